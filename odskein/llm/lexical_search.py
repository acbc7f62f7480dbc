"""Ranked lexical search over bit-sliced Bloom signatures.

The index holds documents of similar length in blocks. A block's signature is a bit matrix: its
columns are the block's documents, its rows the values of a hash, so that one row is a bitmap of
the documents that may hold a term. There is one matrix (plane) for each of a list of counts; a
document's term sets its bits in the plane of count c if it occurs at least c times. A term is
present at most where the bitmaps of all its rows meet, so planes overestimate counts.

A search adds up, for each query, the planes' bitmaps weighted by what a term gains with that
count in a document of that length. The sum is an upper bound of the document's score. The
documents with the largest bounds are scored exactly first; the k-th of their scores is a score
that k documents reach, so a document whose bound is below it is not in the result. All others
are scored exactly from their words. Nothing else leaves out a document: no cap, no sample.

Scores are whole numbers. With N documents that have a term, L terms in all, n terms in a document,
df documents that hold a term and tf its count in a document, a term weighs
w = floor(1000 ln((2N + 2) / (2df + 1))); m = 10 + 90 n N div L; a score is the sum of
w * (10**9 tf div (1000 tf + 8 m)) over the query's terms, once each.

What grows: the index with the documents; what a task emits with the queries and k. Queries are
taken in blocks of about ``PAIRS`` (query, term) pairs, and only one block's terms, weights and
thresholds are with the driver and in the tasks at a time. The k best of each task meet in two
steps, so no task gets the rows of all tasks.

Defined results: null and empty texts have no terms, are not counted and never found; a query
without terms, or whose terms no document holds, has no rows; the rows of a repeated query id are
one query with the terms of all; repeated doc_ids are documents of their own; a missing doc_id ranks
behind others of the same score; empty tables give no rows; other columns are not looked at.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections import Counter
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from odskein.llm.native import lower_az, plain_words, whole_text
from odskein.llm.shared import new_path, return_memory, stored
from odskein.llm.wordhash import words_of

# Words and documents of one block of the index.
BLOCK_WORDS = 1 << 17
BLOCK_DOCS = 1024
# Counts that have a plane; beyond the last one they go on doubling.
COUNTS = (1, 2, 3, 4, 6, 8, 12, 16)
# Rows of the first plane for each word of the block's longest documents, and their bounds.
ROWS_PER_WORD, LEAST_ROWS, MOST_ROWS = 8, 64, 1 << 17
# Different words a task counts before it hands the counts on.
VOCABULARY = 200_000
# (query, term) pairs of the queries searched at once.
PAIRS = 100_000
# Documents whose bounds are added up at once.
COLUMNS = 256
# Tasks that first choose among the other tasks' best rows of a query.
SALTS = 32

INDEX_SCHEMA = (
    "block long, docs long, total long, doc_ids array<long>, ns array<int>, n_rows int, n_planes int, signature binary,"
    " words array<binary>, terms array<string>, dfs array<long>"
)
_TYPES = [pa.int64()] * 3 + [pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.string()), pa.list_(pa.int64())]
_NAMES = [field.split()[0] for field in INDEX_SCHEMA.split(", ")]


def plane_counts(most: int) -> list[int]:
    """The counts of the planes that a block needs whose largest count is ``most``."""
    counts = [c for c in COUNTS if c <= most]
    while counts[-1] >= COUNTS[-1] and 2 * counts[-1] <= most:
        counts.append(2 * counts[-1])
    return counts


def plane_rows(n_rows: int, plane: int) -> int:
    """Few terms occur more than once, so later planes need fewer rows."""
    return max(LEAST_ROWS, n_rows >> min(2 * plane, 4))


def hashed_rows(crcs: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Two rows of a plane for each term's checksum."""
    mixed = crcs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    shift = np.uint64(64 - (n_rows.bit_length() - 1))
    return (mixed >> shift).astype(np.int64), ((mixed * np.uint64(0xD6E8FEB86659FD93)) >> shift).astype(np.int64)


def signature(terms: list[tuple[np.ndarray, np.ndarray]], n_rows: int) -> tuple[int, bytes]:
    """Number of planes and their packed bits, for the (checksums, counts) of each document of a block."""
    width = len(terms)
    crcs = np.concatenate([c for c, _ in terms])
    counts = np.concatenate([c for _, c in terms])
    owner = np.repeat(np.arange(width), [len(c) for c, _ in terms])
    planes = []
    for plane, least in enumerate(plane_counts(int(counts.max()))):
        held = counts >= least
        rows = plane_rows(n_rows, plane)
        bits = np.zeros((rows, width), bool)
        for row in hashed_rows(crcs[held], rows):
            bits[row, owner[held]] = True
        planes.append(np.packbits(bits, axis=1).tobytes())
    return len(planes), b"".join(planes)


class _Blocks:
    """Collects the documents of one task into blocks of similar length."""

    def __init__(self, partition: int):
        self.next = partition << 32
        self.open: dict[int, list] = {}
        self.sizes: Counter = Counter()
        self.vocabulary: Counter = Counter()

    def add(self, doc_id: int | None, text: str):
        words = words_of(text.encode("utf-8")).split()
        if not words:
            return
        counts = Counter(words)
        self.vocabulary.update(counts.keys())
        crcs = np.fromiter(map(zlib.crc32, counts), np.uint32, len(counts))
        tfs = np.fromiter(counts.values(), np.int64, len(counts))
        length = len(words).bit_length()
        self.open.setdefault(length, []).append((doc_id, len(words), b" ".join(words), crcs, tfs))
        self.sizes[length] += len(words)
        if self.sizes[length] >= BLOCK_WORDS or len(self.open[length]) >= BLOCK_DOCS:
            yield self.block(length)
        if len(self.vocabulary) >= VOCABULARY:
            yield self.counted()

    def rest(self):
        for length in sorted(self.open):
            yield self.block(length)
        if self.vocabulary:
            yield self.counted()

    def block(self, length: int) -> pa.RecordBatch:
        docs = self.open.pop(length)
        self.next, total = self.next + 1, self.sizes.pop(length)
        n_rows = min(MOST_ROWS, max(LEAST_ROWS, ROWS_PER_WORD << length))
        n_planes, bits = signature([doc[3:] for doc in docs], n_rows)
        ids, ns, words = ([doc[i] for doc in docs] for i in range(3))
        return _row([self.next, len(docs), total, ids, ns, n_rows, n_planes, bits, words, None, None])

    def counted(self) -> pa.RecordBatch:
        terms = [term.decode("utf-8") for term in self.vocabulary]
        dfs = list(self.vocabulary.values())
        self.vocabulary = Counter()
        return _row([None] * 9 + [terms, dfs])


def _row(values: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, _TYPES)], names=_NAMES)


def write_index(docs: DataFrame, path: str) -> None:
    """Write the blocks of all documents, and how many of each task's documents hold each term."""

    def build(batches):
        from pyspark import TaskContext

        blocks = _Blocks(TaskContext.get().partitionId())
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                yield from blocks.add(doc_id, text.as_py() or "")
        yield from blocks.rest()
        return_memory()

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = plain.mapInArrow(build, INDEX_SCHEMA)
    rows.write.option("compression", "zstd").option("parquet.block.size", str(32 << 20)).option("parquet.enable.dictionary", "false").parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INDEX_SCHEMA).parquet(path)


def query_terms(items: DataFrame, index: DataFrame) -> DataFrame:
    """item_id, term and df of every different term of every query that some document holds."""
    said = items.select(F.col("item_id").alias("item_id"), F.explode(F.array_distinct(plain_words(lower_az(whole_text())))).alias("term"))
    said = said.distinct()
    held = index.where("terms is not null").select(F.explode(F.arrays_zip("terms", "dfs")).alias("held")).select("held.*")
    wanted = held.join(said.select(F.col("term").alias("terms")).distinct(), "terms", "left_semi")
    dfs = wanted.groupBy(F.col("terms").alias("term")).agg(F.sum("dfs").alias("df"))
    return said.join(stored(dfs, "term-counts"), "term")


@dataclass(frozen=True)
class Queries:
    """One block of queries: their terms and weights, and which terms each has."""

    ids: list
    terms: list[bytes]
    weights: np.ndarray
    which: np.ndarray  # the terms of all queries, one query after the other
    starts: np.ndarray
    n_docs: int
    n_words: int
    k: int
    floors: np.ndarray | None = None  # scores that k documents are known to reach

    def lengths(self, ns) -> np.ndarray:
        return np.array([10 + (90 * int(n) * self.n_docs) // self.n_words for n in ns], np.int64)

    def sums(self, gains: np.ndarray) -> np.ndarray:
        """For each query the sum over its terms' rows of ``gains``."""
        return np.add.reduceat(gains[self.which], self.starts, axis=0)


def numbered_queries(rows: list, n_docs: int, n_words: int, k: int) -> Queries:
    """From collected rows of item_id, term and df."""
    ids = sorted({row["item_id"] for row in rows}, key=lambda i: (i is not None, i))
    dfs = {row["term"]: row["df"] for row in rows}
    number = {term: n for n, term in enumerate(dfs)}
    of = {i: [] for i in ids}
    for row in rows:
        of[row["item_id"]].append(number[row["term"]])
    sizes = np.array([len(of[i]) for i in ids])
    return Queries(
        ids,
        [term.encode("utf-8") for term in dfs],
        np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in dfs.values()], np.int64),
        np.array([n for i in ids for n in of[i]]),
        np.cumsum(sizes) - sizes,
        n_docs,
        n_words,
        k,
    )


def upper_bounds(queries: Queries, crcs: np.ndarray, ns: list[int], n_rows: int, n_planes: int, bits: bytes) -> np.ndarray:
    """Bounds of the scores, queries by documents, from one block's signature."""
    width = len(ns)
    packed, at, present, levels = -(-width // 8), 0, None, None
    data = np.frombuffer(bits, np.uint8)
    for plane in range(n_planes):
        rows = plane_rows(n_rows, plane)
        table = data[at : at + rows * packed].reshape(rows, packed)
        at += rows * packed
        one, two = hashed_rows(crcs, rows)
        met = table[one] & table[two]
        present = met if present is None else present & met  # a count reaches a plane only through those before
        slices = np.unpackbits(present, axis=1, count=width)
        levels = slices.astype(np.int8) if levels is None else levels + slices
    m, longest = queries.lengths(ns), np.array(ns, np.int64)
    counts = plane_counts(max(COUNTS[-1], 2 ** (n_planes + 8)))[: n_planes + 1]
    gains = [np.zeros(width, np.int64)]
    for plane in range(n_planes):
        most = np.minimum(longest, counts[plane + 1] - 1) if plane + 1 < n_planes else longest
        gains.append((1_000_000_000 * most) // (1000 * most + 8 * m))
    gains = np.array(gains)
    out = np.empty((len(queries.ids), width), np.int64)
    for first in range(0, width, COLUMNS):
        some = slice(first, min(width, first + COLUMNS))
        gained = np.take_along_axis(gains[:, some], levels[:, some].astype(np.intp), axis=0)
        out[:, some] = queries.sums(gained * queries.weights[:, None])
    return out


def exact_scores(queries: Queries, number: dict[bytes, int], n: int, words: bytes) -> np.ndarray:
    """A document's score for each query."""
    counts = Counter(words.split())
    met = [(number[t], counts[t]) for t in counts.keys() & number.keys()]
    gains = np.zeros(len(queries.terms), np.int64)
    if met:
        which, tf = np.array(met, np.int64).T
        gains[which] = queries.weights[which] * ((1_000_000_000 * tf) // (1000 * tf + 8 * queries.lengths([n])))
    return queries.sums(gains)


class Best:
    """The k best documents of each query so far."""

    def __init__(self, queries: Queries):
        self.k = queries.k
        self.heaps: list[list] = [[] for _ in queries.ids]
        self.floors = np.ones(len(queries.ids), np.int64) if queries.floors is None else queries.floors.copy()

    def offer(self, scores: np.ndarray, doc_id: int | None) -> None:
        for q in np.flatnonzero(scores >= self.floors).tolist():
            heap, entry = self.heaps[q], (int(scores[q]), doc_id is not None, -(doc_id or 0))
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            else:
                heapq.heappushpop(heap, entry)
            if len(heap) == self.k:
                self.floors[q] = max(self.floors[q], heap[0][0])

    def batch(self) -> pa.RecordBatch:
        rows = [(q, -entry[2] if entry[1] else None, entry[0]) for q, heap in enumerate(self.heaps) for entry in heap]
        columns = zip(*rows) if rows else ([], [], [])
        return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names=["query", "doc_id", "score"])


SCORED = "query long, doc_id long, score long"


def _highest(rows: DataFrame, k: int, *order) -> DataFrame:
    """The k first rows of each query, with their rank; chosen in two steps."""
    salt = F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS))
    first = Window.partitionBy("query", salt).orderBy(*order)
    final = Window.partitionBy("query").orderBy(*order)
    some = rows.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k).drop("rank")
    return some.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k)


def _checksums(queries: Queries) -> np.ndarray:
    return np.array([zlib.crc32(term) for term in queries.terms], np.uint32)


def _most_promising(index: DataFrame, queries: Queries) -> DataFrame:
    """query, block, place: the k documents with the largest bounds of each query."""

    def bound(batches):
        crcs, k = _checksums(queries), queries.k
        best = np.zeros((len(queries.ids), k), np.int64)
        at = np.zeros((len(queries.ids), k, 2), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                bounds = upper_bounds(queries, crcs, row["ns"], row["n_rows"], row["n_planes"], row["signature"])
                places = np.broadcast_to(np.stack([np.full(bounds.shape[1], row["block"]), np.arange(bounds.shape[1])], axis=1), (*bounds.shape, 2))
                bounds, places = np.concatenate([best, bounds], axis=1), np.concatenate([at, places], axis=1)
                top = np.argpartition(-bounds, k - 1, axis=1)[:, :k]
                best = np.take_along_axis(bounds, top, axis=1)
                at = np.take_along_axis(places, top[:, :, None], axis=1)
        query, rank = np.nonzero(best)
        columns = [query, at[query, rank, 0], at[query, rank, 1], best[query, rank]]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query", "block", "place", "bound"])

    signatures = index.where("block is not null").select("block", "ns", "n_rows", "n_planes", "signature")
    found = signatures.mapInArrow(bound, "query long, block long, place long, bound long")
    return _highest(found, queries.k, F.desc("bound"), "block", "place").select("query", "block", "place")


def _first_floors(index: DataFrame, queries: Queries) -> np.ndarray:
    """Of each query a score that k documents reach; 1 if not so many are known."""
    # at most k rows for each query of the block
    asked = _most_promising(index, queries).groupBy("block").agg(F.collect_set(F.col("place").cast("int")).alias("places"))
    held = index.where("block is not null").select("block", "doc_ids", "ns", "words").join(F.broadcast(asked), "block")
    chosen = held.select(F.explode(F.transform("places", lambda p: F.struct(F.get("doc_ids", p).alias("doc_id"), F.get("ns", p).alias("n"), F.get("words", p).alias("words")))).alias("doc")).select("doc.*")

    def score(batches):
        best, number = Best(queries), {term: n for n, term in enumerate(queries.terms)}
        for batch in batches:
            for row in batch.to_pylist():
                best.offer(exact_scores(queries, number, row["n"], row["words"]), row["doc_id"])
        yield best.batch()

    kth = _highest(chosen.mapInArrow(score, SCORED), queries.k, F.desc("score"), F.asc_nulls_last("doc_id")).where(F.col("rank") == queries.k)
    floors = np.ones(len(queries.ids), np.int64)
    for row in kth.select("query", "score").collect():  # at most one row for each query of the block
        floors[row["query"]] = row["score"]
    return floors


def _ranked(index: DataFrame, queries: Queries) -> DataFrame:
    """query, doc_id, score and rank of the k best documents of each query of a block."""
    queries = replace(queries, floors=_first_floors(index, queries))

    def score(batches):
        crcs, number = _checksums(queries), {term: n for n, term in enumerate(queries.terms)}
        best = Best(queries)
        for batch in batches:
            for i in range(batch.num_rows):
                ns, n_rows, n_planes, bits = (batch.column(c)[i].as_py() for c in ("ns", "n_rows", "n_planes", "signature"))
                bounds = upper_bounds(queries, crcs, ns, n_rows, n_planes, bits)
                ids, words = batch.column("doc_ids")[i].as_py(), batch.column("words")[i].values
                open_ = (bounds >= best.floors[:, None]).any(axis=0)
                # the most promising first: they raise the floors for the others
                order = np.flatnonzero(open_)[np.argsort(-bounds[:, open_].max(axis=0), kind="stable")]
                for place in order.tolist():
                    if (bounds[:, place] >= best.floors).any():
                        best.offer(exact_scores(queries, number, ns[place], words[place].as_py()), ids[place])
        yield best.batch()
        return_memory()

    blocks = index.where("block is not null").select("ns", "n_rows", "n_planes", "signature", "doc_ids", "words")
    found = blocks.mapInArrow(score, SCORED)
    return _highest(found, queries.k, F.desc("score"), F.asc_nulls_last("doc_id"))


def search(index: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the k best documents of each query."""
    spark = index.sparkSession
    totals = index.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()
    pairs = stored(query_terms(items, index), "query-terms")
    blocks = max(1, math.ceil(pairs.count() / PAIRS))
    kind = pairs.schema["item_id"].dataType.simpleString()
    result = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for block in range(blocks):
        rows = pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect()  # about PAIRS rows
        if not rows:
            continue
        queries = numbered_queries(rows, *totals, k)
        names = spark.createDataFrame(list(enumerate(queries.ids)), f"query long, item_id {kind}")
        result = result.unionByName(_ranked(index, queries).join(names, "query").select("item_id", "rank", "doc_id", "score"))
    return result


def ranked_documents(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """Index all documents in the shared folder and search them."""
    spark = docs.sparkSession
    path = new_path(spark, "search-index")
    write_index(docs, path)
    return search(read_index(spark, path), items, k)
