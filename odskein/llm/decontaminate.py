"""Benchmark decontamination: which words of a document stand in a window of a benchmark item.

A window is ``width`` consecutive words of an item (all its words, if it has fewer). A window is in a
document only if all its shingles are, so its rarest one is enough to find it: the prefix of a
containment of one. The job goes over the documents twice, and never shuffles a text.

1. All windows' shingles are counted over the whole corpus, which gives the order by rarity. A
   window with a shingle that never occurs is done.
2. Each place of a document where a window's rarest shingle stands is reported with the words
   around it. The join on that shingle fixes where the window would start; positions outside the
   document are dropped (length and position bounds), and the words must equal the window's.

Both passes look shingles up in a bit field of fixed size (``FIELD_BITS``), whatever the benchmark's
size; false hits are dropped by the join. Equal windows of several items are searched for once.

Defined results: a null text has no words; a null item_id counts as an item with an empty name;
repeated doc_ids keep all their rows; items that share an item_id are one item; an empty
benchmark or documents table gives clean documents or no rows; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType
from pyspark.sql.window import Window

from odskein.llm.shared import carried, given_back, let_go, return_memory, stored
from odskein.llm.token_files import slices
from odskein.llm.wordhash import hash_words, hash_shingles, spell, words_of

FIELD_BITS = 1 << 23
SHINGLE = 3


def item_windows(items: DataFrame, width: int) -> DataFrame:
    """item, window (words joined by blanks) and n (its words), without repeats."""

    def cut(batches):
        for batch in batches:
            out = []
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist()):
                words = words_of((text or "").encode("utf-8", "replace")).split()
                if words:
                    n = min(width, len(words))
                    found = dict.fromkeys(b" ".join(words[i : i + n]) for i in range(len(words) - n + 1))
                    out += [(item, window.decode(), n) for window in found]
            columns = list(zip(*out)) or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int32())], names=["item", "window", "n"]
            )

    plain = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(cut, "item string, window string, n int").distinct()


def window_shingles(windows: DataFrame) -> DataFrame:
    """Every window's shingles: window, n, k (words of the shingle), at (its place) and shingle."""

    def cut(batches):
        for batch in batches:
            out = []
            for window, n in zip(batch.column("window").to_pylist(), batch.column("n").to_pylist()):
                k = min(SHINGLE, n)
                _, _, hashes = hash_words(np.frombuffer(window.encode() + b" ", np.uint8))
                out += [(window, n, k, at, int(value)) for at, value in enumerate(hash_shingles(hashes, k).view(np.int64))]
            columns = list(zip(*out)) or [[]] * 5
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["window", "n", "k", "at", "shingle"])

    return windows.select("window", "n").distinct().mapInArrow(cut, "window string, n int, k int, at int, shingle long")


def bit_field(shingles: DataFrame) -> tuple[np.ndarray, list[int]]:
    """A bit field over the shingles, and their lengths; at most FIELD_BITS places are collected."""
    spot = F.col("shingle").bitwiseAND(F.lit(FIELD_BITS - 1)).cast("int")
    spots = shingles.select(spot.alias("spot")).distinct().toPandas()["spot"].to_numpy(np.int64)
    field = np.zeros(FIELD_BITS, bool)
    field[spots] = True
    return np.packbits(field), [row[0] for row in shingles.select("k").distinct().collect()]


def _places(field: np.ndarray, lengths: list[int], hashes: np.ndarray, doc: np.ndarray):
    """Places and values of the shingles that the field knows, inside single documents."""
    for k in lengths:
        values = hash_shingles(hashes, k)
        spot = (values & np.uint64(FIELD_BITS - 1)).astype(np.int64)
        known = (field[spot >> 3] >> (7 - (spot & 7)).astype(np.uint8)) & 1
        at = np.flatnonzero(known)
        at = at[doc[at] == doc[at + k - 1]]
        yield at, values[at]


def _read(batch):
    """Slices of a batch as one byte string, with words, their hashes and their documents."""
    texts = [(text or "").encode("utf-8", "replace") for text in batch.column("text").to_pylist()]
    for first, last in slices([len(text) for text in texts]):
        joined = words_of(b" ".join(texts[first:last]) + b" ")
        edges = np.cumsum([0, *(len(text) + 1 for text in texts[first:last])])
        starts, ends, hashes = hash_words(np.frombuffer(joined, np.uint8))
        yield first, last, joined, starts, ends, hashes, np.searchsorted(edges, starts, "right") - 1


def shingle_counts(docs: DataFrame, shingles: DataFrame) -> DataFrame:
    """How often each of the shingles occurs in the corpus (and perhaps others, hashed alike)."""
    field, lengths = bit_field(shingles)

    def count(batches):
        let_go()
        for batch in batches:
            for _, _, _, _, _, hashes, doc in _read(batch):
                for _, values in _places(field, lengths, hashes, doc):
                    found, times = np.unique(values.view(np.int64), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(times.astype(np.int64))], names=["shingle", "times"])
            return_memory()

    plain = docs.select(F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(count, "shingle long, times long").groupBy("shingle").agg(F.sum("times").alias("times"))


def rarest_shingles(shingles: DataFrame, counts: DataFrame) -> DataFrame:
    """Of each window that can occur at all, the shingle that occurs least."""
    order = F.struct("times", "shingle", "at", "k")
    return (
        shingles.join(counts, "shingle", "left")
        .groupBy("window", "n")
        .agg(F.min(order).alias("rarest"), F.bool_and(F.col("times").isNotNull()).alias("possible"))
        .where("possible")
        .select("window", "n", "rarest.shingle", "rarest.at", "rarest.k")
    )


PLACES = ArrayType(
    StructType().add("at", "integer").add("shingle", "long").add("lead", "integer").add("around", "string")
)


def shingle_places(docs: DataFrame, prefixes: DataFrame, width: int, carry: bool = False) -> DataFrame:
    """row, doc_id, n_words and the places of prefix shingles with the words around them.

    With ``carry`` the documents' columns come along under names of their own.
    """
    names = ["row", "doc_id", *(f"c{i}" for i in range(len(docs.columns)) if carry)]
    field, lengths = bit_field(prefixes)
    place = pa.struct([("at", pa.int32()), ("shingle", pa.int64()), ("lead", pa.int32()), ("around", pa.string())])

    def find(batches):
        let_go()
        for batch in batches:
            for first, last, joined, starts, ends, hashes, doc in _read(batch):
                count = last - first
                n_words = np.bincount(doc, minlength=count)
                begin = np.cumsum(n_words) - n_words
                places = [[] for _ in range(count)]
                for at, values in _places(field, lengths, hashes, doc):
                    for i, value in zip(at.tolist(), values.view(np.int64).tolist()):
                        d = int(doc[i])
                        low, high = max(int(begin[d]), i - width + 1), min(int(begin[d] + n_words[d]), i + width)
                        around = spell(joined[starts[low] : ends[high - 1]])
                        places[d].append((i - int(begin[d]), value, i - low, around))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(first, count) for c in names),
                        pa.array(n_words.astype(np.int64)),
                        pa.array([[dict(zip(("at", "shingle", "lead", "around"), p)) for p in row] for row in places], pa.list_(place)),
                    ],
                    names=[*names, "n_words", "places"],
                )
            return_memory()

    plain = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        *(carried(docs) if carry else []),
    )
    schema = StructType([plain.schema[c] for c in names]).add("n_words", "long").add("places", PLACES)
    return plain.mapInArrow(find, schema)


def window_hits(places: DataFrame, prefixes: DataFrame) -> DataFrame:
    """row, start, n and window of every occurrence of a window, exactly compared."""
    start = F.col("place.at") - F.col("prefix.at")
    words = F.slice(F.split("place.around", " "), F.col("place.lead") - F.col("prefix.at") + 1, F.col("n"))
    inside = (start >= 0) & (start + F.col("n") <= F.col("n_words")) & (F.col("place.lead") >= F.col("prefix.at"))
    return (
        places.select("row", "n_words", F.explode("places").alias("place"))
        .join(prefixes.alias("prefix"), F.col("place.shingle") == F.col("prefix.shingle"))
        .where(inside)
        .where(F.when(inside, F.array_join(words, " ") == F.col("window")))
        .select("row", start.alias("start"), "n", "window")
        .distinct()
    )


def _searched(docs: DataFrame, items: DataFrame, width: int, carry: bool):
    windows = stored(item_windows(items, width), "windows")
    shingles = stored(window_shingles(windows), "shingles")
    prefixes = stored(rarest_shingles(shingles, shingle_counts(docs, shingles)), "prefixes")
    places = stored(shingle_places(docs, prefixes, width, carry), "places")
    return windows, places, stored(window_hits(places, prefixes), "hits")


def without_contamination(docs: DataFrame, items: DataFrame, width: int = 10) -> DataFrame:
    """The documents in which no window of an item occurs, with all their columns."""
    _, places, hits = _searched(docs, items, width, carry=True)
    return given_back(places.join(hits.select("row").distinct(), "row", "left_anti"), docs)


def contamination(docs: DataFrame, items: DataFrame, width: int = 10) -> DataFrame:
    """For each document its words, those in windows of items, and the items found."""
    windows, places, hits = _searched(docs, items, width, carry=False)
    end = F.col("start") + F.col("n")
    so_far = Window.partitionBy("row").orderBy("start", "n").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.lit(0), end - F.greatest(F.col("start"), F.coalesce(F.max(end).over(so_far), F.lit(0))))
    covered = hits.select("row", "start", "n").distinct().select("row", fresh.alias("fresh")).groupBy("row").agg(F.sum("fresh").alias("n_hit"))
    named = hits.select("row", "window").distinct().join(windows.select("item", "window"), "window").groupBy("row")
    found = named.agg(F.sort_array(F.collect_set("item")).alias("items"))
    items_column = F.coalesce(F.col("items"), F.array().cast("array<string>"))
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0)).cast("long")
    return (
        places.select("row", "doc_id", "n_words")
        .join(covered, "row", "left")
        .join(found, "row", "left")
        .select(
            "doc_id",
            "n_words",
            n_hit.alias("n_hit"),
            F.size(items_column).cast("long").alias("n_items"),
            F.sha2(F.concat_ws(",", items_column), 256).alias("items_sha256"),
            (n_hit > 0).alias("contaminated"),
        )
    )
