"""SimHash near-duplicates, found with BK-trees.

A text's fingerprint has a bit set where more than half of its shingles' hashes have it. Texts
whose fingerprints differ in at most ``radius`` bits are linked, and linked texts form groups.

The search is over distinct fingerprints, so copies cost nothing. The 64 bits are cut into
``radius + spare`` blocks: two fingerprints within the radius agree in all bits of some ``spare``
of the blocks. Each choice of blocks and each value of their bits is a shard, and a shard's BK-tree
(children keyed by their distance to the parent) is searched along the edges within the radius.
The trees would grow with the corpus, so they are not broadcast from the driver: a shuffle brings
each tree to the tasks that hold queries for it, and only to those. ``spare`` follows from the
number of fingerprints, so that shards stay small; a shard with more than ``tile`` fingerprints is
cut into tiles, and every pair of its tiles is one piece of work. A piece reports a forest over
its fingerprints instead of all pairs, which keeps every link of the groups.

Defined results: a null or empty text, or one without words, has fingerprint zero and is linked
like any other; a text with fewer words than a shingle is one shingle; a null doc_id never is a
group's id unless the group has no other; repeated rows are kept; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from odskein.llm.components import components
from odskein.llm.shared import carried, given_back, let_go, return_memory, stored
from odskein.operators.lookups import with_totals

SEED = 42
BITS = 64


def fingerprint(text: str, shingle: int) -> int:
    """The fingerprint of one text as an unsigned integer."""
    import xxhash

    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = [end - 1 for end in accumulate(len(word) + 1 for word in words)]
    starts = [0, *(end + 1 for end in ends)]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :])), np.uint64)
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    set_bits = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int.from_bytes(np.packbits(set_bits).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int, carry: bool = False) -> DataFrame:
    """row (a number), doc_id and fingerprint (the 64 bits as a signed long) of every document.

    With ``carry`` the documents' columns come along under names of their own.
    """
    names = ["row", "doc_id", *(f"c{i}" for i in range(len(docs.columns)) if carry)]

    def run(batches):
        let_go()
        for batch in batches:
            values = [fingerprint(text or "", shingle) for text in batch.column("plain").to_pylist()]
            signed = np.array(values, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(signed)], names=[*names, "fingerprint"])
            return_memory()

    plain = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("plain"),
        *(carried(docs) if carry else []),
    )
    return plain.mapInArrow(run, StructType([plain.schema[c] for c in names]).add("fingerprint", "long"))


class BKTree:
    """A metric tree of integers under the Hamming distance."""

    def __init__(self):
        self.root = None

    def add(self, value: int) -> None:
        if self.root is None:
            self.root = (value, {})
            return
        node = self.root
        while distance := (node[0] ^ value).bit_count():
            child = node[1].get(distance)
            if child is None:
                node[1][distance] = (value, {})
                return
            node = child

    def within(self, value: int, radius: int) -> list[int]:
        """All values at most ``radius`` away; only edges that can lead to one are followed."""
        found, open_nodes = [], [self.root] if self.root else []
        while open_nodes:
            other, children = open_nodes.pop()
            distance = (other ^ value).bit_count()
            if distance <= radius:
                found.append(other)
            for edge, child in children.items():
                if -radius <= edge - distance <= radius:
                    open_nodes.append(child)
        return found


class Forest:
    """Disjoint sets whose representative is the smallest member."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        parent = self.parent
        while (above := parent.get(x, x)) != x:
            parent[x] = parent.get(above, above)
            x = above
        return x

    def link(self, x: int, y: int) -> None:
        a, b = sorted((self.find(x), self.find(y)))
        self.parent[a] = a
        self.parent[b] = a


def shard_masks(radius: int, spare: int) -> list[int]:
    """One mask for each choice of ``spare`` of the blocks, as signed longs."""
    count = radius + spare
    cuts = [BITS * i // count for i in range(count + 1)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:])]
    masks = [sum(chosen) for chosen in combinations(blocks, spare)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def spare_blocks(count: int, radius: int, shard: int) -> int:
    """How many agreeing blocks make shards of about ``shard`` fingerprints, if bits are even."""
    spare = 1
    while spare < 4 and count >> (BITS * spare // (radius + spare)) > shard:
        spare += 1
    return spare


def links(prints: DataFrame, radius: int, shard: int = 256, tile: int = 2048) -> DataFrame:
    """Edges (a, b) of a forest whose groups are those of all pairs within the radius.

    ``prints`` has distinct fingerprints and is read twice, so it is a stored table.
    """
    masks = shard_masks(radius, spare_blocks(prints.count(), radius, shard))
    keyed = prints.select(
        "fingerprint",
        F.explode(F.array(*[F.struct(F.lit(i).alias("choice"), F.col("fingerprint").bitwiseAND(F.lit(m)).alias("bits")) for i, m in enumerate(masks)])).alias("shard"),
    ).select("fingerprint", "shard.*")
    sizes = keyed.groupBy("choice", "bits").count().where("count > 1")
    tiles = F.ceil(F.col("count") / tile).cast("int")
    own = F.pmod(F.xxhash64("fingerprint"), F.col("tiles")).cast("int")
    pieces = (
        keyed.join(sizes, ["choice", "bits"])
        .select("choice", "bits", "fingerprint", tiles.alias("tiles"))
        .select("*", own.alias("own"))
        .select("*", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
        .select("choice", "bits", F.least("own", "other").alias("tree"), F.greatest("own", "other").alias("query"), "own", "fingerprint")
    )
    key = ["choice", "bits", "tree", "query"]

    def search(batches):
        piece, rows = None, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (*key, "own", "fingerprint")]
            for *at, own, value in zip(*columns):
                if at != piece:
                    yield from _edges(piece, rows, radius)
                    piece, rows = at, []
                rows.append((own, value & (1 << BITS) - 1))
        yield from _edges(piece, rows, radius)

    sorted_pieces = pieces.repartition(*key).sortWithinPartitions(*key, "own", "fingerprint")
    return sorted_pieces.mapInArrow(search, "a long, b long").distinct()


def _edges(piece, rows, radius):
    """Search one piece of work: the rows of its tree's tile, then those that ask."""
    if piece is None:
        return
    tree_tile, query_tile = piece[2:]
    tree, forest = BKTree(), Forest()
    for own, value in rows:
        if own == query_tile:
            for other in tree.within(value, radius):
                forest.link(value, other)
        if own == tree_tile:
            tree.add(value)
    pairs = [(x, forest.find(x)) for x in forest.parent]
    pairs = np.array([p for p in pairs if p[0] != p[1]], np.uint64).reshape(-1, 2).view(np.int64)
    if len(pairs):
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def groups(rows: DataFrame, radius: int) -> DataFrame:
    """fingerprint, root (the group's smallest fingerprint) and component_id, stored.

    ``rows`` is a stored table with doc_id and fingerprint.
    """
    prints = stored(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "prints")
    roots = components(links(prints.select("fingerprint"), radius))
    labelled = prints.join(roots, prints["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root")
    )
    heads = labelled.groupBy("root").agg(F.min("first").alias("component_id"))
    return stored(with_totals(labelled, heads, ["root"]).select("fingerprint", "root", "component_id"), "groups")


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the group's smallest doc_id."""
    rows = stored(fingerprints(docs, shingle), "fingerprints")
    return rows.join(groups(rows, radius), "fingerprint").select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


def representatives(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """One document of each group, with all its columns: that with the smallest doc_id."""
    rows = stored(fingerprints(docs, shingle, carry=True), "fingerprints")
    found = rows.select("row", "doc_id", "fingerprint").join(groups(rows, radius), "fingerprint")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    chosen = found.groupBy("root").agg(F.min(order).alias("chosen")).select("chosen.row")
    return given_back(rows.join(chosen, "row", "left_semi"), docs)
