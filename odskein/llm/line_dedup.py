"""Lines that many documents share, kept in one of them.

A line's key is the line without white space at both ends and with A-Z in lower case. Every text is
exploded into its lines; keys of at least ``least_chars`` code points are hashed (128 bits of a
cryptographic hash, so that different keys do not meet) and the different documents of each hash
counted. A key that at least ``least_docs`` documents hold loses all its lines except in the
document with the largest id. What is left is put together again by position.

Only hashes and positions are exchanged by key: a line that a third of all documents hold is
counted in two steps, first for each (hash, document), and its places are looked up in a stored
table, so that the join's hot partitions can be split. The texts move once, to meet the positions
they lose, under their id and a hash of the text: repeated ids are spread, and the positions under
one such pair are at most the lines of one text.

Defined results: a null or empty text is one empty line; rows with the same doc_id are one document,
whose rows lose or keep a line alike; rows without doc_id are one document too, which never is the
one that keeps; repeated rows are kept; an empty table gives no rows; columns other than the two
named are not looked at, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odskein.llm.shared import stored
from odskein.llm.token_files import slices

LEAST_CHARS = 40
LEAST_DOCS = 5

ENTRIES_SCHEMA = "doc_id long, mark long, pos int, high long, low long"
KEPT_SCHEMA = "doc_id long, n_lines long, n_dropped long, text string"


def keys_of(text: str, least_chars: int) -> list[tuple[int, bytes]]:
    """(position, key) of the lines whose key has at least ``least_chars`` code points."""
    found = []
    for i, line in enumerate(text.encode("utf-8").lower().split(b"\n")):  # bytes: A-Z only
        key = line.strip(b" \t\n\x0b\x0c\r")
        if len(key) >= least_chars and (key.isascii() or len(key.decode("utf-8")) >= least_chars):
            found.append((i, key))
    return found


def _rows(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("mark"), text.alias("text"))


def line_entries(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """One row for each long line: doc_id, the text's mark, the line's position and its key's hash in two halves."""

    def explode(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for first, last in slices([len(text) for text in texts]):
                rows, places, hashes = [], [], []
                for row in range(first, last):
                    for place, key in keys_of(texts[row], least_chars):
                        rows.append(row)
                        places.append(place)
                        hashes.append(hashlib.blake2b(key, digest_size=16).digest())
                halves = np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)
                which = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(which),
                        batch.column("mark").take(which),
                        pa.array(places, pa.int32()),
                        pa.array(halves[:, 0]),
                        pa.array(halves[:, 1]),
                    ],
                    names=["doc_id", "mark", "pos", "high", "low"],
                )

    return _rows(docs).mapInArrow(explode, ENTRIES_SCHEMA)


def widespread(entries: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """Hashes that at least ``least_docs`` documents hold, and the largest of these documents' ids."""
    counted = entries.groupBy("high", "low").agg(
        F.count_distinct(F.struct("doc_id")).alias("holders"),  # a struct, so that a missing id counts
        F.max("doc_id").alias("keeper"),
    )
    return counted.where(F.col("holders") >= least_docs).select("high", "low", "keeper")


def dropped_places(entries: DataFrame, common: DataFrame) -> DataFrame:
    """doc_id, mark and the positions that its text loses; both inputs are stored tables."""
    lost = entries.join(common, ["high", "low"]).where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    return lost.groupBy("doc_id", "mark").agg(F.collect_set("pos").alias("places"))


def without_common_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """doc_id, n_lines (before), n_dropped and the text that is left, of every row."""
    entries = stored(line_entries(docs, least_chars), "line-entries")
    common = stored(widespread(entries, least_docs), "common-lines")
    places = stored(dropped_places(entries, common), "dropped-lines").alias("lost")
    rows = _rows(docs).alias("rows")
    same = F.col("rows.doc_id").eqNullSafe(F.col("lost.doc_id")) & (F.col("rows.mark") == F.col("lost.mark"))

    def reassemble(batches):
        for batch in batches:
            texts = batch.column("text")
            places = batch.column("places")
            for first, last in slices(pa.compute.utf8_length(texts).to_pylist()):
                n_lines, n_dropped, kept = [], [], []
                for text, lost in zip(texts.slice(first, last - first).to_pylist(), places.slice(first, last - first).to_pylist()):
                    lines, gone = text.split("\n"), set(lost or ())
                    n_lines.append(len(lines))
                    n_dropped.append(len(gone))
                    kept.append("\n".join([line for i, line in enumerate(lines) if i not in gone]) if gone else text)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, last - first), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.string())],
                    names=["doc_id", "n_lines", "n_dropped", "text"],
                )

    met = rows.join(places, same, "left").select("rows.doc_id", "rows.text", "lost.places")
    return met.mapInArrow(reassemble, KEPT_SCHEMA)
