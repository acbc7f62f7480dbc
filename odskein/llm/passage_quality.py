"""Quality classifier: attention-based multiple-instance learning over passages.

A document is a bag of passages of PASSAGE words. A passage is described by how often each pair of
character classes follows one another in it; the encoder is a layer learned with the rest. Gated
attention weighs the passages of a document, and the weighted passage decides the document's
score. Only document labels are learned from.

Training is bounded: at most ``sample_docs`` labelled documents of at most ``sample_chars``
characters, chosen by a hash of their id, are described by Spark and fitted on the driver. Scoring
goes over every document whole. A text longer than ``SLICE`` bytes is described a slice at a time,
cut between passages; its attention is summed up as the slices come (largest exponent, sum of
weights, weighted sum), so memory does not grow with the text.

Defined results: a null or empty text is one passage without characters and gets that passage's
score; labels that are not 0 or 1 are not learned from, of several labels of a document the
smallest counts; repeated rows get equal scores; no usable label gives a score of 0.5 to all; an
empty table gives no rows. Nothing but the text is an input of a score.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odskein.llm.shared import carried, given_back, let_go, return_memory
from odskein.llm.token_files import slices

PASSAGE = 80
# Text described at once, in bytes.
SLICE = 1_000_000
# Character classes of bytes: every ASCII punctuation mark that prose or markup uses is one.
_MARKS = b" \n\t.,;:!?'\"-()[]{}<>#*$%&|/\\=_@+~^`"
_CLASS = np.zeros(256, np.int64)
for _i, _c in enumerate(_MARKS):
    _CLASS[_c] = 5 + _i
_CLASS[[c for c in range(256) if chr(c).islower() and c < 128]] = 1
_CLASS[[c for c in range(256) if chr(c).isupper() and c < 128]] = 2
_CLASS[48:58] = 3
_CLASS[128:] = 4
CLASSES = int(_CLASS.max()) + 1
FEATURES = CLASSES * CLASSES


def passage_counts(texts: list[bytes], words: int = PASSAGE) -> tuple[np.ndarray, np.ndarray]:
    """Counts of class pairs of each passage, and the number of passages of each text.

    A pair belongs to the passage its first byte stands in. Texts do not touch each other.
    """
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1  # the separators' places
    begins = np.concatenate([[0], ends[:-1] + 1])
    space = np.concatenate([[True], (data == 32) | ((data >= 9) & (data <= 13))])
    starts = np.flatnonzero(space[:-1] & ~space[1:])
    doc = np.searchsorted(ends, starts)
    first_word = np.searchsorted(starts, begins)
    number = np.arange(len(starts)) - first_word[doc]
    n_words = np.bincount(doc, minlength=len(texts))
    passages = np.maximum(1, -(-n_words // words))
    # a passage starts at its first word, a text's first passage at the text's start
    heads = starts[(number % words == 0) & (number > 0)]
    edges = np.sort(np.concatenate([begins, heads]))
    kinds = _CLASS[data]
    of = np.repeat(np.arange(len(edges)), np.diff(np.concatenate([edges, [len(data)]])))
    inside = np.ones(len(data) - 1, bool)
    inside[ends[:-1]] = False
    inside[(ends - 1)[ends - 1 >= begins]] = False
    pairs = (of[:-1] * FEATURES + kinds[:-1] * CLASSES + kinds[1:])[inside]
    return np.bincount(pairs, minlength=len(edges) * FEATURES).reshape(len(edges), FEATURES), passages


def passage_slices(text: bytes, words: int = PASSAGE, size: int = SLICE) -> Iterator[np.ndarray]:
    """``passage_counts`` of one text, some passages at a time."""
    at = 0
    while at < len(text) or not at:
        upto, cut = at + size, None
        while upto < len(text) and cut is None:
            data = np.frombuffer(text, np.uint8, upto - at, at)
            space = np.concatenate([[True], (data == 32) | ((data >= 9) & (data <= 13))])
            starts = np.flatnonzero(space[:-1] & ~space[1:])
            whole = (len(starts) - 1) // words * words
            if whole > 0:
                cut = at + int(starts[whole])
            else:  # words so long that no passage ends here
                upto += size
        if cut is None:
            yield passage_counts([text[at:]], words)[0]
            return
        counts, _ = passage_counts([text[at:cut]], words)
        counts[-1, _CLASS[text[cut - 1]] * CLASSES + _CLASS[text[cut]]] += 1  # the pair that the cut parts
        yield counts
        at = cut


def described(counts: np.ndarray) -> np.ndarray:
    """Square roots of the shares of the class pairs; zeros for a passage without any."""
    total = counts.sum(axis=1, keepdims=True)
    return np.sqrt(counts / np.maximum(total, 1)).astype(np.float32)


# ---------------------------------------------------------------- the model


@dataclass
class Model:
    """Encoder (w, b), gated attention (v, u, q) and the document's classifier (c, d)."""

    w: np.ndarray
    b: np.ndarray
    v: np.ndarray
    u: np.ndarray
    q: np.ndarray
    c: np.ndarray
    d: np.ndarray

    NAMES = ("w", "b", "v", "u", "q", "c", "d")

    @classmethod
    def fresh(cls, hidden: int, gates: int, seed: int) -> Model:
        rng = np.random.Generator(np.random.PCG64(seed))
        draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        zero = lambda n: np.zeros(n, np.float32)
        return cls(4 * draw(FEATURES, hidden), zero(hidden), draw(hidden, gates), draw(hidden, gates), draw(gates), draw(hidden), zero(1))

    def forward(self, x: np.ndarray, sizes: np.ndarray) -> dict:
        """Scores of the bags of ``sizes`` rows of ``x``, with what the gradient needs."""
        starts = np.cumsum(sizes) - sizes
        bag = np.repeat(np.arange(len(sizes)), sizes)
        h = np.tanh(x @ self.w + self.b)
        t, s = np.tanh(h @ self.v), _sigmoid(h @ self.u)
        e = (t * s) @ self.q
        a = np.exp(e - np.maximum.reduceat(e, starts)[bag])
        a /= np.add.reduceat(a, starts)[bag]
        z = np.add.reduceat(a[:, None] * h, starts)
        return {"bag": bag, "starts": starts, "h": h, "t": t, "s": s, "a": a, "z": z, "score": _sigmoid(z @ self.c + self.d[0])}

    def gradients(self, x: np.ndarray, sizes: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss."""
        f = self.forward(x, sizes)
        bag, h, t, s, a = f["bag"], f["h"], f["t"], f["s"], f["a"]
        g = ((f["score"] - y) / len(y)).astype(np.float32)
        dz = g[:, None] * self.c
        da = (dz[bag] * h).sum(axis=1)
        de = a * (da - np.add.reduceat(a * da, f["starts"])[bag])
        dt, ds = de[:, None] * self.q * s * (1 - t * t), de[:, None] * self.q * t * s * (1 - s)
        dh = (a[:, None] * dz[bag] + dt @ self.v.T + ds @ self.u.T) * (1 - h * h)
        return {
            "w": x.T @ dh, "b": dh.sum(axis=0), "v": h.T @ dt, "u": h.T @ ds, "q": (t * s).T @ de, "c": f["z"].T @ g, "d": g.sum(keepdims=True),
        }

    def scores(self, texts: list[bytes]) -> np.ndarray:
        counts, sizes = passage_counts(texts)
        return self.forward(described(counts), sizes)["score"].astype(np.float64)

    def long_score(self, text: bytes, size: int = SLICE) -> float:
        """The score of one text, from slices of it."""
        most, total, weighted = -np.inf, 0.0, np.zeros(len(self.c), np.float64)
        for counts in passage_slices(text, size=size):
            h = np.tanh(described(counts) @ self.w + self.b)
            e = ((np.tanh(h @ self.v) * _sigmoid(h @ self.u)) @ self.q).astype(np.float64)
            high = max(most, float(e.max()))
            a = np.exp(e - high)
            total, weighted, most = total * np.exp(most - high) + a.sum(), weighted * np.exp(most - high) + a @ h, high
        return float(_sigmoid(weighted / total @ self.c + self.d[0]))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(bags: list[np.ndarray], labels: list[int], hidden: int = 32, gates: int = 16, steps: int = 1200, rate: float = 0.004, decay: float = 1e-4, seed: int = 11) -> Model:
    """Adam over mini-batches of bags (counts of class pairs, one row for each passage), for about ``steps`` steps."""
    model = Model.fresh(hidden, gates, seed)
    rng = np.random.Generator(np.random.PCG64(seed))
    moments = {n: (np.zeros_like(getattr(model, n)), np.zeros_like(getattr(model, n))) for n in Model.NAMES}
    y, step = np.array(labels, np.float32), 0
    epochs = max(1, round(steps / -(-len(bags) // 64)))
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        pace = rate * (1 - epoch / epochs)
        for at in range(0, len(order), 64):
            chosen = order[at : at + 64]
            x = described(np.concatenate([bags[i] for i in chosen]))
            sizes = np.array([len(bags[i]) for i in chosen])
            step += 1
            for name, grad in model.gradients(x, sizes, y[chosen]).items():
                value = getattr(model, name)
                first, second = moments[name]
                first += 0.1 * (grad - first)
                second += 0.001 * (grad * grad - second)
                value -= pace * (first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8) + decay * value)
    return model


# ---------------------------------------------------------------- Spark


def sample_bags(docs: DataFrame, labels: DataFrame, sample_docs: int, sample_chars: int) -> tuple[list[np.ndarray], list[int]]:
    """Passage counts and labels of at most ``sample_docs`` labelled documents."""

    def describe(batches):
        let_go()
        for batch in batches:
            packed, sizes = [], []
            for text in batch.column("text").to_pylist():
                counts, _ = passage_counts([(text or "").encode("utf-8", "replace")])
                packed.append(zlib.compress(np.minimum(counts, 65535).astype(np.uint16).tobytes(), 1))
                sizes.append(len(counts))
            yield pa.RecordBatch.from_arrays([batch.column("quality"), pa.array(sizes, pa.int32()), pa.array(packed, pa.binary())], names=["quality", "size", "counts"])
            return_memory()

    chosen = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min(F.col("quality").cast("int")).alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_docs)
    )
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    short = plain.where(F.length(F.coalesce("text", F.lit(""))) <= sample_chars)
    # one row for each chosen doc_id however often it is repeated, always the same one and in the same
    # order: at most sample_docs small rows, so their size is bounded whatever the corpus
    one = F.min_by("text", F.struct(F.xxhash64("text"), F.col("text"))).alias("text")
    rows = short.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "quality").agg(one)
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id").select("text", "quality")
    found = rows.mapInArrow(describe, "quality int, size int, counts binary").collect()
    bags = [np.frombuffer(zlib.decompress(r["counts"]), np.uint16).reshape(r["size"], FEATURES) for r in found]
    return bags, [r["quality"] for r in found]


def learn(docs: DataFrame, labels: DataFrame, sample_docs: int = 3000, sample_chars: int = 30_000) -> Model | None:
    """A model from the labels given; None if none is usable."""
    bags, y = sample_bags(docs, labels, sample_docs, sample_chars)
    return fit(bags, y) if bags else None


def scored(docs: DataFrame, model: Model | None) -> DataFrame:
    """The documents with a column ``score`` (its former namesake, if any, is replaced)."""
    names = [c for c in docs.columns if c != "score"]

    def run(batches):
        let_go()
        for batch in batches:
            texts = [(t or "").encode("utf-8", "replace") for t in batch.column("text").to_pylist()]
            scores = np.full(len(texts), 0.5)
            if model is not None:
                for first, last in slices([len(t) for t in texts], SLICE):
                    # a slice ends with the row that fills it, so only its last text can be a long one
                    long = len(texts[last - 1]) > SLICE
                    if last - first > long:
                        scores[first : last - long] = model.scores(texts[first : last - long])
                    if long:
                        scores[last - 1] = model.long_score(texts[last - 1])
            del texts
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(scores)], names=[*names, "score"])
            return_memory()

    from pyspark.sql.types import DoubleType, StructType

    schema = StructType([docs.schema[c] for c in names]).add("score", DoubleType())
    return docs.select(*names).mapInArrow(run, schema)


def kept(docs: DataFrame, model: Model | None, least: float) -> DataFrame:
    """The documents that score at least ``least``, with all their columns, also one named ``score``."""
    rows = docs.select(*carried(docs), F.col("text").cast("string").alias("text"))
    return given_back(scored(rows, model).where(F.col("score") >= least), docs)


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are never learned from."""
    return F.crc32(doc_id.cast("string")) % 4 == 2


def trained_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    model = learn(docs, labels.where(~held_out(F.col("doc_id"))))
    rows = scored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), model)
    return rows.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )
