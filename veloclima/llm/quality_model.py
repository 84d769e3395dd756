"""Quality classifier by compression.

Two zstandard dictionaries are built, one from good and one from bad labelled text.  A text
is cut into pieces of ``PIECE`` bytes, each is compressed with either dictionary, and the
normalised difference of the summed sizes says which of the two it resembles.  Because every
piece starts from the dictionary, all of a long text counts.  A logistic curve over the
difference and the logarithm of the compression ratio, their squares and their product, fitted to other labelled documents than
the dictionaries, turns this into the chance of label 1.

Labels are learned from a bounded sample: at most ``SAMPLE`` documents of each label, the
least by a hash, half for the dictionaries (one piece each) and half for the curve, weighted
to the shares of the labels.  An id counts once, however many rows of either table it has, and with
one text, the first by its hashes.  Rows held out by ``is_held_out`` are never in it.  Nothing but the
text enters a score.

Defined results: a null or empty text has difference 0 and ratio 1 and gets the score of
that; labels that are null or neither 0 nor 1, and ids that are null or have both labels, are ignored; with one label only the score is
that label's share, without labels 0.5; repeated rows score alike; an empty table gives an
empty result.  Input columns named like a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._tables import bounded_batches, row_key, texts_of, twin_key

SAMPLE = 3000
PIECE = 1024
DICTIONARY_BYTES = 100_000
LEVEL = 3
THRESHOLD = 0.3


def is_held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def build_dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary, or the samples themselves where there is too little to train on."""
    import zstandard

    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(1024, sum(map(len, samples)) // 10)), samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES] or b" " * 8


def _compressors(dictionaries: tuple[bytes, bytes]) -> list[Callable[[bytes], bytes]]:
    import zstandard

    out = []
    for content in dictionaries:
        held = zstandard.ZstdCompressionDict(content)
        held.precompute_compress(level=LEVEL)
        options = dict(write_checksum=False, write_content_size=False, write_dict_id=False)
        out.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=held, **options).compress)
    return out


def sizes_of(text: bytes, bad: Callable, good: Callable) -> tuple[float, float]:
    """(normalised difference, compression ratio) of a text."""
    if not text:
        return 0.0, 1.0
    pieces = [text[k : k + PIECE] for k in range(0, len(text), PIECE)]
    a, b = sum(len(bad(p)) for p in pieces), sum(len(good(p)) for p in pieces)
    return (a - b) / (a + b), (a + b) / (2 * len(text))


def _terms(difference: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    d, r = 10 * difference, np.log(ratio)
    return np.column_stack([np.ones(len(d)), d, d * d, r, r * r, d * r])


def fit_curve(difference: np.ndarray, ratio: np.ndarray, label: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Coefficients of a weighted logistic regression, by Newton steps."""
    x = _terms(difference, ratio)
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        slope = x.T @ (weight * (label - p)) - ridge * w
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w = w + step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return w


class Model:
    """Two dictionaries and a curve; ``share`` alone where labels are of one kind."""

    def __init__(self, share: float, dictionaries: tuple[bytes, bytes] | None = None, curve: np.ndarray | None = None):
        self.share, self.dictionaries, self.curve = share, dictionaries, curve

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if self.dictionaries is None:
            return np.full(len(texts), self.share)
        bad, good = _compressors(self.dictionaries)
        measured = np.array([sizes_of(t, bad, good) for t in texts]).reshape(-1, 2)
        return 1 / (1 + np.exp(-np.clip(_terms(measured[:, 0], measured[:, 1]) @ self.curve, -40, 40)))


def _measure(dictionaries: tuple[bytes, bytes]):
    def measure(texts: pa.Array) -> pa.Array:
        bad, good = _compressors(dictionaries)
        rows = [sizes_of(t, bad, good) for t in texts_of(texts)]
        columns = list(zip(*rows)) or [(), ()]
        return pa.StructArray.from_arrays([pa.array(c, pa.float64()) for c in columns], ["difference", "ratio"])

    return measure


def labelled(labels: DataFrame, doc_id: str, label: str) -> DataFrame:
    """(id, label, order) of each document that labels may be learned from; ids with both labels are left out."""
    seen = labels.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{label}`").cast("int").alias("label"))
    seen = seen.where(F.col("label").isin(0, 1) & F.col("id").isNotNull() & ~is_held_out(F.col("id")))
    each = seen.groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
    return each.where("label = other").select("id", "label", F.xxhash64(F.lit("sample"), F.col("id")).alias("order"))


def sampled_rows(documents: DataFrame, labels: DataFrame, text: str, doc_id: str, label: str, sample: int):
    """(counts of the labels, rows): at most ``sample`` rows (id, label, order, text) of each label."""
    seen = labelled(labels, doc_id, label)
    counts = {r.label: r.n for r in seen.groupBy("label").agg(F.count("*").alias("n")).collect()}
    chosen = [seen.where(F.col("label") == k).orderBy("order", "id").limit(sample) for k in (0, 1)]
    # at most twice ``sample`` rows of three numbers
    chosen = F.broadcast(chosen[0].unionAll(chosen[1]))
    known = documents.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    known = known.where("text <> ''").join(chosen, "id")
    # a document that is there several times speaks once, with the text that sorts first by its hashes
    least = F.min(F.struct(row_key("text").alias("a"), twin_key("text").alias("b"), "text")).alias("least")
    return counts, known.groupBy("id", "label", "order").agg(least).select("id", "label", "order", F.col("least.text").alias("text"))


def fit(documents: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality", sample: int = SAMPLE) -> Model:
    counts, known = sampled_rows(documents, labels, text, doc_id, label, sample)
    total = sum(counts.values())
    if len(counts) < 2:
        return Model(counts.get(1, 0) / total if total else 0.5)
    known = known.withColumn("half", F.pmod(F.xxhash64(F.lit("half"), F.col("id")), F.lit(2)))
    at = F.pmod("order", F.greatest(F.lit(1), F.length("text") - PIECE)) + 1
    pieces = known.where("half = 0").select("label", "id", F.col("text").substr(at.cast("int"), F.lit(PIECE)).alias("piece")).collect()
    samples = {k: [r.piece.encode() for r in sorted(pieces, key=lambda r: (r.id, r.piece)) if r.label == k] for k in (0, 1)}
    if not samples[0] or not samples[1]:
        return Model(counts[1] / total)
    dictionaries = build_dictionary(samples[0]), build_dictionary(samples[1])
    measure = F.arrow_udf(_measure(dictionaries), "difference double, ratio double")
    rows = known.where("half = 1").select("label", measure("text").alias("m")).select("label", "m.*").collect()
    rows = sorted((r.label, r.difference, r.ratio) for r in rows)
    if len({r[0] for r in rows}) < 2:
        return Model(counts[1] / total)
    marks, difference, ratio = (np.array(c, float) for c in zip(*rows))
    weight = np.where(marks == 1, counts[1] / total / max(1, (marks == 1).sum()), counts[0] / total / max(1, (marks == 0).sum()))
    return Model(counts[1] / total, dictionaries, fit_curve(difference, ratio, marks, weight * len(marks)))


def score(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents with score and predicted.  The model is two dictionaries and six numbers."""
    curve = None if model.curve is None else model.curve.tolist()
    bounded_batches(documents.sparkSession)
    held = documents.sparkSession.sparkContext.broadcast((model.share, model.dictionaries, curve))

    def scores(texts: pa.Array) -> pa.Array:
        return pa.array(Model(*held.value).scores(texts_of(texts)), pa.float64())

    rows = documents.withColumn("score", F.arrow_udf(scores, "double")(F.col(f"`{text}`").cast("string")))
    return rows.withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))
