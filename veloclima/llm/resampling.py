"""Target-distribution importance resampling over hashed n-grams.

The features of a text are its runs of 1 to ``ORDERS`` normalised words.  A feature falls
into one of ``BUCKETS`` buckets.  What a bucket holds in the target against what it holds in
the raw documents is its gain; a document's weight is the mean gain of its features, and
with Gumbel noise drawn from its id the weights become scores whose top is a sample without
replacement, tilted towards the target.

Normalised: A-Z in lower case, words are runs of ASCII letters, digits and anything beyond
ASCII.

Within a batch, n-grams are interned in an open-addressed table of NumPy arrays: keys are
xxhash64 of the n-gram's bytes, probing is linear, and an n-gram shares a slot only after
its bytes were compared with those of the slot's owner.  A slot stores its bucket, found
once, and its count.  The first pass over the texts adds the counts of slots to their
buckets; the second interns again and gathers each occurrence's gain by its slot.

Counts of buckets are partial per task; Spark adds them, and the driver gets ``BUCKETS``
numbers of each table.  Ranks come from a range partitioning of the scores: a row's rank is
its place in its partition and the sizes of those before, so nothing is sorted in one task.
Texts take no part in that unless they are asked for.

Defined results: a null or empty text has no words, no features and weight 0; without any
target or any document the counts are 0; rows that repeat a doc_id get the same noise, and
ties are settled by smaller doc_id, null last, then by the row's number; a null doc_id
counts as the id "".  An empty table gives an empty result.  Input columns named like a
result column are replaced.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._tables import Written, bounded_batches, free_name, groups_of, texts_of

ORDERS = 2
BUCKETS = 10_000
GROUP_BYTES = 1 << 20  # texts worked on at once
SLICE = 1 << 19  # occurrences interned at once

_WORD = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(128, 256))
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b in _WORD else 32 for b in range(256))
RESULT = ("n_words", "n_features", "weight", "score", "rank")

# --- fixed values: the constants of xxHash64 ---------------------------------------
_P1 = np.uint64(11400714785074694791)
_P2 = np.uint64(14029467366897019727)
_P3 = np.uint64(1609587929392839161)
_P4 = np.uint64(9650029242287828579)
_P5 = np.uint64(2870177450012600261)
# -----------------------------------------------------------------------------------


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


class Grams:
    """N-grams of normalised texts as ranges of one buffer, words joined by one space."""

    def __init__(self, texts: list[bytes], orders: int):
        plain = np.frombuffer(b" ".join([*texts, b""]).translate(_TABLE) + b" ", np.uint8)
        edge = np.flatnonzero(np.diff(plain != 32, prepend=False))
        start, end = edge[::2], edge[1::2]
        ends_of_texts = np.cumsum([len(t) + 1 for t in texts]) if texts else np.empty(0, np.int64)
        word_of = np.searchsorted(ends_of_texts, start, side="right")
        keep = plain != 32
        keep[end] = True
        self.data = np.concatenate([plain[keep], np.zeros(8, np.uint8)])
        length = end - start
        first = np.cumsum(length + 1) - length - 1
        self.n_words = np.bincount(word_of, minlength=len(texts))
        starts, lengths, texts_of_grams = [], [], []
        for k in range(orders):
            n = max(0, len(first) - k)
            inside = word_of[:n] == word_of[k:]
            starts.append(first[:n][inside])
            lengths.append((first[k:] + length[k:] - first[:n])[inside])
            texts_of_grams.append(word_of[:n][inside])
        self.start, self.length = np.concatenate(starts), np.concatenate(lengths)
        self.text = np.concatenate(texts_of_grams)
        self.n_features = np.bincount(self.text, minlength=len(texts))

    def slices(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for at in range(0, len(self.start), SLICE):
            yield self.start[at : at + SLICE], self.length[at : at + SLICE], self.text[at : at + SLICE]


class Interned:
    """An open-addressed table of ranges of bytes; ``slot`` is each occurrence's."""

    def __init__(self, data: np.ndarray, start: np.ndarray, length: np.ndarray, buckets: int):
        self.data, self.start, self.length = data, start, length
        self.lanes = np.lib.stride_tricks.sliding_window_view(data, 8)
        self.keys = self.hashes()
        size = 1 << max(4, (2 * len(start) - 1).bit_length())
        owner = np.full(size, -1, np.int64)
        at = (self.keys & np.uint64(size - 1)).astype(np.int64)
        self.slot = np.empty(len(start), np.int64)
        waiting = np.arange(len(start))
        while len(waiting):
            place = at[waiting]
            free = owner[place] < 0
            owner[place[free]] = waiting[free]
            held = owner[place]
            same = self.equal(held, waiting)
            self.slot[waiting[same]] = place[same]
            waiting = waiting[~same]
            at[waiting] = (at[waiting] + 1) & (size - 1)
        taken = np.flatnonzero(owner >= 0)
        owners = owner[taken]
        whole = memoryview(data)
        codes = [zlib.crc32(whole[s : s + n]) for s, n in zip(start[owners].tolist(), length[owners].tolist())]
        self.bucket = np.zeros(size, np.int64)
        self.bucket[taken] = np.array(codes, np.int64) % buckets
        self.count = np.bincount(self.slot, minlength=size)

    def lane(self, start: np.ndarray) -> np.ndarray:
        return self.lanes[start].view("<u8").ravel()

    def hashes(self) -> np.ndarray:
        """xxhash64 of each range: short ranges together, lane by lane, others by the library."""
        import xxhash

        with np.errstate(over="ignore"):
            h = _P5 + self.length.astype(np.uint64)
            for k in range(0, 24, 8):
                own = np.flatnonzero(self.length >= k + 8)
                if not len(own):
                    break
                x = _turned(self.lane(self.start[own] + k) * _P2, 31) * _P1
                h[own] = _turned(h[own] ^ x, 27) * _P1 + _P4
            at = self.length & ~7
            own = np.flatnonzero(self.length & 4)
            x = (self.lane(self.start[own] + at[own]) & np.uint64(0xFFFFFFFF)) * _P1
            h[own] = _turned(h[own] ^ x, 23) * _P2 + _P3
            at = self.length & ~3
            for k in range(3):
                own = np.flatnonzero((self.length & 3) > k)
                x = self.data[self.start[own] + at[own] + k].astype(np.uint64) * _P5
                h[own] = _turned(h[own] ^ x, 11) * _P1
            for shift, factor in ((33, _P2), (29, _P3)):
                h = (h ^ (h >> np.uint64(shift))) * factor
            h ^= h >> np.uint64(32)
        whole = memoryview(self.data)
        for k in np.flatnonzero(self.length >= 32).tolist():
            h[k] = xxhash.xxh64_intdigest(whole[self.start[k] : self.start[k] + self.length[k]])
        return h

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the ranges at a and b hold the same bytes."""
        same = (self.keys[a] == self.keys[b]) & (self.length[a] == self.length[b])
        open_ = np.flatnonzero(same & (a != b))
        a, b, length = a[open_], b[open_], self.length[b[open_]]
        at = 0
        while len(open_):
            left = np.minimum(length - at, 8).astype(np.uint64)
            differ = self.lane(self.start[a] + at) ^ self.lane(self.start[b] + at)
            differ <<= (np.uint64(8) - left) * np.uint64(8)
            same[open_[differ != 0]] = False
            at += 8
            on = (differ == 0) & (length > at)
            open_, a, b, length = open_[on], a[on], b[on], length[on]
            if at >= 64:
                # few are this long: whole ranges at once
                whole = memoryview(self.data)
                ranges = lambda x: [whole[s : s + n] for s, n in zip(self.start[x].tolist(), length.tolist())]
                same[open_] = [p == q for p, q in zip(ranges(a), ranges(b))]
                break
        return same


def _grams(texts: list[bytes], orders: int) -> Iterator[tuple[int, int, Grams]]:
    for first, end in groups_of([len(t) for t in texts], GROUP_BYTES):
        yield first, end, Grams(texts[first:end], orders)


def _bucket_counts(orders: int, buckets: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, grams in _grams(texts_of(batch.column(0)), orders):
                for start, length, _ in grams.slices():
                    table = Interned(grams.data, start, length, buckets)
                    np.add.at(total, table.bucket, table.count)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    return rows


def bucket_counts(documents: DataFrame, text: str = "text", orders: int = ORDERS, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features of all texts by bucket."""
    bounded_batches(documents.sparkSession)
    texts = documents.select(F.col(f"`{text}`").cast("string").alias("text"))
    parts = texts.mapInArrow(_bucket_counts(orders, buckets), "bucket long, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains_of(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of each bucket, in thousandths of a natural logarithm, rounded down."""
    buckets = len(raw)
    above, below = float(raw.sum() + buckets), float(target.sum() + buckets)
    ratio = lambda t, s: (t + 1.0) * above / ((s + 1.0) * below)
    return np.array([math.floor(1000 * math.log(ratio(t, s))) for s, t in zip(raw.tolist(), target.tolist())], np.int64)


def fit(
    documents: DataFrame, target: DataFrame, text: str = "text", orders: int = ORDERS, buckets: int = BUCKETS
) -> np.ndarray:
    """The gains, from counts over all documents and all target texts."""
    counts = []
    for table in (documents, target):
        own = np.zeros(buckets, np.int64)
        for row in bucket_counts(table, text, orders, buckets).collect():  # ``buckets`` rows at most
            own[row.bucket] = row.n
        counts.append(own)
    return gains_of(*counts)


def _weights(gains, orders: int):
    def weights(column: pa.Array) -> pa.Array:
        parts = [(np.empty(0, np.int64),) * 3]
        for first, end, grams in _grams(texts_of(column), orders):
            total = np.zeros(end - first, np.int64)
            for start, length, text in grams.slices():
                table = Interned(grams.data, start, length, len(gains.value))
                gain = np.array(gains.value, np.int64)[table.bucket]
                np.add.at(total, text, gain[table.slot])
            parts.append((grams.n_words, grams.n_features, total // np.maximum(1, grams.n_features)))
        columns = [pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*parts)]
        return pa.StructArray.from_arrays(columns, ["n_words", "n_features", "weight"])

    return weights


def score(
    documents: DataFrame, gains: np.ndarray, seed: int = 7, text: str = "text", doc_id: str = "doc_id", orders: int = ORDERS
) -> DataFrame:
    """The documents with n_words, n_features, weight and score: one narrow pass."""
    spark = documents.sparkSession
    bounded_batches(spark)
    held = spark.sparkContext.broadcast(gains.tolist())
    found, noisy = free_name(documents, "_found"), free_name(documents, "_noise")
    kind = "n_words long, n_features long, weight long"
    kept = [F.col(f"`{c}`") for c in documents.columns if c.lower() not in RESULT]
    weights = F.arrow_udf(_weights(held, orders), kind)(F.col(f"`{text}`").cast("string")).alias(found)
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    rows = documents.select(*kept, weights, noise.alias(noisy))
    return rows.select(*kept, f"{found}.*", (F.col(f"{found}.weight") + F.col(noisy)).alias("score"))


def draw(scored: DataFrame, tables: Written, percent: int = 25, least_words: int = 20, doc_id: str = "doc_id") -> DataFrame:
    """The rows with rank: 1, 2, 3... for the ``percent`` of eligible rows with the highest scores."""
    row, part, place, before = (free_name(scored, f"_{name}") for name in ("row", "part", "place", "before"))
    rows = tables(scored.withColumn(row, F.monotonically_increasing_id()), "scored")
    eligible = F.col("n_words") >= least_words
    order = [F.col("score").desc(), F.col(f"`{doc_id}`").asc_nulls_last(), F.col(row)]
    tasks = max(1, int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = rows.where(eligible).repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    # the number is the partition's in the upper and the row's place in the lower 33 bits
    ranged = tables(ranged.withColumn(place, F.monotonically_increasing_id()), "ranged")
    ranged = ranged.withColumn(part, F.shiftright(place, 33)).withColumn(place, F.col(place).bitwiseAND((1 << 33) - 1))
    total, offsets = 0, []
    for own, n in sorted(ranged.groupBy(part).count().collect()):  # one row per task
        offsets.append((own, total))
        total += n
    offsets = scored.sparkSession.createDataFrame(offsets, f"{part} long, {before} long")
    rank = F.col(before) + F.col(place) + 1
    drawn = total * percent // 100
    ranked = ranged.join(F.broadcast(offsets), part).withColumn("rank", F.when(rank <= drawn, rank))
    others = rows.where(~eligible | F.col("n_words").isNull()).withColumn("rank", F.lit(None).cast("long"))
    columns = [F.col(f"`{c}`") for c in [*scored.columns, "rank"]]
    return ranked.select(*columns).unionAll(others.select(*columns))


def resample(
    documents: DataFrame,
    target: DataFrame,
    percent: int = 25,
    least_words: int = 20,
    seed: int = 7,
    text: str = "text",
    doc_id: str = "doc_id",
    orders: int = ORDERS,
    buckets: int = BUCKETS,
    keep_text: bool = False,
) -> DataFrame:
    """Every document with n_words, n_features, weight, score and rank, null where it is not drawn.

    The text is left out unless asked for: with it, texts move once.
    """
    tables = Written(documents.sparkSession, "resampling")
    gains = fit(documents, target, text, orders, buckets)
    scored = score(documents, gains, seed, text, doc_id, orders)
    return draw(scored if keep_text else scored.drop(text), tables, percent, least_words, doc_id)
