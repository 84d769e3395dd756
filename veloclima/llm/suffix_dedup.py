"""Suffix-array dedup with run-compressed Burrows-Wheeler indexes.

Every string of ``WINDOW`` bytes that starts twice in the corpus is found; bytes under such
a string are removed.  The corpus is far too large to sort all its suffixes, and nearly all
of it is there once, so two steps come before the index:

1. Each window is anchored at the least hash among its 16-byte substrings, which the window
   alone decides.  Spark counts anchors: a window with a single anchor is there once.
   Windows in equal contexts of one anchor are repeats as a whole (see ``_repeats``).
2. What is open, with one example of each context that is settled, goes by anchor into
   buckets of about ``BUCKET_BYTES``.  Equal windows meet there, since they share an anchor.

A bucket's contexts are sorted by suffix and give a Burrows-Wheeler transform in runs.  The
match with the suffix before and behind is measured at the ends of the runs only; from one
such sample to the next it shrinks by one per byte, so one pass along the text streams the
longest match of every suffix (its matching statistics).  Matches of a window or more are
marked, exactly, byte by byte.

An anchor with more than ``KINDS`` contexts does not go into a bucket; its windows are anchored
again.  Starts at like distances from the anchor, ``WIDTHS`` of them, form a run, and the second
anchor is what all windows of such a run share: nearly a whole window, so it is far rarer than
the first.  Runs are counted like the contexts before them, one row for each, and what stays open goes into
buckets by its second anchor, or, where that is still too common, is anchored again in
shorter runs.  Runs of one window are settled by counting alone, so this ends.

Defined results: a null or empty text has no bytes; matches never cross documents; texts
shorter than a window lose nothing; rows that repeat doc_id and text count as two documents,
so they lose all bytes from ``WINDOW`` on; an empty table gives an empty result.  What is
left can begin or end inside a character, so it is binary.  Input columns named like a
result column are replaced.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._repeats import DOCUMENT, ROWS, RangeHash, classify, context_rows, covered, keyed, per_key, with_spans
from ._tables import Written, free_name, groups_of, mixed, texts_of

WINDOW = 200
SEED = 16  # bytes whose hash can be an anchor
PIECE = 1 << 20  # bytes worked on at once; a longer text is taken in overlapping pieces
BUCKET_BYTES = 400_000
KINDS = 500
WIDTHS = (64, 8, 1)

_PLACE_BITS = 24
_RESULT = "n_bytes long, n_removed long, n_spans long, kept binary"
_LEFT = "anchor long, kinds long, key long, twin long, at int, known boolean, size int, body binary"
_MARKED = "key long, twin long, first int, last int"
_RUNS = f"{ROWS}, known boolean, of int, ahead int"


def byte_names() -> np.ndarray:
    k = np.arange(256, dtype=np.uint64)
    return mixed(k, k)


def anchors(data: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(place, name) of the anchor of every window start of these bytes."""
    n = len(data) - SEED + 1
    words = np.ndarray((len(data) - 7,), "<u8", np.ascontiguousarray(data), strides=(1,))
    name = mixed(words[:n].copy(), words[SEED - 8 : SEED - 8 + n].copy())
    width = window - SEED + 1
    rows = -(-n // width)
    low = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    low[:n] = name >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS) | np.arange(n, dtype=np.uint64)
    grid = low.reshape(rows, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = n - width + 1
    best = np.minimum(behind[:starts], ahead[width - 1 : width - 1 + starts])
    place = (best & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
    return place, name[place]


def _anchor_rows(window: int):
    def pieces(texts):
        for first, end in groups_of([len(t) for t in texts], PIECE):
            parts, bodies, size = [], [], 0
            for k in range(first, end):
                for at in range(0, max(len(texts[k]) - window + 1, 0), PIECE):
                    body = texts[k][at : at + PIECE + window - 1]
                    if bodies and size + len(body) > 2 * PIECE:
                        yield parts, b"".join(bodies)
                        parts, bodies, size = [], [], 0
                    parts.append((k, at, size, len(body)))
                    bodies.append(body)
                    size += len(body)
            if bodies:
                yield parts, b"".join(bodies)

    def rows(batches):
        codes = byte_names()
        for batch in batches:
            for parts, body in pieces(texts_of(batch.column(2))):
                data = np.frombuffer(body, np.uint8)
                place, name = anchors(data, window)
                owner = np.repeat(np.arange(len(parts)), [p[3] for p in parts])[: len(place)]
                at = np.arange(len(place))
                inside = at <= np.array([p[2] + p[3] - window for p in parts])[owner]
                found = context_rows(at[inside], place[inside], name[inside], RangeHash(codes[data]), window)
                part = owner[found[2]]
                shift = np.array([p[1] - p[2] for p in parts])[part]
                document = pa.array(np.array([p[0] for p in parts], np.int64)[part])
                columns = [
                    pa.array(found[0].view(np.int64)),
                    pa.array(found[1].view(np.int64)),
                    *(batch.column(k).take(document) for k in (0, 1)),
                    pa.array((found[2] + shift).astype(np.int32)),
                    pa.array((found[3] + shift).astype(np.int32)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["anchor", "context", *DOCUMENT, "first", "last"])

    return rows


def _left_rows(window: int):
    """Open contexts as bytes."""

    def rows(batches):
        names = [c.split()[0] for c in _LEFT.split(", ")]
        for batch in batches:
            out = []
            documents = zip(*(batch.column(k).to_pylist() for k in (0, 1)), texts_of(batch.column(2)), batch.column(3).to_pylist())
            for key, twin, text, wanted in documents:
                for x in wanted:
                    body = text[x["first"] : x["last"] + window]
                    out.append((x["anchor"], x["kinds"], key, twin, x["first"], x["known"], len(body), body))
                    if len(out) > 20_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _LEFT_TYPES)], names)
                        out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _LEFT_TYPES)], names)

    return rows


_LEFT_TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.int32(), pa.binary())


def anchors_ahead(data: np.ndarray, begin: np.ndarray, window: int) -> np.ndarray:
    """How far the anchor lies behind the start of each of these windows."""
    words = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    out = np.empty(len(begin), np.int64)
    step = np.arange(window - SEED + 1)
    for k in range(0, len(begin), 2000):
        at = begin[k : k + 2000, None] + step
        name = mixed(words[at], words[at + SEED - 8])
        low = name >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS) | step.astype(np.uint64)
        out[k : k + 2000] = low.argmin(1)
    return out


def second_anchors(bodies: list[bytes], anchor: np.ndarray, ahead: np.ndarray | None, window: int, width: int, codes: np.ndarray):
    """(body, anchor, context, first, last, ahead) of the contexts' runs of starts, places within the context.

    Starts whose distances to the anchor fall into one block of ``width`` make a run.  All windows
    of a block share the bytes between its last start and its first window's end, also where
    the context has only some of the block's starts; the second anchor is their hash.
    """
    size = np.array([len(b) for b in bodies], np.int64)
    offset = np.cumsum(size) - size
    data = np.frombuffer(b"".join(bodies), np.uint8)
    ranges = RangeHash(codes[data])
    if ahead is None:
        ahead = anchors_ahead(data, offset, window)
    starts = size - window + 1
    body = np.repeat(np.arange(len(bodies)), starts)
    place = np.arange(len(body)) - np.repeat(np.cumsum(starts) - starts, starts)
    distance = ahead[body] - place
    block = distance // width
    new = np.ones(len(body), bool)
    new[1:] = (body[1:] != body[:-1]) | (block[1:] != block[:-1])
    head = np.flatnonzero(new)
    last = place[np.append(head[1:], len(body)) - 1]
    body, first, block, distance = body[head], place[head], block[head], distance[head]
    begin = (offset + ahead)[body] - block * width
    core = ranges(begin, begin - width + 1 + window)
    name = mixed(mixed(anchor[body].view(np.uint64), block.astype(np.uint64)), core)
    shape = (distance << 32 | (last - first)).astype(np.uint64)
    whole = ranges(offset[body] + first, offset[body] + last + window)
    return body, name, mixed(whole, shape), first, last, distance


def _second_rows(window: int, width: int):
    def rows(batches):
        codes = byte_names()
        names = [c.split()[0] for c in _RUNS.split(", ")]
        for batch in batches:
            bodies = batch.column("body").to_pylist()
            anchor, at = (batch.column(name).to_numpy() for name in ("anchor", "at"))
            known = batch.column("known").to_numpy(zero_copy_only=False)
            ahead = batch.column("ahead").to_numpy().astype(np.int64) if "ahead" in batch.schema.names else None
            for low, high in groups_of([len(b) for b in bodies], PIECE):
                own = None if ahead is None else ahead[low:high]
                body, name, context, first, last, distance = second_anchors(bodies[low:high], anchor[low:high], own, window, width, codes)
                row = body + low
                document = pa.array(row)
                columns = [
                    pa.array(name.view(np.int64)),
                    pa.array(context.view(np.int64)),
                    *(batch.column(n).take(document) for n in DOCUMENT),
                    *(pa.array(c.astype(np.int32)) for c in (first + at[row], last + at[row])),
                    pa.array(known[row]),
                    *(pa.array(c.astype(np.int32)) for c in (at[row], distance)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    return rows


class RunIndex:
    """Suffixes of a few texts in order, as runs of the Burrows-Wheeler transform.

    Each text ends in a mark of its own, smaller than any byte, the marks in text order.
    """

    def __init__(self, texts: list[bytes]):
        lengths = np.array([len(t) for t in texts], np.int64)
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        n = len(self.data)
        ends = np.cumsum(lengths)
        self.begins = ends - lengths
        here = np.arange(n)
        self.rest = np.repeat(ends, lengths) - here  # bytes to the end of the text
        # the first 7 bytes, then how many of them are there
        key = np.zeros(n, np.uint64)
        for k in range(min(7, n)):
            byte = np.zeros(n, np.uint64)
            byte[: n - k] = self.data[k:]
            key |= np.where(self.rest > k, byte, 0).astype(np.uint64) << np.uint64(8 * (7 - k))
        key |= np.minimum(self.rest, 7).astype(np.uint64)
        # a rank is the place of a group's first member, from 1, so only groups of several are sorted on
        rank, width, most = self._refined(here, key, None, n), 7, int(lengths.max(initial=0))
        self.ranks, step = [(width, rank)], 2 if 3 * n.bit_length() <= 64 else 1
        while width < most:
            several = np.bincount(rank, minlength=n + 1)[rank] > 1
            own = np.flatnonzero(several & (self.rest >= width))
            if not len(own):
                break
            key, bits = rank[own].astype(np.uint64), np.uint64(n.bit_length())
            for k in range(1, step + 1):
                far = k * width
                later = np.where(self.rest[own] > far, rank[np.minimum(own + far, n - 1)], 0)
                key = key << bits | later.astype(np.uint64)
            rank = self._refined(own, key, rank, n)
            width *= step + 1
            self.ranks.append((width, rank))
        self.suffixes = self._order(rank, n)  # ends by text order
        before = np.full(n, -1, np.int64)
        before[1:] = self.data[:-1]
        before[self.begins[lengths > 0]] = -1 - np.arange((lengths > 0).sum())  # each text's start, a run of its own
        self.transform = before[self.suffixes]
        self.heads = np.ones(n, bool)
        self.heads[1:] = self.transform[1:] != self.transform[:-1]

    @staticmethod
    def _refined(own: np.ndarray, key: np.ndarray, rank: np.ndarray | None, n: int) -> np.ndarray:
        """Ranks after the members ``own``, of whole groups, are told apart by ``key``."""
        order = np.argsort(key)
        key, place = key[order], np.arange(len(own))
        new = np.ones(len(own), bool)
        new[1:] = key[1:] != key[:-1]
        start = np.maximum.accumulate(np.where(new, place, 0)) if len(own) else place
        if rank is None:
            out = np.empty(n, np.int64)
            out[own[order]] = start + 1
            return out
        old = rank[own[order]]
        first = np.ones(len(own), bool)
        first[1:] = old[1:] != old[:-1]
        out = rank.copy()
        out[own[order]] = old + start - np.maximum.accumulate(np.where(first, place, 0))
        return out

    @staticmethod
    def _order(rank: np.ndarray, n: int) -> np.ndarray:
        out, tied = np.empty(n, np.int64), np.bincount(rank, minlength=n + 1)[rank] > 1
        single = np.flatnonzero(~tied)
        out[rank[single] - 1] = single
        several = np.flatnonzero(tied)
        several = several[np.argsort(rank[several], kind="stable")]
        own, place = rank[several], np.arange(len(several))
        first = np.ones(len(several), bool)
        first[1:] = own[1:] != own[:-1]
        start = np.maximum.accumulate(np.where(first, place, 0)) if len(several) else place
        out[own - 1 + place - start] = several
        return out

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Bytes that the suffixes at a and b share."""
        most = np.minimum(self.rest[a], self.rest[b])
        length = np.zeros(len(a), np.int64)
        for width, rank in [x for x in reversed(self.ranks) for _ in range(2)]:
            open_ = length + width <= most
            x, y = a[open_] + length[open_], b[open_] + length[open_]
            length[open_] += np.where(rank[x] == rank[y], width, 0)
        for _ in range(7):
            open_ = length < most
            x, y = a[open_] + length[open_], b[open_] + length[open_]
            same = self.data[x] == self.data[y]
            at = np.flatnonzero(open_)
            most[at[~same]] = length[at[~same]]
            length[at[same]] += 1
        return length

    def _stream(self, sampled: np.ndarray, values: np.ndarray) -> np.ndarray:
        at_sample = np.zeros(len(self.data), bool)
        at_sample[sampled] = True
        value = np.zeros(len(self.data), np.int64)
        value[sampled] = values
        here = np.arange(len(self.data))
        last = np.maximum.accumulate(np.where(at_sample, here, 0))
        return value[last] - (here - last)

    def _at_least(self, a: np.ndarray, b: np.ndarray, least: int) -> np.ndarray:
        """Common bytes where there are ``least``; where there are fewer, maybe 0."""
        known = [rank for width, rank in self.ranks if width <= least]
        if not known:
            return self.common(a, b)
        out = np.zeros(len(a), np.int64)
        some = np.flatnonzero((known[-1][a] == known[-1][b]) & (np.minimum(self.rest[a], self.rest[b]) >= least))
        out[some] = self.common(a[some], b[some])
        return out

    def matching_statistics(self, least: int = 0) -> np.ndarray:
        """For each byte, the longest string from it that starts anywhere else too.

        Strings shorter than ``least`` may be told shorter than they are.
        """
        if not len(self.data):
            return np.zeros(0, np.int64)
        sa = self.suffixes
        head = np.flatnonzero(self.heads)
        first = self._at_least(sa[np.maximum(head - 1, 0)], sa[head], least)
        first[head == 0] = 0
        tail = np.append(head[1:] - 1, len(sa) - 1)
        last = self._at_least(sa[tail], sa[np.minimum(tail + 1, len(sa) - 1)], least)
        last[tail == len(sa) - 1] = 0
        return np.maximum(self._stream(sa[head], first), self._stream(sa[tail], last))


def _mark(window: int):
    def mark(bucket: pa.Table) -> pa.Table:
        bodies = bucket.column("body").to_pylist()
        index = RunIndex(bodies)
        long = index.matching_statistics(window) >= window
        ats = bucket.column("at").to_pylist()
        known = bucket.column("known").to_pylist()
        rows: tuple[list, list, list] = ([], [], [])
        for k, begin in enumerate(index.begins.tolist()):
            if known[k]:
                continue
            own = long[begin : begin + len(bodies[k])].astype(np.int8)
            edge = np.diff(np.concatenate([[0], own, [0]]))
            for s, e in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
                rows[0].append(k)
                rows[1].append(ats[k] + s)
                rows[2].append(ats[k] + e - 1)
        document = pa.array(rows[0], pa.int64())
        columns = [*(bucket.column(name).take(document) for name in DOCUMENT), pa.array(rows[1], pa.int32()), pa.array(rows[2], pa.int32())]
        return pa.table(columns, names=[*DOCUMENT, "first", "last"])

    return mark


def _cut(window: int):
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        rows = []
        for text, own in zip(texts_of(texts), spans.to_pylist()):
            if not own:
                rows.append((len(text), 0, 0, text))
                continue
            gone = covered(own, window, len(text))
            runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
            kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
            rows.append((len(text), len(text) - len(kept), runs, kept))
        columns = list(zip(*rows)) or [()] * 4
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        names = ["n_bytes", "n_removed", "n_spans", "kept"]
        return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    return cut


def _anchored_again(hot: DataFrame, tables: Written, window: int, kinds: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """(spans, open contexts for the index) of contexts whose anchors are too common."""
    spans, ready = [], []
    for width in WIDTHS:
        if hot.isEmpty():
            break
        level = f"-{width}"
        rows = tables(hot.mapInArrow(_second_rows(window, width), _RUNS), "rows" + level)
        repeats, left = classify(rows, tables, level, ("known", "of", "ahead"))
        spans.append(repeats)
        if width == 1:  # what two such runs share is all they are
            break
        whole = hot.select(*DOCUMENT, F.col("at").alias("of"), "body")
        size = F.col("last") - F.col("first") + window
        parts = left.join(whole, [*DOCUMENT, "of"]).select(
            "anchor", "kinds", *DOCUMENT, F.col("first").alias("at"), "known", "ahead", size.alias("size"),
            F.substring("body", F.col("first") - F.col("of") + 1, size).alias("body"),
        )
        parts = tables(parts, "parts" + level)
        ready.append(parts.where(F.col("kinds") <= kinds).drop("ahead"))
        hot = parts.where(F.col("kinds") > kinds)
    return spans, ready


def removed_spans(
    documents: DataFrame, tables: Written, text: str, doc_id: str, window: int, kinds: int, bucket_bytes: int
) -> DataFrame:
    """(key, twin, spans): for each document, first and last starts of repeated windows."""
    own = keyed(documents, doc_id, text)
    rows = tables(own.mapInArrow(_anchor_rows(window), ROWS), "rows")
    spans, left = classify(rows, tables)
    wanted = left.groupBy(*DOCUMENT).agg(F.collect_set(F.struct("anchor", "first", "last", "known", "kinds")).alias("wanted"))
    texts = own.join(tables(wanted, "wanted"), [*DOCUMENT]).dropDuplicates([*DOCUMENT])
    found = tables(texts.select(*DOCUMENT, "text", "wanted").mapInArrow(_left_rows(window), _LEFT), "left")
    more, ready = _anchored_again(found.where(F.col("kinds") > kinds), tables, window, kinds)
    bodies = reduce(DataFrame.unionByName, [found.where(F.col("kinds") <= kinds), *ready])
    size = bodies.agg(F.sum(F.col("size").cast("long"))).first()[0] or 0
    bucket = F.pmod(F.xxhash64("anchor"), F.lit(max(1, -(-size // bucket_bytes)))).alias("bucket")
    marked = bodies.select(*DOCUMENT, "at", "known", "body", bucket).groupBy("bucket").applyInArrow(_mark(window), _MARKED)
    spans = reduce(DataFrame.unionAll, [spans, *more, tables(marked, "marked")])
    out = tables(per_key(spans), "spans")
    tables.drop(*(name for name in list(tables.paths) if name != "spans"))
    return out


def dedup_bytes(
    documents: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    window: int = WINDOW,
    kinds: int = KINDS,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """The documents with n_bytes, n_removed, n_spans and kept (the bytes left)."""
    tables = Written(documents.sparkSession, "suffix-dedup")
    result = free_name(documents, "_cut")
    found = removed_spans(documents, tables, text, doc_id, window, kinds, bucket_bytes)
    own = {"n_bytes", "n_removed", "n_spans", "kept", "spans"}
    kept = [c for c in documents.columns if c.lower() not in own]
    cut = F.arrow_udf(_cut(window), _RESULT)(F.col(f"`{text}`").cast("string"), F.col("spans"))
    rows = with_spans(documents, found, kept, doc_id, text)
    return rows.withColumn(result, cut).select(*(F.col(f"`{c}`") for c in kept), f"{result}.*")
