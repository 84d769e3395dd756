"""Substring dedup by recompression.

A round of recompression names runs of equal symbols and then pairs of neighbours, the
first from one half of the alphabet and the second from the other; which half a symbol is
in changes with the round.  A name is a 64-bit hash of the names it stands for, so it is
the same in every task and document without a shared table, and equal word sequences get
equal symbols except at their ends, where a run or pair may reach outside.  How far the
ends can differ follows from the inside alone.  What is left are the sure symbols.

Every window of ``WINDOW`` words is anchored at ``SPAN`` neighbouring sure symbols after
``ROUNDS`` rounds, those whose joint name is least, or after fewer rounds where not as many
are left.  More rounds make rarer symbols, but leave fewer of them to choose from, which
means more anchors.  Spark counts the symbols: a window whose anchor
occurs once in the corpus occurs once.  The other windows are verified by hashes of all
they cover (see ``_repeats``), and words in a repeated window are removed.

Names, contexts and windows must each agree in 64 bits, about 128 for two different
windows to be taken for one.

Defined results: a null or empty text has no words and stays without; texts shorter than a
window lose nothing; rows that repeat doc_id and text count as two documents, so all words
in their windows go; an empty table gives an empty result.  Input columns named like a
result column are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._repeats import DOCUMENT, ROWS, RangeHash, classify, context_rows, covered, keyed, per_key, repeated_starts, with_spans
from ._tables import Written, free_name, groups_of, mixed, texts_of

WINDOW = 35
ROUNDS = 2
SPAN = 3  # neighbouring symbols that make an anchor
PIECE = 200_000  # words worked on at once; a longer text is taken in overlapping pieces

_RESULT = "n_words long, n_removed long, kept string"


class Names(dict):
    """64-bit names of words."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 500_000:
            self.clear()
        self[word] = name = xxhash.xxh64_intdigest(word, 11)
        return name


def names_of(words: list[bytes], names: Names) -> np.ndarray:
    return np.fromiter(map(names.__getitem__, words), np.uint64, len(words))


def _first_half(symbols: np.ndarray, level: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((symbols ^ np.uint64(level * 0x632BE59BD9B4E019 & (1 << 64) - 1)) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(63) == 0


class Level:
    """Symbols after a round, and for each window the range of those that are sure."""

    def __init__(self, symbols, starts, low, high):
        self.symbols, self.starts, self.low, self.high = symbols, starts, low, high

    def next(self, level: int) -> Level:
        s, n = self.symbols, len(self.symbols)
        fresh = np.ones(n, bool)
        fresh[1:] = s[1:] != s[:-1]
        run_of = np.cumsum(fresh) - 1
        run = np.flatnonzero(fresh)
        length = np.diff(np.append(run, n))
        name = np.where(length > 1, mixed(s[run], length.astype(np.uint64)), s[run])
        m = len(name)
        opens = _first_half(name, level)
        pair = np.zeros(m, bool)
        pair[:-1] = opens[:-1] & ~opens[1:]
        head = np.ones(m, bool)
        head[1:] = ~pair[:-1]
        symbol_of = np.append(np.cumsum(head) - 1, head.sum())
        at = np.flatnonzero(head)
        joined = pair[at]
        out = name[at].copy()
        out[joined] = mixed(name[at[joined]], name[at[joined] + 1])
        # The run at either end may go on outside.  Then a symbol of the second half may end a
        # pair that begins outside, and one of the first half may begin one that ends there.
        low = np.append(run_of + 1, m)[self.low]
        low += ~np.append(opens, True)[low]
        high = np.where(self.high > 0, run_of[self.high - 1], 0)
        high -= np.append(opens, False)[high - 1] & (high > 0)
        low = symbol_of[np.minimum(low, m)]
        high = np.where(high > 0, symbol_of[high - 1] + 1, 0)
        return Level(out, self.starts[run[at]], low, high)


def least_in(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Places of the leftmost least value in each range [low, high), none empty."""
    length = high - low
    power = np.frexp(length)[1] - 1  # largest power of two inside
    table, out = np.arange(len(values)), np.empty(len(low), np.int64)
    for k in range(int(power.max(initial=0)) + 1):
        own = power == k
        a, b = table[low[own]], table[high[own] - (1 << k)]
        out[own] = np.where(values[b] < values[a], b, a)
        if len(table) <= 1 << k:
            break
        a, b = table[: -(1 << k)], table[1 << k :]
        table = np.where(values[b] < values[a], b, a)
    return out


def anchors(names: np.ndarray, window: int = WINDOW, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(place, name) of the anchor of every window start, by the window's content alone."""
    n = len(names) - window + 1
    level = Level(names, np.arange(len(names)), np.arange(n), np.arange(n) + window)
    levels = [level]
    for k in range(rounds):
        levels.append(levels[-1].next(k + 1))
    place, name = np.zeros(n, np.int64), np.zeros(n, np.uint64)
    left = np.arange(n)
    for depth in range(rounds, -1, -1):
        level = levels[depth]
        sure = level.low[left] + SPAN <= level.high[left]
        own = left[sure]
        if len(own):
            several = level.symbols
            for k in range(1, SPAN):
                several = mixed(several[:-1], level.symbols[k:])
            best = least_in(several, level.low[own], level.high[own] - SPAN + 1)
            place[own] = level.starts[best]
            name[own] = mixed(several[best], np.full(len(best), depth, np.uint64))
        left = left[~sure]
    return place, name


def _pieces(texts: list[bytes], window: int):
    """(text, first word, place, words) of each part, and the parts' words: short documents together, long ones cut
    so that each window is in one part."""
    for first, end in groups_of([len(t) for t in texts], PIECE * 6):
        parts, words = [], []
        for k in range(first, end):
            own = texts[k].split()
            for at in range(0, max(len(own) - window + 1, 0), PIECE):
                part = own[at : at + PIECE + window - 1]
                if words and len(words) + len(part) > 2 * PIECE:
                    yield parts, words
                    parts, words = [], []
                parts.append((k, at, len(words), len(part)))
                words.extend(part)
        if words:
            yield parts, words


def _anchor_rows(window: int, rounds: int):
    def rows(batches):
        names = Names()
        for batch in batches:
            for parts, words in _pieces(texts_of(batch.column(2)), window):
                sequence = names_of(words, names)
                place, name = anchors(sequence, window, rounds)
                owner = np.repeat(np.arange(len(parts)), [p[3] for p in parts])[: len(place)]
                at = np.arange(len(place))
                inside = at <= np.array([p[2] + p[3] - window for p in parts])[owner]
                found = context_rows(at[inside], place[inside], name[inside], RangeHash(sequence), window)
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


_WINDOWS = "anchor long, hash long, key long, twin long, at int, known boolean"


def _window_rows(window: int):
    def rows(batches):
        names = Names()
        for batch in batches:
            documents = zip(*(batch.column(k).to_pylist() for k in (0, 1)), texts_of(batch.column(2)), batch.column(3).to_pylist())
            for key, twin, text, wanted in documents:
                words = text.split()
                ranges = RangeHash(names_of(words, names))
                first = np.array([x["first"] for x in wanted])
                count = np.array([x["last"] for x in wanted]) - first + 1
                which = np.repeat(np.arange(len(wanted)), count)
                at = first[which] + np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
                columns = [
                    pa.array(np.array([x["anchor"] for x in wanted], np.int64)[which]),
                    pa.array(ranges(at, at + window).view(np.int64)),
                    pa.array(np.full(len(at), key, np.int64)),
                    pa.array(np.full(len(at), twin, np.int64)),
                    pa.array(at.astype(np.int32)),
                    pa.array(np.array([x["known"] for x in wanted], bool)[which]),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["anchor", "hash", *DOCUMENT, "at", "known"])

    return rows


def _cut(window: int):
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        rows = []
        for text, own in zip(texts_of(texts), spans.to_pylist()):
            words = text.split()
            gone = covered(own, window, len(words)) if own else None
            kept = words if gone is None else [words[k] for k in np.flatnonzero(~gone)]
            rows.append((len(words), len(words) - len(kept), b" ".join(kept).decode()))
        columns = list(zip(*rows)) or [(), (), ()]
        kinds = (pa.int64(), pa.int64(), pa.string())
        return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["n_words", "n_removed", "kept"])

    return cut


def removed_spans(documents: DataFrame, tables: Written, text: str, doc_id: str, window: int, rounds: int) -> DataFrame:
    """(key, twin, spans): for each document, first and last starts of repeated windows."""
    own = keyed(documents, doc_id, text)
    rows = tables(own.mapInArrow(_anchor_rows(window, rounds), ROWS), "rows")
    spans, left = classify(rows, tables)
    wanted = left.groupBy(*DOCUMENT).agg(F.collect_set(F.struct("anchor", "first", "last", "known")).alias("wanted"))
    # rows that repeat a document ask for the same windows: once is enough, their spans are known
    texts = own.join(tables(wanted, "wanted"), [*DOCUMENT]).dropDuplicates([*DOCUMENT])
    windows = tables(texts.select(*DOCUMENT, "text", "wanted").mapInArrow(_window_rows(window), _WINDOWS), "windows")
    spans = spans.unionAll(repeated_starts(windows, tables))
    found = tables(per_key(spans), "spans")
    tables.drop("shared", "contexts", "kinds", "counted", "open", "wanted", "windows", "twice")
    return found


def dedup_substrings(
    documents: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW, rounds: int = ROUNDS
) -> DataFrame:
    """The documents with n_words, n_removed and kept (the words left, joined by one space)."""
    tables = Written(documents.sparkSession, "substring-dedup")
    result = free_name(documents, "_cut")
    found = removed_spans(documents, tables, text, doc_id, window, rounds)
    kept = [c for c in documents.columns if c.lower() not in {"n_words", "n_removed", "kept", "spans"}]
    cut = F.arrow_udf(_cut(window), _RESULT)(F.col(f"`{text}`").cast("string"), F.col("spans"))
    rows = with_spans(documents, found, kept, doc_id, text)
    return rows.withColumn(result, cut).select(*(F.col(f"`{c}`") for c in kept), f"{result}.*")
