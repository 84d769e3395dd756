"""Which windows of fixed length occur twice: the steps that two operators share.

A window is named after one anchor inside it, chosen from the window's own content, so
equal windows have equal anchors at equal places.  Neighbouring windows with the same
anchor make one row ``(anchor, context, key, twin, first, last)``: the anchor's name, a hash of
everything these windows cover, the document (two hashes of 64 bits), and the first and last
start.

Most anchors occur once, and their windows with them.  Of the rest, rows with equal contexts
are repeats as a whole.  What stays open are contexts that occur once beside others of the
same anchor; the operators settle these, window by window.

Counts are partial aggregates that go back to the rows by joins of written tables, which
Spark splits where an anchor is hot.  No group is gathered.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._tables import Written, free_name, mixed, row_key, twin_key

ROWS = "anchor long, context long, key long, twin long, first int, last int"
DOCUMENT = ("key", "twin")
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


class RangeHash:
    """Hashes of ranges of a sequence of 64-bit names, equal for equal ranges."""

    def __init__(self, names: np.ndarray):
        n = len(names)
        with np.errstate(over="ignore"):
            powers = np.multiply.accumulate(np.full(n + 1, _BASE, np.uint64)) if n else np.ones(1, np.uint64)
            self.inverse = np.multiply.accumulate(np.full(n + 1, _INVERSE, np.uint64))
            self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(names * powers[:n], dtype=np.uint64)])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self.sums[end] - self.sums[start]) * self.inverse[start]


def keyed(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(key, twin, text) of the documents."""
    names = f"`{doc_id}`", f"`{text}`"
    return documents.select(row_key(*names).alias("key"), twin_key(*names).alias("twin"), F.col(f"`{text}`").cast("string").alias("text"))


def with_spans(documents: DataFrame, spans: DataFrame, kept: list[str], doc_id: str, text: str) -> DataFrame:
    """The kept columns of the documents, and their spans."""
    names = f"`{doc_id}`", f"`{text}`"
    here = [free_name(documents, "_key"), free_name(documents, "_twin")]
    rows = documents.select(*(F.col(f"`{c}`") for c in kept), row_key(*names).alias(here[0]), twin_key(*names).alias(here[1]))
    return rows.join(spans.withColumnsRenamed(dict(zip(DOCUMENT, here))).hint("merge"), here, "left")


def context_rows(starts: np.ndarray, anchor_at: np.ndarray, anchor: np.ndarray, ranges: RangeHash, window: int):
    """(anchor, context, first, last) of runs of consecutive window starts with one anchor place."""
    new = np.ones(len(starts), bool)
    new[1:] = (anchor_at[1:] != anchor_at[:-1]) | (starts[1:] != starts[:-1] + 1) | (anchor[1:] != anchor[:-1])
    head = np.flatnonzero(new)
    first = starts[head]
    last = starts[np.append(head[1:], len(starts)) - 1] if len(head) else first
    place = ((anchor_at[head] - first) << 32 | (last - first)).astype(np.uint64)
    return anchor[head], mixed(ranges(first, last + window), place), first, last


def classify(rows: DataFrame, tables: Written, level: str = "", carried: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """``(spans, open)`` of a written table ``rows``.

    spans: (key, twin, first, last) of windows that are repeats.  open: (anchor, key, twin, first, last,
    kinds, known) of contexts to be settled; ``kinds`` contexts share the anchor, and
    ``known`` contexts stand for those that are in spans already.  Further columns are ``carried`` along to
    the open rows; rows may come with ``known``.  ``level`` tells repeated calls' tables apart.
    """
    several = rows.groupBy("anchor").agg(
        F.count("*").alias("n"), F.min("context").alias("low"), F.max("context").alias("high")
    )
    several = tables(several.where("n > 1").select("anchor", (F.col("low") == F.col("high")).alias("alike")), "several" + level)
    shared = tables(rows.join(several, "anchor"), "shared" + level)
    tables.drop("rows" + level, "several" + level)
    unlike = shared.where("not alike")
    contexts = unlike.groupBy("anchor", "context").agg(F.count("*").alias("n"), F.min(F.struct(*DOCUMENT, "first")).alias("one"))
    contexts = tables(contexts, "contexts" + level)
    kinds = tables(contexts.groupBy("anchor").agg(F.count("*").alias("kinds")), "kinds" + level)
    counted = unlike.select("anchor", "context", *DOCUMENT, "first", "last", *carried).join(contexts, ["anchor", "context"])
    counted = tables(counted.select("anchor", *DOCUMENT, "first", "last", "n", "one", *carried), "counted" + level)
    spans = shared.where("alike").select(*DOCUMENT, "first", "last").unionAll(counted.where("n > 1").select(*DOCUMENT, "first", "last"))
    left = counted.where((F.col("n") == 1) | (F.struct(*DOCUMENT, "first") == F.col("one")))
    known = (F.col("n") > 1) | F.col("known") if "known" in carried else F.col("n") > 1
    others = [c for c in carried if c != "known"]
    left = left.join(kinds, "anchor").select("anchor", *DOCUMENT, "first", "last", "kinds", known.alias("known"), *others)
    return spans, tables(left, "open" + level)


def repeated_starts(windows: DataFrame, tables: Written) -> DataFrame:
    """(anchor, hash, key, twin, at, known), a written table -> (key, twin, first, last) of starts
    whose (anchor, hash) occurs twice."""
    twice = windows.groupBy("anchor", "hash").agg(F.count("*").alias("n")).where("n > 1").select("anchor", "hash")
    twice = tables(twice, "twice")
    found = windows.where("not known").join(twice, ["anchor", "hash"], "left_semi")
    return found.select(*DOCUMENT, F.col("at").alias("first"), F.col("at").alias("last"))


def per_key(spans: DataFrame) -> DataFrame:
    """(key, twin, spans): all of one document's, as many as it has windows at most, however many rows repeat it."""
    return spans.groupBy(*DOCUMENT).agg(F.collect_set(F.struct("first", "last")).alias("spans"))


def covered(spans: list[dict] | None, window: int, length: int) -> np.ndarray:
    """Mask of the units that lie in any window of the spans."""
    edges = np.zeros(length + 1, np.int32)
    if spans:
        np.add.at(edges, [s["first"] for s in spans], 1)
        np.add.at(edges, [s["last"] + window for s in spans], -1)
    return np.cumsum(edges[:length]) > 0
