"""Line dedup by pairwise alignment.

Documents overlap if they share a run of neighbouring lines with ``BLOCK_WORDS`` words.  From
each line on, and back from each line, the shortest such run is hashed, and a document is
compared with the first holder of each of its runs.  So there are no more pairs than two per
line, however many documents share one, and none is left out: a line of a common block lies
in such a run inside the block, and whoever holds the block, the run's first holder has that
run.  The two are aligned by patience diff: lines that each side has once, in the longest
order common to both, split the texts, and what lies between is aligned in the same way.
Aligned runs of lines with at least ``BLOCK_WORDS`` words are deleted from the later document,
and so are runs that both have in another order, which no alignment holds all of: a first
holder speaks for the others, whose order may be that of the later document.

The order of documents is that of doc_id (null last), then of the row's key.  Lines are
compared without white space at their ends; lines without words match, but count nothing.

Alignment reads arrays of line hashes only; texts move once, when lines are cut.  Later documents
meet their first holders in buckets of about ``MEET_LINES`` lines: a first holder that many share is
sent to as many buckets as its later documents fill, once to each, not once to each document.

Defined results: a null or empty text has no lines and stays; rows that repeat doc_id and
text are one document here, and are cut alike; an empty table gives an empty result; other
columns are kept, those named like a result column are replaced.
"""

from __future__ import annotations

import bisect
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._repeats import RangeHash
from ._tables import Written, free_name, mixed, row_identity, texts_of

BLOCK_WORDS = 15  # in a deleted block
MEET_LINES = 20_000  # of later documents that meet their first holders at once


def block_runs(names: np.ndarray, words: np.ndarray, ends: np.ndarray, least: int = BLOCK_WORDS):
    """(start, end, key) of the shortest runs with ``least`` words from each line on and back from each.

    The lines are those of several documents, ``ends`` their first place and where each ends.
    """
    document = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    total = np.concatenate([[0], np.cumsum(words, dtype=np.int64)])
    place = np.arange(len(names))
    end = np.searchsorted(total, total[:-1] + least, "left")
    start = np.searchsorted(total, total[1:] - least, "right") - 1
    on, back = end <= ends[document + 1], start >= ends[document]
    start, end = np.concatenate([place[on], start[back]]), np.concatenate([end[on], place[back] + 1])
    return start, end, mixed(RangeHash(names)(start, end), (end - start).astype(np.uint64))


def _line_hashes(texts: pa.Array) -> pa.Array:
    import xxhash

    hashes, words, ends = [], [], [0]
    for text in texts_of(texts):
        for line in text.split(b"\n") if text else ():
            parts = line.split()
            hashes.append((xxhash.xxh64_intdigest(line.strip(b" \t\x0b\f\r"), 7) | 1) if parts else 0)
            words.append(len(parts))
        ends.append(len(hashes))
    names, ends = np.array(hashes, dtype=np.uint64), np.array(ends)
    start, _, key = block_runs(names, np.array(words, np.int64), ends)
    document = np.searchsorted(ends, start, "right") - 1
    order = np.lexsort((key, document))
    document, key = document[order], key[order]
    new = np.ones(len(key), bool)  # a run once per document
    new[1:] = (document[1:] != document[:-1]) | (key[1:] != key[:-1])
    run_ends = np.concatenate([[0], np.cumsum(np.bincount(document[new], minlength=len(ends) - 1))])
    lists = [
        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(x, kind))
        for offsets, x, kind in ((ends, names.view(np.int64), pa.int64()), (ends, words, pa.int32()), (run_ends, key[new].view(np.int64), pa.int64()))
    ]
    return pa.StructArray.from_arrays(lists, ["hashes", "words", "runs"])


_LINES = T.StructType(
    [
        T.StructField("hashes", T.ArrayType(T.LongType())),
        T.StructField("words", T.ArrayType(T.IntegerType())),
        T.StructField("runs", T.ArrayType(T.LongType())),
    ]
)
line_hashes = F.arrow_udf(_line_hashes, _LINES)


def _in_order(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest chain of pairs, sorted by the first place, that rises in the second."""
    tails: list[int] = []
    last: list[int] = []
    before = [-1] * len(pairs)
    for k, (_, y) in enumerate(pairs):
        at = bisect.bisect_left(tails, y)
        before[k] = last[at - 1] if at else -1
        if at == len(tails):
            tails.append(y)
            last.append(k)
        else:
            tails[at], last[at] = y, k
    chain, k = [], last[-1] if last else -1
    while k >= 0:
        chain.append(pairs[k])
        k = before[k]
    return chain[::-1]


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned places (in a, in b), rising in both."""
    matched = []
    open_parts = [(0, len(a), 0, len(b))]
    while open_parts:
        a0, a1, b0, b1 = open_parts.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            matched.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            matched.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        na, nb = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {a[i]: i for i in range(a0, a1) if na[a[i]] == 1}
        pairs = [(place[b[j]], j) for j in range(b0, b1) if nb[b[j]] == 1 and b[j] in place]
        if not pairs:  # only lines that repeat: the k-th with the k-th
            places = defaultdict(list)
            for i in range(a1 - 1, a0 - 1, -1):
                places[a[i]].append(i)
            pairs = [(places[b[j]].pop(), j) for j in range(b0, b1) if places.get(b[j])]
        anchors = _in_order(sorted(pairs))
        if not anchors:
            continue
        matched += anchors
        a_from, b_from = a0, b0
        for i, j in [*anchors, (a1, b1)]:
            open_parts.append((a_from, i, b_from, j))
            a_from, b_from = i + 1, j + 1
    return sorted(matched)


def common_blocks(first: list[int], later: list[int], words: list[int], least: int = BLOCK_WORDS) -> list[int]:
    """Places in ``later`` of lines in common runs with enough words, aligned or moved."""
    cut, run = [], []
    for i, j in [*patience(first, later), (-2, -2)]:
        if run and (i, j) != (run[-1][0] + 1, run[-1][1] + 1):
            if sum(words[y] for _, y in run) >= least:
                cut += [y for _, y in run]
            run = []
        run.append((i, j))
    return sorted({*cut, *_moved(first, later, words, cut, least)})


def _moved(first: list[int], later: list[int], words: list[int], cut: list[int], least: int) -> list[int]:
    """Places in ``later`` of the shortest runs with enough words that ``first`` has anywhere."""
    have, gone, known = set(first), set(cut), dict(zip(later, words))
    if not any(line in have and y not in gone for y, line in enumerate(later)):
        return []
    lines = np.array([*first, *later], np.int64).view(np.uint64)
    counts = np.array([*(known.get(x, least) for x in first), *words], np.int64)
    start, end, key = block_runs(lines, counts, np.array([0, len(first), len(lines)]), least)
    own = start >= len(first)
    both = np.isin(key[own], key[~own])
    return [y - len(first) for s, e in zip(start[own][both].tolist(), end[own][both].tolist()) for y in range(s, e)]


def _align(firsts: pa.Table, later: pa.Table) -> pa.Table:
    """Cut places of the later documents of a bucket."""
    held = {(x["a"], x["b"]): h for x, h in zip(firsts.column("holder").to_pylist(), firsts.column("held").to_pylist())}
    columns = (later.column(name).to_pylist() for name in ("key", "first", "hashes", "words"))
    rows = [(k["a"], k["b"], common_blocks(held[x["a"], x["b"]], h, w)) for k, x, h, w in zip(*columns)]
    rows = list(zip(*(r for r in rows if r[2]))) or [(), (), ()]
    kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()))
    return pa.table([pa.array(c, t) for c, t in zip(rows, kinds)], names=["a", "b", "cut"])


def _cut(texts: pa.Array, removed: pa.Array) -> pa.Array:
    out = []
    for text, gone in zip(texts.to_pylist(), removed.to_pylist()):
        if gone:
            drop = set(gone)
            text = "\n".join(line for k, line in enumerate(text.split("\n")) if k not in drop)
        out.append(text)
    return pa.array(out, pa.string())


def aligned(pairs: DataFrame, docs: DataFrame, tables: Written, meet_lines: int = MEET_LINES) -> DataFrame:
    """(key, cut): for each pair (first, key) with common blocks, the places in the later document."""
    lines = docs.select("key", F.size("hashes").cast("long").alias("n"))
    load = pairs.join(lines, "key").groupBy("first").agg(F.sum("n").alias("n"))
    load = tables(load.select("first", F.ceil(F.greatest("n", F.lit(1)) / meet_lines).cast("int").alias("chunks"), "n"), "load")
    total = load.agg(F.sum("n")).first()[0] or 0
    bucket = F.pmod(F.xxhash64("first", "chunk"), F.lit(max(1, -(-total // meet_lines)))).alias("bucket")
    chunk = F.pmod(F.xxhash64("key"), F.col("chunks")).cast("int").alias("chunk")
    later = pairs.join(load, "first").select("first", "key", chunk).join(docs.select("key", "hashes", "words"), "key")
    firsts = load.join(docs.select(F.col("key").alias("first"), "hashes"), "first")
    firsts = firsts.select("first", "hashes", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    firsts = firsts.select(bucket, F.col("first").alias("holder"), F.col("hashes").alias("held"))
    later = later.select(bucket, "key", "first", "hashes", "words")
    cut = firsts.groupBy("bucket").cogroup(later.groupBy("bucket")).applyInArrow(_align, "a long, b long, cut array<int>")
    return cut.select(F.struct("a", "b").alias("key"), "cut")


def removed_lines(documents: DataFrame, tables: Written, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(key, removed): for documents that lose lines, the places of these lines."""
    own = documents.select(
        row_identity(f"`{doc_id}`", f"`{text}`").alias("key"),
        F.col(f"`{doc_id}`").isNull().alias("nameless"),
        F.col(f"`{doc_id}`").alias("name"),
        line_hashes(F.col(f"`{text}`").cast("string")).alias("l"),
    ).dropDuplicates(["key"])
    docs = tables(own.select("key", "nameless", "name", "l.hashes", "l.words", "l.runs"), "lines")
    order = F.struct("nameless", "name", "key")
    each = docs.select(order.alias("at"), F.explode("runs").alias("h"))
    held = each.groupBy("h").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    held = tables(held.where("n >= 2").select("h", F.col("first.key").alias("first")), "held")
    each = docs.select("key", F.explode("runs").alias("h"))
    pairs = each.join(held, "h").where("key <> first").select("first", "key").distinct()
    pairs = tables(pairs, "pairs")
    cut = aligned(pairs, docs, tables)
    lost = cut.groupBy("key").agg(F.array_distinct(F.flatten(F.collect_list("cut"))).alias("removed"))
    lost = tables(lost, "removed")
    tables.drop("lines", "held", "pairs", "load")
    return lost


def dedup_lines(documents: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents with what is left of their text, and n_lines and n_removed."""
    tables = Written(documents.sparkSession, "line-dedup")
    key = free_name(documents, "_key")
    lost = removed_lines(documents, tables, text, doc_id).withColumnRenamed("key", key)
    kept = [c for c in documents.columns if c.lower() not in {"n_lines", "n_removed"}]
    keyed = documents.select(*(F.col(f"`{c}`") for c in kept), row_identity(f"`{doc_id}`", f"`{text}`").alias(key))
    joined = keyed.join(lost.hint("merge"), key, "left")
    old = F.col(f"`{text}`").cast("string")
    n_lines = F.when(F.coalesce(F.length(old), F.lit(0)) == 0, 0).otherwise(F.size(F.split(old, "\n"))).cast("long")
    new = F.when(F.col("removed").isNull(), old).otherwise(F.arrow_udf(_cut, "string")(old, F.col("removed")))
    return joined.select(
        *(new.alias(c) if c == text else F.col(f"`{c}`") for c in kept),
        n_lines.alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
    )


def keep_texts(documents: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents without repeated lines, those with no word left dropped; own columns only."""
    rows = dedup_lines(documents, text, doc_id).select(*(F.col(f"`{c}`") for c in documents.columns), "n_removed")
    return rows.where((F.col("n_removed") == 0) | F.col(f"`{text}`").rlike(r"[^\x20\x09-\x0D]")).drop("n_removed")
