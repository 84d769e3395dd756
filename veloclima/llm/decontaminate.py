"""Benchmark decontamination with one Aho-Corasick automaton.

Benchmark questions and answers become windows of 10 normalised words.  All windows go
into one automaton over word numbers (see ``automaton``), which reads each normalised text once; hits
are mapped back to words, and to offsets of the original text.

Normalised: A-Z in lower case, words are runs of ASCII letters, digits and anything beyond
ASCII.  In UTF-8 that is a table of 256 bytes, so normalising is one ``bytes.translate``.

The automaton is built on the driver and reaches the tasks by broadcast.  The benchmark's size is
measured first: beyond ``SHARD_BYTES`` of words (an automaton of some 110 MB, measured 170 bytes a word) its
pieces are dealt by hash into shards, each with an automaton and a scan of its own.  Such a scan
keeps the hits only, by the row's identity, and the texts meet the hits of all scans once.  The result is the same.

Defined results: a null or empty text has no words and no hits; items without words are
ignored; repeated documents each get their row; repeated item ids count once; no
documents or no items give no rows or no hits.  A null item id counts as the id "".
"""

from __future__ import annotations

import hashlib
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._tables import Written, bounded_batches, free_name, row_key, texts_of, twin_key
from .automaton import Automaton

WINDOW = 10
SHARD_BYTES = 4_000_000
PIECE = 1000  # words of an item that are dealt to a shard together

_WORD = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(128, 256))
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if b in _WORD else 32 for b in range(256)
)

_FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
    ]
)
_HITS = T.StructType([_FOUND["items"], _FOUND["spans"]])
_PIECES = T.ArrayType(T.StringType())


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def _pieces(texts: pa.Array) -> pa.Array:
    """Normalised words of each text, in overlapping pieces, so that each window is in one of them."""
    out = []
    for text in texts_of(texts):
        w = words_of(text)
        starts = range(0, max(1, len(w) - WINDOW + 1), PIECE - WINDOW + 1) if w else ()
        out.append([b" ".join(w[i : i + PIECE]).decode() for i in starts])
    return pa.array(out, pa.list_(pa.string()))


def item_pieces(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item, piece), each pair once."""
    pieces = F.arrow_udf(_pieces, _PIECES)(F.col(f"`{text}`").cast("string"))
    item = F.coalesce(F.col(f"`{item_id}`").cast("string"), F.lit("")).alias("item")
    return benchmark.select(item, F.explode(pieces).alias("piece")).distinct()


def window_automaton(pieces: list[tuple[str, str]]) -> tuple[dict[bytes, int], list[str], Automaton]:
    """(word numbers, item ids, automaton) of the windows of all (item, piece)."""
    numbers: dict[bytes, int] = {}
    items = sorted({item for item, _ in pieces})
    place = {item: k for k, item in enumerate(items)}
    by_length: dict[int, tuple[list, list]] = {}
    for item, piece in pieces:
        words = np.array([numbers.setdefault(w, len(numbers) + 1) for w in piece.encode().split()], np.int64)
        windows = np.lib.stride_tricks.sliding_window_view(words, min(WINDOW, len(words)))
        rows, owners = by_length.setdefault(windows.shape[1], ([], []))
        rows.append(windows)
        owners.append(np.full(len(windows), place[item]))
    patterns = [np.concatenate(rows) for rows, _ in by_length.values()]
    owners = [o for _, own in by_length.values() for o in own]
    return numbers, items, Automaton(patterns, np.concatenate(owners) if owners else np.zeros(0, np.int64), len(numbers) + 1)


def _word_offsets(text: bytes) -> list[tuple[int, int]]:
    """Start and end of each word as code points of the original text."""
    offsets, at, chars = [], 0, 0
    plain = text.translate(_TABLE)
    for word in plain.split():
        start = plain.index(word, at)
        chars += len(text[at:start].decode("utf-8", "replace"))
        length = len(word.decode("utf-8", "replace"))
        offsets.append((chars, chars + length))
        at, chars = start + len(word), chars + length
    return offsets


def search(texts: list[bytes], numbers: dict[bytes, int], items: list[str], automaton: Automaton):
    """(words, spans, items) of each text: hit words as [start, end), merged, and the items they are of."""
    split = [words_of(text) for text in texts]
    ends = np.cumsum([len(w) + 1 for w in split]) if split else np.zeros(0, np.int64)
    line = np.zeros(int(ends[-1]) if len(ends) else 0, np.int64)
    for words, end in zip(split, ends.tolist()):
        line[end - 1 - len(words) : end - 1] = np.fromiter(map(numbers.get, words, repeat(0)), np.int64, len(words))
    last, length, owner = automaton.hits(line)
    text = np.searchsorted(ends, last, "right")
    order = np.argsort(text, kind="stable")
    cuts = np.searchsorted(text[order], np.arange(len(texts) + 1))
    out = []
    for k, words in enumerate(split):
        own = order[cuts[k] : cuts[k + 1]]
        if not len(own):
            out.append((len(words), [], []))
            continue
        begin = int(ends[k]) - 1 - len(words)
        spans = sorted({(e - n + 1 - begin, e + 1 - begin) for e, n in zip(last[own].tolist(), length[own].tolist())})
        out.append((len(words), merged(spans), sorted({items[i] for i in np.unique(owner[own]).tolist()})))
    return out


def merged(spans) -> list[list[int]]:
    """Sorted spans, those that touch joined."""
    out: list[list[int]] = []
    for start, end in spans:
        if out and start <= out[-1][1]:
            out[-1][1] = max(end, out[-1][1])
        else:
            out.append([start, end])
    return out


def _found_rows(rows) -> pa.Array:
    rows = [{"n_words": n, "n_hit": sum(e - s for s, e in spans), "items": items, "spans": spans} for n, spans, items in rows]
    return pa.array(rows, _ARROW)


def _scan(held):
    """An Arrow function over texts: everything that is found."""

    def scan(texts: pa.Array) -> pa.Array:
        return _found_rows(search(texts_of(texts), *held.value))

    return scan


def _hits(held):
    """An Arrow function over texts: spans and items of those with hits, null for the others."""

    def hits(texts: pa.Array) -> pa.Array:
        rows = [{"items": items, "spans": spans} if spans else None for _, spans, items in search(texts_of(texts), *held.value)]
        return pa.array(rows, pa.struct([_ARROW.field("items"), _ARROW.field("spans")]))

    return hits


def _joined(texts: pa.Array, items: pa.Array, spans: pa.Array) -> pa.Array:
    """What is found in each text, from the hits of several scans."""
    rows = zip(texts_of(texts), items.to_pylist(), spans.to_pylist())
    return _found_rows((len(words_of(t)), merged(sorted(map(tuple, s or ()))), sorted(set(i or ()))) for t, i, s in rows)


_ARROW = pa.struct(
    [("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("spans", pa.list_(pa.list_(pa.int64())))]
)


def scan(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """The documents with ``found``: n_words, n_hit, items, spans of hit words."""
    spark = documents.sparkSession
    tables = Written(spark, "decontaminate")
    bounded_batches(spark)
    pieces = tables(item_pieces(benchmark, item_id, item_text), "pieces")
    size = pieces.agg(F.sum(F.octet_length("piece") + F.octet_length("item"))).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))
    documents = documents.drop("found")
    body = F.col(f"`{text}`").cast("string")

    def shipped(shard: int):
        own = pieces.where(F.pmod(F.xxhash64("item", "piece"), F.lit(shards)) == shard).collect()  # about ``shard_bytes``
        return spark.sparkContext.broadcast(window_automaton([(r["item"], r["piece"]) for r in own]))

    if shards == 1:
        return documents.withColumn("found", F.arrow_udf(_scan(shipped(0)), _FOUND)(body))
    names = [free_name(documents, "_key"), free_name(documents, "_twin")]
    identity = [row_key(f"`{text}`").alias(names[0]), twin_key(f"`{text}`").alias(names[1])]
    parts = []
    for shard in range(shards):
        hits = documents.select(*identity, F.arrow_udf(_hits(shipped(shard)), _HITS)(body).alias("h")).where("h is not null")
        parts.append(tables(hits.dropDuplicates(names).select(*names, "h.*"), f"hits{shard}"))
    lists = {name: free_name(documents, f"_{name}") for name in ("items", "spans")}
    flat = (F.flatten(F.collect_list(name)).alias(own) for name, own in lists.items())
    whole = reduce(DataFrame.unionAll, parts).groupBy(*names).agg(*flat)
    rows = documents.select("*", *identity).join(tables(whole, "hits"), names, "left")
    found = F.arrow_udf(_joined, _FOUND)(body, *(F.col(own) for own in lists.values()))
    return rows.withColumn("found", found).select(*(F.col(f"`{c}`") for c in documents.columns), "found")


def mark(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents with n_words, n_hit, n_items, items and contaminated."""
    own = {"n_words", "n_hit", "n_items", "items", "contaminated", "found"}
    kept = [c for c in documents.columns if c.lower() not in own]
    return scan(documents, benchmark, **options).select(
        *(F.col(f"`{c}`") for c in kept),
        F.col("found.n_words").alias("n_words"),
        F.col("found.n_hit").alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.col("found.items").alias("items"),
        (F.col("found.n_hit") > 0).alias("contaminated"),
    )


def _original(texts: pa.Array, spans: pa.Array) -> pa.Array:
    out = []
    for text, hit in zip(texts_of(texts), spans.to_pylist()):
        offsets = _word_offsets(text) if hit else []
        out.append([[offsets[s][0], offsets[e - 1][1]] for s, e in hit or ()])
    return pa.array(out, pa.list_(pa.list_(pa.int64())))


def original_spans(found: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``original_spans``: [start, end) of each hit in code points of the text."""
    spans = F.arrow_udf(_original, T.ArrayType(T.ArrayType(T.LongType())))
    return found.withColumn("original_spans", spans(F.col(text).cast("string"), F.col("found.spans")))


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without any window of the benchmark, with their own columns only."""
    whole = documents.select(
        F.col(f"`{options.get('text', 'text')}`").alias("_text"),
        F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("_row"),
    )
    found = scan(whole, benchmark, **(options | {"text": "_text"}))
    return found.where(F.col("found.n_hit") == 0).select("_row.*")


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
