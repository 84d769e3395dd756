"""SentencePiece encoding and decoding with a table of distinct chunks.

Where no piece holds a whitespace marker behind anything else, merges never reach across
the start of a run of markers.  A text is then cut before each such run, and its ids are
those of its chunks, one after the other.  A task keeps a table of the chunks it has met:
each distinct chunk is segmented once by the library, and the ids of a text are gathered
from the table by the places of its chunks.  Words repeat, so most of the work is lookups.

``cuts_at_markers`` reads from the model file whether this holds: byte-pair merges, no
normalising beyond the markers, a marker put before the text, no pieces defined by a user,
no marker inside a piece behind another character.  With any other model whole texts go to
the library.  The ids are the library's either way, begin and end ids as asked, no sampling.

The model reaches the tasks by broadcast of its file, whose size is checked.  A table
starts afresh beyond ``TABLE_CHARS``; a long text is worked on in pieces of whole chunks.

Ids are stored as little-endian unsigned 32-bit integers in one binary value per document,
the usual layout of training data; ``unpacked`` gives them as an array.

Defined results: a null or empty text has the begin and end ids alone and decodes to the
empty text; null ids decode to null; repeated rows are encoded alike; an empty table gives
an empty result.  Input columns named like a result column are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._tables import bounded_batches, free_name, groups_of

MODEL_BYTES = 64 << 20
TABLE_CHARS = 8 << 20
GROUP_CHARS = 1 << 20

MARK = "▁"
_CHUNK = re.compile(" +[^ ]*")
_START = re.compile("(?<! ) ")
_INSIDE = re.compile(f"[^{MARK}]{MARK}")

# --- fixed values: numbers of the fields and kinds in a SentencePiece model file ---
_PIECE, _TRAINER, _NORMALIZER = 1, 2, 3
_TEXT_OF_PIECE, _KIND_OF_PIECE, _USER_DEFINED = 1, 3, 4
_MODEL_TYPE, _BPE, _MARK_AS_SUFFIX = 3, 2, 24
_CHARS_MAP, _MARK_BEFORE, _ONE_SPACE, _ESCAPE = 2, 3, 4, 5
# -----------------------------------------------------------------------------------


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of the fields of a protocol buffer."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        head = number()
        if head & 7 == 0:
            yield head >> 3, number()
            continue
        length = {1: 8, 5: 4}.get(head & 7) or number()
        yield head >> 3, message[at : at + length]
        at += length


def cuts_at_markers(model: bytes) -> bool:
    """Whether texts may be segmented chunk by chunk."""
    trainer, normalizer = {}, {}
    for field, value in _fields(model):
        if field == _PIECE:
            piece = dict(_fields(value))
            if piece.get(_KIND_OF_PIECE) == _USER_DEFINED or _INSIDE.search(piece.get(_TEXT_OF_PIECE, b"").decode()):
                return False
        elif field == _TRAINER:
            trainer.update(_fields(value))
        elif field == _NORMALIZER:
            normalizer.update(_fields(value))
    plain = normalizer.get(_MARK_BEFORE, 1) and normalizer.get(_ESCAPE, 1) and not normalizer.get(_ONE_SPACE, 1)
    plain = plain and not normalizer.get(_CHARS_MAP) and not trainer.get(_MARK_AS_SUFFIX, 0)
    return bool(plain) and trainer.get(_MODEL_TYPE) == _BPE


def read_model(path: str) -> bytes:
    """The model file, from where the driver sees it."""
    if Path(path).stat().st_size > MODEL_BYTES:
        raise ValueError(f"{path} is larger than the {MODEL_BYTES} bytes that may be broadcast")
    return Path(path).read_bytes()


class ChunkTable:
    """Ids of distinct chunks, one behind the other."""

    def __init__(self, processor):
        self.processor = processor
        # the marker alone cannot be asked for: the library puts one before every text
        self.mark = processor.encode("a ")[len(processor.encode("a")) :]
        self.clear()

    def clear(self) -> None:
        self.slots: dict[str, int] = {}
        self.chars, self.used = 0, 0
        self.flat, self.start, self.length = np.empty(1 << 16, np.uint32), np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64)

    def add(self, chunks: list[str]) -> None:
        ids = self.processor.encode([c[1:] for c in chunks], num_threads=1)
        ids = [self.mark if c == " " else x for c, x in zip(chunks, ids)]
        length = np.fromiter(map(len, ids), np.int64, len(ids))
        first, end = len(self.slots), self.used + int(length.sum())
        while len(self.flat) < end:
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        while len(self.start) < first + len(ids):
            self.start = np.concatenate([self.start, np.empty_like(self.start)])
            self.length = np.concatenate([self.length, np.empty_like(self.length)])
        self.flat[self.used : end] = np.fromiter((x for own in ids for x in own), np.uint32, end - self.used)
        self.start[first : first + len(ids)] = self.used + np.cumsum(length) - length
        self.length[first : first + len(ids)] = length
        self.used = end
        self.slots.update(zip(chunks, range(first, first + len(chunks))))
        self.chars += sum(map(len, chunks)) + 8 * len(chunks)

    def ids(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks in a row, and how many each has."""
        if self.chars > TABLE_CHARS:
            self.clear()
        new = list(dict.fromkeys(c for c in chunks if c not in self.slots))
        if new:
            self.add(new)
        slots = np.fromiter(map(self.slots.__getitem__, chunks), np.int64, len(chunks))
        length = self.length[slots]
        before = np.cumsum(length) - length
        places = np.arange(int(length.sum())) + np.repeat(self.start[slots] - before, length)
        return self.flat[places], length


def pieces_of(text: str, most: int = GROUP_CHARS) -> Iterator[str]:
    """A text behind the marker it gets, in pieces of whole chunks."""
    line, at = " " + text.replace(MARK, " "), 0
    while len(line) - at > most:
        cut = line.rfind(" ", at + 1, at + most)
        while cut > at and line[cut - 1] == " ":
            cut -= 1
        if cut <= at:
            later = _START.search(line, at + most)
            cut = later.start() if later else len(line)
        yield line[at:cut]
        at = cut
    if at < len(line):
        yield line[at:]


def encode_texts(texts: list[str], table: ChunkTable) -> list[np.ndarray]:
    """The ids of each text."""
    pieces = [(k, piece) for k, text in enumerate(texts) if text for piece in pieces_of(text)]
    out: list[list[np.ndarray]] = [[] for _ in texts]
    for first, end in groups_of([len(piece) for _, piece in pieces], GROUP_CHARS):
        split = [_CHUNK.findall(piece) for _, piece in pieces[first:end]]
        ids, length = table.ids([chunk for own in split for chunk in own])
        until = np.concatenate([[0], np.cumsum(length)])[np.cumsum([0, *map(len, split)])]
        for (k, _), a, b in zip(pieces[first:end], until[:-1], until[1:]):
            out[k].append(ids[a:b])
    return [np.concatenate(own) if own else np.empty(0, np.uint32) for own in out]


def _worker(model, chunked: bool):
    """The library and the table, made once in each task."""
    held: dict = {}

    def get():
        if not held:
            import sentencepiece

            held["processor"] = sentencepiece.SentencePieceProcessor(model_proto=model.value)
            held["table"] = ChunkTable(held["processor"]) if chunked else None
        return held["processor"], held["table"]

    return get


def _encoded(texts: pa.Array, worker, begin: bool, end: bool) -> list[np.ndarray]:
    processor, table = worker()
    given = [t or "" for t in texts.to_pylist()]
    if table is None:
        ids = [np.array(x, np.uint32) for x in processor.encode(given, num_threads=1)]
    else:
        ids = encode_texts(given, table)
    head = np.array([processor.bos_id()] if begin else [], np.uint32)
    tail = np.array([processor.eos_id()] if end else [], np.uint32)
    return [np.concatenate([head, own, tail]) for own in ids]


def _shipped(spark: SparkSession, model: bytes):
    bounded_batches(spark)
    return _worker(spark.sparkContext.broadcast(model), cuts_at_markers(model))


def encode(documents: DataFrame, model: bytes, text: str = "text", begin: bool = True, end: bool = True) -> DataFrame:
    """The documents with n_tokens and ids."""
    worker = _shipped(documents.sparkSession, model)

    def ids(texts: pa.Array) -> pa.Array:
        return pa.array([own.astype("<u4").tobytes() for own in _encoded(texts, worker, begin, end)], pa.binary())

    encoded = documents.withColumn("ids", F.arrow_udf(ids, "binary")(F.col(f"`{text}`").cast("string")))
    return encoded.withColumn("n_tokens", F.shiftright(F.octet_length("ids"), 2).cast("long"))


def _decoded(processor, ids: list[int]) -> str:
    return processor.decode(ids) if ids else ""


def decode(encoded: DataFrame, model: bytes, ids: str = "ids") -> DataFrame:
    """The rows with decoded, the text of their packed ids."""
    worker = _shipped(encoded.sparkSession, model)

    def texts(packed: pa.Array) -> pa.Array:
        processor, _ = worker()
        rows = packed.to_pylist()
        return pa.array([None if x is None else _decoded(processor, np.frombuffer(x, "<u4").tolist()) for x in rows], pa.string())

    return encoded.withColumn("decoded", F.arrow_udf(texts, "string")(F.col(f"`{ids}`")))


def round_trip(documents: DataFrame, model: bytes, text: str = "text", begin: bool = True, end: bool = True) -> DataFrame:
    """The documents with n_tokens, ids and decoded, the text that the ids give, in one pass."""
    worker = _shipped(documents.sparkSession, model)
    result = free_name(documents, "_pieces")

    def both(texts: pa.Array) -> pa.Array:
        encoded = _encoded(texts, worker, begin, end)
        processor, _ = worker()
        columns = [
            pa.array(map(len, encoded), pa.int64()),
            pa.array([own.astype("<u4").tobytes() for own in encoded], pa.binary()),
            pa.array([_decoded(processor, own.tolist()) for own in encoded], pa.string()),
        ]
        return pa.StructArray.from_arrays(columns, ["n_tokens", "ids", "decoded"])

    kind = "n_tokens long, ids binary, decoded string"
    rows = documents.withColumn(result, F.arrow_udf(both, kind)(F.col(f"`{text}`").cast("string")))
    kept = [c for c in documents.columns if c.lower() not in ("n_tokens", "ids", "decoded")]
    return rows.select(*(F.col(f"`{c}`") for c in kept), f"{result}.*")


def unpacked(ids: Column) -> Column:
    """Packed ids as an array of integers."""
    count = (F.octet_length(ids) / 4).cast("int")
    byte = lambda at: F.conv(F.hex(F.substring(ids, at, F.lit(1))), 16, 10).cast("long")
    number = lambda k: sum((byte(4 * k + 1 + b) * (1 << 8 * b) for b in range(1, 4)), byte(4 * k + 1))
    return F.when(count == 0, F.array().cast("array<long>")).otherwise(F.transform(F.sequence(F.lit(0), count - 1), number))
