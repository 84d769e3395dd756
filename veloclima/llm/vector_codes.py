"""Vector code compression: product quantisation with exact integer k-means.

A vector's components become integers, floor(``SCALE`` * x), and the vector is cut into
``PARTS`` consecutive parts.  Each part has a codebook of ``ENTRIES`` integer entries, at
first the parts of the vectors with the smallest ids.  A round assigns every part to its
nearest entry (squared distance, ties to the lower index) and replaces each entry by the
mean of its parts, rounded down; after the last round parts are assigned once more.

Assigning keeps lower bounds (norm-of-sum bounds, Newling and Fleuret, 2016).  Entries form
``GROUPS`` groups by index.  Of each group a part keeps a lower bound on its distance to
the group's entries other than its own, and the round that bound was measured in.  All
codebooks so far are kept, so a bound of round s holds in round t less the largest distance
between an entry's places in s and in t, its true net way, which is never more than the sum
of its single steps.  The distance to the part's own entry is measured; only groups whose
bound is not above it are searched again, exactly.  Bounds are rounded down, and a tie always
searches again, so codes equal those of a full search.

Vectors and bounds are a written table, replaced in every round: one narrow pass.  Sums of
a round are partial per task, and Spark adds them; the driver gets one row per used entry
and holds the codebooks, ``PARTS * ENTRIES`` entries of a known length.  Distances are
computed in doubles where all are below 2**53, and in 64-bit integers beyond.

Defined results: rows whose vector is null, empty, or holds null or non-finite components
are dropped, and so are vectors of another length than the most frequent (ties: the longer).
Components are held between -2**k and 2**k, with the largest k for which the squared distances
of whole vectors fit 62 bits (k = 27 for 64 components), so results stay exact; a sum of errors
stops at 2**63 - 1.  Parts end at floor(i *
length / ``PARTS``).  Fewer vectors than ``ENTRIES`` make shorter codebooks; rows that repeat
an id count each, in the order of their components; a null id is the last.  An empty table gives
an empty result.  Input columns named like a result column are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._tables import Written, bounded_batches, free_name

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
GROUPS = 8
ROWS = 4096  # vectors worked on at once
RESULT = ("code", "error", "label_error")

#: One round's codebooks: for each part an array of (entries, components).
Codebooks = list[np.ndarray]


def edges(length: int, parts: int) -> list[int]:
    return [k * length // parts for k in range(parts + 1)]


def _quantised(scale: int):
    def rows(vectors: pa.Array) -> pa.Array:
        """Components as 32-bit integers in one binary value, null for rows to be dropped."""
        count = np.asarray(vectors.value_lengths().fill_null(0), np.int64)
        values = vectors.flatten().to_numpy(zero_copy_only=False)  # null becomes nan
        start = np.cumsum(count) - count
        good = np.isfinite(values)
        bad = np.concatenate([[0], np.cumsum(~good)])
        fine = (count > 0) & (bad[start + count] == bad[start])
        out = []
        for s, n, f in zip(start.tolist(), count.tolist(), fine.tolist()):
            if not f:
                out.append(None)
                continue
            most = 1 << (60 - (n - 1).bit_length()) // 2
            out.append(np.clip(np.floor(values[s : s + n] * scale), -most, most).astype("<i4").tobytes())
        return pa.array(out, pa.binary())

    return rows


def _matrix(packed: pa.Array, kind: str) -> np.ndarray:
    flat = np.frombuffer(b"".join(packed.to_pylist()), kind)
    return flat.reshape(len(packed), len(flat) // max(1, len(packed)))


def _packed(matrix: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in np.ascontiguousarray(matrix)], pa.binary())


def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to entries, as 64-bit integers."""
    peak = max((int(np.abs(a).max()) for a in (x, entries) if a.size), default=0)
    if x.shape[1] * (2 * peak) ** 2 < 1 << 53:
        a, b = x.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    return np.stack([((x - entry) ** 2).sum(1) for entry in entries], 1)


_FAR = np.iinfo(np.int64).max


def _below(distance: np.ndarray) -> np.ndarray:
    """Lower bounds on the roots of squared distances, safe to store in 32 bits; none is infinity."""
    root = np.sqrt(distance.astype(np.float64)) * (1 - 1e-6)
    return np.where(distance == _FAR, np.inf, root)


class Assigner:
    """Nearest entries of one part, by bounds over the rounds so far.

    ``history`` holds the part's entries of all rounds; the last are searched.
    """

    def __init__(self, history: list[np.ndarray], groups: int = GROUPS):
        self.now, self.round = history[-1].astype(np.int64), len(history) - 1
        self.groups = groups
        self.ends = [k * len(self.now) // groups for k in range(groups + 1)]
        self.group_of = np.repeat(np.arange(groups), np.diff(self.ends))
        self.net_ways = np.zeros((len(history), groups))
        for s, then in enumerate(history[:-1]):
            way = np.sqrt(((self.now - then) ** 2).sum(1).astype(np.float64)) * (1 + 1e-9)
            self.net_ways[s] = [way[a:b].max(initial=0) for a, b in zip(self.ends, self.ends[1:])]
        self.measured = 0  # distances computed in searches

    def __call__(self, x: np.ndarray, code: np.ndarray | None, bounds: np.ndarray | None, stamps: np.ndarray | None):
        """(code, squared distance, bounds, stamps), from those of an earlier round or from none."""
        n = len(x)
        if code is None:
            before, best = np.full(n, -1), np.full(n, _FAR)
            code, valid = np.full(n, len(self.now)), np.full((n, self.groups), -np.inf)
            bounds, stamps = np.empty((n, self.groups), np.float32), np.empty((n, self.groups), np.uint8)
        else:
            before = code = code.astype(np.int64)
            best = ((x - self.now[code]) ** 2).sum(1)
            valid = bounds - self.net_ways[stamps, np.arange(self.groups)]
            bounds, stamps = bounds.copy(), stamps.copy()
        own, code, best = best, code.copy(), best.copy()
        found = []
        for g, (a, b) in enumerate(zip(self.ends, self.ends[1:])):
            rows = np.flatnonzero(valid[:, g] <= np.sqrt(best.astype(np.float64)) * (1 + 1e-9))
            if not len(rows):
                continue
            distance = squared(x[rows], self.now[a:b]) if a < b else np.full((len(rows), 1), _FAR)
            self.measured += len(rows) * (b - a)
            at, line = distance.argmin(1), np.arange(len(rows))
            least = distance[line, at]
            distance[line, at] = _FAR
            found.append((g, rows, at + a, least, distance.min(1)))
            better = (least < best[rows]) | ((least == best[rows]) & (at + a < code[rows]))
            better &= least < _FAR
            code[rows[better]], best[rows[better]] = (at + a)[better], least[better]
        # an entry given up belongs to its group's bound again
        left = np.flatnonzero((before >= 0) & (code != before))
        g = self.group_of[before[left]]
        bounds[left, g], stamps[left, g] = np.minimum(valid[left, g] * (1 - 1e-6), _below(own[left])), self.round
        # a searched group's bound is new, and leaves out the entry that was taken in the end
        for g, rows, entry, least, second in found:
            bounds[rows, g] = _below(np.where(entry == code[rows], second, least))
            stamps[rows, g] = self.round
        return code, best, bounds, stamps


def _assign(history, parts: int, groups: int, counted=None):
    """An Arrow function: packed vectors, and the codes, bounds and stamps of the round before."""

    def assign(*columns: pa.Array) -> pa.Array:
        x = _matrix(columns[0], "<i4").astype(np.int64)
        ends = edges(x.shape[1], parts)
        assigners = [Assigner([codebooks[p] for codebooks in history.value], groups) for p in range(parts)]
        out = []
        for first in range(0, len(x), ROWS):
            own = x[first : first + ROWS]
            state = [None] * 3
            if len(columns) > 1:
                code, bounds, stamps = (c.slice(first, ROWS) for c in columns[1:])
                state = [_matrix(code, "u1"), _matrix(bounds, "<f4"), _matrix(stamps, "u1")]
            found = []
            for p, assigner in enumerate(assigners):
                at = slice(p * groups, (p + 1) * groups)
                earlier = [None] * 3 if state[0] is None else [state[0][:, p], state[1][:, at], state[2][:, at]]
                found.append(assigner(own[:, ends[p] : ends[p + 1]], *earlier))
            code, error, bounds, stamps = zip(*found)
            out.append(
                pa.StructArray.from_arrays(
                    [
                        _packed(np.stack(code, 1).astype(np.uint8)),
                        _packed(np.concatenate(bounds, 1).astype("<f4")),
                        _packed(np.concatenate(stamps, 1)),
                        pa.array(sum(error)),
                    ],
                    ["code", "bounds", "stamps", "error"],
                )
            )
        if counted is not None:
            counted.add(sum(a.measured for a in assigners))
        return pa.concat_arrays(out)  # a batch has rows

    return assign


_STATE = "code binary, bounds binary, stamps binary, error long"


def _sums(length: int, parts: int, entries: int):
    """Partial sums of the parts assigned to each entry, one row per used entry and task."""
    ends = edges(length, parts)
    widest = max(b - a for a, b in zip(ends, ends[1:]))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((parts, entries, widest), np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            x, code = _matrix(batch.column(0), "<i4").astype(np.int64), _matrix(batch.column(1), "u1")
            for p, (a, b) in enumerate(zip(ends, ends[1:])):
                np.add.at(total[p, :, : b - a], code[:, p], x[:, a:b])
                count[p] += np.bincount(code[:, p], minlength=entries)
        p, entry = np.nonzero(count)
        columns = [p, entry, count[p, entry], *(total[p, entry, k] for k in range(widest))]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["part", "entry", "n", *(f"s{k}" for k in range(widest))])

    return rows, widest


def moved(state: DataFrame, codebooks: Codebooks, length: int) -> Codebooks:
    """The codebooks with each used entry at the mean of its parts, rounded down."""
    parts, entries = len(codebooks), len(codebooks[0])
    rows, widest = _sums(length, parts, entries)
    names = [f"s{k}" for k in range(widest)]
    layout = ", ".join(f"{name} long" for name in ["part", "entry", "n", *names])
    partial = state.select("x", "code").mapInArrow(rows, layout)
    out = [c.copy() for c in codebooks]
    # parts * entries rows at most
    for row in partial.groupBy("part", "entry").agg(*(F.sum(c).alias(c) for c in ["n", *names])).collect():
        own = out[row.part]
        own[row.entry] = np.array(row[3 : 3 + own.shape[1]], np.int64) // row.n
    return out


def compress(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    scale: int = SCALE,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    groups: int = GROUPS,
    counted=None,
) -> tuple[DataFrame, Codebooks]:
    """The kept rows, vectors left out, with code, error and label_error; and the codebooks.

    ``code`` is one byte per part.  ``counted``, an accumulator, gets the number of distances
    that searches computed.
    """
    if not 1 <= entries <= 256:
        raise ValueError("an index has one byte: 1 to 256 entries")
    spark = vectors.sparkSession
    bounded_batches(spark)
    tables = Written(spark, "vector-codes")
    kept = [c for c in vectors.columns if c != vector and c.lower() not in RESULT]
    own = {c: f"_{k}" for k, c in enumerate(kept)}  # names out of the way of the state's
    state_columns = [F.col(f"`{c}`").alias(name) for c, name in own.items()]
    if vec_id not in own:
        state_columns.append(F.col(f"`{vec_id}`").alias("_id"))
    if label not in own:
        state_columns.append(F.col(f"`{label}`").alias("_label"))
    id_, label_ = own.get(vec_id, "_id"), own.get(label, "_label")
    integers = F.arrow_udf(_quantised(scale), "binary")(F.col(f"`{vector}`").cast("array<double>")).alias("x")
    state = tables(vectors.select(*state_columns, integers).where("x is not null"), "vectors")
    held = [c for c in state.columns if c != "x"]

    sizes = state.groupBy(F.octet_length("x").alias("size")).count()
    size = sizes.orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    length = size[0]["size"] // 4 if size else 0
    state = state.where(F.octet_length("x") == 4 * length)
    seeds = state.select(id_, "x").orderBy(F.col(id_).asc_nulls_last(), "x").limit(entries).collect()
    first = np.array([np.frombuffer(r.x, "<i4") for r in seeds], np.int64).reshape(len(seeds), length)
    history = [[first[:, a:b] for a, b in zip(edges(length, parts), edges(length, parts)[1:])]]

    columns, last = ["x"], "vectors"
    for k in range(rounds + 1):
        assign = F.arrow_udf(_assign(spark.sparkContext.broadcast(history), parts, groups, counted), _STATE)
        state = state.withColumn("_found", assign(*columns)).select(*held, "x", "_found.*")
        state = tables(state, f"round{k}")
        tables.drop(last)
        columns, last = ["x", "code", "bounds", "stamps"], f"round{k}"
        if k < rounds and len(first):
            history.append(moved(state, history[-1], length))

    by_label = [F.col(label_).isNull().alias("_none"), F.col(label_).alias("_of")]
    sums = state.groupBy(*by_label).agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit((1 << 63) - 1).cast("decimal(38,0)")).alias("_sum"))
    sums = tables(sums.select("_none", "_of", F.col("_sum").cast("long").alias("label_error")), "labels")
    coded = state.join(sums, (F.col(label_).isNull() == F.col("_none")) & F.col(label_).eqNullSafe(F.col("_of")))
    return coded.select(*(F.col(name).alias(c) for c, name in own.items()), *RESULT), history[-1]


def codebooks_digest(codebooks: Codebooks) -> str:
    """sha256 of all components as decimal numbers, by part, entry and position."""
    listed = ",".join(str(x) for part in codebooks for entry in part.tolist() for x in entry)
    return hashlib.sha256(listed.encode()).hexdigest()


def encode(vectors: DataFrame, codebooks: Codebooks, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """Any vectors with code and error under given codebooks, null where they do not fit: one narrow pass."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    length = sum(part.shape[1] for part in codebooks)
    full = _assign(spark.sparkContext.broadcast([codebooks]), len(codebooks), 1)
    empty = np.zeros(length, "<i4").tobytes()

    def codes(packed: pa.Array) -> pa.Array:
        fits = [x is not None and len(x) == len(empty) for x in packed.to_pylist()]
        found = full(pa.array([x if f else empty for x, f in zip(packed.to_pylist(), fits)], pa.binary()))
        columns = [pa.array([v if f else None for v, f in zip(found.field(c).to_pylist(), fits)], t) for c, t in _CODE.items()]
        return pa.StructArray.from_arrays(columns, list(_CODE))

    result = free_name(vectors, "_coded")
    integers = F.arrow_udf(_quantised(scale), "binary")(F.col(f"`{vector}`").cast("array<double>"))
    coded = F.arrow_udf(codes, "code binary, error long")(integers)
    kept = [F.col(f"`{c}`") for c in vectors.columns if c.lower() not in _CODE]
    return vectors.withColumn(result, coded).select(*kept, f"{result}.*")


_CODE = {"code": pa.binary(), "error": pa.int64()}


def decode(coded: DataFrame, codebooks: Codebooks, scale: int = SCALE) -> DataFrame:
    """The rows with approximation, the vector that their code stands for."""
    held = coded.sparkSession.sparkContext.broadcast(codebooks)

    def vectors(codes: pa.Array) -> pa.Array:
        books = held.value
        rows = [None if c is None else np.concatenate([books[p][e] for p, e in enumerate(c)]) / scale for c in codes.to_pylist()]
        return pa.array(rows, pa.list_(pa.float64()))

    return coded.withColumn("approximation", F.arrow_udf(vectors, "array<double>")(F.col("code")))
