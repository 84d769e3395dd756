"""SimHash near-duplicates with a hierarchical index in Gray order.

Fingerprints are made distinct and sorted by Gray rank (the place of the value in the
reflected Gray code), so that neighbours share most of their bits.  Ranges of that order
are blocks.  In a block, groups of neighbours form the nodes of a tree: a node holds the
bits that all its members share and that no node above it holds yet.  A search adds up the
differing bits on its way down and leaves a group as soon as there are too many.

The same holds above the blocks: their shared bits are nodes too, and a fingerprint is sent
only to those blocks that may hold a neighbour of it.  There are ``FEWEST_BLOCKS`` to ``BLOCKS``
of them: how often a fingerprint is sent grows with the square of the logarithm of their
number, and their number bounds what is broadcast.  Members of a block and the fingerprints sent to it meet in
pieces of bounded size, whatever the groups in the data: exact copies count once here.

Defined results: a null or empty text has fingerprint 0 and links like any other; a group
is named by its smallest doc_id that is not null; repeated rows each get their row; an
empty table gives an empty result.  Input columns named like a result column are replaced.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._tables import Written, free_name, row_identity, row_key, texts_of, twin_key
from .components import components

SHINGLE = 3
SEED = 42
DISTANCE = 2
FEWEST_BLOCKS, BLOCKS = 1 << 6, 1 << 16
BLOCK_ROWS = 1 << 15
SEARCH_ROWS = 200_000  # fingerprints that search a block in one piece
_FAN = 4
_FRONT = 1 << 21  # (fingerprint, node) pairs held at once


def fingerprint_of(text: bytes) -> int:
    """64 bits as an unsigned number; bytes.lower changes A-Z only."""
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(SHINGLE))))
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(s, SEED) for s in shingles], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(h), 1 << 16):  # 64 bytes a shingle
        bits = np.unpackbits(h[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


@F.arrow_udf(T.LongType())
def fingerprints(texts: pa.Array) -> pa.Array:
    values = np.array([fingerprint_of(t) for t in texts_of(texts)], dtype=np.uint64)
    return pa.array(values.view(np.int64))


def gray_rank(values: np.ndarray) -> np.ndarray:
    """Place of each unsigned value in the reflected Gray code."""
    rank = values.astype(np.uint64)
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank ^ (rank >> np.uint64(shift))
    return rank


def _gray_rank_column(name: str):
    """The same for a long, as a long in the same order."""
    rank = F.col(name)
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    return rank.bitwiseXOR(F.lit(-(1 << 63)))


class GrayTree:
    """Groups of ``_FAN`` neighbours, groups of these, and so on up to one root."""

    def __init__(self, same_one: np.ndarray, same_zero: np.ndarray):
        """Members in Gray order, as bits that are surely 1 and bits that are surely 0."""
        levels = [(same_one, same_zero)]
        while len(levels[-1][0]) > 1:
            one, zero = levels[-1]
            starts = np.arange(0, len(one), _FAN)
            levels.append((np.bitwise_and.reduceat(one, starts), np.bitwise_and.reduceat(zero, starts)))
        self.levels = []  # from the root: (mask of the bits a node adds, their values)
        for k in range(len(levels) - 1, -1, -1):
            one, zero = levels[k]
            mask = one | zero
            if k + 1 < len(levels):
                above = (levels[k + 1][0] | levels[k + 1][1])[np.arange(len(one)) // _FAN]
                mask = mask & ~above
            self.levels.append((mask, one & mask))

    def search(self, wanted: np.ndarray, distance: int):
        """Yields (place in wanted, member): all members that differ in few enough bits."""
        if not self.levels or not len(self.levels[0][0]) or not len(wanted):
            return
        stack = [(0, np.arange(len(wanted)), np.zeros(len(wanted), np.int64), np.zeros(len(wanted), np.uint8))]
        while stack:
            depth, place, node, far = stack.pop()
            if len(place) > _FRONT:
                half = len(place) // 2
                stack += [(depth, place[:half], node[:half], far[:half]), (depth, place[half:], node[half:], far[half:])]
                continue
            mask, value = self.levels[depth]
            far = far + np.bitwise_count((wanted[place] ^ value[node]) & mask[node])
            near = far <= distance
            place, node, far = place[near], node[near], far[near]
            if not len(place):
                continue
            if depth + 1 == len(self.levels):
                yield place, node
                continue
            count = len(self.levels[depth + 1][0])
            child = (node[:, None] * _FAN + np.arange(_FAN)).ravel()
            inside = child < count
            stack.append((depth + 1, np.repeat(place, _FAN)[inside], child[inside], np.repeat(far, _FAN)[inside]))


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For links between values: (node, least value that it reaches), roots left out."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        after = label.copy()
        np.minimum.at(after, label[x], low)
        np.minimum.at(after, label[y], low)
        while True:
            jumped = after[after]
            if (jumped == after).all():
                break
            after = jumped
        if (after == label).all():
            below = label != np.arange(len(nodes))
            return nodes[below], nodes[label[below]]
        label = after


_SENT = "block int, chunk int, wanted long"
_LINKS = "a long, b long"


def links(distinct: DataFrame, tables: Written, distance: int = DISTANCE, fingerprint: str = "fingerprint") -> DataFrame:
    """(a, b): links that connect what lies within the distance, enough for components.

    ``distinct`` holds each fingerprint once.  A piece reduces what it finds to one link per
    node, which loses no connection.
    """
    spark = distinct.sparkSession
    n = distinct.count()
    blocks = min(BLOCKS, max(FEWEST_BLOCKS, -(-n // BLOCK_ROWS)))
    members = distinct.select(F.col(fingerprint).alias("member")).withColumn("rank", _gray_rank_column("member"))
    members = members.repartitionByRange(blocks, "rank").select(F.spark_partition_id().alias("block"), "member")
    members = tables(members, "blocks")
    tops = members.groupBy("block").agg(
        F.bit_and("member").alias("one"), F.bit_and(F.bitwise_not("member")).alias("zero"), F.min(_gray_rank_column("member")).alias("at")
    )
    tops = tops.orderBy("at").collect()  # one row per block, BLOCKS at most
    unsigned = lambda name: np.array([r[name] for r in tops], np.int64).view(np.uint64)
    held = spark.sparkContext.broadcast((np.array([r.block for r in tops], np.int32), unsigned("one"), unsigned("zero")))
    depth = math.ceil(math.log2(max(2, len(tops))))
    visits = min(len(tops), 1 + depth + depth * (depth - 1) // 2)
    chunks = max(1, -(-n * visits // (max(1, len(tops)) * SEARCH_ROWS)))

    def send(batches):
        names, one, zero = held.value
        tree = GrayTree(one, zero)
        for batch in batches:
            wanted = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for place, top in tree.search(wanted.view(np.uint64), distance):
                value = wanted[place]
                chunk = ((value.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(chunks)
                columns = [pa.array(names[top]), pa.array(chunk.astype(np.int32)), pa.array(value)]
                yield pa.RecordBatch.from_arrays(columns, ["block", "chunk", "wanted"])

    def meet(own: pa.Table, sent: pa.Table) -> pa.Table:
        member = own.column("member").to_numpy().astype(np.int64).view(np.uint64)
        member = member[np.argsort(gray_rank(member), kind="stable")]
        wanted = sent.column("wanted").to_numpy().astype(np.int64).view(np.uint64)
        found_a, found_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for place, node in GrayTree(member, ~member).search(wanted, distance):
            x, y = wanted[place].view(np.int64), member[node].view(np.int64)
            other = x < y  # each pair is found from both ends
            a, b = forest(np.concatenate([found_a[0], x[other]]), np.concatenate([found_b[0], y[other]]))
            found_a[0], found_b[0] = a, b
        return pa.table({"a": pa.array(found_a[0], pa.int64()), "b": pa.array(found_b[0], pa.int64())})

    sent = members.select("member").mapInArrow(send, _SENT)
    copies = members.select("block", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"), "member")
    return copies.groupBy("block", "chunk").cogroup(sent.groupBy("block", "chunk")).applyInArrow(meet, _LINKS)


def groups(documents: DataFrame, tables: Written, text: str = "text", doc_id: str = "doc_id", distance: int = DISTANCE):
    """(rows, names): rows (doc_id, key, fp) of the documents; names (fp, root, component) of
    each distinct fingerprint."""
    rows = documents.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        row_identity(f"`{doc_id}`", f"`{text}`").alias("key"),
        fingerprints(F.col(f"`{text}`").cast("string")).alias("fp"),
    )
    rows = tables(rows, "rows")
    distinct = tables(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    linked = tables(links(distinct, tables, distance, "fp"), "found")
    roots = components(linked, tables)
    named = distinct.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    named = tables(named, "named")
    least = tables(named.groupBy("root").agg(F.min("first").alias("component")), "least")
    return rows, tables(named.select("fp", "root").join(least, "root").select("fp", "root", "component"), "components")


def near_duplicates(documents: DataFrame, text: str = "text", doc_id: str = "doc_id", distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fingerprint in hex, component_id) of every document."""
    tables = Written(documents.sparkSession, "simhash")
    rows, names = groups(documents, tables, text, doc_id, distance)
    return rows.join(names, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id")
    )


def keep_first(documents: DataFrame, text: str = "text", doc_id: str = "doc_id", distance: int = DISTANCE) -> DataFrame:
    """One document of each group: the smallest doc_id; of rows that repeat it, one."""
    tables = Written(documents.sparkSession, "simhash")
    rows, names = groups(documents, tables, text, doc_id, distance)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key"))
    kept = rows.join(names, "fp").groupBy("root").agg(first.alias("f"))
    # two plain columns: the join has dealt the rows out as the last step wants them
    here = [free_name(documents, "_key"), free_name(documents, "_twin")]
    keys = tables(kept.select(*(F.col(f"f.key.{half}").alias(name) for half, name in zip("ab", here))), "kept")
    content = f"`{doc_id}`", f"`{text}`"
    keyed = documents.withColumns(dict(zip(here, (row_key(*content), twin_key(*content)))))
    return keyed.join(keys.hint("merge"), here, "left_semi").dropDuplicates(here).drop(*here)
