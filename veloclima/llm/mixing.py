"""Mixing sources to target weights by entropy balancing.

Each source gets a share of all words by its weight, at most ``MOST`` times what it has;
what is cut off is shared again by weight.  Document rates then solve

    minimise  sum r log r - r + 1   subject to  sum of rate * size = target, 0 <= r <= MOST

for the documents of each source.  The dual has one multiplier per source and the solution
is an exponential tilt, ``rate = min(MOST, exp(multiplier * size / mean size))``.  Newton
steps on the dual run as aggregates over (source, size, number of documents): the table has
one row for each size that a source has, whatever the number of documents.

Rates become copies by hash, so that reruns agree: the whole part, and one more copy with
the chance of the fraction.  Each source moves its chances by one small amount, so that its
words reach the target up to the one document that would go beyond it (with the rows that
repeat it).  What is still missing is given to a few documents per size class, largest first.

Everything is DataFrame expressions.  Documents are not shuffled while Spark can ship the
table of sources (one row per source) whole, which it checks itself.

Defined results: a null text has size 0; a null source is a source, the last one; sources
without words have target 0; repeated rows get the same number of copies; an empty table
gives an empty mix.  Input columns named like a result column are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._tables import Written, row_key

WEIGHTS = (5, 2, 1)  # by the order of sources, repeating
MOST = 3  # copies of a document, and of a source
CLOSE = 1e-9  # relative distance of a source's tilted words from its target
_PICKS = 8  # candidates for the last correction in each size class
_ONE = 1 << 52  # a chance of one
_PARTS = 1 << 11  # of the range that holds a source's edge, in each round

RESULT = ("size", "source_size", "target", "rate", "copies", "taken")


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size) -> also weight and target; the targets' sum is that of the sizes.

    With the sources ordered by the level at which they reach their limit, a source is
    limited if the level of what is left for it and those behind it lies above its own.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    listed = F.array(*(F.lit(float(w)) for w in weights))
    weighed = sources.withColumn(
        "weight", F.element_at(listed, (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    )
    limit = F.lit(float(most)) * F.col("source_size")
    by_level = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    total = F.sum("source_size").over(everything)
    levels = (
        weighed.withColumn("full_at", limit / F.col("weight"))
        .withColumn("limited", F.sum(limit).over(by_level) - limit)
        .withColumn("open_weight", F.sum("weight").over(everything) - F.sum("weight").over(by_level) + F.col("weight"))
        .withColumn("level", (total - F.col("limited")) / F.col("open_weight"))
    )
    first = F.min_by("level", F.when(F.col("level") <= F.col("full_at"), F.col("full_at"))).over(everything)
    return levels.select(
        "source",
        "source_size",
        "weight",
        F.when(F.col("source_size") == 0, F.lit(0.0))
        .otherwise(F.least(limit, F.coalesce(first, F.col("level")) * F.col("weight")))
        .alias("target"),
    )


def _rate(size: Column, most: int) -> Column:
    tilted = F.exp(F.least(F.col("multiplier") * size / F.col("mean_size"), F.lit(50.0)))
    return (
        F.when(F.col("target") >= most * F.col("source_size"), F.lit(float(most)))
        .when(size == 0, F.lit(0.0))
        .otherwise(F.least(F.lit(float(most)), tilted))
    )


def solve(sizes: DataFrame, targets: DataFrame, tables: Written, most: int = MOST) -> DataFrame:
    """One row per source with its multiplier.

    ``sizes`` holds (source, size, n), without size 0.  Each round is one aggregate over it.
    A Newton step on log(words) that leaves the bracket around the root is replaced by
    halving, so the rounds end for any sizes.
    """
    least = sizes.groupBy("source").agg(F.min("size").alias("smallest"), F.sum("n").alias("n_docs"))
    ratio = F.col("target") / F.col("source_size")
    start = F.when(ratio < 1, F.log(ratio)).otherwise(F.lit(math.log(most)))
    state = (
        targets.where("source_size > 0")
        .join(least.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("mean_size", F.col("source_size") / F.col("n_docs"))
        .withColumn("edge", start * F.col("mean_size") / F.col("smallest"))
        .select(
            "source", "source_size", "weight", "target", "mean_size",
            F.least(F.col("edge"), F.lit(0.0)).alias("low"),
            F.greatest(F.col("edge"), F.lit(0.0)).alias("high"),
            F.lit(0.0).alias("multiplier"),
        )
    )
    state, rounds = tables(state, "state0"), 0
    while True:
        tilt = F.col("multiplier") * F.col("size") / F.col("mean_size")
        free = tilt < math.log(most)
        rate = F.when(free, F.exp(tilt)).otherwise(F.lit(float(most)))
        words = F.col("n") * F.col("size") * rate
        slope = F.when(free, words * F.col("size") / F.col("mean_size")).otherwise(0.0)
        own = sizes.select(F.col("source").alias("_source"), "size", "n")
        met = (
            own.join(state, F.col("source").eqNullSafe(F.col("_source")))
            .groupBy("source", "source_size", "weight", "target", "mean_size", "low", "high", "multiplier")
            .agg(F.sum(words).alias("words"), F.sum(slope).alias("slope"))
        )
        full = F.col("target") >= most * F.col("source_size")
        far = F.when(full, F.lit(0.0)).otherwise(F.abs(F.col("words") / F.col("target") - 1))
        low = F.when(F.col("words") < F.col("target"), F.col("multiplier")).otherwise(F.col("low"))
        high = F.when(F.col("words") > F.col("target"), F.col("multiplier")).otherwise(F.col("high"))
        step = F.col("multiplier") - F.log(F.col("words") / F.col("target")) * F.col("words") / F.col("slope")
        inside = (F.col("slope") > 0) & (step > F.col("low")) & (step < F.col("high"))
        halved = (F.col("low") + F.col("high")) / 2
        stuck = (halved <= F.col("low")) | (halved >= F.col("high"))  # neighbours among doubles
        state = (
            met.withColumn("low", low)
            .withColumn("high", high)
            .withColumn("done", (far <= CLOSE) | stuck)
            .withColumn("multiplier", F.when(F.col("done"), F.col("multiplier")).when(inside, step).otherwise(halved))
            .select("source", "source_size", "weight", "target", "mean_size", "low", "high", "multiplier", "done")
        )
        rounds += 1
        state = tables(state, f"state{rounds}")
        tables.drop(f"state{rounds - 1}")
        if state.where(~F.col("done")).isEmpty():
            return state.drop("done")
        state = state.drop("done")


def _place() -> Column:
    """Where a document's fraction stands in the order of rounding up; null without a fraction.

    Below ``_ONE`` the chance alone would round it up.
    """
    chance = F.pmod(F.xxhash64(F.lit("copies"), F.col("_key")), F.lit(_ONE))
    part = F.col("rate") - F.floor("rate")
    return F.when(part > 0, chance - F.floor(part * float(_ONE)) + F.lit(_ONE))


def _copies() -> Column:
    return (F.floor("rate") + F.when(_place() < F.col("edge"), F.lit(1)).otherwise(0)).cast("long")


def rounding_edges(rows: DataFrame, tables: Written) -> DataFrame:
    """(source, edge): documents placed below the edge are rounded up; one more would be too many.

    Each round counts the words in ``_PARTS`` parts of the range that holds the edge, in
    partial aggregates, and goes on with one part, until it holds one document or one place.
    """
    whole = F.sum(F.floor("rate") * F.col("size"))
    first = rows.groupBy("source").agg((F.max("target") - whole).alias("open"))
    state = tables(first.select("source", "open", F.lit(0).cast("long").alias("edge"), F.lit(0).cast("long").alias("below")), "edge0")
    placed = rows.select(F.col("source").alias("_source"), "size", _place().alias("place")).where("place is not null")
    width, rounds = 2 * _ONE, 0
    while True:
        step = max(1, width // _PARTS)
        inside = placed.join(state, F.col("source").eqNullSafe(F.col("_source")))
        inside = inside.where((F.col("place") >= F.col("edge")) & (F.col("place") < F.col("edge") + F.lit(width)))
        part = F.floor((F.col("place") - F.col("edge")) / F.lit(float(step))).cast("long")
        sums = inside.groupBy("source", "open", "edge", "below", part.alias("part")).agg(F.sum("size").alias("words"), F.count("*").alias("n"))
        up_to = F.col("below") + F.sum("words").over(Window.partitionBy("source").orderBy("part"))
        over = sums.withColumn("up_to", up_to).where("up_to > open")
        at = F.struct((F.col("edge") + F.col("part") * F.lit(step)).alias("edge"), (F.col("up_to") - F.col("words")).alias("below"), "n")
        found = over.groupBy(F.col("source").alias("_source")).agg(F.min_by(at, "part").alias("at"))
        state = state.join(found, F.col("source").eqNullSafe(F.col("_source")), "left").select(
            "source", "open",
            F.coalesce("at.edge", F.col("edge") + F.lit(width)).alias("edge"),  # nothing is over: all are rounded up
            F.coalesce("at.below", "below").alias("below"),
            F.coalesce("at.n", F.lit(0)).alias("n"),
        )
        rounds += 1
        state = tables(state, f"edge{rounds}")
        tables.drop(f"edge{rounds - 1}")
        width = step
        if width == 1 or state.where("n > 1").isEmpty():
            return state.select("source", "edge")


def _corrections(rows: DataFrame, most: int) -> DataFrame:
    """(source, sign, moved): row keys whose copies change by one.

    Candidates are at most ``_PICKS`` documents in each power of two of sizes, found with
    partial aggregates, so a hot source sends no more than a small one.
    """
    need = rows.groupBy("source").agg((F.max("target") - F.sum(F.col("copies") * F.col("size"))).alias("need"))
    order = F.xxhash64(F.lit("picks"), F.col("_key"))
    size_class = F.floor(F.log2(F.col("size")))
    pick = F.struct("size", "_key")
    able = {1: F.col("copies") < most, -1: F.col("copies") > 0}
    picks = rows.where("size > 0").groupBy("source", size_class.alias("c"), F.pmod(order, F.lit(_PICKS)).alias("k")).agg(
        F.min_by(pick, F.when(able[1], order)).alias("up"), F.min_by(pick, F.when(able[-1], order)).alias("down")
    )
    ordered = lambda name: F.sort_array(F.collect_list(name), asc=False)  # noqa: E731  largest first; nulls are left out
    ladder = picks.groupBy("source").agg(ordered("up").alias("up"), ordered("down").alias("down"))
    steps = ladder.withColumnRenamed("source", "_source").join(need, F.col("source").eqNullSafe(F.col("_source")))
    chosen = F.expr(
        "aggregate(if(need > 0, up, down), named_struct('left', abs(need), 'moved', cast(array() as array<bigint>)),"
        " (a, x) -> if(x.size <= a.left, named_struct('left', a.left - x.size, 'moved', array_append(a.moved, x._key)), a),"
        " a -> a.moved)"
    )
    return steps.select("source", F.when(F.col("need") > 0, F.lit(1)).otherwise(F.lit(-1)).alias("sign"), chosen.alias("moved"))


def mix(
    documents: DataFrame,
    text: str = "text",
    source: str = "source",
    doc_id: str = "doc_id",
    weights=WEIGHTS,
    most: int = MOST,
) -> DataFrame:
    """The documents with size, source_size, target, rate, copies and taken (copies * size)."""
    tables = Written(documents.sparkSession, "mixing")
    kept = [c for c in documents.columns if c.lower() not in RESULT]
    sized = documents.select(
        F.struct(*(F.col(f"`{c}`") for c in kept)).alias("_row"),
        F.col(f"`{source}`").cast("string").alias("_row_source"),
        count_words(F.col(f"`{text}`").cast("string")).alias("size"),
        row_key(f"`{doc_id}`", f"`{text}`").alias("_key"),
    )
    slim = tables(sized.select(F.col("_row_source").alias("source"), "size", "_key"), "sizes")
    sizes = tables(slim.groupBy("source", "size").agg(F.count("*").alias("n")), "histogram")
    sources = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = tables(source_targets(sources, weights, most), "targets")
    solved = solve(sizes.where("size > 0"), targets, tables, most)
    solved = targets.join(
        solved.select(F.col("source").alias("_source"), "mean_size", "multiplier"),
        F.col("source").eqNullSafe(F.col("_source")),
        "left",
    ).drop("_source")
    solved = tables(solved, "solved")
    rated = (
        slim.withColumnRenamed("source", "_row_source")
        .join(solved, F.col("_row_source").eqNullSafe(F.col("source")))
        .withColumn("rate", _rate(F.col("size"), most))
    )
    edges = tables(rounding_edges(rated, tables).withColumnRenamed("source", "_source"), "edges")
    solved = tables(solved.join(edges, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source"), "edged")
    edges = edges.withColumnRenamed("_source", "_edge_source")
    rated = rated.join(edges, F.col("source").eqNullSafe(F.col("_edge_source"))).withColumn("copies", _copies())
    moves = _corrections(rated, most).withColumnRenamed("source", "_source")
    final = tables(solved.join(moves, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source"), "final")
    tables.drop("sizes", "histogram", "targets", "solved", "edges", "edged")
    moved = F.when(F.array_contains("moved", F.col("_key")), F.col("sign")).otherwise(0)
    facts = final.withColumnRenamed("source", "_source")
    mixed = sized.join(facts, F.col("_row_source").eqNullSafe(F.col("_source")))
    return (
        mixed.withColumn("rate", _rate(F.col("size"), most))
        .withColumn("copies", (_copies() + F.coalesce(moved, F.lit(0))).cast("long"))
        .withColumn("taken", F.col("copies") * F.col("size"))
        .select("_row.*", *RESULT)
    )
