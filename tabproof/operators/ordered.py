"""Running counts in descending score order, over any number of distinct scores.

A single ordered window would run in one task. Here scores are cut into ranges of similar
counts; each range is ordered by itself, and a small table of range totals supplies what
lies above it. The range edges are plain numbers in the plan, so a lost
task recomputes to the same result without anything being kept in memory.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabproof.operators.quantile import fine_cell

# Ranges per shuffle partition, so that unequal ranges even out.
RANGES_PER_PARTITION = 4


def cell_facts(score: Column) -> list[Column]:
    """Aggregate expressions that :func:`range_edges` needs per coarse cell."""
    return [F.count(score).alias("n"), F.min(score).alias("low"), F.max(score).alias("high")]


def range_edges(df: DataFrame, score: Column, cells: list) -> list[float]:
    """Ascending values that cut the rows into similar shares.

    ``cells`` are rows of :func:`cell_facts` by coarse cell. A cell above the wanted share
    is counted again in finer cells, until none is left but those of a single value. Counts
    meet before the shuffle; the driver gets a few numbers per range.
    """
    cells = sorted((c["low"], c["high"], c["n"]) for c in cells if c["n"])
    ranges = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) * RANGES_PER_PARTITION)
    share = max(1, -(-sum(n for _, _, n in cells) // ranges))
    while heavy := [c for c in cells if c[2] > share and c[0] < c[1]]:
        cells = sorted([c for c in cells if c not in set(heavy)] + _finer(df, score, heavy, share))
    edges, filled = [], 0
    for low, _, n in cells:
        if filled and filled + n > share:
            edges.append(low)
            filled = 0
        filled += n
    return edges


def _finer(df: DataFrame, score: Column, heavy: list[tuple], share: int) -> list[tuple]:
    """Bounds and counts of the finer cells of ``heavy``, at most a few per range."""
    known = df.sparkSession.createDataFrame(
        [(float(i + 1), low, high, max(16, 4 * -(-n // share))) for i, (low, high, n) in enumerate(heavy)],
        "__cell double, __low double, __high double, __parts int")
    rows = df.select(score.alias("__score")).where(F.col("__score").isNotNull())
    splits = [-math.inf, *(low for low, _, _ in heavy), math.inf]
    placed = Bucketizer(splits=splits, inputCol="__score", outputCol="__cell").transform(rows)
    inside = placed.join(F.broadcast(known), "__cell").where("__score <= __high")
    part = fine_cell(F.col("__score"), F.col("__low"), F.col("__high"), F.col("__parts"))
    counted = inside.groupBy("__cell", part.alias("__part")).agg(*cell_facts(F.col("__score")))
    return [(r["low"], r["high"], r["n"]) for r in counted.collect()]


def score_counts(df: DataFrame, label: Column, score: Column, by=()) -> DataFrame:
    """Positives and negatives per distinct score; equal scores meet before the shuffle."""
    positive = label.cast("bigint")
    rows = df.select(
        *[F.col(c) for c in by], score.alias("score"), positive.alias("positive"))
    # Scores are never null here; saying so lets both uses of the counts share a shuffle.
    return rows.where("score is not null").groupBy(*by, "score").agg(
        F.sum("positive").alias("pos"), F.sum(1 - F.col("positive")).alias("neg"))


def running_counts(counts: DataFrame, edges: list[float] | None, by=()) -> DataFrame:
    """Add to each (score, pos, neg) row what lies at or above its score.

    New columns: ``cum_pos``, ``cum_neg`` (inclusive), ``next_pos``, ``next_neg`` (the
    counts of the next lower score, null at the lowest) and ``all_pos``, ``all_neg``.
    """
    by = list(by)
    inner = sorted(set(edges or []))
    if inner:
        bucketizer = Bucketizer(
            splits=[-math.inf, *inner, math.inf], inputCol="score", outputCol="__range")
        ranged = bucketizer.transform(counts)
    else:
        ranged = counts.withColumn("__range", F.lit(0.0))

    totals = ranged.groupBy(*by, "__range").agg(
        F.sum("pos").alias("range_pos"), F.sum("neg").alias("range_neg"),
        F.max_by(F.struct("pos", "neg"), "score").alias("top"),
    )
    # A row per group and range from here to the join.
    downwards = Window.partitionBy(*by, F.lit(0)).orderBy(F.desc("__range"))
    above = downwards.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(*by, F.lit(0))
    offsets = totals.select(
        *[F.col(c).alias(f"__{c}") for c in by], F.col("__range").alias("__offset_range"),
        F.coalesce(F.sum("range_pos").over(above), F.lit(0)).alias("above_pos"),
        F.coalesce(F.sum("range_neg").over(above), F.lit(0)).alias("above_neg"),
        F.lead("top").over(downwards).alias("next_top"),
        F.sum("range_pos").over(everything).alias("all_pos"),
        F.sum("range_neg").over(everything).alias("all_neg"),
    )
    inside = Window.partitionBy(*by, "__range").orderBy(F.desc("score"))
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    same = F.col("__range") == F.col("__offset_range")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return ranged.join(offsets, same).select(
        *by, "score", "pos", "neg",
        (F.sum("pos").over(upto) + F.col("above_pos")).alias("cum_pos"),
        (F.sum("neg").over(upto) + F.col("above_neg")).alias("cum_neg"),
        F.coalesce(F.lead("pos").over(inside), F.col("next_top.pos")).alias("next_pos"),
        F.coalesce(F.lead("neg").over(inside), F.col("next_top.neg")).alias("next_neg"),
        "all_pos", "all_neg",
    )
