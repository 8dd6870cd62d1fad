"""Connected components of an edge table too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabproof.llm.spool import spool


def connected_components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """``node, component`` for every node of an edge; ``component`` is its smallest node.

    ``edges`` has two columns of one ordered type, in any direction; loops and repeats are
    allowed, edges with a null end are not edges. Large-star and small-star steps take
    turns until nothing moves: each hangs neighbours on the smallest node around them, so
    the number of rounds grows with the logarithm of the longest path. Minima are combined
    before the shuffle, and no list of neighbours is ever built. Each round is written to
    the shared folder, in few files when it is small, as no round has more edges than the
    one before; the driver sees one checksum per round.
    """
    a, b = edges.columns
    now = spool(
        edges.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("u"))
        .where(F.col("u").isNotNull() & F.col("v").isNotNull() & F.col(a).isNotNull()
               & F.col(b).isNotNull()).distinct(), purpose)
    seen = None
    while (mark := _mark(now)) != seen:
        seen = mark
        now = spool(_small_star(_large_star(now)), purpose, most=mark[0])
    parents = now.where("u != v").select(F.col("v").alias("node"), F.col("u").alias("component"))
    roots = now.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()
    loops = now.where("u = v").select(F.col("v").alias("node"), F.col("u").alias("component"))
    return parents.unionByName(roots).unionByName(loops).distinct()


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("hub")).agg(F.min("v").alias("m"))
    least = least.select("hub", F.least("hub", "m").alias("m"))
    return (both.where("v > u").join(least, F.col("u") == F.col("hub"))
            .select(F.col("m").alias("u"), "v").unionByName(edges.where("u = v").select("u", "v"))
            .distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy(F.col("v").alias("hub")).agg(F.min("u").alias("m"))
    moved = edges.join(least, F.col("v") == F.col("hub")).select(F.col("m").alias("u"), F.col("u").alias("v"))
    kept = least.select(F.col("m").alias("u"), F.col("hub").alias("v"))
    return moved.where("u != v").unionByName(kept).distinct()
