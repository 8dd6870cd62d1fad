"""Exact medians and modes of many columns, at any size.

Spark's exact ``median`` keeps a value-to-count map of the whole column in one task. Here a
quantile sketch proposes bounds around the middle: every lane of tasks makes its own, and
the lanes' sketches meet per column. One counting scan proves the bounds, as it counts what
lies below them, and cuts what lies inside into ordered cells of which the one with the
wanted rank is picked by Spark. Usually that settles it; a crowded cell is cut again. Where
the proof fails, or the bounds are too far apart to be cut evenly, cells by sign and
magnitude start the search anew. The result is exact whatever the sketch says.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabproof.functions.columns import quoted

# Cells per sign by magnitude, some thirty for each doubling, and least and most of equal width.
COARSE_CELLS = 1 << 16
FINE_CELLS = 4096
MOST_CELLS = 1 << 16
# Size of a sketch, what it may be off in rank as a share with room to spare, and lanes.
SKETCH_SIZE = 2048
SKETCH_SLACK = 0.005
SKETCH_LANES = 64


def coarse_cell(value: Column) -> Column:
    """Number of the cell of a double, ascending with the value."""
    doublings = F.least(F.log2(F.abs(value)), F.lit(1024.0)) + 1075
    level = F.floor(doublings * (COARSE_CELLS / 2100)).cast("int") + 1
    return F.when(value == 0, 0).when(value > 0, level).otherwise(-level)


def fine_cell(value: Column, low: Column, high: Column, cells: Column) -> Column:
    """Number of the equal-width cell of a value between two bounds, ascending with it."""
    return F.least(F.floor((value - low) / (high - low) * cells), cells - 1).cast("int")


@dataclass
class MedianSearch:
    """The middle values of one column. ``below`` values are known to lie under ``low``;
    without bounds the search starts from cells by magnitude."""

    position: int
    count: int
    minimum: float | None = None
    maximum: float | None = None
    low: float | None = None
    high: float | None = None
    median: float | None = None

    @property
    def ranks(self) -> tuple[int, int]:
        return (self.count - 1) // 2, self.count // 2

    def bound(self, low: float, high: float) -> None:
        """Search between two values from now on, if their distance is a number."""
        self.low, self.high = (low, high) if math.isfinite(high - low) else (None, None)

    def cell(self, value: Column) -> Column:
        """Cell of a value, ascending; -1 below the bounds, null above them."""
        if self.low is None:
            return F.when(value.isNotNull(), coarse_cell(value))
        if self.low == self.high:
            inside = F.lit(0)
        else:
            cells = min(max(FINE_CELLS, int(8 * SKETCH_SLACK * self.count)), MOST_CELLS)
            inside = fine_cell(value, F.lit(self.low), F.lit(self.high), F.lit(cells))
        return F.when(value < self.low, -1).when(value <= self.high, inside)

    def settle(self, found: list) -> None:
        """``found`` are the cells with the middle ranks, in order: one or two."""
        low_rank, high_rank = self.ranks
        inside = [c for c in found if self.low is None or c["cell"] >= 0]
        if len(inside) < len(found) or not inside or inside[-1]["before"] + inside[-1]["n"] <= high_rank:
            self.low = self.high = None  # the bounds miss a middle rank
            return
        first, last = inside[0], inside[-1]
        lower = self._value(first, low_rank)
        upper = self._value(last, high_rank)
        if lower is None or upper is None:
            self.bound(first["low"], last["high"])
            return
        self.median = (lower + 0.0) if low_rank == high_rank else (lower + upper) / 2

    @staticmethod
    def _value(cell, rank: int) -> float | None:
        """The value at a rank if the ends of its cell tell it."""
        if cell["low"] == cell["high"] or rank == cell["before"]:
            return cell["low"]
        return cell["high"] if rank == cell["before"] + cell["n"] - 1 else None


def propose_medians(df: DataFrame, columns: list[str]) -> list[MedianSearch]:
    """A search per column with its number of values, extremes and proposed bounds.

    One scan. A task's sketch goes to one of some lanes, a lane's to its column; the driver
    gets five numbers per column.
    """
    if not columns:
        return []
    df = _doubles(df, columns)
    facts = [[F.kll_sketch_agg_double(f"v{i}", F.lit(SKETCH_SIZE)).alias("sketch"), F.count(f"v{i}").alias("n"),
              F.min(f"v{i}").alias("low"), F.max(f"v{i}").alias("high")] for i in range(len(columns))]
    names = ("sketch", "n", "low", "high")
    lanes = df.groupBy((F.spark_partition_id() % SKETCH_LANES).alias("lane")).agg(
        *[fact.alias(f"{name}{i}") for i, own in enumerate(facts) for name, fact in zip(names, own)])
    by_column = lanes.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("position"), *[F.col(f"{n}{i}").alias(n) for n in names])
        for i in range(len(columns))])))
    merged = by_column.where("n > 0").groupBy("position").agg(
        F.kll_merge_agg_double("sketch").alias("sketch"), F.sum("n").alias("n"),
        F.min("low").alias("minimum"), F.max("high").alias("maximum"))
    found = merged.select(
        "position", "n", "minimum", "maximum",
        F.kll_sketch_get_quantile_double("sketch", F.lit(0.5 - SKETCH_SLACK)).alias("low"),
        F.kll_sketch_get_quantile_double("sketch", F.lit(0.5 + SKETCH_SLACK)).alias("high"),
    ).collect()
    searches = {i: MedianSearch(i, 0) for i in range(len(columns))}
    for row in found:
        search = searches[row["position"]] = MedianSearch(
            row["position"], row["n"], row["minimum"], row["maximum"])
        search.bound(row["low"], row["high"])
    return list(searches.values())


def settle_medians(df: DataFrame, columns: list[str], searches: list[MedianSearch]) -> list[float | None]:
    """The exact medians of searches made by :func:`propose_medians` over the same rows.

    A round is one scan for all columns that are open; the driver gets the cells of the
    middle ranks, two per column at most.
    """
    df = _doubles(df, columns)
    while pending := [s for s in searches if s.count and s.median is None]:
        picked: dict[int, list] = {}
        for row in _middle_cells(df, pending):
            picked.setdefault(row["g"], []).append(row)
        for search in pending:
            search.settle(sorted(picked.get(search.position, []), key=lambda r: r["cell"]))
    return [s.median for s in searches]


def exact_medians(df: DataFrame, columns: list[str]) -> list[float | None]:
    """Median of each column over its non-null values; None for a column without any.

    With an even number of values it is the mean of the two middle ones.
    """
    return settle_medians(df, columns, propose_medians(df, columns))


def _doubles(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns as ``v0``, ``v1`` and so on; NaN is no value."""
    values = [quoted(name).cast("double") for name in columns]
    return df.select([F.when(~F.isnan(v), v).alias(f"v{i}") for i, v in enumerate(values)])


def _middle_cells(df: DataFrame, searches: list[MedianSearch]) -> list:
    """Rows ``g, cell, before, n, low, high`` of the cells that hold the middle ranks."""
    records = []
    for search in searches:
        value = F.col(f"v{search.position}")
        records += [F.lit(search.position), search.cell(value).cast("int"), value]
    cells = df.select(F.stack(F.lit(len(searches)), *records).alias("g", "cell", "value")).where(
        "cell IS NOT NULL").groupBy("g", "cell").agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
    below = Window.partitionBy("g").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    ranks = df.sparkSession.createDataFrame(
        [(s.position, *s.ranks) for s in searches], "g int, low_rank bigint, high_rank bigint")
    placed = cells.withColumn("before", F.coalesce(F.sum("n").over(below), F.lit(0)))
    return placed.join(F.broadcast(ranks), "g").where(
        "before <= high_rank AND before + n > low_rank").select("g", "cell", "before", "n", "low", "high").collect()


def exact_modes(df: DataFrame, columns: list[str]) -> list[float | None]:
    """Most frequent non-null value of each column, the smallest one among ties."""
    if not columns:
        return []
    cells = F.array(*[
        F.struct(F.lit(i).alias("position"), quoted(name).cast("double").alias("value"))
        for i, name in enumerate(columns)
    ])
    counted = (
        df.select(F.inline(cells)).where("value is not null")
        .groupBy("position", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    best = counted.groupBy("position").agg(
        F.max_by("value", F.struct(F.col("n"), -F.col("value"))).alias("value"))
    found = {row["position"]: row["value"] for row in best.collect()}
    return [found.get(i) for i in range(len(columns))]
