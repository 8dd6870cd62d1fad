"""Seeded, stratified train/test split with exact sizes.

Every row gets a hash of seed and row id; per class, the rows with the smallest
hashes are held out. The cut-off hash of a class is found by counting, first over
coarse hash ranges and then only inside the range that contains it, so the split
itself is a filter expression: no window over a class, no shuffle of the table, and
the same answer whenever a partition is computed again.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabproof.errors import SplitError
from tabproof.functions.columns import nan_to_null, quoted

TRAIN, TEST = "train", "test"

# Default seed and held-out share.
DEFAULT_SEED = 42
DEFAULT_TEST_SIZE = 0.2

# Hash digits examined per counting pass: 4096 ranges per class.
DIGITS_PER_PASS = 3
# A hash range with at most this many rows is ordered to find the exact cut-off.
ORDERED_ROWS = 100_000
HASH_DIGITS = 32

# Labels of rows that cannot be placed in a class.
NO_TARGET, ODD_TARGET = -1, -2


@dataclass(frozen=True)
class SplitPlan:
    """Where each class is cut: few numbers, independent of the table size.

    ``cutoffs`` maps a class to the last held-out (hash, row id...) in hash order.
    """

    target: str
    row_id: tuple[str, ...]
    seed: int
    test_size: float
    class_counts: dict
    test_quotas: dict
    cutoffs: dict

    @property
    def rows(self) -> int:
        return sum(self.class_counts.values())

    @property
    def test_rows(self) -> int:
        return sum(self.test_quotas.values())

    @property
    def train_rows(self) -> int:
        return self.rows - self.test_rows

    @property
    def realised_test_size(self) -> float:
        return self.test_rows / self.rows


def row_hash(seed: int, row_id) -> Column:
    """Hex MD5 of seed and row id; any SQL engine can compute the same value."""
    parts = [F.coalesce(quoted(name).cast("string"), F.lit("")) for name in row_id]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))


def with_row_id(df: DataFrame, name: str = "row_id", copies_per_task: int = 1_000_000) -> DataFrame:
    """Add a row id derived from content, for tables without a key.

    Identical rows are interchangeable, so they are counted, not collected, and
    numbered when they are written out again. The numbering of a heavily copied row
    is spread over many tasks. The id is the same in every run.
    """
    df = nan_to_null(df)
    columns = [quoted(c) for c in df.columns]
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("__copies"))
    one, step = F.lit(1).cast("bigint"), F.lit(copies_per_task).cast("bigint")
    numbered = counted.where(F.col("__copies") <= step).withColumn(
        "__copy", F.explode(F.sequence(one, F.col("__copies"))))
    # One record may stand for billions of copies: spread chunks of it, then expand.
    starts = F.sequence(one, F.col("__copies"), step)
    heavy = (
        counted.where(F.col("__copies") > step).withColumn("__start", F.explode(starts))
        .repartition(*columns, "__start")
    )
    end = F.least(F.col("__copies"), F.col("__start") + step - 1)
    heavy = heavy.withColumn("__copy", F.explode(F.sequence("__start", end))).drop("__start")
    numbered = numbered.unionByName(heavy)
    content = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    return numbered.select(
        F.sha2(F.concat_ws(":", F.col("__copy").cast("string"), content), 256).alias(name), *columns)


def class_quotas(class_counts: dict, test_size: float) -> dict:
    """Held-out rows per class: exact total, largest remainders on the train side.

    Equal remainders go to the smaller class value.
    """
    rows = sum(class_counts.values())
    held_out = math.ceil(rows * test_size)
    train = rows - held_out
    quotas = {c: train * n // rows for c, n in class_counts.items()}
    by_remainder = sorted(class_counts, key=lambda c: (-(train * class_counts[c] % rows), c))
    for c in by_remainder[: train - sum(quotas.values())]:
        quotas[c] += 1
    return {c: n - quotas[c] for c, n in class_counts.items()}


def _check_stratifiable(class_counts, test_size) -> None:
    for marker, problem in ((NO_TARGET, "no target value"), (ODD_TARGET, "a target other than 0 or 1")):
        if class_counts.get(marker):
            raise SplitError(f"{class_counts[marker]} row(s) have {problem}")
    rarest = min(class_counts.values(), default=0)
    if rarest < 2:
        raise SplitError(f"the rarest class has {rarest} row(s); each class needs at least 2")
    rows = sum(class_counts.values())
    held_out = math.ceil(rows * test_size)
    for side, size in ((TEST, held_out), (TRAIN, rows - held_out)):
        if size < len(class_counts):
            raise SplitError(f"{size} {side} row(s) cannot cover {len(class_counts)} classes")


def _in_range(label: Column, hash_: Column, prefixes: dict) -> Column:
    tests = [(label == F.lit(c)) & hash_.startswith(p) for c, p in prefixes.items()]
    return reduce(lambda a, b: a | b, tests)


def plan_split(
    df: DataFrame, target: str, row_id, test_size: float = DEFAULT_TEST_SIZE,
    seed: int = DEFAULT_SEED, ordered_rows: int = ORDERED_ROWS,
) -> SplitPlan:
    """Find the cut-offs. Each pass reads only the target and the row id.

    ``row_id`` must identify a row; ids shared by rows on both sides of a cut-off
    would break the exact sizes and raise.
    """
    if not 0.0 < test_size < 1.0:
        raise SplitError(f"test_size must lie strictly between 0 and 1, got {test_size}")
    row_id = (row_id,) if isinstance(row_id, str) else tuple(row_id)
    absent = [name for name in (target, *row_id) if name not in df.columns]
    if absent:
        raise SplitError(f"column(s) not present: {absent}")
    keys = nan_to_null(df.select(quoted(target), *[quoted(n) for n in row_id if n != target]))
    value = quoted(target).cast("double")
    # Four labels at most, whatever the column holds: the counts stay small.
    label = F.when(value.isNull(), NO_TARGET).when(value.isin(0.0, 1.0), value.cast("int"))
    hashed = keys.select(
        label.otherwise(ODD_TARGET).alias("label"), row_hash(seed, row_id).alias("hash"),
        F.struct(*[quoted(name) for name in row_id]).alias("id"),
    )
    label, hash_ = F.col("label"), F.col("hash")

    def histogram(rows, digits):
        counted = rows.groupBy("label", F.substring(hash_, 1, digits).alias("prefix"))
        return counted.agg(F.count(F.lit(1)).alias("n")).collect()

    first = histogram(hashed, DIGITS_PER_PASS)
    class_counts = {}
    for row in first:
        class_counts[row["label"]] = class_counts.get(row["label"], 0) + row["n"]
    _check_stratifiable(class_counts, test_size)
    quotas = class_quotas(class_counts, test_size)

    wanted = {c: n for c, n in quotas.items() if n > 0}
    prefixes, digits, buckets = {}, DIGITS_PER_PASS, first
    open_classes = set(wanted)
    while open_classes:
        sizes = {}
        for row in sorted((r for r in buckets if r["label"] in open_classes), key=lambda r: r["prefix"]):
            c = row["label"]
            if c in sizes:
                continue
            if wanted[c] <= row["n"]:
                prefixes[c], sizes[c] = row["prefix"], row["n"]
            else:
                wanted[c] -= row["n"]
        open_classes = {c for c in open_classes if sizes[c] > ordered_rows}
        if not open_classes:
            break
        if digits >= HASH_DIGITS:
            raise SplitError(f"{list(row_id)} does not identify rows: one id covers many rows")
        digits = min(HASH_DIGITS, digits + DIGITS_PER_PASS)
        inside = _in_range(label, hash_, {c: prefixes[c] for c in open_classes})
        buckets = histogram(hashed.where(inside), digits)

    cutoffs = _find_cutoffs(hashed, prefixes, wanted, row_id) if wanted else {}
    return SplitPlan(target, row_id, seed, test_size, class_counts, quotas, cutoffs)


def _find_cutoffs(hashed, prefixes, wanted, row_id) -> dict:
    """Order the few rows of each boundary range and take the last held-out one."""
    label, hash_ = F.col("label"), F.col("hash")
    order = Window.partitionBy("label").orderBy("hash", "id")
    boundary = hashed.where(_in_range(label, hash_, prefixes)).select(
        "label", "hash", "id",
        F.row_number().over(order).alias("position"),
        F.lead("hash").over(order).alias("next_hash"), F.lead("id").over(order).alias("next_id"),
    )
    at_cut = reduce(
        lambda a, b: a | b,
        [(label == F.lit(c)) & (F.col("position") == n) for c, n in wanted.items()],
    )
    cutoffs = {}
    for row in boundary.where(at_cut).collect():
        if row["hash"] == row["next_hash"] and row["id"] == row["next_id"]:
            raise SplitError(f"{list(row_id)} does not identify rows: {tuple(row['id'])} repeats")
        cutoffs[row["label"]] = (row["hash"], tuple(row["id"]))
    return cutoffs


def assign_partition(df: DataFrame, plan: SplitPlan, name: str = "partition") -> DataFrame:
    """Add the ``train``/``test`` column. A narrow projection of the table."""
    if name in df.columns:
        raise SplitError(f"the table already has a column '{name}'")
    hash_ = row_hash(plan.seed, plan.row_id)
    held_out = F.lit(False)
    for value, (cut_hash, cut_id) in plan.cutoffs.items():
        same = F.struct(*[quoted(n) for n in plan.row_id]) <= F.struct(*[
            F.lit(v).cast(df.schema[n].dataType).alias(n) for n, v in zip(plan.row_id, cut_id)
        ])
        before = (hash_ < cut_hash) | ((hash_ == cut_hash) & same)
        in_class = quoted(plan.target).cast("double") == F.lit(float(value))
        held_out = F.when(in_class, before).otherwise(held_out)
    return df.withColumn(name, F.when(held_out, TEST).otherwise(TRAIN))


def stratified_split(
    df: DataFrame, target: str, row_id, test_size: float = DEFAULT_TEST_SIZE,
    seed: int = DEFAULT_SEED,
) -> DataFrame:
    """The table with a ``partition`` column; features and target stay in one row."""
    return assign_partition(df, plan_split(df, target, row_id, test_size, seed))


def partition_sizes(split: DataFrame) -> DataFrame:
    return split.groupBy("partition").agg(F.count(F.lit(1)).alias("n"))


def class_balance(split: DataFrame, target: str) -> DataFrame:
    """Rows per partition and class."""
    return split.groupBy("partition", quoted(target).alias("label")).agg(F.count(F.lit(1)).alias("n"))


def take_partition(df: DataFrame, members: DataFrame, row_id) -> tuple[DataFrame, DataFrame]:
    """Divide a table by a list of row ids: (rows listed, rows not listed)."""
    row_id = [row_id] if isinstance(row_id, str) else list(row_id)
    ids = members.select(*[quoted(name) for name in row_id])
    return df.join(ids, row_id, "left_semi"), df.join(ids, row_id, "left_anti")


def check_split(df: DataFrame, split: DataFrame, row_id) -> DataFrame:
    """One row: ids on both sides, input rows lost, rows added. All zero when sound."""
    row_id = [row_id] if isinstance(row_id, str) else list(row_id)
    ids = [quoted(name) for name in row_id]

    def tally(frame, given, train, test):
        flags = zip(("__given", "__train", "__test"), (given, train, test))
        return frame.select(*ids, *[F.expr(e).cast("bigint").alias(n) for n, e in flags])

    sides = tally(split, "0", f"partition = '{TRAIN}'", f"partition = '{TEST}'")
    per_id = tally(df, "1", "0", "0").unionByName(sides).groupBy(*ids).agg(
        F.sum("__given").alias("given"), F.sum("__train").alias("train"),
        F.sum("__test").alias("test"),
    ).select("given", "train", "test", (F.col("train") + F.col("test")).alias("kept"))
    return per_id.agg(
        F.count_if((F.col("train") > 0) & (F.col("test") > 0)).alias("overlap"),
        F.coalesce(F.sum(F.greatest(F.col("given") - F.col("kept"), F.lit(0))), F.lit(0)).alias("lost"),
        F.coalesce(F.sum(F.greatest(F.col("kept") - F.col("given"), F.lit(0))), F.lit(0)).alias("added"),
    )
