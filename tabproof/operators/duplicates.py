"""Surplus copies of identical rows, without shuffling whole rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabproof.functions.columns import comparable, distinct_names, nan_to_null, quoted, value_text


def _cell(field: T.StructField):
    """A cell as it is compared: one zero, binary as hexadecimal, maps in order."""
    column, kind = quoted(field.name), field.dataType
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return column + F.lit(0.0).cast(kind)
    return F.hex(column) if isinstance(kind, T.BinaryType) else comparable(column, kind)


def duplicate_rows(df: DataFrame) -> DataFrame:
    """One row, ``duplicate_count``: rows beyond the first of each identical group.

    Null equals null, and maps are equal whatever the order of their entries. Rows are told
    apart by a 256-bit digest of all their values, so 32 bytes travel per distinct row.
    Copies meet before the shuffle: one row copied a billion times is one record per task.
    """
    df = nan_to_null(distinct_names(df))
    if not df.columns:
        return df.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("duplicate_count"))
    cells = [_cell(f).alias(f"c{i}") for i, f in enumerate(df.schema.fields)]
    groups = df.select(F.unhex(F.sha2(value_text(*cells), 256)).alias("row")).groupBy("row").agg(
        F.count(F.lit(1)).alias("copies"))
    return groups.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).cast("bigint").alias("duplicate_count"))
