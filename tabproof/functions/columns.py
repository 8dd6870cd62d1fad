"""Column expressions shared by the operators; all of them stay inside Catalyst."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_numeric(data_type: T.DataType) -> bool:
    """Numbers and booleans; dates, strings and nested types are not numeric."""
    return isinstance(data_type, (T.NumericType, T.BooleanType))


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into null in every float column, so that one notion of missing is left."""
    floating = (T.FloatType, T.DoubleType)
    if not any(isinstance(f.dataType, floating) for f in df.schema.fields):
        return df
    return df.select([
        F.when(~F.isnan(quoted(f.name)), quoted(f.name)).alias(f.name)
        if isinstance(f.dataType, floating) else quoted(f.name)
        for f in df.schema.fields
    ])


def _has_own_order(data_type: T.DataType) -> bool:
    if isinstance(data_type, (T.MapType, T.VariantType)):
        return False
    if isinstance(data_type, T.ArrayType):
        return _has_own_order(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return all(_has_own_order(f.dataType) for f in data_type.fields)
    return True


def comparable(column: Column, data_type: T.DataType) -> Column:
    """The value in a form that can be compared: maps as sorted entries, variants as JSON.

    Equal maps become equal whatever the order of their entries.
    """
    if _has_own_order(data_type):
        return column
    if isinstance(data_type, T.VariantType):
        return F.to_json(column)
    if isinstance(data_type, T.ArrayType):
        return F.transform(column, lambda x: comparable(x, data_type.elementType))
    if isinstance(data_type, T.StructType):
        fields = [comparable(column.getField(f.name), f.dataType).alias(f.name) for f in data_type.fields]
        return F.when(column.isNotNull(), F.struct(*fields))
    entries = F.transform(F.map_entries(column), lambda e: F.struct(
        comparable(e["key"], data_type.keyType).alias("key"),
        comparable(e["value"], data_type.valueType).alias("value")))
    return F.array_sort(entries)


def value_text(*columns: Column) -> Column:
    """Comparable values as one text that differs where they do."""
    return F.to_json(F.struct(*columns), {
        "ignoreNullFields": "false",
        "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
        "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    })


def distinct_names(df: DataFrame) -> DataFrame:
    """The same table; a repeated column name gets its place behind it, as in ``x#2``."""
    names: list[str] = []
    for name in df.columns:
        new, n = name, 1
        while new in names:
            n += 1
            new = f"{name}#{n}"
        names.append(new)
    return df if names == df.columns else df.toDF(*names)


def quoted(name: str) -> Column:
    """Column by its exact name, also when the name holds dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_finite(column: Column) -> Column:
    """True for ordinary numbers; false for null, NaN and both infinities."""
    value = column.cast("double")
    return F.coalesce(~F.isnan(value) & (F.abs(value) != F.lit(float("inf"))), F.lit(False))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Ratio as double, null where the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def number_text(column: Column) -> Column:
    """Integral doubles without the ``.0``; every other value as it is."""
    value = column.cast("double")
    whole = (value == F.floor(value)) & (F.abs(value) < F.lit(1e18))
    return F.when(whole, value.cast("bigint").cast("string")).otherwise(value.cast("string"))


def metric_text(column: Column) -> Column:
    """A metric cell: four decimals, ``n/a`` where the metric is undefined."""
    value = column.cast("double")
    return F.when(value.isNull(), F.lit("n/a")).otherwise(F.format_string("%.4f", value))


def share_text(part: Column, total: Column) -> Column:
    """Share of a total as a percentage with one decimal, ``n/a`` on a zero total."""
    share = safe_ratio(part * 100, total)
    return F.when(share.isNull(), F.lit("n/a")).otherwise(F.format_string("%.1f%%", share))


def json_text(*columns) -> Column:
    """The columns as one JSON object; nulls stay visible."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
