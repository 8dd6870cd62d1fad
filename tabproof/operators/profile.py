"""Column statistics and value distributions of a table.

The exact profile turns each row into one record per column and counts equal
values before anything is shuffled, so a hot value travels as a single record per
task. Every statistic then comes from those counts: each column is read once and only
distinct values are shuffled, however many columns the table has. Whole numbers, dates and
times travel as bit sets: 64 neighbouring values are one record whose bits say which occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabproof.contract import TableContract
from tabproof.functions.columns import comparable, is_numeric, nan_to_null, quoted, value_text

# Longer texts are compared by their SHA-256, so that documents are not shuffled whole.
# A digest has exactly this many characters, hence never equals a text kept as it is.
DIGEST_LENGTH = 64

STATISTICS = (
    "row_count", "missing_count", "unique_count", "zero_cells", "negative_cells",
    "minimum", "maximum",
)


STATISTICS_SCHEMA = (
    "position int, name string, dtype string, is_numeric boolean, in_contract boolean, "
    "is_sentinel boolean, must_be_positive boolean, row_count bigint, missing_count bigint, "
    "unique_count bigint, zero_cells bigint, negative_cells bigint, minimum double, maximum double"
)


def _numeric_value(field: T.StructField) -> Column:
    column = quoted(field.name)
    return column.cast("int") if isinstance(field.dataType, T.BooleanType) else column


WHOLE, NUMBER, TEXT = "whole", "number", "text"


def _kind(field: T.StructField) -> str:
    """In which form the values of a column are told apart."""
    kind = field.dataType
    if isinstance(kind, (T.IntegralType, T.BooleanType, T.DateType, T.TimestampType)):
        return WHOLE
    return NUMBER if isinstance(kind, (T.FloatType, T.DoubleType)) else TEXT


def _value(field: T.StructField) -> Column:
    """The cell as a bigint, a double or a text that identifies its value."""
    column, kind = quoted(field.name), field.dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("bigint")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if _kind(field) == WHOLE:
        return column.cast("bigint")
    if _kind(field) == NUMBER:
        return column.cast("double")
    if isinstance(kind, T.BinaryType):
        text = F.hex(column)
    elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        text = F.when(column.isNotNull(), value_text(comparable(column, kind).alias("value")))
    elif isinstance(kind, T.VariantType):
        text = F.to_json(column)
    else:
        text = column.cast("string")
    return F.when(F.length(text) >= DIGEST_LENGTH, F.sha2(text, 256)).otherwise(text)


#: Values that share a record: one bit each of a 64-bit number.
WORD_BITS = 6


def _records(df: DataFrame, own: list, kind: str) -> DataFrame:
    """(position, value): a record per row and column, without an array of them."""
    cells = [part for i, f in own for part in (F.lit(i), _value(f))]
    return df.select(F.stack(F.lit(len(own)), *cells).alias("position", kind))


def _whole_parts(df: DataFrame, own: list) -> DataFrame:
    """Facts per column and word of 64 values; all values of a word have one sign."""
    value = F.col(WHOLE)
    place = value.bitwiseAND(F.lit((1 << WORD_BITS) - 1)).cast("int")
    counted = _records(df, own, WHOLE).groupBy("position", F.shiftright(value, WORD_BITS).alias("word")).agg(
        F.count(F.lit(1)).alias("n"), F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), place)).alias("bits"),
        F.count_if(value == 0).alias("zeros"), F.min(value).alias("low"), F.max(value).alias("high"))
    return counted.select(
        "position", "n", F.when(F.col("word").isNull(), F.col("n")).otherwise(0).alias("missing"),
        F.coalesce(F.bit_count("bits"), F.lit(0)).cast("bigint").alias("values"), "zeros",
        F.when(F.col("word") < 0, F.col("n")).otherwise(0).alias("negatives"),
        F.col("low").cast("double").alias("low"), F.col("high").cast("double").alias("high"))


def _value_parts(df: DataFrame, own: list, kind: str) -> DataFrame:
    """Facts per column and distinct value."""
    values = _records(df, own, kind).groupBy("position", kind).agg(F.count(F.lit(1)).alias("n"))
    number = F.col(NUMBER) if kind == NUMBER else F.lit(None).cast("double")
    decimals = [i for i, f in own if isinstance(f.dataType, T.DecimalType)]
    if decimals:
        number = F.when(F.col("position").isin(decimals), F.col(TEXT).try_cast("double"))
    present = F.col(kind).isNotNull()
    n = F.col("n")
    return values.select(
        "position", "n", F.when(present, 0).otherwise(n).alias("missing"),
        present.cast("bigint").alias("values"), F.when(number == 0, n).otherwise(0).alias("zeros"),
        F.when(number < 0, n).otherwise(0).alias("negatives"), number.alias("low"), number.alias("high"))


def _exact_statistics(df: DataFrame) -> DataFrame:
    """The three kinds of value are counted apart: each reads only its own columns, and
    narrow keys of one type are much cheaper to group than keys with empty slots."""
    fields = list(enumerate(df.schema.fields))
    nothing = F.lit(0).cast("bigint")
    # One record per column with a count of zero, so that an empty table has a profile too.
    parts = df.sparkSession.range(len(fields)).select(
        F.col("id").cast("int").alias("position"),
        *[nothing.alias(c) for c in ("n", "missing", "values", "zeros", "negatives")],
        *[F.lit(None).cast("double").alias(c) for c in ("low", "high")])
    for kind in (WHOLE, NUMBER, TEXT):
        own = [(i, f) for i, f in fields if _kind(f) == kind]
        if own:
            parts = parts.unionByName(_whole_parts(df, own) if kind == WHOLE else _value_parts(df, own, kind))
    totals = ("row_count", "missing_count", "unique_count", "zero_cells", "negative_cells")
    return parts.groupBy("position").agg(
        *[F.sum(c).alias(name) for c, name in zip(("n", "missing", "values", "zeros", "negatives"), totals)],
        F.min("low").alias("minimum"), F.max("high").alias("maximum"))


def _single_row_statistics(df: DataFrame, approximate: bool) -> DataFrame:
    """Everything but exact distinct counts: one aggregate, no shuffle of table data."""
    fields = df.schema.fields
    aggregates = [F.count(F.lit(1)).alias("row_count")]
    records = []
    for i, field in enumerate(fields):
        column = quoted(field.name)
        aggregates.append(F.count_if(column.isNull()).alias(f"missing_{i}"))
        unique = F.approx_count_distinct(column) if approximate else F.max(F.lit(None).cast("bigint"))
        aggregates.append(unique.alias(f"unique_{i}"))
        if is_numeric(field.dataType):
            value = _numeric_value(field)
            aggregates += [
                F.count_if(value == 0).alias(f"zero_{i}"),
                F.count_if(value < 0).alias(f"negative_{i}"),
                F.min(value).cast("double").alias(f"minimum_{i}"),
                F.max(value).cast("double").alias(f"maximum_{i}"),
            ]
            rest = [F.col(f"{s}_{i}") for s in ("zero", "negative", "minimum", "maximum")]
        else:
            rest = [F.lit(0).cast("bigint")] * 2 + [F.lit(None).cast("double")] * 2
        parts = [F.col("row_count"), F.col(f"missing_{i}"), F.col(f"unique_{i}"), *rest]
        records.append(F.struct(
            F.lit(i).alias("position"), *[p.alias(s) for p, s in zip(parts, STATISTICS)]
        ))
    return df.agg(*aggregates).select(F.inline(F.array(*records)))


def column_statistics(
    df: DataFrame, contract: TableContract | None = None, distinct: str | None = "exact"
) -> DataFrame:
    """One row per column with counts, extremes and the contract flags of the column.

    ``distinct`` is ``"exact"``, ``"approximate"`` or ``None`` (leave it out).
    """
    if distinct not in ("exact", "approximate", None):
        raise ValueError("distinct must be 'exact', 'approximate' or None")
    df = nan_to_null(df)
    fields = df.schema.fields
    if not fields:
        return df.sparkSession.createDataFrame([], STATISTICS_SCHEMA)
    if distinct == "exact":
        statistics = _exact_statistics(df)
    else:
        statistics = _single_row_statistics(df, approximate=distinct == "approximate")

    rules = [contract.rule(f.name) if contract else None for f in fields]

    def by_position(values, kind):
        literals = F.array(*[F.lit(v).cast(kind) for v in values])
        return F.element_at(literals, F.col("position") + 1)

    numeric = by_position([is_numeric(f.dataType) for f in fields], "boolean")
    return statistics.select(
        "position",
        by_position([f.name for f in fields], "string").alias("name"),
        by_position([f.dataType.simpleString() for f in fields], "string").alias("dtype"),
        numeric.alias("is_numeric"),
        by_position([r is not None for r in rules], "boolean").alias("in_contract"),
        by_position([bool(r and r.zero_is_missing) for r in rules], "boolean").alias("is_sentinel"),
        by_position([bool(r and r.must_be_positive) for r in rules], "boolean")
        .alias("must_be_positive"),
        "row_count", "missing_count", "unique_count", "zero_cells", "negative_cells",
        F.when(numeric, F.col("minimum")).alias("minimum"),
        F.when(numeric, F.col("maximum")).alias("maximum"),
    )


def column_profile(statistics: DataFrame) -> DataFrame:
    """The published part of :func:`column_statistics`."""
    fraction = F.try_divide(F.col("missing_count").cast("double"), F.col("row_count").cast("double"))
    counted = F.col("is_numeric") & F.col("is_sentinel")
    return statistics.select(
        "position", "name", "dtype", "is_numeric", "missing_count",
        F.coalesce(fraction, F.lit(0.0)).alias("missing_fraction"),
        "unique_count",
        F.when(counted, F.col("zero_cells")).otherwise(F.lit(0).cast("bigint")).alias("zero_count"),
        "minimum", "maximum",
    )


def target_distribution(df: DataFrame, target: str) -> DataFrame:
    """Rows per distinct non-null target value, the value as double, in ascending order.

    Empty when the target is absent or not numeric.
    """
    spark = df.sparkSession
    field = next((f for f in df.schema.fields if f.name == target), None)
    if field is None or not is_numeric(field.dataType):
        return spark.createDataFrame([], "value double, n bigint")
    value = _numeric_value(field).cast("double")
    return (
        df.select(value.alias("value"))
        .where(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy("value").agg(F.count(F.lit(1)).alias("n")).orderBy("value")
    )


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """Rows per class of an outcome column."""
    return df.groupBy(quoted(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
