"""Features that arrive as one array, map or struct column per row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabproof.errors import FeatureInputError
from tabproof.functions.columns import is_numeric, quoted


def align_records(df: DataFrame, column: str, features: list[str]) -> DataFrame:
    """Spread an array, map or struct column into named feature columns.

    Other columns stay. An array of another length, or a map that lacks a feature
    key, fails the query; a struct that lacks a field fails before it runs.
    """
    kind = df.schema[column].dataType
    record = quoted(column)
    others = [quoted(name) for name in df.columns if name != column]
    if isinstance(kind, T.StructType):
        absent = [name for name in features if name not in kind.names]
        if absent:
            raise FeatureInputError(f"the record column lacks {absent}")
        return df.select(*others, *[record.getField(name).alias(name) for name in features])
    if isinstance(kind, T.ArrayType) and is_numeric(kind.elementType):
        right = F.size(record) == len(features)
        problem = F.concat(
            F.lit(f"expected {len(features)} values per record, got "), F.size(record).cast("string"))
        values = [F.get(record, F.lit(i)) for i in range(len(features))]
    elif isinstance(kind, T.MapType) and is_numeric(kind.valueType):
        keys = F.map_keys(record)
        wanted = F.array(*[F.lit(name) for name in features])
        right = F.size(F.array_except(wanted, keys)) == 0
        problem = F.concat(
            F.lit("the record lacks key(s): "),
            F.array_join(F.array_except(wanted, keys), ", "))
        values = [F.try_element_at(record, F.lit(name)) for name in features]
    else:
        raise FeatureInputError(f"cannot align a column of type {kind.simpleString()}")
    return df.select(*others, *[
        F.when(right, value).otherwise(F.raise_error(problem)).cast("double").alias(name)
        for name, value in zip(features, values)
    ])
