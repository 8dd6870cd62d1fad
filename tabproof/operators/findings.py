"""Coded findings of a contract check, computed as a query over the column statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabproof.contract import TARGET_VALUES, TableContract
from tabproof.functions.columns import is_numeric, number_text

ERROR, WARNING = "error", "warning"

# The stable finding codes and their severities.
SEVERITIES = {
    "EMPTY_DATASET": ERROR,
    "MISSING_REQUIRED_COLUMN": ERROR,
    "UNEXPECTED_TARGET_COLUMN": ERROR,
    "UNEXPECTED_COLUMN": WARNING,
    "NON_NUMERIC_FEATURE": ERROR,
    "NON_BINARY_TARGET": ERROR,
    "MISSING_VALUES": WARNING,
    "COLUMN_WITHOUT_USABLE_VALUES": ERROR,
    "COLUMN_WITHOUT_USABLE_MEASUREMENTS": ERROR,
    "ZERO_SENTINEL_VALUE": WARNING,
    "NEGATIVE_VALUE": ERROR,
    "NON_POSITIVE_VALUE": ERROR,
    "DUPLICATE_ROW": WARNING,
}

SCHEMA = "ordinal int, code string, severity string, column string, count bigint, message string"

# Findings a single column can have, in the order in which they are reported.
COLUMN_SLOTS = 5


def _finding(ordinal, code, message, column=None, count=None):
    text = F.lit(message) if isinstance(message, str) else message
    name = F.lit(column) if column is None or isinstance(column, str) else column
    number = F.lit(None) if count is None else count
    return F.struct(
        (F.lit(ordinal) if isinstance(ordinal, int) else ordinal).cast("int").alias("ordinal"),
        F.lit(code).alias("code"),
        F.lit(SEVERITIES[code]).alias("severity"),
        name.cast("string").alias("column"),
        number.cast("bigint").alias("count"),
        text.alias("message"),
    )


def _emit(df: DataFrame, conditional) -> DataFrame:
    """Rows for those (condition, finding) pairs whose condition holds."""
    found = F.array_compact(F.array(*[F.when(test, finding) for test, finding in conditional]))
    return df.select(F.inline(found))


def _structure_findings(df: DataFrame, contract: TableContract):
    """Findings that follow from the column names alone, in report order."""
    found = [
        ("MISSING_REQUIRED_COLUMN", name, f"The contract requires column '{name}'; it is absent.")
        for name in contract.missing_from(df.columns)
    ]
    target = contract.target.name
    if target not in df.columns:
        aliases = contract.target_aliases_in(df.columns)
        hint = f" Possible misspelling: {', '.join(aliases)}. Rename it explicitly." if aliases else ""
        found.append((
            "UNEXPECTED_TARGET_COLUMN", target, f"No outcome column called '{target}'.{hint}",
        ))
    found += [
        ("UNEXPECTED_COLUMN", name, f"Column '{name}' is unknown to the contract and may leak.")
        for name in contract.unexpected_in(df.columns)
    ]
    return found


def _column_findings(statistics, df, contract: TableContract) -> DataFrame:
    structure = _structure_findings(df, contract)
    first_row, has_rows = F.col("position") == 0, F.col("row_count") > 0
    pairs = [(
        first_row & ~has_rows,
        _finding(1, "EMPTY_DATASET", "The table has no rows or no columns.", count=F.col("row_count")),
    )]
    pairs += [
        (first_row & has_rows, _finding(1 + i, code, message, column))
        for i, (code, column, message) in enumerate(structure)
    ]

    base = 1 + max(1, len(structure))
    slot = F.lit(base) + F.col("position") * COLUMN_SLOTS
    name, missing, zeros = F.col("name"), F.col("missing_count"), F.col("zero_cells")
    negatives = F.col("negative_cells")
    usable = F.col("row_count") - missing
    checked = has_rows & F.col("in_contract")
    measured = checked & F.col("is_numeric")
    placeholder = measured & F.col("is_sentinel") & (zeros > 0)

    def about(count, text):
        return F.concat(F.lit("Column '"), name, F.lit("': "), count.cast("string"), F.lit(" " + text))

    pairs += [
        (
            (missing > 0) & (missing == F.col("row_count")),
            _finding(slot, "COLUMN_WITHOUT_USABLE_VALUES",
                     about(missing, "null cell(s) and nothing else."), name, missing),
        ),
        (
            (missing > 0) & (missing < F.col("row_count")),
            _finding(slot, "MISSING_VALUES", about(missing, "null cell(s)."), name, missing),
        ),
        (
            checked & ~F.col("is_numeric"),
            _finding(slot + 1, "NON_NUMERIC_FEATURE",
                     F.concat(F.lit("Column '"), name, F.lit("' must be numeric, is "), "dtype"), name),
        ),
        (
            placeholder & (zeros == usable),
            _finding(slot + 2, "COLUMN_WITHOUT_USABLE_MEASUREMENTS",
                     about(zeros, "placeholder zero(s) and no measurement."), name, zeros),
        ),
        (
            placeholder & (zeros < usable),
            _finding(slot + 2, "ZERO_SENTINEL_VALUE",
                     about(zeros, "zero(s) that mean 'not recorded'."), name, zeros),
        ),
        (
            measured & (negatives > 0),
            _finding(slot + 3, "NEGATIVE_VALUE",
                     about(negatives, "negative value(s), impossible here."), name, negatives),
        ),
        (
            measured & F.col("must_be_positive") & (zeros > 0),
            _finding(slot + 4, "NON_POSITIVE_VALUE",
                     about(zeros, "zero(s) where only positive values are possible."), name, zeros),
        ),
    ]

    last = base + COLUMN_SLOTS * len(df.columns)
    target = next((f for f in df.schema.fields if f.name == contract.target.name), None)
    if target is not None and not is_numeric(target.dataType):
        pairs.append((first_row & has_rows, _finding(
            last, "NON_NUMERIC_FEATURE",
            f"Outcome '{target.name}' must be numeric, is {target.dataType.simpleString()}",
            target.name,
        )))
    return _emit(statistics, pairs)


def unexpected_target_values(distribution: DataFrame) -> DataFrame:
    """Target values outside the two classes, ascending, with their rendered text."""
    return (
        distribution.where(~F.col("value").isin(*TARGET_VALUES))
        .select("value", number_text(F.col("value")).alias("value_text"), "n")
        .orderBy("value")
    )


def _target_findings(distribution, df, contract: TableContract) -> DataFrame:
    odd = distribution.where(~F.col("value").isin(*TARGET_VALUES))
    totals = odd.agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("distinct"),
        F.min("value").alias("low"), F.max("value").alias("high"),
    ).where("distinct > 0")
    name = contract.target.name
    # The values themselves are rows of unexpected_target_values.
    message = F.concat(
        F.lit(f"Outcome '{name}' may hold only 0 and 1, also holds "),
        F.when(F.col("distinct") == 1, number_text(F.col("low"))).otherwise(F.concat(
            F.col("distinct").cast("string"), F.lit(" other values from "), number_text(F.col("low")),
            F.lit(" to "), number_text(F.col("high")))),
        F.lit("."),
    )
    structure = len(_structure_findings(df, contract))
    last = 1 + max(1, structure) + COLUMN_SLOTS * len(df.columns)
    finding = _finding(last, "NON_BINARY_TARGET", message, name, F.col("n"))
    return totals.select(F.inline(F.array(finding)))


def _duplicate_findings(duplicates: DataFrame) -> DataFrame:
    count = F.col("duplicate_count")
    message = F.concat(count.cast("string"), F.lit(" row(s) repeat an earlier row."))
    return _emit(duplicates, [(count > 0, _finding(0, "DUPLICATE_ROW", message, count=count))])


def table_findings(
    df: DataFrame, contract: TableContract, statistics: DataFrame, distribution: DataFrame,
    duplicates: DataFrame | None = None,
) -> DataFrame:
    """All findings; sort by ``ordinal`` for report order.

    Order: duplicates, structure, then per column in table order, then the target.
    """
    if df.columns:
        found = _column_findings(statistics, df, contract)
    else:
        found = df.sparkSession.range(1).select(F.inline(F.array(_finding(
            1, "EMPTY_DATASET", "The table has no rows or no columns.", count=F.lit(0)))))
    if contract.target.name in df.columns:
        found = found.unionByName(_target_findings(distribution, df, contract))
    if duplicates is not None:
        found = found.unionByName(_duplicate_findings(duplicates))
    return found


def finding_counts(findings: DataFrame) -> DataFrame:
    """Findings per code."""
    return findings.groupBy("code").agg(F.count(F.lit(1)).alias("n"))


def finding_text(findings: DataFrame) -> DataFrame:
    """Each finding as one line: severity, code, column, count and message."""
    column = F.when(F.col("column").isNotNull(), F.concat(F.lit(" ["), "column", F.lit("]")))
    count = F.when(F.col("count").isNotNull(), F.concat(F.lit(" (n="), F.col("count"), F.lit(")")))
    line = F.concat(
        F.lit("["), F.upper("severity"), F.lit("] "), F.col("code"),
        F.coalesce(column, F.lit("")), F.coalesce(count, F.lit("")), F.lit(": "), F.col("message"),
    )
    return findings.select("ordinal", line.alias("text"))
