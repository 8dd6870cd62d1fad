"""The whole contract check of a table, as one report of DataFrames."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabproof.contract import TableContract
from tabproof.errors import InvalidTableError
from tabproof.functions.columns import distinct_names, json_text, number_text
from tabproof.operators.duplicates import duplicate_rows
from tabproof.operators.findings import (
    ERROR, SCHEMA, WARNING, finding_counts, finding_text, table_findings,
)
from tabproof.operators.profile import (
    STATISTICS_SCHEMA, column_profile, column_statistics, target_distribution,
)


@dataclass
class QualityReport:
    """The parts of a report, each a DataFrame that runs only when it is used.

    The column statistics are one row per column. They are computed once and kept as
    such; profile, findings and facts derive from them without another scan. Rows of
    the table are never fetched.
    """

    df: DataFrame = field(repr=False)
    contract: TableContract
    source: str | None = None
    distinct: str | None = "exact"
    count_duplicates: bool = True

    @cached_property
    def statistics(self) -> DataFrame:
        rows = column_statistics(self.df, self.contract, self.distinct).collect()
        return self.df.sparkSession.createDataFrame(rows, STATISTICS_SCHEMA)

    @cached_property
    def column_profile(self) -> DataFrame:
        return column_profile(self.statistics)

    @cached_property
    def target_distribution(self) -> DataFrame:
        return target_distribution(self.df, self.contract.target.name)

    @cached_property
    def duplicates(self) -> DataFrame | None:
        return duplicate_rows(self.df) if self.count_duplicates else None

    @cached_property
    def issues(self) -> DataFrame:
        return table_findings(
            self.df, self.contract, self.statistics, self.target_distribution, self.duplicates
        )

    @cached_property
    def issue_rows(self) -> list[dict]:
        return [row.asDict() for row in self.issues.orderBy("ordinal").collect()]

    @cached_property
    def column_rows(self) -> list[dict]:
        return [row.asDict() for row in self.column_profile.orderBy("position").collect()]

    @property
    def errors(self) -> list[dict]:
        return [row for row in self.issue_rows if row["severity"] == ERROR]

    @property
    def warnings(self) -> list[dict]:
        return [row for row in self.issue_rows if row["severity"] == WARNING]

    @property
    def is_valid(self) -> bool:
        return not self.errors

    @property
    def has_warnings(self) -> bool:
        return bool(self.warnings)

    @property
    def issue_counts(self) -> DataFrame:
        return finding_counts(self.issues)

    @property
    def issue_text(self) -> DataFrame:
        return finding_text(self.issues)

    def column(self, name: str) -> dict | None:
        """Profile of one column, or None when the table has no such column."""
        return next((row for row in self.column_rows if row["name"] == name), None)

    @property
    def zero_counts(self) -> DataFrame:
        """Zeros per numeric sentinel column."""
        judged = F.col("is_numeric") & F.col("is_sentinel") & (F.col("row_count") > 0)
        return self.statistics.where(judged).select("name", F.col("zero_cells").alias("zero_count"))

    @cached_property
    def table_profile(self) -> DataFrame:
        """One row of table facts."""
        spark = self.df.sparkSession
        columns = self.column_rows
        row_count = self.statistics.agg(F.max("row_count").alias("row_count")) if columns else (
            spark.range(1).select(F.lit(0).cast("bigint").alias("row_count")))
        n_duplicates = self.duplicates.first()["duplicate_count"] if self.count_duplicates else None
        return row_count.select(
            F.lit(self.source).cast("string").alias("source"),
            "row_count",
            F.lit(len(self.df.columns)).alias("column_count"),
            F.array(*[F.lit(name) for name in self.df.columns]).cast("array<string>")
            .alias("column_names"),
            F.lit(n_duplicates).cast("bigint").alias("duplicate_count"),
            F.lit(sum(row["missing_count"] for row in columns)).cast("bigint").alias("missing_cells"),
            F.lit(self.is_valid).alias("is_valid"),
        )

    def raise_for_errors(self) -> "QualityReport":
        """The same report, or an error that carries it."""
        if self.errors:
            raise InvalidTableError(self, self.errors)
        return self

    def write_json(self, path: str, mode: str = "error") -> None:
        """Write every part as JSON below ``path``; nulls stay visible."""
        spark = self.df.sparkSession
        parts = {
            "table_profile": self.table_profile,
            "column_profile": spark.createDataFrame(self.column_rows, self.column_profile.schema),
            "target_distribution": self.target_distribution.select(
                number_text(F.col("value")).alias("value"), "n"),
            "issues": spark.createDataFrame(self.issue_rows, SCHEMA),
        }
        for name, part in parts.items():
            text = part.select(json_text(*[F.col(c) for c in part.columns]).alias("value"))
            text.write.mode(mode).text(f"{path}/{name}")


def validate(
    df: DataFrame, contract: TableContract, source: str | None = None,
    distinct: str | None = "exact",
) -> QualityReport:
    """Check a table against its contract. Never raises for a data fault.

    Columns after the first of a name are reported as ``name#2`` and so on.
    """
    return QualityReport(distinct_names(df), contract, source, distinct)


def require_valid(df: DataFrame, contract: TableContract, source: str | None = None) -> DataFrame:
    """The same table, or an error when a fatal finding exists.

    Distinct values and duplicate rows never make a table unusable, so this gate
    leaves both out: one aggregate without a shuffle of table data. The report in
    the error still computes the full findings.
    """
    gate = QualityReport(df, contract, source, distinct=None, count_duplicates=False)
    if gate.errors:
        raise InvalidTableError(validate(df, contract, source), gate.errors)
    return df
