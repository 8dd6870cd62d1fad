"""Strict CSV: a malformed file is an error, never a plausible-looking table.

The checks are aggregates over the raw lines and over the parsed rows, so they scale
with the cluster. A file is split across tasks, also if quoted fields hold line breaks: then
its records are put together from line ranges first (:mod:`tabproof.sources.records`).
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabproof.contract import TableContract
from tabproof.errors import SourceFormatError, SourceNotFoundError, SourceReadError
from tabproof.functions.columns import quoted
from tabproof.plans.quality import QualityReport, require_valid, validate
from tabproof.sources.digests import file_manifest
from tabproof.sources.records import csv_records

# Cells that mean "missing", as pandas documents them for read_csv.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# What a cell of each inferred type looks like.
BOOLEAN_PATTERN = r"^(true|True|TRUE|false|False|FALSE)$"
INTEGER_PATTERN = r"^\s*[+-]?[0-9]+\s*$"
FLOAT_PATTERN = r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity))\s*$"

CORRUPT = "_corrupt_record"


def _options(multi_line: bool) -> dict:
    return {
        "sep": ",", "quote": '"', "escape": '"', "encoding": "UTF-8", "multiLine": multi_line,
        "mode": "PERMISSIVE", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
    }


def fingerprint(spark: SparkSession, path: str) -> str:
    """SHA-256 of a file; of a folder, the digest of its sorted per-file digests.

    Empty when nothing can be opened there; any other failure raises. A file of any size is
    read by one task, and one task sees 64 characters per file; for very large files and
    folders there is :func:`tabproof.sources.digests.folder_digest`.
    """
    try:
        digests = file_manifest(spark, path).agg(
            F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list("sha256")).alias("all"))
        return digests.select(
            F.when(F.col("n") == 1, F.element_at("all", 1))
            .when(F.col("n") > 1, F.sha2(F.array_join("all", "\n"), 256))
            .otherwise(F.lit("")).alias("digest")
        ).first()["digest"]
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return ""
        raise SourceReadError(path, str(error)) from error
    except (PySparkException, Py4JJavaError) as error:
        raise SourceReadError(path, f"no digest of the content: {error}") from error


def _check_location(spark, path) -> None:
    try:
        files = file_manifest(spark, path, digest=False)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise SourceNotFoundError(path, "nothing exists at this location") from error
        raise SourceReadError(path, str(error)) from error
    is_csv = F.lower("path").endswith(".csv")
    facts = files.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~is_csv).alias("other"),
        F.min(F.when(~is_csv, F.col("path"))).alias("example"), F.sum("length").alias("bytes"),
    ).first()
    if facts["other"]:
        raise SourceFormatError(facts["example"], "only .csv files can be read")
    if not facts["n"]:
        raise SourceReadError(path, "the folder holds no file")
    if not facts["bytes"]:
        raise SourceReadError(path, "the file is empty")


def _check_lines(spark, path) -> bool:
    """Check encoding and quotes; True when some quoted field spans lines."""
    line = F.col("value")
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    per_file = spark.read.text(path).groupBy(F.input_file_name().alias("file")).agg(
        F.sum(quotes).alias("quotes"),
        F.count_if(quotes % 2 == 1).alias("odd_lines"),
        F.count_if(~F.is_valid_utf8(line)).alias("bad_lines"),
    )
    facts = per_file.agg(
        F.min(F.when(F.col("bad_lines") > 0, F.col("file"))).alias("not_text"),
        F.min(F.when(F.col("quotes") % 2 == 1, F.col("file"))).alias("unclosed"),
        F.sum("odd_lines").alias("odd_lines"),
    ).first()
    if facts["not_text"]:
        raise SourceReadError(facts["not_text"], "the file is not UTF-8 text")
    if facts["unclosed"]:
        raise SourceReadError(facts["unclosed"], "a quoted field is never closed")
    return bool(facts["odd_lines"])


def _names(path: str, first) -> list[str]:
    names = [name or "" for name in first] if first else []
    if not names:
        raise SourceReadError(path, "the file has no header")
    repeated = sorted({name for name in names if names.count(name) > 1})
    if repeated:
        raise SourceReadError(path, f"header name(s) repeat: {repeated}")
    return names


def _text_schema(names: list[str]) -> T.StructType:
    return T.StructType(
        [T.StructField(n, T.StringType()) for n in names] + [T.StructField(CORRUPT, T.StringType())])


def _line_rows(spark: SparkSession, path: str) -> tuple[list[str], DataFrame]:
    """Header and rows as text where every record is one line."""
    names = _names(path, spark.read.options(**_options(False)).csv(path).first())
    rows = (
        spark.read.options(**_options(False), columnNameOfCorruptRecord=CORRUPT)
        .option("header", True).option("enforceSchema", False).schema(_text_schema(names)).csv(path)
    )
    return names, rows


def _record_rows(spark: SparkSession, path: str) -> tuple[list[str], DataFrame]:
    """Header and rows as text where records may span lines."""
    records = csv_records(spark, path)
    options = {k: str(v) for k, v in _options(True).items()} | {"columnNameOfCorruptRecord": CORRUPT}

    def fields(record: Column, names: list[str]) -> Column:
        return F.from_csv(record, ", ".join(f"`{n.replace('`', '``')}` string" for n in [*names, CORRUPT]), options)

    headers = records.where("header").groupBy("record").agg(F.min("file").alias("file")).orderBy("file")
    found = headers.withColumn("width", _field_count(F.col("record"))).limit(2).collect()
    if not found:
        raise SourceReadError(path, "the file has no header")
    numbered = [f"c{i}" for i in range(max(r["width"] for r in found))]
    parsed = [
        [cell or "" for cell in row[:found[i]["width"]]] for i, row in enumerate(
            headers.limit(2).select(fields(F.col("record"), numbered).alias("f")).select("f.*").collect())]
    names = _names(path, parsed[0])
    if any(other != names for other in parsed):
        raise SourceReadError(found[1]["file"], "the header differs from that of other files")
    return names, records.where("NOT header").select(fields(F.col("record"), names).alias("f")).select("f.*")


def _cell(name: str) -> Column:
    """The text of a cell, null when it is one of the missing tokens."""
    return F.when(~quoted(name).isin(*MISSING_TOKENS), quoted(name))


def _field_count(record: Column) -> Column:
    unquoted = F.regexp_replace(record, '"[^"]*"', "")
    return F.length(unquoted) - F.length(F.replace(unquoted, F.lit(","), F.lit(""))) + 1


def read_strict_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read a CSV file, or a folder of CSV parts with the same header, as a typed table.

    Rows with too many fields, unclosed quotes, repeated header names and text that is
    not UTF-8 raise; short rows are padded with nulls. A column is bigint, double or
    boolean when all its present cells are, and string otherwise.
    """
    _check_location(spark, path)
    names, rows = (_record_rows if _check_lines(spark, path) else _line_rows)(spark, path)

    checks = [F.count_if(_field_count(F.col(CORRUPT)) > len(names)).alias("long_rows")]
    for i, name in enumerate(names):
        cell = _cell(name)
        whole = cell.rlike(INTEGER_PATTERN) & F.trim(cell).try_cast("bigint").isNotNull()
        checks.append(F.struct(
            F.count(cell).alias("present"),
            F.count_if(whole).alias("bigint"),
            F.count_if(cell.rlike(FLOAT_PATTERN)).alias("double"),
            F.count_if(cell.rlike(BOOLEAN_PATTERN)).alias("boolean"),
        ).alias(f"c{i}"))
    try:
        facts = rows.agg(*checks).first()
    except (PySparkException, Py4JJavaError) as error:
        raise SourceReadError(path, f"malformed CSV: {error}") from error
    if facts["long_rows"]:
        raise SourceReadError(
            path, f"{facts['long_rows']} row(s) hold more values than the header declares")

    def typed(i, name):
        seen = facts[f"c{i}"]
        if not seen["present"]:
            kind = "double"  # a column without any value is numeric to the validator
        else:
            kind = next((k for k in ("bigint", "double", "boolean") if seen[k] == seen["present"]), None)
        cell = _cell(name)
        return (F.trim(cell).cast(kind) if kind else cell).alias(name)

    return rows.select(*[typed(i, name) for i, name in enumerate(names)])


def load_and_validate(
    spark: SparkSession, path: str, contract: TableContract
) -> tuple[DataFrame, QualityReport]:
    """The table and its report. Findings are returned, not raised."""
    df = read_strict_csv(spark, path)
    return df, validate(df, contract, source=path)


def load_training_table(
    spark: SparkSession, path: str, contract: TableContract
) -> tuple[DataFrame, str]:
    """The table and its fingerprint; a fatal finding raises with the whole report."""
    df = read_strict_csv(spark, path)
    return require_valid(df, contract, source=path), fingerprint(spark, path)
