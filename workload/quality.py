"""Profiles, findings, duplicates and distributions."""

from pyspark.sql import functions as F

from tabproof.operators.duplicates import duplicate_rows
from tabproof.operators.findings import unexpected_target_values
from tabproof.operators.profile import class_distribution, target_distribution
from tabproof.plans.quality import validate
from tabproof.sources.shared import shared_folder
from workload.tables import (
    CUSTOMER, CUSTOMER_SQL, LINEITEM, LINEITEM_SQL, customer, lineitem, table,
)


def column_profile(spark, sf_dir):
    return validate(lineitem(spark, sf_dir), LINEITEM).column_profile


def _profile_sql():
    columns = [
        ("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
        ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
        ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"),
        ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz"), ("returned", "int"),
    ]
    parts = []
    for i, (name, kind) in enumerate(columns):
        numeric = kind in ("bigint", "int", "double")
        zero = f"count(*) FILTER ({name} = 0)" if name in LINEITEM.sentinel_names else "0"
        low, high = (f"min({name})", f"max({name})") if numeric else ("NULL", "NULL")
        parts.append(f"""
            SELECT CAST({i} AS INTEGER) AS position, '{name}' AS name, '{kind}' AS dtype,
                   {str(numeric).lower()} AS is_numeric,
                   CAST(count(*) - count({name}) AS BIGINT) AS missing_count,
                   coalesce((count(*) - count({name})) / nullif(count(*), 0), 0.0)::DOUBLE AS missing_fraction,
                   CAST(count(DISTINCT {name}) AS BIGINT) AS unique_count,
                   CAST({zero} AS BIGINT) AS zero_count,
                   CAST({low} AS DOUBLE) AS minimum, CAST({high} AS DOUBLE) AS maximum
            FROM t""")
    return f"WITH t AS ({LINEITEM_SQL})" + " UNION ALL ".join(parts)


def table_profile(spark, sf_dir):
    profile = validate(customer(spark, sf_dir), CUSTOMER).table_profile
    return profile.select(
        "row_count", "column_count", F.array_join("column_names", ",").alias("column_names"),
        "duplicate_count", "missing_cells", "is_valid")


TABLE_PROFILE_SQL = f"""
    WITH t AS ({CUSTOMER_SQL}),
    d AS (SELECT count(*) AS n FROM (SELECT DISTINCT * FROM t))
    SELECT CAST((SELECT count(*) FROM t) AS BIGINT) AS row_count,
           CAST(8 AS INTEGER) AS column_count,
           'c_custkey,c_name,c_nationkey,balance,unmeasured,empty,c_mktsegment,segment' AS column_names,
           CAST((SELECT count(*) FROM t) - (SELECT n FROM d) AS BIGINT) AS duplicate_count,
           CAST((SELECT 2 * count(*) - count(c_nationkey) - count(empty) FROM t) AS BIGINT) AS missing_cells,
           FALSE AS is_valid
"""


def issues(spark, sf_dir):
    found = validate(customer(spark, sf_dir), CUSTOMER).issues
    return found.select("ordinal", "code", "severity", "column", "count")


# Ordinals: duplicates, two structure findings, then five slots per column.
ISSUES_SQL = f"""
    WITH t AS ({CUSTOMER_SQL}),
    f AS (
        SELECT 0 AS ordinal, 'DUPLICATE_ROW' AS code, 'warning' AS severity, NULL AS "column",
               (SELECT count(*) FROM t) - (SELECT count(*) FROM (SELECT DISTINCT * FROM t)) AS "count"
        UNION ALL SELECT 1, 'MISSING_REQUIRED_COLUMN', 'error', 'credit_limit', NULL
        UNION ALL SELECT 2, 'UNEXPECTED_COLUMN', 'warning', 'c_mktsegment', NULL
        UNION ALL SELECT 3 + 5 * 1 + 1, 'NON_NUMERIC_FEATURE', 'error', 'c_name', NULL
        UNION ALL SELECT 3 + 5 * 2, 'MISSING_VALUES', 'warning', 'c_nationkey',
                         count(*) FILTER (c_nationkey IS NULL) FROM t
        UNION ALL SELECT 3 + 5 * 2 + 2, 'ZERO_SENTINEL_VALUE', 'warning', 'c_nationkey',
                         count(*) FILTER (c_nationkey = 0) FROM t
        UNION ALL SELECT 3 + 5 * 3 + 3, 'NEGATIVE_VALUE', 'error', 'balance',
                         count(*) FILTER (balance < 0) FROM t
        UNION ALL SELECT 3 + 5 * 3 + 4, 'NON_POSITIVE_VALUE', 'error', 'balance',
                         count(*) FILTER (balance = 0) FROM t
        UNION ALL SELECT 3 + 5 * 4 + 2, 'COLUMN_WITHOUT_USABLE_MEASUREMENTS', 'error', 'unmeasured',
                         count(*) FILTER (unmeasured = 0) FROM t
        UNION ALL SELECT 3 + 5 * 5, 'COLUMN_WITHOUT_USABLE_VALUES', 'error', 'empty',
                         count(*) FILTER (empty IS NULL) FROM t
        UNION ALL SELECT 3 + 5 * 8, 'NON_BINARY_TARGET', 'error', 'segment',
                         count(*) FILTER (segment NOT IN (0, 1)) FROM t
    )
    SELECT CAST(ordinal AS INTEGER) AS ordinal, code, severity, "column", CAST("count" AS BIGINT) AS "count"
    FROM f WHERE "count" IS NULL OR "count" > 0
"""


def issue_counts(spark, sf_dir):
    return validate(customer(spark, sf_dir), CUSTOMER).issue_counts


ISSUE_COUNTS_SQL = (
    f"SELECT code, CAST(count(*) AS BIGINT) AS n FROM ({ISSUES_SQL}) GROUP BY code")


def issue_text(spark, sf_dir):
    return validate(lineitem(spark, sf_dir), LINEITEM).issue_text


# Seven columns are outside the contract, so column findings start at ordinal 8.
ISSUE_TEXT_SQL = f"""
    WITH t AS ({LINEITEM_SQL}),
    u AS (SELECT * FROM (VALUES (1, 'l_orderkey'), (2, 'l_partkey'), (3, 'l_suppkey'),
              (4, 'l_linenumber'), (5, 'l_returnflag'), (6, 'l_linestatus'), (7, 'l_shipdate')
          ) AS v(ordinal, name)),
    z AS (SELECT 6 AS position, 'l_discount' AS name, count(*) FILTER (l_discount = 0) AS n FROM t
          UNION ALL SELECT 7, 'l_tax', count(*) FILTER (l_tax = 0) FROM t),
    d AS (SELECT (SELECT count(*) FROM t) - (SELECT count(*) FROM (SELECT DISTINCT * FROM t)) AS n)
    SELECT CAST(ordinal AS INTEGER) AS ordinal,
           '[WARNING] UNEXPECTED_COLUMN [' || name || ']: Column ''' || name
           || ''' is unknown to the contract and may leak.' AS text
    FROM u
    UNION ALL
    SELECT CAST(8 + 5 * position + 2 AS INTEGER),
           '[WARNING] ZERO_SENTINEL_VALUE [' || name || '] (n=' || n || '): Column ''' || name
           || ''': ' || n || ' zero(s) that mean ''not recorded''.'
    FROM z WHERE n > 0
    UNION ALL
    SELECT 0, '[WARNING] DUPLICATE_ROW (n=' || n || '): ' || n || ' row(s) repeat an earlier row.'
    FROM d WHERE n > 0
"""


def zero_counts(spark, sf_dir):
    return validate(lineitem(spark, sf_dir), LINEITEM).zero_counts


ZERO_COUNTS_SQL = """
    SELECT 'l_discount' AS name, CAST(count(*) FILTER (l_discount = 0) AS BIGINT) AS zero_count FROM lineitem
    UNION ALL
    SELECT 'l_tax', CAST(count(*) FILTER (l_tax = 0) AS BIGINT) FROM lineitem
"""


def duplicates(spark, sf_dir):
    return duplicate_rows(table(spark, sf_dir, "documents").select("text", "lang"))


DUPLICATES_SQL = """
    SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS duplicate_count
    FROM (SELECT count(*) AS c FROM documents GROUP BY text, lang)
"""


def duplicates_lineitem(spark, sf_dir):
    keys = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return duplicate_rows(keys)


DUPLICATES_LINEITEM_SQL = """
    SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS duplicate_count
    FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber)
"""


def quality_distribution(spark, sf_dir):
    return target_distribution(table(spark, sf_dir, "labels"), "quality")


QUALITY_DISTRIBUTION_SQL = """
    SELECT CAST(quality AS DOUBLE) AS value, CAST(count(*) AS BIGINT) AS n
    FROM labels WHERE quality IS NOT NULL GROUP BY quality
"""


def unexpected_values(spark, sf_dir):
    return unexpected_target_values(target_distribution(table(spark, sf_dir, "embeddings"), "label"))


UNEXPECTED_VALUES_SQL = """
    SELECT CAST(label AS DOUBLE) AS value, CAST(label AS VARCHAR) AS value_text,
           CAST(count(*) AS BIGINT) AS n
    FROM embeddings WHERE label NOT IN (0, 1) GROUP BY label ORDER BY label
"""


def returned_distribution(spark, sf_dir):
    return class_distribution(lineitem(spark, sf_dir), "returned")


RETURNED_DISTRIBUTION_SQL = (
    f"SELECT returned AS label, CAST(count(*) AS BIGINT) AS n FROM ({LINEITEM_SQL}) GROUP BY returned")


def report_json(spark, sf_dir):
    """The report written as JSON files and read back."""
    folder = shared_folder(spark, "report")
    validate(lineitem(spark, sf_dir), LINEITEM, source="lineitem").write_json(folder)
    lines = spark.read.schema(
        "position int, name string, dtype string, is_numeric boolean, missing_count bigint, "
        "missing_fraction double, unique_count bigint, zero_count bigint, minimum double, "
        "maximum double"
    ).json(f"{folder}/column_profile")
    return lines


QUERIES = {
    "column_profile": column_profile,
    "table_profile": table_profile,
    "issues": issues,
    "issue_counts": issue_counts,
    "issue_text": issue_text,
    "zero_counts": zero_counts,
    "duplicate_rows": duplicates,
    "duplicate_keys": duplicates_lineitem,
    "target_distribution": quality_distribution,
    "unexpected_target_values": unexpected_values,
    "class_distribution": returned_distribution,
    "report_json": report_json,
}

ORACLES = {
    "column_profile": _profile_sql(),
    "table_profile": TABLE_PROFILE_SQL,
    "issues": ISSUES_SQL,
    "issue_counts": ISSUE_COUNTS_SQL,
    "issue_text": ISSUE_TEXT_SQL,
    "zero_counts": ZERO_COUNTS_SQL,
    "duplicate_rows": DUPLICATES_SQL,
    "duplicate_keys": DUPLICATES_LINEITEM_SQL,
    "target_distribution": QUALITY_DISTRIBUTION_SQL,
    "unexpected_target_values": UNEXPECTED_VALUES_SQL,
    "class_distribution": RETURNED_DISTRIBUTION_SQL,
    "report_json": _profile_sql(),
}
