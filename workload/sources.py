"""Strict CSV reading and file digests, on CSV copies of the given tables."""

from pyspark.sql import functions as F

from tabproof.contract import ColumnRule, TableContract
from tabproof.sources.csv import (
    file_manifest, load_and_validate, load_training_table, read_strict_csv,
)
from tabproof.sources.digests import file_digests
from tabproof.sources.shared import shared_folder
from workload.tables import table


def _as_csv(spark, sf_dir, name, df=None):
    folder = shared_folder(spark, f"{name}-csv")
    (df if df is not None else table(spark, sf_dir, name)).write.options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    ).csv(folder)
    return folder


def csv_strict(spark, sf_dir):
    return read_strict_csv(spark, _as_csv(spark, sf_dir, "part")).withColumn(
        "p_size", F.col("p_size").cast("bigint"))


CSV_STRICT_SQL = """
    SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size, p_retailprice FROM part
"""


def csv_missing_tokens(spark, sf_dir):
    """Missing-value spellings in two columns, read back as nulls."""
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_acctbal") < 0, "NA").otherwise(F.col("c_acctbal").cast("string"))
        .alias("c_acctbal"),
        F.when(F.col("c_mktsegment") == "BUILDING", "n/a").otherwise(F.col("c_mktsegment"))
        .alias("c_mktsegment"),
    )
    return read_strict_csv(spark, _as_csv(spark, sf_dir, "customer", customer))


CSV_MISSING_SQL = """
    SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal,
           nullif(c_mktsegment, 'BUILDING') AS c_mktsegment
    FROM customer
"""


def csv_documents(spark, sf_dir):
    """Whole texts with quotes and line breaks."""
    return read_strict_csv(spark, _as_csv(spark, sf_dir, "documents"))


CSV_DOCUMENTS_SQL = "SELECT doc_id, text, lang, source, n_chars FROM documents"


def csv_types(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn(
        "is_final", (F.col("o_orderstatus") == "F"))
    contract = TableContract(
        (ColumnRule("o_orderkey", "int"), ColumnRule("o_custkey", "int"), ColumnRule("o_totalprice")),
        ColumnRule("is_final"))
    _, report = load_and_validate(spark, _as_csv(spark, sf_dir, "orders", orders), contract)
    return report.column_profile.select("name", "dtype", "unique_count", "minimum", "maximum")


CSV_TYPES_SQL = """
    SELECT 'o_orderkey' AS name, 'bigint' AS dtype, count(DISTINCT o_orderkey)::BIGINT AS unique_count,
           min(o_orderkey)::DOUBLE AS minimum, max(o_orderkey)::DOUBLE AS maximum FROM orders
    UNION ALL SELECT 'o_custkey', 'bigint', count(DISTINCT o_custkey), min(o_custkey), max(o_custkey) FROM orders
    UNION ALL SELECT 'o_orderstatus', 'string', count(DISTINCT o_orderstatus), NULL, NULL FROM orders
    UNION ALL SELECT 'o_totalprice', 'double', count(DISTINCT o_totalprice), min(o_totalprice), max(o_totalprice) FROM orders
    UNION ALL SELECT 'o_orderdate', 'string', count(DISTINCT o_orderdate), NULL, NULL FROM orders
    UNION ALL SELECT 'o_orderpriority', 'string', count(DISTINCT o_orderpriority), NULL, NULL FROM orders
    UNION ALL SELECT 'is_final', 'boolean', count(DISTINCT o_orderstatus = 'F'),
                     min(CAST(o_orderstatus = 'F' AS INTEGER)), max(CAST(o_orderstatus = 'F' AS INTEGER)) FROM orders
"""


def csv_training_table(spark, sf_dir):
    """A table that passes its contract, with the length of its fingerprint."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice",
        (F.col("o_orderstatus") == "F").cast("int").alias("is_final"))
    contract = TableContract(
        (ColumnRule("o_custkey", "int"), ColumnRule("o_totalprice", must_be_positive=True)),
        ColumnRule("is_final", "int"))
    df, digest = load_training_table(spark, _as_csv(spark, sf_dir, "orders", orders), contract)
    return df.withColumn("digest_length", F.lit(len(digest)))


CSV_TRAINING_SQL = """
    SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderstatus = 'F' AS BIGINT) AS is_final,
           CAST(64 AS INTEGER) AS digest_length
    FROM orders
"""


def manifest(spark, sf_dir):
    return file_manifest(spark, f"{sf_dir}/lineitem.parquet")


def file_digest(spark, sf_dir):
    """Block digest and SHA-256 of text files, one per year of orders; small blocks, so that
    there are several levels."""
    orders = table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").alias("year"), "o_orderkey",
        F.concat_ws("|", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority").alias("line"))
    folder = shared_folder(spark, "orders-text")
    orders.repartition("year").sortWithinPartitions("year", "o_orderkey").select("year", "line").write.partitionBy(
        "year").text(folder)
    found = file_digests(spark, folder, block=4096, fanout=4).join(
        file_manifest(spark, folder).select("path", "sha256"), "path")
    year = F.regexp_extract("path", r"/year=(\d+)/", 1).cast("int")
    return found.select(year.alias("year"), "length", "digest", "sha256")


FILE_DIGEST_SQL = """
    WITH RECURSIVE f AS (
        SELECT year(o_orderdate) AS year, string_agg(concat_ws('|', o_orderkey, o_custkey, o_orderstatus,
               o_orderpriority) || chr(10), '' ORDER BY o_orderkey) AS content
        FROM orders GROUP BY 1
    ), n AS (
        SELECT year, i AS place, sha256(substr(content, i * 4096 + 1, 4096)) AS digest,
               CAST(ceil(length(content) / 4096) AS BIGINT) AS nodes
        FROM (SELECT *, unnest(range(0, CAST(ceil(length(content) / 4096) AS BIGINT))) AS i FROM f)
    ), t AS (
        SELECT * FROM n
        UNION ALL
        SELECT year, place // 4, sha256(string_agg(digest, '' ORDER BY place)), (max(nodes) + 3) // 4
        FROM t WHERE nodes > 1 GROUP BY year, place // 4
    )
    SELECT CAST(year AS INTEGER) AS year, CAST(length(content) AS BIGINT) AS length, digest,
           sha256(content) AS sha256
    FROM t JOIN f USING (year) WHERE nodes = 1
"""


QUERIES = {
    "csv_strict": csv_strict,
    "csv_missing_tokens": csv_missing_tokens,
    "csv_documents": csv_documents,
    "csv_types": csv_types,
    "csv_training_table": csv_training_table,
    "file_manifest": manifest,
    "file_digest": file_digest,
}

ORACLES = {
    "csv_strict": CSV_STRICT_SQL,
    "csv_missing_tokens": CSV_MISSING_SQL,
    "csv_documents": CSV_DOCUMENTS_SQL,
    "csv_types": CSV_TYPES_SQL,
    "csv_training_table": CSV_TRAINING_SQL,
    "file_digest": FILE_DIGEST_SQL,
}
