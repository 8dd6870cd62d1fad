"""Tables and contracts the registered queries run on."""

from pyspark.sql import functions as F

from tabproof.contract import ColumnRule, TableContract

LINEITEM = TableContract(
    features=(
        ColumnRule("l_quantity", must_be_positive=True),
        ColumnRule("l_extendedprice"),
        ColumnRule("l_discount", zero_is_missing=True),
        ColumnRule("l_tax", zero_is_missing=True),
    ),
    target=ColumnRule("returned", "int"),
)

CUSTOMER = TableContract(
    features=(
        ColumnRule("c_custkey", "int"),
        ColumnRule("c_name"),
        ColumnRule("c_nationkey", "int", zero_is_missing=True),
        ColumnRule("balance", must_be_positive=True),
        ColumnRule("unmeasured", zero_is_missing=True),
        ColumnRule("empty"),
        ColumnRule("credit_limit"),
    ),
    target=ColumnRule("segment", "int"),
)

EVENTS = TableContract(
    features=(ColumnRule("user_id", "int"), ColumnRule("value", zero_is_missing=True)),
    target=ColumnRule("purchase", "int"),
)

DOCUMENTS = TableContract(
    features=(
        ColumnRule("n_chars", "int"),
        ColumnRule("n_words", "int"),
        ColumnRule("n_lines", "int"),
        ColumnRule("n_digits", "int", zero_is_missing=True),
        ColumnRule("n_stops", "int"),
    ),
    target=ColumnRule("quality", "int"),
)


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lineitem(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").withColumn(
        "returned", (F.col("l_returnflag") == "R").cast("int"))


LINEITEM_SQL = "SELECT *, CAST(l_returnflag = 'R' AS INTEGER) AS returned FROM lineitem"


def customer(spark, sf_dir):
    """Every customer twice, with faults of every kind."""
    once = table(spark, sf_dir, "customer").select(
        "c_custkey",
        "c_name",
        F.when(F.col("c_nationkey") != 7, F.col("c_nationkey")).alias("c_nationkey"),
        F.when(F.abs("c_acctbal") < 1000, 0.0).otherwise(F.col("c_acctbal")).alias("balance"),
        F.lit(0.0).alias("unmeasured"),
        F.lit(None).cast("double").alias("empty"),
        "c_mktsegment",
        F.when(F.col("c_mktsegment") == "BUILDING", 1)
        .when(F.col("c_mktsegment") == "MACHINERY", 2).otherwise(0).alias("segment"),
    )
    return once.unionByName(once)


CUSTOMER_SQL = """
    SELECT c_custkey, c_name, nullif(c_nationkey, 7) AS c_nationkey,
           CASE WHEN abs(c_acctbal) < 1000 THEN 0.0 ELSE c_acctbal END AS balance,
           0.0 AS unmeasured, CAST(NULL AS DOUBLE) AS empty, c_mktsegment,
           CASE c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'MACHINERY' THEN 2 ELSE 0 END AS segment
    FROM customer, (VALUES (1), (2)) AS twice(copy)
"""


def events(spark, sf_dir):
    return with_purchase(table(spark, sf_dir, "events"))


def with_purchase(frame):
    return frame.select(
        "event_id", "user_id",
        F.when(F.col("event_type") == "error", 0.0).otherwise(F.col("value")).alias("value"),
        (F.col("event_type") == "purchase").cast("int").alias("purchase"),
    )


EVENTS_SQL = """
    SELECT event_id, user_id,
           CASE WHEN event_type = 'error' THEN 0.0 ELSE value END AS value,
           CAST(event_type = 'purchase' AS INTEGER) AS purchase
    FROM events
"""


def scored_lineitem(spark, sf_dir):
    """One label and three scores per line; ``tied`` has few distinct values."""
    tied = 5 * F.col("l_discount") + 2 * F.col("l_tax")
    return lineitem(spark, sf_dir).select(
        F.col("returned").alias("label"),
        F.round(tied, 4).alias("tied"),
        (F.col("l_extendedprice") / 200000).alias("fine"),
        (F.col("l_quantity") / 50).alias("coarse"),
        "l_linestatus",
    ).withColumn("tied", F.least(F.lit(1.0), F.col("tied")))


SCORED_SQL = """
    SELECT CAST(l_returnflag = 'R' AS INTEGER) AS label,
           least(CAST(1.0 AS DOUBLE), round(5 * l_discount + 2 * l_tax, 4)) AS tied,
           l_extendedprice / 200000 AS fine, l_quantity / 50 AS coarse, l_linestatus
    FROM lineitem
"""


def labelled_documents(spark, sf_dir):
    """Features of whole texts next to their quality label."""
    text = F.col("text")
    documents = table(spark, sf_dir, "documents").select(
        "doc_id",
        "n_chars",
        F.size(F.split(text, r"\s+")).alias("n_words"),
        (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).alias("n_lines"),
        F.length(F.regexp_replace(text, "[^0-9]", "")).alias("n_digits"),
        (F.length(text) - F.length(F.replace(text, F.lit("."), F.lit("")))).alias("n_stops"),
    )
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return documents.join(labels, "doc_id")


LABELLED_SQL = """
    SELECT doc_id, quality FROM documents JOIN labels USING (doc_id)
"""
# Held-out rows: ceil(n * 0.2); train quotas by largest remainder, ties to the smaller class.
LABELLED_SPLIT_SQL = f"""
    WITH d AS ({LABELLED_SQL}),
    h AS (SELECT *, row_number() OVER (
              PARTITION BY quality ORDER BY md5('42:' || doc_id), doc_id) AS r FROM d),
    c AS (SELECT quality, count(*) AS n FROM d GROUP BY quality),
    t AS (SELECT sum(n)::BIGINT AS rows,
                 (sum(n) - ceil(sum(n)::DOUBLE * CAST(0.2 AS DOUBLE)))::BIGINT AS train FROM c),
    q AS (SELECT quality, n, (train * n) // rows AS base,
                 row_number() OVER (ORDER BY (train * n) % rows DESC, quality) AS pick,
                 train - sum((train * n) // rows) OVER () AS spare
          FROM c, t),
    k AS (SELECT quality, n - base - CASE WHEN pick <= spare THEN 1 ELSE 0 END AS held_out FROM q)
    SELECT h.doc_id, h.quality, CASE WHEN h.r <= k.held_out THEN 'test' ELSE 'train' END AS partition
    FROM h JOIN k USING (quality)
"""
