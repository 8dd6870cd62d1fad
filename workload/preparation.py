"""Projection, imputation, scaling, splits and streaming preparation."""

from pyspark.sql import functions as F

from tabproof.operators.prepare import (
    FeatureColumns, ZeroToMissing, describe_preparation, fit_preparation,
)
from tabproof.operators.records import align_records
from tabproof.operators.split import (
    check_split, class_balance, partition_sizes, stratified_split, take_partition, with_row_id,
)
from tabproof.plans.training import (
    load_preparation, save_preparation, write_preparation_json,
)
from tabproof.sources.shared import shared_folder
from tabproof.streaming.scoring import prepare_stream, write_stream
from workload.tables import (
    EVENTS, EVENTS_SQL, LINEITEM, LINEITEM_SQL, events, lineitem, table, with_purchase,
)

KEYS = ["l_orderkey", "l_linenumber"]
FEATURES = LINEITEM.feature_names


def _rounded(df, names, digits=6):
    return df.select(*[
        F.round(c, digits).alias(c) if c in names else F.col(c) for c in df.columns])


def contract_projection(spark, sf_dir):
    stage = FeatureColumns(columns=FEATURES, passthrough=KEYS)
    return stage.transform(lineitem(spark, sf_dir))


PROJECTION_SQL = "SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"CAST({c} AS DOUBLE) AS {c}" for c in FEATURES) + " FROM lineitem"


def sentinel_to_null(spark, sf_dir):
    stage = ZeroToMissing(columns=LINEITEM.sentinel_names)
    return stage.transform(contract_projection(spark, sf_dir))


SENTINEL_SQL = """
    SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice,
           nullif(l_discount, 0) AS l_discount, nullif(l_tax, 0) AS l_tax
    FROM lineitem
"""


def _impute(strategy, scaling="none"):
    def query(spark, sf_dir):
        df = lineitem(spark, sf_dir)
        model = fit_preparation(df, LINEITEM, scaling, strategy, passthrough=KEYS)
        return _rounded(model.transform(df), FEATURES)
    return query


def _impute_sql(statistic):
    """``statistic`` maps a column name to a scalar subquery over ``s``."""
    columns = ", ".join(
        f"round(coalesce(s.{c}, ({statistic(c)}), 0), 6) AS {c}" for c in FEATURES)
    return f"WITH s AS ({SENTINEL_SQL}) SELECT l_orderkey, l_linenumber, {columns} FROM s"


def _mode(c):
    return (f"SELECT {c} FROM s WHERE {c} IS NOT NULL GROUP BY {c} "
            f"ORDER BY count(*) DESC, {c} LIMIT 1")


IMPUTE_SQL = {
    "median": _impute_sql(lambda c: f"SELECT median({c}) FROM s"),
    "mean": _impute_sql(lambda c: f"SELECT avg({c}) FROM s"),
    "most_frequent": _impute_sql(_mode),
    "constant": _impute_sql(lambda c: "SELECT CAST(0 AS DOUBLE)"),
}

STANDARDIZE_SQL = (
    f"WITH s AS ({SENTINEL_SQL}), m AS (SELECT l_orderkey, l_linenumber, "
    + ", ".join(f"coalesce({c}, (SELECT median({c}) FROM s)) AS {c}" for c in FEATURES)
    + " FROM s), a AS (SELECT "
    + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS d_{c}" for c in FEATURES)
    + " FROM m) SELECT l_orderkey, l_linenumber, "
    + ", ".join(f"round(({c} - m_{c}) / CASE WHEN d_{c} = 0 THEN 1 ELSE d_{c} END, 6) AS {c}"
                for c in FEATURES)
    + " FROM m, a"
)


def split_events(spark, sf_dir):
    return stratified_split(events(spark, sf_dir), "purchase", "event_id")


def stratified(spark, sf_dir):
    return split_events(spark, sf_dir).select("event_id", "purchase", "partition")


# Held-out rows: ceil(n * 0.2); train quotas by largest remainder, ties to the smaller class.
SPLIT_SQL = f"""
    WITH e AS ({EVENTS_SQL}),
    h AS (SELECT *, row_number() OVER (
              PARTITION BY purchase ORDER BY md5('42:' || event_id), event_id) AS r FROM e),
    c AS (SELECT purchase, count(*) AS n FROM e GROUP BY purchase),
    t AS (SELECT sum(n)::BIGINT AS rows,
                 (sum(n) - ceil(sum(n)::DOUBLE * CAST(0.2 AS DOUBLE)))::BIGINT AS train FROM c),
    q AS (SELECT purchase, n, (train * n) // rows AS base,
                 row_number() OVER (ORDER BY (train * n) % rows DESC, purchase) AS pick,
                 train - sum((train * n) // rows) OVER () AS spare
          FROM c, t),
    k AS (SELECT purchase, n - base - CASE WHEN pick <= spare THEN 1 ELSE 0 END AS held_out FROM q)
    SELECT h.event_id, h.user_id, h.value, h.purchase,
           CASE WHEN h.r <= k.held_out THEN 'test' ELSE 'train' END AS partition
    FROM h JOIN k ON h.purchase = k.purchase
"""


def prepare_train_only(spark, sf_dir):
    split = split_events(spark, sf_dir)
    model = fit_preparation(
        split.where("partition = 'train'"), EVENTS, passthrough=["event_id", "partition"])
    return _rounded(model.transform(split), EVENTS.feature_names)


PREPARED_CTE = f"""
    WITH x AS ({SPLIT_SQL}),
    s AS (SELECT event_id, partition, CAST(user_id AS DOUBLE) AS user_id,
                 nullif(value, 0) AS value FROM x),
    i AS (SELECT median(user_id) AS f_user_id, median(value) AS f_value
          FROM s WHERE partition = 'train'),
    m AS (SELECT event_id, partition, coalesce(user_id, f_user_id) AS user_id,
                 coalesce(value, f_value) AS value FROM s, i),
    a AS (SELECT avg(user_id) AS m_user_id, stddev_pop(user_id) AS d_user_id,
                 avg(value) AS m_value, stddev_pop(value) AS d_value
          FROM m WHERE partition = 'train')
"""

PREPARE_SQL = PREPARED_CTE + """
    SELECT event_id, partition, round((user_id - m_user_id) / d_user_id, 6) AS user_id,
           round((value - m_value) / d_value, 6) AS value
    FROM m, a
"""


def describe(spark, sf_dir):
    split = split_events(spark, sf_dir)
    model = fit_preparation(split.where("partition = 'train'"), EVENTS)
    return _rounded(describe_preparation(spark, model), ["statistic", "mean", "scale"])


DESCRIBE_SQL = PREPARED_CTE + """
    SELECT CAST(0 AS INTEGER) AS position, 'user_id' AS feature, FALSE AS is_sentinel,
           'median' AS strategy, 'standard' AS scaling, round(f_user_id, 6) AS statistic,
           round(m_user_id, 6) AS mean, round(d_user_id, 6) AS scale FROM a, i
    UNION ALL
    SELECT 1, 'value', TRUE, 'median', 'standard', round(f_value, 6), round(m_value, 6),
           round(d_value, 6) FROM a, i
"""


def split_balance(spark, sf_dir):
    return class_balance(split_events(spark, sf_dir), "purchase")


BALANCE_SQL = f"""
    SELECT partition, purchase AS label, CAST(count(*) AS BIGINT) AS n
    FROM ({SPLIT_SQL}) GROUP BY ALL
"""


def split_sizes(spark, sf_dir):
    return partition_sizes(split_events(spark, sf_dir))


SIZES_SQL = f"""
    SELECT partition, CAST(count(*) AS BIGINT) AS n FROM ({SPLIT_SQL}) GROUP BY ALL
"""


def split_check(spark, sf_dir):
    return check_split(events(spark, sf_dir), split_events(spark, sf_dir), "event_id")


SPLIT_CHECK_SQL = f"""
    WITH x AS ({SPLIT_SQL})
    SELECT CAST((SELECT count(*) FROM (
                    SELECT event_id FROM x WHERE partition = 'train'
                    INTERSECT SELECT event_id FROM x WHERE partition = 'test')) AS BIGINT) AS overlap,
           CAST((SELECT count(*) FROM (
                    SELECT event_id FROM events EXCEPT ALL SELECT event_id FROM x)) AS BIGINT) AS lost,
           CAST((SELECT count(*) FROM (
                    SELECT event_id FROM x EXCEPT ALL SELECT event_id FROM events)) AS BIGINT) AS added
"""


def split_membership(spark, sf_dir):
    """Test rows recovered from the source table by their ids."""
    held_out = split_events(spark, sf_dir).where("partition = 'test'")
    listed, _ = take_partition(table(spark, sf_dir, "events"), held_out, "event_id")
    return listed.select("event_id", "event_type", "value")


MEMBERSHIP_SQL = f"""
    SELECT event_id, event_type, value FROM events
    WHERE event_id IN (SELECT event_id FROM ({SPLIT_SQL}) WHERE partition = 'test')
"""


def row_identity(spark, sf_dir):
    """Content ids are unique even where rows repeat."""
    rows = table(spark, sf_dir, "lineitem").select("l_partkey", "l_linenumber")
    ids = with_row_id(rows).groupBy("row_id").agg(F.count(F.lit(1)).alias("n"))
    return ids.agg(F.count(F.lit(1)).alias("ids"), F.sum("n").alias("rows"))


ROW_IDENTITY_SQL = """
    SELECT CAST(count(*) AS BIGINT) AS ids, CAST(count(*) AS BIGINT) AS rows FROM lineitem
"""


def record_alignment(spark, sf_dir):
    """The same two features from an array, a map and a struct column."""
    part = table(spark, sf_dir, "part")
    size, price = F.col("p_size").cast("double"), F.col("p_retailprice")
    names = ["size", "price"]
    shapes = {
        "array": F.array(size, price),
        "map": F.create_map(F.lit("price"), price, F.lit("size"), size),
        "struct": F.struct(price.alias("price"), size.alias("size")),
    }
    frames = [
        align_records(part.select("p_partkey", F.lit(kind).alias("shape"), c.alias("record")),
                      "record", names)
        for kind, c in shapes.items()
    ]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


ALIGNMENT_SQL = """
    SELECT p_partkey, shape, CAST(p_size AS DOUBLE) AS size, p_retailprice AS price
    FROM part, (VALUES ('array'), ('map'), ('struct')) AS s(shape)
"""


def stream_preparation(spark, sf_dir):
    """A preparation fitted on the training rows, applied to the table as a file stream."""
    split = split_events(spark, sf_dir)
    model = fit_preparation(
        split.where("partition = 'train'"), EVENTS, passthrough=["event_id"])
    schema = table(spark, sf_dir, "events").schema
    stream = (
        spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir))
    prepared = prepare_stream(model, with_purchase(stream))
    folder = shared_folder(spark, "stream")
    query = write_stream(prepared, f"{folder}/out", f"{folder}/checkpoint")
    query.awaitTermination()
    return _rounded(spark.read.parquet(f"{folder}/out"), EVENTS.feature_names)


STREAM_SQL = PREPARED_CTE + """
    SELECT event_id, round((user_id - m_user_id) / d_user_id, 6) AS user_id,
           round((value - m_value) / d_value, 6) AS value
    FROM m, a
"""

def saved_preparation(spark, sf_dir):
    """A preparation written to disk, read back and applied."""
    df, folder = lineitem(spark, sf_dir), shared_folder(spark, "preparation")
    save_preparation(fit_preparation(df, LINEITEM, "none", passthrough=KEYS), folder)
    return _rounded(load_preparation(folder).transform(df), FEATURES)


def preparation_json(spark, sf_dir):
    """What a preparation has fitted, written as JSON and read back."""
    split, folder = split_events(spark, sf_dir), shared_folder(spark, "description")
    write_preparation_json(fit_preparation(split.where("partition = 'train'"), EVENTS), folder)
    lines = spark.read.schema(
        "position int, feature string, is_sentinel boolean, strategy string, scaling string, "
        "statistic double, mean double, scale double").json(folder)
    return _rounded(lines, ["statistic", "mean", "scale"])


QUERIES = {
    "contract_projection": contract_projection,
    "sentinel_to_null": sentinel_to_null,
    "impute_median": _impute("median"),
    "impute_mean": _impute("mean"),
    "impute_most_frequent": _impute("most_frequent"),
    "impute_constant": _impute("constant"),
    "standardize": _impute("median", "standard"),
    "record_alignment": record_alignment,
    "stratified_split": stratified,
    "split_balance": split_balance,
    "split_sizes": split_sizes,
    "split_check": split_check,
    "split_membership": split_membership,
    "row_identity": row_identity,
    "prepare_train_only": prepare_train_only,
    "describe_preparation": describe,
    "score_stream": stream_preparation,
    "saved_preparation": saved_preparation,
    "preparation_json": preparation_json,
}

ORACLES = {
    "contract_projection": PROJECTION_SQL,
    "sentinel_to_null": SENTINEL_SQL,
    "impute_median": IMPUTE_SQL["median"],
    "impute_mean": IMPUTE_SQL["mean"],
    "impute_most_frequent": IMPUTE_SQL["most_frequent"],
    "impute_constant": IMPUTE_SQL["constant"],
    "standardize": STANDARDIZE_SQL,
    "record_alignment": ALIGNMENT_SQL,
    "stratified_split": f"SELECT event_id, purchase, partition FROM ({SPLIT_SQL})",
    "split_balance": BALANCE_SQL,
    "split_sizes": SIZES_SQL,
    "split_check": SPLIT_CHECK_SQL,
    "split_membership": MEMBERSHIP_SQL,
    "row_identity": ROW_IDENTITY_SQL,
    "prepare_train_only": PREPARE_SQL,
    "describe_preparation": DESCRIBE_SQL,
    "score_stream": STREAM_SQL,
    "saved_preparation": IMPUTE_SQL["median"],
    "preparation_json": DESCRIBE_SQL,
}
