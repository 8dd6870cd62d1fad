import pytest
from pyspark.sql import functions as F

from tabproof.errors import EvaluationError
from tabproof.operators.align import align_by_position, row_positions
from tabproof.operators.profile import target_distribution


def test_positions_follow_files(spark, tmp_path):
    """Several files, read in ranges of which a task gets many, in the order of addresses."""
    folder = str(tmp_path / "rows")
    spark.range(5000).repartitionByRange(5, "id").sortWithinPartitions("id").write.option(
        "maxRecordsPerFile", 300).parquet(folder)
    found = row_positions(spark.read.parquet(folder), ["id"]).collect()
    assert sorted(r["position"] for r in found) == list(range(5000))
    assert all(r["position"] == r["id"] for r in found)
    lines = str(tmp_path / "lines")
    spark.range(400).coalesce(1).select(F.format_string("%03d", "id")).write.text(lines)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100")
    try:
        split = spark.read.text(lines)
        assert split.rdd.getNumPartitions() > 4
        assert all(int(r["value"]) == r["position"] for r in row_positions(split, ["value"]).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_positions_without_files(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 3).alias("x"), F.lit(0).alias("position"))
    assert all(r["x"] == 3 * r["position"] for r in row_positions(df, ["x"]).collect())
    assert row_positions(df.limit(0), ["x"]).count() == 0


def test_alignment_by_position(spark):
    truth = spark.range(0, 50, 1, 3).select((F.col("id") % 2).alias("y"))
    scores = spark.range(0, 50, 1, 5).select((F.col("id") / 50).alias("p"))
    found = align_by_position(truth, scores, "y", "p").collect()
    assert len(found) == 50
    assert all(r["label"] == r["position"] % 2 and r["score"] == r["position"] / 50 for r in found)
    with pytest.raises(EvaluationError, match="50 label.* 49 score"):
        align_by_position(truth, scores.limit(49), "y", "p")


def test_target_distribution_is_ordered(spark):
    df = spark.createDataFrame([(v,) for v in (3, 1, 2, None, 3, -1)], "y int")
    assert [tuple(r) for r in target_distribution(df, "y").collect()] == [(-1.0, 1), (1.0, 1), (2.0, 1), (3.0, 2)]
