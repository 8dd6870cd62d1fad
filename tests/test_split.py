import hashlib

import pytest
from pyspark.sql import functions as F

from tabproof.errors import SplitError
from tabproof.operators.split import (
    assign_partition, check_split, class_balance, class_quotas, partition_sizes, plan_split,
    stratified_split, take_partition, with_row_id,
)


@pytest.fixture
def table(spark):
    """1000 rows, every fourth positive."""
    return spark.range(1000).select("id", (F.col("id") % 4 == 0).cast("int").alias("y"))


def members(split, side="test"):
    return {r["id"] for r in split.where(F.col("partition") == side).collect()}


def brute_force(rows, quotas, seed):
    chosen = set()
    for label, quota in quotas.items():
        ids = [i for i, y in rows if y == label]
        ids.sort(key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i))
        chosen |= set(ids[:quota])
    return chosen


@pytest.mark.parametrize("ordered_rows", [100_000, 20, 1])
@pytest.mark.parametrize("test_size", [0.2, 0.25, 0.5, 0.013])
def test_equals_sorting_by_hash(table, ordered_rows, test_size):
    plan = plan_split(table, "y", "id", test_size, seed=7, ordered_rows=ordered_rows)
    rows = [(r["id"], r["y"]) for r in table.collect()]
    expected = brute_force(rows, class_quotas({0: 750, 1: 250}, test_size), 7)
    assert members(assign_partition(table, plan)) == expected
    assert plan.test_rows == len(expected) == plan.rows - plan.train_rows


def test_sizes_and_balance(table):
    split = stratified_split(table, "y", "id", 0.2)
    assert {r["partition"]: r["n"] for r in partition_sizes(split).collect()} == {"train": 800, "test": 200}
    balance = {(r["partition"], r["label"]): r["n"] for r in class_balance(split, "y").collect()}
    assert balance == {("train", 0): 600, ("train", 1): 200, ("test", 0): 150, ("test", 1): 50}


def test_same_seed_same_rows_other_seed_other_rows(table):
    a = members(stratified_split(table, "y", "id", seed=1))
    assert a == members(stratified_split(table.repartition(5).orderBy(F.rand()), "y", "id", seed=1))
    assert a != members(stratified_split(table, "y", "id", seed=2))


def test_split_is_a_narrow_projection(table):
    split = stratified_split(table, "y", "id")
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan and "Join" not in plan


def test_quotas():
    assert class_quotas({0: 500, 1: 268}, 0.2) == {0: 100, 1: 54}
    # equal remainders go to the smaller class value on the train side
    assert class_quotas({0: 5, 1: 5}, 0.3) == {0: 1, 1: 2}
    for n in range(4, 60):
        quotas = class_quotas({0: n, 1: 2 * n + 1}, 0.2)
        assert sum(quotas.values()) == -(-(3 * n + 1) // 5)


def test_check_split(table):
    split = stratified_split(table, "y", "id")
    assert tuple(check_split(table, split, "id").first()) == (0, 0, 0)
    broken = split.where("id != 3").unionByName(split.where("id = 5"))
    flipped = split.where("id = 8").withColumn(
        "partition", F.when(F.col("partition") == "test", "train").otherwise("test"))
    facts = check_split(table, broken.unionByName(flipped), "id").first()
    assert tuple(facts) == (1, 1, 2)


def test_rows_recovered_by_id(table):
    split = stratified_split(table, "y", "id")
    listed, rest = take_partition(table, split.where("partition = 'test'"), "id")
    assert {r["id"] for r in listed.collect()} == members(split)
    assert {r["id"] for r in rest.collect()} == members(split, "train")


def test_composite_and_string_ids(spark):
    df = spark.range(400).select(
        (F.col("id") % 20).alias("a"), F.concat(F.lit("k"), F.floor(F.col("id") / 20)).alias("b"),
        (F.col("id") % 2).alias("y"))
    split = stratified_split(df, "y", ["a", "b"], 0.25)
    assert {r["partition"]: r["n"] for r in partition_sizes(split).collect()} == {"train": 300, "test": 100}
    assert tuple(check_split(df, split, ["a", "b"]).first()) == (0, 0, 0)


@pytest.mark.parametrize("kind", ["boolean", "double", "bigint"])
def test_any_numeric_target_type(table, kind):
    other = table.withColumn("y", F.col("y").cast(kind))
    assert members(stratified_split(other, "y", "id")) == members(stratified_split(table, "y", "id"))


def test_guards(spark, table):
    one = spark.createDataFrame([(i, int(i == 0)) for i in range(9)], "id int, y int")
    with pytest.raises(SplitError, match="at least 2"):
        plan_split(one, "y", "id")
    few = spark.createDataFrame([(i, i % 2) for i in range(10)], "id int, y int")
    with pytest.raises(SplitError, match="test row"):
        plan_split(few, "y", "id", 0.05)
    with pytest.raises(SplitError, match="train row"):
        plan_split(few, "y", "id", 0.95)
    with pytest.raises(SplitError, match="no target"):
        plan_split(table.withColumn("y", F.when(F.col("id") > 3, F.col("y"))), "y", "id")
    with pytest.raises(SplitError, match="other than 0 or 1"):
        plan_split(table.withColumn("y", F.col("id")), "y", "id")
    with pytest.raises(SplitError, match="strictly between"):
        plan_split(table, "y", "id", 1.0)
    with pytest.raises(SplitError, match="not present"):
        plan_split(table, "y", "key")


def test_repeated_ids_that_would_break_the_sizes_are_refused(spark):
    same = spark.range(100).select(F.lit(1).alias("id"), (F.col("id") % 2).alias("y"))
    with pytest.raises(SplitError, match="identify"):
        plan_split(same, "y", "id")
    with pytest.raises(SplitError, match="identify"):
        plan_split(same, "y", "id", ordered_rows=10)


@pytest.mark.parametrize("copies_per_task", [1_000_000, 7])
def test_content_ids_number_identical_rows(spark, copies_per_task):
    rows = [("a", 1)] * 50 + [("a", None)] * 3 + [("b", 2)]
    df = spark.createDataFrame(rows, "t string, x int")
    numbered = with_row_id(df, copies_per_task=copies_per_task)
    assert numbered.select("row_id").distinct().count() == 54
    again = with_row_id(df.repartition(3), copies_per_task=copies_per_task)
    assert sorted(numbered.collect()) == sorted(again.collect())
    assert numbered.groupBy("t", "x").count().where("count = 50").count() == 1


def test_content_ids_can_be_split(spark):
    df = spark.createDataFrame([(i % 3, i % 2) for i in range(60)], "x int, y int")
    split = stratified_split(with_row_id(df), "y", "row_id", 0.2)
    assert {r["partition"]: r["n"] for r in partition_sizes(split).collect()} == {"train": 48, "test": 12}
