import json
import math

import pytest
from pyspark.sql import functions as F

from tabproof.contract import ColumnRule, TableContract
from tabproof.errors import InvalidTableError
from tabproof.operators.duplicates import duplicate_rows
from tabproof.operators.findings import unexpected_target_values
from tabproof.operators.profile import column_statistics, target_distribution
from tabproof.plans.quality import require_valid, validate


def codes(report):
    return [(r["code"], r["column"], r["count"]) for r in report.issue_rows]


def test_clean_table_has_no_findings(clean, contract):
    report = validate(clean, contract, source="here")
    assert codes(report) == []
    assert report.is_valid and not report.has_warnings
    facts = report.table_profile.first()
    assert (facts["row_count"], facts["column_count"], facts["duplicate_count"]) == (4, 9, 0)
    assert facts["source"] == "here" and facts["column_names"] == contract.required_names
    assert report.raise_for_errors() is report
    assert {r["value"]: r["n"] for r in report.target_distribution.collect()} == {0.0: 2, 1.0: 2}


def test_profile_statistics(clean, contract):
    glucose = validate(clean, contract).column("Glucose")
    assert glucose["dtype"] == "bigint" and glucose["is_numeric"]
    assert (glucose["minimum"], glucose["maximum"]) == (85.0, 183.0)
    assert glucose["unique_count"] == 4 and glucose["missing_fraction"] == 0.0
    assert validate(clean, contract).column("nope") is None


@pytest.mark.parametrize("distinct", ["exact", "approximate", None])
def test_all_ways_of_profiling_agree(preparation, contract, distinct):
    rows = {
        r["name"]: r.asDict()
        for r in column_statistics(preparation.withColumn("t", F.lit("x")), contract, distinct).collect()
    }
    exact = {
        r["name"]: r.asDict()
        for r in column_statistics(preparation.withColumn("t", F.lit("x")), contract).collect()
    }
    for name, row in rows.items():
        for key, value in exact[name].items():
            if key == "unique_count":
                assert row[key] == (value if distinct else None)
            else:
                assert row[key] == value, (name, key)


def test_nan_and_null_are_one_missing_value(spark, contract):
    df = spark.createDataFrame([(1.0,), (math.nan,), (None,)], "BMI double")
    row = {r["name"]: r for r in column_statistics(df, contract).collect()}["BMI"]
    assert (row["missing_count"], row["unique_count"], row["maximum"]) == (2, 1, 1.0)


def test_profile_of_every_type(spark):
    df = spark.sql("""
        SELECT * FROM VALUES
          (1Y, true, 1.50BD, DATE'2020-01-01', TIMESTAMP'2020-01-01 00:00:00', X'00', array(1), map('a', 1), 'x'),
          (1Y, false, 1.50BD, DATE'2020-01-02', TIMESTAMP'2020-01-01 00:00:00', X'01', array(2), map('a', 1), 'y'),
          (NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL)
          AS t(b, f, d, day, ts, bin, arr, m, s)""")
    rows = {r["name"]: r for r in column_statistics(df).collect()}
    assert [rows[c]["unique_count"] for c in df.columns] == [1, 2, 1, 2, 1, 2, 2, 1, 2]
    assert all(rows[c]["missing_count"] == 1 for c in df.columns)
    assert (rows["f"]["minimum"], rows["f"]["maximum"], rows["f"]["zero_cells"]) == (0.0, 1.0, 1)
    assert rows["d"]["maximum"] == 1.5
    assert rows["day"]["minimum"] is None and not rows["day"]["is_numeric"]


def test_long_texts_are_distinct_values(spark):
    texts = ["a" * 64, "a" * 65, "a" * 64, "b"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert column_statistics(df).first()["unique_count"] == 3


def test_empty_table(clean, contract):
    report = validate(clean.limit(0), contract)
    assert codes(report) == [("EMPTY_DATASET", None, 0)]
    assert report.column("Glucose")["missing_fraction"] == 0.0
    assert report.column("Glucose")["minimum"] is None
    assert report.table_profile.first()["row_count"] == 0


def test_table_without_columns(clean, contract):
    report = validate(clean.select(), contract)
    assert codes(report) == [("EMPTY_DATASET", None, 0)]
    assert report.table_profile.first()["column_count"] == 0


def test_missing_required_columns_in_contract_order(clean, contract):
    report = validate(clean.drop("Age", "Insulin", "BMI"), contract)
    assert codes(report) == [("MISSING_REQUIRED_COLUMN", c, None) for c in ("Insulin", "BMI", "Age")]


@pytest.mark.parametrize("alias", ["class", "ClassVariable", "target", "DIABETES"])
def test_misnamed_target(clean, contract, alias):
    report = validate(clean.withColumnRenamed("Outcome", alias), contract)
    found = codes(report)
    assert ("MISSING_REQUIRED_COLUMN", "Outcome", None) in found
    assert ("UNEXPECTED_TARGET_COLUMN", "Outcome", None) in found
    assert ("UNEXPECTED_COLUMN", alias, None) in found
    text = next(r["message"] for r in report.issue_rows if r["code"] == "UNEXPECTED_TARGET_COLUMN")
    assert alias in text


def test_extra_column_is_a_warning(clean, contract):
    report = validate(clean.withColumn("SiteCode", F.lit("ABC")), contract)
    assert codes(report) == [("UNEXPECTED_COLUMN", "SiteCode", None)]
    assert report.is_valid and report.has_warnings


def test_non_numeric_feature(clean, contract):
    report = validate(clean.withColumn("Glucose", F.lit("high")), contract)
    assert ("NON_NUMERIC_FEATURE", "Glucose", None) in codes(report)
    assert report.column("Glucose")["minimum"] is None


def test_non_numeric_target_is_reported_twice(clean, contract):
    report = validate(clean.withColumn("Outcome", F.lit("yes")), contract)
    assert codes(report).count(("NON_NUMERIC_FEATURE", "Outcome", None)) == 2
    assert report.target_distribution.count() == 0


@pytest.mark.parametrize("value", [2, 7, -1])
def test_unexpected_target_value(edited, contract, value):
    report = validate(edited(Outcome={0: value, 1: value}), contract)
    assert ("NON_BINARY_TARGET", "Outcome", 2) in codes(report)
    assert f"also holds {value}." in report.issue_rows[-1]["message"]


def test_fractional_target_is_kept(clean, contract):
    df = clean.withColumn("Outcome", F.when(F.col("Age") == 50, 1.5).otherwise(F.col("Outcome")))
    report = validate(df, contract)
    assert ("NON_BINARY_TARGET", "Outcome", 1) in codes(report)
    assert "1.5" in report.issue_rows[-1]["message"]
    assert {r["value"] for r in report.target_distribution.collect()} == {0.0, 1.0, 1.5}


def test_integral_float_target_is_accepted(clean, contract):
    assert validate(clean.withColumn("Outcome", F.col("Outcome").cast("double")), contract).is_valid


def test_message_sums_up_many_unexpected_values(spark):
    contract = TableContract((ColumnRule("x"),), ColumnRule("y"))
    df = spark.range(100).select(F.lit(1.0).alias("x"), F.col("id").alias("y"))
    row = validate(df, contract).issue_rows[-1]
    assert row["code"] == "NON_BINARY_TARGET" and row["count"] == 98
    assert row["message"].endswith("also holds 98 other values from 2 to 99.")
    odd = unexpected_target_values(target_distribution(df, "y")).collect()
    assert [r["value"] for r in odd] == [float(i) for i in range(2, 100)]
    assert odd[0]["value_text"] == "2"


def test_missing_values(edited, contract):
    report = validate(edited(Insulin={0: None, 2: None}), contract)
    assert codes(report) == [("MISSING_VALUES", "Insulin", 2)]
    assert report.column("Insulin")["missing_fraction"] == 0.5


def test_column_without_values(clean, contract):
    report = validate(clean.withColumn("BMI", F.lit(None).cast("double")), contract)
    assert codes(report) == [("COLUMN_WITHOUT_USABLE_VALUES", "BMI", 4)]
    assert report.column("BMI")["unique_count"] == 0


def test_sentinel_zeros(edited, contract):
    report = validate(edited(Glucose={1: 0}), contract)
    assert codes(report) == [("ZERO_SENTINEL_VALUE", "Glucose", 1)]
    assert report.column("Glucose")["zero_count"] == 1
    zeros = {r["name"]: r["zero_count"] for r in report.zero_counts.collect()}
    assert zeros == {"Glucose": 1, "BloodPressure": 0, "SkinThickness": 0, "Insulin": 0, "BMI": 0}


def test_zero_in_an_ordinary_column_is_data(edited, contract):
    report = validate(edited(Pregnancies={1: 0}), contract)
    assert codes(report) == [] and report.column("Pregnancies")["zero_count"] == 0


def test_sentinel_column_of_zeros_and_nulls(edited, contract):
    report = validate(edited(Insulin={0: 0, 1: 0, 2: 0, 3: None}), contract)
    assert codes(report) == [
        ("MISSING_VALUES", "Insulin", 1), ("COLUMN_WITHOUT_USABLE_MEASUREMENTS", "Insulin", 3)]


def test_text_zero_is_not_counted(clean, contract):
    report = validate(clean.withColumn("Glucose", F.lit("0")), contract)
    assert report.column("Glucose")["zero_count"] == 0
    assert not any(c[0] == "ZERO_SENTINEL_VALUE" for c in codes(report))


def test_negative_and_non_positive(edited, contract):
    assert codes(validate(edited(Glucose={0: -50, 1: -60}), contract)) == [
        ("NEGATIVE_VALUE", "Glucose", 2)]
    assert codes(validate(edited(Age={0: 0}), contract)) == [("NON_POSITIVE_VALUE", "Age", 1)]
    assert codes(validate(edited(Age={0: -3}), contract)) == [("NEGATIVE_VALUE", "Age", 1)]


def test_negative_target_is_reported_by_both_checks(edited, contract):
    found = codes(validate(edited(Outcome={0: -1}), contract))
    assert found == [("NEGATIVE_VALUE", "Outcome", 1), ("NON_BINARY_TARGET", "Outcome", 1)]


def test_findings_keep_check_order(edited, contract):
    df = edited(Glucose={0: 0}, Age={1: 0}, BMI={2: None}).withColumn("x", F.lit(1))
    df = df.drop("Insulin").unionByName(df.drop("Insulin").limit(1))
    report = validate(df, contract)
    assert [c for c, _, _ in codes(report)] == [
        "DUPLICATE_ROW", "MISSING_REQUIRED_COLUMN", "UNEXPECTED_COLUMN", "ZERO_SENTINEL_VALUE",
        "MISSING_VALUES", "NON_POSITIVE_VALUE"]
    assert len(report.errors) + len(report.warnings) == len(report.issue_rows)
    counts = {r["code"]: r["n"] for r in report.issue_counts.collect()}
    assert counts["DUPLICATE_ROW"] == 1
    lines = [r["text"] for r in report.issue_text.orderBy("ordinal").collect()]
    assert lines[0].startswith("[WARNING] DUPLICATE_ROW (n=1): ")
    assert lines[1].startswith("[ERROR] MISSING_REQUIRED_COLUMN [Insulin]: ")


def test_require_valid_raises_with_the_full_report(edited, contract, clean):
    bad = edited(Age={0: 0}, Glucose={0: 0})
    with pytest.raises(InvalidTableError) as caught:
        require_valid(bad, contract)
    assert "NON_POSITIVE_VALUE" in str(caught.value)
    assert [c for c, _, _ in codes(caught.value.report)] == ["ZERO_SENTINEL_VALUE", "NON_POSITIVE_VALUE"]
    warned = edited(Glucose={0: 0})
    assert require_valid(warned, contract) is warned


def test_report_json_keeps_nulls(spark, edited, contract, tmp_path):
    validate(edited(Glucose={0: 0}, Outcome={0: 2}), contract).write_json(str(tmp_path / "r"))

    def lines(part):
        return [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "r" / part)).collect()]

    assert lines("table_profile")[0]["source"] is None
    assert {r["value"] for r in lines("target_distribution")} == {"0", "1", "2"}
    assert {r["code"] for r in lines("issues")} == {"ZERO_SENTINEL_VALUE", "NON_BINARY_TARGET"}
    assert len(lines("column_profile")) == 9


def test_duplicate_rows(spark):
    rows = [(1, None, "a")] * 5 + [(None, 1, "a")] * 2 + [(2, 2, "b"), (3, 3, None)]
    rows += [(4, 4, "c")] * 300
    df = spark.createDataFrame(rows, "x int, y int, t string").repartition(4)
    assert duplicate_rows(df).first()[0] == 4 + 1 + 299


def test_rows_that_look_alike_are_told_apart(spark):
    df = spark.sql("""
        SELECT * FROM VALUES
            (array('a,b'), timestamp'2024-01-01 00:00:00.000001', 0.1D, x'00', named_struct('p', 'x', 'q', null)),
            (array('a', 'b'), timestamp'2024-01-01 00:00:00.000001', 0.1D, x'00', named_struct('p', 'x', 'q', null)),
            (array('a', 'b'), timestamp'2024-01-01 00:00:00.000002', 0.1D, x'00', named_struct('p', 'x', 'q', null)),
            (array('a', 'b'), timestamp'2024-01-01 00:00:00.000002', 0.1D, null, named_struct('p', 'x', 'q', null)),
            (array('a', 'b'), timestamp'2024-01-01 00:00:00.000002', 0.1D, null, named_struct('p', null, 'q', 'x')),
            (array('a', 'b'), timestamp'2024-01-01 00:00:00.000002', 0.1D, null, null)
        AS t(a, ts, d, b, s)""")
    assert duplicate_rows(df).first()[0] == 0
    assert duplicate_rows(df.unionAll(df)).first()[0] == 6
    zeros = spark.createDataFrame([(0.0,), (-0.0,)], "x double")
    assert duplicate_rows(zeros).first()[0] == 1


def test_nested_columns_and_repeated_names_are_validated(spark, contract):
    df = spark.sql("""
        SELECT map('a', 1, 'b', map_size) AS m, array(map(map_size, 'x')) AS ms,
               parse_json('{"k": 1, "a": [2]}') AS v, 1 AS twice, 2 AS twice
        FROM VALUES (1), (1), (2) AS t(map_size)""")
    turned = spark.sql("""
        SELECT map('b', 1, 'a', 1) AS m, array(map(1, 'x')) AS ms,
               parse_json('{"a": [2], "k": 1}') AS v, 1 AS twice, 2 AS twice""")
    report = validate(df.unionAll(turned), contract)
    assert report.duplicates.first()["duplicate_count"] == 2
    assert [report.column(name)["unique_count"] for name in ("m", "ms", "v", "twice#2")] == [2, 2, 1, 1]
    assert ("UNEXPECTED_COLUMN", "twice#2", None) in codes(report)


def test_duplicates_treat_nan_as_missing(spark):
    df = spark.createDataFrame([(math.nan,), (None,), (1.0,)], "x double")
    assert duplicate_rows(df).first()[0] == 1
    assert duplicate_rows(df.limit(0)).first()[0] == 0
