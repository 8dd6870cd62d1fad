"""Shared session and the small invented tables the tests edit one cell at a time."""

import math
import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tabproof.contract import DIABETES_CONTRACT  # noqa: E402

# Expected inputs shared with the published behaviour being matched.
HEADER = (
    "Pregnancies,Glucose,BloodPressure,SkinThickness,"
    "Insulin,BMI,DiabetesPedigreeFunction,Age,Outcome"
)
CLEAN_ROWS = [
    (6, 148, 72, 35, 100, 33.6, 0.627, 50, 1),
    (1, 85, 66, 23, 94, 26.6, 0.351, 32, 0),
    (8, 183, 64, 24, 110, 23.3, 0.672, 41, 1),
    (1, 90, 62, 20, 84, 25.2, 0.482, 28, 0),
]
NAN = math.nan
PREPARATION_ROWS = [
    (6, 148, 72, 35, 100, 33.6, 0.627, 50, 1),
    (1, 85, 66, 23, 94, 26.6, 0.351, 32, 0),
    (8, 183, 64, 24, 110, 23.3, 0.672, 41, 1),
    (1, 90, 62, 20, 84, 25.2, 0.482, 28, 0),
    (4, 110, 66, 25, 120, 24.0, 0.400, 33, 1),
    (2, 95, 60, 22, 100, 23.5, 0.510, 35, 0),
    (3, 130, 70, 28, 140, 27.0, 0.610, 45, 1),
    (5, 105, 68, 26, 130, 26.5, 0.560, 39, 0),
    (7, 120, 64, 27, 125, 25.0, 0.520, 36, 1),
    (0, 100, 66, 24, 110, 25.8, 0.430, 31, 0),
    (2, 140, 70, 30, 150, 29.0, 0.700, 48, 1),
    (9, 88, 62, 21, 96, 24.5, 0.380, 30, 0),
    (0, 0, 0, 0, 0, 0.0, 0.250, 22, 0),
    (11, 0, 82, 30, 160, 31.5, 0.620, 55, 1),
    (5, NAN, 68, 24, 0, 27.5, NAN, 44, 1),
    (3, 95, NAN, 22, 100, 24.0, 0.470, 34, 0),
    (0, 200, 90, 40, 300, 45.0, 0.900, 60, 1),
    (0, 210, 92, 42, 320, 46.0, 0.950, 62, 0),
]
RECORD = {
    "Pregnancies": 2.0, "Glucose": 0.0, "BloodPressure": 70.0, "SkinThickness": 25.0,
    "Insulin": 120.0, "BMI": 28.0, "DiabetesPedigreeFunction": 0.45, "Age": 38.0,
}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]").appName("tabproof-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.default.parallelism", "2")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def contract():
    return DIABETES_CONTRACT


@pytest.fixture
def clean(spark, contract):
    return spark.createDataFrame(CLEAN_ROWS, contract.to_struct_type())


@pytest.fixture
def edited(spark, contract):
    """Clean rows with some cells of a column replaced: ``edited(Glucose={0: -5})``."""
    names = contract.required_names

    def build(**columns):
        rows = [list(row) for row in CLEAN_ROWS]
        for name, cells in columns.items():
            for i, value in cells.items():
                rows[i][names.index(name)] = value
        return spark.createDataFrame([tuple(r) for r in rows], contract.to_struct_type())

    return build


@pytest.fixture
def preparation(spark, contract):
    """18 rows with an id; rows 0-15 are meant for training."""
    names = contract.feature_names
    schema = "row int, " + ", ".join(f"{n} double" for n in names) + ", Outcome bigint"
    rows = [(i, *[float(v) for v in r[:-1]], r[-1]) for i, r in enumerate(PREPARATION_ROWS)]
    return spark.createDataFrame(rows, schema)
