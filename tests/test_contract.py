import pytest

from tabproof.contract import DIABETES_CONTRACT, ColumnRule
from tests.conftest import HEADER


def test_required_columns_in_order():
    assert DIABETES_CONTRACT.required_names == HEADER.split(",")


def test_sentinels_and_positive_columns():
    assert DIABETES_CONTRACT.sentinel_names == [
        "Glucose", "BloodPressure", "SkinThickness", "Insulin", "BMI"]
    assert [r.name for r in DIABETES_CONTRACT.rules if r.must_be_positive] == ["Age"]


def test_missing_and_unexpected_columns():
    columns = ["extra", "Glucose", "Outcome"]
    assert DIABETES_CONTRACT.missing_from(columns)[0] == "Pregnancies"
    assert "Glucose" not in DIABETES_CONTRACT.missing_from(columns)
    assert DIABETES_CONTRACT.unexpected_in(columns) == ["extra"]


def test_struct_type_carries_metadata():
    fields = {f.name: f for f in DIABETES_CONTRACT.to_struct_type().fields}
    assert fields["BMI"].dataType.simpleString() == "double"
    assert fields["Age"].dataType.simpleString() == "bigint"
    assert fields["Glucose"].metadata["unit"] == "mg/dL"


def test_unknown_kind_is_rejected():
    with pytest.raises(ValueError):
        ColumnRule("a", "text")
