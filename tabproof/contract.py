"""What a table must look like: its columns, their rules and the binary target."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Spellings that hint at a misnamed outcome column. They only make
# a finding more helpful; an alias is never accepted in place of the target.
TARGET_ALIASES = (
    "outcome", "class", "classvariable", "class_variable", "target",
    "diabetes", "diabetesoutcome", "diabetes_outcome", "label", "y",
)

# The two classes of every target.
TARGET_VALUES = (0.0, 1.0)


@dataclass(frozen=True)
class ColumnRule:
    """Rules for one column.

    ``kind`` is ``"int"`` or ``"float"``. ``zero_is_missing`` says that a zero is a
    placeholder for "not recorded"; ``must_be_positive`` that zero is impossible.
    """

    name: str
    kind: str = "float"
    description: str = ""
    unit: str | None = None
    zero_is_missing: bool = False
    must_be_positive: bool = False

    def __post_init__(self):
        if self.kind not in ("int", "float"):
            raise ValueError(f"kind of {self.name!r} must be 'int' or 'float'")


@dataclass(frozen=True)
class TableContract:
    """Ordered feature rules plus the rule of the binary target."""

    features: tuple[ColumnRule, ...]
    target: ColumnRule
    target_aliases: tuple[str, ...] = TARGET_ALIASES

    @property
    def rules(self) -> tuple[ColumnRule, ...]:
        return (*self.features, self.target)

    @property
    def feature_names(self) -> list[str]:
        return [rule.name for rule in self.features]

    @property
    def required_names(self) -> list[str]:
        return [rule.name for rule in self.rules]

    @property
    def sentinel_names(self) -> list[str]:
        return [rule.name for rule in self.rules if rule.zero_is_missing]

    def rule(self, name: str) -> ColumnRule | None:
        return next((rule for rule in self.rules if rule.name == name), None)

    def missing_from(self, columns) -> list[str]:
        """Required columns that are absent, in contract order."""
        present = set(columns)
        return [name for name in self.required_names if name not in present]

    def unexpected_in(self, columns) -> list[str]:
        """Columns the contract does not know, in table order."""
        known = set(self.required_names)
        return [name for name in columns if name not in known]

    def target_aliases_in(self, columns) -> list[str]:
        """Column names that look like a misspelt target, sorted."""
        return sorted(name for name in columns if name.strip().lower() in self.target_aliases)

    def to_struct_type(self) -> T.StructType:
        """The contract as a Spark schema; unit and description go to the metadata."""
        kinds = {"int": T.LongType(), "float": T.DoubleType()}
        return T.StructType([
            T.StructField(
                rule.name, kinds[rule.kind], True,
                {"description": rule.description, "unit": rule.unit},
            )
            for rule in self.rules
        ])


# The contract of the public diabetes screening table.
DIABETES_CONTRACT = TableContract(
    features=(
        ColumnRule("Pregnancies", "int", "times pregnant", "count"),
        ColumnRule("Glucose", "int", "plasma glucose", "mg/dL", zero_is_missing=True),
        ColumnRule("BloodPressure", "int", "diastolic pressure", "mm Hg", zero_is_missing=True),
        ColumnRule("SkinThickness", "int", "triceps skin fold", "mm", zero_is_missing=True),
        ColumnRule("Insulin", "int", "two-hour serum insulin", "microU/mL", zero_is_missing=True),
        ColumnRule("BMI", "float", "body mass index", "kg/m^2", zero_is_missing=True),
        ColumnRule("DiabetesPedigreeFunction", "float", "family history score"),
        ColumnRule("Age", "int", "age", "years", must_be_positive=True),
    ),
    target=ColumnRule("Outcome", "int", "binary class"),
)
