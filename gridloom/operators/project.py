"""Column names, selections and roles."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions.columns import numeric_columns, ref, refs, require_columns
from gridloom.functions.numeric import nan_to_null

# Spelling variants of a column and the name that stands for them.
CANONICAL_NAMES = {"physical-exercice": "physical-exercise"}

# Columns left out of the univariate profile.
PROFILE_DROPPED = (
    "expected_burn",
    "meal_name",
    "meal_type",
    "Name of Exercise",
    "Sets",
    "Reps",
    "Benefit",
    "Target Muscle Group",
    "Equipment Needed",
    "Difficulty Level",
    "Body Part",
    "Type of Muscle",
    "Workout",
    "pct_carbs",
    "cal_from_macros",
    "pct_HRR",
    "BMI",
    "Burns Calories (per 30 min)_bc",
    "Height (m)",
    "Fat_Percentage",
    "Calories",
    "cal_balance",
    "BMI_calc",
    "lean_mass_kg",
    "protein_per_kg",
    "Calories_Burned",
    "Burns_Calories_Bin",
    "Burns Calories (per 30 min)",
    "Carbs",
    "Proteins",
    "Fats",
    "Water_Intake (liters)",
)

# Names under which the regression target is looked for, in this order.
TARGET_NAMES = ("weight-(kg)", "Weight_kg", "Weight (kg)", "weight_kg")


def slug(name: str) -> str:
    """Lower-case name with runs of blanks, underscores and hyphens as one hyphen, none at the ends."""
    return re.sub(r"[\s_-]+", "-", name.strip().lower()).strip("-")


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename the columns that exist."""
    return df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})


def normalize_names(df: DataFrame, canonical: Mapping[str, str] = CANONICAL_NAMES) -> DataFrame:
    """Slug every column name, then apply the canonical spellings; a collision is an error."""
    names = [slug(c) for c in df.columns]
    names = [canonical.get(n, n) for n in names]
    doubled = sorted({n for n in names if names.count(n) > 1})
    if doubled:
        raise ValueError(f"column names collide after normalisation: {', '.join(doubled)}")
    return df.toDF(*names)


def drop_listed(df: DataFrame, names: Iterable[str] = PROFILE_DROPPED) -> tuple[DataFrame, int]:
    """Drop the listed columns that exist; also return how many there were."""
    present = [n for n in dict.fromkeys(names) if n in df.columns]
    return df.drop(*present), len(present)


def feature_columns(df: DataFrame, target: str) -> list[str]:
    """Every column but the target, which must exist."""
    require_columns(df, [target], ValueError)
    return [c for c in df.columns if c != target]


def infer_target(columns: Sequence[str], candidates: Sequence[str] = TARGET_NAMES) -> str:
    """The first candidate present."""
    for name in candidates:
        if name in columns:
            return name
    raise ValueError(f"no target column found; pass one of: {', '.join(list(columns)[:30])}")


def select_numeric(df: DataFrame) -> DataFrame:
    """P10: the numeric columns."""
    return df.select(*refs(numeric_columns(df)))


def clean_missing(df: DataFrame) -> DataFrame:
    """NaN to NULL in every floating column, so that missing has one form."""
    floating = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: nan_to_null(ref(c)) for c in floating}) if floating else df


def varying_columns(df: DataFrame) -> list[str]:
    """Numeric columns whose sample variance is positive, from one aggregate."""
    names = numeric_columns(df)
    if not names:
        return []
    row = df.agg(*[F.var_samp(nan_to_null(ref(c).cast("double"))).alias(c) for c in names]).first()
    return [c for c in names if row[c] is not None and row[c] > 0]


def select_varying(df: DataFrame) -> DataFrame:
    return df.select(*refs(varying_columns(df)))
