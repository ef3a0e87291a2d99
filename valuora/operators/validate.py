"""Projections, filters and light cleaning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from valuora.functions.columns import (
    clipped_difference,
    null_propagating_sum,
    ordinal_level,
    plus_zero_filled,
    presence_flag,
    product,
    weighted_sum_zero_filled,
)


class SchemaError(RuntimeError):
    """Input does not carry the required columns."""


def require_columns(df: DataFrame, required: Sequence[str]) -> None:
    """Raise listing every missing column."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise SchemaError(
            f"{len(missing)} required column(s) absent: {', '.join(missing)}; "
            f"the input has {', '.join(df.columns[:10])}{', ...' if len(df.columns) > 10 else ''}"
        )


def drop_outliers(df: DataFrame, area: str, target: str, area_above: float, target_below: float) -> DataFrame:
    """Drop rows with ``area > a AND target < t``; a null comparison keeps the row."""
    cond = (F.col(area) > F.lit(area_above)) & (F.col(target) < F.lit(target_below))
    return df.where(~F.coalesce(cond, F.lit(False)))


def outlier_rows(df: DataFrame, area: str, target: str, area_above: float, target_below: float, keep: Sequence[str]) -> DataFrame:
    """The rows P7 would drop, projected for inspection."""
    cond = (F.col(area) > F.lit(area_above)) & (F.col(target) < F.lit(target_below))
    return df.where(F.coalesce(cond, F.lit(False))).select(*keep)


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Tolerant drop (absent names are ignored)."""
    return df.drop(*columns)


def subset_zero_fill(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """P10: keep ``columns`` in order; absent ones become literal 0."""
    present = set(df.columns)
    return df.select(*[F.col(c) if c in present else F.lit(0).alias(c) for c in columns])


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Numeric columns by dtype."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def nominal_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Non-numeric columns by dtype."""
    return [f.name for f in df.schema if not isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def present(df: DataFrame, candidates: Sequence[str]) -> list[str]:
    """The listed columns that exist, in list order."""
    return [c for c in candidates if c in df.columns]


def codes_to_string(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Integer-coded categories as strings (``20``, never ``20.0``)."""
    out = df
    for c in present(df, columns):
        dtype = df.schema[c].dataType
        col = F.col(c)
        if isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType)):
            col = F.when(col == F.floor(col), col.cast("long").cast("string")).otherwise(col.cast("string"))
        out = out.withColumn(c, col.cast("string"))
    return out


def with_log_label(df: DataFrame, target: str, label: str = "label") -> DataFrame:
    """``label = log1p(target)``."""
    return df.withColumn(label, F.log1p(F.col(target).cast("double")))


def fill_informative(df: DataFrame, categories: Sequence[str], zeros: Sequence[str] = ()) -> DataFrame:
    """F8: informative nulls -> ``"None"`` (categories) / 0 (numeric companions)."""
    cats = {c: "None" for c in present(df, categories) if c not in zeros}
    nums = {c: 0 for c in present(df, zeros)}
    out = df.fillna(cats) if cats else df
    return out.fillna(nums) if nums else out


def fill_missing_categories(df: DataFrame, value: str = "Missing") -> DataFrame:
    """every remaining null in a non-numeric column -> ``value``."""
    cols = nominal_columns(df)
    return df.fillna(value, subset=cols) if cols else df


def map_ordinals(df: DataFrame, columns: Sequence[str], scale: Sequence[str]) -> DataFrame:
    """scale position 0..k-1; unknown or null -> -1."""
    out = df
    for c in present(df, columns):
        out = out.withColumn(c, ordinal_level(F.col(c), scale))
    return out


# ---------------------------------------------------------------- F1-F7
ENGINEERED = (
    "ship_lag", "order_lag", "total_area", "weighted_count", "grade_by_area",
    "area_sum", "has_returns", "has_discount", "has_credit",
)


def engineer(
    df: DataFrame,
    *,
    ages: Mapping[str, tuple[str, str]],
    total: tuple[str, Sequence[str]],
    weighted: Mapping[str, float],
    interaction: tuple[str, str],
    chain: Sequence[str],
    flags: Mapping[str, str],
    names: Sequence[str],
) -> DataFrame:
    """Append engineered columns; the input columns are kept as they are.

    ``names`` orders the outputs: ages..., total, weighted, interaction,
    chain, flags...  Required inputs are checked first (F7).
    """
    required = {x for pair in ages.values() for x in pair} | {total[0], *total[1]} | set(weighted) | set(interaction) | set(chain) | set(flags.values())
    require_columns(df, sorted(required))
    exprs = [clipped_difference(a, b) for a, b in ages.values()]
    exprs.append(plus_zero_filled(total[0], *total[1]))
    exprs.append(weighted_sum_zero_filled(weighted))
    exprs.append(product(*interaction))
    exprs.append(null_propagating_sum(list(chain)))
    exprs.extend(presence_flag(src) for src in flags.values())
    if len(exprs) != len(names):
        raise ValueError("names must match the engineered expressions")
    return df.select("*", *[e.alias(n) for e, n in zip(exprs, names)])


def engineer_sales(df: DataFrame) -> DataFrame:
    """F1-F6 bound to the sales table (grade must already be ordinal-mapped)."""
    return engineer(
        df,
        ages={"ship_lag": ("last_ship_year", "sold_year"), "order_lag": ("sold_year", "first_ship_year")},
        total=("living_area", ["basement_area"]),
        weighted={"rooms": 1.0, "basement_area": 0.5},
        interaction=("grade_level", "living_area"),
        chain=["living_area", "basement_area", "frontage"],
        flags={"has_returns": "basement_area", "has_discount": "frontage", "has_credit": "acctbal"},
        names=ENGINEERED,
    )


# The ordered priority scale of the sales table's ``grade``.
GRADE_SCALE = ("5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT")
