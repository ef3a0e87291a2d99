"""Scalar column expressions.

All of these are built-in Spark SQL expressions, so they stay inside
whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The ordered quality scale (absent < poor < fair < typical <
# good < excellent) and the inflation reference (CPI-U, 2010 base, 2025 ref).
QUALITY_SCALE = ("None", "Po", "Fa", "TA", "Gd", "Ex")
CPI_BASE_YEAR = 2010
CPI_BASE = 218.056
CPI_REFERENCE_YEAR = 2025
CPI_REFERENCE = 322.561
CPI_NOTE = (
    "The inflated figure converts purchasing power between years; no market "
    "was consulted for it."
)
HISTORICAL_NOTICE = "Priced at about the 2010 price level, which says nothing of current value."
CLIPPED_NOTICE = "The raw price lay outside the prices seen in training and was moved to their edge."


def c(name: str | Column) -> Column:
    return F.col(name) if isinstance(name, str) else name


def nan_to_null(col: Column) -> Column:
    """NaN -> NULL, so comparisons and aggregates behave as 'missing'."""
    return F.nanvl(col, F.lit(None).cast("double"))


def lenient_double(col: Column) -> Column:
    """F18 lenient: unparseable -> NULL (``try_cast``), NaN -> NULL."""
    return nan_to_null(col.try_cast("double"))


def strict_double(col: Column) -> Column:
    """F18 strict: a bad value fails the job under ANSI mode."""
    return col.cast("double")


def clipped_difference(later: str | Column, earlier: str | Column) -> Column:
    """``max(0, later - earlier)``; a null input gives null (no silent 0)."""
    diff = c(later) - c(earlier)
    return F.when(diff.isNull(), F.lit(None)).otherwise(F.greatest(F.lit(0), diff))


def plus_zero_filled(base: str | Column, *optional: str | Column) -> Column:
    """``base + coalesce(x, 0) + ...``; a null base propagates."""
    out = c(base)
    for o in optional:
        out = out + F.coalesce(c(o), F.lit(0))
    return out


def weighted_sum_zero_filled(weights: Mapping[str, float]) -> Column:
    """sum of ``w * coalesce(x, 0)``."""
    out = F.lit(0.0)
    for name, w in weights.items():
        out = out + F.lit(float(w)) * F.coalesce(F.col(name), F.lit(0))
    return out


def product(a: str | Column, b: str | Column) -> Column:
    """interaction term."""
    return c(a) * c(b)


def null_propagating_sum(cols: Sequence[str | Column]) -> Column:
    """plain ``+`` chain, any null gives null."""
    out = c(cols[0])
    for x in cols[1:]:
        out = out + c(x)
    return out


def presence_flag(col: str | Column) -> Column:
    """``x > 0`` as 0/1 with null -> 0."""
    return F.coalesce(c(col) > 0, F.lit(False)).cast("int")


def ordinal_level(col: str | Column, scale: Sequence[str] = QUALITY_SCALE) -> Column:
    """position in ``scale`` (0-based); unknown or null -> -1."""
    levels = F.array(*[F.lit(s) for s in scale])
    return (F.coalesce(F.array_position(levels, c(col)), F.lit(0)) - 1).cast("int")


def smeared_price(log_col: str | Column, smear: float | Column) -> Column:
    """``exp(log) * smear - 1``."""
    s = smear if isinstance(smear, Column) else F.lit(float(smear))
    return F.exp(c(log_col)) * s - F.lit(1.0)


def clip(col: str | Column, lo: float | Column, hi: float | Column) -> Column:
    """clip to [lo, hi]."""
    lo_c = lo if isinstance(lo, Column) else F.lit(float(lo))
    hi_c = hi if isinstance(hi, Column) else F.lit(float(hi))
    return F.least(F.greatest(c(col), lo_c), hi_c)


def price_warnings(price: str | Column, raw_price: str | Column) -> Column:
    """constant notice, plus the clipping notice when the point price moved."""
    return F.array_compact(
        F.array(
            F.lit(HISTORICAL_NOTICE),
            F.when(c(price) != c(raw_price), F.lit(CLIPPED_NOTICE)),
        )
    )


def cpi_factor() -> float:
    return CPI_REFERENCE / CPI_BASE


def cpi_adjust(amount: str | Column, factor: float | None = None) -> Column:
    """convert 2010 dollars into reference-year dollars."""
    return c(amount) * F.lit(cpi_factor() if factor is None else factor)


def rounded(col: str | Column, digits: int = 2) -> Column:
    """F16: half-up rounding (Spark ``round``); Python's is half-even."""
    return F.round(c(col), digits)


def residual(actual: str | Column, predicted: str | Column) -> Column:
    """F17."""
    return c(actual) - c(predicted)


def is_close(a: str | Column, b: str | Column, rtol: float = 1e-5, atol: float = 1e-8) -> Column:
    """``|a - b| <= atol + rtol * |b|``."""
    return F.abs(c(a) - c(b)) <= F.lit(atol) + F.lit(rtol) * F.abs(c(b))


def seeded_unit_hash(key: str | Column, seed: int) -> Column:
    """Deterministic 32-bit hash of ``seed:key`` as a bigint in [0, 2^32).

    md5-based so the same value is computable in any SQL engine; used for
    shuffled folds and random splits (D3-D6, V7).
    """
    text = F.concat(F.lit(f"{seed}:"), c(key).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def seeded_hash_sql(key_sql: str, seed: int) -> str:
    """DuckDB twin of :func:`seeded_unit_hash`."""
    return f"CAST(('0x' || substr(md5('{seed}:' || CAST({key_sql} AS VARCHAR)), 1, 8)) AS BIGINT)"


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson correlation as an aggregate that yields NULL (not an ANSI
    divide-by-zero error) when either side is constant."""
    xm = F.when(y.isNotNull(), x)  # pairwise deletion for every moment
    ym = F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(xm, ym), F.stddev_pop(xm) * F.stddev_pop(ym))
