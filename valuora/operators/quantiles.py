"""Grouped quantiles with linear interpolation (A14, and every median).

Three methods, same output shape (group columns + ``q array<double>``):

``exact``
    Spark's ``percentile``: linear interpolation, identical to NumPy's default
    and DuckDB's ``quantile_cont``.  It keeps a value->count map per group in
    one task, so use it only where every group is bounded.
``approx``
    ``percentile_approx`` (Greenwald-Khanna sketch, mergeable partials,
    bounded memory).  Returns observed values, not interpolated ones.
``refine``
    Exact *and* distributed, the same plan for every size: one scan sketches
    each group and brackets the order statistics, a second scan counts what
    lies below each bracket and keeps the values inside (ties collapsed to
    ``(value, count)``), and those are ranked.  Brackets widen in steps until
    they hold a few ranks, so a group of three rows and one of a billion take
    the same way; no task ever holds a whole large group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from valuora.session import materialize


def grouped_quantiles(
    df: DataFrame,
    group_cols: Sequence[str],
    value: str,
    probs: Sequence[float],
    method: str = "exact",
    accuracy: int = 100_000,
) -> DataFrame:
    """Quantiles of ``value`` per group; nulls are ignored; empty groups are absent."""
    probs = [float(p) for p in probs]
    x = F.col(value).cast("double")
    src = df.select(*group_cols, x.alias("__x")).where(F.col("__x").isNotNull())
    if method == "exact":
        return src.groupBy(*group_cols).agg(F.percentile("__x", probs).alias("q")) if group_cols else \
            src.agg(F.percentile("__x", probs).alias("q"))
    if method == "approx":
        agg = F.percentile_approx("__x", probs, accuracy).cast("array<double>").alias("q")
        return src.groupBy(*group_cols).agg(agg) if group_cols else src.agg(agg)
    if method == "refine":
        return _refined(src, list(group_cols), probs, accuracy)
    raise ValueError(f"Unknown quantile method {method!r}")


def _refined(src: DataFrame, groups: list[str], probs: list[float], accuracy: int) -> DataFrame:
    k = len(probs)
    # Bracket half-widths as shares of the group: the sketch's rank error is below
    # n / accuracy, and neighbouring ranks are 1 / n apart, so the first width of
    # at least 3 / accuracy and 3 / n surely holds both ranks that p needs.
    widths = [3.0 / accuracy]
    while widths[-1] < 1.0:
        widths.append(min(1.0, widths[-1] * 10))
    ends = [min(1.0, max(0.0, p + side * w)) for p in probs for w in widths for side in (-1, 1)]
    stats = [F.count(F.lit(1)).alias("__n"), F.percentile_approx("__x", ends, accuracy).cast("array<double>").alias("__s")]
    sketch = materialize(src.groupBy(*groups).agg(*stats) if groups else src.agg(*stats), "quantile-sketch")
    level = F.least(F.size(F.filter(F.array(*[F.lit(w) for w in widths]), lambda w: w * F.col("__n") < 3.0)), F.lit(len(widths) - 1))
    at = [1 + 2 * (j * len(widths) + level) for j in range(k)]
    brackets = sketch.select(
        *groups, "__n", F.array(*[F.element_at("__s", i) for i in at]).alias("__lo"),
        F.array(*[F.element_at("__s", i + 1) for i in at]).alias("__hi"))
    if groups:
        named = brackets.withColumnsRenamed({g: f"__k{i}" for i, g in enumerate(groups)})
        same = [src[g].eqNullSafe(named[f"__k{i}"]) for i, g in enumerate(groups)]
        joined = src.join(named, same).select(*groups, "__x", "__n", "__lo", "__hi")
    else:  # one group: its brackets are a few literals, no join
        row = brackets.first()
        lits = [F.array(*[F.lit(v).cast("double") for v in row[c] or [None] * k]).alias(c) for c in ("__lo", "__hi")]
        joined = src.select("__x", F.lit(row["__n"]).cast("long").alias("__n"), *lits)
    one = joined.select(*groups, "__x", "__n", F.posexplode(F.arrays_zip("__lo", "__hi")).alias("__j", "__b"))
    cells = (
        one.where(F.col("__x") <= F.col("__b.__hi"))
        .select(*groups, "__j", "__n", F.when(F.col("__x") >= F.col("__b.__lo"), F.col("__x")).alias("__x"))
        .groupBy(*groups, "__j", "__n", "__x").agg(F.count(F.lit(1)).alias("__c"))
    )
    # Running count within (group, j); the row without value holds all below.
    w = Window.partitionBy(*groups, "__j").orderBy(F.asc_nulls_first("__x")).rowsBetween(Window.unboundedPreceding, 0)
    ranked = cells.withColumn("__cum", F.sum("__c").over(w))
    probs_arr = F.array(*[F.lit(p) for p in probs])
    pos = (F.col("__n") - 1).cast("double") * F.element_at(probs_arr, F.col("__j") + 1)
    ranked = ranked.select(*groups, "__j", "__x", "__cum", pos.alias("__pos"))
    lo_rank = F.floor("__pos")
    hi_rank = F.ceil("__pos")
    picked = ranked.groupBy(*groups, "__j").agg(
        F.first("__pos").alias("__pos"),
        F.min(F.when(F.col("__cum") > lo_rank, F.col("__x"))).alias("__vlo"),
        F.min(F.when(F.col("__cum") > hi_rank, F.col("__x"))).alias("__vhi"),
    )
    lo_r, hi_r = F.floor("__pos"), F.ceil("__pos")
    value = F.when(lo_r == hi_r, F.col("__vlo")).otherwise(
        (hi_r - F.col("__pos")) * F.col("__vlo") + (F.col("__pos") - lo_r) * F.col("__vhi")
    )
    ordered = F.transform(
        F.array_sort(F.collect_list(F.struct(F.col("__j"), value.alias("v")))), lambda s: s["v"]).alias("q")
    if groups:
        return picked.groupBy(*groups).agg(ordered)
    return picked.agg(ordered).where(F.size("q") > 0)


def median_by(df: DataFrame, group_cols: Sequence[str], value: str, alias: str, method: str = "exact") -> DataFrame:
    """Median per group as a scalar column."""
    q = grouped_quantiles(df, group_cols, value, [0.5], method)
    return q.select(*group_cols, F.col("q")[0].alias(alias))
