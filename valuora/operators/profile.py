"""Data-profiling aggregates (A1, A9-A13, A18, A19) and plot tables (V1-V4, V7).

Every statistic over many columns is one ``agg`` (one scan) or an
``unpivot`` followed by one grouped job; nothing loops over columns with a
job per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuora.functions.columns import safe_corr, seeded_unit_hash
from valuora.operators.joins import exact_positions
from valuora.operators.quantiles import grouped_quantiles


def group_medians(df: DataFrame, group: str, value: str, method: str = "refine") -> tuple[DataFrame, DataFrame]:
    """A1: per-group median and the global median (nulls skipped)."""
    per_group = grouped_quantiles(df, [group], value, [0.5], method).select(group, F.col("q")[0].alias("median"))
    overall = grouped_quantiles(df, [], value, [0.5], method).select(F.col("q")[0].alias("median"))
    return per_group, overall


def missingness_table(df: DataFrame, informative: Sequence[str] = (), columns: Sequence[str] | None = None) -> DataFrame:
    """A10: ``feature, n_missing, pct_missing (2 dp), kind`` for columns with nulls."""
    cols = list(columns or df.columns)
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.sum(F.col(f"`{c}`").isNull().cast("long")).alias(c) for c in cols],
    )
    long = counts.unpivot(["__rows"], cols, "feature", "n_missing")
    kind = F.when(F.col("feature").isin(list(informative)), "informative").otherwise("true gap") if informative \
        else F.lit("true gap")
    return long.where(F.col("n_missing") > 0).select(
        "feature",
        "n_missing",
        F.round(F.col("n_missing") / F.col("__rows") * 100, 2).alias("pct_missing"),
        kind.alias("kind"),
    )


def skewness_table(df: DataFrame, columns: Sequence[str], threshold: float = 0.75) -> DataFrame:
    """Bias-corrected sample skewness, ``|skew| > threshold``.

    Spark's ``skewness`` is the population g1; the corrected G1 multiplies by
    ``sqrt(n(n-1))/(n-2)`` (undefined for n < 3 or constant columns).
    """
    cols = list(columns)
    aggs = []
    for c in cols:
        n = F.count(c).cast("double")
        g1 = F.skewness(c)
        aggs.append(F.when(n >= 3, g1 * F.sqrt(n * (n - 1)) / (n - 2)).alias(c))
    long = df.agg(*aggs).unpivot([], cols, "feature", "skew")
    return long.where(F.col("skew").isNotNull() & ~F.isnan("skew") & (F.abs("skew") > threshold))


def target_correlations(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Pearson correlation of each column with the target (pairwise deletion)."""
    cols = [c for c in columns if c != target]
    wide = df.agg(*[safe_corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(c) for c in cols])
    return wide.unpivot([], cols, "feature", "corr")


def correlation_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long correlation matrix ``(a, b, corr)`` of the given columns (one scan)."""
    cols = list(columns)
    names, aggs = [], []
    for i, a in enumerate(cols):
        for b in cols[i:]:
            name = f"{a}__{b}"
            names.append((a, b, name))
            aggs.append(safe_corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(name))
    row = df.agg(*aggs)
    long = row.unpivot([], [n for _, _, n in names], "pair", "corr")
    spark = df.sparkSession
    keys = spark.createDataFrame([(n, a, b) for a, b, n in names] + [(n, b, a) for a, b, n in names if a != b],
                                 "pair string, a string, b string")
    return long.join(F.broadcast(keys), "pair").select("a", "b", "corr")


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent value per column, smallest value on ties; null without values.

    Values are counted by column in one pass of grouping sets, then the most frequent is
    picked, so no task holds a column's whole value map.
    """
    cols = list(columns)
    counted = df.groupingSets([[F.col(c)] for c in cols], *cols).agg(
        F.count(F.lit(1)).alias("__n"), F.grouping_id().alias("__set"))
    whole = (1 << len(cols)) - 1
    picked = []
    for i, c in enumerate(cols):
        own = (F.col("__set") == whole - (1 << (len(cols) - 1 - i))) & F.col(c).isNotNull()
        picked.append(F.min_by(F.col(c), F.when(own, F.struct((-F.col("__n")).alias("n"), F.col(c).alias("v")))).alias(c))
    return counted.agg(*picked)


def distinct_and_min(df: DataFrame, columns: Sequence[str], approx: bool = False) -> DataFrame:
    """Distinct count and minimum per column (``approx`` uses HLL++)."""
    out = []
    for c in columns:
        nd = F.approx_count_distinct(c) if approx else F.count_distinct(c)
        out.extend([nd.alias(f"{c}__distinct"), F.min(c).cast("double").alias(f"{c}__min")])
    row = df.agg(*out)
    return row.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"{c}__distinct").alias("n_distinct"),
                                     F.col(f"{c}__min").alias("min")) for c in columns])).alias("s")
    ).select("s.*")


def histogram(df: DataFrame, value: str, bins: int = 30, log1p: bool = False) -> DataFrame:
    """V1: equal-width histogram ``(bin, lower, upper, n)`` plus the sample skew."""
    x = F.log1p(F.col(value).cast("double")) if log1p else F.col(value).cast("double")
    src = df.select(x.alias("x")).where(F.col("x").isNotNull())
    stats = src.agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count("x").alias("n"),
                    F.skewness("x").alias("g1"))
    width = (F.col("hi") - F.col("lo")) / F.lit(bins)
    b = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("x") - F.col("lo")) / width), F.lit(bins - 1))
    ).cast("int")
    binned = src.crossJoin(F.broadcast(stats)).select(b.alias("bin"), "lo", "hi", "n", "g1")
    n = F.col("n").cast("double")
    skew = F.when(n >= 3, F.col("g1") * F.sqrt(n * (n - 1)) / (n - 2))
    return binned.groupBy("bin", "lo", "hi", "n", "g1").agg(F.count(F.lit(1)).alias("count")).select(
        "bin",
        (F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / F.lit(bins)).alias("lower"),
        (F.col("lo") + (F.col("bin") + 1) * (F.col("hi") - F.col("lo")) / F.lit(bins)).alias("upper"),
        "count",
        skew.alias("skew"),
    )


def box_stats(df: DataFrame, group: str, value: str, method: str = "refine") -> DataFrame:
    """V3: per group q1, median, q3 and 1.5-IQR whiskers (no order; W5 is :func:`groups_by_median`)."""
    q = grouped_quantiles(df, [group], value, [0.25, 0.5, 0.75], method).select(
        group, F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3")
    )
    iqr = F.col("q3") - F.col("q1")
    fences = q.select("*", (F.col("q1") - 1.5 * iqr).alias("__lo"), (F.col("q3") + 1.5 * iqr).alias("__hi"))
    x = F.col(value).cast("double")
    whisk = df.select(group, x.alias("__x")).join(fences.select(group, "__lo", "__hi"), group).groupBy(group).agg(
        F.min(F.when(F.col("__x") >= F.col("__lo"), F.col("__x"))).alias("whisker_low"),
        F.max(F.when(F.col("__x") <= F.col("__hi"), F.col("__x"))).alias("whisker_high"),
        F.count(F.lit(1)).alias("n"),
    )
    return q.join(whisk, group)


def groups_by_median(df: DataFrame, group: str, value: str, method: str = "refine") -> DataFrame:
    """``group, median, n, rank``, groups ordered by their median (ties by the group).

    Groups without a value come first, as a null median does.  Ranks are places in the global
    order, taken from sorted range partitions, so any number of groups will do.
    """
    medians = grouped_quantiles(df, [group], value, [0.5], method).select(group, F.col("q")[0].alias("median"))
    counts = df.groupBy(group).agg(F.count(value).alias("n"))
    both = counts.alias("c").join(medians.alias("m"), F.col(f"c.{group}").eqNullSafe(F.col(f"m.{group}")), "left").select(
        F.col(f"c.{group}").alias(group), "median", "n")
    return exact_positions(both, ["median", group], "rank", "median-order").withColumn("rank", F.col("rank") + 1).orderBy("rank")


def calibration_bins(df: DataFrame, actual: str, predicted: str, bins: int = 10, method: str = "refine") -> DataFrame:
    """V4: prediction-decile bins with mean actual, mean predicted, mean residual."""
    probs = [i / bins for i in range(bins + 1)]
    q = grouped_quantiles(df, [], predicted, probs, method).first()["q"]
    inner = sorted(set(q))[1:-1]
    p = F.col(predicted).cast("double")
    b = F.size(F.filter(F.array(*[F.lit(float(e)) for e in inner]), lambda e: e <= p)) if inner else F.lit(0)
    return df.select(b.alias("bin"), F.col(actual).alias("a"), p.alias("p")).groupBy("bin").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("a").alias("actual_mean"),
        F.avg("p").alias("predicted_mean"),
        F.avg(F.col("a") - F.col("p")).alias("residual_mean"),
    )


def scatter_sample(df: DataFrame, key: str, columns: Sequence[str], fraction: float, seed: int) -> DataFrame:
    """V7: a seeded-hash sample of ``columns`` (the sample *is* the feature)."""
    threshold = int(round(fraction * 2**32))
    return df.where(seeded_unit_hash(key, seed) < F.lit(threshold)).select(key, *columns)
