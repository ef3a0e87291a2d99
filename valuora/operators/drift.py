"""Population drift and delayed-label monitoring.

The whole report is a handful of grouped jobs over *long* tables: every
numeric feature is unpivoted to ``(feature, x)`` so all PSIs come from one
edges aggregate on the reference, one bin-count aggregate per side and one
small join, instead of one pass per column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from valuora.functions.columns import is_close, lenient_double
from valuora.operators.quantiles import grouped_quantiles

SHARE_FLOOR = 1e-6
REPORT_COLUMNS = ("section", "feature", "metric", "value")


def _spark(df: DataFrame) -> SparkSession:
    return df.sparkSession


def numeric_long(df: DataFrame, features: Sequence[str], value: str = "x") -> DataFrame:
    """Unpivot numeric features into ``(feature, x)``; values are leniently coerced."""
    wide = df.select(*[lenient_double(F.col(f)).alias(f) for f in features])
    return wide.unpivot([], list(features), "feature", value)


def category_long(df: DataFrame, features: Sequence[str], value: str = "v") -> DataFrame:
    """Unpivot categorical features into ``(feature, v)`` as strings."""
    wide = df.select(*[F.col(f).cast("string").alias(f) for f in features])
    return wide.unpivot([], list(features), "feature", value)


def _feature_spine(spark: SparkSession, features: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(f,) for f in features], "feature string")


def psi_edges(
    reference_long: DataFrame, bins: int = 10, method: str = "refine", accuracy: int = 1_000_000
) -> DataFrame:
    """Per-feature decile edges of the reference, de-duplicated and sorted.

    Returns ``feature, n_ref, first_value, inner_edges`` where ``inner_edges``
    are the unique edges without the outer two (which become -inf/+inf).
    """
    probs = [i / bins for i in range(bins + 1)]
    q = grouped_quantiles(
        reference_long.where(F.col("x").isNotNull()), ["feature"], "x", probs, method, accuracy
    )
    stats = reference_long.where(F.col("x").isNotNull()).groupBy("feature").agg(
        F.count("x").alias("n_ref"), F.min("x").alias("first_value")
    )
    uniq = F.array_sort(F.array_distinct(F.col("q")))
    return q.join(stats, "feature").select(
        "feature",
        "n_ref",
        "first_value",
        F.size(uniq).alias("n_edges"),
        F.when(F.size(uniq) >= 3, F.slice(uniq, 2, F.size(uniq) - 2)).alias("inner_edges"),
    )


def fit_edges(reference_long: DataFrame, bins: int = 10, method: str = "refine") -> DataFrame:
    """Fit the reference edges once and return them as a small local table.

    The fitted state has one row per feature (at most ``bins + 1`` values
    each), so collecting it is bounded by the parameters, not by the data; the
    re-created frame is then safe to broadcast and is reused by every later
    step (and frozen for streaming drift) without recomputing the quantiles.
    """
    fitted = psi_edges(reference_long, bins, method)
    rows = fitted.collect()
    return reference_long.sparkSession.createDataFrame(rows, fitted.schema)


def _bin_shares(long: DataFrame, edges: DataFrame, side: str) -> DataFrame:
    binned = long.where(F.col("x").isNotNull()).join(edges.select("feature", "inner_edges"), "feature")
    binned = binned.where(F.col("inner_edges").isNotNull()).select(
        "feature", F.size(F.filter("inner_edges", lambda e: e <= F.col("x"))).alias("bin")
    )
    counts = binned.groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy("feature"))
    return counts.select("feature", "bin", (F.col("n") / total).alias(side))


def population_stability(
    reference_long: DataFrame,
    current_long: DataFrame,
    features: Sequence[str],
    bins: int = 10,
    method: str = "refine",
) -> DataFrame:
    """PSI per feature from two ``(feature, x)`` tables.

    Left-closed bins on the reference's unique decile edges with open outer
    bins; shares floored at 1e-6; ``sum((cur-ref)*ln(cur/ref))``.  Fewer than 3
    unique edges: share of current values not close to the reference value.
    Either side empty: null.
    """
    spark = _spark(reference_long)
    edges = F.broadcast(fit_edges(reference_long, bins, method))
    ref = _bin_shares(reference_long, edges, "ref_share")
    cur = _bin_shares(current_long, edges, "cur_share")
    floor = F.lit(SHARE_FLOOR)
    r = F.greatest(F.coalesce(F.col("ref_share"), F.lit(0.0)), floor)
    cshare = F.greatest(F.coalesce(F.col("cur_share"), F.lit(0.0)), floor)
    psi = ref.join(cur, ["feature", "bin"], "full_outer").groupBy("feature").agg(
        F.sum((cshare - r) * F.log(cshare / r)).alias("psi_binned")
    )
    cur_stats = (
        current_long.where(F.col("x").isNotNull())
        .join(edges.select("feature", "first_value"), "feature")
        .groupBy("feature")
        .agg(
            F.count(F.lit(1)).alias("n_cur"),
            F.avg((~is_close("x", "first_value")).cast("double")).alias("outside_rate"),
        )
    )
    out = (
        _feature_spine(spark, features)
        .join(edges.drop("inner_edges"), "feature", "left")
        .join(cur_stats, "feature", "left")
        .join(psi, "feature", "left")
    )
    value = (
        F.when(F.coalesce(F.col("n_ref"), F.lit(0)) == 0, F.lit(None).cast("double"))
        .when(F.coalesce(F.col("n_cur"), F.lit(0)) == 0, F.lit(None).cast("double"))
        .when(F.col("n_edges") < 3, F.col("outside_rate"))
        .otherwise(F.coalesce(F.col("psi_binned"), F.lit(0.0)))
    )
    return out.select("feature", value.alias("psi"))


def psi_columns(
    reference: DataFrame, current: DataFrame, features: Sequence[str], bins: int = 10, method: str = "refine"
) -> DataFrame:
    """R1 over wide tables: ``feature, psi``."""
    return population_stability(
        numeric_long(reference, features), numeric_long(current, features), features, bins, method
    )


def missing_rates(df: DataFrame, features: Sequence[str], name: str = "missing_rate") -> DataFrame:
    """Share of null (or NaN) values per column, all columns in one pass."""
    wide = df.select(*[lenient_double(F.col(f)).isNull().cast("double").alias(f) if _is_numeric(df, f)
                       else F.col(f).isNull().cast("double").alias(f) for f in features])
    agg = wide.agg(*[F.avg(f).alias(f) for f in features])
    return agg.unpivot([], list(features), "feature", name)


def _is_numeric(df: DataFrame, name: str) -> bool:
    from pyspark.sql.types import NumericType

    return isinstance(df.schema[name].dataType, NumericType)


def numeric_section(
    reference: DataFrame, current: DataFrame, features: Sequence[str], bins: int = 10, method: str = "refine"
) -> DataFrame:
    """PSI and both missing rates per numeric feature."""
    psi = psi_columns(reference, current, features, bins, method)
    ref_m = missing_rates(reference, features, "reference_missing_rate")
    cur_m = missing_rates(current, features, "current_missing_rate")
    return psi.join(ref_m, "feature", "left").join(cur_m, "feature", "left")


def categorical_section(reference: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    """Novel-category rate among non-null current values + current missing rate.

    The known set is the reference's distinct ``(feature, value)`` pairs.  Current rows
    are counted by value first, so the membership join meets each value once, however
    often it occurs (a hot value is one row).
    """
    spark = _spark(reference)
    known = (
        category_long(reference, features).where(F.col("v").isNotNull()).distinct()
        .withColumn("known", F.lit(True))
    )
    cur = category_long(current, features).groupBy("feature", "v").agg(F.count(F.lit(1)).cast("double").alias("n"))
    flagged = cur.join(known, ["feature", "v"], "left")
    present = F.col("v").isNotNull()
    seen, novel = F.sum(F.when(present, F.col("n"))), F.sum(F.when(present & F.col("known").isNull(), F.col("n")).otherwise(0.0))
    stats = flagged.groupBy("feature").agg(
        F.when(seen > 0, novel / seen).alias("novel"),
        (F.sum(F.when(~present, F.col("n")).otherwise(0.0)) / F.sum("n")).alias("current_missing_rate"),
    )
    return _feature_spine(spark, features).join(stats, "feature", "left").select(
        "feature",
        F.coalesce(F.col("novel"), F.lit(0.0)).alias("novel_category_rate"),
        "current_missing_rate",
    )


def range_section(current: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Share of rows outside ``[min, max]``; nulls count as in range."""
    names = list(bounds)
    exprs = []
    for name in names:
        lo, hi = bounds[name]
        x = lenient_double(F.col(name))
        bad = F.coalesce((x < F.lit(float(lo))) | (x > F.lit(float(hi))), F.lit(False))
        exprs.append(F.avg(bad.cast("double")).alias(name))
    return current.agg(*exprs).unpivot([], names, "feature", "violation_rate")


def delayed_label_performance(scored: DataFrame, actual: str = "actual_price", predicted: str = "predicted_price") -> DataFrame:
    """Log-RMSE and dollar MAE of predictions once labels are known."""
    a, p = F.col(actual), F.col(predicted)
    return scored.agg(
        F.sqrt(F.avg(F.pow(F.log1p(a) - F.log1p(p), 2))).alias("log_rmse"),
        F.avg(F.abs(a - p)).alias("dollar_mae"),
    )


def prediction_shift(reference: DataFrame, current: DataFrame, predicted: str = "predicted_price", method: str = "refine") -> DataFrame:
    """PSI of the predicted price plus both means."""
    psi = psi_columns(reference, current, [predicted], method=method)
    ref_mean = reference.agg(F.avg(predicted).alias("reference_mean"))
    cur_mean = current.agg(F.avg(predicted).alias("current_mean"))
    return psi.crossJoin(ref_mean).crossJoin(cur_mean).drop("feature")


def drift_report(
    reference: DataFrame,
    current: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    bounds: Mapping[str, tuple[float, float]],
    actual: str = "actual_price",
    predicted: str = "predicted_price",
    bins: int = 10,
    method: str = "refine",
    materialize_inputs: bool = True,
) -> DataFrame:
    """The whole report as long rows ``(section, feature, metric, value)``.

    Sections: ``numeric`` (psi, reference/current missing rate),
    ``categorical`` (novel_category_rate, current_missing_rate),
    ``range_violations`` (violation_rate), and when the columns exist
    ``delayed_label_performance`` and ``prediction_shift``.  Each side is counted
    once (:mod:`valuora.operators.drift_cells`); the reference's quantiles take two more scans.
    """
    from valuora.operators import drift_cells as C
    from valuora.session import materialize

    if materialize_inputs:
        reference = materialize(reference, "drift-reference")  # scanned three times
    has = lambda name: name if name in current.columns else None
    frozen = C.freeze(reference, numeric, categorical, bounds, has(actual) if has(predicted) else None, has(predicted), bins, method)
    return C.report_from_cells(materialize(C.current_cells(current, frozen), "drift-current-cells"), frozen)


def report_document(report: DataFrame) -> dict:
    """Nest the long report into ``{section: {feature: {metric: value}}}``.

    The report has a fixed, small number of rows (features x metrics), so
    bringing it to the driver for the JSON artifact is bounded.
    """
    import math

    doc: dict = {}
    for row in report.collect():
        section = doc.setdefault(row["section"], {})
        value = row["value"]
        value = None if value is None or (isinstance(value, float) and not math.isfinite(value)) else value
        if row["feature"] is None or row["section"] == "prediction_shift":
            section[row["metric"]] = value
        elif row["section"] == "range_violations":
            section[row["feature"]] = value
        else:
            section.setdefault(row["feature"], {})[row["metric"]] = value
    return doc
