"""Regression metrics, fold summaries, error slices, calibration stats
(A2-A8, A15-A17, A21)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from valuora.operators.quantiles import grouped_quantiles

EPS = 2.220446049250313e-16  # float64 machine epsilon (MAPE guard)


def _r2(sse: Column, n: Column, var_pop: Column) -> Column:
    """``1 - SSE / SST``; a constant label gives 1 for a perfect fit, else 0."""
    sst = n * var_pop
    return F.when(sst > 0, F.lit(1.0) - sse / sst).when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0))


def adjusted_r2(r2: Column, n: Column, p: Column | int) -> Column:
    """A5: ``1-(1-r2)(n-1)/(n-p-1)``; null when ``n <= p+1``."""
    p_col = p if isinstance(p, Column) else F.lit(p)
    denom = n - p_col - 1
    return F.when(denom > 0, F.lit(1.0) - (F.lit(1.0) - r2) * (n - 1) / denom)


def metric_exprs(true_log: str, pred_log: str, n_features: int | None = None) -> list[Column]:
    """A4: log- and dollar-space metrics as aggregate expressions (one pass).

    Dollars are ``expm1`` of the log values; MAPE guards the denominator with
    machine epsilon.
    """
    yl, pl = F.col(true_log), F.col(pred_log)
    y, p = F.expm1(yl), F.expm1(pl)
    el, ed = yl - pl, y - p
    n = F.count(F.lit(1)).cast("double")
    sse_l, sse_d = F.sum(el * el), F.sum(ed * ed)
    log_r2 = _r2(sse_l, n, F.var_pop(yl))
    out = [
        F.sqrt(F.avg(el * el)).alias("log_rmse"),
        F.avg(F.abs(el)).alias("log_mae"),
        F.avg(el * el).alias("log_mse"),
        log_r2.alias("log_r2"),
        (adjusted_r2(log_r2, n, n_features) if n_features is not None else F.lit(None).cast("double")).alias("log_adj_r2"),
        F.sqrt(F.avg(ed * ed)).alias("dollar_rmse"),
        F.avg(F.abs(ed)).alias("dollar_mae"),
        F.avg(ed * ed).alias("dollar_mse"),
        _r2(sse_d, n, F.var_pop(y)).alias("dollar_r2"),
        F.avg(F.abs(ed) / F.greatest(F.abs(y), F.lit(EPS))).alias("dollar_mape"),
    ]
    return out


def regression_metrics(df: DataFrame, true_log: str, pred_log: str, n_features: int | None = None,
                       group: Sequence[str] = ()) -> DataFrame:
    """A4/A5 (optionally per group)."""
    exprs = metric_exprs(true_log, pred_log, n_features)
    return df.groupBy(*group).agg(*exprs) if group else df.agg(*exprs)


def fold_metrics(scored: DataFrame, true_log: str = "label", pred_log: str = "prediction",
                 keys: Sequence[str] = ("model", "validation_year")) -> DataFrame:
    """Log rmse, log mae, dollar mae, log r2 per (model, fold)."""
    yl, pl = F.col(true_log), F.col(pred_log)
    el = yl - pl
    ed = F.expm1(yl) - F.expm1(pl)
    n = F.count(F.lit(1)).cast("double")
    return scored.groupBy(*keys).agg(
        F.sqrt(F.avg(el * el)).alias("log_rmse"),
        F.avg(F.abs(el)).alias("log_mae"),
        F.avg(F.abs(ed)).alias("dollar_mae"),
        _r2(F.sum(el * el), n, F.var_pop(yl)).alias("log_r2"),
    )


def fold_summary(per_fold: DataFrame, metric: str = "log_rmse", model: str = "model") -> DataFrame:
    """Mean and standard error (``stddev_samp / sqrt(k)``) per model."""
    return per_fold.groupBy(model).agg(
        F.avg(metric).alias(metric),
        (F.stddev_samp(metric) / F.sqrt(F.count(metric))).alias(f"{metric}_se"),
        F.count(metric).alias("n_folds"),
    )


def comparison_table(per_fold: DataFrame, fold_col: str = "validation_year") -> DataFrame:
    """Per-fold rows plus one ``summary`` row per model (columns null
    where not applicable), as the reference's comparison report."""
    summary = fold_summary(per_fold).drop("n_folds")
    folds = per_fold.withColumn("fold", F.col(fold_col).cast("string"))
    summ = summary.withColumn("fold", F.lit("summary"))
    return folds.unionByName(summ, allowMissingColumns=True)


def ranked_table(table: DataFrame, metrics: Sequence[str] = ("log_rmse_mean", "log_rmse"), keys: Sequence[str] = ("model",),
                 descending: bool = False) -> DataFrame:
    """A comparison table sorted by the first of ``metrics`` that it has, with its ``rank``.

    Nulls come last, ties go by ``keys``.  A comparison table has a row per run, so one sorted
    window holds it; a table with none of the metrics raises.
    """
    metric = next((m for m in metrics if m in table.columns), None)
    if metric is None:
        raise ValueError(f"a comparison table needs one of {list(metrics)}")
    order = F.desc_nulls_last(metric) if descending else F.asc_nulls_last(metric)
    return table.withColumn("rank", F.row_number().over(Window.orderBy(order, *keys))).orderBy("rank")


def cv_summary(per_fold: DataFrame, metrics: Sequence[str], group: Sequence[str] = ("run",)) -> DataFrame:
    """``<metric>_mean`` and ``<metric>_std`` (ddof 1) over folds."""
    aggs = []
    for m in metrics:
        aggs += [F.avg(m).alias(f"{m}_mean"), F.stddev_samp(m).alias(f"{m}_std")]
    return per_fold.groupBy(*group).agg(*aggs)


def error_by_group(scored: DataFrame, group: str, actual: str = "actual_price", predicted: str = "predicted_price") -> DataFrame:
    """A2: count, mean actual, mean predicted and MAE per group."""
    return scored.groupBy(group).agg(
        F.count(F.lit(1)).alias("count"),
        F.avg(actual).alias("actual_mean"),
        F.avg(predicted).alias("prediction_mean"),
        F.avg(F.abs(F.col(actual) - F.col(predicted))).alias("mae"),
    )


def error_by_quantile_band(scored: DataFrame, actual: str = "actual_price", predicted: str = "predicted_price",
                           q: int = 4, method: str = "refine") -> DataFrame:
    """A3: quantile bands of the actual value (right-closed, first includes the
    minimum, duplicate edges dropped) with the A2 statistics."""
    edges = grouped_quantiles(scored, [], actual, [i / q for i in range(q + 1)], method).first()["q"]
    uniq = sorted(set(edges))
    inner = uniq[1:-1]
    a = F.col(actual).cast("double")
    band = F.size(F.filter(F.array(*[F.lit(float(e)) for e in inner]), lambda e: a > e)) if inner else F.lit(0)
    lowers = F.array(*[F.lit(float(e)) for e in uniq[:-1]])
    uppers = F.array(*[F.lit(float(e)) for e in uniq[1:]])
    banded = scored.withColumn("band", band)
    return error_by_group(banded, "band", actual, predicted).select(
        "band", F.element_at(lowers, F.col("band") + 1).alias("band_low"),
        F.element_at(uppers, F.col("band") + 1).alias("band_high"), "count", "actual_mean", "prediction_mean", "mae",
    )


def residual_calibration(residuals: DataFrame, residual: str = "residual", low: float = 0.05, high: float = 0.95,
                         method: str = "refine") -> DataFrame:
    """Smearing factor ``mean(exp(r))`` and residual quantiles."""
    q = grouped_quantiles(residuals, [], residual, [low, high], method)
    sm = residuals.agg(F.avg(F.exp(residual)).alias("smearing_factor"), F.count(F.lit(1)).alias("n_residuals"))
    return sm.crossJoin(q).select("smearing_factor", "n_residuals", F.col("q")[0].alias("residual_q_low"),
                                  F.col("q")[1].alias("residual_q_high"))


def price_bounds(df: DataFrame, target: str, method: str = "refine") -> DataFrame:
    """``max(0, q0.001 * 0.5)`` and ``q0.999 * 1.5`` of the target."""
    q = grouped_quantiles(df, [], target, [0.001, 0.999], method)
    return q.select(
        F.greatest(F.lit(0.0), F.col("q")[0] * 0.5).alias("price_min"),
        (F.col("q")[1] * 1.5).alias("price_max"),
    )


def interval_coverage(scored: DataFrame, actual: str, low: str, high: str) -> Column:
    """Share of rows with ``low <= actual <= high`` (aggregate expression)."""
    return F.avg(F.col(actual).between(F.col(low), F.col(high)).cast("double"))


def argmin(df: DataFrame, label: str, value: str) -> DataFrame:
    """The label with the smallest value (ties: smallest label)."""
    return df.agg(F.min_by(F.col(label), F.struct(F.col(value), F.col(label))).alias(label),
                  F.min(value).alias(value))
