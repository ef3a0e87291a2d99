"""Temporal model comparison and one-SE selection.

Two flavours share the table logic:

* :func:`closed_form_comparison` fits the median baseline and univariate
  least-squares candidates for **all folds in one grouped job**: the expanding
  folds are a tag on the rows (D2), every fold's fit is a ``groupBy`` of
  moments (or a distributed median) over its training rows, and predictions
  are a broadcast join of the per-fold parameters to the validation rows.
* :func:`valuora.plans.models.temporal_model_comparison` loops over
  ``pyspark.ml`` estimators fold by fold (ridge, elastic net, boosted trees).

Both emit the same long out-of-fold table
``(model, validation_year, <key>, label, prediction)``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuora.operators.metrics import fold_metrics, fold_summary
from valuora.operators.quantiles import grouped_quantiles
from valuora.operators.splits import expanding_folds

# Complexity ranks of the production candidates (lower = simpler),
# the minimum relative gain over the baseline, and the baseline's name.
PRODUCTION_COMPLEXITY = {"ridge": 1, "elastic_net": 2, "gradient_boosting": 3, "hist_gradient_boosting": 4}
MIN_IMPROVEMENT = 0.20
BASELINE = "baseline"
SELECTION_RULE = "simplest candidate whose error is within one standard error of the best; the median unless 20% is gained"


def _fit_closed_form(train: DataFrame, label: str, univariate: Mapping[str, str], method: str) -> DataFrame:
    """Per-fold parameters ``(validation_year, model, intercept, slope)``."""
    med = grouped_quantiles(train, ["validation_year"], label, [0.5], method).select(
        "validation_year", F.lit(BASELINE).alias("model"), F.col("q")[0].alias("intercept"),
        F.lit(0.0).alias("slope"), F.lit(None).cast("string").alias("feature"),
    )
    parts = [med]
    if univariate:
        y = F.col(label)
        aggs = []
        for name, feat in univariate.items():
            x = F.coalesce(F.col(feat).cast("double"), F.lit(0.0))
            aggs += [F.covar_pop(x, y).alias(f"{name}__cov"), F.var_pop(x).alias(f"{name}__var"),
                     F.avg(x).alias(f"{name}__mx")]
        moments = train.groupBy("validation_year").agg(F.avg(y).alias("__my"), *aggs)
        for name, feat in univariate.items():
            slope = F.when(F.col(f"{name}__var") > 0, F.col(f"{name}__cov") / F.col(f"{name}__var")).otherwise(0.0)
            parts.append(moments.select(
                "validation_year", F.lit(name).alias("model"),
                (F.col("__my") - slope * F.col(f"{name}__mx")).alias("intercept"), slope.alias("slope"),
                F.lit(feat).alias("feature"),
            ))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _predict_closed_form(rows: DataFrame, params: DataFrame, univariate: Mapping[str, str], fold_col: str | None) -> DataFrame:
    """Attach ``model`` and ``prediction`` to every row for every model."""
    feats = sorted(set(univariate.values()))
    xcol = F.lit(0.0)
    for f in feats:
        xcol = F.when(F.col("feature") == f, F.coalesce(F.col(f).cast("double"), F.lit(0.0))).otherwise(xcol)
    keys = [fold_col] if fold_col else []
    joined = rows.join(F.broadcast(params), keys) if keys else rows.crossJoin(F.broadcast(params))
    return joined.withColumn("prediction", F.col("intercept") + F.col("slope") * xcol).drop(
        "intercept", "slope", "feature")


def closed_form_comparison(
    df: DataFrame,
    year: str,
    validation_years: Sequence[int],
    label: str,
    univariate: Mapping[str, str],
    key: str,
    method: str = "refine",
) -> DataFrame:
    """M1+M2+M5 closed form: out-of-fold predictions for all candidates and folds.

    Returns ``model, validation_year, <key>, label, prediction``.  The fold
    parameter table has ``folds x models`` rows (bounded by the parameters),
    so it is broadcast to the validation rows.
    """
    tagged = expanding_folds(df, year, validation_years, check=False)
    train = tagged.where(F.col("role") == "train")
    valid = tagged.where(F.col("role") == "validate")
    params = _fit_closed_form(train, label, univariate, method)
    params = df.sparkSession.createDataFrame(params.collect(), params.schema)
    feats = sorted(set(univariate.values()))
    preds = _predict_closed_form(valid.select("validation_year", key, label, *feats), params, univariate, "validation_year")
    return preds.select("model", "validation_year", key, F.col(label).alias("label"), "prediction")


def fit_closed_form_all(df: DataFrame, label: str, model: str, univariate: Mapping[str, str], method: str = "refine") -> DataFrame:
    """Refit one closed-form candidate on all development rows."""
    tagged = df.withColumn("validation_year", F.lit(0))
    params = _fit_closed_form(tagged, label, {k: v for k, v in univariate.items() if k == model}, method)
    params = params.where(F.col("model") == model).drop("validation_year")
    return df.sparkSession.createDataFrame(params.collect(), params.schema)


def predict_with(df: DataFrame, params: DataFrame, univariate: Mapping[str, str]) -> DataFrame:
    """Apply a fitted closed-form model (one row of parameters) to any rows."""
    return _predict_closed_form(df, params, univariate, None).drop("model")


def comparison_report(oof: DataFrame) -> DataFrame:
    """A6 + A7: per-fold metrics plus summary rows (mean, standard error)."""
    per_fold = fold_metrics(oof, "label", "prediction", ("model", "validation_year"))
    summary = fold_summary(per_fold).drop("n_folds")
    return per_fold.withColumn("fold", F.col("validation_year").cast("string")).unionByName(
        summary.withColumn("fold", F.lit("summary")), allowMissingColumns=True
    )


def select_model(summary: DataFrame, complexity: Mapping[str, int], min_improvement: float = MIN_IMPROVEMENT) -> DataFrame:
    """M6: one-standard-error rule.

    ``summary`` has one row per model with ``log_rmse`` and ``log_rmse_se``.
    Threshold = best (baseline included) mean + its SE; eligible = non-baseline
    models at or under it; the least complex eligible model wins; the baseline
    wins when nothing is eligible or the best non-baseline model improves on
    the baseline by less than ``min_improvement``.  One-row decision record.
    """
    spark = summary.sparkSession
    ranks = spark.createDataFrame(list(complexity.items()), "model string, complexity int")
    s = summary.select("model", "log_rmse", "log_rmse_se")
    head = s.agg(
        F.min_by(F.col("model"), F.struct("log_rmse", "model")).alias("best_cv_model"),
        F.min_by(F.col("log_rmse") + F.col("log_rmse_se"), F.struct("log_rmse", "model")).alias("one_se_threshold"),
        F.max(F.when(F.col("model") == BASELINE, F.col("log_rmse"))).alias("__base"),
        F.min(F.when(F.col("model") != BASELINE, F.col("log_rmse"))).alias("__best_model"),
    ).withColumn("baseline_improvement", F.lit(1.0) - F.col("__best_model") / F.col("__base"))
    eligible = (
        s.join(F.broadcast(ranks), "model").crossJoin(head.select("one_se_threshold"))
        .where((F.col("model") != BASELINE) & (F.col("log_rmse") <= F.col("one_se_threshold")))
        .agg(F.min_by(F.col("model"), F.struct("complexity", "model")).alias("__eligible"))
    )
    chosen = F.when(
        (F.col("baseline_improvement") < F.lit(min_improvement)) | F.col("__eligible").isNull(), F.lit(BASELINE)
    ).otherwise(F.col("__eligible"))
    return head.crossJoin(eligible).select(
        chosen.alias("chosen"), "best_cv_model", "one_se_threshold", "baseline_improvement",
        F.lit(SELECTION_RULE).alias("selection_rule"),
    )
