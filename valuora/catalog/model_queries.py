"""Model comparison, selection, calibration, scoring and holdout queries
(M1, M2, M5, M6, M15-M21, A2, A3, A6, A7, A14-A17, A21).

The closed-form candidates are SQL-expressible end to end, so these queries
carry DuckDB twins.  The ``pyspark.ml`` variants are registered without an
oracle (rows-only check) and covered by pytest properties.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from valuora.catalog import register
from valuora.functions.columns import CLIPPED_NOTICE, CPI_NOTE, CPI_REFERENCE_YEAR, HISTORICAL_NOTICE, cpi_factor
from valuora.operators.metrics import cv_summary, error_by_group, error_by_quantile_band, fold_summary, ranked_table
from valuora.plans import closed_form as CF
from valuora.plans import production as P
from valuora.sources.tables import sales_source, HOLDOUT_YEAR, VALIDATION_YEARS, sales_table, with_sales

METHOD = "refine"
MODEL_VERSION = "closed-form-1"


def _trained(spark, sf_dir, target):
    return CF.train_and_evaluate(sales_source(spark, sf_dir), target, "sold_year", HOLDOUT_YEAR, VALIDATION_YEARS,
                                 method=METHOD, materialize_input=False)  # the source is materialised


def _pipeline_sql(target: str) -> list[str]:
    """CTEs reproducing the closed-form workflow in DuckDB for ``target``."""
    years = ", ".join(f"({y})" for y in VALIDATION_YEARS)
    ranks = ", ".join(f"('{m}', {r})" for m, r in CF.COMPLEXITY.items())
    ols_fold = []
    ols_all = []
    for name, feat in CF.UNIVARIATE.items():
        x = f"coalesce(CAST({feat} AS DOUBLE), 0.0)"
        slope = f"CASE WHEN var_pop({x}) > 0 THEN covar_pop({x}, label) / var_pop({x}) ELSE 0.0 END"
        ols_fold.append(
            f"SELECT validation_year, '{name}' AS model, avg(label) - ({slope}) * avg({x}) AS intercept, {slope} AS slope, "
            f"'{feat}' AS feature FROM tagged WHERE role = 'train' GROUP BY validation_year")
        ols_all.append(
            f"SELECT '{name}' AS model, avg(label) - ({slope}) * avg({x}) AS intercept, {slope} AS slope, '{feat}' AS feature FROM dev")
    xcase = "CASE " + " ".join(
        f"WHEN p.feature = '{f}' THEN coalesce(CAST(t.{f} AS DOUBLE), 0.0)" for f in sorted(set(CF.UNIVARIATE.values()))
    ) + " ELSE 0.0 END"
    return [
        f"dev AS (SELECT *, ln(1 + {target}) AS label FROM sales WHERE sold_year < {HOLDOUT_YEAR})",
        f"hold AS (SELECT * FROM sales WHERE sold_year = {HOLDOUT_YEAR})",
        f"folds AS (SELECT * FROM (VALUES {years}) v(validation_year))",
        f"ranks AS (SELECT * FROM (VALUES {ranks}) r(model, complexity))",
        """tagged AS (SELECT d.*, f.validation_year,
            CASE WHEN d.sold_year = f.validation_year THEN 'validate' ELSE 'train' END AS role
            FROM dev d JOIN folds f ON d.sold_year <= f.validation_year)""",
        "params AS (SELECT validation_year, 'baseline' AS model, median(label) AS intercept, 0.0 AS slope, "
        "CAST(NULL AS VARCHAR) AS feature FROM tagged WHERE role = 'train' GROUP BY validation_year\n UNION ALL "
        + "\n UNION ALL ".join(ols_fold) + ")",
        f"""oof AS (SELECT p.model, t.validation_year, t.sale_id, t.label,
            p.intercept + p.slope * ({xcase}) AS prediction
            FROM tagged t JOIN params p ON p.validation_year = t.validation_year WHERE t.role = 'validate')""",
        """fm AS (SELECT model, validation_year,
            sqrt(avg(pow(label - prediction, 2))) AS log_rmse, avg(abs(label - prediction)) AS log_mae,
            avg(abs((exp(label) - 1) - (exp(prediction) - 1))) AS dollar_mae,
            CASE WHEN count(*) * var_pop(label) > 0 THEN 1 - sum(pow(label - prediction, 2)) / (count(*) * var_pop(label))
                 WHEN sum(pow(label - prediction, 2)) = 0 THEN 1.0 ELSE 0.0 END AS log_r2
            FROM oof GROUP BY model, validation_year)""",
        "summ AS (SELECT model, avg(log_rmse) AS log_rmse, stddev_samp(log_rmse) / sqrt(count(log_rmse)) AS log_rmse_se FROM fm GROUP BY model)",
        "best AS (SELECT model, log_rmse + log_rmse_se AS thr FROM summ ORDER BY log_rmse, model LIMIT 1)",
        """imp AS (SELECT 1 - (SELECT min(log_rmse) FROM summ WHERE model <> 'baseline')
                         / (SELECT max(log_rmse) FROM summ WHERE model = 'baseline') AS improvement)""",
        """elig AS (SELECT s.model FROM summ s JOIN ranks r ON r.model = s.model
            WHERE s.model <> 'baseline' AND s.log_rmse <= (SELECT thr FROM best)
            ORDER BY r.complexity, s.model LIMIT 1)""",
        """decision AS (SELECT CASE WHEN (SELECT improvement FROM imp) < 0.2 OR (SELECT count(*) FROM elig) = 0
                   THEN 'baseline' ELSE (SELECT model FROM elig) END AS chosen,
            (SELECT model FROM best) AS best_cv_model, (SELECT thr FROM best) AS one_se_threshold,
            (SELECT improvement FROM imp) AS baseline_improvement)""",
        """cal AS (SELECT avg(exp(r)) AS smearing_factor, quantile_cont(r, 0.05) AS q_low, quantile_cont(r, 0.95) AS q_high,
            count(*) AS n_residuals
            FROM (SELECT label - prediction AS r FROM oof WHERE model = (SELECT chosen FROM decision)) t)""",
        f"""bounds AS (SELECT greatest(0.0, quantile_cont({target}, 0.001) * 0.5) AS price_min,
            quantile_cont({target}, 0.999) * 1.5 AS price_max FROM dev)""",
        "params_all AS (SELECT * FROM (SELECT 'baseline' AS model, median(label) AS intercept, 0.0 AS slope, "
        "CAST(NULL AS VARCHAR) AS feature FROM dev\n UNION ALL " + "\n UNION ALL ".join(ols_all)
        + ") a WHERE model = (SELECT chosen FROM decision))",
        f"""hpred AS (SELECT t.sale_id, t.neighborhood, CAST(t.{target} AS DOUBLE) AS actual_price,
            p.intercept + p.slope * ({xcase}) AS log_prediction FROM hold t, params_all p)""",
        """scored AS (SELECT h.*,
            exp(log_prediction) * c.smearing_factor - 1 AS raw_price,
            least(greatest(exp(log_prediction) * c.smearing_factor - 1, b.price_min), b.price_max) AS price,
            least(greatest(exp(log_prediction + c.q_low) * c.smearing_factor - 1, b.price_min), b.price_max) AS interval_low,
            least(greatest(exp(log_prediction + c.q_high) * c.smearing_factor - 1, b.price_min), b.price_max) AS interval_high
            FROM hpred h, cal c, bounds b)""",
    ]


def _sql(target: str, body: str) -> str:
    return with_sales(body, *_pipeline_sql(target))


def r(col, d=6):
    return F.round(F.col(col), d).alias(col)


# ---------------------------------------------------------------- M1 + M2 + M5 + A6 + A7
_COMPARISON_BODY = """
SELECT model, validation_year, CAST(validation_year AS VARCHAR) AS fold, round(log_rmse, 6) AS log_rmse,
       round(log_mae, 6) AS log_mae, round(dollar_mae, 2) AS dollar_mae, round(log_r2, 6) AS log_r2,
       CAST(NULL AS DOUBLE) AS log_rmse_se
FROM fm
UNION ALL
SELECT model, NULL, 'summary', round(log_rmse, 6), NULL, NULL, NULL, round(log_rmse_se, 6) FROM summ
"""


def _comparison(spark, sf_dir, target):
    rep = _trained(spark, sf_dir, target).report
    return rep.select("model", "validation_year", "fold", r("log_rmse"), r("log_mae"), r("dollar_mae", 2), r("log_r2"),
                      r("log_rmse_se"))


@register("temporal_comparison", _sql("sale_price", _COMPARISON_BODY))
def temporal_comparison(spark, sf_dir):
    return _comparison(spark, sf_dir, "sale_price")


@register("temporal_comparison_no_signal", _sql("market_price", _COMPARISON_BODY))
def temporal_comparison_no_signal(spark, sf_dir):
    return _comparison(spark, sf_dir, "market_price")


# ---------------------------------------------------------------- W2
_RANKED = ("log_rmse", "log_mae")


@register("comparison_ranking", _sql("sale_price", """
SELECT 'folds' AS source, model, round(avg(log_rmse), 6) AS value, row_number() OVER (ORDER BY avg(log_rmse) NULLS LAST, model) AS rank
FROM fm GROUP BY model
UNION ALL
SELECT 'summary', model, round(log_rmse, 6), row_number() OVER (ORDER BY log_rmse NULLS LAST, model) FROM summ
"""))
def comparison_ranking(spark, sf_dir):
    """Both tables sorted by their metric: a fold summary has ``log_rmse_mean``, the temporal one falls back to ``log_rmse``."""
    per_fold = _trained(spark, sf_dir, "sale_price").report.where(F.col("fold") != "summary")
    folds = ranked_table(cv_summary(per_fold, _RANKED, ("model",)))
    summary = ranked_table(fold_summary(per_fold))
    return folds.select(F.lit("folds").alias("source"), "model", F.round("log_rmse_mean", 6).alias("value"), "rank").unionByName(
        summary.select(F.lit("summary").alias("source"), "model", F.round("log_rmse", 6).alias("value"), "rank"))


# ---------------------------------------------------------------- M6 + A21
_DECISION_BODY = f"""
SELECT chosen, best_cv_model, round(one_se_threshold, 6) AS one_se_threshold,
       round(baseline_improvement, 6) AS baseline_improvement, '{CF.C.SELECTION_RULE}' AS selection_rule
FROM decision
"""


def _decision(spark, sf_dir, target):
    d = _trained(spark, sf_dir, target).decision
    return d.select("chosen", "best_cv_model", r("one_se_threshold"), r("baseline_improvement"), "selection_rule")


@register("model_selection", _sql("sale_price", _DECISION_BODY))
def model_selection(spark, sf_dir):
    return _decision(spark, sf_dir, "sale_price")


@register("model_selection_fallback", _sql("market_price", _DECISION_BODY))
def model_selection_fallback(spark, sf_dir):
    return _decision(spark, sf_dir, "market_price")


# ---------------------------------------------------------------- M16 + A14 + A15 + A16
@register("residual_calibration", _sql("sale_price", """
SELECT round(smearing_factor, 6) AS smearing_factor, n_residuals, round(q_low, 6) AS residual_q_low,
       round(q_high, 6) AS residual_q_high, round(price_min, 2) AS price_min, round(price_max, 2) AS price_max
FROM cal, bounds
"""))
def residual_calibration(spark, sf_dir):
    c = _trained(spark, sf_dir, "sale_price").calibration
    return c.select(r("smearing_factor"), "n_residuals", r("residual_q_low"), r("residual_q_high"), r("price_min", 2),
                    r("price_max", 2))


# ---------------------------------------------------------------- M15 + M18 + M19
_RESPONSE_BODY = f"""
SELECT sale_id,
       round(price, 2) AS predicted_price_2010_usd, round(interval_low, 2) AS interval_90_low,
       round(interval_high, 2) AS interval_90_high,
       round(price * {cpi_factor()!r}, 2) AS inflation_adjusted_reference_usd,
       round(interval_low * {cpi_factor()!r}, 2) AS inflation_adjusted_interval_90_low,
       round(interval_high * {cpi_factor()!r}, 2) AS inflation_adjusted_interval_90_high,
       {CPI_REFERENCE_YEAR} AS inflation_reference_year, round({cpi_factor()!r}, 6) AS inflation_factor,
       '{MODEL_VERSION}' AS model_version,
       array_to_string(list_filter(['{HISTORICAL_NOTICE}', CASE WHEN price <> raw_price THEN '{CLIPPED_NOTICE}' END,
                       '{CPI_NOTE}'], lambda v: v IS NOT NULL), ' | ') AS warnings
FROM scored
"""


@register("holdout_scoring", _sql("sale_price", _RESPONSE_BODY))
def holdout_scoring(spark, sf_dir):
    scored = _trained(spark, sf_dir, "sale_price").holdout_scored
    resp = P.response(scored, MODEL_VERSION)
    return resp.select(
        "sale_id", "predicted_price_2010_usd", "interval_90_low", "interval_90_high", "inflation_adjusted_reference_usd",
        "inflation_adjusted_interval_90_low", "inflation_adjusted_interval_90_high", "inflation_reference_year",
        "inflation_factor", "model_version", F.array_join("response_warnings", " | ").alias("warnings"),
    )


# ---------------------------------------------------------------- M20
@register("holdout_evaluation", _sql("sale_price", """
SELECT count(*) AS n_rows,
       round(sqrt(avg(pow(ln(1 + actual_price) - ln(1 + price), 2))), 6) AS log_rmse,
       round(avg(abs(ln(1 + actual_price) - ln(1 + price))), 6) AS log_mae,
       round(sqrt(avg(pow(actual_price - price, 2))), 2) AS dollar_rmse,
       round(avg(abs(actual_price - price)), 2) AS dollar_mae,
       round(avg(abs((actual_price - price) / actual_price)), 6) AS dollar_mape,
       round(CASE WHEN count(*) * var_pop(actual_price) > 0
                  THEN 1 - sum(pow(actual_price - price, 2)) / (count(*) * var_pop(actual_price)) ELSE 0.0 END, 6) AS dollar_r2,
       round(avg(CASE WHEN actual_price BETWEEN interval_low AND interval_high THEN 1.0 ELSE 0.0 END), 6) AS interval_90_coverage
FROM scored
"""))
def holdout_evaluation(spark, sf_dir):
    m = P.holdout_metrics(_trained(spark, sf_dir, "sale_price").holdout_scored)
    return m.select("n_rows", r("log_rmse"), r("log_mae"), r("dollar_rmse", 2), r("dollar_mae", 2), r("dollar_mape"),
                    r("dollar_r2"), r("interval_90_coverage"))


# ---------------------------------------------------------------- A2 / A3 on the holdout
@register("holdout_errors_by_group", _sql("sale_price", """
SELECT neighborhood, count(*) AS count, round(avg(actual_price), 2) AS actual_mean,
       round(avg(price), 2) AS prediction_mean, round(avg(abs(actual_price - price)), 2) AS mae
FROM scored GROUP BY neighborhood
"""))
def holdout_errors_by_group(spark, sf_dir):
    s = _trained(spark, sf_dir, "sale_price").holdout_scored
    e = error_by_group(s, "neighborhood", "actual_price", "price")
    return e.select("neighborhood", "count", r("actual_mean", 2), r("prediction_mean", 2), r("mae", 2))


@register("holdout_errors_by_band", _sql("sale_price", """
SELECT band, round(u[band + 1], 2) AS band_low, round(u[band + 2], 2) AS band_high, count(*) AS count,
       round(avg(actual_price), 2) AS actual_mean, round(avg(price), 2) AS prediction_mean,
       round(avg(abs(actual_price - price)), 2) AS mae
FROM (SELECT s.*, e.u, len(list_filter(CASE WHEN len(e.u) >= 3 THEN list_slice(e.u, 2, len(e.u) - 1) ELSE [] END,
                                       lambda t: s.actual_price > t)) AS band
      FROM scored s, (SELECT list_sort(list_distinct(quantile_cont(actual_price, [0.0, 0.25, 0.5, 0.75, 1.0]))) AS u FROM scored) e) t
GROUP BY band, u
"""))
def holdout_errors_by_band(spark, sf_dir):
    s = _trained(spark, sf_dir, "sale_price").holdout_scored
    e = error_by_quantile_band(s, "actual_price", "price", 4, METHOD)
    return e.select("band", r("band_low", 2), r("band_high", 2), "count", r("actual_mean", 2), r("prediction_mean", 2),
                    r("mae", 2))

