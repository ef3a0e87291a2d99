"""Drift queries (R1-R8) on the sales table: reference = before 2000, current = 2000."""

from __future__ import annotations

from pyspark.sql import functions as F

from valuora.catalog import register
from valuora.catalog.sqlgen import long_sql, missing_sql, psi_sql, values_sql
from valuora.operators import drift
from valuora.sources.tables import (
    sales_source,
    REFERENCE_CUTOFF_YEAR,
    SALES_BOUNDS,
    SALES_CATEGORICAL,
    SALES_NUMERIC,
    SCORED_SQL,
    sales_table,
    scored_sales,
    with_sales,
)

REF_WHERE = f"sold_year < {REFERENCE_CUTOFF_YEAR}"
CUR_WHERE = f"sold_year = {REFERENCE_CUTOFF_YEAR}"
# The quantile method used by registered drift queries: exact and distributed.
METHOD = "refine"


def _sides(spark, sf_dir, scored=False):
    s = sales_source(spark, sf_dir)
    if scored:
        s = scored_sales(s)
    return s.where(F.col("sold_year") < REFERENCE_CUTOFF_YEAR), s.where(F.col("sold_year") == REFERENCE_CUTOFF_YEAR)


def _r6(col):
    return F.round(F.col(col), 6).alias(col)


# ---------------------------------------------------------------- R1 + R3
_NUM_SQL = with_sales(
    """
SELECT p.feature, round(p.psi, 6) AS psi, round(rm.reference_missing_rate, 6) AS reference_missing_rate,
       round(cm.current_missing_rate, 6) AS current_missing_rate
FROM psi_out p
LEFT JOIN rm ON rm.feature = p.feature
LEFT JOIN cm ON cm.feature = p.feature
""",
    f"ref_long AS ({long_sql('sales', SALES_NUMERIC, REF_WHERE)})",
    f"cur_long AS ({long_sql('sales', SALES_NUMERIC, CUR_WHERE)})",
    psi_sql("ref_long", "cur_long", SALES_NUMERIC).strip(),
    f"rm AS ({missing_sql('ref_long', 'reference_missing_rate')})",
    f"cm AS ({missing_sql('cur_long', 'current_missing_rate')})",
)


@register("drift_numeric_psi", _NUM_SQL)
def drift_numeric_psi(spark, sf_dir):
    ref, cur = _sides(spark, sf_dir)
    out = drift.numeric_section(ref, cur, SALES_NUMERIC, method=METHOD)
    return out.select("feature", _r6("psi"), _r6("reference_missing_rate"), _r6("current_missing_rate"))


# ---------------------------------------------------------------- R4 + J3
_CAT_SQL = with_sales(
    """
SELECT spine.feature,
       round(coalesce(st.novel, 0.0), 6) AS novel_category_rate,
       round(st.current_missing_rate, 6) AS current_missing_rate
FROM """ + values_sql(SALES_CATEGORICAL) + """
LEFT JOIN (
  SELECT c.feature,
         avg(CASE WHEN c.x IS NOT NULL THEN (CASE WHEN k.x IS NULL THEN 1.0 ELSE 0.0 END) END) AS novel,
         avg(CASE WHEN c.x IS NULL THEN 1.0 ELSE 0.0 END) AS current_missing_rate
  FROM cur_long c LEFT JOIN known k ON k.feature = c.feature AND k.x = c.x
  GROUP BY c.feature
) st ON st.feature = spine.feature
""",
    f"ref_long AS ({long_sql('sales', SALES_CATEGORICAL, REF_WHERE, cast='VARCHAR')})",
    f"cur_long AS ({long_sql('sales', SALES_CATEGORICAL, CUR_WHERE, cast='VARCHAR')})",
    "known AS (SELECT DISTINCT feature, x FROM ref_long WHERE x IS NOT NULL)",
)


@register("drift_categorical_novelty", _CAT_SQL)
def drift_categorical_novelty(spark, sf_dir):
    ref, cur = _sides(spark, sf_dir)
    out = drift.categorical_section(ref, cur, SALES_CATEGORICAL)
    return out.select("feature", _r6("novel_category_rate"), _r6("current_missing_rate"))


# ---------------------------------------------------------------- R5 + P6
def _range_sql() -> str:
    parts = []
    for name, (lo, hi) in SALES_BOUNDS.items():
        parts.append(
            f"SELECT '{name}' AS feature, round(avg(CASE WHEN CAST({name} AS DOUBLE) < {lo} OR CAST({name} AS DOUBLE) > {hi} "
            f"THEN 1.0 ELSE 0.0 END), 6) AS violation_rate FROM sales WHERE {CUR_WHERE}"
        )
    return with_sales("\nUNION ALL ".join(parts))


@register("drift_range_violations", _range_sql())
def drift_range_violations(spark, sf_dir):
    _, cur = _sides(spark, sf_dir)
    return drift.range_section(cur, SALES_BOUNDS).select("feature", _r6("violation_rate"))


# ---------------------------------------------------------------- R6 (+ J4 shape)
_R6_SQL = with_sales(
    f"""
SELECT round(sqrt(avg(pow(ln(1 + actual_price) - ln(1 + predicted_price), 2))), 6) AS log_rmse,
       round(avg(abs(actual_price - predicted_price)), 2) AS dollar_mae
FROM scored WHERE {CUR_WHERE}
""",
    SCORED_SQL,
)


@register("drift_delayed_label_performance", _R6_SQL)
def drift_delayed_label_performance(spark, sf_dir):
    _, cur = _sides(spark, sf_dir, scored=True)
    out = drift.delayed_label_performance(cur)
    return out.select(_r6("log_rmse"), F.round("dollar_mae", 2).alias("dollar_mae"))


# ---------------------------------------------------------------- R7
_R7_SQL = with_sales(
    """
SELECT round(p.psi, 6) AS psi,
       round((SELECT avg(predicted_price) FROM scored WHERE """ + REF_WHERE + """), 2) AS reference_mean,
       round((SELECT avg(predicted_price) FROM scored WHERE """ + CUR_WHERE + """), 2) AS current_mean
FROM psi_out p
""",
    SCORED_SQL,
    f"ref_long AS ({long_sql('scored', ['predicted_price'], REF_WHERE)})",
    f"cur_long AS ({long_sql('scored', ['predicted_price'], CUR_WHERE)})",
    psi_sql("ref_long", "cur_long", ["predicted_price"]).strip(),
)


@register("drift_prediction_shift", _R7_SQL)
def drift_prediction_shift(spark, sf_dir):
    ref, cur = _sides(spark, sf_dir, scored=True)
    out = drift.prediction_shift(ref, cur, method=METHOD)
    return out.select(_r6("psi"), F.round("reference_mean", 2).alias("reference_mean"),
                      F.round("current_mean", 2).alias("current_mean"))


# ---------------------------------------------------------------- R8
_R8_SQL = with_sales(
    f"""
SELECT section, feature, metric, round(value, 6) AS value FROM (
  SELECT 'numeric' AS section, n.feature, 'psi' AS metric, n.psi AS value FROM psi_out n
  UNION ALL SELECT 'numeric', feature, 'reference_missing_rate', reference_missing_rate FROM rm
  UNION ALL SELECT 'numeric', feature, 'current_missing_rate', current_missing_rate FROM cm
  UNION ALL SELECT 'categorical', spine.feature, 'novel_category_rate', coalesce(st.novel, 0.0)
    FROM {values_sql(SALES_CATEGORICAL)} LEFT JOIN cat_stats st ON st.feature = spine.feature
  UNION ALL SELECT 'categorical', feature, 'current_missing_rate', current_missing_rate FROM cat_stats
  UNION ALL SELECT 'range_violations', feature, 'violation_rate', violation_rate FROM rng
  UNION ALL SELECT 'delayed_label_performance', NULL, 'log_rmse',
         sqrt(avg(pow(ln(1 + actual_price) - ln(1 + predicted_price), 2))) FROM scored WHERE {CUR_WHERE}
  UNION ALL SELECT 'delayed_label_performance', NULL, 'dollar_mae',
         avg(abs(actual_price - predicted_price)) FROM scored WHERE {CUR_WHERE}
  UNION ALL SELECT 'prediction_shift', 'predicted_price', 'psi', psi FROM p_psi_out
  UNION ALL SELECT 'prediction_shift', 'predicted_price', 'reference_mean', avg(predicted_price) FROM scored WHERE {REF_WHERE}
  UNION ALL SELECT 'prediction_shift', 'predicted_price', 'current_mean', avg(predicted_price) FROM scored WHERE {CUR_WHERE}
) t
""",
    SCORED_SQL,
    f"ref_long AS ({long_sql('sales', SALES_NUMERIC, REF_WHERE)})",
    f"cur_long AS ({long_sql('sales', SALES_NUMERIC, CUR_WHERE)})",
    psi_sql("ref_long", "cur_long", SALES_NUMERIC).strip(),
    f"rm AS ({missing_sql('ref_long', 'reference_missing_rate')})",
    f"cm AS ({missing_sql('cur_long', 'current_missing_rate')})",
    f"cref AS ({long_sql('sales', SALES_CATEGORICAL, REF_WHERE, cast='VARCHAR')})",
    f"ccur AS ({long_sql('sales', SALES_CATEGORICAL, CUR_WHERE, cast='VARCHAR')})",
    "known AS (SELECT DISTINCT feature, x FROM cref WHERE x IS NOT NULL)",
    """cat_stats AS (
  SELECT c.feature,
         avg(CASE WHEN c.x IS NOT NULL THEN (CASE WHEN k.x IS NULL THEN 1.0 ELSE 0.0 END) END) AS novel,
         avg(CASE WHEN c.x IS NULL THEN 1.0 ELSE 0.0 END) AS current_missing_rate
  FROM ccur c LEFT JOIN known k ON k.feature = c.feature AND k.x = c.x GROUP BY c.feature)""",
    "rng AS (" + "\nUNION ALL ".join(
        f"SELECT '{n}' AS feature, avg(CASE WHEN CAST({n} AS DOUBLE) < {lo} OR CAST({n} AS DOUBLE) > {hi} THEN 1.0 ELSE 0.0 END) AS violation_rate FROM sales WHERE {CUR_WHERE}"
        for n, (lo, hi) in SALES_BOUNDS.items()) + ")",
    f"pref AS ({long_sql('scored', ['predicted_price'], REF_WHERE)})",
    f"pcur AS ({long_sql('scored', ['predicted_price'], CUR_WHERE)})",
    psi_sql("pref", "pcur", ["predicted_price"], prefix="p_").strip(),
)


@register("drift_report", _R8_SQL)
def drift_report_query(spark, sf_dir):
    ref, cur = _sides(spark, sf_dir, scored=True)
    # the source is already a materialised table, so the report reads it directly
    rep = drift.drift_report(ref, cur, SALES_NUMERIC, SALES_CATEGORICAL, SALES_BOUNDS, method=METHOD,
                             materialize_inputs=False)
    return rep.select("section", "feature", "metric", F.round("value", 6).alias("value"))
