"""Metric, summary and feature-selection queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from valuora.catalog import register
from valuora.catalog.sqlgen import probs_sql
from valuora.functions.columns import seeded_hash_sql
from valuora.operators import metrics as M
from valuora.operators import selection as G
from valuora.operators.splits import kfold
from valuora.sources.tables import sales_source, SCORED_SQL, SEED, sales_table, scored_sales, with_sales

N_FEATURES = 2
H = seeded_hash_sql("sale_id", SEED)


def _scored_logs(spark, sf_dir):
    s = scored_sales(sales_source(spark, sf_dir))
    return s.withColumn("y_log", F.log1p("actual_price")).withColumn("p_log", F.log1p("predicted_price"))


_METRIC_NAMES = [("log_rmse", 6), ("log_mae", 6), ("log_mse", 6), ("log_r2", 6), ("log_adj_r2", 6), ("dollar_rmse", 2),
                 ("dollar_mae", 2), ("dollar_mse", 0), ("dollar_r2", 6), ("dollar_mape", 6)]


def _metrics_sql(group: str = "") -> str:
    yl, pl = "ln(1 + actual_price)", "ln(1 + predicted_price)"
    y, p = "actual_price", "predicted_price"
    r2 = ("CASE WHEN count(*) * var_pop({y}) > 0 THEN 1 - sum(pow({y} - {p}, 2)) / (count(*) * var_pop({y})) "
          "WHEN sum(pow({y} - {p}, 2)) = 0 THEN 1.0 ELSE 0.0 END")
    lr2 = r2.format(y=yl, p=pl)
    n = "CAST(count(*) AS DOUBLE)"
    adj = f"CASE WHEN {n} - {N_FEATURES} - 1 > 0 THEN 1 - (1 - ({lr2})) * ({n} - 1) / ({n} - {N_FEATURES} - 1) END"
    exprs = {
        "log_rmse": f"sqrt(avg(pow({yl} - {pl}, 2)))",
        "log_mae": f"avg(abs({yl} - {pl}))",
        "log_mse": f"avg(pow({yl} - {pl}, 2))",
        "log_r2": lr2,
        "log_adj_r2": adj,
        "dollar_rmse": f"sqrt(avg(pow({y} - {p}, 2)))",
        "dollar_mae": f"avg(abs({y} - {p}))",
        "dollar_mse": f"avg(pow({y} - {p}, 2))",
        "dollar_r2": r2.format(y=y, p=p),
        "dollar_mape": f"avg(abs({y} - {p}) / greatest(abs({y}), 2.220446049250313e-16))",
    }
    sel = ", ".join(f"round({exprs[k]}, {d}) AS {k}" for k, d in _METRIC_NAMES)
    return sel


@register("regression_metrics", with_sales(f"SELECT {_metrics_sql()} FROM scored", SCORED_SQL))
def regression_metrics(spark, sf_dir):
    m = M.regression_metrics(_scored_logs(spark, sf_dir), "y_log", "p_log", N_FEATURES)
    return m.select(*[F.round(k, d).alias(k) for k, d in _METRIC_NAMES])


_CV_METRICS = ["log_rmse", "log_mae", "dollar_mae", "log_r2"]


@register("cv_summary", with_sales(f"""
SELECT 'fixed_linear' AS run, {', '.join(f"round(avg({m}), 6) AS {m}_mean, round(stddev_samp({m}), 6) AS {m}_std" for m in _CV_METRICS)}
FROM (SELECT fold, sqrt(avg(pow(ln(1 + actual_price) - ln(1 + predicted_price), 2))) AS log_rmse,
             avg(abs(ln(1 + actual_price) - ln(1 + predicted_price))) AS log_mae,
             avg(abs(actual_price - predicted_price)) AS dollar_mae,
             1 - sum(pow(ln(1 + actual_price) - ln(1 + predicted_price), 2)) / (count(*) * var_pop(ln(1 + actual_price))) AS log_r2
      FROM (SELECT *, CAST({H} % 5 AS INTEGER) AS fold FROM scored) t GROUP BY fold) f
""", SCORED_SQL))
def cv_summary(spark, sf_dir):
    s = kfold(_scored_logs(spark, sf_dir), "sale_id", 5, SEED).withColumn("model", F.lit("fixed_linear"))
    per = M.fold_metrics(s, "y_log", "p_log", ("model", "fold"))
    out = M.cv_summary(per.withColumnRenamed("model", "run"), _CV_METRICS, ("run",))
    return out.select("run", *[F.round(c, 6).alias(c) for c in out.columns if c != "run"])


SIGNAL_FEATURES = ["acctbal", "living_area", "basement_area", "rooms", "frontage", "market_price"]
TOP_K = 3
METHODS = ["correlation", "mutual_info", "attribution"]


def _signals_sql() -> list[str]:
    def long(alias):
        return " UNION ALL ".join(
            f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS x, sale_price AS y FROM sales" for f in SIGNAL_FEATURES)
    p = probs_sql(10)
    return [
        f"lng AS ({long('lng')})",
        "corr_s AS (SELECT feature, abs(corr(x, y)) AS score FROM lng GROUP BY feature)",
        f"""mi_edges AS (SELECT feature,
              list_sort(list_distinct(quantile_cont(x, {p}))) AS ux, list_sort(list_distinct(quantile_cont(y, {p}))) AS uy
            FROM lng WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY feature)""",
        """mi_bins AS (SELECT l.feature,
              len(list_filter(list_slice(e.ux, 2, greatest(len(e.ux) - 1, 1)), lambda t: t <= l.x)) AS a,
              len(list_filter(list_slice(e.uy, 2, greatest(len(e.uy) - 1, 1)), lambda t: t <= l.y)) AS b
            FROM lng l JOIN mi_edges e ON e.feature = l.feature WHERE l.x IS NOT NULL AND l.y IS NOT NULL)""",
        """mi_joint AS (SELECT feature, a, b, count(*) AS n_ab FROM mi_bins GROUP BY 1, 2, 3)""",
        """mi_s AS (SELECT feature, sum((n_ab / n) * ln((n_ab * n) / (n_a * n_b))) AS score FROM (
              SELECT feature, n_ab, sum(n_ab) OVER (PARTITION BY feature) AS n,
                     sum(n_ab) OVER (PARTITION BY feature, a) AS n_a, sum(n_ab) OVER (PARTITION BY feature, b) AS n_b
              FROM mi_joint) j GROUP BY feature)""",
        """att_m AS (SELECT feature, avg(x) AS mx,
              CASE WHEN var_pop(x) > 0 THEN covar_pop(x, y) / var_pop(x) ELSE 0.0 END AS coef FROM lng GROUP BY feature)""",
        """att_s AS (SELECT l.feature, avg(coalesce(abs(m.coef * (l.x - m.mx)), 0.0)) AS score
            FROM lng l JOIN att_m m ON m.feature = l.feature GROUP BY l.feature)""",
        f"""keep AS (
            (SELECT 'correlation' AS method, feature FROM corr_s WHERE score IS NOT NULL ORDER BY score DESC, feature LIMIT {TOP_K})
            UNION ALL (SELECT 'mutual_info', feature FROM mi_s WHERE score IS NOT NULL ORDER BY score DESC, feature LIMIT {TOP_K})
            UNION ALL (SELECT 'attribution', feature FROM att_s WHERE score IS NOT NULL ORDER BY score DESC, feature LIMIT {TOP_K}))""",
    ]


def _spine():
    return "(VALUES " + ", ".join(f"('{f}')" for f in SIGNAL_FEATURES) + ") AS u(feature)"


@register("signal_scores", with_sales(f"""
SELECT 'correlation' AS method, feature, round(score, 6) AS score FROM corr_s
UNION ALL SELECT 'mutual_info', feature, round(score, 6) FROM mi_s
UNION ALL SELECT 'attribution', feature, round(score, 4) FROM att_s
""", *_signals_sql()))
def signal_scores(spark, sf_dir):
    s = sales_source(spark, sf_dir)
    corr = G.correlation_scores(s, SIGNAL_FEATURES, "sale_price").select(F.lit("correlation").alias("method"), "feature", F.round("score", 6).alias("score"))
    mi = G.mutual_information_scores(s, SIGNAL_FEATURES, "sale_price", 10, "refine").select(
        F.lit("mutual_info").alias("method"), "feature", F.round("score", 6).alias("score"))
    att = G.linear_attribution_scores(s, None, SIGNAL_FEATURES, "sale_price").select(
        F.lit("attribution").alias("method"), "feature", F.round("score", 4).alias("score"))
    return corr.unionByName(mi).unionByName(att)


@register("consensus_votes", with_sales(f"""
SELECT u.feature,
       {', '.join(f"CAST(count(*) FILTER (WHERE k.method = '{m}') AS INTEGER) AS {m}" for m in METHODS)},
       CAST(count(k.method) AS INTEGER) AS votes,
       CAST(count(k.method) >= {len(METHODS) / 2} AS INTEGER) AS keep
FROM {_spine()} LEFT JOIN keep k ON k.feature = u.feature
GROUP BY u.feature
""", *_signals_sql()))
def consensus_votes(spark, sf_dir):
    s = sales_source(spark, sf_dir)
    keep = (
        G.top_k(G.correlation_scores(s, SIGNAL_FEATURES, "sale_price"), TOP_K, "correlation")
        .unionByName(G.top_k(G.mutual_information_scores(s, SIGNAL_FEATURES, "sale_price", 10, "refine"), TOP_K, "mutual_info"))
        .unionByName(G.top_k(G.linear_attribution_scores(s, None, SIGNAL_FEATURES, "sale_price"), TOP_K, "attribution"))
    )
    out = G.consensus(keep, SIGNAL_FEATURES, METHODS)
    return out.select("feature", *[F.col(m).cast("int").alias(m) for m in METHODS], F.col("votes").cast("int").alias("votes"), "keep")
