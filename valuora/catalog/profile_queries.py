"""Profiling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from valuora.catalog import register
from valuora.catalog.sqlgen import probs_sql
from valuora.functions.columns import seeded_hash_sql
from valuora.operators import profile as A
from valuora.operators.drift import missing_rates
from valuora.operators.quantiles import grouped_quantiles
from valuora.sources.tables import (
    sales_source,
    SALES_CATEGORICAL,
    SALES_INFORMATIVE_NULL,
    SALES_NUMERIC,
    SCORED_SQL,
    SEED,
    sales_table,
    scored_sales,
    with_sales,
)

ALL_COLUMNS = ("sale_id", "sold_year", *SALES_CATEGORICAL, *SALES_NUMERIC, "first_ship_year", "last_ship_year",
               "market_price", "sale_price")
PROFILE_NUMERIC = (*SALES_NUMERIC, "market_price", "sale_price")
METHOD = "refine"


def r(col, d=6):
    return F.round(F.col(col), d).alias(col)


@register("group_medians", with_sales(
    """SELECT neighborhood, round(median(frontage), 6) AS median_frontage,
    round((SELECT median(frontage) FROM sales), 6) AS global_median FROM sales GROUP BY neighborhood"""))
def group_medians(spark, sf_dir):
    per, overall = A.group_medians(sales_source(spark, sf_dir), "neighborhood", "frontage", METHOD)
    return per.crossJoin(overall.withColumnRenamed("median", "global_median")).select(
        "neighborhood", F.round("median", 6).alias("median_frontage"), r("global_median"))


def _missing_sql():
    parts = [f"SELECT '{c}' AS feature, round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 6) AS missing_rate FROM sales"
             for c in ALL_COLUMNS]
    return with_sales("\nUNION ALL ".join(parts))


@register("missing_rates", _missing_sql())
def missing_rates_query(spark, sf_dir):
    return missing_rates(sales_source(spark, sf_dir), ALL_COLUMNS).select("feature", r("missing_rate"))


def _missingness_sql():
    parts = [f"SELECT '{c}' AS feature, sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS n_missing, count(*) AS n FROM sales"
             for c in ALL_COLUMNS]
    inf = ", ".join(f"'{c}'" for c in SALES_INFORMATIVE_NULL)
    return with_sales(
        f"""SELECT feature, n_missing, round(n_missing / n * 100, 2) AS pct_missing,
        CASE WHEN feature IN ({inf}) THEN 'informative' ELSE 'true gap' END AS kind
        FROM ({' UNION ALL '.join(parts)}) t WHERE n_missing > 0""")


@register("missingness_table", _missingness_sql())
def missingness_table(spark, sf_dir):
    return A.missingness_table(sales_source(spark, sf_dir), SALES_INFORMATIVE_NULL, ALL_COLUMNS)


SKEW_THRESHOLD = 0.5


def _skew_sql():
    parts = [f"SELECT '{c}' AS feature, skewness(CAST({c} AS DOUBLE)) AS skew FROM sales" for c in PROFILE_NUMERIC]
    return with_sales(
        f"SELECT feature, round(skew, 6) AS skew FROM ({' UNION ALL '.join(parts)}) t "
        f"WHERE skew IS NOT NULL AND abs(skew) > {SKEW_THRESHOLD}")


@register("skewness", _skew_sql())
def skewness(spark, sf_dir):
    return A.skewness_table(sales_source(spark, sf_dir), PROFILE_NUMERIC, SKEW_THRESHOLD).select("feature", r("skew"))


def _corr_sql():
    parts = [f"SELECT '{c}' AS feature, corr(CAST({c} AS DOUBLE), sale_price) AS corr FROM sales"
             for c in PROFILE_NUMERIC if c != "sale_price"]
    return with_sales(f"SELECT feature, round(corr, 6) AS corr, round(abs(corr), 6) AS abs_corr FROM ({' UNION ALL '.join(parts)}) t")


@register("target_correlations", _corr_sql())
def target_correlations(spark, sf_dir):
    out = A.target_correlations(sales_source(spark, sf_dir), PROFILE_NUMERIC, "sale_price")
    return out.select("feature", r("corr"), F.round(F.abs("corr"), 6).alias("abs_corr"))


TOP_N = 3


@register("top_correlated_features", with_sales(
    f"""SELECT feature, round(abs_corr, 6) AS abs_corr FROM (
      SELECT feature, abs(corr) AS abs_corr FROM (
        {' UNION ALL '.join(f"SELECT '{c}' AS feature, corr(CAST({c} AS DOUBLE), sale_price) AS corr FROM sales" for c in PROFILE_NUMERIC if c != 'sale_price')}
      ) t ORDER BY abs(corr) DESC, feature LIMIT {TOP_N}) u"""))
def top_correlated_features(spark, sf_dir):
    out = A.target_correlations(sales_source(spark, sf_dir), PROFILE_NUMERIC, "sale_price")
    return out.select("feature", F.abs("corr").alias("abs_corr")).orderBy(F.desc("abs_corr"), "feature") \
        .limit(TOP_N).select("feature", r("abs_corr"))


MATRIX = ("living_area", "rooms", "basement_area", "sale_price")


def _matrix_sql():
    parts = []
    for a in MATRIX:
        for b in MATRIX:
            parts.append(f"SELECT '{a}' AS a, '{b}' AS b, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS corr FROM sales")
    return with_sales(" UNION ALL ".join(parts))


@register("correlation_matrix", _matrix_sql())
def correlation_matrix(spark, sf_dir):
    return A.correlation_pairs(sales_source(spark, sf_dir), MATRIX).select("a", "b", r("corr"))


QPROBS = [0.001, 0.05, 0.25, 0.5, 0.75, 0.95, 0.999]


@register("price_quantiles", with_sales(
    f"""SELECT zoning, p.prob, round(q[p.i], 1) AS quantile FROM (
      SELECT zoning, quantile_cont(sale_price, {QPROBS}) AS q FROM sales GROUP BY zoning) t,
      (SELECT unnest(range(1, {len(QPROBS) + 1})) AS i, unnest({QPROBS}) AS prob) p"""))
def price_quantiles(spark, sf_dir):
    q = grouped_quantiles(sales_source(spark, sf_dir), ["zoning"], "sale_price", QPROBS, METHOD)
    probs = F.array(*[F.lit(p) for p in QPROBS])
    return q.select("zoning", F.posexplode("q").alias("i", "v")).select(
        "zoning", F.element_at(probs, F.col("i") + 1).alias("prob"), F.round("v", 1).alias("quantile"))


MODE_COLS = ("neighborhood", "zoning", "building_type", "grade")


def _mode_sql():
    parts = [f"""(SELECT '{c}' AS feature, v AS mode FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM sales
                 WHERE {c} IS NOT NULL GROUP BY 1) t ORDER BY n DESC, v ASC LIMIT 1)""" for c in MODE_COLS]
    parts.append("""(SELECT 'rooms' AS feature, CAST(v AS VARCHAR) AS mode FROM (SELECT rooms AS v, count(*) AS n FROM sales
                 WHERE rooms IS NOT NULL GROUP BY 1) t ORDER BY n DESC, v ASC LIMIT 1)""")
    return with_sales(" UNION ALL ".join(parts))


@register("category_modes", _mode_sql())
def category_modes(spark, sf_dir):
    m = A.modes(sales_source(spark, sf_dir), [*MODE_COLS, "rooms"])
    cols = [*MODE_COLS, "rooms"]
    return m.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], cols, "feature", "mode")


def _distinct_sql():
    parts = [f"SELECT '{c}' AS feature, count(DISTINCT {c}) AS n_distinct, CAST(min({c}) AS DOUBLE) AS min FROM sales"
             for c in PROFILE_NUMERIC]
    return with_sales(" UNION ALL ".join(parts))


@register("distinct_and_min", _distinct_sql())
def distinct_and_min(spark, sf_dir):
    return A.distinct_and_min(sales_source(spark, sf_dir), PROFILE_NUMERIC)


HIST_BINS = 20


def _hist_sql(expr: str, name: str) -> str:
    return f"""SELECT '{name}' AS feature, bin, round(lo + bin * (hi - lo) / {HIST_BINS}, 6) AS lower,
      round(lo + (bin + 1) * (hi - lo) / {HIST_BINS}, 6) AS upper, count(*) AS count, round(sk, 6) AS skew
    FROM (SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((x - lo) / ((hi - lo) / {HIST_BINS})), {HIST_BINS - 1}) END AS INTEGER) AS bin,
                 lo, hi, sk
          FROM (SELECT {expr} AS x FROM sales) v,
               (SELECT min({expr}) AS lo, max({expr}) AS hi, skewness({expr}) AS sk FROM sales) s
          WHERE x IS NOT NULL) b
    GROUP BY bin, lo, hi, sk"""


HIST_SPECS = (("sale_price", "sale_price", False), ("log1p_sale_price", "sale_price", True),
              ("basement_area", "basement_area", False), ("frontage", "frontage", False))


@register("histograms", with_sales(" UNION ALL ".join(
    _hist_sql(f"ln(1 + {src})" if lg else f"CAST({src} AS DOUBLE)", name) for name, src, lg in HIST_SPECS)))
def histograms(spark, sf_dir):
    s = sales_source(spark, sf_dir)
    out = None
    for name, src, lg in HIST_SPECS:
        h = A.histogram(s, src, HIST_BINS, log1p=lg).select(
            F.lit(name).alias("feature"), "bin", r("lower"), r("upper"), "count", r("skew"))
        out = h if out is None else out.unionByName(h)
    return out


@register("group_boxplot", with_sales(
    """SELECT b.neighborhood, round(q1, 2) AS q1, round(median, 2) AS median, round(q3, 2) AS q3,
       round(min(CASE WHEN s.sale_price >= q1 - 1.5 * (q3 - q1) THEN s.sale_price END), 2) AS whisker_low,
       round(max(CASE WHEN s.sale_price <= q3 + 1.5 * (q3 - q1) THEN s.sale_price END), 2) AS whisker_high,
       count(*) AS n
    FROM (SELECT neighborhood, quantile_cont(sale_price, 0.25) AS q1, quantile_cont(sale_price, 0.5) AS median,
                 quantile_cont(sale_price, 0.75) AS q3 FROM sales GROUP BY neighborhood) b
    JOIN sales s ON s.neighborhood = b.neighborhood
    GROUP BY b.neighborhood, q1, median, q3"""))
def group_boxplot(spark, sf_dir):
    b = A.box_stats(sales_source(spark, sf_dir), "neighborhood", "sale_price", METHOD)
    return b.select("neighborhood", *[r(c, 2) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")], "n")


@register("groups_by_median", with_sales(
    """SELECT neighborhood, round(median(sale_price), 2) AS median, count(sale_price) AS n,
       row_number() OVER (ORDER BY median(sale_price) NULLS FIRST, neighborhood NULLS FIRST) AS rank
    FROM sales GROUP BY neighborhood"""))
def groups_by_median(spark, sf_dir):
    return A.groups_by_median(sales_source(spark, sf_dir), "neighborhood", "sale_price", METHOD).select(
        "neighborhood", r("median", 2), "n", "rank")


@register("calibration_bins", with_sales(
    f"""SELECT bin, count(*) AS n, round(avg(actual_price), 2) AS actual_mean, round(avg(predicted_price), 2) AS predicted_mean,
       round(avg(actual_price - predicted_price), 2) AS residual_mean
    FROM (SELECT s.*, len(list_filter(e.inner_edges, lambda t: t <= s.predicted_price)) AS bin
          FROM scored s, (SELECT CASE WHEN len(u) >= 3 THEN list_slice(u, 2, len(u) - 1) ELSE [] END AS inner_edges
                          FROM (SELECT list_sort(list_distinct(quantile_cont(predicted_price, {probs_sql(10)}))) AS u FROM scored) q) e) t
    GROUP BY bin""", SCORED_SQL))
def calibration_bins(spark, sf_dir):
    c = A.calibration_bins(scored_sales(sales_source(spark, sf_dir)), "actual_price", "predicted_price", 10, METHOD)
    return c.select("bin", "n", r("actual_mean", 2), r("predicted_mean", 2), r("residual_mean", 2))


SAMPLE_FRACTION = 0.05


@register("scatter_sample", with_sales(
    f"SELECT sale_id, living_area, sale_price FROM sales WHERE {seeded_hash_sql('sale_id', SEED)} < {int(round(SAMPLE_FRACTION * 2**32))}"))
def scatter_sample(spark, sf_dir):
    return A.scatter_sample(sales_source(spark, sf_dir), "sale_id", ["living_area", "sale_price"], SAMPLE_FRACTION, SEED)


@register("distinct_years", with_sales("SELECT DISTINCT sold_year FROM sales"))
def distinct_years(spark, sf_dir):
    return sales_source(spark, sf_dir).select("sold_year").distinct()
