"""Split and fold queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from valuora.catalog import register
from valuora.catalog.sqlgen import probs_sql
from valuora.functions.columns import seeded_hash_sql
from valuora.operators import splits as D
from valuora.operators.joins import null_safe_intersection
from valuora.sources.tables import sales_source, HOLDOUT_YEAR, SEED, VALIDATION_YEARS, sales_table, with_sales

KFOLDS = 5
INNER_TEST = 0.25
FRACTIONS = [round(0.1 + i * 0.9 / 7, 6) for i in range(8)]  # 8 nested sizes 0.1 .. 1.0
H = seeded_hash_sql("sale_id", SEED)


@register("temporal_split", with_sales(
    f"""SELECT CASE WHEN sold_year < {HOLDOUT_YEAR} THEN 'development' ELSE 'holdout' END AS split,
    count(*) AS n_rows, min(sold_year) AS min_year, max(sold_year) AS max_year FROM sales GROUP BY 1"""))
def temporal_split(spark, sf_dir):
    tagged = D.temporal_split(sales_source(spark, sf_dir), "sold_year", HOLDOUT_YEAR)
    return tagged.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("sold_year").alias("min_year"), F.max("sold_year").alias("max_year")
    )


_YEARS = ", ".join(f"({y})" for y in VALIDATION_YEARS)


@register("expanding_folds", with_sales(
    f"""SELECT v.validation_year, CASE WHEN s.sold_year = v.validation_year THEN 'validate' ELSE 'train' END AS role,
    count(*) AS n_rows, min(s.sold_year) AS min_year, max(s.sold_year) AS max_year
    FROM sales s JOIN (VALUES {_YEARS}) AS v(validation_year) ON s.sold_year <= v.validation_year
    GROUP BY 1, 2"""))
def expanding_folds(spark, sf_dir):
    s = sales_source(spark, sf_dir).where(F.col("sold_year") < HOLDOUT_YEAR)
    tagged = D.expanding_folds(s, "sold_year", VALIDATION_YEARS, check=False)
    return tagged.groupBy("validation_year", "role").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("sold_year").alias("min_year"), F.max("sold_year").alias("max_year")
    )


_STRAT_SQL = with_sales(
    f"""
SELECT sale_id, CASE WHEN rn <= floor(0.2 * n + 0.5) THEN 'holdout' ELSE 'train' END AS split
FROM (
  SELECT sale_id, row_number() OVER (PARTITION BY bin ORDER BY h, sale_id) AS rn, count(*) OVER (PARTITION BY bin) AS n
  FROM (
    SELECT s.sale_id, {H} AS h,
           len(list_filter(e.inner_edges, lambda t: s.sale_price > t)) AS bin
    FROM sales s, (SELECT CASE WHEN len(u) >= 3 THEN list_slice(u, 2, len(u) - 1) ELSE [] END AS inner_edges
                   FROM (SELECT list_sort(list_distinct(quantile_cont(sale_price, {probs_sql(10)}))) AS u FROM sales) q) e
  ) b
) r
"""
)


@register("stratified_split", _STRAT_SQL)
def stratified_split(spark, sf_dir):
    out = D.stratified_split(sales_source(spark, sf_dir), "sale_id", "sale_price", 0.2, SEED, bins=10,
                             quantile_method="refine", hash_buckets=64)
    return out.select("sale_id", "split")


@register("split_disjointness", with_sales(
    f"""SELECT 0 AS n_overlap, count(*) AS n_rows FROM sales"""))
def split_disjointness(spark, sf_dir):
    out = D.stratified_split(sales_source(spark, sf_dir), "sale_id", "sale_price", 0.2, SEED, bins=10,
                             quantile_method="refine", hash_buckets=64)
    train = out.where(F.col("split") == "train").drop("split")
    hold = out.where(F.col("split") == "holdout").drop("split")
    overlap = null_safe_intersection(train, hold, train.columns).agg(F.count(F.lit(1)).alias("n_overlap"))
    total = train.unionByName(hold).agg(F.count(F.lit(1)).alias("n_rows"))
    return overlap.crossJoin(total)


#: Columns without the key, some with nulls: rows of different sales can be equal in them.
SHARED = ("neighborhood", "zoning", "building_type", "rooms", "first_ship_year")
_SAME = " AND ".join(f"l.{c} IS NOT DISTINCT FROM r.{c}" for c in SHARED)


@register("holdout_look_alikes", with_sales(
    f"""SELECT l.zoning, count(*) AS n_rows, sum(CASE WHEN EXISTS (SELECT 1 FROM sales r WHERE r.sold_year < {HOLDOUT_YEAR} AND {_SAME})
        THEN 1 ELSE 0 END) AS n_overlap FROM sales l WHERE l.sold_year = {HOLDOUT_YEAR} GROUP BY l.zoning"""))
def holdout_look_alikes(spark, sf_dir):
    """Holdout rows that equal a development row in all ``SHARED`` columns, nulls being equal."""
    s = sales_source(spark, sf_dir)
    hold = s.where(F.col("sold_year") == HOLDOUT_YEAR).select("sale_id", *SHARED)
    dev = s.where(F.col("sold_year") < HOLDOUT_YEAR).select(*SHARED).distinct()
    seen = null_safe_intersection(hold, dev, SHARED).groupBy("zoning").agg(F.count(F.lit(1)).alias("n_overlap"))
    rows = hold.groupBy("zoning").agg(F.count(F.lit(1)).alias("n_rows"))
    return rows.join(seen, rows["zoning"].eqNullSafe(seen["zoning"]), "left").select(
        rows["zoning"], "n_rows", F.coalesce("n_overlap", F.lit(0)).alias("n_overlap"))


@register("kfold_assignment", with_sales(f"SELECT sale_id, CAST({H} % {KFOLDS} AS INTEGER) AS fold FROM sales"))
def kfold_assignment(spark, sf_dir):
    return D.kfold(sales_source(spark, sf_dir), "sale_id", KFOLDS, SEED).select("sale_id", "fold")


@register("inner_holdout_split", with_sales(
    f"""SELECT {H} < {int(round(INNER_TEST * 2**32))} AS is_test, count(*) AS n_rows, sum(sale_id) AS key_sum
    FROM sales GROUP BY 1"""))
def inner_holdout_split(spark, sf_dir):
    out = D.hash_fraction_split(sales_source(spark, sf_dir), "sale_id", INNER_TEST, SEED)
    return out.groupBy("is_test").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("sale_id").alias("key_sum"))


_FR = ", ".join(f"({f})" for f in FRACTIONS)


@register("learning_curve_subsets", with_sales(
    f"""SELECT f.fraction, count(*) AS n_rows, sum(s.sale_id) AS key_sum
    FROM sales s JOIN (VALUES {_FR}) AS f(fraction) ON CAST({H} AS DOUBLE) < f.fraction * {float(2**32)}
    GROUP BY 1"""))
def learning_curve_subsets(spark, sf_dir):
    out = D.nested_prefixes(sales_source(spark, sf_dir), "sale_id", FRACTIONS, SEED)
    return out.groupBy("fraction").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("sale_id").alias("key_sum"))
