"""Learned transformer queries (E1-E8): fit on development rows (before the
holdout year), apply to holdout rows (or cross-fit the training rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from valuora.catalog import register
from valuora.functions.columns import seeded_hash_sql
from valuora.operators import encoders as E
from valuora.sources.tables import sales_source, HOLDOUT_YEAR, SEED, sales_table, with_sales

DEV = f"dev AS (SELECT *, ln(1 + sale_price) AS label FROM sales WHERE sold_year < {HOLDOUT_YEAR})"
HOLD = f"hold AS (SELECT * FROM sales WHERE sold_year = {HOLDOUT_YEAR})"
METHOD = "refine"
IMPUTE_COLS = ["acctbal", "living_area", "basement_area", "rooms", "frontage"]


def _parts(spark, sf_dir):
    s = sales_source(spark, sf_dir).withColumn("label", F.log1p("sale_price"))
    return s.where(F.col("sold_year") < HOLDOUT_YEAR), s.where(F.col("sold_year") == HOLDOUT_YEAR)


def r(col, d=6):
    return F.round(F.col(col), d).alias(col)


# ---------------------------------------------------------------- E1 (A1 + J1)
@register("impute_group_median", with_sales("""
SELECT h.sale_id, round(coalesce(h.frontage, g.med, (SELECT median(frontage) FROM dev)), 6) AS frontage
FROM hold h LEFT JOIN (SELECT neighborhood, median(frontage) AS med FROM dev GROUP BY neighborhood) g
  ON g.neighborhood = h.neighborhood
""", DEV, HOLD))
def impute_group_median(spark, sf_dir):
    dev, hold = _parts(spark, sf_dir)
    model = E.GroupMedianImputer(inputCols=["frontage"], groupCol="neighborhood", method=METHOD).fit(dev)
    return model.transform(hold).select("sale_id", r("frontage"))


# ---------------------------------------------------------------- E2 + E3
def _median_sql():
    fills = ", ".join(f"round(coalesce(CAST(h.{c} AS DOUBLE), m.{c}), 6) AS {c}" for c in IMPUTE_COLS)
    meds = ", ".join(f"median(CAST({c} AS DOUBLE)) AS {c}" for c in IMPUTE_COLS)
    flags = ", ".join(
        f"CASE WHEN (SELECT count(*) FROM dev WHERE {c} IS NULL) > 0 THEN CAST(h.{c} IS NULL AS DOUBLE) END AS missingindicator_{c}"
        for c in IMPUTE_COLS)
    return with_sales(f"SELECT h.sale_id, {fills}, {flags} FROM hold h, (SELECT {meds} FROM dev) m", DEV, HOLD)


@register("impute_median_indicators", _median_sql())
def impute_median_indicators(spark, sf_dir):
    dev, hold = _parts(spark, sf_dir)
    model = E.MedianImputer(inputCols=IMPUTE_COLS, addIndicator=True, method=METHOD).fit(dev)
    out = model.transform(hold)
    flags = [f"missingindicator_{c}" for c in IMPUTE_COLS]
    return out.select("sale_id", *[r(c) for c in IMPUTE_COLS],
                      *[F.col(f) if f in out.columns else F.lit(None).cast("double").alias(f) for f in flags])


# ---------------------------------------------------------------- E4
@register("impute_mode", with_sales("""
SELECT h.sale_id, coalesce(h.rooms, (SELECT rooms FROM dev WHERE rooms IS NOT NULL GROUP BY rooms
                                     ORDER BY count(*) DESC, rooms LIMIT 1)) AS rooms, h.zoning
FROM hold h
""", DEV, HOLD))
def impute_mode(spark, sf_dir):
    dev, hold = _parts(spark, sf_dir)
    return E.ModeImputer(inputCols=["rooms", "zoning"]).fit(dev).transform(hold).select("sale_id", "rooms", "zoning")


# ---------------------------------------------------------------- E5
SCALE_COLS = ["acctbal", "living_area", "frontage"]


@register("standard_scale", with_sales(
    "SELECT h.sale_id, " + ", ".join(
        f"round((h.{c} - m.{c}__m) / CASE WHEN m.{c}__s > 0 THEN m.{c}__s ELSE 1.0 END, 6) AS {c}" for c in SCALE_COLS)
    + " FROM hold h, (SELECT " + ", ".join(f"avg({c}) AS {c}__m, stddev_pop({c}) AS {c}__s" for c in SCALE_COLS)
    + " FROM dev) m", DEV, HOLD))
def standard_scale(spark, sf_dir):
    dev, hold = _parts(spark, sf_dir)
    return E.PopulationScaler(inputCols=SCALE_COLS).fit(dev).transform(hold).select("sale_id", *[r(c) for c in SCALE_COLS])


# ---------------------------------------------------------------- E6 (A11 + A19)
def _skew_sql():
    picks = []
    for c in IMPUTE_COLS:
        picks.append(
            f"(SELECT abs(skewness(CAST({c} AS DOUBLE))) > 0.75 AND min({c}) >= 0 AND count(DISTINCT {c}) > 2 FROM dev) AS {c}__pick")
    vals = ", ".join(f"round(CASE WHEN p.{c}__pick THEN ln(1 + h.{c}) ELSE CAST(h.{c} AS DOUBLE) END, 6) AS {c}" for c in IMPUTE_COLS)
    return with_sales(f"SELECT h.sale_id, {vals} FROM hold h, (SELECT {', '.join(picks)}) p", DEV, HOLD)


@register("skewed_log1p", _skew_sql())
def skewed_log1p(spark, sf_dir):
    dev, hold = _parts(spark, sf_dir)
    out = E.SkewedLog1p(inputCols=IMPUTE_COLS, threshold=0.75).fit(dev).transform(hold)
    return out.select("sale_id", *[F.round(F.col(c).cast("double"), 6).alias(c) for c in IMPUTE_COLS])


# ---------------------------------------------------------------- E7
ONEHOT_COLS = ["zoning", "building_type"]


@register("one_hot_encoding", with_sales(
    " UNION ALL ".join(
        f"""SELECT h.sale_id, '{c}_' || l.lvl AS level, CAST(coalesce(h.{c} = l.lvl, false) AS DOUBLE) AS value
        FROM hold h, (SELECT DISTINCT CAST({c} AS VARCHAR) AS lvl FROM dev WHERE {c} IS NOT NULL) l"""
        for c in ONEHOT_COLS), DEV, HOLD))
def one_hot_encoding(spark, sf_dir):
    dev, hold = _parts(spark, sf_dir)
    model = E.OneHot(inputCols=ONEHOT_COLS).fit(dev)
    names = model.output_names()
    out = model.transform(hold.select("sale_id", *ONEHOT_COLS))
    return out.unpivot(["sale_id"], names, "level", "value")


# ---------------------------------------------------------------- E8
H = seeded_hash_sql("sale_id", SEED)


def _shrunk_sql(n, s, ss, gm, gv):
    mean = f"(({s}) / ({n}))"
    var = f"greatest(({ss}) / ({n}) - {mean} * {mean}, 0.0)"
    lam = f"CASE WHEN ({n}) * ({gv}) + {var} > 0 THEN ({n}) * ({gv}) / (({n}) * ({gv}) + {var}) ELSE 1.0 END"
    return f"CASE WHEN ({n}) > 0 THEN ({lam}) * {mean} + (1.0 - ({lam})) * ({gm}) ELSE ({gm}) END"


_TE_SQL = with_sales(
    f"""
SELECT d.sale_id, round({_shrunk_sql('coalesce(o.n, 0.0)', 'o.s', 'o.ss', 'g.gm', 'g.gv')}, 6) AS neighborhood
FROM devf d JOIN gl g ON g.fold = d.fold LEFT JOIN oof o ON o.cat = d.neighborhood AND o.fold = d.fold
UNION ALL
SELECT h.sale_id, round(coalesce(e.enc, (SELECT gm FROM full_g)), 6) AS neighborhood
FROM hold h LEFT JOIN enc e ON e.cat = h.neighborhood
""",
    DEV, HOLD,
    f"devf AS (SELECT *, CAST({H} % 5 AS INTEGER) AS fold FROM dev)",
    "gf AS (SELECT fold, CAST(count(label) AS DOUBLE) AS gn, sum(label) AS gs, sum(label * label) AS gss FROM devf GROUP BY fold)",
    "gt AS (SELECT sum(gn) AS tn, sum(gs) AS ts, sum(gss) AS tss FROM gf)",
    """gl AS (SELECT fold, (ts - gs) / (tn - gn) AS gm,
        (tss - gss) / (tn - gn) - pow((ts - gs) / (tn - gn), 2) AS gv FROM gf, gt)""",
    """per AS (SELECT neighborhood AS cat, fold, CAST(count(label) AS DOUBLE) AS n, sum(label) AS s, sum(label * label) AS ss
        FROM devf GROUP BY 1, 2)""",
    "tot AS (SELECT cat, sum(n) AS tn, sum(s) AS ts, sum(ss) AS tss FROM per GROUP BY cat)",
    "oof AS (SELECT p.cat, p.fold, t.tn - p.n AS n, t.ts - p.s AS s, t.tss - p.ss AS ss FROM per p JOIN tot t ON t.cat = p.cat)",
    "full_g AS (SELECT avg(label) AS gm, var_pop(label) AS gv FROM dev)",
    f"""enc AS (SELECT cat, {_shrunk_sql('n', 's', 'ss', '(SELECT gm FROM full_g)', '(SELECT gv FROM full_g)')} AS enc
        FROM (SELECT neighborhood AS cat, CAST(count(label) AS DOUBLE) AS n, sum(label) AS s, sum(label * label) AS ss
              FROM dev GROUP BY 1) c)""",
)


@register("target_encoding", _TE_SQL)
def target_encoding(spark, sf_dir):
    dev, hold = _parts(spark, sf_dir)
    enc = E.CrossFittedTargetEncoder(inputCols=["neighborhood"], labelCol="label", keyCol="sale_id", folds=5, seed=SEED)
    train_part = enc.fit_transform(dev).select("sale_id", r("neighborhood"))
    hold_part = enc.fit(dev).transform(hold).select("sale_id", r("neighborhood"))
    return train_part.unionByName(hold_part)


# ---------------------------------------------------------------- E9: the cleaning steps, raw variant
@register("legacy_cleaned_rows", with_sales("""
SELECT s.sale_id, CAST(s.sold_year AS VARCHAR) AS sold_year, coalesce(CAST(s.basement_area AS DOUBLE), 0.0) AS basement_area,
       round(coalesce(CAST(s.frontage AS DOUBLE), g.m, a.m), 6) AS frontage,
       round(coalesce(s.living_area, 0.0) + coalesce(CAST(s.basement_area AS DOUBLE), 0.0), 6) AS total_area,
       coalesce(s.neighborhood, 'Missing') AS neighborhood, coalesce(s.zoning, 'Missing') AS zoning,
       coalesce(s.building_type, 'Missing') AS building_type, coalesce(s.grade, 'Missing') AS grade
FROM sales s
LEFT JOIN (SELECT neighborhood, quantile_cont(CAST(frontage AS DOUBLE), 0.5) AS m FROM sales GROUP BY 1) g ON g.neighborhood = s.neighborhood
CROSS JOIN (SELECT quantile_cont(CAST(frontage AS DOUBLE), 0.5) AS m FROM sales) a
"""))
def legacy_cleaned_rows(spark, sf_dir):
    """E9 raw: year codes as text, no basement as 0, frontage by its neighborhood's median, the summed area."""
    from valuora.plans import models as MD
    from valuora.plans.cleaning import Cleaning

    s = sales_source(spark, sf_dir)
    steps = Cleaning(codes=("sold_year",), zeros=("basement_area",), group="neighborhood", grouped=("frontage",),
                     engineered={"total_area": "coalesce(living_area, 0.0) + basement_area"})
    pre = MD.legacy_preprocessor("raw", ["basement_area", "frontage"], ["neighborhood", "zoning", "building_type", "grade"], {}, None, "sale_id", 42, False, steps)
    return pre.fit(s).transform(s).select("sale_id", "sold_year", F.col("basement_area").cast("double").alias("basement_area"),
                                          F.round("frontage", 6).alias("frontage"), F.round("total_area", 6).alias("total_area"),
                                          "neighborhood", "zoning", "building_type", "grade")
