"""Sources, contract, projection and cleaning queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from valuora.catalog import register
from valuora.functions import contract as K
from valuora.functions.columns import QUALITY_SCALE, seeded_hash_sql
from valuora.operators import validate as V
from valuora.sources import files, manifest
from valuora.sources.tables import sales_source, HOLDOUT_YEAR, sales_table, table, with_sales

SALES_COLUMNS = (
    "sale_id, sold_year, neighborhood, zoning, building_type, grade, acctbal, living_area, basement_area, "
    "rooms, frontage, first_ship_year, last_ship_year, market_price, sale_price"
)


# ---------------------------------------------------------------- S1 (sales source)
@register("sales_table", with_sales(f"SELECT {SALES_COLUMNS} FROM sales"))
def sales_table_query(spark, sf_dir):
    return sales_table(spark, sf_dir)  # derived from the raw tables every time


# ---------------------------------------------------------------- P2 + P13 + F18
def _projection_sql() -> str:
    cols = ", ".join(f"{s.metadata['column']} AS {s.name}" for s in K.SALES_CONTRACT)
    return with_sales(f"SELECT {cols}, CAST(sale_price AS DOUBLE) AS sale_price, round(ln(1 + sale_price), 6) AS label FROM sales")


@register("contract_projection", _projection_sql())
def contract_projection(spark, sf_dir):
    cur = K.project(sales_source(spark, sf_dir), K.SALES_CONTRACT, target="sale_price")
    return V.with_log_label(cur, "sale_price").withColumn("label", F.round("label", 6))


# ---------------------------------------------------------------- P3 + P4
def _violation_sql_list() -> str:
    checks = []
    for s in K.SALES_CONTRACT:
        if K.is_text(s):
            checks.append(f"CASE WHEN {s.name} IS NULL THEN '{s.name}: required' END")
            checks.append(f"CASE WHEN {s.name} IS NOT NULL AND length(trim(CAST({s.name} AS VARCHAR))) = 0 THEN '{s.name}: empty' END")
            continue
        num = f"TRY_CAST(CAST({s.name} AS VARCHAR) AS DOUBLE)"
        checks.append(f"CASE WHEN {s.name} IS NULL THEN '{s.name}: required' END")
        checks.append(f"CASE WHEN {s.name} IS NOT NULL AND {num} IS NULL THEN '{s.name}: not a number' END")
        if K.is_whole(s):
            checks.append(f"CASE WHEN {num} IS NOT NULL AND {num} <> floor({num}) THEN '{s.name}: not an integer' END")
        low, high = s.metadata.get("low"), s.metadata.get("high")
        if low is not None:
            checks.append(f"CASE WHEN {num} < {float(low)} THEN '{s.name}: below {low:g}' END")
        if high is not None:
            checks.append(f"CASE WHEN {num} > {float(high)} THEN '{s.name}: above {high:g}' END")
    for r in K.SALES_RULES:
        a, b = f"CAST({r.left} AS DOUBLE)", f"CAST({r.right} AS DOUBLE)"
        checks.append(f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL AND NOT ({a} {r.op} {b}) THEN '{r.message}' END")
    return "list_filter([" + ",\n  ".join(checks) + "], lambda v: v IS NOT NULL)"


_VIOL_SQL = with_sales(
    f"""
SELECT sale_id, len(v) AS n_violations, array_to_string(v, '; ') AS violations
FROM (SELECT sale_id, {_violation_sql_list()} AS v FROM sales) t
"""
)


@register("contract_violations", _VIOL_SQL)
def contract_violations(spark, sf_dir):
    checked = K.validate(sales_source(spark, sf_dir), K.SALES_CONTRACT, K.SALES_RULES)
    return checked.select(
        "sale_id", F.size("violations").alias("n_violations"), F.array_join("violations", "; ").alias("violations")
    )


# ---------------------------------------------------------------- P5
_ROUTE_SQL = with_sales(
    f"""
SELECT CASE WHEN len(v) = 0 THEN 'valid' ELSE 'quarantine' END AS route, count(*) AS n_rows
FROM (SELECT {_violation_sql_list()} AS v FROM sales) t GROUP BY 1
"""
)


@register("contract_routing", _ROUTE_SQL)
def contract_routing(spark, sf_dir):
    valid, bad = K.route(K.validate(sales_source(spark, sf_dir), K.SALES_CONTRACT, K.SALES_RULES))
    return valid.select(F.lit("valid").alias("route")).unionByName(
        bad.select(F.lit("quarantine").alias("route"))
    ).groupBy("route").agg(F.count(F.lit(1)).alias("n_rows"))


# ---------------------------------------------------------------- P7 / P8
OUTLIER_AREA, OUTLIER_PRICE = 200.0, 190000.0


@register("outlier_filter", with_sales(
    f"SELECT sold_year, count(*) AS n_rows FROM sales WHERE NOT coalesce(living_area > {OUTLIER_AREA} "
    f"AND sale_price < {OUTLIER_PRICE}, false) GROUP BY sold_year"))
def outlier_filter(spark, sf_dir):
    kept = V.drop_outliers(sales_source(spark, sf_dir), "living_area", "sale_price", OUTLIER_AREA, OUTLIER_PRICE)
    return kept.groupBy("sold_year").agg(F.count(F.lit(1)).alias("n_rows"))


@register("outlier_listing", with_sales(
    f"SELECT sale_id, living_area, grade, sale_price FROM sales WHERE living_area > {OUTLIER_AREA} "
    f"AND sale_price < {OUTLIER_PRICE}"))
def outlier_listing(spark, sf_dir):
    return V.outlier_rows(sales_source(spark, sf_dir), "living_area", "sale_price", OUTLIER_AREA, OUTLIER_PRICE,
                          ["sale_id", "living_area", "grade", "sale_price"])


# ---------------------------------------------------------------- P9 + P10 + P12
@register("column_subset", with_sales(
    "SELECT sale_id, rooms, 0 AS ghost_feature, zoning FROM sales"))
def column_subset(spark, sf_dir):
    s = V.drop_columns(sales_source(spark, sf_dir), ["market_price", "not_a_column"])
    return V.subset_zero_fill(s, ["sale_id", "rooms", "ghost_feature", "zoning"])


@register("codes_to_string", with_sales(
    "SELECT sale_id, CAST(rooms AS VARCHAR) AS rooms, "
    "CASE WHEN living_area = floor(living_area) THEN CAST(CAST(living_area AS BIGINT) AS VARCHAR) "
    "ELSE CAST(living_area AS VARCHAR) END AS living_area FROM sales"))
def codes_to_string(spark, sf_dir):
    s = sales_source(spark, sf_dir).select("sale_id", "rooms", "living_area")
    return V.codes_to_string(s, ["rooms", "living_area", "absent_code"])


# ---------------------------------------------------------------- F8 + F9 + F10
_FILL_SQL = with_sales(
    f"""
SELECT sale_id, coalesce(returns_seen, 'None') AS returns_seen, coalesce(discount_band, 'Missing') AS discount_band,
       coalesce(basement_area, 0) AS basement_area,
       coalesce(list_position({list(QUALITY_SCALE)}, coalesce(returns_seen, 'None')), 0) - 1 AS returns_level,
       coalesce(list_position(['5-LOW', '4-NOT SPECIFIED', '3-MEDIUM', '2-HIGH', '1-URGENT'], grade), 0) - 1 AS grade_level,
       coalesce(list_position({list(QUALITY_SCALE)}, building_type), 0) - 1 AS status_level
FROM (SELECT sale_id, grade, building_type, basement_area,
             CASE WHEN basement_area IS NOT NULL THEN 'Gd' END AS returns_seen,
             CASE WHEN frontage >= 0.05 THEN 'high' WHEN frontage < 0.05 THEN 'low' END AS discount_band
      FROM sales) t
"""
)


@register("fill_and_ordinals", _FILL_SQL)
def fill_and_ordinals(spark, sf_dir):
    s = sales_source(spark, sf_dir).select(
        "sale_id", "grade", "building_type", "basement_area",
        F.when(F.col("basement_area").isNotNull(), "Gd").alias("returns_seen"),
        F.when(F.col("frontage") >= 0.05, "high").when(F.col("frontage") < 0.05, "low").alias("discount_band"),
    )
    s = V.fill_informative(s, ["returns_seen", "basement_area"], zeros=["basement_area"])
    s = V.fill_missing_categories(s)
    s = s.withColumn("returns_level", F.col("returns_seen")).withColumn("grade_level", F.col("grade")) \
        .withColumn("status_level", F.col("building_type"))
    s = V.map_ordinals(s, ["returns_level", "status_level"], QUALITY_SCALE)
    s = V.map_ordinals(s, ["grade_level"], V.GRADE_SCALE)
    return s.select("sale_id", "returns_seen", "discount_band", "basement_area", "returns_level", "grade_level", "status_level")


# ---------------------------------------------------------------- F1-F7
_FE_SQL = with_sales(
    """
SELECT sale_id,
       CASE WHEN last_ship_year - sold_year IS NULL THEN NULL ELSE greatest(0, last_ship_year - sold_year) END AS ship_lag,
       CASE WHEN sold_year - first_ship_year IS NULL THEN NULL ELSE greatest(0, sold_year - first_ship_year) END AS order_lag,
       living_area + coalesce(basement_area, 0) AS total_area,
       0.0 + 1.0 * coalesce(rooms, 0) + 0.5 * coalesce(basement_area, 0) AS weighted_count,
       grade_level * living_area AS grade_by_area,
       living_area + basement_area + frontage AS area_sum,
       CAST(coalesce(basement_area > 0, false) AS INTEGER) AS has_returns,
       CAST(coalesce(frontage > 0, false) AS INTEGER) AS has_discount,
       CAST(coalesce(acctbal > 0, false) AS INTEGER) AS has_credit
FROM (SELECT *, coalesce(list_position(['5-LOW', '4-NOT SPECIFIED', '3-MEDIUM', '2-HIGH', '1-URGENT'], grade), 0) - 1 AS grade_level
      FROM sales) t
"""
)


@register("engineered_features", _FE_SQL)
def engineered_features(spark, sf_dir):
    s = sales_source(spark, sf_dir).withColumn("grade_level", F.col("grade"))
    s = V.map_ordinals(s, ["grade_level"], V.GRADE_SCALE)
    return V.engineer_sales(s).select("sale_id", *V.ENGINEERED)


# ---------------------------------------------------------------- S7
_JSON_SQL = with_sales(
    """
SELECT zoning,
       CASE WHEN isnan(v) OR isinf(v) THEN NULL ELSE v END AS root_balance,
       CASE WHEN isnan(w) OR isinf(w) THEN NULL ELSE w END AS growth
FROM (SELECT zoning, sqrt(min(acctbal)) AS v, exp(max(acctbal)) AS w FROM sales GROUP BY zoning) t
"""
)


@register("strict_json_values", _JSON_SQL)
def strict_json_values(spark, sf_dir):
    agg = sales_source(spark, sf_dir).groupBy("zoning").agg(
        F.sqrt(F.min("acctbal")).alias("root_balance"), F.exp(F.max("acctbal")).alias("growth")
    )
    return files.json_safe(agg)


# ---------------------------------------------------------------- S12
REQUEST_SCHEMA = T.StructType([T.StructField("k", T.IntegerType())])


@register("request_parsing", """
SELECT event_id, TRY_CAST(json_extract(props, '$.k') AS INTEGER) AS k,
       len(list_filter(json_keys(props), lambda x: x <> 'k')) AS n_extra_keys,
       CAST(json_valid(props) = false AS INTEGER) AS is_corrupt
FROM events
""")
def request_parsing(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "props")
    parsed = files.parse_requests(ev, "props", REQUEST_SCHEMA, keep=["event_id"])
    return parsed.select(
        "event_id", F.col("k").try_cast("int").alias("k"), F.size("extra_keys").alias("n_extra_keys"),
        F.col("_corrupt_record").isNotNull().cast("int").alias("is_corrupt"),
    )


# ---------------------------------------------------------------- S10
_MANIFEST_SQL = with_sales(
    f"""
SELECT count(*) AS n_rows, 15 AS n_columns,
       sum(CASE WHEN sold_year < {HOLDOUT_YEAR} THEN 1 ELSE 0 END) AS n_development,
       sum(CASE WHEN sold_year = {HOLDOUT_YEAR} THEN 1 ELSE 0 END) AS n_holdout,
       CAST(sum(CAST(('0x' || substr(md5(concat_ws('|', CAST(sale_id AS VARCHAR), neighborhood, zoning,
            CAST(sold_year AS VARCHAR))), 1, 8)) AS BIGINT)) AS BIGINT) AS fingerprint
FROM sales
"""
)


@register("dataset_manifest", _MANIFEST_SQL)
def dataset_manifest(spark, sf_dir):
    s = sales_source(spark, sf_dir)
    return manifest.manifest(s, "sold_year", HOLDOUT_YEAR, ["sale_id", "neighborhood", "zoning", "sold_year"])


_EXACT = ("acctbal", "living_area", "basement_area", "frontage", "market_price", "sale_price")  # decimal texts: every engine writes them alike
_QUOTED = (*_EXACT, "neighborhood", "zoning", "building_type", "grade")


def _row_json_sql() -> str:
    parts = []
    for c in (c.strip() for c in SALES_COLUMNS.split(",")):
        text = f"CAST(CAST({c} AS DECIMAL(18, 4)) AS VARCHAR)" if c in _EXACT else f"CAST({c} AS VARCHAR)"
        text = f"""'"' || {text} || '"'""" if c in _QUOTED else text
        parts.append(f"""'"{c}":' || coalesce({text}, 'null')""")
    return "'{' || " + " || ',' || ".join(parts) + " || '}'"


@register("dataset_manifest_rows", with_sales(f"""
SELECT count(*) AS n_rows, 15 AS n_columns, sum(CASE WHEN sold_year < {HOLDOUT_YEAR} THEN 1 ELSE 0 END) AS n_development,
       sum(CASE WHEN sold_year = {HOLDOUT_YEAR} THEN 1 ELSE 0 END) AS n_holdout,
       CAST(sum(CAST('0x' || substr(sha256({_row_json_sql()}), 1, 15) AS BIGINT)) AS VARCHAR) AS fingerprint
FROM sales"""))
def dataset_manifest_rows(spark, sf_dir):
    """S10 over whole rows: every column of every row, nulls included, is in the fingerprint."""
    s = sales_source(spark, sf_dir)
    exact = s.select(*[F.col(c).cast("decimal(18,4)").cast("string").alias(c) if c in _EXACT else c for c in s.columns])
    return manifest.manifest(exact, "sold_year", HOLDOUT_YEAR).drop("schema").withColumn("fingerprint", F.col("fingerprint").cast("string"))


# ---------------------------------------------------------------- S2 + S3 (CSV round trip)
@register("csv_round_trip", with_sales(f"SELECT {SALES_COLUMNS} FROM sales"))
def csv_round_trip(spark, sf_dir):
    """Write the table as headed CSV, read it back by extension with the
    table's schema (no inference), and return what was read."""
    from valuora.session import scratch_path

    src = sales_source(spark, sf_dir)
    path = scratch_path(spark, "csv-round-trip") + ".csv"
    src.write.mode("overwrite").option("header", True).csv(path)
    return files.read_frame(spark, path, schema=src.schema)


# ---------------------------------------------------------------- S5 (+ S3, D3)
@register("saved_split_reload", with_sales("""
SELECT sale_id, sale_price FROM (
  SELECT sale_id, sale_price, row_number() OVER (PARTITION BY bin ORDER BY h, sale_id) AS rn, count(*) OVER (PARTITION BY bin) AS n
  FROM (
    SELECT s.sale_id, s.sale_price, """ + seeded_hash_sql("sale_id", 42) + """ AS h,
           len(list_filter(e.inner_edges, lambda t: s.sale_price > t)) AS bin
    FROM sales s, (SELECT CASE WHEN len(u) >= 3 THEN list_slice(u, 2, len(u) - 1) ELSE [] END AS inner_edges
                   FROM (SELECT list_sort(list_distinct(quantile_cont(sale_price, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS u
                         FROM sales) q) e) b) r
WHERE rn <= floor(0.2 * n + 0.5)
"""))
def saved_split_reload(spark, sf_dir):
    """Persist both partitions of the stratified split in one partitioned
    write, then reload only the holdout (the filter prunes the directory)."""
    from valuora.operators.splits import stratified_split
    from valuora.session import scratch_path

    out = stratified_split(sales_source(spark, sf_dir), "sale_id", "sale_price", 0.2, 42, quantile_method="refine",
                           hash_buckets=64)
    path = scratch_path(spark, "saved-split")
    files.save_split(out.select("sale_id", "sale_price", "split"), path)
    return files.load_split(spark, path, "holdout").select("sale_id", "sale_price")
