"""Streaming queries (T1-T5): batch twins with DuckDB oracles, and the real
Structured Streaming jobs (file source, ``availableNow``, checkpointed
Parquet sinks in the shared checkpoint folder) checked rows-only."""

from __future__ import annotations

from pyspark.sql import functions as F

from valuora.catalog import REGISTRY, register
from valuora.catalog.sqlgen import long_sql, psi_sql, windowed_report_sql
from valuora.functions import contract as K
from valuora.operators import drift
from valuora.operators import drift_cells as C
from valuora.operators.quantiles import grouped_quantiles
from valuora.session import checkpoint_root, materialize, scratch_path
from valuora.sources.tables import (
    sales_source,
    EVENTS_SQL,
    HOLDOUT_YEAR,
    REFERENCE_CUTOFF_YEAR,
    SALES_BOUNDS,
    SALES_CATEGORICAL,
    SALES_NUMERIC,
    SCORED_SQL,
    VALIDATION_YEARS,
    scored_sales,
    sale_events,
    sales_table,
    table,
    with_sales,
)
from valuora.streaming import jobs as S

DAY = 86_400
MONTH = 30 * DAY
YEAR = 365 * DAY


def _bucket_sql(value: str, bounds, prefix: str) -> str:
    parts = [f"sum(CASE WHEN {value} <= {float(b)!r} THEN 1 ELSE 0 END) AS {prefix}_le_{S._name(b)}" for b in bounds]
    parts += [f"count({value}) AS {prefix}_count", f"sum({value}) AS {prefix}_sum"]
    return ", ".join(parts)


def _utc(spark):
    """Event times are zone-less (TIMESTAMP_NTZ); window arithmetic runs on
    TIMESTAMP, so pin the session zone to UTC to keep windows epoch-aligned
    whatever zone the caller's session uses."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def _round_sum(df, col, d=6):
    return df.withColumn(col, F.round(col, d))


# ---------------------------------------------------------------- T2 (batch twin)
@register("request_counters", f"""
SELECT CAST(floor(epoch(ts) / {DAY}) * {DAY} AS BIGINT) AS window_start, event_type AS path,
       CASE WHEN event_type = 'error' THEN '500' ELSE '200' END AS status, count(*) AS requests,
       {_bucket_sql('value / 1000.0', S.LATENCY_BUCKETS, 'latency').replace('AS latency_sum', 'AS latency_sum_raw')}
FROM events GROUP BY 1, 2, 3
""".replace("sum(value / 1000.0) AS latency_sum_raw", "round(sum(value / 1000.0), 6) AS latency_sum"))
def request_counters(spark, sf_dir):
    _utc(spark)
    out = S.request_counters(table(spark, sf_dir, "events"), window_seconds=DAY)
    return _round_sum(out, "latency_sum")


# ---------------------------------------------------------------- T3 (batch twin)
@register("price_histogram", f"""
WITH {EVENTS_SQL.strip()}
SELECT CAST(floor(epoch(ts) / {MONTH}) * {MONTH} AS BIGINT) AS window_start,
       {_bucket_sql('predicted_price', S.PRICE_BUCKETS, 'price').replace('sum(predicted_price) AS price_sum', 'round(sum(predicted_price), 2) AS price_sum')}
FROM sale_ev GROUP BY 1
""")
def price_histogram(spark, sf_dir):
    _utc(spark)
    out = S.price_histogram(sale_events(spark, sf_dir), "ts", "predicted_price", MONTH)
    return _round_sum(out, "price_sum", 2)


# ---------------------------------------------------------------- T4 (batch twin)
@register("delayed_label_windows", f"""
WITH {EVENTS_SQL.strip()}
SELECT CAST(floor(epoch(ts) / {MONTH}) * {MONTH} AS BIGINT) AS window_start, count(*) AS n_pairs,
       round(sqrt(avg(pow(ln(1 + actual_price) - ln(1 + predicted_price), 2))), 6) AS log_rmse,
       round(avg(abs(actual_price - predicted_price)), 2) AS dollar_mae
FROM sale_ev WHERE label_ts >= ts AND label_ts <= ts + INTERVAL 365 DAY
GROUP BY 1
""")
def delayed_label_windows(spark, sf_dir):
    _utc(spark)
    ev = sale_events(spark, sf_dir)
    preds = ev.select("sale_id", "ts", "predicted_price")
    labels = ev.select("sale_id", "label_ts", "actual_price").where(F.col("label_ts").isNotNull())
    joined = S.delayed_label_join(preds, labels, "sale_id", "ts", "label_ts")
    out = S.delayed_performance_by_window(joined, "ts", MONTH)
    return out.select("window_start", "n_pairs", F.round("log_rmse", 6).alias("log_rmse"),
                      F.round("dollar_mae", 2).alias("dollar_mae"))


# ---------------------------------------------------------------- T5 (batch twin)
def _t5_sql() -> str:
    ref_where = f"sold_year < {REFERENCE_CUTOFF_YEAR}"
    cur = " UNION ALL ".join(
        f"SELECT CAST(floor(epoch(o.o_orderdate) / {YEAR}) * {YEAR} AS BIGINT) AS window_start, '{f}' AS feature, "
        f"CAST(s.{f} AS DOUBLE) AS x FROM sales s JOIN orders o ON o.o_orderkey = s.sale_id "
        f"WHERE s.sold_year >= {REFERENCE_CUTOFF_YEAR}" for f in SALES_NUMERIC)
    return with_sales(
        """
SELECT w.window_start, w.feature,
       round(sum((greatest(coalesce(c.s, 0.0), 1e-6) - greatest(coalesce(w.r, 0.0), 1e-6))
                 * ln(greatest(coalesce(c.s, 0.0), 1e-6) / greatest(coalesce(w.r, 0.0), 1e-6))), 6) AS psi
FROM (SELECT k.window_start, r.feature, r.bin, r.r FROM (SELECT DISTINCT window_start, feature FROM cur_bins) k
      JOIN ref_share r ON r.feature = k.feature) w
FULL OUTER JOIN cur_share c ON c.window_start = w.window_start AND c.feature = w.feature AND c.bin = w.bin
GROUP BY 1, 2
""".replace("SELECT w.window_start, w.feature,", "SELECT coalesce(w.window_start, c.window_start) AS window_start, "
            "coalesce(w.feature, c.feature) AS feature,"),
        f"ref_long AS ({long_sql('sales', SALES_NUMERIC, ref_where)})",
        f"cur_long AS ({cur})",
        psi_sql("ref_long", "ref_long", SALES_NUMERIC, prefix="r_").strip(),
        """cur_bins AS (SELECT c.window_start, c.feature, len(list_filter(e.inner_edges, lambda t: t <= c.x)) AS bin, count(*) AS n
            FROM cur_long c JOIN r_edges2 e ON e.feature = c.feature WHERE c.x IS NOT NULL AND e.inner_edges IS NOT NULL
            GROUP BY 1, 2, 3)""",
        "cur_share AS (SELECT window_start, feature, bin, n / sum(n) OVER (PARTITION BY window_start, feature) AS s FROM cur_bins)",
        "ref_share AS (SELECT feature, bin, s AS r FROM r_ref_sh)",
    )


@register("windowed_drift", _t5_sql())
def windowed_drift(spark, sf_dir):
    _utc(spark)
    s = sales_source(spark, sf_dir)
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("sale_id"), F.col("o_orderdate").alias("ts"))
    ref = drift.numeric_long(s.where(F.col("sold_year") < REFERENCE_CUTOFF_YEAR), SALES_NUMERIC)
    edges = drift.fit_edges(ref, 10, "refine")
    cur = s.where(F.col("sold_year") >= REFERENCE_CUTOFF_YEAR).join(orders, "sale_id")
    cur_long = cur.select("ts", *[F.col(f).cast("double").alias(f) for f in SALES_NUMERIC]).unpivot(
        ["ts"], list(SALES_NUMERIC), "feature", "x")
    counts = S.windowed_bin_counts(cur_long, edges, "ts", YEAR)
    ref_counts = ref.where(F.col("x").isNotNull()).join(F.broadcast(edges.select("feature", "inner_edges")), "feature") \
        .where(F.col("inner_edges").isNotNull()) \
        .select("feature", F.size(F.filter("inner_edges", lambda e: e <= F.col("x"))).alias("bin")) \
        .groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("n"))
    out = S.psi_from_counts(counts, ref_counts)
    return out.select("window_start", "feature", F.round("psi", 6).alias("psi"))


# ---------------------------------------------------------------- real streams
@register("stream_request_counters", REGISTRY["request_counters"][1])
def stream_request_counters(spark, sf_dir):
    """T2 as a stream: watermark 1 hour, daily windows, append mode, closed to the last window."""
    _utc(spark)
    checkpoint_root(spark)
    schema = table(spark, sf_dir, "events").schema

    def build(beats):
        src = spark.readStream.schema(schema).parquet(S.file_glob(f"{sf_dir}/events.parquet")).unionByName(beats)
        src = src.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", "1 hour")
        return S.request_counters(src, window_seconds=DAY)

    out = scratch_path(spark, "t2-out")
    S.run_to_the_end(spark, build, schema, "ts", out, scratch_path(spark, "t2-ckpt"), scratch_path(spark, "t2-beats"))
    return _round_sum(spark.read.parquet(out), "latency_sum")


@register("stream_price_histogram", REGISTRY["price_histogram"][1])
def stream_price_histogram(spark, sf_dir):
    """T3 as a stream: predicted prices in monthly windows, watermark 30 days."""
    _utc(spark)
    checkpoint_root(spark)
    prices = sale_events(spark, sf_dir).select("ts", "predicted_price")
    held = scratch_path(spark, "t3-prices")
    prices.write.parquet(held)

    def build(beats):
        src = spark.readStream.schema(prices.schema).parquet(held).unionByName(beats)
        src = src.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", "30 days")
        return S.price_histogram(src, "ts", "predicted_price", MONTH)

    out = scratch_path(spark, "t3-out")
    S.run_to_the_end(spark, build, prices.schema, "ts", out, scratch_path(spark, "t3-ckpt"), scratch_path(spark, "t3-beats"))
    return _round_sum(spark.read.parquet(out), "price_sum", 2)


@register("stream_delayed_labels", REGISTRY["delayed_label_windows"][1])
def stream_delayed_labels(spark, sf_dir):
    """T4 as a stream-stream join (both inputs written once as file streams)."""
    _utc(spark)
    checkpoint_root(spark)
    ev = sale_events(spark, sf_dir)
    pred_dir, lab_dir = scratch_path(spark, "t4-pred"), scratch_path(spark, "t4-lab")
    ev.select("sale_id", "ts", "predicted_price").write.parquet(pred_dir)
    ev.select("sale_id", "label_ts", "actual_price").where(F.col("label_ts").isNotNull()).write.parquet(lab_dir)
    preds = spark.readStream.schema("sale_id long, ts timestamp_ntz, predicted_price double").parquet(pred_dir)
    labels = spark.readStream.schema("sale_id long, label_ts timestamp_ntz, actual_price double").parquet(lab_dir)
    joined = S.delayed_label_join(preds, labels, "sale_id", "ts", "label_ts")
    out = scratch_path(spark, "t4-out")
    S.run_available(joined, out, scratch_path(spark, "t4-ckpt"))
    windows = S.delayed_performance_by_window(spark.read.parquet(out), "ts", MONTH)
    return windows.select("window_start", "n_pairs", F.round("log_rmse", 6).alias("log_rmse"),
                          F.round("dollar_mae", 2).alias("dollar_mae"))


@register("stream_scoring")
def stream_scoring(spark, sf_dir):
    """Holdout rows as JSON request documents -> validated, scored stream."""
    from valuora.plans import closed_form as CF
    from valuora.plans import comparison as C

    checkpoint_root(spark)
    trained = CF.train_and_evaluate(sales_source(spark, sf_dir), "sale_price", "sold_year", HOLDOUT_YEAR,
                                    VALIDATION_YEARS, method="refine", materialize_input=False)
    req_dir = scratch_path(spark, "t1-req")
    hold = sales_source(spark, sf_dir).where(F.col("sold_year") == HOLDOUT_YEAR)
    hold.select(F.to_json(F.struct(*[F.col(s.name) for s in K.SALES_CONTRACT]))).write.text(req_dir)

    def predict(valid):
        return C.predict_with(valid, trained.params, CF.UNIVARIATE).withColumnRenamed("prediction", "log_prediction")

    stream = S.scoring_stream(spark, req_dir, K.SALES_CONTRACT, K.SALES_RULES, predict, trained.calibration,
                              "closed-form-1")
    out = scratch_path(spark, "t1-out")
    S.run_available(stream, out, scratch_path(spark, "t1-ckpt"), partition_by=["route"])
    return spark.read.parquet(out)


@register("stream_windowed_drift", REGISTRY["windowed_drift"][1])
def stream_windowed_drift(spark, sf_dir):
    """T5 as a stream: current rows arrive as a file stream, are binned against
    frozen reference edges (static broadcast table) and counted per yearly
    event-time window with a watermark; PSI is then computed from the sink."""
    _utc(spark)
    checkpoint_root(spark)
    s = sales_source(spark, sf_dir)
    ref = drift.numeric_long(s.where(F.col("sold_year") < REFERENCE_CUTOFF_YEAR), SALES_NUMERIC)
    edges = drift.fit_edges(ref, 10, "refine")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("sale_id"), F.col("o_orderdate").alias("ts"))
    cur_dir = scratch_path(spark, "t5-cur")
    s.where(F.col("sold_year") >= REFERENCE_CUTOFF_YEAR).join(orders, "sale_id").select(
        "ts", *[F.col(f).cast("double").alias(f) for f in SALES_NUMERIC]).write.parquet(cur_dir)
    schema = "ts timestamp_ntz, " + ", ".join(f"{f} double" for f in SALES_NUMERIC)
    rows = spark.read.parquet(cur_dir).schema

    def build(beats):
        stream = spark.readStream.schema(schema).parquet(cur_dir).unionByName(beats)
        stream = stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", "30 days")
        return S.windowed_bin_counts(stream.unpivot(["ts"], list(SALES_NUMERIC), "feature", "x"), edges, "ts", YEAR)

    out = scratch_path(spark, "t5-out")
    S.run_to_the_end(spark, build, rows, "ts", out, scratch_path(spark, "t5-ckpt"), scratch_path(spark, "t5-beats"))
    ref_counts = ref.where(F.col("x").isNotNull()).join(F.broadcast(edges.select("feature", "inner_edges")), "feature") \
        .where(F.col("inner_edges").isNotNull()) \
        .select("feature", F.size(F.filter("inner_edges", lambda e: e <= F.col("x"))).alias("bin")) \
        .groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("n"))
    psi = S.psi_from_counts(spark.read.parquet(out), ref_counts)
    return psi.select("window_start", "feature", F.round("psi", 6).alias("psi"))


# ---------------------------------------------------------------- T5: the whole report by window
_REPORT_SQL = with_sales(
    windowed_report_sql("base", SALES_NUMERIC, SALES_CATEGORICAL, SALES_BOUNDS),
    SCORED_SQL,
    f"base AS (SELECT s.*, s.sold_year < {REFERENCE_CUTOFF_YEAR} AS is_ref, "
    f"CAST(floor(epoch(o.o_orderdate) / {YEAR}) * {YEAR} AS BIGINT) AS window_start "
    "FROM scored s JOIN orders o ON o.o_orderkey = s.sale_id)",
)


def _report_sides(spark, sf_dir):
    """The frozen reference, and the scored rows since the cutoff with their order dates."""
    s = scored_sales(sales_source(spark, sf_dir))
    frozen = C.freeze(s.where(F.col("sold_year") < REFERENCE_CUTOFF_YEAR), SALES_NUMERIC, SALES_CATEGORICAL, SALES_BOUNDS,
                      "actual_price", "predicted_price")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("sale_id"), F.col("o_orderdate").alias("ts"))
    return frozen, s.where(F.col("sold_year") >= REFERENCE_CUTOFF_YEAR).join(orders, "sale_id")


def _rounded_report(report):
    return report.withColumn("value", F.round("value", 6))


@register("windowed_drift_report", _REPORT_SQL)
def windowed_drift_report(spark, sf_dir):
    """R3-R8 by yearly event-time window against the frozen reference."""
    _utc(spark)
    frozen, current = _report_sides(spark, sf_dir)
    cells = C.current_cells(current, frozen, F.window(F.col("ts").cast("timestamp"), f"{YEAR} seconds"))
    return _rounded_report(C.report_from_cells(materialize(cells, "window-cells"), frozen))


@register("stream_drift_report", _REPORT_SQL)
def stream_drift_report(spark, sf_dir):
    """The same report as a stream: one streaming aggregate over the tagged cells, watermark 30 days,
    closed to the last window; the report is made from the sink's cells."""
    _utc(spark)
    checkpoint_root(spark)
    frozen, current = _report_sides(spark, sf_dir)
    held = scratch_path(spark, "t5-report-rows")
    current.write.parquet(held)
    schema = spark.read.parquet(held).schema

    def build(beats):
        rows = spark.readStream.schema(schema).parquet(held).unionByName(beats)
        rows = rows.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", "30 days")
        return C.current_cells(rows, frozen, F.window("ts", f"{YEAR} seconds"))

    out = scratch_path(spark, "t5-report-cells")
    S.run_to_the_end(spark, build, schema, "ts", out, scratch_path(spark, "t5-report-ckpt"), scratch_path(spark, "t5-report-beats"))
    return _rounded_report(C.report_from_cells(spark.read.parquet(out), frozen))


# ---------------------------------------------------------------- T2: latency percentiles
HOUR = 3_600
LATENCY_QUANTILES = (0.5, 0.9, 0.95, 0.99)
#: Three times the error that a sketch keeps with 99 % confidence.
RANK_BOUND = 3 * S.sketch_rank_error()

_PERCENTILE_SQL = f"""
SELECT CAST(floor(epoch(ts) / {DAY}) * {DAY} AS BIGINT) AS window_start, event_type AS path, count(value) AS requests, q.quantile,
       round(quantile_cont(value, q.quantile), 6) AS exact_latency_ms, TRUE AS sketch_within_bound
FROM events, (SELECT unnest([{', '.join(f'CAST({q} AS DOUBLE)' for q in LATENCY_QUANTILES)}]) AS quantile) q
WHERE value IS NOT NULL GROUP BY 1, 2, 4
""".replace("quantile_cont(value, q.quantile)", "CASE q.quantile " + " ".join(
    f"WHEN {q} THEN quantile_cont(value, {q})" for q in LATENCY_QUANTILES) + " END")


def _held_against_exact(events, estimates):
    """Daily percentiles from sketches beside the exact ones, and whether the estimate's true rank is within the bound."""
    day = S.window_start_seconds(F.col("ts").cast("timestamp"), DAY)
    rows = events.select(day.alias("window_start"), F.col("event_type").alias("path"),
                         F.col("value").cast("double").alias("x")).where("x IS NOT NULL")
    exact = grouped_quantiles(rows, ["window_start", "path"], "x", LATENCY_QUANTILES, "refine").select(
        "window_start", "path", F.explode(F.arrays_zip(F.array(*[F.lit(q) for q in LATENCY_QUANTILES]).alias("quantile"), "q")).alias("e")).select(
        "window_start", "path", "e.quantile", F.round("e.q", 6).alias("exact_latency_ms"))
    asked = estimates.groupBy("window_start", "path", "requests").agg(F.collect_list(F.struct("quantile", (F.col("latency_s") * 1000.0).alias("latency_ms"))).alias("asked"))
    sides = rows.join(asked, ["window_start", "path"]).select("window_start", "path", "requests", "x", F.explode("asked").alias("a"))
    at, slack = F.col("a.latency_ms"), F.col("a.latency_ms") * 1e-12  # ms -> s -> ms costs a last bit
    ranks = sides.groupBy("window_start", "path", "requests", "a.quantile").agg(
        F.avg((F.col("x") < at - slack).cast("double")).alias("below"), F.avg((F.col("x") <= at + slack).cast("double")).alias("upto"))
    within = (F.col("below") - RANK_BOUND <= F.col("quantile")) & (F.col("quantile") <= F.col("upto") + RANK_BOUND)
    return ranks.join(exact, ["window_start", "path", "quantile"]).select(
        "window_start", "path", "requests", "quantile", "exact_latency_ms", within.alias("sketch_within_bound"))


@register("latency_percentiles", _PERCENTILE_SQL)
def latency_percentiles(spark, sf_dir):
    """Hourly sketches merged to days."""
    _utc(spark)
    events = table(spark, sf_dir, "events")
    estimates = materialize(S.sketch_percentiles(S.latency_sketches(events, window_seconds=HOUR), DAY, LATENCY_QUANTILES), "latency-percentiles")
    return _held_against_exact(events, estimates)


@register("stream_latency_percentiles", _PERCENTILE_SQL)
def stream_latency_percentiles(spark, sf_dir):
    """The hourly sketches come from a stream (watermark 1 hour); its sink is merged to days."""
    _utc(spark)
    checkpoint_root(spark)
    events = table(spark, sf_dir, "events")

    def build(beats):
        rows = spark.readStream.schema(events.schema).parquet(S.file_glob(f"{sf_dir}/events.parquet")).unionByName(beats)
        rows = rows.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", "1 hour")
        return S.latency_sketches(rows, window_seconds=HOUR)

    out = scratch_path(spark, "t2-sketches")
    S.run_to_the_end(spark, build, events.schema, "ts", out, scratch_path(spark, "t2-sketch-ckpt"), scratch_path(spark, "t2-sketch-beats"))
    estimates = materialize(S.sketch_percentiles(spark.read.parquet(out), DAY, LATENCY_QUANTILES), "latency-percentiles")
    return _held_against_exact(events, estimates)
