"""Structured Streaming jobs (T1-T5) and their batch twins.

All sinks are file sinks with a checkpoint location, so every job is
exactly-once and restartable after a driver or executor loss; none uses
``foreachBatch`` (which needs a Python callback server).  Event times in the
driver's Parquet load as ``TIMESTAMP_NTZ`` and are cast to ``TIMESTAMP``
before any watermark.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from valuora.functions import contract as K
from valuora.plans import production as P

# Cumulative bucket bounds of the request-latency histogram
# (seconds) and of the predicted-price histogram (dollars).
LATENCY_BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0)
PRICE_BUCKETS = (50_000, 100_000, 150_000, 200_000, 300_000, 500_000, 1_000_000)


def file_glob(path: str) -> str:
    """A file-source path for one Parquet file (the file source wants a directory
    or a glob): the last character becomes a one-letter class."""
    return f"{path[:-1]}[{path[-1]}]"


def event_time(col: str, df: DataFrame | None = None) -> Column:
    """The event-time column as ``TIMESTAMP``; left untouched when it already is
    one (a cast would drop the watermark attached to the column)."""
    if df is not None and isinstance(df.schema[col].dataType, T.TimestampType):
        return F.col(col)
    return F.col(col).cast("timestamp")


def window_start_seconds(ts: Column, seconds: int) -> Column:
    """Epoch-aligned tumbling-window start as epoch seconds (batch twin of ``window``)."""
    return (F.floor(F.unix_seconds(ts) / F.lit(seconds)) * F.lit(seconds)).cast("bigint")


def cumulative_buckets(value: Column, bounds: Sequence[float], prefix: str) -> list[Column]:
    """``sum(value <= b)`` per bound (``le_<b>``) plus ``+Inf`` count, ``sum`` and ``count``."""
    out = [F.sum((value <= F.lit(float(b))).cast("long")).alias(f"{prefix}_le_{_name(b)}") for b in bounds]
    out += [F.count(value).alias(f"{prefix}_count"), F.sum(value).alias(f"{prefix}_sum")]
    return out


def _name(b: float) -> str:
    return str(int(b)) if float(b).is_integer() else repr(float(b)).replace(".", "_")


# ---------------------------------------------------------------- T2 / T3 aggregates
def request_counters(events: DataFrame, ts: str = "ts", path: str = "event_type", latency_ms: str = "value",
                     window_seconds: int = 86_400, status: Column | None = None) -> DataFrame:
    """Per (window, path, status): request count and the cumulative latency
    histogram (latency in seconds).  Works on batch and streaming frames."""
    st = status if status is not None else F.when(F.col(path) == "error", F.lit("500")).otherwise(F.lit("200"))
    lat = F.col(latency_ms).cast("double") / F.lit(1000.0)
    w = F.window(event_time(ts, events), f"{window_seconds} seconds")
    agg = events.select(w.alias("w"), F.col(path).alias("path"), st.alias("status"), lat.alias("latency_s")).groupBy(
        "w", "path", "status"
    ).agg(F.count(F.lit(1)).alias("requests"), *cumulative_buckets(F.col("latency_s"), LATENCY_BUCKETS, "latency"))
    return _window_seconds(agg)


def latency_sketches(events: DataFrame, ts: str = "ts", path: str = "event_type", latency_ms: str = "value",
                     window_seconds: int = 3_600, k: int = 800) -> DataFrame:
    """Per (window, path) the number of latencies (seconds) and their KLL sketch.

    Sketches merge, so a sink of short windows gives the percentiles of any longer one
    (:func:`sketch_percentiles`).  A sketch keeps about ``k`` values per level, whatever the window
    holds; windows of at most ``k`` latencies are exact.  Works on batch and streaming frames.
    """
    w = F.window(event_time(ts, events), f"{window_seconds} seconds")
    lat = F.col(latency_ms).cast("double") / F.lit(1000.0)
    rows = events.select(w.alias("w"), F.col(path).alias("path"), lat.alias("latency_s"))
    # Nulls are left out by the sketch and the count: a filter on the rows would move below the
    # watermark and take the heartbeats that close the last windows.
    agg = rows.groupBy("w", "path").agg(F.count("latency_s").alias("requests"), F.kll_sketch_agg_double("latency_s", k).alias("sketch"))
    return _window_seconds(agg).where("requests > 0")


def sketch_rank_error(k: int = 800) -> float:
    """The normalised rank error that a (merged) KLL sketch of ``k`` keeps with 99 % confidence."""
    return 2.296 / k**0.9021


def sketch_percentiles(sketches: DataFrame, window_seconds: int, quantiles: Sequence[float] = (0.5, 0.9, 0.95, 0.99)) -> DataFrame:
    """Percentiles per (longer window, path) from merged sketches: ``window_start, path, requests, quantile, latency_s``."""
    start = (F.floor(F.col("window_start") / F.lit(window_seconds)) * F.lit(window_seconds)).cast("bigint")
    merged = sketches.groupBy(start.alias("window_start"), "path").agg(
        F.sum("requests").alias("requests"), F.kll_merge_agg_double("sketch").alias("sketch"))
    at = F.array(*[F.lit(float(q)) for q in quantiles])
    values = F.kll_sketch_get_quantile_double("sketch", at)
    return merged.select("window_start", "path", "requests", F.explode(F.arrays_zip(at.alias("quantile"), values.alias("latency_s"))).alias("q")).select(
        "window_start", "path", "requests", "q.*")


def _window_seconds(agg: DataFrame) -> DataFrame:
    """Replace the window struct by its start in epoch seconds (after the
    aggregation, so streaming keeps grouping on the watermarked window)."""
    return agg.select(F.unix_seconds(F.col("w.start")).alias("window_start"), *[c for c in agg.columns if c != "w"])


def price_histogram(scored: DataFrame, ts: str, price: str, window_seconds: int) -> DataFrame:
    """Cumulative predicted-price buckets, sum and count per window."""
    w = F.window(event_time(ts, scored), f"{window_seconds} seconds")
    agg = scored.select(w.alias("w"), F.col(price).cast("double").alias("p")).groupBy("w").agg(
        *cumulative_buckets(F.col("p"), PRICE_BUCKETS, "price"))
    return _window_seconds(agg)


# ---------------------------------------------------------------- T4
def delayed_label_join(predictions: DataFrame, labels: DataFrame, key: str, pred_ts: str, label_ts: str,
                       max_delay: str = "365 days", watermark: str = "30 days") -> DataFrame:
    """T4: predictions meet labels that arrive up to ``max_delay`` later.

    Watermarks on both sides plus the bounded event-time condition let the
    streaming join drop state for predictions whose labels can no longer come.
    """
    p = predictions.withColumn(pred_ts, event_time(pred_ts)).withWatermark(pred_ts, watermark).alias("p")
    lab = labels.withColumn(label_ts, event_time(label_ts)).withWatermark(label_ts, watermark).alias("l")
    cond = (
        (F.col(f"p.{key}") == F.col(f"l.{key}"))
        & (F.col(f"l.{label_ts}") >= F.col(f"p.{pred_ts}"))
        & (F.col(f"l.{label_ts}") <= F.col(f"p.{pred_ts}") + F.expr(f"INTERVAL {max_delay}"))
    )
    return p.join(lab, cond, "inner").select(f"p.{key}", f"p.{pred_ts}", f"l.{label_ts}", "p.predicted_price",
                                             "l.actual_price")


def delayed_performance_by_window(joined: DataFrame, ts: str, window_seconds: int) -> DataFrame:
    """R6 per prediction window over the joined pairs."""
    a, p = F.col("actual_price"), F.col("predicted_price")
    return joined.groupBy(window_start_seconds(F.col(ts).cast("timestamp"), window_seconds).alias("window_start")).agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.sqrt(F.avg(F.pow(F.log1p(a) - F.log1p(p), 2))).alias("log_rmse"),
        F.avg(F.abs(a - p)).alias("dollar_mae"),
    )


# ---------------------------------------------------------------- T5
def windowed_bin_counts(current_long: DataFrame, edges: DataFrame, ts: str, window_seconds: int) -> DataFrame:
    """T5 streaming half: bin counts per (window, feature, bin) against frozen
    reference edges (a small static table joined to the stream)."""
    joined = current_long.where(F.col("x").isNotNull()).join(F.broadcast(edges.select("feature", "inner_edges")), "feature")
    binned = joined.where(F.col("inner_edges").isNotNull()).select(
        F.window(event_time(ts, current_long), f"{window_seconds} seconds").alias("w"), "feature",
        F.size(F.filter("inner_edges", lambda e: e <= F.col("x"))).alias("bin"))
    return _window_seconds(binned.groupBy("w", "feature", "bin").agg(F.count(F.lit(1)).alias("n")))


def psi_from_counts(counts: DataFrame, reference_counts: DataFrame) -> DataFrame:
    """T5 batch half: PSI per (window, feature) from bin counts of both sides."""
    from pyspark.sql import Window

    floor = F.lit(1e-6)
    cur = counts.select("window_start", "feature", "bin",
                        (F.col("n") / F.sum("n").over(Window.partitionBy("window_start", "feature"))).alias("c"))
    ref = reference_counts.select("feature", "bin",
                                  (F.col("n") / F.sum("n").over(Window.partitionBy("feature"))).alias("r"))
    wins = cur.select("window_start", "feature").distinct()
    ref_w = wins.join(ref, "feature")
    full = cur.join(ref_w, ["window_start", "feature", "bin"], "full_outer")
    c = F.greatest(F.coalesce(F.col("c"), F.lit(0.0)), floor)
    r = F.greatest(F.coalesce(F.col("r"), F.lit(0.0)), floor)
    return full.groupBy("window_start", "feature").agg(F.sum((c - r) * F.log(c / r)).alias("psi"))


# ---------------------------------------------------------------- runners
def run_available(df: DataFrame, out: str, checkpoint: str, mode: str = "append", partition_by: Sequence[str] = ()) -> None:
    """Drain everything currently available into a checkpointed Parquet sink."""
    w = df.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint)
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.trigger(availableNow=True).start(out)
    q.awaitTermination()


#: Event time of the closing heartbeat: later than any window of the data.
END_OF_STREAM = "2200-01-01 00:00:00"


def run_to_the_end(spark: SparkSession, build, schema: T.StructType, ts: str, out: str, checkpoint: str, beats: str) -> None:
    """Drain a windowed append-mode job so that its last windows arrive too.

    Append mode keeps a window until the watermark passes it, which the data's own
    last rows never do.  ``build`` maps a stream of heartbeats (rows of ``schema``, null
    but for ``ts``) to the aggregate over data and heartbeats together.  The job
    first drains the data; then one heartbeat far in the future moves the watermark
    and the same job, from its checkpoint, emits what was still open.  The
    heartbeat's own window stays in the state.
    """
    spark.createDataFrame([], schema).write.mode("append").parquet(beats)
    run_available(build(spark.readStream.schema(schema).parquet(beats)), out, checkpoint)
    last = [F.lit(END_OF_STREAM if f.name == ts else None).cast(f.dataType).alias(f.name) for f in schema]
    spark.range(1).select(*last).write.mode("append").parquet(beats)
    run_available(build(spark.readStream.schema(schema).parquet(beats)), out, checkpoint)


def scoring_stream(
    spark: SparkSession,
    requests_path: str,
    contract: T.StructType,
    rules: Sequence[K.CrossRule],
    predict,
    calibration: DataFrame,
    model_version: str,
) -> DataFrame:
    """JSON request lines -> S12 parse -> P3/P4 validation -> M18/M19.

    ``predict`` maps the valid typed rows to rows with ``log_prediction``
    (a fitted ``PipelineModel.transform`` or a closed-form expression).
    Returns one streaming frame with ``route`` = valid | quarantine, to be
    written partitioned by route (valid rows carry the response columns,
    quarantined rows carry their reasons).
    """
    from valuora.sources.files import parse_requests

    raw = spark.readStream.text(requests_path).withColumnRenamed("value", "__raw")
    parsed = parse_requests(raw, "__raw", contract, keep=["__raw"])
    checked = K.validate(parsed, contract, rules, extra_keys="extra_keys", mistyped="mistyped")
    checked = checked.withColumn("violations", F.when(F.col("_corrupt_record").isNotNull(),
                                                      F.array(F.lit("malformed document"))).otherwise(F.col("violations")))
    valid = checked.where(F.size("violations") == 0).select(*K.clean(contract))
    scored = P.response(P.score(predict(valid), calibration), model_version)
    answer = scored.select(
        F.lit("valid").alias("route"),
        F.to_json(F.struct(*[F.col(s.name) for s in contract])).alias("request"),
        "predicted_price_2010_usd", "interval_90_low", "interval_90_high", "inflation_adjusted_reference_usd",
        F.array_join("response_warnings", " | ").alias("detail"),
    )
    rejected = checked.where(F.size("violations") > 0).select(
        F.lit("quarantine").alias("route"), F.col("__raw").alias("request"),
        F.lit(None).cast("double").alias("predicted_price_2010_usd"), F.lit(None).cast("double").alias("interval_90_low"),
        F.lit(None).cast("double").alias("interval_90_high"),
        F.lit(None).cast("double").alias("inflation_adjusted_reference_usd"),
        F.array_join("violations", "; ").alias("detail"),
    )
    return answer.unionByName(rejected)
