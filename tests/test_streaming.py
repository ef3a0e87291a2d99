"""Streaming jobs (T1, T2, T4) against their batch twins on sf0.001."""

from bisect import bisect_left, bisect_right

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from valuora.streaming import jobs as S


def test_stream_scoring_routes_every_request(spark, sf_dir):
    out = entry.queries()["stream_scoring"](spark, sf_dir)
    routes = {r.route: r["count"] for r in out.groupBy("route").count().collect()}
    from valuora.sources.tables import HOLDOUT_YEAR, sales_table

    n = sales_table(spark, sf_dir).where(F.col("sold_year") == HOLDOUT_YEAR).count()
    assert sum(routes.values()) == n
    valid = out.where("route = 'valid'")
    assert valid.where("interval_90_low > predicted_price_2010_usd OR predicted_price_2010_usd > interval_90_high").count() == 0
    bad = out.where("route = 'quarantine'").select("detail").collect()
    assert all(r.detail for r in bad)


def test_stream_join_matches_batch_twin(spark, sf_dir):
    q = entry.queries()
    stream = {r.window_start: (r.n_pairs, round(r.log_rmse, 6)) for r in q["stream_delayed_labels"](spark, sf_dir).collect()}
    batch = {r.window_start: (r.n_pairs, r.log_rmse) for r in q["delayed_label_windows"](spark, sf_dir).collect()}
    assert stream == batch


@pytest.mark.parametrize("stream,batch", [
    ("stream_request_counters", "request_counters"), ("stream_price_histogram", "price_histogram"),
    ("stream_windowed_drift", "windowed_drift"), ("stream_drift_report", "windowed_drift_report"),
    ("stream_latency_percentiles", "latency_percentiles")])
def test_streams_equal_their_batch_twins(spark, sf_dir, stream, batch):
    """Every window arrives, the last ones included."""
    q = entry.queries()
    got, want = q[stream](spark, sf_dir), q[batch](spark, sf_dir)
    rows = lambda df: sorted(map(str, df.select(*want.columns).collect()))
    assert rows(got) == rows(want)


def test_merged_sketches_keep_their_rank_error(spark):
    """60,000 latencies in 60 windows merged into one; ties, nulls and a small exact window."""
    n = 60_000
    rows = spark.range(n).select(
        (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(secs=F.col("id") % 60 * 60)).alias("ts"), F.lit("a").alias("event_type"),
        F.when(F.col("id") % 7 == 0, 100.0).otherwise((F.col("id") * 7919 % n).cast("double")).alias("value"))
    rows = rows.unionByName(spark.sql("SELECT timestamp'2024-01-01 00:00:10' ts, 'b' event_type, CAST(null AS DOUBLE) value"))
    sketches = S.latency_sketches(rows, window_seconds=60)
    assert sketches.where("path = 'b'").count() == 0
    asked = [0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99]
    got = S.sketch_percentiles(sketches, 86_400, asked).collect()
    values = sorted(r["value"] for r in rows.where("event_type = 'a'").select("value").collect())
    assert {r["requests"] for r in got} == {n} and sorted(r["quantile"] for r in got) == asked
    for r in got:
        low, high = bisect_left(values, r["latency_s"] * 1000 - 1e-6) / n, bisect_right(values, r["latency_s"] * 1000 + 1e-6) / n
        assert low - 3 * S.sketch_rank_error() <= r["quantile"] <= high + 3 * S.sketch_rank_error()
    few = S.sketch_percentiles(S.latency_sketches(rows.where("event_type = 'a'").limit(5), window_seconds=60), 86_400, [0.0, 1.0])
    assert few.count() == 2
