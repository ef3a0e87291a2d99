"""Benchmark the headline queries.

Runs each query over the tables in ``$BENCH_SF_DIR`` (default
``/root/testdata/sf0.1``) on ``local[$BENCH_CPUS]`` and prints ONE JSON line:
``{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}``.
Every query is executed in full through the ``noop`` sink (no collect), after
one warm-up query that pays the JVM and code-generation start-up.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "sales_table",
    "contract_violations",
    "drift_report",
    "stratified_split",
    "group_boxplot",
    "target_encoding",
    "temporal_comparison",
    "model_selection",
    "holdout_scoring",
    "holdout_evaluation",
    "consensus_votes",
    "request_counters",
    "windowed_drift",
    "stream_request_counters",
    "ml_temporal_comparison",
]


def scoring_throughput(spark, sf_dir: str) -> dict:
    """Batch-scoring cost per row with already fitted models (the reference
    reports prediction latency per row): every sales row is scored through
    the noop sink by the closed-form model and by the fitted pyspark.ml model."""
    from valuora.catalog import ml_queries
    from valuora.plans import closed_form as CF
    from valuora.plans import comparison as C
    from valuora.plans import production as P
    from valuora.plans import training as T
    from valuora.sources.tables import HOLDOUT_YEAR, VALIDATION_YEARS, sales_source

    rows = sales_source(spark, sf_dir)
    n = rows.count()
    out = {}
    cf = CF.train_and_evaluate(rows, "sale_price", "sold_year", HOLDOUT_YEAR, VALIDATION_YEARS, method="refine",
                               materialize_input=False)
    t0 = time.perf_counter()
    pred = C.predict_with(rows, cf.params, CF.UNIVARIATE).withColumnRenamed("prediction", "log_prediction")
    P.response(P.score(pred, cf.calibration), "bench").write.format("noop").mode("overwrite").save()
    out["closed_form"] = round((time.perf_counter() - t0) * 1000 / n, 5)
    ml = ml_queries._production(spark, sf_dir)
    t0 = time.perf_counter()
    T.score_with_model(ml["model"], ml["calibration"], rows).write.format("noop").mode("overwrite").save()
    out[ml["chosen"]] = round((time.perf_counter() - t0) * 1000 / n, 5)
    out["rows"] = n
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from valuora.catalog import queries
    from valuora.session import build_session, checkpoint_root

    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(cpus, 8),
                          extra_conf={"spark.ui.showConsoleProgress": "false"})
    checkpoint_root(spark)
    qs = queries()
    warm = qs["sales_table"](spark, sf_dir)
    warm.write.format("noop").mode("overwrite").save()
    timings: dict[str, float] = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
    scoring = scoring_throughput(spark, sf_dir)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_queries_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "scoring_ms_per_row": scoring,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
