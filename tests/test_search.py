"""Model-based search on a known surface, its ranges, and a small run over shared folds."""

import numpy as np
from pyspark.sql import functions as F

from valuora.plans import models as MD
from valuora.plans import search as H


def surface(p):
    return (np.log(p["rate"] / 0.03)) ** 2 + 0.3 * (p["maxDepth"] - 5) ** 2 + 4 * (p["columnShare"] - 0.7) ** 2 + 0.1 * np.log(p["l2"]) ** 2


def test_search_beats_random_draws_and_is_seeded():
    wins, gains = 0, []
    for seed in range(100, 120):
        run = H.search(lambda batch: [surface(p) for p in batch], H.BOOSTER_RANGES, 60, seed)
        rng = np.random.default_rng(1000 + seed)
        drawn = min(surface({n: r.value(rng.random()) for n, r in H.BOOSTER_RANGES.items()}) for _ in range(60))
        best = min(t["score"] for t in run)
        wins += best < drawn
        gains.append(drawn - best)
        assert len(run) == 60
    assert wins >= 14 and np.mean(gains) > 0
    again = [H.search(lambda batch: [surface(p) for p in batch], H.BOOSTER_RANGES, 20, 7) for _ in range(2)]
    assert again[0] == again[1]


def test_values_stay_in_their_ranges_and_failed_trials_count_as_worst():
    run = H.search(lambda batch: [float("nan") if p["maxDepth"] > 6 else surface(p) for p in batch], H.BOOSTER_RANGES, 40, 3)
    for t in run:
        for name, r in H.BOOSTER_RANGES.items():
            assert r.low <= t["params"][name] <= r.high and isinstance(t["params"][name], int if r.whole else float)
    late = [t["params"]["maxDepth"] for t in run[20:]]
    assert np.mean([d > 6 for d in late]) < 0.34
    whole = H.Range(3, 8, whole=True)
    assert [whole.value(u) for u in (0.0, 0.1, 0.99, 1.0)] == [3, 3, 8, 8]
    assert H.search(lambda batch: [], H.BOOSTER_RANGES, 0, 1) == []


def test_booster_search_over_shared_folds(spark):
    df = spark.range(240).select(F.col("id").alias("k"), (F.col("id") % 17).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"),
                                 (F.col("id") % 3).cast("int").alias("fold")).withColumn("label", F.col("a") * 0.1 + F.col("b") ** 2 * 0.2)
    small = {"rounds": H.Range(5, 20, whole=True), "rate": H.Range(0.05, 0.5, log=True), "maxDepth": H.Range(1, 3, whole=True)}
    pre = lambda: MD.ProductionPreprocessor(numericCols=["a", "b"], categoricalCols=[])
    run = H.booster_search(df, pre, "fold", 3, trials=4, seed=1, batch=2, ranges=small)
    assert len(run) == 4 and all(np.isfinite(t["score"]) for t in run)
    grid = H.booster_search(df, pre, "fold", 3, trials=2, seed=1, batch=2, ranges=small)
    assert [t["params"] for t in grid] == [t["params"] for t in run[:2]]
    assert all(abs(a["score"] - b["score"]) < 1e-9 for a, b in zip(grid, run))
