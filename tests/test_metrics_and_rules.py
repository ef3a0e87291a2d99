"""A4/A5 identities, the consensus vote (A20) and the one-SE rule (M6)."""

import math

import pytest
from pyspark.sql import functions as F

from valuora.operators import metrics as M
from valuora.operators import selection as G
from valuora.plans import comparison as C


def test_perfect_prediction_metrics(spark):
    df = spark.createDataFrame([(math.log1p(v), math.log1p(v)) for v in (100000.0, 200000.0, 300000.0)], "y double, p double")
    m = M.regression_metrics(df, "y", "p").first()
    assert m.log_rmse == 0 and m.dollar_mae == pytest.approx(0, abs=1e-6)
    assert m.log_r2 == 1.0 and m.dollar_r2 == 1.0


def test_dollar_mae_by_hand(spark):
    rows = [(math.log1p(a), math.log1p(p)) for a, p in ((100.0, 110.0), (200.0, 180.0))]
    m = M.regression_metrics(spark.createDataFrame(rows, "y double, p double"), "y", "p").first()
    assert m.dollar_mae == pytest.approx(15.0)
    assert m.dollar_mape == pytest.approx((0.1 + 0.1) / 2)


def test_adjusted_r2(spark):
    df = spark.range(1).select(
        M.adjusted_r2(F.lit(0.9), F.lit(30.0), 5).alias("a"), M.adjusted_r2(F.lit(0.9), F.lit(6.0), 5).alias("b"))
    r = df.first()
    assert r.a == pytest.approx(1 - 0.1 * 29 / 24)
    assert r.b is None


def test_consensus_keeps_majority(spark):
    keep = spark.createDataFrame([("m1", "a"), ("m1", "b"), ("m2", "a"), ("m2", "c"), ("m3", "a")],
                                 "method string, feature string")
    votes = {r.feature: (r.votes, r.keep) for r in G.consensus(keep, list("abcd"), ["m1", "m2", "m3"]).collect()}
    assert votes == {"a": (3, 1), "b": (1, 0), "c": (1, 0), "d": (0, 0)}
    with pytest.raises(ValueError):
        G.consensus(keep, list("abcd"), [])


def _summary(spark, rows):
    return spark.createDataFrame(rows, "model string, log_rmse double, log_rmse_se double")


def test_one_se_rule_prefers_simpler_model(spark):
    s = _summary(spark, [("baseline", 0.40, 0.01), ("ridge", 0.165, 0.01), ("elastic_net", 0.164, 0.01),
                         ("gradient_boosting", 0.160, 0.008)])
    d = C.select_model(s, C.PRODUCTION_COMPLEXITY).first()
    assert d.chosen == "ridge" and d.best_cv_model == "gradient_boosting"
    assert d.one_se_threshold == pytest.approx(0.168)


def test_small_gain_falls_back_to_baseline(spark):
    s = _summary(spark, [("baseline", 0.40, 0.01), ("ridge", 0.34, 0.01)])
    d = C.select_model(s, C.PRODUCTION_COMPLEXITY).first()
    assert d.chosen == "baseline"
    assert d.baseline_improvement == pytest.approx(0.15)
