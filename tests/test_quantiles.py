import pytest
from pyspark.sql import functions as F

from valuora.operators.quantiles import grouped_quantiles


@pytest.mark.parametrize("accuracy", [20, 100_000])
def test_refine_matches_exact_on_small_and_large_groups(spark, accuracy):
    rows = [("big", float((i * 7919) % 1000) / 7.0) for i in range(3000)]
    rows += [("tie", 5.0) for _ in range(200)] + [("tie", 1.0)]
    rows += [("small", float(i)) for i in range(7)]
    df = spark.createDataFrame(rows, "g string, x double")
    probs = [0.0, 0.001, 0.1, 0.25, 0.5, 0.75, 0.9, 0.999, 1.0]
    exact = {r.g: r.q for r in grouped_quantiles(df, ["g"], "x", probs, "exact").collect()}
    refined = {r.g: r.q for r in grouped_quantiles(df, ["g"], "x", probs, "refine", accuracy).collect()}
    assert exact.keys() == refined.keys()
    for g in exact:
        assert refined[g] == pytest.approx(exact[g], rel=1e-12, abs=1e-12), g


def test_global_quantile_ignores_nulls(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "x double")
    q = grouped_quantiles(df, [], "x", [0.5], "refine", 2).first()["q"]
    assert q == [2.0]
