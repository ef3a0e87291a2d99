"""Ranked tables, group order, manifests of whole rows, look-alikes and the chosen features."""

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from valuora.operators import metrics as M
from valuora.operators import profile as A
from valuora.operators.joins import null_safe_intersection
from valuora.plans import models as MD
from valuora.plans import training as T
from valuora.sources import manifest


def test_tables_are_ranked_by_the_first_metric_they_have(spark):
    rows = [("a", 2.0, 1.0), ("b", 1.0, 2.0), ("c", None, 3.0), ("d", 1.0, 0.0)]
    both = spark.createDataFrame(rows, "model string, log_rmse_mean double, log_rmse double")
    assert [r["model"] for r in M.ranked_table(both).collect()] == ["b", "d", "a", "c"]
    fallback = M.ranked_table(both.drop("log_rmse_mean"))
    assert [(r["model"], r["rank"]) for r in fallback.collect()] == [("d", 1), ("a", 2), ("b", 3), ("c", 4)]
    assert [r["model"] for r in M.ranked_table(both, descending=True).collect()][0] == "a"
    with pytest.raises(ValueError):
        M.ranked_table(both.select("model"))
    assert M.ranked_table(both.limit(0)).count() == 0


def test_groups_are_ordered_by_median(spark):
    rows = [("x", 5.0), ("x", 7.0), ("y", 1.0), (None, 6.0), ("z", None), ("w", 6.0)]
    got = A.groups_by_median(spark.createDataFrame(rows, "g string, v double").repartition(3), "g", "v").collect()
    assert [(r["g"], r["median"], r["n"], r["rank"]) for r in got] == [
        ("z", None, 0, 1), ("y", 1.0, 1, 2), (None, 6.0, 1, 3), ("w", 6.0, 1, 4), ("x", 6.0, 2, 5)]


def test_every_column_of_every_row_is_in_the_manifest(spark):
    base = spark.createDataFrame([(1, 1999, None, "u"), (2, 2000, "u", None)], "k int, year int, a string, b string")
    one = manifest.manifest(base, "year", 2000).first()
    moved = manifest.manifest(base.select("k", "year", F.col("b").alias("a"), F.col("a").alias("b")), "year", 2000).first()
    assert one["fingerprint"] != moved["fingerprint"]
    assert one["fingerprint"] == manifest.manifest(base.repartition(2), "year", 2000).first()["fingerprint"]


def test_null_safe_intersection_takes_nulls_as_equal(spark):
    left = spark.createDataFrame([(1, None), (2, "a"), (3, None)], "k int, v string")
    right = spark.createDataFrame([(None,), ("b",)], "v string")
    assert sorted(r["k"] for r in null_safe_intersection(left, right, ["v"]).collect()) == [1, 3]


def _rows(spark):
    rows = [(i, float(i % 11), None if i % 9 == 0 else float(i % 4), "pq"[i % 2], i % 2 + i % 11 / 10, i % 3) for i in range(120)]
    return spark.createDataFrame(rows, "k int, n double, m double, c string, label double, fold int")


def _pre(log=False):
    return MD.legacy_preprocessor("ohe", ["n", "m"], ["c"], {}, None, "k", 1, log)


def test_slot_names_are_those_of_the_columns(spark):
    out = _pre().fit(_rows(spark)).transform(_rows(spark))
    assert MD.feature_names(out) == ["n", "m", "missingindicator_m", "c_p", "c_q"]


def test_full_and_selected_features_are_compared(spark):
    kept = Pipeline(stages=[*_pre().getStages(), MD.FeatureSubset(names=["n", "c_q", "unseen"])]).fit(_rows(spark)).transform(_rows(spark))
    assert MD.feature_names(kept) == ["n", "c_q"]
    got = T.selection_comparison(_rows(spark), _pre, ["n", "c_q"], "fold", 3, 1).collect()
    assert {r["model"] for r in got} == {"Ridge__full", "Ridge__selected", "GradientBoosting__full", "GradientBoosting__selected"}
    assert [r["rank"] for r in got] == [1, 2, 3, 4]
    assert [r["log_rmse_mean"] for r in got] == sorted(r["log_rmse_mean"] for r in got) and got[0]["log_rmse_mean"] < 0.3
    with pytest.raises(ValueError):
        Pipeline(stages=[*_pre().getStages(), MD.FeatureSubset(names=["unseen"])]).fit(_rows(spark))
