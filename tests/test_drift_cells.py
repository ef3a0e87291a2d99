"""The drift report from cells: constant and empty sides, nulls, novel values, cells that add up."""

import math

from pyspark.sql import functions as F

from valuora.operators import drift
from valuora.operators import drift_cells as C

SCHEMA = "x double, k double, c string, actual_price double, predicted_price double"


def report(rows):
    return {(r["section"], r["feature"], r["metric"]): r["value"] for r in rows.collect()}


def sides(spark):
    reference = spark.createDataFrame([(float(i % 20), 7.0, "ab"[i % 2], 1.0, float(i)) for i in range(200)] + [(None, 7.0, None, 1.0, 3.0)], SCHEMA)
    current = spark.createDataFrame([(float(i % 10), 7.0 if i % 4 else 8.0, "abc"[i % 3], 100.0, 90.0) for i in range(60)] + [(None, None, None, None, 90.0)], SCHEMA)
    return reference, current


def test_report_values(spark):
    reference, current = sides(spark)
    got = report(drift.drift_report(reference, current, ["x", "k"], ["c"], {"x": (2, 8)}))
    psi = drift.psi_columns(reference, current, ["x", "k"]).collect()
    for r in psi:
        assert abs(got["numeric", r["feature"], "psi"] - r["psi"]) < 1e-12
    assert got["numeric", "k", "psi"] == 15 / 60  # a constant reference: share of other values
    assert got["numeric", "x", "current_missing_rate"] == 1 / 61 and got["numeric", "x", "reference_missing_rate"] == 1 / 201
    assert got["categorical", "c", "novel_category_rate"] == 20 / 60 and got["categorical", "c", "current_missing_rate"] == 1 / 61
    assert got["range_violations", "x", "violation_rate"] == 18 / 61
    assert abs(got["delayed_label_performance", None, "log_rmse"] - (math.log1p(100) - math.log1p(90))) < 1e-12
    assert got["delayed_label_performance", None, "dollar_mae"] == 10.0
    assert got["prediction_shift", "predicted_price", "current_mean"] == 90.0


def test_empty_sides_keep_every_line(spark):
    reference, current = sides(spark)
    got = report(drift.drift_report(reference, current.limit(0), ["x", "k"], ["c"], {"x": (2, 8)}))
    assert got["numeric", "x", "psi"] is None and got["numeric", "x", "reference_missing_rate"] == 1 / 201
    assert got["categorical", "c", "novel_category_rate"] == 0.0 and got["categorical", "c", "current_missing_rate"] is None
    assert got["range_violations", "x", "violation_rate"] is None and got["delayed_label_performance", None, "log_rmse"] is None
    none = report(drift.drift_report(reference.limit(0), current, ["x"], ["c"], {}))
    assert none["numeric", "x", "psi"] is None and none["categorical", "c", "novel_category_rate"] == 1.0


def test_cells_of_two_parts_add_up(spark):
    reference, current = sides(spark)
    frozen = C.freeze(reference, ["x", "k"], ["c"], {"x": (2, 8)}, "actual_price", "predicted_price")
    parts = [C.current_cells(current.where(F.col("x") < 4), frozen), C.current_cells(current.where("x >= 4 OR x IS NULL"), frozen)]
    whole, added = report(C.report_from_cells(C.current_cells(current, frozen), frozen)), report(C.report_from_cells(parts[0].unionByName(parts[1]), frozen))
    assert whole.keys() == added.keys()
    assert all(math.isclose(whole[k], added[k], rel_tol=1e-12) for k in whole)
