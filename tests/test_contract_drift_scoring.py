"""Contract validation (P3-P5), strict JSON (S7), drift (R1-R4), scoring (M18), CPI."""

import json
import math

import pytest
from pyspark.sql import functions as F

from valuora.functions import contract as K
from valuora.functions.columns import CPI_BASE, CPI_REFERENCE, cpi_factor
from valuora.operators import drift
from valuora.plans import production as P
from valuora.sources import files

GOOD = {"neighborhood": " N1 ", "zoning": "BUILDING", "building_type": "O", "grade": "1-URGENT", "acctbal": 10.0,
        "living_area": 100.0, "basement_area": 0.0, "rooms": 4, "frontage": 0.05, "first_ship_year": 1995,
        "last_ship_year": 1996, "sold_year": 1997}


def _requests(spark, docs):
    text = spark.createDataFrame([(json.dumps(d),) for d in docs], "t string")
    parsed = files.parse_requests(text, "t", K.SALES_CONTRACT)
    return K.validate(parsed, K.SALES_CONTRACT, K.SALES_RULES, extra_keys="extra_keys", mistyped="mistyped")


def test_valid_request_passes_and_is_trimmed(spark):
    out = _requests(spark, [GOOD])
    valid, bad = K.route(out)
    assert bad.count() == 0
    assert valid.select(*K.clean(K.SALES_CONTRACT)).first().neighborhood == "N1"


def test_extra_field_and_date_rule_are_rejected(spark):
    extra = dict(GOOD, surprise=1)
    dates = dict(GOOD, last_ship_year=1990)
    rows = _requests(spark, [extra, dates]).collect()
    assert any("unknown field: surprise" in v for v in rows[0].violations)
    assert "last_ship_year lies ahead of first_ship_year" in rows[1].violations


def test_contract_names_and_metadata():
    assert {"neighborhood", "rooms", "sold_year"} <= set(K.SALES_CONTRACT.names)
    assert (K.SALES_CONTRACT["rooms"].metadata["low"], K.SALES_CONTRACT["rooms"].metadata["high"]) == (1, 10)


def test_request_types_are_judged_on_the_raw_values(spark):
    docs = [dict(GOOD, rooms=3.5), dict(GOOD, rooms="4"), dict(GOOD, living_area="abc"), dict(GOOD, zoning=7),
            dict(GOOD, grade=None), dict(GOOD, rooms=11)]
    got = [r.violations for r in _requests(spark, docs).collect()]
    assert got == [["rooms: not an integer"], [], ["living_area: not a number"], ["zoning: not a text"],
                   ["grade: required"], ["rooms: above 10"]]


def test_strict_json_nulls_non_finite(spark):
    df = spark.createDataFrame([(float("nan"), float("inf"), 1.5)], "a double, b double, c double")
    doc = json.loads(files.strict_json_lines(df).first().json)
    assert doc == {"a": None, "b": None, "c": 1.5}


def test_drift_signals(spark):
    ref = spark.createDataFrame([(float(v), "A", 7.0) for v in range(2500, 2520)], "area double, cat string, const double")
    cur = spark.createDataFrame([(2500 + i * 1500 / 19, "B" if i == 0 else "A", 7.0) for i in range(20)],
                                "area double, cat string, const double")
    psi = {r.feature: r.psi for r in drift.psi_columns(ref, cur, ["area", "const"]).collect()}
    assert psi["area"] > 0 and psi["const"] == 0.0
    novel = drift.categorical_section(ref, cur, ["cat"]).first().novel_category_rate
    assert novel == pytest.approx(1 / 20)


def test_psi_identical_is_zero_and_empty_is_null(spark):
    ref = spark.createDataFrame([(float(v),) for v in range(100)], "x double")
    assert drift.psi_columns(ref, ref, ["x"]).first().psi == pytest.approx(0.0, abs=1e-12)
    empty = ref.where("x < 0")
    assert drift.psi_columns(ref, empty, ["x"]).first().psi is None


def test_constant_model_scoring(spark):
    cal = spark.createDataFrame([(1.02, -0.1, 0.1, 50000.0, 500000.0)], list(P.CALIBRATION_COLUMNS))
    df = spark.createDataFrame([(math.log1p(200000.0),)], "log_prediction double")
    r = P.score(df, cal).first()
    assert r.interval_low < r.price < r.interval_high and r.price > 200000
    assert r.warnings[0].startswith("Priced at about")
    assert len(r.warnings) == 1


def test_clipping_warns(spark):
    cal = spark.createDataFrame([(1.0, -0.1, 0.1, 50000.0, 60000.0)], list(P.CALIBRATION_COLUMNS))
    r = P.score(spark.createDataFrame([(math.log1p(200000.0),)], "log_prediction double"), cal).first()
    assert r.price == 60000.0 and len(r.warnings) == 2


def test_cpi_factor():
    assert cpi_factor() == pytest.approx(CPI_REFERENCE / CPI_BASE)
    assert round(cpi_factor(), 6) == round(322.561 / 218.056, 6)
