"""F1-F10, P7-P12 on hand-computed rows."""

import pytest
from pyspark.sql import functions as F

from valuora.functions.columns import QUALITY_SCALE
from valuora.operators import validate as V

COLS = "last_ship_year int, sold_year int, first_ship_year int, living_area double, basement_area double, " \
       "rooms long, grade_level int, frontage double, acctbal double"


def _engineer(spark, rows):
    return V.engineer_sales(spark.createDataFrame(rows, COLS)).first()


def test_engineered_row_by_hand(spark):
    r = _engineer(spark, [(2003, 1998, 1991, 1230.0, 410.0, 5, 6, 0.03, -42.5)])
    assert r.ship_lag == 5 and r.order_lag == 7
    assert r.total_area == 1640.0
    assert r.weighted_count == 5 + 0.5 * 410
    assert r.grade_by_area == 6 * 1230.0
    assert r.area_sum == pytest.approx(1230 + 410 + 0.03)
    assert (r.has_returns, r.has_discount, r.has_credit) == (1, 1, 0)


def test_negative_age_is_clipped_and_nulls_follow_policy(spark):
    r = _engineer(spark, [(1999, 2000, 2009, 1500.0, None, None, 7, None, None)])
    assert r.ship_lag == 0 and r.order_lag == 0
    assert r.total_area == 1500.0          # null basement counts as 0
    assert r.area_sum is None              # plain sum propagates null
    assert r.has_returns == 0 and r.has_discount == 0 and r.has_credit == 0


def test_age_of_null_input_stays_null(spark):
    r = _engineer(spark, [(None, 2000, 1990, 1.0, 1.0, 1, 1, 0.0, 1.0)])
    assert r.ship_lag is None


def test_missing_inputs_raise(spark):
    df = spark.createDataFrame([(1,)], "sold_year int")
    with pytest.raises(V.SchemaError):
        V.engineer_sales(df)


def test_ordinal_scale_unknown_and_null(spark):
    df = spark.createDataFrame([(v,) for v in [*QUALITY_SCALE, "??", None]], "q string")
    out = [r.q for r in V.map_ordinals(df, ["q"], QUALITY_SCALE).collect()]
    assert out == [0, 1, 2, 3, 4, 5, -1, -1]


def test_outlier_filter_keeps_nulls(spark):
    df = spark.createDataFrame([(1, 1500.0, 200000.0), (2, 4500.0, 150000.0), (3, 4600.0, 500000.0), (4, None, 1.0)],
                               "id int, area double, price double")
    kept = sorted(r.id for r in V.drop_outliers(df, "area", "price", 4000, 300000).collect())
    assert kept == [1, 3, 4]
    assert [r.id for r in V.outlier_rows(df, "area", "price", 4000, 300000, ["id"]).collect()] == [2]


def test_codes_cast_and_tolerant_drop_and_zero_fill(spark):
    df = spark.createDataFrame([(20.0, 1, "x")], "code double, a int, b string")
    out = V.codes_to_string(df, ["code", "absent"]).first()
    assert out.code == "20"
    assert V.drop_columns(df, ["zzz", "b"]).columns == ["code", "a"]
    sub = V.subset_zero_fill(df, ["a", "ghost"]).first()
    assert sub.a == 1 and sub.ghost == 0


def test_informative_and_missing_fills(spark):
    df = spark.createDataFrame([(None, None, None)], "pool string, garage_year double, other string")
    out = V.fill_missing_categories(V.fill_informative(df, ["pool", "garage_year"], zeros=["garage_year"])).first()
    assert (out.pool, out.garage_year, out.other) == ("None", 0.0, "Missing")


def test_skew_rule_shuffles_no_distinct_values(spark, monkeypatch):
    """Columns of two values, with negative ones or all null are left alone; no distinct count is taken for that."""
    from valuora.operators import encoders as E

    rows = [(float(2 ** (i % 12)), float(i % 20 == 0), float(2 ** (i % 12)) - 5, None, None if i % 3 else float(i**4)) for i in range(120)]
    df = spark.createDataFrame(rows, "a double, two double, negative double, none double, nulls double")

    def refused(*_):
        raise AssertionError("distinct values counted")

    monkeypatch.setattr(E.F, "count_distinct", refused)
    assert E.SkewedLog1p(inputCols=df.columns).fit(df).selected() == ["a", "nulls"]
