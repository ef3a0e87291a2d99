"""Splits (D1-D6), encoders (E1, E5, E8), models (M1, M2) and persistence."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from valuora.operators import encoders as E
from valuora.operators import splits as D
from valuora.plans import models as MD


def _years(spark):
    return spark.createDataFrame([(i, 2006 + i // 3) for i in range(12)], "id int, year int")


def test_temporal_split_errors(spark):
    df = _years(spark)
    with pytest.raises(D.SplitError):
        D.temporal_split(df, "nope", 2009)
    with pytest.raises(D.SplitError):
        D.temporal_split(df, "year", 2012)
    with pytest.raises(D.SplitError):
        D.temporal_split(df, "year", 2008)  # 2009 rows are newer
    dev, hold = D.split_parts(D.temporal_split(df, "year", 2009))
    assert dev.count() == 9 and hold.count() == 3


def test_expanding_folds_never_leak(spark):
    tagged = D.expanding_folds(_years(spark), "year", [2007, 2008, 2009])
    bad = tagged.groupBy("validation_year").agg(
        F.max(F.when(F.col("role") == "train", F.col("year"))).alias("tmax"),
        F.min(F.when(F.col("role") == "validate", F.col("year"))).alias("vmin")).where("tmax >= vmin")
    assert bad.count() == 0
    with pytest.raises(D.SplitError):
        D.expanding_folds(_years(spark), "year", [2006])


def test_stratified_split_is_exact_deterministic_and_disjoint(sales):
    a = D.stratified_split(sales, "sale_id", "sale_price", 0.2, 42, hash_buckets=16)
    b = D.stratified_split(sales, "sale_id", "sale_price", 0.2, 42, hash_buckets=64)
    ra = {r.sale_id: r.split for r in a.collect()}
    rb = {r.sale_id: r.split for r in b.collect()}
    assert ra == rb  # bucket count changes the plan, never the result
    n = sales.count()
    n_hold = sum(1 for v in ra.values() if v == "holdout")
    assert len(ra) == n and abs(n_hold - 0.2 * n) <= 10


def test_hash_splits_nested_and_sized(sales):
    sub = D.nested_prefixes(sales, "sale_id", [0.3, 0.6], 42)
    small = {r.sale_id for r in sub.where("fraction = 0.3").collect()}
    big = {r.sale_id for r in sub.where("fraction = 0.6").collect()}
    assert small <= big
    folds = D.kfold(sales, "sale_id", 5, 42).groupBy("fold").count().collect()
    assert len(folds) == 5


def test_group_median_imputer_unseen_group(spark):
    train = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 10.0), ("b", None)], "g string, x double")
    model = E.GroupMedianImputer(inputCols=["x"], groupCol="g").fit(train)
    test = spark.createDataFrame([("b", None), ("Nowhere", None), ("a", 5.0)], "g string, x double")
    assert [r.x for r in model.transform(test).collect()] == [10.0, 3.0, 5.0]


def test_population_scaler_zero_variance(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, c double")
    r = E.PopulationScaler(inputCols=["a", "c"]).fit(df).transform(df).collect()
    assert [x.a for x in r] == [-1.0, 1.0] and [x.c for x in r] == [0.0, 0.0]


def test_target_encoder_cross_fit_differs_from_full_fit(sales):
    dev = sales.withColumn("label", F.log1p("sale_price"))
    enc = E.CrossFittedTargetEncoder(inputCols=["neighborhood"], labelCol="label", keyCol="sale_id")
    oof = enc.fit_transform(dev).select("sale_id", F.col("neighborhood").alias("oof"))
    full = enc.fit(dev).transform(dev).select("sale_id", F.col("neighborhood").alias("full"))
    j = oof.join(full, "sale_id")
    assert j.where(F.abs(F.col("oof") - F.col("full")) > 0).count() > 0
    assert j.where(F.col("oof").isNull()).count() == 0


def test_ridge_matches_closed_form(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 3))
    y = x @ np.array([1.0, -2.0, 0.5]) + rng.normal(scale=0.1, size=200) + 3.0
    xs = (x - x.mean(0)) / x.std(0)
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(xs, y)], "a double, b double, c double, label double")
    feats = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    alpha = 10.0
    m = MD.PenalisedLinear(kind="ridge", alpha=alpha).fit(feats)
    xc, yc = xs - xs.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + alpha * np.eye(3), xc.T @ yc)
    assert np.allclose(m.coefficients.toArray(), w, rtol=1e-6, atol=1e-8)


def test_median_baseline_and_persistence(spark, tmp_path):
    df = spark.createDataFrame([(float(i), float(i % 7)) for i in range(50)], "label double, x double")
    pipe = Pipeline(stages=[E.MedianImputer(inputCols=["x"], addIndicator=True), MD.MedianBaseline()])
    model = pipe.fit(df)
    path = str(tmp_path / "m")
    model.write().overwrite().save(path)
    again = PipelineModel.load(path)
    a = [r.prediction for r in model.transform(df).collect()]
    b = [r.prediction for r in again.transform(df).collect()]
    assert a == b and a[0] == 24.5


def test_encoded_width_is_the_fitted_levels_and_unseen_is_all_zeros(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 4.0), ("a", 8.0)], "g string, x double")
    model = MD.ProductionPreprocessor(numericCols=["x"], categoricalCols=["g"]).fit(df)
    new = model.transform(spark.createDataFrame([("zzz", 2.0), ("b", 2.0)], "g string, x double")).collect()
    assert [len(r.features) for r in new] == [4, 4]
    assert [sum(r.features.toArray()[1:]) for r in new] == [0.0, 1.0]


def test_pipeline_training_rows_are_target_encoded_out_of_fold(sales):
    dev = sales.withColumn("label", F.log1p("sale_price"))
    pre = MD.legacy_preprocessor("target", ["rooms"], ["neighborhood"], {}, "neighborhood", "sale_id", 42)
    model, encoded = MD.fit_on_training(pre, dev)
    levels = dev.select("neighborhood").distinct().count()
    reaching = encoded.select("neighborhood", F.round(F.col("__te_neighborhood"), 9).alias("e")).distinct().count()
    new_rows = model.transform(dev).select("neighborhood", F.round(F.col("__te_neighborhood"), 9).alias("e")).distinct().count()
    assert new_rows == levels < reaching


def test_changed_input_files_are_derived_anew(spark, sf_dir, tmp_path):
    import shutil

    import pyarrow.parquet as pq

    from valuora.sources.tables import SALES_INPUTS, sales_source

    for name in SALES_INPUTS:
        shutil.copyfile(f"{sf_dir}/{name}.parquet", tmp_path / f"{name}.parquet")
    first = sales_source(spark, str(tmp_path))
    again = sales_source(spark, str(tmp_path))
    assert first.inputFiles() == again.inputFiles()
    before = first.count()
    orders = pq.read_table(f"{sf_dir}/orders.parquet")
    pq.write_table(orders.slice(0, orders.num_rows // 2), tmp_path / "orders.parquet")
    assert 0 < sales_source(spark, str(tmp_path)).count() < before
