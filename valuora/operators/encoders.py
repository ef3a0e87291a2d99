"""Learned column transformers as ``pyspark.ml`` Estimators.

Every fit is one distributed aggregate whose result is a small fitted state
(one value per column, or per category of a bounded categorical column).  The
state is stored in a JSON ``Param`` so the models persist with
``DefaultParamsWritable`` inside a ``PipelineModel`` (S11), and every
transform is a pure column expression (literal maps, ``coalesce``,
arithmetic): no join, no shuffle, no Python UDF, identical in batch and
streaming.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from valuora.functions.columns import seeded_unit_hash
from valuora.operators.quantiles import grouped_quantiles


def _state(obj) -> str:
    return json.dumps(obj, sort_keys=True)


def _lit_map(mapping: dict) -> Column:
    if not mapping:
        return F.create_map().cast("map<string,double>")
    items = []
    for k, v in sorted(mapping.items()):
        items += [F.lit(k), F.lit(None if v is None else float(v)).cast("double")]
    return F.create_map(*items)


class _HasState(Params):
    state = Param(Params._dummy(), "state", "fitted state as JSON", typeConverter=TypeConverters.toString)

    def _get_state(self):
        if not self.isDefined(self.state):
            raise RuntimeError(f"{type(self).__name__} is not fitted")
        return json.loads(self.getOrDefault(self.state))


class _HasCols(Params):
    inputCols = Param(Params._dummy(), "inputCols", "input columns", typeConverter=TypeConverters.toListString)
    groupCol = Param(Params._dummy(), "groupCol", "group column", typeConverter=TypeConverters.toString)
    method = Param(Params._dummy(), "method", "quantile method", typeConverter=TypeConverters.toString)

    def cols(self) -> list[str]:
        return list(self.getOrDefault(self.inputCols))


# ---------------------------------------------------------------- E1
class GroupMedianImputerModel(Model, _HasCols, _HasState, DefaultParamsReadable, DefaultParamsWritable):
    """Fill nulls with the fitted median of the row's group; unseen group -> global median."""

    def __init__(self):
        super().__init__()

    def _transform(self, df: DataFrame) -> DataFrame:
        st = self._get_state()
        group = F.col(self.getOrDefault(self.groupCol)).cast("string")
        out = df
        for c in self.cols():
            med = _lit_map(st["groups"][c])
            out = out.withColumn(c, F.coalesce(F.col(c), F.element_at(med, group) if st["groups"][c] else F.lit(None),
                                               F.lit(st["global"][c])))
        return out


class GroupMedianImputer(Estimator, _HasCols, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, inputCols: Sequence[str] | None = None, groupCol: str | None = None, method: str = "refine"):
        super().__init__()
        self._setDefault(method="refine")
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> GroupMedianImputerModel:
        g, m = self.getOrDefault(self.groupCol), self.getOrDefault(self.method)
        groups, overall = {}, {}
        for c in self.cols():
            per = grouped_quantiles(df.select(F.col(g).cast("string").alias(g), c), [g], c, [0.5], m).collect()
            groups[c] = {r[g]: r["q"][0] for r in per if r[g] is not None}
            tot = grouped_quantiles(df, [], c, [0.5], m).collect()
            overall[c] = tot[0]["q"][0] if tot else None
        model = GroupMedianImputerModel()
        model._set(inputCols=self.cols(), groupCol=g, state=_state({"groups": groups, "global": overall}))
        return model


# ---------------------------------------------------------------- E2 + E3
class MedianImputerModel(Model, _HasCols, _HasState, DefaultParamsReadable, DefaultParamsWritable):
    """Median fill; optional 0/1 indicators for columns that had nulls at fit time."""

    def __init__(self):
        super().__init__()

    def _transform(self, df: DataFrame) -> DataFrame:
        st = self._get_state()
        fills = [F.coalesce(F.col(c), F.lit(st["median"][c])).alias(c) for c in self.cols()]
        flags = [F.col(c).isNull().cast("double").alias(f"missingindicator_{c}") for c in st["indicators"]]
        keep = [c for c in df.columns if c not in self.cols()]
        return df.select(*keep, *fills, *flags)


class MedianImputer(Estimator, _HasCols, DefaultParamsReadable, DefaultParamsWritable):
    addIndicator = Param(Params._dummy(), "addIndicator", "add missing indicators", typeConverter=TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, inputCols: Sequence[str] | None = None, addIndicator: bool = False, method: str = "refine"):
        super().__init__()
        self._setDefault(addIndicator=False, method="refine")
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> MedianImputerModel:
        cols = self.cols()
        long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], cols, "feature", "x")
        q = {r["feature"]: r["q"][0] for r in grouped_quantiles(long, ["feature"], "x", [0.5], self.getOrDefault(self.method)).collect()}
        nulls = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols]).first()
        ind = [c for c in cols if nulls[c]] if self.getOrDefault(self.addIndicator) else []
        model = MedianImputerModel()
        model._set(inputCols=cols, state=_state({"median": {c: q.get(c) for c in cols}, "indicators": ind}))
        return model


# ---------------------------------------------------------------- E4
class ModeImputerModel(Model, _HasCols, _HasState, DefaultParamsReadable, DefaultParamsWritable):
    def __init__(self):
        super().__init__()

    def _transform(self, df: DataFrame) -> DataFrame:
        st = self._get_state()
        out = df
        for c in self.cols():
            out = out.withColumn(c, F.coalesce(F.col(c), F.lit(st[c]).cast(df.schema[c].dataType)))
        return out


class ModeImputer(Estimator, _HasCols, DefaultParamsReadable, DefaultParamsWritable):
    """Most frequent value per column (smallest on ties)."""

    @keyword_only
    def __init__(self, inputCols: Sequence[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> ModeImputerModel:
        row = df.agg(*[F.mode(c, deterministic=True).alias(c) for c in self.cols()]).first()
        model = ModeImputerModel()
        model._set(inputCols=self.cols(), state=_state({c: row[c] for c in self.cols()}))
        return model


# ---------------------------------------------------------------- E5
class PopulationScalerModel(Model, _HasCols, _HasState, DefaultParamsReadable, DefaultParamsWritable):
    def __init__(self):
        super().__init__()

    def _transform(self, df: DataFrame) -> DataFrame:
        st = self._get_state()
        out = df
        for c in self.cols():
            mean, std = st[c]
            scale = std if std else 1.0
            out = out.withColumn(c, (F.col(c) - F.lit(mean)) / F.lit(scale))
        return out


class PopulationScaler(Estimator, _HasCols, DefaultParamsReadable, DefaultParamsWritable):
    """Standardise with the population standard deviation; zero variance -> divide by 1."""

    @keyword_only
    def __init__(self, inputCols: Sequence[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> PopulationScalerModel:
        aggs = []
        for c in self.cols():
            aggs += [F.avg(c).alias(f"{c}__m"), F.stddev_pop(c).alias(f"{c}__s")]
        row = df.agg(*aggs).first()
        model = PopulationScalerModel()
        model._set(inputCols=self.cols(), state=_state({c: [row[f"{c}__m"], row[f"{c}__s"]] for c in self.cols()}))
        return model


# ---------------------------------------------------------------- E6
class SkewedLog1pModel(Model, _HasCols, _HasState, DefaultParamsReadable, DefaultParamsWritable):
    def __init__(self):
        super().__init__()

    def selected(self) -> list[str]:
        return list(self._get_state()["columns"])

    def _transform(self, df: DataFrame) -> DataFrame:
        out = df
        for c in self.selected():
            out = out.withColumn(c, F.log1p(F.col(c)))
        return out


class SkewedLog1p(Estimator, _HasCols, DefaultParamsReadable, DefaultParamsWritable):
    """At fit: pick columns with |corrected skew| > threshold, min >= 0, > 2 distinct values."""

    threshold = Param(Params._dummy(), "threshold", "skew threshold", typeConverter=TypeConverters.toFloat)

    @keyword_only
    def __init__(self, inputCols: Sequence[str] | None = None, threshold: float = 0.75):
        super().__init__()
        self._setDefault(threshold=0.75)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> SkewedLog1pModel:
        aggs = []
        for c in self.cols():
            n = F.count(c).cast("double")
            aggs += [
                F.when(n >= 3, F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2)).alias(f"{c}__skew"),
                F.min(c).alias(f"{c}__min"),
                F.max(c).alias(f"{c}__max"),
            ]
        row = df.agg(*aggs).first()
        t = self.getOrDefault(self.threshold)
        chosen = [c for c in self.cols()
                  if row[f"{c}__skew"] is not None and abs(row[f"{c}__skew"]) > t
                  and row[f"{c}__min"] is not None and row[f"{c}__min"] >= 0]
        if chosen:  # more than two distinct values: one beside the ends; no distinct values are shuffled
            between = df.agg(*[F.max((F.col(c) != F.lit(row[f"{c}__min"])) & (F.col(c) != F.lit(row[f"{c}__max"]))).alias(c) for c in chosen]).first()
            chosen = [c for c in chosen if between[c]]
        model = SkewedLog1pModel()
        model._set(inputCols=self.cols(), state=_state({"columns": chosen}))
        return model


# ---------------------------------------------------------------- E7 (SQL/array form)
class OneHotModel(Model, _HasCols, _HasState, DefaultParamsReadable, DefaultParamsWritable):
    """One 0/1 column per fitted level (alphabetical); unseen or null -> all zeros."""

    def __init__(self):
        super().__init__()

    def output_names(self) -> list[str]:
        st = self._get_state()
        return [f"{c}_{lvl}" for c in self.cols() for lvl in st[c]]

    def _transform(self, df: DataFrame) -> DataFrame:
        st = self._get_state()
        cols = []
        for c in self.cols():
            for lvl in st[c]:
                cols.append(F.coalesce(F.col(c).cast("string") == F.lit(lvl), F.lit(False)).cast("double").alias(f"{c}_{lvl}"))
        return df.select(*[x for x in df.columns if x not in self.cols()], *cols)


class OneHot(Estimator, _HasCols, DefaultParamsReadable, DefaultParamsWritable):
    """Levels are the distinct non-null values seen at fit, sorted.

    Meant for bounded categories; for vectors use ``StringIndexer(keep) +
    OneHotEncoder(dropLast=True)``, which has the same unknown -> zeros rule.
    """

    @keyword_only
    def __init__(self, inputCols: Sequence[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> OneHotModel:
        row = df.agg(*[F.array_sort(F.collect_set(F.col(c).cast("string"))).alias(c) for c in self.cols()]).first()
        model = OneHotModel()
        model._set(inputCols=self.cols(), state=_state({c: list(row[c]) for c in self.cols()}))
        return model


# ---------------------------------------------------------------- E8
def _shrunk(n: Column, s: Column, ss: Column, gmean: Column, gvar: Column) -> Column:
    """Empirical-Bayes blend ``lam*mean_c + (1-lam)*mean`` with
    ``lam = n*tau2 / (n*tau2 + var_c)`` (population variances)."""
    mean_c = s / n
    var_c = F.greatest(ss / n - mean_c * mean_c, F.lit(0.0))
    lam = F.when(n * gvar + var_c > 0, (n * gvar) / (n * gvar + var_c)).otherwise(F.lit(1.0))
    return F.when(n > 0, lam * mean_c + (F.lit(1.0) - lam) * gmean).otherwise(gmean)


class TargetEncoderModel(Model, _HasCols, _HasState, DefaultParamsReadable, DefaultParamsWritable):
    """Full-fit encoding for new rows; unseen category -> global mean."""

    labelCol = Param(Params._dummy(), "labelCol", "label", typeConverter=TypeConverters.toString)

    def __init__(self):
        super().__init__()

    def _transform(self, df: DataFrame) -> DataFrame:
        st = self._get_state()
        out = df
        for c in self.cols():
            enc = _lit_map(st["encoding"][c])
            out = out.withColumn(c, F.coalesce(F.element_at(enc, F.col(c).cast("string")), F.lit(st["mean"])))
        return out


class CrossFittedTargetEncoder(Estimator, _HasCols, DefaultParamsReadable, DefaultParamsWritable):
    """Continuous-target encoder with shrinkage; training rows are encoded
    out-of-fold by :meth:`fit_transform` (cross-fitting), other rows by the
    full fit (:meth:`fit` then ``transform``)."""

    labelCol = Param(Params._dummy(), "labelCol", "label", typeConverter=TypeConverters.toString)
    keyCol = Param(Params._dummy(), "keyCol", "row key for fold hashing", typeConverter=TypeConverters.toString)
    folds = Param(Params._dummy(), "folds", "number of folds", typeConverter=TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "fold seed", typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, inputCols=None, labelCol="label", keyCol=None, folds=5, seed=42):
        super().__init__()
        self._setDefault(labelCol="label", folds=5, seed=42)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> TargetEncoderModel:
        y = F.col(self.getOrDefault(self.labelCol)).cast("double")
        g = df.agg(F.avg(y).alias("m"), F.var_pop(y).alias("v")).first()
        enc = {}
        for c in self.cols():
            stats = df.groupBy(F.col(c).cast("string").alias("cat")).agg(
                F.count(y).cast("double").alias("n"), F.sum(y).alias("s"), F.sum(y * y).alias("ss"))
            rows = stats.select("cat", _shrunk(F.col("n"), F.col("s"), F.col("ss"), F.lit(g["m"]), F.lit(g["v"])).alias("e")).collect()
            enc[c] = {r["cat"]: r["e"] for r in rows if r["cat"] is not None}
        model = TargetEncoderModel()
        model._set(inputCols=self.cols(), labelCol=self.getOrDefault(self.labelCol),
                   state=_state({"encoding": enc, "mean": g["m"]}))
        return model

    def fit_transform(self, df: DataFrame) -> DataFrame:
        """Out-of-fold encoding of the training rows themselves.

        Per (category, fold) moments are aggregated once; the statistics of
        "all other folds" are category totals minus the own fold, and the
        same subtraction gives the other folds' global mean and variance.
        """
        y = F.col(self.getOrDefault(self.labelCol)).cast("double")
        k, seed = self.getOrDefault(self.folds), self.getOrDefault(self.seed)
        key = self.getOrDefault(self.keyCol)
        tagged = df.withColumn("__fold", (seeded_unit_hash(key, seed) % k).cast("int"))
        gf = tagged.groupBy("__fold").agg(F.count(y).cast("double").alias("gn"), F.sum(y).alias("gs"), F.sum(y * y).alias("gss"))
        gt = gf.agg(F.sum("gn").alias("tn"), F.sum("gs").alias("ts"), F.sum("gss").alias("tss"))
        gl = gf.crossJoin(gt).select(
            "__fold", (F.col("tn") - F.col("gn")).alias("on"), (F.col("ts") - F.col("gs")).alias("os"),
            (F.col("tss") - F.col("gss")).alias("oss"))
        gl = gl.select("__fold", (F.col("os") / F.col("on")).alias("__gm"),
                       (F.col("oss") / F.col("on") - (F.col("os") / F.col("on")) ** 2).alias("__gv"))
        out = tagged.join(F.broadcast(gl), "__fold")
        for c in self.cols():
            cat = F.col(c).cast("string")
            per = tagged.groupBy(cat.alias("__cat"), "__fold").agg(
                F.count(y).cast("double").alias("n"), F.sum(y).alias("s"), F.sum(y * y).alias("ss"))
            tot = per.groupBy("__cat").agg(F.sum("n").alias("tn"), F.sum("s").alias("ts"), F.sum("ss").alias("tss"))
            oof = per.join(tot, "__cat").select(
                "__cat", "__fold", (F.col("tn") - F.col("n")).alias("__n"), (F.col("ts") - F.col("s")).alias("__s"),
                (F.col("tss") - F.col("ss")).alias("__ss"))
            out = out.join(oof, (out[c].cast("string") == oof["__cat"]) & (out["__fold"] == oof["__fold"]), "left") \
                .drop(oof["__fold"]).drop("__cat")
            out = out.withColumn(c, _shrunk(F.coalesce(F.col("__n"), F.lit(0.0)), F.col("__s"), F.col("__ss"),
                                            F.col("__gm"), F.col("__gv"))).drop("__n", "__s", "__ss")
        return out.drop("__fold", "__gm", "__gv")
