"""The whole drift report from one aggregate per side (R3-R8), batch or streaming (T5).

The reference is frozen once: the edges of every numeric feature and of the prediction from one
quantile call, then its counts.  After that each side is one aggregate over tagged cells

    section, feature, cell -> n, missing, present, total

where a cell is a bin number, a category or nothing, ``missing`` counts nulls and ``total`` sums
what the section needs (values outside a constant reference, values out of range, predictions,
errors).  Cells are additive, so the same aggregate runs on a stream per event-time window, and
its sink can be added up over any windows before the report is made from it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from valuora.functions.columns import is_close, lenient_double
from valuora.operators.drift import REPORT_COLUMNS, SHARE_FLOOR
from valuora.operators.quantiles import grouped_quantiles
from valuora.session import materialize

CELL_KEYS = ("section", "feature", "cell")


@dataclass(frozen=True)
class Frozen:
    """What current rows are held against.  ``edges`` has, by (section, feature), the unique
    edges; its size is features x bins.  ``cells`` are the reference's counts, as a written table."""

    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    bounds: Mapping[str, tuple[float, float]]
    actual: str | None
    predicted: str | None
    edges: Mapping[tuple[str, str], list[float]]
    cells: DataFrame


def freeze(reference: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (), bounds: Mapping[str, tuple[float, float]] | None = None,
           actual: str | None = None, predicted: str | None = None, bins: int = 10, method: str = "refine") -> Frozen:
    """Edges and counts of the reference; ``actual`` and ``predicted`` are None where the current rows lack them."""
    shift = predicted if predicted in reference.columns else None
    cut = [("numeric", f) for f in numeric] + ([("prediction_shift", shift)] if shift else [])
    edges: dict[tuple[str, str], list[float]] = {}
    if cut:
        names = [f"c{i}" for i in range(len(cut))]
        long = reference.select(*[lenient_double(F.col(f)).alias(n) for n, (_, f) in zip(names, cut)]).unpivot([], names, "name", "x")
        found = grouped_quantiles(long, ["name"], "x", [i / bins for i in range(bins + 1)], method).collect()
        edges = {cut[int(r["name"][1:])]: sorted(set(r["q"])) for r in found}
    plain = Frozen(tuple(numeric), tuple(categorical), dict(bounds or {}), actual, predicted, edges, reference)
    items = _binned(reference, plain) + _categories(plain)
    return Frozen(plain.numeric, plain.categorical, plain.bounds, actual, predicted, edges,
                  materialize(_count(reference, items), "drift-reference-cells"))


def _item(section: str, feature: str, cell: Column | None, missing: Column, total: Column | None) -> Column:
    return F.struct(F.lit(section).alias("section"), F.lit(feature).alias("feature"),
                    (F.lit(None) if cell is None else cell).cast("string").alias("cell"), missing.cast("int").alias("missing"),
                    (F.lit(None) if total is None else total).cast("double").alias("total"))


def _bin(x: Column, inner: Sequence[float]) -> Column:
    """The left-closed bin of ``x`` among inner edges."""
    return F.size(F.filter(F.array(*[F.lit(e) for e in inner]), lambda e: e <= x))


def _binned(df: DataFrame, frozen: Frozen) -> list[Column]:
    out = []
    for section, f in [("numeric", f) for f in frozen.numeric] + ([("prediction_shift", frozen.predicted)] if frozen.predicted in df.columns else []):
        x, edges = lenient_double(F.col(f)), frozen.edges.get((section, f), [])
        bin_ = F.lit(0)
        if len(edges) >= 3:
            bin_ = _bin(x, edges[1:-1])
        missing = x.isNull() if section == "prediction_shift" or isinstance(df.schema[f].dataType, NumericType) else F.col(f).isNull()
        outside = ~is_close(x, F.lit(edges[0])) if edges else F.lit(None)
        out.append(_item(section, f, F.when(x.isNotNull(), bin_), missing, outside))
        if section == "prediction_shift":
            out.append(_item("prediction_mean", f, None, missing, x))
    return out


def _categories(frozen: Frozen) -> list[Column]:
    return [_item("categorical", f, F.col(f), F.col(f).isNull(), None) for f in frozen.categorical]


def _ranges(frozen: Frozen) -> list[Column]:
    out = []
    for f, (low, high) in frozen.bounds.items():
        x = lenient_double(F.col(f))
        bad = F.coalesce((x < F.lit(float(low))) | (x > F.lit(float(high))), F.lit(False))
        out.append(_item("range_violations", f, None, F.lit(0), bad))
    return out


def _errors(frozen: Frozen) -> list[Column]:
    a, p = F.col(frozen.actual), F.col(frozen.predicted)
    return [_item("delayed_label_performance", name, None, e.isNull(), e)
            for name, e in (("log_rmse", F.pow(F.log1p(a) - F.log1p(p), 2)), ("dollar_mae", F.abs(a - p)))]


def _count(df: DataFrame, items: Sequence[Column], keys: Sequence[Column] = ()) -> DataFrame:
    names = [f"__key{i}" for i in range(len(keys))]
    long = df.select(*[k.alias(n) for k, n in zip(keys, names)], F.explode(F.array(*items)).alias("i")).select(*names, "i.*")
    return long.groupBy(*names, *CELL_KEYS).agg(F.count(F.lit(1)).alias("n"), F.sum("missing").alias("missing"),
                                                F.count("total").alias("present"), F.sum("total").alias("total"))


def current_cells(current: DataFrame, frozen: Frozen, window: Column | None = None) -> DataFrame:
    """The cells of current rows, by ``window`` (a ``F.window``, kept as ``window_start`` in epoch seconds) where one is given."""
    items = _binned(current, frozen) + _categories(frozen) + _ranges(frozen)
    items += _errors(frozen) if frozen.actual and frozen.predicted else []
    if window is None:
        return _count(current, items)
    counted = _count(current, items, [window])
    return counted.select(F.unix_seconds("__key0.start").alias("window_start"), *CELL_KEYS, "n", "missing", "present", "total")


def _lines(frozen: Frozen) -> list[tuple]:
    """One row per feature and section: reference values seen, their floored shares by bin, missing
    rate and mean (features x bins numbers)."""
    held = frozen.cells.where(F.col("section").isin("numeric", "prediction_shift", "prediction_mean")).collect()
    out: list[tuple] = []
    for section, f in [("numeric", f) for f in frozen.numeric] + sorted({(r["section"], r["feature"]) for r in held if r["section"] != "numeric"}):
        mine = [r for r in held if (r["section"], r["feature"]) == (section, f)]
        counts = {int(r["cell"]): r["n"] for r in mine if r["cell"] is not None}
        seen, rows, present = sum(counts.values()), sum(r["n"] for r in mine), sum(r["present"] for r in mine)
        bins = len(frozen.edges.get((section, f), [])) - 1
        shares = [max(counts.get(b, 0) / seen, SHARE_FLOOR) for b in range(bins)] if bins >= 2 else None
        total = sum(r["total"] for r in mine if r["total"] is not None)
        out.append((section, f, seen, shares, sum(r["missing"] for r in mine) / rows if rows else None, total / present if present else None))
    out += [("range_violations", f, 0, None, None, None) for f in frozen.bounds]
    if frozen.actual and frozen.predicted:
        out += [("delayed_label_performance", m, 0, None, None, None) for m in ("log_rmse", "dollar_mae")]
    return out


def _spine(windows: DataFrame, keys: list[str], lines: list[tuple]) -> DataFrame:
    """Every line of the report in every window."""
    types = ("string", "string", "long", "array<double>", "double", "double")
    names = ("section", "feature", "n_ref", "shares", "ref_missing", "ref_mean")
    lit = lambda v, t: (F.array(*[F.lit(x) for x in v]) if isinstance(v, list) else F.lit(v)).cast(t)
    structs = [F.struct(*[lit(v, t).alias(n) for v, t, n in zip(line, types, names)]) for line in lines]
    return windows.select(*keys, F.explode(F.array(*structs)).alias("l")).select(*keys, "l.*")


def report_from_cells(cells: DataFrame, frozen: Frozen) -> DataFrame:
    """The report ``section, feature, metric, value`` (by ``window_start``, where the cells have it).

    ``cells`` may hold a cell more than once (sinks of several runs or windows); they are added up.
    A category met in no reference row is novel; categories are joined by value after counting, so a
    hot one is a single row.
    """
    keys = [c for c in ("window_start",) if c in cells.columns]
    windows = cells.select(*keys).distinct() if keys else cells.sparkSession.range(1)
    spine = _spine(windows, keys, _lines(frozen))
    summed = cells.where("section <> 'categorical'").groupBy(*keys, *CELL_KEYS).agg(
        *[F.sum(c).alias(c) for c in ("n", "missing", "present", "total")])
    seen = F.col("cell").isNotNull()
    side = summed.groupBy(*keys, "section", "feature").agg(
        F.sum("n").alias("rows"), F.coalesce(F.sum(F.when(seen, F.col("n"))), F.lit(0)).alias("seen"), F.sum("missing").alias("missing"),
        F.sum("present").alias("present"), F.sum("total").alias("total"),
        F.map_from_entries(F.collect_list(F.when(seen, F.struct(F.col("cell").cast("int"), "n")))).alias("bins"))
    both = spine.join(side, [*keys, "section", "feature"], "left")

    def part(b):
        now = F.greatest(F.coalesce(F.try_element_at("bins", b), F.lit(0)) / F.col("seen"), F.lit(SHARE_FLOOR))
        was = F.element_at("shares", b + 1)
        return (now - was) * F.log(now / was)

    binned = F.aggregate(F.sequence(F.lit(0), F.size("shares") - 1), F.lit(0.0), lambda s, b: s + part(b))
    # a constant reference has no bins: the share of values elsewhere
    psi = F.when((F.col("n_ref") == 0) | (F.coalesce("seen", F.lit(0)) == 0), None).when(F.col("shares").isNull(), F.col("total") / F.col("seen")).otherwise(binned)
    rate = lambda c: F.col(c) / F.col("rows")
    mean = F.when(F.col("present") > 0, F.col("total") / F.col("present"))
    pair = lambda name, value: F.struct(F.lit(name).alias("metric"), value.cast("double").alias("value"))
    metrics = (
        F.when(F.col("section") == "numeric", F.array(pair("psi", psi), pair("reference_missing_rate", F.col("ref_missing")), pair("current_missing_rate", rate("missing"))))
        .when(F.col("section") == "prediction_shift", F.array(pair("psi", psi)))
        .when(F.col("section") == "prediction_mean", F.array(pair("reference_mean", F.col("ref_mean")), pair("current_mean", mean)))
        .when(F.col("section") == "range_violations", F.array(pair("violation_rate", rate("total"))))
        .when(F.col("feature") == "log_rmse", F.array(pair("log_rmse", F.sqrt(mean))))
        .otherwise(F.array(pair("dollar_mae", mean))))
    section = F.when(F.col("section") == "prediction_mean", "prediction_shift").otherwise(F.col("section")).alias("section")
    out = both.select(*keys, section, F.when(F.col("section") != "delayed_label_performance", F.col("feature")).alias("feature"),
                      F.explode(metrics).alias("m")).select(*keys, "section", "feature", "m.*")
    if frozen.categorical:
        out = out.unionByName(_novelty(cells, frozen, windows, keys))
    return out.select(*keys, *REPORT_COLUMNS)


def _novelty(cells: DataFrame, frozen: Frozen, windows: DataFrame, keys: list[str]) -> DataFrame:
    known = frozen.cells.where("section = 'categorical' AND cell IS NOT NULL").select("feature", "cell", F.lit(True).alias("known"))
    by_value = cells.where("section = 'categorical'").groupBy(*keys, "feature", "cell").agg(F.sum("n").alias("n"))
    flagged = by_value.join(known, ["feature", "cell"], "left")
    count = lambda when: F.coalesce(F.sum(F.when(when, F.col("n"))), F.lit(0))
    seen, novel = count(F.col("cell").isNotNull()), count(F.col("cell").isNotNull() & F.col("known").isNull())
    side = flagged.groupBy(*keys, "feature").agg(F.when(seen > 0, novel / seen).alias("novel"), (count(F.col("cell").isNull()) / F.sum("n")).alias("missing"))
    spine = windows.select(*keys, F.explode(F.array(*[F.lit(f) for f in frozen.categorical])).alias("feature"))
    rates = F.array(F.struct(F.lit("novel_category_rate").alias("metric"), F.coalesce("novel", F.lit(0.0)).alias("value")),
                    F.struct(F.lit("current_missing_rate").alias("metric"), F.col("missing").alias("value")))
    both = spine.join(side, [*keys, "feature"], "left").select(*keys, F.lit("categorical").alias("section"), "feature", F.explode(rates).alias("m"))
    return both.select(*keys, "section", "feature", "m.*")
