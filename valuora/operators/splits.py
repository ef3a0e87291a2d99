"""Row partitioning: temporal split, expanding folds, hashed random splits.

Randomness is a seeded md5 hash of the row key, so every split is
deterministic, independent of partitioning and task retries, and computable
in SQL.  No split ever needs a global sort or a global window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from valuora.functions.columns import seeded_unit_hash
from valuora.operators.quantiles import grouped_quantiles


class SplitError(ValueError):
    """A split could not be built as requested."""


def temporal_split(df: DataFrame, year: str, holdout_year: int, split_col: str = "split") -> DataFrame:
    """``development`` = year < H, ``holdout`` = year == H.

    One aggregate checks all four error conditions before any row moves.
    Returns the input with ``split_col`` (use :func:`split_parts` to separate).
    """
    if year not in df.columns:
        raise SplitError(f"there is no column {year!r} to split by")
    y = F.col(year).cast("int")
    stats = df.agg(
        F.sum((y == holdout_year).cast("long")).alias("n_holdout"),
        F.sum((y < holdout_year).cast("long")).alias("n_dev"),
        F.array_sort(F.collect_set(F.when(y > holdout_year, y))).alias("future"),
    ).first()
    if not stats["n_holdout"]:
        raise SplitError(f"the input has nothing from {holdout_year}, the year to hold out")
    if stats["future"]:
        raise SplitError(f"the input reaches past {holdout_year}: {stats['future']}")
    if not stats["n_dev"]:
        raise SplitError(f"the input has nothing before {holdout_year} to train on")
    return df.withColumn(split_col, F.when(y < holdout_year, "development").otherwise("holdout"))


def split_parts(df: DataFrame, split_col: str = "split") -> tuple[DataFrame, DataFrame]:
    return (
        df.where(F.col(split_col) == "development").drop(split_col),
        df.where(F.col(split_col) == "holdout").drop(split_col),
    )


def expanding_folds(df: DataFrame, year: str, validation_years: Sequence[int], check: bool = True) -> DataFrame:
    """Rows tagged ``(validation_year, role)`` for every expanding fold.

    Train = year < v, validate = year == v.  The fold table is tiny (one row
    per validation year, bounded by the parameter) and broadcast; each input
    row appears once per fold it belongs to.  With ``check`` one aggregate
    verifies that no fold is empty.
    """
    spark = df.sparkSession
    years = spark.createDataFrame([(int(v),) for v in validation_years], "validation_year int")
    y = F.col(year).cast("int")
    tagged = df.join(F.broadcast(years), y <= F.col("validation_year"), "inner").withColumn(
        "role", F.when(y == F.col("validation_year"), "validate").otherwise("train")
    )
    if check:
        counts = {
            (r["validation_year"], r["role"]): r["n"]
            for r in tagged.groupBy("validation_year", "role").agg(F.count(F.lit(1)).alias("n")).collect()
        }
        for v in validation_years:
            if not counts.get((v, "train")) or not counts.get((v, "validate")):
                raise SplitError(f"{v}: a fold needs rows of that year and of earlier ones")
    return tagged


def fold_frames(df: DataFrame, year: str, validation_year: int) -> tuple[DataFrame, DataFrame]:
    """One expanding fold as two filters (used by fitting loops)."""
    y = F.col(year).cast("int")
    return df.where(y < validation_year), df.where(y == validation_year)


def kfold(df: DataFrame, key: str, k: int, seed: int, fold_col: str = "fold") -> DataFrame:
    """Shuffled k-fold assignment ``hash(seed:key) % k``."""
    return df.withColumn(fold_col, (seeded_unit_hash(key, seed) % k).cast("int"))


def hash_fraction_split(df: DataFrame, key: str, fraction: float, seed: int, col: str = "is_test") -> DataFrame:
    """Test share ``fraction`` by hash threshold (no sort, no window)."""
    threshold = int(round(fraction * 2**32))
    return df.withColumn(col, seeded_unit_hash(key, seed) < F.lit(threshold))


def nested_prefixes(df: DataFrame, key: str, fractions: Sequence[float], seed: int) -> DataFrame:
    """Training subsets for learning curves, nested by construction.

    A row belongs to fraction f when its hash is below f * 2^32, so every
    smaller subset is contained in every larger one.  Returns rows tagged with
    each fraction they belong to.
    """
    spark = df.sparkSession
    fr = spark.createDataFrame([(float(f),) for f in fractions], "fraction double")
    h = seeded_unit_hash(key, seed).cast("double")
    return df.join(F.broadcast(fr), h < F.col("fraction") * F.lit(float(2**32)), "inner")


def stratified_split(
    df: DataFrame,
    key: str,
    target: str,
    test_size: float,
    seed: int,
    bins: int = 10,
    col: str = "split",
    quantile_method: str = "refine",
    hash_buckets: int | None = None,
) -> DataFrame:
    """D3: per target-quantile bin, exactly ``round(test_size * n_bin)`` rows go
    to ``holdout``: the rows with the smallest ``(hash, key)`` in the bin.

    Bins: quantile edges of ``target`` (duplicates dropped), right-closed, the
    first bin includes the minimum.  The rank inside a bin is computed without
    a window over the bin: rows are first grouped into ``hash_buckets`` ranges
    of the hash, a running count over the (bin, bucket) histogram finds the
    bucket where the holdout quota runs out, and only the rows of that one
    bucket per bin are ranked exactly.
    """
    probs = [i / bins for i in range(bins + 1)]
    edges = grouped_quantiles(df, [], target, probs, quantile_method).first()["q"]
    uniq = sorted(set(edges))
    inner = uniq[1:-1]
    spark = df.sparkSession
    x = F.col(target).cast("double")
    bin_id = F.size(F.filter(F.array(*[F.lit(float(e)) for e in inner]), lambda e: x > e)) if inner else F.lit(0)
    if hash_buckets is None:
        # ~100k rows per bucket: the one straddling bucket per bin stays small.
        hash_buckets = int(min(2**20, max(64, df.count() // 100_000)))
    h = seeded_unit_hash(key, seed)
    width = 2**32 // hash_buckets
    tagged = df.select("*", bin_id.alias("__bin"), h.alias("__h")).withColumn(
        "__bucket", (F.col("__h") / F.lit(width)).cast("long")
    )
    hist = tagged.groupBy("__bin", "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    w_bin = Window.partitionBy("__bin")
    w_run = w_bin.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, 0)
    quota = F.floor(F.lit(float(test_size)) * F.sum("__n").over(w_bin) + F.lit(0.5))
    plan = hist.select(
        "__bin", "__bucket", "__n", quota.alias("__quota"),
        (F.sum("__n").over(w_run) - F.col("__n")).alias("__before"),
    )
    if bins * hash_buckets <= 65_536:
        # bins x buckets rows, bounded by the parameters: collect and broadcast
        plan_df = F.broadcast(spark.createDataFrame(
            plan.collect(), "__bin int, __bucket long, __n long, __quota long, __before long"))
    else:
        plan_df = plan  # larger plans stay distributed (shuffle join, AQE decides)
    joined = tagged.join(plan_df, ["__bin", "__bucket"])
    crossing = (F.col("__before") < F.col("__quota")) & (F.col("__before") + F.col("__n") > F.col("__quota"))
    # Whole buckets on either side of the quota line need no ranking.
    whole = joined.where(~crossing).withColumn(
        col, F.when(F.col("__before") + F.col("__n") <= F.col("__quota"), "holdout").otherwise("train")
    )
    # At most one bucket per bin straddles the line; only its rows are ranked.
    w_edge = Window.partitionBy("__bin", "__bucket").orderBy("__h", key)
    edge = joined.where(crossing).withColumn(
        col,
        F.when(F.col("__before") + F.row_number().over(w_edge) <= F.col("__quota"), "holdout").otherwise("train"),
    )
    drop = ["__bin", "__h", "__bucket", "__n", "__quota", "__before"]
    return whole.drop(*drop).unionByName(edge.drop(*drop))
