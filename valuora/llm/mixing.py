"""Mixing sources to target weights by subset-sum budget fitting.

Each source gets a share of a word budget.  Whole passes over a source cover
the target's integer part; what remains is a budget smaller than the source,
which is met by choosing how many documents of each exact length to take:
a proportional share of every length first, then a bounded-knapsack dynamic
program over the words that are left; sources of few, very long documents are
chosen again by their reachable sums.  Which documents of a length are taken is
decided by a seeded hash.

Only the (source, length) histogram is ever grouped by source; documents
themselves are ranked inside small seeded buckets, so neither a hot source nor a
hot length ends up in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from valuora.llm.common import addressed, materialize, repeated, shipped, with_row_ids

WORDS = r"[^\x20\x09-\x0D]+"


def word_count(column):
    return F.coalesce(F.regexp_count(column, F.lit(WORDS)), F.lit(0)).cast("long")


def ordered_ranks(sources: DataFrame) -> DataFrame:
    """``sources`` with ``_rank``: 0-based position by source in code-point order, null last.

    Range partitions are ranked one by one and shifted by the sizes of those
    before them; the only thing collected is one count per partition.
    """
    keys = F.struct(F.col("source").isNull().alias("last"), F.col("source"))
    parts = materialize(
        sources.withColumn("_key", keys).repartitionByRange("_key").withColumn("_part", F.spark_partition_id()),
        "mix-sources")
    sizes = sorted((r["_part"], r["count"]) for r in parts.groupBy("_part").count().collect())
    before, total = {}, 0
    for part, size in sizes:
        before[part], total = total, total + size
    spark = sources.sparkSession
    shift = spark.createDataFrame(list(before.items()) or [(0, 0)], "_part int, _before long")
    from pyspark.sql import Window

    inside = F.row_number().over(Window.partitionBy("_part").orderBy("_key")) - 1
    return (
        parts.withColumn("_inside", inside).join(F.broadcast(shift), "_part")
        .withColumn("_rank", F.col("_before") + F.col("_inside")).drop("_part", "_key", "_inside", "_before")
    )


def water_fill(sources: DataFrame, weights: Sequence[float], total_share: float = 1.0, repeat: float = 3.0) -> DataFrame:
    """``target`` per source: weights cycle over the sources in order; a target
    stops at ``repeat`` times its source's size and the excess is shared again by
    weight among the others, until none is above.

    ``sources`` has source and source_size.  Rounds run as aggregates; the driver
    sees two numbers a round.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    ranked = materialize(ordered_ranks(sources).withColumn("_weight", weight), "mix-ranked")
    cap = F.col("source_size") * float(repeat)
    budget = float(ranked.agg(F.sum("source_size")).first()[0] or 0) * total_share
    level = 0.0
    while True:
        held = F.col("_weight") * level >= cap
        row = ranked.agg(
            F.sum(F.when(held, cap).otherwise(0.0)), F.sum(F.when(~held, F.col("_weight")).otherwise(0.0))
        ).first()
        capped, open_weight = float(row[0] or 0.0), float(row[1] or 0.0)
        if not open_weight:
            break
        raised = (budget - capped) / open_weight
        if raised <= level * (1 + 1e-12):
            break
        level = raised
    return ranked.select("source", "source_size", F.least(F.col("_weight") * level, cap).alias("target"))


def knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many of each length to take so that the sum comes as near to ``budget``
    as it can, from below in a tie (bounded subset sum).

    Counts are split into binary lots; the reachable sums up to twice the budget
    (beyond it, taking nothing is nearer) are one big-integer bit set, and the lot
    that first reached each sum is kept for the way back.
    """
    taken = np.zeros(len(lengths), dtype=np.int64)
    top = 2 * budget
    mask = (1 << (top + 1)) - 1
    reach, first, lots = 1, np.full(top + 1, -1, dtype=np.int64), []
    for i, (length, count) in enumerate(zip(lengths.tolist(), counts.tolist())):
        if length <= 0 or length > top:
            continue
        count, lot = min(count, top // length), 1
        while count > 0:
            lot = min(lot, count)
            fresh = (reach << (lot * length)) & mask & ~reach
            if fresh:
                bits = np.frombuffer(fresh.to_bytes(top // 8 + 1, "little"), dtype=np.uint8)
                first[np.flatnonzero(np.unpackbits(bits, bitorder="little")[: top + 1])] = len(lots)
                lots.append((i, lot))
                reach |= fresh
            count, lot = count - lot, lot * 2
        if reach >> budget & 1:
            break
    below = (reach & ((1 << (budget + 1)) - 1)).bit_length() - 1
    above = reach >> (budget + 1)
    over = budget + (above & -above).bit_length() if above else top + 1
    at = below if budget - below <= over - budget else over
    while at > 0:
        i, lot = lots[first[at]]
        taken[i] += lot
        at -= lot * int(lengths[i])
    return taken


def reachable(lengths: np.ndarray, counts: np.ndarray, top: int, most: int):
    """Sums up to ``top`` as a sorted array, the lot that first reached each, the lots, and
    whether all are there: no lot is added that makes more than ``most`` sums."""
    sums, first, lots = np.zeros(1, dtype=np.int64), np.full(1, -1, dtype=np.int32), []
    for i, (length, count) in enumerate(zip(lengths.tolist(), counts.tolist())):
        if length <= 0 or length > top:
            continue
        count, lot = min(count, top // length), 1
        while count > 0:
            lot = min(lot, count)
            more = sums + lot * length
            more = more[: np.searchsorted(more, top, side="right")]
            fresh = more[sums[np.minimum(np.searchsorted(sums, more), len(sums) - 1)] != more]
            if len(sums) + len(fresh) > most:
                return sums, first, lots, False
            if len(fresh):
                merged = np.concatenate([sums, fresh])
                order = np.argsort(merged, kind="stable")
                first = np.concatenate([first, np.full(len(fresh), len(lots), dtype=np.int32)])[order]
                sums = merged[order]
                lots.append((i, lot))
            count, lot = count - lot, lot * 2
    return sums, first, lots, True


def sparse_knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int, most: int) -> tuple[np.ndarray, bool]:
    """``knapsack`` for budgets too wide for a bit set: the lengths in two halves, the sums
    each reaches, and the nearest pair.  Also says whether both halves are whole."""
    taken, top = np.zeros(len(lengths), dtype=np.int64), 2 * budget
    held = np.flatnonzero(counts)
    halves = [held[::2], held[1::2]]
    sides = [reachable(lengths[h], counts[h], top, most) for h in halves]
    one, two = sides[0][0], sides[1][0]
    after = np.searchsorted(two, budget - one)
    below, above = two[np.maximum(after - 1, 0)], two[np.minimum(after, len(two) - 1)]
    other = np.where(np.abs(budget - one - above) < np.abs(budget - one - below), above, below)
    at = int(np.argmin(np.abs(budget - one - other)))
    for half, (sums, first, lots, _), rest in zip(halves, sides, (int(one[at]), int(other[at]))):
        while rest > 0:
            i, lot = lots[first[np.searchsorted(sums, rest)]]
            taken[half[i]] += lot
            rest -= lot * int(lengths[half[i]])
    return taken, sides[0][3] and sides[1][3]


def some_of(counts: np.ndarray, most: int) -> np.ndarray:
    """About ``most`` of the counted documents, spread over the lengths; all of them if no more are there."""
    if counts.sum() <= most:
        return counts.copy()
    held, out = np.flatnonzero(counts), np.zeros_like(counts)
    if len(held) > most:
        out[held[np.linspace(0, len(held) - 1, most).astype(int)]] = 1
    else:
        out[held] = np.minimum(counts[held], -(-most // len(held)))
    return out


def refit(lengths: np.ndarray, counts: np.ndarray, taken: np.ndarray, budget: int, most: int = 1 << 20) -> np.ndarray:
    """``taken`` brought nearer to ``budget`` by giving some documents back and choosing
    again among them and the open ones: a few at first, then four times as many, until the
    sum is as near as their common divisor allows, every document took part (no subset is
    nearer; always so up to 40 documents of different lengths), or half of those taking
    part reach more than ``most`` sums.
    """
    best, free = taken, 5
    worded = np.where(lengths > 0, counts, 0)
    step = int(np.gcd.reduce(lengths[worded > 0]))  # every sum is a multiple
    least = min(budget % step, -budget % step)
    held = np.minimum(taken, worded)
    while True:
        back, more = some_of(held, free), some_of(worded - held, free)
        want, whole = budget - int(((taken - back) * lengths).sum()), True
        if want > 0:
            chosen, whole = sparse_knapsack(lengths, back + more, want, most)
            trial = taken - back + chosen
            best = min(best, trial, key=lambda t: abs(budget - int((t * lengths).sum())))
        if abs(budget - int((best * lengths).sum())) == least or not whole or (back + more == worded).all():
            return best
        free *= 4


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int, window: int = 16384) -> np.ndarray:
    """Documents of each length to take for ``budget`` words (0 <= budget <= all words).

    Every length gives its proportional share, rounded down; longest lengths then
    give one batch more while more than ``window`` words are missing; the dynamic
    program spends the last words.  What that cannot meet, as documents are too long
    for the window, is chosen again with documents of the share given back.
    """
    size = int((lengths * counts).sum())
    if budget <= 0 or size <= 0:
        return np.zeros(len(lengths), dtype=np.int64)
    if budget >= size:
        return counts.copy()
    taken = np.array([c * budget // size for c in counts.tolist()], dtype=np.int64) if size > window else np.zeros(len(lengths), dtype=np.int64)
    left = budget - int((taken * lengths).sum())
    for i in np.argsort(-lengths, kind="stable"):
        if left <= window:
            break
        more = min(int(counts[i] - taken[i]), (left - window // 2) // int(lengths[i])) if lengths[i] else 0
        if more > 0:
            taken[i] += more
            left -= more * int(lengths[i])
    if left <= max(window, 1):
        taken = taken + knapsack(lengths, counts - taken, left)
    if size > window and int((taken * lengths).sum()) != budget:
        taken = refit(lengths, counts, taken, budget)
    return taken


def decide(rows: DataFrame, weights: Sequence[float] = (5, 2, 1), repeat: float = 3.0, seed: int = 7,
           bucket_rows: int = 128, window: int = 16384) -> DataFrame:
    """``rows`` (``_row``, doc_id, source, size, _tie) with source_size, target and copies.

    ``copies`` is how often the mix takes the row (0 to ``repeat`` rounded down).  Null
    sources form one source; documents of size 0 follow the whole passes only.  The
    seeded rank of a row depends on doc_id and ``_tie`` (a hash of its text) alone.
    """
    hist = materialize(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-histogram")
    sources = hist.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = materialize(water_fill(sources, weights, repeat=repeat), "mix-targets")
    plan = hist.join(targets, hist["source"].eqNullSafe(targets["source"])).select(
        hist["source"], "size", "n", "source_size", "target")
    schema = T.StructType(
        [
            T.StructField("_source", T.StringType()), T.StructField("_size", T.LongType()), T.StructField("n", T.LongType()),
            T.StructField("source_size", T.LongType()), T.StructField("target", T.DoubleType()),
            T.StructField("passes", T.LongType()), T.StructField("extra", T.LongType()),
        ]
    )

    def choose(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("size", kind="stable")
        size, target = int(part["source_size"].iloc[0]), float(part["target"].iloc[0])
        want = round(target)
        passes = min(want // size if size else 0, int(repeat))
        extra = fit_budget(part["size"].to_numpy(), part["n"].to_numpy(), want - passes * size, window)
        return pd.DataFrame(
            {"_source": part["source"], "_size": part["size"], "n": part["n"], "source_size": size, "target": target,
             "passes": passes, "extra": extra})

    chosen = materialize(shipped(plan).groupBy("source").applyInPandas(choose, schema), "mix-plan")
    unit = (F.xxhash64(F.lit(seed), "doc_id", "_tie").bitwiseAND(F.lit((1 << 53) - 1))).cast("double") / float(1 << 53)
    buckets = F.ceil(F.col("n") / F.lit(bucket_rows))
    joined = rows.join(
        chosen, rows["source"].eqNullSafe(chosen["_source"]) & (rows["size"] == chosen["_size"])
    ).drop("_source", "_size")
    placed = materialize(joined.withColumn("_u", unit).withColumn("_bucket", F.floor(F.col("_u") * buckets)).drop("_tie"), "mix-placed")
    whole = F.col("extra").isin(0) | (F.col("extra") == F.col("n"))
    open_rows = placed.where(~whole)
    from pyspark.sql import Window

    counts = open_rows.groupBy("source", "size", "_bucket").agg(F.count("*").alias("_in"))
    before = counts.withColumn(
        "_before", F.sum("_in").over(Window.partitionBy("source", "size").orderBy("_bucket")) - F.col("_in"))
    before = materialize(before, "mix-buckets").withColumnsRenamed({"source": "_s", "size": "_z", "_bucket": "_b"})
    ranked = open_rows.withColumn(
        "_place", F.row_number().over(Window.partitionBy("source", "size", "_bucket").orderBy("_u", "doc_id", "_row")))
    taken = ranked.join(
        before, ranked["source"].eqNullSafe(before["_s"]) & (ranked["size"] == before["_z"]) & (ranked["_bucket"] == before["_b"])
    ).withColumn("copies", F.col("passes") + (F.col("_before") + F.col("_place") <= F.col("extra")).cast("long"))
    settled = placed.where(whole).withColumn("copies", F.col("passes") + (F.col("extra") > 0).cast("long"))
    out = ["_row", "doc_id", "source", "size", "source_size", "target", "copies"]
    return settled.select(out).union(taken.select(out))


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Written table ``(_row, doc_id, source, size, _tie)``; size is the word count (null text: 0)."""
    return with_row_ids(
        docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                    word_count(F.col(text_col)).alias("size"), F.xxhash64(F.col(text_col)).alias("_tie")), "mix-rows")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix itself: rows of ``docs``, repeated as often as they are taken."""
    held, file, place = addressed(docs, "mix-input")
    rows = held.select(F.struct(F.col(file).alias("file"), F.col(place).alias("place")).alias("_row"), F.col(id_col).alias("doc_id"),
                       F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), F.xxhash64(F.col(text_col)).alias("_tie"))
    marks = decide(materialize(rows, "mix-rows"), **options).where("copies > 0").select(
        F.col("_row.file").alias(file), F.col("_row.place").alias(place), "copies")
    return repeated(held, file, place, marks, "mix-copies")
