"""Hard-negative mining with an inverted multi-index.

Vectors are cut into two halves, each with a codebook of its own; a pair of codewords is
a cell.  A query's inner product with any vector of a cell is at most the sum of two half
bounds, ``q . codeword + |q| * radius``, where a codeword's radius is the largest distance
of any row's half to it.  A multi-sequence heap gives the cells in falling order of that
sum.  A search stops where the next bound lies below what it still needs (its kth best
score, or the lower end of its window), so its result is certified, not approximate.

The codebooks are fitted on a bounded sample; every row is assigned and every radius is
taken over all rows.  Rows are stored by cell in shards of about ``shard_rows`` rows
(small cells share a shard, large ones are dealt over several), queries in blocks of rows
of near-by cells.  A query goes to the shards that hold its best cells first; the scores
found there decide which other shards can still hold anything better, and only to those
it goes as well.  The state that tasks carry is the codebooks and one entry per cell.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from valuora.llm.common import materialize, shipped, smallest, with_row_ids

NO_ID = (1 << 63) - 1
EXACT = float(1 << 53)


@dataclass(frozen=True)
class MultiIndex:
    """Codebooks and radii of both halves; rows, first shard and number of shards of each cell."""

    books: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]
    cells: dict[int, tuple[int, int, int]]

    def bounds(self, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Highest inner product that a row's half can have with the query's, by codeword."""
        out, cut = [], self.books[0].shape[1]
        for part, book, radius in zip((query[:cut], query[cut:]), self.books, self.radii):
            size = float(np.sqrt(part @ part))
            reach = size * radius
            slack = 1e-9 * (size * np.sqrt((book * book).sum(axis=1)) + reach) + 0.25  # of rounding
            out.append(book @ part + reach + slack)
        return out[0], out[1]


def multi_sequence(one: np.ndarray, two: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """(sum, i, j) of all pairs, largest sum first."""
    if not len(one) or not len(two):
        return
    first, second = np.argsort(-one, kind="stable").tolist(), np.argsort(-two, kind="stable").tolist()
    a, b = one[first].tolist(), two[second].tolist()
    heap = [(-(a[0] + b[0]), 0, 0)]
    while heap:
        total, p, q = heapq.heappop(heap)
        yield -total, first[p], second[q]
        if q + 1 < len(b):
            heapq.heappush(heap, (-(a[p] + b[q + 1]), p, q + 1))
        if not q and p + 1 < len(a):
            heapq.heappush(heap, (-(a[p + 1] + b[0]), p + 1, 0))


def codebook(rows: np.ndarray, words: int, rounds: int = 8) -> np.ndarray:
    """k-means centres of ``rows`` (at most ``words``, at least one)."""
    distinct = np.unique(rows, axis=0)
    if not len(distinct):
        return np.zeros((1, rows.shape[1]))
    centres = distinct[np.linspace(0, len(distinct) - 1, min(words, len(distinct))).astype(int)].astype(float)
    for _ in range(rounds):
        nearest = _nearest(rows, centres)[0]
        for k in np.unique(nearest):
            centres[k] = rows[nearest == k].mean(axis=0)
    return centres


def _nearest(rows: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest codeword of each row and the distance to it."""
    near = ((book * book).sum(axis=1) - 2 * (rows @ book.T)).argmin(axis=1)
    gap = rows - book[near]
    return near, np.sqrt((gap * gap).sum(axis=1))


def _matrix(column, rows: int) -> np.ndarray:
    """A list column of equally long lists as a matrix."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1) if rows else np.zeros((0, 0))


def mining_rows(vectors: DataFrame, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
                scale: float = 256.0, shifted: int = 7, labels: int = 10) -> DataFrame:
    """Written table ``(_row, id, named, label, vec)``: floor(scale * x), padded to one length.

    Rows with a null label or vector, or a null or non-finite component, are left out.  The
    label of ids divisible by ``shifted`` becomes ``(label + 1) % labels``.  Repeated ids are
    rows of their own; a null id (``named`` false) is a row that is never an anchor and comes
    last in ties.
    """
    fine = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(F.col(label_col).isNotNull() & F.col(vector_col).isNotNull()).where(fine)
    label = F.col(label_col).cast("long")
    moved = F.when(F.col(id_col) % shifted == 0, (label + 1) % labels).otherwise(label)
    vec = F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale).cast("double"))
    rows = rows.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.col(id_col).isNotNull().alias("named"),
                       moved.alias("label"), vec.alias("vec"))
    width = rows.agg(F.max(F.size("vec"))).first()[0] or 1
    padded = F.concat("vec", F.array_repeat(F.lit(0.0), F.lit(max(1, width)) - F.size("vec")))
    return with_row_ids(rows.withColumn("vec", padded), "negatives-rows")


def build_index(rows: DataFrame, words: int = 16, sample_rows: int = 4096, shard_rows: int = 4096) -> tuple[MultiIndex, DataFrame]:
    """The index and ``rows`` with ``cell`` and ``shard``.

    Codebooks come from the ``sample_rows`` rows of smallest hash.  Radii and cell sizes are
    aggregates over all rows: one row per cell reaches the driver.
    """
    hashed = rows.select("_row", "vec", F.xxhash64(F.lit(13), "_row").alias("_h"))
    sample = np.array([r["vec"] for r in smallest(hashed, "_h", sample_rows, "_row").select("vec").collect()], dtype=float)
    sample = sample if sample.size else np.zeros((0, 1))
    cut = sample.shape[1] // 2
    books = (codebook(sample[:, :cut], words), codebook(sample[:, cut:], words))
    schema = T.StructType([*rows.schema.fields, T.StructField("i", T.IntegerType()), T.StructField("j", T.IntegerType()),
                           T.StructField("d1", T.DoubleType()), T.StructField("d2", T.DoubleType())])
    arrow = to_arrow_schema(schema)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("vec"), batch.num_rows)
                (i, d1), (j, d2) = _nearest(x[:, :cut], books[0]), _nearest(x[:, cut:], books[1])
                more = [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(d1), pa.array(d2)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *more], schema=arrow)

    held = materialize(shipped(rows).mapInArrow(assign, schema), "negatives-cells")
    k = len(books[1])
    stats = held.groupBy("i", "j").agg(F.count("*").alias("n"), F.max("d1").alias("d1"), F.max("d2").alias("d2")).collect()
    radii = (np.zeros(len(books[0])), np.zeros(k))
    cells, shard, room = {}, 0, shard_rows
    for r in sorted(stats, key=lambda r: (r["i"], r["j"])):
        radii[0][r["i"]] = max(radii[0][r["i"]], r["d1"])
        radii[1][r["j"]] = max(radii[1][r["j"]], r["d2"])
        if r["n"] > room and room < shard_rows:
            shard, room = shard + 1, shard_rows
        parts = -(-r["n"] // shard_rows)
        cells[r["i"] * k + r["j"]] = (r["n"], shard, parts)
        if parts > 1:
            shard += parts
        else:
            room -= r["n"]
    cell = F.col("i") * k + F.col("j")
    table = rows.sparkSession.createDataFrame([(c, *v[1:]) for c, v in cells.items()], "cell int, _first int, _parts int")
    dealt = F.col("_first") + F.pmod(F.xxhash64(F.lit(5), "_row"), F.col("_parts")).cast("int")
    indexed = held.withColumn("cell", cell).join(F.broadcast(table), "cell").withColumn("shard", dealt)
    return MultiIndex(books, radii, cells), indexed.drop("i", "j", "d1", "d2", "_first", "_parts")


def routes(anchors: DataFrame, index: MultiIndex, probe_rows: int | None = None) -> DataFrame:
    """``(_row, shard)``: where each anchor has to go.

    With ``probe_rows``, the shards of its best cells until they hold so many rows;
    otherwise those of all cells whose bound reaches the anchor's ``least``.
    """
    k = len(index.books[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, shards = [], []
            least = batch.column("least").to_pylist()
            for row, low, query in zip(batch.column("_row").to_pylist(), least, _matrix(batch.column("vec"), batch.num_rows)):
                found, seen = set(), 0
                for bound, i, j in multi_sequence(*index.bounds(query)):
                    if bound < low if probe_rows is None else seen >= probe_rows:
                        break
                    if (cell := index.cells.get(i * k + j)) is not None:
                        seen += cell[0]
                        found.update(range(cell[1], cell[1] + cell[2]))
                rows += [row] * len(found)
                shards += sorted(found)
            yield pa.RecordBatch.from_arrays([pa.array(rows, type=pa.int64()), pa.array(shards, type=pa.int32())], names=["_row", "shard"])

    return shipped(anchors.select("_row", "vec", "least")).mapInArrow(run, "_row long, shard int")


class _Shard:
    """Rows of one group by cell, for searches in falling order of bounds."""

    def __init__(self, index: MultiIndex, rows: pa.Table) -> None:
        k = len(index.books[1])
        cell = rows.column("cell").to_numpy()
        order = np.argsort(cell, kind="stable")
        cell = cell[order]
        self.index = index
        self.vec = _matrix(rows.column("vec"), rows.num_rows)[order]
        self.row, self.id, self.label = (rows.column(c).to_numpy()[order] for c in ("_row", "id", "label"))
        self.known = rows.column("named").to_numpy()[order]
        self.last = np.lexsort((self.row, ~self.known, self.id)).argsort()  # place in ties
        names, starts = np.unique(cell, return_index=True)
        ends = np.append(starts[1:], len(cell))
        self.slices = {int(c): (int(a), int(b)) for c, a, b in zip(names, starts, ends)}
        self.i, self.j = np.unique(names // k), np.unique(names % k)
        self.k = k
        self.top = float(np.abs(self.vec).max(initial=0.0))

    def scores(self, query: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Exact inner products; beyond what doubles hold, in Python integers, held inside 64 bits."""
        if np.abs(query).max(initial=0.0) * self.top * max(1, len(query)) < EXACT:
            return (self.vec[at] @ query).astype(np.int64)
        whole = [sum(int(x) * int(y) for x, y in zip(v, query)) for v in self.vec[at]]
        return np.array([max(-NO_ID - 1, min(NO_ID, s)) for s in whole], dtype=np.int64)

    def falling(self, query: np.ndarray, batch: int = 512) -> Iterator[tuple[float, np.ndarray]]:
        """(bound of everything that follows, rows of the next cells), best cells first."""
        one, two = self.index.bounds(query)
        held: list[np.ndarray] = []
        size = 0
        for bound, i, j in multi_sequence(one[self.i], two[self.j]):
            cut = self.slices.get(int(self.i[i]) * self.k + int(self.j[j]))
            if cut is None:
                continue
            if size >= batch:
                yield bound, np.concatenate(held)
                held, size = [], 0
            held.append(np.arange(*cut))
            size += cut[1] - cut[0]
        if held:
            yield -np.inf, np.concatenate(held)

    def best(self, at: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best of the given rows, ties by id."""
        order = np.lexsort((self.last[at], -scores))[:k]
        return at[order], scores[order]

    def positives(self, row: int, label: int, query: np.ndarray, least: float, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Best ``k`` other rows of the label; a score below ``least`` is not needed."""
        at, got = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        for bound, some in self.falling(query):
            some = some[(self.label[some] == label) & (self.row[some] != row)]
            scores = self.scores(query, some)
            at, got = self.best(np.concatenate([at, some]), np.concatenate([got, scores]), k)
            if bound < max(least, got[-1] if len(got) == k else -np.inf):
                break
        return at, got

    def windows(self, label: int, query: np.ndarray, ceilings: list[int], floors: list[int], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each window of scores, its first ``k`` rows of other labels."""
        none = np.zeros(0, dtype=np.int64)
        found = [(none, none)] * len(ceilings)
        for bound, some in self.falling(query):
            some = some[self.label[some] != label]
            scores = self.scores(query, some)
            needed = np.inf
            for w, (high, low) in enumerate(zip(ceilings, floors)):
                inside = (scores >= low) & (scores <= high)
                at, got = found[w]
                if inside.any():
                    at, got = self.best(np.concatenate([at, some[inside]]), np.concatenate([got, scores[inside]]), k)
                    found[w] = (at, got)
                needed = min(needed, got[-1] if len(got) == k else low)
            if bound < needed:
                break
        return found


def _meet(anchors: DataFrame, routed: DataFrame, indexed: DataFrame, index: MultiIndex, search, schema: str) -> DataFrame:
    """``search(shard, anchor rows)`` on every block of anchors and shard that ``routed`` brings together."""
    going = anchors.join(routed, "_row").withColumnRenamed("shard", "_shard")
    pairs = going.select(F.col("_block").alias("_to"), F.col("_shard").alias("_from")).distinct()
    coming = indexed.join(pairs, indexed["shard"] == pairs["_from"]).drop("shard")
    arrow = to_arrow_schema(T._parse_datatype_string(schema)) if isinstance(schema, str) else to_arrow_schema(schema)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            out = search(_Shard(index, right), left)
        columns = zip(*out) if out else [[] for _ in arrow]
        return pa.Table.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return shipped(going).groupBy("_block", "_shard").cogroup(coming.groupBy("_to", "_from")).applyInArrow(run, schema)


def _ranked(df: DataFrame, keys: list[str], score: str, ident: str, named: str, row: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc(score), ident, F.desc(named), row)
    return df.withColumn("rank", F.row_number().over(order))


def hard_negatives(rows: DataFrame, every: int = 100, positives: int = 5, negatives: int = 5, share: tuple[int, int] = (4, 5),
                   words: int = 16, sample_rows: int = 4096, shard_rows: int = 4096, block: int = 512) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` comes from :func:`mining_rows`.  Anchors are rows whose id is divisible by
    ``every``; positives are the best other rows of their label; the negatives of a positive
    are the best rows of other labels that score at most the positive's score and at least
    ``share`` of it.  A repeated anchor row has results of its own.  Tables without rows or
    anchors give no rows.  Scores outside 64 bits stop at their limits.
    """
    index, indexed = build_index(rows, words, sample_rows, shard_rows)
    indexed = materialize(indexed, "negatives-index")
    anchors = indexed.where(F.col("named") & (F.col("id") % every == 0))
    anchors = anchors.select("_row", "id", "label", "vec", "shard", F.lit(float("-inf")).alias("least"))
    # neighbouring shards have anchors alike; a shard with many anchors makes blocks of its own
    parts = anchors.groupBy("shard").agg(F.ceil(2 * F.count("*") / block).alias("_parts"))
    own = F.struct("shard", F.pmod(F.xxhash64(F.lit(3), "_row"), F.col("_parts")).alias("p"))
    near = F.floor(F.col("shard") / max(1, block * every // shard_rows))
    anchors = anchors.join(parts, "shard").withColumn("_block", F.when(F.col("_parts") > 1, F.xxhash64(own)).otherwise(near))
    anchors = materialize(anchors.drop("shard", "_parts"), "negatives-anchors")

    def nearest(shard: _Shard, left: pa.Table) -> list[tuple]:
        out = []
        vec = _matrix(left.column("vec"), left.num_rows)
        for row, label, least, query in zip(*(left.column(c).to_pylist() for c in ("_row", "label", "least")), vec):
            at, got = shard.positives(row, label, query, least, positives)
            out += [(row, int(shard.id[a]), bool(shard.known[a]), int(shard.row[a]), int(s)) for a, s in zip(at, got)]
        return out

    kinds = "_row long, id long, named boolean, positive_row long, score long"
    probe = materialize(routes(anchors, index, shard_rows).distinct(), "negatives-probe")
    first = materialize(_meet(anchors, probe, indexed, index, nearest, kinds), "negatives-first")
    bars = _ranked(first, ["_row"], "score", "id", "named", "positive_row").where(F.col("rank") == positives).select(
        "_row", F.col("score").cast("double").alias("_bar"))
    barred = anchors.drop("least").join(bars, "_row", "left").withColumn("least", F.coalesce("_bar", F.lit(float("-inf")))).drop("_bar")
    barred = materialize(barred, "negatives-barred")
    rest = routes(barred, index).join(probe, ["_row", "shard"], "left_anti")
    second = _meet(barred, materialize(rest, "negatives-rest"), indexed, index, nearest, kinds)
    chosen = _ranked(first.union(second), ["_row"], "score", "id", "named", "positive_row").where(F.col("rank") <= positives)
    chosen = materialize(chosen.withColumnRenamed("rank", "place"), "negatives-positives")

    top, whole = share
    floor = lambda s: -((-top * s) // whole)
    sought = chosen.groupBy("_row").agg(
        F.sort_array(F.collect_list(F.struct("place", "score"))).alias("windows"),  # at most ``positives``
        F.min("score").alias("_low"))
    sought = anchors.drop("least").join(sought, "_row").withColumn(
        "least", F.ceil(F.col("_low").cast("decimal(38,0)") * top / whole).cast("double") - 1).drop("_low")
    sought = materialize(sought, "negatives-sought")

    def inside(shard: _Shard, left: pa.Table) -> list[tuple]:
        out = []
        vec = _matrix(left.column("vec"), left.num_rows)
        for row, label, windows, query in zip(*(left.column(c).to_pylist() for c in ("_row", "label", "windows")), vec):
            high = [w["score"] for w in windows]
            found = shard.windows(label, query, high, [floor(s) for s in high], negatives)
            for w, (at, got) in zip(windows, found):
                out += [(row, w["place"], int(shard.id[a]), bool(shard.known[a]), int(shard.row[a]), int(s)) for a, s in zip(at, got)]
        return out

    found = _meet(sought, materialize(routes(sought, index), "negatives-routes"), indexed, index, inside,
                  "_row long, place int, negative long, negative_named boolean, negative_row long, negative_score long")
    found = _ranked(found, ["_row", "place"], "negative_score", "negative", "negative_named", "negative_row").where(F.col("rank") <= negatives)
    name = lambda c, known: F.when(F.col(known), F.col(c))
    pairs = chosen.select("_row", "place", name("id", "named").alias("positive_id"), F.col("score").alias("positive_score"))
    return found.join(pairs, ["_row", "place"]).join(anchors.select("_row", F.col("id").alias("anchor_id")), "_row").select(
        "anchor_id", "positive_id", "rank", name("negative", "negative_named").alias("negative_id"), "positive_score", "negative_score")
