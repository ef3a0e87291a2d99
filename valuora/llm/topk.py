"""Exact top-k inner-product search by exhaustive term-at-a-time accumulation.

Vectors are read as sparse rows of (term, weight).  Candidates of a block are
inverted into postings by term; for every term, the queries that have it scatter
their weight times the posting weights into a dense score array.  The block's
best k per query are taken by partition selection, and blocks are merged.

Queries and candidates meet in blocks: a block pair is one bounded group, so
memory does not depend on the table; every candidate is scored against every
query.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from valuora.llm.common import shipped, with_row_ids

EXACT = float(1 << 53)
EXACT_FLOAT = float(1 << 24)


NO_ID = (1 << 63) - 1


def quantized(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 64.0) -> DataFrame:
    """Written table ``(_row, id, named, vec)``: floor(scale * x) of each component, as doubles.

    Rows with a null vector or a null or non-finite component are left out.  Every other row
    takes part: repeated ids are candidates (and queries) of their own; a row without id
    (``named`` false) is a candidate that comes last in ties.
    """
    fine = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(F.col(vector_col).isNotNull()).where(fine)
    vec = F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale).cast("double"))
    return with_row_ids(rows.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"),
                                    F.col(id_col).isNotNull().alias("named"), vec.alias("vec")), "topk-vectors")


def _matrix(vectors: list) -> np.ndarray:
    width = max((len(v) for v in vectors), default=0)
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def accumulate(queries: np.ndarray, candidates: np.ndarray, tile: int = 32) -> np.ndarray:
    """Integer scores of all queries (rows) against all candidates, term at a time.

    Candidates are inverted once: a term's postings are its column of weights, or
    the positions of the non-zero ones where few have it.  Queries go through the
    terms ``tile`` at a time, so their score rows stay in the processor's cache.
    Terms beyond a shorter vector weigh zero.  Sums are exact: floats hold every
    integer below 2^24, doubles below 2^53; beyond that, Python integers take over.
    """
    terms = min(queries.shape[1], candidates.shape[1])
    q, c = queries[:, :terms], candidates[:, :terms]
    largest = (np.abs(q).max(initial=0.0) * np.abs(c).max(initial=0.0)) * max(terms, 1)
    if largest >= EXACT:
        whole = [[sum(int(a) * int(b) for a, b in zip(x, y)) for y in c] for x in q]
        return np.array(whole, dtype=object).reshape(len(q), len(c))
    kind = np.float32 if largest < EXACT_FLOAT else np.float64
    weights = np.ascontiguousarray(c.T, dtype=kind)
    postings = [np.flatnonzero(w) if np.count_nonzero(w) < len(w) / 8 else None for w in weights]
    scores = np.zeros((len(q), len(c)), dtype=kind)
    for start in range(0, len(q), tile):
        part = np.ascontiguousarray(q[start : start + tile].T, dtype=kind)
        rows = scores[start : start + tile]
        product = np.empty_like(rows)
        for t in range(terms):
            hit = np.flatnonzero(part[t])
            if not len(hit):
                continue
            if postings[t] is None:
                rows += np.multiply(part[t][:, None], weights[t], out=product)
            else:
                rows[np.ix_(hit, postings[t])] += np.multiply.outer(part[t][hit], weights[t][postings[t]])
    return scores


def best(scores: np.ndarray, order: np.ndarray, own: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(query, candidate, score) by place: each query's k best, ties to the smaller ``order``.

    ``own`` marks pairs of a row with itself, which are left out.
    """
    by = np.argsort(order, kind="stable")
    scores, own = scores[:, by], own[:, by]
    if scores.dtype == object:
        out = []
        for q, row in enumerate(scores):
            top = sorted((-int(s), i) for i, s in enumerate(row) if not own[q, i])[:k]
            out += [(q, int(by[i]), -s) for s, i in top]
        return out
    scores = np.where(own, -np.inf, scores)
    keep = ~own
    if scores.shape[1] > k:
        keep &= scores >= np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k, None]
    rows, columns = np.nonzero(keep)
    values = scores[rows, columns].astype(np.int64)
    ranked = np.lexsort((columns, -values, rows))
    rows, columns, values = rows[ranked], columns[ranked], values[ranked]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    top = place < k
    return list(zip(rows[top].tolist(), by[columns[top]].tolist(), values[top].tolist()))


RESULT = "query_row long, query_id long, id long, named boolean, row long, score long"
LIMIT = (1 << 63) - 1


def search(vectors: DataFrame, every: int = 20, k: int = 20, query_block: int = 512, candidate_block: int = 16384, tile: int = 2048) -> DataFrame:
    """Top ``k`` of every row whose id is divisible by ``every``, against all other rows.

    ``vectors`` is the output of :func:`quantized`.  Gives query_id, rank, vec_id, score; scores
    outside 64 bits stop at their limits.  A block of candidates is scored tile by tile with a
    running top ``k``, so only ``k`` rows of a query leave each block.
    """
    rows = vectors
    asked = F.col("named") & (F.col("id") % every == 0)
    n, q = rows.agg(F.count("*"), F.count(F.when(asked, 1))).first()
    blocks, query_blocks = max(1, -(-n // candidate_block)), max(1, -(-q // query_block))
    hashed = F.xxhash64(F.lit(9), "_row")
    copies = lambda count: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))
    queries = rows.where(asked).select("_row", "id", "vec", F.pmod(hashed, F.lit(query_blocks)).alias("_q"), copies(blocks).alias("_c"))
    candidates = rows.select("_row", "id", "named", "vec", copies(query_blocks).alias("_q"), F.pmod(hashed, F.lit(blocks)).alias("_c"))

    def score(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        held: dict[int, list[tuple]] = {}
        asking = _matrix(left["vec"].tolist())
        query_rows = left["_row"].to_numpy()
        for at in range(0, len(right) if len(left) else 0, tile):
            part = right.iloc[at : at + tile]
            scores = accumulate(asking, _matrix(part["vec"].tolist()))
            ids, named, numbers = part["id"].tolist(), part["named"].tolist(), part["_row"].to_numpy()
            order = np.lexsort((numbers, ~part["named"].to_numpy(dtype=bool), part["id"].to_numpy())).argsort()
            for a, b, s in best(scores, order, query_rows[:, None] == numbers, k):
                held.setdefault(a, []).append((-s, ids[b], not named[b], int(numbers[b])))
        out = []
        names = left["id"].tolist()
        for a, found in held.items():
            for s, ident, nameless, number in sorted(found)[:k]:
                out.append((int(query_rows[a]), names[a], ident, not nameless, number, max(-LIMIT - 1, min(LIMIT, -s))))
        columns = ["query_row", "query_id", "id", "named", "row", "score"]
        frame = pd.DataFrame(out, columns=columns)
        return frame.astype({c: "bool" if c == "named" else "int64" for c in columns})

    # the query side carries k rows a block at most into the merge
    partial = shipped(queries).groupBy("_q", "_c").cogroup(candidates.groupBy("_q", "_c")).applyInPandas(score, RESULT)
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "id", F.desc("named"), "row"))
    return partial.withColumn("rank", rank).where(F.col("rank") <= k).select(
        "query_id", "rank", F.when(F.col("named"), F.col("id")).alias("vec_id"), "score")
