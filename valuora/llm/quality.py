"""Quality by ordinal cumulative-link regression on graded ratings.

``P(grade <= k) = sigmoid(theta_k - w.x)`` with one weight vector shared by all
grades and ordered thresholds.  ``x`` is hashed text: words, the shapes of
neighbouring words and repeats, as square roots of their relative frequency.
The fit runs in numpy on a bounded sample of rated rows (``sample_rows``, taken
by a seeded hash); scoring reads every row and whole texts.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from valuora.llm.common import map_columns, smallest, worker_state
from valuora.session import ship_package

BITS = 16
MEMO_WORDS = 300_000
PIECE = 48
_RUNS = re.compile(r"(.)\1+")


def _shape(word: str) -> str:
    """Character classes of a word with runs collapsed: letters by case, digits, other characters as they are."""
    kinds = "".join("a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else "l" if c.isalpha() else c for c in word)
    return _RUNS.sub(r"\1", kinds)


def _pieces(words: list[str]) -> list[str]:
    """``words`` with unbroken runs of over ``PIECE`` characters cut into pieces that cover them."""
    if max(map(len, words)) <= PIECE:
        return words
    return [w[i : i + PIECE] for w in words for i in range(0, len(w), PIECE)]


class TextHasher:
    """Sparse hashed features of texts, with a bounded memo of words."""

    def __init__(self, bits: int = BITS) -> None:
        self.mask, self.memo = (1 << bits) - 1, {}

    def _word(self, word: str) -> int:
        code = zlib.crc32(word.lower().encode()) << 32 | zlib.crc32(b"shape " + _shape(word).encode())
        self.memo[word] = code
        return code

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Sorted feature numbers and their values; an empty text has the bias feature alone."""
        words = (text or "").split()
        if not words:
            return np.zeros(1, dtype=np.int64), np.ones(1)
        words = _pieces(words)
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        get, miss = self.memo.get, self._word
        codes = np.fromiter((get(w) or miss(w) for w in words), dtype=np.uint64, count=len(words))
        word, shape = (codes >> np.uint64(32)).astype(np.int64), (codes & np.uint64(0xFFFFFFFF)).astype(np.int64)
        parts = [word, shape * 31 + 7]
        if len(words) > 1:
            parts += [(shape[:-1] * 1_000_003 + shape[1:]) ^ 0x5BD1, np.where(word[:-1] == word[1:], 0xA11CE, 0xB0B)]
        found, counts = np.unique(np.concatenate(parts) & self.mask, return_counts=True)
        return found, np.sqrt(counts / len(words))


@dataclass
class OrdinalModel:
    """Weights, ordered thresholds (one fewer than grades) and the selection rule."""

    weights: np.ndarray
    thresholds: np.ndarray
    select_grade: int = 1
    select_at: float = 0.5

    def margins(self, hasher: TextHasher, texts) -> np.ndarray:
        out = np.empty(len(texts))
        for i, t in enumerate(texts):
            f, v = hasher(t)
            out[i] = self.weights[f] @ v
        return out

    def tails(self, margins: np.ndarray) -> np.ndarray:
        """``P(grade >= k)`` for k = 1, 2, ... as columns."""
        return _sigmoid(margins[:, None] - self.thresholds[None, :])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit_ordinal(features: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, n_grades: int, bits: int = BITS,
                rounds: int = 150, rate: float = 0.05, l2: float = 2e-5) -> tuple[np.ndarray, np.ndarray]:
    """Maximum-likelihood weights and thresholds by full-batch Adam.

    Thresholds are ``t0, t0 + e^d1, ...`` so they stay ordered.
    """
    size = 1 << bits
    rows = np.repeat(np.arange(len(features)), [len(f) for f, _ in features])
    cols = np.concatenate([f for f, _ in features])
    vals = np.concatenate([v for _, v in features])
    share = np.array([(grades >= k).mean() for k in range(1, n_grades)]).clip(0.01, 0.99)
    start = -np.log(share / (1 - share))
    gaps = np.log(np.maximum(np.diff(start), 0.05))
    params = np.concatenate([np.zeros(size), start[:1], gaps])
    m, s = np.zeros_like(params), np.zeros_like(params)
    at = np.arange(len(grades))
    for step in range(1, rounds + 1):
        theta = params[size] + np.concatenate([[0.0], np.cumsum(np.exp(params[size + 1 :]))])
        z = np.bincount(rows, weights=vals * params[cols], minlength=len(grades))
        cdf = _sigmoid(theta[None, :] - z[:, None])
        full = np.concatenate([np.zeros((len(z), 1)), cdf, np.ones((len(z), 1))], axis=1)
        p = np.maximum(full[at, grades + 1] - full[at, grades], 1e-9)
        slope = np.concatenate([np.zeros((len(z), 1)), cdf * (1 - cdf), np.zeros((len(z), 1))], axis=1)
        up, down = slope[at, grades + 1] / p, slope[at, grades] / p
        dz = (up - down) / len(z)
        dtheta = np.array([(down[grades == k + 1].sum() - up[grades == k].sum()) / len(z) for k in range(n_grades - 1)])
        grad = np.empty_like(params)
        grad[:size] = np.bincount(cols, weights=vals * dz[rows], minlength=size) + l2 * params[:size]
        grad[size] = dtheta.sum()
        grad[size + 1 :] = [dtheta[k + 1 :].sum() * np.exp(params[size + 1 + k]) for k in range(n_grades - 2)]
        m += 0.1 * (grad - m)
        s += 0.001 * (grad**2 - s)
        params -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    theta = params[size] + np.concatenate([[0.0], np.cumsum(np.exp(params[size + 1 :]))])
    return params[:size], theta


def train(rated: DataFrame, n_grades: int = 3, text_col: str = "text", grade_col: str = "grade", id_col: str = "doc_id",
          select_grade: int = 1, keep_clean: float = 0.998, sample_rows: int = 6000, seed: int = 6) -> OrdinalModel:
    """Fit on at most ``sample_rows`` rated rows (smallest seeded hash of the id).

    A fifth of them is held back to set the selection threshold: the tail
    probability that keeps ``keep_clean`` of the rows rated ``select_grade`` or
    better, at most 0.5.  Rows without text or grade do not train; without rated
    rows of two grades the model keeps everything.
    """
    rows = rated.where(F.col(grade_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(text_col).alias("text"), F.col(grade_col).cast("int").alias("grade"),
        F.xxhash64(F.lit(seed), F.col(id_col)).alias("h"))
    chosen = smallest(rows, "h", sample_rows, "grade", "text")
    schema = T.StructType(
        [T.StructField("h", T.LongType()), T.StructField("grade", T.IntegerType()),
         T.StructField("f", T.ArrayType(T.IntegerType())), T.StructField("v", T.ArrayType(T.FloatType()))])

    def make():
        hasher = TextHasher()

        def work(c):
            both = [hasher(t) for t in c["text"]]
            return {"h": c["h"], "grade": c["grade"], "f": [f for f, _ in both], "v": [v.astype(np.float32) for _, v in both]}

        return work

    got = map_columns(chosen, make, schema).toArrow()
    grades = got["grade"].to_numpy().astype(np.int64)
    if len(np.unique(grades)) < 2:
        return OrdinalModel(np.zeros(1 << BITS), np.full(n_grades - 1, -10.0), select_grade, 0.0)
    features = [(f.values.to_numpy(), v.values.to_numpy()) for f, v in zip(got["f"], got["v"])]  # views, no copies
    held = (np.arange(len(grades)) % 5 == 4) & (len(grades) >= 50)
    weights, theta = fit_ordinal([x for x, h in zip(features, held) if not h], grades[~held], n_grades)
    model = OrdinalModel(weights, theta, select_grade)
    watch = held if held.any() else ~held
    z = np.array([weights[f] @ v for (f, v), h in zip(features, watch) if h])
    clean = model.tails(z)[grades[watch] >= select_grade, select_grade - 1]
    model.select_at = min(0.5, float(np.quantile(clean, 1 - keep_clean))) if len(clean) else 0.5
    return model


def score(model: OrdinalModel, text: Column) -> Column:
    """Struct of ``expected_grade``, ``tail`` (P(grade >= select_grade)) and ``keep`` for a text column.

    A null text counts as empty; an empty or blank one is graded by the bias feature alone;
    runs without white space count by pieces of ``PIECE`` characters, to their end.
    """

    ship_package(SparkSession.active())

    @F.pandas_udf("expected_grade double, tail double, keep boolean")
    def grade(texts: pd.Series) -> pd.DataFrame:
        worker_state()
        tails = model.tails(model.margins(TextHasher(), texts.where(texts.notna(), "").to_numpy()))
        tail = tails[:, model.select_grade - 1]
        return pd.DataFrame({"expected_grade": tails.sum(axis=1), "tail": tail, "keep": tail >= model.select_at})

    return grade(text)


def graded(labels: DataFrame) -> DataFrame:
    """Ratings 0, 1, 2 from the label table: poor; good but toxic; good and clean."""
    good = F.col("quality").cast("int")
    return labels.where(F.col("quality").isNotNull()).select(
        "doc_id", (good + good * (1 - F.coalesce(F.col("toxic").cast("int"), F.lit(0)))).alias("grade"))
