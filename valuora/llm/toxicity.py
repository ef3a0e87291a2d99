"""Toxicity by a convolutional text classifier over hashed word embeddings.

A word's embedding is the sum of rows hashed from the word and its leading
characters.  Filters of several widths slide over the whole text, each keeps its
maximum, and a logistic layer turns the maxima into a score.  The network is
trained by Adam on all labelled rows but a held fifth, which calibrates the score
and one threshold per language.  Rows are dealt to shards of bounded size; in each
epoch a task runs Adam over its shard from the common network, and the networks are
averaged (an embedding row by the steps that touched it).  One shard is plain Adam.
Language is used for that report alone, never for the score.
"""

from __future__ import annotations

import copy
import re
import zlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from valuora.llm.common import shipped
from valuora.session import materialize, ship_package

WORD = re.compile(r"\w+")
MEMO_WORDS = 150_000
STEP_WORDS = 20_000
PIECE = 24
LONG_WORD = 48
PREFIXES = (4, 5, 6, 7)
CARET = zlib.crc32(b"^")


@dataclass
class Shape:
    """Sizes of the network."""

    buckets: int = 1 << 14
    dims: int = 16
    widths: tuple[int, ...] = (1, 2, 3)
    filters: int = 12


@dataclass
class ToxicityModel:
    """Trained arrays, score calibration ``sigmoid(scale * z + shift)`` and thresholds by language."""

    shape: Shape
    embed: np.ndarray
    filters: list[np.ndarray]  # per width: (width, dims, filters)
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: float
    scale: float = 1.0
    shift: float = 0.0
    threshold: float = 0.5
    by_language: dict[str, float] = field(default_factory=dict)


def sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * np.clip(x, -60, 60)))


def row_type(buckets: int):
    """The narrowest type that holds a bucket number."""
    return np.uint16 if buckets <= 1 << 16 else np.int32


class WordRows:
    """Embedding rows of words: (1 + len(PREFIXES)) bucket numbers each."""

    def __init__(self, buckets: int) -> None:
        self.buckets, self.kind = buckets, row_type(buckets)

    def of_words(self, words: Sequence[str]) -> np.ndarray:
        """(words, parts) bucket numbers: checksums of every word and of "^" with its leading characters."""
        rows = np.empty((len(words), 1 + len(PREFIXES)), self.kind)
        for j, (parts, start) in enumerate([(words, 0), *(([w[:n] for w in words], CARET) for n in PREFIXES)]):
            rows[:, j] = np.fromiter(map(zlib.crc32, map(str.encode, parts), repeat(start)), np.uint32, len(words)) % self.buckets
        return rows

    @staticmethod
    def words(text: str | None) -> list[str]:
        """Lower-cased words of a text."""
        words = WORD.findall((text or "").lower())
        if max(map(len, words), default=0) > LONG_WORD:  # unbroken runs: pieces that cover them
            words = [p for w in words for p in ([w] if len(w) <= LONG_WORD else [w[i : i + PIECE] for i in range(0, len(w), PIECE)])]
        return words

    def __call__(self, text: str | None) -> np.ndarray:
        """(words, parts) bucket numbers of the words of a text."""
        return self.of_words(self.words(text))


def _responses(vectors: np.ndarray, w: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Answers of one width's filters at every place; places whose window would reach
    the next text are out of the running."""
    width = len(w)
    n = len(vectors) - width + 1
    u = vectors[:n] @ w[0]
    for j in range(1, width):
        u += vectors[j : j + n] @ w[j]
        u[starts[1:] - j] = -np.inf
    return u


def _pooled(model: ToxicityModel, vectors: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Maxima of every filter over every text.

    ``vectors`` holds the texts' word vectors one after another, each text followed
    by ``max(widths)`` zero rows, so every text has a place for every width.
    """
    pools = []
    for w, b in zip(model.filters, model.bias):
        pools.append(np.maximum(np.maximum.reduceat(_responses(vectors, w, starts), starts, axis=0) + b, 0))
    return np.concatenate(pools, axis=1)


def _stack(texts: Sequence[np.ndarray], pad: int, blank: int) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of texts one after another, each followed by ``pad`` times ``blank``; text starts."""
    gap = np.full(pad, blank, np.int32)
    lengths = np.array([len(t) + pad for t in texts])
    return np.concatenate([x for t in texts for x in (t, gap)]), np.concatenate([[0], np.cumsum(lengths)[:-1]])


def _embed(embed: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Vectors of words given by their embedding rows."""
    vectors = embed[rows[:, 0]]
    for j in range(1, rows.shape[1]):
        vectors += embed[rows[:, j]]
    return vectors


def _in_steps(texts: Iterable[np.ndarray], step_words: int) -> Iterator[list[np.ndarray]]:
    """Lists of texts of ``step_words`` words or a little more."""
    batch, size = [], 0
    for t in texts:
        batch.append(t)
        size += len(t)
        if size >= step_words:
            yield batch
            batch, size = [], 0
    if batch:
        yield batch


def _logits(model: ToxicityModel, texts: Sequence[np.ndarray], vectors: np.ndarray) -> np.ndarray:
    """Logits of texts given as word numbers (from 1), all at once; ``vectors`` are those of the numbers, the first one zero."""
    numbers, starts = _stack(texts, max(model.shape.widths), 0)
    return _pooled(model, np.take(vectors, numbers, axis=0), starts) @ model.out + model.out_bias


def raw_scores(model: ToxicityModel, texts: Sequence[np.ndarray], step_words: int = STEP_WORDS) -> np.ndarray:
    """Logits of texts given as word rows; texts are stacked up to ``step_words`` words at a time."""
    return shard_scores(model, *_numbered(texts), step_words)


def shard_scores(model: ToxicityModel, texts: Sequence[np.ndarray], rows: np.ndarray, step_words: int = STEP_WORDS) -> np.ndarray:
    """Logits of texts given as word numbers, with the embedding rows of every number."""
    vectors = np.concatenate([np.zeros((1, model.shape.dims), np.float32), _embed(model.embed, rows)])
    out = [_logits(model, [t + 1 for t in batch], vectors) for batch in _in_steps(texts, step_words)]
    return np.concatenate(out) if out else np.zeros(0)


def _numbered(texts: Sequence[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Texts given as word rows with a number for every word, and the rows by number."""
    if not texts:
        return [], np.zeros((0, 1 + len(PREFIXES)), np.int32)
    ends = np.cumsum([len(t) for t in texts])
    return np.split(np.arange(ends[-1], dtype=np.int32), ends[:-1]), np.concatenate(texts)


class WordVectors(dict):
    """Numbers of the words met (from 1) and their vectors, summed up once per word; all are forgotten beyond ``MEMO_WORDS``."""

    def __init__(self, model: ToxicityModel) -> None:
        super().__init__()
        self.model, self.hashed, self.fresh = model, WordRows(model.shape.buckets), []
        self.table = np.zeros((1, model.shape.dims), np.float32)

    def __missing__(self, word: str) -> int:
        self.fresh.append(word)
        self[word] = number = len(self) + 1
        return number

    def vectors(self) -> np.ndarray:
        """Vectors by number."""
        if self.fresh:
            known = len(self) + 1 - len(self.fresh)
            if len(self) >= len(self.table):
                self.table = np.concatenate([self.table[:known], np.zeros((len(self) + 1, self.table.shape[1]), np.float32)])
            self.table[known : len(self) + 1] = _embed(self.model.embed, self.hashed.of_words(self.fresh))
            self.fresh = []
        return self.table

    def logits(self, texts: Iterable[str | None]) -> np.ndarray:
        """Logits of texts."""
        out = []
        for batch in _in_steps(map(WordRows.words, texts), STEP_WORDS):
            if len(self) > MEMO_WORDS:
                self.clear()
            numbers = [np.fromiter(map(self.__getitem__, words), np.int32, len(words)) for words in batch]
            out.append(_logits(self.model, numbers, self.vectors()))
        return np.concatenate(out) if out else np.zeros(0)


def fit(texts: list[np.ndarray], labels: np.ndarray, weights: np.ndarray, shape: Shape | None = None, epochs: int = 8,
        batch: int = 64, rate: float = 0.01, drop: float = 0.2, l2: float = 1e-5, seed: int = 10) -> ToxicityModel:
    """Train by mini-batch Adam on log loss; a share ``drop`` of the words is blanked in each step."""
    rng = np.random.default_rng(seed)
    model = untrained(shape or Shape(), float((labels * weights).sum() / weights.sum()), rng)
    descend(model, *_numbered(texts), labels, weights, rng, range(epochs), epochs, batch, rate, drop, l2)
    return model


def untrained(shape: Shape, share: float, rng: np.random.Generator) -> ToxicityModel:
    """A drawn network whose score is the ``share`` of toxic rows on an empty text."""
    d, f, share = shape.dims, shape.filters, float(np.clip(share, 0.01, 0.99))
    return ToxicityModel(
        shape, rng.normal(0, 0.1, (shape.buckets, d)).astype(np.float32),
        [rng.normal(0, 1 / np.sqrt(w * d), (w, d, f)).astype(np.float32) for w in shape.widths],
        [np.zeros(f, np.float32) for _ in shape.widths],
        rng.normal(0, 0.3, f * len(shape.widths)).astype(np.float32), float(np.log(share / (1 - share))))


def _sums(at: np.ndarray, values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The places (below ``size``, ascending) where the values add up to something, and the sums there, added up in their order."""
    mark, slot, d = np.zeros(size, bool), np.empty(size, np.int64), values.shape[1]
    mark[at] = True
    found = np.flatnonzero(mark)
    slot[found] = np.arange(0, len(found) * d, d)
    sums = np.zeros((len(found), d), np.float32)
    np.add.at(sums.reshape(-1), (slot[at][:, None] + np.arange(d)).ravel(), values.ravel())
    some = sums.any(axis=1)
    return found[some], sums[some]


def descend(model: ToxicityModel, texts: list[np.ndarray], words: np.ndarray, labels: np.ndarray, weights: np.ndarray, rng: np.random.Generator, turns: range,
            epochs: int = 8, batch: int = 64, rate: float = 0.01, drop: float = 0.2, l2: float = 1e-5) -> np.ndarray:
    """Run the epochs ``turns`` of ``epochs`` over the texts, changing ``model``; steps that touched each embedding row.

    Texts are word numbers, ``words`` the embedding rows of every number.  A step sums up the vector of
    a word once, however often it occurs, and handles gradients only where there are any.
    """
    shape = model.shape
    d, f, pad, blank = shape.dims, shape.filters, max(shape.widths), len(words)
    words = np.concatenate([words, np.zeros((1, words.shape[1]), words.dtype)])  # the last one stands for no word
    seen, place = np.zeros(shape.buckets, np.float32), np.zeros(len(words), np.int32)
    params = [*model.filters, *model.bias, model.out, np.array([model.out_bias], np.float32)]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    embed_m, embed_s = np.zeros_like(model.embed), np.zeros_like(model.embed)
    step = 0
    for epoch in turns:
        lr = rate * (1 - epoch / epochs) + rate * 0.05
        order = rng.permutation(len(texts))
        for at in range(0, len(order), batch):
            pick = order[at : at + batch]
            numbers, starts = _stack([texts[i] for i in pick], pad, blank)
            real = (numbers != blank) & (rng.random(len(numbers)) >= drop)
            here = np.arange(len(numbers), dtype=np.int32)
            place[numbers] = here
            some = numbers[place[numbers] == here]  # every word once
            place[some] = here[: len(some)]
            table = np.zeros((len(some) + 1, d), np.float32)
            table[:-1] = _embed(model.embed, words[some])
            vectors = np.take(table, np.where(real, place[numbers], len(some)), axis=0)
            pools, where = [], []
            for w, b in zip(model.filters, model.bias):
                u = _responses(vectors, w, starts)
                spots = np.empty((len(pick), f), dtype=np.int64)
                for i, (a, z) in enumerate(zip(starts.tolist(), [*starts[1:].tolist(), len(u)])):
                    spots[i] = a + u[a:z].argmax(axis=0)
                pools.append(u[spots, np.arange(f)] + b)
                where.append(spots)
            pre = np.concatenate(pools, axis=1)
            hidden = np.maximum(pre, 0)
            p = sigmoid(hidden @ model.out + params[-1][0])
            dz = ((p - labels[pick]) * weights[pick] / len(pick)).astype(np.float32)
            grads = [np.zeros_like(q) for q in params]
            grads[-1][0] = dz.sum()
            grads[-2] += hidden.T @ dz
            dh = np.outer(dz, model.out) * (pre > 0)
            spread, shares = [], []  # places in the stack and their gradients
            for i, (width, w, spots) in enumerate(zip(shape.widths, model.filters, where)):
                g = dh[:, i * f : (i + 1) * f]
                grads[len(shape.widths) + i] += g.sum(axis=0)
                text, unit = np.nonzero(g)
                for j in range(width):
                    picked = spots + j  # (texts, filters)
                    grads[i][j] += np.einsum("bfd,bf->df", vectors[picked], g)
                    spread.append(picked[text, unit])
                    shares.append(g[text, unit][:, None] * w[j].T[unit])
            spread, shares = np.concatenate(spread), np.concatenate(shares)
            touched, dv = _sums(spread[real[spread]], shares[real[spread]], len(numbers))
            hit = words[numbers[touched]]
            live, g = _sums(hit.T.ravel(), np.tile(dv, (hit.shape[1], 1)), shape.buckets)  # rows seen in this step
            seen[live] += 1
            step += 1
            q, m, s = model.embed[live], embed_m[live], embed_s[live]
            g += l2 * q
            m += 0.1 * (g - m)
            s += 0.01 * (g**2 - s)
            embed_m[live], embed_s[live] = m, s
            model.embed[live] = q - lr * m / (np.sqrt(s) + 1e-6)
            for q, g, (m, s) in zip(params, grads, moments):
                m += 0.1 * (g + l2 * q - m)
                s += 0.01 * ((g + l2 * q) ** 2 - s)
                q -= lr * 0.3 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-6)
    model.out_bias = float(params[-1][0])
    return seen


def _dense(model: ToxicityModel) -> list[np.ndarray]:
    return [*model.filters, *model.bias, model.out, np.array([model.out_bias], np.float32)]


def _set_dense(model: ToxicityModel, flat: np.ndarray) -> None:
    cuts = np.cumsum([a.size for a in _dense(model)])[:-1]
    parts = [p.reshape(a.shape).astype(np.float32) for p, a in zip(np.split(flat, cuts), _dense(model))]
    n = len(model.filters)
    model.filters, model.bias, model.out, model.out_bias = parts[:n], parts[n : 2 * n], parts[2 * n], float(parts[-1][0])


def _averaged(shards: DataFrame, model: ToxicityModel, turns: range, seed: int, options: dict) -> ToxicityModel:
    """``turns`` from ``model`` on every shard, and the mean of what comes out: one job.

    Networks are added up as flat vectors, in groups of shards, so the driver gets few of them.
    """
    rows_type = row_type(model.shape.buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                texts, words, y, _ = _unpacked(batch, i, rows_type)
                shard = batch.column("shard")[i].as_py()
                mine = copy.deepcopy(model)
                seen = descend(mine, texts, words, y, np.ones(len(y)), np.random.default_rng([seed, turns[0], shard]), turns, **options)
                flat = np.concatenate([((mine.embed - model.embed) * seen[:, None]).ravel(), seen, np.concatenate([a.ravel() for a in _dense(mine)]) * len(y), [len(y)]])
                yield pa.RecordBatch.from_arrays([pa.array([shard % 8], pa.int32()), pa.array([shard], pa.int32()), pa.array([flat.astype(np.float32).tobytes()], pa.binary())], ["part", "shard", "flat"])

    def add(table: pa.Table) -> pa.Table:
        total = 0.0
        for i in np.argsort(table.column("shard").to_numpy()).tolist():  # one order, whatever order they came in
            total = total + np.frombuffer(table.column("flat")[i].as_buffer(), np.float32).astype(np.float64)
        return pa.table({"part": table.column("part").slice(0, 1), "flat": pa.array([total.tobytes()], pa.binary())})

    found = shards.where("NOT held").mapInArrow(run, "part int, shard int, flat binary").groupBy("part").applyInArrow(add, "part int, flat binary").collect()
    total = sum(np.frombuffer(r["flat"]) for r in sorted(found, key=lambda r: r["part"]))
    size, buckets = model.embed.size, model.shape.buckets
    seen = total[size : size + buckets]
    model.embed = (model.embed + total[:size].reshape(model.embed.shape) / np.maximum(seen, 1)[:, None]).astype(np.float32)
    _set_dense(model, total[size + buckets : -1] / total[-1])
    return model


def _platt(z: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """Scale (positive) and shift of a weighted logistic fit of labels on logits, by Newton steps."""
    x = np.stack([z, np.ones_like(z)], axis=1)
    beta = np.array([1.0, 0.0])
    ones, zeros = (w * y).sum(), (w * (1 - y)).sum()
    target = np.where(y > 0, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    for _ in range(50):
        p = sigmoid(x @ beta)
        grad = x.T @ (w * (p - target)) + 1e-3 * (beta - [1.0, 0.0])
        hess = (x * (w * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        move = np.linalg.solve(hess, grad)
        beta -= np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-8:
            break
    return max(float(beta[0]), 1e-3), float(beta[1])


def best_threshold(score: np.ndarray, y: np.ndarray, w: np.ndarray) -> float:
    """Score threshold of the largest weighted F1 (0.5 without positives)."""
    if not (y > 0).any():
        return 0.5
    order = np.argsort(-score, kind="stable")
    hits, all_ = np.cumsum((w * y)[order]), np.cumsum(w[order])
    f1 = 2 * hits / (all_ + (w * y).sum())
    f1[:-1][score[order][:-1] == score[order][1:]] = -1  # equal scores stay together
    at = int(f1.argmax())
    lower = score[order[at + 1]] if at + 1 < len(order) else 0.0
    return float((score[order[at]] + lower) / 2)


def _unpacked(batch: pa.RecordBatch, i: int, rows_type) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, list[str]]:
    """Texts as word numbers, the embedding rows of every number, labels and languages of a shard."""
    lengths, words, rows = (np.frombuffer(batch.column(c)[i].as_buffer(), k) for c, k in (("lengths", np.int64), ("words", np.int32), ("rows", rows_type)))
    return np.split(words, np.cumsum(lengths)[:-1]), rows.reshape(-1, 1 + len(PREFIXES)), np.array(batch.column("toxic")[i].as_py(), dtype=np.float64), batch.column("lang")[i].as_py()


SHARD = "shard int, held boolean, toxic array<int>, lang array<string>, lengths binary, words binary, rows binary"


def train(labelled: DataFrame, text_col: str = "text", label_col: str = "toxic", id_col: str = "doc_id", lang_col: str = "lang",
          shard_rows: int = 4000, seed: int = 10, least_language: int = 40, **options) -> ToxicityModel:
    """Train on all labelled rows.

    A shard has about ``shard_rows`` rows; more rows make more shards.  A fifth of the rows (by a seeded hash of the id) does not train but calibrates, on
    counts of logits rounded to 1/1024.  Null texts and labels take no part; with fewer than two
    classes the score is a constant.
    """
    rows = labelled.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(text_col).alias("text"), F.col(label_col).cast("int").alias("toxic"),
        F.coalesce(F.col(lang_col), F.lit("")).alias("lang"), F.xxhash64(F.lit(seed), F.col(id_col)).alias("h")).where("toxic IN (0, 1)")
    totals = {int(r["toxic"]): int(r["n"]) for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    shape, epochs = options.pop("shape", None) or Shape(), options.get("epochs", 8)
    if not totals.get(0) or not totals.get(1):
        empty = [np.zeros((w, shape.dims, shape.filters), np.float32) for w in shape.widths]
        flat = -3.0 if not totals.get(1) else 3.0
        return ToxicityModel(shape, np.zeros((shape.buckets, shape.dims), np.float32), empty,
                             [np.zeros(shape.filters, np.float32) for _ in shape.widths],
                             np.zeros(shape.filters * len(shape.widths), np.float32), flat)
    n, rows_type = sum(totals.values()), row_type(shape.buckets)
    count = -(-n // shard_rows)
    held = (F.pmod("h", F.lit(5)) == 4) if n >= 100 else F.lit(False)
    dealt = rows.withColumn("held", held).withColumn("shard", F.pmod(F.xxhash64("h"), F.lit(count)).cast("int"))

    def pack(table: pa.Table) -> pa.Table:
        hashed, known = WordRows(shape.buckets), {}
        order = sorted(zip(table.column("h").to_pylist(), table.column("toxic").to_pylist(), table.column("text").to_pylist(), table.column("lang").to_pylist()))
        texts = [np.array([known.setdefault(w, len(known)) for w in hashed.words(o[2])], np.int32) for o in order]
        vocabulary = hashed.of_words(list(known))
        return pa.table({"shard": table.column("shard").slice(0, 1), "held": table.column("held").slice(0, 1),
                         "toxic": pa.array([[o[1] for o in order]], pa.list_(pa.int32())), "lang": pa.array([[o[3] for o in order]], pa.list_(pa.string())),
                         "lengths": pa.array([np.array([len(t) for t in texts], np.int64).tobytes()], pa.binary()),
                         "words": pa.array([np.concatenate(texts).tobytes()], pa.binary()), "rows": pa.array([vocabulary.tobytes()], pa.binary())})

    shards = materialize(shipped(dealt).groupBy("shard", "held").applyInArrow(pack, SHARD), "toxicity-shards")
    sides = {r["held"]: r["n"] for r in shards.groupBy("held").agg(F.count("*").alias("n")).collect()}
    model = untrained(shape, totals[1] / n, np.random.default_rng(seed))
    # one shard is trained through in one task; several meet after every epoch
    for turns in [range(epochs)] if sides.get(False, 0) <= 1 else [range(e, e + 1) for e in range(epochs)]:
        if sides.get(False):
            model = _averaged(shards, model, turns, seed, options)

    def logits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                texts, words, y, lang = _unpacked(batch, i, rows_type)
                cell = np.rint(np.clip(shard_scores(model, texts, words), -60, 60) * 1024).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(y.astype(np.int32)), pa.array(cell)], ["lang", "toxic", "cell"])

    watch = shards.where(F.col("held") == F.lit(bool(sides.get(True))))
    cells = watch.mapInArrow(logits, "lang string, toxic int, cell long").groupBy("lang", "toxic", "cell").agg(
        F.count("*").alias("n")).orderBy("lang", "toxic", "cell").toPandas()  # at most one row per language, label and rounded logit
    z, y, w = cells["cell"].to_numpy() / 1024, cells["toxic"].to_numpy(dtype=np.float64), cells["n"].to_numpy(dtype=np.float64)
    model.scale, model.shift = _platt(z, y, w)
    s = sigmoid(model.scale * z + model.shift)
    model.threshold = best_threshold(s, y, w)
    lang = cells["lang"].to_numpy()
    for name in sorted(set(lang) - {""}):
        own = lang == name
        if w[own].sum() >= least_language and (w * y)[own].sum() >= 5:
            model.by_language[name] = best_threshold(s[own], y[own], w[own])
    return model


def scored(model: ToxicityModel, text: Column) -> Column:
    """Score in [0, 1] of a text column; a null or empty text is scored like any other text."""

    ship_package(SparkSession.active())

    @F.pandas_udf(T.DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = WordVectors(model)
        for texts in batches:
            out = np.empty(len(texts))
            for at in range(0, len(texts), 200):
                out[at : at + 200] = sigmoid(model.scale * known.logits(texts.iloc[at : at + 200]) + model.shift)
            yield pd.Series(out)

    return score(text)


def language_threshold(model: ToxicityModel, lang: Column) -> Column:
    """The calibrated threshold of a row's language, the common one for other languages."""
    out = F.lit(model.threshold)
    for name, t in model.by_language.items():
        out = F.when(lang == name, F.lit(t)).otherwise(out)
    return out
