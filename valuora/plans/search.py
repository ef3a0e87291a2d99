"""Model-based parameter search (M13): trials are drawn where good trials are dense and others are not.

Every parameter is mapped to [0, 1] (logarithmic where its range says so).  After a random start, the
finished trials are parted into the best 15 % and the rest; each side gives a density per parameter, a
mixture of one kernel per trial, as wide as the gap to its neighbours, and one flat kernel.  Of points drawn
from the good side's densities the one with the highest ratio of both is tried next.  Trials come in batches,
and a batch is one grid for :func:`valuora.plans.models.cv_grid`, so its trials share each fold's rows
and binned store.  The driver holds finished trials only.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Estimator
from pyspark.sql import DataFrame

from valuora.plans import models as MD


@dataclass(frozen=True)
class Range:
    """A parameter between ``low`` and ``high`` (both possible); ``log``: equal factors are equally likely."""

    low: float
    high: float
    log: bool = False
    whole: bool = False

    def value(self, u: float):
        low, high = (self.low - 0.5, self.high + 0.5) if self.whole else (self.low, self.high)
        if self.log:
            x = math.exp(math.log(low) + u * (math.log(high) - math.log(low)))
        else:
            x = low + u * (high - low)
        x = min(max(round(x) if self.whole else x, self.low), self.high)
        return int(x) if self.whole else float(x)


#: The search ranges of the boosted trees.
BOOSTER_RANGES = {"rounds": Range(300, 2000, whole=True), "rate": Range(0.005, 0.2, log=True), "maxDepth": Range(3, 8, whole=True),
                  "columnShare": Range(0.4, 1.0), "l2": Range(1e-3, 10.0, log=True)}


class _Density:
    """One axis: kernels at the trials, each as wide as its larger gap, and a flat one."""

    def __init__(self, at: np.ndarray) -> None:
        self.at = np.sort(at)
        walls = np.concatenate([[0.0], self.at, [1.0]])
        gaps = np.diff(walls)
        self.width = np.clip(np.maximum(gaps[:-1], gaps[1:]), 1.0 / (1 + len(at)) / 4, 0.5)

    def log(self, u: np.ndarray) -> np.ndarray:
        z = (u[:, None] - self.at) / self.width
        cdf = np.vectorize(lambda t: 0.5 * (1 + math.erf(t / math.sqrt(2))))
        mass = cdf((1 - self.at) / self.width) - cdf(-self.at / self.width)
        kernels = np.exp(-0.5 * z**2) / (self.width * math.sqrt(2 * math.pi) * mass)
        return np.log((kernels.sum(axis=1) + 1.0) / (len(self.at) + 1))

    def draw(self, n: int, rng: np.random.Generator) -> np.ndarray:
        which = rng.integers(0, len(self.at) + 1, n)
        u = rng.random(n)
        for i in np.flatnonzero(which < len(self.at)):
            x = rng.normal(self.at[which[i]], self.width[which[i]])
            while not 0 <= x <= 1:  # the kernel is cut at the walls
                x = rng.normal(self.at[which[i]], self.width[which[i]])
            u[i] = x
        return u


def suggest(tried: np.ndarray, scores: Sequence[float], n: int, rng: np.random.Generator, good: float = 0.15, candidates: int = 24) -> np.ndarray:
    """``n`` points in the unit cube (``tried``: finished points; low scores are good, non-finite ones are worst).

    Whole points compete: one axis at a time, the ratio would favour values at the edge of what was tried.
    """
    order = np.argsort(np.where(np.isfinite(scores), scores, np.inf), kind="stable")
    best = max(1, math.ceil(good * len(order)))
    sides = [(_Density(tried[order[:best], j]), _Density(tried[order[best:], j])) for j in range(tried.shape[1])]
    out = np.empty((n, tried.shape[1]))
    for i in range(n):
        points = np.column_stack([near.draw(candidates, rng) for near, _ in sides])
        ratio = sum(near.log(u) - rest.log(u) for u, (near, rest) in zip(points.T, sides))
        out[i] = points[np.argmax(ratio)]
    return out


def search(evaluate: Callable[[list[dict]], Sequence[float]], ranges: Mapping[str, Range], trials: int, seed: int, batch: int = 5, start: int = 10) -> list[dict]:
    """All trials in order, ``{"params", "score"}``; ``evaluate`` scores a batch.  The same seed and scores give the same trials."""
    rng, names = np.random.default_rng(seed), list(ranges)
    points, scores, out = np.empty((0, len(names))), [], []
    while len(scores) < trials:
        n = min(batch, trials - len(scores))
        if len(scores) < start:
            n = min(n, start - len(scores))
            new = rng.random((n, len(names)))
        else:
            new = suggest(points, scores, n, rng)
        params = [{name: ranges[name].value(u) for name, u in zip(names, point)} for point in new]
        found = [float(s) for s in evaluate(params)]
        points, scores = np.concatenate([points, new]), scores + found
        out += [{"params": p, "score": s} for p, s in zip(params, found)]
    return out


def booster_search(df: DataFrame, preprocessor: Callable[[], Estimator], fold_col: str, k: int, trials: int = 25, seed: int = 42, batch: int = 5,
                   ranges: Mapping[str, Range] = BOOSTER_RANGES) -> list[dict]:
    """Boosted trees by mean CV log RMSE; a batch is one grid over shared folds."""
    booster = MD.HistogramBooster(seed=seed)

    def evaluate(batch_params: list[dict]) -> list[float]:
        grid = [{booster.getParam(name): v for name, v in p.items()} for p in batch_params]
        rows = MD.summarize_cv(MD.cv_grid(df, preprocessor, {"GradientBoosting": (booster, grid)}, fold_col, k)).collect()
        mean = {r["map_index"]: r["log_rmse_mean"] for r in rows}
        return [mean[i] if mean.get(i) is not None else math.inf for i in range(len(grid))]

    return search(evaluate, ranges, trials, seed, batch)
