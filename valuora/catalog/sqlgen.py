"""Small helpers to write the DuckDB oracle text (generated from lists)."""

from __future__ import annotations

import re
from collections.abc import Sequence


def long_sql(source: str, features: Sequence[str], where: str = "TRUE", value: str = "x", cast: str = "DOUBLE") -> str:
    """UNION ALL unpivot that keeps null values (DuckDB's UNPIVOT drops them)."""
    parts = [
        f"SELECT '{f}' AS feature, CAST({f} AS {cast}) AS {value} FROM {source} WHERE {where}"
        for f in features
    ]
    return "\nUNION ALL ".join(parts)


def values_sql(names: Sequence[str], column: str = "feature") -> str:
    rows = ", ".join(f"('{n}')" for n in names)
    return f"(VALUES {rows}) AS spine({column})"


def probs_sql(bins: int) -> str:
    return "[" + ", ".join(repr(i / bins) for i in range(bins + 1)) + "]"


def psi_sql(ref_cte: str, cur_cte: str, features: Sequence[str], bins: int = 10, prefix: str = "") -> str:
    """CTE text computing ``<prefix>psi_out(feature, psi)`` from two long CTEs."""
    text = f"""
edges AS (
  SELECT feature, count(x) AS n_ref, min(x) AS first_value,
         list_sort(list_distinct(quantile_cont(x, {probs_sql(bins)}))) AS u
  FROM {ref_cte} WHERE x IS NOT NULL GROUP BY feature
),
edges2 AS (
  SELECT feature, n_ref, first_value, len(u) AS n_edges,
         CASE WHEN len(u) >= 3 THEN list_slice(u, 2, len(u) - 1) END AS inner_edges
  FROM edges
),
ref_bins AS (
  SELECT r.feature, len(list_filter(e.inner_edges, lambda t: t <= r.x)) AS bin, count(*) AS n
  FROM {ref_cte} r JOIN edges2 e ON r.feature = e.feature
  WHERE r.x IS NOT NULL AND e.inner_edges IS NOT NULL GROUP BY 1, 2
),
cur_bins AS (
  SELECT r.feature, len(list_filter(e.inner_edges, lambda t: t <= r.x)) AS bin, count(*) AS n
  FROM {cur_cte} r JOIN edges2 e ON r.feature = e.feature
  WHERE r.x IS NOT NULL AND e.inner_edges IS NOT NULL GROUP BY 1, 2
),
ref_sh AS (SELECT feature, bin, n / sum(n) OVER (PARTITION BY feature) AS s FROM ref_bins),
cur_sh AS (SELECT feature, bin, n / sum(n) OVER (PARTITION BY feature) AS s FROM cur_bins),
psi_binned AS (
  SELECT coalesce(a.feature, b.feature) AS feature,
         sum((greatest(coalesce(b.s, 0.0), 1e-6) - greatest(coalesce(a.s, 0.0), 1e-6))
             * ln(greatest(coalesce(b.s, 0.0), 1e-6) / greatest(coalesce(a.s, 0.0), 1e-6))) AS psi_binned
  FROM ref_sh a FULL OUTER JOIN cur_sh b ON a.feature = b.feature AND a.bin = b.bin
  GROUP BY 1
),
cur_stats AS (
  SELECT c.feature, count(*) AS n_cur,
         avg(CASE WHEN abs(c.x - e.first_value) <= 1e-8 + 1e-5 * abs(e.first_value) THEN 0.0 ELSE 1.0 END) AS outside_rate
  FROM {cur_cte} c JOIN edges2 e ON c.feature = e.feature WHERE c.x IS NOT NULL GROUP BY 1
),
psi_out AS (
  SELECT spine.feature,
         CASE WHEN coalesce(e.n_ref, 0) = 0 THEN NULL
              WHEN coalesce(s.n_cur, 0) = 0 THEN NULL
              WHEN e.n_edges < 3 THEN s.outside_rate
              ELSE coalesce(p.psi_binned, 0.0) END AS psi
  FROM {values_sql(features)}
  LEFT JOIN edges2 e ON e.feature = spine.feature
  LEFT JOIN cur_stats s ON s.feature = spine.feature
  LEFT JOIN psi_binned p ON p.feature = spine.feature
)"""
    for name in ("edges2", "edges", "ref_bins", "cur_bins", "ref_sh", "cur_sh", "psi_binned", "cur_stats", "psi_out"):
        text = re.sub(rf"\b{name}\b", f"{prefix}{name}", text)
    return text


def missing_sql(long_cte: str, name: str) -> str:
    return f"SELECT feature, avg(CASE WHEN x IS NULL THEN 1.0 ELSE 0.0 END) AS {name} FROM {long_cte} GROUP BY feature"


def windowed_report_sql(base: str, numeric: Sequence[str], categorical: Sequence[str], bounds, bins: int = 10) -> str:
    """The drift report by window, feature by feature, from ``base`` (columns, ``is_ref``, ``window_start``)."""
    parts = []
    for section, f in [("numeric", f) for f in numeric] + [("prediction_shift", "predicted_price")]:
        x = f"CAST({f} AS DOUBLE)"
        parts.append(f"""
SELECT window_start, '{section}' AS section, '{f}' AS feature, 'psi' AS metric, value FROM (
  WITH e AS (SELECT list_sort(list_distinct(quantile_cont({x}, {probs_sql(bins)}))) AS u, count({x}) AS n_ref FROM {base} WHERE is_ref),
  cut AS (SELECT is_ref, window_start, {x} AS x, u, n_ref, len(u) AS k,
            CASE WHEN len(u) >= 3 THEN len(list_filter(list_slice(u, 2, len(u) - 1), lambda t: t <= {x})) ELSE 0 END AS b
          FROM {base}, e),
  ref AS (SELECT b, count(x) / any_value(n_ref) AS s FROM cut WHERE is_ref AND x IS NOT NULL GROUP BY b),
  wins AS (SELECT window_start, count(x) AS n_cur, any_value(n_ref) AS n_ref, any_value(k) AS k,
             avg(CASE WHEN x IS NULL THEN NULL WHEN abs(x - u[1]) <= 1e-8 + 1e-5 * abs(u[1]) THEN 0.0 ELSE 1.0 END) AS outside
           FROM cut WHERE NOT is_ref GROUP BY window_start),
  cur AS (SELECT window_start, b, count(*) AS n FROM cut WHERE NOT is_ref AND x IS NOT NULL GROUP BY 1, 2),
  grid AS (SELECT w.*, g.b FROM wins w, (SELECT unnest(range({bins})) AS b) g WHERE g.b < w.k - 1),
  score AS (SELECT g.window_start, sum((greatest(coalesce(c.n, 0) / g.n_cur, 1e-6) - greatest(coalesce(r.s, 0.0), 1e-6))
                  * ln(greatest(coalesce(c.n, 0) / g.n_cur, 1e-6) / greatest(coalesce(r.s, 0.0), 1e-6))) AS psi
            FROM grid g LEFT JOIN cur c ON c.window_start = g.window_start AND c.b = g.b LEFT JOIN ref r ON r.b = g.b GROUP BY 1)
  SELECT w.window_start, CASE WHEN w.n_ref = 0 OR w.n_cur = 0 THEN NULL WHEN w.k < 3 THEN w.outside ELSE s.psi END AS value
  FROM wins w LEFT JOIN score s ON s.window_start = w.window_start) t""")
    by = "FROM {b} WHERE NOT is_ref GROUP BY window_start".format(b=base)
    for f in numeric:
        parts.append(f"SELECT window_start, 'numeric', '{f}', 'current_missing_rate', avg(CASE WHEN {f} IS NULL THEN 1.0 ELSE 0.0 END) {by}")
        parts.append(f"SELECT window_start, 'numeric', '{f}', 'reference_missing_rate', "
                     f"(SELECT avg(CASE WHEN {f} IS NULL THEN 1.0 ELSE 0.0 END) FROM {base} WHERE is_ref) {by}")
    for f in categorical:
        novel = (f"coalesce(avg(CASE WHEN {f} IS NULL THEN NULL WHEN CAST({f} AS VARCHAR) IN (SELECT DISTINCT CAST({f} AS VARCHAR) FROM {base} "
                 f"WHERE is_ref AND {f} IS NOT NULL) THEN 0.0 ELSE 1.0 END), 0.0)")
        parts.append(f"SELECT window_start, 'categorical', '{f}', 'novel_category_rate', {novel} {by}")
        parts.append(f"SELECT window_start, 'categorical', '{f}', 'current_missing_rate', avg(CASE WHEN {f} IS NULL THEN 1.0 ELSE 0.0 END) {by}")
    for f, (lo, hi) in bounds.items():
        parts.append(f"SELECT window_start, 'range_violations', '{f}', 'violation_rate', "
                     f"avg(CASE WHEN CAST({f} AS DOUBLE) < {lo} OR CAST({f} AS DOUBLE) > {hi} THEN 1.0 ELSE 0.0 END) {by}")
    parts.append(f"SELECT window_start, 'prediction_shift', 'predicted_price', 'current_mean', avg(predicted_price) {by}")
    parts.append(f"SELECT window_start, 'prediction_shift', 'predicted_price', 'reference_mean', (SELECT avg(predicted_price) FROM {base} WHERE is_ref) {by}")
    parts.append(f"SELECT window_start, 'delayed_label_performance', NULL, 'log_rmse', sqrt(avg(pow(ln(1 + actual_price) - ln(1 + predicted_price), 2))) {by}")
    parts.append(f"SELECT window_start, 'delayed_label_performance', NULL, 'dollar_mae', avg(abs(actual_price - predicted_price)) {by}")
    union = "\nUNION ALL ".join(parts)
    return f"SELECT window_start, section, feature, metric, round(value, 6) AS value FROM ({union}) r"
