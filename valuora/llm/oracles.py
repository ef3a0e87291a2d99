"""DuckDB SQL for the queries that SQL can express whole on small tables."""

from __future__ import annotations

#: Rows without a null or non-finite component, each number ``scale`` times and floored.
_VECTORS = """
good AS (
  SELECT row_number() OVER () AS r, vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
),
parts AS (
  SELECT r, unnest(range(len(embedding))) AS i, floor({scale} * CAST(unnest(embedding) AS DOUBLE)) AS x FROM good
)"""

_TOPK = "WITH" + _VECTORS.format(scale=64) + """,
scores AS (
  SELECT a.r AS q, b.r AS c, CAST(sum(a.x * b.x) AS BIGINT) AS score
  FROM parts a JOIN good g ON g.r = a.r AND g.vec_id % 20 = 0 JOIN parts b ON b.i = a.i AND b.r <> a.r
  GROUP BY a.r, b.r
),
ranked AS (
  SELECT q, c, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, n.vec_id) AS rank
  FROM scores JOIN good n ON n.r = c
)
SELECT o.vec_id AS query_id, CAST(rank AS INTEGER) AS rank, n.vec_id AS vec_id, score
FROM ranked JOIN good o ON o.r = q JOIN good n ON n.r = c WHERE rank <= 20
"""

_NEGATIVES = "WITH" + _VECTORS.format(scale=256) + """,
rated AS (
  SELECT r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label FROM good WHERE label IS NOT NULL
),
scores AS (
  SELECT a.r AS q, b.r AS c, CAST(sum(a.x * b.x) AS BIGINT) AS score
  FROM parts a JOIN rated g ON g.r = a.r AND g.vec_id % 100 = 0 JOIN parts b ON b.i = a.i AND b.r <> a.r
  GROUP BY a.r, b.r
),
pairs AS (
  SELECT q, c, o.vec_id AS anchor_id, n.vec_id AS other_id, o.label = n.label AS same, score
  FROM scores JOIN rated o ON o.r = q JOIN rated n ON n.r = c
),
positives AS (
  SELECT * FROM pairs WHERE same QUALIFY row_number() OVER (PARTITION BY q ORDER BY score DESC, other_id) <= 5
),
negatives AS (
  SELECT p.anchor_id, p.other_id AS positive_id, n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.q, p.c ORDER BY n.score DESC, n.other_id) AS rank
  FROM positives p JOIN pairs n ON n.q = p.q AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 5
"""

ORACLES: dict[str, str] = {"op9_exact_topk": _TOPK, "op13_hard_negatives": _NEGATIVES}
