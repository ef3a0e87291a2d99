"""Conversation trie, hard negatives and personal data against plain programs."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np

from valuora.llm import negatives, pii, queries, trie

CONV = "conv_id long, turn long, role string, text string"


# ---------------------------------------------------------------- op12
def plain_trie(rows):
    turns = defaultdict(list)
    for r in rows:
        if r["conv_id"] is not None:
            turns[r["conv_id"]].append((r["turn"] is not None, r["turn"] or 0, r["role"] or "", r["text"] or ""))
    turns = {c: [t[2:] for t in sorted(v)] for c, v in turns.items()}
    paths = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        donor = c - (c % 100 if c >= 0 else -(-c % 100))
        paths[c] = tuple(turns.get(donor, [])[:h] + own[h:])
    members, children = defaultdict(list), defaultdict(list)
    for c in sorted(paths):
        for d in range(len(paths[c]) + 1):
            members[paths[c][:d]].append(c)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved, out = {}, {}, set()
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in children[p]) if children[p] else 1
        saved[p] = sum(saved[k] for k in children[p]) + ((len(members[p]) - 1) * len(p[-1][1]) if p else 0)
        ends = ",".join(str(c) for c in members[p] if len(paths[c]) == len(p))
        out.add((members[p][0], len(p), members[p[:-1]][0] if p else None, len(members[p]), len(children[p]), leaves[p],
                 saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return out


NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def found_nodes(df):
    rows = [tuple(r) for r in df.select(*NODE).collect()]
    assert len(set(rows)) == len(rows)
    return set(rows)


def test_op12_equals_plain_trie(spark, sf_dir):
    rows = [r.asDict() for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()]
    assert found_nodes(queries.op12_conversation_trie(spark, sf_dir)) == plain_trie(rows)


def test_trie_edges_and_distributed_splits(spark):
    """Nulls, repeated rows and turns, absent donors, negative ids, copies, one very long conversation."""
    rng = random.Random(12)
    rows = [(c, t, rng.choice(["user", "bot", None]), rng.choice(["a", "bb", "", None, "é€"])) for c in range(-120, 260, 3) for t in range(rng.randrange(1, 7))]
    rows += [(300 + i, t, "user", f"same {t}") for i in range(40) for t in range(7)]  # copies of one conversation
    rows += [(777, t, "user", f"turn {t}") for t in range(500)]
    rows += [(5, None, "user", "first"), (5, 2, "user", "twice"), (5, 2, "user", "twice"), (None, 1, "user", "nobody"), (900, None, None, None)]
    df = spark.createDataFrame(rows, CONV).selectExpr("*", "1 AS depth", "'x' AS d", "2 AS n_convs")
    want = plain_trie([r.asDict() for r in df.collect()])
    assert found_nodes(trie.prefix_trie(df.repartition(7))) == want
    assert found_nodes(trie.prefix_trie(df, task_nodes=64)) == want  # split by Spark before tasks finish
    assert trie.prefix_trie(df.limit(0)).count() == 0


def test_centroid_sums_on_random_forests():
    rng = np.random.default_rng(4)
    for shape in ("random", "chain", "star"):
        n = 300
        parent = np.array([-1] + [{"random": int(rng.integers(0, i)), "chain": i - 1, "star": 0}[shape] for i in range(1, n)])
        parent[rng.integers(1, n, 5)] = -1
        depth = np.zeros(n, dtype=int)
        for i in range(n):
            depth[i] = 0 if parent[i] < 0 else depth[parent[i]] + 1
        values = rng.integers(0, 100, size=(n, 2))
        want = values.copy()
        for i in range(n - 1, 0, -1):
            if parent[i] >= 0:
                want[parent[i]] += want[i]
        mix = rng.permutation(n)  # any order of nodes
        place = np.argsort(mix)
        mixed = np.where(parent[mix] >= 0, place[parent[mix]], -1)
        assert (trie.centroid_sums(mixed, depth[mix], values[mix]) == want[mix]).all()
    assert trie.centroid_sums(np.zeros(0, dtype=int), np.zeros(0, dtype=int), np.zeros((0, 2), dtype=int)).shape == (0, 2)


# ---------------------------------------------------------------- op13
def plain_negatives(rows):
    """Rows as (id or None, label, integer vector); results as in the query."""
    width = max(len(v) for *_, v in rows)
    x = np.array([[*v, *[0] * (width - len(v))] for *_, v in rows], dtype=np.int64)
    label = np.array([(k + 1) % 10 if i is not None and i % 7 == 0 else k for i, k, _ in rows])
    key = np.array([i if i is not None else 1 << 62 for i, *_ in rows])
    out = []
    for a, (ident, *_) in enumerate(rows):
        if ident is None or ident % 100:
            continue
        score = x @ x[a]
        order = [i for i in np.lexsort((key, -score)) if i != a]
        negative = [i for i in order if label[i] != label[a]]
        for p in [i for i in order if label[i] == label[a]][:5]:
            window = [i for i in negative if 80 * score[p] <= 100 * score[i] <= 100 * score[p]][:5]
            out += [(ident, rows[p][0], r + 1, rows[i][0], int(score[p]), int(score[i])) for r, i in enumerate(window)]
    return sorted(out, key=str)


def test_op13_equals_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    plain = [(r["vec_id"], r["label"], [int(np.floor(256 * float(v))) for v in r["embedding"]]) for r in rows]
    got = sorted((tuple(r) for r in queries.op13_hard_negatives(spark, sf_dir).collect()), key=str)
    assert got == plain_negatives(plain)


def test_negatives_edges_and_shards(spark):
    rng = random.Random(13)
    rows = [(i, rng.randrange(3), [rng.randrange(-8, 9) / 256 for _ in range(4)]) for i in range(600)]
    rows += [(i, i % 2, [0.02, 0.03, 0.0, 0.01]) for i in range(600, 800)]  # one very common vector
    rows += [(200, 1, [0.02, 0.03]), (None, 2, [0.02, 0.03, 0.001, 0.01])]  # repeated id, no id, shorter vector
    odd = [(800, None, [1.0]), (801, 1, None), (802, 1, [None, 1.0]), (803, 1, [float("nan")]), (804, 1, [float("inf")])]
    schema = "vec_id long, label int, embedding array<double>"
    df = spark.createDataFrame(rows + odd, schema).selectExpr("*", "1 AS rank", "'x' AS cell", "2 AS shard")
    plain = plain_negatives([(i, k, [int(np.floor(256 * v)) for v in x]) for i, k, x in rows])
    keep = negatives.mining_rows(df)
    for options in ({}, {"shard_rows": 50, "block": 3, "words": 4}):
        got = sorted((tuple(r) for r in negatives.hard_negatives(keep, **options).collect()), key=str)
        # ties between rows of one id may name either
        assert [g[:3] + g[4:] for g in got] == [p[:3] + p[4:] for p in plain]
    assert negatives.hard_negatives(negatives.mining_rows(df.limit(0))).count() == 0


def test_multi_sequence_falls_and_bounds_hold():
    rng = np.random.default_rng(5)
    one, two = rng.normal(size=7), rng.normal(size=5)
    seen = list(negatives.multi_sequence(one, two))
    assert len({(i, j) for _, i, j in seen}) == 35 and all(a[0] >= b[0] for a, b in zip(seen, seen[1:]))
    rows = rng.integers(-50, 50, size=(400, 6)).astype(float)
    books = (negatives.codebook(rows[:, :3], 4), negatives.codebook(rows[:, 3:], 4))
    (i, d1), (j, d2) = negatives._nearest(rows[:, :3], books[0]), negatives._nearest(rows[:, 3:], books[1])
    radii = tuple(np.array([d[c == k].max(initial=0) for k in range(4)]) for c, d in ((i, d1), (j, d2)))
    index = negatives.MultiIndex(books, radii, {})
    for query in rows[:20]:
        a, b = index.bounds(query)
        assert (rows @ query <= a[i] + b[j]).all()


# ---------------------------------------------------------------- op11
PATTERNS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def passes(kind, value):
    digits = re.sub(r"[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(v - 9 if v > 9 else v for v in doubled) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def plain_spans(text):
    found = [(m.start(), n, k, m.end()) for n, (k, p) in enumerate(PATTERNS) for m in re.finditer(p, text) if passes(k, m[0])]
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(found))


def test_base_spans_equal_the_patterns():
    rng = random.Random(1)
    for n in range(20_000):
        signs = "a@.1+- %(2b.3é|@@1." if n % 2 else "0123456789 .-+@a"
        text = "".join(rng.choice(signs) for _ in range(rng.randint(0, 50)))
        assert ",".join(f"{k}:{a}:{b}" for k, a, b in pii.base_spans(text)) == plain_spans(text)
        pii.tokens(text, pii.base_spans(text))


def test_long_runs_take_linear_work():
    for run in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "a@" * 100_000, "+1 " * 100_000):
        pii.base_spans(run + "@")


def test_op11_base_part(spark, sf_dir, local_docs):
    rows = queries.op11_personal_data(spark, sf_dir).collect()
    assert len(rows) == len(local_docs)
    for r in rows:
        want = plain_spans(local_docs[r["doc_id"]]["text"] or "")
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert set(want.split(",")) <= set(r["spans"].split(","))
        for k, _ in PATTERNS:
            assert r[f"n_{k}"] == len(re.findall(rf"\b{k}:", want))


def test_contexts_find_unseen_identifiers(spark):
    docs = [(i, f"hello there. call me at +1 (0{i % 90 + 10}) 555-1{i:03d} any time. x") for i in range(40)]
    docs += [(i, f"please call me at 555-44-{1000 + i} any time. y") for i in range(40, 46)]
    docs += [(46, "the value at 12345678 in"), (47, None), (48, ""), (40, docs[0][1]), (None, "call me at 555-44-9999 any time.")]
    docs += [(50 + i, f"number {4000000000000000 + 37 * i} noted") for i in range(30)]  # most fail the check digit
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS start", "'x' AS kind", "2 AS _row", "'y' AS pattern")
    rows = pii.scan(df).collect()
    assert len(rows) == len(docs)
    found = {(r["doc_id"], r["spans"]) for r in rows if r["n_found"]}
    assert found == {(i, "found_phone:18:29") for i in range(40, 46)} | {(None, "found_phone:11:22")}
    assert {r["spans"] for r in rows if r["doc_id"] in (46, 47, 48)} == {""}
    learned = {r["pattern"]: r for r in pii.learn(pii.mentions(df)).collect()}
    assert set(learned) == {"me at _ |middle", "at _ any |middle"}
    assert all(r["kind"] == "phone" and r["confidence"] >= 0.75 for r in learned.values())
    assert pii.scan(df.limit(0)).count() == 0


def test_pattern_scores_equal_a_plain_program(spark):
    rng = random.Random(8)
    words = ["mail", "dial", "see", "ref"]
    docs = [(i, f"{rng.choice(words)} us {rng.choice(['+1 555 010 %04d' % rng.randrange(30), 'u%d@x.org' % rng.randrange(9), '55%05d' % rng.randrange(20)])} {rng.choice(['now', 'soon'])}") for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = pii.mentions(df)
    edges = {(p, m["value"], m["kind"]) for r in rows.collect() for m in r["mentions"] for p in m["patterns"]}
    useful = {p for p, _, k in edges if k}
    edges = {e for e in edges if e[0] in useful}
    score = {}
    for last in (False, False, True):
        kept = {}
        for p in useful:
            by = defaultdict(list)
            for q, v, k in edges:
                if q == p:
                    if k:
                        by[k].append(1.0)
                    else:
                        for kind, s in score.get(v, {}).items():
                            by[kind].append(s)
            kind, s = max(by.items(), key=lambda x: (sum(x[1]), x[0]))
            n = len({v for q, v, _ in edges if q == p})
            conf = sum(s) / (n + 2.0)
            if sum(x >= 0.5 for x in s) >= 5 and conf >= (0.75 if last else 0.6):
                kept[p] = (kind, conf)
        score = {}
        for q, v, k in edges:
            if not k and q in kept:
                kind, conf = kept[q]
                old = score.setdefault(v, {}).get(kind, 0.0)
                score[v][kind] = 1 - (1 - old) * (1 - conf)
    got = {r["pattern"]: (r["kind"], r["confidence"]) for r in pii.learn(rows).collect()}
    assert got.keys() == kept.keys()
    assert all(got[p][0] == kept[p][0] and abs(got[p][1] - kept[p][1]) < 1e-9 for p in kept)
