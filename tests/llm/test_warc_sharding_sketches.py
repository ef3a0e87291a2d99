"""WARC index, jump sharding, sketches and exact search against brute force."""

import base64
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from valuora.llm import fingerprints, queries, sharding, topk, warc

PAGE = "page_id long, url string, html string"


def plain_pages(rows, min_bytes=0):
    """rows: (page_id, html) -> {page_id: (bytes, digest, type, refers_to)}."""
    first = {}
    for page, html in rows:
        data = (html or "").encode()
        if page is not None:
            first[data] = min(page, first.get(data, page))
    out = {}
    for page, html in rows:
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        again = len(data) >= min_bytes and data in first and first[data] != page
        out[page] = (len(data), digest, "revisit" if again else "response", first[data] if again else None)
    return out


def seen(df):
    return {r["page_id"]: (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in df.collect()}


def test_op4_equals_brute_force(spark, sf_dir):
    rows = [(r["page_id"], r["html"]) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    got = queries.op4_warc_index(spark, sf_dir)
    assert got.count() == len(rows)
    assert seen(got) == plain_pages(rows)


@pytest.fixture(scope="module")
def odd_pages(spark):
    rows = [
        (3, "http://www.Example.com:80/a?b=1#f", "<p>same é</p>"), (1, "https://example.com/a", "<p>same é</p>"),
        (2, None, None), (4, "http://[broken", ""), (5, "http://www.example.com/a?b=1", "x" * 300_000), (None, "u", "<p>same é</p>"),
        (6, "http://www.example.com/a?b=1", "line\r\n\r\nWARC/1.1\r\n"), (7, "two\r\nlines", "last"),
    ]
    rows += [(100 + i, "http://hot.example.org/one", f"body {i % 40}") for i in range(200)]
    return spark.createDataFrame(rows, PAGE).selectExpr("*", "'z' AS file", "1 AS offset", "'q' AS key")


def test_warc_round_trip_and_edges(spark, odd_pages):
    captures, directory, archives, index = warc.archive(odd_pages)
    rows = [(r["page_id"], r["html"]) for r in odd_pages.collect()]
    back = warc.read_records(captures, archives, payloads=True)
    assert seen(back) == plain_pages(rows) and back.count() == len(rows)
    html = {r["page_id"]: r["html"] for r in back.where("record_type = 'response'").collect()}
    want = dict(rows)
    assert all(html[p] == (want[p] or "") for p in html)
    # through the index: one hot key, two captures of one URL, a missing key
    ask = [warc.url_key(u) for u in ("http://hot.example.org/one", "http://www.example.com/a?b=1", "http://none.org/")]
    keys = spark.createDataFrame([(k,) for k in ask + ask[:1]], "key string")
    found = warc.lookup(keys, directory, index).collect()
    assert Counter(r["key"] for r in found) == {ask[0]: 200, ask[1]: 3}
    assert len({r["page_id"] for r in found}) == 203


def test_small_payloads_are_responses(odd_pages):
    rows = [(r["page_id"], r["html"]) for r in odd_pages.collect()]
    got = {r["page_id"]: r["record_type"] for r in warc.choose_records(odd_pages, min_bytes=8).collect()}
    assert got == {p: v[2] for p, v in plain_pages(rows, 8).items()}


def test_index_blocks_are_searched_across_borders(spark):
    captures = spark.range(500).selectExpr("id AS page_id", "concat('k', lpad(CAST(id DIV 7 AS STRING), 3, '0')) AS key",
                                           "'f' AS file", "id AS offset", "1L AS length")
    folder = warc.scratch_path(spark, "warc-blocks")
    directory = warc.write_index(captures, folder, block_lines=5)
    assert directory.count() >= 100
    found = warc.lookup(captures.select("key"), directory, folder).collect()
    assert sorted(r["page_id"] for r in found) == list(range(500))


def test_empty_archive(spark):
    none = spark.createDataFrame([], PAGE)
    captures, directory, archives, index = warc.archive(none)
    assert captures.count() == 0 and directory.count() == 0
    assert warc.lookup(spark.createDataFrame([("k",)], "key string"), directory, index).count() == 0
    assert warc.read_records(captures, archives).count() == 0


@pytest.mark.parametrize("url,key", [
    ("http://www.Example.com:80/a?b=1#f", "com,example,www)/a?b=1"), ("https://u:p@b.org:8443", "org,b:8443)/"), (None, ")/")])
def test_url_key(url, key):
    assert warc.url_key(url) == key


def plain_jump(key, shards):
    b, j, key = -1, 0, key % (1 << 64)
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


@pytest.mark.parametrize("shards", [1, 2, 16, 17, 50])
def test_jump_hash_equals_the_published_loop(spark, shards):
    rng = random.Random(shards)
    keys = [0, 1, -1, (1 << 63) - 1, -(1 << 63)] + [rng.getrandbits(64) - (1 << 63) for _ in range(200)]
    df = spark.createDataFrame([(k,) for k in keys], "k long").select("k", sharding.jump_hash(F.col("k"), shards).alias("s"))
    assert [r["s"] for r in df.collect()] == [plain_jump(k, shards) for k in keys]


def check_shards(rows, texts):
    slots = defaultdict(list)
    for r in rows:
        assert r["grown_shard"] in (r["shard"], 16) and r["law"] == "key"
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in texts)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want


def test_op5_slots_and_growth(spark, sf_dir, local_docs):
    rows = queries.op5_jump_sharding(spark, sf_dir).collect()
    check_shards(rows, [(d, r["text"]) for d, r in local_docs.items()])


def test_sharding_edges(edge_docs, no_docs):
    rows = sharding.shard(edge_docs).collect()
    check_shards(rows, [(r["doc_id"], r["text"]) for r in edge_docs.collect()])
    one = {r["shard"] for r in rows if r["doc_id"] == 1}
    assert len(one) == 1 and sharding.shard(no_docs).count() == 0
    with pytest.raises(ValueError):
        sharding.jump_hash(F.lit(1), 0)


def plain_shingles(text, n=5):
    words = (text or "").encode().split()
    if not words:
        return set()
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_op8_texts_and_estimates(spark, sf_dir, local_docs):
    rows = {r["doc_id"]: r for r in queries.op8_bottom_k_fingerprints(spark, sf_dir).collect()}
    order = sorted(local_docs)
    assert rows.keys() == local_docs.keys()
    by_text, errors = {}, []
    for doc, after in zip(order, order[1:] + order[:1]):
        text, following = local_docs[doc]["text"] or "", local_docs[after]["text"] or ""
        m = len(text) // 4
        edited = text[: len(text) - m] + following[:m]
        r = rows[doc]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert by_text.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        a = plain_shingles(text)
        errors += [r["near_edited"] - jaccard(a, plain_shingles(edited)), r["near_next"] - jaccard(a, plain_shingles(following))]
    assert abs(np.mean(errors)) < 0.01 and np.max(np.abs(errors)) < 0.3


def test_sketch_edges(edge_docs, no_docs):
    rows = fingerprints.compare_with_next(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    by = {r["doc_id"]: r for r in rows}
    assert by[5]["n_chars"] == 0 and by[5]["sketch"] == [] and by[6]["sketch"] == []
    assert by[4]["near_next"] == 1.0 and by[5]["near_edited"] == 1.0  # empty against empty
    assert by[1]["sketch"] == by[2]["sketch"] and by[9]["n_chars"] == 20000
    # the row without id comes last and wraps to the first
    first = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    assert by[None]["edited_sha256"] == hashlib.sha256(("no id he" + first[:2]).encode()).hexdigest()
    assert fingerprints.compare_with_next(no_docs).count() == 0
    alone = fingerprints.compare_with_next(edge_docs.where("doc_id = 7")).first()
    assert alone["near_next"] == 1.0


def test_sketches_merge_and_estimate(spark):
    rng = random.Random(8)
    words = [f"w{rng.randrange(10**6)}" for _ in range(3000)]
    parts = [(1, " ".join(words[:1504])), (1, " ".join(words[1500:])), (2, " ".join(words[:2000])), (3, "tiny text")]
    df = fingerprints.add_sketch(spark.createDataFrame(parts, "id int, text string"), "text", "s", 256)
    merged = fingerprints.merge_parts(df.select("id", "s"), ["id"], "s", 256)
    whole = fingerprints.add_sketch(spark.createDataFrame([(" ".join(words),)], "text string"), "text", "s", 256).first()["s"]
    got = {r["id"]: r["s"] for r in merged.collect()}
    assert got[1] == whole
    pair = merged.where("id = 2").select(F.col("s").alias("a")).crossJoin(merged.where("id = 1").select(F.col("s").alias("b")))
    r = pair.select(fingerprints.resemblance(F.col("a"), F.col("b"), 256).alias("r"),
                    fingerprints.containment(F.col("a"), F.col("b"), 256).alias("c"),
                    fingerprints.distinct_shingles(F.col("b"), 256).alias("n")).first()
    assert abs(r["r"] - 1996 / 2996) < 0.12 and abs(r["c"] - 1) < 0.15 and abs(r["n"] - 2996) < 600
    small = merged.where("id = 3").select(fingerprints.distinct_shingles(F.col("s"), 256).alias("n")).first()
    assert small["n"] == 1


def plain_topk(vectors, every=20, k=20):
    out = {}
    for q, x in vectors.items():
        if q % every == 0:
            ranked = sorted((-sum(a * b for a, b in zip(x, y)), c) for c, y in vectors.items() if c != q)[:k]
            out[q] = [(i + 1, c, -s) for i, (s, c) in enumerate(ranked)]
    return out


def found_topk(df):
    out = defaultdict(list)
    for r in df.collect():
        out[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    return {q: sorted(v) for q, v in out.items()}


def test_op9_equals_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    vectors = {r["vec_id"]: [int(np.floor(64 * float(x))) for x in r["embedding"]] for r in rows}
    assert found_topk(queries.op9_exact_topk(spark, sf_dir)) == plain_topk(vectors)


def test_topk_blocks_ties_and_edges(spark):
    rng = random.Random(9)
    rows = [(i, [float(rng.randrange(-3, 4)) / 64 for _ in range(rng.randrange(1, 6))]) for i in range(400)]
    rows += [(i, [0.5, 0.5]) for i in range(400, 700)]  # one very common vector
    odd = [(900, None), (901, [1.0, None]), (902, [float("nan")]), (903, [float("inf")]), (940, [])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").selectExpr("*", "1 AS rank", "2 AS score")
    vectors = {i: [int(np.floor(64 * x)) for x in v] for i, v in rows} | {940: []}
    for options in ({}, {"query_block": 7, "candidate_block": 50, "tile": 16}):
        assert found_topk(topk.search(topk.quantized(df), **options)) == plain_topk(vectors)
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<double>")
    assert found_topk(topk.search(topk.quantized(few))) == {0: [(1, 1, 8192)]}
    assert topk.search(topk.quantized(few.limit(0))).count() == 0
    # repeated ids are rows of their own, a row without id is a candidate behind equal scores
    twice = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (1, [3.0]), (None, [2.0]), (0, [1.0])], "vec_id long, embedding array<double>")
    for own in (topk.search(topk.quantized(twice), candidate_block=2, tile=1), topk.search(topk.quantized(twice))):
        ranked = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in own.fillna(-1, ["vec_id"]).collect())
        assert ranked == sorted(2 * [(0, 1, 1, 12288), (0, 2, 1, 8192), (0, 3, -1, 8192), (0, 4, 0, 4096)])


def test_scores_beyond_exact_doubles():
    a, b = np.array([[float(1 << 40), 3.0]]), np.array([[float(1 << 40), 1.0], [0.0, 5.0]])
    assert topk.accumulate(a, b).tolist() == [[(1 << 80) + 3, 15]]
