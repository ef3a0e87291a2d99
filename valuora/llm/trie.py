"""Prefix trie of conversations, rolled up by centroid decomposition.

A node is a distinct sequence of first turns; it is named by its smallest member
conversation and its depth, which no other node shares.  Prefixes are compared by a
128-bit hash that adds up over (position, turn) pairs, so a long conversation is
hashed in pieces, by the tasks that hold its turns.

Subtree sums come from the centroid decomposition of the parent-edge forest: a
component is split at its centroid (the lowest node that holds at least half of the
component below it), the total below the centroid is added to every node on the
path from the centroid to the component's top, and the parts (one under each child
of the centroid, one above it) are split again.  Components halve, so a node takes
part in a logarithmic number of splits, whatever the trie's depth.  Components of
more than ``task_nodes`` nodes are split by Spark, all of them at once; smaller ones
are finished inside tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from valuora.llm.common import materialize, shipped

INDEX = (1 << 33) - 1  # the row part of monotonically_increasing_id
EMPTY = hashlib.sha256(b"").hexdigest()


def mixed(a: np.ndarray, b: np.ndarray, position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit words that stand for (turn digest, position); a prefix is the xor of its words."""
    with np.errstate(over="ignore"):
        x = a + position * np.uint64(0x9E3779B97F4A7C15)
        y = b ^ (position * np.uint64(0xC2B2AE3D27D4EB4F))
        for _ in range(3):  # each half stirs the other
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9) + y
            y = (y ^ (y >> np.uint64(27))) * np.uint64(0x94D049BB133111EB) ^ x
        return x ^ (x >> np.uint64(31)), y ^ (y >> np.uint64(31))


def _offsets(parts: DataFrame, column: str = "_part") -> DataFrame:
    """Rows before each partition: one row per partition of a range-partitioned table."""
    sizes = sorted((r[column], r["count"]) for r in parts.groupBy(column).count().collect())
    rows, total = [], 0
    for part, size in sizes:
        rows.append((part, total))
        total += size
    return F.broadcast(parts.sparkSession.createDataFrame(rows, f"{column} int, _before long"))


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, place, d, n_chars)`` of every turn with a conv_id.

    ``place`` numbers all turns by conv_id, turn (null first), role, text; nulls in role
    and text are empty.  A long conversation spans partitions; only one count per
    partition is collected.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"),
        F.monotonically_increasing_id().alias("_salt"))  # spreads equal rows
    keys = ["conv_id", "turn", "role", "text", "_salt"]
    digest = F.substring(F.unhex(F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256)), 1, 16)
    parts = materialize(
        rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select(
            "conv_id", digest.alias("d"), F.length("text").cast("long").alias("n_chars"),
            F.monotonically_increasing_id().alias("_id"), F.spark_partition_id().alias("_part")), "trie-turns")
    place = F.col("_before") + F.col("_id").bitwiseAND(F.lit(INDEX))
    return parts.join(_offsets(parts), "_part").select("conv_id", place.alias("place"), "d", "n_chars")


def rebuilt_turns(turns: DataFrame, century: int = 100, most: int = 6) -> DataFrame:
    """``(conv_id, pos, len, d, n_chars)`` of every rebuilt conversation, and its row at pos 0.

    The first h original turns of conversation ``c - c % century`` (h = crc32 of the decimal
    conv_id, modulo ``most``), then the conversation's own turns after its first h.
    """
    convs = turns.groupBy("conv_id").agg(F.min("place").alias("start"), F.count("*").alias("n"))
    first = turns.where(F.col("conv_id") % century == 0)
    heads = first.join(convs.select("conv_id", "start"), "conv_id").withColumn("pos", F.col("place") - F.col("start") + 1)
    heads = heads.where(F.col("pos") < most).groupBy(F.col("conv_id").alias("donor")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "d", "n_chars"))).alias("heads"))
    plan = convs.withColumn("donor", F.col("conv_id") - F.col("conv_id") % century).withColumn(
        "h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).join(heads, "donor", "left")
    plan = plan.withColumn("k", F.when(F.col("heads").isNull(), 0).otherwise(F.least(F.col("h"), F.size("heads"))).cast("long"))
    plan = plan.withColumn("len", F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    plan = materialize(plan.select("conv_id", "start", "h", "k", "len", F.slice("heads", F.lit(1), F.col("k").cast("int")).alias("heads")), "trie-plan")
    pos = F.col("place") - F.col("start") + 1
    own = turns.join(plan.drop("heads"), "conv_id").where(pos > F.col("h")).select(
        "conv_id", (pos - F.col("h") + F.col("k")).alias("pos"), "len", "d", "n_chars")
    given = plan.where("k > 0").select("conv_id", "len", F.explode("heads").alias("t")).select(
        "conv_id", "t.pos", "len", "t.d", "t.n_chars")
    top = plan.select("conv_id", F.lit(0).cast("long").alias("pos"), "len", F.lit(bytes(16)).alias("d"), F.lit(0).cast("long").alias("n_chars"))
    return own.union(given.select(own.columns)).union(top.select(own.columns))


_PREFIX = T.StructType([T.StructField(c, T.LongType()) for c in ("conv_id", "pos", "len", "n_chars", "a", "b", "pa", "pb")]
                       + [T.StructField("_part", T.IntegerType())])


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Running xor of the mixed turns, by conversation, over sorted rows of one task."""
    schema = to_arrow_schema(_PREFIX)
    last, state = None, np.zeros(2, dtype=np.uint64)
    for batch in batches:
        if not batch.num_rows:
            continue
        conv = batch.column("conv_id").to_numpy()
        pos = batch.column("pos").to_numpy()
        words = np.frombuffer(b"".join(batch.column("d").to_pylist()), dtype="<u8").reshape(-1, 2)
        x, y = mixed(words[:, 0].copy(), words[:, 1].copy(), pos.astype(np.uint64))
        new = np.stack([np.where(pos == 0, np.uint64(0), x), np.where(pos == 0, np.uint64(0), y)])
        begin = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
        total = np.bitwise_xor.accumulate(new, axis=1)
        base = np.where(begin > 0, total[:, begin - 1], np.uint64(0))
        if last is not None and conv[0] == last:
            base[:, 0] = state
        total ^= np.repeat(base, np.diff(np.append(begin, len(conv))), axis=1)
        before = total ^ new
        last, state = conv[-1], total[:, -1].copy()
        words = [w.view(np.int64) for w in (total[0], total[1], before[0], before[1])]
        columns = [conv, pos, batch.column("len"), batch.column("n_chars"), *words, batch.column("_part")]
        yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


def prefixes(rebuilt: DataFrame) -> DataFrame:
    """``(conv_id, pos, len, n_chars, a, b, pa, pb)``: prefix hash up to each turn, and its parent's.

    Tasks hash what they hold; a conversation that goes on in the next range partition is
    carried over by one row per partition.
    """
    parted = rebuilt.repartitionByRange("conv_id", "pos").sortWithinPartitions("conv_id", "pos").withColumn("_part", F.spark_partition_id())
    local = materialize(shipped(parted).mapInArrow(_running, _PREFIX), "trie-prefixes")
    ends = local.groupBy("_part").agg(
        F.min("conv_id").alias("first"), F.max("conv_id").alias("last"), F.max_by(F.struct("a", "b"), F.struct("conv_id", "pos")).alias("x"))
    carried, previous, state = [], None, (0, 0)
    for r in sorted(ends.collect(), key=lambda r: r["_part"]):
        held = state if previous == r["first"] else (0, 0)
        carried.append((r["_part"], r["first"], *held))
        own = (r["x"]["a"], r["x"]["b"])
        state = (own[0] ^ held[0], own[1] ^ held[1]) if r["first"] == r["last"] else own
        previous = r["last"]
    carry = F.broadcast(local.sparkSession.createDataFrame(carried, "_part int, _first long, _a long, _b long"))
    fix = lambda c, by: F.when((F.col("conv_id") == F.col("_first")) & (F.col("pos") > 0), F.col(c).bitwiseXOR(F.col(by))).otherwise(F.col(c)).alias(c)
    return local.join(carry, "_part").select(
        "conv_id", "pos", "len", "n_chars", fix("a", "_a"), fix("b", "_b"), fix("pa", "_a"), fix("pb", "_b"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the blocks of each node; blocks of one node follow each other."""
    key, text = None, None
    for batch in batches:
        out: list[tuple] = []
        c = batch.to_pydict()
        for a, b, pos, ids in zip(c["a"], c["b"], c["pos"], c["ids"]):
            if (a, b, pos) != key:
                if key is not None:
                    out.append((*key, text.hexdigest()))
                key, text = (a, b, pos), hashlib.sha256(ids.encode())
            else:
                text.update(b"," + ids.encode())
        if out:
            yield _digest_rows(out)
    if key is not None:
        yield _digest_rows([(*key, text.hexdigest())])


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 3 + [pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*rows), kinds)], names=["a", "b", "pos", "ends_sha256"])


def end_digests(paths: DataFrame, block: int = 256) -> DataFrame:
    """``(a, b, pos, ends_sha256)`` of nodes at which conversations end.

    Ids are joined in blocks of ``block`` consecutive numbers; a node's blocks are then
    read as a sorted stream, so no list of a node's conversations is ever held.
    """
    ends = paths.where("pos = len")
    ids = F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string"))
    blocks = ends.groupBy("a", "b", "pos", F.floor(F.col("conv_id") / block).alias("block")).agg(F.concat_ws(",", ids).alias("ids"))
    keys = ["a", "b", "pos"]
    return shipped(blocks.repartition(*keys).sortWithinPartitions(*keys, "block")).mapInArrow(
        _digests, "a long, b long, pos long, ends_sha256 string")


def centroid_sums(parent: np.ndarray, depth: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Subtree sums of a forest (``parent`` -1: a top) by centroid decomposition.

    All components are split in the same pass.  Nodes are kept in preorder, where a
    subtree is an interval, so every step is one operation on whole arrays.
    """
    n = len(parent)
    out = np.zeros_like(values)
    if not n:
        return out
    order = np.argsort(depth, kind="stable")
    layers = np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)
    full = np.ones(n, dtype=np.int64)
    for layer in layers[::-1]:
        inner = layer[parent[layer] >= 0]
        np.add.at(full, parent[inner], full[inner])
    pre, tops = np.zeros(n, dtype=np.int64), np.flatnonzero(parent < 0)
    pre[tops] = np.cumsum(full[tops]) - full[tops]  # one top's interval after another
    top_of = np.arange(n)
    for layer in layers:  # a child stands behind its parent and the children before it
        inner = layer[parent[layer] >= 0]
        if len(inner):
            inner = inner[np.argsort(parent[inner], kind="stable")]
            first = np.flatnonzero(np.concatenate([[True], parent[inner][1:] != parent[inner][:-1]]))
            before = np.cumsum(full[inner]) - full[inner]
            before -= np.repeat(before[first], np.diff(np.append(first, len(inner))))
            pre[inner] = pre[parent[inner]] + 1 + before
            top_of[inner] = top_of[parent[inner]]
    place = np.argsort(pre)  # from here on, node = its preorder number
    up = np.where(parent[place] >= 0, pre[parent[place]], -1)
    full, value, below = full[place], values[place], np.zeros_like(values)
    last = np.arange(n) + full
    size, comp, live = full.copy(), pre[top_of[place]], np.arange(n)
    while len(live):
        live = live[np.argsort(comp[live], kind="stable")]
        label = comp[live]
        starts = np.flatnonzero(np.concatenate([[True], label[1:] != label[:-1]]))
        counts = np.diff(np.append(starts, len(live)))
        group = np.repeat(np.arange(len(starts)), counts)
        # the candidates form a path from the top; the lowest one is the last in preorder
        half = 2 * size[live] >= counts[group]
        at = np.maximum.reduceat(np.where(half, np.arange(len(live)), -1), starts)
        centre = live[at]
        c = centre[group]
        under = (live >= c) & (live < last[c])
        totals = np.add.reduceat(np.where(under[:, None], value[live], 0), starts, axis=0)
        path = (live <= c) & (c < last[live])
        below[live[path]] += totals[group[path]]
        size_c = size[centre]
        above = path & (live != c)
        size[live[above]] -= size_c[group[above]]
        # under the centroid, a part begins at each of its children
        marks = np.where(under & (up[live] == c), np.arange(len(live)), 0)
        part = live[np.maximum.accumulate(marks)]
        comp[live[under]] = part[under]
        live = live[live != c]
    out[place] = below
    return out


def _small_components(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["tdepth", "tconv", "depth", "conv"], kind="stable").reset_index(drop=True)
    depth, conv = rows["depth"].to_numpy(), rows["conv"].to_numpy()
    index = pd.MultiIndex.from_arrays([conv, depth])
    parent = index.get_indexer(pd.MultiIndex.from_arrays([rows["pconv"].to_numpy(), depth - 1]))
    top = (conv == rows["tconv"].to_numpy()) & (depth == rows["tdepth"].to_numpy())
    sums = centroid_sums(np.where(top, -1, parent), depth, rows[["leaf", "saved"]].to_numpy(dtype=np.int64))
    return pd.DataFrame({"conv": conv, "depth": depth, "leaf": sums[:, 0], "saved": sums[:, 1]})


def _subtree_sizes(paths: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(on_path, sizes)``: which node each depth of a naming conversation's path is, and the
    number of nodes below each node.

    A conversation names the lower end of its path, so what it adds to a node's size is
    the length of that end, counted from the node.
    """
    key = (paths["a"] == nodes["a"]) & (paths["b"] == nodes["b"]) & (paths["pos"] == nodes["depth"])
    named = paths.join(nodes, key).select(paths["conv_id"].alias("x"), nodes["depth"], nodes["conv"].alias("owner"), paths["len"])
    named = materialize(named, "trie-named")
    begins = named.where("x = owner").groupBy("x").agg(F.min("depth").alias("begin"))
    on_path = materialize(named.join(begins, "x"), "trie-on-path")
    sizes = on_path.groupBy(F.col("owner").alias("conv"), "depth").agg(
        F.sum(F.col("len") - F.greatest("begin", "depth") + 1).alias("size"))
    return on_path.select("x", "depth", "owner"), sizes


def rollup(nodes: DataFrame, paths: DataFrame, task_nodes: int = 1 << 14) -> DataFrame:
    """``(conv, depth, leaf, saved)``: parts of the subtree sums, to be added up by node.

    ``nodes`` has conv, depth, pconv, leaf, saved, a, b.
    """
    count = nodes.count()
    base = nodes.select("conv", "depth", "pconv", "leaf", "saved")
    root = nodes.where("depth = 0").select("conv").first()
    base = base.withColumn("tconv", F.lit(root["conv"] if root else 0).cast("long")).withColumn("tdepth", F.lit(0).cast("long"))
    found, comp = [], ["tconv", "tdepth"]
    if count <= task_nodes:
        done = [base]
    else:
        on_path, sizes = _subtree_sizes(paths, nodes)
        sized = base.join(sizes, ["conv", "depth"]).withColumn("csize", F.lit(count).cast("long"))
        big, done = materialize(sized, "trie-component"), []
        while big.limit(1).count():
            lowest = F.min_by(F.struct("conv", "depth", "size"), F.struct("size", "depth", "conv"))
            centre = big.where("2 * size >= csize").groupBy(*comp).agg(lowest.alias("c")).select(
                *comp, F.col("c.conv").alias("cconv"), F.col("c.depth").alias("cdepth"), F.col("c.size").alias("csz"))
            centre = materialize(centre, "trie-centroids")
            at = on_path.select(F.col("x").alias("conv"), F.col("depth").alias("cdepth"), F.col("owner").alias("o0"))
            below = on_path.select(F.col("x").alias("conv"), (F.col("depth") - 1).alias("cdepth"), F.col("owner").alias("o1"))
            held = big.join(centre, comp).join(at, ["conv", "cdepth"], "left").join(below, ["conv", "cdepth"], "left")
            under = (F.col("depth") >= F.col("cdepth")) & F.col("o0").eqNullSafe(F.col("cconv"))
            held = materialize(held.withColumn("under", under), "trie-split")
            totals = held.where("under").groupBy(*comp).agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"))
            path = centre.join(totals, comp).join(on_path.withColumnRenamed("x", "cconv"), "cconv").where(
                (F.col("depth") >= F.col("tdepth")) & (F.col("depth") <= F.col("cdepth")))
            path = materialize(path.select(F.col("owner").alias("conv"), "depth", "leaf", "saved", F.col("csz").alias("less")), "trie-paths")
            found.append(path.drop("less"))
            rest = held.where(~(F.col("under") & (F.col("depth") == F.col("cdepth"))))
            tops = rest.where("under and depth = cdepth + 1").select(
                F.col("conv").alias("o1"), "cdepth", F.col("size").alias("top_size"), F.lit(True).alias("under"))
            rest = rest.join(tops, ["o1", "cdepth", "under"], "left").join(path.select("conv", "depth", "less"), ["conv", "depth"], "left")
            state = materialize(rest.select(
                "conv", "depth", "pconv", "leaf", "saved",
                F.when(F.col("under"), F.col("size")).otherwise(F.col("size") - F.coalesce("less", F.lit(0))).alias("size"),
                F.when(F.col("under"), F.col("o1")).otherwise(F.col("tconv")).alias("tconv"),
                F.when(F.col("under"), F.col("cdepth") + 1).otherwise(F.col("tdepth")).alias("tdepth"),
                F.when(F.col("under"), F.col("top_size")).otherwise(F.col("csize") - F.col("csz")).alias("csize")), "trie-component")
            done.append(state.where(F.col("csize") <= task_nodes).select(*base.columns))
            big = state.where(F.col("csize") > task_nodes)
    small = done[0]
    for d in done[1:]:
        small = small.union(d)
    groups = max(1, -(-count // task_nodes))
    dealt = small.withColumn("_group", F.pmod(F.xxhash64("tconv", "tdepth"), F.lit(groups)))
    parts = shipped(dealt).groupBy("_group").applyInPandas(_small_components, "conv long, depth long, leaf long, saved long")
    for f in found:
        parts = parts.union(f.select(parts.columns))
    return parts


def prefix_trie(conversations: DataFrame, task_nodes: int = 1 << 14) -> DataFrame:
    """One row per node of the trie of rebuilt conversations.

    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256.  Rows without conv_id belong to no conversation and take no part; null
    roles and texts are empty; equal (conv_id, turn) rows are ordered by role, then text,
    and repeated rows are turns of their own; other columns are not read.  A table without
    a conversation has no nodes, not even a root.
    """
    paths = prefixes(rebuilt_turns(ordered_turns(conversations)))
    ends = end_digests(paths)
    nodes = paths.groupBy("a", "b", "pos").agg(
        F.min("conv_id").alias("conv"), F.count("*").alias("n_convs"), F.min("pa").alias("pa"), F.min("pb").alias("pb"),
        F.min("n_chars").alias("n_chars"))
    nodes = materialize(nodes.join(ends, ["a", "b", "pos"], "left").withColumnRenamed("pos", "depth"), "trie-nodes")
    above = nodes.select(F.col("a").alias("pa"), F.col("b").alias("pb"), (F.col("depth") + 1).alias("depth"), F.col("conv").alias("pconv"))
    linked = nodes.join(above, ["pa", "pb", "depth"], "left")
    children = linked.where("depth > 0").groupBy(F.col("pconv").alias("conv"), (F.col("depth") - 1).alias("depth")).agg(
        F.count("*").alias("n_children"))
    linked = materialize(
        linked.join(children, ["conv", "depth"], "left").fillna(0, ["n_children"])
        .withColumn("leaf", (F.col("n_children") == 0).cast("long"))
        .withColumn("saved", (F.col("n_convs") - 1) * F.col("n_chars")), "trie-linked")
    sums = rollup(linked, paths, task_nodes).groupBy("conv", "depth").agg(F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    return linked.join(sums, ["conv", "depth"]).select(
        F.col("conv").alias("conv_id"), "depth", F.col("pconv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))
