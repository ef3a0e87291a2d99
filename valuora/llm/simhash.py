"""SimHash near-duplicates found with pivot distance tables.

A fingerprint is the 64-bit SimHash of word shingles.  Reference fingerprints
(pivots) are fixed: the zero word, one mask per block of ``64 / blocks`` bits,
and seeded random words.  The distance table of a fingerprint holds its Hamming
distances to all of them.

* The block pivots deal fingerprints into cells.  ``d(x, 0) - d(x, mask)`` gives
  the number of set bits in a block; two fingerprints at distance 2 have block
  counts at L1 distance 2 at most, so one vector of counts lies within 1 of both.
  Each fingerprint enters its own cell and the ``2 * blocks`` cells next to it:
  a pair within distance 2 always meets, without comparing all pairs.
* Pairs that meet are discarded when any coordinate of their distance tables
  differs by more than the allowed distance (triangle inequality); survivors
  are verified by the Hamming distance itself.
* A cell holding more than ``cell_rows`` fingerprints is not expanded into
  pairs.  Its members take finer pivots: every word at distance 0 or 1 from the
  fingerprint.  Two fingerprints within distance 2 share such a pivot, and two
  that share one are within 1 + 1 (the table's inclusion rule), so a star to the
  smallest member keeps every connection with a number of links linear in the
  members.  The result is exact at any group size.

Components of the links come from alternating large-star and small-star steps;
every step is a written table, nothing is gathered on the driver but counts.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from valuora.llm.common import addressed, map_columns, materialize, repeated, with_row_ids

MAX_DISTANCE = 2


def simhash64(text: str | None, shingle_words: int = 3) -> int:
    """SimHash of one text as an unsigned integer.

    A-Z are lower-cased, words are runs of bytes other than ASCII white space,
    shingles are ``shingle_words`` words joined by a space (the whole sequence
    when there are fewer), hashed with XXH64 (seed 42).  A bit is set when more
    than half of the hashes have it; null or wordless text gives zero.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle_words:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle_words))))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, 42) for s in shingles), dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 65536):  # bounded scratch for very long texts
        part = hashes[start : start + 65536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3,
                 name: str = "simhash") -> DataFrame:
    """A written table ``(_row, doc_id, fp)``: the signed 64-bit SimHash of every row."""
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("fp", T.LongType())])

    def make():
        return lambda c: {"doc_id": c["doc_id"], "fp": [_signed(simhash64(t, shingle_words)) for t in c["text"]]}

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return with_row_ids(map_columns(source, make, schema), name)


class PivotTable:
    """The reference fingerprints and the Spark expressions over their distances.

    ``blocks`` pivots are bit-block masks, ``random_pivots`` are seeded words.
    """

    def __init__(self, blocks: int = 16, random_pivots: int = 32, seed: int = 20) -> None:
        if 64 % blocks or blocks > 16:
            raise ValueError("blocks must divide 64 and be at most 16")
        self.blocks, self.width = blocks, 64 // blocks
        self.digit = self.width.bit_length()  # bits of a key that hold one block's count
        if self.digit * blocks > 63:
            raise ValueError("the cell key would not fit in 63 bits")
        self.masks = [_signed(((1 << self.width) - 1) << (self.width * b)) for b in range(blocks)]
        words = np.random.default_rng(seed).integers(0, 1 << 64, size=random_pivots, dtype=np.uint64)
        self.references = [0, *self.masks, *(_signed(int(w)) for w in words)]

    def distances(self, fp: Column) -> Column:
        """The distance table's row: Hamming distance to every reference."""
        return F.array(*[F.bit_count(fp.bitwiseXOR(F.lit(p).cast("long"))).cast("byte") for p in self.references])

    def add_cells(self, tables: DataFrame, dist: str = "dist", out: str = "cell") -> DataFrame:
        """One row per entry of a fingerprint: its own cell and the cells one count away."""
        zero = F.element_at(dist, 1).cast("int")
        counts = F.transform(F.slice(dist, 2, self.blocks), lambda d: F.shiftright(zero - d.cast("int") + self.width, 1))
        place = F.aggregate(
            F.sequence(F.lit(0), F.lit(self.blocks - 1)), F.lit(0).cast("long"),
            lambda acc, b: acc + F.call_function("shiftleft", F.element_at("_counts", b + 1).cast("long"), b * self.digit))
        step = lambda b: F.call_function("shiftleft", F.lit(1).cast("long"), b * self.digit)
        blocks = F.sequence(F.lit(0), F.lit(self.blocks - 1))
        below = F.transform(F.filter(blocks, lambda b: F.element_at("_counts", b + 1) > 0), lambda b: F.col("_own") - step(b))
        above = F.transform(F.filter(blocks, lambda b: F.element_at("_counts", b + 1) < self.width), lambda b: F.col("_own") + step(b))
        return (
            tables.withColumn("_counts", counts).withColumn("_own", place)
            .withColumn(out, F.explode(F.concat(F.array("_own"), below, above))).drop("_counts", "_own", dist)
        )


def _coordinates_allow(a: Column, b: Column, limit: int) -> Column:
    return F.forall(F.zip_with(a, b, lambda x, y: F.abs(x.cast("int") - y.cast("int"))), lambda d: d <= limit)


def links(distinct: DataFrame, pivots: PivotTable, cell_rows: int = 64) -> DataFrame:
    """Edges ``(u, v)`` between distinct fingerprints; their components are those of
    the graph of all pairs within distance 2.

    ``distinct`` has one row per fingerprint (``fp``).  Edges from small cells are
    the verified pairs; edges from cells above ``cell_rows`` are stars around
    shared pivots, which connect the same fingerprints.

    Spark takes exploded rows for as few as there were before, so the joins of such rows say
    that they are sorted and merged: the driver would be sent all of them for a broadcast.
    """
    tables = distinct.select("fp", pivots.distances(F.col("fp")).alias("dist"))
    entries = pivots.add_cells(tables)
    sizes = materialize(entries.groupBy("cell").agg(F.count("*").alias("members")).where("members > 1"), "simhash-sizes")
    shared = materialize(entries.hint("merge").join(sizes, "cell"), "simhash-cells")  # both sides are dealt anew: hot cells can be split
    small = shared.where(F.col("members") <= cell_rows).select("cell", "fp")
    left = small.select("cell", F.col("fp").alias("u"), pivots.distances(F.col("fp")).alias("du"))
    right = small.select("cell", F.col("fp").alias("v"), pivots.distances(F.col("fp")).alias("dv"))
    pairs = (
        left.hint("merge").join(right, "cell")
        .where("u > v")
        .where(_coordinates_allow(F.col("du"), F.col("dv"), MAX_DISTANCE))
        .where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= MAX_DISTANCE)
        .select("u", "v")
    )
    crowded = shared.where(F.col("members") > cell_rows).select("fp").distinct()
    fine = [F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(_signed(1 << b)).cast("long")) for b in range(64)]]
    near = crowded.select("fp", F.explode(F.array(*fine)).alias("pivot"))
    centre = near.groupBy("pivot").agg(F.min("fp").alias("v"), F.count("*").alias("n")).where("n > 1")
    stars = near.hint("merge").join(centre, "pivot").where("fp != v").select(F.col("fp").alias("u"), "v")
    return pairs.union(stars).distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every endpoint; root is the component's smallest node.

    Alternates large-star (hang larger neighbours on the smallest neighbour) and
    small-star until the edge set stops changing.
    """
    edges = materialize(edges.select("u", "v").where("u != v"), "cc-edges")
    state = None
    for _ in range(max_rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large, "cc-large")
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        moved = down.join(least, "u")
        small = (
            moved.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v")))
            .distinct()
        )
        edges = materialize(small, "cc-small")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").cast("decimal(20,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())


def near_duplicates(fps: DataFrame, pivots: PivotTable | None = None, cell_rows: int = 64) -> DataFrame:
    """Rows of ``fps`` with ``root`` (fingerprint naming the component) and
    ``component_id`` (its smallest non-null doc_id).

    Equal fingerprints are collapsed first, so a group of exact copies costs one
    row; rows come back through joins on the fingerprint whose small side is one
    row per fingerprint (Spark splits a hot fingerprint's rows).  Null doc_ids
    take part but never name a component unless all its ids are null.
    """
    pivots = pivots or PivotTable()
    distinct = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "simhash-distinct")
    found = components(links(distinct, pivots, cell_rows))
    rooted = materialize(
        distinct.join(found, distinct["fp"] == found["node"], "left")
        .select("fp", "doc_id", F.coalesce("root", "fp").alias("root")), "simhash-roots")
    smallest = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = rooted.select("fp", "root").join(smallest, "root")
    return fps.join(named, "fp")


def hex_fingerprint(fp: Column) -> Column:
    """16 lower-case hex digits of the unsigned fingerprint."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3) -> DataFrame:
    """``docs`` with one row kept of each near-duplicate component.

    Kept is the row with the smallest doc_id (nulls last; among repeated rows,
    one of them).  Columns and their names stay as they are.
    """
    held, file, place = addressed(docs, "dedup-input")
    source = held.select(F.col(file).alias("_file"), F.col(place).alias("_place"), F.col(text_col).alias("text"), F.col(id_col).alias("doc_id"))
    schema = T.StructType([T.StructField("_file", T.LongType()), T.StructField("_place", T.LongType()),
                           T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("fp", T.LongType())])

    def make():
        return lambda c: {"_file": c["_file"], "_place": c["_place"], "doc_id": c["doc_id"],
                          "fp": [_signed(simhash64(t, shingle_words)) for t in c["text"]]}

    fps = materialize(map_columns(source, make, schema), "dedup-fingerprints")
    rows = near_duplicates(fps)
    order = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id"), F.col("_file"), F.col("_place"))
    keep = rows.groupBy("root").agg(F.min(order).alias("k")).select(
        F.col("k._file").alias(file), F.col("k._place").alias(place), F.lit(1).alias("copies"))
    return repeated(held, file, place, keep, "dedup-kept")
