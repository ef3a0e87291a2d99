"""Document fingerprints: bottom-k sketches of word-shingle hashes, in DataFrame
expressions only.

A sketch is the sorted array of a text's ``k`` smallest distinct 64-bit shingle
hashes.  Sketches of parts merge into the sketch of the whole; two sketches give
resemblance, containment and distinct shingle counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from valuora.llm.common import materialize

SPACES = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def _tokens(text: Column) -> Column:
    """Words of a text; one empty string when there are none."""
    return F.split(F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS)), SPACES)


def _shingles(hashed: Column, tokens: Column, words: int) -> Column:
    """Hashes of all runs of ``words`` words (all words as one when there are fewer; none without words)."""
    rolled = F.transform(
        F.sequence(F.lit(1), F.size(hashed) - (words - 1)),
        lambda i: F.xxhash64(*[F.element_at(hashed, (i + j).cast("int")) for j in range(words)]))
    return (
        F.when(F.element_at(tokens, 1) == "", F.array().cast("array<bigint>"))
        .when(F.size(hashed) < words, F.array(F.xxhash64(hashed)))
        .otherwise(rolled)
    )


def bottom(hashes: Column, k: int = 64) -> Column:
    """The ``k`` smallest distinct hashes, ascending."""
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def add_sketch(df: DataFrame, text: str, out: str, k: int = 64, words: int = 5) -> DataFrame:
    """``df`` with the sketch of a text column (null or wordless text: empty sketch).

    Words are hashed once in a projection of their own, so shingles hash a few longs.
    """
    tokens, hashed = f"_{out}_tokens", f"_{out}_hashed"
    return (
        df.withColumn(tokens, _tokens(F.col(text)))
        .withColumn(hashed, F.transform(tokens, lambda w: F.xxhash64(w)))
        .withColumn(out, bottom(_shingles(F.col(hashed), F.col(tokens), words), k))
        .drop(tokens, hashed)
    )


def merge(a: Column, b: Column, k: int = 64) -> Column:
    """Sketch of two parts taken together (their shingles' union)."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_parts(df: DataFrame, keys: list[str], sketch: str, k: int = 64) -> DataFrame:
    """One sketch per key from the sketches of its parts.

    Only the ``k`` smallest distinct hashes of a key survive each side of the
    shuffle (ranked per map task first), so a hot key costs k values a task.
    """
    single = df.select(*keys, F.explode(sketch).alias("_h")).distinct()
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("_h"))
    kept = single.withColumn("_rank", rank).where(F.col("_rank") <= k)
    return kept.groupBy(*keys).agg(F.sort_array(F.collect_list("_h")).alias(sketch))


def distinct_shingles(sketch: Column, k: int = 64) -> Column:
    """Estimated number of distinct shingles (exact below ``k``)."""
    span = float(1 << 64)
    top = F.element_at(sketch, -1).cast("double") + float(1 << 63)
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise((k - 1) * span / F.greatest(top, F.lit(1.0)))


def resemblance(a: Column, b: Column, k: int = 64) -> Column:
    """Estimated Jaccard similarity: share of the union's k smallest hashes found in both.

    Two empty sketches resemble each other fully, an empty and a filled one not at all.
    """
    union = merge(a, b, k)
    both = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both.cast("double") / F.size(union))


def containment(a: Column, b: Column, k: int = 64) -> Column:
    """Estimated share of a's shingles that b has, from resemblance and distinct counts."""
    r = resemblance(a, b, k)
    na, nb = distinct_shingles(a, k), distinct_shingles(b, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), r * (na + nb) / ((r + 1) * F.greatest(na, F.lit(1.0)))))


def as_text(sketch: Column) -> Column:
    """The sketch as 16 lower-case hex digits a hash."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def followers(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every distinct (id, text): the key of the row before it by ascending id,
    and that row's length in characters.

    Columns ``_id``, ``_nul``, ``_th`` name a row (id or 0, id is null, text hash),
    ``_pid``, ``_pnul``, ``_pth`` and ``_pn`` the one before; the first row follows
    the last.  Null ids come last, equal ids by text hash.  Positions come from a
    range-partitioned write; rows meet their predecessor by an equi-join on it.
    """
    order = ["_nul", "_id", "_th"]
    keys = row_keys(docs, id_col, text_col).select(*order, F.coalesce(F.length(text_col), F.lit(0)).alias("_n")).distinct()
    placed = materialize(
        keys.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_pos", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_pos", 33)), "sketch-order")
    # one row per range partition, so a window over all of them is small
    ends = placed.groupBy("_part").agg(F.min("_pos").alias("_pos"), F.max("_pos").alias("_end"))
    last = F.last("_end").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    starts = ends.select("_pos", F.coalesce(F.lag("_end").over(Window.orderBy("_part")), last).alias("_jump"))
    linked = placed.join(F.broadcast(starts), "_pos", "left").withColumn("_prev", F.coalesce("_jump", F.col("_pos") - 1))
    before = placed.select(F.col("_pos").alias("_prev"), F.col("_id").alias("_pid"), F.col("_nul").alias("_pnul"),
                           F.col("_th").alias("_pth"), F.col("_n").alias("_pn"))
    return materialize(linked.join(before, "_prev").select(*order, "_pid", "_pnul", "_pth", "_pn"), "sketch-followers")


def row_keys(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with ``_id``, ``_nul``, ``_th``: join keys that never are null."""
    return docs.select(
        "*", F.coalesce(F.col(id_col), F.lit(0)).alias("_id"), F.col(id_col).isNull().alias("_nul"),
        F.xxhash64(text_col, F.lit(8)).alias("_th"))


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 64, words: int = 5) -> DataFrame:
    """Each text, its edited text and the next document's text compared by sketch.

    The edited text has its last floor(n_chars / 4) characters replaced by the first
    as many (or all) of the next document's.  Gives doc_id, n_chars, edited_sha256,
    sketch, edited_sketch, near_edited, near_next.  Texts are shuffled once; a row
    sends its predecessor only the characters that it needs.  Repeated rows (same id
    and text) all have the same next document and give a row each; a single
    document is its own next.
    """
    key = ["_id", "_nul", "_th"]
    plain = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = add_sketch(row_keys(plain, "doc_id", "text").select(*key, "text"), "text", "sketch", k, words)
    placed = texts.join(followers(plain, "doc_id", "text"), key)
    sent = placed.select(
        F.col("_pid").alias("_id"), F.col("_pnul").alias("_nul"), F.col("_pth").alias("_th"),
        F.col("text").substr(F.lit(1), F.floor(F.col("_pn") / 4).cast("int")).alias("_head"),
        F.col("sketch").alias("_next")).dropDuplicates(key)
    both = placed.join(sent, key)
    n = F.length("text")
    edited = F.concat(F.col("text").substr(F.lit(1), n - F.floor(n / 4).cast("int")), F.col("_head"))
    out = add_sketch(both.withColumn("edited", edited), "edited", "edited_sketch", k, words)
    return out.select(
        F.when(~F.col("_nul"), F.col("_id")).alias("doc_id"), n.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"), "sketch", "edited_sketch",
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("_next"), k).alias("near_next"))
