"""Personal data: fixed patterns, and identifiers found by bootstrapped contexts.

Four base patterns (email, ip, card, phone) give spans by themselves and are the seeds.
Every seed and every other identifier-like token is a mention; what stands around it
gives lexical patterns: the two words before it, and the word before with the word behind,
each with a coarse type of the token (what signs and how many digits it has).  Mentions of the whole corpus make a graph of patterns and instances.

Spark scores both sides in turns: a pattern's confidence is the score it holds over the
distinct instances it extracts, smoothed; an unlabelled instance's score is the chance
that at least one of its confident patterns is right.  Patterns that end with enough
support and confidence then extract the unseen identifiers that stand in them, as spans
``found_<kind>``.  A pattern that also extracts tokens which fail a base pattern's check
(a number of a card's length with a wrong check digit, say) loses confidence by them.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from valuora.llm.common import map_columns, materialize, with_row_ids

KINDS = ("email", "ip", "card", "phone")

DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")  # from the start of a run, as later starts fail alike
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
MARK = re.compile(r"[0-9@]")
BREAK = frozenset(" \t\n\r\v\f\"'`<>|,;=:[]{} ")
TOKEN_END = re.compile(r"[^\s\"'`<>|,;=:\[\]{}]*+")
WORD = re.compile(r"[^\W\d_]+|[:=#]")
TRIM = ".!?()$#%*-_+~&/"
WINDOW = 48
MAX_TOKEN = 64


def luhn(digits: str) -> bool:
    total = 0
    for place, ch in enumerate(reversed(digits)):
        value = int(ch) << (place & 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def email_spans(text: str) -> list[tuple[int, int]]:
    """Leftmost matches; a local part never crosses an ``@`` or the match before."""
    out, last = [], 0
    for m in DOMAIN.finditer(text):
        start = m.start()
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            out.append((start, m.end()))
            last = m.end()
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The fixed patterns, leftmost and non-overlapping by kind; offsets in code points."""
    spans = [("email", a, b) for a, b in email_spans(text)] if "@" in text else []
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p) <= 3 and int(p) <= 255 for p in (p.lstrip("0") or "0" for p in m[0].split("."))):
                spans.append(("ip", m.start(), m.end()))
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                spans.append(("card", m.start(), m.end()))
        for m in PHONE.finditer(text):
            if 10 <= len(DIGIT.findall(m[0])) <= 15:
                spans.append(("phone", m.start(), m.end()))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def tokens(text: str, taken: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Identifier-like tokens outside the spans ``taken``: at most 64 characters, with an inner
    ``@`` or at least four digits."""
    out, last, held = [], 0, 0
    spans = sorted((a, b) for _, a, b in taken)
    for m in MARK.finditer(text):
        if m.start() < last:
            continue
        start = m.start()
        while start > last and text[start - 1] not in BREAK and not text[start - 1].isspace():
            start -= 1
        last = TOKEN_END.match(text, m.start()).end()
        last = max(last, m.end())
        a, b = start, last
        if b - a > 4 * MAX_TOKEN:
            continue
        while a < b and text[a] in TRIM:
            a += 1
        while b > a and text[b - 1] in TRIM:
            b -= 1
        part = text[a:b]
        if not (4 <= len(part) <= MAX_TOKEN and ("@" in part[1:-1] or len(DIGIT.findall(part)) >= 4)):
            continue
        while held < len(spans) and spans[held][1] <= a:
            held += 1
        if any(x < b and a < y for x, y in spans[held : held + 8]):
            continue
        out.append((a, b))
    return out


def slot(value: str) -> str:
    """Coarse type of an identifier: its signs, and a class of its number of digits."""
    if "@" in value:
        return "at"
    if any(ch.isalpha() for ch in value):
        return "mixed"
    digits = len(DIGIT.findall(value))
    if value.count(".") >= 3:
        return "dotted"
    return "short" if digits < 8 else "middle" if digits < 14 else "long"


def patterns(text: str, start: int, end: int) -> list[str]:
    """Lexical patterns around a mention."""
    before = WORD.findall(text[max(0, start - WINDOW) : start].lower())[-2:]
    behind = WORD.findall(text[end : end + WINDOW].lower())[:1]
    kind, one = slot(text[start:end]), before[-1] if before else "^"
    two = " ".join(before) if len(before) == 2 else f"^ {one}"
    return [f"{two} _ |{kind}", f"{one} _ {behind[0] if behind else '$'} |{kind}"]


_SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("kind", T.StringType()), T.StructField("end", T.LongType())])
_MENTION = T.StructType([*_SPAN.fields, T.StructField("value", T.StringType()), T.StructField("patterns", T.ArrayType(T.StringType()))])


def mentions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Written table, one row per document: ``_row``, doc_id, counts and digest of the base spans,
    and the mentions (base spans with their kind, other tokens without)."""
    fields = [T.StructField("doc_id", docs.schema[id_col].dataType)]
    fields += [T.StructField(f"n_{k}", T.LongType()) for k in KINDS]
    fields += [T.StructField("base_sha256", T.StringType()), T.StructField("mentions", T.ArrayType(_MENTION))]

    def make():
        def work(c):
            out = {f.name: [] for f in fields}
            out["doc_id"] = c["doc_id"]
            for text in c["text"]:
                text = text or ""
                spans = base_spans(text)
                for k in KINDS:
                    out[f"n_{k}"].append(sum(s[0] == k for s in spans))
                out["base_sha256"].append(hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest())
                found = spans + [(None, a, b) for a, b in (tokens(text, spans) if MARK.search(text) else [])]
                out["mentions"].append([
                    {"start": a, "kind": k, "end": b, "value": text[a:b].lower(), "patterns": patterns(text, a, b)} for k, a, b in found])
            return out

        return work

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return with_row_ids(map_columns(source, make, T.StructType(fields)), "pii-mentions")


def learn(rows: DataFrame, rounds: int = 3, support: int = 5, enough: float = 0.6, accept: float = 0.75, smooth: float = 2.0) -> DataFrame:
    """Confident patterns ``(pattern, kind, confidence, support, instances)`` of the mentions.

    Edges are distinct (pattern, instance) pairs, so copies of a document count once; a
    pattern or an instance with very many edges is one key of partial aggregates and of
    joins against one row per key.
    """
    edges = rows.select(F.explode("mentions").alias("m")).select(
        F.explode("m.patterns").alias("pattern"), F.xxhash64("m.value").alias("instance"), F.coalesce("m.kind", F.lit("")).alias("seed"))
    edges = materialize(edges.distinct(), "pii-edges")
    # only a pattern that extracts a seed can become confident
    useful = edges.where("seed != ''").select("pattern").distinct()
    edges = materialize(edges.join(useful, "pattern"), "pii-graph")
    open_edges = edges.where("seed = ''").select("pattern", "instance")
    scored = edges.where("seed != ''").select("pattern", F.col("seed").alias("kind"), F.lit(1.0).alias("score"))
    found = None
    for last in [False] * (rounds - 1) + [True]:
        totals = edges.groupBy("pattern").agg(F.count_distinct("instance").alias("instances"))
        held = scored.groupBy("pattern", "kind").agg(F.sum("score").alias("weight"), F.sum((F.col("score") >= 0.5).cast("long")).alias("support"))
        best = held.groupBy("pattern").agg(F.max_by(F.struct("kind", "weight", "support"), F.struct("weight", "kind")).alias("b"))
        rated = best.join(totals, "pattern").select(
            "pattern", "b.kind", (F.col("b.weight") / (F.col("instances") + smooth)).alias("confidence"), "b.support", "instances")
        found = materialize(rated.where((F.col("support") >= support) & (F.col("confidence") >= (accept if last else enough))), "pii-patterns")
        if last:
            break
        chance = 1 - F.exp(F.sum(F.log(1 - F.col("confidence"))))
        likely = open_edges.join(found, "pattern").groupBy("instance", "kind").agg(chance.alias("score"))
        grown = open_edges.join(likely, "instance").select("pattern", "kind", "score")
        scored = edges.where("seed != ''").select("pattern", F.col("seed").alias("kind"), F.lit(1.0).alias("score")).union(grown)
    return found


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Personal data of every text: doc_id, counts by base kind, sha256 of the base spans, all
    spans as ``kind:start:end`` by start, then kind (base kinds first), and the number found by context.

    Null and empty texts have no spans; every row, repeated ids included, gives one row;
    other columns are not read; an empty table gives no rows.
    """
    rows = mentions(docs, id_col, text_col)
    learned = learn(rows, **options)
    unseen = rows.select("_row", F.explode("mentions").alias("m")).where(F.col("m.kind").isNull()).select(
        "_row", "m.start", "m.end", F.explode("m.patterns").alias("pattern"))
    hits = unseen.join(learned, "pattern").groupBy("_row", "start", "end").agg(
        F.max_by("kind", F.struct("confidence", "kind")).alias("kind"))
    extra = hits.groupBy("_row").agg(F.collect_list(F.struct("start", F.concat(F.lit("found_"), "kind").alias("kind"), "end")).alias("found"))
    base = F.transform(F.filter("mentions", lambda m: m["kind"].isNotNull()), lambda m: F.struct(m["start"], m["kind"], m["end"]))
    held = rows.select("_row", "doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", base.cast(T.ArrayType(_SPAN)).alias("base"))
    order = F.array(*[F.lit(k) for k in [*KINDS, *[f"found_{k}" for k in KINDS]]])
    none = F.array().cast(T.ArrayType(_SPAN))
    spans = F.concat("base", F.coalesce(F.col("found").cast(T.ArrayType(_SPAN)), none))
    ranked = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], F.array_position(order, s["kind"]), s["end"], s["kind"].alias("kind"))))
    shown = F.array_join(F.transform(ranked, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return held.join(extra, "_row", "left").select(
        "doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", shown.alias("spans"),
        F.coalesce(F.size("found"), F.lit(0)).cast("long").alias("n_found"))
