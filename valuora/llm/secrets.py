"""Secret scans: fixed patterns, and password guess cost in credential contexts.

Three base patterns (assignments, access keys, long hex runs) give spans by
themselves.  On top, every value that stands in a wider credential context
(``pwd: ...``, ``Authorization: Bearer ...``, ``://user:value@host`` and the
like) is priced by a dynamic program: the cheapest split of the value into
dictionary words, dates, repeats, keyboard walks or sequences and brute-force
spans, in bits of guessing work.  Values that cost at least ``min_bits`` become
spans of kind ``guess``.

Dictionary words are the whole-word entries of a public tokenizer's vocabulary,
priced by rank; the file's path is a parameter.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from valuora.llm.common import map_columns, worker_state
from valuora.session import ship_package

KINDS = ("assign", "access", "hex", "guess")

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # maximal runs, as a shorter one never passes

#: Contexts whose value (the last group that matched) is priced.  A name may have a prefix
#: up to a sign, an underscore or a camel-case step; the names of ASSIGN any prefix.
CONTEXT = re.compile(
    r"""(?:(?:(?:(?<![A-Za-z0-9])|(?-i:(?<=[a-z0-9])(?=[A-Z])))(?:pass(?:phrase|code)?|pwd|secret_?(?:access_?)?key|access_?key|private_?key|client_?secret|credentials?|auth(?:_?key)?)"""
    r"""|password|passwd|secret|token|api_?key)["']?\x20*(?:[:=]|=>|\bis\b)\x20*)"""
    r"""(?:"([^"\n]{6,})"|'([^'\n]{6,})'|([^\s"',;]{6,}))"""
    r"""|\b(?:bearer|basic)\x20+([A-Za-z0-9+/_.=~-]{6,})"""
    r"""|://[^\s:/@]+:([^\s/@]{6,})@""",
    re.IGNORECASE | re.ASCII)
#: Any context holds one of these, so other texts skip the pattern.
HINT = re.compile(r"pass|pwd|secret|token|key|credential|auth|bearer|basic|://", re.IGNORECASE | re.ASCII)

ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
DATE = re.compile(
    r"(?:19|20)\d\d(?:[-/.]?(?:0[1-9]|1[0-2])(?:[-/.]?(?:0[1-9]|[12]\d|3[01]))?)?"
    r"|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:(?:19|20)\d\d|\d\d)")
MAX_WORD = 24
NEXT = 16
NEAR = 1e-9  # bits that rounding may differ by


def _steps() -> set[str]:
    """Ordered pairs of characters next to each other on a keyboard row or in the alphabet or digits."""
    runs = [*ROWS, "abcdefghijklmnopqrstuvwxyz", "0123456789"]
    pairs = {a + b for r in runs for a, b in zip(r, r[1:])}
    return pairs | {p[::-1] for p in pairs}


STEPS = _steps()


@lru_cache(maxsize=4)
def load_words(path: str) -> dict[str, float]:
    """Bits to guess each whole-word entry of a tokenizer file, by its rank among them."""
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    words = [w[:-4] for w, _ in sorted(vocab.items(), key=lambda x: x[1]) if w.endswith("</w>")]
    words = [w for w in words if 3 <= len(w) <= MAX_WORD and w.isascii() and w.isalpha()]
    return {w: math.log2(i + 2) for i, w in enumerate(words)}


def _char_bits(ch: str) -> float:
    if ch.isdigit():
        return math.log2(10)
    if ch.isalpha():
        return math.log2(26)
    return math.log2(33)


def guess_bits(value: str, words: dict[str, float], limit: float = math.inf) -> float:
    """Bits of work to guess ``value`` by its cheapest segmentation, one program over the whole value.

    With ``limit``, the program ends once every way to go on costs at least that much, and gives
    that lower bound; costs below ``limit`` are exact.  Words, dates and units are bounded.  A
    repeat or a walk has up to ``NEXT`` units or steps, or goes to its end; it is offered from
    the place where it begins, and from a later place only if that is reached more cheaply
    than going on.  So work is linear in the length.
    """
    low, n = value.lower(), len(value)
    best = [0.0] + [math.inf] * n
    units = 16
    # same[u]: how many characters from here on equal the ones u before them
    same = [[0] * (n + 1) for _ in range(units + 1)]
    for u in range(1, units + 1):
        row = same[u]
        for i in range(n - 1, u - 1, -1):
            row[i] = row[i + 1] + 1 if low[i] == low[i - u] else 0
    steps = [1] * (n + 1)  # characters of the walk that begins here
    for i in range(n - 2, -1, -1):
        steps[i] = steps[i + 1] + 1 if low[i : i + 2] in STEPS else 1
    walk_bits = math.log2(len("".join(ROWS)) * 2)
    repeats: dict[tuple[int, int], int] = {}
    walk, far, check = -1, 0, 16
    for i in range(n):
        if i == check:
            if min(best[i : far + 1]) >= limit:
                return min(best[i : far + 1])
            check *= 2
        base, split = best[i], 1.0 if i else 0.0  # one bit names each further boundary

        def offer(end: int, bits: float, base=base, split=split) -> None:
            nonlocal far
            far = max(far, end)
            if base + split + bits < best[end]:
                best[end] = base + split + bits

        # brute force: one more character of a span costs its class alone
        best[i + 1] = min(best[i + 1], base + _char_bits(value[i]))
        far = max(far, i + 1)
        for end in range(i + 3, min(n, i + MAX_WORD) + 1):
            bits = words.get(low[i:end])
            if bits is not None:
                part = value[i:end]
                case = 0.0 if part == low[i:end] else 1.0 if part.istitle() or part.isupper() else float(len(part))
                offer(end, bits + case)
        if low[i].isdigit() and (m := DATE.match(low, i)):
            offer(m.end(), math.log2(150) + (math.log2(365) if m.end() - i > 4 else 0.0))
        if steps[i] >= 3:
            within = 0 <= walk < i < walk + steps[walk]
            if not within or base + NEAR < best[walk] + math.log2((i + 3 - walk) / 3):
                walk = i
                for end in {*range(i + 3, i + min(steps[i], NEXT) + 1), i + steps[i]}:
                    offer(end, walk_bits + math.log2(end - i))
        for unit in range(1, min(i, units) + 1):  # what stands before, repeated
            times = same[unit][i] // unit
            if not times:
                continue
            key = (unit, i % unit)
            lead = repeats.get(key, -1)
            held = 0 <= lead < i and lead + same[unit][lead] >= i + unit
            if held and base + NEAR >= best[lead] + math.log2((i - lead) // unit + 1):
                continue  # going on from the lead is as cheap
            repeats[key] = i
            for k in {*range(1, min(times, NEXT) + 1), times}:
                offer(i + k * unit, 1.0 + math.log2(k))
    return best[n]


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The three fixed patterns, leftmost and non-overlapping by kind; offsets in code points."""
    spans = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    spans += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def context_values(text: str) -> list[tuple[int, int]]:
    """Where the values of credential contexts stand."""
    if not HINT.search(text):
        return []
    return [m.span(m.lastindex) for m in CONTEXT.finditer(text)]


def guess_spans(text: str, words: dict[str, float], min_bits: float) -> list[tuple[str, int, int]]:
    """Values in a credential context whose guess cost reaches ``min_bits``."""
    return [("guess", a, b) for a, b in context_values(text) if guess_bits(text[a:b], words, min_bits) >= min_bits]


def show(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan(docs: DataFrame, words_path: str, id_col: str = "doc_id", text_col: str = "text", min_bits: float = 40.0) -> DataFrame:
    """Spans of every text: doc_id, counts by base kind, sha256 of the base spans,
    all spans as ``kind:start:end`` (by start, then kind), comma-joined.

    Null and empty texts have no spans; every row gives one row.
    """
    fields = [T.StructField("doc_id", docs.schema[id_col].dataType)]
    fields += [T.StructField(f"n_{k}", T.LongType()) for k in KINDS]
    fields += [T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())]

    def make():
        words = load_words(words_path)

        def work(c):
            out = {f.name: [] for f in fields}
            out["doc_id"] = c["doc_id"]
            for text in c["text"]:
                base = base_spans(text or "")
                extra = guess_spans(text or "", words, min_bits)
                spans = sorted(base + extra, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
                for k in KINDS:
                    out[f"n_{k}"].append(sum(s[0] == k for s in spans))
                out["base_sha256"].append(hashlib.sha256(show(base).encode()).hexdigest())
                out["spans"].append(show(spans))
            return out

        return work

    return map_columns(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), make, T.StructType(fields))


def secret_spans(text: str | None, words: dict[str, float], min_bits: float) -> list[tuple[int, int]]:
    """What to hide in a text: values, merged where they overlap.  Of an assignment
    only the value is hidden, so the line stays readable; a context's value of which a
    part is hidden is hidden whole."""
    text = text or ""
    cuts = [(m.start(2), m.end(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    cuts += [(a, b) for k, a, b in base_spans(text) if k != "assign"]
    for a, b in context_values(text):
        if any(a < d and c < b for c, d in cuts) or guess_bits(text[a:b], words, min_bits) >= min_bits:
            cuts.append((a, b))
    merged: list[tuple[int, int]] = []
    for a, b in sorted(cuts):
        if merged and a < merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


def redacted(text: Column, words_path: str, min_bits: float = 40.0, mark: str = "[SECRET]") -> Column:
    """``text`` with every secret replaced by ``mark``; null stays null."""
    ship_package(SparkSession.active())

    @F.pandas_udf(T.StringType())
    def clean(texts: pd.Series) -> pd.Series:
        worker_state()
        words = load_words(words_path)

        def one(t):
            if t is None:
                return None
            out, at = [], 0
            for a, b in secret_spans(t, words, min_bits):
                out += [t[at:a], mark]
                at = b
            return "".join([*out, t[at:]]) if out else t

        return texts.map(one, na_action="ignore")

    return clean(text)
