"""Best-fit packing of tokenized documents into fixed-capacity sequences.

Items and bins are vectors: tokens, documents and attention cost (length
squared).  An item may only enter a bin with room in every coordinate; among
those the bin with the best score wins: the largest weighted dot product of
demand and residual, or the smallest weighted norm of what would be left.
Items go in by decreasing length.

Pieces are dealt by hash into packing groups of about ``group_tokens`` tokens;
the number of groups follows the total, so a task's work does not grow with the
input.  Sequences that stay emptier than ``repack_below`` are opened again and
their pieces are packed together in a second round.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from unicodedata import is_normalized

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from valuora.llm.common import byte_slices, hand_back, materialize, shipped, worker_state

MEMO_WORDS = 200_000
LONG_WORD = 48
ENCODE_WORDS = 2048
WORD_END = "</w>"
_LETTERS = frozenset(b"abcdefghijklmnopqrstuvwxyz")
#: Signs that make token runs of their own behind a letter; none occurs in a special token's
#: string, and an apostrophe would begin a contraction.
_SIGNS = b".,!?;:$%&*#"


class WordTokenizer:
    """Token ids of a text as little-endian unsigned 32-bit bytes.

    For a lower-casing tokenizer that never joins text across ASCII white space,
    the ids of a text are those of its words in order, so words are looked up in
    a memo and only new ones go through the tokenizer.  Signs at a word's end, after an
    ASCII letter, are a token run of their own, so they are coded apart.  Texts that may hold
    a special token's string keep their case.  The memo is two Arrow columns (a dict of small
    objects, made among the objects of a passing text, would hold several times its size in
    memory); once it is full, only the words of the texts at hand stay in it.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words = pa.array([], pa.large_binary())
        self.ids = pa.array([], pa.large_binary())
        # letters that normalisation leaves as they are need neither it nor the splitting pattern
        plain = json.loads(self.tokenizer.to_str()) | {"normalizer": None, "added_tokens": [], "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
            {"type": "WhitespaceSplit"}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}}
        self.plain = Tokenizer.from_str(json.dumps(plain))
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends[[i for t, i in vocab.items() if t.endswith(WORD_END)]] = True

    def _encode(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of each word.  Words of letters alone are coded many at a time and cut
        at the tokens that end a word; should a letter run turn out to be more than
        one, that lot is coded word by word like the other words."""
        out: dict[bytes, bytes] = {}
        letters, rest = [], []
        for w in words:
            (letters if w.isalpha() or w.decode().isalpha() else rest).append(w)
        for at in range(0, len(letters), ENCODE_WORDS):
            some = letters[at : at + ENCODE_WORDS]
            text = b" ".join(some).decode()
            simple = max(text) < "\u0250" and text == text.lower() and is_normalized("NFC", text)
            coder = self.plain if simple else self.tokenizer
            ids = np.array(coder.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
            stops = (np.flatnonzero(self.ends[ids]) + 1) * 4
            if len(stops) != len(some) or stops[-1] != 4 * len(ids):
                rest += some
                continue
            data, start = ids.tobytes(), 0
            for w, stop in zip(some, stops.tolist()):
                out[w], start = data[start:stop], stop
        for at in range(0, len(rest), ENCODE_WORDS):  # the tokenizer's own result objects are large
            some = rest[at : at + ENCODE_WORDS]
            coded = self.tokenizer.encode_batch_fast([w.decode() for w in some], add_special_tokens=False)
            out.update((w, struct.pack(f"<{len(e)}I", *e.ids)) for w, e in zip(some, coded))
        return out

    def _known(self, words: list[bytes]) -> dict[bytes, bytes]:
        place = pc.index_in(pa.array(words, pa.large_binary()), value_set=self.words)
        there = place.is_valid()
        return dict(zip([w for w, t in zip(words, there.to_pylist()) if t], self.ids.take(place.filter(there)).to_pylist()))

    def texts(self, texts: pa.Array | list[str | None]) -> Iterator[bytes]:
        column = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        words = pc.ascii_split_whitespace(pc.if_else(pc.match_substring(column, "<|"), column, pc.ascii_lower(column)))
        uses = words.values.dictionary_encode()
        different = uses.dictionary.cast(pa.large_binary())
        place = pc.index_in(different, value_set=self.words)
        if len(self.words) > MEMO_WORDS:
            used = place.drop_null()
            self.words, self.ids = self.words.take(used), self.ids.take(used)
            place = pc.index_in(different, value_set=self.words)
        listed = different.filter(place.is_null()).to_pylist()
        new = set(listed).difference((b"",))
        stems = {w: w.rstrip(_SIGNS) for w in new if w[-1] in _SIGNS}
        stopped = {w: s for w, s in stems.items() if s and s[-1] in _LETTERS}
        parts = list(set(stopped.values()).union(w[len(s) :] for w, s in stopped.items()).union(new.difference(stopped)))
        known = self._known(parts)
        coded = self._encode([w for w in parts if w not in known])
        ids = lambda w: coded[w] if w in coded else known[w]
        coded.update([(w, ids(s) + ids(w[len(s) :])) for w, s in stopped.items()])
        at = place.fill_null(-1).to_numpy().astype(np.int64)
        at[at < 0] = len(self.ids) + np.arange(len(listed))
        every = pa.concat_arrays([self.ids, pa.array([coded.get(w, b"") for w in listed], pa.large_binary())])
        kept = [w for w in coded if len(w) <= LONG_WORD]
        self.words = pa.concat_arrays([self.words, pa.array(kept, pa.large_binary())])
        self.ids = pa.concat_arrays([self.ids, pa.array([coded[w] for w in kept], pa.large_binary())])
        out = every.take(pa.array(at[uses.indices.to_numpy()]))
        ends = np.frombuffer(out.buffers()[1], dtype=np.int64)[words.offsets.to_numpy()].tolist() if len(out) else [0] * (len(words) + 1)
        data = memoryview(out.buffers()[2] or b"") if len(out) else memoryview(b"")
        del listed, new, stems, stopped, parts, known, coded, kept, every, uses, words
        for start, stop in zip(ends, ends[1:]):
            yield bytes(data[start:stop])


def worker_tokenizer(path: str) -> WordTokenizer:
    """The tokenizer of this Python process, so tasks that follow each other share its memo."""
    return worker_state(("tokenizer", path), lambda: WordTokenizer(path))


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_tokens: int = 4096,
    end_id: int = 1,
    keep_ids: bool = False,
) -> DataFrame:
    """One row per piece of a document: its ids and then ``end_id``, cut every
    ``max_tokens`` tokens.

    Columns: doc_id, piece, start, length, ids_crc32, _deal (a hash that spreads
    even repeated rows) and, with ``keep_ids``, ids (array of int).  Null and
    empty texts are the end id alone.
    """
    fields = [
        T.StructField("doc_id", docs.schema[id_col].dataType),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("_deal", T.LongType()),
    ]
    if keep_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    schema = T.StructType(fields)
    arrow = to_arrow_schema(schema)
    end = int(end_id).to_bytes(4, "little")
    step = 4 * max_tokens

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = worker_tokenizer(tokenizer_path)
        seen = 0
        for batch in batches:
            for part in byte_slices(batch):
                out: list[list] = [[] for _ in fields]
                for doc, ids in zip(part.column("doc_id").to_pylist(), tokenizer.texts(part.column("text"))):
                    ids += end
                    for at in range(0, len(ids), step):
                        cut = ids[at : at + step]
                        crc = zlib.crc32(cut)
                        seen += 1
                        deal = zlib.crc32(b"%d %d %d" % (seen, crc, at))
                        row = [doc, at // step, at // 4, len(cut) // 4, crc, deal]
                        if keep_ids:
                            row.append(np.frombuffer(cut, dtype="<u4").astype(np.int32))
                        for column, value in zip(out, row):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(v, type=f.type) for v, f in zip(out, arrow)], schema=arrow)
                hand_back()

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return shipped(source).mapInArrow(run, schema)


@dataclass(frozen=True)
class Capacity:
    """What one sequence may hold, and how residuals are scored.

    ``weights`` belong to tokens, documents, attention cost; ``score`` is
    ``"norm"`` (smallest weighted residual norm) or ``"dot"`` (largest weighted
    dot product of demand and residual).
    """

    tokens: int = 4096
    documents: int = 4096
    attention: int = 4096 * 4096
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05)
    score: str = "norm"


def best_fit(lengths: np.ndarray, capacity: Capacity) -> np.ndarray:
    """Bin number of every item (in the given order of items).

    Bins are kept as a residual matrix.  Bins whose token residual is below the
    shortest item that is still to come are closed and leave the matrix, so the
    search touches open bins only.
    """
    if capacity.score not in ("norm", "dot"):
        raise ValueError(f"unknown score {capacity.score!r}")
    limits = np.array([capacity.tokens, capacity.documents, capacity.attention], dtype=np.float64)
    if len(lengths) and (lengths.max() > limits[0] or float(lengths.max()) ** 2 > limits[2] or limits[1] < 1):
        raise ValueError("an item exceeds an empty sequence's capacity")
    weights = np.asarray(capacity.weights) / limits / (limits if capacity.score == "norm" else 1.0)
    order = np.argsort(-lengths, kind="stable")
    shortest = lengths[order[-1]] if len(order) else 0
    out = np.empty(len(lengths), dtype=np.int64)
    residual, number, used, made = np.empty((3, 1024)), np.empty(1024, dtype=np.int64), 0, 0
    for place, item in enumerate(order):
        need = np.array([lengths[item], 1.0, float(lengths[item]) ** 2])
        open_bins = residual[:, :used]
        fits = (open_bins >= need[:, None]).all(axis=0)
        if fits.any():
            if capacity.score == "norm":
                value = (weights[:, None] * (open_bins - need[:, None]) ** 2).sum(axis=0)
                value[~fits] = np.inf
                best = int(value.argmin())
            else:
                value = ((weights * need / limits)[:, None] * open_bins).sum(axis=0)
                value[~fits] = -np.inf
                best = int(value.argmax())
        else:
            if used == residual.shape[1]:
                residual = np.concatenate([residual, np.empty((3, used))], axis=1)
                number = np.concatenate([number, np.empty(used, dtype=np.int64)])
            best, used = used, used + 1
            residual[:, best], number[best] = limits, made
            made += 1
        residual[:, best] -= need
        out[item] = number[best]
        if (residual[0, best] < shortest or residual[1, best] < 1) and used:
            used -= 1  # closed: the last open bin takes its column
            residual[:, best], number[best] = residual[:, used], number[used]
    return out


def _pack_groups(pieces: DataFrame, groups: int, first_id: int, capacity: Capacity, ident: T.DataType) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField("doc_id", ident), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()), T.StructField("_deal", T.LongType()),
            T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()), T.StructField("_fill", T.LongType()),
        ]
    )

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        worker_state()
        rows = rows.sort_values(["length", "_deal", "ids_crc32", "piece"], ascending=[False, True, True, True], kind="stable")
        bins = best_fit(rows["length"].to_numpy(), capacity)
        rows = rows.drop(columns="_group").assign(sequence_id=first_id + (int(key[0]) << 32) + bins)
        by = rows.groupby("sequence_id")["length"]
        return rows.assign(offset=by.cumsum() - rows["length"], _fill=by.transform("sum"))[[f.name for f in schema]]

    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64("_deal", "ids_crc32"), F.lit(groups)))
    return shipped(dealt).groupBy("_group").applyInPandas(pack, schema)


def pack(
    pieces: DataFrame,
    capacity: Capacity | None = None,
    group_tokens: int = 1 << 19,
    repack_below: float = 0.98,
    name: str = "packing",
) -> DataFrame:
    """``pieces`` (columns of :func:`token_pieces`) with sequence_id and offset.

    Every row is placed once, repeated rows included; offsets inside a sequence
    are gapless from 0.  An empty input gives an empty result.
    """
    capacity = capacity or Capacity()
    ident = pieces.schema["doc_id"].dataType
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "_deal"]
    pieces = materialize(pieces.select(columns), f"{name}-pieces")

    def groups(df: DataFrame) -> int:
        return max(1, -(-(df.agg(F.sum("length")).first()[0] or 0) // group_tokens))

    first = materialize(_pack_groups(pieces, groups(pieces), 0, capacity, ident), f"{name}-first")
    full = F.col("_fill") >= int(capacity.tokens * repack_below)
    loose = first.where(~full).select(columns)
    again = _pack_groups(loose, groups(loose), 1 << 62, capacity, ident)
    return first.where(full).union(again).drop("_deal", "_fill")


def fill_report(packed: DataFrame, tokens: int = 4096) -> DataFrame:
    """Sequences, tokens and mean fill of a packing (one row)."""
    return packed.agg(F.count_distinct("sequence_id").alias("sequences"), F.sum("length").alias("tokens")).select(
        "*", (F.col("tokens") / (F.col("sequences") * tokens)).alias("fill"))
