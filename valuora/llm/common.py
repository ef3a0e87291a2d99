"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.dataset as pads
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from valuora.session import materialize, scratch_path, ship_package

__all__ = ["BATCH_BYTES", "table", "text_or_empty", "map_columns", "with_row_ids", "materialize", "byte_slices", "shipped", "smallest",
           "files_alone", "addressed", "repeated", "worker_state", "hand_back"]

#: Python tasks cut their incoming Arrow batches so that one step holds about
#: this many bytes of text, however long single texts are.
BATCH_BYTES = 4 << 20


_STATE: dict[object, object] = {}


def hand_back() -> None:
    """Return freed memory of this process, which allocators would keep, to the machine."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def worker_state(key: object = None, make: Callable[[], object] | None = None):
    """What a Python worker keeps between tasks (a tokenizer and its memo, say): the state of one
    operator at a time.  A task of another operator, or one without state, drops it and hands
    the memory back, so stages that follow each other don't add up."""
    if _STATE and key not in _STATE:
        _STATE.clear()
        gc.collect()
        hand_back()
    if make is None:
        return None
    if key not in _STATE:
        _STATE[key] = make()
    return _STATE[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def byte_slices(batch: pa.RecordBatch, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Zero-copy slices of ``batch`` of about ``limit`` bytes (at least one row each)."""
    rows = max(1, int(batch.num_rows * limit / max(limit, batch.nbytes)))
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def shipped(df: DataFrame) -> DataFrame:
    """``df``, after making this package importable in its session's Python workers."""
    ship_package(df.sparkSession)
    return df


def map_columns(
    df: DataFrame,
    make: Callable[[], Callable[[dict[str, list]], dict[str, Sequence]]],
    schema: T.StructType,
) -> DataFrame:
    """``mapInArrow`` over lists of column values.

    ``make`` is called once in each task and returns the function applied to
    every slice, so per-task state (a tokenizer, a memo) is built once.
    """
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state()
        work = make()
        for batch in batches:
            for part in byte_slices(batch):
                out = work(part.to_pydict())
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)

    return shipped(df).mapInArrow(run, schema)


def with_row_ids(df: DataFrame, name: str, column: str = "_row") -> DataFrame:
    """``df`` written as Parquet with a unique long per row, then reread.

    The id is fixed by the write, so later jobs and retried tasks see the same
    one; repeated rows become distinguishable.
    """
    return materialize(df.withColumn(column, F.monotonically_increasing_id()), name)


def smallest(rows: DataFrame, order: str, count: int, *ties: str) -> DataFrame:
    """The ``count`` rows with the smallest ``order`` (then ``ties``).

    The bar is found on that one column first, so wide columns of other rows are
    filtered out where they are read.
    """
    bar = rows.select(order).orderBy(order).limit(count).agg(F.max(order)).first()[0]
    if bar is None:
        return rows.limit(0)
    return rows.where(F.col(order) <= bar).orderBy(order, *ties).limit(count)


def files_alone(df: DataFrame) -> bool:
    """Whether ``df`` is nothing but a read of files, so that each of its rows has a place in one."""
    return df._jdf.queryExecution().analyzed().getClass().getSimpleName() == "LogicalRelation"


def addressed(df: DataFrame, name: str) -> tuple[DataFrame, str, str]:
    """``df`` with two more columns that tell its rows apart (also repeated ones): a number for
    the file and the row's place in it; and the names of these columns.

    A plain read of files has them already.  Anything else is written first.
    """
    if not files_alone(df):
        df = materialize(df, name)
    file, place = "_file", "_place"
    while file in df.columns or place in df.columns:
        file, place = f"_{file}", f"_{place}"
    hidden = df.metadataColumn("_metadata")
    return df.select("*", F.xxhash64(hidden["file_path"]).alias(file), hidden["row_index"].alias(place)), file, place


def repeated(rows: DataFrame, file: str, place: str, marks: DataFrame, name: str, carry: Sequence[str] = ()) -> DataFrame:
    """Rows of :func:`addressed`, each as often as ``marks`` (file, place, copies) says; others go.

    The rows themselves never move: marks are written in one folder per input file, sorted by
    place, and the task that reads a part of the file looks up the marks of that part.  Columns
    of the marks named in ``carry`` are added to the rows; a place may have several marks.
    """
    path = scratch_path(rows.sparkSession, name)
    (marks.select(F.col(file).alias("file"), F.col(place).alias("place"), F.col("copies").cast("long").alias("copies"), *carry)
     .repartitionByRange("file", "place").sortWithinPartitions("file", "place")
     .write.option("parquet.block.size", 1 << 20).partitionBy("file").parquet(path))
    carried = T.StructType([marks.schema[c] for c in carry])
    schema = T.StructType([*rows.schema.fields[:-2], *carried.fields])
    arrow = to_arrow_schema(schema)
    stored = pa.schema([("place", pa.int64()), ("copies", pa.int64()), *to_arrow_schema(carried)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state()
        fs, base = pafs.FileSystem.from_uri(path)
        held: dict[int, pads.Dataset | None] = {}

        def marked(number: int, places: np.ndarray) -> tuple[np.ndarray, pa.Table] | None:
            """Places' numbers, as often as they are marked, beside their marks."""
            if number not in held:
                folder = f"{base}/file={number}"
                known = fs.get_file_info(folder).type == pafs.FileType.Directory
                held[number] = pads.dataset(folder, filesystem=fs, format="parquet", schema=stored) if known else None
            if held[number] is None:
                return None
            at = pads.field("place")
            found = held[number].to_table(filter=(at >= int(places.min())) & (at <= int(places.max()))).sort_by("place")
            first, last = (np.searchsorted(found["place"].to_numpy(), places, side=s) for s in ("left", "right"))
            count = last - first
            row = np.repeat(np.arange(len(places)), count)
            mark = np.arange(len(row)) + np.repeat(first - (np.cumsum(count) - count), count)
            times = found["copies"].to_numpy()[mark]
            return np.repeat(row, times), found.take(pa.array(np.repeat(mark, times)))

        for batch in batches:
            for part in byte_slices(batch):
                numbers, places = (c.to_numpy() for c in part.columns[-2:])
                taken, beside = [], []
                for number in np.unique(numbers).tolist():
                    mine = np.flatnonzero(numbers == number)
                    got = marked(number, places[mine])
                    if got is not None and len(got[0]):
                        taken.append(mine[got[0]])
                        beside.append(got[1])
                if taken:
                    kept, added = part.take(pa.array(np.concatenate(taken))), pa.concat_tables(beside)
                    yield pa.RecordBatch.from_arrays([*kept.columns[:-2], *[added[c].combine_chunks() for c in carry]], schema=arrow)

    return shipped(rows).mapInArrow(run, schema)
