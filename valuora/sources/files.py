"""File sources and sinks."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class SourceNotFound(FileNotFoundError):
    """A requested input path does not exist."""


def _path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hadoop_path))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Read Parquet; a missing path raises ``SourceNotFound`` naming it."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            raise SourceNotFound(f"No such dataset: {path}") from exc
        raise


def read_frame(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet by (case-insensitive) extension, otherwise CSV with a header.

    Without an explicit schema the CSV types are inferred, as the reference's
    reader does; production callers should pass ``schema`` to skip inference.
    """
    if path.lower().rstrip("/").endswith(".parquet"):
        return read_parquet(spark, path)
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    if not _path_exists(spark, path):
        raise SourceNotFound(f"No such dataset: {path}")
    return reader.csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """S3: overwrite-mode Parquet write (parents are created by the writer)."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def read_or_materialise(
    spark: SparkSession,
    cache_path: str,
    build,
    required_columns: Sequence[str] = (),
    force: bool = False,
) -> DataFrame:
    """Use the cached copy when present, else build and write it.

    ``build`` is a zero-argument callable returning the source DataFrame.  The
    required-column guard runs on both the cached and the freshly built frame.
    """
    from valuora.operators.validate import require_columns

    # A finished write leaves _SUCCESS; a half-written folder is rebuilt.
    if not force and _path_exists(spark, f"{cache_path.rstrip('/')}/_SUCCESS"):
        cached = read_parquet(spark, cache_path)
        require_columns(cached, required_columns)
        return cached
    fresh = build()
    require_columns(fresh, required_columns)
    if force:
        write_parquet(fresh, cache_path)
    else:
        staged = f"{cache_path.rstrip('/')}-{uuid.uuid4().hex[:12]}"
        write_parquet(fresh, staged)
        if not _publish(spark, staged, cache_path):
            return read_parquet(spark, staged)
    return read_parquet(spark, cache_path)


def stored_once(spark: SparkSession, path: str, write) -> str:
    """Where the content that ``write(staged_path)`` makes is stored: ``path``, published by one
    rename, or the staged folder if another job was first."""
    if _path_exists(spark, path):
        return path
    staged = f"{path.rstrip('/')}-{uuid.uuid4().hex[:12]}"
    write(staged)
    return path if _publish(spark, staged, path) else staged


def _publish(spark: SparkSession, staged: str, path: str) -> bool:
    """Rename ``staged`` to ``path``; False when another job has published it first."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    no_overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        files.rename(jvm.org.apache.hadoop.fs.Path(staged), target, no_overwrite)
    except Py4JJavaError as exc:
        if not _path_exists(spark, path):
            raise exc
        return False
    return True


def input_state(spark: SparkSession, paths: Sequence[str]) -> str:
    """Digest of the paths, sizes and modification times of all files below ``paths``.

    File contents are not read (the columns are pruned); one row comes back.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    one = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    row = listed.select(one.alias("h")).agg(F.count("h").alias("n"), F.sum("h").alias("h")).first()
    return hashlib.md5(f"{sorted(paths)} {row['n']} {row['h']}".encode()).hexdigest()[:16]


def save_split(df: DataFrame, path: str, split_col: str = "split") -> None:
    """Persist both partitions of a split in one write, partitioned by split."""
    write_parquet(df, path, partition_by=[split_col])


def load_split(spark: SparkSession, path: str, split: str, split_col: str = "split") -> DataFrame:
    """Reload one partition; the filter prunes the other directory."""
    return read_parquet(spark, path).where(F.col(split_col) == split)


def write_report_csv(df: DataFrame, path: str) -> None:
    """Small report tables (aggregates) as a single headed CSV file."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def _strict(col: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(F.isnan(col) | (F.abs(col) == F.lit(float("inf"))), F.lit(None)).otherwise(col)
    if isinstance(dtype, T.StructType):
        return F.struct(*[_strict(col[f.name], f.dataType).alias(f.name) for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        return F.transform(col, lambda x: _strict(x, dtype.elementType))
    if isinstance(dtype, T.MapType):
        return F.transform_values(col, lambda _k, v: _strict(v, dtype.valueType))
    return col


def json_safe(df: DataFrame) -> DataFrame:
    """Every NaN/+-Inf float leaf (nested too) becomes null.

    ``to_json`` alone would print ``"NaN"``, which is not RFC 8259 JSON.
    """
    return df.select(*[_strict(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema])


def strict_json_lines(df: DataFrame) -> DataFrame:
    """One strict JSON document per row with keys in sorted order."""
    safe = json_safe(df)
    ordered = safe.select(*sorted(safe.columns))
    return ordered.select(F.to_json(F.struct(*ordered.columns), {"ignoreNullFields": "false"}).alias("json"))


def write_strict_json(df: DataFrame, path: str) -> None:
    """S7 sink: strict JSON lines."""
    strict_json_lines(df).write.mode("overwrite").text(path)


def write_scored(df: DataFrame, path: str, *, force: bool = False) -> None:
    """S8 + S9: write a scored table; refuse to overwrite unless forced."""
    df.write.mode("overwrite" if force else "errorifexists").parquet(path)


def read_requests(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    corrupt_col: str = "_corrupt_record",
) -> DataFrame:
    """JSON request documents, one a line, under the contract's names (see
    :func:`parse_requests`)."""
    raw = spark.read.text(path).withColumnRenamed("value", "__raw")
    return parse_requests(raw, "__raw", schema, corrupt_col)


def parse_requests(df: DataFrame, text_col: str, schema: T.StructType, corrupt_col: str = "_corrupt_record",
                   keep: Sequence[str] = ()) -> DataFrame:
    """S12 on a column of JSON text (batch or stream); ``keep`` passes columns through.

    Every contract field comes back as the text of its value, so that validation
    can tell a bad value from an absent one and the contract's types are applied
    only afterwards.  ``mistyped`` lists text fields given as another JSON type,
    ``extra_keys`` the keys outside the contract; documents that are no JSON
    object keep their text in ``corrupt_col``.
    """
    plain = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    parsed = F.from_json(F.col(text_col), plain, {"mode": "PERMISSIVE"})
    keys = F.json_object_keys(F.col(text_col))
    known = F.array(*[F.lit(n) for n in plain.names])
    document = F.try_parse_json(text_col)
    kinds = [
        (f.name, F.schema_of_variant(F.try_variant_get(document, f"$.{f.name}", "variant")))
        for f in schema if isinstance(f.dataType, T.StringType)
    ]
    wrong = F.array(*[F.when(~kind.isin("STRING", "VOID"), F.lit(name)) for name, kind in kinds])
    return df.select(
        *keep,
        parsed.alias("__req"),
        F.when(keys.isNull(), F.col(text_col)).alias(corrupt_col),
        F.coalesce(F.filter(keys, lambda k: ~F.array_contains(known, k)), F.array().cast("array<string>")).alias("extra_keys"),
        F.array_compact(wrong.cast("array<string>")).alias("mistyped"),
    ).select(*keep, "__req.*", corrupt_col, "extra_keys", "mistyped")
