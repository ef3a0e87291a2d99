"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import atexit
import contextlib
import contextvars
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every job here relies on.  AQE re-plans joins and coalesces
# partitions at run time; the skew-join split handles a hot key holding a
# large share of one side; ANSI mode makes bad casts and division by zero
# fail loudly instead of silently producing nulls.
RECOMMENDED_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "valuora",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the recommended settings.

    On a cluster ``master`` is left to ``spark-submit``; locally pass
    ``local[N]``.  The web UI is switched off: no job here needs it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(RECOMMENDED_CONF)
    conf["spark.ui.enabled"] = "false"
    if master and master.startswith("local"):
        # Local mode runs everything in the driver JVM; give it real memory.
        conf["spark.driver.memory"] = os.environ.get("VALUORA_DRIVER_MEMORY", "12g")
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``; that value always wins.
    Only when it is unset and the master is local (tests, a laptop) a fresh
    local folder is created and registered; on a cluster an unset folder is an
    error, as executors would each write to their own disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(configured)
        return configured.rstrip("/")
    existing = spark.sparkContext.getCheckpointDir()
    if existing:
        # getCheckpointDir returns "<root>/<uuid>"; reuse its parent.
        return existing.rstrip("/").rsplit("/", 1)[0]
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
    local = tempfile.mkdtemp(prefix="valuora-ckpt-")
    atexit.register(shutil.rmtree, local, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


_MADE: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("scratch_made", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique path below the checkpoint root for a written intermediate."""
    path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    made = _MADE.get()
    if made is not None:
        made.append(path)
    return path


@contextlib.contextmanager
def scratch_made():
    """The scratch paths that this thread hands out inside the block, as a list."""
    made: list[str] = []
    token = _MADE.set(made)
    try:
        yield made
    finally:
        _MADE.reset(token)


def drop_scratch(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch tables that no later job reads."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers (once per application).

    Spark distributes the zipped sources itself, so tasks work wherever the
    package is not installed on the executors.
    """
    context = spark.sparkContext
    if getattr(context, "_valuora_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="valuora-code-"), "valuora.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(path)
    context._valuora_shipped = True


def materialize(df, name: str):
    """Write ``df`` as Parquet below the checkpoint root and read it back.

    Used for inputs that many later jobs read: the upstream joins run once,
    the lineage is cut (a lost executor re-reads files instead of recomputing
    the joins), and later scans are columnar with pruning and pushdown.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
