"""Spark session and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "edicto", extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Session for local runs and tests.  On a cluster, pass no master and
    let the submitter's configuration win."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        # Local mode runs every task in the driver JVM, whose default heap
        # (1 GB) is far below the machine; on a cluster the submitter's
        # memory settings apply instead.  Half of the machine's memory;
        # `extra_conf` overrides it.
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
        conf["spark.driver.memory"] = f"{max(1, total // 2**31)}g"
    conf.update(extra_conf or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by `spark.checkpoint.dir`.  Only in local mode
    (tests) is a scratch folder made when the session names none; a cluster
    without one raises, because executors do not share local folders."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="edicto-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (for written tables that
    cut lineage and for streaming checkpoints)."""
    return "/".join([ensure_checkpoint_dir(spark).rstrip("/"), *parts])


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, as
    `PYTHONPATH` or `--py-files` would (executors without that folder ignore it)."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, known) if x)


def file_system(spark: SparkSession, path: str):
    """The file system that holds `path`, and the path in its terms."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more."""
    fs, p = file_system(spark, path)
    fs.delete(p, True)


_SCRATCH: ContextVar[str | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Copies that `written` makes inside go to one folder, which is deleted at
    the end.  Nothing that is lazy may leave the block."""
    path = shared_path(spark, f"run-{uuid.uuid4().hex}")
    token = _SCRATCH.set(path)
    try:
        yield path
    finally:
        _SCRATCH.reset(token)
        discard(spark, path)


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` written to a new folder under the shared one and read back: it is
    computed once, survives the loss of executors, and has a known size."""
    spark, name = df.sparkSession, f"{name}-{uuid.uuid4().hex}"
    path = f"{_SCRATCH.get()}/{name}" if _SCRATCH.get() else shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
