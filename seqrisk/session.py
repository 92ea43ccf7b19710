"""Session helpers: one place for the Spark settings the operators rely on."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings every job wants. Shuffle partitions are sized by the caller; AQE
# coalesces small partitions, converts joins to broadcast from runtime sizes
# and splits skewed join partitions.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # pandas-written nanosecond timestamps / timedeltas read as BIGINT ns
    "spark.sql.legacy.parquet.nanosAsLong": "true",
}


TABLES, SCRATCH = "seqrisk-tables", "seqrisk-scratch"     # folders of scratch tables


def get_session(master: str = "local[8]", shuffle_partitions: int = 8,
                app: str = "seqrisk", extra: dict | None = None,
                driver_memory: str = "16g") -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app).config("spark.driver.memory", driver_memory)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in conf.items():
        if not k.startswith("spark.ui") and not k.startswith("spark.driver"):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf on an existing session
                pass
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``. Where it is unset, a scratch
    folder is made for a local master only: on a cluster a machine-local folder
    would lose rows, so that is an error."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="seqrisk-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    spark.conf.set("spark.checkpoint.dir", path)
    return path


_scope: ContextVar[str] = ContextVar("scratch_scope", default="")


def scratch_path(spark: SparkSession, kind: str, name: str) -> str:
    """A new path for a scratch table under the shared checkpoint directory;
    within a ``scratch_scope``, under the folder of that scope."""
    parts = [ensure_checkpoint_dir(spark).rstrip("/"), kind, _scope.get(), name]
    return "/".join(p for p in parts if p)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[str]:
    """Scratch tables made inside belong to the scope and are deleted at its
    end, also after an error; those of other scopes, other jobs and of an outer
    scope are left alone. Results must be written (or collected) inside: a frame
    that still reads a scratch table cannot be used afterwards. Yields the
    scope's name."""
    name = f"scope-{uuid.uuid4().hex}"
    inner = f"{_scope.get()}/{name}".lstrip("/")
    token = _scope.set(inner)
    try:
        yield inner
    finally:
        _scope.reset(token)
        base = ensure_checkpoint_dir(spark).rstrip("/")
        jvm = spark.sparkContext._jvm
        for kind in (TABLES, SCRATCH):
            path = jvm.org.apache.hadoop.fs.Path(f"{base}/{kind}/{inner}")
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df: DataFrame, options: dict[str, str] | None = None) -> DataFrame:
    """Cut the lineage by writing the frame as a Parquet table under the
    shared checkpoint directory and reading it back. The written table
    survives executor loss (unlike a local checkpoint), is columnar, and the
    re-read plan gets column pruning and filter pushdown. ``options``: of the
    Parquet writer."""
    spark = df.sparkSession
    path = scratch_path(spark, TABLES, uuid.uuid4().hex)
    df.write.mode("overwrite").options(**(options or {})).parquet(path)
    return spark.read.parquet(path)
