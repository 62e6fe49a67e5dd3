"""Session construction and shared-folder helpers.

Scratch data (checkpoints, staged tables) always goes under the folder the
cluster names in ``spark.checkpoint.dir``.  Only when that is unset *and*
the master is local (tests, laptops) do we create a private temp folder.
"""

from __future__ import annotations

import contextlib
import contextvars
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins from runtime sizes,
# coalesces small shuffle partitions and splits skewed ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
}
#: Codec of tables and staged rows, also in a session that was built elsewhere.
CODEC = DEFAULT_CONF["spark.sql.parquet.compression.codec"]


def build_session(master: str | None = None, app: str = "starloom",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only when unset.

    Order: the context's folder, then ``spark.checkpoint.dir`` from the
    session conf, then (local master only) a fresh temp folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is unset; a shared folder is required on a cluster")
        configured = tempfile.mkdtemp(prefix="starloom-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


_COLLECTOR: contextvars.ContextVar[list | None] = contextvars.ContextVar(
    "starloom_scratch", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root for staged tables."""
    root = ensure_checkpoint_dir(spark)
    path = os.path.join(root, "starloom-scratch", f"{name}-{uuid.uuid4().hex}")
    collected = _COLLECTOR.get()
    if collected is not None:
        collected.append(path)
    return path


@contextlib.contextmanager
def scratch_scope(spark: SparkSession, keep: bool = False):
    """Delete the scratch folders created inside the block when it ends
    (only when it ends without an error, and only if ``keep`` is False).
    Use it where every result has been written elsewhere by the end."""
    collected: list[str] = []
    token = _COLLECTOR.set(collected)
    try:
        yield collected
    finally:
        _COLLECTOR.reset(token)
    if not keep:
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for p in collected:
            path = jvm.org.apache.hadoop.fs.Path(p)
            fs = path.getFileSystem(conf)
            if fs.exists(path):
                fs.delete(path, True)
