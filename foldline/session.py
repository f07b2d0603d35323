"""Session construction and the shared scratch area.

Everything that must outlive one task (staged sink output, checkpoints,
streaming progress, state tables written by tests) goes below the folder the
cluster names in ``spark.checkpoint.dir``.  We only set our own folder when the
session has none, which is the case in unit tests on a local master.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

_SCRATCH_CHILD = "foldline-scratch"


def build_session(
    master: str | None = None,
    app_name: str = "foldline",
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
) -> SparkSession:
    """Return a session tuned for the engine's operators.

    AQE stays on so that shuffle partitions are coalesced (small inputs) or
    split (skewed inputs) at run time; the Spark UI stays off.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session, set up only when absent."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):  # one machine, one file system
            raise RuntimeError(
                "spark.checkpoint.dir is not set; a cluster needs a shared "
                "folder for checkpoints and staged output"
            )
        configured = tempfile.mkdtemp(prefix="foldline-checkpoints-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, unique folder below the shared checkpoint root, removed when the application ends."""
    root = checkpoint_root(spark).rstrip("/")
    path = f"{root}/{_SCRATCH_CHILD}/{purpose}-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


@contextmanager
def session_conf(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Set SQL settings for the actions run inside the block, then restore them."""
    previous = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, str(value))
    try:
        yield
    finally:
        for key, value in previous.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
