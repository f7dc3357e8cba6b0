"""Session defaults and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local_roots: dict[str, str] = {}

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
}


def get_spark(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """Build a session with the defaults above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting (tests) gets a temporary folder;
    a cluster session must name one, because executors cannot see the driver's disk.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if sc.applicationId not in _local_roots:
        _local_roots[sc.applicationId] = tempfile.mkdtemp(prefix="tidemark-")
        sc.setCheckpointDir(_local_roots[sc.applicationId])
    return _local_roots[sc.applicationId]


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh path under the work root; nothing is created until Spark writes to it."""
    return f"{work_root(spark)}/tidemark/{name}-{uuid.uuid4().hex}"
