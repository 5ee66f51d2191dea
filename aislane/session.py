"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_test_root: str | None = None


def configure(spark: SparkSession) -> SparkSession:
    """Set the runtime options the jobs rely on."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # A repeated JSON key keeps its last value instead of failing the line.
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    # Streams' state lies on disk, with only its changes in each checkpoint.
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder named by ``spark.checkpoint.dir``.

    Without that setting only a local master may go on, in a temporary folder:
    on a cluster no other machine would see it.
    """
    global _test_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        _test_root = _test_root or tempfile.mkdtemp(prefix="aislane-")
        root = _test_root
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
