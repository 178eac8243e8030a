"""Session settings shared by the library: runtime SQL options and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHUNK_ROWS_CONF = "spark.tideway.chunkRows"
DEFAULT_CHUNK_ROWS = 5_000_000

# Runtime options only (no static ones), so a session made by somebody else can be tuned too.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # an extra exchange is cheaper than one task holding a hot key
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def tune(spark: SparkSession) -> SparkSession:
    """Set the runtime options the library relies on and return the session."""
    for name, value in RUNTIME_CONF.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    # one machine with Spark's default of 200: every stateful stream would open 200 state stores
    if spark.sparkContext.master.startswith("local") and spark.conf.get("spark.sql.shuffle.partitions") == "200":
        spark.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    return spark


def chunk_rows(spark: SparkSession) -> int:
    """Rows one task should hold of a single key before that key is split over several tasks."""
    return int(spark.conf.get(CHUNK_ROWS_CONF, str(DEFAULT_CHUNK_ROWS)))


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: `spark.checkpoint.dir`, or a scratch folder in local mode."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
