"""Session settings the engine is designed for, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# The JVM only interprets a generated method of over 8000 bytes, and the cleaning and rules of a feed make one. Beyond this limit
# Spark runs the operators one by one, whose methods it keeps small: 300,000 transactions took 8.9 s before and 4.7 s so.
COMPILED = {"spark.sql.codegen.hugeMethodLimit": "8000"}

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A join side is broadcast only while its estimated (static) or measured
    # (adaptive) size stays under this bound; beyond it the join shuffles.
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    # Files hold their rows compressed: the bound is on bytes in memory.
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    # Deduplication keys of a whole day do not fit in executor heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    **COMPILED,
    # Commit what changed instead of a full copy of the state.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# A partition of a shuffle should hold about this much; adaptive execution merges what turns out small.
SHUFFLE_BYTES = 128 * 1024 * 1024


def shuffle_settings(input_bytes: int) -> dict[str, str]:
    """How finely shuffles of so much input start out. Stateful streams do not run adaptively and keep their number for good,
    so it is set before their first start."""
    partitions = str(max(200, -(-input_bytes // SHUFFLE_BYTES)))
    return {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": partitions,
        "spark.sql.shuffle.partitions": partitions,
    }


def build_session(
    app_name: str = "riskflow", master: str | None = None, input_bytes: int | None = None, **conf: str
) -> SparkSession:
    """Create a session with the engine's settings; ``conf`` wins over them.

    ``input_bytes``: what the largest job reads; sizes its shuffles. Without it Spark's own default holds.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    sized = shuffle_settings(input_bytes) if input_bytes else {}
    for key, value in {**SETTINGS, **sized, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def keep_compiled(spark: SparkSession) -> None:
    """Have a session that ``build_session`` did not make run wide plans compiled as well. Results are the same."""
    for name, value in COMPILED.items():
        spark.conf.set(name, value)


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the cluster's shared ``spark.checkpoint.dir``.

    Only a local session may fall back to a machine-local temporary folder:
    executors on other machines could not see it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="riskflow-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
