"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

#: Settings every job relies on.  No job hints ``broadcast``: a side is only
#: broadcast when its size, from table statistics or measured by AQE at run
#: time, is below these limits; beyond them Spark sort-merges and splits skew.
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even where that costs a later operator its partitioning.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A side whose every shuffled part is below this is hashed, so that the wide side of a join is not sorted and spilled.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": str(64 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # HotSpot never compiles methods above 8000 bytes; without this limit a wide
    # fact's generated loop would run interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

#: Keyed stream operators keep timers and list state, which need RocksDB.
STATE_PROVIDER = (
    "spark.sql.streaming.stateStore.providerClass",
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
)

#: For joins of streams: both sides of a part lie in one store, a batch writes its changes only, and rows are not
#: counted, as that reads every key before it is written.
JOIN_STATE = {
    "spark.sql.streaming.join.stateFormatVersion": "3",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def build_session(
    app: str = "tallyflow",
    master: str | None = None,
    zone: str = "Asia/Shanghai",
    **conf: str,
) -> SparkSession:
    """A session for the jobs; ``zone`` is the one zone all date text uses."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", zone)
    if master:
        builder = builder.master(master)
    for key, value in {**JOB_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_job_conf(spark: SparkSession, zone: str | None = None) -> SparkSession:
    """Apply the run-time settings to a session made elsewhere."""
    for key, value in JOB_CONF.items():
        spark.conf.set(key, value)
    if zone:
        spark.conf.set("spark.sql.session.timeZone", zone)
    return spark


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for written tables and stream checkpoints.

    On a cluster this lies in the shared folder named by
    ``spark.checkpoint.dir``.  Only where that is unset, as in tests on one
    machine, a local folder is taken.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        shared = tempfile.mkdtemp(prefix="tallyflow-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return os.path.join(shared, f"{purpose}-{uuid.uuid4().hex[:12]}")
