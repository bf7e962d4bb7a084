"""Writing streams: append, upsert, metrics, and one stream to several targets.

All writers are safe to repeat: a micro-batch that runs again after a failure
overwrites exactly what its first attempt wrote.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.keyed import last_per
from ..operators.parse import to_lines
from ..operators.windows import stamped

Writer = Callable[[DataFrame, int], None]


def start(
    df: DataFrame,
    writer: Writer,
    checkpoint: str,
    mode: str = "append",
    available_now: bool = False,
    every: str = "10 seconds",
    state_parts: int | None = None,
    conf: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Run `writer` once per micro-batch; progress is kept in `checkpoint`.

    Keyed state is cut into `state_parts` parts, by default one per core of the
    cluster.  The number holds for the life of a checkpoint, so it is given with
    the query and not left to the session; so are the settings in `conf`.
    """
    spark = df.sparkSession
    own = {"spark.sql.shuffle.partitions": str(state_parts or spark.sparkContext.defaultParallelism), **(conf or {})}
    before = {key: spark.conf.get(key, None) for key in own}
    for key, value in own.items():
        spark.conf.set(key, value)
    try:
        return _started(df, writer, checkpoint, mode, available_now, every)
    finally:
        # The query has its own copy of the settings.
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _started(df: DataFrame, writer: Writer, checkpoint: str, mode: str, available_now: bool, every: str) -> StreamingQuery:
    query = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(writer)
    query = query.trigger(availableNow=True) if available_now else query.trigger(processingTime=every)
    return query.start()


def append_files(df: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Append rows as JSON lines; the file sink's own log gives exactly-once."""
    query = to_lines(df).writeStream.format("text").outputMode("append").option("checkpointLocation", checkpoint)
    if available_now:
        query = query.trigger(availableNow=True)
    return query.start(path)


def append_topic(df: DataFrame, servers: str, topic: str, checkpoint: str) -> StreamingQuery:
    """Append rows as JSON records to a Kafka topic.  Needs the connector jar."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic, "checkpointLocation": checkpoint}
    return to_lines(df).writeStream.format("kafka").options(**options).start()


def _batch_folder(path: str, batch_id: int) -> str:
    return f"{path}/batch={batch_id}"


def upsert_writer(path: str, keys: list[str], order: list[str]) -> Writer:
    """Keep, per micro-batch, the newest row of each key.

    Batches are only added, so a write costs what the batch holds and not what
    the table holds; `read_upserts` takes the newest row over all batches.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        last_per(batch, keys, order).write.mode("overwrite").parquet(_batch_folder(path, batch_id))

    return write


def read_upserts(spark: SparkSession, path: str, keys: list[str], order: list[str]) -> DataFrame:
    rows = spark.read.option("basePath", path).parquet(path)
    return last_per(rows, keys, [*order, "batch"]).drop("batch")


def metric_writer(path: str, columns: list[str]) -> Writer:
    """Metric rows in declared column order, partitioned by day."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = stamped(batch.select(*columns)).withColumn("dt", F.substring("stt", 1, 10))
        (
            rows.withColumn("batch", F.lit(batch_id))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("dt", "batch")
            .parquet(path)
        )

    return write


def fan_out(parts: Callable[[DataFrame], dict[str, DataFrame]], path: str) -> Writer:
    """One parsed micro-batch to several targets, each a folder under `path`."""

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            for name, rows in parts(kept).items():
                rows.write.mode("overwrite").json(_batch_folder(f"{path}/{name}", batch_id))
        finally:
            kept.unpersist()

    return write


def dimension_writer(path: str, routing: Callable[[SparkSession], DataFrame]) -> Writer:
    """Route a micro-batch of changes and upsert every configured dimension.

    The configuration is read again in each batch, so new, changed and removed
    rows take effect.  It is one row per dimension table, not data.
    """
    from ..operators.dims import latest_dimensions, route

    def write(batch: DataFrame, batch_id: int) -> None:
        arrived = batch.withColumn("seq", F.monotonically_increasing_id())
        routed = latest_dimensions(route(arrived, routing(batch.sparkSession)))
        rows = routed.select("sink_table", "pk", "data", "type", F.col("ts").try_cast("bigint").alias("ts"), "seq")
        rows.write.mode("overwrite").partitionBy("sink_table").parquet(_batch_folder(path, batch_id))

    return write


def enriched(writer: Writer, enrich: Callable[[DataFrame], DataFrame]) -> Writer:
    """Enrich every micro-batch before it is written.

    A table joined to a stream is read as it was when the query started.  What
    `enrich` reads, it reads again for every micro-batch, so that new rows of a
    dictionary or a dimension take effect.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        writer(enrich(batch), batch_id)

    return write
