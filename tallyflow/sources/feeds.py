"""Reading the feeds, the dictionary, the dimensions and the metric tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.timefmt import at, watermarked
from ..operators.dims import dimension, latest_dimensions
from ..operators.parse import clean_rows


def topic_lines(spark: SparkSession, servers: str, topic: str, start: str = "latest", **options: str) -> DataFrame:
    """Text of a Kafka topic; a record without payload gives an empty text.

    Positions live in the query's checkpoint.  Needs the Kafka connector jar.
    """
    reader = spark.readStream.format("kafka").options(
        **{"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": start, **options}
    )
    return payload(reader.load())


def payload(records: DataFrame) -> DataFrame:
    return records.select(F.coalesce(F.col("value").cast("string"), F.lit("")).alias("value"))


def folder_lines(spark: SparkSession, path: str, stream: bool = True, files_per_batch: int = 1000) -> DataFrame:
    """Text lines of a folder, as a stream or a table."""
    if not stream:
        return spark.read.text(path)
    return spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)


def table_stream(spark: SparkSession, path: str, schema: T.StructType | None = None, files_per_batch: int = 1000) -> DataFrame:
    """Parquet files of a folder as they arrive."""
    schema = schema or spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def log_rows(lines: DataFrame) -> DataFrame:
    """Application log; event time `rt` is left to `with_event_time`."""
    return clean_rows(lines, schemas.LOG)


def change_rows(lines: DataFrame) -> DataFrame:
    """Row-change records."""
    return clean_rows(lines, schemas.CHANGE)


def with_event_time(logs: DataFrame, delay: str = "2 seconds") -> DataFrame:
    """Adds `rt` from `ts`, and the watermark on a stream."""
    return watermarked(logs.withColumn("rt", at("ts")), "rt", delay)


def captured_routing(lines: DataFrame) -> DataFrame:
    """Routing rows out of change-capture text, whose row image is in `after`."""
    after = F.from_json(F.get_json_object("value", "$.after"), CAPTURED)
    names = dict(zip(CAPTURED.names, schemas.ROUTING.names))
    rows = lines.select(after.alias("row")).where(F.col("row").isNotNull())
    return rows.select(*[F.coalesce(f"row.{a}", f"row.{b}").alias(b) for a, b in names.items() if a != b])


# Both spellings occur in captured rows; fixed names.
CAPTURED = T.StructType(
    [T.StructField(n, T.StringType()) for n in "sourceTable sinkTable sinkColumns sinkPk sinkExtend".split()]
    + schemas.ROUTING.fields
)


def jdbc_dictionary(spark: SparkSession, url: str, **options: str) -> DataFrame:
    """The code dictionary from a database; read again in every micro-batch."""
    reader = spark.read.format("jdbc").options(url=url, dbtable="base_dic", **options)
    return reader.load().select(*[f.name for f in schemas.DICTIONARY])


def dictionary_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.DICTIONARY).parquet(path)


def current_dimensions(spark: SparkSession, path: str, sink_table: str, columns: list[str]) -> DataFrame:
    """One dimension out of the dimension sink's folder, the newest version per key; for use in `dims.enrich`."""
    versions = spark.read.option("basePath", path).parquet(f"{path}/batch=*")
    return dimension(latest_dimensions(versions.where(F.col("sink_table") == sink_table)), sink_table, columns)


def metric_table(spark: SparkSession, path: str) -> DataFrame:
    """A metric table partitioned by day `dt`; reports prune on it."""
    return spark.read.parquet(path)
