"""Dimension maintenance: routing by configuration, pruning, latest rows, enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import predicates as P
from .joins import lookup
from .keyed import last_per

ROUTED_TYPES = ("insert", "update", "bootstrap-insert")


def sink_columns() -> Column:
    """The configured column list; blanks around names do not count."""
    return F.transform(F.split("sink_columns", ","), lambda c: F.trim(c))


def route(changes: DataFrame, routing: DataFrame) -> DataFrame:
    """Changes of configured tables, cut to the configured columns and tagged
    with their sink table.  Tables without configuration are dropped.

    The configuration, one row per dimension table, is taken into the plan: its
    size is known there, so changes are not shuffled by the few table names, and
    feeds of other tables are left out before a row of them is made.
    """
    known = routing.toArrow()
    tables = {t for t in known.column("source_table").to_pylist() if t is not None}
    rules = routing.sparkSession.createDataFrame(known, routing.schema).select(
        F.col("source_table").alias("table"),
        "sink_table",
        F.coalesce(F.nullif("sink_pk", F.lit("")), F.lit("id")).alias("sink_pk"),
        sink_columns().alias("_keep"),
    )
    kept = F.map_filter("data", lambda k, _: F.array_contains("_keep", k))
    return (
        changes.where(P.is_type(*ROUTED_TYPES) & F.col("table").isin(sorted(tables)))
        .join(rules, "table")
        .withColumn("data", kept)
        .withColumn("pk", F.try_element_at("data", F.col("sink_pk")))
        .drop("_keep")
    )


def latest_dimensions(routed: DataFrame) -> DataFrame:
    """Upsert result: newest change per sink table and primary key.

    Change times are whole seconds.  Of equal ones the last to arrive counts, by
    the columns `batch` and `seq` that the dimension sink writes; without them
    the choice is by content.
    """
    arrival = [F.col(c) for c in ("batch", "seq") if c in routed.columns] or [F.to_json("data")]
    return last_per(routed.where(F.col("pk").isNotNull()), ["sink_table", "pk"], [F.col("ts").try_cast("bigint"), *arrival])


def dimension(latest: DataFrame, sink_table: str, columns: list[str]) -> DataFrame:
    """One dimension as a table of text columns."""
    rows = latest.where(F.col("sink_table") == sink_table)
    return rows.select(*[P.new(c).alias(c) for c in columns])


def dimension_schema(columns: str, pk: str | None = None) -> T.StructType:
    """All columns are text; the primary key (default `id`) may not be null."""
    key = pk or "id"
    names = [c.strip() for c in columns.split(",")]
    return T.StructType([T.StructField(c, T.StringType(), c != key) for c in names])


def ensure_table(spark: SparkSession, path: str, columns: str, pk: str | None = None, options: dict | None = None) -> str:
    """Create an empty dimension table at `path` unless one is there."""
    schema = dimension_schema(columns, pk)
    spark.createDataFrame([], schema).write.mode("ignore").options(**(options or {})).parquet(path)
    return path


# --- enrichment ------------------------------------------------------------
def enrich(df: DataFrame, dim: DataFrame, key: str, take: dict[str, str], how: str = "inner") -> DataFrame:
    """Add dimension columns by `id`; a row whose key is unknown is dropped, or
    kept with NULLs when `how` is `left`."""
    return lookup(df, dim, key, "id", take, how)


def category_tree(dims: dict[str, DataFrame]) -> DataFrame:
    """The three category levels flattened to one row per lowest category."""
    level3 = dims["category3"].select(
        F.col("id").alias("category3_id"), F.col("name").alias("category3_name"), "category2_id"
    )
    level2 = enrich(level3, dims["category2"], "category2_id", {"name": "category2_name", "category1_id": "category1_id"})
    return enrich(level2, dims["category1"], "category1_id", {"name": "category1_name"})


def with_categories(df: DataFrame, dims: dict[str, DataFrame], how: str = "inner") -> DataFrame:
    """Adds the category levels, from the stored tree `categories` where there is one."""
    tree = dims["categories"] if "categories" in dims else category_tree(dims)
    names = ["category3_name", "category2_id", "category2_name", "category1_id", "category1_name"]
    return lookup(df, tree, "category3_id", "category3_id", {n: n for n in names}, how)


def with_sku(df: DataFrame, dims: dict[str, DataFrame], spu: bool = True, how: str = "inner") -> DataFrame:
    take = {"tm_id": "trademark_id", "category3_id": "category3_id"}
    if spu:
        take = {"spu_id": "spu_id", **take}
    return enrich(df, dims["sku"], "sku_id", take, how)


def with_trademark(df: DataFrame, dims: dict[str, DataFrame], how: str = "inner") -> DataFrame:
    return enrich(df, dims["trademark"], "trademark_id", {"tm_name": "trademark_name"}, how)


def with_spu(df: DataFrame, dims: dict[str, DataFrame], how: str = "inner") -> DataFrame:
    return enrich(df, dims["spu"], "spu_id", {"spu_name": "spu_name"}, how)


def with_province(df: DataFrame, dims: dict[str, DataFrame], how: str = "inner") -> DataFrame:
    return enrich(df, dims["province"], "province_id", {"name": "province_name"}, how)
