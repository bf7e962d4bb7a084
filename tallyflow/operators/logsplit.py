"""Splitting the application log into page, start, display, action and error rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _with_parent(df: DataFrame, array: str, *extra: str) -> DataFrame:
    """One row per element of `array`, the element joined with parent fields."""
    return df.where(F.col("start").isNull()).select(
        F.explode(array).alias("item"),
        F.to_json("common").alias("common"),
        F.col("page.page_id").alias("page_id"),
        *extra,
    )


def error_log(logs: DataFrame) -> DataFrame:
    """Full records that carry an error, whatever else they hold."""
    return logs.where(F.col("err").isNotNull())


def start_log(logs: DataFrame) -> DataFrame:
    return logs.where(F.col("start").isNotNull()).drop("err")


def display_log(logs: DataFrame) -> DataFrame:
    """Exposures: element fields, `common` as JSON text, page and record time."""
    return _with_parent(logs, "displays", "ts").withColumnRenamed("item", "display")


def action_log(logs: DataFrame) -> DataFrame:
    """Actions: as exposures, but an action keeps its own time."""
    rows = _with_parent(logs, "actions").withColumnRenamed("item", "action")
    return rows.withColumn("ts", F.col("action").getItem("ts").try_cast("bigint"))


def page_log(logs: DataFrame) -> DataFrame:
    return logs.where(F.col("start").isNull()).drop("err", "displays", "actions")


def split_log(logs: DataFrame) -> dict[str, DataFrame]:
    """The five outputs over one parsed and repaired log."""
    return {
        "page": page_log(logs),
        "start": start_log(logs),
        "display": display_log(logs),
        "action": action_log(logs),
        "error": error_log(logs),
    }


def as_event(rows: DataFrame, element: str) -> DataFrame:
    """Write form of a display or action: one flat text map."""
    parent = {"common": "common", "page_id": "page_id"}
    if element == "display":
        parent["ts"] = "ts"
    pairs = [part for name, c in parent.items() for part in (F.lit(name), F.col(c).cast("string"))]
    keep = F.map_filter(element, lambda k, _: ~k.isin(*parent))
    return rows.select(F.to_json(F.map_concat(keep, F.create_map(*pairs))).alias("value"))
