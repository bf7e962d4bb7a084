"""Helpers the operators share: stored tables, gapless numbering, connected components, text bytes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import work_folder

#: Skewed joins are split at run time, also where a later operator then needs its own shuffle.
_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, read with the settings the operators rely on."""
    for key, value in _CONF.items():
        spark.conf.set(key, value)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table into the shared work folder and read it back.

    This cuts the lineage: what reads it never computes it again, also not after
    an executor is lost.
    """
    spark = df.sparkSession
    path = work_folder(spark, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """The name, with underscores before it as long as the table has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def crc_of_id(column: str = "doc_id") -> Column:
    """crc32 of an id written as text; a missing id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def partial_rows(batches: Iterator, rows: int) -> Iterator:
    """Arrow batches cut to at most `rows` rows, so that a step's memory is bounded."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def dense_positions(df: DataFrame, groups: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Number the rows of each group from 0 without gaps, in the given order.

    A window over a group would put the group into one task.  Here the rows are
    dealt out by range, numbered inside each range, and each (range, group) gets
    the number of the group's earlier rows from a small table of counts.  Equal
    rows may be dealt to different ranges; their order among each other is free.
    """
    keys = [*groups, *order]
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    spread = tied.repartitionByRange(*[F.col(k).asc_nulls_first() for k in keys], F.col("_tie"))
    spread = spread.sortWithinPartitions(*[F.col(k).asc_nulls_first() for k in keys], F.col("_tie"))
    at = stored(
        spread.drop("_tie").withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33)),
        "positions",
    )
    # One row per range and group: a few rows for each task, not for each row.
    counts = at.groupBy(*groups, "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_from"))
    earlier = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *[F.col(g).alias(f"_{g}") for g in groups],
        F.col("_part").alias("_p"),
        "_from",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
    )
    found = F.expr(" and ".join([f"{g} <=> _{g}" for g in groups] + ["_part = _p"]))
    return at.join(offsets, found).withColumn(name, F.col("_before") + F.col("_at") - F.col("_from")).select(*df.columns, name)


def connected(edges: DataFrame) -> DataFrame:
    """Connected components of undirected edges `a`, `b`: one row `node`, `root` per node, root the least node.

    Alternates two star steps until nothing changes: every node hands its least
    neighbour to its larger neighbours, then to its smaller ones.  Each step is
    a pre-aggregated minimum and a join; the number of steps grows with the
    logarithm of the size.  No component is ever gathered.
    """

    def star(pairs: DataFrame) -> DataFrame:
        least = pairs.groupBy("u").agg(F.min("v").alias("m"))
        return pairs.join(least, "u").withColumn("m", F.least("u", "m"))

    now = stored(edges.selectExpr("greatest(a, b) as u", "least(a, b) as v").where("u <> v").distinct(), "links")
    last = None
    while True:
        both = now.unionByName(now.selectExpr("v as u", "u as v"))
        large = star(both).where("v > u").selectExpr("v as u", "m as v").where("u <> v").distinct()
        large = stored(large, "links")
        small = star(large).selectExpr("explode(array(struct(v as u, m as v), struct(u, m as v))) as e").select("e.*")
        now = stored(small.where("u <> v").distinct(), "links")
        state = now.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if state == last:
            break
        last = state
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
