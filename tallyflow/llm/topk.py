"""Exact top-k search by inner product with a pivot-distance index.

Vectors get one more component that makes all their lengths equal; then the
largest inner products are the smallest distances.  Every vector is keyed by its
nearest pivot and its distance to it, and the sorted keys are cut into annuli of
a fixed number of vectors.  A query first searches the annulus it lies in, which
bounds the distance of its k-th neighbour.  By the triangle inequality an annulus
is at least as far as the query's own pivot distance is outside it, so annuli are
expanded in order of that gap, twice as many in every round; the bound tightens
between rounds, and a query stops as soon as its next gap is beyond it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Pivots, vectors they are chosen from, vectors of an annulus, queries of a task.
PIVOTS, SAMPLE, ANNULUS, BATCH = 16, 1024, 1024, 4096


class Pivots(NamedTuple):
    """Pivots with their added component as last column; `square` is every vector's squared length then."""

    points: list[list[float]]
    square: float
    width: int


def matrix(raw, width: int, kind=float):
    """Rows of numbers from packed vectors, padded with zeros to `width`."""
    import numpy as np

    out = np.zeros((len(raw), width), kind)
    for i, value in enumerate(raw):
        one = np.frombuffer(value, np.int64)
        out[i, : len(one)] = one
    return out


def lifted(rows, square: float):
    """Rows with the component added that makes their squared length `square`."""
    import numpy as np

    rest = np.sqrt(np.maximum(0.0, square - (rows * rows).sum(axis=1)))
    return np.concatenate([rows, rest[:, None]], axis=1)


def distances(points, pivots: Pivots):
    """Distances of lifted points to all pivots."""
    import numpy as np

    to = np.array(pivots.points).reshape(-1, points.shape[1])
    return np.sqrt(np.maximum(0.0, 2 * pivots.square - 2 * points @ to.T))


def choose_pivots(raw, square: float, width: int, count: int = PIVOTS) -> Pivots:
    """From a sample, the vector furthest from all pivots so far, again and again."""
    import numpy as np

    points = lifted(matrix(raw, width), square)
    chosen = [0]
    near = np.full(len(points), np.inf)
    while len(chosen) < min(count, len(points)):
        near = np.minimum(near, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
        if near.max() <= 0:
            break
        chosen.append(int(near.argmax()))
    return Pivots(points[chosen].tolist(), square, width)


def _pack(batches: Iterator) -> Iterator:
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        values = [np.array(v, np.int64) for v in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([v.tobytes() for v in values], pa.binary()),
                # As doubles, rounded up: squares of large components would not fit a long.
                pa.array([float(w @ w) * (1 + 1e-12) for w in (v.astype(float) for v in values)], pa.float64()),
                pa.array([len(v) for v in values], pa.int32()),
                batch.column(2),
            ],
            names=["id", "v", "square", "width", "asks"],
        )


def _key(batches: Iterator, pivots: Pivots) -> Iterator:
    import numpy as np
    import pyarrow as pa

    for batch in common.partial_rows(batches, 4096):
        d = distances(lifted(matrix(batch.column(1).to_pylist(), pivots.width), pivots.square), pivots)
        nearest = d.argmin(axis=1)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(nearest.astype(np.int32)), pa.array(d[np.arange(len(d)), nearest])],
            names=[*batch.schema.names, "pivot", "distance"],
        )


def whole_scores(rough, queries, vectors, width: int):
    """Inner products as whole numbers, where doubles are not exact; one that no long holds is an error.

    A vector's product with itself may be no answer, so it may be too large; it then counts as the largest long.
    """
    import numpy as np

    beyond = np.abs(rough) >= 2.0**63 * (1 - 1e-9)
    if any(queries["v"].iloc[i] != vectors["v"].iloc[j] for i, j in np.argwhere(beyond)):
        raise ValueError("an inner product is too large for a long")
    scores = matrix(queries["v"], width, np.int64) @ matrix(vectors["v"], width, np.int64).T
    return np.where(beyond, np.iinfo(np.int64).max, scores)


def _search(key, vectors, queries, width: int, k: int):
    """The best k of an annulus for each of a batch of queries, as far as they reach the queries' bounds."""
    import numpy as np
    import pandas as pd

    found = []
    if len(vectors) and len(queries):
        # Rows lie by id, so a stable sort settles ties.
        vectors = vectors.sort_values("id", kind="stable")
        x, ids, copies = matrix(vectors["v"], width), vectors["id"].to_numpy(), vectors["copies"].to_numpy()
        # No part of a sum is more than both lengths multiplied, so short vectors are exact in doubles.
        reach = np.sqrt((x * x).sum(axis=1).max())
        for at in range(0, len(queries), 512):
            some = queries.iloc[at : at + 512]
            asked = matrix(some["v"], width)
            scores = asked @ x.T
            if np.sqrt((asked * asked).sum(axis=1).max()) * reach >= 2.0**53:
                scores = whole_scores(scores, some, vectors, width)
            for row, query, bound in zip(scores, some["query"], np.nextafter(some["bound"].to_numpy(), -np.inf)):
                near = np.flatnonzero(row >= bound)
                if len(near) > k:
                    near = near[np.argsort(-row[near], kind="stable")[:k]]
                found.append((np.full(len(near), query), ids[near], copies[near], row[near].astype(np.int64)))
    columns = [np.concatenate(c) for c in zip(*found)] if found else [np.empty(0, np.int64)] * 4
    return pd.DataFrame(dict(zip(("query", "id", "copies", "score"), columns)))


def _to_pivots(batches: Iterator, pivots: Pivots) -> Iterator:
    """Each query's distance to every pivot, and its own squared length."""
    import numpy as np
    import pyarrow as pa

    for batch in common.partial_rows(batches, 1024):
        q = matrix(batch.column(1).to_pylist(), pivots.width)
        # The added component of a query is 0, whatever its length.
        flat = np.concatenate([q, np.zeros((len(q), 1))], axis=1)
        to = np.array(pivots.points).reshape(-1, flat.shape[1])
        squares = (q * q).sum(axis=1)
        d = np.sqrt(np.maximum(0.0, squares[:, None] + pivots.square - 2 * flat @ to.T))
        n = d.shape[1]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(batch.column(0).to_numpy(), n)),
                pa.array(np.tile(np.arange(n, dtype=np.int32), len(q))),
                pa.array(d.reshape(-1)),
                pa.array(np.repeat(squares, n)),
            ],
            names=["query", "pivot", "d", "own"],
        )


def top_k(vectors: DataFrame, k: int = 20) -> DataFrame:
    """The k best scoring other vectors of every asking one: `query`, `rank`, `id`, `score`.

    `vectors` has `id` (long), `v` (array of longs) and `asks` (boolean).  The
    score is the exact inner product, and a ValueError says where no long holds
    it; ties go to the smaller id.  Shorter vectors count as filled up with
    zeros.  Rows with a null id, vector or component take no part.  Rows that
    repeat an id are results of their own, but none is its own query's; a query
    that repeats its vector asks once.  With fewer than k others a query has as
    many results.  An empty table gives no rows.

    Equal vectors have equal answers and score alike, so the index holds of each
    vector the smallest ids, as many as an answer can hold, and each is searched
    for once.
    """
    spark = vectors.sparkSession
    full = vectors.where("id is not null and v is not null and not exists(v, x -> x is null)")
    packed = full.select("id", "v", F.coalesce("asks", F.lit(False)).alias("asks"))
    rows = common.stored(packed.mapInArrow(_pack, "id long, v binary, square double, width int, asks boolean"), "vectors")
    lasts = rows.agg(F.max("square"), F.max("width")).first()
    if lasts[0] is None:
        return spark.createDataFrame([], "query long, rank int, id long, score long")
    square, width = float(lasts[0]), int(lasts[1])
    sample = rows.orderBy(F.xxhash64("v"), "v").limit(SAMPLE).select("v").collect()
    pivots = choose_pivots(sorted({bytes(r.v) for r in sample}), square, width)

    single = common.stored(rows.groupBy("id", "v").agg(F.count("*").alias("copies"), F.max("asks").alias("asks")), "single")
    # An answer leaves out its query's own vectors, mostly one.
    most = k + (single.groupBy("id").count().agg(F.max("count")).first()[0] or 1)
    same = Window.partitionBy("v").orderBy("id")
    kept = single.select("id", "v", "copies").withColumn("n", F.row_number().over(same)).where(F.col("n") <= most)
    keyed = common.stored(
        kept.mapInArrow(partial(_key, pivots=pivots), "id long, v binary, copies long, n int, pivot int, distance double"), "keys"
    )
    placed = common.dense_positions(keyed, ["pivot"], ["distance", "id"], "at")
    index = common.stored(placed.withColumn("annulus", F.expr(f"pivot * 1000000000L + at div {ANNULUS}")), "index")
    annuli = index.groupBy("annulus", "pivot").agg(F.min("distance").alias("inner"), F.max("distance").alias("outer"))

    asking = index.where("n = 1").select("v", F.col("annulus").alias("home")).join(single.where("asks").select("v").distinct(), "v")
    asking = common.dense_positions(common.stored(asking, "asking"), [], ["home", "v"], "query")
    asking = common.stored(asking.select("query", "v", "home", F.expr(f"query div {BATCH}").alias("batch")), "asking")

    def searched(pairs: DataFrame) -> DataFrame:
        """`pairs`: `query`, `v`, `batch`, `bound` and the `annulus` to search."""
        needed = pairs.select(F.col("annulus").alias("part"), F.col("batch").alias("set")).distinct()
        sides = index.join(needed, F.col("annulus") == F.col("part")).select("part", "set", "id", "v", "copies").groupBy("part", "set")
        return sides.cogroup(pairs.groupBy("annulus", "batch")).applyInPandas(
            partial(_search, width=width, k=most), "query long, id long, copies long, score long"
        )

    best = Window.partitionBy("query").orderBy(F.desc("score"), "id")

    def best_of(found: DataFrame) -> DataFrame:
        return common.stored(found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= most).drop("n"), "lists")

    everything = F.lit(float("-inf"))

    def bounds(lists: DataFrame) -> DataFrame:
        """Per query the score that a better vector must reach, and how far it can be at most."""
        last = F.when(F.count("*") >= most, F.min("score").cast("double")).otherwise(everything)
        reached = asking.join(lists.groupBy("query").agg(last.alias("bound")), "query").join(own, "query")
        far = F.sqrt(F.greatest(F.lit(0.0), F.col("own") + square - 2 * F.col("bound")))
        return common.stored(reached.select("query", "v", "batch", "bound", far.alias("radius")), "bounds")

    to_pivots = common.stored(
        asking.select("query", "v").mapInArrow(partial(_to_pivots, pivots=pivots), "query long, pivot int, d double, own double"), "reach"
    )
    own = to_pivots.where("pivot = 0").select("query", "own")
    lists = best_of(searched(asking.select("query", "v", "batch", everything.alias("bound"), F.col("home").alias("annulus"))))
    bounded = bounds(lists)
    # Far over the rounding of distances.
    can = F.expr("gap <= radius + 1e-6 * (1 + d + radius)")
    gaps = to_pivots.join(annuli, "pivot").withColumn("gap", F.greatest(F.col("inner") - F.col("d"), F.col("d") - F.col("outer"), F.lit(0.0)))
    gaps = gaps.join(bounded.select("query", "radius"), "query").where(can).join(asking.select("query", "home"), "query").where("annulus <> home")
    nearest = Window.partitionBy("query").orderBy("gap", "annulus")
    gaps = common.stored(gaps.select("query", "annulus", "gap", "d").withColumn("turn", F.row_number().over(nearest)), "gaps")
    done, step = 0, 1
    while True:
        turn = gaps.where(f"turn > {done} and turn <= {done + step}").join(bounded, "query").where(can)
        turn = common.stored(turn.select("query", "v", "batch", "bound", "annulus"), "turn")
        if turn.isEmpty():
            # Gaps only grow, so no query has a later one within its radius.
            break
        lists = best_of(lists.unionByName(searched(turn)))
        bounded = bounds(lists)
        done, step = done + step, 2 * step

    askers = single.where("asks").select("v", F.col("id").alias("asker")).join(asking.select("v", "query"), "v")
    answers = askers.select("asker", "query").join(lists, "query").where("id <> asker")
    answers = answers.select("*", F.explode(F.expr(f"sequence(1, least(copies, {k}))")).alias("copy"))
    mine = Window.partitionBy("asker", "query").orderBy(F.desc("score"), "id")
    ranked = answers.withColumn("rank", F.row_number().over(mine)).where(F.col("rank") <= k)
    too_large = F.raise_error(F.lit("an inner product is too large for a long")).cast("long")
    score = F.when(F.col("score") == (1 << 63) - 1, too_large).otherwise(F.col("score"))
    return ranked.select(F.col("asker").alias("query"), "rank", "id", score.alias("score"))
