"""Importance resampling towards a target distribution, on hashed word n-grams.

Separators are collapsed to single blanks, and an overlapped regular expression
with look-arounds at the blanks gives every run of words as a span, which is
counted under its CRC.  A document weighs the mean log ratio of the target's and
the corpus's share of its buckets; Gumbel noise from its id turns the highest
scores into a draw without replacement.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: What lies between words once A-Z are lower-cased; bytes over 7F belong to words.
SEPARATORS = rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
FEATURES = "id long, n_words long, n_features long, buckets array<int>, counts array<int>"


def spans_of(words: int) -> bytes:
    """A run of so many words, which starts and ends where a word does."""
    return rb"(?<![^ ])[^ ]+" + rb" [^ ]+" * (words - 1) + rb"(?![^ ])"


def squeezed(text: bytes, separators) -> bytes:
    return separators.sub(b" ", text.lower()).strip(b" ")


def _features(batches: Iterator, grams: tuple[int, int], buckets: int) -> Iterator:
    import zlib

    import numpy as np
    import pyarrow as pa
    import regex

    separators = regex.compile(SEPARATORS)
    spans = [regex.compile(spans_of(n)) for n in range(grams[0], grams[1] + 1)]
    for batch in common.partial_rows(batches, 500):
        words, totals, found, counts = [], [], [], []
        for text in batch.column(1).to_pylist():
            line = squeezed(text or b"", separators)
            crcs = [zlib.crc32(m.group()) for span in spans for m in span.finditer(line, overlapped=True)]
            bucket, count = np.unique(np.array(crcs, np.int64) % buckets, return_counts=True)
            words.append(line.count(b" ") + 1 if line else 0)
            totals.append(len(crcs))
            found.append(bucket)
            counts.append(count)
        ends = pa.array(np.cumsum([0, *map(len, found)]).astype(np.int32))
        lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(c).astype(np.int32))) for c in (found, counts)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(words, pa.int64()), pa.array(totals, pa.int64()), *lists],
            names=["id", "n_words", "n_features", "buckets", "counts"],
        )


def features(docs: DataFrame, id_col: str, text_col: str, grams: tuple[int, int], buckets: int) -> DataFrame:
    """Words, features and the count of every bucket, per row; a null text has none."""
    if not 1 <= grams[0] <= grams[1] or buckets < 1:
        raise ValueError("runs have one word or more, and there is a bucket")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(partial(_features, grams=grams, buckets=buckets), FEATURES)


def _flat(batch):
    import numpy as np

    return [np.asarray(batch.column(name).flatten()) for name in ("buckets", "counts")]


def _totals(batches: Iterator, buckets: int) -> Iterator:
    import numpy as np
    import pyarrow as pa

    total = np.zeros(buckets, np.int64)
    for batch in batches:
        bucket, count = _flat(batch)
        np.add.at(total, bucket, count)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bucket", "n"])


def bucket_totals(found: DataFrame, buckets: int) -> list[int]:
    """Features in each bucket over all rows: every task hands on at most one row per bucket."""
    parts = found.select("buckets", "counts").mapInArrow(partial(_totals, buckets=buckets), "bucket int, n long")
    out = [0] * buckets
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def gains(corpus: list[int], target: list[int]) -> list[int]:
    """Each bucket's log ratio of shares in thousandths, one feature added to every bucket of both."""
    from math import floor, log

    size = len(corpus)
    s, t = float(sum(corpus) + size), float(sum(target) + size)
    return [floor(1000 * log((b + 1.0) * s / ((a + 1.0) * t))) for a, b in zip(corpus, target)]


def _weigh(batches: Iterator, gain: list[int]) -> Iterator:
    import numpy as np
    import pyarrow as pa

    known = np.array(gain, np.int64)
    for batch in batches:
        bucket, count = _flat(batch)
        sums = np.concatenate([[0], np.cumsum(known[bucket] * count)])
        ends = np.concatenate([[0], np.cumsum(np.asarray(batch.column("buckets").value_lengths()))]).astype(np.int64)
        n = np.asarray(batch.column("n_features"))
        weight = (sums[ends[1:]] - sums[ends[:-1]]) // np.maximum(n, 1)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("n_words"), batch.column("n_features"), pa.array(weight)],
            names=["id", "n_words", "n_features", "weight"],
        )


def noise(seed: int) -> F.Column:
    """Gumbel noise in thousandths, from the id alone; a missing id is an empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(-1000 * F.log(-F.log(uniform))).cast("long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    least_words: int = 20,
    grams: tuple[int, int] = (1, 2),
    buckets: int = 10000,
    seed: int = 2024,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
) -> DataFrame:
    """`id`, `n_words`, `n_features`, `weight`, `score`, `rank` of every row of `docs`.

    Of the rows with `least_words` words or more, `percent` percent (rounded
    down) are drawn by the highest score; `rank` counts them from 1 and is null
    elsewhere.  Ties go to the smaller id, missing ids first; rows equal in both
    keep their number but not their order.  Null and empty texts have no
    features, weigh 0 and are drawn only where `least_words` is 0.  Repeated rows
    are rows of their own.  An empty target has no features, so a bucket gains
    by its rarity alone; an empty table gives no rows.
    """
    found = common.stored(features(docs, id_col, text_col, grams, buckets), "features")
    # Only the row count of the target's features matters, so they need no id.
    wanted = features(target.withColumn("_none", F.lit(None).cast("long")), "_none", target_col, grams, buckets)
    gain = gains(bucket_totals(found, buckets), bucket_totals(wanted, buckets))
    weighed = found.mapInArrow(partial(_weigh, gain=gain), "id long, n_words long, n_features long, weight long")
    scored = weighed.withColumn("score", F.col("weight") + noise(seed)).withColumn("_in", F.col("n_words") >= least_words)
    scored = common.stored(scored.withColumn("_down", -F.col("score")), "scores")
    drawn = scored.where("_in").count() * percent // 100
    # The draw grows with the table, so ranks come from ranges and not from one sorted list.
    ranked = common.dense_positions(scored, ["_in"], ["_down", "id"], "_at")
    rank = F.when(F.col("_in") & (F.col("_at") < drawn), F.col("_at") + 1)
    return ranked.select("id", "n_words", "n_features", "weight", "score", rank.alias("rank"))


def drawn_rows(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", **params) -> DataFrame:
    """The rows of `docs` that `resample` draws, with all their columns; rows that share a drawn id come together."""
    chosen = resample(docs, target, id_col=id_col, **params).where("rank is not null")
    ids = chosen.select(F.col("id").alias("_drawn")).distinct()
    return docs.join(ids, docs[id_col].cast("long").eqNullSafe(ids["_drawn"]), "left_semi")
