"""Text quality by Bradley-Terry ranking.

A document's strength is a weighted sum of features of its text.  The weights
are learned from preference pairs, a good document against a bad one, by
logistic loss on the difference of their features.  A quantile of the strengths
of the labelled rows is the threshold.  All labelled rows take part in both;
sums over them are made where the rows lie.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Preference pairs: this many in small tables, and this many for each row of the more frequent label in large ones.
PAIRS, PAIRS_A_ROW = 60_000, 3
#: Quantiles that are tried as thresholds.
LEVELS = 1001
#: The score that the threshold strength gets.
CUT = 0.3

_PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def features(text: str):
    """A fixed number of figures about a text: lengths, case, digits, repeats and every punctuation mark's rate."""
    import numpy as np

    raw = text.encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words, lines = raw.split(), raw.split(b"\n")
    n = max(1, len(words))
    upper, lower = counts[65:91].sum(), counts[97:123].sum()
    marks = counts[list(_PUNCTUATION)] / n
    shape = [
        np.log1p(len(words)),
        len(raw) / n,
        upper / max(1, upper + lower),
        counts[48:58].sum() / max(1, len(raw)),
        counts[128:].sum() / max(1, len(raw)),
        counts[:32].sum() / n,
        len(set(words)) / n,
        len(set(lines)) / len(lines),
        np.log1p(n / len(lines)),
        marks.sum(),
    ]
    return np.concatenate([shape, np.log1p(20 * marks)])


class Model(NamedTuple):
    mean: list[float]
    scale: list[float]
    weights: list[float]
    threshold: float

    def score(self, rows):
        """Between 0 and 1, `CUT` at the threshold, rising with the strength."""
        import numpy as np

        strength = ((rows - np.array(self.mean)) / np.array(self.scale)) @ np.array(self.weights)
        logit = np.log(CUT / (1 - CUT)) + strength - self.threshold
        return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


def _pair_sums(diff, weights):
    """Slope and bend of the logistic loss over rows of feature differences, in one row."""
    import numpy as np

    p = 1 / (1 + np.exp(np.clip(diff @ weights, -500, 500)))
    return np.concatenate([diff.T @ p, ((diff * (p * (1 - p))[:, None]).T @ diff).ravel()])


def _newton(sums_of, count: int, width: int, strength_of_prior: float):
    """Weights by Newton's method; `sums_of(weights)` are the sums over all pairs."""
    import numpy as np

    weights = np.zeros(width)
    for _ in range(30):
        sums = sums_of(weights) / count
        slope = sums[:width] - strength_of_prior * weights
        bend = sums[width:].reshape(width, width) + strength_of_prior * np.eye(width)
        step = np.linalg.solve(bend, slope)
        weights += step * min(1.0, 5.0 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return weights


def fit_pairs(good, bad, strength_of_prior: float = 1e-3, seed: int = 7):
    """Weights that make good rows outrank bad ones: logistic loss on feature differences, by Newton's method."""
    import numpy as np

    rng = np.random.default_rng(seed)
    count = min(PAIRS, len(good) * len(bad))
    diff = good[rng.integers(0, len(good), count)] - bad[rng.integers(0, len(bad), count)]
    return _newton(lambda weights: _pair_sums(diff, weights), count, diff.shape[1], strength_of_prior)


def _sums(batches: Iterator, of, columns: int) -> Iterator:
    """The sum of `of(arrays, other columns)` over the batches of a task, as one row."""
    import numpy as np
    import pyarrow as pa

    total = None
    for batch in common.partial_rows(batches, 10_000):
        if batch.num_rows:
            arrays = [c.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1) for c in batch.columns[:columns]]
            found = of(*arrays, *[c.to_numpy(zero_copy_only=False) for c in batch.columns[columns:]])
            total = found if total is None else total + found
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["total"])


def _total(table: DataFrame, of, columns: int = 1):
    """Sums over all rows of a table: its first columns are arrays; each task gives one row of fixed length."""
    import numpy as np

    rows = table.mapInArrow(partial(_sums, of=of, columns=columns), "total array<double>").collect()
    return np.sum([r.total for r in rows], axis=0) if rows else None


def _moments(x):
    import numpy as np

    return np.concatenate([[len(x)], x.sum(axis=0)])


def _spread(x, mean):
    return ((x - mean) ** 2).sum(axis=0)


def _scaled_pair_sums(good, bad, scale, weights):
    return _pair_sums((good - bad) / scale, weights)


def _below(strength, label, levels):
    """How many bad and good strengths lie below each level."""
    import numpy as np

    return np.concatenate([np.searchsorted(np.sort(strength[label == kind, 0]), levels) for kind in (0, 1)])


def _strengths(batches: Iterator, mean, scale, weights) -> Iterator:
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        rows = batch.column(0).flatten().to_numpy().astype(np.float64).reshape(batch.num_rows, len(mean))
        yield pa.RecordBatch.from_arrays([pa.array(((rows - mean) / scale) @ weights), batch.column(1)], names=["strength", "label"])


def _pairs(rows: DataFrame, few: int, many: int, counts: dict[int, int]) -> DataFrame:
    """Features `good` and `bad` of preference pairs: every row of the frequent label with several of the other, each of which has its turn."""
    each = min(counts[few], max(PAIRS_A_ROW, -(-PAIRS // counts[many])))
    placed = common.stored(common.dense_positions(rows.withColumn("h", F.xxhash64("id")), ["label"], ["h", "id", "x"], "at"), "placed")
    partner = F.explode(F.transform(F.sequence(F.lit(0), F.lit(each - 1)), lambda k: (F.col("at") * each + k) % counts[few]))
    left = placed.where(F.col("label") == many).select(F.col("x").alias("frequent"), partner.alias("at"))
    both = left.join(placed.where(F.col("label") == few).select("at", F.col("x").alias("seldom")), "at")
    good, bad = ("frequent", "seldom") if many == 1 else ("seldom", "frequent")
    return common.stored(both.select(F.col(good).alias("good"), F.col(bad).alias("bad")), "pairs")


def fit(rows: DataFrame) -> Model:
    """A model from rows of `id`, `x` and 0/1 `label`.

    The threshold is the quantile of the strengths that tells the labels apart
    best, good and bad ones counting alike; among equals the lowest, which
    rejects least.  With labels of one kind only, all rows score on that side.
    """
    import numpy as np

    counts = {r.label: r.n for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        width = len(features(""))
        return Model([0.0] * width, [1.0] * width, [0.0] * width, -20.0)
    n, *sums = _total(rows.select("x"), _moments)
    mean = np.array(sums) / n
    scale = np.sqrt(_total(rows.select("x"), partial(_spread, mean=mean)) / n)
    scale[scale < 1e-9] = 1.0
    if len(counts) == 1:
        return Model(mean.tolist(), scale.tolist(), [0.0] * len(mean), 20.0 if 0 in counts else -20.0)
    many, few = (1, 0) if counts[1] >= counts[0] else (0, 1)
    pairs = _pairs(rows, few, many, counts)
    weights = _newton(
        lambda w: _total(pairs, partial(_scaled_pair_sums, scale=scale, weights=w), 2), pairs.count(), len(mean), 1e-3
    )
    strengths = rows.select("x", "label").mapInArrow(partial(_strengths, mean=mean, scale=scale, weights=weights), "strength double, label int")
    strengths = common.stored(strengths, "strengths")
    shares = F.lit([float(q) for q in np.linspace(0, 1, LEVELS)])
    levels = np.unique(strengths.agg(F.percentile_approx("strength", shares, 100_000).alias("q")).first().q)
    below = _total(strengths.select(F.array("strength").alias("s"), "label"), partial(_below, levels=levels))
    gone, lost = below[: len(levels)] / counts[0], below[len(levels) :] / counts[1]
    # The middle of the gap below the chosen quantile: unseen rows fall on either side of it alike.
    level = float(levels[int(np.argmax(1 - lost + gone))])
    nearest = strengths.where(F.col("strength") < level).agg(F.max("strength")).first()[0]
    threshold = level if nearest is None else (level + nearest) / 2
    return Model(mean.tolist(), scale.tolist(), weights.tolist(), float(threshold))


def _feature_rows(batches: Iterator) -> Iterator:
    import numpy as np
    import pyarrow as pa

    for batch in common.partial_rows(batches, 1000):
        found = [features(t or "").astype(np.float32) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.float32()))], names=["id", "x"])


def feature_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id` and the features `x` of every row; a null text counts as empty."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_feature_rows, "id long, x array<float>")


def train(table: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> Model:
    """Fit on all labelled rows of a feature table.

    Labels other than 0 and 1, null ids and rows without a document are left out.
    """
    marks = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"))
    return fit(common.stored(table.join(marks.where("id is not null and label in (0, 1)"), "id").select("id", "x", "label"), "labelled"))


def _scores_of(batches: Iterator, model: Model) -> Iterator:
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        rows = batch.column(1).flatten().to_numpy().astype(np.float64).reshape(batch.num_rows, len(model.mean))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(rows))], names=["id", "score"])


def rank(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """`id` and `score` per row of `docs`, by a model fitted on `labels`.

    Repeated rows stay; a null id is scored and never learned from; null and
    empty texts get the score of an empty text.  Without usable labels every
    row scores above the threshold.  An empty table gives no rows.
    """
    table = common.stored(feature_table(docs, id_col, text_col), "features")
    model = train(table, labels, id_col, label_col)
    return table.mapInArrow(partial(_scores_of, model=model), "id long, score double")


def _scores(batches: Iterator, model: Model, at: int, name: str) -> Iterator:
    import numpy as np
    import pyarrow as pa

    for batch in common.partial_rows(batches, 1000):
        rows = np.array([features(t or "") for t in batch.column(at).to_pylist()])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.score(rows))], names=[*batch.schema.names, name])


def with_score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """`docs` with one more column; a null text scores as an empty one."""
    from pyspark.sql import types as T

    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    return docs.mapInArrow(partial(_scores, model=model, at=docs.columns.index(text_col), name=name), schema)


def keep_good(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of `docs` that score at least `CUT`, all columns as they are."""
    name = common.unused(docs, "score")
    return with_score(docs, model, text_col, name).where(F.col(name) >= CUT).select(*docs.columns)
