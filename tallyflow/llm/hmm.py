"""A hidden Markov language model over words, trained by Baum-Welch over all partitions.

States emit word classes, and a class emits its words.  The most frequent words
are classes of their own, all others fall into classes by their ending, so the
states' tables have a fixed size while the word counts grow with the corpus.

    P(text) = P(classes of its words and the end) * product of P(word | class)

The first factor is the exact likelihood by the scaled forward recursion.  The
second needs every word's count: those of frequent words are known to each task,
all others are joined.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import partial
from itertools import repeat
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Hidden states; word classes: words of their own, endings, and the end of a text.
STATES, OWN, ENDINGS = 8, 4096, 4095
CLASSES = OWN + ENDINGS + 1
END = CLASSES - 1
#: Words whose counts every task knows, and the longest of them in bytes; all others are joined.
HEAD, HEAD_BYTES = 131_072, 64
#: Added to a word's count.
ADDED = 0.1
#: Rounds that find the states, and the last ones; each goes over all training texts.
WARM_ROUNDS, ROUNDS = 12, 2


def words_of(text: str | None) -> list[bytes]:
    """Words of a text, with A-Z lower-cased; a null text has none."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def ending(word: bytes) -> int:
    """The class of a word that is not its own: by its last three bytes."""
    from zlib import crc32

    return OWN + crc32(word[-3:]) % ENDINGS


# --- counting ---------------------------------------------------------------
def _count(batches: Iterator) -> Iterator:
    import pyarrow as pa

    def rows(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts.keys()), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "c"]
        )

    counts: Counter = Counter()
    for batch in common.partial_rows(batches, 500):
        for text in batch.column(0).to_pylist():
            counts.update(words_of(text))
        if len(counts) > 400_000:
            yield rows(counts)
            counts = Counter()
    yield rows(counts)


class Lexicon(NamedTuple):
    """What every task knows of the counts."""

    total: int
    distinct: int
    ends: int
    head: dict[bytes, int]  # word -> place; places below OWN are classes of their own
    counts: list[int]  # of the head, by place
    class_counts: list[float]
    class_log: list[float]  # log10 of a class's total, words and the unknown one smoothed


def _class_sizes(batches: Iterator, own) -> Iterator:
    import numpy as np
    import pyarrow as pa

    known = own.value
    n, v = np.zeros(CLASSES), np.zeros(CLASSES)
    for batch in batches:
        places = np.array([known.get(w, -1) if len(w) <= HEAD_BYTES else -1 for w in batch.column(0).to_pylist()], np.int64)
        words = batch.column(0).to_pylist()
        classes = np.array([p if 0 <= p < OWN else ending(w) for p, w in zip(places.tolist(), words)], np.int64)
        counts = batch.column(1).to_numpy()
        n += np.bincount(classes, weights=counts, minlength=CLASSES)
        v += np.bincount(classes, minlength=CLASSES)
    used = np.flatnonzero(v)
    yield pa.RecordBatch.from_arrays(
        [pa.array(used.astype(np.int32)), pa.array(n[used]), pa.array(v[used])], names=["class", "n", "v"]
    )


def lexicon(counts: DataFrame, ends: int) -> Lexicon:
    """Totals of a count table (`word`, `c`), its most frequent words, and the classes' totals.

    The head is cut at a count class, so that it never has more than `HEAD` words.
    """
    import numpy as np

    spark = counts.sparkSession
    totals = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    level = F.floor(F.log2("c") * 16)
    short = counts.where(F.octet_length("word") <= HEAD_BYTES)
    sizes = short.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect()  # under 1000 rows
    taken, cut = 0, None
    for row in sizes:
        taken += row["count"]
        if taken > HEAD:
            break
        cut = row["level"]
    rows = [] if cut is None else short.where(level >= cut).collect()  # at most HEAD rows
    rows = sorted(((r.c, bytes(r.word)) for r in rows), key=lambda r: (-r[0], r[1]))
    head = {word: at for at, (_, word) in enumerate(rows)}
    sent = spark.sparkContext.broadcast(head)
    per_class = counts.mapInArrow(partial(_class_sizes, own=sent), "class int, n double, v double")
    n, v = np.zeros(CLASSES), np.zeros(CLASSES)
    for row in per_class.groupBy("class").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect():  # at most CLASSES rows
        n[row["class"]], v[row["class"]] = row.n, row.v
    n[END] = ends
    log = np.log10(np.maximum(ADDED, n + ADDED * (v + 1)))
    return Lexicon(
        int(totals[0]) + ends, int(totals[1]) + (ends > 0), ends, head, [c for c, _ in rows], n.tolist(), log.tolist()
    )


# --- encoding ---------------------------------------------------------------
_ENCODED = (
    "id long, trains boolean, n_tokens long, n_known long, head_log double, class_log double, codes binary, "
    "tail array<struct<word:binary,n:int>>"
)


def _encode(batches: Iterator, known) -> Iterator:
    import numpy as np
    import pyarrow as pa

    lex: Lexicon = known.value
    head, log_count = lex.head.get, np.log10(np.array([*lex.counts, 1.0]) + ADDED)
    class_log = np.array(lex.class_log)
    code = np.empty(len(lex.counts) + 1, np.uint16)
    code[: min(OWN, len(lex.counts))] = np.arange(min(OWN, len(lex.counts)))
    for word, at in lex.head.items():
        if at >= OWN:
            code[at] = ending(word)
    tail_kind = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int32())]))
    for batch in common.partial_rows(batches, 500):
        rows = []
        for key, trains, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            words = words_of(text)
            at = np.fromiter(map(head, words, repeat(-1)), np.int64, len(words))
            codes = code[at]
            rare = np.flatnonzero(at < 0)
            tail: Counter = Counter()
            if len(rare):
                missing = [words[i] for i in rare.tolist()]
                codes[rare] = [ending(w) for w in missing]
                tail.update(missing)
            logs = np.where(at >= 0, log_count[at], 0.0)
            shared = codes >= OWN
            # A word that is its own class has probability 1 there: its count is part of the base alone.
            rows.append(
                (
                    key,
                    trains,
                    len(words) + 1,
                    len(words) - len(rare) + (lex.ends > 0),
                    float(logs.sum()),
                    float(logs[shared].sum() - class_log[codes[shared]].sum()),
                    np.append(codes, np.uint16(END)).tobytes(),
                    [{"word": w, "n": n} for w, n in tail.items()],
                )
            )
        kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), tail_kind]
        names = [c.split()[0] for c in _ENCODED.split(", ")]
        columns = list(zip(*rows)) or [[]] * len(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


# --- the states -------------------------------------------------------------
class States(NamedTuple):
    """Start (K), transitions (K x K) and, by class, emissions (C x K)."""

    start: object
    move: object
    emit: object


def first_states(class_counts, states: int = STATES, seed: int = 11) -> States:
    """States that differ by chance about the corpus's class shares, and tend to stay."""
    import numpy as np

    rng = np.random.default_rng(seed)
    shares = smoothed_shares(class_counts)
    emit = shares[:, None] * np.exp(0.5 * rng.standard_normal((CLASSES, states)))
    move = np.full((states, states), 0.2 / states) + 0.8 * np.eye(states)
    return States(np.full(states, 1 / states), move, emit / emit.sum(axis=0))


def smoothed_shares(class_counts):
    import numpy as np

    shares = np.array(class_counts) + ADDED
    return shares / shares.sum()


#: Cells (a text at a step) gone over together, cells of which emissions are held, and steps between two scalings.
CELLS, BLOCK, EVERY = 2_000_000, 8_192, 16


def groups_of(codes: list) -> Iterator[list[int]]:
    """Places of code arrays, by falling length, in groups of at most `CELLS` cells (or one text)."""
    group: list[int] = []
    cells = 0
    for at in sorted(range(len(codes)), key=lambda i: -len(codes[i])):
        if group and cells + len(codes[at]) > CELLS:
            yield group
            group, cells = [], 0
        group.append(at)
        cells += len(codes[at])
    if group:
        yield group


class _Group:
    """Texts of a group side by side, step by step; what is held per cell is its code, state shares and scale.

    Cells of one step lie together, those of the longest texts first, and texts
    that have ended have none.  Shares are scaled at every `EVERY`th step and at
    a text's end, all other scales are 1; emissions are far from so small that
    what lies between could vanish.
    """

    def __init__(self, codes: list, model: States):
        import numpy as np

        self.model, lengths = model, np.array([len(c) for c in codes])
        alive = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
        starts = np.concatenate([[0], np.cumsum(alive)])
        self.codes = np.empty(starts[-1], np.uint16)
        for i, c in enumerate(codes):
            self.codes[starts[: len(c)] + i] = c
        self.alive, self.starts = [*alive.tolist(), 0], starts.tolist()

    def blocks(self) -> Iterator[tuple[int, int]]:
        """Ranges of steps of about `BLOCK` cells."""
        low = 0
        for t, end in enumerate(self.starts[1:], 1):
            if end - self.starts[low] >= BLOCK or t == len(self.starts) - 1:
                yield low, t
                low = t

    def forward(self, keep: bool = False):
        """Log10 likelihood of each text; with `keep`, `shares` and `scales` stay for `counts`."""
        import numpy as np

        model, k, starts = self.model, len(self.model.start), self.starts
        if keep:
            self.shares, self.scales = np.empty((starts[-1], k)), np.ones(starts[-1])
        likelihood, ones = np.zeros(self.alive[0]), np.ones(k)
        now = None
        for low, high in self.blocks():
            first = starts[low]
            block = model.emit.take(self.codes[first : starts[high]].astype(np.intp), axis=0)
            for t in range(low, high):
                n, at = self.alive[t], starts[t] - first
                cells = block[at : at + n]
                cells *= model.start if now is None else np.dot(now[:n], model.move)
                now = cells
                scaled = 0 if t % EVERY == EVERY - 1 else self.alive[t + 1]
                if scaled < n:
                    size = np.dot(now[scaled:], ones)
                    now[scaled:] /= size[:, None]
                    likelihood[scaled:n] += np.log10(size)
                    if keep:
                        self.scales[starts[t] + scaled : starts[t] + n] = size
            if keep:
                self.shares[first : starts[high]] = block
        return likelihood

    def counts(self):
        import numpy as np

        model, k, starts = self.model, len(self.model.start), self.starts
        moves, emissions = np.zeros((k, k)), np.zeros((CLASSES, k))
        back_move = np.ascontiguousarray(model.move.T)
        ahead = np.ones((0, k))
        for low, high in reversed([*self.blocks()]):
            own = slice(starts[low], starts[high])
            codes = self.codes[own].astype(np.intp)
            # What a move into each cell is worth, and what lies ahead of it; a text's last cell has nothing ahead.
            weighted = model.emit.take(codes, axis=0)
            weighted /= self.scales[own, None]
            back = np.ones((len(codes), k))
            for t in range(high - 1, low - 1, -1):
                n, at = self.alive[t], starts[t] - starts[low]
                back[at : at + len(ahead)] = ahead
                cells = weighted[at : at + n]
                cells *= back[at : at + n]
                ahead = np.dot(cells, back_move)
            back *= self.shares[own]  # the cells' state shares given the whole text
            into = max(low, 1)
            # The cell of the same text one step before.
            alive = np.array(self.alive[into - 1 : high], np.int64)
            before = np.arange(starts[into], starts[high]) - np.repeat(alive[:-1], alive[1:])
            moves += self.shares.take(before, axis=0).T @ weighted[starts[into] - starts[low] :]
            for i, shares in enumerate(np.ascontiguousarray(back.T)):
                emissions[:, i] += np.bincount(codes, weights=shares, minlength=CLASSES)
        return back[: self.alive[0]].sum(axis=0), model.move * moves, emissions


def forward(codes: list, model: States):
    """Log10 likelihood of each array of class codes, which come by falling length.

    The scaled forward recursion runs over all texts of the group in step: at
    each place the state shares are moved, weighted by the emissions, and scaled
    to sum 1; the logarithms of the scales add up to the exact likelihood.
    """
    return _Group(codes, model).forward()


def expected_counts(codes: list, model: States):
    """Baum-Welch counts of a group of texts: starts (K), moves (K x K), emissions (C x K), and the log10 likelihood."""
    group = _Group(codes, model)
    likelihood = group.forward(keep=True)
    return (*group.counts(), float(likelihood.sum()))


def _count_states(batches: Iterator, sent) -> Iterator:
    import numpy as np
    import pyarrow as pa

    model: States = sent.value
    k = len(model.start)
    # Rows: classes, then the moves out of each state, the starts, and the likelihood.
    total = np.zeros((CLASSES + k + 2, k))
    for batch in batches:
        codes = [np.frombuffer(c, np.uint16) for c in batch.column(0).to_pylist()]
        for group in groups_of(codes):
            start, moves, emissions, likelihood = expected_counts([codes[i] for i in group], model)
            total[:CLASSES] += emissions
            total[CLASSES : CLASSES + k] += moves
            total[-2] += start
            total[-1, 0] += likelihood
    used = np.flatnonzero(total.any(axis=1))
    yield pa.RecordBatch.from_arrays(
        [pa.array(used.astype(np.int32)), *(pa.array(total[used, i]) for i in range(k))],
        names=["row", *(f"s{i}" for i in range(k))],
    )


def baum_welch(encoded: DataFrame, model: States, class_counts, prior: float = 100.0) -> tuple[States, float]:
    """One round: expected counts of every partition, added up, make the next parameters.  Also the old ones' log10 likelihood.

    What comes to the driver has a row per class and state, whatever the corpus.
    Emissions are drawn towards the corpus's class shares with the weight of
    `prior` words, so that no class is impossible.
    """
    import numpy as np

    k = len(model.start)
    sent = encoded.sparkSession.sparkContext.broadcast(model)
    schema = "row int, " + ", ".join(f"s{i} double" for i in range(k))
    parts = encoded.select("codes").mapInArrow(partial(_count_states, sent=sent), schema)
    total = np.zeros((CLASSES + k + 2, k))
    for row in parts.groupBy("row").agg(*[F.sum(f"s{i}").alias(f"s{i}") for i in range(k)]).collect():
        total[row["row"]] = row[1:]
    sent.unpersist()
    emit = total[:CLASSES] + prior * smoothed_shares(class_counts)[:, None]
    move = total[CLASSES : CLASSES + k] + 0.01 + 0.1 * np.eye(k)
    start = total[-2] + 0.1
    new = States(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))
    return new, float(total[-1, 0])


def _likelihoods(batches: Iterator, sent) -> Iterator:
    import numpy as np
    import pyarrow as pa

    model: States = sent.value
    for batch in batches:
        codes = [np.frombuffer(c, np.uint16) for c in batch.column(1).to_pylist()]
        out = np.zeros(len(codes))
        for group in groups_of(codes):
            out[group] = forward([codes[i] for i in group], model)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *batch.columns[2:], pa.array(out)], names=["id", *batch.schema.names[2:], "state_log"]
        )


def score(
    docs: DataFrame,
    trains: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    states: int = STATES,
    rounds: int = ROUNDS,
    warm_rounds: int = WARM_ROUNDS,
) -> DataFrame:
    """Learn from the rows where `trains` holds, score all rows.

    Per row: `id`, `trains`, `n_tokens` (words and the end), `n_known` (of them
    seen in training), `train_tokens`, `base_score` (log10 by word counts alone,
    each with 0.1 added) and `score`, the model's log10 probability.  All training
    texts are gone over `warm_rounds` + `rounds` times.  Null texts are empty:
    their end is scored.  Where `trains` is null a row is not learned from.  Repeated rows
    count and are scored each.  Without training rows every word is unknown.  An
    empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(trains, F.lit(False)).alias("trains"),
        F.col(text_col).cast("string").alias("text"),
    )
    learned = rows.where("trains")
    ends = learned.count()
    counted = learned.select("text").mapInArrow(_count, "word binary, c long")
    counts = common.stored(counted.groupBy("word").agg(F.sum("c").alias("c")), "counts")
    lex = lexicon(counts, ends)
    known = spark.sparkContext.broadcast(lex)
    encoded = rows.mapInArrow(partial(_encode, known=known), _ENCODED)
    encoded = common.stored(encoded.withColumn("row", F.monotonically_increasing_id()), "encoded")

    model = first_states(lex.class_counts, states)
    corpus = encoded.where("trains").select("codes")
    for _ in range(warm_rounds + rounds):
        model, _ = baum_welch(corpus, model, lex.class_counts)

    tail = encoded.select("row", F.explode("tail").alias("t")).select("row", "t.word", "t.n")
    tail = tail.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(ADDED))).alias("tail_log"),
        F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("tail_known"),
    )
    sent = spark.sparkContext.broadcast(model)
    plain = "trains boolean, n_tokens long, n_known long, head_log double, class_log double, row long"
    names = [c.split()[0] for c in plain.split(", ")]
    by_states = encoded.select("id", "codes", *names).mapInArrow(
        partial(_likelihoods, sent=sent), f"id long, {plain}, state_log double"
    )
    import math

    end_log = math.log10(lex.ends + ADDED)
    total_log = math.log10(lex.total + ADDED * (lex.distinct + 1))
    tail_log = F.coalesce("tail_log", F.lit(0.0))
    return by_states.join(tail, "row", "left").select(
        "id",
        "trains",
        "n_tokens",
        (F.col("n_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(lex.total).cast("long").alias("train_tokens"),
        (F.col("head_log") + tail_log + end_log - F.col("n_tokens") * F.lit(total_log)).alias("base_score"),
        (F.col("state_log") + F.col("class_log") + tail_log).alias("score"),
    )
