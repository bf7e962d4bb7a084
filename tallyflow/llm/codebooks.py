"""Vector codes: parts of vectors told by the nearest entry of a codebook per part.

Codebooks are moved in rounds.  A vector keeps, for each part, an upper bound of
the distance to its entry and a lower bound of the distance to all others, each
with the round in which it was measured.  All rounds' codebooks are kept, so a
bound is brought up to date by the net way that an entry went since that round
(the norm of the sum of its moves), which is never longer than the moves added
up.  Only parts whose bounds overlap are measured anew.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

STATE = "id long, label int, v binary, codes binary, upper binary, lower binary, upper_at binary, lower_at binary"
#: Bounds are compared with this share to spare, far over the rounding of square roots.
SLACK = 1e-6


class Codebooks(NamedTuple):
    """`history[r][part][entry]` is an entry's components in round r; the last round is in force."""

    history: list
    width: int
    exact: str

    def digest(self) -> str:
        """SHA-256 of the entries' components as decimal text, by part, entry and position."""
        text = ",".join(str(int(x)) for part in self.history[-1] for entry in part for x in entry)
        return hashlib.sha256(text.encode()).hexdigest()


class State(NamedTuple):
    """Per vector and part: the entry, both bounds, and the rounds in which they were measured."""

    codes: object
    upper: object
    lower: object
    upper_at: object
    lower_at: object


#: How each member of the state lies in a row.
_LAYOUT = State("u1", "f8", "f8", "u1", "u1")


def squares(x, entries):
    """Squared distances of rows to entries; exact, as every term is a whole number that the type holds."""
    return (x * x).sum(axis=1)[:, None] - 2 * (x @ entries.T) + (entries * entries).sum(axis=1)


def net_moves(history, part: int):
    """For each earlier round: how far every entry is from where it was, and the furthest of all but that entry."""
    import numpy as np

    now = history[-1][part].astype(float)
    own, others = [], []
    for then in history:
        way = np.sqrt(((now - then[part].astype(float)) ** 2).sum(axis=1))
        first = int(way.argmax())
        rest = np.full(len(way), way[first])
        rest[first] = np.delete(way, first).max() if len(way) > 1 else 0.0
        own.append(way)
        others.append(rest)
    return np.array(own), np.array(others)


def assign(x, state: State | None, history) -> tuple[State, int]:
    """The nearest entry of the last codebook for each part of `x` (vectors, parts, width), and how many were rescanned.

    Ties go to the lower index: a part keeps its entry without a rescan only if
    all others are certainly further.
    """
    import numpy as np

    n, parts, _ = x.shape
    now = len(history) - 1
    fresh = state is None
    if fresh:
        state = State(*[np.zeros((n, parts), kind) for kind in _LAYOUT])
    codes, upper, lower, upper_at, lower_at = (m.copy() for m in state)
    rescans = 0
    for p in range(parts):
        entries, own = history[-1][p], x[:, p]
        open_ = np.arange(n)
        if not fresh:
            way, furthest = net_moves(history, p)
            a = codes[:, p]
            reach = lower[:, p] - furthest[lower_at[:, p], a]

            def sure(rows):
                near = upper[rows, p] + way[upper_at[rows, p], a[rows]]
                return near < reach[rows] - SLACK * (1 + near + np.abs(lower[rows, p]))

            open_ = open_[~sure(open_)]
            # One distance tightens the upper bound; that is often enough.
            moved = own[open_] - entries[a[open_]]
            upper[open_, p] = np.sqrt((moved * moved).sum(axis=1).astype(float))
            upper_at[open_, p] = now
            open_ = open_[~sure(open_)]
        if len(open_):
            d = squares(own[open_], entries)
            best = d.argmin(axis=1)
            at = np.arange(len(open_))
            codes[open_, p] = best
            upper[open_, p] = np.sqrt(d[at, best].astype(float))
            second = d.astype(float)
            second[at, best] = 1e300
            lower[open_, p] = np.sqrt(second.min(axis=1))
            upper_at[open_, p] = lower_at[open_, p] = now
        rescans += len(open_)
    return State(codes, upper, lower, upper_at, lower_at), rescans


def _matrix(column, kind: str, shape: tuple):
    import numpy as np

    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), *shape)


def _rows(matrix):
    import pyarrow as pa

    return pa.array([row.tobytes() for row in matrix], pa.binary())


def _pack(batches: Iterator, size: int, kind: str) -> Iterator:
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        out = np.zeros((batch.num_rows, size), kind)
        for at, v in enumerate(batch.column(2).to_pylist()):
            out[at, : len(v)] = v
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _rows(out)], names=["id", "label", "v"])


def _assigned(batches: Iterator, books: Codebooks, kind: str) -> Iterator:
    import numpy as np
    import pyarrow as pa

    history = [np.array(book, books.exact) for book in books.history]
    parts = len(history[0])
    for batch in common.partial_rows(batches, 4096):
        x = _matrix(batch.column("v"), kind, (parts, books.width)).astype(books.exact)
        state = None
        if len(history) > 1:
            state = State(*[_matrix(batch.column(n), t, (parts,)) for n, t in zip(State._fields, _LAYOUT)])
        found, _ = assign(x, state, history)
        columns = [_rows(m.astype(t)) for m, t in zip(found, _LAYOUT)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("label"), batch.column("v"), *columns], names=["id", "label", "v", *State._fields]
        )


def _sums(batches: Iterator, parts: int, entries: int, width: int, kind: str) -> Iterator:
    """Of all rows of a task: for each part and entry in use, the sum of its parts and their number."""
    import numpy as np
    import pyarrow as pa

    total, count = np.zeros((parts * entries, width), np.int64), np.zeros(parts * entries, np.int64)
    base = np.arange(parts) * entries
    for batch in batches:
        at = (_matrix(batch.column(1), "u1", (parts,)).astype(np.int64) + base).reshape(-1)
        np.add.at(total, at, _matrix(batch.column(0), kind, (parts * width,)).reshape(-1, width))
        count += np.bincount(at, minlength=parts * entries)
    used = np.flatnonzero(count)
    yield pa.RecordBatch.from_arrays(
        [pa.array(used), pa.array(list(total[used]), pa.list_(pa.int64())), pa.array(count[used])], names=["at", "sums", "n"]
    )


def _moved(state: DataFrame, books: Codebooks, kind: str) -> list:
    """The codebook after a round: every used entry is the floored mean of its parts."""
    import numpy as np

    old = np.array(books.history[-1], np.int64)
    parts, entries, width = old.shape
    sums = state.select("v", "codes").mapInArrow(
        partial(_sums, parts=parts, entries=entries, width=width, kind=kind), "at long, sums array<long>, n long"
    )
    totals = [F.sum(F.col("sums")[i]) for i in range(width)]
    new = old.reshape(-1, width).copy()
    # One row per part and entry, however many vectors there are.
    for row in sums.groupBy("at").agg(F.sum("n"), *totals).collect():
        new[row[0]] = [total // row[1] for total in row[2:]]
    return new.reshape(old.shape).tolist()


def _errors(batches: Iterator, books: Codebooks, kind: str) -> Iterator:
    import numpy as np
    import pyarrow as pa

    last = np.array(books.history[-1], np.int64)
    parts = len(last)
    for batch in common.partial_rows(batches, 4096):
        x = _matrix(batch.column("v"), kind, (parts, books.width)).astype(np.int64)
        codes = _matrix(batch.column("codes"), "u1", (parts,))
        apart = x - last[np.arange(parts), codes]
        error = (apart * apart).sum(axis=(1, 2))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("label"), batch.column("codes"), pa.array(error)],
            names=["id", "label", "codes", "error"],
        )


def compress(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2) -> tuple[DataFrame, Codebooks | None]:
    """`id`, `label`, `codes` (a byte per part), `error` per row, and the codebooks.

    `vectors` has `id` (long), `v` (array of longs) and `label` (int).  Each
    part's codebook starts as that part of the `entries` rows with the smallest
    ids (rows that repeat an id go by their vectors; fewer rows make a smaller
    codebook).  A round assigns every part to the nearest entry, ties to the
    lower index, and moves every used entry to the floored mean of its parts;
    after the rounds parts are assigned again.  `error` sums the squared distances.

    Rows with a null id, vector or component take no part.  Vectors count as
    filled up with zeros to the longest one and to whole parts, so also an empty
    one has a code.  Whole numbers are kept whole: components so large that a
    row's error would not fit a long raise a ValueError that says so.  An empty
    table gives no rows and no codebooks.
    """
    import numpy as np

    if not (1 <= entries <= 256 and parts >= 1 and 0 <= rounds <= 255):
        raise ValueError("a code is one byte per part")
    spark = vectors.sparkSession
    full = vectors.where("id is not null and v is not null and not exists(v, x -> x is null)").select("id", "label", "v")
    most = full.agg(F.max(F.size("v")), F.max(F.array_max("v")), F.min(F.array_min("v"))).first()
    if most[0] is None:
        return spark.createDataFrame([], "id long, label int, codes binary, error long"), None
    width = max(1, -(-most[0] // parts))
    large = max(abs(most[1] or 0), abs(most[2] or 0), 1)
    if 4 * parts * width * large**2 >= 2**63:
        raise ValueError(f"components of up to {large} are too large for whole squared distances")
    kind = "i2" if large < 2**15 else "i4" if large < 2**31 else "i8"
    exact = "f8" if 4 * width * large**2 < 2**53 else "i8"
    rows = common.stored(full.mapInArrow(partial(_pack, size=parts * width, kind=kind), "id long, label int, v binary"), "vectors")
    # As many rows as a codebook has entries.
    first = np.array([np.frombuffer(r.v, kind) for r in rows.orderBy("id", full_order("v")).limit(entries).select("v").collect()])
    start = first.reshape(len(first), parts, width).transpose(1, 0, 2).astype(np.int64)
    books = Codebooks([start.tolist()], width, exact)
    state = rows
    for round_ in range(rounds + 1):
        state = common.stored(state.mapInArrow(partial(_assigned, books=books, kind=kind), STATE), f"round-{round_}")
        if round_ < rounds:
            books = books._replace(history=[*books.history, _moved(state, books, kind)])
    coded = state.select("id", "label", "v", "codes").mapInArrow(
        partial(_errors, books=books, kind=kind), "id long, label int, codes binary, error long"
    )
    return common.stored(coded, "codes"), books


def full_order(column: str) -> F.Column:
    """An order of packed vectors, so that rows that repeat an id have a fixed one."""
    return F.hex(column)


def decoded(coded: DataFrame, books: Codebooks) -> DataFrame:
    """`id`, `v`: every row's vector as its code tells it."""
    table = F.array(*[F.array(*[F.array(*[F.lit(int(x)) for x in entry]) for entry in part]) for part in books.history[-1]])
    parts = len(books.history[-1])
    part = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda p: table[p][F.conv(F.hex(F.substring("codes", p + 1, F.lit(1))), 16, 10).cast("int")])
    return coded.select("id", F.flatten(part).alias("v"))


def label_errors(coded: DataFrame) -> DataFrame:
    """`coded` with `label_error`, the errors of all rows of a label; rows without a label are one group."""
    sums = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
