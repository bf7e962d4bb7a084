"""Repeated substrings by content-defined chunking.

A gear hash rolls over a text's bytes and cuts where its top bits are zero, so
that cuts depend on the last few bytes only: after an insertion the same chunks
come back.  Chunks are compared by digest over all documents.  A run of chunks
that one earlier document holds in the same order is an anchor, and is extended
byte by byte in both texts; what is long enough then is a repeated passage.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: A cut looks at this many bytes, at top bits of a 16-bit hash.
WINDOW, CUT_BITS = 16, 5
#: Bytes of a chunk, and of a passage that is told.
SHORTEST, LONGEST, PASSAGE = 12, 256, 96
#: A key is frequent beyond this share of all rows, so there are at most as many frequent keys.
FREQUENT = 4096


@lru_cache(maxsize=1)
def gear():
    """A number for each byte value, from a splitmix generator."""
    import numpy as np

    mask, state, out = (1 << 64) - 1, 0, []
    for _ in range(256):
        state = (state + 0x9E3779B97F4A7C15) & mask
        z = ((state ^ (state >> 30)) * 0xBF58476D1CE4E5B9) & mask
        z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & mask
        out.append((z ^ (z >> 31)) & 0xFFFF)
    return np.array(out, np.uint16)


def cuts(raw: bytes) -> list[int]:
    """Ends of the chunks of a text's bytes."""
    return _cuts(raw)[0]


def _cuts(raw: bytes):
    """Ends of the chunks of a text's bytes, and the rolling hash at every byte.

    The hash is h[i] = 2 h[i-1] + gear[byte i] in 16 bits, so bytes further back
    than 16 drop out; it is built for all places at once, doubling the reach of
    the sum in each step.  Cuts nearer than `SHORTEST` to the last one are
    passed over.  Where none comes within `LONGEST` bytes, the place of the least
    hash among them is the cut (the first, if several), so that periodic text
    too is cut by its content and comes back in step after a shift.
    """
    import numpy as np

    if not raw:
        return [], np.zeros(0, np.uint16)
    h = gear()[np.frombuffer(raw, np.uint8)]
    reach = 1
    while reach < WINDOW:
        more = h.copy()
        more[reach:] += h[:-reach] << np.uint16(reach)
        h, reach = more, 2 * reach
    ends, last = [], 0
    places = (np.flatnonzero(h >> np.uint16(16 - CUT_BITS) == 0) + 1).tolist()
    for at in [*places, len(raw)]:
        while at - last > LONGEST:
            first = last + SHORTEST
            last = first + int(h[first - 1 : last + LONGEST].argmin())
            ends.append(last)
        if at - last >= SHORTEST:
            ends.append(at)
            last = at
    if last < len(raw):
        ends.append(len(raw))
    return ends, h


def _chunks(batches: Iterator) -> Iterator:
    import numpy as np
    import pyarrow as pa
    from xxhash import xxh3_64_digest

    for batch in common.partial_rows(batches, 500):
        counts, starts_of, ends_of, edges_of, digests = [], [], [], [], []
        for text in batch.column(1).to_pylist():
            raw = (text or "").encode("utf-8", "surrogatepass")
            ends, h = _cuts(raw)
            counts.append(len(ends))
            last = 0
            for end in ends:
                digests.append(xxh3_64_digest(raw[last:end]))
                last = end
            to = np.array(ends, np.int64)
            at = np.concatenate([[0], to])[: len(to)].astype(np.int64)
            if len(to):
                # The rolling hash just before a chunk, and the one whose window begins just after it.
                wide = h.astype(np.int64)
                before = np.where(at > 0, wide[at - 1], 0)
                after = wide[np.minimum(to + WINDOW, len(raw)) - 1]
                edges_of.append(before << 16 | after)
            starts_of.append(at)
            ends_of.append(to)
        starts, ends = np.concatenate(starts_of), np.concatenate(ends_of)
        which = np.repeat(np.arange(len(counts)), counts)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pa.array(which)),
                batch.column(2).take(pa.array(which)),
                pa.array(starts),
                pa.array((ends - starts).astype(np.int32)),
                pa.array(np.concatenate([np.zeros(0, np.int64), *edges_of])),
                pa.array(np.frombuffer(b"".join(digests), ">u8").astype(np.uint64).view(np.int64)),
            ],
            names=["id", "row", "start", "length", "edges", "digest"],
        )


def chunk_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """Every chunk of every row: `id`, `row` (tells rows apart), `start` and `length` in bytes, `digest`, and `edges`.

    `edges` are two 16-bit hashes, of the 16 bytes before the chunk and of those after it.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(text_col).cast("string").alias("text"),
        (F.col(row_col) if row_col else F.monotonically_increasing_id()).alias("row"),
    )
    return rows.mapInArrow(_chunks, "id long, row long, start long, length int, edges long, digest long")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", passage: int = PASSAGE) -> DataFrame:
    """Passages that also stand, whole and in one piece, in a document with a smaller id.

    `id`, `row`, `start`, `n_bytes`, `n_chunks` (whole chunks in it) and
    `first_id`, the document that holds it: the smallest id with those chunks;
    `start` and `n_bytes` count UTF-8 bytes.  An anchor, a run of chunks that
    follow each other in both texts, is extended by the bytes that agree before
    and after it, by at most `passage` bytes on each side; so every anchor inside
    a common passage of at least `passage` bytes is told, and neighbouring
    anchors tell the rest.  A passage inside another told one is left out; others
    may overlap.  What repeats inside one document only, also over rows of one
    id, is not told.  Rows without an id come after all ids; null and empty texts
    have no chunks.  An empty table gives no rows.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(text_col).cast("string").alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    return passages_of(common.stored(rows, "documents"), passage)


def _with_frequent(many: DataFrame, few: DataFrame, keys: list[str], total: int) -> DataFrame:
    """`many` joined to `few`, whose `n` tells how often a key stands in `many`, `total` rows at most.

    A frequent key would put its rows into one task; there are at most `FREQUENT`
    of them, and every task gets those.
    """
    often = F.broadcast(few.where(F.col("n") > total // FREQUENT))
    seldom = few.where(F.col("n") <= total // FREQUENT).drop("n")
    rest = many.join(often.select(*keys), keys, "left_anti").join(seldom, keys)
    return many.join(often.drop("n"), keys).unionByName(rest)


def _around(batches: Iterator, reach: int) -> Iterator:
    """The bytes before or after each asked place of a text."""
    import pyarrow as pa

    for batch in common.partial_rows(batches, 200):
        out = []
        for row, text, asked in zip(*(c.to_pylist() for c in batch.columns)):
            raw = text.encode("utf-8", "surrogatepass")
            for one in asked:
                at = one["at"]
                near = raw[at : at + reach] if one["after"] else raw[max(at - reach, 0) : at]
                out.append((row, at, one["after"], one["n"], near))
        rows, places, sides, counts, near = zip(*out) if out else ((),) * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.int64()), pa.array(places, pa.int64()), pa.array(sides, pa.bool_())]
            + [pa.array(counts, pa.int64()), pa.array(near, pa.binary())],
            names=["row", "at", "after", "n", "near"],
        )


def equal_bytes(a: bytes, b: bytes, order: str) -> int:
    """How many bytes agree from the start (`order` "little") or back from the end ("big")."""
    n = min(len(a), len(b))
    a, b = (a[:n], b[:n]) if order == "little" else (a[len(a) - n :], b[len(b) - n :])
    differ = int.from_bytes(a, order) ^ int.from_bytes(b, order)
    return n if not differ else (differ & -differ).bit_length() - 1 >> 3


def _agreeing(batches: Iterator, order: str) -> Iterator:
    """The last two columns, bytes of two texts, made into the number of bytes that agree."""
    import pyarrow as pa

    for batch in batches:
        *kept, own, other = batch.columns
        n = [equal_bytes(a, b, order) for a, b in zip(own.to_pylist(), other.to_pylist())]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(n, pa.int64())], names=[*batch.schema.names[:-2], "agree"])


def passages_of(docs: DataFrame, passage: int = PASSAGE) -> DataFrame:
    """The repeated passages of a stored table `id`, `text`, `row`, as in `repeated_passages`."""
    chunks = common.stored(chunk_table(docs, "id", "text", "row"), "chunks")
    # Rows without an id count as one document after all others.
    place = F.coalesce("id", F.lit((1 << 63) - 1))
    seen = common.stored(chunks.groupBy("digest").agg(F.min(place).alias("place"), F.count("*").alias("n")).where("n > 1"), "digests")
    again = common.stored(_with_frequent(chunks, seen, ["digest"], chunks.count()), "repeats")
    # Of the first document's places of a chunk, the first one.
    own = F.min(F.struct("row", "start", "edges")).alias("own")
    first = again.where(place == F.col("place")).groupBy("digest").agg(own).join(seen.select("digest", "n"), "digest")
    first = first.selectExpr("digest", "n", "own.row as f_row", "own.start as f_start", "own.edges as f_edges")
    pairs = _with_frequent(again.where(place > F.col("place")), first, ["digest"], chunks.count())
    # Chunks that follow each other in both texts lie equally far from the sum of lengths before them.
    pairs = pairs.withColumn("shift", F.col("start") - F.col("f_start"))
    line = Window.partitionBy("row", "f_row", "shift").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    runs = pairs.withColumn("run", F.col("start") - F.coalesce(F.sum("length").over(line), F.lit(0)))
    differ = F.col("edges").bitwiseXOR(F.col("f_edges"))
    anchors = runs.groupBy("row", "f_row", "shift", "run").agg(
        F.first("id").alias("id"),
        F.min("place").alias("place"),
        F.min("start").alias("start"),
        F.sum("length").alias("n_bytes"),
        F.count("*").alias("n_chunks"),
        F.min_by(differ.bitwiseAND(F.lit(0xFFFF0000)) == 0, "start").alias("as_before"),
        F.max_by(differ.bitwiseAND(F.lit(0xFFFF)) == 0, "start").alias("as_after"),
    )
    # Missing bytes stand on one side at least by half; where that is a whole window, its hash agrees.
    could = (F.lit(passage) - F.col("n_bytes") <= 2 * WINDOW - 2) | F.col("as_before") | F.col("as_after")
    anchors = anchors.where(could).withColumn("end", F.col("start") + F.col("n_bytes"))
    anchors = anchors.withColumn("f_start", F.col("start") - F.col("shift")).withColumn("f_end", F.col("end") - F.col("shift"))
    anchors = common.stored(anchors.drop("shift", "run", "as_before", "as_after"), "anchors")
    ends = [(r, a, after) for after, own, other in ((False, "start", "f_start"), (True, "end", "f_end")) for r, a in (("row", own), ("f_row", other))]
    asked = F.array(*[F.struct(F.col(r).alias("row"), F.col(a).alias("at"), F.lit(after).alias("after")) for r, a, after in ends])
    asked = anchors.select(F.explode(asked).alias("e")).select("e.*").groupBy("row", "at", "after").agg(F.count("*").alias("n"))
    # A text has at most as many places as cuts, however many anchors ask for them.
    by_row = asked.groupBy("row").agg(F.collect_list(F.struct("at", "after", "n")).alias("asked"))
    texts = docs.select("row", "text").join(by_row, "row")
    around = texts.mapInArrow(partial(_around, reach=passage), "row long, at long, after boolean, n long, near binary")
    around = common.stored(around, "around")
    spans, total = anchors, 2 * anchors.count()
    for after, at, name in ((False, "start", "left"), (True, "end", "right")):
        near = around.where(F.col("after") == after).drop("after")
        # The first holders' places may be frequent; one anchor at most starts, and one ends, at a text's own place.
        first = near.select(F.col("row").alias("f_row"), F.col("at").alias(f"f_{at}"), "n", F.col("near").alias("other"))
        spans = _with_frequent(spans, first, ["f_row", f"f_{at}"], total)
        spans = spans.join(near.select("row", F.col("at").alias(at), F.col("near").alias("own")), ["row", at])
        rest = spans.drop("own", "other", f"f_{at}", *(["f_row"] if after else []))
        schema = ", ".join(f"{c} {t}" for c, t in rest.dtypes) + ", agree bigint"
        spans = spans.select(*rest.columns, "own", "other").mapInArrow(partial(_agreeing, order="little" if after else "big"), schema)
        spans = common.stored(spans.withColumnRenamed("agree", name), name)
    spans = spans.select(
        "id", "row", (F.col("start") - F.col("left")).alias("start"), F.expr("n_bytes + left + right").alias("n_bytes"), "n_chunks", F.col("place").alias("first_id")
    )
    spans = spans.where(F.col("n_bytes") >= passage)
    wider = Window.partitionBy("row").orderBy("start", F.desc("n_bytes"), "first_id", F.desc("n_chunks"))
    reached = F.max(F.col("start") + F.col("n_bytes")).over(wider.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("reached", reached).where("reached is null or reached < start + n_bytes")
    return spans.select("id", "row", "start", "n_bytes", "n_chunks", "first_id")


def _cut_out(batches: Iterator, at: int) -> Iterator:
    import pyarrow as pa

    for batch in common.partial_rows(batches, 500):
        out = []
        for text, spans in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
            raw = None if text is None else text.encode("utf-8", "surrogatepass")
            kept, last = [], 0
            for span in sorted(spans or [], key=lambda s: s["start"]):
                kept.append(raw[last : max(last, span["start"])])
                last = max(last, span["start"] + span["n_bytes"])
            raw = None if raw is None else b"".join(kept) + raw[last:]
            # A cut may fall inside a character; its rest goes with the passage.
            out.append(None if raw is None else raw.decode("utf-8", "ignore"))
        columns = [pa.array(out, pa.string()) if i == at else c for i, c in enumerate(batch.columns[:-1])]
        yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", passage: int = PASSAGE) -> DataFrame:
    """`docs` with every repeated passage cut out of the text, wherever a document with a smaller id keeps it.

    Overlapping passages are cut once.  Null and empty texts stay; an empty table stays empty.
    """
    row, own, cut = (common.unused(docs, n) for n in ("_row", "_own", "_cut"))
    keyed = common.stored(docs.withColumn(row, F.monotonically_increasing_id()), "documents")
    numbered = keyed.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.col(row).alias("row"))
    spans = passages_of(numbered, passage)
    by_row = spans.groupBy(F.col("row").alias(own)).agg(F.collect_list(F.struct("start", "n_bytes")).alias(cut))
    joined = keyed.join(by_row, F.col(row) == F.col(own), "left").select(*docs.columns, cut)
    return joined.mapInArrow(partial(_cut_out, at=docs.columns.index(text_col)), docs.schema)
