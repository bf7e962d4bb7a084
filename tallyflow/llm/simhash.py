"""SimHash near-duplicates found by deletion-variant signatures.

A fingerprint is cut into so few segments that two fingerprints within the
allowed distance differ by at most one bit in one of them.  Every segment is
indexed once for each of its bits, with that bit taken out; fingerprints that
meet under an equal variant are verified on all bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, sigtree

BITS = 64


def _words_of_votes(digests: bytes, words: int) -> list[int]:
    """The fingerprint of 64-bit hashes in as many 64-bit words; further words are made from mixed hashes."""
    import numpy as np

    hashes = np.frombuffer(digests, ">u8").astype(np.uint64)
    out = []
    for number in range(words):
        if number:
            hashes = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15 + 2 * number)
            hashes ^= hashes >> np.uint64(29)
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        votes = bits.sum(axis=0, dtype=np.int32)
        out.append(int.from_bytes(np.packbits(votes * 2 > len(hashes)).tobytes(), "big"))
    return out


def fingerprint_words(text: str, shingle: int = 5, seed: int = 42, words: int = 1) -> list[int]:
    """The SimHash of a text's word shingles as unsigned 64-bit words.

    A-Z are lower-cased, words are runs of anything but blanks, tabs and line
    ends.  A text of fewer words than a shingle is one shingle; a text without
    words has zeros.  A bit is set if it is set in over half the hashes.
    """
    from xxhash import xxh64_digest

    own = text.encode("utf-8", "surrogatepass").lower().split()
    if not own:
        return [0] * words
    if len(own) <= shingle:
        shingles = [b" ".join(own)]
    else:
        shingles = map(b" ".join, zip(*(own[i:] for i in range(shingle))))
    return _words_of_votes(b"".join([xxh64_digest(s, seed) for s in shingles]), words)


def fingerprint(text: str, shingle: int = 5, seed: int = 42) -> int:
    return fingerprint_words(text, shingle, seed)[0]


def _fingerprints(batches: Iterator, shingle: int, seed: int, words: int) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        values = [fingerprint_words(t or "", shingle, seed, words) for t in batch.column(1).to_pylist()]
        signed = [[v - (1 << BITS) if v >> (BITS - 1) else v for v in value] for value in values]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(signed, pa.list_(pa.int64()))], names=["id", "fps"])


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, seed: int = 42, words: int = 1
) -> DataFrame:
    """`id`, `fps` (the fingerprint's words as signed longs) for every row; a null text counts as empty."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(partial(_fingerprints, shingle=shingle, seed=seed, words=words), "id long, fps array<long>")


def segments(distance: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of the fewest segments of which one differs by at most one bit."""
    count = max(2, distance // 2 + 1)
    cuts = [BITS * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _near_in_word(index: DataFrame, distance: int) -> DataFrame:
    """Pairs `a` < `b` of nodes whose `fp` differ in at most `distance` bits in the same `word`, each once a word.

    Both sides of the join are the variant index, keyed by (word, segment, bit
    taken out, remaining bits), and only verified pairs leave it.  A pair can
    meet under several variants; it is kept at the first segment that differs by
    at most one bit, under the variant of that bit.
    """
    cuts = segments(distance)
    key_bits = max(width for _, width in cuts)
    variants, first, number = [], "", 0
    for low, width in cuts:
        mask = (1 << width) - 1
        part = f"(shiftrightunsigned(fp, {low}) & {mask}L)"
        place = f"shiftleft(cast(word as bigint), {key_bits + BITS.bit_length()})"
        variants += [f"{place} | {(number + bit) << key_bits}L | ({part} & {mask & ~(1 << bit)}L)" for bit in range(width)]
        diff = f"(shiftrightunsigned(x.fp ^ y.fp, {low}) & {mask}L)"
        # The position of the only set bit, or 0 where the segments are equal.
        first += f" when bit_count({diff}) <= 1 then {number} + bit_count(greatest({diff} - 1L, 0L))"
        number += width
    # Spark sizes the exploded index like the nodes it is made of and would send it to the driver for a broadcast.
    spread = index.selectExpr("node", "fp", f"explode(array({', '.join(variants)})) as variant").hint("merge")
    met = F.expr(
        f"x.variant = y.variant and x.node < y.node and bit_count(x.fp ^ y.fp) <= {distance} "
        f"and (shiftright(x.variant, {key_bits}) & {(1 << BITS.bit_length()) - 1}) = case{first} end"
    )
    return spread.alias("x").join(spread.alias("y"), met).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))


def links(nodes: DataFrame, distance: int, words: int = 1, in_word: int | None = None) -> DataFrame:
    """Pairs `a` < `b` of nodes (`node`, `fps`: different fingerprints) that differ in at most `distance` bits.

    A pair is looked for in each word and then verified on all.  One of its words
    differs by at most `distance` / `words` bits; a smaller `in_word` asks for
    one that differs by no more than that.
    """
    # Every word becomes many rows, so few nodes are dealt out to all tasks first.
    tasks = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    index = nodes.repartition(tasks, "node").select("node", F.posexplode("fps").alias("word", "fp"))
    met = _near_in_word(index, distance // words if in_word is None else in_word)
    if words == 1:
        return met
    prints = nodes.select("node", "fps")
    met = met.distinct().join(prints.toDF("a", "fa"), "a").join(prints.toDF("b", "fb"), "b")
    apart = F.aggregate(F.zip_with("fa", "fb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    return met.where(apart <= distance).select("a", "b")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    distance: int = 4,
    seed: int = 42,
    words: int = 1,
    in_word: int | None = None,
) -> DataFrame:
    """`id`, `fps`, `component` per row: the smallest id reachable over fingerprints that differ in at most `distance` bits.

    Fingerprints have `words` * 64 bits; `in_word` also asks for a word that
    differs by at most so many.  Equal fingerprints are one node, so
    copies are never paired with each other.  Null and empty texts have
    fingerprint 0 and are linked like others.  Repeated rows stay rows of their
    own; a null id is no one's component unless the whole component has none.
    An empty table gives no rows.
    """
    # A fingerprint of one word is its own node; longer ones are told by their hash.
    node = F.col("fps")[0] if words == 1 else F.xxhash64("fps")
    prints = common.stored(fingerprints(docs, id_col, text_col, shingle, seed, words).withColumn("node", node), "prints")
    nodes = common.stored(prints.groupBy("node").agg(F.first("fps").alias("fps"), F.min("id").alias("first")), "nodes")
    roots = common.connected(links(nodes, distance, words, in_word)).withColumnRenamed("node", "n")
    placed = nodes.join(roots, F.col("node") == F.col("n"), "left").withColumn("root", F.coalesce("root", "node"))
    placed = common.stored(placed.select("node", "first", "root"), "placed")
    classes = placed.groupBy("root").agg(F.min("first").alias("component"))
    by_node = placed.join(classes, "root").select("node", "component")
    return prints.join(by_node, "node").select("id", "fps", "component")


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similar: int = 80, distance: int | None = None
) -> DataFrame:
    """The rows of `docs` without near-copies: of each component the row with the smallest id stays.

    A link is `similar` percent of the union of both whole shingle sets in
    common.  With a `distance`, `near_duplicates` first tells the rows whose
    fingerprints differ in at most so many bits, each held against the first row
    of its component by the same rule.  So few bits miss texts near that bound;
    `sigtree.jaccard_components` adds the links that are left.

    Texts without words (null or empty) are copies of each other.  Rows without
    an id stay only where their component has no id at all; of repeated rows with
    one id a single one stays.  An empty table gives no rows.
    """
    row = common.unused(docs, "_row")
    keyed = common.stored(docs.withColumn(row, F.monotonically_increasing_id()), "documents")
    # The row number plays the id, so that ties have one winner; ids decide first.
    told = None
    if distance is not None:
        near = near_duplicates(keyed, row, text_col, shingle, distance).where("id <> component")
        told = near.select(F.col("component").alias("a"), F.col("id").alias("b"))
    found = sigtree.jaccard_components(keyed, row, text_col, shingle, similar, told)
    group = F.when(F.col("n_shingles") == 0, F.lit(-1)).otherwise(F.col("component"))
    sized = found.select(F.col("id").alias("at"), group.alias("group"))
    sized = sized.join(keyed.select(F.col(row).alias("at"), F.col(id_col).cast("long").alias("own")), "at")
    winners = sized.groupBy("group").agg(F.min(F.struct(F.col("own").isNull().alias("n"), "own", "at")).alias("w"))
    return keyed.join(winners.select(F.col("w.at").alias(row)), row, "left_semi").select(*docs.columns)
