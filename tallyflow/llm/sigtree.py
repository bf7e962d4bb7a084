"""Documents linked by the Jaccard similarity of their word shingles, found by signature trees.

A node of a tree holds the OR of its sets' token bitmaps, the range of their
sizes and the most tokens that share a bit with another one of their set.  So no
two sets below a pair of nodes have more in common than the bits of both nodes
and those shared; a pair whose sets would need more is left out with all below
it.  Two trees, or one with itself, are descended together.

Sets hang in trees twice.  First whole sets that have a least hash in common are
linked, and linked sets become a component.  Then leaves of close sets of one
component hang in one tree for every token of their sets' prefixes; a pair of
sets similar enough has such a token in common, so no link is lost.  Tokens with
the same leaves are descended once, and only pairs of different components count.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Words of a shingle; percent of two sets' union that they have in common.
SHINGLE, SIMILAR = 5, 80
#: Children of a node; sets of a leaf; whole sets and leaves that one tree holds at most (a larger group is many pairs of trees).
FAN, LEAF, WHOLE, LARGEST = 8, 64, 256, 4096
#: Times that whole sets are grouped by a least hash.
GROUPINGS = 3
#: The sketch of all shingles counts in so many slots, of which a row of its table holds so many.
SLOT_BITS, CHUNK_BITS = 20, 10
#: Bits of a hash that trees are told by; a chance meeting is only one more pair to look at.
TOKEN_BITS = 44
#: Asked rows are marked in so many bits, whatever their number, each task's rows side by side from steps of `MARK_STEP` on.
#: Rows that share a bit only let more texts through to the exact join.
MARK_BITS, MARK_STEP = 26, 41475559
LEAVES = "leaf long, comp long, low long, high long, shared long, bits binary, tokens array<long>"
SETS = "row long, n long, shared long, bits binary, hashes binary"
PRINTS = "row long, id long, n long, node long, least array<long>, chunk int, slots binary, sums binary"


def shingle_set(text: bytes, shingle: int = SHINGLE, seed: int = 42):
    """The sorted 64-bit hashes of a text's different shingles.

    A-Z are lower-cased, words are runs of anything but blanks, tabs and line
    ends.  Fewer words than a shingle are one shingle; no words have none.
    """
    import numpy as np
    from xxhash import xxh64_digest

    own = text.lower().split()
    if len(own) <= shingle:
        found = [b" ".join(own)] if own else []
    else:
        found = map(b" ".join, zip(*(own[i:] for i in range(shingle))))
    return np.unique(np.frombuffer(b"".join([xxh64_digest(s, seed) for s in found]), ">u8").astype(np.uint64))


def prefix_length(size: int, similar: int) -> int:
    """So many tokens of a set, the first in an order of all tokens, meet those of every set similar enough."""
    return size - (similar * size + 99) // 100 + 1 if size else 0


# --- trees -----------------------------------------------------------------
class Nodes(NamedTuple):
    """Nodes of one level: smallest and largest set, most tokens that share a bit, bitmaps of one width."""

    low: object
    high: object
    shared: object
    bits: object


def width_of(size: int) -> int:
    """Bits of a bitmap: two to four for each token."""
    return max(64, 1 << (2 * size - 1).bit_length())


def bitmap(hashes, width: int):
    """A set's bitmap, and how many of its tokens share a bit with another one."""
    import numpy as np

    out = np.zeros(width, bool)
    out[(hashes & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(out, bitorder="little").view(np.uint64), len(hashes) - int(out.sum())


def widened(bits: list, words: int):
    """Bitmaps of one width.  A repeated bitmap holds all bits that a wider one could, so bounds stay bounds."""
    import numpy as np

    return np.array([b if len(b) == words else np.tile(b, words // len(b)) for b in bits])


def above(nodes: Nodes) -> Nodes:
    """Parents of `FAN` neighbours each."""
    import numpy as np

    at = np.arange(0, len(nodes.low), FAN)
    return Nodes(
        np.minimum.reduceat(nodes.low, at),
        np.maximum.reduceat(nodes.high, at),
        np.maximum.reduceat(nodes.shared, at),
        np.bitwise_or.reduceat(nodes.bits, at, axis=0),
    )


def can_link(a: Nodes, b: Nodes, i, j, similar: int):
    """Whether sets below nodes i of `a` and j of `b` can have as much in common as similar sets have."""
    import numpy as np

    fit = (100 * a.high[i] >= similar * b.low[j]) & (100 * b.high[j] >= similar * a.low[i])
    at = np.flatnonzero(fit)
    common_bits = np.bitwise_count(a.bits[i[at]] & b.bits[j[at]]).sum(axis=1).astype(np.int64)
    most = np.minimum(common_bits + np.minimum(a.shared[i[at]], b.shared[j[at]]), np.minimum(a.high[i[at]], b.high[j[at]]))
    fit[at] = (100 + similar) * most >= similar * (a.low[i[at]] + b.low[j[at]])
    return fit


def descend(a: Nodes, b: Nodes | None, similar: int) -> Iterator:
    """Index arrays (i, j) of the pairs at the bottom of two trees, or of one tree with itself (i < j), that can link."""
    import numpy as np

    def levels_of(nodes):
        out = [nodes]
        while len(out[-1].low) > FAN:
            out.append(above(out[-1]))
        return out

    left = levels_of(a)
    right = left if b is None else levels_of(b)
    while len(left) != len(right):
        short = left if len(left) < len(right) else right
        short.append(above(short[-1]))
    # Pairs looked at together fill about 32 MB.
    step = max(1, (1 << 22) // a.bits.shape[1] // FAN**2)
    i, j = (x.reshape(-1) for x in np.meshgrid(np.arange(len(left[-1].low)), np.arange(len(right[-1].low)), indexing="ij"))
    waiting = [(len(left) - 1, i, j)]
    while waiting:
        level, i, j = waiting.pop()
        if b is None:
            kept = i < j if level == 0 else i <= j
            i, j = i[kept], j[kept]
        kept = can_link(left[level], right[level], i, j, similar)
        i, j = i[kept], j[kept]
        if level == 0:
            if len(i):
                yield i, j
            continue
        for at in range(0, len(i), step):
            below_i = (i[at : at + step, None, None] * FAN + np.arange(FAN)[:, None] + np.zeros(FAN, int)).reshape(-1)
            below_j = (j[at : at + step, None, None] * FAN + np.zeros(FAN, int)[:, None] + np.arange(FAN)).reshape(-1)
            there = (below_i < len(left[level - 1].low)) & (below_j < len(right[level - 1].low))
            waiting.append((level - 1, below_i[there], below_j[there]))


def similar_sets(x, y, similar: int) -> bool:
    import numpy as np

    if 100 * min(len(x), len(y)) < similar * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= similar * (len(x) + len(y) - both)


def nodes_of(sets: list) -> Nodes:
    import numpy as np

    sizes = np.array([len(s) for s in sets], np.int64)
    width = width_of(int(sizes.max()))
    maps = [bitmap(s, width) for s in sets]
    return Nodes(sizes, sizes, np.array([m[1] for m in maps], np.int64), np.array([m[0] for m in maps]))


def spanning_links(ids: list, sets: list, similar: int) -> list[tuple[int, int]]:
    """Links between sets similar enough, as many as it takes to hold each component together."""
    import numpy as np

    if len(ids) == 2:
        return [(ids[0], ids[1])] if similar_sets(sets[0], sets[1], similar) else []
    order = np.argsort([len(s) for s in sets], kind="stable")
    sets, ids = [sets[i] for i in order], [ids[i] for i in order]
    root = list(range(len(ids)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    links = []
    for i, j in descend(nodes_of(sets), None, similar):
        for x, y in zip(i.tolist(), j.tolist()):
            a, b = find(x), find(y)
            if a != b and similar_sets(sets[x], sets[y], similar):
                root[max(a, b)] = min(a, b)
                links.append((ids[x], ids[y]))
    return links


# --- what tasks do ---------------------------------------------------------
def _u8(blob: bytes):
    import numpy as np

    return np.frombuffer(blob, np.uint64)


def _prints(batches: Iterator, shingle: int) -> Iterator:
    """A row for each text, and at the end the task's share of the sketch: each chunk with its used slots and their counts."""
    import numpy as np
    import pyarrow as pa
    from xxhash import xxh3_64_intdigest

    kinds = [pa.int64()] * 4 + [pa.list_(pa.int64()), pa.int32(), pa.binary(), pa.binary()]
    names = ["row", "id", "n", "node", "least", "chunk", "slots", "sums"]
    mixes = [np.uint64(0x9E3779B97F4A7C15 + 2 * r) for r in range(GROUPINGS)]
    counts = np.zeros(1 << SLOT_BITS, np.uint32)
    for batch in common.partial_rows(batches, 500):
        sets = [shingle_set(t or b"", shingle) for t in batch.column(2).to_pylist()]
        slots = np.concatenate(sets) >> np.uint64(64 - SLOT_BITS)
        np.add.at(counts, slots.astype(np.int64), 1)
        nodes = np.array([xxh3_64_intdigest(s.tobytes()) for s in sets], np.uint64)
        least = [[int((s * m).min().view(np.int64)) for m in mixes] if len(s) else [] for s in sets]
        columns = [batch.column(0), batch.column(1), pa.array(list(map(len, sets)), kinds[2]), pa.array(nodes.view(np.int64)), pa.array(least, kinds[4])]
        yield pa.RecordBatch.from_arrays(columns + [pa.nulls(len(sets), k) for k in kinds[5:]], names=names)
    chunks, used, sums = [], [], []
    for chunk, part in enumerate(counts.reshape(-1, 1 << CHUNK_BITS)):
        at = np.flatnonzero(part)
        if len(at):
            chunks.append(chunk)
            used.append(at.astype(np.uint16).tobytes())
            sums.append(part[at].tobytes())
    shares = [pa.array(c, k) for c, k in zip((chunks, used, sums), kinds[5:])]
    yield pa.RecordBatch.from_arrays([pa.nulls(len(chunks), k) for k in kinds[:5]] + shares, names=names)


def _summed(batches: Iterator) -> Iterator:
    import numpy as np
    import pyarrow as pa

    total: dict = {}
    for batch in batches:
        for chunk, slots, sums in zip(*(c.to_pylist() for c in batch.columns)):
            own = total.setdefault(chunk, np.zeros(1 << CHUNK_BITS, np.uint64))
            own[np.frombuffer(slots, np.uint16)] += np.frombuffer(sums, np.uint32).astype(np.uint64)
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.int32()), pa.array([t.tobytes() for t in total.values()], pa.binary())], names=["chunk", "sums"]
    )


def _prefixes(batches: Iterator, shingle: int, similar: int, sketch) -> Iterator:
    import numpy as np
    import pyarrow as pa

    often = np.frombuffer(sketch.value, np.uint64)
    for batch in common.partial_rows(batches, 500):
        found, sizes, shared, bits = [], [], [], []
        for text in batch.column(1).to_pylist():
            own = shingle_set(text, shingle)
            # Seldom shingles first: any order is right, this one keeps trees small.
            order = np.argsort(often[(own >> np.uint64(64 - SLOT_BITS)).astype(np.int64)], kind="stable")
            found.append(own[order[: prefix_length(len(own), similar)]] >> np.uint64(64 - TOKEN_BITS))
            words, double = bitmap(own, width_of(len(own)))
            sizes.append(len(own))
            shared.append(double)
            bits.append(words.tobytes())
        ends = pa.array(np.cumsum([0, *map(len, found)]).astype(np.int32))
        tokens = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(found).view(np.int64)))
        columns = [pa.array(sizes, pa.int64()), pa.array(shared, pa.int64()), pa.array(bits, pa.binary())]
        yield pa.RecordBatch.from_arrays([batch.column(0), tokens, *columns], names=["row", "tokens", "n", "shared", "bits"])


def _runs(batches: Iterator, keys: int) -> Iterator:
    """Rows that follow each other with the same first `keys` columns, as (key, list of rows)."""
    last, rows = None, []
    for batch in common.partial_rows(batches, 1000):
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:keys] != last:
                if rows:
                    yield last, rows
                last, rows = row[:keys], []
            rows.append(row[keys:])
    if rows:
        yield last, rows


def _pairs_batch(pairs: list):
    import pyarrow as pa

    a, b = zip(*pairs) if pairs else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _marked(batches: Iterator, marks) -> Iterator:
    """Rows of texts whose bit is set."""
    import numpy as np
    import pyarrow as pa

    bits = np.frombuffer(marks.value, np.uint8)
    for batch in batches:
        row = batch.column(0).to_numpy()
        at = ((row & ((1 << 33) - 1)) + (row >> 33) * MARK_STEP) & (8 * len(bits) - 1)
        yield batch.filter(pa.array(bits[at >> 3] >> (at & 7) & 1 == 1))


def _whole_links(batches: Iterator, shingle: int, similar: int) -> Iterator:
    links: list = []
    for _, rows in _runs(batches, 2):
        if len(rows) > 1:
            links += spanning_links([r[0] for r in rows], [shingle_set(r[1], shingle) for r in rows], similar)
        if len(links) > 10000:
            yield _pairs_batch(links)
            links = []
    yield _pairs_batch(links)


def _leaves(batches: Iterator) -> Iterator:
    """Each leaf's sizes, bitmap and prefix tokens, from runs of its sets' own."""
    import numpy as np
    import pyarrow as pa

    names, kinds = LEAVES.replace(",", "").split()[::2], [pa.int64()] * 5 + [pa.binary(), pa.list_(pa.int64())]

    def packed(out):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [()] * 7, kinds)], names=names)

    out: list = []
    for (leaf, comp), rows in _runs(batches, 2):
        sizes, shared, bits, tokens = zip(*rows)
        if len(rows) > 1:
            bits = [np.bitwise_or.reduce(widened([_u8(b) for b in bits], max(map(len, bits)) // 8), axis=0).tobytes()]
            tokens = [np.unique(np.concatenate([np.array(t, np.int64) for t in tokens]))]
        out.append((leaf, comp, min(sizes), max(sizes), max(shared), bits[0], tokens[0]))
        if len(out) >= 500:
            yield packed(out)
            out = []
    yield packed(out)


def _leaf_pairs(batches: Iterator, similar: int) -> Iterator:
    """Pairs of leaves of different components that can link, from runs of a tree's leaves (`side` 0, 1, or 2 for both)."""
    import numpy as np

    def nodes(rows, words):
        low, high, shared = (np.array([r[i] for r in rows], np.int64) for i in (3, 4, 5))
        return Nodes(low, high, shared, widened([_u8(r[6]) for r in rows], words))

    def names(rows):
        return (np.array([r[i] for r in rows], np.int64) for i in (1, 2))

    found: set = set()
    for _, rows in _runs(batches, 3):
        rows.sort(key=lambda r: (r[3], r[1]))
        words = max(len(r[6]) for r in rows) // 8
        left, right = [r for r in rows if r[0] != 1], [r for r in rows if r[0] == 1]
        right = left if rows[0][0] == 2 else right
        if not left or not right:
            continue
        (la, ca), (lb, cb) = names(left), names(right)
        for i, j in descend(nodes(left, words), None if left is right else nodes(right, words), similar):
            far = ca[i] != cb[j]
            i, j = i[far], j[far]
            first = ca[i] < cb[j]
            found.update(zip(np.where(first, la[i], lb[j]).tolist(), np.where(first, lb[j], la[i]).tolist()))
        if len(found) > 100000:
            yield _pairs_batch(list(found))
            found = set()
    yield _pairs_batch(list(found))


def _sets(batches: Iterator, shingle: int) -> Iterator:
    """Of rows: the size, shared bits, bitmap and hashes of each."""
    import pyarrow as pa

    for batch in common.partial_rows(batches, 500):
        sets = [shingle_set(t, shingle) for t in batch.column(1).to_pylist()]
        maps = [bitmap(s, width_of(len(s))) for s in sets]
        columns = [
            pa.array([len(s) for s in sets], pa.int64()),
            pa.array([m[1] for m in maps], pa.int64()),
            pa.array([m[0].tobytes() for m in maps], pa.binary()),
            pa.array([s.tobytes() for s in sets], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=SETS.replace(",", "").split()[::2])


def _near_sets(batches: Iterator, similar: int) -> Iterator:
    """Rows of two leaves whose own bitmaps say that they can link, with their components."""
    import numpy as np
    import pyarrow as pa

    def nodes(sets, words):
        low, shared = (np.array([s[k] for s in sets], np.int64) for k in ("n", "shared"))
        return Nodes(low, low, shared, widened([_u8(s["bits"]) for s in sets], words))

    for batch in common.partial_rows(batches, 500):
        found = []
        for ca, cb, xs, ys in zip(*(c.to_pylist() for c in batch.columns)):
            words = max(len(s["bits"]) for s in xs + ys) // 8
            i, j = (g.reshape(-1) for g in np.meshgrid(np.arange(len(xs)), np.arange(len(ys)), indexing="ij"))
            near = can_link(nodes(xs, words), nodes(ys, words), i, j, similar)
            found += [(ca, cb, xs[x]["row"], ys[y]["row"]) for x, y in zip(i[near], j[near])]
        columns = list(zip(*found)) if found else [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["ca", "cb", "x", "y"])


def _verified(batches: Iterator, similar: int) -> Iterator:
    for batch in common.partial_rows(batches, 1000):
        yield _pairs_batch(
            [(ca, cb) for ca, cb, x, y in zip(*(c.to_pylist() for c in batch.columns)) if similar_sets(_u8(x), _u8(y), similar)]
        )


def _similar_texts(batches: Iterator, shingle: int, similar: int) -> Iterator:
    last, own = None, None
    for batch in common.partial_rows(batches, 500):
        links = []
        for a, b, ta, tb in zip(*(c.to_pylist() for c in batch.columns)):
            if a != last:
                last, own = a, shingle_set(ta, shingle)
            if similar_sets(own, shingle_set(tb, shingle), similar):
                links.append((a, b))
        yield _pairs_batch(links)


# --- the join --------------------------------------------------------------
class Job(NamedTuple):
    """What all steps need: the stored texts (`row`, `text`), the rule, and the parts that large steps are dealt out to."""

    texts: DataFrame
    shingle: int
    similar: int
    tasks: int


def _sketch(prints: DataFrame, job: Job) -> bytes:
    """How often shingles occur, counted in slots by their hashes over all rows; its size is fixed."""
    import numpy as np

    parts = prints.where("chunk is not null").select("chunk", "slots", "sums")
    out = np.zeros((1 << (SLOT_BITS - CHUNK_BITS), 1 << CHUNK_BITS), np.uint64)
    for row in parts.repartition(job.tasks, "chunk").mapInArrow(_summed, "chunk int, sums binary").collect():
        out[row.chunk] += np.frombuffer(row.sums, np.uint64)
    return out.tobytes()


def _asked_texts(asked: DataFrame, job: Job) -> DataFrame:
    """The texts of the rows that `asked` has, and few others: what is left out here is not moved to be joined."""
    at = F.expr(f"((row & {(1 << 33) - 1}) + shiftright(row, 33) * {MARK_STEP}) & {(1 << MARK_BITS) - 1}")
    bits = asked.select(at.alias("at")).groupBy(F.shiftright("at", 15).alias("chunk"))
    bits = bits.agg(F.bitmap_construct_agg(F.expr("at & 32767")).alias("marks"))
    marks = bytearray(1 << (MARK_BITS - 3))
    for found in bits.collect():
        marks[found.chunk << 12 : (found.chunk + 1) << 12] = found.marks
    shared = asked.sparkSession.sparkContext.broadcast(bytes(marks))
    return job.texts.mapInArrow(partial(_marked, marks=shared), "row long, text binary")


def _close_links(prints: DataFrame, nodes: DataFrame, job: Job) -> DataFrame:
    """Links of whole sets that have a least hash in common, in trees of at most about `WHOLE` sets."""
    kept = prints.select("row", "node", F.posexplode("least").alias("turn", "token")).join(nodes.select("row"), "row", "left_semi")
    kept = common.stored(kept, "least")
    groups = kept.groupBy("turn", "token").agg(F.count("*").alias("size"), F.expr("bit_xor(xxhash64(node))").alias("members"))
    groups = groups.where("size > 1").withColumn("trees", F.expr(f"cast(ceil(size / {WHOLE}) as int)"))
    # Groups with the same sets are looked at once; larger ones are cut up, in each turn at random.
    once = F.expr("if(trees = 1, struct(members as a, size as b), struct(xxhash64(turn, token) as a, -size as b))")
    groups = groups.groupBy(once.alias("k")).agg(F.min(F.struct("turn", "token", "trees")).alias("g")).select("g.*")
    placed = kept.join(groups, ["turn", "token"])
    places = placed.select("row", "node", F.xxhash64("turn", "token").alias("tree"), F.expr("pmod(xxhash64(node, turn), trees)").alias("part"))
    # Stored, so that its size is known and texts are only shuffled for it where it is large.
    places = common.stored(places, "places")
    whole = _asked_texts(places, job).join(places, "row").select("tree", "part", "node", "text")
    whole = whole.repartition(job.tasks, "tree", "part").sortWithinPartitions("tree", "part")
    links = whole.mapInArrow(partial(_whole_links, shingle=job.shingle, similar=job.similar), "a long, b long")
    return common.stored(links, "close")


def _told_links(told: DataFrame, prints: DataFrame, nodes: DataFrame, job: Job) -> DataFrame:
    """Those of the pairs of ids told by the caller whose whole sets are similar enough, as pairs of nodes."""
    ids = prints.where("n > 0").select("id", "node")
    pairs = told.join(ids.toDF("a", "x"), "a").join(ids.toDF("b", "y"), "b").where("x <> y").select("x", "y").distinct()
    pairs = common.stored(pairs, "told")
    # Only texts that a pair holds move.
    held = pairs.selectExpr("explode(array(x, y)) as node").distinct()
    held = common.stored(nodes.select("row", "node").join(held, "node", "left_semi"), "held")
    texts = common.stored(held.join(job.texts, "row").select("node", "text"), "node-texts")
    both = pairs.join(texts.toDF("x", "tx"), "x").join(texts.toDF("y", "ty"), "y").select("x", "y", "tx", "ty").sortWithinPartitions("x")
    return common.stored(both.mapInArrow(partial(_similar_texts, shingle=job.shingle, similar=job.similar), "a long, b long"), "told-links")


def _placed(nodes: DataFrame, close: DataFrame) -> DataFrame:
    """`row`, `node`, `comp`, `leaf` of every set: leaves hold up to `LEAF` sets of a component that are near in size."""
    roots = common.connected(close).select(F.col("node").alias("n"), "root")
    known = common.stored(nodes.join(roots, F.col("node") == F.col("n"), "left").select("row", "node", "first", "size", "root"), "comps")
    many = common.dense_positions(known.where("root is not null").withColumn("comp", F.col("root")), ["comp"], ["size", "node"], "at")
    alone = known.where("root is null").select("*", F.col("node").alias("comp"), F.lit(0).cast("long").alias("at"))
    both = many.unionByName(alone).withColumn("leaf", F.expr(f"xxhash64(comp, at div {LEAF})"))
    return common.stored(both.select("row", "node", "first", "comp", "leaf"), "placed")


def _trees(leaves: DataFrame) -> DataFrame:
    """`tree`, `part`, `other`, `side`, `leaf`: trees of leaves that have a prefix token in common."""
    # Leaves of one component are at most a 64th of its sets, so what a token brings together is small.
    meets = leaves.select(F.explode("tokens").alias("token"), "leaf")
    same = Window.partitionBy("token")
    meets = meets.withColumn("size", F.count("*").over(same)).withColumn("leaves", F.expr("bit_xor(xxhash64(leaf))").over(same))
    meets = common.stored(meets.where("size > 1"), "meets")
    once = meets.groupBy("size", "leaves").agg(F.min("token").alias("token"))
    once = common.stored(once.select("token", F.expr(f"cast(ceil(size / {LARGEST}) as int)").alias("parts")), "tokens")
    kept = meets.select("token", "leaf").join(once, "token").withColumn("own", F.expr("cast(pmod(xxhash64(leaf), parts) as int)"))
    # Part i of a tree is descended with itself and with every other part.
    pairs = F.expr(
        "transform(sequence(0, parts - 1), o -> struct(least(own, o) as part, greatest(own, o) as other,"
        " case when own = o then 2 when own < o then 0 else 1 end as side))"
    )
    return kept.select(F.col("token").alias("tree"), F.explode(pairs).alias("p"), "leaf").select("tree", "p.*", "leaf")


def _far_links(prints: DataFrame, placed: DataFrame, job: Job) -> DataFrame:
    """Components that a link joins, as pairs `a`, `b`."""
    sketch = prints.sparkSession.sparkContext.broadcast(_sketch(prints, job))
    spots = placed.select("row", "comp", "leaf")
    prefixes = _asked_texts(spots, job).mapInArrow(
        partial(_prefixes, shingle=job.shingle, similar=job.similar, sketch=sketch),
        "row long, tokens array<long>, n long, shared long, bits binary",
    )
    prefixes = prefixes.where("n > 0").join(spots, "row").select("leaf", "comp", "n", "shared", "bits", "tokens")
    prefixes = prefixes.repartition(job.tasks, "leaf", "comp").sortWithinPartitions("leaf", "comp")
    leaves = common.stored(prefixes.mapInArrow(_leaves, LEAVES), "leaves")
    hung = common.stored(_trees(leaves), "trees").join(leaves.drop("tokens"), "leaf")
    # One tree's parts are at most `LARGEST` leaves, so no key is hot.
    hung = hung.select("tree", "part", "other", "side", "leaf", "comp", "low", "high", "shared", "bits")
    hung = hung.repartition(job.tasks, "tree", "part", "other").sortWithinPartitions("tree", "part", "other")
    pairs = common.stored(hung.mapInArrow(partial(_leaf_pairs, similar=job.similar), "a long, b long").distinct(), "pairs")
    used = common.stored(spots.join(pairs.selectExpr("explode(array(a, b)) as leaf").distinct(), "leaf", "left_semi"), "used")
    # Sets are made where the texts lie; those that no leaf asked for go with the join below.
    sets = common.stored(_asked_texts(used, job).mapInArrow(partial(_sets, shingle=job.shingle), SETS), "sets")
    # A leaf is at most `LEAF` sets, and only their bitmaps move here.
    own = F.struct("row", "n", "shared", "bits")
    held = sets.drop("hashes").join(used, "row").groupBy("leaf", "comp").agg(F.collect_list(own).alias("own"))
    packed = common.stored(held, "packed")
    both = pairs.join(packed.select(F.col("leaf").alias("a"), F.col("comp").alias("ca"), F.col("own").alias("xs")), "a")
    both = both.join(packed.select(F.col("leaf").alias("b"), F.col("comp").alias("cb"), F.col("own").alias("ys")), "b")
    near = both.select("ca", "cb", "xs", "ys").mapInArrow(partial(_near_sets, similar=job.similar), "ca long, cb long, x long, y long")
    near = common.stored(near, "near")
    asked = common.stored(near.selectExpr("explode(array(x, y)) as row").distinct(), "asked")
    sets = sets.join(asked, "row", "left_semi").select("row", "hashes")
    whole = near.join(sets.toDF("x", "xs"), "x").join(sets.toDF("y", "ys"), "y").select("ca", "cb", "xs", "ys")
    return common.stored(whole.mapInArrow(partial(_verified, similar=job.similar), "a long, b long").distinct(), "far")


def jaccard_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    similar: int = SIMILAR,
    told: DataFrame | None = None,
) -> DataFrame:
    """`id`, `n_shingles`, `component` of every row.

    Rows are linked if their shingle sets' intersection is `similar` percent of
    their union or more; `component` is the least id reachable, its own included.
    A row without words (null or empty text) has no shingles and is linked with
    nothing, also not with its like.  Repeated rows are rows of their own and
    linked with each other; a null id is a component's only where no row of it
    has an id.  An empty table gives no rows.

    `told` has pairs `a`, `b` of ids that another search holds for near.  They
    are verified like all others and only spare work: the result is the same
    without them.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("long").alias("id"),
        common.text_or_empty(text_col).cast("binary").alias("text"),
    )
    # Texts take less room than their hashes, so these are made anew where they are needed.
    rows = common.stored(rows, "texts")
    job = Job(rows.select("row", "text"), shingle, similar, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    prints = common.stored(rows.mapInArrow(partial(_prints, shingle=shingle), PRINTS), "prints")
    # Rows with equal sets are one node, and its least row stands for all of them.
    full = prints.where("n > 0")
    nodes = full.groupBy("node").agg(F.min("row").alias("row"), F.min("id").alias("first"), F.min("n").alias("size"))
    nodes = common.stored(nodes, "nodes")
    close = _close_links(full, nodes, job)
    if told is not None:
        close = close.unionByName(_told_links(told, prints, nodes, job))
    placed = _placed(nodes, close)
    roots = common.connected(_far_links(prints, placed, job)).select(F.col("node").alias("c"), "root")
    rooted = placed.join(roots, F.col("comp") == F.col("c"), "left").select("node", "first", F.coalesce("root", "comp").alias("root"))
    rooted = common.stored(rooted, "rooted")
    classes = rooted.groupBy("root").agg(F.min("first").alias("component"))
    by_node = rooted.join(classes, "root").select(F.col("node").alias("at"), "component")
    told = prints.where("n is not null")
    found = told.select("id", "n", "node").join(by_node, (F.col("node") == F.col("at")) & (F.col("n") > 0), "left")
    own = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))
    return found.select("id", F.col("n").alias("n_shingles"), own.alias("component"))
