"""Packing, near copies, passages, decontamination, sharding and ranking against plain versions."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyflow.llm import chunks, common, decontam, packing, quality, queries, sharding, simhash

SCHEMA = "doc_id long, text string, id long, row long, _row long, score double, key string"


def words(rng, n):
    return [rng.choice("abcdefgh") + str(rng.randrange(4000)) for _ in range(n)]


def table(spark, rows):
    """Documents with further columns whose names the operators use inside."""
    return spark.createDataFrame([(*r, 1, 2, 3, 0.5, "k") for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd_rows():
    rng = random.Random(3)
    long = " ".join(words(rng, 30_000))
    same = " ".join(words(rng, 120))
    return [
        (1, None), (2, ""), (3, same), (3, same), (4, same), (None, same), (None, None), (5, long),
        (6, " \n\t "), (7, "a"), (8, same.upper()), (9, "É ü ñ 漢字 \U0001f600 ½ x"), (10, same + " more"), (10, "other"),
    ]


# --- packing ----------------------------------------------------------------
def test_word_encoder_equals_the_tokenizer():
    from hypothesis import given, settings
    from hypothesis import strategies as st
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(queries.TOKENIZER)
    fast = packing.encoder(queries.TOKENIZER, queries.RANKS)
    piece = st.sampled_from([" ", "  ", "   ", "\n", "\t", "a", "Zb", "it's", "é", "½", "²", "12", ",", "...", "<|endoftext|>", "\x1c", "\xa0", "漢", "ªb", "_", "?!"])
    texts = st.one_of(st.text(), st.lists(piece, max_size=12).map("".join))

    @settings(max_examples=600, deadline=None)
    @given(texts)
    def check(text):
        if any("\ud800" <= c <= "\udfff" for c in text):
            return
        ids = np.frombuffer(fast(text), "<u4").tolist()
        assert ids == whole.encode(text, add_special_tokens=False).ids

    check()


def test_place_fills_sequences():
    rng = np.random.default_rng(5)
    lengths = np.sort(rng.integers(1, 2049, 5000))[::-1]
    sequence, offset = packing.place(lengths, 2048)
    used = Counter()
    for s, o, n in sorted(zip(sequence.tolist(), offset.tolist(), lengths.tolist())):
        assert o == used[s]
        used[s] += n
    assert max(used.values()) <= 2048
    assert len(used) <= 1.01 * lengths.sum() / 2048 + 1
    # The rule, checked against every open sequence.
    small = [7, 7, 6, 5, 5, 4, 3, 3, 2, 2, 1, 1, 1]
    gap = {}
    for n, s in zip(small, packing.place(small, 10)[0].tolist()):
        fits = {g for g in gap.values() if g >= n}

        def squares(g):
            after = Counter(gap.values())
            after.subtract([g])
            after[g - n] += 1
            return sum(c * c for left, c in after.items() if left)

        assert (s in gap) == bool(fits)
        if fits:
            assert squares(gap[s]) == min(map(squares, fits))
        gap[s] = gap.get(s, 10) - n


def test_packing_of_odd_rows(spark, odd_rows):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(queries.TOKENIZER)
    got = packing.pack_documents(table(spark, odd_rows), queries.TOKENIZER, queries.RANKS).collect()
    want = Counter()
    for key, text in odd_rows:
        ids = whole.encode(text or "", add_special_tokens=False).ids + [0]
        for n, (start, length) in enumerate(packing.cut(len(ids), 2048)):
            raw = np.array(ids[start : start + length], "<u4").tobytes()
            want[(key, n, start, length, zlib.crc32(raw))] += 1
    assert Counter((r.id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    filled = defaultdict(list)
    for r in got:
        filled[r.sequence_id].append((r.offset, r.length))
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack_documents(table(spark, []), queries.TOKENIZER, queries.RANKS).count() == 0


# --- near copies ------------------------------------------------------------
def plain_components(prints, distance):
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a in prints:
        for b in prints:
            if a < b and (a ^ b).bit_count() <= distance:
                root[find(a)] = find(b)
    return {p: find(p) for p in prints}


def test_links_are_all_pairs(spark):
    rng = random.Random(1)
    prints = {rng.getrandbits(64) for _ in range(60)} | {0, (1 << 64) - 1}
    for p in list(prints):
        for flips in range(1, 7):
            q = p
            for bit in rng.sample(range(64), flips):
                q ^= 1 << bit
            prints.add(q)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    for distance in (0, 1, 3, 4):
        nodes = spark.createDataFrame([(p, [p]) for (p,) in signed], "node long, fps array<long>")
        got = sorted((r.a, r.b) for r in simhash.links(nodes, distance).collect())
        want = sorted((a, b) for (a,) in signed for (b,) in signed if a < b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= distance)
        assert got == want


def test_links_of_several_words_are_all_pairs(spark):
    rng = random.Random(11)
    rows = [[rng.getrandbits(64) for _ in range(4)] for _ in range(20)]
    for own in list(rows):
        for flips in (5, 20, 31, 38, 44):
            other = list(own)
            for bit in rng.sample(range(256), flips):
                other[bit // 64] ^= 1 << bit % 64
            rows.append(other)
    signed = [[w - (1 << 64) if w >> 63 else w for w in r] for r in rows]
    nodes = spark.createDataFrame(list(enumerate(signed)), "node long, fps array<long>")
    apart = lambda a, b: [((x ^ y) & ((1 << 64) - 1)).bit_count() for x, y in zip(a, b)]
    for distance, in_word in ((31, None), (40, 7)):
        got = sorted((r.a, r.b) for r in simhash.links(nodes, distance, 4, in_word).collect())
        want = [
            (i, j) for i, a in enumerate(signed) for j, b in enumerate(signed)
            if i < j and sum(apart(a, b)) <= distance and min(apart(a, b)) <= 7
        ]
        assert got == want and len(got) > 40


def test_connected(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, b) for b in range(101, 160)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    got = {r.node: r.root for r in common.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}
    for a, b in edges:
        for x in (a, b):
            root.setdefault(x, x)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    assert got == {k: v for k, v in root.items() if k in got}
    assert set(got) == {x for e in edges for x in e if e[0] != e[1]}
    assert common.connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_simhash_query_equals_all_pairs(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    prints = {r.doc_id: simhash.fingerprint(r.text or "", 4) for r in rows}
    roots = plain_components(set(prints.values()), 4)
    least = {}
    for key, p in prints.items():
        least[roots[p]] = min(key, least.get(roots[p], key))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op9_deletion_variant_simhash(spark, sf_dir).collect()}
    assert got == {k: (f"{p:016x}", least[roots[p]]) for k, p in prints.items()}


def test_near_copies_of_odd_rows(spark, odd_rows):
    docs = table(spark, odd_rows)
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(odd_rows)
    by = defaultdict(set)
    for r in got:
        by[r.id].add(r.component)
    assert by[1] == by[2] == by[6] == {1} and by[3] == by[4] == by[8] == {3}
    assert by[None] == {3, 1}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[1] == 1 and ids[3] == 1 and ids[4] == 0 and ids[None] == 0 and ids[2] == 0
    assert simhash.near_duplicates(table(spark, [])).count() == 0 and simhash.keep_one(table(spark, [])).count() == 0


# --- passages ---------------------------------------------------------------
def test_cuts_come_back_after_an_insertion():
    rng = random.Random(4)
    raw = " ".join(words(rng, 2000)).encode()
    moved = raw[:5000] + b"something new" + raw[5000:]
    a, b = chunks.cuts(raw), chunks.cuts(moved)
    assert a[-1] == len(raw) and all(0 < y - x <= chunks.LONGEST for x, y in zip([0, *a], a))
    parts = {raw[x:y] for x, y in zip([0, *a], a)}
    same = sum(y - x for x, y in zip([0, *b], b) if moved[x:y] in parts)
    assert same > len(raw) - 400
    assert chunks.cuts(b"") == [] and chunks.cuts(b"x" * 1000)[-1] == 1000
    h, gear = 0, chunks.gear().tolist()
    hashes = []
    for byte in raw:
        h = (2 * h + gear[byte]) & 0xFFFF
        hashes.append(h)
    # A chunk ends where the plain rolling hash says, or where it is least, if it says so nowhere within reach.
    for x, y in zip([0, *a], a):
        if hashes[y - 1] >> (16 - chunks.CUT_BITS) and y < len(raw):
            reach = hashes[x + chunks.SHORTEST - 1 : x + chunks.LONGEST]
            assert min(reach) >> (16 - chunks.CUT_BITS) and y == x + chunks.SHORTEST + reach.index(min(reach))


def test_periodic_text_comes_back_in_step():
    rng = random.Random(5)
    for n in (1, 2, 3, 9):
        raw = (" ".join(words(rng, n)) + " ").encode() * 400
        moved = b"before it" + raw[3:]
        parts = {raw[x:y] for x, y in zip([0, *chunks.cuts(raw)], chunks.cuts(raw))}
        ends = chunks.cuts(moved)
        assert sum(y - x for x, y in zip([0, *ends], ends) if moved[x:y] in parts) > len(moved) - 2 * chunks.LONGEST


def plain_passages(rows):
    """Repeated passages by looking at every run of chunks of every row."""
    last = (1 << 63) - 1
    first, parts_of, raws = {}, [], [(text or "").encode() for _, text in rows]
    for at, (key, _) in enumerate(rows):
        ends = chunks.cuts(raws[at])
        parts_of.append([(x, y, raws[at][x:y]) for x, y in zip([0, *ends], ends)])
        for x, _, part in parts_of[-1]:
            first[part] = min(first.get(part, (last, at, x)), (last if key is None else key, at, x))
    out = Counter()
    for at, (key, _) in enumerate(rows):
        raw, runs = raws[at], {}
        for x, y, part in parts_of[at]:
            holder, row, start = first[part]
            if holder >= (last if key is None else key):
                continue
            mine = runs.setdefault((holder, row, x - start), [])
            if mine and mine[-1][1] == x:
                mine[-1][1:] = [y, mine[-1][2] + 1]
            else:
                mine.append([x, y, 1])
        spans = []
        for (holder, row, shift), found in runs.items():
            other = raws[row]
            for x, y, n in found:
                low, high = max(0, x - chunks.PASSAGE), y + chunks.PASSAGE
                while x > low and x > shift and raw[x - 1] == other[x - 1 - shift]:
                    x -= 1
                while y < min(high, len(raw), len(other) + shift) and raw[y] == other[y - shift]:
                    y += 1
                assert raw[x:y] == other[x - shift : y - shift]
                if y - x >= chunks.PASSAGE:
                    spans.append((x, x - y, holder, -n))
        reached = 0
        for x, size, holder, n in sorted(spans):
            if x - size > reached:
                out[(key, x, -size, -n, holder)] += 1
                reached = x - size
    return out


def test_repeated_passages_equal_a_plain_version(spark, odd_rows):
    rng = random.Random(6)
    shared = " ".join(words(rng, 60))
    rows = [*odd_rows, *((100 + i, " ".join([*words(rng, 40), shared, *words(rng, 40)])) for i in range(5)), (200, " ".join(words(rng, 300)))]
    docs = table(spark, rows)
    got = Counter((r.id, r.start, r.n_bytes, r.n_chunks, r.first_id) for r in chunks.repeated_passages(docs).collect())
    assert got == plain_passages(rows)
    told = {k[0] for k in got}
    assert {101, 102, 103, 104, 4, None} <= told and not told & {1, 2, 3, 5, 7, 100, 200}
    cut = chunks.without_repeats(docs)
    assert cut.columns == docs.columns
    texts = defaultdict(list)
    for r in cut.collect():
        texts[r.doc_id].append(r.text)
    assert len(texts[3][0]) == len(odd_rows[2][1]) and all(len(texts[i][0]) < 800 for i in (101, 102)) and texts[1] == [None]
    assert chunks.repeated_passages(table(spark, [])).count() == 0


def test_passages_are_told_whole_and_from_one_document(spark):
    rng = random.Random(16)
    rows, want = [], {}
    for i in range(60):
        shared = " ".join(words(rng, 51))
        for key in (i, 1000 + i):
            before, after = " ".join(words(rng, rng.randrange(5, 40))) + " ", " " + " ".join(words(rng, 30))
            rows.append((key, before + shared + after))
            want[key] = (len(before), len(shared))
    # Two halves of 80 bytes from two documents are no passage, nor are they one of 160 bytes.
    halves = ["".join(rng.choice("abcdefghij ") for _ in range(80)) for _ in range(2)]
    rows += [(5000, "x" + halves[0] + "y" * 300), (5001, "z" + halves[1] + "w" * 300), (5002, "u" + halves[0] + halves[1] + "v")]
    # One passage in a third of all rows.
    rows += [(6000 + i, f"{i} {' '.join(words(rng, 4))} {rows[0][1]}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = chunks.repeated_passages(docs).collect()
    assert Counter((r.id, r.start, r.n_bytes, r.n_chunks, r.first_id) for r in found) == plain_passages(rows)
    by_id = defaultdict(list)
    for r in found:
        by_id[r.id].append(r)
    whole = 0
    for key, (start, size) in want.items():
        if key < 1000:
            assert key not in by_id
        else:
            # No more is lost than what a chunk of greatest length reaches beyond the extension.
            lost = chunks.LONGEST - chunks.PASSAGE
            assert min(r.start for r in by_id[key]) <= start + lost and max(r.start + r.n_bytes for r in by_id[key]) >= start + size - lost
            whole += min(r.start for r in by_id[key]) <= start and max(r.start + r.n_bytes for r in by_id[key]) >= start + size
            assert {r.first_id for r in by_id[key]} == {key - 1000}
    assert whole >= 50
    assert not {5000, 5001, 5002} & set(by_id) and all(len(by_id[6000 + i]) for i in range(60))
    cut = {r.doc_id: r.text for r in chunks.without_repeats(docs).collect()}
    assert all(cut[k] == t for k, t in rows if k < 1000) and all(len(cut[6000 + i]) < 60 for i in range(60))


# --- decontamination --------------------------------------------------------
def test_masks_find_every_window():
    from itertools import combinations

    spots = [sum(1 << (s + i) for i, c in enumerate(m) if c == "1") for m in decontam.MASKS for s in range(13 - len(m) + 1)]
    for bad in combinations(range(13), 2):
        assert any(not p & ((1 << bad[0]) | (1 << bad[1])) for p in spots), bad


def test_decontamination_equals_all_places(spark, odd_rows):
    rng = random.Random(8)
    items = [(i, " ".join(words(rng, n))) for i, n in enumerate((40, 25, 13, 9, 6, 5, 4, 1))] + [(9, None), (10, ""), (None, "z " * 30)]
    rows = list(odd_rows)
    for i, (_, text) in enumerate(items[:8]):
        for swaps in range(4):
            own = text.split()
            for at in rng.sample(range(len(own)), min(swaps, len(own))):
                own[at] = "swapped"
            rows.append((1000 + 10 * i + swaps, " ".join([*words(rng, 50), *own, *words(rng, 50)]).title().replace(" ", ", ")))
    benchmark = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, item long")
    docs = table(spark, rows)
    got = Counter(tuple(r[c] for c in ("id", "item", "start", "words", "equal")) for r in decontam.contaminated(docs, benchmark).collect())
    want = Counter()
    for key, text in rows:
        own = decontam.word_hashes(text or "")
        for item, passage in items:
            # The long text holds the item of one word by chance.
            if item is None or key == 5 and item != 7:
                continue
            other = decontam.word_hashes(passage or "")
            for shift in range(-len(other), len(own)) if len(other) else ():
                for run in decontam.overlaps(own, other, shift, 13, 0.8):
                    want[(key, item, *run)] += 1
    assert got == want
    bad = {k[0] for k in got}
    assert {1000, 1001, 1002, 1003, 1010, 1020, 1030, 1040, 1050, 1060, 1070} <= bad and not bad & {1, 2, 3, 7, 1031, 1041, 1051}
    kept = decontam.remove_contaminated(docs, benchmark)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(k for k, _ in rows if k not in bad)
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contaminated(docs, nothing).count() == 0 and decontam.contaminated(table(spark, []), benchmark).count() == 0
    assert decontam.remove_contaminated(docs, nothing).count() == len(rows)


# --- sharding ---------------------------------------------------------------
def test_shards(spark, odd_rows):
    rng = random.Random(9)
    rows = [*odd_rows, *((i, "t" * rng.randrange(9)) for i in range(2000, 5000))]
    tree = sharding.even_tree(4, 2, 2)
    got = sharding.assign(table(spark, rows), tree, sharding.with_region(tree, 16)).collect()
    want = Counter((k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t in rows)
    assert Counter((r.id, r["size"], r.text_crc32) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 16)
    assert set(by) == set(range(16)) and all(sorted(v) == list(range(len(v))) for v in by.values())
    assert len({r.shard for r in got if r.id is None}) == 1
    moved = sum(r.grown_shard == 16 for r in got) / len(got)
    assert 0.03 < moved < 0.09 and max(map(len, by.values())) < 1.5 * len(rows) / 16
    assert sharding.assign(table(spark, []), tree, tree).count() == 0


def test_weights_move_rows_in_their_subtree_only(spark):
    tree = sharding.even_tree(3, 2, 2)
    heavier = [leaf._replace(weight=3.0) if leaf.shard == 5 else leaf for leaf in tree]
    rows = spark.range(6000).select(sharding.shard_of(F.col("id"), tree).alias("a"), sharding.shard_of(F.col("id"), heavier).alias("b")).collect()
    region = {leaf.shard: leaf.region for leaf in tree}
    assert all(r.a == r.b or region[r.b] == region[5] for r in rows)
    share = sum(r.b == 5 for r in rows) / len(rows)
    assert abs(share - 3 / 14) < 0.03
    with pytest.raises(ValueError):
        sharding.shard_of(F.col("id"), [])


# --- ranking ----------------------------------------------------------------
def test_ranking_tells_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = [r for r in queries.op6_bradley_terry_quality(spark, sf).collect() if r.held_out and r.doc_id in labels]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    right = [(r.predicted == labels[r.doc_id], labels[r.doc_id]) for r in got]
    for kind in (0, 1):
        own = [a for a, b in right if b == kind]
        assert sum(own) / len(own) > 0.8
    assert all(r.predicted == (r.score >= 0.3) for r in got)


def test_ranking_of_odd_rows(spark, odd_rows):
    docs = table(spark, odd_rows)
    labels = spark.createDataFrame([(3, 1, 9), (7, 0, 9), (None, 1, 9), (5, None, 9), (99, 0, 9), (9, 7, 9)], "doc_id long, quality int, x int")
    got = quality.rank(docs, labels).collect()
    assert Counter(r.id for r in got) == Counter(k for k, _ in odd_rows) and all(0 <= r.score <= 1 for r in got)
    empty = spark.createDataFrame([], "doc_id long, quality int")
    assert all(r.score > 0.3 for r in quality.rank(docs, empty).collect())
    assert quality.rank(table(spark, []), labels).count() == 0
    model = quality.train(quality.feature_table(docs), labels)
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns
    scored = Counter(r.id for r in got if r.score >= quality.CUT)
    assert Counter(r.doc_id for r in kept.collect()) == scored
    # A pair's order is what is learned: better features score higher.
    rng = np.random.default_rng(1)
    good, bad = rng.normal(1, 1, (200, 3)), rng.normal(0, 1, (200, 3))
    weights = quality.fit_pairs(good, bad)
    assert ((good @ weights)[:, None] > (bad @ weights)[None, :]).mean() > 0.8
