"""Signature trees and the pipeline's near-copies against exact similarity over all pairs."""

import itertools
import random

import numpy as np

from tallyflow.llm import sigtree, simhash


def shingles(text):
    own = text.lower().split()
    return {tuple(own)} if len(own) <= 5 else {tuple(own[i : i + 5]) for i in range(len(own) - 4)}


def similarity(a, b):
    return len(a & b) / len(a | b)


def roots_of(texts):
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))
    pairs = [p for p in itertools.combinations(root, 2) if similarity(sets[p[0]], sets[p[1]]) >= 0.8]
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            if root[a] != root[b]:
                root[a] = root[b] = min(root[a], root[b])
                changed = True
    return root


def near_texts(rng, count):
    """Texts, each followed by a copy with words changed, of a similarity around 0.8."""
    out = []
    for _ in range(count):
        own = [rng.choice("abcdefgh") + str(rng.randrange(4000)) for _ in range(rng.randrange(60, 300))]
        other = [f"new{rng.randrange(4000)}" if rng.random() < 0.02 else w for w in own]
        out += [" ".join(own), " ".join(other)]
    return out


def test_near_copies_at_the_bound_are_all_found(spark):
    rng = random.Random(11)
    texts = near_texts(rng, 120)
    # A group of many close texts with a chain that leads out of it.
    base = near_texts(rng, 1)[0].split()
    texts += [" ".join(f"c{i}x{j}" if rng.random() < 0.03 else w for j, w in enumerate(base)) for i in range(60)]
    now = list(base)
    for i in range(15):
        now[(i * 7) % len(now)] = f"step{i}"
        texts.append(" ".join(now))
    want = roots_of(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.id: r.component for r in sigtree.jaccard_components(docs).collect()}
    assert [got[i] for i in range(len(texts))] == want
    kept = {r.doc_id for r in simhash.keep_one(docs).select("doc_id").collect()}
    assert kept == set(want)
    # Fingerprints alone miss some of these.
    prints = [simhash.fingerprint(t) for t in texts]
    assert sum(want[i + 1] == i and (prints[i] ^ prints[i + 1]).bit_count() > 4 for i in range(0, 240, 2)) > 5


def components(spark, texts, **params):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.id: r.component for r in sigtree.jaccard_components(docs, **params).collect()}
    return [got[i] for i in range(len(texts))]


def test_a_line_that_many_texts_share(spark):
    rng = random.Random(12)
    line = "one two three four five six seven eight nine ten eleven twelve"
    texts = [f"{line} {t}" for t in near_texts(rng, 80)]
    assert components(spark, texts) == roots_of(texts)


def test_small_trees_and_blocks_lose_nothing(spark, monkeypatch):
    """Every group is cut into many trees, leaves and parts, and no least hash links anything."""
    rng = random.Random(13)
    texts = near_texts(rng, 60)
    base = near_texts(rng, 1)[0].split()
    texts += [" ".join(f"c{i}x{j}" if rng.random() < 0.02 else w for j, w in enumerate(base)) for i in range(40)]
    want = roots_of(texts)
    monkeypatch.setattr(sigtree, "LARGEST", 5)
    monkeypatch.setattr(sigtree, "LEAF", 3)
    monkeypatch.setattr(sigtree, "WHOLE", 4)
    assert components(spark, texts) == want
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(sigtree, "_close_links", lambda prints, nodes, job: prints.selectExpr("node as a", "node as b").limit(0))
    got = {r.id: r.component for r in sigtree.jaccard_components(docs).collect()}
    assert [got[i] for i in range(len(texts))] == want
    told = spark.createDataFrame([(i, j) for i, j in itertools.combinations(range(12), 2)] + [(0, 999)], "a long, b long")
    got = {r.id: r.component for r in sigtree.jaccard_components(docs, told=told).collect()}
    assert [got[i] for i in range(len(texts))] == want


def test_descent_finds_every_pair_and_leaves_pairs_out():
    rng = random.Random(14)
    sets = [np.array(sorted(rng.sample(range(10**15), rng.randrange(1, 60))), np.uint64) for _ in range(150)]
    sets += [np.unique(np.concatenate([s[: len(s) * 9 // 10], s[:1]])) for s in sets]
    sets.sort(key=len)
    want = {(i, j) for i, j in itertools.combinations(range(300), 2) if sigtree.similar_sets(sets[i], sets[j], 80)}
    nodes = sigtree.nodes_of(sets)
    looked = [p for i, j in sigtree.descend(nodes, None, 80) for p in zip(i.tolist(), j.tolist())]
    assert want <= set(looked) and len(looked) == len(set(looked)) < 3000 < 300 * 299 / 2
    left, right = (sigtree.Nodes(*[c[part] for c in nodes]) for part in (slice(0, 120), slice(120, 300)))
    both = {(i, 120 + j) for a, b in sigtree.descend(left, right, 80) for i, j in zip(a.tolist(), b.tolist())}
    assert {(i, j) for i, j in want if i < 120 <= j} <= both
    # Bitmaps of two widths: the narrow one is repeated.
    x, y = sets[-1], sets[-1][:-2]
    wide = [sigtree.bitmap(x, 256), sigtree.bitmap(y, 128)]
    pair = sigtree.Nodes(np.array([len(x), len(y)]), np.array([len(x), len(y)]), np.array([w[1] for w in wide]), sigtree.widened([w[0] for w in wide], 4))
    assert sigtree.can_link(pair, pair, np.array([0]), np.array([1]), 80)[0]


def test_odd_rows_of_the_similarity_join(spark):
    rows = [(5, None), (6, ""), (7, " \t\n"), (8, "Two words"), (9, "two\tWORDS"), (8, "two words"), (None, "TWO words"), (None, "no id"), (10, "word " * 50_000)]
    docs = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "doc_id long, text string, row long, component long, hashes string")
    got = sorted(((r.id, r.n_shingles, r.component) for r in sigtree.jaccard_components(docs).collect()), key=str)
    want = [(5, 0, 5), (6, 0, 6), (7, 0, 7), (8, 1, 8), (8, 1, 8), (9, 1, 8), (10, 1, 10), (None, 1, 8), (None, 1, None)]
    assert got == sorted(want, key=str)
    assert sigtree.jaccard_components(docs.limit(0)).count() == 0


def test_only_asked_texts_are_moved(spark, monkeypatch):
    """Texts that no group of whole sets and no pair of leaves asks for are left out before a shuffle; no asked one is."""
    plans, keep = {}, sigtree.common.stored

    def stored(df, purpose):
        plans[purpose] = df._jdf.queryExecution().executedPlan().toString()
        return keep(df, purpose)

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    words = lambda i: [f"w{i}x{k}" for k in range(40)]
    near = [(i, " ".join(words(i))) for i in range(60)] + [(100 + i, " ".join([*words(i)[:39], "end"])) for i in range(0, 60, 20)]
    docs = spark.createDataFrame(near, "doc_id long, text string").repartition(7)
    monkeypatch.setattr(sigtree.common, "stored", stored)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = {r.id: r.component for r in sigtree.jaccard_components(docs).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert found == {i: i % 100 for i, _ in near}
    # Sets are made where the texts lie; whole texts are filtered before they are dealt out for a join.
    assert "Exchange" not in plans["sets"]
    assert plans["close"].count("MapInArrow") == 2


def test_marked_rows_hold_all_that_are_asked(spark, monkeypatch):
    rows = [(part << 33) + at for part in (0, 1, 5, 700, 90_000) for at in range(300)]
    texts = spark.createDataFrame([(r, b"t") for r in rows], "row long, text binary")
    asked = [r for r in rows if r % 7 == 0]
    job = sigtree.Job(texts, 5, 80, 4)
    wanted = spark.createDataFrame([(r,) for r in asked], "row long")
    assert sorted(r.row for r in sigtree._asked_texts(wanted, job).collect()) == asked
    # With few bits rows share some; more pass, and none is lost.
    monkeypatch.setattr(sigtree, "MARK_BITS", 15)
    assert set(asked) <= {r.row for r in sigtree._asked_texts(wanted, job).collect()}
    assert sigtree._asked_texts(wanted.limit(0), job).count() == 0
