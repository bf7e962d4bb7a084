"""Importance resampling and vector codes against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tallyflow.llm import codebooks, resample


# --- importance resampling ---------------------------------------------------
def plain_words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain_buckets(text, grams, buckets):
    own = plain_words(text)
    runs = [" ".join(own[i : i + n]) for n in range(grams[0], grams[1] + 1) for i in range(len(own) - n + 1)]
    return Counter(zlib.crc32(r.encode()) % buckets for r in runs)


def plain_resample(docs, target, percent, least, grams, buckets, seed):
    counts = [plain_buckets(t, grams, buckets) for _, t in docs]
    s, t = sum(counts, Counter()), sum((plain_buckets(x, grams, buckets) for x in target), Counter())
    all_s, all_t = s.total() + buckets, t.total() + buckets
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in s}
    rows = []
    for (key, text), own in zip(docs, counts):
        weight = sum(gain[b] * n for b, n in own.items()) // own.total() if own else 0
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        rows.append((key, len(plain_words(text)), own.total(), weight, score))
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], -1 if r[0] is None else r[0]))
    rank = {id(r): i + 1 for i, r in enumerate(able[: len(able) * percent // 100])}
    return Counter((*r, rank.get(id(r))) for r in rows)


def texts(rng, n):
    words = ["Straße", "naïve", "A1", "b2", "ﬁn", "x", "日本", "the", "THE", "über-all", "d'or", "3.14"] + [f"w{i}" for i in range(40)]
    return [rng.choice(" ,\n--\t").join(rng.choice(words) for _ in range(rng.randrange(60))) for _ in range(n)]


@pytest.mark.parametrize("grams, least, percent", [((1, 1), 20, 10), ((1, 3), 0, 33), ((2, 2), 5, 100)])
def test_resampling_equals_a_plain_version(spark, grams, least, percent):
    rng = random.Random(21)
    docs = list(enumerate(texts(rng, 200))) + [(1000, None), (1001, ""), (1002, "—"), (1003, "word " * 30_000), (None, "one two " * 20), (7, "again the")]
    target = [*texts(rng, 20), None, "", "日本 the"]
    table = spark.createDataFrame([(*d, 1, "x", 0.5) for d in docs], "doc_id long, text string, n_words long, buckets string, score double")
    wanted = spark.createDataFrame([(t, 3) for t in target], "text string, id long")
    for seed, buckets in ((2024, 10000), (7, 50)):
        params = dict(percent=percent, least_words=least, grams=grams, buckets=buckets, seed=seed)
        got = resample.resample(table, wanted, **params)
        want = plain_resample(docs, target, percent, least, grams, buckets, seed)
        assert Counter(tuple(r) for r in got.select("id", "n_words", "n_features", "weight", "score", "rank").collect()) == want
    drawn = resample.drawn_rows(table, wanted, **params)
    ids = {r[0] for r in want if r[5] is not None}
    assert drawn.columns == table.columns
    assert Counter(r.doc_id for r in drawn.collect()) == Counter(k for k, _ in docs if k in ids)
    assert resample.resample(table.limit(0), wanted).count() == 0
    assert resample.resample(table, wanted.limit(0), **params).where("rank is not null").count() == sum(r[5] is not None for r in want)


def test_spans_are_all_runs_of_words():
    import regex

    line = resample.squeezed("  One,two;;THREE\nvier über ".encode(), regex.compile(resample.SEPARATORS))
    assert line.decode() == "one two three vier über"
    for n in (1, 2, 3, 6):
        found = [m.group().decode() for m in regex.finditer(resample.spans_of(n), line, overlapped=True)]
        own = line.decode().split(" ")
        assert found == [" ".join(own[i : i + n]) for i in range(len(own) - n + 1)]


def test_the_draw_moves_towards_the_target(spark):
    rng = random.Random(22)
    near, far = [[f"{side}{i}" for i in range(50)] for side in "nf"]
    docs = [(i, " ".join(rng.choice(near if i % 10 == 0 else far) for _ in range(30))) for i in range(1000)]
    target = spark.createDataFrame([(" ".join(rng.choice(near) for _ in range(30)),) for _ in range(50)], "text string")
    drawn = resample.drawn_rows(spark.createDataFrame(docs, "doc_id long, text string"), target, percent=10)
    # Without weights a tenth of the hundred drawn would be near; noise keeps it a draw.
    assert sum(r.doc_id % 10 == 0 for r in drawn.collect()) > 40


# --- vector codes ------------------------------------------------------------
def plain_codes(rows, parts, entries, rounds):
    """rows: (id, v) in order; codes, errors and books."""
    width = max((-(-len(v) // parts) for _, v in rows), default=0)
    x = np.zeros((len(rows), parts * width), object)
    for i, (_, v) in enumerate(rows):
        x[i, : len(v)] = v
    x = x.reshape(len(rows), parts, width)
    books = [x[:entries, p].copy() for p in range(parts)]

    def nearest(p, part):
        return min(range(len(books[p])), key=lambda e: (sum((a - b) ** 2 for a, b in zip(part, books[p][e])), e))

    for round_ in range(rounds + 1):
        codes = [[nearest(p, x[i, p]) for p in range(parts)] for i in range(len(rows))]
        if round_ < rounds:
            for p in range(parts):
                for e in range(len(books[p])):
                    mine = [x[i, p] for i in range(len(rows)) if codes[i][p] == e]
                    if mine:
                        books[p][e] = [sum(column) // len(mine) for column in zip(*mine)]
    errors = [sum(int((a - b) ** 2) for p in range(parts) for a, b in zip(x[i, p], books[p][codes[i][p]])) for i in range(len(rows))]
    text = ",".join(str(int(v)) for book in books for entry in book for v in entry)
    return [bytes(c) for c in codes], errors, hashlib.sha256(text.encode()).hexdigest()


def coded(spark, rows, **params):
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "id long, label int, v array<long>, codes int, state string")
    found, books = codebooks.compress(table, **params)
    return found, books


def test_codes_equal_a_plain_version(spark):
    rng = random.Random(23)
    rows = [(i, i % 3 if i % 7 else None, [rng.randrange(-40, 40) + 300 * (i % 5) for _ in range(12)]) for i in range(300)]
    # Ties: equal rows among the first, and few values.
    rows += [(1000 + i, 4, [rng.randrange(2) for _ in range(12)]) for i in range(200)]
    rows = [(i, label, rows[0][2] if i in (1, 2) else v) for i, label, v in rows]
    for some, params in ((rows, dict(parts=4, entries=16, rounds=3)), (rows[::-1], dict(parts=5, entries=8, rounds=2)), (rows[:5], dict(parts=3, entries=64, rounds=1))):
        found, books = coded(spark, some, **params)
        got = {r.id: (bytes(r.codes), r.error) for r in found.collect()}
        ordered = sorted((i, v) for i, _, v in some)
        codes, errors, digest = plain_codes(ordered, **params)
        assert got == {i: pair for (i, _), pair in zip(ordered, zip(codes, errors))}
        assert books.digest() == digest
    labelled = {r.id: r.label_error for r in codebooks.label_errors(found).collect()}
    assert labelled == {i: sum(got[j][1] for j, m, _ in some if m == label) for i, label, _ in some}
    back = {r.id: r.v for r in codebooks.decoded(found, books).collect()}
    assert all(sum((a - b) ** 2 for a, b in zip(back[i], v)) == got[i][1] for i, _, v in some)


def test_codes_of_odd_rows(spark):
    rows = [(None, 1, [1, 2]), (1, None, None), (2, 1, [1, None]), (3, 1, []), (4, 2, [5]), (4, 2, [5]), (4, None, [6, 7, 8, 9, 10]), (5, 1, [2**25] * 5)]
    params = dict(parts=2, entries=3, rounds=2)
    found, books = coded(spark, rows, **params)
    ordered = [(3, []), (4, [5]), (4, [5]), (4, [6, 7, 8, 9, 10]), (5, [2**25] * 5)]
    codes, errors, digest = plain_codes(ordered, **params)
    got = Counter((r.id, bytes(r.codes), r.error) for r in found.collect())
    assert got == Counter((i, c, e) for (i, _), c, e in zip(ordered, codes, errors)) and books.digest() == digest
    assert coded(spark, [(1, 1, [])], **params)[0].select("error").first()[0] == 0
    with pytest.raises(ValueError, match="too large"):
        coded(spark, [(1, 1, [2**62])], **params)
    table = spark.createDataFrame([], "id long, label int, v array<long>")
    none, books = codebooks.compress(table)
    assert none.count() == 0 and books is None


def test_bounds_spare_most_rescans_and_change_nothing():
    rng = np.random.default_rng(24)
    centers = rng.integers(-2000, 2000, (8, 16))
    x = (centers[rng.integers(0, 8, 3000)] + rng.integers(-30, 30, (3000, 16))).reshape(3000, 4, 4).astype(float)
    history = [x[:8].transpose(1, 0, 2)]
    state, first = codebooks.assign(x, None, history)
    assert first == 3000 * 4
    spared = 0
    for _ in range(6):
        new = history[-1].copy()
        for p in range(4):
            for e in range(8):
                mine = x[state.codes[:, p] == e, p]
                if len(mine):
                    new[p, e] = np.floor(mine.sum(axis=0) / len(mine))
        history.append(new)
        state, rescans = codebooks.assign(x, state, history)
        fresh, _ = codebooks.assign(x, None, history)
        assert (state.codes == fresh.codes).all()
        spared += first - rescans
    # Net displacement is at most the way gone, and mostly less.
    net, _ = codebooks.net_moves(history, 0)
    steps = [np.sqrt(((b[0] - a[0]) ** 2).sum(axis=1)) for a, b in zip(history, history[1:])]
    assert (net[0] <= sum(steps) + 1e-9).all() and spared > 3 * first
