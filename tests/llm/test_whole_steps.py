"""Steps that take all their rows: rounds of the language model, fingerprints before signature trees, joins of exploded rows."""

import numpy as np
import corpus_pipeline
from pyspark.sql import functions as F

from tallyflow.functions import tokens
from tallyflow.llm import common, hmm, simhash


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_round_goes_over_all_training_texts(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"a b{i % 7} c{i % 3}") for i in range(200)], "doc_id long, text string")
    seen, welch = [], hmm.baum_welch
    monkeypatch.setattr(hmm, "baum_welch", lambda encoded, *more: seen.append(encoded.count()) or welch(encoded, *more))
    assert hmm.score(docs, F.col("doc_id") % 10 != 0).count() == 200
    assert seen == [180] * (hmm.WARM_ROUNDS + hmm.ROUNDS)


def test_blocks_and_groups_change_no_counts(monkeypatch):
    rng = np.random.default_rng(3)
    model = hmm.first_states(rng.integers(1, 50, hmm.CLASSES), 4)
    sizes = [1, 1, 2, 30, 31, 90, 400, 400]
    codes = [np.append(rng.integers(0, hmm.END, n - 1), hmm.END).astype(np.uint16) for n in sizes]

    def counted():
        groups = list(hmm.groups_of(codes))
        assert sorted(i for g in groups for i in g) == list(range(len(codes)))
        return [sum(part) for part in zip(*(hmm.expected_counts([codes[i] for i in g], model) for g in groups))]

    want = counted()
    assert np.isclose(want[0].sum(), len(codes)) and np.isclose(want[2].sum(), sum(sizes))
    for cells, block, every in ((500, 7, 1), (1, 1, 3), (1_000_000, 50, 1000)):
        for name, value in (("CELLS", cells), ("BLOCK", block), ("EVERY", min(every, 40))):
            monkeypatch.setattr(hmm, name, value)
        assert all(np.allclose(a, b) for a, b in zip(counted(), want))
    codes = codes[:2]  # texts without words
    assert counted()[1].sum() == 0


def test_fingerprints_of_all_documents_come_before_the_trees(spark, sf_dir, monkeypatch):
    words = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:58])), (3, " ".join(words[::-1])), (3, "x"), (None, "x"), (4, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen, search, trees = [], simhash.near_duplicates, simhash.sigtree.jaccard_components
    monkeypatch.setattr(simhash, "near_duplicates", lambda docs, *more: seen.append(docs.count()) or search(docs, *more))
    told = []
    monkeypatch.setattr(simhash.sigtree, "jaccard_components", lambda *a: told.append(a[-1].count()) or trees(*a))
    kept = corpus_pipeline.one_of_each_group(spark, docs, sf_dir)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 3, 4]
    assert seen == [7] and told[0] >= 2  # copies of x, and texts without words


def test_exploded_rows_are_not_sent_to_the_driver(spark):
    """Spark sizes exploded rows like the rows they come from, here far below the limit of a broadcast."""
    nodes = spark.createDataFrame([(i, [i * 7919]) for i in range(50)], "node long, fps array<long>")
    nodes = common.stored(nodes, "few-nodes")  # so that its size is known
    found = plan(simhash.links(nodes, 4))
    assert "SortMergeJoin" in found and "Broadcast" not in found
    runs = spark.createDataFrame([(i, f"ab{i}") for i in range(50)], "id long, run string")
    lexicon = spark.createDataFrame([("ab",), ("b1",)], "word string")
    runs, lexicon = common.stored(runs, "few-runs"), common.stored(lexicon, "few-words")
    joined = tokens.dictionary_words(runs, "run", lexicon, script=r"[\p{L}\p{N}]")
    by_run = [line for line in plan(joined).splitlines() if "Join [_id" in line]
    assert len(by_run) == 2 and all("SortMergeJoin" in line for line in by_run)
