"""Every step of the pipeline has an effect on its result."""

from tallyflow.llm import simhash


def test_near_copies_need_no_fingerprints(spark, monkeypatch):
    monkeypatch.setattr(simhash, "fingerprints", lambda *_, **__: (_ for _ in ()).throw(AssertionError("unused step")))
    words = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:58])), (3, " ".join(words[::-1])), (4, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash.keep_one(docs).collect()) == [1, 3, 4]
