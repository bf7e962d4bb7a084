"""The quality model is learned from all labelled rows, not from a part of them."""

from tallyflow.llm import quality


def test_every_labelled_row_counts(spark):
    # Far more rows than any sample was; one label is rare.
    rows = spark.range(0, 30_000, 1, 4).selectExpr("id", "array(cast(id % 7 as float), cast(id as float)) as x")
    labels = spark.range(30_000).selectExpr("id as doc_id", "if(id < 300, 0, 1) as quality")
    model = quality.train(rows, labels)
    assert abs(model.mean[1] - 29_999 / 2) < 1e-6
    # The labels part between the ids 299 and 300; a threshold is one of a thousand quantiles, 30 rows apart.
    scores = {r.id: model.score([r.x]) for r in rows.where("id in (0, 150, 250, 350, 20000, 29999)").collect()}
    assert all((scores[i][0] >= quality.CUT) == (i >= 300) for i in scores)
