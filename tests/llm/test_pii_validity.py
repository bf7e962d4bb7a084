"""Card and social security numbers are replaced only where they can be such."""

from tallyflow.llm import pii

#: Luhn sums that fail, times in milliseconds, areas, groups and serials that are not given out.
NOT = ["5693240340017844", "4111 1111 1111 1112", "3782 822463 10006", "1700000000001", "000-12-3456", "666-12-3456", "912-12-3456", "123-00-4567", "123-45-0000"]
CARDS = ["4111111111111111", "5555-5555-5555-4444", "3782 822463 10005", "3782-822463-10005"]
OTHERS = ["123-45-6789", "1-212-555-0100"]


def luhn(text):
    digits = [int(c) for c in reversed(text) if c.isdigit()]
    return sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(digits)) % 10


def test_only_valid_numbers_are_replaced(spark):
    values = [*NOT, *CARDS, *OTHERS]
    assert all(luhn(v) for v in NOT[:4])
    docs = spark.createDataFrame([(i, f"by {v} was") for i, v in enumerate(values)], "doc_id long, text string")
    got = {values[r.doc_id]: (r.text, r.n) for r in pii.with_pseudonyms(docs, key="k", count_col="n").collect()}
    for v in NOT:
        assert got[v] == (f"by {v} was", 0), v
    for v in [*CARDS, *OTHERS]:
        text, n = got[v]
        assert n == 1 and text != f"by {v} was" and len(text) == len(v) + 7, v
        assert [c for c in text if not c.isdigit()] == [c for c in f"by {v} was" if not c.isdigit()]
    assert all(luhn(got[v][0]) == 0 for v in CARDS)
    assert got["1-212-555-0100"][0].startswith("by 1-")
