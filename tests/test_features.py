"""Term counts in the row, and what is shuffled for them."""

from collections import Counter

import pytest

from corpuslab.operators import features as FT


def _want(rows):
    got = Counter()
    for key, text in rows:
        words = [w for w in (text or "").lower().split() if len(w) > 1 and w not in FT.STOP_WORDS]
        got.update((key, w) for w in words)
        got.update((key, f"{a} {b}") for a, b in zip(words, words[1:]))
    return got


@pytest.mark.parametrize("again", [[], [("a", "red fox red fox"), ("b", "blue"), (None, "red red"), (None, "red owl")]])
def test_term_counts_with_repeated_and_null_keys(spark, again):
    rows = [("a", "the red fox red fox runs"), ("b", "blue owl"), ("c", ""), ("d", None), ("e", "x of the")] + again
    docs = spark.createDataFrame(rows, "id string, text string")
    got = FT._term_counts(docs, "id", "text", FT.STOP_WORDS)
    assert sorted(map(str, got.collect())) == sorted(f"Row(id={k!r}, term={t!r}, tf={n})" for (k, t), n in _want(rows).items())
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert ("Aggregate [" in plan) == bool(again)  # a key's terms are counted in its row
    model = FT.tfidf_fit(docs)
    weights = FT.tfidf_transform(docs, model).collect()
    assert {(r["id"], r["term"]) for r in weights} == {k for k in _want(rows) if k[0] is not None}
    norms = Counter()
    for r in weights:
        norms[r["id"]] += r["weight"] ** 2
    assert all(abs(n - 1) < 1e-9 for n in norms.values())
