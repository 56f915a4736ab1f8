import random
import zlib

import fixtures as fx
import numpy as np

from corpuslab.llm import op8_quality as c


def labelled(n=600):
    rng = random.Random(4)
    docs, labels = [], []
    for i in range(n):
        good = i % 5 != 0
        text = fx.prose(rng, rng.randint(30, 200))
        if not good:
            text = rng.choice([lambda t: t.upper() + "!!", lambda t: t.replace(" ", "### "), lambda t: t.replace(" ", " | "), lambda t: (t[:12] + " ") * 40])(text)
        docs.append((i, text, "en", "s", 0))
        labels.append((i, int(good), 0))
    return docs, labels


def test_held_out_rows_are_told_apart(spark):
    docs, labels = labelled()
    table = fx.clashing(fx.documents(spark, docs))
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = {r.doc_id: r for r in c.scores(table, marks).collect()}
    assert len(got) == len(docs)
    want = {i: q for i, q, _ in labels}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())
    held = [(want[i], r.predicted) for i, r in got.items() if r.held_out]
    assert np.mean([a == b for a, b in held]) > 0.93
    # labels of held-out rows, lang and source change nothing
    other = spark.createDataFrame([(i, 1 - q if got[i].held_out else q, t) for i, q, t in labels], "doc_id bigint, quality int, toxic int")
    again = {r.doc_id: r.score for r in c.scores(table.selectExpr("doc_id", "text", "'xx' lang", "'yy' source"), other).collect()}
    assert all(abs(again[i] - r.score) < 1e-9 for i, r in got.items())


def test_awkward_rows_and_tables(spark):
    docs = fx.documents(spark)
    marks = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0), (4, None, 0), (7, 1, 0), (10, 1, None)], "doc_id bigint, quality int, toxic int")
    got = c.scores(fx.clashing(docs), marks).collect()  # no bad row: nothing is rejected
    assert len(got) == len(fx.doc_rows()) and all(r.predicted == 1 for r in got)
    assert c.scores(docs.limit(0), marks).count() == 0
    kept = c.good_documents(fx.clashing(docs), marks.limit(0))
    assert kept.columns == fx.clashing(docs).columns and kept.count() == len(got)


def test_fit_ranks_pairs():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(0, 1, (300, 4)), rng.normal(0, 1, (100, 4))
    good[:, 1] += 3
    w = c.fit(good, bad)
    assert ((good @ w)[:, None] > (bad @ w)[None, :]).mean() > 0.97 and abs(w[1]) == np.abs(w).max()


def plain_measure(text):
    """The features by a plain reading, character by character."""
    import math
    import re

    import zstandard

    raw = (text or "").encode()
    words = [w for w in re.split(rb"[ \t\n\x0b\x0c\r]+", raw) if w]
    if not words:
        return [0.0] * len(c.FEATURES)
    n, size = len(words), len(raw)
    of = lambda test: sum(1 for b in raw if test(b))
    upper = of(lambda b: 65 <= b <= 90)
    letters = max(1, upper + of(lambda b: 97 <= b <= 122 or b >= 128))
    ratio = math.log(size / len(zstandard.compress(raw, 1)))
    usual = 0.35 + 0.065 * math.log(max(size, 64) / 64)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    fine = lambda b: b >= 128 or chr(b).isalnum() or chr(b) in ".,"
    return [min(3, math.log(1 + n) / 3), 1 - len(set(words)) / n, min(2, of(lambda b: chr(b) in "#*$%&<>\\^~@{}[]=+_/") / n), min(1, 2 * raw.count(b"|") / n),
            upper / letters, min(1, of(lambda b: chr(b) in "!?") / n), ratio - usual, max(0, ratio - usual - 0.5), min(3, size / n / 6),
            min(1, 4 * of(lambda b: 48 <= b <= 57) / size), 1 - len(set(lines)) / max(1, len(lines)), sum(65 <= w[0] <= 90 for w in words) / n,
            sum(not fine(w[-1]) for w in words) / n, min(1, of(lambda b: chr(b) in ".!?") / n), min(3, math.log(1 + n / len(set(words))))]


def test_features_equal_a_plain_reading(spark):
    rows = [(i, r[1]) for i, r in enumerate(fx.doc_rows())] + [(900 + k, d[1]) for k, d in enumerate(labelled(40)[0])]
    got = {r.doc_id: r.features for r in c.measured(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    for i, text in rows:
        want = np.array(plain_measure(text))
        close = np.abs(np.array(got[i]) - want) < 1e-9
        close[[6, 7]] = np.abs(np.array(got[i]) - want)[[6, 7]] < 0.1  # a frame may state its size or not
        assert close.all(), (i, np.flatnonzero(~close))


def test_fit_is_the_minimum_of_the_pairwise_loss():
    """Against plain gradient descent on the same pairs."""
    rng = np.random.default_rng(1)
    good, bad = rng.normal(0.4, 1, (80, 3)), rng.normal(0, 1, (50, 3))
    got = c.fit(good, bad, pairs=2000)
    draw = np.random.default_rng(7)
    x = good[draw.integers(0, 80, 2000)] - bad[draw.integers(0, 50, 2000)]
    scale = x.std(axis=0)
    w = np.zeros(3)
    for _ in range(4000):
        m = (x / scale) @ w
        w -= 0.5 * (-(x / scale) * (1 / (1 + np.exp(m)))[:, None]).mean(axis=0) + 0.5 * 1e-4 * w
    assert np.allclose(got, w / scale, atol=1e-4)


def feature_rows(n_good, n_bad, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.uniform(0, 1, (n_good + n_bad, len(c.FEATURES)))
    x[:n_good, 2] += 0.5
    return [(i, int(i < n_good), list(map(float, v))) for i, v in enumerate(x)]


def test_every_labelled_row_is_learnt_from(spark, monkeypatch):
    """More rows than one block or the former bound of 20,000 holds: none is left out."""
    marks = spark.range(30_000).selectExpr("id AS doc_id", "CAST(id % 9 > 0 AS INT) AS quality")
    want = {i for i in range(30_000) if zlib.crc32(str(i).encode()) % 4 != 2}
    assert {r.doc_id for r in c.chosen(marks).collect()} == want
    monkeypatch.setattr(c, "BLOCK", 8)
    monkeypatch.setattr(c, "PARTNERS", 4)
    for n_good, n_bad in ((100, 3), (5, 90), (64, 64), (1, 30), (20, 13)):
        data = feature_rows(n_good, n_bad)
        got = c.blocks(spark.createDataFrame(data, "doc_id bigint, good int, features array<double>"), n_good, n_bad).collect()
        k = len(c.FEATURES)
        seen = {1: set(), 0: set()}
        for r in got:
            for label, flat in ((1, r.good), (0, r.bad)):
                rows = [tuple(flat[j:j + k]) for j in range(0, len(flat), k)]
                assert min(4, n_good, n_bad) <= len(rows) == len(set(rows)) <= 9
                seen[label] |= set(rows)
        assert seen[1] | seen[0] == {tuple(v) for _, _, v in data} and len(seen[1]) == n_good


def test_fit_of_blocks_is_the_minimum_over_their_pairs(spark):
    """One block: all pairs of a good and a bad row; and ranks give numpy's quantiles."""
    data = feature_rows(60, 40)
    df = spark.createDataFrame(data, "doc_id bigint, good int, features array<double>").repartition(3)
    got = c.fit_blocks(c.blocks(df, 60, 40))
    x = np.array([v for _, _, v in data])
    d = (x[:60, None] - x[None, 60:]).reshape(-1, x.shape[1])
    w = got * d.std(axis=0)
    p = 1 / (1 + np.exp(d / d.std(axis=0) @ w))
    assert np.abs(-(d / d.std(axis=0) * p[:, None]).mean(axis=0) + 1e-4 * w).max() < 1e-6
    for q in (0.0, 0.4, 0.5, 0.77, 1.0):
        assert abs(c.quantile(df, c.F.col("features")[0], q, 100) - np.quantile(x[:, 0], q)) < 1e-12
