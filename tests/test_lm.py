"""LM arithmetic on tiny corpora, sampling and balancing rules."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from corpuslab.operators import lm as LM
from corpuslab.operators import ngrams as G
from corpuslab.operators import sampling as M


def corpus(spark, sents, name="c"):
    return spark.createDataFrame([(name, i, s.split()) for i, s in enumerate(sents)],
                                 "corpus string, sent_id long, tokens array<string>")


def test_one_sentence_probabilities(spark):
    m = LM.fit(corpus(spark, ["a b"]))
    st = m.stats.first()
    assert (st["total_tokens"], st["vocab_size"]) == (4, 4)
    test = spark.createDataFrame([(0, "c", ["a", "b"])], "sent_id long, model string, tokens array<string>")
    p = LM.interpolated(LM.positions(test), m).orderBy("i").collect()
    assert p[0]["p"] == pytest.approx(0.1 * 2 / 8)
    assert p[1]["p"] == pytest.approx(0.1 * 2 / 8 + 0.3 * 2 / 5)
    lp = LM.sentence_logprob(test, m).first()["logprob"]
    assert lp == pytest.approx(math.log2(0.1 * 2 / 8) + math.log2(0.1 * 2 / 8 + 0.3 * 2 / 5))


def test_next_token_unigram(spark):
    m = LM.fit(corpus(spark, ["a a b"]))
    assert LM.best_unigram(m).first()["token"] == "a"


def test_idf():
    assert G.idf(4, 2) == 1.0


def test_perplexity_without_mask_is_infinite(spark):
    m = LM.fit(corpus(spark, ["a b c"]))
    rows = spark.createDataFrame([(0, "c", ["a", "b"], ["a", "b"])],
                                 "sent_id long, model string, restored array<string>, masked array<string>")
    assert LM.masked_perplexity(rows, m).first()["perplexity"] == float("inf")


def test_balance_to_smallest_class(spark):
    rows = [(i, c) for c, n in ((1, 5), (2, 3), (3, 9)) for i in range(n)]
    df = spark.createDataFrame([(c * 100 + i, c) for i, c in rows], "sent_id long, class long")
    got = {r["class"]: r["count"] for r in M.balance(df, "class").groupBy("class").count().collect()}
    assert got == {1: 3, 2: 3, 3: 3}


def test_masking_is_deterministic_and_counts(spark):
    df = spark.createDataFrame([(7, ["w%d" % i for i in range(25)])], "sent_id long, tokens array<string>")
    a = M.mask_tokens(df, 0.1).first()
    b = M.mask_tokens(df, 0.1).first()
    assert a["masked"] == b["masked"]
    assert sum(1 for t in a["masked"] if t == "[*]") == 3
    assert sorted(a["mask_pos"]) == a["mask_pos"]


def test_restore_chains_use_previous_fills(spark):
    # corpus: x y z repeated; masks at 1 and 2 must chain (context of 2 uses fill of 1)
    m = LM.fit(corpus(spark, ["x y z w"] * 3))
    masked = spark.createDataFrame([(1, ["x", "[*]", "[*]", "w"])], "sent_id long, masked array<string>")
    r = LM.restore(masked, m, "c").first()
    assert r["restored"][0] == "x"
    assert r["generated"] == [r["restored"][1], r["restored"][2]]
    assert len(r["generated"]) == 2 and None not in r["generated"]


def test_collocation_metric_by_name(spark):
    with pytest.raises(ValueError):
        G.collocations(corpus(spark, ["a b"]), "Nope")


def test_ngrams_guard(spark):
    df = spark.createDataFrame([(["a"],)], "t array<string>")
    from corpuslab.functions import text as T
    assert df.select(T.ngrams(F.col("t"), 2).alias("g")).first()["g"] == []


def test_group_rank_equals_window_rank_with_hot_group(spark):
    from pyspark.sql import Window
    rows = [(i, "hot" if i % 3 else f"g{i % 7}") for i in range(600)]
    df = spark.createDataFrame(rows, "sent_id long, grp string")
    order = [M.T.md5_order(42, "sent_id"), F.col("sent_id")]
    got = {(r["sent_id"], r["_rank"]) for r in M.group_rank(df, ["grp"], order).collect()}
    w = Window.partitionBy("grp").orderBy(*order)
    want = {(r["sent_id"], r["rk"]) for r in df.withColumn("rk", F.row_number().over(w)).collect()}
    assert got == want


def test_chains_of_masks_and_rows_that_share_a_key(spark):
    """Rows of one key are told apart by their masks; equal ones stay two rows."""
    train = corpus(spark, ["a b c d e f", "a b c d e f", "x y z"])
    masked = [(0, ["a", "[*]", "[*]", "d", "[*]"]), (0, ["a", "[*]", "[*]", "d", "[*]"]), (0, ["[*]", "y"]),
              (1, ["q", "q", "[*]", "[*]", "[*]"]), (2, ["a", "b"])]
    df = spark.createDataFrame(masked, "sent_id long, masked array<string>")
    got = sorted((r.sent_id, r.restored, r.generated) for r in LM.restore(df, LM.fit(train), "c").collect())
    # the plain way, one sentence after the other
    top = {(r.w1, r.w2): r.token for r in LM.best_next(LM.fit(train)).collect()}
    want = []
    for i, row in masked:
        cur = list(row)
        for j, x in enumerate(cur):
            if x == "[*]":
                cur[j] = top.get((cur[j - 2] if j >= 2 else "<s_0>", cur[j - 1] if j >= 1 else "<s_1>"), "a")
        want.append((i, cur, [c for c, x in zip(cur, row) if x == "[*]"]))
    assert got == sorted(want)


def test_restoration_writes_masks_not_sentences(spark, monkeypatch):
    """Each round keeps (key, place, context) of the masks that are left."""
    kept = []
    monkeypatch.setattr(LM, "saved", lambda df, name: kept.append((name, df.columns)) or df.localCheckpoint())
    df = spark.createDataFrame([(0, ["[*]", "[*]", "[*]"])], "sent_id long, masked array<string>")
    LM.restore(df, LM.fit(corpus(spark, ["a b c"])), "c").collect()
    assert len(kept) > 3 and all("masked" not in c and "_cur" not in c for _, c in kept)


def test_both_metrics_come_from_one_count(spark):
    sent = corpus(spark, ["a b a b c", "a b c", "a b", "b c", "a"])
    stats = G.ngram_stats(sent, (2, 3), 2)
    assert {(r.n, r.ngram): (r.cnt, r.df) for r in stats.collect()} == {(2, "a b"): (4, 3), (2, "b c"): (3, 3), (3, "a b c"): (2, 2)}
    for f in (G.frequency_collocations, G.tfidf_collocations):
        assert sorted(f(sent, (2, 3), 2, stats=stats).collect()) == sorted(f(sent, (2, 3), 2).collect())


def scoring_rows(spark):
    train = corpus(spark, ["a b c d", "a b a b c", "x y"]).unionByName(corpus(spark, ["b c d", "q a b"], "d"))
    rows = [(0, "c", "a b c d e"), (0, "c", "a b c d e"), (0, "c", "x"), (1, "d", "q q q"), (2, "d", "zz"), (3, "c", "a b c d e f g a b"), (4, None, "a b")]
    test = spark.createDataFrame([(k, m, t.split()) for k, m, t in rows], "sent_id long, model string, tokens array<string>")
    return LM.fit(train), test


def test_scoring_equals_the_probability_of_each_position(spark):
    """Rows that share a key are summed; words and models without counts stay."""
    m, test = scoring_rows(spark)
    plain = LM.interpolated(LM.positions(test), m).groupBy("sent_id", "model").agg(F.sum(F.log2("p")).alias("lp"))
    want = {(r.sent_id, r.model): r.lp for r in plain.collect()}
    got = {(r.sent_id, r.model): r.logprob for r in LM.sentence_logprob(test, m).collect()}
    assert len(want) == 4 and got == pytest.approx(want)
    both = {r.sent_id: (r.c, r.d) for r in LM.cross_logprob(test.drop("model"), m, ["c", "d"]).collect()}
    for j, k in enumerate("cd"):
        one = LM.sentence_logprob(test.withColumn("model", F.lit(k)), m)
        assert {r.sent_id: r.logprob for r in one.collect()} == pytest.approx({i: v[j] for i, v in both.items()})


def test_perplexity_reads_the_masked_positions(spark):
    m, test = scoring_rows(spark)
    rows = test.withColumnRenamed("tokens", "restored").withColumn("masked", F.transform("restored", lambda x, i: F.when(i % 3 == 1, "[*]").otherwise(x)))
    for part in (rows, rows.filter("model = 'c'")):  # several models, and one
        p = LM.interpolated(LM.positions(part.select("sent_id", "model", F.col("restored").alias("tokens"))), m).filter("i % 3 = 1")
        want = {(r.sent_id, r.model): 2 ** -r.a for r in p.groupBy("sent_id", "model").agg(F.avg(F.log2("p")).alias("a")).collect()}
        got = LM.masked_perplexity(part, m).collect()
        assert len(got) == part.count()
        assert {(r.sent_id, r.model): r.perplexity for r in got} == pytest.approx({(r.sent_id, r.model): want.get((r.sent_id, r.model), math.inf) for r in got})


def test_positions_are_shuffled_for_one_lookup_and_back(spark):
    """No triple is made distinct or joined for each of its counts: the answers
    come from one join, whatever the number of models."""
    m, test = scoring_rows(spark)
    for df in (LM.sentence_logprob(test, m), LM.cross_logprob(test, m, ["c", "d"])):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert sum("_h2#" in x and "Join" in x for x in plan.split("\n")) == 1
        assert not any("Aggregate [model#" in x and "w1#" in x for x in plan.split("\n"))


def test_rows_are_scored_in_slices(spark, monkeypatch):
    """Sums and means of a key whose rows lie in several slices; a slice is written before the next one."""
    m, test = scoring_rows(spark)
    masked = test.withColumnRenamed("tokens", "restored").withColumn("masked", F.transform("restored", lambda x, i: F.when(i % 3 == 1, "[*]").otherwise(x)))

    def results():
        one = {(r.sent_id, r.model): r.logprob for r in LM.sentence_logprob(test, m).collect()}
        two = {r.sent_id: (r.c, r.d) for r in LM.cross_logprob(test.drop("model"), m, ["c", "d"]).collect()}
        ppl = [sorted((r.sent_id, str(r.model), r.perplexity) for r in LM.masked_perplexity(d, m).collect()) for d in (masked, masked.filter("model = 'c'"))]
        return one, two, ppl
    one, two, ppl = results()
    kept, keep = [], LM.saved
    monkeypatch.setattr(LM, "saved", lambda df, name: kept.append(name) or keep(df, name))
    monkeypatch.setattr(LM, "SLICE_TOKENS", 3)
    got = results()
    assert got[0] == pytest.approx(one) and {k: pytest.approx(v) for k, v in two.items()} == got[1]
    assert [[x[:2] for x in p] for p in got[2]] == [[x[:2] for x in p] for p in ppl]
    assert [[x[2] for x in p] for p in got[2]] == [pytest.approx([x[2] for x in p]) for p in ppl]
    assert kept.count("scored") == 4 and kept.count("log-sums") >= 4 + 4 + 2 + 2


def test_late_rounds_do_not_shuffle_the_table_of_contexts(spark, monkeypatch):
    train = corpus(spark, ["a b c d e f", "a b c x", "x y z"])
    df = spark.createDataFrame([(0, ["a", "[*]", "[*]", "[*]", "e"]), (1, ["x", "[*]"])], "sent_id long, masked array<string>")
    few = sorted(map(tuple, LM.restore(df, LM.fit(train), "c").collect()))
    monkeypatch.setattr(LM, "FEW_MASKS", 0)
    assert few == sorted(map(tuple, LM.restore(df, LM.fit(train), "c").collect()))
    monkeypatch.undo()
    plans, keep = [], LM.saved
    monkeypatch.setattr(LM, "saved", lambda d, name: plans.append((name, d._jdf.queryExecution().optimizedPlan().toString())) or keep(d, name))
    LM.restore(df, LM.fit(train), "c").collect()
    filled = [p for name, p in plans if name == "filled"]
    assert filled and all("strategy=broadcast" in p for p in filled)


def test_ranked_rows_are_shuffled_once(spark, monkeypatch):
    """Null groups and null or repeated keys have ranks too."""
    from pyspark.sql import Window
    rows = [(i % 90 if i % 11 else None, ["a", "b", None, "a"][i % 4], "x" * (i % 5)) for i in range(400)]
    df = spark.createDataFrame(rows, "sent_id long, grp string, other string").repartition(5)
    plans, keep = [], M.saved
    monkeypatch.setattr(M, "saved", lambda d, name: plans.append(d._jdf.queryExecution().optimizedPlan().toString()) or keep(d, name))
    ranked = M.group_rank(df, ["grp"], [M.T.md5_order(1, "sent_id"), F.col("sent_id")], "k")
    assert ranked.columns == ["sent_id", "grp", "other", "k"] and len(plans) == 2 and "Window" not in plans[0]
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Window" not in plan
    w = Window.partitionBy("grp").orderBy(M.T.md5_order(1, "sent_id"), F.col("sent_id"))
    cols = ["sent_id", "grp", "k"]  # rows of one key differ only in what does not rank them
    key = lambda r: tuple(str(x) for x in r)
    want = df.withColumn("k", F.row_number().over(w)).select(*cols).collect()
    assert sorted(map(key, ranked.select(*cols).collect())) == sorted(map(key, want))


def test_only_rows_that_may_be_chosen_are_ranked(spark, monkeypatch):
    rows = [(i, 1 if i % 50 else 2) for i in range(5000)] + [(None, 1), (9999, None)]
    df = spark.createDataFrame(rows, "sent_id long, class long")
    ranked, rank = [], M.group_rank
    monkeypatch.setattr(M, "group_rank", lambda d, *a: ranked.append(d.count()) or rank(d, *a))
    got = {tuple(r) for r in M.per_group_n(df, "class", 100).collect()}
    assert 201 <= ranked[0] < 260
    order = lambda r: hashlib.md5(f"42:{r[0]}".encode()).hexdigest()
    first = sorted((r for r in rows[:5000] if r[1] == 1), key=order)
    assert got == {*first[:99], (None, 1), *(r for r in rows if r[1] == 2), (9999, None)}
    assert M.per_group_n(df, "class", 0).count() == 0


def test_a_saved_model_is_written_once(spark, tmp_path, monkeypatch):
    from corpuslab.plans import q_lm
    kept, keep = [], q_lm.materialize
    monkeypatch.setattr(q_lm, "materialize", lambda df, *key: kept.append(key[-1]) or keep(df, *key))
    text = "The green house stands near the old river bank. " * 3
    spark.createDataFrame([(i, text, "en", "s") for i in range(3)], "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    rows = q_lm.q_lm_save_load(spark, str(tmp_path)).collect()
    assert [r.corpus for r in rows] == ["en"] and kept == ["lm_uni", "lm_stats"]
    assert {r.corpus: (r.total_tokens, r.vocab_size) for r in rows} == {r.corpus: (r.total_tokens, r.vocab_size) for r in q_lm.q_lm_stats(spark, str(tmp_path)).collect()}


def test_shuffle_files_of_written_tables_do_not_stay(spark, tmp_path):
    import gc
    import time
    from corpuslab.session import saved
    gc.collect()
    block = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    for _ in range(3):
        saved(spark.range(1000).repartition(7).groupBy("id").count(), "t")
    for _ in range(50):  # the cleaner works in a thread of its own
        if block.shuffleStatuses().size() == 0:
            break
        time.sleep(0.2)
    most = block.shuffleStatuses().size()
    for _ in range(3):
        saved(spark.range(1000).repartition(7).groupBy("id").count(), "t")
    time.sleep(1)
    assert block.shuffleStatuses().size() <= most + 2
