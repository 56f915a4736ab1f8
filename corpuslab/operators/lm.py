"""Interpolated trigram language models for any number of corpora at once.

A model is four tables keyed by ``corpus`` (the reference's two hard-coded
corpora become a column): unigram, bigram and trigram counts over
start-padded sentences, and one stats row (total tokens T, vocabulary V).

    p(w_i) = .1 (c(w)+1)/(T+V)
           + [i>0] .3 (c(w_-1,w)+1)/(c(w_-1)+V)
           + [i>1] .6 (c(w_-2,w_-1,w)+1)/(c(w_-2,w_-1)+V)

Scoring asks for the counts of all words, pairs and triples of the test side
under short hashes, in one join for all models; the
argmax over the vocabulary (next token) is rewritten as the
top trigram count per context, because the denominator is constant inside a
context.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import exists, let_go, saved

# FIXED VALUES: interpolation weights, zero floor, start symbols, mask literal
L1, L2, L3 = 0.1, 0.3, 0.6
ZERO_FLOOR = 1e-12
S0, S1 = T.START_SYMBOLS
UNK = "<UNK>"
SLICE_TOKENS = 32_000_000  # tokens scored at once, about, so that their requests and answers do not all lie on the disk
MOST_SLICES = 4  # the counts are dealt out anew for each slice
FEW_MASKS = 100_000  # masks of a round whose contexts are broadcast (some 10 MB)


@dataclass
class Model:
    uni: DataFrame    # corpus, w, c1
    bi: DataFrame     # corpus, w1, w2, c2
    tri: DataFrame    # corpus, w1, w2, w3, c3
    stats: DataFrame  # corpus, total_tokens, vocab_size

    def persist(self):
        for d in (self.uni, self.bi, self.tri, self.stats):
            d.persist()
        return self


def _with_history(arr: Column) -> Column:
    """array<struct<i, w, w1, w2>>: each token with its two predecessors
    (NULL before the start). Built in-array so exploding never copies the
    whole sentence into every output row."""
    return F.transform(arr, lambda x, i: F.struct(
        i.alias("i"), x.alias("w"),
        F.when(i >= 1, F.element_at(arr, i)).alias("w1"),
        F.when(i >= 2, F.element_at(arr, i - 1)).alias("w2")))


def _windows(pad: DataFrame, names: list[str]) -> DataFrame:
    """A row for each run of ``len(names)`` tokens. Shifted slices are zipped,
    so that no lambda runs for each token."""
    n = F.greatest(F.size("_t") - (len(names) - 1), F.lit(0))
    runs = F.arrays_zip(*[F.slice("_t", F.lit(k + 1), n) for k in range(len(names))])
    return pad.select("corpus", F.inline(runs).alias(*names))


def fit(sent: DataFrame, corpus_col: str = "corpus", tokens_col: str = "tokens") -> Model:
    """``Trigram_LM(sentences)`` for every corpus value at once."""
    pad = sent.select(F.col(corpus_col).alias("corpus"), T.start_padded(tokens_col).alias("_t"))
    uni = (pad.select("corpus", F.explode("_t").alias("w"))
           .groupBy("corpus", "w").agg(F.count(F.lit(1)).alias("c1")))
    bi = (_windows(pad, ["w1", "w2"]).filter(F.col("w1").isNotNull())
          .groupBy("corpus", "w1", "w2").agg(F.count(F.lit(1)).alias("c2")))
    tri = (_windows(pad, ["w1", "w2", "w3"]).filter(F.col("w1").isNotNull())
           .groupBy("corpus", "w1", "w2", "w3").agg(F.count(F.lit(1)).alias("c3")))
    return Model(uni, bi, tri, stats_of(uni))


def stats_of(uni: DataFrame) -> DataFrame:
    """One row per corpus: all tokens and the vocabulary's size."""
    return uni.groupBy("corpus").agg(F.sum("c1").cast("long").alias("total_tokens"),
                                     F.count(F.lit(1)).alias("vocab_size"))


def positions(test: DataFrame, tokens_col: str = "tokens") -> DataFrame:
    """(…test cols, i, w, w1, w2): token i with its two predecessors (NULL at
    the edge: scoring does not pad, so positions 0-1 lose context)."""
    keep = [c for c in test.columns if c != tokens_col]
    return (test.select(*keep, F.explode(_with_history(F.col(tokens_col))).alias("h"))
            .select(*keep, "h.i", "h.w", "h.w1", "h.w2"))


def _spread(word: str, by: str) -> Column:
    """Join key of a history word. A position without that word needs no
    count: it gets a key of its own, which no model holds, so that the first
    tokens of all sentences do not meet in one partition."""
    return F.when(F.col(word) == "", F.concat(F.lit("\0"), F.col(by))).otherwise(F.col(word))


def probabilities(triples: DataFrame, m: Model, model_col: str = "model") -> DataFrame:
    """(model, w2, w1, w, p) of distinct triples (model, w2, w1, w), a
    missing history word being empty. The unigram and bigram parts are
    looked up once for each distinct pair (w1, w), the trigram part once for
    each triple."""
    k = model_col
    cnt = lambda c: F.coalesce(F.col(c), F.lit(0))
    stats = F.broadcast(m.stats.withColumnRenamed("corpus", k))  # a row a corpus
    V = F.col("vocab_size")
    uni = m.uni.select(F.col("corpus").alias(k), "w", F.col("c1"))
    bi = m.bi.select(F.col("corpus").alias(k), F.col("w1").alias("_h"), F.col("w2").alias("w"), "c2")
    pairs = triples.select(k, "w1", "w").distinct().withColumn("_h", _spread("w1", "w"))
    low = (pairs.join(uni, [k, "w"], "left")
           .join(uni.select(k, F.col("w").alias("_h"), F.col("c1").alias("_c_h")), [k, "_h"], "left")
           .join(bi, [k, "_h", "w"], "left").join(stats, k, "left"))
    p1 = F.lit(L1) * (cnt("c1") + 1) / (F.col("total_tokens") + V)
    p2 = F.when(F.col("w1") != "", F.lit(L2) * (cnt("c2") + 1) / (cnt("_c_h") + V)).otherwise(0.0)
    low = low.select(k, "w1", "w", p1.alias("_p1"), p2.alias("_p2"))
    tri = m.tri.select(F.col("corpus").alias(k), F.col("w1").alias("_g"), F.col("w2").alias("w1"), F.col("w3").alias("w"), "c3")
    hist = m.bi.select(F.col("corpus").alias(k), F.col("w1").alias("_g"), F.col("w2").alias("w1"), F.col("c2").alias("_c_g"))
    high = (triples.withColumn("_g", _spread("w2", "w")).join(tri, [k, "_g", "w1", "w"], "left")
            .join(hist, [k, "_g", "w1"], "left").join(stats, k, "left"))
    p3 = F.when(F.col("w2") != "", F.lit(L3) * (cnt("c3") + 1) / (cnt("_c_g") + V)).otherwise(0.0)
    both = high.select(k, "w2", "w1", "w", p3.alias("_p3")).join(low, [k, "w1", "w"])
    p = F.col("_p1") + F.col("_p2") + F.col("_p3")
    return both.select(k, "w2", "w1", "w", F.when(p == 0, F.lit(ZERO_FLOOR)).otherwise(p).alias("p"))


def interpolated(pos: DataFrame, m: Model, model_col: str = "model") -> DataFrame:
    """Adds ``p`` (interpolated probability) to exploded positions; the
    model used for each row is ``pos[model_col]`` (a corpus name). Positions
    meet one table of the probabilities of their distinct triples."""
    keyed = pos.withColumn("w1", F.coalesce("w1", F.lit(""))).withColumn("w2", F.coalesce("w2", F.lit("")))
    probs = probabilities(keyed.select(model_col, "w2", "w1", "w").distinct(), m, model_col)
    return keyed.join(probs, [model_col, "w2", "w1", "w"])


def _hashes(kind: Column, *grams: Column | str) -> list[Column]:
    """Join key of an n-gram: 96 bits of two unrelated hashes (missing words
    are null). Among 10^9 n-grams any two are alike with a chance of 10^-11."""
    return [F.xxhash64(kind, *grams).alias("_h"), F.hash(kind, *grams).alias("_h2")]


def _hashed_counts(m: Model, models: list[str] | None) -> DataFrame:
    """(_h, _h2, n0, n1, ..): the counts of all unigrams, bigrams and trigrams
    under their hashes; of each of ``models``, or with the corpus hashed in."""
    none = F.lit(None).cast("string")
    rows = None
    for kind, d, words, n in ((1, m.uni, [none, none, "w"], "c1"), (2, m.bi, [none, "w1", "w2"], "c2"), (3, m.tri, ["w1", "w2", "w3"], "c3")):
        key = _hashes(F.lit(kind), *words, *(["corpus"] if models is None else []))
        part = d.select("corpus", *key, F.col(n).alias("n0"))
        rows = part if rows is None else rows.unionByName(part)
    if models is None:
        return rows.drop("corpus")
    rows = rows.filter(F.col("corpus").isin(models))
    if len(models) == 1:
        return rows.drop("corpus")
    return rows.groupBy("_h", "_h2").agg(*[F.max(F.when(F.col("corpus") == k, F.col("n0"))).alias(f"n{j}") for j, k in enumerate(models)])


def _log_sums(test: DataFrame, m: Model, models: list[str] | None = None) -> DataFrame:
    """test(key, tokens, [model], [wanted array<boolean>]) -> (key, [model],
    s0, s1, .., n): the sums of log2 p over the (wanted) positions of a key's
    rows, by each of ``models`` or by the model of its row, and the number of
    these positions. Many rows are scored in slices, one after the other."""
    own = models is None
    if own:  # a row without a model has no score
        test = test.filter("model IS NOT NULL")
    rows = saved(test.withColumn("_row", F.monotonically_increasing_id()), "scored")
    by, k = ["key", *(["model"] if own else [])], range(1 if own else len(models))

    def sums(part):
        return _scored(part, m, models).groupBy(*by).agg(*[F.sum(F.log2(f"p{j}")).alias(f"s{j}") for j in k], F.count(F.lit(1)).alias("n"))

    # a wanted position asks for its counts and those of the position before it
    asked = 2 * F.size(F.filter("wanted", lambda x: x)) if "wanted" in rows.columns else F.size("tokens")
    tokens = rows.agg(F.sum(F.greatest(asked, F.lit(0)).cast("long"))).first()[0] or 0
    slices = max(1, min(MOST_SLICES, -(-tokens // SLICE_TOKENS)))
    if slices == 1:
        return sums(rows)
    out = None
    for s in range(slices):
        part = saved(sums(rows.filter(F.pmod(F.xxhash64("_row"), F.lit(slices)) == s)), "log-sums")
        out = part if out is None else out.unionByName(part)
    return out.groupBy(*by).agg(*[F.sum(c).alias(c) for c in out.columns if c not in by])


def _scored(rows: DataFrame, m: Model, models: list[str] | None = None) -> DataFrame:
    """rows(_row, key, tokens, [model], [wanted array<boolean>]) -> (key,
    [model], p0, p1, ..), a row for each (wanted) position: its probability
    by each of ``models``, or by the model of its row.

    Every word, pair and triple of a row asks for its count under a hash;
    all of them meet the counts in one join, and the answers go back to
    their row, where a position reads its own counts and those of the
    position before it (the history of a triple is the pair before)."""
    own = models is None
    some = "wanted" in rows.columns
    n = F.greatest(F.size("tokens"), F.lit(0))
    pad = F.concat(F.array(F.lit(None).cast("string"), F.lit(None).cast("string")), "tokens")
    arrays = [F.when(n > 0, F.sequence(F.lit(0), n - 1)), F.slice(pad, F.lit(1), n), F.slice(pad, F.lit(2), n), F.col("tokens")]
    if some:  # the position before a wanted one gives its counts, too
        arrays += [F.col("wanted"), F.concat(F.slice("wanted", F.lit(2), n), F.array(F.lit(False)))]
    pos = rows.select("_row", *(["model"] if own else []), F.inline(F.arrays_zip(*arrays)).alias("i", "a", "b", "c", *(["x", "y"] if some else [])))
    if some:
        pos = pos.filter("x OR y")
    asked = pos.select("*", F.explode(F.array(*map(F.lit, (1, 2, 3)))).alias("_n"))
    asked = asked.filter((F.col("_n") == 1) | (F.col("_n") == 2) & F.col("b").isNotNull()
                         | (F.col("_n") == 3) & F.col("a").isNotNull() & (F.col("x") if some else F.lit(True)))
    words = [F.when(F.col("_n") == 3, F.col("a")), F.when(F.col("_n") > 1, F.col("b")), F.col("c")]
    asked = asked.select("_row", "i", *(["x"] if some else []), "_n", *_hashes(F.col("_n"), *words, *(["model"] if own else [])))
    k = range(1 if own else len(models))
    counts = _hashed_counts(m, models)
    known = F.lit(False)
    for j in k:
        known = known | F.col(f"n{j}").isNotNull()
    # a row without a known word must not get lost; other counts may be missing
    found = asked.join(counts, ["_h", "_h2"], "left").filter((F.col("_n") == 1) | known).drop("_h", "_h2").repartition("_row")
    at = found.groupBy("_row", "i").agg(
        *([F.max("x").alias("x")] if some else []),
        *[F.coalesce(F.max(F.when(F.col("_n") == g, F.col(f"n{j}"))), F.lit(0)).alias(f"c{g}_{j}") for g in (1, 2, 3) for j in k])
    before = Window.partitionBy("_row").orderBy("i")
    at = at.select("*", *[F.lag(f"c{g}_{j}").over(before).alias(f"b{g}_{j}") for g in (1, 2) for j in k])
    if some:
        at = at.filter("x")
    at = at.join(rows.drop("tokens", "wanted"), "_row")
    if own:
        at = at.join(F.broadcast(m.stats.select(F.col("corpus").alias("model"), F.col("total_tokens").alias("t0"), F.col("vocab_size").alias("v0"))), "model", "left")
    else:
        of = lambda c, name: F.max(F.when(F.col("corpus") == name, F.col(c)))
        at = at.crossJoin(F.broadcast(m.stats.agg(*[of(c, name).alias(f"{c[0]}{j}") for j, name in enumerate(models) for c in ("total_tokens", "vocab_size")])))

    def p(j):
        c = lambda name: F.col(f"{name}_{j}")
        v = F.col(f"v{j}")
        p1 = F.lit(L1) * (c("c1") + 1) / (F.col(f"t{j}") + v)
        p2 = F.when(F.col("i") >= 1, F.lit(L2) * (c("c2") + 1) / (c("b1") + v)).otherwise(0.0)
        p3 = F.when(F.col("i") >= 2, F.lit(L3) * (c("c3") + 1) / (c("b2") + v)).otherwise(0.0)
        return F.when(p1 + p2 + p3 == 0, F.lit(ZERO_FLOOR)).otherwise(p1 + p2 + p3).alias(f"p{j}")

    return at.select("key", *(["model"] if own else []), *[p(j) for j in k])


def sentence_logprob(test: DataFrame, m: Model, key: str = "sent_id", model_col: str = "model",
                     tokens_col: str = "tokens") -> DataFrame:
    """``calculate_prob_of_sentence``: (key, model, logprob) = Σ log2 p."""
    rows = test.select(F.col(key).alias("key"), F.col(model_col).alias("model"), F.col(tokens_col).alias("tokens"))
    return _log_sums(rows, m).select(F.col("key").alias(key), F.col("model").alias(model_col), F.col("s0").alias("logprob"))


def cross_logprob(test: DataFrame, m: Model, models: list[str], key: str = "sent_id", tokens_col: str = "tokens") -> DataFrame:
    """(key, a column for each of ``models``): Σ log2 p of every sentence by
    every model; the positions are looked up once for all of them."""
    rows = test.select(F.col(key).alias("key"), F.col(tokens_col).alias("tokens"))
    return _log_sums(rows, m, models).select(F.col("key").alias(key), *[F.col(f"s{j}").alias(k) for j, k in enumerate(models)])


def continuations(m: Model) -> DataFrame:
    """(corpus, w1, w2, token, c3): the likeliest token after every context
    that has one."""
    # an aggregate, not a window: partial aggregation absorbs hot contexts
    return (m.tri.groupBy("corpus", "w1", "w2")
            .agg(F.min_by("w3", F.struct((-F.col("c3")).alias("nc"), F.col("w3"))).alias("token"),
                 F.max("c3").alias("c3")))


def best_next(m: Model) -> DataFrame:
    """``generate_next_token`` for every seen context: (corpus, w1, w2,
    token, prob). The argmax of (c3+1)/(c(w1,w2)+V) is the largest trigram
    count (ties: smallest token); contexts whose continuations are all
    unseen fall back to the smallest non-start token at 1/(c+V)."""
    top = continuations(m)
    fb = fallback(m)
    return (m.bi.join(top, ["corpus", "w1", "w2"], "left")
            .join(F.broadcast(fb), "corpus")
            .join(F.broadcast(m.stats), "corpus")
            .select("corpus", "w1", "w2",
                    F.coalesce("token", "fallback").alias("token"),
                    ((F.coalesce("c3", F.lit(0)) + 1) / (F.col("c2") + F.col("vocab_size"))).alias("prob")))


def fallback(m: Model) -> DataFrame:
    """One row per corpus: the token every unseen context ties on."""
    return (m.uni.filter(~F.col("w").isin(S0, S1)).groupBy("corpus")
            .agg(F.min("w").alias("fallback")))


def best_unigram(m: Model) -> DataFrame:
    """``generate_next_token((None, None))``: (corpus, token, prob)."""
    w = Window.partitionBy("corpus").orderBy(F.col("c1").desc(), F.col("w").asc())
    return (m.uni.filter(~F.col("w").isin(S0, S1))
            .withColumn("r", F.row_number().over(w)).filter("r = 1")
            .join(F.broadcast(m.stats), "corpus")
            .select("corpus", F.col("w").alias("token"),
                    ((F.col("c1") + 1) / (F.col("total_tokens") + F.col("vocab_size"))).alias("prob")))


def context_of(arr: Column, i: Column, edge: str = "reference") -> tuple[Column, Column]:
    """Restoration context of 0-based position ``i`` in ``arr``:
    (arr[i-2] or <s_0>, arr[i-1] or <s_1>). With ``edge='reference'`` a mask
    at i=1 gets (<s_0>, arr[0]); ``edge='padded'`` gives (<s_1>, arr[0])."""
    w1 = F.when(i >= 2, F.element_at(arr, i - 1))
    if edge == "padded":
        w1 = w1.when(i == 1, F.lit(S1))
    w1 = w1.otherwise(F.lit(S0))
    w2 = F.when(i >= 1, F.element_at(arr, i)).otherwise(F.lit(S1))
    return w1, w2


def restore(masked: DataFrame, m: Model, model: str, key: str = "sent_id",
            masked_col: str = "masked", edge: str = "reference") -> DataFrame:
    """``restore_and_evaluate_sentences`` (filling part) for every row.

    Masks are filled left to right and a filled token is context for the
    next mask, so the work runs in rounds: each round fills every mask whose
    two predecessors are known (one join with the next-token table) and hands
    the tokens to the masks one and two places on. The number of rounds is
    the longest chain of masks with gaps <= 2, not the number of masks. Only
    masks travel (key, position, context), each round's rest is written to
    the shared checkpoint folder (lineage cut, survives executor loss), and
    the tokens found meet their sentence once, at the end. Rows that share
    the key are told apart by their masked tokens. Adds ``restored`` (array)
    and ``generated`` (tokens put in the masks, in order)."""
    # a context without a continuation takes the fallback token, like one
    # that is not in the model. The table is not pre-partitioned on purpose:
    # with both sides shuffled, adaptive execution can split a hot context
    bn = saved(continuations(m).filter(F.col("corpus") == model).select("w1", "w2", "token"), "next-token")
    fb_rows = fallback(m).filter(F.col("corpus") == model).select("fallback").take(1)
    fb = fb_rows[0][0] if fb_rows else UNK
    keyed = masked.withColumn("_h", F.xxhash64(masked_col))
    at = [key, "_h", "_i"]

    def context(x, i):  # tokens that are masked themselves are not known yet
        known = lambda c: F.when(c != T.MASK, c)
        awaits = lambda gap: F.coalesce(F.get(masked_col, i + gap) == T.MASK, F.lit(False))
        w1, w2 = context_of(F.col(masked_col), i, edge)
        return F.when(x == T.MASK, F.struct(i.cast("int").alias("_i"), known(w1).alias("w1"), known(w2).alias("w2"),
                                            awaits(1).alias("_to1"), awaits(2).alias("_to2")))

    masks = F.filter(F.transform(masked_col, context), lambda s: s.isNotNull())
    todo = saved(keyed.select(key, "_h", F.explode(masks).alias("_x")).select(key, "_h", "_x.*").distinct(), "masks")
    found = []
    while True:
        ready = F.col("w1").isNotNull() & F.col("w2").isNotNull()
        now, table = todo.filter(ready), bn
        if now.count() <= FEW_MASKS:  # late rounds: the table of all contexts is only scanned
            table = F.broadcast(bn.join(F.broadcast(now.select("w1", "w2").distinct()), ["w1", "w2"], "left_semi"))
        filled = saved(now.join(table, ["w1", "w2"], "left")
                       .select(*at, "_to1", "_to2", F.coalesce("token", F.lit(fb)).alias("_tok")), "filled")
        found.append(filled)
        todo = todo.filter(~ready)
        if todo.isEmpty():
            break
        for word, gap in (("w2", 1), ("w1", 2)):  # only tokens that a mask waits for travel
            near = filled.filter(f"_to{gap}").select(key, "_h", (F.col("_i") + gap).alias("_i"), "_tok")
            todo = todo.join(near, at, "left").withColumn(word, F.coalesce(word, "_tok")).drop("_tok")
        todo = saved(todo, "masks")
    tokens = found[0]
    for f in found[1:]:
        tokens = tokens.unionByName(f)
    fills = tokens.groupBy(key, "_h").agg(F.map_from_entries(F.collect_list(F.struct("_i", "_tok"))).alias("_fm"))
    restored = F.transform(masked_col, lambda x, i: F.when(x == T.MASK, F.col("_fm")[i]).otherwise(x))
    return (keyed.join(fills, [key, "_h"], "left").withColumn("restored", restored).drop("_h", "_fm")
            .withColumn("generated", F.filter(
                F.transform(masked_col, lambda x, i: F.when(x == T.MASK, F.col("restored")[i])),
                lambda x: x.isNotNull())))


def masked_perplexity(rows: DataFrame, m: Model, model_col: str = "model", key: str = "sent_id",
                      masked_col: str = "masked", restored_col: str = "restored") -> DataFrame:
    """``calculate_perplexity``: 2^(-mean log2 p) over the masked positions,
    p from the restored tokens; +inf when a row has no mask."""
    test = rows.select(F.col(key).alias("key"), F.col(model_col).alias("model"), F.col(restored_col).alias("tokens"),
                       F.transform(masked_col, lambda x: x == T.MASK).alias("wanted"))
    names = [r["model"] for r in test.select("model").distinct().limit(2).collect()]
    if len(names) == 1 and names[0] is not None:  # one model for all rows: only its counts are read
        lp = _log_sums(test.drop("model"), m, names).withColumn("model", F.lit(names[0]))
    else:
        lp = _log_sums(test, m)
    lp = lp.select("key", "model", (F.col("s0") / F.col("n")).alias("_avg"))
    return (test.select("key", "model").join(lp, ["key", "model"], "left")
            .select(F.col("key").alias(key), F.col("model").alias(model_col), F.when(F.col("_avg").isNull(), F.lit(float("inf")))
                    .otherwise(F.pow(F.lit(2.0), -F.col("_avg"))).alias("perplexity")))


_PARTS = ("uni", "bi", "tri", "stats")


def save(m: Model, path: str) -> None:
    """Write the four model tables as Parquet under ``path``."""
    for name in _PARTS:
        getattr(m, name).write.mode("overwrite").parquet(f"{path}/{name}")
        let_go(m.uni.sparkSession)  # a table's shuffle does not stay beside the next one's


def load(spark, path: str) -> Model | None:
    """Reload a saved model; None when there is none at ``path``. A model
    that is there but can't be read is an error, never taken for absent."""
    if not exists(spark, path):
        return None
    return Model(*[spark.read.parquet(f"{path}/{name}") for name in _PARTS])


def load_or_fit(spark, path: str, fit_fn) -> Model:
    """Reuse saved tables when there are any, else fit, save and reload."""
    m = load(spark, path)
    if m is None:
        save(fit_fn(), path)
        m = load(spark, path)
    return m
