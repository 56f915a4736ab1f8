"""N-gram counting, thresholds, TF-IDF and top-k collocations.

Every count is a hash aggregation keyed by ``(corpus, ngram)``: Spark runs a
partial (map-side) aggregate before the shuffle, so frequent keys such as
punctuation collapse locally instead of skewing one reducer. Ranking uses a
window top-k that Spark plans as ``WindowGroupLimit`` (rows cut before the
sort shuffle finishes).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T


def occurrences(sent: DataFrame, ns=(2,), padded: bool = False) -> DataFrame:
    """(corpus, sent_id, n, ngram, total) for every window of every size in
    ``ns``; ``total`` = windows of that size in the sentence. Built from
    unpadded tokens, which equals dropping n-grams holding a start symbol;
    ``padded=True`` counts with the two start symbols (LM counts)."""
    toks = T.start_padded("tokens") if padded else F.col("tokens")
    def tag(n):
        total = F.greatest(F.size(toks) - n + 1, F.lit(0)).cast("long")
        return F.transform(T.ngrams(toks, n), lambda g: F.struct(
            F.lit(n).alias("n"), g.alias("ngram"), total.alias("total")))

    arr = F.flatten(F.array(*[tag(n) for n in ns]))
    return (sent.select("corpus", "sent_id", F.explode(arr).alias("g"))
            .select("corpus", "sent_id", "g.n", "g.ngram", "g.total"))


def sentence_counts(sent: DataFrame, ns=(2,)) -> DataFrame:
    """(corpus, sent_id, n, ngram, total, c): each distinct n-gram of a
    sentence with its count, without a shuffle: the row's n-grams are sorted
    and the lengths of equal runs taken."""
    def tag(n):
        total = F.greatest(F.size("tokens") - n + 1, F.lit(0)).cast("long")
        return F.transform(T.ngrams("tokens", n), lambda g: F.struct(F.lit(n).alias("n"), g.alias("ngram"), total.alias("total")))

    grams = F.sort_array(F.flatten(F.array(*[tag(n) for n in ns])))
    rows = sent.select("corpus", "sent_id", T.once(grams).alias("s")).filter(F.size("s") > 0)
    starts = F.filter(F.sequence(F.lit(1), F.size("s")), lambda i: (i == 1) | (F.element_at("s", i) != F.element_at("s", F.greatest(i - 1, F.lit(1)))))
    rows = rows.select("corpus", "sent_id", "s", T.once(starts).alias("at"))
    runs = F.transform("at", lambda a, j: F.struct(F.element_at("s", a).alias("g"),
                                                   (F.coalesce(F.get("at", j + 1), F.size("s") + 1) - a).cast("long").alias("c")))
    return (rows.select("corpus", "sent_id", F.explode(runs).alias("r"))
            .select("corpus", "sent_id", "r.g.n", "r.g.ngram", "r.g.total", "r.c"))


def counts(sent: DataFrame, ns=(2,), padded: bool = False) -> DataFrame:
    """(corpus, n, ngram, cnt)."""
    return (occurrences(sent, ns, padded).groupBy("corpus", "n", "ngram")
            .agg(F.count(F.lit(1)).alias("cnt")))


def top_k(df: DataFrame, score: str, k: int, by=("corpus", "n")) -> DataFrame:
    """First ``k`` rows per group by ``score`` desc, ties by n-gram text."""
    w = Window.partitionBy(*by).orderBy(F.col(score).desc(), F.col("ngram").asc())
    return df.withColumn("rank", F.row_number().over(w).cast("long")).filter(F.col("rank") <= k)


def ngram_stats(sent: DataFrame, ns=(2,), t: int = 5) -> DataFrame:
    """(corpus, n, ngram, cnt, df, tf_sum) of the n-grams that occur at
    least ``t`` times: both metrics from one count and one shuffle.

    tf = count/total per sentence, counted in the row, so the only shuffle is
    that of the partial sums by n-gram. ``total`` rides along from the array
    size, so no join is needed to normalise."""
    tf = sentence_counts(sent, ns).select("corpus", "n", "ngram", "c", (F.col("c") / F.col("total")).alias("tf"))
    return (tf.groupBy("corpus", "n", "ngram")
            .agg(F.sum("c").alias("cnt"), F.count(F.lit(1)).alias("df"), F.sum("tf").alias("tf_sum"))
            .filter(F.col("cnt") >= t))


def frequency_collocations(sent: DataFrame, ns=(2,), t: int = 5, k: int = 10, stats: DataFrame | None = None) -> DataFrame:
    """``get_k_n_t_collocations(k, n, t, corpus, "Frequency")`` for every
    corpus and every n at once: (corpus, n, rank, ngram, cnt). ``stats``:
    rows of ``ngram_stats`` if there are any already."""
    c = counts(sent, ns) if stats is None else stats.select("corpus", "n", "ngram", "cnt")
    return top_k(c.filter(F.col("cnt") >= t), "cnt", k)


def tfidf_scores(sent: DataFrame, ns=(2,), t: int = 5, stats: DataFrame | None = None) -> DataFrame:
    """``calculate_tfidf``: Σ_sentences tf · log2(N/df), N = all sentences
    of the corpus (also those without an n-gram), kept when df >= t."""
    n_docs = sent.groupBy("corpus").agg(F.count(F.lit(1)).alias("n_docs"))
    agg = ngram_stats(sent, ns, t) if stats is None else stats
    return (agg.filter(F.col("df") >= t)
            .join(F.broadcast(n_docs), "corpus")  # one row per corpus
            .select("corpus", "n", "ngram", "df", "tf_sum",
                    (F.col("tf_sum") * F.log2(F.col("n_docs") / F.col("df"))).alias("tfidf")))


def tfidf_collocations(sent: DataFrame, ns=(2,), t: int = 5, k: int = 10, stats: DataFrame | None = None) -> DataFrame:
    s = tfidf_scores(sent, ns, t, stats).withColumn("score", F.round("tfidf", 6))
    return top_k(s, "score", k)


METRICS = {"Frequency": frequency_collocations, "TF-IDF": tfidf_collocations}


def collocations(sent: DataFrame, metric: str, ns=(2,), t: int = 5, k: int = 10) -> DataFrame:
    """Metric chosen by name; an unknown name raises like the reference."""
    if metric not in METRICS:
        raise ValueError("Unsupported metric")
    return METRICS[metric](sent, ns, t, k)


def idf(n_docs: int, df: int) -> float:
    return math.log2(n_docs / df)
