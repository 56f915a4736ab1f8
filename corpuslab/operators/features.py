"""Author labels, hand-made features, scaling and relational TF-IDF."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import saved

# the driver-table stand-in for the reference's speaker alias map
ALIASES = {"src0": "src1", "src2": "src3"}
LABEL_NAMES = {1: "first", 2: "second", 3: "other"}
FEATURES = ["sentence_length", "text_length", "num_commas", "num_periods", "num_questions",
            "num_exclamations", "num_dashes", "protocol_number_f", "knesset_number_f", "protocol_type_idx"]
# English stop words removed before TF-IDF n-grams (a parameter; the
# reference uses its library's built-in list)
STOP_WORDS = ("a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "has", "he", "in", "is", "it",
              "its", "of", "on", "or", "that", "the", "this", "to", "was", "were", "will", "with")


def canonical_speakers(df: DataFrame, aliases: dict = ALIASES, col: str = "speaker_name") -> DataFrame:
    """``update_speaker_names``: alias -> canonical name, else unchanged
    (left join with the alias table, broadcast: its size is the map's)."""
    spark = df.sparkSession
    amap = spark.createDataFrame(list(aliases.items()), "alias string, canonical string")
    return (df.join(F.broadcast(amap), df[col] == amap["alias"], "left")
            .withColumn(col, F.coalesce("canonical", col)).drop("alias", "canonical"))


def speaker_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("speaker_name").agg(F.count(F.lit(1)).alias("cnt"))


def top_speakers(df: DataFrame, n: int = 2) -> DataFrame:
    """``most_common(n)``: (speaker_name, cnt, rank); ties by name."""
    return (speaker_counts(df).orderBy(F.col("cnt").desc(), F.col("speaker_name")).limit(n)
            .withColumn("rank", F.row_number().over(Window.orderBy(F.col("cnt").desc(), "speaker_name"))
                        .cast("long")))


def class_labels(df: DataFrame, n: int = 2) -> DataFrame:
    """Class 1..n for the top speakers, n+1 ("other") for everyone else."""
    top = top_speakers(df, n).select("speaker_name", F.col("rank").alias("_r"))
    return (df.join(F.broadcast(top), "speaker_name", "left")  # n rows
            .withColumn("class", F.coalesce("_r", F.lit(n + 1)).cast("long")).drop("_r"))


def decode(c: Column, names: dict = LABEL_NAMES) -> Column:
    return F.create_map(*[x for k, v in names.items() for x in (F.lit(k), F.lit(v))])[c]


def count_char(text: Column, ch: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(ch), F.lit("")))


def custom_features(df: DataFrame, text: str = "sentence_text") -> DataFrame:
    """``extract_custom_features``: 9 numbers + the protocol type's index in
    the sorted distinct types (non-blank texts only)."""
    t = F.col(text)
    d = df.filter(t.isNotNull() & (T.py_strip(t) != ""))
    types = (d.select(F.coalesce("protocol_type", F.lit("Unknown")).alias("ptype")).distinct()
             .withColumn("protocol_type_idx", (F.dense_rank().over(Window.orderBy("ptype")) - 1).cast("double")))
    return (d.withColumn("ptype", F.coalesce("protocol_type", F.lit("Unknown")))
            .join(F.broadcast(types), "ptype")  # one row per distinct type
            .select("*",
                    F.size(T.ws_tokens(t)).cast("double").alias("sentence_length"),
                    F.length(t).cast("double").alias("text_length"),
                    count_char(t, ",").cast("double").alias("num_commas"),
                    count_char(t, ".").cast("double").alias("num_periods"),
                    count_char(t, "?").cast("double").alias("num_questions"),
                    count_char(t, "!").cast("double").alias("num_exclamations"),
                    (count_char(t, "-") + count_char(t, "–")).cast("double").alias("num_dashes"),
                    F.coalesce(F.col("protocol_number").cast("double"), F.lit(0.0)).alias("protocol_number_f"),
                    F.coalesce(F.col("knesset_number").cast("double"), F.lit(0.0)).alias("knesset_number_f"))
            .drop("ptype"))


def fold_scaled(df: DataFrame, feats=FEATURES, fold: str = "fold") -> DataFrame:
    """Standard scaling per fold: each row of fold f is scaled with the
    mean and population std of the rows NOT in f (the train folds); zero
    variance -> scale 1. Per-fold moments are a k-row table."""
    sums = df.groupBy(fold).agg(F.count(F.lit(1)).alias("_n"),
                                *[F.sum(c).alias(f"_s_{c}") for c in feats],
                                *[F.sum(F.col(c) * F.col(c)).alias(f"_q_{c}") for c in feats])
    w = Window.partitionBy()
    tot = sums.select(fold, *[(F.sum(c).over(w) - F.col(c)).alias(c) for c in sums.columns if c != fold])
    mom = tot.select(fold, *[x for c in feats for x in (
        (F.col(f"_s_{c}") / F.col("_n")).alias(f"_m_{c}"),
        F.sqrt(F.greatest(F.lit(0.0), F.col(f"_q_{c}") / F.col("_n")
                          - (F.col(f"_s_{c}") / F.col("_n")) ** 2)).alias(f"_d_{c}"))])
    out = df.join(F.broadcast(mom), fold)
    for c in feats:
        sd = F.col(f"_d_{c}")
        out = out.withColumn(c, (F.col(c) - F.col(f"_m_{c}")) / F.when(sd == 0, 1.0).otherwise(sd))
    return out.drop(*[x for c in feats for x in (f"_m_{c}", f"_d_{c}")])


def _words(text: Column, stop_words) -> Column:
    return F.filter(F.regexp_extract_all(F.lower(text), F.lit(f"{T.WORD}+"), 0),
                    lambda w: (F.length(w) >= 2) & ~w.isin(*stop_words))


def _term_counts(docs: DataFrame, key: str, text: str, stop_words) -> DataFrame:
    """(key, term, tf). The terms of a row are sorted and equal runs counted in the row, so only
    the counts of keys that stand on several rows (or are null) are shuffled."""
    keys = docs.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter((F.col("_n") > 1) | F.col(key).isNull())
    several = saved(keys.select(F.col(key).alias("_key"), F.lit(True).alias("_several")), "several")
    d = docs.select(key, T.once(_words(F.col(text), stop_words)).alias("w"))
    rows = d.select(key, T.once(F.sort_array(F.concat("w", T.ngrams(F.col("w"), 2)))).alias("s")).filter(F.size("s") > 0)
    starts = F.filter(F.sequence(F.lit(1), F.size("s")), lambda i: (i == 1) | (F.element_at("s", i) != F.element_at("s", F.greatest(i - 1, F.lit(1)))))
    rows = rows.select(key, "s", T.once(starts).alias("at"))
    runs = F.transform("at", lambda a, j: F.struct(F.element_at("s", a).alias("term"),
                                                   (F.coalesce(F.get("at", j + 1), F.size("s") + 1) - a).cast("long").alias("tf")))
    if several.isEmpty():
        return rows.select(key, F.explode(runs).alias("r")).select(key, "r.term", "r.tf")
    terms = (rows.join(several, F.col(key).eqNullSafe(F.col("_key")), "left")
             .select(key, "_several", F.explode(runs).alias("r")).select(key, "_several", "r.term", "r.tf"))
    added = terms.filter("_several").groupBy(key, "term").agg(F.sum("tf").alias("tf"))
    return terms.filter("_several IS NULL").select(key, "term", "tf").unionByName(added)


def tfidf_fit(docs: DataFrame, key: str = "id", text: str = "text", max_terms: int = 10_000,
              stop_words=STOP_WORDS) -> DataFrame:
    """Vocabulary of 1-2-grams (lower-case words of >= 2 word characters,
    stop words removed before forming bigrams): the ``max_terms`` most
    frequent terms (ties by term) with idf = ln((1+n)/(1+df)) + 1.
    (term, idf); at most ``max_terms`` rows."""
    tf = _term_counts(docs, key, text, stop_words)
    n = docs.count()
    return (tf.groupBy("term").agg(F.sum("tf").alias("cf"), F.count(F.lit(1)).alias("df"))
            .orderBy(F.col("cf").desc(), "term").limit(max_terms)
            .select("term", (F.log((1.0 + n) / (1.0 + F.col("df"))) + 1.0).alias("idf")))


def tfidf_transform(docs: DataFrame, model: DataFrame, key: str = "id", text: str = "text",
                    stop_words=STOP_WORDS) -> DataFrame:
    """(key, term, weight): tf * idf over the fitted vocabulary, rows
    L2-normalised. The vocabulary is bounded (``max_terms``), so it is
    broadcast."""
    w = (_term_counts(docs, key, text, stop_words).filter(F.col(key).isNotNull()).join(F.broadcast(model), "term")
         .withColumn("raw", F.col("tf") * F.col("idf")))
    # a key has at most ``max_terms`` of them; they cross the shuffle once, in one row
    per = w.groupBy(key).agg(F.collect_list(F.struct("term", "raw")).alias("_t"), F.sqrt(F.sum(F.col("raw") ** 2)).alias("nrm"))
    return per.select(key, "nrm", F.explode("_t").alias("t")).select(key, "t.term", (F.col("t.raw") / F.col("nrm")).alias("weight"))


def reviews(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled reviews (doc_id, text, label): documents joined with their
    quality label."""
    return docs.join(labels.select("doc_id", F.col("quality").cast("long").alias("label")), "doc_id") \
        .select("doc_id", "text", "label")


def sparse_vectors(terms: DataFrame, vocab: DataFrame, key: str = "id") -> DataFrame:
    """(key, term, weight) -> (key, idx array<int>, val array<double>) with
    term indices from the (bounded) vocabulary order."""
    idx = vocab.withColumn("j", (F.row_number().over(Window.orderBy("term")) - 1).cast("int"))
    ent = terms.join(F.broadcast(idx), "term").groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("j", "weight"))).alias("_e"))
    return ent.select(key, F.transform("_e", lambda e: e["j"]).alias("idx"),
                      F.transform("_e", lambda e: e["weight"]).alias("val"))
