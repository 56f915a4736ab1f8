"""Queries: author labels, balancing, folds, features, KNN, reports,
labelled reviews and their samples."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import evaluate as EV
from ..operators import features as FT
from ..operators import knn as KNN
from ..operators import sampling as M
from ..operators.sentences import sentence_table
from ..session import materialize
from ..sources.tables import table
from . import sqlfrag as S
from .registry import query

SEED = 42
MD5 = S.md5_order(SEED, "sent_id")

# ---------------------------------------------------------------- SQL base

_ALIAS_VALUES = ", ".join(f"('{a}', '{c}')" for a, c in FT.ALIASES.items())
LABELED = f"""{S.sentences_ctes()},
canon AS (SELECT s.* REPLACE (coalesce(a.canonical, s.speaker_name) AS speaker_name)
          FROM sentences s LEFT JOIN (VALUES {_ALIAS_VALUES}) a(alias, canonical) ON s.speaker_name = a.alias),
cnts AS (SELECT speaker_name, count(*) AS cnt FROM canon GROUP BY speaker_name),
top2 AS (SELECT speaker_name, cnt, row_number() OVER (ORDER BY cnt DESC, speaker_name) AS rank FROM cnts QUALIFY rank <= 2),
labeled AS (SELECT c.*, CAST(coalesce(t.rank, 3) AS BIGINT) AS class FROM canon c LEFT JOIN top2 t USING (speaker_name))"""


def _balanced_sql(src: str = "labeled", name: str = "bal") -> str:
    return f"""{name}_sz AS (SELECT class, count(*) AS n FROM {src} GROUP BY class),
{name} AS (SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY class ORDER BY {MD5}, sent_id) AS r FROM {src})
       WHERE r <= (SELECT min(n) FROM {name}_sz))"""


BAL = f"""{LABELED},
{_balanced_sql()},
binl AS (SELECT * FROM labeled WHERE class IN (1, 2)),
{_balanced_sql('binl', 'bbal')}"""


def _feat_sql(src: str) -> str:
    cc = lambda ch: f"CAST(length(sentence_text) - length(replace(sentence_text, '{ch}', '')) AS DOUBLE)"
    return f"""SELECT *, CAST(len({S.ws_tokens('sentence_text')}) AS DOUBLE) AS sentence_length,
       CAST(length(sentence_text) AS DOUBLE) AS text_length, {cc(',')} AS num_commas, {cc('.')} AS num_periods,
       {cc('?')} AS num_questions, {cc('!')} AS num_exclamations, {cc('-')} + {cc('–')} AS num_dashes,
       coalesce(CAST(protocol_number AS DOUBLE), 0.0) AS protocol_number_f,
       coalesce(CAST(knesset_number AS DOUBLE), 0.0) AS knesset_number_f,
       CAST(dense_rank() OVER (ORDER BY coalesce(protocol_type, 'Unknown')) - 1 AS DOUBLE) AS protocol_type_idx
FROM {src} WHERE sentence_text IS NOT NULL AND {S.strip('sentence_text')} <> ''"""


def _folds_sql(src: str) -> str:
    return f"SELECT *, CAST((row_number() OVER (PARTITION BY class ORDER BY {MD5}, sent_id) - 1) % 5 AS INTEGER) AS fold FROM {src}"


def _scaled_sql(src: str, name: str) -> str:
    fs = FT.FEATURES
    sums = ", ".join(f"sum({c}) AS s_{c}, sum({c} * {c}) AS q_{c}" for c in fs)
    tot = ", ".join(f"sum(s_{c}) OVER () - s_{c} AS s_{c}, sum(q_{c}) OVER () - q_{c} AS q_{c}" for c in fs)
    mom = ", ".join(f"s_{c} / n AS m_{c}, sqrt(greatest(0.0, q_{c} / n - (s_{c} / n) ** 2)) AS d_{c}" for c in fs)
    sc = ", ".join(f"({c} - m_{c}) / CASE WHEN d_{c} = 0 THEN 1.0 ELSE d_{c} END AS {c}" for c in fs)
    return f"""{name}_s AS (SELECT fold, count(*) AS n0, {sums} FROM {src} GROUP BY fold),
{name}_t AS (SELECT fold, sum(n0) OVER () - n0 AS n, {tot} FROM {name}_s),
{name}_m AS (SELECT fold, {mom} FROM {name}_t),
{name} AS (SELECT sent_id, class, fold, {sc} FROM {src} JOIN {name}_m USING (fold))"""


FEATS_SQL = f"""{BAL},
feat AS ({_feat_sql('bal')}),
ffold AS ({_folds_sql('feat')}),
{_scaled_sql('ffold', 'scl')}"""


def _labeled(spark, sf_dir):
    return FT.class_labels(FT.canonical_speakers(sentence_table(spark, sf_dir)))


BALANCED_COLUMNS = ["sent_id", "sentence_text", "protocol_type", "protocol_number", "knesset_number", "class"]


def _balanced(spark, sf_dir, binary=False):
    lab = _labeled(spark, sf_dir)
    if binary:
        lab = lab.filter(F.col("class").isin(1, 2))
    # only what the classes' queries read: the rows are ranked, so they are shuffled and written
    return M.balance(lab.select(*BALANCED_COLUMNS), "class", SEED)


# ---------------------------------------------------------------- labels

@query("speaker_aliases", f"""{LABELED.replace(S.sentences_ctes() + ',', 'WITH ' + S.sentences_ctes() + ',', 1)}
SELECT sent_id, speaker_name FROM canon""")
def q_speaker_aliases(spark, sf_dir):
    """Canonical speaker names (alias map lookup, default = the name)."""
    return FT.canonical_speakers(sentence_table(spark, sf_dir)).select("sent_id", "speaker_name")


def _w(body: str) -> str:
    return "WITH " + body


@query("speaker_counts", _w(LABELED) + "\nSELECT speaker_name, CAST(cnt AS BIGINT) AS cnt FROM cnts")
def q_speaker_counts(spark, sf_dir):
    """Sentences per (canonical) speaker."""
    return FT.speaker_counts(FT.canonical_speakers(sentence_table(spark, sf_dir)))


@query("top_speakers", _w(LABELED) + "\nSELECT speaker_name, CAST(cnt AS BIGINT) AS cnt, CAST(rank AS BIGINT) AS rank FROM top2")
def q_top_speakers(spark, sf_dir):
    """The two most frequent speakers."""
    return FT.top_speakers(FT.canonical_speakers(sentence_table(spark, sf_dir)))


@query("class_labels", _w(LABELED) + "\nSELECT sent_id, speaker_name, class FROM labeled")
def q_class_labels(spark, sf_dir):
    """Class 1 / 2 for the top speakers, 3 for everyone else."""
    return _labeled(spark, sf_dir).select("sent_id", "speaker_name", "class")


@query("two_speaker_labels", _w(LABELED) + "\nSELECT sent_id, CAST(class - 1 AS BIGINT) AS label FROM labeled WHERE class IN (1, 2)")
def q_two_speaker_labels(spark, sf_dir):
    """Sentences of the two top speakers, label 0 / 1."""
    return (_labeled(spark, sf_dir).filter(F.col("class").isin(1, 2))
            .select("sent_id", (F.col("class") - 1).cast("long").alias("label")))


@query("label_decode", _w(LABELED) + """
SELECT sent_id, CASE class WHEN 1 THEN 'first' WHEN 2 THEN 'second' WHEN 3 THEN 'other' END AS label FROM labeled""")
def q_label_decode(spark, sf_dir):
    """1 -> first, 2 -> second, 3 -> other."""
    return _labeled(spark, sf_dir).select("sent_id", FT.decode(F.col("class")).alias("label"))


@query("class_min", _w(LABELED) + "\nSELECT CAST(min(cnt) AS BIGINT) AS min_size FROM (SELECT class, count(*) AS cnt FROM labeled GROUP BY class)")
def q_class_min(spark, sf_dir):
    """Smallest class size (the down-sampling target)."""
    return _labeled(spark, sf_dir).groupBy("class").count().agg(F.min("count").cast("long").alias("min_size"))


@query("balanced_classes", _w(BAL) + "\nSELECT sent_id, class FROM bal")
def q_balanced_classes(spark, sf_dir):
    """Every class down-sampled to the smallest class's size."""
    return _balanced(spark, sf_dir).select("sent_id", "class")


@query("stratified_folds", _w(BAL) + f"\nSELECT sent_id, class, fold FROM ({_folds_sql('bal')})")
def q_stratified_folds(spark, sf_dir):
    """5 stratified folds over the balanced set."""
    return M.stratified_folds(_balanced(spark, sf_dir), "class", 5, SEED).select("sent_id", "class", "fold")


@query("label_index", _w(S.sentences_ctes()) + """
SELECT protocol_type, CAST(dense_rank() OVER (ORDER BY protocol_type) - 1 AS BIGINT) AS idx
FROM (SELECT DISTINCT protocol_type FROM sentences)""")
def q_label_index(spark, sf_dir):
    """Sorted distinct values -> 0.. (the table has one row per value)."""
    from pyspark.sql import Window
    d = sentence_table(spark, sf_dir).select("protocol_type").distinct()
    return d.withColumn("idx", (F.dense_rank().over(Window.orderBy("protocol_type")) - 1).cast("long"))


@query("custom_features", _w(BAL) + f"\nSELECT sent_id, class, {', '.join(FT.FEATURES)} FROM ({_feat_sql('bal')})")
def q_custom_features(spark, sf_dir):
    """The 10 hand-made features of the balanced sentences."""
    return FT.custom_features(_balanced(spark, sf_dir)).select("sent_id", "class", *FT.FEATURES)


def _scaled(spark, sf_dir, binary=False):
    f = FT.custom_features(_balanced(spark, sf_dir, binary))
    return FT.fold_scaled(M.stratified_folds(f, "class", 5, SEED))


@query("scaled_features", _w(FEATS_SQL) + "\nSELECT sent_id, class, fold, "
       + ", ".join(f"round({c}, 6) AS {c}" for c in FT.FEATURES) + " FROM scl")
def q_scaled_features(spark, sf_dir):
    """Each fold scaled with the train folds' mean and population std."""
    s = _scaled(spark, sf_dir)
    return s.select("sent_id", "class", "fold", *[F.round(c, 6).alias(c) for c in FT.FEATURES])


# ---------------------------------------------------------------- KNN

EMB_FOLDS = f"""emb AS (SELECT vec_id, CAST(label AS BIGINT) AS label, embedding,
       (row_number() OVER (PARTITION BY label ORDER BY {S.md5_order(SEED, 'vec_id')}, vec_id) - 1) % 5 AS fold FROM embeddings)"""


def knn_sql(src: str, key: str, dist: str, k: int = 7) -> str:
    return f"""pairs AS (SELECT a.{key} AS test_id, b.{key} AS train_id, b.label AS train_label, round({dist}, 9) AS dist
         FROM {src} a JOIN {src} b ON a.fold <> b.fold),
nn AS (SELECT *, row_number() OVER (PARTITION BY test_id ORDER BY dist, train_id) AS rank FROM pairs QUALIFY rank <= {k}),
vw AS (SELECT test_id, train_label,
              CASE WHEN max(CASE WHEN dist = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY test_id) = 1
                   THEN (CASE WHEN dist = 0 THEN 1.0 ELSE 0.0 END) ELSE 1.0 / dist END AS w FROM nn),
vs AS (SELECT test_id, train_label, round(sum(w), 9) AS score FROM vw GROUP BY test_id, train_label),
pred AS (SELECT test_id, train_label AS predicted FROM (
           SELECT *, row_number() OVER (PARTITION BY test_id ORDER BY score DESC, train_label) AS r FROM vs) WHERE r = 1)"""


EMB_DIST = ("sqrt(list_sum(list_transform(range(1, len(a.embedding) + 1), "
            "lambda i: (CAST(a.embedding[i] AS DOUBLE) - CAST(b.embedding[i] AS DOUBLE)) ** 2)))")
EMB_KNN = f"""{EMB_FOLDS},
{knn_sql('emb', 'vec_id', EMB_DIST)}"""


def _emb(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("label").cast("long").alias("label"), F.col("embedding").alias("vec"))
    return M.stratified_folds(e, "label", 5, SEED, key="id")


def _emb_knn(spark, sf_dir):
    e = _emb(spark, sf_dir)
    return KNN.knn(e, e, 7, by_fold=True)


@query("knn_join", _w(EMB_KNN) + "\nSELECT test_id, CAST(rank AS BIGINT) AS rank, train_id, round(dist, 6) AS dist FROM nn")
def q_knn_join(spark, sf_dir):
    """The 7 nearest train vectors (other folds) of every vector."""
    return _emb_knn(spark, sf_dir).select("test_id", "rank", "train_id", F.round("dist", 6).alias("dist"))


@query("knn_classify", _w(EMB_KNN) + "\nSELECT e.vec_id, e.label, p.predicted FROM emb e JOIN pred p ON p.test_id = e.vec_id")
def q_knn_classify(spark, sf_dir):
    """V4: distance-weighted 7-NN vote, 5-fold cross-validated."""
    e = _emb(spark, sf_dir)
    pred = KNN.vote(KNN.knn(e, e, 7, by_fold=True))
    return e.join(pred, e["id"] == pred["test_id"]).select(F.col("id").alias("vec_id"), "label", "predicted")


@query("classification_report", _w(EMB_KNN) + """,
tp0 AS (SELECT e.label AS truth, p.predicted AS pred FROM emb e JOIN pred p ON p.test_id = e.vec_id),
""" + EV.report_sql("tp0") + """
SELECT name, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM rep""")
def q_classification_report(spark, sf_dir):
    """Per-class precision/recall/F1/support + accuracy, macro and
    weighted averages over the pooled folds."""
    return EV.classification_report(q_knn_classify(spark, sf_dir), "label", "predicted")


_CV_DIST = "sqrt(" + " + ".join(f"(a.{c} - b.{c}) ** 2" for c in FT.FEATURES) + ")"


def _cv_sql(task: str, src: str) -> str:
    fs = FT.FEATURES
    mom = ", ".join(f"sum(x.{c}) / count(*) AS m_{c}, "
                    f"sqrt(greatest(0.0, sum(x.{c} * x.{c}) / count(*) - (sum(x.{c}) / count(*)) ** 2)) AS d_{c}"
                    for c in fs)
    scl = ", ".join(f"(r.{c} - m.m_{c}) / CASE WHEN m.d_{c} = 0 THEN 1.0 ELSE m.d_{c} END AS {c}" for c in fs)
    return f"""{task}_feat AS ({_feat_sql(src)}),
{task}_ff AS ({_folds_sql(task + '_feat')}),
{task}_m AS (SELECT k.fold AS k, {mom} FROM {task}_ff x JOIN (SELECT DISTINCT fold FROM {task}_ff) k ON x.fold <> k.fold
             GROUP BY k.fold),
{task}_sc AS (SELECT m.k, r.sent_id, r.class, r.fold, {scl} FROM {task}_ff r, {task}_m m),
{task}_pairs AS (SELECT a.sent_id AS test_id, a.class AS truth, b.sent_id AS train_id, b.class AS train_label,
                        round({_CV_DIST}, 9) AS dist
                 FROM {task}_sc a JOIN {task}_sc b ON a.k = a.fold AND b.k = a.k AND b.fold <> a.k)"""


def _knn_vote_sql(task: str) -> str:
    return f"""{task}_nn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY test_id ORDER BY dist, train_id) AS rank
                    FROM {task}_pairs) WHERE rank <= 7),
{task}_vw AS (SELECT test_id, truth, train_label,
        CASE WHEN max(CASE WHEN dist = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY test_id) = 1
             THEN (CASE WHEN dist = 0 THEN 1.0 ELSE 0.0 END) ELSE 1.0 / dist END AS w FROM {task}_nn),
{task}_vs AS (SELECT test_id, any_value(truth) AS truth, train_label, round(sum(w), 9) AS score FROM {task}_vw GROUP BY test_id, train_label),
{task}_pred AS (SELECT '{task}' AS task, truth, train_label AS pred FROM (
     SELECT *, row_number() OVER (PARTITION BY test_id ORDER BY score DESC, train_label) AS r FROM {task}_vs) WHERE r = 1)"""


CV_SQL = _w(BAL) + ",\n" + _cv_sql("multi", "bal") + ",\n" + _knn_vote_sql("multi") + ",\n" \
    + _cv_sql("binary", "bbal") + ",\n" + _knn_vote_sql("binary") + """,
allp AS (SELECT * FROM multi_pred UNION ALL SELECT * FROM binary_pred),
""" + EV.report_sql("allp", by=("task",)) + """
SELECT task, name, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM rep"""


def _cv_predictions(spark, sf_dir, binary: bool):
    f = M.stratified_folds(FT.custom_features(_balanced(spark, sf_dir, binary)), "class", 5, SEED)
    f = materialize(f.select("sent_id", "class", "fold", *FT.FEATURES).withColumn("_one", F.lit(1)),
                    os.path.abspath(sf_dir), f"cv_features_{binary}")
    vec = F.array(*[F.col(c) for c in FT.FEATURES])
    preds = []
    for k in range(5):  # one scaler per fold: the moments of the train folds,
        aggs = []       # applied to test and train rows alike
        for c in FT.FEATURES:
            m = F.sum(c) / F.count(F.lit(1))
            aggs += [m.alias(f"_m_{c}"),
                     F.sqrt(F.greatest(F.lit(0.0), F.sum(F.col(c) * F.col(c)) / F.count(F.lit(1)) - m ** 2))
                     .alias(f"_d_{c}")]
        mom = f.filter(F.col("fold") != k).groupBy("_one").agg(*aggs)  # one row
        sc = f.join(F.broadcast(mom), "_one")
        for c in FT.FEATURES:
            sd = F.col(f"_d_{c}")
            sc = sc.withColumn(c, (F.col(c) - F.col(f"_m_{c}")) / F.when(sd == 0, 1.0).otherwise(sd))
        test = sc.filter(F.col("fold") == k).select(F.col("sent_id").alias("id"), vec.alias("vec"))
        train = sc.filter(F.col("fold") != k).select(F.col("sent_id").alias("id"), F.col("class").alias("label"),
                                                      vec.alias("vec"))
        preds.append(KNN.vote(KNN.knn(test, train, 7)))
    p = preds[0]
    for q in preds[1:]:
        p = p.unionByName(q)
    return f.join(p, f["sent_id"] == p["test_id"]).select(F.col("class").alias("truth"), F.col("predicted").alias("pred"))


@query("cv_report", CV_SQL)
def q_cv_report(spark, sf_dir):
    """V6: 5-fold cross-validated 7-NN on the scaled hand-made features, for
    the binary and the three-class task; pooled reports."""
    multi = _cv_predictions(spark, sf_dir, False).withColumn("task", F.lit("multi"))
    binary = _cv_predictions(spark, sf_dir, True).withColumn("task", F.lit("binary"))
    return EV.classification_report(multi.unionByName(binary), "truth", "pred", by=("task",))


# ---------------------------------------------------------------- reviews

REVIEWS = "reviews AS (SELECT d.doc_id, d.text, CAST(l.quality AS BIGINT) AS label FROM documents d JOIN labels l USING (doc_id))"


def _reviews(spark, sf_dir):
    return FT.reviews(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("reviews", f"WITH {REVIEWS} SELECT doc_id, label, n_chars FROM reviews JOIN (SELECT doc_id, length(text) AS n_chars FROM documents) USING (doc_id)")
def q_reviews(spark, sf_dir):
    """Labelled reviews (documents with their quality label)."""
    return _reviews(spark, sf_dir).select("doc_id", "label", F.length("text").alias("n_chars"))


@query("stratified_sample", f"""WITH {REVIEWS}
SELECT doc_id, label FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {S.md5_order(SEED, 'doc_id')}, doc_id) AS r
                           FROM reviews) WHERE r <= 25""")
def q_stratified_sample(spark, sf_dir):
    """M5: 25 reviews per label (the per-class size is the feature)."""
    return M.per_group_n(_reviews(spark, sf_dir), "label", 25, SEED, key="doc_id").select("doc_id", "label")


@query("shuffled", f"WITH {REVIEWS} SELECT doc_id, {S.md5_order(SEED, 'doc_id')} AS ord_key FROM reviews")
def q_shuffled(spark, sf_dir):
    """M6: seeded permutation key (range-partitioned sort, no single task)."""
    return M.shuffled(_reviews(spark, sf_dir), SEED, key="doc_id").select("doc_id", "ord_key")


@query("train_test_split", f"""WITH {REVIEWS}
SELECT doc_id, row_number() OVER (ORDER BY {S.md5_order(SEED, 'doc_id')}, doc_id) <= ceil((SELECT count(*) FROM reviews) * 0.2) AS is_test FROM reviews""")
def q_train_test_split(spark, sf_dir):
    """M7: exact, seeded 80/20 split (a fifth, rounded up, is test)."""
    return M.train_test(_reviews(spark, sf_dir), 0.2, SEED, key="doc_id").select("doc_id", "is_test")


# ---------------------------------------------------------------- TF-IDF

_STOP = ", ".join(S.q(w) for w in FT.STOP_WORDS)


def _tfidf_sql(src: str, fit: str) -> str:
    words = (f"list_filter(regexp_extract_all(lower(text), {S.q(T.WORD + '+')}), "
             f"lambda w: length(w) >= 2 AND NOT list_contains([{_STOP}], w))")
    return f"""{src}_w AS (SELECT id, {words} AS w FROM {src}),
{src}_tf AS (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(list_concat(w, {S.ngrams('w', 2)})) AS term FROM {src}_w) GROUP BY id, term)"""


TFIDF_SQL = f"""{BAL},
trn AS (SELECT sent_id AS id, sentence_text AS text, class AS label FROM bal),
{_tfidf_sql('trn', 'trn')},
vocab AS (SELECT term, ln((1 + (SELECT count(*) FROM trn)) / (1 + df)) + 1 AS idf
          FROM (SELECT term, sum(tf) AS cf, count(*) AS df FROM trn_tf GROUP BY term ORDER BY cf DESC, term LIMIT 10000)),
trn_raw AS (SELECT id, term, tf * idf AS raw FROM trn_tf JOIN vocab USING (term)),
trn_wt AS (SELECT id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY id)) AS weight FROM trn_raw)"""


def _tfidf_train(spark, sf_dir):
    bal = _balanced(spark, sf_dir).select(F.col("sent_id").alias("id"), F.col("sentence_text").alias("text"),
                                           F.col("class").alias("label"))
    model = FT.tfidf_fit(bal)
    return bal, model, FT.tfidf_transform(bal, model)


@query("tfidf_terms", _w(TFIDF_SQL) + "\nSELECT id AS sent_id, term, round(weight, 6) AS weight FROM trn_wt")
def q_tfidf_terms(spark, sf_dir):
    """V1: 1-2-gram TF-IDF weights of the balanced sentences (relational
    form: one row per non-zero entry)."""
    _, _, w = _tfidf_train(spark, sf_dir)
    return w.select(F.col("id").alias("sent_id"), "term", F.round("weight", 6).alias("weight"))


@query("score_sentences", _w(TFIDF_SQL) + f""",
lines AS (SELECT item_id, line_no, {S.strip('line')} AS text FROM (
  SELECT item_id, unnest(string_split(text, chr(10))) AS line, unnest(range(0, len(string_split(text, chr(10))))) AS line_no
  FROM benchmark) WHERE {S.strip('line')} <> ''),
tst AS (SELECT CAST(item_id AS BIGINT) * 2147483648 + line_no AS id, text FROM lines),
{_tfidf_sql('tst', 'trn')},
tst_raw AS (SELECT id, term, tf * idf AS raw FROM tst_tf JOIN vocab USING (term)),
tst_wt AS (SELECT id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY id)) AS weight FROM tst_raw),
dots AS (SELECT a.id AS test_id, b.id AS train_id, sum(a.weight * b.weight) AS dot
         FROM tst_wt a JOIN trn_wt b USING (term) GROUP BY a.id, b.id),
pairs AS (SELECT t.id AS test_id, r.id AS train_id, r.label AS train_label,
                 round(sqrt(greatest(0.0, round(2.0 - 2.0 * coalesce(d.dot, 0.0), 12))), 9) AS dist
          FROM tst t, trn r LEFT JOIN dots d ON d.test_id = t.id AND d.train_id = r.id),
nn AS (SELECT *, row_number() OVER (PARTITION BY test_id ORDER BY dist, train_id) AS rank FROM pairs QUALIFY rank <= 7),
vw AS (SELECT test_id, train_label,
              CASE WHEN max(CASE WHEN dist = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY test_id) = 1
                   THEN (CASE WHEN dist = 0 THEN 1.0 ELSE 0.0 END) ELSE 1.0 / dist END AS w FROM nn),
vs AS (SELECT test_id, train_label, round(sum(w), 9) AS score FROM vw GROUP BY test_id, train_label),
pred AS (SELECT test_id, train_label AS predicted FROM (
           SELECT *, row_number() OVER (PARTITION BY test_id ORDER BY score DESC, train_label) AS r FROM vs) WHERE r = 1)
SELECT CAST(test_id AS BIGINT) AS line_id, CASE predicted WHEN 1 THEN 'first' WHEN 2 THEN 'second' ELSE 'other' END AS label
FROM pred""")
def q_score_sentences(spark, sf_dir):
    """New sentences (non-blank benchmark lines) vectorised with the
    fitted TF-IDF model and labelled by 7-NN over the balanced sentences."""
    bal, model, wtr = _tfidf_train(spark, sf_dir)
    lines = (table(spark, sf_dir, "benchmark")
             .select("item_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
             .select((F.col("item_id").cast("long") * (1 << 31) + F.col("line_no")).alias("id"),
                     T.py_strip("line").alias("text"))
             .filter(F.col("text") != ""))
    wts = FT.tfidf_transform(lines, model)
    vocab = model.select("term")
    train = FT.sparse_vectors(wtr, vocab).join(bal.select("id", "label"), "id")
    test = lines.select("id").join(FT.sparse_vectors(wts, vocab), "id", "left")  # no term -> zero vector
    pred = KNN.vote(KNN.knn_sparse_unit(test, train, k=7))
    return pred.select(F.col("test_id").alias("line_id"), FT.decode(F.col("predicted")).alias("label"))
