"""Queries: next-token distributions of the per-class models and each
decoding control."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import features as FT
from ..operators import generate as GN
from ..operators import lm as LM
from ..session import materialize
from ..sources.tables import table
from . import sqlfrag as S
from .registry import query

PROMPT = GN.PROMPT.split()
CTX = (PROMPT[-2], PROMPT[-1])


def _class_model(spark, sf_dir):
    """A model for each label, from all its reviews and their whole texts."""
    rv = FT.reviews(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    m = LM.fit(rv.select(F.col("label").cast("string").alias("corpus"), T.ws_tokens("text").alias("tokens")))
    uni = materialize(m.uni, os.path.abspath(sf_dir), "class_lm_uni")
    # of the longer n-grams only those after the prompt are read: the filter
    # reaches below their counts, so the others are never shuffled
    return LM.Model(uni, m.bi, m.tri, LM.stats_of(uni))


CLASS_LM = f"""reviews AS (SELECT d.doc_id, d.text, CAST(l.quality AS BIGINT) AS label FROM documents d JOIN labels l USING (doc_id)),
rt AS (SELECT CAST(label AS VARCHAR) AS corpus, list_concat(['<s_0>', '<s_1>'], {S.ws_tokens('text')}) AS t FROM reviews),
cp AS (SELECT corpus, t[i + 1] AS w, CASE WHEN i >= 1 THEN t[i] END AS w1, CASE WHEN i >= 2 THEN t[i - 1] END AS w2
       FROM (SELECT corpus, t, unnest(range(0, len(t))) AS i FROM rt)),
cu AS (SELECT corpus, w, count(*) AS c1 FROM cp GROUP BY corpus, w),
cb AS (SELECT corpus, w1, w AS w2, count(*) AS c2 FROM cp WHERE w1 IS NOT NULL GROUP BY corpus, w1, w),
ct AS (SELECT corpus, w2 AS w1, w1 AS w2, w AS w3, count(*) AS c3 FROM cp WHERE w2 IS NOT NULL GROUP BY corpus, w2, w1, w),
cs AS (SELECT corpus, sum(c1) AS total_tokens, count(*) AS vocab_size FROM cu GROUP BY corpus),
dist AS (SELECT u.corpus AS model, u.w AS token, ln(
   0.1::DOUBLE * (u.c1 + 1) / (s.total_tokens + s.vocab_size)
   + 0.3::DOUBLE * (coalesce(b.c2, 0) + 1) / (coalesce(u1.c1, 0) + s.vocab_size)
   + 0.6::DOUBLE * (coalesce(tr.c3, 0) + 1) / (coalesce(b2.c2, 0) + s.vocab_size)) AS logit
  FROM cu u JOIN cs s USING (corpus)
  LEFT JOIN cu u1 ON u1.corpus = u.corpus AND u1.w = {S.q(CTX[1])}
  LEFT JOIN cb b ON b.corpus = u.corpus AND b.w1 = {S.q(CTX[1])} AND b.w2 = u.w
  LEFT JOIN cb b2 ON b2.corpus = u.corpus AND b2.w1 = {S.q(CTX[0])} AND b2.w2 = {S.q(CTX[1])}
  LEFT JOIN ct tr ON tr.corpus = u.corpus AND tr.w1 = {S.q(CTX[0])} AND tr.w2 = {S.q(CTX[1])} AND tr.w3 = u.w
  WHERE u.w NOT IN ('<s_0>', '<s_1>'))"""

def _soft_rows(src: str) -> str:
    return (f"SELECT *, e / sum(e) OVER (PARTITION BY model) AS prob FROM (SELECT *, exp(logit - mx) AS e FROM "
            f"(SELECT *, max(logit) OVER (PARTITION BY model) AS mx FROM {src}))")


def _soft(src: str) -> str:
    return f"SELECT model, token, round(prob, 9) AS prob FROM ({_soft_rows(src)})"


_SEEN = ", ".join(S.q(w) for w in PROMPT)
PEN = f"""pen AS (SELECT model, token, CASE WHEN token IN ({_SEEN}) AND logit < 0 THEN logit * {GN.PENALTY}
                                      WHEN token IN ({_SEEN}) THEN logit / {GN.PENALTY} ELSE logit END AS logit FROM dist)"""
TEMP = f"tmp AS (SELECT model, token, logit / {GN.TEMPERATURE} AS logit FROM pen)"
TOPK = f"""tk AS (SELECT model, token, logit FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY logit DESC, token) AS r
                                             FROM tmp) WHERE r <= {GN.TOP_K})"""
TOPP = f"""tps AS (SELECT model, token, logit, prob FROM ({_soft_rows('tk')})),
tpc AS (SELECT *, coalesce(sum(prob) OVER (PARTITION BY model ORDER BY prob DESC, token
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS before FROM tps),
tp AS (SELECT model, token, logit FROM tpc WHERE before < {GN.TOP_P})"""


def _out(df):
    return GN.softmax(df).select("model", "token", F.round("prob", 9).alias("prob"))


def _dist(spark, sf_dir):
    return GN.distribution(_class_model(spark, sf_dir), CTX)


@query("next_dist", f"WITH {CLASS_LM} " + _soft("dist"))
def q_next_dist(spark, sf_dir):
    """Next-token distribution of each class model after the prompt."""
    return _out(_dist(spark, sf_dir))


@query("next_dist_penalty", f"WITH {CLASS_LM}, {PEN} " + _soft("pen"))
def q_next_dist_penalty(spark, sf_dir):
    """Repetition penalty on tokens already in the text."""
    return _out(GN.penalize(_dist(spark, sf_dir), PROMPT))


@query("next_dist_temperature", f"WITH {CLASS_LM}, {PEN}, {TEMP} " + _soft("tmp"))
def q_next_dist_temperature(spark, sf_dir):
    """Penalty, then temperature 0.7."""
    return _out(GN.temperature(GN.penalize(_dist(spark, sf_dir), PROMPT)))


@query("next_dist_topk", f"WITH {CLASS_LM}, {PEN}, {TEMP}, {TOPK} " + _soft("tk"))
def q_next_dist_topk(spark, sf_dir):
    """Penalty, temperature, top-50."""
    return _out(GN.top_k(GN.temperature(GN.penalize(_dist(spark, sf_dir), PROMPT))))


@query("next_dist_topp", f"WITH {CLASS_LM}, {PEN}, {TEMP}, {TOPK}, {TOPP} " + _soft("tp"))
def q_next_dist_topp(spark, sf_dir):
    """Penalty, temperature, top-50, then top-p 0.9 (the token that
    crosses the threshold is kept), renormalised."""
    return _out(GN.top_p(GN.top_k(GN.temperature(GN.penalize(_dist(spark, sf_dir), PROMPT)))))
