"""Next-token distributions of class language models and the sampling
controls (repetition penalty, temperature, top-k, top-p), as DataFrame
steps over (model, token) rows: one row per vocabulary word and model.

Order follows the usual decoding pipeline: penalty on the log-probability
of tokens already present (x1.2 on a negative value), temperature, top-k,
then top-p keeping the token that crosses the threshold; each step is
renormalised with a softmax over the kept rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import lm as LM

# FIXED VALUES: decoding controls and the prompt
PROMPT = "The movie was"
TEMPERATURE, TOP_K, TOP_P, PENALTY = 0.7, 50, 0.9, 1.2


def distribution(m: LM.Model, context: tuple[str, str]) -> DataFrame:
    """(model, token, logit): interpolated log p of every non-start token of
    every model after ``context`` (w_-2, w_-1). The counts that hold the
    context are filtered by it, so words meet them by model and word; what
    depends on the context alone is a row a model."""
    w2, w1 = context
    cnt = lambda c: F.coalesce(F.col(c), F.lit(0))
    after1 = m.bi.filter(F.col("w1") == w1).select("corpus", F.col("w2").alias("w"), "c2")
    after2 = m.tri.filter((F.col("w1") == w2) & (F.col("w2") == w1)).select("corpus", F.col("w3").alias("w"), "c3")
    of1 = m.uni.filter(F.col("w") == w1).select("corpus", F.col("c1").alias("_c1"))
    of2 = m.bi.filter((F.col("w1") == w2) & (F.col("w2") == w1)).select("corpus", F.col("c2").alias("_c2"))
    one = m.stats.join(of1, "corpus", "left").join(of2, "corpus", "left")
    rows = (m.uni.filter(~F.col("w").isin(LM.S0, LM.S1)).join(after1, ["corpus", "w"], "left")
            .join(after2, ["corpus", "w"], "left").join(F.broadcast(one), "corpus"))
    V = F.col("vocab_size")
    p = (F.lit(LM.L1) * (F.col("c1") + 1) / (F.col("total_tokens") + V) + F.lit(LM.L2) * (cnt("c2") + 1) / (cnt("_c1") + V)
         + F.lit(LM.L3) * (cnt("c3") + 1) / (cnt("_c2") + V))
    return rows.select(F.col("corpus").alias("model"), F.col("w").alias("token"), F.log(p).alias("logit"))


def softmax(df: DataFrame, logit: str = "logit") -> DataFrame:
    """Per-model softmax with aggregates (partial, map-side) and a join of
    one row per model, not a window over a whole vocabulary."""
    mx = df.groupBy("model").agg(F.max(logit).alias("_mx"))
    d = df.join(F.broadcast(mx), "model").withColumn("_e", F.exp(F.col(logit) - F.col("_mx")))
    z = d.groupBy("model").agg(F.sum("_e").alias("_z"))
    return d.join(F.broadcast(z), "model").withColumn("prob", F.col("_e") / F.col("_z")).drop("_mx", "_e", "_z")


def penalize(df: DataFrame, seen: list[str], penalty: float = PENALTY) -> DataFrame:
    lg = F.col("logit")
    hit = F.col("token").isin(*seen) if seen else F.lit(False)
    return df.withColumn("logit", F.when(hit & (lg < 0), lg * penalty)
                         .when(hit, lg / penalty).otherwise(lg))


def temperature(df: DataFrame, t: float = TEMPERATURE) -> DataFrame:
    return df.withColumn("logit", F.col("logit") / F.lit(t))


def top_k(df: DataFrame, k: int = TOP_K) -> DataFrame:
    w = Window.partitionBy("model").orderBy(F.col("logit").desc(), "token")
    return df.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k).drop("_r")


def top_p(df: DataFrame, p: float = TOP_P) -> DataFrame:
    """Keep tokens whose preceding cumulative probability is below ``p``."""
    d = softmax(df)
    w = (Window.partitionBy("model").orderBy(F.col("prob").desc(), "token")
         .rowsBetween(Window.unboundedPreceding, -1))
    return (d.withColumn("_before", F.coalesce(F.sum("prob").over(w), F.lit(0.0)))
            .filter(F.col("_before") < p).drop("_before", "prob"))
