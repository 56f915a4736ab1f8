"""Queries: JSON Lines sinks and sources over files Spark writes from the
driver tables (the sentence table, conversation turns, raw text lines)."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ..operators.sentences import sentence_table
from ..session import scratch_path
from ..sources import jsonl as J
from ..sources.tables import table
from . import sqlfrag as S
from .registry import query

_FILES: dict = {}


def _sentence_jsonl(spark, sf_dir):
    """The sentence table (D2 fields) as JSONL in the scratch folder."""
    key = ("sent", spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    if key not in _FILES:
        path = scratch_path(spark, os.path.abspath(sf_dir), "sentences_jsonl")
        J.write_jsonl(sentence_table(spark, sf_dir).select(
            "protocol_name", "knesset_number", "protocol_type", "protocol_number", "speaker_name",
            "sentence_text"), path)
        _FILES[key] = path
    return _FILES[key]


def _mixed_jsonl(spark, sf_dir):
    """Sentence records + conversation turns (objects lacking the required
    keys) + raw benchmark lines (not JSON), as one text file."""
    key = ("mixed", spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    if key not in _FILES:
        path = scratch_path(spark, os.path.abspath(sf_dir), "mixed_jsonl")
        s = sentence_table(spark, sf_dir).select(F.to_json(F.struct(
            "protocol_name", "knesset_number", "protocol_type", "protocol_number", "speaker_name",
            "sentence_text")).alias("value"))
        c = table(spark, sf_dir, "conversations").select(F.to_json(F.struct("conv_id", "turn", "role", "text"))
                                                        .alias("value"))
        b = table(spark, sf_dir, "benchmark").select(F.explode(F.split("text", "\n", -1)).alias("value"))
        s.unionByName(c).unionByName(b).write.mode("overwrite").text(path)
        _FILES[key] = path
    return _FILES[key]


_COUNTS = f"""WITH {S.sentences_ctes()},
st AS (SELECT 'ok' AS status, count(*) AS n FROM sentences
       UNION ALL SELECT 'incomplete', count(*) FROM conversations
       UNION ALL SELECT 'bad_json', sum(len(string_split(text, chr(10)))) FROM benchmark)"""


@query("jsonl_validate", _COUNTS + "\nSELECT status, CAST(n AS BIGINT) AS n FROM st")
def q_jsonl_validate(spark, sf_dir):
    """Tolerant JSONL scan; lines classified ok / incomplete / bad_json."""
    v = J.validate(spark, _mixed_jsonl(spark, sf_dir))
    return v.groupBy("status").agg(F.count(F.lit(1)).cast("long").alias("n"))


@query("jsonl_default", _COUNTS + """
SELECT CAST(sum(n) FILTER (WHERE status <> 'bad_json') AS BIGINT) AS n_records,
       CAST(sum(n) FILTER (WHERE status = 'incomplete') AS BIGINT) AS n_empty FROM st""")
def q_jsonl_default(spark, sf_dir):
    """Parseable records with a missing ``sentence_text`` read as ''."""
    d = J.read_default(spark, _mixed_jsonl(spark, sf_dir))
    return d.agg(F.count(F.lit(1)).cast("long").alias("n_records"),
                 F.sum((F.col("sentence_text") == "").cast("long")).cast("long").alias("n_empty"))


@query("jsonl_strict", f"""WITH {S.sentences_ctes()}
SELECT protocol_name, knesset_number, protocol_type, protocol_number, speaker_name, sentence_text FROM sentences""")
def q_jsonl_strict(spark, sf_dir):
    """S3: strict JSONL read (FAILFAST) of the written sentence records."""
    return J.read_strict(spark, _sentence_jsonl(spark, sf_dir))


@query("jsonl_roundtrip", f"""WITH {S.sentences_ctes()}
SELECT protocol_type, CAST(count(*) AS BIGINT) AS n FROM sentences GROUP BY protocol_type""")
def q_jsonl_roundtrip(spark, sf_dir):
    """Sentence records written as JSONL (non-ASCII kept, nulls kept),
    read back and counted per protocol type."""
    r = J.read_strict(spark, _sentence_jsonl(spark, sf_dir))
    return r.groupBy("protocol_type").agg(F.count(F.lit(1)).cast("long").alias("n"))
