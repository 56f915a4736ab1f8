"""JSON Lines sources and sink.

* ``write_jsonl``: one JSON object per line, null fields kept, UTF-8.
* ``validate``: tolerant scan; every line is classified as ``ok`` (an object
  holding both required keys), ``incomplete`` (an object missing one) or
  ``bad_json``; key *presence* decides, not a schema read (null == missing).
* ``read_strict``: every line must parse (FAILFAST).
* ``read_default``: parse, missing text -> ``''``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REQUIRED = ("protocol_type", "sentence_text")
SENTENCE_SCHEMA = ("protocol_name string, knesset_number long, protocol_type string, protocol_number long, "
                   "speaker_name string, sentence_text string")


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def validate(spark: SparkSession, path: str, required=REQUIRED) -> DataFrame:
    """(value, status) for every line."""
    lines = spark.read.text(path)
    keys = F.json_object_keys("value")
    has_all = F.lit(True)
    for k in required:
        has_all = has_all & F.array_contains(keys, k)
    status = F.when(keys.isNull(), "bad_json").when(has_all, "ok").otherwise("incomplete")
    return lines.select("value", status.alias("status"))


def read_strict(spark: SparkSession, path: str, schema: str = SENTENCE_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_default(spark: SparkSession, path: str, schema: str = SENTENCE_SCHEMA) -> DataFrame:
    """Parseable records only; a missing ``sentence_text`` becomes ``''``."""
    ok = validate(spark, path, ()).filter(F.col("status") != "bad_json")
    return (ok.select(F.from_json("value", schema).alias("r")).select("r.*")
            .withColumn("sentence_text", F.coalesce("sentence_text", F.lit(""))))
