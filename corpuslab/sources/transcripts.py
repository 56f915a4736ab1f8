"""Transcript paragraphs derived from the ``conversations`` table.

Each conversation is one transcript file (``file_id = conv_id``); each turn
contributes a header paragraph ``<< role >>:`` followed by the lines of its
text, ordered by ``(turn, line)``. This is the shape the reference reads
from ``.docx`` files (see ``docx.py`` for the binary-file reader).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from .tables import spread, table

PARA_BASE = 1 << 32  # para_idx = turn * PARA_BASE + line; turn and line are below 2^31, so no two paragraphs of a file meet


def conversation_file_name(conv_id: str = "conv_id"):
    code = F.when(F.col(conv_id) % 2 == 0, "ptm").otherwise("ptv")
    return F.concat((F.col(conv_id) % 6 + 20).cast("string"), F.lit("_"), code, F.lit("_"),
                    F.col(conv_id).cast("string"), F.lit(".docx"))


def raw_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file_id, protocol_name, para_idx, text) before stripping/filtering."""
    conv = spread(table(spark, sf_dir, "conversations"), "conv_id")
    lines = F.concat(F.array(F.concat(F.lit("<< "), F.col("role"), F.lit(" >>:"))),
                     F.split(F.col("text"), "\n", -1))
    return (conv.select(F.col("conv_id").alias("file_id"), conversation_file_name().alias("protocol_name"),
                        "turn", F.posexplode(lines).alias("line", "text"))
            .select("file_id", "protocol_name",
                    (F.col("turn").cast("long") * PARA_BASE + F.col("line")).cast("long").alias("para_idx"), "text"))


def paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stripped, non-blank paragraphs."""
    return (raw_paragraphs(spark, sf_dir).withColumn("text", T.py_strip("text"))
            .filter(F.col("text") != ""))
