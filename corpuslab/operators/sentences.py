"""Sentence table: turn text -> phrases -> cleaned, tokenized sentences.

One narrow pass per turn (no shuffle): ``split`` with the sentence regex,
``posexplode``, clean and tokenize with native regex functions.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.presets import LATIN, Preset
from ..session import let_go, scratch_path
from ..sources.tables import spread, table


def sent_id(file_id="file_id", turn_id="turn_id", piece_pos="piece_pos") -> "F.Column":
    """``file:turn:piece``: unique however many turns a file and pieces a
    turn has (a number packed from the three would collide)."""
    return F.concat_ws(":", *[(F.col(c) if isinstance(c, str) else c).cast("string")
                              for c in (file_id, turn_id, piece_pos)])



def file_name(doc_id, lang) -> "F.Column":
    """Synthetic transcript file name for a document (driver-table mapping)."""
    code = (F.when(F.col(lang) == "en", "ptm").when(F.col(lang) == "fr", "ptv")
            .otherwise("xyz"))
    return F.concat((F.col(doc_id) % 6 + 20).cast("string"), F.lit("_"), code,
                    F.lit("_"), F.col(doc_id).cast("string"), F.lit(".docx"))


def file_name_parts(name) -> tuple:
    """``extract_metadata``: drop the extension, split on ``_``; part 0 is
    the parliament number (NULL when not an integer, where the reference
    aborts), part 1 ``ptm`` -> plenary, ``ptv`` -> committee, else unknown."""
    parts = F.split(F.regexp_replace(F.col(name) if isinstance(name, str) else name, r"\.[^.]*$", ""), "_")
    knesset = parts.getItem(0).try_cast("long")
    ptype = (F.when(parts.getItem(1) == "ptm", "plenary").when(parts.getItem(1) == "ptv", "committee")
             .otherwise("unknown"))
    return knesset, ptype


def phrases(turns: DataFrame, text_col: str = "text") -> DataFrame:
    """``break_text_into_phrases``: one row per non-empty stripped phrase
    with its piece position."""
    return (turns
            .select("*", F.posexplode(T.sentence_pieces(text_col)).alias("piece_pos", "piece"))
            .drop(text_col)
            .select("*", T.once(T.py_strip("piece")).alias("phrase"))
            .drop("piece")
            .filter(F.col("phrase") != ""))


def clean_phrases(ph: DataFrame, preset: Preset) -> DataFrame:
    """``clean_sentence`` + the 4-part minimum, before tokenizing. Phrases
    are tested as they are first; each one left is cleaned once."""
    return (ph.filter(T.worth_cleaning("phrase", preset))
            .select("*", T.once(T.cleaned("phrase", preset)).alias("clean"))
            .filter(F.col("clean").rlike(preset.script) & (F.size(T.space_tokens("clean")) >= 4)))


def sentences_from_turns(turns: DataFrame, preset: Preset) -> DataFrame:
    """turns(file_id, turn_id, text, ...) -> sentences(..., sent_id, tokens,
    sentence_text, n_tokens)."""
    s = clean_phrases(phrases(turns), preset)
    return (s.select("*", T.once(T.tokenize("clean")).alias("tokens"))
            .withColumn("sentence_text", F.array_join("tokens", " "))
            .withColumn("n_tokens", F.size("tokens").cast("long"))
            .withColumn("sent_id", sent_id())
            .withColumn("piece_pos", F.col("piece_pos").cast("long"))
            .drop("phrase", "clean"))


def protocol_number(text_col: str, preset: Preset) -> "F.Column":
    """Of a file's whole text: the first integer of the comma list after the
    protocol phrase, wherever it stands, else the ordinal-words lookup (when
    the preset has one), else -1."""
    first = F.split(F.regexp_extract(F.col(text_col), preset.protocol_number, 1), ",").getItem(0)
    num = F.trim(first).try_cast("long")
    if preset.session_ordinal and preset.ordinals:
        words = F.regexp_replace(F.regexp_extract(F.col(text_col), preset.session_ordinal, 1), "-", " ")
        lookup = F.create_map(*[x for k, v in preset.ordinals.items() for x in (F.lit(k), F.lit(v))])
        num = F.coalesce(num, lookup[words].cast("long"))
    return F.coalesce(num, F.lit(-1).cast("long"))


def document_turns(spark: SparkSession, sf_dir: str, preset: Preset = LATIN) -> DataFrame:
    """Each document is one speaker turn: speaker = source, corpus = lang."""
    docs = spread(table(spark, sf_dir, "documents"), "doc_id")
    pname = file_name("doc_id", "lang")
    knesset, ptype = file_name_parts(pname)
    return docs.select(
        F.col("doc_id").alias("file_id"),
        F.lit(0).cast("long").alias("turn_id"),
        F.col("lang").alias("corpus"),
        pname.alias("protocol_name"),
        knesset.alias("knesset_number"),
        ptype.alias("protocol_type"),
        protocol_number("text", preset).alias("protocol_number"),
        F.col("source").alias("speaker_name"),
        T.paragraphs_joined("text").alias("text"),
    )


SENTENCE_COLUMNS = ["sent_id", "file_id", "turn_id", "piece_pos", "corpus", "protocol_name",
                    "knesset_number", "protocol_type", "protocol_number", "speaker_name",
                    "sentence_text", "n_tokens", "tokens"]


def build_sentence_table(spark: SparkSession, sf_dir: str, preset: Preset = LATIN) -> DataFrame:
    return sentences_from_turns(document_turns(spark, sf_dir, preset), preset).select(*SENTENCE_COLUMNS)


_MEMO: dict = {}


def sentence_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sentence table written once per application to the shared scratch
    folder (lineage cut; later reads get column pruning and pushdown)."""
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    if key not in _MEMO:
        path = scratch_path(spark, os.path.abspath(sf_dir), "sentences")
        build_sentence_table(spark, sf_dir).write.mode("overwrite").parquet(path)
        let_go(spark)
        _MEMO[key] = path
    return spark.read.parquet(_MEMO[key])
