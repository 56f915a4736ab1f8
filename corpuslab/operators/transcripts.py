"""Transcript ETL: paragraphs -> speaker headers -> speaker turns.

The reference walks each file with a small state machine (current speaker,
text buffer). Here that is two window functions over ``(file, para_idx)``:
a running count of headers numbers the turns (paragraphs before the first
header get turn 0 and are dropped), and one aggregation per turn joins the
pieces in paragraph order. One shuffle by file; everything else is narrow.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.presets import Preset
from .sentences import file_name_parts, protocol_number, sentences_from_turns


def py_re(p: str) -> str:
    """Python ``re`` pattern -> Java/RE2: Unicode ``\\w`` and ``\\s``."""
    return p.replace(r"\w", T.WORD).replace(r"\s", T.WS)


def header_candidate(text: Column) -> Column:
    """Text before the first colon when the paragraph looks like a header
    (non-empty colon-free prefix, nothing but space after the last colon, no
    colon followed by a word), else NULL."""
    raw = F.regexp_extract(text, r"^([^\n:]+?):", 1)
    words_after = text.rlike(f":{T.WS}*{T.WORD}")
    colon_end = text.rlike(f":{T.WS}*$")
    return F.when((raw != "") & colon_end & ~words_after, raw)


def clean_speaker_name(raw: Column, preset: Preset) -> Column:
    """``clean_speaker_name``: NULL when rejected."""
    name = F.regexp_replace(raw, r"\([^)]*\)", "")
    bad = functools.reduce(lambda a, b: a | b,
                           [name.startswith(p) for p in preset.bad_name_prefixes], F.lit(False))
    for p in preset.title_patterns:
        name = F.regexp_replace(name, py_re(p), "")
    for ph in preset.removed_phrases:
        name = F.replace(name, F.lit(ph), F.lit(""))
    return F.when(~bad & ~name.isin(*preset.exception_words), T.py_strip(name))


def colon_mode_name(text: Column, preset: Preset) -> Column:
    raw = T.py_strip(header_candidate(text))
    rejected = raw.isin(*preset.exception_words)
    if preset.agenda_prefix:
        rejected = rejected | raw.rlike("^" + py_re(preset.agenda_prefix))
    return F.when(raw.isNotNull() & ~rejected, clean_speaker_name(raw, preset))


def marked_mode_name(text: Column, preset: Preset) -> Column:
    """Header of the "marked" files: needs ``<``, ``>``, ``:``, no digit;
    lighter cleaning."""
    raw = T.py_strip(F.regexp_extract(text, r"^([^\n:]+?):", 1))
    ok = (text.contains("<") & text.contains(">") & text.contains(":") & ~text.rlike(r"\p{Nd}")
          & (F.regexp_extract(text, r"^([^\n:]+?):", 1) != ""))
    name = F.regexp_replace(raw, r"\([^)]*\)", "")
    for ph in preset.marked_removed_phrases:
        name = F.replace(name, F.lit(ph), F.lit(""))
    name = T.py_strip(name)
    return F.when(ok & ~raw.isin(*preset.exception_words) & ~name.isin(*preset.exception_words), name)


def speaker_name(text: Column, file: Column, preset: Preset, all_marked: bool = False) -> Column:
    """``extract_speaker_name`` followed by the <= 4 words rule: the header's
    speaker, or NULL when the paragraph is speech."""
    if all_marked:
        name = marked_mode_name(text, preset)
    elif preset.marked_files:
        name = F.when(file.isin(*preset.marked_files), marked_mode_name(text, preset)) \
            .otherwise(colon_mode_name(text, preset))
    else:
        name = colon_mode_name(text, preset)
    return F.when((name != "") & (F.size(T.ws_tokens(name)) <= 4), name)


def with_speakers(paragraphs: DataFrame, preset: Preset, all_marked: bool = False) -> DataFrame:
    """paragraphs(file_id, protocol_name, para_idx, text) -> + ``header``
    (speaker of a header paragraph), ``speaker`` (carried forward),
    ``turn_id`` (running header count)."""
    w = (Window.partitionBy("file_id").orderBy("para_idx")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (paragraphs
            .withColumn("header", speaker_name(F.col("text"), F.col("protocol_name"), preset, all_marked))
            .withColumn("speaker", F.last("header", ignorenulls=True).over(w))
            .withColumn("turn_id", F.count("header").over(w).cast("long")))


def turns(paragraphs: DataFrame, preset: Preset, all_marked: bool = False) -> DataFrame:
    """(file_id, turn_id, speaker_name, text): the header's text after its
    colon plus every following speech paragraph, joined by one space."""
    p = with_speakers(paragraphs, preset, all_marked).filter(F.col("turn_id") > 0)
    piece = F.when(F.col("header").isNotNull(),
                   T.py_strip(F.split(F.col("text"), ":", 2).getItem(1))).otherwise(F.col("text"))
    return (p.withColumn("piece", piece)
            .groupBy("file_id", "turn_id")
            .agg(F.max("header").alias("speaker_name"),
                 F.array_sort(F.collect_list(F.struct("para_idx", "piece"))).alias("_p"))
            .select("file_id", "turn_id", "speaker_name",
                    F.array_join(F.transform("_p", lambda s: s["piece"]), " ").alias("text")))


def file_texts(paragraphs: DataFrame) -> DataFrame:
    """(file_id, protocol_name, text): a file's paragraphs joined by line ends."""
    return (paragraphs.groupBy("file_id")
            .agg(F.any_value("protocol_name").alias("protocol_name"), F.array_sort(F.collect_list(F.struct("para_idx", "text"))).alias("_p"))
            .select("file_id", "protocol_name", F.array_join(F.transform("_p", lambda s: s["text"]), "\n").alias("text")))


def sentence_records(paragraphs: DataFrame, preset: Preset) -> DataFrame:
    """paragraphs(file_id, protocol_name, para_idx, text) of any number of
    transcripts -> sentence records (D2): metadata from the file name, the
    protocol number from the whole file's text, speakers, turns, phrases,
    cleaning and tokens."""
    meta = file_texts(paragraphs).select("file_id", "protocol_name", protocol_number("text", preset).alias("protocol_number"))
    k, kind = file_name_parts("protocol_name")
    joined = (turns(paragraphs, preset).join(meta, "file_id")
              .select("file_id", "turn_id", kind.alias("corpus"), "protocol_name", k.alias("knesset_number"),
                      kind.alias("protocol_type"), "protocol_number", "speaker_name", "text"))
    return sentences_from_turns(joined, preset)


__all__ = ["turns", "with_speakers", "speaker_name", "clean_speaker_name", "header_candidate",
           "file_name_parts", "file_texts", "sentence_records"]
