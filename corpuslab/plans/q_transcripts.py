"""Queries: transcript ETL (metadata, headers, names, carry-forward, turns,
transcript sentences) and the text-rule views of the sentence pipeline."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.presets import LATIN, Preset
from ..operators import sentences as SN
from ..operators import transcripts as TR
from ..operators.sentences import sentence_table
from ..sources import transcripts as SRC
from ..sources.tables import table
from . import sqlfrag as S
from .registry import query

P = LATIN


# ---------------------------------------------------------------- SQL mirror

def _py_re(p: str) -> str:
    return S.q(TR.py_re(p))


def sql_clean_name(raw: str, preset: Preset = P) -> str:
    name = f"regexp_replace({raw}, '\\([^)]*\\)', '', 'g')"
    bad = " OR ".join(f"starts_with({name}, {S.q(b)})" for b in preset.bad_name_prefixes) or "false"
    x = name
    for p in preset.title_patterns:
        x = f"regexp_replace({x}, {_py_re(p)}, '', 'g')"
    for ph in preset.removed_phrases:
        x = f"replace({x}, {S.q(ph)}, '')"
    exc = ", ".join(S.q(e) for e in preset.exception_words)
    return f"CASE WHEN NOT ({bad}) AND {x} NOT IN ({exc}) THEN {S.strip(x)} END"


def sql_candidate(text: str) -> str:
    raw = f"regexp_extract({text}, '^([^\\n:]+?):', 1)"
    return (f"CASE WHEN {raw} <> '' AND regexp_matches({text}, {S.q(':' + T.WS + '*$')}) "
            f"AND NOT regexp_matches({text}, {S.q(':' + T.WS + '*' + T.WORD)}) THEN {raw} END")


def sql_colon_name(text: str, preset: Preset = P) -> str:
    raw = S.strip(sql_candidate(text))
    exc = ", ".join(S.q(e) for e in preset.exception_words)
    agenda = f" OR regexp_matches({raw}, {S.q('^' + TR.py_re(preset.agenda_prefix))})" if preset.agenda_prefix else ""
    return f"CASE WHEN {raw} IS NOT NULL AND NOT ({raw} IN ({exc}){agenda}) THEN {sql_clean_name(raw, preset)} END"


def sql_marked_name(text: str, preset: Preset = P) -> str:
    g = f"regexp_extract({text}, '^([^\\n:]+?):', 1)"
    raw = S.strip(g)
    name = f"regexp_replace({raw}, '\\([^)]*\\)', '', 'g')"
    for ph in preset.marked_removed_phrases:
        name = f"replace({name}, {S.q(ph)}, '')"
    name = S.strip(name)
    exc = ", ".join(S.q(e) for e in preset.exception_words)
    ok = (f"contains({text}, '<') AND contains({text}, '>') AND contains({text}, ':') "
          f"AND NOT regexp_matches({text}, '\\p{{Nd}}') AND {g} <> ''")
    return f"CASE WHEN {ok} AND {raw} NOT IN ({exc}) AND {name} NOT IN ({exc}) THEN {name} END"


def sql_speaker(text: str, marked: bool = False, preset: Preset = P) -> str:
    name = sql_marked_name(text, preset) if marked else sql_colon_name(text, preset)
    return f"CASE WHEN {name} <> '' AND len({S.ws_tokens(name)}) <= 4 THEN {name} END"


CONV_NAME = ("concat(CAST(conv_id % 6 + 20 AS VARCHAR), '_', CASE WHEN conv_id % 2 = 0 THEN 'ptm' ELSE 'ptv' END, "
             "'_', CAST(conv_id AS VARCHAR), '.docx')")

def paras_sql(file_id: str = "conv_id") -> str:
    return f"""rawp AS (SELECT {file_id} AS file_id, {CONV_NAME} AS protocol_name, turn,
                unnest(list_concat(['<< ' || role || ' >>:'], string_split(text, chr(10)))) AS text,
                unnest(range(0, 1 + len(string_split(text, chr(10))))) AS line FROM conversations),
paras AS (SELECT file_id, protocol_name, CAST(turn AS BIGINT) * 4294967296 + line AS para_idx, {S.strip('text')} AS text
          FROM rawp WHERE {S.strip('text')} <> '')"""


PARAS = paras_sql()


def speakers_sql(marked: bool = False, file_id: str = "conv_id") -> str:
    return f"""{paras_sql(file_id)},
hdr AS (SELECT *, {sql_speaker('text', marked)} AS header FROM paras),
spk AS (SELECT *, last_value(header IGNORE NULLS) OVER w AS speaker, count(header) OVER w AS turn_id
        FROM hdr WINDOW w AS (PARTITION BY file_id ORDER BY para_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


def turns_sql(file_id: str = "conv_id") -> str:
    return f"""{speakers_sql(file_id=file_id)},
turns0 AS (SELECT file_id, CAST(turn_id AS BIGINT) AS turn_id, max(header) AS speaker_name,
                  string_agg(CASE WHEN header IS NOT NULL THEN {S.strip("substr(text, strpos(text, ':') + 1)")}
                                  ELSE text END, ' ' ORDER BY para_idx) AS text
           FROM spk WHERE turn_id > 0 GROUP BY file_id, turn_id)"""


TURNS = turns_sql()


# ---------------------------------------------------------------- queries

@query("paragraphs", f"WITH {PARAS} SELECT file_id, para_idx, text FROM paras")
def q_paragraphs(spark, sf_dir):
    """Transcript paragraphs in order, stripped, blanks dropped."""
    return SRC.paragraphs(spark, sf_dir).select("file_id", "para_idx", "text")


@query("file_metadata", f"""SELECT conv_id AS file_id, {CONV_NAME} AS protocol_name,
       TRY_CAST(split_part(regexp_replace({CONV_NAME}, '\\.[^.]*$', ''), '_', 1) AS BIGINT) AS knesset_number,
       CASE split_part(regexp_replace({CONV_NAME}, '\\.[^.]*$', ''), '_', 2) WHEN 'ptm' THEN 'plenary'
            WHEN 'ptv' THEN 'committee' ELSE 'unknown' END AS protocol_type
FROM (SELECT DISTINCT conv_id FROM conversations)""")
def q_file_metadata(spark, sf_dir):
    """Parliament number and protocol type from the file name."""
    f = table(spark, sf_dir, "conversations").select("conv_id").distinct()
    name = SRC.conversation_file_name()
    k, t = SN.file_name_parts(name)
    return f.select(F.col("conv_id").alias("file_id"), name.alias("protocol_name"),
                    k.alias("knesset_number"), t.alias("protocol_type"))


@query("protocol_number", f"""SELECT doc_id AS file_id, {S.protocol_number('text')} AS protocol_number FROM documents""")
def q_protocol_number(spark, sf_dir):
    """First number after the protocol phrase, else -1."""
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("file_id"), SN.protocol_number("text", P).alias("protocol_number"))


@query("speaker_headers", f"WITH {speakers_sql()} SELECT file_id, para_idx, header AS speaker_name FROM spk WHERE header IS NOT NULL")
def q_speaker_headers(spark, sf_dir):
    """Header paragraphs and their cleaned speaker (colon mode)."""
    s = TR.with_speakers(SRC.paragraphs(spark, sf_dir), P)
    return s.filter(F.col("header").isNotNull()).select("file_id", "para_idx", F.col("header").alias("speaker_name"))


@query("speaker_headers_marked",
       f"WITH {speakers_sql(True)} SELECT file_id, para_idx, header AS speaker_name FROM spk WHERE header IS NOT NULL")
def q_speaker_headers_marked(spark, sf_dir):
    """The marked-file header rule applied to every transcript."""
    s = TR.with_speakers(SRC.paragraphs(spark, sf_dir), P, all_marked=True)
    return s.filter(F.col("header").isNotNull()).select("file_id", "para_idx", F.col("header").alias("speaker_name"))


@query("clean_names", f"""WITH {PARAS}
SELECT file_id, para_idx, {S.strip("regexp_extract(text, '^([^\\n:]+?):', 1)")} AS raw_name,
       {sql_clean_name(S.strip("regexp_extract(text, '^([^\\n:]+?):', 1)"))} AS clean_name
FROM paras WHERE regexp_extract(text, '^([^\\n:]+?):', 1) <> ''""")
def q_clean_names(spark, sf_dir):
    """``clean_speaker_name`` of every text before a first colon."""
    p = SRC.paragraphs(spark, sf_dir)
    g = F.regexp_extract("text", r"^([^\n:]+?):", 1)
    raw = T.py_strip(g)
    return (p.filter(g != "").select("file_id", "para_idx", raw.alias("raw_name"),
                                     TR.clean_speaker_name(raw, P).alias("clean_name")))


@query("speaker_carry", f"WITH {speakers_sql()} SELECT file_id, para_idx, speaker AS speaker_name FROM spk WHERE speaker IS NOT NULL")
def q_speaker_carry(spark, sf_dir):
    """Every paragraph's speaker is the latest header's (paragraphs
    before the first header are dropped)."""
    s = TR.with_speakers(SRC.paragraphs(spark, sf_dir), P)
    return s.filter(F.col("speaker").isNotNull()).select("file_id", "para_idx", F.col("speaker").alias("speaker_name"))


@query("speaker_turns", f"WITH {TURNS} SELECT file_id, turn_id, speaker_name, text AS turn_text FROM turns0")
def q_speaker_turns(spark, sf_dir):
    """Numbered turns; text after the header colon seeds the turn."""
    return TR.turns(SRC.paragraphs(spark, sf_dir), P).withColumnRenamed("text", "turn_text")


def _file_turns_sql(file_id: str = "conv_id") -> str:
    return f"""{turns_sql(file_id)},
texts AS (SELECT file_id, any_value(protocol_name) AS protocol_name, string_agg(text, chr(10) ORDER BY para_idx) AS text
          FROM paras GROUP BY file_id),
turns AS (SELECT t.file_id, t.turn_id, CASE split_part(m.protocol_name, '_', 2) WHEN 'ptm' THEN 'plenary'
                      WHEN 'ptv' THEN 'committee' ELSE 'unknown' END AS corpus, m.protocol_name,
                 TRY_CAST(split_part(m.protocol_name, '_', 1) AS BIGINT) AS knesset_number,
                 CASE split_part(m.protocol_name, '_', 2) WHEN 'ptm' THEN 'plenary' WHEN 'ptv' THEN 'committee'
                      ELSE 'unknown' END AS protocol_type,
                 {S.protocol_number('m.text')} AS protocol_number, t.speaker_name, t.text
          FROM turns0 t JOIN texts m USING (file_id))"""


RECORD = ["sent_id", "file_id", "turn_id", "piece_pos", "protocol_name", "knesset_number", "protocol_type",
          "protocol_number", "speaker_name", "sentence_text"]


@query("transcript_sentences", f"WITH {S.sentences_ctes(_file_turns_sql())} SELECT {', '.join(RECORD)} FROM sentences")
def q_transcript_sentences(spark, sf_dir):
    """Entry A end to end: transcripts -> turns -> sentence records."""
    return TR.sentence_records(SRC.paragraphs(spark, sf_dir), P).select(*RECORD)


@query("docx_sentences", f"WITH {S.sentences_ctes(_file_turns_sql(CONV_NAME))} SELECT {', '.join(RECORD)} FROM sentences")
def q_docx_sentences(spark, sf_dir):
    """A folder of .docx transcripts read file by file and turned
    into sentence records (files are told apart by their names)."""
    from ..sources import docx as DX
    paras = DX.read_paragraphs(spark, _docx_folder(spark, sf_dir)).withColumn("text", T.py_strip("text")).filter("text <> ''")
    return TR.sentence_records(paras.withColumn("file_id", F.col("protocol_name")), P).select(*RECORD)


# a preset with both branches: a phrase before the digits, and ordinal words
WORDED = replace(P, protocol_number=r"[Nn]o\.?\s*(\d+(?:,\s*\d+)*)", session_ordinal=r"the\s+([a-z]+)\s+of",
                 ordinals={"and": 1, "end": 2, "one": 3, "that": 4, "her": 5, "time": 6, "there": 7})


@query("protocol_number_words", f"""SELECT doc_id AS file_id, {S.protocol_number('text', WORDED)} AS protocol_number FROM documents""")
def q_protocol_number_words(spark, sf_dir):
    """Digits after the phrase, else the ordinal words of the session
    phrase, else -1."""
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("file_id"), SN.protocol_number("text", WORDED).alias("protocol_number"))


# ---------------------------------------------------------------- text views

_DOC_TURNS = S.documents_turns_cte(P)


@query("sentences", f"""WITH {_DOC_TURNS},
pieces AS (SELECT file_id, unnest(arr) AS piece, unnest(range(0, len(arr))) AS piece_pos
           FROM (SELECT file_id, {S.sentence_pieces('text')} AS arr FROM turns))
SELECT {S.sent_id('0')} AS sent_id, {S.strip(S.restore_marks('piece'))} AS phrase
FROM pieces WHERE {S.strip(S.restore_marks('piece'))} <> ''""")
def q_sentences(spark, sf_dir):
    """``break_text_into_phrases`` of every document's text."""
    ph = SN.phrases(SN.document_turns(spark, sf_dir, P))
    return ph.select(SN.sent_id().alias("sent_id"), "phrase")


@query("clean_sentences", f"""WITH {_DOC_TURNS},
pieces AS (SELECT file_id, unnest(arr) AS piece, unnest(range(0, len(arr))) AS piece_pos
           FROM (SELECT file_id, {S.sentence_pieces('text')} AS arr FROM turns)),
ph AS (SELECT file_id, piece_pos, {S.strip(S.restore_marks('piece'))} AS phrase FROM pieces),
cl AS (SELECT file_id, piece_pos, {S.clean_sentence('phrase', P)} AS clean FROM ph WHERE phrase <> '')
SELECT {S.sent_id('0')} AS sent_id, clean FROM cl
WHERE clean IS NOT NULL AND len(string_split(clean, ' ')) >= 4""")
def q_clean_sentences(spark, sf_dir):
    """``clean_sentence`` and the 4-part minimum."""
    c = SN.clean_phrases(SN.phrases(SN.document_turns(spark, sf_dir, P)), P)
    return c.select(SN.sent_id().alias("sent_id"), "clean")


@query("tokenize", f"""WITH {S.sentences_ctes()} SELECT sent_id, sentence_text, n_tokens FROM sentences""")
def q_tokenize(spark, sf_dir):
    """Tokens of every clean sentence, joined by one space."""
    return sentence_table(spark, sf_dir).select("sent_id", "sentence_text", "n_tokens")


@query("sentences_by_type", f"""WITH {S.sentences_ctes()}
SELECT sent_id, sentence_text FROM sentences WHERE protocol_type = 'committee'""")
def q_sentences_by_type(spark, sf_dir):
    """Sentences of one protocol type (pushed down to the scan)."""
    return (sentence_table(spark, sf_dir).filter(F.col("protocol_type") == "committee")
            .select("sent_id", "sentence_text"))


@query("length_filter", f"""WITH {S.sentences_ctes()}
SELECT sent_id, n_tokens FROM sentences WHERE n_tokens BETWEEN 4 AND 10""")
def q_length_filter(spark, sf_dir):
    """P20/M9: sentences of 4-10 tokens (similarity seeds)."""
    return sentence_table(spark, sf_dir).filter(F.col("n_tokens").between(4, 10)).select("sent_id", "n_tokens")


@query("corpus_union", f"""WITH {S.sentences_ctes()}
SELECT sent_id, corpus FROM sentences WHERE corpus = 'fr'
UNION ALL SELECT sent_id, corpus FROM sentences WHERE corpus = 'en'""")
def q_corpus_union(spark, sf_dir):
    """Committee + plenary sentences (union all)."""
    return sentence_table(spark, sf_dir).filter(F.col("corpus").isin("fr", "en")).select("sent_id", "corpus")


@query("nonblank_lines", f"""SELECT item_id, CAST(line_no AS BIGINT) AS line_no, {S.strip('line')} AS line FROM (
  SELECT item_id, unnest(string_split(text, chr(10))) AS line, unnest(range(0, len(string_split(text, chr(10))))) AS line_no
  FROM benchmark) WHERE {S.strip('line')} <> ''""")
def q_nonblank_lines(spark, sf_dir):
    """Lines of a text table, stripped, blank ones dropped."""
    b = table(spark, sf_dir, "benchmark")
    return (b.select("item_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
            .select("item_id", F.col("line_no").cast("long").alias("line_no"), T.py_strip("line").alias("line"))
            .filter(F.col("line") != ""))


_DOCX: dict = {}


def _docx_folder(spark, sf_dir):
    """The conversations written as one .docx per transcript into the
    shared scratch folder (once per application)."""
    import os
    from ..session import scratch_path
    from ..sources import docx as DX
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    if key not in _DOCX:
        folder = scratch_path(spark, os.path.abspath(sf_dir), "docx")
        DX.write_folder(SRC.raw_paragraphs(spark, sf_dir).select("protocol_name", "para_idx", "text"), folder)
        _DOCX[key] = folder
    return _DOCX[key]


@query("docx_paragraphs", f"""WITH {PARAS},
ranked AS (SELECT protocol_name, text, row_number() OVER (PARTITION BY protocol_name ORDER BY para_idx) - 1 AS i
           FROM (SELECT protocol_name, CAST(turn AS BIGINT) * 4294967296 + line AS para_idx, text FROM rawp))
SELECT protocol_name, CAST(i AS BIGINT) AS para_idx, {S.strip('text')} AS text FROM ranked WHERE {S.strip('text')} <> ''""")
def q_docx_paragraphs(spark, sf_dir):
    """Folder scan of .docx transcripts (binaryFile + mapInPandas with
    the standard zip/XML parser), paragraphs stripped and blanks dropped."""
    from ..sources import docx as DX
    p = DX.read_paragraphs(spark, _docx_folder(spark, sf_dir))
    return (p.withColumn("text", T.py_strip("text")).filter(F.col("text") != "")
            .select("protocol_name", "para_idx", "text"))
