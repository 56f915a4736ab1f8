"""DuckDB (RE2) fragments that mirror ``functions.text`` for the oracles.

RE2 has no look-around, so: whole-word tests use maximal word runs, the
sentence split protects non-splitting marks with private-use characters,
and the token regex protects ``letter"`` the same way.
"""

from __future__ import annotations

from ..functions import text as T
from ..functions.presets import LATIN, Preset

WS = T.WS
WORD = T.WORD


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {q('^' + WS + '+|' + WS + '+$')}, '', 'g')"


def ws_tokens(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, {q(WS + '+')}), lambda t: t <> '')"


def paragraphs_joined(x: str) -> str:
    return (f"array_to_string(list_filter(list_transform(string_split({x}, chr(10)), "
            f"lambda p: {strip('p')}), lambda p: p <> ''), ' ')")


_PROTECT = (("\\.", ".", 57344), ("!", "!", 57345), ("\\?", "?", 57346))


def sentence_pieces(x: str) -> str:
    """List of raw pieces, private-use characters still in place."""
    for rx, _, cp in _PROTECT:
        for _ in range(2):  # matches are consumed: two passes cover chains
            x = f"regexp_replace({x}, {q('(\\p{Nd})' + rx + '(\\p{Nd})')}, '\\1' || chr({cp}) || '\\2', 'g')"
        for _ in range(2):
            x = f"regexp_replace({x}, {q('( \\p{Nd})' + rx + '( )')}, '\\1' || chr({cp}) || '\\2', 'g')"
    x = f"regexp_replace({x}, '([.!?])', '\\1' || chr(57347), 'g')"
    return f"string_split({x}, chr(57347))"


def restore_marks(x: str) -> str:
    for _, mark, cp in _PROTECT:
        x = f"replace({x}, chr({cp}), {q(mark)})"
    return x


def whole_words(x: str, word_class: str) -> str:
    return (f"list_filter(regexp_extract_all({x}, {q(WORD + '+')}), "
            f"lambda w: regexp_full_match(w, {q('(?:' + word_class + ')+')}))")


def remove_whole_words(x: str, word_pattern: str) -> str:
    pat = q(f"(^|[^\\p{{L}}\\p{{N}}_])(?:{word_pattern})($|[^\\p{{L}}\\p{{N}}_])")
    for _ in range(2):
        x = f"regexp_replace({x}, {pat}, '\\1\\2', 'g')"
    return x


def collapse_ws(x: str) -> str:
    return strip(f"regexp_replace({x}, {q(WS + '+')}, ' ', 'g')")


def clean_sentence(s: str, preset: Preset = LATIN) -> str:
    n_words = f"len({whole_words(s, preset.script)})"
    junk = f"(contains({s}, '--') OR contains({s}, '- -') OR contains({s}, '– – –'))"
    cleaned = s
    if preset.foreign_word:
        cleaned = remove_whole_words(cleaned, preset.foreign_word)
    cleaned = collapse_ws(cleaned)
    return (f"CASE WHEN {n_words} > 2 AND NOT {junk} AND regexp_matches({cleaned}, {q(preset.script)}) "
            f"THEN {cleaned} END")


def tokenize(x: str) -> str:
    punct = T.PUNCT
    protected = f"regexp_replace({x}, '(\\p{{L}})\"', '\\1' || chr(57344), 'g')"
    pat = q(f"[^\\s{punct}]+|[{punct}]")
    return f"list_transform(regexp_extract_all({protected}, {pat}), lambda t: replace(t, chr(57344), '\"'))"


def ngrams(tokens: str, n: int) -> str:
    return (f"CASE WHEN len({tokens}) >= {n} THEN list_transform(range(0, len({tokens}) - {n - 1}), "
            f"lambda i: array_to_string({tokens}[i + 1:i + {n}], ' ')) ELSE []::VARCHAR[] END")


def md5_order(seed, *parts: str) -> str:
    args = [q(str(seed))]
    for p in parts:
        args += ["':'", f"CAST({p} AS VARCHAR)"]
    return f"md5(concat({', '.join(args)}))"


def mask_count(n: str, x: float) -> str:
    raw = f"(CAST({n} AS DOUBLE) * {float(x)!r}::DOUBLE)"
    return f"greatest(1, CAST(CASE WHEN {raw} - floor({raw}) >= 0.5 THEN ceil({raw}) ELSE floor({raw}) END AS INTEGER))"


def protocol_number(text: str, preset: Preset = LATIN) -> str:
    first = f"trim(split_part(regexp_extract({text}, {q(preset.protocol_number)}, 1), ',', 1))"
    words = ""
    if preset.session_ordinal and preset.ordinals:
        found = f"replace(regexp_extract({text}, {q(preset.session_ordinal)}, 1), '-', ' ')"
        words = f", CASE {found} " + " ".join(f"WHEN {q(k)} THEN {v}" for k, v in preset.ordinals.items()) + " END"
    return f"coalesce(TRY_CAST({first} AS BIGINT){words}, -1)"


def documents_turns_cte(preset: Preset = LATIN) -> str:
    code = "CASE WHEN lang = 'en' THEN 'ptm' WHEN lang = 'fr' THEN 'ptv' ELSE 'xyz' END"
    pname = f"concat(CAST(doc_id % 6 + 20 AS VARCHAR), '_', {code}, '_', CAST(doc_id AS VARCHAR), '.docx')"
    return f"""turns AS (
  SELECT doc_id AS file_id, CAST(0 AS BIGINT) AS turn_id, lang AS corpus,
         {pname} AS protocol_name,
         CAST(CAST(doc_id % 6 + 20 AS VARCHAR) AS BIGINT) AS knesset_number,
         CASE WHEN lang = 'en' THEN 'plenary' WHEN lang = 'fr' THEN 'committee' ELSE 'unknown' END AS protocol_type,
         {protocol_number('text', preset)} AS protocol_number,
         source AS speaker_name,
         {paragraphs_joined('text')} AS text
  FROM documents)"""


def sent_id(turn: str) -> str:
    return f"concat(CAST(file_id AS VARCHAR), ':', CAST({turn} AS VARCHAR), ':', CAST(piece_pos AS VARCHAR))"


def sentences_ctes(turns_cte: str | None = None, preset: Preset = LATIN) -> str:
    """CTEs ending in ``sentences`` (same columns as the Spark table plus
    ``tokens``)."""
    turns_cte = turns_cte or documents_turns_cte(preset)
    return f"""{turns_cte},
pieces AS (
  SELECT * EXCLUDE (text, arr), unnest(arr) AS piece, unnest(range(0, len(arr))) AS piece_pos
  FROM (SELECT *, {sentence_pieces('text')} AS arr FROM turns)),
phr AS (
  SELECT * EXCLUDE (piece), {strip(restore_marks('piece'))} AS phrase FROM pieces),
cln AS (
  SELECT * EXCLUDE (phrase), {clean_sentence('phrase', preset)} AS clean FROM phr WHERE phrase <> ''),
tok AS (
  SELECT * EXCLUDE (clean), {tokenize('clean')} AS tokens FROM cln
  WHERE clean IS NOT NULL AND len(string_split(clean, ' ')) >= 4),
sentences AS (
  SELECT {sent_id('turn_id')} AS sent_id,
         file_id, turn_id, CAST(piece_pos AS BIGINT) AS piece_pos, corpus, protocol_name,
         knesset_number, protocol_type, protocol_number, speaker_name,
         array_to_string(tokens, ' ') AS sentence_text, CAST(len(tokens) AS BIGINT) AS n_tokens,
         tokens
  FROM tok)"""
