"""Text rules as native Column expressions (no Python UDF on the text path).

Regex notes (Java regex inside Spark):
* Python's ``str.strip``/``split()``/``\\s`` use Unicode whitespace; Java's
  ``\\s`` is ASCII only and ``trim`` strips spaces only, so ``WS`` spells the
  set out.
* Python's ``\\w`` is letters, digits and ``_`` -> ``[\\p{L}\\p{N}_]``.
* A "whole word of class X" (Python ``\\bX+\\b``) is a maximal run of word
  characters that consists of X only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .presets import Preset

# FIXED VALUES: Python's whitespace set, the sentence-split and token patterns
WS = (r"[\t\n\x{0B}\x{0C}\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
      r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
WS_CHARS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
# runs of white space that are not one plain space already
WS_RUN = rf"{WS}{{2,}}|{WS.replace(chr(32), '')}"
WORD = r"[\p{L}\p{N}_]"
# split after . ! ? unless digit<mark>digit, or " <digit><mark> " (list number)
SENTENCE_SPLIT = r"(?<=[.!?])(?!(?<=\p{Nd}[.!?])\p{Nd})(?!(?<= \p{Nd}[.!?]) )"
# a token is a run of non-space non-punctuation characters (a '"' right after a
# letter stays inside: abbreviations), or one punctuation mark
PUNCT = r""".,;!?()\[\]{}\-"'"""
TOKEN = rf"""(?:[^\s{PUNCT}]|(?<=\p{{L}})")+|[{PUNCT}]"""
# the same language, written for speed: a token starts with a plain
# character (a letter before '"' always belongs to the run), and '"' only
# extends a run that ends in a letter; possessive, so no backtracking
TOKEN_FAST = rf"""[^\s{PUNCT}]++(?:(?<=\p{{L}})"[^\s{PUNCT}]*+)*+|[{PUNCT}]"""
START_SYMBOLS = ("<s_0>", "<s_1>")
MASK = "[*]"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """``str.strip()``: both ends only are read, no regex over the text."""
    return F.btrim(col(c), F.lit(WS_CHARS))


def ws_tokens(c) -> Column:
    """``str.split()``: split on Unicode whitespace runs, no empty strings."""
    return F.filter(F.split(col(c), rf"{WS}+", -1), lambda x: x != "")


def space_tokens(c) -> Column:
    """``str.split(" ")``: split on single spaces, empties kept."""
    return F.split(col(c), " ", -1)


def script_tokens(c, script: str) -> Column:
    """``re.findall(script + '+', text)``: runs of one script's letters."""
    return F.regexp_extract_all(col(c), F.lit(f"{script}+"), 0)


def once(c: Column) -> Column:
    """``c`` as a generated column, for a ``select`` of its own: later
    references read the value, where a projected column's expression would
    be copied into every filter and lambda that names it."""
    return F.explode(F.array(c))


def whole_words(c, word_class: str) -> Column:
    """Words (maximal ``\\w`` runs) made only of ``word_class`` characters."""
    return F.filter(F.regexp_extract_all(col(c), F.lit(f"{WORD}+"), 0),
                    lambda w: w.rlike(f"^(?:{word_class})+$"))


def count_whole_words(c, word_class: str) -> Column:
    """Number of words made only of ``word_class``: one regex pass with
    look-around (equal to ``size(whole_words(..))``, without a lambda)."""
    rx = rf"(?<!{WORD})(?:{word_class})+(?!{WORD})"
    return F.size(F.regexp_extract_all(col(c), F.lit(rx), 0))


def remove_whole_words(c, word_pattern: str) -> Column:
    return F.regexp_replace(col(c), rf"(?<!{WORD})(?:{word_pattern})(?!{WORD})", "")


def collapse_ws(c) -> Column:
    """``re.sub(r'\\s+', ' ', s).strip()``."""
    return F.btrim(F.regexp_replace(col(c), WS_RUN, " "))


def paragraphs_joined(c) -> Column:
    """Turn text of a file: stripped non-blank lines joined by one space."""
    lines = F.transform(F.split(col(c), "\n", -1), py_strip)
    return F.array_join(F.filter(lines, lambda x: x != ""), " ")


def sentence_pieces(c) -> Column:
    """Raw pieces of ``break_text_into_phrases`` (strip/drop-empty later)."""
    return F.split(col(c), SENTENCE_SPLIT, -1)


def worth_cleaning(c, preset: Preset) -> Column:
    """Whether a stripped phrase has three words of the script and no dash junk."""
    s = col(c)
    junk = s.contains("--") | s.contains("- -") | s.contains("– – –")
    return ~junk & (count_whole_words(s, preset.script) > 2)


def cleaned(c, preset: Preset) -> Column:
    """A phrase without foreign words, white space collapsed."""
    s = col(c)
    return collapse_ws(remove_whole_words(s, preset.foreign_word) if preset.foreign_word else s)


def clean_sentence(c, preset: Preset) -> Column:
    """``clean_sentence``: NULL when the phrase is rejected, else the cleaned
    phrase. ``c`` must already be stripped."""
    x = cleaned(c, preset)
    return F.when(worth_cleaning(c, preset) & x.rlike(preset.script), x)


def tokenize(c) -> Column:
    """``tokenize_sentence`` as an array of tokens."""
    return F.regexp_extract_all(col(c), F.lit(TOKEN_FAST), 0)


def ngrams(tokens, n: int) -> Column:
    """Sliding windows of length ``n`` joined by one space (tokens never hold
    whitespace, so the joined key is lossless)."""
    t = col(tokens)
    return F.when(
        F.size(t) >= n,
        F.transform(F.sequence(F.lit(0), F.size(t) - n),
                    lambda i: F.array_join(F.slice(t, i + 1, n), " ")),
    ).otherwise(F.array().cast("array<string>"))


def start_padded(tokens) -> Column:
    return F.concat(F.array(*[F.lit(s) for s in START_SYMBOLS]), col(tokens))


def mask_count(n_tokens, x: float) -> Column:
    """``len*x`` rounded half up (on the fraction), at least 1."""
    if not (0 < x <= 1):
        raise ValueError("x must be a fraction in (0, 1]")
    raw = col(n_tokens).cast("double") * F.lit(float(x))
    r = F.when(raw - F.floor(raw) >= 0.5, F.ceil(raw)).otherwise(F.floor(raw))
    return F.greatest(F.lit(1), r.cast("int"))


def md5_order(seed, *parts) -> Column:
    """Deterministic pseudo-random order key ``md5('seed:part:...')``; equal
    in Spark and DuckDB, so sampling has a SQL oracle."""
    args = [F.lit(str(seed))]
    for p in parts:
        args += [F.lit(":"), col(p).cast("string")]
    return F.md5(F.concat(*args))
