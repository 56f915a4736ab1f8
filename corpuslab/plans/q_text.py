"""Queries: paragraphs, phrases, cleaning, tokenizing, the sentence table."""

from __future__ import annotations

from ..operators.sentences import SENTENCE_COLUMNS, sentence_table
from . import sqlfrag as S
from .registry import query

SENT = S.sentences_ctes()
_SENT_OUT = ("sent_id, file_id, turn_id, piece_pos, corpus, protocol_name, knesset_number, "
             "protocol_type, protocol_number, speaker_name, sentence_text, n_tokens")


@query("sentence_table", f"WITH {SENT} SELECT {_SENT_OUT} FROM sentences")
def q_sentence_table(spark, sf_dir):
    """The D2 record (plus ids) for every sentence of every document."""
    return sentence_table(spark, sf_dir).drop("tokens")
