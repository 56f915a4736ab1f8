"""Query registry: name -> (Spark builder, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``; ``sql`` is
    the DuckDB oracle over the driver's views (None -> rows-only check)."""

    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def load_all() -> None:
    from . import (q_classify, q_cv, q_generate, q_io, q_lm, q_models, q_ngrams, q_prompts, q_text,  # noqa: F401
                   q_transcripts, q_vectors)
