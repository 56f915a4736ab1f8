"""Entry smoke test and Spark-vs-DuckDB equality for a slice of queries on
sf0.001 (the full gate runs at sf0.01 via tools/check.py)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from corpuslab.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
SLICE = ["sentence_table", "colloc_freq_2", "colloc_tfidf_3", "lm_stats", "next_token", "masked_sentences",
         "restored_sentences", "speaker_turns", "transcript_sentences", "knn_classify", "balanced_classes",
         "sentence_vectors", "prompt_accuracy", "jsonl_validate"]


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["corpus", "rank", "collocation", "cnt"]
    assert df.count() >= 0


def test_every_query_has_a_builder():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 80


@pytest.mark.parametrize("name", SLICE)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = sorted((tuple(norm(x) for x in r) for r in df.collect()), key=repr)
    rel = con.sql(E.oracle_sql()[name])
    order = [rel.columns.index(c) for c in df.columns]
    want = sorted((tuple(norm(r[i]) for i in order) for r in rel.fetchall()), key=repr)
    assert rows == want
