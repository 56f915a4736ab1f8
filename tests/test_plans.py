"""Physical-plan properties the design relies on (checked on sf0.001)."""

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_masking_does_not_shuffle(spark):
    p = plan(E.queries()["masked_sentences"](spark, SF))
    assert "Exchange" not in p


def test_counts_use_partial_aggregation_and_group_limit(spark):
    p = plan(E.queries()["colloc_freq_2"](spark, SF))
    assert "partial_count" in p
    assert "WindowGroupLimit" in p


def test_filter_and_columns_reach_the_scan(spark):
    p = plan(E.queries()["sentences_by_type"](spark, SF))
    assert "PushedFilters: [IsNotNull(protocol_type), EqualTo(protocol_type,committee)]" in p
    assert "ReadSchema: struct<sent_id:string,protocol_type:string,sentence_text:string>" in p
