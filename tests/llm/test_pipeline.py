import random

import fixtures as fx

import corpus_pipeline as cp
from corpuslab.llm import op1_quality as q
from corpuslab.llm import op7_pack as p
from test_exact import norm
from test_neardup import brute


def folder(spark, tmp_path, rows, labels):
    sf = str(tmp_path)
    fx.clashing(fx.documents(spark, rows)).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    return sf


def test_stages_and_run(spark, tmp_path):
    rng = random.Random(8)
    rows = fx.doc_rows() + [(5000 + k, (fx.prose(rng, 80).upper() + "!! ") * 1, "en", "s", 0) for k in range(30)]
    labels = [(r[0], 0 if r[0] >= 5000 else 1, 0) for r in rows if r[0] is not None and (r[0] >= 5000 or r[0] < 120)]
    sf = folder(spark, tmp_path / "a", rows, labels)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, None
    for k, (name, stage) in enumerate(cp.STAGES[:-1]):
        out = stage(spark, docs, sf)
        assert out.columns == columns, name
        out.write.parquet(f"{tmp_path}/s{k}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/s{k}")
        had, has = [(r.doc_id, r.text) for r in before.collect()], [(r.doc_id, r.text) for r in docs.collect()]
        if name == "quality_rules":
            kept = q.report(before).filter("kept").select("doc_id").collect()
            assert sorted(map(str, kept)) == sorted(str(r) for r in docs.select("doc_id").collect())
        if name == "quality_classifier":
            gone = {i for i, _ in had} - {i for i, _ in has}
            assert sum(i >= 5000 for i in gone if i is not None) >= 27 and sum(i < 5000 for i in gone if i is not None) <= 2
        if name == "exact_dedup":
            assert sorted(norm(t) for _, t in has) == sorted({norm(t) for _, t in had})
        if name == "near_dedup":
            want = brute(had, 5)
            assert {i for i, _ in has if i is not None} == {i for i, (_, c) in want.items() if c == i}
    pieces = cp.run(spark, sf).collect()
    assert {r.doc_id for r in pieces} == {i for i, _ in has}
    one = p.with_crc(p.pack(docs)).collect()
    assert sum(r.length for r in pieces) == sum(r.length for r in one)


def test_empty(spark, tmp_path):
    sf = folder(spark, tmp_path / "b", [], [])
    assert cp.run(spark, sf).count() == 0
