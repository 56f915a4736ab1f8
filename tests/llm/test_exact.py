import hashlib
import re

import fixtures as fx
import pytest
from pyspark.sql import functions as F

from corpuslab.llm import op3_exact as e


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(norm(r[1]), []).append(r[0])
    out = []
    for r in rows:
        g = groups[norm(r[1])]
        keep = min((x for x in g if x is not None), default=None)
        out.append((r[0], keep, len(g), r[0] == keep, hashlib.sha256(norm(r[1]).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("digest", [e.sha256, lambda c: F.crc32(c) % 7])
def test_equals_brute_force_even_when_digests_clash(spark, digest):
    docs = fx.documents(spark).repartition(7)
    assert sorted(map(tuple, e.groups(fx.clashing(docs), digest, 3).collect()), key=str) == brute(fx.doc_rows())
    stay = e.distinct_documents(fx.clashing(docs), digest, 3)
    assert stay.columns == fx.clashing(docs).columns
    got = [(norm(r.text), r.doc_id) for r in stay.collect()]
    want = {}
    for r in fx.doc_rows():
        t = norm(r[1])
        want[t] = r[0] if want.get(t) is None else min(want[t], r[0] if r[0] is not None else want[t])
    assert sorted(got, key=str) == sorted(want.items(), key=str)


def test_empty(spark):
    docs = fx.documents(spark, [])
    assert e.groups(docs).count() == e.distinct_documents(docs).count() == 0
