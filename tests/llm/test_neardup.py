import random
import re

import fixtures as fx
import numpy as np
import pytest

from corpuslab.llm import op10_neardup as n

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, width=4):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}


def brute(rows, width=4):
    """doc_id -> (set size, component) for rows with an id; ids are unique or repeat equal texts."""
    sets = {i: shingles(t, width) for i, t in rows if i is not None}
    up = {i: i for i in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * min(len(x), len(y)) >= 80 * max(len(x), len(y)) and 100 * len(x & y) >= 80 * len(x | y):
                low, high = sorted((top(a), top(b)))
                up[high] = low
    return {i: (len(sets[i]), top(i)) for i in ids}


def family(seed, size, share):
    """Copies of one text, each with other words changed."""
    rng = random.Random(seed)
    base = fx.prose(rng, 300)
    return [fx.edited(rng, base, share) for _ in range(size)]


def test_equals_brute_force(spark):
    rows = [(r[0], r[1]) for r in fx.doc_rows()]
    rows += [(1000 + k, t) for k, t in enumerate(family(1, 25, 0.02) + family(2, 25, 0.035) + family(3, 12, 0.2))]
    passage = fx.prose(random.Random(9), 60)
    rows += [(2000 + k, passage + " " + fx.prose(random.Random(100 + k), 40)) for k in range(40)]
    docs = spark.createDataFrame([(i, t, "", "", 0) for i, t in rows], fx.DOCS).repartition(5)
    want = brute(rows)
    got = n.components(fx.clashing(docs)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id] and r.kept == (r.component_id == r.doc_id), r.doc_id
    stay = n.representatives(fx.clashing(docs))
    assert stay.columns == fx.clashing(docs).columns
    assert {r.doc_id for r in stay.collect()} == {i for i, (_, c) in want.items() if c == i} | {None}


def test_five_word_shingles_of_the_pipeline(spark):
    rows = [(k, t) for k, t in enumerate(family(5, 20, 0.015))]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in n.components(spark.createDataFrame([(i, t, "", "", 0) for i, t in rows], fx.DOCS), width=5).collect()}
    assert got == brute(rows, 5)


def test_long_chains_become_one_component(spark):
    rows, links = [(k, k + 1) for k in range(200)] + [(500, 501)], None
    links = spark.createDataFrame(rows, "a bigint, b bigint")
    got = {r.id: r.comp for r in n.propagate(links).collect()}
    assert got == {**{k: 0 for k in range(201)}, 500: 500, 501: 500}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "a b c"), (2, "d e f")]])
def test_tables_without_links(spark, rows):
    docs = spark.createDataFrame([(i, t, "", "", 0) for i, t in rows], fx.DOCS)
    assert sorted((r.doc_id, r.component_id, r.kept) for r in n.components(docs).collect()) == [(i, i, True) for i, _ in rows]


def test_pairing_small_collections_gives_all_tables():
    import pyarrow as pa
    sig = np.arange(2 * 4 * 3, dtype=np.uint32)
    batch = pa.RecordBatch.from_arrays([pa.array([7]), pa.array([sig.tobytes()], pa.binary())], names=["id", "signature"])
    out = list(n._keys(4, 3)(iter([batch])))
    assert len(set(out[0].column("key").to_pylist())) == 16


def test_ranks_of_a_hot_key_over_many_pieces(spark):
    rows = [(7, i, 5 if i == 4321 else 1 + i % 3) for i in range(6000)] + [(k, i, 1) for k in range(20, 400) for i in range(2)]
    members = spark.createDataFrame(rows, "key bigint, id bigint, hub bigint").repartition(5)
    got = n.ranks(members).collect()
    by_key = {}
    for r in got:
        by_key.setdefault(r.key, []).append((r["rank"], r.id))
    assert all(sorted(x)[-1][0] == len(x) == len({k for k, _ in x}) for x in by_key.values()) and len(got) == len(rows)
    hub = {i: h for k, i, h in rows if k == 7}
    order = [hub[i] for _, i in sorted(by_key[7])]
    assert order == sorted(order, reverse=True) and sorted(by_key[7])[0] == (1, 4321)


def test_no_whole_key_is_put_into_one_task(spark):
    """A window by the key alone can't be split: windows are by key and piece, or over a row a piece."""
    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    rows = [(k % 3, k, k % 2, k, 1) for k in range(60)]
    members = spark.createDataFrame(rows, "key bigint, id bigint, comp bigint, hub bigint, n bigint")
    assert "Window [" not in plan(n.mixed(members)) and "Window [" not in plan(n.shared(members.select("key", "id")))
    numbered = [x for x in plan(n.ranks(members)).split("\n") if "row_number" in x and "Window [" in x]
    assert numbered and all("piece#" in x.split("], [")[1] for x in numbered)
    assert {r.id for r in n.mixed(members).collect()} == set(range(60))
    assert n.mixed(members.withColumn("comp", members.key)).isEmpty()
    assert sorted(map(tuple, n.shared(members.select("key", "id").union(spark.createDataFrame([(99, 1)], "key bigint, id bigint"))).collect())) == sorted((k, i, 20) for k, i, *_ in rows)


def test_one_id_on_several_texts(spark):
    a, b, c = fx.prose(random.Random(31), 120), fx.prose(random.Random(32), 120), fx.prose(random.Random(33), 120)
    near = a.split(" ")
    near[60] = "changed"
    rows = [(5, a), (5, b), (2, " ".join(near)), (9, c), (5, "x y"), (5, None), (7, b + " tail"), (7, c)]
    docs = fx.clashing(spark.createDataFrame([(i, t, "", "", 0) for i, t in rows], fx.DOCS))
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in n.components(docs).collect())
    size = lambda t: len(shingles(t))
    assert got == sorted([(5, size(a), 2, False), (5, size(b), 5, True), (2, size(a), 2, True), (9, size(c), 7, False), (5, 1, 5, True), (5, 0, 5, True),
                          (7, size(b) + 1, 5, False), (7, size(c), 7, True)])
    stay = sorted((r.doc_id, r.text or "") for r in n.representatives(docs).collect())
    assert stay == sorted([(5, b), (2, rows[2][1]), (5, "x y"), (5, ""), (7, c)])
    assert n.representatives(docs).columns == docs.columns


def test_rounds_and_floor_find_the_same_links(spark):
    docs = spark.createDataFrame([(i, t, "", "", 0) for i, t in enumerate(family(7, 12, 0.03) + family(8, 12, 0.045))], fx.DOCS)
    want = sorted(map(tuple, n.components(docs).collect()))
    assert want == sorted(map(tuple, n.components(docs, floor=0.6).collect())) == sorted(map(tuple, n.components(docs, pivots=2).collect()))


def test_a_pair_meets_only_in_the_first_table_it_shares(spark):
    import pyarrow as pa
    m, r = 4, 3
    rng = np.random.default_rng(3)
    sigs = np.where(rng.random((40, 2 * m * r)) < 0.85, np.arange(2 * m * r), rng.integers(100, 1 << 30, (40, 2 * m * r))).astype(np.uint32)
    batch = pa.RecordBatch.from_arrays([pa.array(range(40)), pa.array([s.tobytes() for s in sigs], pa.binary())], names=["id", "signature"])
    keys = [(k, i) for out in n._keys(m, r)(iter([batch])) for k, i in zip(out.column("key").to_pylist(), out.column("id").to_pylist())]
    by_key = {}
    for k, i in keys:
        by_key.setdefault(k, []).append(i)
    shared = {(a, b) for ids in by_key.values() for a in ids for b in ids if a < b}
    assert sum(len(ids) * (len(ids) - 1) // 2 for ids in by_key.values()) > 2 * len(shared) > 200
    rows = [(k, i, 1 + ids.index(i), i, 100, bytearray(sigs[i].tobytes()), *[0] * 16) for k, ids in by_key.items() for i in ids]
    here = spark.createDataFrame(rows, "key bigint, id bigint, rank bigint, comp bigint, n bigint, signature binary, " + ", ".join(f"{c} bigint" for c in n.ODD))
    met = [(x.a, x.b) for x in n.meetings(n.with_earlier(here, m, r), 1000, 80).collect()]
    assert len(met) == len(set(met)) and set(met) == shared
