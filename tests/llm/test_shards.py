import zlib

import fixtures as fx
import numpy as np
import pytest

from corpuslab.llm import op5_shards as s
from corpuslab.llm.common import fresh_path
from corpuslab.llm.tokens import ChunkEncoder, bpe_50k


@pytest.fixture(scope="module")
def plain():
    return ChunkEncoder(bpe_50k()).tokenizer


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_chunks_encode_as_the_whole_text(plain):
    import random
    rng = random.Random(3)
    parts = ["a", "bc", " ", "  ", "\n", "\t", "'s", "'", "1", "!", "é", " ", "\x1c", "　", "<|endoftext|>", "\x00"]
    texts = [t or "" for t in fx.texts()] + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(5000)]
    for keep in (50, 1 << 20):
        e = ChunkEncoder(bpe_50k(), keep)
        for i in range(0, len(texts), 700):
            flat, ends = e.encode(texts[i:i + 700])
            for k, t in enumerate(texts[i:i + 700]):
                assert flat[ends[k]:ends[k + 1]].tolist() == ids_of(plain, t)


@pytest.mark.parametrize("size", [1, 2, 7, 5000])
def test_perfect_hash_is_minimal_and_tells_strangers(size):
    rng = np.random.default_rng(size)
    keys = np.unique(rng.integers(-1 << 60, 1 << 60, size))
    h = s.PerfectHash.load(s.PerfectHash.build(keys).dump())
    assert sorted(h.slots(keys).tolist()) == list(range(len(keys)))
    shard = s._shard(0, 0, keys.tolist(), [True] * len(keys), [1] * len(keys), [np.ones(1, np.uint32)] * len(keys))
    assert (s.lookup(shard, keys)[0] >= 0).all()
    strangers = np.setdiff1d(rng.integers(-1 << 60, 1 << 60, 3000), keys)
    assert (s.lookup(shard, strangers)[0] >= 0).mean() < 0.01


def test_files_read_back_in_order(spark, plain):
    docs = fx.clashing(fx.documents(spark)).repartition(5)
    folder = fresh_path(spark, "test-shards")
    s.write(docs, folder, shard_ids=3000)
    got = s.read(spark, folder).orderBy("start").collect()
    rows = fx.doc_rows()
    assert len(got) == len(rows)
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda x: (x is not None, x or 0))
    start = 0
    for r in got:
        assert r.start == start and r.ids_crc32 == zlib.crc32(r.ids) and len(r.ids) == 4 * r.n_tokens
        start += r.n_tokens
    mine = sorted(((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in got), key=str)
    assert mine == sorted(((r[0], ids_of(plain, r[1]) + [0]) for r in rows), key=str)
    asked = spark.createDataFrame([(1,), (4,), (100,), (-5,), (10**12,), (2,)], "doc_id bigint")
    found = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in s.fetch(spark, folder, asked).collect()}
    assert found == {i: ids_of(plain, next(r[1] for r in rows if r[0] == i)) + [0] for i in (1, 4, 100)}


def test_empty(spark):
    folder = fresh_path(spark, "test-shards")
    s.write(fx.documents(spark, []), folder)
    assert s.read(spark, folder).count() == 0
    assert s.fetch(spark, folder, spark.createDataFrame([(1,)], "doc_id bigint")).count() == 0
