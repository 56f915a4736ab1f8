import hashlib

import fixtures as fx
import tiktoken

from corpuslab.llm import op4_bpe as b


def test_equals_tiktoken_and_round_trip(spark):
    enc = tiktoken.Encoding("own", pat_str=b.pattern(), mergeable_ranks=b.read_ranks(b.rank_file()), special_tokens={})
    docs = fx.clashing(fx.documents(spark)).repartition(3)
    for block in (2000, 1 << 24):
        decoded = b.decode(b.encode(docs, block_chars=block)) if block == 2000 else b.encode(docs, block_chars=block, decoded=True)
        got = sorted(((r.doc_id, tuple(r.ids), bytes(r.decoded)) for r in decoded.collect()), key=str)
        want = sorted(((r[0], tuple(enc.encode_ordinary(r[1] or "")), (r[1] or "").encode()) for r in fx.doc_rows()), key=str)
        assert got == want
    row = next(r for r in b.digests(decoded).collect() if r.doc_id == 1)
    ids = enc.encode_ordinary(fx.doc_rows()[0][1])
    assert (row.n_tokens, row.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
    assert row.decoded_sha256 == hashlib.sha256(fx.doc_rows()[0][1].encode()).hexdigest()


def test_only_empty_texts_and_no_rows(spark):
    docs = fx.documents(spark, [(1, None, "", "", 0), (1, "", "", "", 0)])
    assert [(r.n_tokens, r.decoded_sha256) for r in b.digests(b.decode(b.encode(docs))).collect()] == [(0, hashlib.sha256(b"").hexdigest())] * 2
    assert b.digests(b.decode(b.encode(docs.limit(0)))).count() == 0
