import random
from collections import defaultdict

import fixtures as fx
import numpy as np

from corpuslab.llm import op7_pack as p
from corpuslab.llm.tokens import ChunkEncoder, bpe_50k


def tightest(rooms, need):
    fits = [r for r in rooms if r >= need]
    return min(fits) if fits else None


def test_tree_finds_the_tightest_window():
    rng = random.Random(1)
    tree, rooms = p.CapacityTree(100), []
    for step in range(4000):
        if rng.random() < 0.5:
            capacity = rng.randint(1, 100)
            tree.add(capacity, step)
            rooms.append(capacity)
        else:
            need = rng.randint(1, 100)
            found = tree.take(need)
            assert (found and found[1]) == tightest(rooms, need)
            if found:
                rooms.remove(found[1])


def test_little_padding():
    rng = random.Random(2)
    lengths = [rng.randint(1, 2048) for _ in range(3000)]
    windows = p.best_fit(lengths, 2048)
    assert len(windows) <= sum(lengths) / 2048 * 1.01 + 1
    assert p.best_fit([], 2048) == []


def test_each_id_lies_in_one_piece(spark):
    plain = ChunkEncoder(bpe_50k()).tokenizer
    docs = fx.clashing(fx.documents(spark)).repartition(3)
    pieces = p.pack(docs, group=20).collect()
    sequences = defaultdict(list)
    texts = defaultdict(list)
    for r in pieces:
        sequences[r.sequence_id].append((r.offset, r.length))
        assert len(r.ids) == 4 * r.length > 0
        texts[r.doc_id].append(r)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    once = defaultdict(list)
    for r in fx.doc_rows():
        once[r[0]].append(r)
    assert texts.keys() == once.keys()
    for i, rows in once.items():
        if len(rows) == 1:
            own = sorted(texts[i], key=lambda r: r.start)
            ids = np.concatenate([np.frombuffer(r.ids, "<u4") for r in own]).tolist()
            assert ids == plain.encode(rows[0][1] or "", add_special_tokens=False).ids + [1]
            assert {r.doc_tokens for r in own} == {len(ids)}
            assert [r.start for r in own] == np.cumsum([0] + [r.length for r in own[:-1]]).tolist()
    assert sum(r.length for r in pieces) == sum(len(plain.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in fx.doc_rows())
    assert p.with_crc(p.pack(docs.limit(0))).count() == 0


def plain_best_fit(lengths, window):
    """Longest first, each into the fullest window that has room."""
    windows = []
    for need in sorted(lengths, reverse=True):
        fits = [w for w in windows if sum(w) + need <= window]
        if fits:
            max(fits, key=sum).append(need)
        else:
            windows.append([need])
    return windows


def test_assignment_equals_best_fit_decreasing():
    rng = random.Random(3)
    for n, window in ((0, 50), (1, 50), (60, 50), (400, 300), (300, 17)):
        lengths = [rng.randint(1, window) for _ in range(n)]
        got = p.best_fit(lengths, window, cut_gap=window + 1)  # nothing is cut
        assert sorted(item for w in got for item, _, _ in w) == list(range(n))
        assert all(start == 0 and length == lengths[item] for w in got for item, start, length in w)
        want = plain_best_fit(lengths, window)
        assert sorted(sum(x[2] for x in w) for w in got) == sorted(map(sum, want))  # windows equally full are interchangeable


def test_cut_pieces_tile_their_items():
    rng = random.Random(4)
    lengths = [rng.randint(1, 200) for _ in range(500)]
    parts = defaultdict(list)
    for w in p.best_fit(lengths, 256, cut_gap=16):
        assert sum(x[2] for x in w) <= 256
        for item, start, length in w:
            parts[item].append((start, length))
    for item, own in parts.items():
        at = 0
        for start, length in sorted(own):
            assert start == at and length > 0
            at += length
        assert at == lengths[item]
    assert len(parts) == len(lengths)
