import random
import re
from collections import Counter
from collections import defaultdict
from itertools import count

import fixtures as fx
import zstandard

from corpuslab.llm import op1_quality as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered), failed)


def test_base_measures_equal_brute_force(spark):
    rows = fx.doc_rows()
    got = q.report(fx.clashing(fx.documents(spark))).collect()
    assert len(got) == len(rows)
    key = lambda r: (r[0] is None, r[0] or 0, str(r[1:]))
    want = sorted(((r[0], *brute(r[1])) for r in rows), key=key)
    mine = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got), key=key)
    assert mine == want
    assert not any(r.kept for r in got if r.base_failed)


def test_bands_reject_repetition_and_noise_and_keep_prose():
    rng = random.Random(5)
    squeeze = zstandard.ZstdCompressor(level=3).compress
    judge = lambda t: q.judge(t, defaultdict(count().__next__), squeeze)[-1]
    for n in (60, 200, 1000, 8000):
        assert judge(fx.prose(rng, n))
    vocabulary = [fx.prose(rng, 1) for _ in range(6)]
    assert not judge(" ".join(rng.choice(vocabulary) for _ in range(3000)))
    noise = "".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(9000))
    assert not judge(" ".join(noise[i:i + 90] for i in range(0, 9000, 90)))
    good = fx.prose(rng, 6000)
    table = "".join(f"{i:09d}0000000000000000000000000 " for i in range(3000))
    assert not judge(good + " " + table)  # half of the chunks are out of their band


def test_window_count_with_many_ids():
    import numpy as np
    ids = np.array([1, 2, 3, 1, 2, 3, 9, 1, 2, 3])
    assert q.repeat_words(ids, 10) == q.repeat_words(ids, 1 << 22) == 9


def test_passing_keeps_columns_and_empty_table(spark):
    docs = fx.clashing(fx.documents(spark))
    assert q.passing(docs).columns == docs.columns
    assert q.passing(docs).count() == q.report(docs).filter("kept").count() > 20
    assert q.report(docs.limit(0)).count() == 0


def test_chunks_of_all_lengths_are_judged_to_the_end():
    """Noise and repetition in one text even out over the whole of it, not over its chunks."""
    rng = random.Random(6)
    squeeze = zstandard.ZstdCompressor(level=3).compress
    judge = lambda t: q.judge(t, defaultdict(count().__next__), squeeze, max_repeat_pct=100)
    code = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"

    def noise(n):
        return "".join(rng.choice(code) if i % 60 else " " for i in range(n))

    for n in (1000, 2000, 4000, 4096, 6000, 8000):
        half = "the same line of words again \n" * (n // 90)  # the whole is within its band
        for text in (half + noise(n - len(half)), noise(n - len(half)) + half):
            r = judge(text)
            band = q.band_of(len(text))
            assert band.low <= r[5] <= band.high and r[6] > 0.5 and not r[-1], n
    for n in (200, 300, 500, 1500, 3000, 5000, 8000):  # the share counts bytes, wherever they stand
        prose = fx.prose(rng, n)[:n]
        assert judge(prose)[6] == 0
        few, many = n // 4, n * 3 // 4
        for bad, kept in ((few, True), (many, False)) if n > 1000 else ():
            for text in (noise(bad) + prose[bad:], prose[bad:] + noise(bad)):
                r = judge(text)
                assert (r[6] <= 0.5) == kept and (kept or not r[-1]), (n, bad)


def plain_verdict(text):
    """Ratios and chunks by a plain reading: the band by length, each chunk by itself, bytes counted one by one."""
    raw = (text or "").encode()
    pack = lambda b: len(zstandard.compress(b, 3))
    if not raw:
        return 0.0, 0.0, True
    band = next(b for b in sorted(q.BANDS, key=lambda b: b.max_bytes) if len(raw) <= b.max_bytes)
    bad = set()
    for k in range(-(-len(raw) // band.chunk)):
        own = range(k * band.chunk, min(len(raw), (k + 1) * band.chunk))
        part = raw[max(0, own.stop - band.chunk):own.stop]
        ratio = len(part) / pack(part)
        if ratio < band.chunk_low or ratio > band.chunk_high:
            bad.update(own)
    whole, share = len(raw) / pack(raw), len(bad) / len(raw)
    return whole, share, band.low <= whole <= band.high and share <= band.bad_share


def test_ratios_and_chunks_equal_a_plain_reading(spark):
    rows = fx.doc_rows()
    verdicts = {r[1]: plain_verdict(r[1]) for r in rows}
    text = {i: r[1] for i, r in enumerate(rows)}
    docs = spark.createDataFrame([(i, t, "", "", 0) for i, t in text.items()], fx.DOCS)
    for r in q.report(docs).collect():
        whole, share, fine = verdicts[text[r.doc_id]]
        assert abs(r.ratio - whole) <= 0.02 * whole and abs(r.bad_chunk_share - share) < 1e-9, r.doc_id  # a frame may state its size or not
        assert r.kept == (not r.base_failed and fine)


def test_limits_decide_on_repetitive_prose_of_each_band():
    """Prose of one of a few stock phrases in each sentence passes the base rules, not its band."""
    rng = random.Random(12)
    squeeze = zstandard.ZstdCompressor(level=3).compress
    for n in (400, 800, 1500, 5000):
        text = fx.prose(rng, n)
        stock = [fx.prose(rng, 2) for _ in range(25)]
        dull = " ".join(w if i % 3 else rng.choice(stock) for i, w in enumerate(text.split(" ")))
        plain, low = (q.judge(t, defaultdict(count().__next__), squeeze) for t in (text, dull))
        assert plain[-1] and not low[7], n
        assert not low[-1], (n, low[5])
