import random

import fixtures as fx

from corpuslab.llm import op6_wordpiece as w


def greedy(word, starts, rest):
    """Longest match first, by trying all lengths; -1 if nothing fits."""
    at, n = 0, 0
    while at < len(word):
        pieces = starts if at == 0 else rest
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), None)
        if end is None:
            return -1
        at, n = end, n + 1
    return n


def test_automaton_equals_greedy_search():
    rng = random.Random(2)
    for _ in range(300):
        make = lambda: "".join(rng.choice("abc") for _ in range(rng.randint(1, 4)))
        starts, rest = {"_" + make() for _ in range(6)} | set(rng.sample(["_"], rng.randint(0, 1))), {make() for _ in range(6)}
        automaton = w.Automaton(starts, rest)
        for _ in range(60):
            word = "_" + "".join(rng.choice("abc") for _ in range(rng.randint(1, 9)))
            assert automaton.count(word) == greedy(word, starts, rest), (starts, rest, word)


def test_documents_equal_brute_force(spark):
    starts, rest = w.vocabulary(w.piece_model())
    want = []
    for i, text, *_ in fx.doc_rows():
        words = (text or "").encode().split()
        n = [greedy(w.MARK + x.decode(), starts, rest) if len(x) < 300 else None for x in words]
        want.append((i, len(words), None if None in n else sum(map(abs, n)), None if None in n else sum(x < 0 for x in n)))
    got = [tuple(r) for r in w.counts(fx.clashing(fx.documents(spark)), keep=200).collect()]
    assert len(got) == len(want)
    skip = {x[0] for x in want if x[2] is None}
    pick = lambda rows: sorted((x for x in rows if x[0] not in skip), key=str)
    assert pick(got) == pick(want)
    assert w.counts(fx.documents(spark, [])).count() == 0
