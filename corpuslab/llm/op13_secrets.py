"""Operator 13, secret scans: base patterns and inferred grammars.

One pass over the whole texts finds the base matches (assign, access, hex) and, beside them,
all candidates: runs of at least ``MIN_CANDIDATE`` credential characters with a digit. The
values of the base matches are labelled credentials. From a bounded sample of each kind a
prefix tree is built and its states are merged, each with the likeliest one, where their counts
of next characters and ends are statistically compatible (Hoeffding bounds, down the whole subtrees), which gives a
probabilistic automaton. Character pairs are counted over all candidates of all documents.
A candidate's score for a kind is the mean gain in bits per character of the kind's
automaton over those pairs. A candidate that reaches ``share`` of the score that all but
``miss`` of the kind's labelled values reach (unlike them, it is among the pairs itself), and
``MIN_GAIN`` at least, is a span of kind ``<kind>_like``.

Only the scan reads texts; it writes matches and candidates. The fit runs on the driver
on at most ``max_labelled`` distinct values a kind, of ``MAX_LENGTH`` characters at most (the
first by a hash of the value); the pairs are a table of 69 x 69 counts. Scoring is a map over
the written rows. Nothing is shuffled but those values and counts.

Defined results: a null or empty text has no spans; null ids and repeated rows are scanned
one by one; texts and candidates of any length are read and scored whole. A candidate that
overlaps a base match is not scored; of kinds with equal scores the first as listed is taken.
A kind with fewer than ``MIN_LABELLED`` distinct values has no automaton and adds nothing. Extra
columns are not read; empty in, empty out.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, slices

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
#: The words that ASSIGN begins with; a text with none of them has no match.
ASSIGNED = ("passw", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # shorter runs fail, and so does any part of them
HEX = re.compile(r"[0-9a-f]{16,}")
MIN_CANDIDATE = 12
CANDIDATE = re.compile(rf"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{{{MIN_CANDIDATE},}}")
DIGIT = re.compile(r"[0-9]")
SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
MAX_LENGTH = 128
MIN_LABELLED = 20
MIN_GAIN = 0.5
SMOOTH = 0.05


def base_matches(text: str) -> list[tuple[str, int, int, str]]:
    """kind, start, end and value of the base matches, by start and then kind as listed."""
    found = []
    lowered = text.lower()
    if any(w in lowered for w in ASSIGNED):
        found += [("assign", m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [("access", m.start(), m.end(), m[0]) for m in ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(found, key=lambda f: (f[1], KINDS.index(f[0])))


def candidates(text: str, base: list) -> list[tuple[str, int, int, str]]:
    """Candidates that overlap no base match; their kind is empty."""
    starts, ends = [], []  # disjoint stretches of base matches
    for _, start, end, _ in base:
        if ends and start < ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    out = []
    for m in CANDIDATE.finditer(text):
        i = bisect_right(ends, m.start())
        if (i == len(ends) or starts[i] >= m.end()) and DIGIT.search(m[0]):
            out.append(("", m.start(), m.end(), m[0]))
    return out


SPANS = "array<struct<kind: string, start: bigint, end: bigint, value: string>>"
_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())]))


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for first, texts in slices(b, "text"):
            rows = []
            for t in texts:
                base = base_matches(t)
                rows.append([dict(zip(("kind", "start", "end", "value"), f)) for f in base + candidates(t, base)])
            yield pa.RecordBatch.from_arrays([b.column("id").slice(first, len(texts)), pa.array(rows, _SPAN)], names=["id", "found"])


def scan(docs: DataFrame) -> DataFrame:
    """id and all base matches and candidates of every document, written once."""
    rows = docs.select(F.col("doc_id").alias("id"), "text")
    return saved(rows.mapInArrow(_scanned, f"id {rows.schema['id'].dataType.simpleString()}, found {SPANS}"), "scanned")


class Automaton:
    """A deterministic probabilistic automaton: counts of arrivals, ends and next characters."""

    def __init__(self, words: list[str]):
        """The prefix tree of the words."""
        self.count, self.ends, self.edges, self.next = [0], [0], [{}], [{}]
        for w in words:
            q = 0
            self.count[0] += 1
            for c in w:
                self.edges[q][c] = self.edges[q].get(c, 0) + 1
                if c not in self.next[q]:
                    self.next[q][c] = len(self.count)
                    self.count.append(0)
                    self.ends.append(0)
                    self.edges.append({})
                    self.next.append({})
                q = self.next[q][c]
                self.count[q] += 1
            self.ends[q] += 1

    def _compatible(self, a: int, b: int, width: float) -> bool:
        """Whether the subtree at ``b`` could come from state ``a``; ``width`` sqrt(ln(2 / alpha) / 2)."""
        n, m = self.count[a], self.count[b]
        if m <= 1 or not n:
            return True  # one word is no evidence against anything: the bound is over 1
        most = width * (1 / math.sqrt(n) + 1 / math.sqrt(m))
        if abs(self.ends[a] / n - self.ends[b] / m) >= most:
            return False
        mine, other = self.edges[a], self.edges[b]
        if any(abs(mine.get(c, 0) / n - other.get(c, 0) / m) >= most for c in {**mine, **other}):
            return False
        return all(self._compatible(self.next[a][c], q, width) for c, q in self.next[b].items() if c in self.next[a])

    def _step(self, q: int, n: int) -> float:
        """log2 of the smoothed probability of what was counted ``n`` times in a state."""
        return math.log2((n + SMOOTH) / (self.count[q] + SMOOTH * (len(SYMBOLS) + 1)))

    def _likelihood(self, a: int, b: int) -> float:
        """log2 of the probability that the words of the subtree at ``b`` come from state ``a``."""
        total = self.ends[b] * self._step(a, self.ends[a])
        for c, n in self.edges[b].items():
            total += n * self._step(a, self.edges[a].get(c, 0)) + self._likelihood(self.next[a].get(c, 0), self.next[b][c])
        return total

    def _fold(self, a: int, b: int):
        """Adds the subtree at ``b`` to state ``a``."""
        self.count[a] += self.count[b]
        self.ends[a] += self.ends[b]
        for c, n in self.edges[b].items():
            self.edges[a][c] = self.edges[a].get(c, 0) + n
        for c, q in self.next[b].items():
            if c in self.next[a]:
                self._fold(self.next[a][c], q)
            else:
                self.next[a][c] = q

    def merge(self, alpha: float = 0.05) -> Automaton:
        """Merges each state at the border of the automaton with the compatible state of it from
        which its words are likeliest (few words are compatible with any), or takes it in, until no border is left; then drops what can't be reached."""
        width = math.sqrt(math.log(2 / alpha) / 2)
        kept, held = [0], {0}
        while border := next(((p, c) for p in kept for c in sorted(self.next[p]) if self.next[p][c] not in held), None):
            p, c = border
            q = self.next[p][c]
            into = min((a for a in kept if self._compatible(a, q, width)), key=lambda a: -self._likelihood(a, q), default=None)
            if into is None:
                kept.append(q)
                held.add(q)
            else:
                self.next[p][c] = into
                self._fold(into, q)
        number = {q: i for i, q in enumerate(kept)}
        self.next = [{c: number[x] for c, x in self.next[q].items()} for q in kept]
        for name in ("count", "ends", "edges"):
            setattr(self, name, [getattr(self, name)[q] for q in kept])
        return self

    def bits(self, word: str) -> float:
        """log2 of the probability of the word; a character never seen in a state costs its
        smoothing and goes back to the first state."""
        q, total = 0, 0.0
        for c in word:
            total += self._step(q, self.edges[q].get(c, 0))
            q = self.next[q].get(c, 0)
        return total + self._step(q, self.ends[q])


class Pairs:
    """log2 probabilities of a character (or the end) after another (or the start)."""

    def __init__(self, counts: np.ndarray):
        p = np.log2((counts + 1.0) / (counts + 1.0).sum(axis=1, keepdims=True))
        edge = len(SYMBOLS)
        name = {i: c for i, c in enumerate(SYMBOLS)} | {edge: ""}
        self.bits_of = {name[i] + "\0" + name[j]: float(p[i, j]) for i in range(edge + 1) for j in range(edge + 1)}

    def bits(self, word: str) -> float:
        of, total, before = self.bits_of, 0.0, ""
        for c in word:
            total += of[before + "\0" + c]
            before = c
        return total + of[before + "\0"]


def _pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    edge = len(SYMBOLS)
    place = np.full(128, edge, np.int64)
    place[np.frombuffer(SYMBOLS.encode(), np.uint8)] = np.arange(edge)
    counts = np.zeros((edge + 1) * (edge + 1), np.int64)
    for b in batches:
        for at in range(0, len(b), 20_000):
            data = ("\n" + "\n".join(b.column("value").slice(at, 20_000).to_pylist()) + "\n").encode()
            x = place[np.frombuffer(data, np.uint8)]
            counts += np.bincount(x[:-1] * (edge + 1) + x[1:], minlength=len(counts))
    pair = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(pair, pa.int32()), pa.array(counts[pair])], names=["pair", "n"])


class Model:
    """An automaton and a threshold for each kind, and the pairs of all candidates."""

    def __init__(self, automata: dict[str, Automaton], pairs: Pairs, labelled: dict[str, list[str]], miss: float, share: float):
        self.automata, self.pairs = automata, pairs
        self.least = {k: max(MIN_GAIN, share * float(np.quantile([self.gain(k, w) for w in labelled[k]], miss))) for k in automata}

    def gain(self, kind: str, word: str) -> float:
        return (self.automata[kind].bits(word) - self.pairs.bits(word)) / (len(word) + 1)

    def kind(self, word: str) -> str | None:
        """The kind with the best score among those whose threshold the word reaches."""
        scores = [(self.gain(k, word), -KINDS.index(k), k) for k in self.automata]
        return max((s for s in scores if s[0] >= self.least[s[2]]), default=(0, 0, None))[2]


def fit(scanned: DataFrame, max_labelled: int = 2000, alpha: float = 0.05, miss: float = 0.01, share: float = 0.5) -> Model:
    """The model of a scan's matches and candidates."""
    found = scanned.select(F.explode("found").alias("f")).select("f.kind", "f.value")
    values = found.filter((F.col("kind") != "") & (F.length("value") <= MAX_LENGTH)).distinct()
    chosen = None
    for k in KINDS:
        mine = values.filter(F.col("kind") == k).orderBy(F.xxhash64("value"), "value").limit(max_labelled)
        chosen = mine if chosen is None else chosen.unionByName(mine)
    labelled: dict = {}
    for r in chosen.collect():
        labelled.setdefault(r["kind"], []).append(r["value"])
    edge = len(SYMBOLS) + 1
    counts = np.zeros(edge * edge)
    tasks = found.filter("kind = ''").select("value").mapInArrow(_pair_counts, "pair int, n bigint")
    for r in tasks.groupBy("pair").agg(F.sum("n").alias("n")).collect():
        counts[r["pair"]] = r["n"]
    counts[-1] = 0  # a line end after a line end is no pair
    automata = {k: Automaton(sorted(labelled[k])).merge(alpha) for k in KINDS if len(labelled.get(k, ())) >= MIN_LABELLED}
    return Model(automata, Pairs(counts.reshape(edge, edge)), labelled, miss, share)


def line(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def _scored(model: Model):
    order = (*KINDS, *(f"{k}_like" for k in KINDS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for b in batches:
            rows = []
            for found in b.column("found").to_pylist():
                base = [(f["kind"], f["start"], f["end"]) for f in found if f["kind"]]
                more = []
                for f in found:
                    word = f["value"]
                    if f["kind"]:
                        continue
                    if word not in known:
                        if len(known) > 100_000:
                            known.clear()
                        known[word] = model.kind(word)
                    if known[word]:
                        more.append((f"{known[word]}_like", f["start"], f["end"]))
                counts = [sum(k == kind for k, _, _ in base) for kind in KINDS]
                whole = sorted(base + more, key=lambda s: (s[1], order.index(s[0])))
                rows.append((*counts, hashlib.sha256(line(base).encode()).hexdigest(), line(whole), len(more)))
            columns = list(zip(*rows)) or [()] * 6
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([b.column("id"), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                                             names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_like"])
    return run


def secrets(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_like (spans the automata add) of every document."""
    scanned = scan(docs)
    schema = (f"doc_id {scanned.schema['id'].dataType.simpleString()}, n_assign bigint, n_access bigint, n_hex bigint, "
              "base_sha256 string, spans string, n_like bigint")
    return scanned.mapInArrow(_scored(fit(scanned, **options)), schema)
