"""Token ids by the tokenizers library, each distinct chunk encoded once per worker.

The tokenizer's pattern never matches across the start of a space that has a non-space
character on at least one side: letters, digits and other signs take a space only as their
first character, and a run of white space gives its last space to the word after it. A
text cut at such spaces therefore has the ids of its chunks, one after the other."""

from __future__ import annotations

import gc
import os
import re
from collections import defaultdict
from itertools import chain, count, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import offsets, ragged_index

#: White space on both sides of a space, or before it at the end.
_UNSAFE = re.compile(r"\s \s|\s \Z")
#: White space before a space; a text without it is cut at every space.
_SPACE_AFTER_SPACE = "[" + "".join(f"\\x{{{c:x}}}" for c in range(0x3001) if chr(c).isspace()) + "] "
_SAFE_CUT = re.compile(r" (?=\S)")
#: Begins the key of a text's first chunk, which has no space before it; no text holds it.
_FIRST = "\ud800"
#: Key of a line end between two units.
_LINE_END = _FIRST + "\n"
#: Units that are encoded in one string.
LINES = 16
#: Signs that a unit may lose at its end.
ENDS = (".", ",")

_ENCODERS: dict = {}


def cut(text: str) -> list[str]:
    """The chunks; all but the first have had a space before them."""
    parts = _SAFE_CUT.split(text) if _UNSAFE.search(text) else text.split(" ")
    parts[0] = _FIRST + parts[0]
    return parts


class ChunkEncoder:
    """Keeps the ids of up to ``keep`` distinct chunks, then only those of the first third,
    which are the usual ones (bounded memory)."""

    def __init__(self, path: str, keep: int = 1_300_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        line_end = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.line_end = line_end[0] if len(line_end) == 1 else None
        self.keep = keep
        self.number: dict = defaultdict(count().__next__)
        self.starts = np.zeros(1 << 16, np.int64)
        self.flat = np.zeros(1 << 18, np.uint32)
        self.known = 0  # chunks with ids
        self.used = 0  # of flat

    def _forget(self):
        stay = self.keep // 3
        number = defaultdict(count(stay).__next__)
        number.update(islice(self.number.items(), stay))
        self.number, self.known, self.used = number, stay, int(self.starts[stay])

    def _units(self, key: str) -> list[str]:
        """Keys of the parts of a chunk that the pattern always separates: a line end between
        two signs that are not white space, and full stops and commas after a letter."""
        first = key[:1] == _FIRST
        body = key[1:] if first else key
        lines = body.split("\n")
        if len(lines) > 1 and (self.line_end is None or any(x.split() != [x] for x in lines)):
            return [key]
        out = []
        for i, x in enumerate(lines):
            if i:
                out.append(_LINE_END)
            mark = _FIRST if i or first else ""
            word = x.rstrip(".,")
            if len(word) < len(x) and word[-1:].isalpha():
                out += [mark + word, _FIRST + x[len(word):]]
            else:
                out.append(mark + x)
        return out

    def _encoded(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of units, where each begins and how many it has. Units without white space
        inside are put on lines, some of them in one string: a line end is a pre-token and an
        id of its own there."""
        texts = [u[1:] if u[:1] == _FIRST else " " + u for u in units]
        words = [u[1:] if u[:1] == _FIRST else u for u in units]
        lined = [i for i, w in enumerate(words) if self.line_end is not None and w.split() == [w]]
        alone = sorted(set(range(len(units))).difference(lined))
        parts = ["\n".join(texts[i] for i in lined[k:k + LINES]) for k in range(0, len(lined), LINES)]
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(parts + [texts[i] for i in alone], add_special_tokens=False)]
        for x in ids[:len(parts)]:
            x.append(self.line_end)
        flat = np.fromiter(chain.from_iterable(ids), np.uint32)
        lens = np.empty(len(units), np.int64)
        begins = np.empty(len(units), np.int64)
        n_lined = sum(map(len, ids[:len(parts)]))
        ends = np.flatnonzero(flat[:n_lined] == self.line_end) if lined else np.zeros(0, np.int64)
        begins[lined] = np.concatenate([[0], ends[:-1] + 1]) if lined else ends
        lens[lined] = ends - begins[lined]
        lens[alone] = [len(x) for x in ids[len(parts):]]
        begins[alone] = n_lined + offsets(lens[alone])[:-1]
        return flat, begins, lens

    def _learn(self, chunks: list[str]):
        """Keeps the ids of new chunks, whose numbers go on from ``known``, and of their new units."""
        gc.disable()  # many small lists, none of them in a cycle
        try:
            todo: dict = defaultdict(count().__next__)
            known = self.known
            number = self.number.get
            of = []  # for each unit of each chunk: its number if known, else the place in todo, negative
            sizes = []
            for c in chunks:
                if "\n" not in c and c[-1:] not in ENDS:
                    of.append(-1 - todo[c])
                    sizes.append(1)
                    continue
                if "\n" not in c and c[-2:-1].isalpha():  # one sign after a letter
                    n, end = number(c[:-1], known), number(_FIRST + c[-1], known)
                    of.append(n if n < known else -1 - todo[c[:-1]])
                    of.append(end if end < known else -1 - todo[_FIRST + c[-1]])
                    sizes.append(2)
                    continue
                own = self._units(c)
                sizes.append(len(own))
                for u in own:
                    n = number(u, known)
                    of.append(n if n < known else -1 - todo[u])
            flat, begins, lens = self._encoded(list(todo))
        finally:
            gc.enable()
        more = [(u, i) for u, i in todo.items() if u not in self.number]
        for u, _ in more:
            self.number[u]
        of = np.concatenate([np.array(of, np.int64), [-1 - i for _, i in more]]).astype(np.int64)
        sizes = np.array(sizes + [1] * len(more), np.int64)
        new = of < 0
        start, size = np.empty(len(of), np.int64), np.empty(len(of), np.int64)
        start[new], size[new] = begins[-1 - of[new]], lens[-1 - of[new]]
        start[~new] = self.starts[of[~new]]
        size[~new] = self.starts[of[~new] + 1] - start[~new]
        at, from_new = ragged_index(start, size), np.repeat(new, size)
        ids = np.empty(len(at), np.uint32)
        ids[from_new], ids[~from_new] = flat[at[from_new]], self.flat[at[~from_new]]
        ends = offsets(size)[offsets(sizes)][1:]
        total, n = len(ids), len(sizes)
        while self.known + n + 1 > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used:self.used + total] = ids
        self.starts[self.known + 1:self.known + 1 + n] = self.used + ends
        self.known += n
        self.used += total

    def _numbers(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the chunks of all texts, and how many chunks a text has. Each distinct chunk
        is looked up once; only texts with a space that is no cut are cut one by one."""
        rows = pa.array(texts, pa.large_string())
        odd = pc.match_substring_regex(rows, _SPACE_AFTER_SPACE).to_numpy(zero_copy_only=False)
        parts = [cut(texts[i]) for i in np.flatnonzero(odd)]
        lists = pc.split_pattern(rows.filter(pa.array(~odd)), " ")
        sizes = np.empty(len(texts), np.int64)
        sizes[odd] = [len(p) for p in parts]
        sizes[~odd] = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        chunks = lists.flatten()
        begins = offsets(sizes[~odd])[:-1]
        lead = np.zeros(len(chunks), bool)
        lead[begins] = True  # first chunks are other keys
        number = self.number.__getitem__
        coded = chunks.filter(pa.array(~lead)).dictionary_encode()
        of_distinct = np.array(list(map(number, coded.dictionary.to_pylist())), np.int64)
        plain = np.empty(len(chunks), np.int64)
        plain[~lead] = of_distinct[coded.indices.to_numpy()]
        plain[begins] = [number(_FIRST + x) for x in chunks.take(pa.array(begins)).to_pylist()]
        out = np.empty(int(sizes.sum()), np.int64)
        mine = np.repeat(odd, sizes)
        out[~mine], out[mine] = plain, np.fromiter(map(number, chain.from_iterable(parts)), np.int64)
        return out, sizes

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts (uint32) and where each text begins (one more at the end)."""
        if len(self.number) > self.keep:
            self._forget()
        at, sizes = self._numbers(texts)
        if len(self.number) > self.known:
            self._learn(list(islice(reversed(self.number), len(self.number) - self.known))[::-1])
        starts = self.starts[at]
        lens = self.starts[at + 1] - starts
        ends = offsets(lens)[offsets(sizes)]
        return self.flat[ragged_index(starts, lens)], ends


def encoder(path: str) -> ChunkEncoder:
    """One for each worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


def bpe_50k() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
