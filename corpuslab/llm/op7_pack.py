"""Operator 7, packing: best-fit decreasing with a segment tree over remaining capacity.

Each task packs the documents of its partition, so nothing is shuffled and a hot source
or a hot key does not matter. An overlong document is first cut into full windows. The
rests are taken longest first; a segment tree whose leaves are capacities 0..window finds
the tightest open window that still has room. Windows left with a gap of at least
``cut_gap`` are filled at the end by cutting the pieces of the emptiest ones, so that all
but one per partition are nearly full. At most ``group`` rests are packed together.

Defined results: a null or empty text is its end id alone; repeated rows and null ids are
packed like any other; extra columns are not read; an empty table gives no pieces.
Sequence ids are unique: partition number and window number. They hold for one evaluation
of the input's partitions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, slices
from .tokens import bpe_50k, encoder

SCHEMA = ("doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, "
          "sequence_id bigint, offset bigint")


class CapacityTree:
    """Counts open windows by remaining capacity; finds the smallest capacity >= need."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.count = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, capacity: int, bin_no: int):
        self.open[capacity].append(bin_no)
        i = capacity + self.size
        while i:
            self.count[i] += 1
            i >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """The tightest open window with room for ``need``: (its number, its capacity)."""
        count, i = self.count, need + self.size
        if not count[i]:
            while i and not (i & 1 == 0 and count[i + 1]):  # climb until a right neighbour holds some
                i >>= 1
            if not i:
                return None
            i += 1
            while i < self.size:
                i = 2 * i if count[2 * i] else 2 * i + 1
        capacity = i - self.size
        while i:
            count[i] -= 1
            i >>= 1
        return self.open[capacity].pop(), capacity


def best_fit(lengths: list[int], window: int, cut_gap: int = 64) -> list[list[tuple[int, int, int]]]:
    """Windows as lists of (item, start within the item, length); 1 <= lengths <= window."""
    tree = CapacityTree(window)
    bins: list[list[tuple[int, int, int]]] = []
    room: list[int] = []
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        need = lengths[item]
        found = tree.take(need)
        if found is None:
            found = len(bins), window
            bins.append([])
            room.append(window)
        b, capacity = found
        bins[b].append((item, 0, need))
        room[b] = capacity - need
        if room[b]:
            tree.add(room[b], b)
    # emptiest windows give, windows with the smallest gaps take
    gaps = sorted((b for b in range(len(bins)) if room[b] >= cut_gap), key=lambda b: (room[b], b))
    low, high = 0, len(gaps) - 1
    while low < high:
        to, source = gaps[low], gaps[high]
        item, start, length = bins[source].pop()
        part = min(length, room[to])
        bins[to].append((item, start, part))
        if part < length:
            bins[source].append((item, start + part, length - part))
        room[to] -= part
        room[source] += part
        low += room[to] == 0
        high -= not bins[source]
    return [b for b in bins if b]


def _packed(window: int, end_id: int, path: str, group: int, cut_gap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 36
        encode = encoder(path).encode
        next_window = 0
        rests: list = []  # (doc_id, start, ids, doc_tokens)

        def batch(rows):
            columns = list(zip(*rows))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                              names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        def pack_rests():
            nonlocal next_window, rests
            rows = []
            for pieces in best_fit([len(r[2]) for r in rests], window, cut_gap):
                offset = 0
                for item, start, length in pieces:
                    doc, at, ids, total = rests[item]
                    rows.append((doc, at + start, length, ids[start:start + length].tobytes(), total, base + next_window, offset))
                    offset += length
                next_window += 1
            rests = []
            return rows

        for b in batches:
            docs = b.column("doc_id").to_pylist()
            for first, texts in slices(b, "text"):
                flat, ends = encode(texts)
                rows = []
                for k in range(len(texts)):
                    ids = np.append(flat[ends[k]:ends[k + 1]], np.uint32(end_id))
                    doc, total = docs[first + k], len(ids)
                    full = total - total % window
                    for at in range(0, full, window):
                        rows.append((doc, at, window, ids[at:at + window].tobytes(), total, base + next_window, 0))
                        next_window += 1
                    if total > full:
                        rests.append((doc, full, ids[full:].copy(), total))
                if rows:
                    yield batch(rows)
                if len(rests) >= group:
                    yield batch(pack_rests())
        if rests:
            yield batch(pack_rests())

    return run


def pack(docs: DataFrame, window: int = 2048, end_id: int = 1, path: str | None = None,
         group: int = 16_000, cut_gap: int = 64) -> DataFrame:
    """A row per piece with its ids (little-endian unsigned 32-bit)."""
    return bounded(docs).select(F.col("doc_id").cast("bigint"), F.col("text")).mapInArrow(
        _packed(window, end_id, path or bpe_50k(), group, cut_gap), SCHEMA)


def with_crc(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
