"""Operator 1, quality rules: compression bands.

zstandard ratios (raw bytes / compressed bytes) of the whole text and of fixed chunks
are held against limits that depend on the text's length, as does the size of the chunks, so
that texts of any length have some; the last chunk ends where the text ends. Repetitive text compresses
too well, noise (encoded or random bytes) does not compress at all. Base rules on words
and repeats come first.

Defined results: a null or empty text has no words, hence ``base_failed``; repeated rows
and null ids are judged one by one; texts of any length are read whole; extra columns are
not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded, unused

SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Band:
    """Limits for texts of at most ``max_bytes`` (UTF-8). A text is rejected if its whole
    ratio is outside low..high, or if more than ``bad_share`` of its bytes are in chunks of
    ``chunk`` bytes with a ratio outside chunk_low..chunk_high."""

    max_bytes: float
    low: float
    high: float
    chunk_low: float
    chunk_high: float
    bad_share: float
    chunk: int


#: Ratios of prose grow with the length, slowly and in a narrow range, so bands are a factor of
#: two wide. Upper limits lie just above the largest ratio of texts labelled good on sf0.1
#: (1.84, 1.97, 2.15, 2.22, 2.34, 2.41, 2.48 from 256 bytes on, a band each); longer bands go on
#: at that rate. Repetitive texts lie above from 1 KB on, some below that. Encoded bytes (base
#: 64) reach 1.33 at most, 1.08 in 256 bytes, 1.20 in 512, 1.26 in 1024; prose at least 1.34,
#: 1.43, 1.69, 1.92 in the first bands, its chunks 1.20, 1.40 and 1.66. Chunks of prose reach
#: 1.76 in 256 bytes, 1.98 in 512, 2.01 in 1024 and 2.23 in 4096.
BANDS = (
    Band(512, 1.10, 1.90, 1.10, 1.85, 0.5, 256),
    Band(1024, 1.25, 2.02, 1.10, 1.85, 0.5, 256),
    Band(2048, 1.40, 2.18, 1.30, 2.08, 0.5, 512),
    Band(4096, 1.45, 2.26, 1.30, 2.08, 0.5, 512),
    Band(8192, 1.50, 2.38, 1.42, 2.12, 0.5, 1024),
    Band(16384, 1.50, 2.48, 1.42, 2.12, 0.5, 1024),
    Band(32768, 1.55, 2.58, 1.42, 2.36, 0.3, 4096),
    Band(131072, 1.55, 2.75, 1.42, 2.36, 0.3, 4096),
    Band(float("inf"), 1.55, 3.20, 1.42, 2.36, 0.3, 4096),
)

FIELDS = [
    ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
    ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("ratio", pa.float64()),
    ("bad_chunk_share", pa.float64()), ("base_failed", pa.bool_()), ("kept", pa.bool_()),
]
RESULT = ("struct<n_words: bigint, word_chars: bigint, n_symbols: bigint, n_dup_lines: bigint, "
          "n_repeat_words: bigint, ratio: double, bad_chunk_share: double, base_failed: boolean, "
          "kept: boolean>")


def repeat_words(ids: np.ndarray, n_ids: int) -> int:
    """Words that lie in a 3-word window found at least twice, the first find included."""
    if len(ids) < 4:
        return 0
    if n_ids < 1 << 21:
        windows = (ids[:-2] << 42) | (ids[1:-1] << 21) | ids[2:]
    else:
        pairs = np.unique(ids[:-1] * n_ids + ids[1:], return_inverse=True)[1]
        windows = pairs[:-1] * n_ids + ids[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(len(windows), bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    covered = np.zeros(len(ids), bool)
    for shift in range(3):
        covered[shift:len(ids) - 2 + shift] |= twice
    return int(covered.sum())


def band_of(n_bytes: int, bands=BANDS) -> Band:
    return next(b for b in bands if n_bytes <= b.max_bytes)


def bad_bytes(raw: bytes, band: Band, squeeze) -> int:
    """Bytes in bad chunks. The last chunk is as long as the others and ends where the text
    ends; only its bytes that no other chunk has are counted."""
    bad = 0
    for at in range(0, len(raw), band.chunk):
        size = min(band.chunk, len(raw) - at)
        part = raw[max(0, at + size - band.chunk):at + size]
        if not band.chunk_low <= len(part) / len(squeeze(part)) <= band.chunk_high:
            bad += size
    return bad


def judge(text: str | None, word_ids, squeeze, bands=BANDS, min_words: int = 50,
          max_repeat_pct: int = 50) -> tuple:
    """One text's row of FIELDS. ``word_ids`` numbers words, ``squeeze`` compresses bytes."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # of bytes: at ASCII white space only
    n = len(words)
    spaces = len(raw) - len(raw.translate(None, SPACE))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    ids = np.fromiter(map(word_ids.__getitem__, words), np.int64, n)
    repeats = repeat_words(ids, len(word_ids))
    ratio = len(raw) / len(squeeze(raw)) if raw else 0.0
    band = band_of(len(raw), bands)
    share = bad_bytes(raw, band, squeeze) / len(raw) if raw else 0.0
    failed = n < min_words or 100 * repeats > max_repeat_pct * n
    kept = not failed and band.low <= ratio <= band.high and share <= band.bad_share
    return (n, len(text) - spaces, len(raw) - len(raw.translate(None, SYMBOLS)), len(lines) - len(set(lines)),
            repeats, ratio, share, failed, kept)


def verdict(text: Column, level: int = 3, **limits) -> Column:
    """The struct of FIELDS for a text column, by an Arrow function on each batch."""

    def of_batch(texts: pa.Array) -> pa.Array:
        squeeze = zstandard.ZstdCompressor(level=level).compress
        word_ids: dict = defaultdict(count().__next__)
        rows = []
        for t in texts:
            if len(word_ids) > 500_000:  # numbers are compared within one text only
                word_ids = defaultdict(count().__next__)
            rows.append(judge(t.as_py(), word_ids, squeeze, **limits))
        columns = list(zip(*rows)) or [[]] * len(FIELDS)
        return pa.StructArray.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(columns, FIELDS)],
                                          names=[n for n, _ in FIELDS])

    of_batch.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(of_batch, RESULT)(text)


def report(docs: DataFrame, **limits) -> DataFrame:
    """A row of measures and verdicts for each document."""
    return bounded(docs).select("doc_id", verdict(F.col("text"), **limits).alias("_q")).select("doc_id", "_q.*")


def passing(docs: DataFrame, **limits) -> DataFrame:
    """The documents kept, with all their columns."""
    name = unused(docs, "quality_verdict")
    judged = bounded(docs).withColumn(name, verdict(F.col("text"), **limits))
    return judged.filter(F.col(f"{name}.kept")).drop(name)
