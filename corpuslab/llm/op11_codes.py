"""Operator 11, vector code compression: product codes by an integer Walsh-Hadamard transform.

Each vector is scaled to integers and cut into equal parts; each part position has a small
codebook, learnt in rounds over all vectors. Parts and entries are filled up with zeros to a
power of two (P) and transformed by additions and subtractions alone. The transform keeps
squared distances up to the factor P, so squared differences of coefficients, added in the
order of their number of sign changes (sequency), are lower bounds that grow to P times the
distance. The entry nearest in the first coefficient gives a whole distance at once; an
entry goes as soon as its sum exceeds that. Ties survive and go to the lower index. All of it
is 64-bit integer arithmetic.

A round is one map over the written integer vectors, in which each task sums its parts by
entry, and a grouping of those few sums (decimals); only codebooks (parts x entries x part
width) pass through the driver.

Defined results: rows whose vector is null or holds null or non-finite components are
dropped. Vectors of different lengths are filled up with zeros to the longest, rounded up to
a multiple of the number of parts (an empty vector is all zeros). Seeds are the first rows by
(vec_id, vector), so rows with one vec_id count one by one; a null vec_id gives no seed but is
coded. With fewer rows than entries the codebooks are smaller; without any row with an id
each codebook is a single zero entry. Components beyond ``vectors.bound`` (32,768 in absolute value at 64
dimensions) are taken as that bound, as no 64-bit error could hold more. Extra columns are not
read; columns of any name may stand in the table. Empty in, empty out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved
from .vectors import bound, dense, scaled, summed


def power_of_two(width: int) -> int:
    return 1 << max(0, width - 1).bit_length()


def sequency_order(size: int) -> np.ndarray:
    """Places of the transform's coefficients by their number of sign changes."""
    bits = size.bit_length() - 1
    gray = np.arange(size) ^ (np.arange(size) >> 1)
    return sum((((gray >> i) & 1) << (bits - 1 - i) for i in range(bits)), np.zeros(size, np.int64))


def transform(parts: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of the rows, filled up with zeros, in sequency order."""
    n, width = parts.shape
    size = power_of_two(width)
    x = np.zeros((n, size), np.int64)
    x[:, :width] = parts
    half = 1
    while half < size:
        y = x.reshape(n, size // (2 * half), 2, half)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, size)
        half *= 2
    return x[:, sequency_order(size)]


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of rows and entries, both transformed: the nearest entry (the lower one of equals) and
    its squared distance times the transform's size."""
    n, size = parts.shape
    first = parts[:, :1] - entries[None, :, 0]
    guess = np.abs(first).argmin(axis=1)
    whole = parts - entries[guess]
    most = (whole * whole).sum(axis=1)
    so_far = first * first
    row, entry = np.nonzero(so_far <= most[:, None])
    so_far = so_far[row, entry]
    at, step = 1, 1
    while at < size:
        diff = parts[row, at:at + step] - entries[entry, at:at + step]
        so_far = so_far + (diff * diff).sum(axis=1)
        stay = so_far <= most[row]
        row, entry, so_far = row[stay], entry[stay], so_far[stay]
        at, step = at + step, 2 * step
    begins = np.searchsorted(row, np.arange(n))  # pairs are in the order of rows, then entries
    best = np.minimum.reduceat(so_far, begins) if n else so_far
    hit = np.flatnonzero(so_far == best[row])
    return entry[hit[np.searchsorted(row[hit], np.arange(n))]], best


class Coder:
    """Codebooks: an array (parts, entries, width) of integers."""

    def __init__(self, books: np.ndarray):
        self.books = books
        self.parts, _, self.width = books.shape
        self.size = power_of_two(self.width)
        self.most = bound(self.parts * self.width, -(-self.size // self.parts))
        self.transformed = [transform(b) for b in books]

    def assign(self, x: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Part number, the rows' parts, their entries and squared distances."""
        for p in range(self.parts):
            own = x[:, p * self.width:(p + 1) * self.width]
            index, far = nearest(transform(own), self.transformed[p])
            yield p, own, index, far // self.size


def _sums(books: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(books)
        parts, entries, width = books.shape
        total, counts = np.zeros(books.shape, np.int64), np.zeros((parts, entries), np.int64)
        for b in batches:
            for _, x in dense(b, parts * width, coder.most):
                for p, own, index, _ in coder.assign(x):
                    np.add.at(total[p], index, own)
                    counts[p] += np.bincount(index, minlength=entries)
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(counts[part, entry]),
                                          pa.array(list(total[part, entry]), pa.list_(pa.int64()))], names=["part", "entry", "n", "sums"])
    return run


def _coded(books: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(books)
        hex_of = np.array([f"{i:02x}" for i in range(books.shape[1])], object)
        for b in batches:
            for rows, x in dense(b, coder.parts * coder.width, coder.most):
                code, error = np.full(len(x), "", object), np.zeros(len(x), np.int64)
                for _, _, index, far in coder.assign(x):
                    code = code + hex_of[index]
                    error += far
                yield pa.RecordBatch.from_arrays([rows.column("id"), rows.column("label"), pa.array(code, pa.string()), pa.array(error)],
                                                 names=["id", "label", "code", "error"])
    return run


def learn(rows: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6) -> np.ndarray:
    """Codebooks of the written integer vectors (id, v)."""
    longest = rows.agg(F.max(F.size("v"))).first()[0] or 0
    width = max(1, -(-longest // parts))
    seeds = rows.filter("id IS NOT NULL").orderBy("id", "v").limit(entries).collect()
    books = np.zeros((parts, max(1, len(seeds)), width), np.int64)
    most = Coder(books).most
    for e, r in enumerate(seeds):
        v = np.clip(np.array(r["v"] + [0] * (parts * width - len(r["v"])), np.int64), -most, most)
        books[:, e] = v.reshape(parts, width)
    for _ in range(rounds):
        partial = rows.select("v").mapInArrow(_sums(books), "part int, entry int, n bigint, sums array<bigint>")
        books = books.copy()
        for (part, entry), n, total in summed(partial, ["part", "entry"], width):
            books[part, entry] = [s // n for s in total]
    return books


def encode(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096,
           column: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """A row per kept vector (id, label, code, error), and the codebooks."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    rows = scaled(vectors, {"id": "vec_id", "label": "label"}, column, scale)
    books = learn(rows, parts, entries, rounds)
    kinds = rows.schema
    schema = f"id {kinds['id'].dataType.simpleString()}, label {kinds['label'].dataType.simpleString()}, code string, error bigint"
    return saved(rows.mapInArrow(_coded(books), schema), "codes"), books


def decode(code: str, books: np.ndarray) -> np.ndarray:
    """The integer vector that a code stands for."""
    return np.concatenate([books[p, int(code[2 * p:2 * p + 2], 16)] for p in range(len(books))])


def with_errors(codes: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256. The sums by label are written before
    the join, so that Spark broadcasts them only if they are small and can split a hot label if not."""
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    sums = saved(codes.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("bigint").alias("label_error")), "label_errors")
    sums = sums.withColumnRenamed("label", "of_label")
    return (codes.join(sums, F.col("label").eqNullSafe(F.col("of_label")))
            .select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")))


def sql(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """The same in DuckDB, for vectors of one length that ``parts`` divides."""
    steps = [f"""WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) - 1 AS r, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT r, p, v[p * (len(v) // {parts}) + 1:(p + 1) * (len(v) // {parts})] AS v FROM kept, (SELECT unnest(range({parts})) AS p)),
book0 AS MATERIALIZED (SELECT p, r AS e, v FROM parts WHERE r < {entries})"""]
    near = """near{i} AS MATERIALIZED (
  SELECT x.r, x.p, min(list_sum(list_transform(list_zip(x.v, b.v), lambda t: (t[1] - t[2]) * (t[1] - t[2]))) * 256 + b.e) AS m
  FROM parts x JOIN book{i} b ON x.p = b.p GROUP BY x.r, x.p)"""
    for i in range(rounds):
        steps.append(near.format(i=i))
        steps.append(f"""book{i + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(s.v, b.v) AS v FROM book{i} b LEFT JOIN (
    SELECT p, e, list((total - ((total % n) + n) % n) // n ORDER BY i) AS v FROM (
      SELECT x.p, y.m % 256 AS e, x.i, sum(x.c) AS total, count(*) AS n
      FROM (SELECT r, p, unnest(v) AS c, unnest(range(len(v))) AS i FROM parts) x JOIN near{i} y ON x.r = y.r AND x.p = y.p
      GROUP BY x.p, y.m % 256, x.i) GROUP BY p, e) s ON b.p = s.p AND b.e = s.e)""")
    steps.append(near.format(i=rounds))
    steps.append(f"""coded AS MATERIALIZED (
  SELECT r, string_agg(printf('%02x', CAST(m % 256 AS BIGINT)), '' ORDER BY p) AS code, CAST(sum(m // 256) AS BIGINT) AS error
  FROM near{rounds} GROUP BY r),
digest AS MATERIALIZED (
  SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds})
SELECT k.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error, d.codebooks_sha256
FROM kept k JOIN coded c ON k.r = c.r CROSS JOIN digest d""")
    return ",\n".join(steps)
