"""Operator 5, token-id output: shards with a minimal perfect hash index.

Documents are range partitioned and sorted by id, encoded, and written as shards: one
Parquet row per shard with the raw id payload (little-endian, 16 bits where every id fits,
else 32), and an index that maps a document's key to its place in the payload. The index is a
minimal perfect hash (levels of bit arrays; a key's slot is the rank of its bit) with a
stored fingerprint, start and length per slot, so an access reads one bit and one slot
whatever the shard's size, and an unknown key is told by its fingerprint. The manifest
(shard, its first and last id, its ids before it) finds the shard.

Files are written and read by Spark, so any store that it knows will do, and a lost
executor only repeats its tasks.

Defined results: a null or empty text is its end id alone. Rows without an id are written
first and read by position, they have no key. Of rows that repeat an id the index names the
first of the shard and their number; all are written and read, ordered by a hash of the
text (equal texts are interchangeable). Extra columns are not read. An empty table gives no shards.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded, offsets, saved, slices
from .tokens import bpe_50k, encoder

MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
SHARD = ("part int, seq int, first_id bigint, last_id bigint, n_docs bigint, n_ids bigint, id_bytes int, keys binary, "
         "key_known binary, levels array<binary>, prints binary, slots binary, payload binary")


def hashed(keys: np.ndarray, seed: int) -> np.ndarray:
    """64 mixed bits of each key."""
    x = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * MIX[0]
    x = (x ^ (x >> np.uint64(27))) * MIX[1]
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Level by level, keys that are alone at their place of a bit array stay there and
    the others go on to the next level; a key's slot is the number of bits before its own."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.before = offsets(np.array([int(x.sum()) for x in levels], np.int64)) if levels else np.zeros(1, np.int64)
        self.ranks = [np.cumsum(x) - x for x in levels]

    @classmethod
    def build(cls, keys: np.ndarray, gamma: float = 1.5) -> PerfectHash:
        levels, left, seed = [], np.unique(keys), 1
        while len(left):
            size = max(2, int(gamma * len(left)))
            at = (hashed(left, seed) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            left = left[~alone[at]]
            seed += 1
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 where no level has a bit for it."""
        out = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        for level, bits in enumerate(self.levels):
            at = (hashed(keys[todo], level + 1) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            out[todo[hit]] = self.before[level] + self.ranks[level][at[hit]]
            todo = todo[~hit]
        return out

    def dump(self) -> list[bytes]:
        return [len(x).to_bytes(8, "little") + np.packbits(x).tobytes() for x in self.levels]

    @classmethod
    def load(cls, data: list[bytes]) -> PerfectHash:
        return cls([np.unpackbits(np.frombuffer(x, np.uint8, offset=8), count=int.from_bytes(x[:8], "little")).astype(bool) for x in data])


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (hashed(keys, 0) >> np.uint64(32)).astype(np.uint32)


def _shard(part: int, seq: int, keys: list, known: list, lens: list[int], ids: list[np.ndarray]) -> dict:
    keys_, known_ = np.array(keys, np.int64), np.array(known, bool)
    starts = offsets(np.array(lens, np.int64))
    named, first, times = np.unique(keys_[known_], return_index=True, return_counts=True)
    rows = np.flatnonzero(known_)[first]  # the first row of each key
    mph = PerfectHash.build(named)
    slots = mph.slots(named)
    prints = np.zeros(len(named), np.uint32)
    prints[slots] = fingerprints(named)
    place = np.zeros((len(named), 3), np.int64)  # row, start, rows of this key
    place[slots] = np.stack([rows, starts[rows], times], axis=1)
    flat = np.concatenate(ids)
    wide = len(flat) and int(flat.max()) > 0xFFFF
    return {"part": part, "seq": seq, "first_id": int(named[0]) if len(named) else None, "last_id": int(named[-1]) if len(named) else None,
            "n_docs": len(keys), "n_ids": len(flat), "id_bytes": 4 if wide else 2, "keys": keys_.tobytes() + starts.tobytes(), "key_known": known_.tobytes(),
            "levels": mph.dump(), "prints": prints.tobytes(), "slots": place.tobytes(), "payload": flat.astype("<u4" if wide else "<u2").tobytes()}


_ARROW = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("first_id", pa.int64()), ("last_id", pa.int64()), ("n_docs", pa.int64()),
                    ("n_ids", pa.int64()), ("id_bytes", pa.int32()), ("keys", pa.binary()), ("key_known", pa.binary()),
                    ("levels", pa.list_(pa.binary())), ("prints", pa.binary()), ("slots", pa.binary()), ("payload", pa.binary())])


def _shards(path: str, end_id: int, shard_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        encode = encoder(path).encode
        keys: list = []
        known: list = []
        lens: list = []
        ids: list = []
        held = 0
        for b in batches:
            docs = b.column("doc_id").to_pylist()
            for first, texts in slices(b, "text", 4 << 20):
                flat, ends = encode(texts)
                for k in range(len(texts)):
                    doc, own = docs[first + k], np.append(flat[ends[k]:ends[k + 1]], np.uint32(end_id))
                    keys.append(doc or 0)
                    known.append(doc is not None)
                    lens.append(len(own))
                    ids.append(own)
                    held += len(own)
                    if held >= shard_ids:
                        yield pa.RecordBatch.from_pylist([_shard(part, seq, keys, known, lens, ids)], schema=_ARROW)
                        keys, known, lens, ids, held, seq = [], [], [], [], 0, seq + 1
        if keys:
            yield pa.RecordBatch.from_pylist([_shard(part, seq, keys, known, lens, ids)], schema=_ARROW)

    return run


def write(docs: DataFrame, folder: str, path: str | None = None, end_id: int = 0, shard_ids: int = 1 << 20) -> None:
    """Writes the shards of ``docs`` in ascending order of doc_id."""
    rows = bounded(docs).select(F.col("doc_id").cast("bigint"), F.col("text"), F.xxhash64("text").alias("h"))
    rows = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text")
    rows.mapInArrow(_shards(path or bpe_50k(), end_id, shard_ids), SHARD).write.parquet(folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """part, seq, first_id, last_id, n_docs, n_ids, start (ids of all shards before)."""
    shards = spark.read.schema(SHARD).parquet(folder).select("part", "seq", "first_id", "last_id", "n_docs", "n_ids")
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))  # a row per task of the writer
    parts = parts.withColumn("part_start", F.sum("part_ids").over(Window.orderBy("part")) - F.col("part_ids")).drop("part_ids")
    within = F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_ids")
    return shards.withColumn("within", within).join(parts, "part").withColumn("start", F.col("part_start") + F.col("within")).drop("within", "part_start")


def _located(shard: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """keys, known, starts (one more) of a shard's rows, and the row that the index gives for each key."""
    n = shard["n_docs"]
    both = np.frombuffer(shard["keys"], np.int64)
    keys, starts = both[:n], both[n:]
    known = np.frombuffer(shard["key_known"], bool)
    rows = np.arange(n)
    rows[known] = lookup(shard, keys[known])[0]
    return keys, known, starts, rows


def lookup(shard: dict, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each key its first row in the shard (-1: not there), where its ids start, its number of rows."""
    place = np.frombuffer(shard["slots"], np.int64).reshape(-1, 3)
    prints = np.frombuffer(shard["prints"], np.uint32)
    slots = PerfectHash.load(shard["levels"]).slots(keys)
    found = slots >= 0
    found[found] = prints[slots[found]] == fingerprints(keys[found])
    out = np.tile(np.array([-1, -1, 0], np.int64), (len(keys), 1))
    out[found] = place[slots[found]]
    return out[:, 0], out[:, 1], out[:, 2]


def _read(batches: Iterator[pa.RecordBatch], with_ids: bool) -> Iterator[pa.RecordBatch]:
    """Each row by its key through the index; rows that repeat a key or have none by their place after it."""
    for b in batches:
        for shard in b.to_pylist():
            keys, known, starts, first = _located(shard)
            payload = np.frombuffer(shard["payload"], "<u4" if shard["id_bytes"] == 4 else "<u2")
            n = len(keys)
            begin = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]])) if n else np.zeros(0, int)
            nth = np.arange(n) - np.repeat(begin, np.diff(np.append(begin, n)))  # 0 but for repeated keys
            row = first + nth
            if (first < 0).any() or not (row == np.arange(n)).all():
                raise RuntimeError("the index does not match the shard")
            a, z = starts[row], starts[row + 1]
            wide = payload.astype("<u4")
            crc = [zlib.crc32(wide[i:j].data) for i, j in zip(a.tolist(), z.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, shard["part"], np.int32)), pa.array(np.full(n, shard["seq"], np.int32)),
                 pa.array(keys, mask=~known), pa.array(a), pa.array(z - a), pa.array(crc, pa.int64()),
                 pa.array([wide[i:j].tobytes() if with_ids else None for i, j in zip(a.tolist(), z.tolist())], pa.binary())],
                names=["part", "seq", "doc_id", "at", "n_tokens", "ids_crc32", "ids"])


def read(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32, ids of every row written."""
    shards = spark.read.schema(SHARD).parquet(folder)
    rows = shards.mapInArrow(lambda batches: _read(batches, with_ids), "part int, seq int, doc_id bigint, at bigint, n_tokens bigint, ids_crc32 bigint, ids binary")
    starts = manifest(spark, folder).select("part", "seq", F.col("start").alias("shard_start"))
    return rows.join(starts, ["part", "seq"]).select("doc_id", (F.col("shard_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", "ids")


def fetch(spark: SparkSession, folder: str, keys: DataFrame) -> DataFrame:
    """doc_id, ids of the first row of each asked key (``keys``: doc_id), by keyed access.

    Keys go to shards by the manifest's ranges: shard and key rows are sorted together and
    each key takes the last shard that begins at or before it."""
    shards = spark.read.schema(SHARD).parquet(folder)
    zones = manifest(spark, folder).filter("first_id IS NOT NULL").groupBy("first_id").agg(F.min(F.struct("part", "seq")).alias("s"))
    step = 1 << 20
    span = zones.agg(F.min("first_id").alias("lo")).first()["lo"]
    if span is None:
        return spark.createDataFrame([], "doc_id bigint, ids binary")
    both = (keys.select(F.col("doc_id").alias("k"), F.lit(1).alias("kind")).distinct()
            .unionByName(zones.select(F.col("first_id").alias("k"), F.lit(0).alias("kind"), "s"), allowMissingColumns=True))
    zone = F.floor(F.col("k") / step)
    last = both.groupBy(zone.alias("z")).agg(F.max(F.when(F.col("kind") == 0, F.struct("k", "s"))).alias("m"))
    carried = last.select("z", F.last("m", ignorenulls=True).over(Window.orderBy("z").rowsBetween(Window.unboundedPreceding, -1)).alias("carry"))
    own = Window.partitionBy("z").orderBy("k", "kind").rowsBetween(Window.unboundedPreceding, 0)
    placed = (both.withColumn("z", zone).withColumn("near", F.last("s", ignorenulls=True).over(own)).join(carried, "z")
              .filter("kind = 1").select(F.col("k").alias("doc_id"), F.coalesce("near", "carry.s").alias("s")).filter("s IS NOT NULL"))
    asked = saved(placed.select("s.part", "s.seq", "doc_id"), "asked")
    shards = shards.join(asked.select("part", "seq").distinct(), ["part", "seq"], "left_semi")  # no other shard is shuffled

    def one(key, left, right):
        wanted = left.column("doc_id").to_numpy()
        out = []
        for shard in right.to_pylist():
            row, start, _ = lookup(shard, wanted)
            n = shard["n_docs"]
            ends = np.frombuffer(shard["keys"], np.int64)[n:]
            payload = np.frombuffer(shard["payload"], "<u4" if shard["id_bytes"] == 4 else "<u2").astype("<u4")
            out += [(int(k), payload[s:ends[r + 1]].tobytes()) for k, r, s in zip(wanted, row, start) if r >= 0]
        return pa.table({"doc_id": pa.array([x[0] for x in out], pa.int64()), "ids": pa.array([x[1] for x in out], pa.binary())})

    return asked.groupBy("part", "seq").cogroup(shards.groupBy("part", "seq")).applyInArrow(one, "doc_id bigint, ids binary")
