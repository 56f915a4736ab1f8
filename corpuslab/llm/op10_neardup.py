"""Operator 10, MinHash near-dedup with tensored banding.

Two collections of ``m`` short hashes, each of ``r`` minhash values, are computed; the
table keys are all m x m pairs of one hash from either collection. So m * m tables of 2r
values each need only 2 m r minhash values.

Documents with the same shingle set form a class at once (grouping by the digest of the
whole sorted set, with partial aggregation), so exact copies never meet in a table. Class
representatives that share a key are candidates. Within a key, members are compared in
rounds: one member with all others, then ``pivots``, its square and so on of those left (those that share
keys with the most others first, so that the text which copies were made from soon meets
them all), until all pairs of members that are not already in one component have been met.
Groups of near copies join after the first round and drop out, so their pairs are never
expanded; no member, partner or bucket is capped. After the first round a pair meets only in
the first table of all that it shares, so two near copies make one row instead of one a table.

Pairs that are not alike enough are left out inside the join by an odd sketch: bit i of it
is the parity of the number of shingles in bin i of 1024. Each shingle that only one of two
sets has flips one bit, so the bits in which two sketches differ are never more than the
size of the symmetric difference, and no linked pair is lost. All pairs left are confirmed on
the full sets. ``floor``, off by default, leaves out pairs before whose signatures agree in a
smaller share of their values (0.6 is four standard deviations below 0.8): for corpora of
texts much longer than the sketch.

With the defaults (m = 10, r = 3) a pair at a similarity of 0.8 is missed by all tables
with a chance of 2 (1 - 0.8^3)^10 = 0.0015, at 0.85 of 0.0001.

Classes, sets, links and labels are keyed by a number given to each distinct shingle set, and
components are named by their smallest doc_id at the end. Defined results: null and empty
texts and texts without words have an empty set and are linked with nothing; rows without an
id are linked with nothing, have no component and are kept; rows that repeat an id with other
texts have the component of their own text each; rows that repeat the smallest id of a
component, with texts of that component, are all kept. Texts of any length are read whole, in
Arrow batches bounded by bytes; a set takes 8 bytes a word. Extra columns are not read by
``components``; ``representatives`` carries them. Empty in, empty out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded, saved, slices, unused

ODD = [f"odd_{i}" for i in range(16)]
SKETCH = "doc_id bigint, n_shingles bigint, digest binary, signature binary"
WITH_SETS = f"{SKETCH}, shingles binary, " + ", ".join(f"{c} bigint" for c in ODD)
_P = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_set(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word windows; of all words if there are fewer than ``width``."""
    if not len(words):
        return np.zeros(0, np.uint64)
    if len(words) < width:
        h = np.full(1, len(words), np.uint64)
        for w in words:
            h = _mix(h * _P + w)
        return h
    h = np.zeros(len(words) - width + 1, np.uint64)
    for i in range(width):
        h = h * _P + words[i:len(words) - width + 1 + i]
    return np.unique(_mix(h))


def set_digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def seeds(n: int) -> tuple[np.ndarray, np.ndarray]:
    x = _mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * _P)
    return x[:n] | np.uint64(1), x[n:]


def signature(shingles: np.ndarray, mul: np.ndarray, add: np.ndarray) -> np.ndarray:
    """The minimum of each hash function over the set (32 bits each)."""
    out = np.full(len(mul), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 4096):
        out = np.minimum(out, (shingles[i:i + 4096, None] * mul[None, :] + add[None, :]).min(axis=0))
    return (out >> np.uint64(32)).astype(np.uint32)


def odd_sketch(shingles: np.ndarray) -> np.ndarray:
    """Parities of the numbers of shingles in 1024 bins, as 16 integers."""
    counts = np.bincount((shingles & np.uint64(1023)).astype(np.int64), minlength=1024)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def _sketched(width: int, n_hashes: int, with_sets: bool):
    mul, add = seeds(n_hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHashes()
        for b in batches:
            ids = b.column("doc_id")
            for first, texts in slices(b, "text"):
                if len(known) > 400_000:
                    known.clear()
                rows = []
                for t in texts:
                    words = t.encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z and ASCII white space only
                    s = shingle_set(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)), width)
                    rows.append((len(s), set_digest(s), signature(s, mul, add).tobytes(), *((s.tobytes(), odd_sketch(s)) if with_sets else ())))
                n, digest, sig, *more = zip(*rows)
                out = {"doc_id": ids.slice(first, len(texts)), "n_shingles": pa.array(n, pa.int64()), "digest": pa.array(digest, pa.binary()), "signature": pa.array(sig, pa.binary())}
                if with_sets:
                    out |= {"shingles": pa.array(more[0], pa.binary())} | dict(zip(ODD, map(pa.array, np.stack(more[1], axis=1))))
                yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    return run


def sketches(docs: DataFrame, width: int, n_hashes: int, with_sets: bool = False) -> DataFrame:
    return bounded(docs).select(F.col("doc_id").cast("bigint"), F.col("text")).mapInArrow(_sketched(width, n_hashes, with_sets), WITH_SETS if with_sets else SKETCH)


def _keys(m: int, r: int):
    """Table keys: a hash of collection A paired with a hash of collection B. The remainder by
    m * m is the number of the table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 2000):
                b = whole.slice(at, 2000)
                ids = b.column("id").to_numpy()
                sig = np.frombuffer(b"".join(b.column("signature").to_pylist()), np.uint32).reshape(len(ids), 2, m, r).astype(np.uint64)
                h = np.zeros(sig.shape[:3], np.uint64)
                for i in range(r):
                    h = _mix(h * _P + sig[..., i])
                table = np.arange(m * m, dtype=np.uint64).reshape(1, m, m)
                key = _mix((h[:, 0, :, None] * _P) ^ (h[:, 1, None, :] + table * _P)) >> np.uint64(2)
                key = key - key % np.uint64(m * m) + table
                yield pa.RecordBatch.from_arrays([pa.array(key.reshape(-1).view(np.int64)), pa.array(np.repeat(ids, m * m))], names=["key", "id"])
    return run


def _confirmed(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a, c = b.column("a"), b.column("b")
            ok = []
            for x, y in zip(b.column("set_a"), b.column("set_b")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                inter = int((both[1:] == both[:-1]).sum())
                ok.append(100 * inter >= percent * (len(x) + len(y) - inter))
            yield pa.RecordBatch.from_arrays([a.filter(pa.array(ok, pa.bool_())), c.filter(pa.array(ok, pa.bool_()))], names=["a", "b"])
    return run


def _alike(floor: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not len(b):
                continue
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint32).reshape(len(b), -1) for c in ("sig_a", "sig_b"))
            ok = pa.array((x == y).mean(axis=1) >= floor)
            yield pa.RecordBatch.from_arrays([b.column("a").filter(ok), b.column("b").filter(ok)], names=["a", "b"])
    return run


def propagate(links: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """id, comp: the smallest id that can be reached; ``labels``: what is known from fewer links.
    Each step takes the least label of the neighbours, then the label of that label."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    nodes = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("comp")).withColumnRenamed("a", "id")
    if labels is not None:
        old = labels.withColumnRenamed("comp", "old")
        nodes = nodes.join(old, "id", "left").select("id", F.least("comp", "old").alias("comp"))
    now, changed = saved(nodes, "labels"), True
    while changed:
        of_b = now.select(F.col("id").alias("b"), F.col("comp").alias("comp_b"))
        near = both.join(of_b, "b").groupBy(F.col("a").alias("id")).agg(F.min("comp_b").alias("near"))
        best = now.join(near, "id").select("id", F.col("comp").alias("was"), F.least("comp", "near").alias("comp"))
        target = now.select(F.col("id").alias("comp"), F.col("comp").alias("further"))
        after = saved(best.join(target, "comp", "left").select("id", "was", F.least("comp", "further").alias("comp")), "labels")
        changed = after.filter("comp <> was").limit(1).count() > 0
        now = after.select("id", "comp")
    return now


def shared(tables: DataFrame) -> DataFrame:
    """key, id, n: the rows whose key others have too, and how many have it. Keys are counted
    with partial aggregation and joined back (a hot key's rows are many on one side only, so
    adaptive execution can split them)."""
    sizes = saved(tables.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "sizes")
    return tables.join(sizes, "key").select("key", "id", "n")


def mixed(members: DataFrame) -> DataFrame:
    """Those of keys with members of more than one component. The keys are written first: a
    join can split a hot key only if both its sides come straight from a shuffle."""
    keys = members.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low <> high").select("key")
    return members.join(saved(keys, "mixed"), "key", "left_semi")


def ranks(members: DataFrame) -> DataFrame:
    """key, id, rank: 1, 2, .. within each key, ids that share keys with the most others first.
    Rows are dealt by ranges of (key, order), so a hot key lies in many pieces; each piece is
    numbered by itself. Only a key that goes on from an earlier piece has an offset, so there
    are fewer offsets than pieces."""
    order = [F.desc("hub"), F.asc("mix"), F.asc("id")]
    spark = members.sparkSession
    pieces = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    dealt = saved(members.select("key", "id", "hub", F.xxhash64("id").alias("mix")).repartitionByRange(pieces, F.asc("key"), *order)
                  .withColumn("piece", F.spark_partition_id()), "dealt")
    before = Window.partitionBy("key").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)  # a row a piece
    offsets = dealt.groupBy("key", "piece").agg(F.count("*").alias("n")).select("key", "piece", F.sum("n").over(before).alias("offset")).filter("offset > 0")
    local = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("key", "piece").orderBy(*order)))
    return local.join(F.broadcast(offsets), ["key", "piece"], "left").select("key", "id", (F.col("rank") + F.coalesce("offset", F.lit(0))).alias("rank"))


def _possible(x: str, y: str, percent: int):
    """Whether sizes and odd sketches (columns with these prefixes) allow the similarity. With d
    the size of the symmetric difference, 100 * intersection >= percent * union is the same as
    (100 + percent) * d <= (100 - percent) * (sum of the sizes)."""
    n_x, n_y = F.col(f"{x}n"), F.col(f"{y}n")
    most = (100 - percent) * (n_x + n_y)
    return ((100 + percent) * F.abs(n_x - n_y) <= most) & ((100 + percent) * differ(x, y) <= most)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int, floor: float) -> DataFrame:
    """Those of the pairs a, b that are links, by odd sketches, signatures and then the full sets."""
    for x in "ab":
        of = sets.select(F.col("id").alias(x), F.col("signature").alias(f"sig_{x}"), *(F.col(c).alias(f"{x}_{c}") for c in ("n", *ODD)))
        pairs = pairs.join(of, x)
    pairs = pairs.filter(_possible("a_", "b_", percent))
    if floor > 0:
        pairs = pairs.select("a", "b", "sig_a", "sig_b").mapInArrow(_alike(floor), "a bigint, b bigint")
    pairs = pairs.select("a", "b")
    for x in "ab":
        pairs = pairs.join(sets.select(F.col("id").alias(x), F.col("shingles").alias(f"set_{x}")), x)
    return saved(pairs.select("a", "b", "set_a", "set_b").mapInArrow(_confirmed(percent), "a bigint, b bigint").distinct(), "found")


def differ(x: str, y: str):
    """In how many bits the odd sketches (columns with these prefixes) differ."""
    return sum((F.bit_count(F.col(f"{x}{c}").bitwiseXOR(F.col(f"{y}{c}"))) for c in ODD[1:]), F.bit_count(F.col(f"{x}{ODD[0]}").bitwiseXOR(F.col(f"{y}{ODD[0]}"))))


def with_earlier(members: DataFrame, m: int, r: int) -> DataFrame:
    """``earlier`` in place of the signature: the short hashes of both collections, with their
    places, that come before those of the key's table. A pair that shares one of them, and the
    key, shares a table before this one."""
    short = lambda k: F.xxhash64(k, F.substring("signature", k * (4 * r) + 1, F.lit(4 * r)))
    table = F.pmod("key", F.lit(m * m)).cast("int")
    first = lambda start, n: F.slice("shorts", start, n)
    rows = members.withColumn("shorts", F.transform(F.sequence(F.lit(0), F.lit(2 * m - 1)), short))
    return rows.withColumn("earlier", F.concat(first(1, F.floor(table / m).cast("int")), first(m + 1, table % m))).drop("signature", "shorts")


def meetings(here: DataFrame, met: int, percent: int) -> DataFrame:
    """a, b: members of different components that share a key with one of its first ``met``
    members, each pair in the first table that it shares."""
    first = here.filter(F.col("rank") <= met).select("key", *(F.col(c).alias(f"p_{c}") for c in ("id", "rank", "comp", "earlier", "n", *ODD)))
    alike = (F.col("rank") > F.col("p_rank")) & (F.col("comp") != F.col("p_comp")) & _possible("", "p_", percent)
    return here.join(first, "key").filter(alike & ~F.arrays_overlap("earlier", "p_earlier")).select(F.least("id", "p_id").alias("a"), F.greatest("id", "p_id").alias("b"))


def sets_of(docs: DataFrame, classes: DataFrame, ids: DataFrame, width: int, n_hashes: int) -> DataFrame:
    """id, n, signature, shingles and odd sketch of the classes ``ids``, from the text of the row
    with the class's smallest id; other texts with that id have another digest and fall out."""
    wanted = saved(classes.join(ids, "id", "left_semi").select("id", "rep", "digest"), "wanted")
    texts = docs.select("doc_id", "text").join(wanted.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
    rows = sketches(texts, width, n_hashes, True).drop("doc_id").withColumnRenamed("n_shingles", "n")
    return saved(rows.join(wanted.select("id", "digest"), "digest").dropDuplicates(["digest"]).drop("digest"), "sets")


def linked(docs: DataFrame, classes: DataFrame, width: int, m: int, r: int, percent: int, floor: float, pivots: int) -> DataFrame | None:
    """id, comp of the classes with confirmed links; None if there are no links."""
    tables = classes.filter("rep IS NOT NULL").select("id", "signature").mapInArrow(_keys(m, r), "key bigint, id bigint")
    members = saved(shared(tables), "members")
    if members.isEmpty():
        return None
    hubs = saved(members.groupBy("id").agg(F.sum("n").alias("hub")), "hubs")  # how often an id meets others
    sets = sets_of(docs, classes, hubs.select("id"), width, 2 * m * r)
    # one order for all keys, so the text that others were made from is the pivot of all its keys
    ranked = saved(ranks(members.select("key", "id").join(hubs, "id")), "ranked")
    firsts = saved(ranked.filter("rank = 1").select("key", F.col("id").alias("pivot")), "pivots")
    with_pivot = ranked.filter("rank > 1").join(firsts, "key").select(F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b")).distinct()
    found = links = confirmed(with_pivot, sets, percent, floor)
    labels, met, left = None, 1, ranked
    while True:
        if not found.isEmpty():
            labels = propagate(links, labels)
        left = left.filter(F.col("rank") > met)  # those up to ``met`` have met all others
        here = left.withColumn("comp", F.col("id"))
        if labels is not None:
            here = saved(left.join(labels, "id", "left").select("key", "id", "rank", F.coalesce("comp", "id").alias("comp")), "labelled")
        here = saved(with_earlier(mixed(here).join(sets.select("id", "n", "signature", *ODD), "id"), m, r), "left")
        if here.isEmpty():
            return labels
        met *= pivots
        found = confirmed(meetings(here, met, percent).distinct(), sets, percent, floor)
        links = links.unionByName(found)
        left = here.select("key", "id", "rank")


def components(docs: DataFrame, width: int = 4, percent: int = 80, m: int = 10, r: int = 3, floor: float = 0.0,
               pivots: int = 512, digests: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row; with ``digests`` also the digest of
    the row's shingle set."""
    base = saved(sketches(docs, width, 2 * m * r), "sketches")
    # classes are numbered when they are written; two of them may have one smallest doc_id
    classes = saved(base.filter("n_shingles > 0").groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("signature").alias("signature"))
                    .withColumn("id", F.monotonically_increasing_id()), "classes")
    labels = linked(docs, classes, width, m, r, percent, floor, pivots)
    same = classes.select("digest", F.col("rep").alias("component"))
    if labels is not None:
        named = classes.select("digest", "id", "rep").join(labels, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
        named = saved(named, "named")
        same = named.join(named.groupBy("comp").agg(F.min("rep").alias("component")), "comp").select("digest", "component")
    rows = base.select("doc_id", "n_shingles", "digest").join(same, "digest", "left")
    alone = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
    rows = rows.withColumn("component_id", F.when(alone, F.col("doc_id")).otherwise(F.col("component")))
    kept = F.when(alone, True).otherwise(F.col("doc_id") == F.col("component_id"))
    return rows.select("doc_id", "n_shingles", "component_id", kept.alias("kept"), *(["digest"] if digests else []))


def _digests(width: int):
    def of_batch(texts: pa.Array) -> pa.Array:
        known = _WordHashes()
        out = []
        for t in texts:
            words = (t.as_py() or "").encode("utf-8", "surrogatepass").lower().split()
            out.append(set_digest(shingle_set(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)), width)))
        return pa.array(out, pa.binary())

    of_batch.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(of_batch, "binary")


def representatives(docs: DataFrame, width: int = 4, **options) -> DataFrame:
    """One document of each component, with all its columns. Rows go by their id; only where an
    id stands both on texts that stay and on texts that go, by id and text."""
    rows = components(docs, width=width, digests=True, **options).filter("doc_id IS NOT NULL")
    rows = saved(rows.select("doc_id", "kept", "digest").distinct(), "verdicts")
    ids = rows.groupBy("doc_id").agg(F.min("kept").alias("all_stay"), F.max("kept").alias("some_stay"))
    gone = saved(ids.filter("NOT all_stay"), "gone")
    torn = gone.filter("some_stay")
    mine = unused(docs, "of_id")
    stay = docs.join(gone.select(F.col("doc_id").alias(mine)), F.col("doc_id") == F.col(mine), "left_anti")
    if torn.isEmpty():
        return stay
    text = unused(docs, "of_text")
    both = docs.join(torn.select(F.col("doc_id").alias(mine)), F.col("doc_id") == F.col(mine), "left_semi").withColumn(text, _digests(width)(F.col("text")))
    good = rows.filter("kept").select(F.col("doc_id").alias(mine), F.col("digest").alias(f"{text}_"))
    part = both.join(good, (F.col("doc_id") == F.col(mine)) & (F.col(text) == F.col(f"{text}_")), "left_semi").drop(text)
    return stay.unionByName(part)
