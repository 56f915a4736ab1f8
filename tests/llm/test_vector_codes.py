"""Operators 11 and 12 against plain loops in Python integers, on awkward tables."""

import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pytest

from corpuslab.llm import op11_codes, op12_centroids
from corpuslab.llm.vectors import bound

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def rows_of(dims: int, n: int = 70, seed: int = 5) -> list[tuple]:
    rng = random.Random(seed)
    rows = [(100 + i, [round(rng.gauss(0, 1), 2) for _ in range(dims)], rng.choice([0, 1, 1, None])) for i in range(n)]
    rows += [(i, [0.5] * dims, 7) for i in (3, 4, 5)]  # equal vectors, ties everywhere
    rows += [rows[0], rows[0], (None, [0.25] * dims, None)]
    rows += [(900, None, 1), (901, [None] + [0.0] * (dims - 1), 1), (902, [float("nan")] * dims, 1), (903, [float("-inf")] + [0.0] * (dims - 1), None)]
    return rows


def ints(v, scale):
    return [math.floor(Fraction(float(np.float32(x))) * scale) for x in v]


def kept(rows, scale):
    good = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v)
    return [(i, ints(v, scale), lab) for i, v, lab in rows if good(v)]


def far(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b))


def nearest(v, entries):
    return min((far(v, e), k) for k, e in enumerate(entries))


def brute_codes(rows, parts=8, entries=16, rounds=6):
    rows = kept(rows, 4096)
    width = max(1, -(-max((len(v) for _, v, _ in rows), default=0) // parts))
    rows = [(i, v + [0] * (parts * width - len(v)), lab) for i, v, lab in rows]
    cut = lambda v, p: v[p * width:(p + 1) * width]
    seeds = sorted((i, v) for i, v, _ in rows if i is not None)[:entries]
    books = [[cut(v, p) for _, v in seeds] or [[0] * width] for p in range(parts)]
    for _ in range(rounds):
        for p in range(parts):
            of = [nearest(cut(v, p), books[p])[1] for _, v, _ in rows]
            for e in range(len(books[p])):
                mine = [cut(v, p) for (_, v, _), x in zip(rows, of) if x == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    out = []
    for i, v, lab in rows:
        best = [nearest(cut(v, p), books[p]) for p in range(parts)]
        out.append((i, lab, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best)))
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    label = {}
    for _, lab, _, err in out:
        label[lab] = label.get(lab, 0) + err
    return sorted((repr((i, c, e, label[lab], digest)) for i, lab, c, e in out))


def brute_centroids(rows, k=8, rounds=10, dims=64):
    rows = [(i, v) for i, v, _ in kept(rows, 1024) if len(v) == dims]
    first = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in rows if i is not None)[:k]
    cents = [v for _, v in first] or [[0] * dims]
    for _ in range(rounds):
        of = [nearest(v, cents)[1] for _, v in rows]
        for c in range(len(cents)):
            mine = [v for (_, v), x in zip(rows, of) if x == c]
            if mine:
                cents[c] = [sum(x) // len(mine) for x in zip(*mine)]
    best = [(i, *nearest(v, cents)) for i, v in rows]
    total = {}
    for _, d, c in best:
        total[c] = total.get(c, 0) + d
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted(repr((i, c, d, total[c], sum(total.values()), digests[c])) for i, d, c in best)


def codes(spark, rows):
    got = op11_codes.with_errors(*op11_codes.encode(spark.createDataFrame(rows, SCHEMA)))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted(repr(tuple(r)) for r in got.collect())


@pytest.mark.parametrize("dims", [16, 24])
def test_codes_equal_brute_force(spark, dims):
    rows = rows_of(dims)
    assert codes(spark, rows) == brute_codes(rows)


def test_codes_of_ragged_and_few_vectors(spark):
    rows = [(1, [0.1, -0.2, 3.0], None), (2, [], None), (2, [1.0] * 17, 4), (None, [2.0], 4)]
    assert codes(spark, rows) == brute_codes(rows)
    assert codes(spark, []) == []
    assert codes(spark, [(None, [1.0] * 8, 1)]) == brute_codes([(None, [1.0] * 8, 1)])
    assert codes(spark, [(1, None, 1)]) == []


def test_extra_columns_with_clashing_names(spark):
    from pyspark.sql import functions as F

    rows = rows_of(16, 20)
    df = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit(i).alias(c) for i, c in enumerate(("id", "v", "code", "error", "n", "sums", "of_label"))])
    got = op11_codes.with_errors(*op11_codes.encode(df)).collect()
    assert sorted(repr(tuple(r)) for r in got) == brute_codes(rows)
    df = df.withColumn("cluster", F.lit(1)).withColumn("distance", F.lit("x"))
    got = op12_centroids.with_inertia(*op12_centroids.cluster(df, dims=16)).collect()
    assert sorted(repr(tuple(r)) for r in got) == brute_centroids(rows, dims=16)


def test_centroids_equal_brute_force(spark):
    rows = rows_of(64, 90) + [(950, [1.0] * 63, 1), (951, [1.0] * 65, 1), (952, [], 1)]
    got = op12_centroids.with_inertia(*op12_centroids.cluster(spark.createDataFrame(rows, SCHEMA)))
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute_centroids(rows)


def test_few_and_no_vectors(spark):
    for rows in ([], [(1, None, 1)], [(5, [0.5] * 64, 1)], [(None, [0.5] * 64, 1)], [(5, [0.5] * 64, 1)] * 3):
        got = op12_centroids.with_inertia(*op12_centroids.cluster(spark.createDataFrame(rows, SCHEMA))).collect()
        assert sorted(repr(tuple(r)) for r in got) == brute_centroids(rows)


def test_transform_keeps_distances():
    rng = np.random.default_rng(3)
    for width in (1, 2, 3, 5, 8, 13, 16):
        x, y = rng.integers(-5000, 5000, (2, 50, width))
        size = op11_codes.power_of_two(width)
        a, b = op11_codes.transform(x), op11_codes.transform(y)
        assert (((a - b) ** 2).sum(axis=1) == size * ((x - y) ** 2).sum(axis=1)).all()
        rows = op11_codes.transform(np.eye(size, dtype=np.int64)).T
        assert [(r[1:] != r[:-1]).sum() for r in rows] == list(range(size))  # sequency order


def test_early_elimination_is_exact():
    rng = np.random.default_rng(4)
    for width in (1, 6, 8):
        x, e = rng.integers(-40, 40, (500, width)), rng.integers(-40, 40, (16, width))
        e[9] = e[2]
        index, dist = op11_codes.nearest(op11_codes.transform(x), op11_codes.transform(e))
        want = ((x[:, None] - e[None]) ** 2).sum(axis=2)
        assert (index == want.argmin(axis=1)).all() and (dist == op11_codes.power_of_two(width) * want.min(axis=1)).all()


def test_threshold_walk_is_exact_and_stops_early():
    rng = np.random.default_rng(5)
    for k, dims in ((1, 3), (8, 2), (50, 3), (8, 64)):
        c = rng.integers(-1000, 1000, (k, dims))
        if k > 3:
            c[k - 1] = c[1]
        x = np.concatenate([rng.integers(-1200, 1200, (300, dims)), c])
        taken = []
        index, dist = op12_centroids.nearest(x, c, taken.append)
        want = ((x[:, None] - c[None]) ** 2).sum(axis=2)
        assert (index == want.argmin(axis=1)).all() and (dist == want.min(axis=1)).all()
        if (k, dims) == (50, 3):
            assert sum(taken) < 0.5 * len(x) * k


def test_large_components_stay_in_64_bits():
    most = bound(64)
    x = np.full((2, 64), most, np.int64)
    x[1] = -most
    assert op12_centroids.nearest(x, x[::-1].copy())[1].tolist() == [0, 0]
    assert op12_centroids.nearest(x[:1], x[1:])[1].tolist() == [64 * (2 * most) ** 2]
    coder = op11_codes.Coder(x[1:].reshape(8, 1, 8))
    assert sum(int(far[0]) for *_, far in coder.assign(x[:1])) == 64 * (2 * most) ** 2
