"""Deterministic sampling, masking, balancing, shuffling and splitting.

Randomness is ``md5('seed:id')`` order (equal in Spark and DuckDB), never
``rand()``: results are reproducible across runs, partitionings and
executor losses, and every operator has a SQL oracle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import saved

MASK = T.MASK
FEW_ROWS = 1000  # rows sorted to find the last one of a cut
DIGITS = 3  # of the order key, counted a group to find the rows that may be among the first


def _hash(seed, key: Column, i: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string"), F.lit(":"), i.cast("string")))


def mask_tokens(df: DataFrame, x: float, seed=42, key: str = "sent_id",
                tokens_col: str = "tokens") -> DataFrame:
    """``mask_tokens_in_sentences``: the first ``mask_count`` positions in
    md5 order become ``[*]``. Done in-array (sort by hash, mark the first k,
    sort back by position), so no shuffle; no lambda refers to another
    computed array, so Catalyst cannot inline an O(n) expression into a
    per-element lambda. Adds ``masked`` and ``mask_pos`` (ascending)."""
    k = T.mask_count(F.size(tokens_col), x)
    keyed = F.transform(tokens_col, lambda t, i: F.struct(
        _hash(seed, F.col(key), i).alias("h"), i.alias("i"), t.alias("t")))
    marked = F.transform(F.array_sort(keyed), lambda s, j: F.struct(
        s["i"].alias("i"), F.when(j < k, F.lit(MASK)).otherwise(s["t"]).alias("t"),
        (j < k).alias("m")))
    back = F.array_sort(marked)
    return (df.withColumn("_mk", back)
            .withColumn("masked", F.transform("_mk", lambda s: s["t"]))
            .withColumn("mask_pos", F.transform(F.filter("_mk", lambda s: s["m"]), lambda s: s["i"]))
            .drop("_mk"))


def sample_n(df: DataFrame, n: int, seed=42, key: str = "sent_id", strict: bool = True) -> DataFrame:
    """First ``n`` rows in md5 order (TakeOrderedAndProject: each partition
    keeps its own top n, so nothing unbounded reaches one task). With
    ``strict`` too few rows is an error, as in the reference."""
    out = df.withColumn("_h", T.md5_order(seed, key)).orderBy("_h", key).limit(n).drop("_h")
    if strict and out.count() < n:
        raise ValueError("Sample larger than population")
    return out


def group_rank(df: DataFrame, by: list, order: list, name: str = "_rank") -> DataFrame:
    """Exact 1-based rank inside each group by ``order`` (ascending value
    expressions; negate a number for descending), without sorting a
    whole group in one task (a group may hold a third of all rows):

    1. range-partition on (group, order), sort each partition and write it
       with the place of every row, so a hot group is spread over many
       partitions in order (the only shuffle of the rows);
    2. count the rows of each (partition, group) piece and find its first
       place;
    3. a row's rank is its place less the first of its piece, and the sizes
       of the same group's earlier pieces. There are as many
       pieces as groups, and at most one more a partition.
    """
    spark = df.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    oc = [F.col(c) if isinstance(c, str) else c for c in order]
    keyed = df.select("*", *[c.alias(f"_o{i}") for i, c in enumerate(oc)])
    okeys = [f"_o{i}" for i in range(len(oc))]
    placed = keyed.repartitionByRange(n, *by, *okeys).sortWithinPartitions(*by, *okeys).drop(*okeys)
    # partition << 33 | place in it
    part = saved(placed.withColumn("_at", F.monotonically_increasing_id()).withColumn("_pid", F.shiftright("_at", 33)), "ranked")
    pieces = part.groupBy("_pid", *by).agg(F.count(F.lit(1)).alias("_c"), F.min("_at").alias("_first"))
    before = F.sum("_c").over(Window.partitionBy(*by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))
    pieces = pieces.withColumn("_off", F.coalesce(before, F.lit(0)) + 1 - F.col("_first"))
    same = F.col("_pid") == F.col("_gpid")
    for c in by:  # a null group has a rank too
        same = same & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    # written, so that its size is known before the join and the rows stay where they are
    pieces = saved(pieces.select(F.col("_pid").alias("_gpid"), *[F.col(c).alias(f"_g_{c}") for c in by], "_off"), "pieces")
    return (part.join(pieces, same).drop("_gpid", *[f"_g_{c}" for c in by])
            .withColumn(name, (F.col("_at") + F.col("_off")).cast("long"))
            .drop("_pid", "_at", "_off"))


def per_group_n(df: DataFrame, by: str, n, seed=42, key: str = "sent_id") -> DataFrame:
    """``n`` rows per group (``n`` an int or a Column such as the smallest
    class size): rank in md5 order <= n, ranked with ``group_rank``. With an
    int, counts of the first digits tell which rows may be among the first
    ``n``; the others are neither shuffled nor written."""
    lim = F.lit(n) if isinstance(n, int) else n
    h = T.md5_order(seed, key)
    if isinstance(n, int):
        digits = F.substring(h, 1, DIGITS)
        sizes = df.groupBy(by, digits.alias("_p")).agg(F.count(F.lit(1)).alias("_c"))
        before = F.sum("_c").over(Window.partitionBy(by).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))
        # rows of these digits have n rows of their group before them (a null key comes first)
        full = saved(sizes.withColumn("_b", before).filter(F.col("_b") >= n).groupBy(F.col(by).alias("_g")).agg(F.min("_p").alias("_cut")), "cuts")
        df = (df.join(full, F.col(by).eqNullSafe(F.col("_g")), "left")
              .filter(F.col("_cut").isNull() | digits.isNull() | (digits < F.col("_cut"))).drop("_g", "_cut"))
    r = group_rank(df, [by], [h, F.col(key)], "_r")
    return r.filter(F.col("_r") <= lim).drop("_r")


def balance(df: DataFrame, by: str = "class", seed=42, key: str = "sent_id") -> DataFrame:
    """``balance_classes``: every class down-sampled to the smallest class
    size (one aggregate gives the size; a scalar)."""
    sizes = df.groupBy(by).agg(F.count(F.lit(1)).alias("_n"))
    m = sizes.agg(F.min("_n")).first()[0] or 0
    return per_group_n(df, by, int(m), seed, key)


def shuffled(df: DataFrame, seed=42, key: str = "sent_id") -> DataFrame:
    """Seeded permutation: ``ord_key`` (md5) and a range-partitioned sort on
    it, so no single task sees all rows."""
    return df.withColumn("ord_key", T.md5_order(seed, key)).orderBy("ord_key", key)


def stratified_folds(df: DataFrame, label: str, k: int = 5, seed=42, key: str = "sent_id") -> DataFrame:
    """Fold 0..k-1 per row: each label's rows in md5 order dealt round-robin,
    so every fold holds ~1/k of every class (rank via ``group_rank``)."""
    r = group_rank(df, [label], [T.md5_order(seed, key), F.col(key)], "_r")
    return r.withColumn("fold", ((F.col("_r") - 1) % k).cast("int")).drop("_r")


def train_test(df: DataFrame, test_fraction: float = 0.2, seed=42, key: str = "sent_id") -> DataFrame:
    """Exact split: the first ceil(fraction * n) rows in (md5, key) order are
    ``is_test``. The cut is found by histograms of md5 prefixes (65,536
    counts a pass, then those of the prefix that holds the cut) until few
    rows share the prefix; no sort and no rank of the table. Rows that share
    a key are on the same side."""
    h = T.md5_order(seed, key)
    n = df.count()
    left = math.ceil(round(test_fraction * n, 9))
    if left <= 0 or left >= n:
        return df.withColumn("is_test", F.lit(left > 0))
    prefix, here = "", n
    while here > FEW_ROWS and len(prefix) < 32:
        part = df.select(h.alias("_h")).filter(F.col("_h").startswith(prefix))
        at = len(prefix)
        for r in sorted(part.groupBy(F.substring("_h", at + 1, 4).alias("p")).agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda r: r["p"]):
            if r["n"] >= left:
                prefix, here = prefix + r["p"], r["n"]
                break
            left -= r["n"]
    last = (df.select(h.alias("_h"), F.col(key).alias("_k")).filter(F.col("_h").startswith(prefix))
            .orderBy("_h", "_k").limit(left).agg(F.max(F.struct("_h", "_k")).alias("m")).first()["m"])
    kind = df.schema[key].dataType
    cut = F.struct(F.lit(last["_h"]).alias("_h"), F.lit(last["_k"]).cast(kind).alias("_k"))
    return df.withColumn("is_test", F.struct(h.alias("_h"), F.col(key).alias("_k")) <= cut)
