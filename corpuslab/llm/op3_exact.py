"""Operator 3, exact dedup: skew-safe combining, native.

Texts are equal when identical after each run of ASCII white space becomes one space. The
digest and the full normalised text together are the grouping key at every stage, so two
texts are never joined by their digests alone:

1. locally: partial aggregation within a scan partition keeps one row per distinct text;
2. salted groups: (digest, text, salt of the partition) merges across partitions;
3. globally: (digest, text) combines the salt winners.

Hot groups shrink at 1 and meet at 3 in at most ``salts`` rows. The winners (without text)
are written, and documents look up theirs by digest in a sort-merge join whose hot
partitions adaptive execution can split. Should a digest ever stand for two texts, that
lookup compares the full texts instead.

Defined results: a null text counts as empty. Of equal texts the smallest doc_id stays
(nulls last: a group without ids has keep_id null and is kept). Rows that repeat both id
and text are one document, flagged alike by ``groups`` and reduced to one row by
``distinct_documents``. Extra columns are not read by ``groups``. Empty in, empty out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved

SPACES = r"[\x20\x09-\x0D]+"


def normalised(text: str = "text") -> Column:
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), SPACES, " ")


def sha256(col: Column) -> Column:
    return F.unhex(F.sha2(col, 256))


def winners(docs: DataFrame, digest=sha256, salts: int = 16) -> DataFrame:
    """digest, norm, keep_id, group_size for each distinct text."""
    rows = (docs.select("doc_id", normalised().alias("norm"))
            .select("doc_id", "norm", digest(F.col("norm")).alias("digest"),
                    F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt")))
    salted = rows.groupBy("digest", "norm", "salt").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    return salted.groupBy("digest", "norm").agg(F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))


def _looked_up(docs: DataFrame, digest, salts: int):
    """The written winners, the columns to join on, and documents with those columns."""
    found = winners(docs, digest, salts)
    kept = saved(found.drop("norm"), "exact-winners")
    clash = kept.groupBy("digest").count().filter("count > 1").limit(1).count() > 0
    keys = ["digest", "norm"] if clash else ["digest"]
    return (found if clash else kept), keys


def groups(docs: DataFrame, digest=sha256, salts: int = 16) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row."""
    kept, keys = _looked_up(docs, digest, salts)
    rows = docs.select("doc_id", normalised().alias("norm"))
    rows = rows.select("doc_id", *(["norm"] if "norm" in keys else []), digest(F.col("norm")).alias("digest"),
                       F.sha2("norm", 256).alias("text_sha256"))
    return rows.join(kept, keys).select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def distinct_documents(docs: DataFrame, digest=sha256, salts: int = 16) -> DataFrame:
    """One document of each group of equal texts, with all its columns."""
    kept, keys = _looked_up(docs, digest, salts)
    kept = kept.select(*[F.col(k).alias(f"__keep_{k}") for k in keys], F.col("keep_id").alias("__keep_id"))
    rows = docs.withColumn("__norm", normalised()).withColumn("__digest", digest(F.col("__norm")))
    same = (F.col("__digest") == F.col("__keep_digest")) & F.col("doc_id").eqNullSafe(F.col("__keep_id"))
    if "norm" in keys:
        same &= F.col("__norm") == F.col("__keep_norm")
    else:
        rows = rows.drop("__norm")
    stay = rows.join(kept, same, "left_semi")
    own = ["__digest", "doc_id"] + (["__norm"] if "norm" in keys else [])
    return stay.dropDuplicates(own).select(*docs.columns)


SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
FROM n WINDOW g AS (PARTITION BY norm)
"""
