"""Integer vectors for the clustering operators: exact scaling, dense matrices of bounded
batches, and sums of clusters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ragged_index, saved

#: Rows of a dense matrix at once.
ROWS = 4096


def _scaled(scale: int, dims: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("v")
            lens = pc.fill_null(pc.list_value_length(lists), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            x = pc.fill_null(lists.flatten().cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
            held = np.maximum(lens, 0)
            at = np.concatenate([[0], np.cumsum(held)])
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(x))])
            ok = (lens >= 0) & (bad[at[1:]] == bad[at[:-1]]) & ((lens == dims) if dims is not None else True)
            with np.errstate(over="ignore", invalid="ignore"):
                ints = np.clip(np.floor(x * float(scale)), -2.0**62, 2.0**62)
            ints = np.where(np.isnan(ints), 0, ints).astype(np.int64)[ragged_index(at[:-1][ok], held[ok])]
            rows = b.filter(pa.array(ok, pa.bool_()))
            v = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(held[ok])]), pa.int32()), pa.array(ints))
            yield pa.RecordBatch.from_arrays([*(rows.column(i) for i in range(rows.num_columns - 1)), v], names=rows.schema.names)
    return run


def scaled(df: DataFrame, keep: dict, vector: str, scale: int, dims: int | None = None) -> DataFrame:
    """The columns ``keep`` (new name: old name) and v, the integers floor(scale * x) of the
    vector, written once. Rows whose vector is null or holds null or non-finite components go,
    with ``dims`` also those of another length."""
    rows = df.select(*(F.col(old).alias(new) for new, old in keep.items()), F.col(vector).alias("v"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return saved(rows.mapInArrow(_scaled(scale, dims), f"{kinds}, v array<bigint>"), "integers")


def bound(dims: int, spread: int = 1) -> int:
    """The largest size of a component with which the squared distance of two vectors, and
    ``spread`` times it, can't pass a 64-bit integer (2^27 at 64 dimensions)."""
    return 1 << ((62 - int(np.ceil(np.log2(max(2, dims, dims * spread))))) // 2 - 1)


def dense(b: pa.RecordBatch, dims: int, most: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Runs of a batch's rows with their matrix: shorter vectors are filled up with zeros,
    components beyond ``most`` are taken as ``most``."""
    for first in range(0, len(b), ROWS):
        part = b.slice(first, ROWS)
        lists = part.column("v")
        lens = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        out = np.zeros((len(part), dims), np.int64)
        out.reshape(-1)[ragged_index(np.arange(len(part)) * dims, lens)] = lists.flatten().to_numpy(zero_copy_only=False)
        yield part, np.clip(out, -most, most)


def summed(partial: DataFrame, keys: list[str], width: int) -> list[tuple[tuple, int, list[int]]]:
    """Keys, count and exact component sums of rows (keys, n, sums) that tasks have summed up
    before; there are few keys, whatever the input."""
    exact = "decimal(38,0)"
    rows = partial.groupBy(*keys).agg(F.sum("n").alias("n"), *(F.sum(F.col("sums")[i].cast(exact)).alias(f"s{i}") for i in range(width))).collect()
    return [(tuple(r[k] for k in keys), int(r["n"]), [int(r[f"s{i}"]) for i in range(width)]) for r in rows]
