"""Helpers shared by the operators: scratch tables, Arrow maps, ragged arrays."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from corpuslab.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, which all executors share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read again: cuts the
    lineage and survives lost executors."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batch: pa.RecordBatch, column: str, size: int = 2 << 20) -> Iterator[tuple[int, list]]:
    """The texts of an Arrow batch (null: empty) in runs of about ``size`` characters,
    with the row at which each run starts. A longer text is a run of its own."""
    texts = batch.column(column).to_pylist()
    start, held = 0, 0
    run: list = []
    for t in texts:
        t = t or ""
        if run and held + len(t) > size:
            yield start, run
            start, run, held = start + len(run), [], 0
        run.append(t)
        held += len(t)
    if run:
        yield start, run


def ragged_index(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Positions starts[i] .. starts[i] + lens[i] - 1 of all i, one after the other."""
    ends = np.cumsum(lens)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lens), lens) + np.arange(total)


def offsets(lens: np.ndarray) -> np.ndarray:
    out = np.zeros(len(lens) + 1, np.int64)
    np.cumsum(lens, out=out[1:])
    return out


def unused(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that the table does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Bytes of an Arrow batch that Spark hands to Python, in place of Spark's own default.
BATCH, SPARK_BATCH = "4m", "67108864b"


def bounded(df: DataFrame) -> DataFrame:
    """The same table; the session's Arrow batches are bounded more tightly by bytes, as rows may
    hold very long texts. A bound that the user has set stays."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(key) == SPARK_BATCH:
        conf.set(key, BATCH)
    return df
