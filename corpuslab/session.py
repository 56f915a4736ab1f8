"""Session helpers: local sessions for tests/bench and the shared scratch
folder (``spark.checkpoint.dir``) used to cut lineage."""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "corpuslab") -> SparkSession:
    """A local session for tests and the benchmark (never used by the library
    itself: library code receives the caller's session)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must be given (a folder every executor sees).
    Only a local-mode session without the setting gets a private temp folder,
    as in tests."""
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        try:
            path = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # unset
            path = None
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        path = tempfile.mkdtemp(prefix="corpuslab-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", path)
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A per-application folder under the checkpoint dir for written tables."""
    base = checkpoint_dir(spark)
    app = spark.sparkContext.applicationId
    key = hashlib.sha1("/".join(parts).encode()).hexdigest()[:12]
    return os.path.join(base, "corpuslab", app, f"{parts[-1]}-{key}")


_MATERIALIZED: dict = {}


def let_go(spark: SparkSession) -> None:
    """Has Spark delete the shuffle files of plans that have ended. Its
    cleaner waits for the driver's JVM to collect them, which a driver with
    free memory may not do before the disk is full."""
    spark.sparkContext._jvm.System.gc()


def materialize(df, *key: str):
    """Write ``df`` once per application as Parquet in the shared scratch
    folder and read it back: cuts lineage (later actions do not recompute
    it), survives executor loss, keeps column pruning."""
    spark = df.sparkSession
    k = (spark.sparkContext.applicationId,) + key
    if k not in _MATERIALIZED:
        path = scratch_path(spark, *key)
        df.write.mode("overwrite").parquet(path)
        let_go(spark)
        _MATERIALIZED[k] = path
    return spark.read.parquet(_MATERIALIZED[k])


def materialized(spark: SparkSession, *key: str) -> bool:
    """Whether ``materialize`` has written a table of that name."""
    return (spark.sparkContext.applicationId,) + key in _MATERIALIZED


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is something at ``path`` in the file system it names."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def saved(df, name: str):
    """``df`` written as Parquet to a new folder of the shared scratch space
    and read back: a lineage cut for tables that are read more than once."""
    path = scratch_path(df.sparkSession, uuid.uuid4().hex, name)
    df.write.parquet(path)
    let_go(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)
