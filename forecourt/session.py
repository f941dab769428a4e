"""Session helpers: one place for the confs every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Confs that matter for correctness (UTC, ANSI) and scale (AQE, skew joins,
# partition sizing).  Shuffle partitions default to the local core count for
# tests; on a cluster the caller passes the cluster's own value and AQE
# coalesces small partitions at runtime.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build(master: str | None = None, shuffle_partitions: int | None = None,
          app: str = "forecourt", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in
    ``spark.checkpoint.dir``.  Only a local session without the setting gets a
    scratch folder; on a cluster a missing setting is an error, since a folder
    of one machine would be read by none of the others."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="forecourt-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_table_path(spark: SparkSession, name: str) -> str:
    """A location under the shared checkpoint folder for written tables that
    cut lineage (never a machine-local folder on a cluster)."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tables", name)


def materialize(df, how: str = "persist"):
    """Materialise an intermediate that several branches of a plan read
    (group statistics joined back, several grains...), so the upstream scan
    and joins run once instead of once per branch.

    'persist' (default) keeps it in executor memory / local disk; a lost
    partition is recomputed from lineage.  'checkpoint' writes it to the
    shared checkpoint folder and cuts the lineage: used where the base is an
    expensive derivation (multi-way joins, tokenised whole texts) whose
    recomputation after an executor loss would be costly.  'table' does so as
    Parquet there, for wide bases: compressed, and a branch reads its columns only."""
    from pyspark import StorageLevel
    if how == "persist":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    if how == "table":
        path = scratch_table_path(df.sparkSession, f"kept_{uuid.uuid4().hex}")
        df.write.parquet(path)
        return df.sparkSession.read.parquet(path)
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def discard(df) -> None:
    """Deletes the scratch table that ``df``, as 'table' of ``materialize`` gave it, reads: what was made
    of it is stored, and nothing reads it again."""
    path = next(iter(df.inputFiles()), "").rsplit("/", 1)[0]
    if "/tables/kept_" in path:
        at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


def free_shuffles(spark: SparkSession) -> None:
    """Spark deletes the shuffle files nothing refers to when the driver's JVM collects, which it does
    rarely by itself; called between large steps of a job."""
    spark._jvm.System.gc()


def few_rows(spark: SparkSession, rows: list[tuple], schema: str):
    """Result ``rows`` of the driver as a frame.  They go to the JVM as Arrow; ``createDataFrame`` of a list
    deals them out as a Python RDD, for which every executor core starts a Python worker."""
    import pyarrow as pa
    from pyspark.sql.types import StructType
    columns = {f: [r[i] for r in rows] for i, f in enumerate(StructType.fromDDL(schema).names)}
    return spark.createDataFrame(pa.table(columns), schema)


def stored_small(df, rows: int = 100_000):
    """``df`` stored once, marked for broadcast if it has at most ``rows`` rows: a join with it then
    never shuffles the other side."""
    from pyspark.sql import functions as F
    df = materialize(df, "checkpoint")
    return F.broadcast(df) if df.count() <= rows else df


def small(df, rows: int = 100_000):
    """``df`` marked for broadcast if it has at most ``rows`` rows; otherwise as it is, and
    the join shuffles.  Reads no more than ``rows`` + 1 rows to tell."""
    from pyspark.sql import functions as F
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
