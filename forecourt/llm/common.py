"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.session import ensure_checkpoint_dir

#: Stands for a null id wherever ids are ordered or joined: smaller than any id.
NULL_ID = -(2 ** 63)

#: Rows of one Arrow batch.  Texts may be long, so batches are kept small.
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def small_batches(spark: SparkSession) -> None:
    """Bounds the rows of an Arrow batch, whatever the session had before."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes a table to the shared folder of ``spark.checkpoint.dir`` and reads
    it back: cuts the lineage, and every later reader starts from the files."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_key(doc_id: str = "doc_id", text: str = "text"):
    """Identity of a row: rows that repeat a doc_id with another text stay apart,
    rows equal in both are one."""
    return F.xxhash64(F.col(doc_id), F.col(text))


def ordered_id(doc_id: str = "doc_id"):
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID))


def copies(df: DataFrame, count: str, number: str, piece: int = 4096) -> DataFrame:
    """A row for each of ``count`` (1 or more) copies of a row, ``number`` counting them from 0.
    They are made in pieces that are dealt out first, so no task makes all copies of one row."""
    part = f"{number}_piece"
    pieces = df.withColumn(part, F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"({count} - 1) div {piece}"))))
    dealt = pieces.repartition(shuffle_width(df.sparkSession), *df.columns, part)
    last = F.least(F.col(part) * piece + piece, F.col(count)) - 1
    return dealt.withColumn(number, F.explode(F.sequence(F.col(part) * piece, last))).drop(part)


def shuffle_width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = 4 << 20):
    """Cuts an Arrow batch into row ranges whose text stays near ``max_bytes``
    (one longer text is a range of its own)."""
    col = batch.column(column)
    lengths = np.asarray(pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False),
                         dtype=np.int64)
    start, total = 0, 0
    for i, n in enumerate(lengths):
        if i > start and total + n > max_bytes:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(n)
    if start < batch.num_rows:
        yield batch.slice(start)


def texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """UTF-8 bytes of a text column, null as empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def aside(df: DataFrame, *names: str) -> tuple[DataFrame, dict[str, str]]:
    """Renames the columns an operator would replace; ``restored`` names them back."""
    own = {f"__own_{n}": n for n in names if n in df.columns}
    return df.withColumnsRenamed({n: k for k, n in own.items()}), own


def restored(df: DataFrame, own: dict[str, str], columns: list[str]) -> DataFrame:
    return df.drop(*own.values()).withColumnsRenamed(own).select(*columns)
