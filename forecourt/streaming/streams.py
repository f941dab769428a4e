"""Structured Streaming operators (STM-*).

* ledger_stream (STM-01): incremental stock ledger.  Per part the state
  carries the running evolutions (sold, purchased, regulated) between
  arrivals (applyInPandasWithState, a call and a state row per hashed bucket
  of parts, not per part); each arrival emits one row per (part, movement day).  The state of a part that has not moved for ``idle``
  days ends by an event-time timer: it emits a closing row with its totals,
  and a later movement opens a new segment.  ``ledger_rows`` adds the totals
  of the closed segments, so the rows equal the batch ledger on those days.
* dedupe_stream (STM-02): union of previous and new results, first arrival
  wins per key (dropDuplicatesWithinWatermark).
* daily_counts_stream (STM-03): per-day counts of warning records with a
  watermark and tumbling windows; updates are written per batch and the
  final value per window is the latest written.

The input is a table of arrivals, written once and partitioned by the number
of the arrival.  Each arrival lands in the folder that the stream watches and
is one run of the query (``availableNow``), restarted from its checkpoint as a
daily job would be.  Sinks are Parquet in the shared checkpoint folder
(exactly-once with the checkpoint).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from forecourt.session import scratch_table_path

LEDGER_OUT = ("part long, day date, kind string, segment long, late boolean, qty_sold double, qty_purchased double, qty_regulated double, "
              "sales_evolution double, purchases_evolution double, regulated_evolution double, stock_qty double")
#: The state of a bucket of parts is one array of these rows, ordered by part; ``due`` is when a part's timer ends.
PART_STATE = np.dtype([("part", "<i8"), ("totals", "<f8", 3), ("stock_qty", "<f8"), ("last", "<i8"), ("segment", "<i8"), ("due", "<i8")])
LEDGER_STATE = "parts binary"
BUCKETS = 4096
FLOWS = ["qty_sold", "qty_purchased", "qty_regulated"]
EVOLUTIONS = ["sales_evolution", "purchases_evolution", "regulated_evolution"]
DAY_MS = 86_400_000


def staged(df: DataFrame, arrival: str, keys: list[str], name: str) -> DataFrame:
    """The arrivals as one table, written once and partitioned by the number
    of the arrival; an arrival's rows are dealt over tasks by ``keys``."""
    path = scratch_table_path(df.sparkSession, f"{name}/staged")
    df.repartitionByRange(arrival, *keys).write.partitionBy(arrival).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run_arrivals(table: DataFrame, arrival: str, landing: str, start: Callable[[], StreamingQuery]) -> None:
    """Lands one arrival after the other and runs the query on what is new."""
    for n in [r[0] for r in table.select(arrival).distinct().orderBy(arrival).collect()]:  # a number an arrival
        table.where(F.col(arrival) == n).drop(arrival).write.mode("append").parquet(landing)
        start().awaitTermination()


def _running(flows: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Running sums of the rows of each part, added in order from its first row."""
    out, rank = flows.copy(), np.arange(len(flows)) - np.repeat(starts, np.diff([*starts, len(flows)]))
    by_rank = np.argsort(rank, kind="stable")
    for at in np.split(by_rank, np.cumsum(np.bincount(rank))[:-1])[1:]:
        out[at] += out[at - 1]
    return out


def _ledger_fn(first_day, idle: int):
    counted_from = (pd.Timestamp(first_day) - pd.Timestamp(0)).days

    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentWatermarkMs()
        held = np.frombuffer(state.get[0], PART_STATE) if state.exists else np.empty(0, PART_STATE)
        if not state.hasTimedOut:
            df = pd.concat(list(pdfs))
            order = np.lexsort((df["day"].to_numpy(), df["part"].to_numpy()))
            part, day, opening = (df[c].to_numpy()[order] for c in ("part", "day", "stock_qty"))
            flows = df[FLOWS].to_numpy()[order]
            starts = np.flatnonzero(np.diff(part, prepend=part[0] - 1))
            size = np.diff([*starts, len(part)])
            moved = np.zeros(len(starts), PART_STATE)
            moved["part"], moved["stock_qty"], moved["segment"] = part[starts], opening[starts], now
            at = np.searchsorted(held["part"], moved["part"])
            known = np.zeros(len(moved), bool)
            known[at < len(held)] = held["part"][at[at < len(held)]] == moved["part"][at < len(held)]
            moved[known] = held[at[known]]
            totals = _running(np.where((day > counted_from)[:, None], flows, 0.0), starts) + np.repeat(moved["totals"], size, axis=0)
            late = np.repeat(known, size) & (day < np.repeat(moved["last"], size))
            ends = starts + size - 1
            moved["last"] = np.where(known, np.maximum(day[ends], moved["last"]), day[ends])
            moved["totals"] = totals[ends]
            moved["due"] = np.maximum((moved["last"] + idle) * DAY_MS, now + 1)
            yield pd.DataFrame(dict(zip(COLUMNS, (part, day, "move", np.repeat(moved["segment"], size), late, *flows.T, *totals.T, opening)))).assign(bucket=key[0])
            rest = np.ones(len(held), bool)
            rest[at[known]] = False
            held = np.concatenate([held[rest], moved])
            held = held[np.argsort(held["part"], kind="stable")]
        over = held[held["due"] < now]
        if len(over):
            none = np.zeros(len(over))
            yield pd.DataFrame(dict(zip(COLUMNS, (over["part"], over["last"], "closed", over["segment"], False, none, none, none, *over["totals"].T, over["stock_qty"])))).assign(bucket=key[0])
        held = held[held["due"] >= now]
        if len(held):
            state.update((held.tobytes(),))
            state.setTimeoutTimestamp(max(int(held["due"].min()), now + 1))
        else:
            state.remove()
    return fn


COLUMNS = [c.split()[0] for c in LEDGER_OUT.split(", ")]


def ledger_query(spark: SparkSession, landing: str, first_day, name: str, idle: int = 400, delay: str = "40 days") -> StreamingQuery:
    """STM-01: one run of the incremental ledger over what is new in
    ``landing``: daily movement rows (part, day, qty_sold, qty_purchased,
    qty_regulated, stock_qty = the part's opening).  Movements of ``first_day``
    are in the opening already.

    A movement older than its part's last posted day is posted late: on its own
    day, in the balances from then on, and marked.  One older than the watermark
    (the latest day seen less ``delay``) is refused; ``refused`` lists those."""
    schema = "part long, day date, qty_sold double, qty_purchased double, qty_regulated double, stock_qty double"
    src = spark.readStream.schema(schema).parquet(landing).withColumn("ts", F.col("day").cast("timestamp")).withWatermark("ts", delay)
    # A bucket of its own holds the rows without a part.
    bucket = F.when(F.col("part").isNull(), -1).otherwise(F.pmod(F.xxhash64("part"), F.lit(BUCKETS))).cast("int")
    src = src.withColumns({"bucket": bucket, "part": F.coalesce("part", F.lit(0)), "day": F.unix_date("day").cast("long")})
    out = ", ".join("day long" if c == "day date" else c for c in [*LEDGER_OUT.split(", "), "bucket int"])
    rows = src.groupBy("bucket").applyInPandasWithState(_ledger_fn(first_day, idle), out, LEDGER_STATE, "append", GroupStateTimeout.EventTimeTimeout)
    rows = rows.withColumns({"part": F.when(F.col("bucket") >= 0, F.col("part")), "day": F.date_from_unix_date(F.col("day").cast("int"))})
    return (rows.select(*COLUMNS).writeStream.format("parquet").option("path", scratch_table_path(spark, f"{name}/out"))
                .option("checkpointLocation", scratch_table_path(spark, f"{name}/ckpt"))
                .outputMode("append").trigger(availableNow=True).start())


def ledger_rows(spark: SparkSession, name: str) -> DataFrame:
    """What the runs have posted: movement rows with the totals of the part's
    closed segments added, and the computed stock."""
    rows = spark.read.parquet(scratch_table_path(spark, f"{name}/out"))
    before = Window.partitionBy("part").orderBy("segment").rangeBetween(Window.unboundedPreceding, -1)
    closed = F.col("kind") == "closed"
    total = rows.withColumns({c: F.col(c) + F.coalesce(F.sum(F.when(closed, F.col(c))).over(before), F.lit(0.0)) for c in EVOLUTIONS})
    return (total.where(~closed).drop("kind", "segment")
            .withColumn("stock_qty_al", F.col("stock_qty") - F.col("sales_evolution") + F.col("purchases_evolution") - F.col("regulated_evolution")))


def refused(spark: SparkSession, landing: str, name: str) -> DataFrame:
    """Landed movements that no run has posted, for they came after the watermark."""
    posted = spark.read.parquet(scratch_table_path(spark, f"{name}/out")).where("kind = 'move'").select("part", "day")
    return spark.read.parquet(landing).join(posted, ["part", "day"], "left_anti")


def ledger_stream(table: DataFrame, arrival: str, first_day, name: str, idle: int = 400, delay: str = "40 days") -> DataFrame:
    """STM-01 over all arrivals of a staged table, each a run of its own."""
    spark = table.sparkSession
    landing = scratch_table_path(spark, f"{name}/in")
    run_arrivals(table, arrival, landing, lambda: ledger_query(spark, landing, first_day, name, idle, delay))
    return ledger_rows(spark, name)


def dedupe_stream(table: DataFrame, arrival: str, keys: list[str], event_time: str, delay: str, name: str) -> DataFrame:
    """STM-02: first arrival per key wins."""
    spark = table.sparkSession
    landing, out, ckpt = (scratch_table_path(spark, f"{name}/{x}") for x in ("in", "out", "ckpt"))
    schema = table.drop(arrival).schema
    run_arrivals(table, arrival, landing, lambda: (
        spark.readStream.schema(schema).parquet(landing).withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)
        .writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
        .outputMode("append").trigger(availableNow=True).start()))
    return spark.read.parquet(out)


def daily_counts_stream(table: DataFrame, arrival: str, ts: str, flag: str, name: str, delay: str = "1 day") -> DataFrame:
    """STM-03: per-day count of flagged records; update mode, every batch's
    updated windows are appended with the batch id, the latest per window
    is the result."""
    spark = table.sparkSession
    landing, out, ckpt = (scratch_table_path(spark, f"{name}/{x}") for x in ("in", "out", "ckpt"))
    schema = table.drop(arrival).schema

    def sink(batch: DataFrame, batch_id: int):
        batch.select(F.col("w.start").alias("day_start"), "warnings", F.lit(batch_id).alias("batch_id")) \
             .write.mode("append").parquet(out)

    def start() -> StreamingQuery:
        src = spark.readStream.schema(schema).parquet(landing)
        agg = (src.filter(F.col(flag)).withWatermark(ts, delay).groupBy(F.window(ts, "1 day").alias("w"))
                  .agg(F.count(F.lit(1)).alias("warnings")))
        return (agg.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", ckpt)
                   .trigger(availableNow=True).start())

    run_arrivals(table, arrival, landing, start)
    r = spark.read.parquet(out)
    return r.groupBy("day_start").agg(F.max_by("warnings", "batch_id").alias("warnings"))
