"""Structured Streaming bindings: follow a change feed into a replica.

``follow_files`` reads new Parquet files of a change feed as a stream and commits each micro-batch through the
same encode, delta and log entry as a batch run. A batch may be delivered again after a failure: its rows
merge to the same replica, and its number is kept in the log, so it isn't counted twice.

``follow_table`` polls a mutable table with the cursor of the replica as its offset, as ``run_table`` does, on a
processing-time clock. A cursor is a resume offset, not an event-time watermark: a row stamped before a
committed cursor is not seen again until a reset, which replays safely.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from strandlog.functions.encode import encode_frame
from strandlog.operators import merge
from strandlog.operators.flatten import flatten_events
from strandlog.operators.pull import project
from strandlog.plans.run import Budget, ReconcileRun, TableResult, _stamp, run_reconcile, run_table
from strandlog.sources.store import Store
from strandlog.spec import PURGE, TableSpec


def commit_batch(store: Store, spec: TableSpec, rows: DataFrame, batch_id: int) -> bool:
    """Merge one micro-batch into the replica; False if the log has it already."""
    head = store.head(spec.key)
    if head.stream_batch >= batch_id:
        return False
    # A micro-batch may hold several versions of a key. The newest is taken over live and deleted ones together;
    # of one change time a deletion comes last, as in a page, and then the greater row, so that a replay agrees.
    purge = spec.soft_delete is not None and spec.soft_delete.mode == PURGE
    every = encode_frame(project(rows, spec), spec)
    dead = F.col(spec.column(spec.soft_delete.column).name).isNotNull() if purge else F.lit(False)
    version = F.struct(F.col(spec.cursor_name).alias("_at"), dead.alias("_dead"), F.struct(*every.columns).alias("_row"))
    name = store.write(spec.key, every.groupBy(F.col(spec.key_name).alias("_key")).agg(F.max(version).alias("v")).select("v.*"))
    newest = store.spark.read.parquet(store.path(spec.key, name))
    sides = newest.groupBy().agg(F.count_if("_dead").alias("dead"), F.count_if(~F.col("_dead")).alias("live"), F.max(F.struct(F.col("_at").alias("c"), F.col(f"_row.{spec.key_name}").cast("string").alias("k"))).alias("t")).collect()[0]
    deltas = []
    if sides["live"]:
        deltas.append(store.write(spec.key, merge.as_upserts(newest.where(~F.col("_dead")).select("_row.*"), head.seq)))
    if sides["dead"]:
        deltas.append(store.write(spec.key, merge.as_deletes(newest.where("_dead").select(f"_row.{spec.key_name}"), store.empty(spec), spec.key_name, head.seq + 1)))
    n, top = sides["live"] + sides["dead"], sides["t"]
    s = head.state
    state = replace(s, last_run_status="ok", rows_synced_total=s.rows_synced_total + n, rows_synced_last_run=n)
    if n and (s.cursor_updated_at is None or (top["c"], top["k"]) > (s.cursor_updated_at, s.cursor_pk)):
        state = replace(state, cursor_updated_at=_stamp(top["c"]), cursor_pk=top["k"])
    head = store.commit(head, state, tuple(deltas), deletes=sides["dead"] > 0, stream_batch=batch_id)
    store.drop(spec.key, (name,))
    store.compact_if_long(spec, head)
    return True


def follow_files(spark: SparkSession, store: Store, spec: TableSpec, path: str, schema: T.StructType, checkpoint: str, every: str | None = None, files_per_batch: int = 1000) -> StreamingQuery:
    """Follow a folder of change files; once over what is there, or ``every`` so often."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda rows, n: commit_batch(store, spec, rows, n) and None)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def _every(seconds: float, rounds: int, job: Callable[[], object]) -> list:
    """``job`` so many times, at most once in so many seconds."""
    out = []
    for k in range(rounds):
        began = time.monotonic()
        out.append(job())
        if k + 1 < rounds:
            time.sleep(max(0.0, seconds - (time.monotonic() - began)))
    return out


def follow_table(store: Store, spec: TableSpec, open_source: Callable[[], DataFrame], every_s: float, rounds: int) -> list[TableResult]:
    """Run the table ``rounds`` times, at most once in ``every_s`` seconds."""
    return _every(every_s, rounds, lambda: run_table(store, spec, open_source(), Budget()))


def follow_reconcile(spark: SparkSession, store: Store, open_source: Callable[[TableSpec], DataFrame], registry: Iterable[TableSpec], every_s: float, rounds: int, **options) -> list[ReconcileRun]:
    """Reconcile ``rounds`` times on a clock of its own; ``options`` are those of ``run_reconcile``."""
    return _every(every_s, rounds, lambda: run_reconcile(spark, store, open_source, registry, **options))


def follow_events(stream: DataFrame, events: str = "events") -> DataFrame:
    """Flatten a stream of items with nested events: the plan of the batch operator, unchanged."""
    return flatten_events(stream, events)
