"""Streaming forms: publications, de-duplication, run counters, stale jobs."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from quire import values as V
from quire.operators import upserts as U
from quire.plans.keyed_ingest import PublicationState


def stream_publications(
    stream: DataFrame, state_root: str, checkpoint: str, now: Column, compact_every: int = 16, **trigger
):
    """Publications upserted and linked per micro-batch into bucketed state (`PublicationState`).

    A batch reads and writes the lineages it touches; the batch id is the version, so a repeated batch changes
    nothing. Predecessors may arrive after their successors. Every ``compact_every`` batches, buckets with as many
    deltas are folded into a base and older files go. Read with `read_publications`.
    """
    trigger = trigger or {"availableNow": True}
    kinds = U.publication_flags(stream).schema

    def apply(batch: DataFrame, batch_id: int) -> None:
        state = PublicationState(batch.sparkSession, state_root, kinds)
        fresh = U.publication_flags(batch).withColumn("seq", F.monotonically_increasing_id())
        if state.apply(fresh, now, batch_id) and batch_id % compact_every == compact_every - 1:
            state.compact(least=compact_every)

    return (
        stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
        .trigger(**trigger).start()
    )


def read_publications(spark: SparkSession, stream_schema: StructType, state_root: str) -> DataFrame:
    """What `stream_publications` has stored; ``stream_schema`` is that of its input."""
    kinds = U.publication_flags(spark.createDataFrame([], stream_schema)).schema
    return PublicationState(spark, state_root, kinds).read()


def stream_dedup(stream: DataFrame, event_time: str = "created_at", delay: str = "1 day") -> DataFrame:
    """Each (source, id, reference) once within the watermark; late repeats are dropped too."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(
        ["source", "source_document_id", "attachment_reference"]
    )


def stream_run_metrics(
    stream: DataFrame, event_time: str = "ts", width: str = "1 hour", delay: str = "10 minutes"
) -> DataFrame:
    """Attachment outcomes counted per tumbling window, emitted once the window is closed."""
    outcome = lambda name: F.count_if(F.col("outcome") == name).alias(name)
    counted = stream.withWatermark(event_time, delay).groupBy(F.window(event_time, width)).agg(
        outcome("downloaded"), outcome("skipped"), outcome("failed")
    )
    return counted.select("window.start", "window.end", "downloaded", "skipped", "failed")


STALE_SCHEMA = "job_id bigint, status string, finished_at timestamp, error string"
_STATE = "status string, updated_ms bigint, event_id bigint"


def _stale_after(seconds: int):
    def step(
        key: tuple, batches: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            status, updated, _ = state.get
            state.remove()
            if status == "PROCESSING":
                at = pd.Timestamp(updated + seconds * 1000, unit="ms")
                yield pd.DataFrame({
                    "job_id": [key[0]], "status": ["FAILED"], "finished_at": [at],
                    "error": ["stale_processing_recovered"],
                })
            return
        status, updated, event = state.get if state.exists else (None, -1, -1)
        for batch in batches:
            last = batch.sort_values(["ts", "event_id"]).iloc[-1]
            at = int(last["ts"].value // 1_000_000), int(last["event_id"])
            if at >= (updated, event):
                status, (updated, event) = last["status"], at
        state.update((status, updated, event))
        # Every job gets a timer: one that has ended says nothing when it fires, and its state goes.
        state.setTimeoutTimestamp(max(updated + seconds * 1000, state.getCurrentWatermarkMs() + 1))
        yield from ()

    return step


def stream_stale_jobs(
    stream: DataFrame, stale_after_seconds: int = V.STALE_AFTER_SECONDS, delay: str = "1 minute"
) -> DataFrame:
    """Jobs that stay PROCESSING for the limit without an event, closed as failed by a timer.

    State is kept for the limit after a job's last event, whatever its status, so it doesn't grow with
    the jobs ever seen.
    """
    return (
        stream.withWatermark("ts", delay)
        .groupBy("job_id")
        .applyInPandasWithState(
            _stale_after(stale_after_seconds), STALE_SCHEMA, _STATE, "append",
            GroupStateTimeout.EventTimeTimeout,
        )
    )


def run_to_files(result: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run an append stream over what is there now and read back what it wrote."""
    spark = result.sparkSession
    schema = result.schema
    query = (
        result.writeStream.format("parquet").outputMode("append").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(schema).parquet(path)
