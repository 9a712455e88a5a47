"""Ingest of landed log files as a stream that stops when it has caught up.

New files drive it rather than the latest event time, so late rows are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from hitloom.operators.dedup import first_within, not_yet_stored
from hitloom.operators.parse import parse_requests
from hitloom.operators.sinks import write_silver
from hitloom.plans.ingest import refine
from hitloom.sources.folders import scratch_folder
from hitloom.sources.lookup import read_lookup
from hitloom.sources.raw_logs import stream_access_logs
from hitloom.sources.silver import read_silver


def requests_stream(spark: SparkSession, landing: str,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """Typed requests from files as they land."""
    return parse_requests(stream_access_logs(spark, landing, max_files_per_trigger))


def ingest_new_files(spark: SparkSession, landing: str, silver: str, checkpoint: str,
                     dedup_across_batches: bool = False,
                     max_files_per_trigger: int | None = None) -> int:
    """Bring silver up to date with the landed files; returns the batches written.

    Each batch is written below its own ``batch_id`` folder and replaces it, so a
    batch retried after a failure leaves no duplicates behind. Requests that an
    earlier batch already brought are left out on demand.
    """
    written = set()

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        with scratch_folder(session, "unnamed") as unnamed:
            requests = refine(batch, read_lookup(session, landing), unnamed)
            if dedup_across_batches:
                earlier = read_silver(session, silver, except_batch=batch_id)
                if earlier is not None:
                    requests = not_yet_stored(requests, earlier)
            write_silver(requests, f"{silver}/batch_id={batch_id}", mode="overwrite")
        written.add(batch_id)

    query = (
        requests_stream(spark, landing, max_files_per_trigger)
        .writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return len(written)


@dataclass(frozen=True)
class Ingested:
    """Batches with rows, rows left out as older than the watermark, and keys remembered."""

    batches: int
    too_late: int
    remembered: int


# The state outgrows an executor's heap long before its disk; changes alone are uploaded.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _states(query: StreamingQuery) -> list[dict]:
    return [state for progress in query.recentProgress for state in progress["stateOperators"]]


def ingest_within(spark: SparkSession, landing: str, silver: str, checkpoint: str, delay: str,
                  max_files_per_trigger: int | None = None) -> Ingested:
    """Bring silver up to date, leaving out requests seen before within ``delay``.

    Silver is not read: the keys stand in the state of the stream, which a restart takes up
    from the checkpoint (``first_within``). Use it where silver is too large to compare
    with and rows are never later than ``delay``; ``ingest_new_files`` with
    ``dedup_across_batches`` loses no late row.
    """
    written = []

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        with scratch_folder(session, "unnamed") as unnamed:
            requests = refine(batch, read_lookup(session, landing), unnamed)
            write_silver(requests, f"{silver}/batch_id={batch_id}", mode="overwrite")
        written.append(batch_id)

    requests = first_within(requests_stream(spark, landing, max_files_per_trigger), delay)
    with _settings(spark, STATE_STORE):
        query = (
            requests.writeStream.foreachBatch(write_batch)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
    query.awaitTermination()
    rows = [progress["numInputRows"] for progress in query.recentProgress]
    states = _states(query)
    return Ingested(
        batches=sum(n > 0 for n in rows),
        too_late=sum(state["numRowsDroppedByWatermark"] for state in states),
        remembered=states[-1]["numRowsTotal"] if states else 0)
