"""Event stream -> deduplicated trips -> windowed demand and flows -> keyed tables."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from odflux.functions.session import cut_lineage, release
from odflux.operators.events import decode_events, dedup_events
from odflux.operators.windows import SLIDE, WIDTH, demand_windows, zone_flows
from odflux.sources.tables import upsert_demand_windows, upsert_zone_flows

QUALITY = "trip_payload_quality"
OUTPUT_MODES = ("update", "append")


def read_event_stream(spark: SparkSession, source: dict[str, str], starting_offsets: str = "latest",
                      max_offsets_per_trigger: int = 500_000, fail_on_data_loss: bool = True,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Raw payloads: a Kafka topic (``{"kafka": servers, "topic": name}``) or Parquet files (``{"path": ...}``).

    ``max_offsets_per_trigger=0`` lifts the rate cap. Offsets that the broker no
    longer has fail the query unless ``fail_on_data_loss`` is turned off.
    """
    if "kafka" in source:
        reader = (
            spark.readStream.format("kafka").option("kafka.bootstrap.servers", source["kafka"])
            .option("subscribe", source["topic"]).option("startingOffsets", starting_offsets)
            .option("failOnDataLoss", str(fail_on_data_loss).lower())
        )
        if max_offsets_per_trigger > 0:
            reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
        return reader.load().select(
            F.col("value").cast("string").alias("value"), F.col("partition").alias("kafka_partition"),
            F.col("offset").alias("kafka_offset"))
    reader = spark.readStream.schema("key string, value string, event_millis long")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(source["path"]).select("value")


def trip_stream(payloads: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """Valid, deduplicated trips; the payload counters are reported under ``QUALITY``."""
    return dedup_events(decode_events(payloads, observe_as=QUALITY), watermark)


# State lives on the executors' disks, and the native memory of all its stores on one executor has one bound.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
}


def _start(frame: DataFrame, name: str, checkpoint: str, mode: str, trigger: dict,
           write: Callable[[DataFrame], None]) -> StreamingQuery:
    if mode not in OUTPUT_MODES:
        raise ValueError(f"output mode must be one of {OUTPUT_MODES}")

    def each(batch: DataFrame, _batch_id: int) -> None:
        held = batch.persist()
        try:
            if not held.isEmpty():
                write(held)
        finally:
            held.unpersist()

    # Also in a session that others made; a query that began with another store keeps the one its checkpoint names.
    for key, value in STATE.items():
        frame.sparkSession.conf.set(key, value)
    return (
        frame.writeStream.queryName(name).outputMode(mode).option("checkpointLocation", checkpoint)
        .trigger(**trigger).foreachBatch(each).start()
    )


def start_demand_query(trips: DataFrame, out: str, checkpoint: str, mode: str = "update",
                       trigger: dict | None = None, width: str = WIDTH, slide: str = SLIDE,
                       sink: Callable[[DataFrame, str], None] = upsert_demand_windows) -> StreamingQuery:
    """Keeps the demand table at ``out`` up to date; a replayed batch overwrites its own keys.

    Another ``sink(batch, out)`` must bear to be given the same batch again: after a
    failure between writing a batch and noting it as done, the restarted query repeats it.
    """
    return _start(demand_windows(trips, width, slide), "zone-demand-windows", checkpoint, mode,
                  trigger or {"processingTime": "30 seconds"}, lambda rows: sink(rows, out))


def start_flow_query(trips: DataFrame, out: str, checkpoint: str, mode: str = "update",
                     trigger: dict | None = None, width: str = WIDTH, slide: str = SLIDE,
                     sink: Callable[[DataFrame, str], None] = upsert_zone_flows) -> StreamingQuery:
    return _start(zone_flows(trips, width, slide), "zone-trip-flows", checkpoint, mode,
                  trigger or {"processingTime": "30 seconds"}, lambda rows: sink(rows, out))


def rows_dropped_late(progress) -> int:
    """Rows that the state operators of one progress report passed over because the watermark had gone by."""
    return sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)


class ProgressLog(StreamingQueryListener):
    """Rates, payload counters and late drops of every micro-batch, as a table at ``path``; ``frame`` reads it.

    Reports are held until there are ``every`` of them or a query ends, so the log
    gets a file per ``every`` micro-batches and the listener starts no job in between.
    At most ``every - 1`` reports are lost with the driver. ``compact`` folds the log's
    files into one.
    """

    SCHEMA = ("query string, batch_id long, input_rows long, input_rows_per_second double, processed_rows_per_second double, "
              "payloads_seen long, payloads_malformed long, rows_dropped_late long")

    def __init__(self, spark: SparkSession, path: str, every: int = 100):
        if every < 1:
            raise ValueError("every must be at least 1")
        self._spark, self._path, self._every = spark, path, every
        self._held: list[tuple] = []
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        seen = p.observedMetrics.get(QUALITY)
        row = (
            p.name, p.batchId, p.numInputRows, float(p.inputRowsPerSecond or 0), float(p.processedRowsPerSecond or 0),
            seen["payloads_seen"] if seen else 0, seen["payloads_malformed"] if seen else 0, rows_dropped_late(p),
        )
        with self._lock:
            self._held.append(row)
            full = len(self._held) >= self._every
        if full:
            self.flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.flush()

    def flush(self) -> None:
        """Append what is held; a report is written once, also when several queries end together."""
        with self._lock:
            rows, self._held = self._held, []
            if rows:
                self._spark.createDataFrame(rows, self.SCHEMA).coalesce(1).write.mode("append").parquet(self._path)

    def compact(self) -> None:
        """One file for all that was logged. Not while a query that is listened to runs."""
        self.flush()
        with self._lock:
            whole = cut_lineage(self.frame())
            whole.coalesce(1).write.mode("overwrite").parquet(self._path)
            release(whole)

    def frame(self) -> DataFrame:
        return self._spark.read.schema(self.SCHEMA).parquet(self._path)
