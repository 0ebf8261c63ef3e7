"""Micro-batch processing of the event log into a raw table and dead letters.

One run takes everything in the log since the last one, in bounded batches.
A batch is complete once the clean rows and the rejected ones are stored; only
then does the checkpoint move on. A batch that is processed again writes the
same directories, so the outcome is that of processing it once.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from candlewick.operators.validate import clean_rows, invalid_rows, validate
from candlewick.sources.log import FileLog, KafkaLog
from candlewick.sources.tables import CARRIED, RawTable, write_dead_letters


@dataclass
class Counters:
    read: int = 0
    written: int = 0
    invalid: int = 0
    batches: int = 0

    def add(self, counts: dict) -> None:
        self.read += counts["read"]
        self.written += counts["written"]
        self.invalid += counts["invalid"]
        self.batches += 1


@dataclass
class Processor:
    event_type: str
    table: RawTable
    dead_letter_path: str
    counters: Counters = field(default_factory=Counters)

    def process(self, records: DataFrame, batch_id: int) -> None:
        """Validate one batch of (key, value, version, log_position) and store both outcomes."""
        counts = Observation()
        validated = (
            validate(records, self.event_type, keep=CARRIED)
            .observe(
                counts,
                F.count("*").alias("read"),
                F.count_if(F.col("reason").isNull()).alias("written"),
                F.count_if(F.col("reason").isNotNull()).alias("invalid"),
            )
            .persist()
        )
        try:
            self.table.write_batch(
                clean_rows(validated, self.event_type, keep=CARRIED), batch_id
            )
            found = counts.get
            if found["invalid"]:
                write_dead_letters(
                    invalid_rows(validated), self.dead_letter_path, self.event_type, batch_id
                )
        finally:
            validated.unpersist()
        self.counters.add(found)


def run_available_now(
    spark: SparkSession,
    log: KafkaLog | FileLog,
    event_type: str,
    table: RawTable,
    dead_letter_path: str,
    checkpoint: str,
    max_per_trigger: int | None = None,
) -> Counters:
    """Process what the log holds and stop; offsets (Kafka) or files per batch are bounded
    by ``max_per_trigger``."""
    table.create(spark)
    processor = Processor(event_type, table, dead_letter_path)
    query = (
        log.read_stream(spark, max_per_trigger)
        .writeStream.foreachBatch(processor.process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return processor.counters


def skip_replays(events: DataFrame, time: str = "event_time", delay: str = "1 hour") -> DataFrame:
    """Drop exact copies of an event within ``delay`` on a stream.

    Only a filter ahead of the upsert, for logs known to repeat records as they
    were: it keeps the first copy, while the upsert keeps the last version.
    """
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark(["event_id"])
