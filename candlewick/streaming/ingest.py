"""Incremental ingest: each landed response is normalized and published once.

A file stream over the landed directory, with a checkpoint of its own, gives every run the files that
were landed since the last one. What cannot be read, a response or a single candle of one, goes to the quarantine
with its reason and does not hold up the rest; without a quarantine it fails the run, which then
starts again at the same files.

A batch publishes first and moves the checkpoint after that. A batch that is run again overwrites its own
quarantine directory and publishes its events once more, with the same keys and versions, which the
upsert resolves to the same rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from candlewick.operators.normalize import normalize_klines, normalize_ticker, rejects
from candlewick.sources.landed import stream_kline_responses, stream_ticker_responses
from candlewick.sources.log import FileLog, KafkaLog, publish
from candlewick.sources.tables import write_dead_letters


@dataclass
class Ingested:
    published: int = 0
    rejected: int = 0
    batches: int = 0


@dataclass
class Ingest:
    event_type: str
    log: KafkaLog | FileLog
    source: str = "exchange"
    quarantine: str | None = None
    counters: Ingested = field(default_factory=Ingested)

    def events(self, responses: DataFrame) -> DataFrame:
        normalize = normalize_ticker if self.event_type == "ticker" else normalize_klines
        return normalize(responses, self.source, on_error="quarantine" if self.quarantine else "fail")

    def process(self, responses: DataFrame, batch_id: int) -> None:
        if self.quarantine is None:
            self.counters.published += publish(self.events(responses), self.log)
            self.counters.batches += 1
            return
        counts = Observation()
        events = self.events(responses).observe(counts, F.count("error").alias("rejected")).persist()
        try:
            self.counters.published += publish(events.filter("error is null"), self.log)
            rejected = counts.get["rejected"]
            if rejected:
                write_dead_letters(rejects(events), self.quarantine, self.event_type, batch_id)
        finally:
            events.unpersist()
        self.counters.rejected += rejected
        self.counters.batches += 1


def ingest_available_now(
    spark: SparkSession,
    ingest: Ingest,
    landed: str,
    checkpoint: str,
    intervals: str | None = None,
    dated: bool = False,
    max_files: int | None = None,
) -> Ingested:
    """Publish what was landed since the last run and stop; at most ``max_files`` responses a batch."""
    if ingest.event_type == "ticker":
        responses = stream_ticker_responses(spark, landed, dated, max_files)
    else:
        responses = stream_kline_responses(spark, landed, intervals, dated, max_files)
    query = (
        responses.writeStream.foreachBatch(ingest.process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return ingest.counters
