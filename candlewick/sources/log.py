"""The event log between normalization and validation.

A log holds (key, value, version) records: the event id, the JSON payload and the
version of the event (operators.normalize). It is a Kafka topic where a broker and the
connector are at hand, with the version in a header, else a directory of parquet files,
appended to batch by batch. Both are read as (key, value, version, log_position). The version
orders the versions of one event; the position does so only for records without one,
which other producers may write.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

RECORD_SCHEMA = "key string, value string, version string"


@dataclass(frozen=True)
class KafkaLog:
    """A topic. ``starting`` is the position of a query without a checkpoint."""

    servers: str
    topic: str
    starting: str = "earliest"
    options: Mapping[str, str] = field(default_factory=dict)

    def read_options(self, max_per_trigger: int | None = None) -> dict[str, str]:
        options = {
            "kafka.bootstrap.servers": self.servers,
            "subscribe": self.topic,
            "startingOffsets": self.starting,
            **self.options,
        }
        if max_per_trigger is not None:
            options["maxOffsetsPerTrigger"] = str(max_per_trigger)
        return options

    def write_options(self) -> dict[str, str]:
        return {
            "kafka.bootstrap.servers": self.servers,
            "topic": self.topic,
            # A record counts as published once all in-sync replicas have it.
            "kafka.acks": "all",
            **self.options,
        }

    def read_stream(self, spark: SparkSession, max_per_trigger: int | None = None) -> DataFrame:
        reader = spark.readStream.format("kafka").options(**self.read_options(max_per_trigger))
        return reader.option("includeHeaders", "true").load().selectExpr(
            "cast(key as string) as key",
            "cast(value as string) as value",
            "cast(get(filter(headers, h -> h.key = 'version'), 0).value as string) as version",
            "struct(lpad(cast(partition as string), 10, '0') as part, offset) as log_position",
        )

    def append(self, records: DataFrame) -> None:
        headed = records.selectExpr(
            "key", "value", "array(named_struct('key', 'version', 'value', cast(version as binary))) as headers"
        )
        headed.write.format("kafka").options(**self.write_options()).save()


@dataclass(frozen=True)
class FileLog:
    """A directory of parquet files, read in the order of their modification."""

    path: str

    def read_stream(self, spark: SparkSession, max_per_trigger: int | None = None) -> DataFrame:
        reader = spark.readStream.schema(RECORD_SCHEMA)
        if max_per_trigger is not None:
            reader = reader.option("maxFilesPerTrigger", max_per_trigger)
        return self._positioned(reader.parquet(self.path))

    def read(self, spark: SparkSession) -> DataFrame:
        return self._positioned(spark.read.schema(RECORD_SCHEMA).parquet(self.path))

    def append(self, records: DataFrame) -> None:
        records.write.mode("append").parquet(self.path)

    @staticmethod
    def _positioned(records: DataFrame) -> DataFrame:
        written = "lpad(cast(unix_millis(_metadata.file_modification_time) as string), 16, '0')"
        return records.selectExpr(
            "key",
            "value",
            "version",
            f"struct(concat({written}, _metadata.file_name) as part, _metadata.row_index as offset)"
            " as log_position",
        )


def publish(events: DataFrame, log: KafkaLog | FileLog) -> int:
    """Append normalized events to the log; the number of records written."""
    published = Observation()
    records = events.selectExpr("event_id as key", "payload as value", "version").observe(
        published, F.count("*").alias("records")
    )
    log.append(records)
    return published.get["records"]
