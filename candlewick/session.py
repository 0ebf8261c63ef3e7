"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Always set: timestamps in the data model are UTC instants.
# Of a key that a JSON object repeats, the last value counts.
_REQUIRED = {"spark.sql.session.timeZone": "UTC", "spark.sql.variant.allowDuplicateKeys": "true"}

# Set only where the session carries no explicit value of its own.
_PREFERRED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A symbol may hold a third of all rows (functions.columns.join_per_key).
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Per-cell positions (operators.blocks) are a small fraction of the rows they
    # join; a hash table per partition spares sorting the rows for a merge join.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # Windows over decimals cost far more per byte than a scan; on small inputs
    # keep partitions below the default minimum of 1 MB, for all cores to work.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
    # Window partitions are ordered blocks of about 16k rows (operators.blocks);
    # keep one block in the in-memory row buffer.
    "spark.sql.windowExec.buffer.in.memory.threshold": "32768",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to ``spark`` and return it."""
    for key, value in _REQUIRED.items():
        spark.conf.set(key, value)
    explicit = spark.conf.getAll
    for key, value in _PREFERRED.items():
        if key not in explicit:
            spark.conf.set(key, value)
    return spark
