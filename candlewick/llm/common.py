"""Shared helpers: reading tables, storing intermediate ones, running sums over a global order."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

# Set only where the session carries no explicit value of its own. Batches to Python
# are bounded in rows and bytes, because one text may be very long.
_PREFERRED = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    explicit = spark.conf.getAll
    for key, value in _PREFERRED.items():
        if key not in explicit:
            spark.conf.set(key, value)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or a temporary one where it is unset (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", "")
    if not folder:
        folder = tempfile.mkdtemp(prefix="candlewick-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


#: For ``stored`` tables of large rows: a task reads a row group at once.
SMALL_ROW_GROUPS = {
    "parquet.block.size": str(8 << 20),
    "parquet.block.size.row.check.min": "1",
    "parquet.page.size.row.check.min": "1",
}


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Jobs started inside remove their shuffle files when they end, so that the disk holds one job's at a time."""
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/candlewick/{uuid.uuid4().hex}/{name}"
    with shuffles_removed(spark):
        df.write.options(**(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Delete tables made by ``stored`` that no later job reads."""
    for df in tables:
        jvm = df.sparkSession._jvm
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def mapped(df: DataFrame, batches: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` over the columns of ``df``."""
    return df.mapInArrow(batches, schema)


def positioned(df: DataFrame, order: list[str | Column], weight: Column, name: str, before: str = "before") -> DataFrame:
    """Store ``df`` in the global order of ``order`` and add the sum of ``weight`` over all earlier rows.

    Rows are range-partitioned and summed inside each part; what is gathered on the
    driver is one number a part. ``order`` has to be a total order.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid = (
        df.withColumn("_weight", weight.cast("long"))
        .repartitionByRange(parts, *order)
        .withColumn("_part", F.spark_partition_id())
    )
    laid = stored(laid, name)
    within = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return laid.withColumn("_inner", F.coalesce(F.sum("_weight").over(within), F.lit(0))).withColumn(
        before, F.col("_inner") + looked_up(part_offsets(laid, F.sum("_weight")), F.col("_part"))
    ).drop("_inner", "_weight", "_part")


def part_offsets(laid: DataFrame, total: Column) -> list[int]:
    """For each part number, the total of all parts before it (as many numbers as partitions)."""
    totals = {r["_part"]: r["_total"] for r in laid.groupBy("_part").agg(total.alias("_total")).collect()}
    offsets, running = [], 0
    for part in range(max(totals, default=-1) + 1):
        offsets.append(running)
        running += totals.get(part) or 0
    return offsets


def looked_up(offsets: list[int], part: Column) -> Column:
    """The entry of a short list at a column's value."""
    values = F.lit(offsets or [0]).cast("array<bigint>")
    return F.element_at(values, part + 1)
