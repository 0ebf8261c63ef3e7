"""Stored tables: the raw tables written by batch, and the marts.

A raw table is a directory without in-place updates, so that a batch can be
written again after a failure and gives the same table:

``batches/batch_id=<n>/``          the rows of micro-batch n, overwritten on replay
``folded/upto=<n>/part=<p>/``      the newest version of each row of a part over batches 0..n
``folds/upto=<n>/``                for each part, the fold that holds its rows as of batch n

A part is the day that a key names (``part_of``). A fold rewrites only the parts its batches touch
and takes all others over from earlier folds, so its cost follows the batches, not the table.

Reading takes the parts of the newest finished fold and the batches after it, and resolves
each key to its newest version. Batch numbers come from the checkpoint
of the streaming query: a table belongs to one checkpoint.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from candlewick.functions.columns import add
from candlewick.operators.staging import in_intervals
from candlewick.operators.upsert import latest_by_key
from candlewick.schemas import TABLES

_POSITION = T.StructType(
    [T.StructField("part", T.StringType()), T.StructField("offset", T.LongType())]
)


# What a stored row carries beside the columns of its table.
CARRIED = ("version", "log_position")


def part_of(key: str) -> str:
    """The part of a key: the epoch day of the milliseconds it ends with. Keys of another form share one part.

    It depends on the key alone, so that all versions of a row meet in one part.
    """
    millis = f"try_cast(regexp_extract({key}, '-([0-9]{{11,14}})$', 1) as bigint)"
    return f"coalesce(concat('d', {millis} div 86400000), 'other')"


@dataclass(frozen=True)
class RawTable:
    path: str
    event_type: str

    @property
    def schema(self) -> T.StructType:
        return TABLES[self.event_type]

    @property
    def _stored(self) -> T.StructType:
        return T.StructType(
            [
                *self.schema.fields,
                T.StructField("version", T.StringType()),
                T.StructField("log_position", _POSITION),
                T.StructField("batch_id", T.LongType()),
            ]
        )

    def create(self, spark: SparkSession) -> None:
        """Make the table readable before its first batch; does nothing if it exists."""
        if _exists(spark, f"{self.path}/folds") and _exists(spark, f"{self.path}/batches"):
            return
        empty = spark.createDataFrame([], self._stored)
        empty.write.mode("append").partitionBy("batch_id").parquet(f"{self.path}/batches")
        spark.createDataFrame([], "part string, at bigint").write.mode("append").parquet(f"{self.path}/folds")

    def write_batch(self, rows: DataFrame, batch_id: int) -> None:
        """Store clean rows (table columns, ``version`` and ``log_position``) as one batch, replacing an earlier try."""
        rows.select(*self.schema.names, *CARRIED).write.mode("overwrite").parquet(
            f"{self.path}/batches/batch_id={batch_id}"
        )

    def _finished(self, spark: SparkSession) -> list[int]:
        """Batch numbers of the finished folds, in order."""
        found = _numbered(spark, f"{self.path}/folds", "upto=")
        return sorted(number for path, number in found if _exists(spark, f"{path}/_SUCCESS"))

    def _parts(self, spark: SparkSession, upto: int | None) -> dict[str, int]:
        """Of each part, the fold that holds its rows as of fold ``upto``; as many entries as days."""
        if upto is None:
            return {}
        held = spark.read.schema("part string, at bigint").parquet(f"{self.path}/folds/upto={upto}")
        return {row.part: row.at for row in held.collect()}

    def _batches(self, spark: SparkSession) -> DataFrame:
        return (
            spark.read.schema(self._stored)
            .option("basePath", f"{self.path}/batches")
            .parquet(f"{self.path}/batches")
        )

    def _folded(self, spark: SparkSession, parts: dict[str, int]) -> DataFrame:
        if not parts:
            return spark.createDataFrame([], self._stored)
        paths = [f"{self.path}/folded/upto={at}/part={part}" for part, at in sorted(parts.items())]
        return spark.read.schema(self._stored).parquet(*paths)

    def versions(self, spark: SparkSession) -> DataFrame:
        """All stored versions: the newest fold and the batches after it."""
        finished = self._finished(spark)
        if not finished:
            return self._batches(spark)
        later = self._batches(spark).filter(F.col("batch_id") > finished[-1])
        return self._folded(spark, self._parts(spark, finished[-1])).unionByName(later)

    def read(self, spark: SparkSession) -> DataFrame:
        """The newest version of each row; a plain scan if all batches are folded."""
        finished = self._finished(spark)
        if finished and self._batches(spark).filter(F.col("batch_id") > finished[-1]).isEmpty():
            return self._folded(spark, self._parts(spark, finished[-1])).select(*self.schema.names)
        return latest_by_key(self.versions(spark)).select(*self.schema.names)

    def merge(self, spark: SparkSession, upto: int) -> tuple[DataFrame, dict[str, int]]:
        """The newest version of each row, with its ``part``, of the parts that the batches after the last fold
        and up to ``upto`` touch; and the fold of every part before this one."""
        finished = self._finished(spark)
        held = self._parts(spark, finished[-1] if finished else None)
        new = self._batches(spark).filter(F.col("batch_id") <= upto)
        if finished:
            new = new.filter(F.col("batch_id") > finished[-1])
        touched = {row.part for row in new.selectExpr(f"{part_of('event_id')} as part").distinct().collect()}
        old = self._folded(spark, {part: at for part, at in held.items() if part in touched})
        rows = latest_by_key(old.unionByName(new))
        return add(rows, {"part": part_of("event_id")}), held | dict.fromkeys(touched, upto)

    def fold(self, spark: SparkSession, upto: int) -> None:
        """Resolve all batches up to ``upto`` once, so that reads no longer do.

        Drops what only readers of the fold before the last one could still need.
        """
        finished = self._finished(spark)
        if finished and upto <= finished[-1]:
            return
        rows, parts = self.merge(spark, upto)
        # Few files a part, however many tasks the resolution had; large parts are split by size.
        rows.hint("rebalance", F.col("part")).write.mode("overwrite").partitionBy("part").parquet(f"{self.path}/folded/upto={upto}")
        manifest = spark.createDataFrame(sorted(parts.items()), "part string, at bigint")
        manifest.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/folds/upto={upto}")
        self._clean(spark, parts, finished)

    def _clean(self, spark: SparkSession, parts: dict[str, int], finished: list[int]) -> None:
        kept = {(at, part) for part, at in parts.items()}
        if finished:
            kept |= {(at, part) for part, at in self._parts(spark, finished[-1]).items()}
        for path, at in _numbered(spark, f"{self.path}/folded", "upto="):
            if not any(at == used for used, _ in kept):
                remove(spark, path)
                continue
            for name in _names(spark, path):
                if name.startswith("part=") and (at, name.removeprefix("part=")) not in kept:
                    remove(spark, f"{path}/{name}")
        for old in finished[:-1]:
            remove(spark, f"{self.path}/folds/upto={old}")
        for path, number in _numbered(spark, f"{self.path}/batches", "batch_id="):
            if finished and number <= finished[-1]:
                remove(spark, path)

    def settle(self, spark: SparkSession) -> None:
        """Fold all finished batches.

        A batch that failed or is being written has no success mark yet and will be written
        again; neither it nor anything after it is folded.
        """
        upto = None
        for path, number in sorted(_numbered(spark, f"{self.path}/batches", "batch_id="), key=lambda b: b[1]):
            if not _exists(spark, f"{path}/_SUCCESS"):
                break
            upto = number
        if upto is not None:
            self.fold(spark, upto)


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _exists(spark: SparkSession, path: str) -> bool:
    files, target = _file_system(spark, path)
    return files.exists(target)


def _names(spark: SparkSession, path: str) -> list[str]:
    """Names of what a directory holds; none if there is no such directory."""
    files, target = _file_system(spark, path)
    return [s.getPath().getName() for s in files.listStatus(target)] if files.exists(target) else []


def _numbered(spark: SparkSession, path: str, prefix: str) -> list[tuple[str, int]]:
    """Paths and numbers of the directories ``<path>/<prefix><number>``."""
    found = [name for name in _names(spark, path) if name.startswith(prefix)]
    return [(f"{path}/{name}", int(name.removeprefix(prefix))) for name in found]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a directory."""
    files, target = _file_system(spark, path)
    files.delete(target, True)


def write_dead_letters(invalid: DataFrame, path: str, event_type: str, batch_id: int) -> None:
    """Store rejected events (reason, payload) of a batch as JSON lines, replacing an earlier try."""
    invalid.select("reason", "payload").write.mode("overwrite").json(
        f"{path}/event_type={event_type}/batch_id={batch_id}"
    )


def _builds(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the finished builds of a mart, in order."""
    if not _exists(spark, f"{path}/builds"):
        return []
    return sorted({row.build for row in spark.read.schema("build bigint").parquet(f"{path}/builds").collect()})


# Candles so long that a directory holds a month of them, else a day.
MONTHLY = ("4h", "1d", "1w")


def _period(time: str) -> str:
    """The first day of the directory a candle lies in."""
    return f"date_format(date_trunc(if(interval in {MONTHLY}, 'month', 'day'), {time}), 'yyyy-MM-dd')"


def _begin_build(spark: SparkSession, path: str, finished: list[int]) -> int:
    """A build number nobody else has: its directory is made by this call alone."""
    number = max([n for _, n in _numbered(spark, path, "build=")] + finished, default=-1) + 1
    while True:
        files, claim = _file_system(spark, f"{path}/claims/{number}")
        try:
            files.create(claim, False).close()
            return number
        except Exception as taken:  # Py4J wraps the file system's error
            if not files.exists(claim):
                raise taken
            number += 1


def write_mart(mart: DataFrame, path: str, time: str | None = None) -> None:
    """Write a new build of a mart beside the old one, then make it the one that is read.

    ``build=<n>/`` holds build n, laid out by candle interval, the column panels filter on, and, where ``time``
    names a time column, by its ``period``; ``periods/build=<n>/`` then has the rows of each.
    ``builds/`` has one record per finished build. A build that fails leaves the mart as it was. Builds
    at the same time get different numbers; the one with the larger number is read. The
    build before the new one is kept for readers that have begun with it.
    """
    spark = mart.sparkSession
    finished = _builds(spark, path)
    number = _begin_build(spark, path, finished)
    build = f"{path}/build={number}"
    if time is None:
        mart.write.mode("overwrite").partitionBy("interval").parquet(build)
    else:
        placed = add(mart, {"period": _period(time)})
        placed = placed.hint("rebalance", F.col("interval"), F.col("period"))
        placed.write.mode("overwrite").partitionBy("interval", "period").parquet(build)
        # Counted from the files' own row counts: no column is read.
        stored = spark.read.schema(T.StructType([*mart.schema.fields, T.StructField("period", T.StringType())])).parquet(build)
        counts = stored.groupBy("interval", "period").agg(F.count("*").alias("rows"))
        counts.coalesce(1).write.mode("overwrite").parquet(f"{path}/periods/build={number}")
    done = spark.createDataFrame([(number,)], "build bigint")
    done.coalesce(1).write.mode("append").parquet(f"{path}/builds")
    for old, n in _numbered(spark, path, "build="):
        # An unfinished build may still be written; once a later one is finished, it is not waited for.
        if n in finished[:-1] or (finished and n < finished[-1]):
            for gone in (old, f"{path}/periods/build={n}", f"{path}/claims/{n}"):
                remove(spark, gone)


def read_mart(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The newest finished build of a mart; no rows before the first."""
    builds = _builds(spark, path)
    if not builds:
        return spark.createDataFrame([], schema)
    # A given schema: Spark would infer a directory ``interval=1d`` as the number 1.
    return spark.read.schema(schema).parquet(f"{path}/build={builds[-1]}").select(*schema.names)


def read_ends(
    spark: SparkSession, path: str, schema: T.StructType, rows: int, intervals: Sequence[str] | None = None
) -> DataFrame:
    """Of the newest build of a mart laid out by periods, the periods that hold the ``rows`` newest rows of
    the given intervals together, and those that hold the oldest one of each."""
    builds = _builds(spark, path)
    if not builds:
        return spark.createDataFrame([], schema)
    counts = spark.read.schema("interval string, period string, rows bigint").parquet(f"{path}/periods/build={builds[-1]}")
    # As many rows as there are directories.
    held = sorted(in_intervals(counts, intervals).collect(), key=lambda r: r.period, reverse=True)
    chosen = set({row.interval: row.period for row in held}.items())
    found, least = 0, ""
    for row in held:
        if found < rows:
            least = row.period  # the newest rows are not older than this day
        elif row.period != least and not (row.interval in MONTHLY and row.period >= f"{least[:8]}01"):
            continue  # ends before it
        chosen.add((row.interval, row.period))
        found += row.rows
    if not chosen:
        return spark.createDataFrame([], schema)
    by_interval: dict[str, list[str]] = {}
    for interval, period in sorted(chosen):
        by_interval.setdefault(interval, []).append(period)
    wanted = " or ".join(
        f"(interval = '{interval}' and period in ({', '.join(repr(p) for p in periods)}))" for interval, periods in by_interval.items()
    )
    partitions = [T.StructField("period", T.StringType())]
    stored = spark.read.schema(T.StructType([*schema.fields, *partitions])).parquet(f"{path}/build={builds[-1]}")
    return stored.filter(wanted).select(*schema.names)
