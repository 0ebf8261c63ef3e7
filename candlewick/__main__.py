"""The steps of a deployment, one command each; scheduling them is left to the caller.

    python -m candlewick ingest  --kind kline --landed DIR --log LOG [--intervals 1m,5m]
                                 [--checkpoint DIR [--quarantine DIR]]
    python -m candlewick process --kind kline --log LOG --house DIR --dead-letters DIR --checkpoint DIR
    python -m candlewick rebuild --house DIR
    python -m candlewick check   --house DIR
    python -m candlewick panel   rsi_bands --house DIR [--intervals 5m,1h | all] [--zone UTC]

LOG is a directory or ``kafka://servers/topic``. Order: ingest and process for
each kind, then rebuild; check ends with a non-zero code if a check fails. With a checkpoint,
ingest publishes what was landed since its last run, else all that is there.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from candlewick.operators.normalize import dump_events, normalize_klines, normalize_ticker
from candlewick.plans import panels
from candlewick.plans.rebuild import Warehouse, rebuild_marts
from candlewick.schemas import DEFAULT_INTERVAL, parse_intervals
from candlewick.session import configure
from candlewick.sources.landed import read_kline_responses, read_ticker_responses
from candlewick.sources.log import FileLog, KafkaLog, publish
from candlewick.streaming.ingest import Ingest, ingest_available_now
from candlewick.streaming.processor import run_available_now

# name: (panel, the newest candles it shows or None for the snapshot, whether it shows times)
PANELS = {
    "snapshot": (panels.panel_snapshot, None, True),
    "trend_vs_ema": (panels.panel_trend_vs_ema, panels.LINE_ROWS, True),
    "rsi_bands": (panels.panel_rsi_bands, panels.LINE_ROWS, True),
    "ema_distance": (panels.panel_ema_distance, panels.LINE_ROWS, True),
    "volume_spike": (panels.panel_volume_spike, panels.BAR_ROWS, True),
    "returns_long": (panels.panel_returns_long, None, False),
}


def open_log(text: str, starting: str = "earliest", options: Sequence[str] = ()) -> KafkaLog | FileLog:
    """A log by its name; ``options`` are Kafka options as ``name=value``."""
    if text.startswith("kafka://"):
        servers, _, topic = text.removeprefix("kafka://").partition("/")
        if not servers or not topic:
            raise ValueError("A Kafka log is written as kafka://servers/topic.")
        named = dict(option.split("=", 1) for option in options)
        return KafkaLog(servers, topic, starting, named)
    return FileLog(text)


def events(spark: SparkSession, args: argparse.Namespace):
    if args.kind == "ticker":
        return normalize_ticker(read_ticker_responses(spark, args.landed, args.dated), args.source)
    responses = read_kline_responses(spark, args.landed, args.intervals, args.dated)
    return normalize_klines(responses, args.source)


def ingest(spark: SparkSession, args: argparse.Namespace) -> int:
    if args.checkpoint is not None:
        if args.log is None:
            raise SystemExit("An ingest with a checkpoint needs a log.")
        run = Ingest(args.kind, open_log(args.log, options=args.log_option), args.source, args.quarantine)
        done = ingest_available_now(
            spark, run, args.landed, args.checkpoint, args.intervals, args.dated, args.max_files
        )
        print(f"Published {done.published} {args.kind} records to {args.log}, {done.rejected} rejected.")
        return 0
    if args.quarantine is not None:
        raise SystemExit("A quarantine needs a checkpoint, whose batches name its directories.")
    batch = events(spark, args)
    if args.dump is not None:
        dump_events(batch).write.text(args.dump)
        return 0
    if args.log is None:
        for row in dump_events(batch).toLocalIterator():
            print(row.value)
        return 0
    print(f"Published {publish(batch, open_log(args.log, options=args.log_option))} {args.kind} records to {args.log}.")
    return 0


def process(spark: SparkSession, args: argparse.Namespace) -> int:
    house = Warehouse(args.house)
    counters = run_available_now(
        spark,
        open_log(args.log, args.starting, args.log_option),
        args.kind,
        house.tickers if args.kind == "ticker" else house.klines,
        args.dead_letters,
        args.checkpoint,
        args.max_per_trigger,
    )
    print(
        f"Processed {counters.read} {args.kind} records: "
        f"{counters.written} written, {counters.invalid} invalid."
    )
    return 0


def rebuild(spark: SparkSession, args: argparse.Namespace) -> int:
    rebuild_marts(spark, Warehouse(args.house))
    return 0


def check(spark: SparkSession, args: argparse.Namespace) -> int:
    failed, code = Warehouse(args.house).check(spark, args.as_of)
    print_rows(failed)
    return code


def print_rows(df: DataFrame) -> None:
    """All rows of ``df``, tab-separated below their names, a partition at a time."""
    print(*df.columns, sep="\t")
    for row in df.toLocalIterator():
        print(*("" if value is None else value for value in row), sep="\t")


def panel(spark: SparkSession, args: argparse.Namespace) -> int:
    build, rows, timed = PANELS[args.name]
    intervals = None if args.intervals == "all" else parse_intervals(args.intervals)
    zone = {"tz": args.zone} if timed else {}
    house = Warehouse(args.house)
    mart = house.snapshot(spark) if rows is None else house.recent(spark, rows, intervals)
    print_rows(build(mart, intervals, **zone))
    return 0


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="candlewick")
    commands = top.add_subparsers(dest="command", required=True)

    def command(run, *shared: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(run.__name__)
        sub.set_defaults(run=run)
        if "kind" in shared:
            sub.add_argument("--kind", choices=("ticker", "kline"), required=True)
        if "house" in shared:
            sub.add_argument("--house", required=True, help="directory of the tables and marts")
        return sub

    sub = command(ingest, "kind")
    sub.add_argument("--landed", required=True, help="directory of landed responses")
    sink = sub.add_mutually_exclusive_group()
    sink.add_argument("--log", help="event log; without it and --dump, events are printed, one task after another")
    sink.add_argument("--dump", help="directory for the events as JSON texts, written by the tasks")
    sub.add_argument("--checkpoint", help="directory that remembers which responses were published")
    sub.add_argument("--quarantine", help="directory for what cannot be read; without it that fails the run")
    sub.add_argument("--dated", action="store_true", help="responses lie in fetched_at=<time> directories")
    sub.add_argument("--max-files", type=int, help="responses per batch")
    sub.add_argument("--log-option", action="append", default=[], help="Kafka option as name=value")
    sub.add_argument("--source", default="exchange", help="name of the source in the events")
    sub.add_argument("--intervals", help="comma-separated candle intervals (default: all landed)")

    sub = command(process, "kind", "house")
    sub.add_argument("--log", required=True)
    sub.add_argument("--dead-letters", required=True)
    sub.add_argument("--checkpoint", required=True)
    sub.add_argument("--max-per-trigger", type=int, help="offsets or files per batch")
    sub.add_argument("--starting", default="earliest", help="Kafka position of a first run")
    sub.add_argument("--log-option", action="append", default=[], help="Kafka option as name=value")

    command(rebuild, "house")
    sub = command(check, "house")
    sub.add_argument("--as-of", default="current_timestamp()", help="timestamp expression")
    sub = command(panel, "house")
    sub.add_argument("name", choices=sorted(PANELS))
    sub.add_argument("--intervals", default=DEFAULT_INTERVAL)
    sub.add_argument("--zone", default=panels.REPORT_ZONE)
    return top


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(arguments)
    return args.run(configure(spark or SparkSession.builder.getOrCreate()), args)


if __name__ == "__main__":
    sys.exit(main())
