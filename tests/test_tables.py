import json
import os
import re
from datetime import datetime

import pytest
from pyspark.sql import types as T

from candlewick.__main__ import print_rows
from candlewick.operators.upsert import latest_by_key
from candlewick.plans.rebuild import Warehouse, rebuild_marts
from candlewick.schemas import OHLCV, SNAPSHOT
from candlewick.sources.landed import read_kline_responses, read_ticker_responses
from candlewick.sources.log import FileLog, KafkaLog, publish
from candlewick.plans import panels
from candlewick.sources import tables
from candlewick.sources.tables import RawTable, read_ends, read_mart, write_mart
from candlewick.operators.normalize import normalize_klines, normalize_ticker
from candlewick.streaming.processor import run_available_now, skip_replays
from tests.samples import KLINE_EVENT, KLINE_ROW, TICKER_EVENT, TICKER_RESPONSE, event


def records(spark, *values):
    rows = [(f"k{i}", v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "key string, value string").coalesce(1)


def run(spark, tmp_path, kind="ticker", max_per_trigger=None):
    table = RawTable(f"{tmp_path}/table", kind)
    counters = run_available_now(
        spark, FileLog(f"{tmp_path}/log"), kind, table, f"{tmp_path}/dead", f"{tmp_path}/checkpoint",
        max_per_trigger,
    )
    return table, counters


def dead_letters(tmp_path):
    found = []
    for path in sorted((tmp_path / "dead").rglob("*.json")):
        found += [json.loads(line) for line in path.read_text().splitlines()]
    return found


def test_latest_version_wins(spark):
    versions = spark.sql(
        "select * from values ('a', 1, 5, 'old'), ('a', 2, 1, 'new'), ('a', 2, 0, 'mid'), ('b', 0, 9, 'only')"
        " as t(event_id, batch_id, log_position, v)"
    )
    got = {r.event_id: r.v for r in latest_by_key(versions).collect()}
    assert got == {"a": "new", "b": "only"}


def test_one_run_stores_clean_rows_and_dead_letters(spark, tmp_path):
    log = FileLog(f"{tmp_path}/log")
    log.append(
        records(
            spark,
            event(TICKER_EVENT, last_price="1"),
            event(TICKER_EVENT, last_price="2"),
            event(TICKER_EVENT, event_id="other"),
            event(TICKER_EVENT, last_price="-1"),
            "{broken",
            "[1]",
        )
    )
    table, counters = run(spark, tmp_path)
    assert (counters.read, counters.written, counters.invalid, counters.batches) == (5, 3, 2, 1)
    rows = {r.event_id: r for r in table.read(spark).collect()}
    assert sorted(rows) == ["other", "ticker-ABCUSD-1"]
    assert rows["ticker-ABCUSD-1"].last_price == 2
    letters = dead_letters(tmp_path)
    assert sorted(x["reason"] for x in letters) == ["Malformed JSON.", "Ticker payload contains negative values."]
    assert {x["payload"] for x in letters} == {"{broken", event(TICKER_EVENT, last_price="-1")}


def test_nothing_is_written_to_dead_letters_without_rejects(spark, tmp_path):
    FileLog(f"{tmp_path}/log").append(records(spark, event(TICKER_EVENT)))
    run(spark, tmp_path)
    assert not (tmp_path / "dead").exists()


def test_batches_are_bounded_and_later_ones_win(spark, tmp_path):
    log = FileLog(f"{tmp_path}/log")
    for price in ("1", "2", "3"):
        log.append(records(spark, event(TICKER_EVENT, last_price=price)))
    table, counters = run(spark, tmp_path, max_per_trigger=1)
    assert (counters.batches, counters.written) == (3, 3)
    assert [r.last_price for r in table.read(spark).collect()] == [3]
    # A second run starts where the first one stopped.
    log.append(records(spark, event(TICKER_EVENT, event_id="late")))
    table, counters = run(spark, tmp_path)
    assert (counters.batches, counters.written) == (1, 1)
    assert table.read(spark).count() == 2


def test_replayed_batch_changes_nothing(spark, tmp_path):
    log = FileLog(f"{tmp_path}/log")
    log.append(records(spark, event(TICKER_EVENT, last_price="1"), event(TICKER_EVENT, last_price="-1")))
    log.append(records(spark, event(TICKER_EVENT, last_price="2")))
    table, _ = run(spark, tmp_path, max_per_trigger=1)
    before, letters = table.read(spark).collect(), dead_letters(tmp_path)
    # Losing the commit of both batches makes the next run process them again.
    commits = tmp_path / "checkpoint" / "commits"
    for n in (0, 1):
        (commits / str(n)).unlink()
        crc = commits / f".{n}.crc"
        if crc.exists():
            crc.unlink()
    table, counters = run(spark, tmp_path, max_per_trigger=1)
    assert counters.read > 0
    assert table.read(spark).collect() == before
    assert dead_letters(tmp_path) == letters


def test_split_stream_equals_one_batch(spark, tmp_path):
    values = [
        event(KLINE_EVENT, event_id=f"e{i % 7}", close_price=str(4 + i / 200), trade_count=i) for i in range(40)
    ]
    for parts, name in ((1, "whole"), (8, "split")):
        log = FileLog(f"{tmp_path}/{name}/log")
        for start in range(0, 40, 40 // parts):
            log.append(records(spark, *values[start : start + 40 // parts]))
        run(spark, tmp_path / name, "kline", max_per_trigger=1)
    whole = RawTable(f"{tmp_path}/whole/table", "kline").read(spark)
    split = RawTable(f"{tmp_path}/split/table", "kline").read(spark)
    assert whole.count() == 7
    assert whole.exceptAll(split).isEmpty() and split.exceptAll(whole).isEmpty()
    assert {int(r.trade_count) for r in whole.collect()} == set(range(33, 40))


def test_fold_keeps_the_table(spark, tmp_path):
    log = FileLog(f"{tmp_path}/log")
    for price in ("1", "2"):
        log.append(records(spark, event(TICKER_EVENT, last_price=price), event(TICKER_EVENT, event_id=price)))
    table, _ = run(spark, tmp_path, max_per_trigger=1)
    before = sorted(table.read(spark).collect())
    table.fold(spark, 1)
    assert sorted(table.read(spark).collect()) == before
    assert table.versions(spark).count() == 3
    table.fold(spark, 0)  # already folded further
    log.append(records(spark, event(TICKER_EVENT, last_price="9")))
    table, _ = run(spark, tmp_path)
    assert {r.event_id: r.last_price for r in table.read(spark).collect()}["ticker-ABCUSD-1"] == 9
    assert table.versions(spark).count() == 4


def test_folds_drop_what_they_replace(spark, tmp_path):
    log = FileLog(f"{tmp_path}/log")
    for n in range(4):
        log.append(records(spark, event(TICKER_EVENT, last_price=str(n + 1)), event(TICKER_EVENT, event_id=str(n))))
        table, _ = run(spark, tmp_path)
        table.settle(spark)
        rows = {r.event_id: r.last_price for r in table.read(spark).collect()}
        assert len(rows) == n + 2 and rows["ticker-ABCUSD-1"] == n + 1
    assert sorted(p.name for p in (tmp_path / "table" / "folded").iterdir()) == ["upto=2", "upto=3"]
    assert sorted(p.name for p in (tmp_path / "table" / "batches").glob("batch_id=*")) == ["batch_id=3"]
    table.settle(spark)
    assert "Window" not in table.read(spark)._jdf.queryExecution().toString()


def test_a_failed_batch_is_not_folded_and_comes_back(spark, tmp_path):
    log = FileLog(f"{tmp_path}/log")
    log.append(records(spark, event(TICKER_EVENT, event_id="a")))
    table, _ = run(spark, tmp_path)
    failed = tmp_path / "table" / "batches" / "batch_id=1"
    failed.mkdir()  # what a batch leaves whose task fails
    table.settle(spark)
    (rest := [p.name for p in (tmp_path / "table" / "folded").iterdir()]).sort()
    assert rest == ["upto=0"]
    log.append(records(spark, event(TICKER_EVENT, event_id="b")))
    table, _ = run(spark, tmp_path)
    table.settle(spark)
    assert sorted(r.event_id for r in table.read(spark).collect()) == ["a", "b"]


def test_a_failed_rebuild_keeps_the_mart(spark, tmp_path):
    path, schema = f"{tmp_path}/mart", T.StructType.fromDDL("price long, interval string")
    assert read_mart(spark, path, schema).isEmpty()
    good = spark.createDataFrame([(1, "1d")], schema)
    write_mart(good, path)
    with pytest.raises(Exception, match="broken"):
        write_mart(good.selectExpr("raise_error('broken') + price as price", "interval"), path)
    assert [tuple(r) for r in read_mart(spark, path, schema).collect()] == [(1, "1d")]
    for n in range(3):
        write_mart(good.selectExpr(f"price + {n} as price", "interval"), path)
    assert read_mart(spark, path, schema).first().price == 3
    assert len(list((tmp_path / "mart").glob("build=*"))) == 2


def mart_rows(spark, tmp_path):
    """Candles of several intervals over some months, with few rows in some days."""
    import random

    rng = random.Random(6)
    rows, start = [], 1_700_000_000
    for interval, step, n in (("5m", 300, 4000), ("1h", 3600, 900), ("1d", 86400, 120), ("1w", 604800, 20)):
        for i in range(n):
            if rng.random() < 0.7:
                rows.append((f"{interval}-{i}", interval, datetime.fromtimestamp(start + i * step), float(len(rows)), 1.0, 50.0))
    schema = T.StructType.fromDDL("event_id string, interval string, candle_time timestamp, close double, ema_20 double, rsi_14 double")
    frame = spark.createDataFrame(rows, schema)
    write_mart(frame, f"{tmp_path}/mart", time="candle_time")
    return frame, f"{tmp_path}/mart", schema


@pytest.mark.parametrize("intervals", [["5m"], ["1h"], ["1d"], ["5m", "1w"], ["1d", "1h"], None, ["1m"]])
def test_panels_over_the_periods_they_need(spark, tmp_path, intervals):
    frame, path, schema = mart_rows(spark, tmp_path)
    for rows, panel in ((panels.LINE_ROWS, panels.panel_rsi_bands), (panels.LINE_ROWS, panels.panel_trend_vs_ema)):
        ends = read_ends(spark, path, schema, rows, intervals)
        assert panel(ends, intervals).collect() == panel(frame, intervals).collect()
        if intervals == ["5m"]:
            scanned = set(re.findall(r"period=([0-9-]+)", " ".join(ends.inputFiles())))
            whole = set(re.findall(r"interval=5m/period=([0-9-]+)", " ".join(read_mart(spark, path, schema).inputFiles())))
            text = ends._jdf.queryExecution().executedPlan().toString()
            assert "PartitionFilters: [" in text and "period" in text.split("PartitionFilters: [")[1].split("]")[0]
            assert len(whole) >= 14 and ends.select("candle_time").distinct().count() < 800 and scanned
    assert read_mart(spark, path, schema).exceptAll(frame).isEmpty() and read_mart(spark, path, schema).count() == frame.count()


def test_builds_at_the_same_time_have_different_numbers(spark, tmp_path):
    numbers = {tables._begin_build(spark, f"{tmp_path}/mart", []) for _ in range(3)}
    assert len(numbers) == 3


def kline_log(spark, tmp_path, days, close="4", name="log"):
    day = 86_400_000
    rows = [
        (f"kline-ABCUSD-1d-{d * day}", event(KLINE_EVENT, event_id=f"kline-ABCUSD-1d-{d * day}", close_price=close)) for d in days
    ]
    FileLog(f"{tmp_path}/{name}").append(spark.createDataFrame(rows, "key string, value string").coalesce(1))


def test_a_fold_reads_and_writes_the_parts_it_touches(spark, tmp_path):
    kline_log(spark, tmp_path, range(20_000, 20_012))
    table, _ = run(spark, tmp_path, "kline")
    table.settle(spark)
    kline_log(spark, tmp_path, [20_003], "4.125")
    table, _ = run(spark, tmp_path, "kline")
    merged, parts = table.merge(spark, 1)
    assert {f.split("folded/")[1].split("/part-")[0] for f in merged.inputFiles() if "folded" in f} == {"upto=0/part=d20003"}
    assert len(parts) == 12 and {p for p, at in parts.items() if at == 1} == {"d20003"}
    table.settle(spark)
    assert [p.name for p in (tmp_path / "table" / "folded" / "upto=1").glob("part=*")] == ["part=d20003"]
    rows = {r.event_id: r.close_price for r in table.read(spark).collect()}
    assert len(rows) == 12 and [k.split("-")[-1] for k, v in rows.items() if v == 4.125] == [str(20_003 * 86_400_000)]
    # The replaced directory goes with the fold after the next.
    for n, day in enumerate((20_005, 20_006)):
        kline_log(spark, tmp_path, [day, 21_000 + n], "4.0625")
        table, _ = run(spark, tmp_path, "kline")
        table.settle(spark)
    left = {p.name for p in (tmp_path / "table" / "folded" / "upto=0").glob("part=*")}
    assert "part=d20003" not in left and len(left) >= 9
    assert table.read(spark).count() == 14


def test_versions_of_a_key_share_a_part(spark):
    keys = ["kline-A-5m-1736900000000", "ticker-A-1736900000000", "kline-A-5m--5", "x", "a-12345678901234567890", "-86399999999"]
    found = [r[0] for r in spark.createDataFrame([(k,) for k in keys], "k string").selectExpr(tables.part_of("k")).collect()]
    assert found == ["d20103", "d20103", "other", "other", "other", "d999"]


def test_rows_printed_have_no_limit(spark, capsys):
    print_rows(spark.range(1200).selectExpr("id", "if(id = 3, null, 'x') as name"))
    assert len(capsys.readouterr().out.splitlines()) == 1201


def test_create_does_nothing_the_second_time(spark, tmp_path):
    table = RawTable(f"{tmp_path}/table", "kline")
    for _ in range(3):
        table.create(spark)
    assert len(list((tmp_path / "table" / "folds").glob("*.parquet"))) == 1


def test_an_open_candle_stays_open_when_read_late(spark, landed):
    late = KLINE_ROW[0] / 1000 + 120
    for file in (landed / "klines").rglob("*.json"):
        os.utime(file, (late, late))
    events = normalize_klines(read_kline_responses(spark, f"{landed}/klines", "5m"), "exchange").collect()
    assert {datetime.fromisoformat(json.loads(e.payload)["ingest_time"]).timestamp() for e in events} == {late}


def test_empty_log_gives_an_empty_table(spark, tmp_path):
    table = RawTable(f"{tmp_path}/table", "kline")
    table.create(spark)
    table.create(spark)
    assert table.read(spark).isEmpty()
    assert table.read(spark).columns == table.schema.names


def test_kafka_options():
    log = KafkaLog("broker:9092", "klines", options={"kafka.request.timeout.ms": "10000"})
    assert log.read_options(500) == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "klines",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "500",
        "kafka.request.timeout.ms": "10000",
    }
    assert "maxOffsetsPerTrigger" not in log.read_options()
    assert log.write_options()["topic"] == "klines"


def test_replay_filter_builds_a_bounded_plan(spark, tmp_path):
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema("event_id string, event_time timestamp").parquet(f"{tmp_path}/in")
    assert skip_replays(stream).isStreaming


@pytest.fixture
def landed(tmp_path):
    (tmp_path / "ticker").mkdir()
    for n in range(2):
        response = {**TICKER_RESPONSE, "closeTime": TICKER_RESPONSE["closeTime"] + n}
        (tmp_path / "ticker" / f"{n}.json").write_text(json.dumps(response, indent=1))
    for interval, step in (("5m", 300_000), ("1d", 86_400_000)):
        folder = tmp_path / "klines" / "symbol=ABCUSD" / f"interval={interval}"
        folder.mkdir(parents=True)
        rows = [
            [KLINE_ROW[0] + i * step, *KLINE_ROW[1:6], KLINE_ROW[0] + (i + 1) * step - 1, *KLINE_ROW[7:]]
            for i in range(30)
        ]
        (folder / "a.json").write_text(json.dumps(rows))
    return tmp_path


def test_landed_responses(spark, landed):
    assert read_ticker_responses(spark, f"{landed}/ticker").count() == 2
    klines = read_kline_responses(spark, f"{landed}/klines")
    assert sorted((r.symbol, r.interval) for r in klines.collect()) == [("ABCUSD", "1d"), ("ABCUSD", "5m")]
    assert read_kline_responses(spark, f"{landed}/klines", "1d, 1w").count() == 1


def test_from_responses_to_marts(spark, landed):
    """Both branches, then the rebuild, then the quality suite."""
    house = Warehouse(f"{landed}/house")
    ingest = "timestamp'2027-01-01 00:00:00'"
    branches = {
        "ticker": (normalize_ticker(read_ticker_responses(spark, f"{landed}/ticker"), "exchange", ingest), house.tickers),
        "kline": (normalize_klines(read_kline_responses(spark, f"{landed}/klines"), "exchange", ingest), house.klines),
    }
    for kind, (events, table) in branches.items():
        log = FileLog(f"{landed}/log/{kind}")
        assert publish(events, log) == (2 if kind == "ticker" else 60)
        counters = run_available_now(
            spark, log, kind, table, f"{landed}/dead", f"{landed}/checkpoint/{kind}"
        )
        assert counters.invalid == 0
    rebuild_marts(spark, house)
    ohlcv, snapshot = house.ohlcv(spark), house.snapshot(spark)
    assert ohlcv.count() == 60 and snapshot.count() == 2
    assert ohlcv.schema.names == OHLCV.names and snapshot.schema.names == SNAPSHOT.names
    assert {r.interval for r in snapshot.collect()} == {"5m", "1d"}
    assert house.check(spark, "timestamp'2027-01-01 00:10:00'")[1] == 0
    assert house.check(spark, "timestamp'2027-01-03 00:00:00'") [1] == 1
    # A rebuild of the same tables gives the same marts.
    before = sorted(map(str, snapshot.collect()))
    rebuild_marts(spark, house)
    assert sorted(map(str, house.snapshot(spark).collect())) == before


def test_commands(spark, landed, capsys):
    from candlewick.__main__ import main, open_log

    house = f"{landed}/house"
    for kind, folder in (("ticker", "ticker"), ("kline", "klines")):
        assert main(["ingest", "--kind", kind, "--landed", f"{landed}/{folder}", "--log", f"{landed}/log/{kind}"], spark) == 0
        assert main(
            ["process", "--kind", kind, "--house", house, "--log", f"{landed}/log/{kind}",
             "--dead-letters", f"{landed}/dead", "--checkpoint", f"{landed}/checkpoint/{kind}"], spark
        ) == 0
    assert main(["rebuild", "--house", house], spark) == 0
    out = capsys.readouterr().out
    assert "Published 60 kline records" in out
    assert "Processed 2 ticker records: 2 written, 0 invalid." in out
    assert main(["check", "--house", house], spark) == 0
    assert main(["check", "--house", house, "--as-of", "timestamp'2100-01-01'"], spark) == 1
    for name in ("snapshot", "trend_vs_ema", "rsi_bands", "ema_distance", "volume_spike", "returns_long"):
        assert main(["panel", name, "--house", house, "--intervals", "all"], spark) == 0
    out = capsys.readouterr().out
    assert "ABCUSD" in out and "oversold_band" in out
    assert main(["ingest", "--kind", "ticker", "--landed", f"{landed}/ticker"], spark) == 0
    assert '"event_id"' in capsys.readouterr().out
    assert open_log("kafka://a:1,b:2/topic") == KafkaLog("a:1,b:2", "topic")
    with pytest.raises(ValueError):
        open_log("kafka://a:1")
