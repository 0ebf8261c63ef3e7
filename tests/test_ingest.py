"""Versions of events, incremental ingest of landed responses, and the quarantine."""

import json
import os
from decimal import Decimal

import pytest

from candlewick.__main__ import main, open_log
from candlewick.operators.normalize import normalize_klines
from candlewick.operators.validate import validate
from candlewick.sources.landed import read_kline_responses
from candlewick.sources.log import FileLog, KafkaLog, publish
from candlewick.sources.tables import RawTable
from candlewick.streaming.ingest import Ingest, ingest_available_now
from candlewick.streaming.processor import run_available_now
from tests.samples import KLINE_ROW, TICKER_EVENT, TICKER_RESPONSE, event

STEP = 300_000


def kline(at=0, close="4", step=STEP):
    row = [KLINE_ROW[0] + at * step, *KLINE_ROW[1:6], KLINE_ROW[0] + (at + 1) * step - 1, *KLINE_ROW[7:]]
    row[1:5] = ["1", "9", "1", close]
    return row


def land(tmp_path, name, rows, fetched=None, symbol="ABCUSD", interval="5m"):
    folder = tmp_path / "klines" / f"symbol={symbol}" / f"interval={interval}"
    folder = folder if fetched is None or isinstance(fetched, (int, float)) else folder / f"fetched_at={fetched}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(rows if isinstance(rows, str) else json.dumps(rows))
    if isinstance(fetched, (int, float)):
        os.utime(folder / name, (fetched, fetched))


def closes(table, spark):
    return {r.event_id.split("-")[-1]: float(r.close_price) for r in table.read(spark).collect()}


@pytest.mark.parametrize("parts", [1, 2, 5])
@pytest.mark.parametrize("newer_first", [False, True])
def test_the_newer_of_two_versions_in_one_publish_wins(spark, tmp_path, parts, newer_first):
    """Whatever file or place of the log each of them gets."""
    fetches = [("old", "3", "2025-01-01 00:00:00"), ("new", "5", "2025-01-01 00:05:00")]
    rows = [(json.dumps([kline(0, "8"), kline(0, close)]), "ABCUSD", "5m", at) for _, close, at in fetches]
    responses = spark.createDataFrame(rows[:: -1 if newer_first else 1], "value string, symbol string, interval string, at string")
    responses = responses.selectExpr("value", "symbol", "interval", "cast(at as timestamp) as fetched_at").repartition(parts)
    log, table = FileLog(f"{tmp_path}/log"), RawTable(f"{tmp_path}/table", "kline")
    assert publish(normalize_klines(responses, "exchange"), log) == 4
    run_available_now(spark, log, "kline", table, f"{tmp_path}/dead", f"{tmp_path}/checkpoint")
    assert list(closes(table, spark).values()) == [5]
    # An older fetch that is published later changes nothing, nor does folding.
    late = responses.selectExpr("value", "symbol", "interval", "timestamp'2024-12-31 00:00:00' as fetched_at")
    publish(normalize_klines(late, "exchange"), log)
    run_available_now(spark, log, "kline", table, f"{tmp_path}/dead", f"{tmp_path}/checkpoint")
    assert list(closes(table, spark).values()) == [5]
    table.settle(spark)
    assert list(closes(table, spark).values()) == [5]


def test_records_without_versions_go_by_their_place(spark, tmp_path):
    log, table = FileLog(f"{tmp_path}/log"), RawTable(f"{tmp_path}/table", "ticker")
    for price in ("1", "2"):
        log.append(spark.createDataFrame([("k", event(TICKER_EVENT, last_price=price))], "key string, value string"))
        run_available_now(spark, log, "ticker", table, f"{tmp_path}/dead", f"{tmp_path}/checkpoint")
    assert [r.last_price for r in table.read(spark).collect()] == [2]
    versioned = spark.createDataFrame([("k", event(TICKER_EVENT, last_price="7"), "2020")], "key string, value string, version string")
    log.append(versioned)
    log.append(spark.createDataFrame([("k", event(TICKER_EVENT, last_price="8"))], "key string, value string"))
    run_available_now(spark, log, "ticker", table, f"{tmp_path}/dead", f"{tmp_path}/checkpoint")
    assert [r.last_price for r in table.read(spark).collect()] == [7]


def run(spark, tmp_path, quarantine="bad", **options):
    job = Ingest("kline", FileLog(f"{tmp_path}/log"), quarantine=quarantine and f"{tmp_path}/{quarantine}")
    return ingest_available_now(spark, job, f"{tmp_path}/klines", f"{tmp_path}/seen", **options)


def quarantined(tmp_path):
    return [json.loads(line) for path in sorted((tmp_path / "bad").rglob("*.json")) for line in path.read_text().splitlines()]


def test_each_run_publishes_what_is_new(spark, tmp_path):
    land(tmp_path, "a.json", [kline(i) for i in range(3)])
    assert run(spark, tmp_path).published == 3
    assert (done := run(spark, tmp_path)).published == 0 and done.batches == 0
    land(tmp_path, "b.json", [kline(i, "7") for i in (2, 3)], fetched=1e9)  # restored with an old time
    land(tmp_path, "c.json", [kline(i) for i in range(4)], interval="1d")
    assert run(spark, tmp_path, intervals="5m").published == 2
    log = FileLog(f"{tmp_path}/log").read(spark)
    assert log.count() == 5 and log.filter("version is null").isEmpty()


def test_batches_are_bounded(spark, tmp_path):
    for n in range(5):
        land(tmp_path, f"{n}.json", [kline(n)])
    done = run(spark, tmp_path, max_files=2)
    assert (done.published, done.batches) == (5, 3)


def test_bad_responses_and_candles_do_not_hold_up_the_rest(spark, tmp_path):
    land(tmp_path, "a.json", [kline(0), ["short"], kline(1, "abc"), kline(2)])
    land(tmp_path, "b.json", "{broken")
    land(tmp_path, "c.json", [kline(5)])
    done = run(spark, tmp_path)
    assert (done.published, done.rejected) == (3, 3)
    found = {r["reason"]: r["payload"] for r in quarantined(tmp_path)}
    assert found["Kline response is not a list."] == "{broken"
    assert json.loads(found["Invalid kline payload shape."]) == ["short"]
    assert json.loads(found["Invalid decimal field: close_price."])[4] == "abc"
    before = quarantined(tmp_path)
    # The batch runs again after a loss of its commit: the quarantine stays, the events resolve to the same rows.
    for name in ("0", ".0.crc"):
        (path := tmp_path / "seen" / "commits" / name).exists() and path.unlink()
    assert run(spark, tmp_path).published == 3
    assert quarantined(tmp_path) == before
    table = RawTable(f"{tmp_path}/table", "kline")
    run_available_now(spark, FileLog(f"{tmp_path}/log"), "kline", table, f"{tmp_path}/dead", f"{tmp_path}/checkpoint")
    assert table.read(spark).count() == 3


def test_without_a_quarantine_a_bad_response_fails_the_run(spark, tmp_path):
    land(tmp_path, "a.json", "{broken")
    with pytest.raises(Exception, match="not a list"):
        run(spark, tmp_path, quarantine=None)
    assert not (tmp_path / "log").exists() or FileLog(f"{tmp_path}/log").read(spark).isEmpty()
    assert run(spark, tmp_path).rejected == 1  # the same file, now with a quarantine


def test_the_fetch_time_may_be_a_directory(spark, tmp_path):
    land(tmp_path, "a.json", [kline(0, "2")], fetched="2025-03-01 00:00:00")
    land(tmp_path, "a.json", [kline(0, "3")], fetched="2025-03-02 00:00:00")
    land(tmp_path, "a.json", [kline(1)], fetched="unknown")
    found = {str(r.fetched_at) for r in read_kline_responses(spark, f"{tmp_path}/klines", dated=True).collect()}
    assert {"2025-03-01 00:00:00", "2025-03-02 00:00:00"} < found and len(found) == 3
    assert run(spark, tmp_path, dated=True).published == 3
    table = RawTable(f"{tmp_path}/table", "kline")
    run_available_now(spark, FileLog(f"{tmp_path}/log"), "kline", table, f"{tmp_path}/dead", f"{tmp_path}/checkpoint")
    assert closes(table, spark)[str(KLINE_ROW[0])] == 3


def test_commands_of_incremental_ingest(spark, tmp_path, capsys):
    (tmp_path / "ticker").mkdir()
    (tmp_path / "ticker" / "a.json").write_text(json.dumps(TICKER_RESPONSE))
    (tmp_path / "ticker" / "b.json").write_text("[]")
    command = ["ingest", "--kind", "ticker", "--landed", f"{tmp_path}/ticker", "--log", f"{tmp_path}/log",
               "--checkpoint", f"{tmp_path}/seen", "--quarantine", f"{tmp_path}/bad"]
    assert main(command, spark) == 0 and "Published 1 ticker records" in capsys.readouterr().out
    assert main(command, spark) == 0 and "Published 0 ticker records" in capsys.readouterr().out
    assert [r["reason"] for r in quarantined(tmp_path)] == ["Missing required field: symbol."]
    with pytest.raises(SystemExit):
        main([*command[:5], "--checkpoint", "x"], spark)
    log = open_log("kafka://a:1/t", "latest", ["kafka.security.protocol=SSL"])
    assert log == KafkaLog("a:1", "t", "latest", {"kafka.security.protocol": "SSL"})


def test_dump_is_written_by_the_tasks(spark, tmp_path):
    for n in range(6):
        land(tmp_path, f"{n}.json", [kline(10 * n + i) for i in range(4)], interval="5m" if n % 2 else "1d")
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))  # a task a file
    try:
        assert main(["ingest", "--kind", "kline", "--landed", f"{tmp_path}/klines", "--dump", f"{tmp_path}/dump"], spark) == 0
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    texts = [p.read_text() for p in (tmp_path / "dump").glob("part-*")]
    assert len(texts) > 1
    assert sum(t.count('"event_id"') for t in texts) == 2 * 24  # in the envelope and in the payload


@pytest.mark.parametrize(
    "text, kept",
    [
        ("1.000000000000000001", "1.000000000000000001"), ("1.0000000000000000001", None), ("0.1234567890123456789", None),
        ("1.0000000000000000000000", "1"), ("12e-19", None), ("12e-18", "0.000000000000000012"), ("120e-19", "0.000000000000000012"),
        ("1.5E3", "1500"), ("0E-8", "0"), ("0e-30", "0"), ("1e-18", "0.000000000000000001"), ("1e-30", None), ("  7 ", "7"),
        ("1.00000000000000000001e5", "100000.000000000000001"), ("NaN", None), ("-0.0000000000000000001", None),
    ],
)
def test_amounts_are_never_rounded(spark, text, kept):
    value = event(TICKER_EVENT, price_change_24h=text)
    row = validate(spark.createDataFrame([(value,)], "value string"), "ticker").first()
    assert (row.reason is None) == (kept is not None)
    assert kept is None or row.price_change_24h == Decimal(kept)
