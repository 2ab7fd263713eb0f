"""Sync, marks, hot tier, reconnection and sinks that break off."""

import json
import random
from datetime import UTC, datetime, timedelta
from pathlib import Path

import exchange
import pytest
from pyspark.sql import functions as F

from barforge.operators import quality, spans
from barforge.schema import STATE
from barforge.sources import ingest, lake
from barforge.sources.sync import Fetching, SyncFailed, Tables, fetched, read_spans, read_state, sync_missing, sync_recent
from barforge.sources.transport import ExchangeCandles, WeightLimiter
from barforge.streaming import pipelines
from barforge.streaming.live import Live
from barforge.streaming.receivers import Receiving

from exchange import DAY, MINUTE, START
from test_operators import candle, frame, series


@pytest.fixture
def calls(spark):
    spark.sparkContext.addPyFile(exchange.__file__)
    path = Path(exchange.CALLS)
    path.write_text("")
    yield lambda: [json.loads(x) for x in path.read_text().splitlines()]
    path.unlink()


@pytest.fixture
def tables(tmp_path):
    return Tables(*(f"{tmp_path}/{x}" for x in ("raw", "silver", "quarantine", "gaps", "state")))


def universe(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "symbol string")


def marks(spark, tables):
    return {r.symbol: (r.last_open_time_ms, r.status) for r in spark.read.parquet(tables.state).collect()}


def at(minutes):
    return datetime.fromtimestamp((START + minutes * MINUTE) / 1000 + 30, tz=UTC)


def test_archives_first_then_pages(spark, tmp_path, tables, calls):
    how = Fetching("exchange:page", "exchange:archive", f"{tmp_path}/cache", limit=1000, tasks=2, weight=900)
    now = datetime(2024, 7, 4, 0, 10, 30, tzinfo=UTC)
    spark.createDataFrame([(s, "1m", START - MINUTE, "active") for s in ("OK", "LOST", "DOWN")], STATE).write.parquet(tables.state)
    got = sync_missing(spark, universe(spark, "OK", "LOST", "DOWN"), "1m", tables, how, now=now)
    assert got["symbols"] == 3 and got["accepted"] == 3 * (3 * 1440 + 10) and got["rejected"] == got["gaps"] == 0
    assert {s: x[0] for s, x in marks(spark, tables).items()} == dict.fromkeys(("OK", "LOST", "DOWN"), START + 3 * DAY + 9 * MINUTE)
    said = calls()
    assert [x[2] for x in said if x[:2] == ["archive", "OK"]] == ["2024-07-01", "2024-07-02"]
    assert min(x[2] for x in said if x[:2] == ["page", "OK"]) == START + 2 * DAY
    assert [x[2] for x in said if x[:2] == ["archive", "LOST"]] == ["2024-07-01"] and min(x[2] for x in said if x[:2] == ["page", "LOST"]) == START
    assert min(x[2] for x in said if x[:2] == ["page", "DOWN"]) == START
    # archives are kept, and nothing is lacking the next time
    fetched(spark, [("OK", START)], "1m", how, datetime(2024, 7, 3, 0, 0, 30, tzinfo=UTC)).count()
    assert [x[2] for x in calls()[len(said) :] if x[0] == "archive"] == []
    n = len(calls())
    assert sync_missing(spark, universe(spark, "OK"), "1m", tables, how, now=now)["raw"] == 0 and len(calls()) == n


def test_marks_follow_what_is_contiguous(spark, tables, calls):
    how = Fetching("exchange:page", limit=100)
    names = ("FULL", "HOLE", "SKIP", "BAD", "GONE")
    spark.createDataFrame([(s, "1m", START - MINUTE, "active") for s in names], STATE).write.parquet(tables.state)
    got = sync_missing(spark, universe(spark, *names[:4]), "1m", tables, how, now=at(10), whole_universe=True)
    assert got["rejected"] == 1 and got["gaps"] == 2
    want = {"FULL": START + 9 * MINUTE, "HOLE": START + 4 * MINUTE, "SKIP": START - MINUTE, "BAD": START + 2 * MINUTE}
    assert marks(spark, tables) == {k: (v, "active") for k, v in want.items()} | {"GONE": (START - MINUTE, "inactive")}
    # nothing turns a symbol active again that is gone
    sync_missing(spark, universe(spark, "FULL"), "1m", tables, how, now=at(20), whole_universe=True)
    assert marks(spark, tables)["GONE"][1] == marks(spark, tables)["BAD"][1] == "inactive" and marks(spark, tables)["FULL"] == (START + 19 * MINUTE, "active")


def test_recent_only_and_legacy_state(spark, tmp_path, tables, calls):
    got = sync_recent(spark, universe(spark, "A", "B"), "1m", tables, Fetching("exchange:page", limit=5), now=at(100))
    assert got["accepted"] == 10 and not lake.exists(spark, tables.state)
    assert lake.scan(spark, tables.silver).agg(F.min("open_time_ms"), F.max("open_time_ms")).first() == (START + 95 * MINUTE, START + 99 * MINUTE)
    old = tmp_path / "old.json"
    old.write_text(json.dumps({"A|1m": {"last_open_time_ms": 7, "status": "active"}, "A|5m": {"last_open_time_ms": 9}, "B|1m": {"last_open_time_ms": None, "status": "inactive"}}))
    rows = {tuple(r) for r in read_state(spark, tables.state, str(old), "1m").collect()}
    assert rows == {("A", "1m", 7, "active"), ("B", "1m", None, "inactive")}


def test_contiguous_from(spark):
    rows = [candle(s, k, 1.0) for s, ks in (("A", (0, 1, 3)), ("B", (2, 3)), ("C", (5,)), ("D", (0, 1))) for k in ks]
    starts = spark.createDataFrame([("A", "1m", START + 1), ("B", "1m", START), ("C", "1m", None)], "symbol string, interval string, start_ms long")
    got = {r.symbol: r.last_open_time_ms for r in quality.contiguous_from(frame(spark, rows + rows[:1]), starts, MINUTE).collect()}
    assert got == {"A": START + MINUTE, "C": START + 5 * MINUTE, "D": START + MINUTE}
    assert quality.contiguous_from(frame(spark, rows).limit(0), starts, MINUTE).collect() == []


def test_nulls_and_broken_numbers_are_rejected(spark):
    rows = frame(spark, [candle("A", 0, 1.0), candle("A", 1, 1.0), candle("A", 2, 1.0)])
    for c in (*quality.VALUES, "open_time_ms", "symbol"):
        broken = rows.withColumn(c, F.when(F.col("open_time_ms") != START + MINUTE, F.col(c)))
        assert sorted(x.r or "" for x in broken.select(quality.reject_reason(MINUTE).alias("r")).collect()) == ["", "", "missing_value"]
    payload = json.dumps([str(START), "1", "two", "0.5", "1.5", "10", str(START + MINUTE - 1)])
    got = ingest.parse_rows(spark.createDataFrame([("A", "1m", payload), ("A", "1m", "no json")], "symbol string, interval string, payload string"))
    assert [r.verdict for r in quality.clean(got.withColumn("seq", F.lit(0)), MINUTE).judged.collect()] == ["rejected"] * 2
    said = ['{"data": {"e": "kline", "s": "A", "k": {"t": "x", "x": true}}}', "no json", '{"data": 5}', '{"data": {"e": "kline", "k": null}}']
    assert [(r.symbol, r.open_time_ms, r.is_closed) for r in ingest.parse_messages(spark.createDataFrame([(x,) for x in said], "value string")).orderBy("symbol").collect()] == [(None, None, False), ("A", None, True)]


def test_a_replacement_that_breaks_off(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    lake.replace(spark.range(3), path)
    (tmp_path / "t").rename(tmp_path / "t.before")  # as if the run had ended there
    assert lake.exists(spark, path) and spark.read.parquet(path).count() == 3
    lake.replace(spark.read.parquet(path).union(spark.range(2)), path)
    assert spark.read.parquet(path).count() == 5 and sorted(x.name for x in tmp_path.iterdir()) == ["t"]


def test_deleting_breaks_off_before_it_loses_rows(spark, tmp_path, monkeypatch):
    root = f"{tmp_path}/silver"
    rows = [candle("A", k, 1.0) for k in (0, 1)] + [candle("B", 0, 1.0)]
    lake.upsert(ingest.stored(frame(spark, rows)), root)
    keys = spark.createDataFrame([("A", "1m", START), ("B", "1m", START)], "symbol string, interval string, open_time_ms long")

    def fails(*_):
        raise OSError

    monkeypatch.setattr(lake, "drop_partitions", fails)
    with pytest.raises(OSError):
        lake.delete_keys(root, keys)
    assert sorted((r.symbol, r.open_time_ms) for r in lake.scan(spark, root).collect()) == [("A", START + MINUTE), ("B", START)]
    monkeypatch.undo()
    lake.delete_keys(root, keys)
    assert [(r.symbol, r.open_time_ms) for r in lake.scan(spark, root).collect()] == [("A", START + MINUTE)]


def test_streams_of_sharded_connections(spark, tmp_path, calls):
    silver, hot, state = (f"{tmp_path}/{x}" for x in ("silver", "hot", "state"))
    sink = pipelines.candle_sink(silver, MINUTE, state=state)
    how = Receiving("exchange:messages", ["A", "B", "C"], "1m", per_connection=2, once=True)
    Live(spark, how, pipelines.buffered(sink, hot, 6), f"{tmp_path}/spool", f"{tmp_path}/c").wait(120)
    assert sorted(x[1] for x in calls()) == ["a@kline_1m/b@kline_1m", "c@kline_1m"]
    pipelines.flush(spark, sink, hot)
    assert sorted((r.symbol, r.open_time_ms - START) for r in lake.scan(spark, silver).collect()) == [(s, k * MINUTE) for s in "ABC" for k in range(2)]
    assert {r.last_open_time_ms for r in spark.read.parquet(state).collect()} == {START + MINUTE} and not lake.exists(spark, hot)


def test_hot_candles_wait_for_the_lake(spark, tmp_path):
    silver, hot = f"{tmp_path}/silver", f"{tmp_path}/hot"
    write = pipelines.buffered(pipelines.candle_sink(silver, MINUTE), hot, 3)
    batch = lambda *rows: ingest.stored(frame(spark, list(rows))).drop("seq").withColumns({"is_closed": F.lit(True), "event_time_ms": F.col("close_time_ms")})
    write(batch(candle("A", 0, 1.0), candle("A", 1, 1.0)), 0)
    assert not lake.exists(spark, silver) and pipelines.hot_rows(spark, hot).count() == 2
    write(batch(candle("A", 1, 2.0)), 1)  # again: nothing new but its price
    assert sorted(r.close for r in pipelines.hot_rows(spark, hot).collect()) == [1.0, 2.0]
    # a batch has written its own row and no other
    assert spark.read.parquet(f"{hot}/batch=1").count() == 1
    write(batch(candle("A", 2, 1.0)), 2)
    assert lake.scan(spark, silver).count() == 3 and not lake.exists(spark, hot)


def test_hot_candles_of_another_run_go_first(spark, tmp_path):
    silver, hot = f"{tmp_path}/silver", f"{tmp_path}/hot"
    batch = lambda *rows: ingest.stored(frame(spark, list(rows))).drop("seq").withColumns({"is_closed": F.lit(True), "event_time_ms": F.col("close_time_ms")})
    start = lambda: pipelines.buffered(pipelines.candle_sink(silver, MINUTE), hot, 100)
    start()(batch(candle("A", 0, 1.0)), 0)
    start()(batch(candle("A", 1, 1.0)), 0)  # a new run, whose numbers begin anew
    assert [r.open_time_ms for r in lake.scan(spark, silver).collect()] == [START] and [r.open_time_ms for r in pipelines.hot_rows(spark, hot).collect()] == [START + MINUTE]


def test_gaps_between_batches(spark, tmp_path):
    silver, gaps = f"{tmp_path}/silver", f"{tmp_path}/gaps"
    batch = lambda *rows: ingest.stored(frame(spark, list(rows))).drop("seq").withColumns({"is_closed": F.lit(True), "event_time_ms": F.col("close_time_ms")})
    all_rows, sink = [], pipelines.candle_sink(silver, MINUTE, gap_report=gaps)
    for n, rows in enumerate(([("A", 0), ("A", 2), ("B", 5)], [("A", 5), ("B", 6)], [("A", 6), ("B", 9), ("A", 3)], [("A", 1)])):
        if n == 2:  # another run, which finds the last candles in the table
            sink = pipelines.candle_sink(silver, MINUTE, gap_report=gaps)
        own = [candle(s, k, 1.0) for s, k in rows]
        all_rows += own
        sink(batch(*own), n)
        want = {(r.symbol, r.missing_open_time_ms) for r in quality.find_gaps(frame(spark, all_rows), MINUTE).collect()}
        got = spark.read.schema("symbol string, missing_open_time_ms long").parquet(gaps).collect()
        assert {(r.symbol, r.missing_open_time_ms) for r in got} == want and len(got) == len(want)


def test_reads_ask_for_what_filters_leave(spark, calls):
    spark.dataSource.register(ExchangeCandles)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        what = {"symbols": json.dumps(["A", "B", "C"]), "interval": "1m", "step_ms": MINUTE, "start_ms": START, "end_ms": START + 30 * DAY, "fetch": "exchange:page", "limit": 1000}
        table = spark.read.format("exchange_candles").options(**what).load()
        three = table.filter((F.col("symbol") == "B") & (F.col("open_time_ms") >= START + 2 * DAY) & (F.col("open_time_ms") < START + 5 * DAY))
        assert three.count() == 3 * 1440
        assert {x[1] for x in calls()} == {"B"} and min(x[2] for x in calls()) == START + 2 * DAY and {x[3] for x in calls()} == {START + 5 * DAY - 1}
        n = len(calls())
        some = table.filter(F.col("symbol").isin("A", "C", "Z") & (F.col("open_time_ms") == START + MINUTE) & F.col("payload").startswith("["))
        assert sorted(r.symbol for r in ingest.parse_rows(some).collect()) == ["A", "C"] and len(calls()) == n + 2
        assert table.filter("symbol = 'Z' or open_time_ms < 0").filter("open_time_ms > 5 and open_time_ms < 3").count() == 0
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_a_failing_symbol_leaves_the_others_marked(spark, tables, calls):
    names = [f"S{k:03}" for k in range(300)]
    names[299], tables.raw = "S299FAIL", None
    spark.createDataFrame([(s, "1m", START - MINUTE, "active") for s in names], STATE).write.parquet(tables.state)
    how, said = Fetching("exchange:page", limit=100, wave=150, weight=100_000), []
    with pytest.raises(SyncFailed) as e:
        sync_missing(spark, universe(spark, *names), "1m", tables, how, now=at(3), progress=said.append)
    assert set(e.value.errors) == {"S299FAIL"} and "refused" in e.value.errors["S299FAIL"] and e.value.counts["accepted"] == 299 * 3
    got = marks(spark, tables)
    assert sum(m == START + 2 * MINUTE for m, _ in got.values()) == 299 and got["S299FAIL"][0] == START - MINUTE
    assert [x.get("done") for x in said] == [150, None]
    # what had come before the failure is kept, and the mark with it
    spark.createDataFrame([("LATEFAIL", "1m", START - MINUTE, "active")], STATE).write.mode("append").parquet(tables.state)
    with pytest.raises(SyncFailed):
        sync_missing(spark, universe(spark, "LATEFAIL"), "1m", tables, Fetching("exchange:page", limit=2), now=at(6))
    assert marks(spark, tables)["LATEFAIL"][0] == START + 3 * MINUTE


def test_archives_and_pages_have_bounds_of_their_own(spark, tmp_path, tables, calls):
    names = [f"C{k}" for k in range(6)]
    spark.createDataFrame([(s, "1m", START - MINUTE, "active") for s in names], STATE).write.parquet(tables.state)
    how = Fetching("exchange:slow_page", "exchange:slow_archive", limit=1000, tasks=3, archive_tasks=2)
    assert sync_missing(spark, universe(spark, *names), "1m", tables, how, now=datetime(2024, 7, 4, 0, 10, 30, tzinfo=UTC))["accepted"] == 6 * (3 * 1440 + 10)

    def most(kind):
        now = top = 0
        for _, by in sorted((t, d) for k, *_, a, b in calls() if k == kind for t, d in ((a, 1), (b, -1))):
            now += by
            top = max(top, now)
        return top

    assert most("slow_archive") == 2 and most("slow_page") == 3


def test_a_hole_that_stays_is_asked_for_a_few_times(spark, tables, calls):
    tables.spans = tables.state + "-spans"
    spark.createDataFrame([("HOLE", "1m", START - MINUTE, "active"), ("FULL", "1m", START - MINUTE, "active")], STATE).write.parquet(tables.state)
    how = Fetching("exchange:page", limit=100, tries=2, hole_age=timedelta(0))
    asked = []
    tables.raw = None
    for k in range(3):
        n = len(calls())
        sync_missing(spark, universe(spark, "HOLE", "FULL"), "1m", tables, how, now=at(10 + k))
        asked.append(sorted(((x[2] - START) // MINUTE, (x[3] - START) // MINUTE) for x in calls()[n:] if x[1] == "HOLE"))
    assert asked[0] == [(0, 9)]
    # the hole alone and what is new, not what lies between; the second time in vain is the last
    assert asked[1] == [(5, 5), (10, 10)] and asked[2] == [(11, 11)]
    assert marks(spark, tables)["HOLE"] == (START + 11 * MINUTE, "active") == marks(spark, tables)["FULL"]
    assert read_spans(spark, tables.spans).collect() == []
    assert lake.scan(spark, tables.silver).count() == 12 + 11


def test_a_young_hole_waits_and_a_late_listing_is_passed(spark, tables, calls):
    tables.spans = tables.state + "-spans"
    tables.raw = None
    spark.createDataFrame([("HOLE", "1m", START + 1490 * MINUTE, "active")], STATE).write.parquet(tables.state)
    # listed 100 minutes ago: what lacks before it is old and passed; YOUNG's hole is not old enough
    how = Fetching("exchange:page", limit=5000, tries=1, hole_age=timedelta(hours=1))
    for k in range(2):
        sync_missing(spark, universe(spark, "LISTED", "YOUNG"), "1m", tables, how, bootstrap_days=1, now=at(1500 + k))
    assert marks(spark, tables) == {"HOLE": (START + 1490 * MINUTE, "active"), "LISTED": (START + 1500 * MINUTE, "active"), "YOUNG": (START + 1494 * MINUTE, "active")}
    asked = sorted((x[1], (x[2] - START) // MINUTE, (x[3] - START) // MINUTE) for x in calls())
    assert [x for x in asked if x[0] == "LISTED"] == [("LISTED", 61, 1499), ("LISTED", 1500, 1500)] and ("YOUNG", 1495, 1495) in asked


def test_span_algebra_by_slots(spark):
    rng = random.Random(9)
    some = lambda n, wide: [("A" if rng.random() < 0.5 else "B", "1m", a * MINUTE, (a + rng.randrange(wide)) * MINUTE) for a in (rng.randrange(200) for _ in range(n))]
    slots = lambda rows: {(s, x) for s, _, a, b in rows for x in range(a, b + 1, MINUTE)}
    for _ in range(3):
        covered, asked = some(25, 8), some(12, 30)
        has = spark.createDataFrame(covered, spans.SPAN)
        wants = spans.merged(spark.createDataFrame(asked, spans.SPAN), MINUTE)
        rows = [tuple(r) for r in spans.lacking(has, wants, MINUTE).collect()]
        assert slots(rows) == slots(asked) - slots(covered) and sum((b - a) // MINUTE + 1 for _, _, a, b in rows) == len(slots(rows))
        assert all((s, a - MINUTE) not in slots(rows) for s, _, a, b in rows)
        assert slots(tuple(r) for r in spans.merged(has, MINUTE).collect()) == slots(covered)
    old = spark.createDataFrame([("A", "1m", 10, 20, 2), ("A", "1m", 40, 50, 1), ("B", "1m", 0, 9, 5)], spans.SPANS)
    new = spark.createDataFrame([("A", "1m", 12, 15), ("A", "1m", 21, 45), ("A", "1m", 60, 70), ("B", "1m", 5, 20)], spans.SPAN)
    assert sorted((r.symbol, r.start_ms, r.tries) for r in spans.tried(new, old).collect()) == [("A", 12, 3), ("A", 21, 2), ("A", 60, 1), ("B", 5, 6)]


def test_limiter_waits_once(monkeypatch):
    rng, clock, spent = random.Random(4), [0.0], []

    def sleep(s):
        assert s > 0
        clock[0] += s

    limiter = WeightLimiter(10, lambda: clock[0], sleep)
    for _ in range(4000):
        clock[0] += rng.random() * 4
        w = rng.randrange(1, 11)
        before = clock[0]
        limiter.acquire(w)
        spent.append((clock[0], w))
        assert sum(x for t, x in spent[-50:] if t > clock[0] - 60 + 1e-6) <= 10
        if clock[0] > before:  # a moment earlier it would not have fitted
            assert sum(x for t, x in spent[-50:-1] if t > clock[0] - 60 - 1e-6) + w > 10
    assert len(limiter.times) < 2000
    limiter.acquire(50)  # more than all: it waits until nothing else is there
    assert clock[0] >= spent[-1][0] + 60 - 1e-6


def test_marks_of_a_stream_do_not_jump_gaps(spark, tmp_path):
    state = f"{tmp_path}/m"
    sink = pipelines.candle_sink(f"{tmp_path}/s", MINUTE, state=state)
    batch = lambda *ks: ingest.stored(frame(spark, [candle("A", k, 1.0) for k in ks])).drop("seq").withColumns({"is_closed": F.lit(True), "event_time_ms": F.col("close_time_ms")})
    for ks, want in (((0, 1), 1), ((4, 5), 1), ((2, 3), 3), ((4,), 4)):
        sink(batch(*ks), 0)
        assert spark.read.parquet(state).first().last_open_time_ms == START + want * MINUTE
    assert lake.scan(spark, f"{tmp_path}/s").count() == 6


def test_source_tail_reads_no_more_than_it_needs(spark, tmp_path):
    from barforge.operators import strength

    root = f"{tmp_path}/silver"
    lake.upsert(ingest.stored(frame(spark, series("A", [1.0] * 300) + series("B", [1.0] * 200))), root)
    got = strength.source_tail(lake.scan(spark, root), "5", "1m", 3, 1)
    assert {r.symbol: r.n for r in got.groupBy("symbol").agg(F.count("*").alias("n")).collect()} == {"A": 20, "B": 20}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SortMergeJoin" not in plan and "GreaterThanOrEqual(open_time_ms" in plan
    assert strength.source_tail(lake.scan(spark, root).limit(0), "5", "1m", 3, 1).collect() == []
