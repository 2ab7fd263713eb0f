"""Live streams through real queries: connections that end, fail, and say nothing; batches computed twice."""

import json
import time
from pathlib import Path

import exchange
import pytest

from barforge.sources import lake
from barforge.streaming import pipelines
from barforge.streaming.live import Fills, Live
from barforge.streaming.receivers import LOG, MESSAGES, Receivers, Receiving

from exchange import MINUTE, START


@pytest.fixture
def calls(spark):
    spark.sparkContext.addPyFile(exchange.__file__)
    path = Path(exchange.CALLS)
    path.write_text("")
    Path(exchange.GO).unlink(missing_ok=True)
    yield lambda: [json.loads(x) for x in path.read_text().splitlines()]
    path.unlink()
    Path(exchange.GO).unlink(missing_ok=True)


def until(seconds, true):
    end = time.monotonic() + seconds
    while not true():
        assert time.monotonic() < end, "it did not come about"
        time.sleep(0.2)


def candles(spark, silver):
    return sorted((r.symbol, (r.open_time_ms - START) // MINUTE) for r in lake.scan(spark, silver).collect())


def receiving(*symbols, **more):
    return Receiving("exchange:mixed", list(symbols), "1m", per_connection=1, **({"seconds": 0.3, "settle": 0.3, "reconnect": 0.3} | more))


@pytest.fixture
def live(spark, tmp_path, calls):
    made = []

    def start(how, sink=None, **more):
        sink = sink or pipelines.candle_sink(f"{tmp_path}/silver", MINUTE)
        made.append(Live(spark, how, sink, f"{tmp_path}/spool", f"{tmp_path}/checkpoint", restart=0.2, **more))
        return made[-1]

    yield start
    for one in made:
        one.stop()


def test_an_orderly_end_fills_its_own_shard_while_another_is_silent(spark, tmp_path, live):
    filled, silver = [], f"{tmp_path}/silver"
    stream = live(receiving("A", "B", once=True), fill=filled.append, fill_at_start=False)
    until(30, lambda: filled and lake.exists(spark, silver) and len(candles(spark, silver)) == 3)
    assert filled == [["A"]] and candles(spark, silver) == [("A", 0), ("A", 1), ("A", 2)]
    assert stream.receivers.alive(), "B had not spoken yet"
    assert stream.counts["end"] == 1
    Path(exchange.GO).touch()
    counts = stream.wait(60)
    assert filled == [["A"], ["B"]] and candles(spark, silver)[-1] == ("B", 0)
    assert (counts["messages"], counts["open"], counts["end"], counts["failed"], counts["fill"]) == (4, 2, 2, 0, 2)


def test_silence_holds_nobody_up(spark, tmp_path, live):
    batches = []

    def sink(batch, batch_id):
        batches.append([r.symbol for r in batch.select("symbol").collect()])

    stream = live(receiving("A", "B", once=True), sink)
    until(20, lambda: sum(map(len, batches)) >= 3)
    assert len(batches) <= 2 and {s for b in batches for s in b} == {"A"} and stream.receivers.alive()


def test_failures_open_another_generation_and_fill_again(spark, tmp_path, live, calls):
    filled, said = [], []
    stream = live(receiving("F", "L"), fill=filled.append, progress=said.append)
    until(40, lambda: sum(x["kind"] == "failed" for x in said) >= 2)
    stream.stop()
    opened = [x for x in said if x["kind"] == "open" and x["shard"] == 0]
    assert [x["again"] for x in opened][:2] == [False, True] and len({x["generation"] for x in opened}) == len(opened)
    assert sum(x["kind"] == "open" for x in said if x.get("shard") == 1) == 1
    assert any("gone" in x["error"] for x in said if x["kind"] == "failed")
    assert sorted(set(map(tuple, filled)))[0] == ("F",) and sum("L" in x for x in filled) == 1  # at the start alone
    assert [x["status"] for x in said if x["kind"] == "shutdown"] == ["requested", "complete"]
    n = len(calls())
    time.sleep(1)
    assert len(calls()) == n and not stream.receivers.alive()


def test_a_batch_computed_twice_has_the_same_rows(spark, tmp_path, live):
    seen = []

    def sink(batch, batch_id):
        rows = sorted((r.symbol, r.open_time_ms) for r in batch.collect())
        again = sorted((r.symbol, r.open_time_ms) for r in batch.collect())
        assert rows == again
        seen.append((batch_id, rows))
        if len([x for x in seen if x[0] == batch_id]) == 1 and rows:
            raise ValueError("storing failed")

    stream = live(receiving("L"), sink)
    until(60, lambda: (stream.wait(0.1), len({b for b, r in seen if r}) >= 2 and len(seen) >= 4)[1])
    stream.stop()
    for batch in {b for b, _ in seen}:
        assert len({json.dumps(r) for b, r in seen if b == batch}) == 1
    told = [k for b, rows in dict(seen).items() for _, k in rows]
    assert told == sorted(told) and stream.counts["restarts"] >= 2


def test_what_is_logged_stays_for_the_next_start(spark, tmp_path, live):
    def fails(batch, batch_id):
        raise ValueError("no room")

    with pytest.raises(Exception, match="no room"):
        live(receiving("A", once=True), fails, most_restarts=0).wait(60)
    silver = f"{tmp_path}/silver"
    live(receiving("C", once=True)).wait(60)
    assert candles(spark, silver) == [("A", 0), ("A", 1), ("A", 2)]


def test_the_log(spark, tmp_path, calls):
    spool = f"{tmp_path}/spool"
    Path(exchange.GO).touch()
    receivers = Receivers(spark, spool, receiving("A", "B", once=True, messages=2))
    receivers.thread.join(40)
    rows = spark.read.schema(LOG).json(f"{spool}/{MESSAGES}").orderBy("shard", "generation", "place").collect()
    assert [(r.shard, r.place, r.event) for r in rows] == [(0, 0, "open"), (0, 1, "message"), (0, 2, "message"), (0, 3, "message"), (0, 4, "end"), (1, 0, "open"), (1, 1, "message"), (1, 2, "end")]
    assert not receivers.alive() and list((tmp_path / "spool" / "_beside").iterdir()) == []
    assert len([x for x in (tmp_path / "spool" / MESSAGES).glob("0-*.json")]) == 3


def test_fills_wait_for_each_other():
    filled, said = [], []

    def fill(symbols):
        filled.append(symbols)
        time.sleep(0.3)
        if symbols == ["c"]:
            raise OSError("no connection")

    fills = Fills(fill, [["a"], ["b"], ["c"]], lambda kind, **x: said.append(kind))
    fills.ask({2})
    time.sleep(0.1)
    fills.ask({0})
    fills.ask({1, 0})
    assert fills.drain(5) and filled == [["c"], ["a", "b", "c"]] and said == ["fill", "fill_failed", "fill"] and len(fills.failures) == 1
    fills.close()


def test_marks_are_saved_now_and_then(spark, tmp_path):
    from barforge.operators import quality
    from barforge.sources import ingest
    from barforge.sources.sync import read_state
    from test_operators import candle, frame

    state, now = f"{tmp_path}/state", [0.0]
    marks = pipelines.Marks(state, MINUTE, 30.0, lambda: now[0])
    accepted = lambda *ks: quality.clean(ingest.stored(frame(spark, [candle("A", k, 1.0) for k in ks])), MINUTE).accepted
    stored = lambda: {r.symbol: r.last_open_time_ms for r in read_state(spark, state).collect()}
    marks.move(accepted(0, 1))
    now[0] = 10
    marks.move(accepted(2))
    assert stored() == {"A": START + MINUTE} and marks.known["A", "1m"] == START + 2 * MINUTE
    # a fill has come further meanwhile: its mark stands, and the stream goes on from it
    lake.replace(ingest.merge_state(read_state(spark, state), spark.createDataFrame([("A", "1m", START + 5 * MINUTE, "active"), ("B", "1m", START, "active")], "symbol string, interval string, last_open_time_ms long, status string")), state)
    now[0] = 41
    marks.move(accepted(3))
    assert stored() == {"A": START + 5 * MINUTE, "B": START}
    marks.move(accepted(6))
    marks.save(spark)
    assert stored()["A"] == START + 6 * MINUTE


def test_the_command(spark, tmp_path, calls, capsys):
    from barforge import cli

    spark.createDataFrame([("A",), ("B",)], "symbol string").write.json(f"{tmp_path}/current")
    places = [f"--{x}={tmp_path}/{x}" for x in ("current", "silver", "raw", "quarantine", "gaps", "state", "spans", "spool", "checkpoint", "hot", "open-candles")]
    cli.main(["stream-klines", *places, "--connect=exchange:messages", "--once", "--streams-per-connection=1"], spark)
    assert candles(spark, f"{tmp_path}/silver") == [("A", 0), ("A", 1), ("B", 0), ("B", 1)] and not lake.exists(spark, f"{tmp_path}/hot")
    assert {(r.symbol, r.last_open_time_ms) for r in spark.read.parquet(f"{tmp_path}/state").collect()} == {("A", START + MINUTE), ("B", START + MINUTE)}
    said = capsys.readouterr().out
    assert said.count("'kind': 'end'") == 2 and "'status': 'complete'" in said
