"""Merges open the partitions that they touch, and no others: files are counted in Spark's own metrics."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from barforge.sources import ingest, lake

from exchange import DAY
from test_operators import MINUTE, START, candle, frame

SYMBOLS, DAYS = 40, 10


@pytest.fixture
def root(spark, tmp_path):
    """400 partitions of two candles each."""
    path = f"{tmp_path}/silver"
    at = F.lit(START) + F.col("id") % DAYS * DAY
    one = frame(spark, [candle("A", 0, 1.0)]).drop("symbol", "open_time_ms", "close_time_ms")
    rows = spark.range(SYMBOLS * DAYS).select(F.concat(F.lit("S"), (F.col("id") / DAYS).cast("int").cast("string")).alias("symbol"), at.alias("open_time_ms"))
    rows = rows.union(rows.withColumn("open_time_ms", F.col("open_time_ms") + MINUTE)).withColumn("close_time_ms", F.col("open_time_ms") + MINUTE - 1)
    lake.upsert(ingest.stored(rows.crossJoin(one)), path, "seq")
    assert len(list((tmp_path / "silver").glob("*/*/*/*.parquet"))) == SYMBOLS * DAYS
    return path


@pytest.fixture
def opened(spark):
    """Files of a table that the statements within ``work`` read."""
    store, bus = spark._jsparkSession.sharedState().statusStore(), spark.sparkContext._jsc.sc().listenerBus()
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)

    def count(table, work):
        bus.waitUntilEmpty()
        before = {store.executionsList().apply(i).executionId() for i in range(store.executionsList().length())}
        work()
        bus.waitUntilEmpty()
        files, runs = 0, store.executionsList()
        for run in (runs.apply(i).executionId() for i in range(runs.length())):
            if run in before:
                continue
            nodes, values = store.planGraph(run).allNodes(), store.executionMetrics(run)
            for node in (nodes.apply(i) for i in range(nodes.length())):
                if node.name().startswith("Scan parquet") and re.search(re.escape(table) + r"[/\]]", node.desc()):
                    for metric in (node.metrics().apply(i) for i in range(node.metrics().length())):
                        if metric.name() == "number of files read" and values.contains(metric.accumulatorId()):
                            files += int(values.apply(metric.accumulatorId()).replace(",", ""))
        return files

    yield count
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def new(spark, symbol="S7", at=START + 3 * DAY, close=9.0):
    return ingest.stored(frame(spark, [candle(symbol, (at - START) // MINUTE, close)]))


def test_one_row_into_400_partitions_reads_one(spark, root, opened):
    assert opened(root, lambda: lake.upsert(new(spark), root, "seq")) == 1
    assert lake.scan(spark, root).count() == 2 * SYMBOLS * DAYS
    got = lake.scan(spark, root, "1m", ["S7"], date(2024, 7, 4), date(2024, 7, 4)).orderBy("open_time_ms").collect()
    assert [r.close for r in got] == [9.0, 1.0]
    # a partition that is not there yet reads none
    assert opened(root, lambda: lake.upsert(new(spark, "NEW"), root, "seq")) == 0
    assert lake.scan(spark, root).count() == 2 * SYMBOLS * DAYS + 1


def test_keys_are_deleted_where_they_are(spark, root, opened):
    keys = spark.createDataFrame([("S7", "1m", START + 3 * DAY), ("S8", "1m", START), ("S8", "1m", START + MINUTE), ("GONE", "1m", START)], "symbol string, interval string, open_time_ms long")
    # what is left of two partitions is looked at, and then written
    assert opened(root, lambda: lake.delete_keys(root, keys)) <= 2 * 2 + 1
    assert lake.scan(spark, root).count() == 2 * SYMBOLS * DAYS - 3
    assert lake.scan(spark, root, "1m", ["S8"], date(2024, 7, 1), date(2024, 7, 1)).count() == 0


def test_scans_open_what_they_name(spark, root, opened):
    assert opened(root, lambda: lake.scan(spark, root, "1m", ["S1", "S2"], date(2024, 7, 2), date(2024, 7, 3)).collect()) == 4
    plan = lake.scan(spark, root, "1m", ["S1", "S2"])
    assert len(plan.inputFiles()) == 2 * DAYS and plan.count() == 4 * DAYS
    assert lake.scan(spark, root, "1m", ["NONE"]).count() == lake.scan(spark, root, "5m", ["S1"]).count() == 0


def test_gaps_by_series(spark, tmp_path, opened):
    path = f"{tmp_path}/gaps"
    gap = lambda s, k: (s, "1m", START + k * MINUTE, START, START + 99 * MINUTE)
    schema = "symbol string, interval string, missing_open_time_ms long, previous_open_time_ms long, next_open_time_ms long"
    lake.merge_gaps(spark.createDataFrame([gap(f"S{k}", 1) for k in range(30)], schema), path)
    assert opened(path, lambda: lake.merge_gaps(spark.createDataFrame([gap("S3", 1), gap("S3", 2)], schema), path)) == 1
    assert spark.read.parquet(path).count() == 31


def test_more_partitions_than_are_named(spark, root, monkeypatch):
    monkeypatch.setattr(lake, "MOST_NAMED", 3)
    rows = new(spark, "S1").unionByName(new(spark, "S2")).unionByName(new(spark, "S3")).unionByName(new(spark, "S4", START)).unionByName(new(spark, "ODD:1/2"))
    lake.upsert(rows, root, "seq")
    assert lake.scan(spark, root).count() == 2 * SYMBOLS * DAYS + 1
    assert lake.scan(spark, root).filter("close = 9").count() == 5
    keys = rows.select("symbol", "interval", "open_time_ms")
    lake.delete_keys(root, keys)
    assert lake.scan(spark, root).count() == 2 * SYMBOLS * DAYS - 4 and lake.scan(spark, root).filter("symbol = 'ODD:1/2'").count() == 0


def test_rebuilds_touch_their_gap_series_alone(spark, tmp_path, opened):
    raw, silver, quarantine, gaps = (f"{tmp_path}/{x}" for x in ("raw", "silver", "quarantine", "gaps"))
    rows = [candle(s, k, 1.0) for s in ("A", "B", "C") for k in (0, 2, 3)]
    lake.write_cleaned(ingest.stored(frame(spark, rows)), MINUTE, raw, silver, quarantine, gaps)
    assert opened(gaps, lambda: lake.renormalize(spark, raw, silver, quarantine, gaps, "1m", MINUTE, ["B"], overwrite=True)) <= 3
    assert sorted(r.symbol for r in spark.read.parquet(gaps).collect()) == ["A", "B", "C"] and lake.scan(spark, silver).count() == 9
