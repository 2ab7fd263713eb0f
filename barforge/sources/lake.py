"""Partitioned Parquet tables: scans, keep-last merges, overlays, partition rewrites."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barforge.functions.timeframes import DAY
from barforge.operators.quality import clean, find_gaps
from barforge.schema import CANDLE, GAP, GAP_KEY, KEY

PARTS = ["interval", "symbol", "date"]
GAP_PARTS = ["interval", "symbol"]
#: Where a table is while another takes its place.
ASIDE = ".before"


def scratch(spark: SparkSession) -> str:
    """A new folder that all executors share: below ``spark.checkpoint.dir`` where it is set.

    Only where nothing is set and all runs on this machine (tests) it is a temporary one.
    """
    known = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.barforge.scratch", None)
    if known is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        known = "file://" + tempfile.mkdtemp(prefix="barforge-")
        spark.conf.set("spark.barforge.scratch", known)
    return f"{known.rstrip('/')}/lake-{uuid.uuid4().hex}"


def _path(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a table at ``path``; one that a broken ``replace`` had moved aside comes back."""
    fs, at = _path(spark, path)
    if not fs.exists(at) and fs.exists(_path(spark, path + ASIDE)[1]):
        fs.rename(_path(spark, path + ASIDE)[1], at)
    return fs.exists(at)


def remove(spark: SparkSession, path: str) -> None:
    fs, at = _path(spark, path)
    fs.delete(at, True)


def scan(spark: SparkSession, root: str, interval: str | None = None, symbols: list[str] | None = None, start: date | None = None, end: date | None = None, schema: str = CANDLE) -> DataFrame:
    """Rows of the table at ``root``; the filters prune partitions. A missing table is empty."""
    if not exists(spark, root):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", root).parquet(*_folders(spark, root, interval, symbols, start, end))
    if interval is not None:
        rows = rows.filter(F.col("interval") == interval)
    if symbols is not None:
        rows = rows.filter(F.col("symbol").isin(symbols))
    if start is not None:
        rows = rows.filter(F.col("date") >= start.isoformat())
    if end is not None:
        rows = rows.filter(F.col("date") <= end.isoformat())
    return rows


def _folders(spark: SparkSession, root: str, interval: str | None, symbols: list[str] | None, start: date | None, end: date | None) -> list[str]:
    """The folders that hold what is asked for, as far as it names few: no other is listed.

    Where no folder of the interval is there, as in a table without partitions, it is the root.
    """
    top = _folder(spark, root, {"interval": interval}) if interval is not None else None
    if top is None or not _there(spark, [top]):
        return [root]
    if not symbols or len(symbols) > MOST_NAMED:
        return [top]
    places = [{"interval": interval, "symbol": x} for x in symbols]
    days = (end - start).days + 1 if start is not None and end is not None else 0
    if 0 < days * len(symbols) <= MOST_NAMED:
        places = [p | {"date": (start + timedelta(days=k)).isoformat()} for p in places for k in range(days)]
    return _there(spark, [_folder(spark, root, p) for p in places]) or [top]


def keep_last(rows: DataFrame, key: list[str], version: str | list[str]) -> DataFrame:
    """One row for each key, that of greatest version; partial aggregates go before the shuffle."""
    order = F.struct(*([version] if isinstance(version, str) else version))
    rest = [c for c in rows.columns if c not in key]
    best = rows.groupBy(*key).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return best.select(*(F.col(c) if c in key else F.col(f"_row.{c}").alias(c) for c in rows.columns))


def overlay(silver: DataFrame, hot: DataFrame | None, key: list[str] = KEY) -> DataFrame:
    """``silver`` with ``hot`` rows in place of those with the same key."""
    if hot is None:
        return silver
    both = silver.withColumn("_version", F.lit(0)).unionByName(hot.select(*silver.columns).withColumn("_version", F.lit(1)))
    return keep_last(both, key, "_version").drop("_version")


#: Partitions that a merge names one by one, and opens without a look at any other.
MOST_NAMED = 4096
#: One writer at a time within this driver: a merge reads partitions and puts others in their place.
WRITING = threading.RLock()


def _folder(spark: SparkSession, root: str, values: dict) -> str:
    """Where the partition of ``values`` (by column, in order) is, spelled as Spark spells it."""
    spell = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    return "/".join((root.rstrip("/"), *(spell(c, None if v is None else str(v)) for c, v in values.items())))


def _there(spark: SparkSession, folders: list[str]) -> list[str]:
    """Those of ``folders`` that exist, asked for side by side."""
    with ThreadPoolExecutor(16) as pool:
        found = pool.map(lambda f: _path(spark, f)[0].exists(_path(spark, f)[1]), folders)
        return [f for f, here in zip(folders, found, strict=True) if here]


def named(places: DataFrame, parts: list[str]) -> list[dict] | None:
    """The partitions that ``places`` fall into, or None if they are more than MOST_NAMED."""
    rows = places.select(*parts).distinct().limit(MOST_NAMED + 1).collect()
    return [r.asDict() for r in rows] if len(rows) <= MOST_NAMED else None


def _schema(root: str, folder: str, places: DataFrame, parts: list[str]) -> T.StructType:
    """That of the table, by one of its folders; partition columns are as in ``places``."""
    found = places.sparkSession.read.option("basePath", root).parquet(folder).schema
    return T.StructType([f if f.name not in parts else places.schema[f.name] for f in found])


def stored_in(root: str, places: DataFrame, parts: list[str], touched: list[dict] | None, schema=None) -> tuple[DataFrame, list[dict] | None]:
    """(rows of the table at ``root`` in the partitions that ``places`` touch, those that are there).

    touched: what ``named`` says of ``places``.

    Up to MOST_NAMED partitions are opened by name: no other is listed or read, however many
    the table has. A batch that touches more is a load of the table itself; it reads what the
    ranges of its partition values leave, and the partitions are None.
    """
    spark = places.sparkSession
    if touched is None:
        ends = places.agg(*(f(c).alias(f"{n}_{c}") for c in parts for n, f in (("low", F.min), ("high", F.max)))).first()
        rows = spark.read.schema(schema or _schema(root, root, places, parts)).parquet(root)
        for c in parts:
            rows = rows.filter(F.col(c).between(ends[f"low_{c}"], ends[f"high_{c}"]))
        return rows.join(places.select(*parts).distinct(), parts, "left_semi"), None
    folders = {_folder(spark, root, p): p for p in touched}
    there = _there(spark, list(folders))
    if not there:
        return spark.createDataFrame([], schema or places.select(*parts).schema), []
    rows = spark.read.schema(schema or _schema(root, there[0], places, parts)).option("basePath", root).parquet(*there)
    return rows, [folders[f] for f in there]


def _write(rows: DataFrame, root: str, parts: list[str]) -> None:
    """Put ``rows``, which may come from the same partitions, in the place of exactly those they fall into."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(root)


def upsert(rows: DataFrame, root: str, sequence: str | None = None, key: list[str] = KEY, parts: list[str] = PARTS) -> None:
    """Merge ``rows`` into the table: incoming rows win, among them the last by ``sequence``.

    Only partitions that incoming rows fall into are opened and rewritten, after one shuffle
    by partition that serves the merge and the writing. A run that is repeated gives the same
    table.
    """
    spark = rows.sparkSession
    order = F.col(sequence) if sequence else F.lit(0).cast("long")
    new = keep_last(rows.withColumn("_v", order.cast("long")), key, "_v").drop("_v", *([sequence] if sequence else []))
    staged = scratch(spark)
    new.write.parquet(staged)
    new = spark.read.schema(new.schema).parquet(staged)
    with WRITING:
        touched = named(new, parts)
        if touched != []:
            both = new.withColumn("_v", F.lit(1))
            if exists(spark, root):
                both = both.unionByName(stored_in(root, new, parts, touched, new.schema)[0].withColumn("_v", F.lit(0)))
            both = both.repartition(*parts)
            _write(keep_last(both, [*parts, *(k for k in key if k not in parts)], "_v").drop("_v"), root, parts)
    remove(spark, staged)


def changed(root: str, places: DataFrame, parts: list[str], schema: str | None, change: Callable[[DataFrame], DataFrame]) -> None:
    """Replace the partitions that ``places`` touch by what ``change`` leaves of their rows.

    Partitions with rows left are overwritten first, the others dropped then: a run that ends
    in between has removed less, and nothing else, and can be repeated.
    """
    spark = places.sparkSession
    with WRITING:
        old, touched = stored_in(root, places, parts, named(places, parts), schema)
        if touched == []:
            return
        left = change(old)
        full = {tuple(r) for r in left.select(*parts).distinct().collect()}  # partitions, not rows
        before = touched if touched is not None else [r.asDict() for r in old.select(*parts).distinct().collect()]
        if full:
            _write(left.repartition(*parts), root, parts)
        emptied = [p for p in before if tuple(p[c] for c in parts) not in full]
        if emptied:
            drop_partitions(root, spark.createDataFrame([tuple(p[c] for c in parts) for p in emptied], places.select(*parts).schema))


def delete_keys(root: str, keys: DataFrame, key: list[str] = KEY, parts: list[str] = PARTS) -> None:
    """Remove rows by key. Only partitions that keys fall into are opened; one of which nothing
    is left keeps no files."""
    spark = keys.sparkSession
    if not exists(spark, root):
        return
    if "date" in parts and "date" not in keys.columns:
        keys = keys.withColumn("date", F.date_format(F.timestamp_millis("open_time_ms"), "yyyy-MM-dd"))
    places = keys.select(*dict.fromkeys([*parts, *key])).distinct()
    changed(root, places, parts, None, lambda old: old.join(places.select(*key), key, "left_anti"))


def drop_partitions(root: str, parts: DataFrame) -> None:
    """Delete the partition folders listed in ``parts`` (as many as a rebuild covers)."""
    spark = parts.sparkSession
    for row in parts.toLocalIterator():
        remove(spark, _folder(spark, root, row.asDict()))


def merge_gaps(gaps: DataFrame, path: str) -> None:
    """Add gaps to the report, the last detection of each missing slot standing.

    The report is partitioned by series, and only those of ``gaps`` are rewritten.
    """
    new = gaps.withColumns({"detected_at": F.current_timestamp(), "status": F.lit("open"), "reason": F.lit("missing_kline")})
    upsert(new, path, key=GAP_KEY, parts=GAP_PARTS)


def replace(rows: DataFrame, path: str, parts: list[str] | None = None) -> None:
    """Put a table in the place of another that ``rows`` may read.

    It is written beside it; then the old one is moved aside, the new one into its place, and
    the old one deleted. Whenever that breaks off, one of the two is found whole by ``exists``.
    """
    spark = rows.sparkSession
    beside = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    exists(spark, path)
    write = rows.write.partitionBy(*parts) if parts else rows.write
    write.parquet(beside)
    fs, at = _path(spark, path)
    aside = _path(spark, path + ASIDE)[1]
    if fs.exists(at):
        fs.delete(aside, True)
        fs.rename(at, aside)
    fs.rename(_path(spark, beside)[1], at)
    fs.delete(aside, True)


def without_days(gaps: DataFrame, days: DataFrame) -> DataFrame:
    """Gaps that fall on none of the (symbol, interval, date) rows of ``days``."""
    start = F.unix_millis(F.to_timestamp(F.concat("date", F.lit(" 00:00:00 UTC")), "yyyy-MM-dd HH:mm:ss z"))
    covered = days.select("symbol", "interval", start.alias("_day")).distinct()
    at = F.col("missing_open_time_ms")
    return gaps.withColumn("_day", at - F.pmod(at, F.lit(DAY))).join(covered, ["symbol", "interval", "_day"], "left_anti").drop("_day")


def write_cleaned(candles: DataFrame, step_ms: int, raw: str | None, silver: str, quarantine: str, gap_report: str, sequence: str = "seq") -> dict[str, int]:
    """Raw as it came, silver accepted, quarantine rejected and conflicting rows, gaps reported."""
    batch = candles.persist()
    try:
        got = clean(batch, step_ms, sequence)
        counts = got.counters().first().asDict() | {"gaps": 0}
        if raw:
            upsert(batch, raw, sequence)
        if counts["accepted"]:
            upsert(got.accepted, silver, sequence)
            gaps = got.gaps
            counts["gaps"] = gaps.count()
            if counts["gaps"]:
                merge_gaps(gaps, gap_report)
        if counts["rejected"] or counts["conflicts"]:
            upsert(got.judged.filter("verdict in ('rejected', 'conflict')").drop("verdict", "reason"), quarantine, sequence)
        return counts
    finally:
        batch.unpersist()


def renormalize(
    spark: SparkSession, raw: str, silver: str, quarantine: str, gap_report: str, interval: str, step_ms: int, symbols: list[str] | None = None,
    start: date | None = None, end: date | None = None, overwrite: bool = False, progress: Callable[[dict[str, int]], None] | None = None,
) -> dict[str, int]:
    """Clean stored raw partitions again. All of them are judged in one job, each day by itself.

    With ``overwrite`` the outputs of the chosen partitions, or everything if none is chosen,
    go first.
    """
    rows = scan(spark, raw, interval, symbols, start, end)
    days = rows.select("interval", "symbol", "date").distinct().persist()
    if overwrite:
        if symbols is None and start is None and end is None:
            for path in (silver, quarantine, gap_report):
                remove(spark, path)
        else:
            for path in (silver, quarantine):
                drop_partitions(path, days)
            if exists(spark, gap_report):
                changed(gap_report, days, GAP_PARTS, GAP, lambda gaps: without_days(gaps, days))
    staged = scratch(spark)
    # the interval carries the day, so that gaps are those within a day, as ingestion has them
    daily = rows.withColumn("open_time", F.timestamp_millis("open_time_ms")).withColumn("seq", F.monotonically_increasing_id())
    clean(daily, step_ms).judged.write.parquet(staged)
    judged = spark.read.parquet(staged)
    accepted = judged.filter("verdict = 'accepted'").drop("verdict", "reason")
    per_day = accepted.withColumn("interval", F.concat_ws("|", "interval", "date"))
    gaps = find_gaps(per_day, step_ms).withColumn("interval", F.split("interval", r"\|")[0])
    counts = judged.agg(
        F.count("*").alias("raw"), *(F.count_if(F.col("verdict") == v).alias(n) for v, n in (("accepted", "accepted"), ("rejected", "rejected"), ("conflict", "conflicts")))
    ).first().asDict() | {"files": days.count(), "gaps": gaps.count()}
    if counts["accepted"]:
        upsert(accepted, silver, "seq")
    if counts["rejected"] + counts["conflicts"]:
        upsert(judged.filter("verdict in ('rejected', 'conflict')").drop("verdict", "reason"), quarantine, "seq")
    if counts["gaps"]:
        merge_gaps(gaps, gap_report)
    if progress:
        progress(counts)
    days.unpersist()
    remove(spark, staged)
    return counts


def write_features(features: DataFrame, root: str, interval: str) -> None:
    """One partition for each UTC day of the bars."""
    dated = features.withColumns({"interval": F.lit(interval), "date": F.date_format(F.timestamp_millis("ts_ms"), "yyyy-MM-dd")})
    _write(dated.repartition("interval", "date"), root, ["interval", "date"])


def write_table(rows: DataFrame, path: str) -> int:
    """Put ``rows`` in the place of a table; nothing is written, and what is there stays, without rows."""
    spark = rows.sparkSession
    staged = scratch(spark)
    rows.write.parquet(staged)
    got = spark.read.schema(rows.schema).parquet(staged)
    n = got.count()
    if n:
        replace(got, path)
    remove(spark, staged)
    return n
