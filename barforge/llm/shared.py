"""What the training-data operators share: intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which driver and executors see alike.

    Only where nothing is set and all runs on this machine (tests) a temporary folder is
    chosen and recorded in the session, so that later calls agree.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    known = spark.conf.get("spark.barforge.shared", None)
    if known is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        known = "file://" + tempfile.mkdtemp(prefix="barforge-")
        spark.conf.set("spark.barforge.shared", known)
    return known


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/barforge-{label}-{uuid.uuid4().hex}"


#: Has Spark delete the shuffle files of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Rows that one task writes, at the least, of a table whose size is known; tasks for each core
#: where writing is little beside what makes the rows.
TASK_ROWS, TASKS_A_CORE = 100_000, 3


def stash(df: DataFrame, label: str, rows: int | None = None, light: bool = False) -> DataFrame:
    """Write ``df`` once into the shared folder and return a reader of it.

    This cuts lineage with files that survive lost executors: a later failure re-reads
    the table instead of recomputing what led to it. The shuffles that made it go. With
    ``rows``, about how many it has at most, no more tasks write it than that asks for, or,
    unless the rows are ``light`` to make, than keep the cores busy: many small files cost
    more than they hold.
    """
    spark = df.sparkSession
    if rows is not None:
        busy = 1 if light else max(TASKS_A_CORE * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")) // 4)
        df = df.coalesce(max(busy, 1 + rows // TASK_ROWS))
    path = fresh_path(spark, label)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    table = spark.read.schema(df.schema).parquet(path)
    table._barforge_path = path
    return table


#: How many files a task may hold open; beyond that Spark sorts its rows by folder first.
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def stash_apart(df: DataFrame, label: str, column: str, parts: int = 1) -> tuple[DataFrame, ...]:
    """(rows in which ``column`` is null, the others) of ``df``, written in one pass and discarded each by itself.

    The others are as many tables as ``parts``, by the remainder of the column, a whole number
    then.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    before = {c: spark.conf.get(c, v) for c, v in ((CLEANUP, "false"), (WRITERS, "0"))}
    spark.conf.set(CLEANUP, "true")
    spark.conf.set(WRITERS, str(1 + parts))
    part = F.lit(0) if parts == 1 else F.pmod(F.col(column), F.lit(parts)).cast("int")
    try:
        df.withColumn("_apart", F.when(F.col(column).isNull(), -1).otherwise(part)).write.partitionBy("_apart").parquet(path)
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    out = []
    for kind in range(-1, parts):
        own = f"{path}/_apart={kind}"
        where = spark._jvm.org.apache.hadoop.fs.Path(own)
        files = where.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(where)  # no row of this kind, no folder
        table = spark.read.schema(df.schema).parquet(own)
        table._barforge_path = own
        out.append(table)
    return tuple(out)


def discard(df: DataFrame | None) -> None:
    """Delete a stashed table that nothing will read again."""
    path = getattr(df, "_barforge_path", None)
    if path is None:
        return
    spark = df.sparkSession
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


#: Bits of a sieve. However many keys there are, no more than SIEVE / 64 rows are broadcast.
SIEVE = 1 << 24


def _marked(rows: DataFrame, keys: DataFrame, column: str, how: str) -> DataFrame:
    """``rows`` with _maybe: whether the bits of ``column`` are set by one of ``keys``."""
    slot = F.col(column).bitwiseAND(F.lit(SIEVE - 1))
    bit = F.expr(f"cast(`{column}` & 63 as int)")
    words = keys.select(F.shiftright(slot, 6).alias("_word"), bit.alias("_bit")).groupBy("_word").agg(F.expr("bit_or(shiftleft(1L, _bit))").alias("_bits"))
    met = rows.withColumn("_bit", bit).join(F.broadcast(words), F.shiftright(slot, 6) == F.col("_word"), how)
    return met.withColumn("_maybe", F.expr("coalesce(shiftrightunsigned(_bits, _bit) & 1L, 0L) = 1")).select(*rows.columns, "_maybe")


def sieved(rows: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """Those of ``rows`` whose ``column`` may be among that of ``keys``: all that are, and few others.

    The column has to be a hash. Keys set bits of a map of fixed size, which is broadcast as
    64-bit words; a join on the column behind it then shuffles little that finds no partner.
    With far more than SIEVE keys everything passes, and only that saving is lost.
    """
    return _marked(rows, keys, column, "inner").filter("_maybe").drop("_maybe")


def parted(rows: DataFrame, keys: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """(rows that ``sieved`` would pass, all the others)."""
    marked = _marked(rows, keys, column, "left")
    return marked.filter("_maybe").drop("_maybe"), marked.filter("not _maybe").drop("_maybe")


#: Bytes of a table that is broadcast after they have been counted.
BROADCAST_BYTES = 32 << 20


def broadcast_if_small(table: DataFrame, size: Column) -> DataFrame | None:
    """A stashed table to be broadcast if its rows, of ``size`` bytes each, are few enough; else None."""
    total = table.agg(F.sum(size)).first()[0] or 0
    return F.broadcast(table) if total <= BROADCAST_BYTES else None


def respread(*keys: str):
    """Grouping columns for an aggregate that is joined on ``keys`` afterwards.

    The extra key is a function of the others, so the groups are the same; but the
    aggregate's partitioning no longer satisfies the join, which therefore deals out both
    sides itself, and adaptive execution may split whichever partitions turn out skewed.
    """
    return [*map(F.col, keys), F.xxhash64(*keys).alias("_spread")]


def with_keys(docs: DataFrame) -> DataFrame:
    """(_key, _row): each row of ``docs`` as a struct, with a key that is null in none and the same in no two.

    It is the doc_id where that is so already. Else rows are numbered in the order of doc_id,
    nulls last, and written once, so that every reader sees the same numbers. The struct
    keeps the names of docs' columns apart from those that joins add.
    """
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"))
    key = F.col("_row.doc_id").cast("long")
    if rows.select(key.alias("k")).groupBy("k").count().filter("k is null or count > 1").isEmpty():
        return rows.select(key.alias("_key"), "_row")
    order = key.asc_nulls_last(), F.xxhash64("_row")
    return stash(rows.orderBy(*order).select(F.monotonically_increasing_id().alias("_key"), "_row"), "keys")


#: Rows of an Arrow batch: whole documents are long, and a batch of Spark's default of 10,000 is
#: held several times over, in each task of the JVM and in its worker.
ARROW_ROWS, ARROW_SETTING = 1000, "spark.sql.execution.arrow.maxRecordsPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Have the session hand documents to workers in batches of ARROW_ROWS, if it has larger ones."""
    if int(spark.conf.get(ARROW_SETTING)) > ARROW_ROWS:
        spark.conf.set(ARROW_SETTING, str(ARROW_ROWS))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
