"""Column builders that Spark has no single function for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T


def bucket(at: Column | str, width: int) -> Column:
    """Start of the bucket that holds ``at``; floors below zero as well."""
    at = F.col(at) if isinstance(at, str) else at
    return at - F.pmod(at, F.lit(width).cast("long"))


def ratio(n: Column, d: Column) -> Column:
    """IEEE division, also under ANSI rules: a zero divisor gives an infinity or NaN."""
    by_zero = F.when(n > 0, F.lit(float("inf"))).when(n < 0, F.lit(float("-inf"))).when(n.isNotNull(), F.lit(float("nan")))
    return F.when(d == 0, by_zero).otherwise(F.try_divide(n, d))


def average_rank(value: Column, within: str, descending: bool = False) -> Column:
    """Rank from 1 with ties at their mean, among the non-null values of ``within``."""
    order = value.desc_nulls_last() if descending else value.asc_nulls_last()
    ties = F.count("*").over(Window.partitionBy(within, value))
    return F.when(value.isNotNull(), F.rank().over(Window.partitionBy(within).orderBy(order)) + (ties - 1) / F.lit(2.0))


def with_ema(df: DataFrame, value: str, span: int, by: str, order: str, name: str) -> DataFrame:
    """Exponential mean with alpha = 2 / (span + 1), seeded with the first value.

    The sum of beta**j x[i - j] is built by doubling: with y_0 = alpha x (the first x whole)
    and y_k+1[i] = y_k[i] + beta**(2**k) y_k[i - 2**k], y_k holds 2**k terms. It stops where
    the next terms weigh less than 1e-17. All steps share one window order, so the series is
    shuffled and sorted once, whatever its length, and nothing leaves the JVM.
    """
    w = Window.partitionBy(by).orderBy(order)
    alpha, beta = 2.0 / (span + 1), 1.0 - 2.0 / (span + 1)
    df = df.withColumn(name, F.when(F.row_number().over(w) == 1, F.col(value)).otherwise(alpha * F.col(value)))
    reach = 1
    while beta**reach > 1e-17:
        df = df.withColumn(name, F.col(name) + F.lit(beta**reach) * F.coalesce(F.lag(name, reach).over(w), F.lit(0.0)))
        reach *= 2
    return df


def rows_back(w: WindowSpec, n: int, upto: int = 0) -> WindowSpec:
    return w.rowsBetween(-n, upto)


def epoch_ms(df: DataFrame, column: str) -> Column:
    """Epoch milliseconds of a timestamp, read as UTC whatever the session's zone is."""
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        return F.expr(f"unix_micros(cast(convert_timezone('UTC', current_timezone(), {column}) as timestamp)) div 1000")
    return F.expr(f"unix_micros({column}) div 1000")
