"""Equal-weight backtest: turnover, costs, equity and its summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barforge.functions.exprs import ratio

AT = "feature_available_time_ms"


def next_returns(features: DataFrame) -> DataFrame:
    """For each bar the return to the symbol's next bar, and that bar's time."""
    w = Window.partitionBy("symbol").orderBy("ts_ms")
    return features.select("ts_ms", "symbol", "close").select(
        F.col("ts_ms").alias(AT), "symbol", F.lead("ts_ms").over(w).alias("return_time_ms"),
        F.round(ratio(F.lead("close").over(w), F.col("close")) - 1, 12).alias("next_return"),
    )


def dense_weights(signals: DataFrame) -> DataFrame:
    """Weights of every symbol at every rebalance, absent ones 0, with the weight before.

    The grid of times and symbols is the feature itself, each side made distinct first.
    """
    weights = signals.select(AT, "symbol", "target_weight")
    grid = weights.select(AT).distinct().crossJoin(weights.select("symbol").distinct())
    filled = grid.join(weights, [AT, "symbol"], "left").withColumn("target_weight", F.coalesce("target_weight", F.lit(0.0)))
    w = Window.partitionBy("symbol").orderBy(AT)
    return filled.withColumn("previous_weight", F.coalesce(F.lag("target_weight").over(w), F.lit(0.0)))


def turnover(signals: DataFrame, returns: DataFrame) -> DataFrame:
    """(time_ms, turnover): what is traded at each rebalance, at the time its return is due.

    A held weight is compared with the symbol's own at the rebalance before; one that is gone
    at the next rebalance is sold there. So no grid of all symbols and times is made (see
    dense_weights). A rebalance that no bar follows has no such time and is left out.
    """
    along = Window.orderBy(AT)  # a row for each rebalance
    times = signals.select(AT).distinct().select(F.col(AT).alias("_at"), F.lag(AT).over(along).alias("_before"), F.lead(AT).over(along).alias("_after"))
    w = Window.partitionBy("symbol").orderBy(AT)
    own = signals.join(times, F.col(AT) == F.col("_at")).withColumns({"_last": F.lag(AT).over(w), "_weight": F.lag("target_weight").over(w), "_next": F.lead(AT).over(w)})
    before = F.when(F.col("_last") == F.col("_before"), F.col("_weight")).otherwise(0.0)
    sold = F.when(~F.col("_next").eqNullSafe(F.col("_after")), F.struct(F.col("_after").alias("at"), F.abs("target_weight").alias("traded")))
    moves = own.select(F.explode(F.array(F.struct(F.col(AT).alias("at"), F.abs(F.col("target_weight") - before).alias("traded")), sold)).alias("m")).filter("m.at is not null")
    traded = moves.groupBy(F.col("m.at").alias(AT)).agg(F.sum("m.traded").alias("turnover"))
    due = returns.filter("return_time_ms is not null").groupBy(AT).agg(F.min("return_time_ms").alias("time_ms"))
    return traded.join(due, AT).groupBy("time_ms").agg(F.sum("turnover").alias("turnover"))


def equity_curve(signals: DataFrame, features: DataFrame, fee_rate: float = 0.0, slippage_rate: float = 0.0) -> DataFrame:
    """A row for each time: gross_return, turnover, cost, period_return, equity."""
    returns = next_returns(features)
    portfolio = (
        signals.join(returns, [AT, "symbol"])
        .filter("return_time_ms is not null and next_return is not null")
        .groupBy(F.col("return_time_ms").alias("time_ms"))
        .agg(F.round(F.sum(F.col("target_weight") * F.col("next_return")), 12).alias("gross_return"))
    )
    timeline = signals.select(F.col(AT).alias("time_ms")).distinct()
    rows = timeline.join(portfolio, "time_ms", "full").join(turnover(signals, returns), "time_ms", "left").na.fill(0.0, ["gross_return", "turnover"])
    rows = rows.withColumn("cost", F.round(F.col("turnover") * (fee_rate + slippage_rate), 12))
    rows = rows.withColumn("period_return", F.round(F.col("gross_return") - F.col("cost"), 12))
    # one row for each time: small enough for the one ordered window that a running product is
    upto = Window.orderBy("time_ms").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("equity", F.round(F.product(1.0 + F.col("period_return")).over(upto), 12)).select("time_ms", "gross_return", "turnover", "cost", "period_return", "equity")


def summary(equity: DataFrame, periods_per_year: int = 365 * 24) -> DataFrame:
    """One row of figures; all but ``periods`` are null where there are no rows."""
    upto = Window.orderBy("time_ms").rowsBetween(Window.unboundedPreceding, 0)
    r = F.when(F.col("period_return") != 0, F.col("period_return"))
    figures = equity.withColumn("drawdown", ratio(F.col("equity"), F.max("equity").over(upto)) - 1).agg(
        F.count("*").alias("periods"), F.max_by("equity", "time_ms").alias("final_equity"), F.min("drawdown").alias("max_drawdown"),
        F.avg(r).alias("_mean"), F.stddev_samp(r).alias("_std"), F.count(r).alias("_n"), F.count_if(F.col("period_return") > 0).alias("_wins"),
        F.avg("period_return").alias("avg_period_return"), F.avg("turnover").alias("avg_turnover"),
    )
    return figures.select(
        "periods", "final_equity", (F.col("final_equity") - 1).alias("total_return"), "max_drawdown",
        F.when(F.col("_std") > 0, F.col("_mean") / F.col("_std") * periods_per_year**0.5).alias("sharpe"),
        F.try_divide(F.col("_wins"), F.col("_n")).alias("win_rate"), "avg_period_return", "avg_turnover",
    )
