"""DuckDB SQL equal to the queries, written from the definitions and not from Spark's plans."""

HOURS = """h AS (
  SELECT upper(event_type) AS symbol, '1h' AS interval, epoch_us(ts) // 1000 // 3600000 * 3600000 AS open_time_ms,
    first(value ORDER BY ts, event_id) AS open, max(value) AS high, min(value) AS low, last(value ORDER BY ts, event_id) AS close,
    round(sum(1.0::DOUBLE), 6) AS volume, epoch_us(min(ts)) // 1000 // 3600000 * 3600000 + 3599999 AS close_time_ms, round(sum(value), 6) AS quote_volume,
    count(*) AS trade_count, round(sum(CASE WHEN user_id % 2 = 0 THEN 1.0::DOUBLE ELSE 0 END), 6) AS taker_buy_base_volume,
    round(sum(CASE WHEN user_id % 2 = 0 THEN value ELSE 0 END), 6) AS taker_buy_quote_volume
  FROM events GROUP BY 1, 2, 3)"""

DAYS = """d AS (
  SELECT 'S' || (l_suppkey % 20) AS symbol, epoch_us(l_shipdate) // 1000 // 86400000 * 86400000 AS open_time_ms,
    first(p ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS open, max(p) AS high, min(p) AS low,
    last(p ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS close,
    round(sum(l_quantity::DOUBLE), 6) AS volume, round(sum(l_extendedprice), 6) AS quote_volume, count(*) AS trade_count,
    round(sum(CASE WHEN l_linenumber % 2 = 0 THEN l_quantity::DOUBLE ELSE 0 END), 6) AS taker_buy_base_volume,
    round(sum(CASE WHEN l_linenumber % 2 = 0 THEN l_extendedprice ELSE 0 END), 6) AS taker_buy_quote_volume
  FROM (SELECT *, l_extendedprice / l_quantity AS p FROM lineitem) GROUP BY 1, 2)"""


def resampled(name: str, source: str, width: int, counted: str, takers: bool) -> str:
    more = "sum(trade_count)::BIGINT AS trade_count, sum(taker_buy_base_volume) AS taker_buy_base_volume, sum(taker_buy_quote_volume) AS taker_buy_quote_volume," if takers else ""
    return f"""{name} AS (
  SELECT symbol, open_time_ms // {width} * {width} AS ts_ms, first(open ORDER BY open_time_ms) AS open, max(high) AS high, min(low) AS low,
    last(close ORDER BY open_time_ms) AS close, sum(volume) AS volume, sum(quote_volume) AS quote_volume, {more} count(*) AS {counted}
  FROM {source} GROUP BY 1, 2)"""


def average_rank(value: str, at: str, down: bool = False) -> str:
    order = f"{value} {'DESC' if down else 'ASC'} NULLS LAST"
    return f"(rank() OVER (PARTITION BY {at} ORDER BY {order}) + (count(*) OVER (PARTITION BY {at}, {value}) - 1) / 2.0)"


def r8(*columns: str) -> str:
    return ", ".join(f"round({c}, 8) AS {c}" for c in columns)


W = "OVER (PARTITION BY symbol ORDER BY ts_ms)"
ROLL = "OVER (PARTITION BY symbol ORDER BY ts_ms ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)"
LAGS = ", ".join(f"round(close / lag(close, {k}) {W} - 1, 12) AS {n}" for n, k in (("ret_1h", 1), ("ret_4h", 4), ("ret_24h", 24), ("ret_7d", 168)))
FEATURES = f"""{HOURS}, {resampled('b', 'h', 14_400_000, 'minute_count', True)},
f1 AS (SELECT *, ts_ms + 14400000 AS feature_available_time_ms, {LAGS}, close / lag(close) {W} - 1 AS bar_return, high / low - 1 AS high_low_range FROM b),
f2 AS (SELECT *, sum(quote_volume) {ROLL} AS quote_volume_24h, stddev_samp(bar_return) {ROLL} AS volatility_24h, sum(high_low_range) {ROLL} AS high_low_range_24h,
  sum(high - low) {ROLL} AS atr_24h, minute_count = 4 AS is_tradable FROM f1),
f3 AS (SELECT *, CASE WHEN is_tradable AND ret_24h IS NOT NULL THEN {average_rank('ret_24h', 'ts_ms', True)} END AS momentum_rank,
  CASE WHEN is_tradable THEN {average_rank('quote_volume_24h', 'ts_ms', True)} END AS liquidity_rank,
  CASE WHEN is_tradable AND volatility_24h IS NOT NULL THEN {average_rank('volatility_24h', 'ts_ms')} END AS low_vol_rank FROM f2),
f AS (SELECT *, CASE WHEN is_tradable THEN 1.0::DOUBLE / liquidity_rank + coalesce(0.5::DOUBLE / momentum_rank, 0) + coalesce(0.2::DOUBLE / low_vol_rank, 0) END AS score FROM f3)"""
SIGNALS = f"""{FEATURES}, s1 AS (SELECT feature_available_time_ms, symbol, score,
  floor({average_rank('score', 'feature_available_time_ms', True)})::BIGINT AS rank FROM f WHERE is_tradable AND score IS NOT NULL),
s AS (SELECT *, 0.5::DOUBLE AS target_weight FROM s1 WHERE rank <= 2)"""
RETURNS = f"""n AS (SELECT ts_ms AS feature_available_time_ms, symbol, lead(ts_ms) {W} AS return_time_ms, round(lead(close) {W} / close - 1, 12) AS next_return FROM f)"""
WEIGHTS = """g AS (SELECT t.feature_available_time_ms, y.symbol, coalesce(s.target_weight, 0) AS target_weight
  FROM (SELECT DISTINCT feature_available_time_ms FROM s) t CROSS JOIN (SELECT DISTINCT symbol FROM s) y
  LEFT JOIN s ON s.feature_available_time_ms = t.feature_available_time_ms AND s.symbol = y.symbol),
w AS (SELECT *, coalesce(lag(target_weight) OVER (PARTITION BY symbol ORDER BY feature_available_time_ms), 0) AS previous_weight FROM g)"""
TURNOVER = """t1 AS (SELECT feature_available_time_ms, sum(abs(target_weight - previous_weight)) AS x FROM w GROUP BY 1),
t2 AS (SELECT feature_available_time_ms, min(return_time_ms) AS time_ms FROM n WHERE return_time_ms IS NOT NULL GROUP BY 1),
t AS (SELECT time_ms, sum(x) AS turnover FROM t1 JOIN t2 USING (feature_available_time_ms) GROUP BY 1)"""
CALM = RETURNS.replace("close", "(100 + close / 100)")
EQUITY = f"""{SIGNALS}, {CALM}, {WEIGHTS}, {TURNOVER},
p AS (SELECT return_time_ms AS time_ms, round(sum(target_weight * next_return), 12) AS gross FROM s JOIN n USING (feature_available_time_ms, symbol)
  WHERE return_time_ms IS NOT NULL AND next_return IS NOT NULL GROUP BY 1),
e1 AS (SELECT time_ms, coalesce(gross, 0) AS gross_return, coalesce(turnover, 0) AS turnover
  FROM (SELECT DISTINCT feature_available_time_ms AS time_ms FROM s) x FULL JOIN p USING (time_ms) LEFT JOIN t USING (time_ms)),
e2 AS (SELECT *, round(turnover * 0.0006::DOUBLE, 12) AS cost FROM e1),
e3 AS (SELECT *, round(gross_return - cost, 12) AS period_return FROM e2),
e AS (SELECT *, round(product(1 + period_return) OVER (ORDER BY time_ms ROWS UNBOUNDED PRECEDING), 12) AS equity FROM e3)"""

WEEKS = f"{DAYS}, {resampled('k', 'd', 604_800_000, 'bar_count', False)}"


def strength(bars: str = "k") -> str:
    return f"""a1 AS (SELECT *, lag(close) {W} AS prev_close,
  list_reduce(list(close) OVER (PARTITION BY symbol ORDER BY ts_ms ROWS UNBOUNDED PRECEDING), lambda x, y: x * (19.0::DOUBLE / 21) + y * (2.0::DOUBLE / 21)) AS ema20 FROM {bars}),
a2 AS (SELECT *, greatest(high - low, abs(high - prev_close), abs(low - prev_close)) AS true_range FROM a1),
a3 AS (SELECT *, avg(true_range) OVER (PARTITION BY symbol ORDER BY ts_ms ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING) AS atr14_lag1, round(close / prev_close - 1, 12) AS ret,
  lag(ema20, 3) {W} AS e3 FROM a2),
a AS (SELECT *, round((close - ema20) / atr14_lag1, 12) AS gap_atr, round((ema20 - e3) / atr14_lag1, 12) AS slope_atr FROM a3),
j AS (SELECT a.*, m.ret AS btc_ret, m.gap_atr AS btc_gap_atr, m.slope_atr AS btc_slope_atr FROM a JOIN a m ON a.ts_ms = m.ts_ms AND m.symbol = 'S0' WHERE a.symbol <> 'S0'),
o1 AS (SELECT *, round(ret - btc_ret, 12) AS rs_ret, round(gap_atr - btc_gap_atr, 12) AS rs_gap, round(slope_atr - btc_slope_atr, 12) AS rs_slope, abs(gap_atr) AS overheat FROM j),
o AS (SELECT *, overheat > 0.35 OR abs(ret) > 1.0 AS is_overheated FROM o1),
c1 AS (SELECT *, coalesce(rs_slope, 0) AS sl, -rs_ret AS nr, -rs_gap AS ng, -coalesce(rs_slope, 0) AS ns FROM o),
c2 AS (SELECT *,
  CASE WHEN NOT is_overheated AND rs_ret > 0 AND rs_gap > 0 THEN 0.45::DOUBLE * {average_rank('rs_ret', 'ts_ms', True)} + 0.30::DOUBLE * {average_rank('rs_gap', 'ts_ms', True)}
    + 0.15::DOUBLE * {average_rank('sl', 'ts_ms', True)} - 0.10::DOUBLE * {average_rank('overheat', 'ts_ms', True)} END AS strong_score,
  CASE WHEN NOT is_overheated AND rs_ret < 0 AND rs_gap < 0 THEN 0.45::DOUBLE * {average_rank('nr', 'ts_ms', True)} + 0.30::DOUBLE * {average_rank('ng', 'ts_ms', True)}
    + 0.15::DOUBLE * {average_rank('ns', 'ts_ms', True)} - 0.10::DOUBLE * {average_rank('overheat', 'ts_ms', True)} END AS weak_score FROM c1),
c AS (SELECT *, CASE WHEN strong_score IS NOT NULL THEN floor({average_rank('strong_score', 'ts_ms')})::BIGINT END AS strong_rank,
  CASE WHEN weak_score IS NOT NULL THEN floor({average_rank('weak_score', 'ts_ms')})::BIGINT END AS weak_rank FROM c2)"""


STRENGTH = f"{WEEKS}, {strength()}"
LIQUID = """l1 AS (SELECT DISTINCT ts_ms FROM k ORDER BY ts_ms DESC LIMIT 20),
l2 AS (SELECT symbol FROM k SEMI JOIN l1 USING (ts_ms) WHERE symbol <> 'S0' GROUP BY 1 ORDER BY sum(quote_volume) DESC, symbol LIMIT {n}),
l AS (SELECT * FROM k WHERE symbol = 'S0' OR symbol IN (SELECT symbol FROM l2))"""


def shown(side: str, share: float) -> str:
    return f"""WITH {STRENGTH}, v1 AS (SELECT * FROM c WHERE NOT is_overheated), v2 AS (SELECT *, floor({average_rank(f'{side}_rank', 'ts_ms')}) AS dr FROM v1 WHERE {side}_rank IS NOT NULL)
SELECT ts_ms, symbol, {r8('rs_ret', 'rs_gap')}, {side}_rank, is_overheated FROM v2
WHERE dr <= (SELECT greatest(1, floor(count(*) * {share})) FROM v1) ORDER BY dr, ts_ms, symbol LIMIT 10"""


K13 = "(open_time_ms // 3600000 + length(symbol)) % 13"
BROKEN = f"""{HOURS}, x AS (SELECT symbol, interval, CASE WHEN {K13} = 1 THEN open_time_ms + 1000 ELSE open_time_ms END AS open_time_ms, CASE WHEN {K13} <> 6 THEN open END AS open,
  CASE WHEN {K13} = 2 THEN low - 1 ELSE high END AS high, low, close, CASE WHEN {K13} = 3 THEN -1 ELSE volume END AS volume,
  CASE WHEN {K13} = 0 THEN close_time_ms + 1 WHEN {K13} = 1 THEN close_time_ms + 1000 ELSE close_time_ms END AS close_time_ms, CASE WHEN {K13} <> 7 THEN quote_volume END AS quote_volume,
  CASE WHEN {K13} = 4 THEN -1 ELSE trade_count END AS trade_count, taker_buy_base_volume, CASE WHEN {K13} = 5 THEN -1 ELSE taker_buy_quote_volume END AS taker_buy_quote_volume FROM h)"""
REASON = """CASE WHEN open IS NULL OR quote_volume IS NULL THEN 'missing_value' WHEN close_time_ms <> open_time_ms + 3599999 THEN 'invalid_close_time' WHEN open_time_ms % 3600000 <> 0 THEN 'misaligned_open_time'
  WHEN high < open OR high < close OR high < low OR low > open OR low > close THEN 'invalid_ohlc' WHEN volume < 0 OR quote_volume < 0 THEN 'negative_volume'
  WHEN trade_count < 0 THEN 'negative_trade_count' WHEN taker_buy_base_volume < 0 OR taker_buy_quote_volume < 0 THEN 'negative_taker_buy_volume' ELSE 'valid' END"""
CLEAN = f"""{BROKEN}, y AS (SELECT *, 1 AS seq FROM x UNION ALL SELECT *, 2 FROM x WHERE open_time_ms // 3600000 % 5 = 0
  UNION ALL SELECT * REPLACE (close + 1 AS close, greatest(high, close + 1) AS high), 3 FROM x WHERE open_time_ms // 3600000 % 7 = 0),
z AS (SELECT *, {REASON} AS reason FROM y),
q AS (SELECT *, row_number() OVER (PARTITION BY symbol, open_time_ms ORDER BY seq) AS n, first(close) OVER (PARTITION BY symbol, open_time_ms ORDER BY seq) AS c0,
  first(high) OVER (PARTITION BY symbol, open_time_ms ORDER BY seq) AS h0 FROM z WHERE reason = 'valid'),
ok AS (SELECT * FROM q WHERE n = 1), bad AS (SELECT * FROM q WHERE n > 1 AND (close <> c0 OR high <> h0)),
nx AS (SELECT symbol, interval, open_time_ms AS p, lead(open_time_ms) OVER (PARTITION BY symbol ORDER BY open_time_ms) AS q FROM ok),
gaps AS (SELECT symbol, interval, unnest(range(p + 3600000, q, 3600000)) AS missing_open_time_ms, p AS previous_open_time_ms, q AS next_open_time_ms FROM nx WHERE q > p + 3600000)"""


def islands(name: str, slots: str) -> str:
    """Spans of hours that follow each other, from a table of (symbol, interval, t)."""
    return f"""{name} AS (SELECT symbol, interval, min(t) AS start_ms, max(t) AS end_ms FROM
  (SELECT *, t - 3600000 * row_number() OVER (PARTITION BY symbol, interval ORDER BY t) AS g FROM (SELECT DISTINCT symbol, interval, t FROM {slots})) GROUP BY symbol, interval, g)"""


#: Spans hour by hour: slots that are covered, and slots that are asked for.
SLOTS = f"""{CLEAN}, has AS (SELECT symbol, interval, unnest(range(open_time_ms, open_time_ms + 3600000 * (open_time_ms // 3600000 % 3) + 1, 3600000)) AS t FROM ok),
weeks AS (SELECT DISTINCT symbol, interval, open_time_ms // 604800000 * 604800000 AS a FROM h), wants AS (SELECT symbol, interval, unnest(range(a, a + 345600000, 3600000)) AS t FROM weeks),
lacks AS (SELECT * FROM wants ANTI JOIN has USING (symbol, interval, t))"""


def mark(which: str) -> str:
    return f"""WITH {CLEAN}, m AS (SELECT symbol, {which}(missing_open_time_ms) AS g FROM gaps GROUP BY 1), u AS (SELECT symbol, max(open_time_ms) AS last FROM ok GROUP BY 1)
SELECT min(coalesce(g - 3600000, last)) AS contiguous_last_open_time_ms FROM u LEFT JOIN m USING (symbol)"""


VALUES = r8("open", "high", "low", "close", "volume") + ", close_time_ms, " + r8("quote_volume") + ", trade_count, " + r8("taker_buy_base_volume", "taker_buy_quote_volume")
CANDLE = f"symbol, interval, open_time_ms, {VALUES}"
DATE = "strftime(make_timestamp(open_time_ms * 1000), '%Y-%m-%d') AS date"
HOT = f"WITH {HOURS}, v AS (SELECT * REPLACE (close + 1 AS close, greatest(high, close + 1) AS high) FROM h WHERE open_time_ms // 3600000 % 3 = 0 UNION ALL SELECT * FROM h WHERE open_time_ms // 3600000 % 3 <> 0)"
STATES = """k AS (SELECT c_custkey, 'C' || c_custkey AS symbol FROM customer),
st AS (SELECT symbol, c_custkey, CASE WHEN c_custkey % 9 = 0 THEN '5m' ELSE '1m' END AS interval,
  CASE WHEN c_custkey % 11 <> 0 THEN 1706000000000 // 60000 * 60000 + c_custkey * 25200000 END AS last_open_time_ms, 'active' AS status FROM k WHERE c_custkey % 4 <> 0)"""
NOW_MS = 1_706_790_896_000
END = NOW_MS // 60_000 * 60_000 - 60_000
LAST_DAY = NOW_MS // 86_400_000 - 2

ORACLE_SQL: dict[str, str] = {
    "bars_hourly": f"WITH {HOURS} SELECT {CANDLE} FROM h",
    "bars_weekly": f"WITH {DAYS}, {resampled('k', 'd', 604_800_000, 'minute_count', True)} SELECT symbol, ts_ms, {r8('open', 'high', 'low', 'close', 'volume', 'quote_volume', 'taker_buy_base_volume', 'taker_buy_quote_volume')}, trade_count, minute_count FROM k",
    "bars_rs": f"WITH {WEEKS} SELECT symbol, ts_ms, {r8('open', 'high', 'low', 'close', 'volume', 'quote_volume')}, bar_count FROM k",
    "validate_reject_reasons": f"WITH {BROKEN} SELECT symbol, open_time_ms, {REASON} AS reason FROM x",
    "dedupe_conflicts": f"WITH {CLEAN} SELECT symbol, open_time_ms, seq, round(close, 8) AS close, 'duplicate_conflict' AS reason FROM bad",
    "accepted_rows": f"WITH {CLEAN} SELECT {CANDLE}, seq FROM ok",
    "clean_counters": f"WITH {CLEAN} SELECT (SELECT count(*) FROM z) AS raw, (SELECT count(*) FROM ok) AS accepted, (SELECT count(*) FROM z WHERE reason <> 'valid') AS rejected, (SELECT count(*) FROM bad) AS conflicts",
    "gap_report": f"WITH {CLEAN} SELECT * FROM gaps",
    "contiguous_mark": mark("max"),
    "contiguous_mark_strict": mark("min"),
    "hot_overlay": f"{HOT} SELECT {CANDLE} FROM v",
    "upsert_keep_last": f"{HOT} SELECT {CANDLE}, {DATE} FROM v",
    "returns_multi_lag": f"WITH {FEATURES} SELECT symbol, ts_ms, {r8('ret_1h', 'ret_4h', 'ret_24h', 'ret_7d', 'high_low_range')} FROM f",
    "rolling_windows": f"WITH {FEATURES} SELECT symbol, ts_ms, {r8('quote_volume_24h', 'volatility_24h', 'high_low_range_24h', 'atr_24h')} FROM f",
    "cross_section_ranks": f"WITH {FEATURES} SELECT symbol, ts_ms, is_tradable, momentum_rank::DOUBLE AS momentum_rank, liquidity_rank::DOUBLE AS liquidity_rank, low_vol_rank::DOUBLE AS low_vol_rank FROM f",
    "feature_table": f"WITH {FEATURES} SELECT symbol, ts_ms, feature_available_time_ms, trade_count, minute_count, is_tradable, {r8('open', 'high', 'low', 'close', 'volume', 'quote_volume', 'taker_buy_base_volume', 'taker_buy_quote_volume', 'ret_1h', 'ret_4h', 'ret_24h', 'ret_7d', 'high_low_range', 'quote_volume_24h', 'volatility_24h', 'high_low_range_24h', 'atr_24h')}, momentum_rank::DOUBLE AS momentum_rank, liquidity_rank::DOUBLE AS liquidity_rank, low_vol_rank::DOUBLE AS low_vol_rank, round(score, 8) AS score FROM f",
    "top_n_signals": f"WITH {SIGNALS} SELECT feature_available_time_ms, symbol, round(score, 8) AS score, rank, target_weight FROM s",
    "latest_signals": f"WITH {SIGNALS} SELECT feature_available_time_ms, symbol, round(score, 8) AS score, rank, target_weight FROM s WHERE feature_available_time_ms = (SELECT max(feature_available_time_ms) FROM s)",
    "next_bar_returns": f"WITH {FEATURES}, {RETURNS} SELECT feature_available_time_ms, symbol, return_time_ms, round(next_return, 8) AS next_return FROM n",
    "dense_weights": f"WITH {SIGNALS}, {WEIGHTS} SELECT feature_available_time_ms, symbol, target_weight::DOUBLE AS target_weight, previous_weight::DOUBLE AS previous_weight FROM w",
    "turnover": f"WITH {SIGNALS}, {RETURNS}, {WEIGHTS}, {TURNOVER} SELECT time_ms, round(turnover, 8)::DOUBLE AS turnover FROM t",
    "equity_curve": f"WITH {EQUITY} SELECT time_ms, {r8('gross_return', 'turnover', 'cost', 'period_return', 'equity')} FROM e",
    "equity_summary": f"""WITH {EQUITY}, i AS (SELECT *, equity / max(equity) OVER (ORDER BY time_ms ROWS UNBOUNDED PRECEDING) - 1 AS dd, CASE WHEN period_return <> 0 THEN period_return END AS r FROM e)
SELECT count(*) AS periods, round(arg_max(equity, time_ms), 8) AS final_equity, round(arg_max(equity, time_ms) - 1, 8) AS total_return, round(min(dd), 8) AS max_drawdown,
  round(CASE WHEN stddev_samp(r) > 0 THEN avg(r) / stddev_samp(r) * sqrt(2190) END, 8) AS sharpe, round(count(*) FILTER (r > 0) / count(r), 8) AS win_rate,
  round(avg(period_return), 8) AS avg_period_return, round(avg(turnover), 8) AS avg_turnover FROM i""",
    "ema20": f"WITH {STRENGTH} SELECT symbol, ts_ms, {r8('close', 'ema20')} FROM a",
    "true_range_atr": f"WITH {STRENGTH} SELECT symbol, ts_ms, {r8('prev_close', 'true_range')}, round(atr14_lag1 / close, 8) AS atr_share FROM a",
    "symbol_factors": f"WITH {STRENGTH} SELECT symbol, ts_ms, {r8('ret', 'gap_atr', 'slope_atr')} FROM a",
    "benchmark_join": f"WITH {STRENGTH} SELECT symbol, ts_ms, {r8('ret', 'btc_ret', 'btc_gap_atr', 'btc_slope_atr')} FROM j",
    "overheat_flag": f"WITH {STRENGTH} SELECT symbol, ts_ms, {r8('rs_ret', 'rs_gap', 'rs_slope', 'overheat')}, is_overheated FROM o",
    "strength_scores": f"WITH {STRENGTH} SELECT symbol, ts_ms, {r8('strong_score', 'weak_score')}, strong_rank, weak_rank FROM c",
    "strength_board": f"""WITH {WEEKS}, {LIQUID.format(n=8)}, {strength('l')}, tail AS (SELECT DISTINCT ts_ms FROM c ORDER BY ts_ms DESC LIMIT 30)
SELECT symbol, ts_ms, '10080' AS tf, '1d' AS source_interval, round(close, 8) AS close, bar_count, {r8('rs_ret', 'rs_gap', 'rs_slope')}, is_overheated, strong_rank, weak_rank FROM c SEMI JOIN tail USING (ts_ms)""",
    "liquidity_universe": f"WITH {WEEKS}, {LIQUID.format(n=5)} SELECT symbol, ts_ms, {r8('open', 'high', 'low', 'close', 'volume', 'quote_volume')}, bar_count FROM l",
    "source_tail": f"WITH {DAYS}, v AS (SELECT *, max(open_time_ms) OVER (PARTITION BY symbol) AS m FROM d) SELECT symbol, open_time_ms, round(close, 8) AS close FROM v WHERE open_time_ms >= m - (15 * 7 - 1) * 86400000::BIGINT",
    "target_tail": f"WITH {WEEKS}, v AS (SELECT DISTINCT ts_ms FROM k ORDER BY ts_ms DESC LIMIT 12) SELECT symbol, ts_ms, {r8('open', 'high', 'low', 'close', 'volume', 'quote_volume')}, bar_count FROM k SEMI JOIN v USING (ts_ms)",
    "show_strong": shown("strong", 0.2),
    "show_weak": shown("weak", 0.5),
    "active_universe": "SELECT 'C' || c_custkey AS symbol FROM customer WHERE c_custkey % 3 <> 0 AND c_custkey % 5 <> 0 AND c_custkey % 7 <> 0",
    "parse_stream_message": f"WITH {HOURS} SELECT {CANDLE}, open_time_ms // 3600000 % 4 <> 3 AS is_closed FROM h WHERE open_time_ms // 3600000 % 11 <> 0",
    "parse_rest_rows": f"WITH {HOURS} SELECT {CANDLE}, {DATE} FROM h",
    "sync_plan": f"""WITH {STATES}, v AS (SELECT k.symbol, coalesce(st.last_open_time_ms + 60000, {NOW_MS} - 30 * 86400000::BIGINT) AS start_ms FROM k LEFT JOIN st ON k.symbol = st.symbol AND st.interval = '1m'),
v2 AS (SELECT *, CASE WHEN start_ms <= {END} THEN greatest(0, {LAST_DAY} - start_ms // 86400000 + 1) ELSE 0 END::BIGINT AS archive_days FROM v),
v3 AS (SELECT *, CASE WHEN archive_days > 0 THEN (start_ms // 86400000 + archive_days) * 86400000::BIGINT ELSE start_ms END AS rest FROM v2)
SELECT symbol, start_ms, archive_days, CASE WHEN start_ms <= {END} AND rest <= {END} THEN (({END} - rest) // 60000 + 1 + 498) // 499 ELSE 0 END::BIGINT AS rest_batches FROM v3""",
    "inactive_checkpoints": f"WITH {STATES} SELECT symbol, interval, last_open_time_ms, CASE WHEN interval = '1m' AND c_custkey % 3 = 0 THEN 'inactive' ELSE status END AS status FROM st",
    "checkpoint_merge": f"""WITH {STATES} SELECT symbol, interval, CASE WHEN interval = '1m' AND length(symbol) % 2 = 0 THEN last_open_time_ms + 60000 ELSE last_open_time_ms END AS last_open_time_ms, status FROM st""",
    "checkpoint_advance": f"""WITH {CLEAN}, due AS (SELECT symbol, min(open_time_ms) + 3600000 * (length(symbol) % 3) + length(symbol) % 2 AS d FROM ok WHERE symbol > 'C' GROUP BY symbol),
own AS (SELECT ok.symbol, interval, open_time_ms, coalesce(ceil(d / 3600000.0)::BIGINT * 3600000, min(open_time_ms) OVER (PARTITION BY ok.symbol)) AS a FROM ok LEFT JOIN due ON ok.symbol = due.symbol WHERE d IS NULL OR open_time_ms >= d),
run AS (SELECT *, a + 3600000 * (row_number() OVER (PARTITION BY symbol ORDER BY open_time_ms) - 1) AS e FROM own)
SELECT symbol, interval, max(open_time_ms) AS last_open_time_ms FROM run WHERE open_time_ms = e GROUP BY ALL""",
    "covered_runs": f"WITH {CLEAN}, o AS (SELECT symbol, interval, open_time_ms AS t FROM ok), {islands('i', 'o')} SELECT * FROM i",
    "covered_spans": f"WITH {SLOTS}, {islands('i', 'has')} SELECT * FROM i",
    "lacking_spans": f"WITH {SLOTS}, {islands('i', 'lacks')} SELECT * FROM i",
    "marks_by_spans": f"""WITH {SLOTS}, {islands('i', 'lacks')}, all_slots AS (SELECT * FROM has UNION ALL
  SELECT symbol, interval, unnest(range(start_ms, end_ms + 1, 3600000)) FROM i WHERE start_ms // 3600000 % 2 = 0), {islands('s', 'all_slots')},
due AS (SELECT symbol, interval, min(open_time_ms) + 432000000 AS d FROM h GROUP BY ALL)
SELECT symbol, interval, end_ms AS last_open_time_ms FROM s JOIN due USING (symbol, interval) WHERE start_ms <= d AND d <= end_ms""",
    "stream_bars_hourly": f"WITH {HOURS} SELECT symbol, open_time_ms, {r8('open', 'high', 'low', 'close', 'volume')}, trade_count FROM h",
    "stream_upsert": f"WITH {HOURS} SELECT {CANDLE} FROM h WHERE open_time_ms // 3600000 % 11 <> 0 AND open_time_ms // 3600000 % 4 <> 3",
    "lake_gap_delete": f"""WITH {CLEAN} SELECT * FROM gaps WHERE NOT (symbol < 'L' AND right(strftime(make_timestamp(missing_open_time_ms * 1000), '%Y-%m-%d'), 1)::INT % 2 = 0)""",
}
