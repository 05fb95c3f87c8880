"""DuckDB twins of the registered queries, over the same Parquet tables."""

from __future__ import annotations

from marketflow.plans.queries import EVENTS_END_MS, FIXED_COEFFICIENTS, LINES_END_MS
from marketflow.schema import DAY_MS, TICKER_SECTOR


def _r(expression: str, digits: int) -> str:
    return f"CAST(round(CAST({expression} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


_DIM = "dim(no, tickerSymbol, sector) AS (VALUES {})".format(
    ", ".join(f"({i}, '{t}', '{s}')" for i, (t, s) in enumerate(TICKER_SECTOR.items()))
)
_COEF = "coef(sector, b0, b_open, b_high, b_low) AS (VALUES {})".format(
    ", ".join(f"('{s}', {b}::DOUBLE, {o}::DOUBLE, {h}::DOUBLE, {l}::DOUBLE)" for s, b, o, h, l in FIXED_COEFFICIENTS)
)
_TICKS = f"""{_DIM},
ticks AS (
  SELECT d.tickerSymbol, d.sector, (epoch_us(e.ts) // 1000) AS ms, e.value AS price,
         CAST(regexp_extract(e.props, '[0-9]+') AS BIGINT) AS volume,
         epoch_us(e.ts) AS us, row(epoch_us(e.ts), e.event_id) AS seq
  FROM events e JOIN dim d ON d.no = e.user_id % 30)"""
_LINES = """lines AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS tickerSymbol, (epoch_us(l_shipdate) // 1000) AS ms,
         l_extendedprice / l_quantity AS price, CAST(l_quantity AS BIGINT) AS volume,
         row(l_orderkey, l_linenumber, l_extendedprice / l_quantity) AS seq
  FROM lineitem),
regions AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS tickerSymbol, r_name AS sector
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def _bars(name: str, source: str, width: int) -> str:
    return f"""{name} AS (
  SELECT tickerSymbol, ms - ms % {width} AS timestamp,
         arg_min(price, seq) AS open, max(price) AS high, min(price) AS low, arg_max(price, seq) AS close,
         CAST(sum(volume) AS BIGINT) AS volume, sum(price * volume) / nullif(sum(volume), 0) AS vw,
         count(*) AS numberOfItems
  FROM {source} GROUP BY ALL)"""


_DAILY = f"""{_TICKS},
{_bars('bars', 'ticks', DAY_MS)},
daily AS (SELECT sector, bars.* FROM bars JOIN dim USING (tickerSymbol))"""
_INTRADAY = f"""{_TICKS},
{_bars('bars', 'ticks', 900_000)},
intraday AS (SELECT sector, bars.* FROM bars JOIN dim USING (tickerSymbol))"""
_LINE_DAILY = f"""{_LINES},
{_bars('bars', 'lines', DAY_MS)},
daily AS (SELECT sector, bars.* FROM bars JOIN regions USING (tickerSymbol))"""


def _date(ms: str) -> str:
    return f"strftime(make_timestamp({ms} * 1000), '%Y-%m-%d')"


def _instant(ms: str) -> str:
    return f"strftime(make_timestamp({ms} * 1000), '%Y-%m-%dT%H:%M:%S.%g+0000')"


def _next_day(ms: str) -> str:
    tomorrow = f"({ms} + {DAY_MS})"
    weekday = f"(isodow(make_timestamp({tomorrow} * 1000)) - 1)"
    return f"CASE WHEN {weekday} > 4 THEN {ms} + {DAY_MS} * (8 - {weekday}) ELSE {tomorrow} END"


def _bar_columns(digits_of_prices: int | None = None) -> str:
    prices = ["open", "high", "low", "close"]
    if digits_of_prices is not None:
        prices = [f"{_r(c, digits_of_prices)} AS {c}" for c in prices]
    return f"tickerSymbol, timestamp, {', '.join(prices)}, volume, {_r('vw', 4)} AS vw, numberOfItems"


def _rebucket(start: str) -> str:
    return f"""wide AS (
  SELECT tickerSymbol, {start} AS start, arg_min(open, timestamp) AS open, max(high) AS high, min(low) AS low,
         arg_max(close, timestamp) AS close, CAST(sum(volume) AS BIGINT) AS volume,
         sum(vw * volume) / nullif(sum(volume), 0) AS vw, CAST(sum(numberOfItems) AS BIGINT) AS numberOfItems
  FROM bars GROUP BY ALL)"""


_WIRE = f"""volume AS v, {_r('vw', 4)} AS vw, open AS o, close AS c, high AS h, low AS l, timestamp AS t,
  numberOfItems AS n, tickerSymbol, volume, open, close, high, low, timestamp, numberOfItems"""

_HISTORY = f"""history AS (
  SELECT sector, 'historical' AS scope, {_date('timestamp')} AS timestamp, {_r('avg(close)', 2)} AS avg_close
  FROM daily GROUP BY sector, daily.timestamp)"""

_DOT = "b0 + b_open * open + b_high * high + b_low * low"


def _ranked(source: str, order: str = "timestamp DESC") -> str:
    return f"""ranked AS (
  SELECT *, row_number() OVER (PARTITION BY tickerSymbol ORDER BY {order}) AS row_num FROM {source})"""


def _forecast(window_size: int, horizon: int) -> str:
    keep = window_size - 1
    last = f"[-{keep}:]"
    columns = ("open", "high", "low")
    wins = ", ".join(f"list({c} ORDER BY timestamp) AS w_{c}" for c in columns)
    base = ", ".join(f"w_{c}, list_avg(w_{c}) AS p_{c}" for c in columns)
    step = ", ".join(f"list_append(w_{c}{last}, p_{c}), list_avg(w_{c}{last})" for c in columns)
    return f"""{_ranked('daily')},
ends AS (SELECT sector, max(timestamp) AS last_ms FROM daily GROUP BY sector),
wins AS (SELECT sector, tickerSymbol, {wins} FROM ranked WHERE row_num < {window_size} GROUP BY ALL),
fold AS (
  SELECT sector, tickerSymbol, 1 AS step, {_next_day('last_ms')} AS timestamp, {base}
  FROM wins JOIN ends USING (sector)
  UNION ALL
  SELECT sector, tickerSymbol, step + 1, {_next_day('timestamp')}, {step} FROM fold WHERE step < {horizon}),
forecast AS (
  SELECT sector, tickerSymbol, step, timestamp, p_open AS open, p_high AS high, p_low AS low FROM fold)"""


_FORECAST = f"{_DAILY},\n{_forecast(10, 10)},\n{_COEF}"
_FORECAST_SERIES = f"""prediction AS (
  SELECT sector, 'prediction' AS scope, {_date('timestamp')} AS timestamp, {_r(f'avg({_DOT})', 2)} AS avg_prediction
  FROM forecast JOIN coef USING (sector) GROUP BY sector, forecast.timestamp)"""

_ONE_STEP = f"""{_DAILY}, {_COEF},
{_ranked('daily')},
ends AS (SELECT sector, max(timestamp) AS last_ms FROM daily GROUP BY sector),
means AS (
  SELECT sector, tickerSymbol, avg(open) AS open, avg(high) AS high, avg(low) AS low
  FROM ranked WHERE row_num <= 7 GROUP BY ALL),
predicted AS (
  SELECT m.*, {_DOT} AS prediction, last_ms FROM means m JOIN coef USING (sector) JOIN ends USING (sector)),
joined AS (
  SELECT sector, tickerSymbol, open, high, low, d.close, d.timestamp, p.prediction
  FROM daily d FULL JOIN predicted p USING (sector, tickerSymbol, open, high, low)),
filled AS (
  SELECT j.sector, tickerSymbol, open, high, low, coalesce(close, 0.0) AS close,
         coalesce(timestamp, last_ms + {DAY_MS}) AS timestamp, coalesce(prediction, 0.0) AS prediction
  FROM joined j JOIN ends USING (sector))"""


def _moments(source: str) -> str:
    names = ("open", "high", "low", "close")
    columns = []
    for i, a in enumerate(names):
        columns.append(f"avg({a}) AS m_{a}")
        for b in names[i:]:
            columns.append(f"covar_pop({a}, {b}) AS c_{a}_{b}")
    return f"mo AS (SELECT sector, count(*) AS n, {', '.join(columns)} FROM {source} GROUP BY sector)"


def _det(a: list[str], b: list[str], c: list[str]) -> str:
    """Determinant of three columns, expanded."""
    return (
        f"({a[0]}*({b[1]}*{c[2]} - {b[2]}*{c[1]}) - {b[0]}*({a[1]}*{c[2]} - {a[2]}*{c[1]})"
        f" + {c[0]}*({a[1]}*{b[2]} - {a[2]}*{b[1]}))"
    )


def _ols(source: str, digits: int) -> str:
    o = ["c_open_open", "c_open_high", "c_open_low"]
    h = ["c_open_high", "c_high_high", "c_high_low"]
    l = ["c_open_low", "c_high_low", "c_low_low"]
    y = ["c_open_close", "c_high_close", "c_low_close"]
    return f"""{_moments(source)},
solved AS (
  SELECT sector, n, m_open, m_high, m_low, m_close, {_det(y, h, l)} / {_det(o, h, l)} AS bo,
         {_det(o, y, l)} / {_det(o, h, l)} AS bh, {_det(o, h, y)} / {_det(o, h, l)} AS bl FROM mo)
SELECT sector, n, {_r('m_close - bo*m_open - bh*m_high - bl*m_low', digits)} AS intercept,
       {_r('bo', digits)} AS coef_open, {_r('bh', digits)} AS coef_high, {_r('bl', digits)} AS coef_low FROM solved"""


def _elastic_net(sweeps: int, alpha: float = 0.7, source: str = "daily") -> str:
    def soft(rest: str) -> str:
        return f"sign({rest}) * greatest(abs({rest}) - l1, 0.0) / (1.0 + l2)"

    def spread(weight: str, deviation: str) -> str:
        # without spread the coefficients are 0
        return f"CASE WHEN isfinite({weight}*sy/{deviation}) THEN {weight}*sy/{deviation} ELSE 0.0 END"

    return f"""{_moments(source)},
sd AS (SELECT *, sqrt(c_open_open) AS so, sqrt(c_high_high) AS sh, sqrt(c_low_low) AS sl,
              sqrt(c_close_close) AS sy FROM mo),
st AS (SELECT *, c_open_high/(so*sh) AS oh, c_open_low/(so*sl) AS ol, c_high_low/(sh*sl) AS hl,
              c_open_close/(so*sy) AS oy, c_high_close/(sh*sy) AS hy, c_low_close/(sl*sy) AS ly,
              0.3*{alpha}/sy AS l1, 0.3*(1.0-{alpha})/sy AS l2 FROM sd),
cd AS (
  SELECT *, 0 AS k, 0.0::DOUBLE AS wo, 0.0::DOUBLE AS wh, 0.0::DOUBLE AS wl FROM st
  UNION ALL
  SELECT c.* EXCLUDE (k, wo, wh, wl, wo1, wh1), k + 1, wo1, wh1, {soft('(ly - ol*wo1 - hl*wh1)')}
  FROM (SELECT *, {soft('(hy - oh*wo1 - hl*wl)')} AS wh1
        FROM (SELECT *, {soft('(oy - oh*wh - ol*wl)')} AS wo1 FROM cd WHERE k < {sweeps})) c),
done AS (SELECT *, {spread('wo', 'so')} AS b_open, {spread('wh', 'sh')} AS b_high, {spread('wl', 'sl')} AS b_low
         FROM cd WHERE k = {sweeps}),
trained AS (
  SELECT sector, n, m_close - b_open*m_open - b_high*m_high - b_low*m_low AS b0, b_open, b_high, b_low FROM done)"""


_TRAINED_COLUMNS = ("b0 AS intercept", "b_open AS coef_open", "b_high AS coef_high", "b_low AS coef_low")


def _trained(digits: int, intercept_digits: int) -> str:
    named = [c.split(" AS ") for c in _TRAINED_COLUMNS]
    return ", ".join(
        f"{_r(column, intercept_digits if name == 'intercept' else digits)} AS {name}" for column, name in named
    )


_STREAM_MEANS = f"""WITH {_TICKS}
SELECT sector, 'streaming' AS scope, {_instant('start')} AS timestamp, {_r('avg(price)', 2)} AS avg_close
FROM (SELECT sector, ms - ms % 900000 AS start, price FROM ticks) GROUP BY sector, start"""

_WORDS = """SELECT word, count(*) AS n
FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY word"""

_LAST_7 = f"""WITH {_DAILY}, {_ranked('daily')},
ends AS (SELECT sector, max(timestamp) AS max_timestamp FROM daily GROUP BY sector)"""

ORACLES: dict[str, str] = {
    # bars
    "bars_15m": f"WITH {_INTRADAY} SELECT {_bar_columns()} FROM bars",
    "bars_daily": f"WITH {_DAILY} SELECT {_bar_columns()} FROM bars",
    "bars_multi_day": f"""WITH {_DAILY}, {_rebucket(f'timestamp - timestamp % {2 * DAY_MS}')}
SELECT {_bar_columns()} FROM (SELECT *, start AS timestamp FROM wide)""",
    "bars_line_items": f"WITH {_LINE_DAILY} SELECT {_bar_columns(4)} FROM bars",
    "bars_line_items_monthly": f"""WITH {_LINE_DAILY},
{_rebucket("epoch_ms(CAST(date_trunc('month', make_timestamp(timestamp * 1000)) AS TIMESTAMP))")}
SELECT {_bar_columns(4)} FROM (SELECT *, start AS timestamp FROM wide)""",
    "bars_requested": f"""WITH {_TICKS},
wanted AS (
  SELECT * FROM ticks WHERE us BETWEEN {EVENTS_END_MS - 2 * DAY_MS} * 1000 AND {EVENTS_END_MS} * 1000),
{_bars('bars', 'wanted', 900_000)} SELECT {_bar_columns()} FROM bars""",
    "range_lookback": f"""WITH {_LINES}
SELECT tickerSymbol, ms AS timestamp, {_r('price', 4)} AS price, volume FROM lines
WHERE ms BETWEEN epoch_ms(make_timestamp({LINES_END_MS} * 1000) - INTERVAL 5 YEARS) AND {LINES_END_MS}""",
    "dedup_bars": """SELECT tickerSymbol, timestamp, best.close AS close, best.volume AS volume,
       best.items AS numberOfItems
FROM (SELECT CAST(l_orderkey AS VARCHAR) AS tickerSymbol, CAST(l_linenumber AS BIGINT) AS timestamp,
             max({'items': l_partkey, 'close': l_extendedprice, 'volume': CAST(l_quantity AS BIGINT)}) AS best
      FROM lineitem GROUP BY ALL)""",
    "project_bars": f"WITH {_DAILY} SELECT tickerSymbol, open, high, low, timestamp, close FROM bars",
    "wire_bars": f"WITH {_DAILY} SELECT {_WIRE} FROM bars",
    # lookup and series
    "sector_lookup": f"WITH {_DAILY} SELECT sector, tickerSymbol, timestamp, open, high, low, close FROM daily",
    "sector_daily_close": f"WITH {_DAILY}, {_HISTORY} SELECT * FROM history ORDER BY sector, timestamp",
    "region_daily_close": f"WITH {_LINE_DAILY}, {_HISTORY} SELECT * FROM history ORDER BY sector, timestamp",
    "sector_completeness": f"""WITH {_INTRADAY},
expected AS (SELECT sector, count(*) AS expected FROM dim GROUP BY sector),
present AS (SELECT sector, timestamp, count(*) AS present FROM intraday GROUP BY sector, timestamp)
SELECT sector, timestamp, present, expected, present >= expected AS complete
FROM present JOIN expected USING (sector)""",
    "sector_max_ts": f"WITH {_LINE_DAILY} SELECT sector, max(timestamp) AS max_timestamp FROM daily GROUP BY sector",
    "sql_named_table": f"WITH {_DAILY} SELECT sector, tickerSymbol, timestamp, close, volume FROM daily",
    "doc_ids": f"""WITH {_DAILY}, {_HISTORY}
SELECT sector || '_' || scope AS index, row_number() OVER (PARTITION BY sector, scope ORDER BY timestamp) - 1 AS id,
       timestamp, avg_close FROM history""",
    "serving_overlay": f"""WITH RECURSIVE {_FORECAST}, {_HISTORY}, {_FORECAST_SERIES},
{_bars('narrow', 'ticks', 900_000)},
live AS (
  SELECT sector, 'streaming' AS scope, {_instant('timestamp')} AS timestamp, {_r('avg(close)', 2)} AS avg_close
  FROM narrow JOIN dim USING (tickerSymbol) GROUP BY sector, narrow.timestamp)
SELECT sector, scope, timestamp, avg_close, NULL::DOUBLE AS avg_prediction FROM history
UNION ALL SELECT sector, scope, timestamp, NULL, avg_prediction FROM prediction
UNION ALL SELECT sector, scope, timestamp, avg_close, NULL FROM live""",
    # ranks and windows
    "rank_newest": """SELECT user_id % 30 AS tickerSymbol, (epoch_us(ts) // 1000) AS timestamp, event_id,
       row_number() OVER (
         PARTITION BY user_id % 30 ORDER BY (epoch_us(ts) // 1000) DESC, event_id DESC) AS row_num
FROM events""",
    "rank_line_items": """SELECT l_returnflag, epoch_us(l_shipdate) // 1000 AS timestamp, l_orderkey, l_linenumber, l_extendedprice,
       row_number() OVER (
         PARTITION BY l_returnflag
         ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC) AS row_num
FROM lineitem""",
    "last_n_strict": f"""WITH {_TICKS}
SELECT tickerSymbol, ms AS timestamp, price, volume
FROM (SELECT *, row_number() OVER (PARTITION BY tickerSymbol ORDER BY ms DESC, seq DESC) AS row_num FROM ticks)
WHERE row_num < 10""",
    "last_n_inclusive": f"""WITH {_LINE_DAILY}, {_ranked('daily')}
SELECT sector, tickerSymbol, timestamp, {_r('close', 4)} AS close FROM ranked WHERE row_num <= 7""",
    "latest_20": f"""WITH {_INTRADAY}
SELECT tickerSymbol, timestamp, close FROM bars ORDER BY timestamp DESC, tickerSymbol DESC LIMIT 20""",
    "moving_mean": f"""WITH {_DAILY}
SELECT tickerSymbol, timestamp, close,
       {_r('avg(close) OVER (PARTITION BY tickerSymbol ORDER BY timestamp ROWS BETWEEN 8 PRECEDING AND CURRENT ROW)', 6)}
         AS moving_mean FROM bars""",
    "ticker_last_n_means": f"""WITH {_DAILY}, {_ranked('daily')}
SELECT tickerSymbol, {_r('avg(open)', 6)} AS open, {_r('avg(high)', 6)} AS high, {_r('avg(low)', 6)} AS low,
       {_r('avg(close)', 6)} AS close, max(timestamp) AS timestamp
FROM ranked WHERE row_num < 10 GROUP BY tickerSymbol""",
    "ticker_last_7_means": f"""{_LAST_7}
SELECT sector, tickerSymbol, {_r('avg(open)', 6)} AS open, {_r('avg(high)', 6)} AS high, {_r('avg(low)', 6)} AS low,
       {_r('avg(timestamp)', 6)} AS mean_timestamp, any_value(max_timestamp) AS max_timestamp
FROM ranked JOIN ends USING (sector) WHERE row_num <= 7 GROUP BY sector, tickerSymbol""",
    # time
    "ts_format_date": "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS date_text FROM orders",
    "ts_format_iso": "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g+0000') AS instant_text FROM events",
    "weekday_of": "SELECT o_orderkey, CAST(isodow(o_orderdate) - 1 AS INTEGER) AS weekday FROM orders",
    "next_business_day": f"""SELECT event_id, (epoch_us(ts) // 1000) AS timestamp,
       {_next_day('(epoch_us(ts) // 1000)')} AS next_ms
FROM events""",
    # models and forecast
    "assemble_features": f"""WITH {_DAILY}
SELECT tickerSymbol, timestamp, close, open AS feature_0, high AS feature_1, low AS feature_2 FROM bars""",
    "trend_by_sector": f"""WITH {_DAILY}
SELECT sector, {_r('regr_slope(close, open)', 6)} AS slope, {_r('regr_intercept(close, open)', 6)} AS intercept
FROM daily GROUP BY sector""",
    "ols_by_sector": f"WITH {_DAILY}, {_ols('daily', 6)}",
    "ols_by_region": f"WITH {_LINE_DAILY}, {_ols('daily', 4)}",
    "elastic_net_by_sector": f"""WITH RECURSIVE {_DAILY}, {_elastic_net(100)}
SELECT sector, n, {_trained(6, 6)} FROM trained""",
    "elastic_net_rolling": f"""WITH RECURSIVE {_DAILY},
windows AS (
  SELECT e.sector || ' ' || e.until AS sector, open, high, low, close
  FROM (SELECT DISTINCT sector, timestamp AS until FROM daily) e
  JOIN daily d ON d.sector = e.sector AND d.timestamp > e.until - {10 * DAY_MS} AND d.timestamp <= e.until),
{_elastic_net(100, source='windows')}
SELECT split_part(sector, ' ', 1) AS sector, CAST(split_part(sector, ' ', 2) AS BIGINT) AS timestamp, n,
       {_r('b0', 4)} AS intercept, {_r('b_open', 4)} AS coef_open, {_r('b_high', 4)} AS coef_high,
       {_r('b_low', 4)} AS coef_low FROM trained""",
    # ten iterations of the trained models reach the converged ones to about 1e-5
    "elastic_net_fit": f"WITH RECURSIVE {_DAILY}, {_elastic_net(100)} SELECT sector, {_trained(3, 2)} FROM trained",
    "elastic_net_fit_one_step": f"""WITH RECURSIVE {_DAILY}, {_elastic_net(100, 0.8)}
SELECT sector, {_trained(3, 2)} FROM trained""",
    "saved_models": f"""WITH RECURSIVE {_DAILY}, {_elastic_net(100)}
SELECT sector, tickerSymbol, timestamp, {_r(_DOT, 1)} AS prediction FROM daily JOIN trained USING (sector)""",
    "batch_forecast": f"""WITH RECURSIVE {_DAILY}, {_forecast(10, 10)}, {_elastic_net(100)}, {_HISTORY},
{_FORECAST_SERIES.replace('JOIN coef', 'JOIN trained')}
SELECT sector, scope, timestamp, avg_close, NULL::DOUBLE AS avg_prediction FROM history
UNION ALL SELECT sector, scope, timestamp, NULL, avg_prediction FROM prediction""",
    "score_fixed_coeffs": f"""WITH {_DAILY}, {_COEF}
SELECT sector, tickerSymbol, timestamp, {_r(_DOT, 6)} AS prediction FROM daily JOIN coef USING (sector)""",
    "standard_scale": f"""WITH {_DAILY},
fit AS (SELECT sector, avg(close) AS m, stddev_samp(close) AS s FROM daily GROUP BY sector)
SELECT sector, tickerSymbol, timestamp, {_r('(close - m) / s', 6)} AS scaled_close
FROM daily JOIN fit USING (sector)""",
    "scaled_regression": f"""WITH {_DAILY},
fit AS (SELECT avg(close) AS m, stddev_samp(close) AS s, stddev_pop(close) / stddev_samp(close) AS sx,
               avg(high) AS my, stddev_pop(high) AS sy, corr(close, high) AS r FROM daily)
SELECT {_r('m', 5)} AS mean, {_r('s', 5)} AS std, {_r('r / (1.0 + 0.1 / sy) * sy / sx', 5)} AS coefficient,
       {_r('my', 5)} AS intercept FROM fit""",
    "forecast_features": f"""WITH RECURSIVE {_FORECAST}
SELECT sector, tickerSymbol, step, timestamp, {_r('open', 6)} AS open, {_r('high', 6)} AS high, {_r('low', 6)} AS low
FROM forecast""",
    "forecast_close": f"""WITH RECURSIVE {_FORECAST}
SELECT sector, tickerSymbol, timestamp, {_r(_DOT, 6)} AS prediction FROM forecast JOIN coef USING (sector)""",
    "forecast_sector": f"""WITH RECURSIVE {_FORECAST}, {_FORECAST_SERIES}
SELECT * FROM prediction ORDER BY sector, timestamp""",
    "forecast_line_items": f"""WITH RECURSIVE {_LINE_DAILY}, {_forecast(12, 5)}
SELECT sector, tickerSymbol, step, timestamp, {_r('open', 4)} AS open, {_r('high', 4)} AS high, {_r('low', 4)} AS low
FROM forecast""",
    # the one-step forecast
    "history_full_join_forecast": f"""WITH {_ONE_STEP}
SELECT sector, tickerSymbol, {_r('open', 6)} AS open, {_r('high', 6)} AS high, {_r('low', 6)} AS low, close, timestamp,
       {_r('prediction', 6)} AS prediction FROM joined""",
    "fillna_after_full_join": f"""WITH {_ONE_STEP}
SELECT sector, tickerSymbol, {_r('open', 6)} AS open, {_r('high', 6)} AS high, {_r('low', 6)} AS low, close, timestamp,
       {_r('prediction', 6)} AS prediction FROM filled""",
    "notnull_filter": f"""WITH {_ONE_STEP}
SELECT sector, tickerSymbol, {_r('prediction', 6)} AS prediction FROM joined WHERE prediction IS NOT NULL""",
    "multi_avg": f"""WITH {_ONE_STEP},
view AS (
  SELECT sector, timestamp, close, NULL::DOUBLE AS prediction FROM daily
  UNION ALL SELECT sector, last_ms + {DAY_MS}, NULL, prediction FROM predicted)
SELECT sector, timestamp, {_r('avg(close)', 2)} AS avg_close, {_r('avg(prediction)', 6)} AS avg_prediction
FROM view GROUP BY sector, timestamp""",
    "forecast_one_step": f"""WITH {_ONE_STEP}
SELECT sector, {_date('timestamp')} AS timestamp, {_r('avg(close)', 2)} AS avg_close,
       {_r('avg(prediction)', 6)} AS avg_prediction FROM filled GROUP BY sector, filled.timestamp""",
    "union_distinct": f"""WITH RECURSIVE {_FORECAST}
SELECT tickerSymbol, {_r('open', 6)} AS open, {_r('high', 6)} AS high, {_r('low', 6)} AS low, timestamp,
       {_r('close', 6)} AS close
FROM (SELECT tickerSymbol, open, high, low, timestamp, close FROM ranked WHERE row_num < 10
      UNION
      SELECT tickerSymbol, open, high, low, timestamp, {_DOT} FROM forecast JOIN coef USING (sector) WHERE step = 1)""",
    # records
    "json_struct_project": f"WITH {_TICKS} SELECT price AS close, ms AS timestamp, sector AS topic FROM ticks",
    "malformed_records": "SELECT props AS value, event_type AS topic FROM events",
    "to_json_doc": f"""WITH {_DAILY}, {_HISTORY}
SELECT sector, CAST(to_json({{'timestamp': timestamp, 'avg_close': avg_close}}) AS VARCHAR) AS document FROM history""",
    "record_key": """SELECT CAST(to_json({'k': CAST(regexp_extract(props, '[0-9]+') AS BIGINT)}) AS VARCHAR) AS value
FROM events""",
    "variant_record_key": """SELECT event_id, CAST(props ->> '$.hello' AS VARCHAR) AS hello,
       CAST(props ->> '$.k' AS BIGINT) AS k, CAST(len(json_keys(props)) AS INTEGER) AS fields FROM events""",
    "route_by_tag": f"""WITH {_DAILY}
SELECT sector AS topic, CAST(to_json({{'tickerSymbol': tickerSymbol, 'timestamp': timestamp, 'close': close,
       'volume': volume}}) AS VARCHAR) AS value FROM daily""",
    "route_one_tag": f"""WITH {_DAILY}
SELECT sector AS topic, CAST(to_json({{'tickerSymbol': tickerSymbol, 'timestamp': timestamp,
       'volume': volume}}) AS VARCHAR) AS value FROM daily WHERE sector = 'tech'""",
    "word_count": _WORDS,
    # sinks
    "landed_bars": f"WITH {_DAILY} SELECT sector, {_WIRE} FROM daily",
    "result_files": f"WITH {_DAILY}, {_HISTORY} SELECT * FROM history",
    "upserted_results": f"""WITH {_DAILY}
SELECT sector, 'historical' AS scope, {_date('timestamp')} AS timestamp, {_r('avg(close)', 2)} AS avg_close
FROM (SELECT sector, timestamp, CASE WHEN timestamp >= {EVENTS_END_MS} THEN close + 1 ELSE close END AS close
      FROM daily) corrected
GROUP BY sector, corrected.timestamp""",
    "compacted_store": f"""WITH {_DAILY}
SELECT sector, 'historical' AS scope, {_date('timestamp')} AS timestamp, {_r('avg(close + 1)', 2)} AS avg_close
FROM daily GROUP BY sector, daily.timestamp""",
    "json_documents": f"""WITH {_DAILY}
SELECT sector, CAST(sum(volume) AS BIGINT) AS volume, CAST(sum(numberOfItems) AS BIGINT) AS numberOfItems
FROM daily GROUP BY sector""",
    # streams
    "stream_sector_avg": _STREAM_MEANS,
    "stream_sector_avg_bounded": _STREAM_MEANS,
    "live_deduped_means": f"""WITH {_DIM},
given AS (
  SELECT sector, tickerSymbol, epoch_us(ts) // 1000 // 900000 * 900000 AS start, value, event_id
  FROM events JOIN dim ON no = user_id % 30),
deliveries AS (
  SELECT sector, tickerSymbol, start, value AS close, event_id AS delivery FROM given
  UNION ALL
  SELECT sector, tickerSymbol, start, value + 1, event_id + (1::BIGINT << 40) FROM given WHERE event_id % 7 = 0),
last AS (SELECT sector, tickerSymbol, start, arg_max(close, delivery) AS close FROM deliveries GROUP BY ALL)
SELECT sector, 'streaming' AS scope, {_instant('start')} AS timestamp, {_r('avg(close)', 2)} AS avg_close
FROM last GROUP BY sector, start""",
    "stream_bars": f"WITH {_INTRADAY} SELECT {_bar_columns()} FROM bars",
    "stream_scored": f"""WITH {_DAILY}, {_COEF}
SELECT sector, tickerSymbol, timestamp, {_r(f"{_DOT} + timestamp // {DAY_MS} % 2", 6)} AS prediction
FROM daily JOIN coef USING (sector)""",
    "stream_dedup": """SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS tickerSymbol,
       epoch_us(l_shipdate) // 1000 AS timestamp
FROM lineitem""",
    "stream_word_count": _WORDS,
    "stream_to_topics": f"""WITH {_TICKS}
SELECT sector AS topic,
       CAST(to_json({{'tickerSymbol': tickerSymbol, 'timestamp': ms - ms % 900000}}) AS VARCHAR) AS value
FROM ticks""",
}
