"""The query registry: every operator over the whole given tables.

Each query takes the session and the folder of Parquet tables. Means and model
outputs are rounded as the oracle rounds them, since the last bit of a float sum
depends on its order.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from marketflow.functions import (
    bucket_start,
    epoch_ms,
    format_date,
    format_instant,
    round_half_up,
    weekday,
)
from marketflow.functions import next_business_day as following_day
from marketflow.operators import bars as B
from marketflow.operators import forecast as FC
from marketflow.operators import models as M
from marketflow.operators import one_step as O
from marketflow.operators import ranking as R
from marketflow.operators import records as J
from marketflow.operators import series as S
from marketflow.plans.batch import batch_series
from marketflow.schema import (
    BAR_SCHEMA,
    DAY_MS,
    ONE_STEP_ELASTIC_NET,
    SECTORS,
    small_frame,
    ticker_dimension,
)
from marketflow.session import new_path, settle, use_utc
from marketflow.sinks import files as files_out
from marketflow.sinks import results as store
from marketflow.sources import files as files_in
from marketflow.sources.ticks import (
    event_ticks,
    events_as_ticks,
    line_item_ticks,
    supplier_regions,
    table,
)
from marketflow.streaming import bars as streamed
from marketflow.streaming import live
from marketflow.streaming.sources import follow_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# the end of the look-back queries: 2024-01-20T00:00:00Z and 2001-01-01T00:00:00Z
EVENTS_END_MS = 1_705_708_800_000
LINES_END_MS = 978_307_200_000

# given models, where a query checks the scoring and not the fit
FIXED_COEFFICIENTS = [
    ("cgoods", 1.5, 0.2, 0.5, 0.3),
    ("financial", 2.0, 0.1, 0.6, 0.2),
    ("energy", 0.5, 0.3, 0.3, 0.3),
    ("health", 1.0, 0.25, 0.5, 0.25),
    ("industrial", 3.0, 0.05, 0.7, 0.2),
    ("tech", 0.0, 0.4, 0.4, 0.2),
]


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(use_utc(spark), sf_dir)

    run.__doc__ = function.__doc__
    QUERIES[function.__name__] = run
    return run


def _rounded(frame: DataFrame, digits: int, *columns: str) -> DataFrame:
    return frame.withColumns({c: round_half_up(F.col(c), digits) for c in columns})


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of the events, with their sector."""
    return S.with_sector(B.bars(event_ticks(spark, sf_dir), 1, "day"), ticker_dimension(spark))


def _line_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of the line items; the region of the supplier is the sector."""
    return S.with_sector(B.bars(line_item_ticks(spark, sf_dir), 1, "day"), supplier_regions(spark, sf_dir))


def _fixed_coefficients(spark: SparkSession) -> DataFrame:
    names = ("sector", "intercept", "coef_open", "coef_high", "coef_low")
    return small_frame(spark, {n: list(values) for n, values in zip(names, zip(*FIXED_COEFFICIENTS))})


def _model_bars(frame: DataFrame) -> DataFrame:
    return frame.select("sector", "tickerSymbol", "timestamp", "open", "high", "low", "close")


def _settled_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars as a table, as the landing job leaves them, for what reads them more than once."""
    return settle(_model_bars(_daily(spark, sf_dir)), "daily")


def _rounded_models(frame: DataFrame) -> DataFrame:
    """Ten iterations leave the fourth decimal of a coefficient open, the third of an intercept."""
    return _rounded(_rounded(frame, 3, "coef_open", "coef_high", "coef_low"), 2, "intercept")


# --- bars ------------------------------------------------------------------


@query
def bars_15m(spark, sf_dir):
    return _rounded(B.bars(event_ticks(spark, sf_dir), 15, "minute"), 4, "vw")


@query
def bars_daily(spark, sf_dir):
    return _rounded(B.bars(event_ticks(spark, sf_dir), 1, "day"), 4, "vw")


@query
def bars_multi_day(spark, sf_dir):
    """Two-day bars, built from the daily ones."""
    daily = B.bars(event_ticks(spark, sf_dir), 1, "day")
    return _rounded(B.rebucket(daily, 2, "day"), 4, "vw")


@query
def bars_line_items(spark, sf_dir):
    frame = B.bars(line_item_ticks(spark, sf_dir), 1, "day")
    return _rounded(frame, 4, "open", "high", "low", "close", "vw")


@query
def bars_line_items_monthly(spark, sf_dir):
    """Monthly bars from the daily ones."""
    daily = B.bars(line_item_ticks(spark, sf_dir), 1, "day")
    return _rounded(B.rebucket(daily, 1, "month"), 4, "open", "high", "low", "close", "vw")


@query
def bars_requested(spark, sf_dir):
    """The intraday request: 15-minute bars of the two days up to a given end."""
    ticks = event_ticks(spark, sf_dir, (EVENTS_END_MS, "2 DAYS"))
    return _rounded(B.bars(ticks, 15, "minute"), 4, "vw")


@query
def range_lookback(spark, sf_dir):
    """The daily request's five years, over the ship dates."""
    ticks = line_item_ticks(spark, sf_dir, (LINES_END_MS, "5 YEARS"))
    return ticks.select(
        "tickerSymbol", "timestamp", round_half_up(F.col("price"), 4).alias("price"), "volume"
    )


@query
def dedup_bars(spark, sf_dir):
    """One delivery of every (order, line): the pair repeats in the table."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("tickerSymbol"),
        F.col("l_linenumber").cast("long").alias("timestamp"),
        F.col("l_extendedprice").alias("close"),
        F.col("l_quantity").cast("long").alias("volume"),
        F.col("l_partkey").alias("numberOfItems"),
    )
    return B.dedup_bars(lines, prefer=("numberOfItems",))


@query
def project_bars(spark, sf_dir):
    wire = B.to_wire(B.bars(event_ticks(spark, sf_dir), 1, "day"))
    return wire.select("tickerSymbol", "open", "high", "low", "timestamp", "close")


@query
def wire_bars(spark, sf_dir):
    """The sixteen-field wire format."""
    return B.to_wire(_rounded(B.bars(event_ticks(spark, sf_dir), 1, "day"), 4, "vw"))


# --- lookup and series -----------------------------------------------------


@query
def sector_lookup(spark, sf_dir):
    return _model_bars(_daily(spark, sf_dir))


@query
def sector_daily_close(spark, sf_dir):
    return S.in_order(S.published_series(_daily(spark, sf_dir), "close", "historical"))


@query
def region_daily_close(spark, sf_dir):
    return S.in_order(S.published_series(_line_daily(spark, sf_dir), "close", "historical"))


@query
def sector_completeness(spark, sf_dir):
    frame = S.with_sector(B.bars(event_ticks(spark, sf_dir), 15, "minute"), ticker_dimension(spark))
    return S.completeness(frame, ticker_dimension(spark))


@query
def sector_max_ts(spark, sf_dir):
    return S.sector_max_timestamp(_line_daily(spark, sf_dir))


@query
def sql_named_table(spark, sf_dir):
    _daily(spark, sf_dir).createOrReplaceTempView("daily_bars")
    return spark.sql("SELECT sector, tickerSymbol, timestamp, close, volume FROM daily_bars")


@query
def doc_ids(spark, sf_dir):
    series = S.overlay(S.published_series(_daily(spark, sf_dir), "close", "historical"))
    return R.document_ids(series).select("index", "id", "timestamp", "avg_close")


@query
def serving_overlay(spark, sf_dir):
    """History, forecast and live series as one table, with given models.

    The ticks are read once: the daily bars come from the 15-minute ones.
    """
    narrow = S.with_sector(B.bars(event_ticks(spark, sf_dir), 15, "minute"), ticker_dimension(spark))
    intraday = settle(narrow, "intraday")
    daily = settle(_model_bars(B.rebucket(intraday, 1, "day", ("sector", "tickerSymbol"))), "daily")
    return S.overlay(
        S.published_series(daily, "close", "historical"),
        S.published_series(FC.forecast(daily, _fixed_coefficients(spark)), "prediction", "prediction"),
        live.live_series(S.sector_mean(intraday, "close")),
    )


# --- ranks and windows -----------------------------------------------------


@query
def rank_newest(spark, sf_dir):
    """The rank of every event within its ticker."""
    ticks = table(spark, sf_dir, "events").select(
        (F.col("user_id") % 30).alias("tickerSymbol"), epoch_ms(F.col("ts")).alias("timestamp"), "event_id"
    )
    return R.rank_newest(ticks, ties=("event_id",))


@query
def rank_line_items(spark, sf_dir):
    """The rank of every line item within its return flag: three keys hold all rows."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", epoch_ms(F.col("l_shipdate")).alias("timestamp"), "l_orderkey", "l_linenumber", "l_extendedprice"
    )
    return R.rank_by_ranges(lines, ("l_returnflag",), ties=("l_orderkey", "l_linenumber", "l_extendedprice"))


@query
def last_n_strict(spark, sf_dir):
    """Window size 10 keeps nine ticks per ticker."""
    ticks = event_ticks(spark, sf_dir)
    return R.last_n_strict(ticks, 10, ties=("seq",)).drop("seq")


@query
def last_n_inclusive(spark, sf_dir):
    return R.last_n(_model_bars(_line_daily(spark, sf_dir)), 7).select(
        "sector", "tickerSymbol", "timestamp", round_half_up(F.col("close"), 4).alias("close")
    )


@query
def latest_20(spark, sf_dir):
    bars = B.bars(event_ticks(spark, sf_dir), 15, "minute")
    return R.latest(bars, 20, ties=("tickerSymbol",)).select("tickerSymbol", "timestamp", "close")


@query
def moving_mean(spark, sf_dir):
    frame = R.moving_mean(B.bars(event_ticks(spark, sf_dir), 1, "day"), 10)
    return _rounded(frame, 6, "moving_mean").select("tickerSymbol", "timestamp", "close", "moving_mean")


@query
def ticker_last_n_means(spark, sf_dir):
    """Means of the nine newest bars, with the newest of their timestamps."""
    newest = R.last_n_strict(_model_bars(_daily(spark, sf_dir)), 10)
    means = newest.groupBy("tickerSymbol").agg(
        *[F.avg(c).alias(c) for c in ("open", "high", "low", "close")],
        F.max("timestamp").alias("timestamp"),
    )
    return _rounded(means, 6, "open", "high", "low", "close")


@query
def ticker_last_7_means(spark, sf_dir):
    means = O.ticker_means(_daily(spark, sf_dir))
    return _rounded(means, 6, "open", "high", "low", "mean_timestamp")


# --- time ------------------------------------------------------------------


@query
def ts_format_date(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", format_date(epoch_ms(F.col("o_orderdate"))).alias("date_text"))


@query
def ts_format_iso(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", format_instant(epoch_ms(F.col("ts"))).alias("instant_text"))


@query
def weekday_of(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", weekday(epoch_ms(F.col("o_orderdate"))).alias("weekday"))


@query
def next_business_day(spark, sf_dir):
    ms = epoch_ms(F.col("ts"))
    return table(spark, sf_dir, "events").select(
        "event_id", ms.alias("timestamp"), following_day(ms).alias("next_ms")
    )


# --- models and forecast ---------------------------------------------------


@query
def assemble_features(spark, sf_dir):
    vectors = M.assemble(_model_bars(_daily(spark, sf_dir)))
    parts = vector_to_array(F.col("features"))
    return vectors.select(
        "tickerSymbol", "timestamp", "close", *[parts[i].alias(f"feature_{i}") for i in range(3)]
    )


@query
def trend_by_sector(spark, sf_dir):
    return _rounded(M.trend_by_key(_daily(spark, sf_dir)), 6, "slope", "intercept")


@query
def ols_by_sector(spark, sf_dir):
    frame = M.ols_by_key(_daily(spark, sf_dir))
    return _rounded(frame, 6, "intercept", "coef_open", "coef_high", "coef_low")


@query
def ols_by_region(spark, sf_dir):
    frame = M.ols_by_key(_line_daily(spark, sf_dir))
    return _rounded(frame, 4, "intercept", "coef_open", "coef_high", "coef_low")


@query
def elastic_net_by_sector(spark, sf_dir):
    """The converged elastic net, all sectors in one job."""
    frame = M.elastic_net_by_key(_daily(spark, sf_dir), sweeps=100)
    return _rounded(frame, 6, "intercept", "coef_open", "coef_high", "coef_low")


@query
def elastic_net_rolling(spark, sf_dir):
    """The converged elastic net of every sector and day over the ten days up to it."""
    frame = M.elastic_net_rolling(_settled_daily(spark, sf_dir), 10 * DAY_MS, sweeps=100)
    return _rounded(frame, 4, "intercept", "coef_open", "coef_high", "coef_low")


@query
def elastic_net_fit(spark, sf_dir):
    """The trained models of the daily job."""
    models = M.fit_sector_models(_daily(spark, sf_dir))
    return _rounded_models(M.coefficient_frame(spark, models))


@query
def elastic_net_fit_one_step(spark, sf_dir):
    """The models of the one-step job, which weighs the absolute penalty more."""
    models = M.fit_sector_models(_daily(spark, sf_dir), **ONE_STEP_ELASTIC_NET)
    return _rounded_models(M.coefficient_frame(spark, models))


@query
def saved_models(spark, sf_dir):
    """Fit, save, load and score: the predicted close of every bar."""
    daily = _settled_daily(spark, sf_dir)
    root = new_path(spark, "models")
    M.save_models(M.fit_sector_models(daily), root)
    loaded = M.load_models(root, SECTORS)
    scored = M.score(daily, M.coefficient_frame(spark, loaded))
    # ten iterations leave the fifth decimal open
    return _rounded(scored, 1, "prediction").select("sector", "tickerSymbol", "timestamp", "prediction")


@query
def score_fixed_coeffs(spark, sf_dir):
    scored = M.score(_model_bars(_daily(spark, sf_dir)), _fixed_coefficients(spark))
    return _rounded(scored, 6, "prediction").select("sector", "tickerSymbol", "timestamp", "prediction")


@query
def standard_scale(spark, sf_dir):
    daily = _settled_daily(spark, sf_dir)
    scaled = M.standard_scale(daily, "close", name="scaled_close")
    return _rounded(scaled, 6, "scaled_close").select("sector", "tickerSymbol", "timestamp", "scaled_close")


@query
def scaled_regression(spark, sf_dir):
    """Assembler, scaler and ridge regression of the high on the close."""
    daily = settle(_daily(spark, sf_dir).select("close", F.col("high").alias("Output")), "daily")
    _, scaler, ridge = M.fit_scaled_regression(daily).stages
    fitted = {
        "mean": scaler.mean[0],
        "std": scaler.std[0],
        "coefficient": ridge.coefficients[0],
        "intercept": ridge.intercept,
    }
    frame = small_frame(spark, {name: [float(value)] for name, value in fitted.items()})
    return _rounded(frame, 5, *fitted)


@query
def forecast_features(spark, sf_dir):
    frame = FC.forecast_features(_daily(spark, sf_dir))
    return _rounded(frame, 6, "open", "high", "low")


@query
def forecast_close(spark, sf_dir):
    frame = FC.forecast(_daily(spark, sf_dir), _fixed_coefficients(spark))
    return _rounded(frame, 6, "prediction").select("sector", "tickerSymbol", "timestamp", "prediction")


@query
def forecast_sector(spark, sf_dir):
    frame = FC.forecast(_daily(spark, sf_dir), _fixed_coefficients(spark))
    return S.in_order(S.published_series(frame, "prediction", "prediction"))


@query
def forecast_line_items(spark, sf_dir):
    """Feature days of every supplier: window of 12 bars, five days ahead."""
    frame = FC.forecast_features(_line_daily(spark, sf_dir), window_size=12, horizon=5)
    return _rounded(frame, 4, "open", "high", "low")


@query
def batch_forecast(spark, sf_dir):
    """The whole daily job: history and trained forecast of every sector."""
    return batch_series(_daily(spark, sf_dir))


# --- the one-step forecast -------------------------------------------------


def _one_step(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    history = _settled_daily(spark, sf_dir)
    predicted = settle(O.predict_next(history, _fixed_coefficients(spark)), "predicted")
    return history, predicted


@query
def history_full_join_forecast(spark, sf_dir):
    joined = O.full_join(*_one_step(spark, sf_dir))
    return _rounded(joined, 6, "open", "high", "low", "prediction").drop("max_timestamp")


@query
def fillna_after_full_join(spark, sf_dir):
    filled = O.fill_missing(O.full_join(*_one_step(spark, sf_dir)))
    return _rounded(filled, 6, "open", "high", "low", "prediction")


@query
def notnull_filter(spark, sf_dir):
    joined = O.full_join(*_one_step(spark, sf_dir)).filter(F.col("prediction").isNotNull())
    return _rounded(joined, 6, "prediction").select("sector", "tickerSymbol", "prediction")


@query
def multi_avg(spark, sf_dir):
    means = S.multi_mean(O.next_day_view(*_one_step(spark, sf_dir)))
    return _rounded(means, 6, "avg_prediction")


@query
def forecast_one_step(spark, sf_dir):
    """The one-step job to its published form."""
    means = S.multi_mean(O.fill_missing(O.full_join(*_one_step(spark, sf_dir))))
    dated = means.withColumn("timestamp", format_date(F.col("timestamp")))
    return S.in_order(_rounded(dated, 6, "avg_prediction"))


@query
def union_distinct(spark, sf_dir):
    """Recent bars and the pending forecast day, without duplicates."""
    columns = ["tickerSymbol", "open", "high", "low", "timestamp", "close"]
    daily = _settled_daily(spark, sf_dir)
    pending = FC.forecast(daily, _fixed_coefficients(spark), horizon=1)
    recent = R.last_n_strict(daily, 10)
    merged = S.union_distinct(
        recent.select(columns), pending.withColumnRenamed("prediction", "close").select(columns)
    )
    return _rounded(merged, 6, "open", "high", "low", "close")


# --- records ---------------------------------------------------------------


def _event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a broker record: JSON bytes and the sector as topic."""
    ticks = S.with_sector(event_ticks(spark, sf_dir), ticker_dimension(spark))
    body = F.to_json(F.struct(F.col("price").alias("close"), "timestamp", "tickerSymbol"))
    return ticks.select(body.cast("binary").alias("value"), F.col("sector").alias("topic"))


@query
def json_struct_project(spark, sf_dir):
    parsed = J.parse_records(_event_records(spark, sf_dir), BAR_SCHEMA)
    return parsed.select(F.col("data.close"), F.col("data.timestamp"), F.col("topic"))


@query
def malformed_records(spark, sf_dir):
    """The event properties are no bars: all of them are dead letters."""
    records = table(spark, sf_dir, "events").select(F.col("props").alias("value"), F.col("event_type").alias("topic"))
    _, bad = J.split_malformed(records)
    return bad


@query
def to_json_doc(spark, sf_dir):
    series = S.published_series(_daily(spark, sf_dir), "close", "historical")
    return series.select("sector", F.to_json(F.struct("timestamp", "avg_close")).alias("document"))


@query
def record_key(spark, sf_dir):
    nested = F.from_json("props", "struct<k: bigint>").alias("some_record")
    events = table(spark, sf_dir, "events").select(F.lit("world").alias("hello"), nested)
    return J.record_key(events, "some_record")


@query
def variant_record_key(spark, sf_dir):
    """The fields that a schema without any leaves over, and one of them as it came."""
    events = table(spark, sf_dir, "events").select("event_id", F.col("props").alias("value"))
    kept = J.with_unknown(events, StructType([StructField("hello", StringType())]))
    return kept.select("event_id", "data.hello", J.unknown_field("k").cast("long").alias("k"), F.size("unknown").alias("fields"))


@query
def route_by_tag(spark, sf_dir):
    bars = _daily(spark, sf_dir).select("sector", "tickerSymbol", "timestamp", "close", "volume")
    return J.to_records(bars)


@query
def route_one_tag(spark, sf_dir):
    bars = _daily(spark, sf_dir).select("sector", "tickerSymbol", "timestamp", "volume")
    return J.only_topic(J.to_records(bars), "tech")


@query
def word_count(spark, sf_dir):
    return J.word_count(table(spark, sf_dir, "documents"), "text")


# --- sinks, written and read back ------------------------------------------


@query
def landed_bars(spark, sf_dir):
    """Bars landed as JSON lines by sector and ticker."""
    path = new_path(spark, "landed")
    daily = _rounded(B.bars(event_ticks(spark, sf_dir), 1, "day"), 4, "vw")
    files_out.land_bars(daily, ticker_dimension(spark), path)
    return files_in.read_landed_bars(spark, path).select("sector", *BAR_SCHEMA.fieldNames())


@query
def result_files(spark, sf_dir):
    """Published series as JSON lines by sector and scope."""
    path = new_path(spark, "results")
    series = S.overlay(S.published_series(_daily(spark, sf_dir), "close", "historical"))
    files_out.write_results(series, path)
    return files_in.read_results(spark, path).select("sector", "scope", "timestamp", "avg_close")


@query
def upserted_results(spark, sf_dir):
    """Two versions of the daily close: the later one holds only the last days."""
    path = new_path(spark, "store")
    daily = _settled_daily(spark, sf_dir)
    store.upsert(S.overlay(S.published_series(daily, "close", "historical")), path, 0)
    corrected = daily.filter(F.col("timestamp") >= EVENTS_END_MS).withColumn("close", F.col("close") + 1)
    store.upsert(S.overlay(S.published_series(corrected, "close", "historical")), path, 1)
    return store.read_current(spark, path).select("sector", "scope", "timestamp", "avg_close")


@query
def compacted_store(spark, sf_dir):
    """A year of daily closes upserted month by month, twice, with a compaction after every fifth version.

    The second round changes every close; a reader opened before the last compaction and
    one after it see the same rows.
    """
    path = new_path(spark, "store")
    daily = _settled_daily(spark, sf_dir)
    version = 0
    for raised in (0, 1):
        series = S.overlay(S.published_series(daily.withColumn("close", F.col("close") + raised), "close", "historical"))
        for part in range(6):
            store.upsert(series.where(F.pmod(F.crc32("timestamp"), F.lit(6)) == part), path, version)
            version += 1
            if version % 5 == 0:
                store.compact(spark, path)
    before = store.read_current(spark, path)
    store.compact(spark, path)
    after = store.read_current(spark, path)
    columns = ["sector", "scope", "timestamp", "avg_close"]
    return before.select(*columns).unionByName(after.select(*columns)).distinct()


@query
def json_documents(spark, sf_dir):
    """Sector documents as indented JSON, one file each, and read back."""
    path = new_path(spark, "pretty")
    totals = _daily(spark, sf_dir).groupBy("sector").agg(
        F.sum("volume").alias("volume"), F.sum("numberOfItems").alias("numberOfItems")
    )
    files_out.write_pretty_json(totals, path)
    return files_in.read_json_documents(spark, path, "sector string, volume long, numberOfItems long")


# --- streams, run over what is there ---------------------------------------


def _stream_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a stream of 15-minute bars of one tick each."""
    ticks = events_as_ticks(follow_table(spark, sf_dir, "events"))
    bars = ticks.select(
        "tickerSymbol",
        bucket_start(F.col("timestamp"), 15, "minute").alias("timestamp"),
        F.col("price").alias("close"),
    )
    return S.with_sector(bars, ticker_dimension(spark))


def _ddl(frame: DataFrame) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in frame.dtypes)


def _finish(streaming_query) -> None:
    streaming_query.awaitTermination()


@query
def stream_sector_avg(spark, sf_dir):
    """Live means of all sectors in one stream, upserted into the store."""
    path = new_path(spark, "stream")
    means = live.sector_means(_stream_bars(spark, sf_dir))
    _finish(live.upsert_stream(means, f"{path}/store", f"{path}/checkpoint"))
    return store.read_current(spark, f"{path}/store").select("sector", "scope", "timestamp", "avg_close")


@query
def stream_sector_avg_bounded(spark, sf_dir):
    """The same with a watermark."""
    path = new_path(spark, "stream")
    means = live.bounded_sector_means(_stream_bars(spark, sf_dir))
    _finish(live.upsert_stream(means, f"{path}/store", f"{path}/checkpoint"))
    return store.read_current(spark, f"{path}/store").select("sector", "scope", "timestamp", "avg_close")


@query
def live_deduped_means(spark, sf_dir):
    """Live means over three rounds of deliveries: bars, copies of some, changed prices of some.

    The last delivery of a bar counts, whichever micro-batch it comes in.
    """
    path = new_path(spark, "stream")
    ticks = event_ticks(spark, sf_dir).withColumn("event", (F.col("seq") % F.lit(Decimal(10**19))).cast("long"))
    bars = S.with_sector(ticks, ticker_dimension(spark)).select(
        "sector",
        "tickerSymbol",
        bucket_start(F.col("timestamp"), 15, "minute").alias("timestamp"),
        F.col("price").alias("close"),
        F.col("event").alias("delivery"),
    )
    bars = settle(bars, "bars")
    early = F.col("delivery") % 10 < 6
    changed = bars.where("delivery % 7 = 0").withColumn("close", F.col("close") + 1)
    rounds = (
        bars.where(early),
        bars.where(~early).unionByName(bars.where("delivery % 5 = 0")),
        changed.withColumn("delivery", F.col("delivery") + (1 << 40)),
    )
    for part in rounds:
        part.write.mode("append").parquet(f"{path}/deliveries")
    stream = spark.readStream.schema(bars.schema).option("maxFilesPerTrigger", 6).parquet(f"{path}/deliveries")
    _finish(live.correct_stream(stream, f"{path}/store", f"{path}/checkpoint", delay="400 days", compact_every=2))
    return store.read_current(spark, f"{path}/store").select("sector", "scope", "timestamp", "avg_close")


@query
def stream_bars(spark, sf_dir):
    """15-minute bars of the events as a stream, over several micro-batches whose ticks lie across each other."""
    path = new_path(spark, "stream")
    ticks = settle(event_ticks(spark, sf_dir), "ticks")
    for part in range(3):
        ticks.where(F.pmod(F.xxhash64("timestamp", "tickerSymbol"), F.lit(3)) == part).write.mode("append").parquet(f"{path}/ticks")
    stream = spark.readStream.schema(ticks.schema).option("maxFilesPerTrigger", 6).parquet(f"{path}/ticks")
    bars = streamed.stream_bars(stream, 15, "minute", delay="400 days")
    _finish(streamed.upsert_bars(bars, f"{path}/bars", f"{path}/checkpoint", compact_every=2))
    return _rounded(streamed.read_live_bars(spark, f"{path}/bars"), 4, "vw")


@query
def stream_scored(spark, sf_dir):
    """Daily bars scored as they come; between two rounds the models change."""
    path = new_path(spark, "stream")
    daily = _settled_daily(spark, sf_dir)
    odd = F.floor(F.col("timestamp") / DAY_MS) % 2
    models = _fixed_coefficients(spark)
    for part, raised in ((0, 0.0), (1, 1.0)):
        streamed.publish_models(models.withColumn("intercept", F.col("intercept") + raised), f"{path}/models")
        daily.where(odd == part).write.mode("append").parquet(f"{path}/bars")
        stream = spark.readStream.schema(daily.schema).parquet(f"{path}/bars")
        _finish(streamed.score_stream(stream, f"{path}/models", f"{path}/out", f"{path}/checkpoint"))
    scored = spark.read.schema(f"{_ddl(daily)}, prediction double").parquet(f"{path}/out")
    return _rounded(scored, 6, "prediction").select("sector", "tickerSymbol", "timestamp", "prediction")


@query
def stream_dedup(spark, sf_dir):
    """Line items as a stream of bars: one delivery per supplier and ship date."""
    path = new_path(spark, "stream")
    lines = follow_table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("tickerSymbol"), epoch_ms(F.col("l_shipdate")).alias("timestamp")
    )
    _finish(live.append_files(live.dedup_stream(lines), f"{path}/out", f"{path}/checkpoint"))
    return spark.read.schema("tickerSymbol string, timestamp long").parquet(f"{path}/out")


@query
def stream_word_count(spark, sf_dir):
    """Word counts of the one micro-batch that the documents make."""
    path = new_path(spark, "stream")
    lines = follow_table(spark, sf_dir, "documents").select(F.col("text").alias("value"))
    _finish(live.count_words(lines, f"{path}/out", f"{path}/checkpoint", every=None))
    return spark.read.schema("word string, n long").parquet(f"{path}/out").select("word", "n")


@query
def stream_to_topics(spark, sf_dir):
    """Events routed as JSON messages, a folder per topic in place of a broker."""
    path = new_path(spark, "stream")
    records = J.to_records(_stream_bars(spark, sf_dir).select("sector", "tickerSymbol", "timestamp"))
    _finish(live.append_files(records, f"{path}/out", f"{path}/checkpoint", ("topic",)))
    return spark.read.schema("value string, topic string").parquet(f"{path}/out").select("topic", "value")
