"""The daily job: fit, forecast, publish."""

from __future__ import annotations

from pyspark.sql import DataFrame

from marketflow.operators.forecast import forecast
from marketflow.operators.models import coefficient_frame, fit_sector_models, save_models
from marketflow.operators.series import overlay, published_series
from marketflow.schema import WINDOW_SIZE
from marketflow.session import settle
from marketflow.sinks.files import write_results


def batch_series(
    bars: DataFrame,
    window_size: int = WINDOW_SIZE,
    horizon: int | None = None,
    model_root: str | None = None,
) -> DataFrame:
    """History and forecast of every sector, in the result schema.

    The bars are settled first: the fit, the history and the forecast each read
    them, and none should parse or aggregate them again.
    """
    settled = settle(
        bars.select("sector", "tickerSymbol", "timestamp", "open", "high", "low", "close"), "bars"
    )
    models = fit_sector_models(settled)
    if model_root is not None:
        save_models(models, model_root)
    predicted = forecast(
        settled, coefficient_frame(bars.sparkSession, models), window_size, horizon
    )
    return overlay(
        published_series(settled, "close", "historical"),
        published_series(predicted, "prediction", "prediction"),
    )


def run_batch(
    bars: DataFrame,
    result_path: str,
    model_root: str,
    window_size: int = WINDOW_SIZE,
    horizon: int | None = None,
) -> None:
    """Fit and save the models of all sectors, write history and forecast."""
    write_results(batch_series(bars, window_size, horizon, model_root), result_path)
