import math
import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from marketflow.operators import models as M
from tests.conftest import rows

SCHEMA = "sector string, tickerSymbol string, timestamp long, open double, high double, low double, close double"


def market(seed=3, sectors=("tech", "energy"), size=300):
    """Correlated prices, as bars have them."""
    draw = random.Random(seed)
    data = []
    for sector in sectors:
        price = draw.uniform(50, 150)
        for i in range(size):
            opening = price
            price += draw.gauss(0, 2)
            data.append(
                (sector, "T", i, opening, max(opening, price) + draw.random(), min(opening, price) - draw.random(), price)
            )
    return data


@pytest.fixture(scope="module")
def bars(spark):
    return spark.createDataFrame(market(), SCHEMA).cache()


def test_one_pass_fit_equals_the_fit_on_rows(bars):
    models = M.fit_sector_models(bars)
    assert set(models) == {"tech", "energy"}
    for sector, model in models.items():
        direct = M.fit_one(bars.filter(F.col("sector") == sector))
        assert np.allclose(model.coefficients, direct.coefficients, rtol=1e-6, atol=1e-8)
        assert math.isclose(model.intercept, direct.intercept, rel_tol=1e-5, abs_tol=1e-6)


def test_settings_reach_the_solver(bars):
    model = M.fit_sector_models(bars, elasticNetParam=0.8)["tech"]
    assert model.getElasticNetParam() == 0.8 and model.getRegParam() == 0.3 and model.getMaxIter() == 10


def test_fit_without_rows(bars):
    assert M.fit_sector_models(bars.limit(0)) == {}


def test_save_and_load(spark, bars, tmp_path):
    models = M.fit_sector_models(bars)
    M.save_models(models, str(tmp_path))
    M.save_models(models, str(tmp_path))  # replaces
    loaded = M.load_models(str(tmp_path), ["tech", "energy"])
    assert {k: list(m.coefficients) for k, m in loaded.items()} == {k: list(m.coefficients) for k, m in models.items()}


def test_score_equals_the_model(spark, bars):
    models = M.fit_sector_models(bars)
    scored = M.score(bars, M.coefficient_frame(spark, models))
    ours = [p for *_, p in rows(scored.filter("sector = 'tech'"))]
    theirs = [r["prediction"] for r in models["tech"].transform(M.assemble(bars.filter("sector = 'tech'"))).orderBy("timestamp").collect()]
    assert np.allclose(ours, theirs)


def test_least_squares_against_numpy(bars):
    for row in M.ols_by_key(bars).collect():
        own = np.array([r[3:] for r in market() if r[0] == row["sector"]])
        x = np.column_stack([np.ones(len(own)), own[:, :3]])
        expected, *_ = np.linalg.lstsq(x, own[:, 3], rcond=None)
        assert np.allclose([row["intercept"], row["coef_open"], row["coef_high"], row["coef_low"]], expected, rtol=1e-6)


def test_trend_against_numpy(bars):
    for row in M.trend_by_key(bars).collect():
        own = np.array([r[3:] for r in market() if r[0] == row["sector"]])
        slope, intercept = np.polyfit(own[:, 0], own[:, 3], 1)
        assert np.allclose([row["slope"], row["intercept"]], [slope, intercept])


def test_one_job_elastic_net_reaches_the_converged_fit(bars):
    for row in M.elastic_net_by_key(bars, sweeps=3000).collect():
        direct = M.fit_one(bars.filter(F.col("sector") == row["sector"]), maxIter=2000, tol=1e-13)
        got = [row["coef_open"], row["coef_high"], row["coef_low"]]
        assert np.allclose(got, direct.coefficients, atol=2e-4)


def test_assemble(spark, bars):
    first = M.assemble(bars).select(vector_to_array("features").alias("f"), "open", "high", "low").first()
    assert first["f"] == [first["open"], first["high"], first["low"]]
    holed = spark.createDataFrame([("s", "t", 1, 1.0, None, 1.0, 1.0)], SCHEMA)
    assert M.assemble(holed, invalid="skip").count() == 0


def test_scaler_against_numpy(bars):
    got = {(s, t): v for s, t, v in rows(M.standard_scale(bars, "close"), "sector", "timestamp", "scaled_close")}
    own = np.array([r[6] for r in market() if r[0] == "tech"])
    assert np.allclose([got[("tech", i)] for i in range(len(own))], (own - own.mean()) / own.std(ddof=1))


def test_scaler_of_a_constant(spark):
    flat = spark.createDataFrame([("s", 2.0)] * 3, "sector string, close double")
    assert {r["scaled_close"] for r in M.standard_scale(flat, "close").collect()} == {0.0}


def test_scaled_regression_predicts(bars):
    fitted = M.fit_scaled_regression(bars.select("close", F.col("high").alias("Output")))
    scored = fitted.transform(bars.select("close", F.col("high").alias("Output")))
    error = scored.select(F.avg(F.abs(F.col("prediction") - F.col("Output")))).first()[0]
    assert error < 2.0


def test_rolling_fit_equals_a_refit_of_every_window(spark, bars):
    span = 40
    slid = M.elastic_net_rolling(bars, span, sweeps=50)
    at = {(r["sector"], r["timestamp"]): r for r in slid.collect()}
    assert len(at) == 600
    for last in (0, 7, 39, 40, 41, 150, 299):
        window = bars.where(f"timestamp > {last - span} and timestamp <= {last}")
        for r in M.elastic_net_by_key(window, sweeps=50).collect():
            got = at[r["sector"], last]
            assert got["n"] == r["n"] == min(last + 1, span)
            for c in ("intercept", "coef_open", "coef_high", "coef_low"):
                assert math.isclose(got[c], r[c], rel_tol=1e-6, abs_tol=1e-6), (last, c)


def test_rolling_fit_of_gaps_nulls_and_constants(spark):
    data = [("a", "T", t, 1.0, 1.0, 1.0, 1.0) for t in (0, 1, 50)] + [("a", "U", 1, 2.0, 2.0, None, 2.0), (None, "T", 1, 1.0, 1.0, 1.0, 1.0)]
    frame = spark.createDataFrame(data, SCHEMA)
    found = {r["timestamp"]: (r["n"], r["coef_open"], r["intercept"]) for r in M.elastic_net_rolling(frame, 10).collect()}
    assert found == {0: (1, 0.0, 1.0), 1: (2, 0.0, 1.0), 50: (1, 0.0, 1.0)}
    assert M.elastic_net_rolling(frame.limit(0), 10).count() == 0
