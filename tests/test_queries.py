"""Every registered query against its DuckDB twin, value by value."""

import pytest

import __spark_entry__ as contract
from tests.compare import difference, duck
from tests.conftest import SMALL


# twins of trained models hold the converged fit; with the few bars of the smallest
# tables ten iterations stop short of it
TRAINED = {"elastic_net_fit", "elastic_net_fit_one_step", "saved_models", "batch_forecast"}
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def connections():
    return {folder: duck(folder) for folder in (SMALL, MEDIUM)}


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query_equals_twin(spark, connections, name):
    folder = MEDIUM if name in TRAINED else SMALL
    frame = contract.queries()[name](spark, folder)
    twin = contract.oracle_sql().get(name)
    if twin is None:
        assert frame.count() > 0
    else:
        assert difference(frame, connections[folder].sql(twin)) is None


def test_every_twin_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_has_a_stable_schema(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["sector", "scope", "timestamp", "avg_close", "avg_prediction"]
    scopes = {r["scope"]: r["n"] for r in frame.groupBy("scope").count().withColumnRenamed("count", "n").collect()}
    assert scopes["prediction"] == 60 and scopes["historical"] > 0
