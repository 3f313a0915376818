"""The stand-in tables have the shape documented in FIXTURES.md at sf0.01."""

from pyspark.sql import functions as F

from retenta.functions.schema import CLIENT_COLUMNS
from retenta.registry.common import clients, requests
from tests.conftest import SF_MID


def test_clients_shape(spark):
    c = clients(spark, SF_MID)
    assert c.columns == CLIENT_COLUMNS
    assert c.count() == 1500
    assert c.where("ATTRITION = 1").count() == 791


def test_requests_shape(spark):
    r = requests(spark, SF_MID)
    assert r.count() == 4573
    assert r.select("ID_CORRELATIVO").distinct().count() == 777
    assert r.agg(F.min("CODMES"), F.max("CODMES")).first() == (200009, 200102)


def test_request_range_reaches_the_scan(spark):
    plan = requests(spark, SF_MID)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan
