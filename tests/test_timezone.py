"""Results do not depend on the session time zone (the driver tables hold
TIMESTAMP_NTZ wall-clock times in UTC)."""

import pytest

import __spark_entry__ as E
from scripts.oracle_check import canon
from tests.conftest import SF_SMALL

NAMES = ["clients_snapshot", "load_date_lima", "score_month", "stream_request_windows", "session_activity"]


@pytest.mark.parametrize("tz", ["America/Lima", "Asia/Tokyo"])
def test_session_time_zone_does_not_matter(spark, duck, tz):
    con = duck(SF_SMALL)
    prev = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", tz)
    try:
        for n in NAMES:
            got = E.queries()[n](spark, SF_SMALL).toPandas()
            assert canon(got) == canon(con.execute(E.oracle_sql()[n]).df()), n
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
