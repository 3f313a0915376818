"""Physical-plan shape of the operators whose cost matters at scale."""

import re

import __spark_entry__ as E
from retenta.operators.requests import request_profile
from retenta.registry.common import clients, requests
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_request_profile_is_one_shuffle_without_expand(spark):
    p = _plan(request_profile(requests(spark, SF_SMALL)).select("ID_CORRELATIVO", "nro_dictamenes"))
    agg_part = p.split("ObjectHashAggregate")[1:]  # the profile aggregate and what feeds it
    assert "Expand" not in p
    assert len(re.findall(r"Exchange hashpartitioning\(ID_CORRELATIVO", p)) == 1, p
    assert agg_part


def test_countdistinct_variant_expands(spark):
    p = _plan(request_profile(requests(spark, SF_SMALL), distinct="expand"))
    assert "Expand" in p


def test_scans_read_only_used_columns(spark):
    p = _plan(clients(spark, SF_SMALL))
    lineitem = [s for s in re.findall(r"ReadSchema: struct<([^>]*)>", p) if "l_orderkey" in s]
    assert lineitem and all("l_extendedprice" not in s and "l_shipdate" not in s for s in lineitem)


def test_rank_plan_has_no_single_partition_exchange_of_the_data(spark):
    df = E.queries()["rank_first_desc"](spark, SF_SMALL)
    p = _plan(df)
    # the only single-partition exchange feeds the window over per-range-partition counts
    for m in re.finditer(r"Exchange SinglePartition", p):
        below = p[m.end():m.end() + 400]
        assert "HashAggregate" in below, p


def test_month_filter_prunes_the_other_month(spark):
    df = E.queries()["filter_month_eq_clients"](spark, SF_SMALL)
    optimized = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in optimized


def test_bucketed_split_tables_need_no_shuffle_for_the_profile(spark):
    from retenta.registry.common import split_tables
    tr_r = split_tables(spark, SF_SMALL)[2]
    p = _plan(request_profile(tr_r))
    assert "Exchange" not in p, p
