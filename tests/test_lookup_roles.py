"""Lookups of several roles in one table: the single pass against one lookup per role."""

import pytest

from nightaudit.operators.lookups import BROADCAST_CONF, BROADCAST_MAX_BYTES, lookup, lookup_roles
from nightaudit.plans import detail
from nightaudit.sources.hotel import hotel_tables
from tests.conftest import SF_SMALL

ROLES = {"guest": {"label": "guest_label", "city": "guest_city"}, "agent": {"label": "agent_label"}}
WHAT = {"guest": "guest profile", "agent": "agent profile"}


@pytest.fixture(params=[BROADCAST_MAX_BYTES, 0], ids=["broadcast", "one pass"])
def bound(spark, request):
    spark.conf.set(BROADCAST_CONF, str(request.param))
    yield request.param
    spark.conf.unset(BROADCAST_CONF)


def _profiles(spark, extra=()):
    return spark.createDataFrame([(i, f"p{i}", None if i % 3 else f"c{i}") for i in range(50)] + list(extra),
                                 "pid long, label string, city string")


def _facts(spark, rows):
    return spark.createDataFrame(rows, "row long, guest long, agent long, label string")


def test_roles_equal_single_lookups(spark, bound):
    rows = [(i, i % 60, None if i % 4 == 0 else 7 if i % 4 < 3 else i % 60, "own") for i in range(400)]
    rows += rows[:5] + [(999, None, None, None)]  # repeated rows, no ids at all
    facts, dim = _facts(spark, rows), _profiles(spark)
    got = lookup_roles(facts, dim, "pid", ROLES, WHAT)
    one = facts
    for col, own in ROLES.items():
        one = lookup(one, dim, {col: "pid"}, own, WHAT[col])
    assert got.columns == one.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, one.collect()))


def test_only_asked_duplicates_raise(spark, bound):
    dim = _profiles(spark, [(48, "again", None), (None, "no id", None), (None, "no id", None)])
    fine = _facts(spark, [(1, 3, 4, "x"), (2, None, 3, "x")])
    assert lookup_roles(fine, dim, "pid", ROLES, WHAT).count() == 2
    assert {r["agent_label"] for r in lookup_roles(fine, dim, "pid", ROLES, WHAT).collect()} == {"p4", "p3"}
    with pytest.raises(Exception, match='agent profile returned more than one row for key .*48'):
        lookup_roles(_facts(spark, [(1, 3, 48, "x")]), dim, "pid", ROLES, WHAT).collect()


def test_empty_tables(spark, bound):
    assert lookup_roles(_facts(spark, []), _profiles(spark), "pid", ROLES, WHAT).collect() == []
    rows = lookup_roles(_facts(spark, [(1, 2, 3, "x")]), _profiles(spark).limit(0), "pid", ROLES, WHAT).collect()
    assert [tuple(r) for r in rows] == [(1, 2, 3, "x", None, None, None)]


def test_detail_joins_large_profiles_once(spark):
    """Q2's profile columns without a broadcast: the profiles' scan stands in the plan once for the four roles."""
    t = hotel_tables(spark, SF_SMALL)
    cols = ["first_name", "last_name", "nationality", "travel_agent", "company", "group_profile"]
    spark.conf.set(BROADCAST_CONF, "0")
    try:
        plan = detail.reservation_detail(t).select("resv_name_id", *cols)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset(BROADCAST_CONF)
    assert sum("Relation" in line and "nationality" in line for line in plan.splitlines()) == 1
