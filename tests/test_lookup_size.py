"""Lookups in tables that files hold in far fewer bytes than memory: they are merged, and what asks for them moves while it
is narrow, with the rows and errors of the broadcast form."""

import uuid
from datetime import date

import pytest

from nightaudit.operators import lookups
from nightaudit.plans import detail, loyalty
from nightaudit.session import ensure_checkpoint_dir
from nightaudit.sources.hotel import hotel_tables
from tests.conftest import SF_SMALL
from tests.test_semantics import _rn


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def _executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_small_tables(monkeypatch):
    monkeypatch.setattr(lookups, "LOOKUP_MAX_BYTES", 0)


def test_many_keys_in_few_bytes_are_not_broadcast(spark):  # F3, F4, F7, F8
    path = f"{ensure_checkpoint_dir(spark)}/size-{uuid.uuid4().hex}"
    (spark.range(600_000).selectExpr("id AS name_id", "concat('p', id) AS last", "md5(cast(id AS string)) AS first")
     .write.option("compression", "zstd").parquet(path))
    profiles = spark.read.parquet(path)
    fact = spark.createDataFrame([(1, 5, 6), (2, 7, None)], "row long, guest long, agent long")
    one = lookups.lookup(fact, profiles, {"guest": "name_id"}, {"last": "guest_last"}, "guest")
    both = lookups.lookup_roles(fact, profiles.select("name_id", "last"), "name_id",
                                {"guest": {"last": "g"}, "agent": {"last": "a"}}, {"guest": "guest", "agent": "agent"})
    for df in (one, both):  # neither by a hint nor by Spark's estimate of the files
        assert "strategy=broadcast" not in _plan(df)
        assert not any("BuildRight" in line and "name_id" in line for line in _executed(df).splitlines())
    assert sorted(tuple(r) for r in both.collect()) == [(1, 5, 6, "p5", "p6"), (2, 7, None, "p7", None)]


def test_few_asked_keys_of_a_large_table_are_broadcast(spark, no_small_tables):
    fact = spark.createDataFrame([(1, 5), (2, 7), (3, None)], "row long, agent long")
    dim = spark.createDataFrame([(5, "a"), (6, "b"), (6, "c")], "pid long, label string")
    assert lookups.few_keys(fact, ["agent"])
    df = lookups.lookup(fact, dim, {"agent": "pid"}, {"label": "agent_label"}, "agent", few=fact)
    assert "strategy=broadcast" in _plan(df)
    assert sorted((r.row, r.agent_label) for r in df.collect()) == [(1, "a"), (2, None), (3, None)]


@pytest.mark.parametrize("few", [True, False])
def test_detail_and_statement_without_small_tables(spark, monkeypatch, few):
    t = hotel_tables(spark, SF_SMALL)
    plain = [sorted(map(str, q(t).collect())) for q in (detail.reservation_detail, loyalty.loyalty_statement)]
    monkeypatch.setattr(lookups, "LOOKUP_MAX_BYTES", 0)
    monkeypatch.setattr(detail, "few_keys", lambda *_: few)
    assert [sorted(map(str, q(t).collect())) for q in (detail.reservation_detail, loyalty.loyalty_statement)] == plain


def test_a_stay_without_nights_asks_for_no_guest(spark, tables, no_small_tables):
    day = date(2024, 2, 3)
    def night(stay):
        return ("R1", day, 1, stay, *[None] * 14)
    t = tables(reservation_name=[_rn("R1", 1, "CHECKED IN", name_id=1, begin=day), _rn("R1", 2, "CHECKED IN", name_id=2, begin=day)],
               reservation_daily_element_name=[night(1)], reservation_daily_elements=[("R1", day, 1, *[None] * 7)],
               resort=[("R1", "Hotel", "TRY")],
               name=[(1, "One", None, None, None, None), (2, "Two", None, None, None, None), (2, "Again", None, None, None, None)],
               reservation_stat_daily=[("R1", 2, day, None, None)] * 2, reservation_summary=[("R1", "2", day, None, None)] * 2)
    assert [(r.resv_name_id, r.last_name) for r in detail.reservation_detail(t).collect()] == [(1, "One")]
    t["reservation_daily_element_name"] = t._df("reservation_daily_element_name", [night(1), night(2)])
    with pytest.raises(Exception, match="guest profile returned more than one row for key .*2"):
        detail.reservation_detail(t).select("last_name").collect()
    with pytest.raises(Exception, match="summary returned more than one row for key"):
        detail.reservation_detail(t).select("room_revenue").collect()
