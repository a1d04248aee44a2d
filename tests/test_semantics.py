"""Hand fixtures for the Oracle semantics that change answers
and for the rewritten operators' edge rows (FIXTURES.md section 2)."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from nightaudit.functions.oracle import least_or_null, profile_name, text_concat, to_char_int, to_char_money
from nightaudit.operators import flags
from nightaudit.operators.asof import stay_and_eur_rates
from nightaudit.operators.lists import bill_number_list
from nightaudit.operators.lookups import lookup

d = dt.date


def test_concat_treats_null_as_empty_and_nvl_falls_through(spark):  # S1
    df = spark.createDataFrame([(None, "ACME", None), ("Smith", None, "Ann")], "last string, company string, first string")
    got = {r[0] for r in df.select(text_concat(profile_name(), ",", F.col("first"))).collect()}
    assert got == {"ACME,", "Smith,Ann"}


def test_least_is_null_when_any_argument_is_null(spark):  # S2
    df = spark.createDataFrame([(d(2000, 1, 5), None), (d(2000, 1, 5), d(1999, 1, 1))], "a date, b date")
    assert [r[0] for r in df.select(least_or_null("a", "b")).collect()] == [None, d(1999, 1, 1)]


def test_number_formats(spark):  # S15
    df = spark.createDataFrame([(D("-1"), D("1234.5")), (D("18"), D("0.004"))], "p decimal(10,0), m decimal(18,4)")
    got = df.select(to_char_int(F.col("p")), to_char_money(F.col("m"))).collect()
    assert [tuple(r) for r in got] == [("-1", "1234.50"), ("18", "0.00")]


def _resort_info(spark, rows):
    return spark.createDataFrame(rows, "resort string, resort_currency string, open_business_date date")


RATE_SCHEMA = ("resort string, base_curr_code string, currency_code string, exchange_rate_type string, "
               "begin_date date, exchange_rate decimal(18,8)")


def test_asof_rate_ties_tolerance_and_business_date(spark):  # J11, S2, S14
    rates = spark.createDataFrame([
        ("R1", "TRY", "USD", "POST", d(2000, 1, 10), D("2.5")),
        ("R1", "TRY", "USD", "CURR", d(2000, 1, 10), D("2.7")),     # tie: 2.7 wins (NVL DESC)
        ("R1", "TRY", "USD", "POST", d(2000, 2, 10), None),
        ("R1", "TRY", "USD", "POST", d(2000, 2, 10), D("0")),       # {NULL, 0} -> 0
        ("R1", "TRY", "USD", "POST", d(2000, 3, 10), None),         # {NULL} -> NULL, no fall-back
        ("R1", "TRY", "USD", "OTHER", d(2000, 3, 20), D("9")),      # wrong type: ignored
        ("R1", "TRY", "GBP", "POST", d(2000, 1, 1), D("5")),
        ("R1", "USD", "GBP", "POST", d(2000, 1, 2), D("7")),        # other base: ignored
        ("R1", "TRY", "EUR", "POST", d(2000, 1, 1), D("3")),
        ("R2", "EUR", "EUR", "POST", d(2000, 1, 1), D("1.5")),
        ("R3", "TRY", "GBP", "POST", d(2000, 1, 1), D("5")),
        ("R3", "TRY", "GBP", "POST", d(2000, 9, 1), D("6")),
        ("R4", "TRY", "GBP", "POST", d(2000, 1, 1), D("5")),
    ], RATE_SCHEMA)
    info = _resort_info(spark, [("R1", "TRY", d(2001, 6, 1)), ("R2", "EUR", d(2001, 6, 1)),
                                ("R3", "TRY", d(2000, 6, 1)), ("R4", "TRY", None)])
    nights = spark.createDataFrame([
        ("R1", d(2000, 1, 15), "USD"), ("R1", d(2000, 2, 15), "USD"), ("R1", d(2000, 3, 15), "USD"),
        ("R1", d(2000, 10, 27), "GBP"),   # exactly 300 days after the rate
        ("R1", d(2000, 10, 28), "GBP"),   # 301 days: out of tolerance
        ("R1", d(2000, 1, 15), "TRY"),    # resort currency: 1
        ("R1", d(2000, 1, 15), None),     # NULL currency: NULL
        ("R2", d(2000, 5, 1), "EUR"),     # EUR-base resort: 1, EUR rate still looked up
        ("R3", d(2000, 12, 1), "GBP"),    # future stay: bound from business date - 300
        ("R4", d(2000, 1, 15), "GBP"),    # no open business date: NULL
    ], "resort string, reservation_date date, currency_code string")
    got = {(r.resort, r.reservation_date, r.currency_code): (r.exchange_rate, r.eur_exchange_rate)
           for r in stay_and_eur_rates(nights, rates, info).collect()}
    r = lambda x: None if x is None else D(x).quantize(D("0.00000001"))
    assert got[("R1", d(2000, 1, 15), "USD")] == (r("2.7"), r("3"))
    assert got[("R1", d(2000, 2, 15), "USD")][0] == r("0")
    assert got[("R1", d(2000, 3, 15), "USD")][0] is None
    assert got[("R1", d(2000, 10, 27), "GBP")][0] == r("5")
    assert got[("R1", d(2000, 10, 28), "GBP")][0] is None
    assert got[("R1", d(2000, 1, 15), "TRY")][0] == r("1")
    assert got[("R1", d(2000, 1, 15), None)] == (None, r("3"))
    assert got[("R2", d(2000, 5, 1), "EUR")] == (r("1"), r("1.5"))
    assert got[("R3", d(2000, 12, 1), "GBP")][0] == r("6")
    assert got[("R4", d(2000, 1, 15), "GBP")][0] is None


def _rn(resort, resv, status, name_id=1, begin=d(2000, 1, 1), end=d(2000, 1, 4), parent=None, usage=None):
    return (resort, resv, name_id, resv + 1000, status, begin, end, None, None, None, None, None, None, None,
            None, parent, usage)


def test_shared_stay_flag(spark, tables):  # J7
    t = tables(
        reservation_name=[_rn("R1", 1, "CHECKED IN"), _rn("R1", 2, "CANCELLED"), _rn("R1", 3, "CHECKED IN"),
                          _rn("R1", 4, "CHECKED IN"), _rn("R1", 5, "CANCELLED"), _rn("R2", 6, "CHECKED IN")],
        reservation_daily_element_name=[
            (r, day, seq, resv) + (None,) * 14
            for r, day, seq, resv in [
                ("R1", d(2000, 1, 1), 11, 1), ("R1", d(2000, 1, 2), 12, 1), ("R1", d(2000, 1, 3), 13, 1),
                ("R1", d(2000, 1, 1), 11, 2),    # cancelled guest in 1's first slot
                ("R1", d(2000, 1, 3), 13, 3),    # active guest on 1's third night
                ("R1", d(2000, 1, 5), 15, 4), ("R1", d(2000, 1, 5), 15, 5),
                ("R2", d(2000, 1, 1), 11, 6)]])  # same slot number, other resort
    got = {r.resv_name_id: r.shared_yn for r in
           flags.shared_stay_flag(t["reservation_name"], t["reservation_daily_element_name"]).collect()}
    assert got == {1: "Y", 2: "Y", 3: "Y", 4: "N", 5: "Y", 6: "N"}


def test_accompanying_names(spark, tables):  # J8, A8
    t = tables(
        reservation_name=[_rn("R1", 1, "CHECKED IN"),
                          _rn("R1", 2, "CHECKED IN", name_id=20, parent=1, usage="AG"),
                          _rn("R1", 3, "CHECKED IN", name_id=30, parent=1, usage="AG"),   # no profile
                          _rn("R1", 4, "CHECKED IN", name_id=40, parent=1, usage="AG"),
                          _rn("R1", 5, "CHECKED IN", name_id=50, parent=1),               # not 'AG'
                          _rn("R2", 6, "CHECKED IN", name_id=20, parent=1, usage="AG"),   # other resort
                          _rn("R1", 7, "CHECKED IN", name_id=30, parent=8, usage="AG")],  # only unnamed kids
        name=[(20, "Last1", None, None, None, None), (40, "Adams", "Zed", None, None, None),
              (50, "X", "Y", None, None, None)])
    got = {(r.resort, r.resv_name_id): (r.accompanying_yn, r.accompanying_names)
           for r in flags.accompanying(t["reservation_name"], t["name"]).collect()}
    assert got[("R1", 1)] == ("Y", "Adams,Zed,Last1")
    assert got[("R1", 8)] == ("Y", None)
    assert ("R1", 5) not in got


def test_repeat_guest_flag(spark, tables):  # J9
    t = tables(reservation_name=[
        _rn("R1", 1, "CHECKED OUT", name_id=7, begin=d(2000, 1, 1)),
        _rn("R2", 2, "RESERVED", name_id=7, begin=d(2000, 2, 1)),      # earlier stay in another resort: Y
        _rn("R1", 3, "CHECKED OUT", name_id=7, begin=d(2000, 1, 1)),   # same day as the first: N
        _rn("R1", 4, "CANCELLED", name_id=8, begin=d(2000, 1, 1)),
        _rn("R1", 5, "RESERVED", name_id=8, begin=d(2000, 2, 1))])     # earlier one cancelled: N
    got = {r.resv_name_id: r.repeat_yn for r in flags.repeat_guest_flag(t["reservation_name"]).collect()}
    assert got == {1: "N", 2: "Y", 3: "N", 4: "N", 5: "N"}


def test_bill_number_list(spark):  # A7
    df = spark.createDataFrame([(1, 10), (1, 9), (1, None), (2, None)], "g int, bill_no bigint")
    got = dict(df.groupBy("g").agg(bill_number_list("bill_no").alias("b")).collect())
    assert got == {1: "9,10", 2: None}


def test_lookup_raises_on_duplicate_key(spark):  # S8
    fact = spark.createDataFrame([(1,), (2,)], "k int")
    dim = spark.createDataFrame([(1, "a"), (1, "b"), (3, "c")], "k int, v string")
    with pytest.raises(Exception, match="more than one row"):
        lookup(fact, dim, {"k": "k"}, {"v": "v"}, "dim").collect()
    # a duplicate that no row asks for, or that a row does not evaluate, does no harm
    asked = spark.createDataFrame([(3,), (None,)], "k int")
    got = lookup(asked, dim, {"k": "k"}, {"v": "v"}, "dim").collect()
    assert sorted((r.k or 0, r.v) for r in got if r.k) == [(3, "c")] and [r.v for r in got if r.k is None] == [None]
    got = lookup(fact, dim, {"k": "k"}, {"v": "v"}, "dim", when=F.col("k") == 2).collect()
    assert sorted(tuple(r) for r in got) == [(1, None), (2, None)]


def test_event_filter_and_room_flags(spark):  # S5, S6, F8-F10
    df = spark.createDataFrame([(None, None), (5, None), (5, "-1"), (5, "C1")], "event_id bigint, room_category string")
    kept = df.where(flags.event_row_kept(F.col("event_id"), F.col("room_category"))).collect()
    assert [(r.event_id, r.room_category) for r in kept] == [(None, None), (5, "-1"), (5, "C1")]
    pm = [r[0] for r in df.select(flags.pseudo_room(F.col("room_category"))).collect()]
    assert pm == ["Y", "Y", "Y", "N"]


def test_share_priority_counts_zero_when_no_rows(spark):  # S9, J15
    df = spark.createDataFrame([(None, 3), (1, 3), (2, None)], "n long, p int")
    assert [r[0] for r in df.select(flags.share_priority(F.col("n"), F.col("p"))).collect()] == [3, 1, 0]
