"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the hotel tables Spark derives from the test tables under
``sf_dir`` and runs over them whole.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nightaudit.operators import flags, lookups, revenue
from nightaudit.operators.asof import stay_and_eur_rates
from nightaudit.operators.contacts import with_contacts
from nightaudit.operators.lists import bill_number_list
from nightaudit.plans import detail, fiscal, fiscal_routing, fiscal_state, ledger, loyalty
from nightaudit.session import ensure_checkpoint_dir
from nightaudit.sources import ingest
from nightaudit.sources.hotel import hotel_tables
from nightaudit.sources.schemas import HotelParquet

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


@register("guest_night_ledger")
def q_guest_night_ledger(spark, sf_dir):
    return ledger.guest_night_ledger(hotel_tables(spark, sf_dir))


@register("guest_night_ledger_sql")
def q_guest_night_ledger_sql(spark, sf_dir):
    return ledger.guest_night_ledger_sql(spark, hotel_tables(spark, sf_dir))


@register("shared_stay_flag")
def q_shared_stay_flag(spark, sf_dir):
    t = hotel_tables(spark, sf_dir)
    return flags.shared_stay_flag(t["reservation_name"], t["reservation_daily_element_name"])


@register("accompanying_names")
def q_accompanying_names(spark, sf_dir):
    t = hotel_tables(spark, sf_dir)
    rn = t["reservation_name"]
    acc = flags.accompanying(rn, t["name"])
    return (rn.select("resort", "resv_name_id").join(acc, ["resort", "resv_name_id"], "left")
            .select("resort", "resv_name_id", F.coalesce("accompanying_yn", F.lit("N")).alias("accompanying_yn"),
                    "accompanying_names"))


@register("child_tax_rollup")
def q_child_tax_rollup(spark, sf_dir):
    t = hotel_tables(spark, sf_dir)
    return revenue.child_tax(t["financial_transactions"], t["trx_codes"])


@register("daily_stay_revenue")
def q_daily_stay_revenue(spark, sf_dir):
    t = hotel_tables(spark, sf_dir)
    return revenue.daily_stay_revenue(revenue.ledger_detail(t["financial_transactions"], t["trx_codes"]))


# ---------------------------------------------------------------------------
# reservation detail (Q2) family
# ---------------------------------------------------------------------------

NIGHT_KEYS = ["resort", "resv_name_id", "reservation_date"]


def _nights(t):
    """Every nightly row of a known reservation (the lookups' driving rows)."""
    rn = t["reservation_name"]
    return t["reservation_daily_element_name"].join(
        rn.select("resort", "resv_name_id", "trunc_end_date"), ["resort", "resv_name_id"])


@register("reservation_detail")
def q_reservation_detail(spark, sf_dir):
    return detail.reservation_detail(hotel_tables(spark, sf_dir))


@register("inhouse_today")
def q_inhouse_today(spark, sf_dir):
    return detail.inhouse_today(hotel_tables(spark, sf_dir))


@register("reservation_extract")
def q_reservation_extract(spark, sf_dir):
    return detail.reservation_extract(hotel_tables(spark, sf_dir))


def _night_rates(spark, sf_dir):
    t = hotel_tables(spark, sf_dir)
    nights = _nights(t).select(*NIGHT_KEYS, "currency_code")
    info = lookups.sized_broadcast(detail.resort_info(t))
    fx = stay_and_eur_rates(nights, t["currency_exchange_rates"], info).select(
        F.col("resort").alias("_r"), F.col("reservation_date").alias("_d"), F.col("currency_code").alias("_c"),
        "exchange_rate", "eur_exchange_rate")
    return nights.join(fx, (F.col("resort") == F.col("_r")) & (F.col("reservation_date") == F.col("_d"))
                       & F.col("currency_code").eqNullSafe(F.col("_c")), "left")


@register("asof_stay_rate")
def q_asof_stay_rate(spark, sf_dir):
    return _night_rates(spark, sf_dir).select(*NIGHT_KEYS, "currency_code", "exchange_rate")


@register("asof_eur_rate")
def q_asof_eur_rate(spark, sf_dir):
    return _night_rates(spark, sf_dir).select(*NIGHT_KEYS, "eur_exchange_rate")


@register("open_business_date_rows")
def q_open_business_date_rows(spark, sf_dir):
    t = hotel_tables(spark, sf_dir)
    return detail.on_open_date(_nights(t), t).select(*NIGHT_KEYS, "resv_daily_el_seq")


@register("actual_or_forecast_revenue")
def q_actual_or_forecast_revenue(spark, sf_dir):
    t = hotel_tables(spark, sf_dir)
    f = lookups.with_resort(_nights(t).select(*NIGHT_KEYS), lookups.sized_broadcast(detail.resort_info(t)))
    return detail.actual_or_forecast(f, t).select(*NIGHT_KEYS, "room_revenue", "room_revenue_tax")


@register("slot_share_priority")
def q_slot_share_priority(spark, sf_dir):
    t = hotel_tables(spark, sf_dir)
    counts = flags.slot_share_count(t["reservation_name"], t["reservation_daily_element_name"])
    return (_nights(t).join(counts, "resv_daily_el_seq", "left")
            .select(*NIGHT_KEYS, flags.share_priority(F.col("slot_nights"), F.col("share_priority"))
                    .alias("share_priority")))


@register("repeat_guest_flag")
def q_repeat_guest_flag(spark, sf_dir):
    return flags.repeat_guest_flag(hotel_tables(spark, sf_dir)["reservation_name"])


@register("first_account_code")
def q_first_account_code(spark, sf_dir):
    t = hotel_tables(spark, sf_dir)
    agents = (t["reservation_daily_element_name"].where(F.col("travel_agent_id").isNotNull())
              .select("travel_agent_id").distinct())
    acc = lookups.first_account_code(t["ar_account"], t["ppor_ar"]).withColumnRenamed("name_id", "travel_agent_id")
    f = agents.join(acc, "travel_agent_id", "left")
    return lookups.lookup(f, t["ppor_name_ar"], {"travel_agent_id": "name_id"}, {"acc_code": "acc_code2"},
                          "ppor_name_ar")


@register("profile_lookups")
def q_profile_lookups(spark, sf_dir):
    t = hotel_tables(spark, sf_dir)
    return detail.reservation_detail(t).select(
        *NIGHT_KEYS, "resort_name", "first_name", "last_name", "nationality", "travel_agent", "company",
        "group_profile", "market_code_description", "group_name", "guest_country", "bookedroomtype", "roomtype")


# ---------------------------------------------------------------------------
# loyalty statement (Q1) family
# ---------------------------------------------------------------------------


@register("loyalty_statement")
def q_loyalty_statement(spark, sf_dir):
    return loyalty.loyalty_statement(hotel_tables(spark, sf_dir))


@register("revenue_classes")
def q_revenue_classes(spark, sf_dir):
    t = hotel_tables(spark, sf_dir)
    return revenue.revenue_classes(t["financial_transactions"], t["trx_codes"], t["resort_products"])


@register("bill_number_list")
def q_bill_number_list(spark, sf_dir):
    t = hotel_tables(spark, sf_dir)
    ft = t["financial_transactions"].where((F.col("ft_subtype") == "C") & F.col("trx_no_added_by").isNull())
    rn = t["reservation_name"].where(F.col("resv_status") == "CHECKED OUT").select(
        "resort", F.col("resv_name_id").alias("original_resv_name_id"))
    bills = ft.join(rn, ["resort", "original_resv_name_id"]).select(
        "resort", F.col("original_resv_name_id").alias("resv_name_id"), "bill_no").distinct()
    return bills.groupBy("resort", "resv_name_id").agg(bill_number_list("bill_no").alias("bill_no"))


@register("departure_day_lookup")
def q_departure_day_lookup(spark, sf_dir):
    t = hotel_tables(spark, sf_dir)
    return loyalty.with_departure(t["reservation_name"].select("resort", "resv_name_id"), loyalty.departure_names(t))


@register("preferred_contact")
def q_preferred_contact(spark, sf_dir):
    t = hotel_tables(spark, sf_dir)
    return with_contacts(t["name"].select("name_id"), t["name_phone"], t["name_document"])


# ---------------------------------------------------------------------------
# fiscal gate (Q7) family
# ---------------------------------------------------------------------------

FISCAL_KEYS = ["bill_no", "resort", "resv_name_id", "folio_view"]


@register("fiscal_outcomes")
def q_fiscal_outcomes(spark, sf_dir):
    return fiscal.fiscal_outcomes(hotel_tables(spark, sf_dir)).select(*FISCAL_KEYS, "outcome")


@register("fiscal_items")
def q_fiscal_items(spark, sf_dir):
    t = hotel_tables(spark, sf_dir)
    return fiscal.fiscal_items(t, t["folio_tax"])


@register("fiscal_payments")
def q_fiscal_payments(spark, sf_dir):
    t = hotel_tables(spark, sf_dir)
    return fiscal.fiscal_payments(t, t["folio_tax"])


@register("fiscal_documents")
def q_fiscal_documents(spark, sf_dir):
    return fiscal.fiscal_gate(hotel_tables(spark, sf_dir))[1]


@register("fiscal_stream")
def q_fiscal_stream(spark, sf_dir):
    """The same outcomes, produced by the streaming job (several micro-batches)."""
    from nightaudit.streaming.fiscal_stream import fiscal_stream_outcomes
    return fiscal_stream_outcomes(spark, hotel_tables(spark, sf_dir)).select(*FISCAL_KEYS, "outcome")


# ---------------------------------------------------------------------------
# routing, kept folio state, typed documents
# ---------------------------------------------------------------------------

_ONCE: dict[tuple, object] = {}


def _once(spark, sf_dir: str, name: str, make: Callable[[str], object]):
    """What several queries of a session read: ``make`` fills a fresh folder of the shared area, once."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _ONCE:
        _ONCE[key] = make(os.path.join(ensure_checkpoint_dir(spark), f"nightaudit-{name}", uuid.uuid4().hex))
    return _ONCE[key]


def _routed(spark, sf_dir):
    """The bills in two batches, some of the first again in the second; the second is tried twice."""
    def make(root):
        t, store = hotel_tables(spark, sf_dir), fiscal_routing.fiscal_store(spark, root)
        bill = F.coalesce("bill_no", F.lit(0))
        batches = [t["folio_tax"].where(bill % 2 == 0), t["folio_tax"].where((bill % 2 == 1) | (bill % 14 == 0))]
        for no in (0, 1, 1):
            fiscal_routing.route_batch(store, no, t, batches[no])
        return store
    return _once(spark, sf_dir, "fiscal-routing", make)


@register("fiscal_accepted")
def q_fiscal_accepted(spark, sf_dir):
    return _routed(spark, sf_dir).read("accepted")


@register("fiscal_rejected")
def q_fiscal_rejected(spark, sf_dir):
    return _routed(spark, sf_dir).read("rejected")


@register("fiscal_outbox")
def q_fiscal_outbox(spark, sf_dir):
    """K3: one live document per bill, with the batch that it came from."""
    return _routed(spark, sf_dir).read("outbox_live")


@register("fiscal_log")
def q_fiscal_log(spark, sf_dir):
    return _routed(spark, sf_dir).read("log")


def _folios(spark, sf_dir):
    """All postings in three batches: two of new ones, a third of them with wrong values, and their corrections. The
    second is tried twice."""
    def make(root):
        t, store = hotel_tables(spark, sf_dir), fiscal_state.folio_store(spark, root)
        ft = t["financial_transactions"]
        third = F.coalesce("trx_no", F.lit(0)) % 3 == 0
        wrong = ft.where(third).withColumns({"gross_amount": -F.col("gross_amount"), "guest_account_credit": F.lit(1).cast("decimal(18,4)")})
        plus, minus = F.lit(1).alias("sign"), F.lit(-1).alias("sign")
        batches = [ft.where(~third).select("*", plus), wrong.select("*", plus),
                   wrong.select("*", minus).unionByName(ft.where(third).select("*", plus))]
        for no in (0, 1, 1, 2):
            fiscal_state.apply_postings(store, no, t, batches[no])
        return store
    return _once(spark, sf_dir, "fiscal-folios", make)


@register("fiscal_kept_counts")
def q_fiscal_kept_counts(spark, sf_dir):
    """A11 from the kept folio state instead of the postings."""
    counts = fiscal_state.kept_counts(_folios(spark, sf_dir), hotel_tables(spark, sf_dir)["folio_tax"])
    return counts.where("mpay_count > 0 OR ppost_count > 0")


@register("fiscal_kept_payments")
def q_fiscal_kept_payments(spark, sf_dir):
    """A10 from the kept folio state instead of the postings."""
    t = hotel_tables(spark, sf_dir)
    return fiscal.fiscal_payments(t, t["folio_tax"], rows=fiscal_state.kept_payments(_folios(spark, sf_dir), t["folio_tax"]))


@register("fiscal_document_lines")
def q_fiscal_document_lines(spark, sf_dir):
    """R8 in json mode, parsed back."""
    t = hotel_tables(spark, sf_dir)
    return fiscal.document_lines(fiscal.fiscal_documents_json(t, fiscal.stored_outcomes(t)))


# ---------------------------------------------------------------------------
# bound reports (F2), ingested tables
# ---------------------------------------------------------------------------

#: Parameter sets of the ledger: resort, first and last day (None: not bound).
LEDGER_BINDS = [("R1", "1994-01-01", "1994-03-31"), ("R3", None, "1995-06-30"), (None, "1997-02-10", "1997-02-20")]


def _bound(report) -> DataFrame:
    """The report for every parameter set, with the set's number."""
    out = None
    for no, binds in enumerate(LEDGER_BINDS, 1):
        one = report(*binds).withColumn("binds", F.lit(no))
        out = one if out is None else out.unionByName(one)
    return out


@register("guest_night_ledger_bound")
def q_guest_night_ledger_bound(spark, sf_dir):
    t = hotel_tables(spark, sf_dir)
    return _bound(lambda *b: ledger.guest_night_ledger(t, *b))


@register("guest_night_ledger_sql_bound")
def q_guest_night_ledger_sql_bound(spark, sf_dir):
    t = hotel_tables(spark, sf_dir)
    return _bound(lambda *b: ledger.guest_night_ledger_sql(spark, t, *b))


#: What the ledger and the in-house list read.
INGESTED = ["resort", "businessdate", "reservation_name", "reservation_daily_element_name", "reservation_daily_elements", "name",
            "financial_transactions", "trx_codes", "currency_exchange_rates", "rate_header", "resort_markets",
            "allotment_header", "name_address", "reservation_stat_daily", "reservation_summary", "ar_account", "ppor_ar",
            "ppor_name_ar", "room_category"]


def _raw_feed(t) -> dict[str, DataFrame]:
    """The hotel tables as a text extract ('' for NULL) with faults among them: postings without a number or with text
    for an amount, nights of no day, and stays that come twice."""
    feed = {}
    for name in INGESTED:
        df = t[name]
        feed[name] = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns])
    ft, dn, rn = (feed[n] for n in ("financial_transactions", "reservation_daily_element_name", "reservation_name"))
    def every(key: str, n: int):
        return F.col(key).cast("bigint") % n == 0
    feed["financial_transactions"] = (
        ft.unionByName(ft.where(every("trx_no", 50)).withColumn("trx_no", F.lit("")))
        .unionByName(ft.where(every("trx_no", 70)).withColumns({"net_amount": F.lit("n/a"), "folio_view": F.lit("one")})))
    feed["reservation_daily_element_name"] = dn.unionByName(
        dn.where(every("resv_name_id", 40)).withColumn("reservation_date", F.lit("1994-02-30")))
    feed["reservation_name"] = rn.unionByName(rn.where(every("resv_name_id", 30)))
    return feed


def _ingested(spark, sf_dir):
    def make(root):
        # by year: the test tables hold a handful of rows of a resort and month
        ingest.ingest(spark, _raw_feed(hotel_tables(spark, sf_dir)), root, INGESTED, "_year")
        return root
    return _once(spark, sf_dir, "ingested", make)


@register("ingest_quarantine")
def q_ingest_quarantine(spark, sf_dir):
    """Rows set aside, by table and reason."""
    rows = ingest.quarantine(spark, _ingested(spark, sf_dir), INGESTED)
    return rows.select("table", F.explode("reasons").alias("reason")).groupBy("table", "reason").agg(F.count("*").alias("n"))


@register("ingested_inhouse_today")
def q_ingested_inhouse_today(spark, sf_dir):
    """Q3 over ingested tables: only the folders of the open days are read."""
    return detail.inhouse_today(HotelParquet(spark, _ingested(spark, sf_dir), period="_year"))


@register("ingested_ledger_bound")
def q_ingested_ledger_bound(spark, sf_dir):
    """Q5 with parameters over ingested tables: only the resort's and the months' folders are read."""
    t = HotelParquet(spark, _ingested(spark, sf_dir), period="_year")
    return _bound(lambda *b: ledger.guest_night_ledger(t, *b))
