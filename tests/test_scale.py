"""What moves and is written when tables grow: one join of the line items, keys instead of rows, aggregates instead of postings."""

import json
import uuid
from datetime import date
from decimal import Decimal as D

from nightaudit.operators.asof import asof_rate
from nightaudit.operators.revenue import with_child_tax
from nightaudit.plans import fiscal
from nightaudit.session import ensure_checkpoint_dir
from nightaudit.sources import ingest
from nightaudit.sources.hotel import hotel_tables

from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_charge_and_its_tax_come_from_one_join(spark):
    plan = _plan(hotel_tables(spark, SF_SMALL, materialize=False)["financial_transactions"])
    assert sum("Relation" in line and "l_orderkey" in line for line in plan.splitlines()) == 1


def test_raw_rows_are_kept_only_where_the_typed_values_do_not_tell_them(spark):
    names = [f.name for f in ingest.schema_of("reservation_daily_elements").fields]
    night = {"resort": "R1", "reservation_date": "2024-02-03", "room": "101"}
    rows = [night | {"resv_daily_el_seq": "1", "quantity": "1"}, night | {"resv_daily_el_seq": "2", "quantity": "01"},
            night | {"resv_daily_el_seq": "3", "quantity": "1"}, night | {"resv_daily_el_seq": "3", "quantity": "01"},
            *[night | {"resv_daily_el_seq": "4", "quantity": "1"}] * 3]
    raw = spark.createDataFrame([tuple(r.get(c, "") for c in names) for r in rows], ", ".join(f"{c} string" for c in names))
    kept = sorted((r.resv_daily_el_seq, r.quantity) for r in ingest.judged(raw, "reservation_daily_elements").where("_row IS NOT NULL").collect())
    assert kept == [(2, 1), (3, 1)]

    root = f"{ensure_checkpoint_dir(spark)}/scale-{uuid.uuid4().hex}"
    ingest.ingest_table(raw, root, "reservation_daily_elements")
    bad = sorted((json.loads(r.row)["resv_daily_el_seq"], json.loads(r.row)["quantity"], r.reasons[0])
                 for r in ingest.quarantine(spark, root, ["reservation_daily_elements"]).collect())
    several = "resort, reservation_date, resv_daily_el_seq: several rows"
    assert bad == [("3", "01", several), ("3", "1", several), ("4", "1", "repeated row"), ("4", "1", "repeated row")]
    good = spark.read.parquet(f"{root}/reservation_daily_elements")
    assert sorted((r.resv_daily_el_seq, r.quantity) for r in good.collect()) == [(1, 1), (2, 1), (4, 1)]


def test_the_rate_history_is_not_shuffled_to_be_pruned(spark, tables):
    t = tables(currency_exchange_rates=[("R1", "TRY", "EUR", "POST", date(2024, 1, 1), D("2"))])
    keys = spark.createDataFrame([("R1", date(2024, 1, 5), "EUR")], "resort string, reservation_date date, currency_code string")
    info = spark.createDataFrame([("R1", "TRY", date(2024, 1, 10))], "resort string, resort_currency string, open_business_date date")
    found = asof_rate(keys, t["currency_exchange_rates"], info)
    assert "strategy=broadcast" in _plan(found)
    assert [r.rate for r in found.collect()] == [D("2")]


def test_only_tax_exclusive_postings_meet_the_taxes(spark):
    postings = spark.createDataFrame([(1, "N"), (2, "Y"), (3, None), (4, "N")], "trx_no bigint, tax_inclusive_yn string")
    taxes = spark.createDataFrame([(1, D("5")), (2, D("6")), (3, D("7"))], "trx_no bigint, child_tax decimal(18,4)")
    got = {r.trx_no: r.child_tax for r in with_child_tax(postings, taxes).collect()}
    assert got == {1: D("5"), 2: None, 3: D("7"), 4: None}


def test_postings_are_counted_before_they_meet_the_bills(spark):
    t = hotel_tables(spark, SF_SMALL, materialize=False)
    assert _plan(fiscal.rule_counts(t, t["folio_tax"])).count("LeftSemi") == 1


def test_a_batch_moves_only_once_into_a_keyed_table(spark):  # F11, F13
    from nightaudit.plans.fiscal_state import folio_store
    from nightaudit.streaming.batch_store import PLACE, shaped
    spec = folio_store(spark, "unused").keyed["folio_payments"]
    rows = shaped(spark.sql("SELECT 'R1' AS resort, id % 9 AS resv_name_id, 1 AS folio_view, 7 AS bill_no, '8000' AS trx_code, "
                            "'Cash' AS pay_name, '0' AS card, 2.5 AS payment FROM range(90)"), spec.schema)
    merged = spec.merge(spec.placed(rows).repartition(*PLACE), PLACE)
    assert merged._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert sorted(r.payment for r in merged.collect()) == [D("25")] * 9


def test_kept_sums_are_written_once_a_batch(spark, tables):  # postings are not added up in a pass of their own
    from nightaudit.plans import fiscal_state
    store = fiscal_state.folio_store(spark, f"{ensure_checkpoint_dir(spark)}/scale-{uuid.uuid4().hex}")
    t = tables(trx_codes=[], params=[])
    seen = {}
    store.commit = lambda batch, rows: seen.update(rows)
    fiscal_state.apply_postings(store, 0, t, t["financial_transactions"].selectExpr("*", "1 AS sign"))
    assert sorted(seen) == ["folio_counts", "folio_payments"]
    # the lookups' own aggregates have no bill
    assert not [line for df in seen.values() for line in _plan(df).splitlines() if "Aggregate [" in line and "bill_no" in line]


def _bills_and_postings(spark):
    bills = spark.createDataFrame([("R1", 10, 1, 1), ("R1", 12, 1, 2), (None, None, 1, 3)],
                                  "resort string, resv_name_id bigint, folio_view int, bill_no bigint")
    postings = spark.createDataFrame([(n, "R1", n, 1) for n in (None, 9, 10, 11, 12, 13)],
                                     "trx_no bigint, resort string, resv_name_id bigint, folio_view int")
    return bills, postings


def test_the_scan_leaves_out_what_a_batch_cannot_ask_for(spark):  # F9
    bills, postings = _bills_and_postings(spark)
    inside = postings.where(fiscal.in_range("resv_name_id", bills, "resv_name_id"))
    assert sorted(r.resv_name_id for r in inside.collect()) == [10, 11, 12]
    none = bills.where("resv_name_id IS NULL")
    assert postings.where(fiscal.in_range("resv_name_id", none, "resv_name_id")).count() == 0


def test_stream_with_too_many_folios_to_broadcast_equals_batch(spark):  # F9
    from nightaudit.operators.lookups import BROADCAST_CONF
    from nightaudit.plans.fiscal_routing import fiscal_store, route_batch
    t = hotel_tables(spark, SF_SMALL)
    bills = t["folio_tax"]
    store = fiscal_store(spark, f"{ensure_checkpoint_dir(spark)}/scale-{uuid.uuid4().hex}")
    spark.conf.set(BROADCAST_CONF, "0")
    try:
        postings = fiscal.batch_postings(t, bills)
        assert not any("LeftSemi" in line for line in _plan(postings).splitlines())
        route_batch(store, 0, t, bills, small_batch=True, postings=postings)
    finally:
        spark.conf.unset(BROADCAST_CONF)
    outcomes, documents = fiscal.fiscal_gate(t)
    got = store.read("accepted").unionByName(store.read("rejected"))
    keys = ["bill_no", "resort", "resv_name_id", "folio_view", "outcome"]
    assert sorted(map(tuple, got.select(*keys).collect()), key=repr) == sorted(map(tuple, outcomes.select(*keys).collect()), key=repr)
    assert (sorted(map(tuple, store.read("outbox").select("resort", "bill_no", "document").collect()), key=repr)
            == sorted(map(tuple, documents.select("resort", "bill_no", "document").collect()), key=repr))
