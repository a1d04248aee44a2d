"""Explicit schemas of the hotel tables, their layout on storage, and the reader of stored tables.

Stored tables are parquet folders ``<root>/<table>``, as ``sources.ingest`` writes them: '' is NULL already (the source
system, Oracle, has no empty string), so the reader hands out plain columns and every filter reaches the scan. The
nightly and posting facts are laid out by resort and month; ``in_dates`` carries a date range over to the months.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nightaudit.functions.oracle import blank_to_null

HOTEL_SCHEMAS = {
    "resort": "resort string, name string, currency_code string",
    "businessdate": "resort string, business_date date, state string",
    "reservation_name": "resort string, resv_name_id bigint, name_id bigint, confirmation_no bigint, resv_status string, trunc_begin_date date, trunc_end_date date, insert_date timestamp_ntz, business_date_created date, cancellation_date timestamp_ntz, cancellation_reason_code string, channel string, payment_method string, address_id bigint, event_id bigint, parent_resv_name_id bigint, name_usage_type string",
    "reservation_daily_element_name": "resort string, reservation_date date, resv_daily_el_seq bigint, resv_name_id bigint, adults int, children int, children1 int, children2 int, children3 int, children4 int, children5 int, travel_agent_id bigint, company_id bigint, group_id bigint, currency_code string, share_amount decimal(18,4), share_priority int, rate_code string",
    "reservation_daily_elements": "resort string, reservation_date date, resv_daily_el_seq bigint, room string, room_category string, booked_room_category string, quantity int, origin_of_booking string, allotment_header_id bigint, market_code string",
    "name": "name_id bigint, last string, first string, title string, company string, nationality string",
    "financial_transactions": "trx_no bigint, resort string, trx_date date, trx_code string, resv_name_id bigint, original_resv_name_id bigint, name_id bigint, net_amount decimal(18,4), gross_amount decimal(18,4), guest_account_credit decimal(18,4), guest_account_debit decimal(18,4), tax_inclusive_yn string, trx_no_added_by bigint, trx_no_against_package bigint, ft_subtype string, display_yn string, invoice_type string, product string, bill_no bigint, folio_view int, arrangement_id bigint",
    "trx_codes": "resort string, trx_code string, trx_code_type string, description string, cc_type string, ind_billing string",
    "resort_products": "resort string, product string, pkg_forcast_group string",
    "currency_exchange_rates": "resort string, base_curr_code string, currency_code string, exchange_rate_type string, begin_date date, exchange_rate decimal(18,8)",
    "rate_header": "resort string, rate_code string, complimentary_yn string, house_use_yn string",
    "resort_markets": "resort string, market_code string, description string",
    "allotment_header": "resort string, allotment_header_id bigint, description string",
    "name_address": "address_id bigint, country string",
    "reservation_stat_daily": "resort string, resv_name_id bigint, business_date date, room_revenue decimal(18,4), total_room_tax decimal(18,4)",
    "reservation_summary": "resort string, event_id string, considered_date date, net_room_revenue decimal(18,4), room_revenue_tax decimal(18,4)",
    "ar_account": "resort string, account_code string, name_id bigint",
    "ppor_ar": "resort string, account_code string, acc_code string",
    "ppor_name_ar": "name_id bigint, acc_code string",
    "trx_code_arrangement": "resort string, arrangement_id bigint, arrangement_code string",
    "fin_trx_translation": "resort string, arrangement_id bigint, trx_code string, translated_column string, language_code string, description string",
    "pms_terminals": "station_id string, description string",
    "params": "resort string, param string, value string",
    "folio_tax": "bill_no bigint, resort string, resv_name_id bigint, folio_view int, terminal string, total_gross decimal(18,2), cashpay decimal(18,2), ccpay decimal(18,2), deposit decimal(18,2)",
    "name_phone": "name_id bigint, phone_role string, phone_type string, primary_yn string, seq int, phone_number string",
    "name_document": "name_id bigint, kind string, doc_number string",
    "room_category": "resort string, room_category string, label string",
}


#: The facts laid out by resort and month (or year), with the date that it is of.
LAID_OUT = {"financial_transactions": "trx_date", "reservation_daily_element_name": "reservation_date",
            "reservation_daily_elements": "reservation_date", "reservation_stat_daily": "business_date",
            "reservation_summary": "considered_date"}
#: The partition column that a layout adds, and the unit of the date that it holds the first day of.
PERIODS = {"_month": "month", "_year": "year"}


def period_of(df: DataFrame) -> str | None:
    """The partition column of a laid-out table, None for others."""
    return next((p for p in PERIODS if p in df.columns), None)


def period_start(period: str, c) -> Column:
    """The value of the partition column for a date."""
    return F.trunc(F.col(c) if isinstance(c, str) else c, PERIODS[period])


def in_dates(df: DataFrame, date: str, d_from=None, d_to=None) -> DataFrame:
    """The rows with ``date`` from ``d_from`` to ``d_to`` (None: open); of a laid-out table, only the folders of those
    months (years) are read."""
    cond, period = F.lit(True), period_of(df)
    for bound, op in ((d_from, "__ge__"), (d_to, "__le__")):
        if bound is not None:
            day = F.lit(bound).cast("date")
            cond = cond & getattr(F.col(date), op)(day)
            if period:
                cond = cond & getattr(F.col(period), op)(period_start(period, day))
    return df if d_from is None and d_to is None else df.where(cond)


def read_hotel_table(spark: SparkSession, root: str, name: str, raw: bool = False,
                     period: str = "_month") -> DataFrame:
    """A stored table; ``raw``: one that has not been ingested, with '' for NULL and in one folder."""
    if raw:
        return blank_to_null(spark.read.schema(HOTEL_SCHEMAS[name]).parquet(os.path.join(root, name)))
    column = f", {period} date" if name in LAID_OUT else ""
    return spark.read.schema(HOTEL_SCHEMAS[name] + column).parquet(os.path.join(root, name))


class HotelParquet:
    """Same interface as ``sources.hotel.HotelTables`` for stored hotel tables."""

    def __init__(self, spark: SparkSession, root: str, raw: bool = False, period: str = "_month"):
        self.spark, self.root, self.raw, self.period = spark, root, raw, period
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = read_hotel_table(self.spark, self.root, name, self.raw, self.period)
        return self._cache[name]

    def reopened(self) -> "HotelParquet":
        """The same tables with their files listed anew."""
        return HotelParquet(self.spark, self.root, self.raw, self.period)
