"""Hotel tables derived from the TPC-H-like test tables.

The reference queries read some twenty hotel tables (reservations, nightly
stay rows, profiles, postings, exchange rates, bills ...). The test data
offers orders / lineitem / customer / supplier / nation, so the hotel tables
are derived from those by deterministic column expressions.

Each table is a *shape* (which base rows, which explode, which filter) plus
a list of ``(column, sql_expression)`` pairs. The expressions are written in
the SQL subset that Spark and DuckDB evaluate identically (integer ``%``,
``CASE``, ``cast``, ``concat`` of non-NULL parts, ``date + int``, decimal
arithmetic - never double rounding), so the Spark side (``selectExpr``) and
the DuckDB oracle (``nightaudit.oracle.hotel_sql``) build the same rows.

All builders are lazy: nothing is read until an action runs.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nightaudit.operators.lookups import lookup_side, sized_broadcast
from nightaudit.session import ensure_checkpoint_dir
from nightaudit.sources.schemas import HOTEL_SCHEMAS
from nightaudit.sources.testdata import read_table, table_path

AGENT_BASE = 1000000000  # profile ids of travel agents / companies (suppliers)

# ---------------------------------------------------------------------------
# shared expressions
# ---------------------------------------------------------------------------
RESORT_OF_NATION = "concat('R', cast(n_nationkey as string))"
RESORT_OF_CUSTOMER = "concat('R', cast(c_nationkey as string))"
CURRENCY_OF_REGION = "CASE n_regionkey WHEN 3 THEN 'EUR' WHEN 1 THEN 'USD' ELSE 'TRY' END"
STAY_BEGIN = "cast(o_orderdate as date)"
STAY_NIGHTS = "cast(o_orderkey % 4 as int)"

RESORT_COLS = [
    ("resort", RESORT_OF_NATION),
    ("name", "concat('Hotel ', n_name)"),
    ("currency_code", CURRENCY_OF_REGION),
]

# one OPEN date per resort except nation 7, plus a CLOSED previous day everywhere
BUSINESSDATE_COLS = [
    ("resort", RESORT_OF_NATION),
    ("business_date", "CASE WHEN k = 0 THEN date '1998-06-01' + n_nationkey ELSE date '1998-05-31' + n_nationkey END"),
    ("state", "CASE WHEN k = 0 AND n_nationkey <> 7 THEN 'OPEN' ELSE 'CLOSED' END"),
]

RESERVATION_NAME_COLS = [
    ("resort", RESORT_OF_CUSTOMER),
    ("resv_name_id", "o_orderkey"),
    ("name_id", "o_custkey"),
    ("confirmation_no", "o_orderkey + 700000"),
    ("resv_status", "CASE o_orderstatus WHEN 'F' THEN 'CHECKED OUT' WHEN 'P' THEN 'CHECKED IN' "
                    "ELSE CASE WHEN o_orderkey % 3 = 0 THEN 'CANCELLED' ELSE 'RESERVED' END END"),
    ("trunc_begin_date", STAY_BEGIN),
    ("trunc_end_date", f"{STAY_BEGIN} + {STAY_NIGHTS}"),
    ("insert_date", "o_orderdate"),
    ("business_date_created", f"{STAY_BEGIN} - cast(o_orderkey % 30 as int)"),
    ("cancellation_date", "CASE WHEN o_orderstatus = 'O' AND o_orderkey % 3 = 0 THEN o_orderdate END"),
    ("cancellation_reason_code", "CASE WHEN o_orderstatus = 'O' AND o_orderkey % 3 = 0 "
                                 "THEN concat('CX', cast(o_orderkey % 4 as string)) END"),
    ("channel", "o_orderpriority"),
    ("payment_method", "c_mktsegment"),
    ("address_id", "o_custkey"),
    ("event_id", "CASE WHEN o_orderkey % 20 = 0 THEN o_orderkey END"),
    # accompanying guests point at an earlier reservation of the same guest
    ("parent_resv_name_id", "CASE WHEN o_orderkey % 12 = 5 THEN prev1 WHEN o_orderkey % 12 = 6 THEN prev2 END"),
    ("name_usage_type", "CASE WHEN o_orderkey % 12 IN (5, 6) THEN 'AG' END"),
]
PREV_ORDER_1 = "lag(o_orderkey, 1) OVER (PARTITION BY o_custkey ORDER BY o_orderkey)"
PREV_ORDER_2 = "lag(o_orderkey, 2) OVER (PARTITION BY o_custkey ORDER BY o_orderkey)"

NIGHT = f"{STAY_BEGIN} + cast(k as int)"
SLOT_OF_NIGHT = (f"cast((year({NIGHT}) * 10000 + month({NIGHT}) * 100 + day({NIGHT})) * 5 "
                 f"+ c_nationkey % 5 as bigint)")

DAILY_ELEMENT_NAME_COLS = [
    ("resort", RESORT_OF_CUSTOMER),
    ("reservation_date", NIGHT),
    ("resv_daily_el_seq", SLOT_OF_NIGHT),
    ("resv_name_id", "o_orderkey"),
    ("adults", "cast(1 + o_orderkey % 3 as int)"),
    ("children", "cast(CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE o_orderkey % 2 END as int)"),
    ("children1", "cast(CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderkey % 2 END as int)"),
    ("children2", "cast(o_custkey % 2 as int)"),
    ("children3", "cast(CASE WHEN k = 0 THEN 1 ELSE 0 END as int)"),
    ("children4", "cast(o_custkey % 3 as int)"),
    ("children5", "cast(CASE WHEN o_orderkey % 9 = 0 THEN 1 END as int)"),
    ("travel_agent_id", f"CASE WHEN o_orderkey % 5 <> 0 THEN {AGENT_BASE} + (o_orderkey * 7 + k) % 120 END"),
    ("company_id", f"CASE WHEN o_orderkey % 3 = 0 THEN {AGENT_BASE} + 50 + o_orderkey % 50 END"),
    ("group_id", f"CASE WHEN o_orderkey % 7 = 0 THEN {AGENT_BASE} + o_orderkey % 30 END"),
    ("currency_code", "CASE WHEN o_orderkey % 60 = 3 THEN NULL ELSE CASE o_orderkey % 6 "
                      "WHEN 0 THEN 'EUR' WHEN 1 THEN 'USD' WHEN 2 THEN 'GBP' ELSE 'TRY' END END"),
    ("share_amount", "cast(cast(o_totalprice as decimal(18,2)) as decimal(18,4))"),
    ("share_priority", "cast(CASE WHEN o_orderkey % 4 = 1 THEN NULL ELSE o_orderkey % 3 END as int)"),
    ("rate_code", "concat('RC', cast(o_orderkey % 9 as string))"),
]

SEQ = "resv_daily_el_seq"
DAILY_ELEMENTS_COLS = [
    ("resort", "resort"),
    ("reservation_date", "reservation_date"),
    ("resv_daily_el_seq", SEQ),
    ("room", f"concat('RM', cast({SEQ} % 997 as string))"),
    ("room_category", f"CASE WHEN {SEQ} % 11 = 0 THEN '-1' WHEN {SEQ} % 13 = 0 THEN NULL "
                      f"ELSE concat('C', cast({SEQ} % 4 as string)) END"),
    ("booked_room_category", f"concat('C', cast(({SEQ} + 1) % 4 as string))"),
    ("quantity", f"cast(1 + {SEQ} % 2 as int)"),
    ("origin_of_booking", f"CASE {SEQ} % 3 WHEN 0 THEN 'WEB' WHEN 1 THEN 'GDS' END"),
    ("allotment_header_id", f"CASE WHEN {SEQ} % 5 = 0 THEN {SEQ} % 40 END"),
    ("market_code", f"concat('M', cast({SEQ} % 6 as string))"),
]

GUEST_NAME_COLS = [
    ("name_id", "c_custkey"),
    ("last", "CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE c_name END"),
    ("first", "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE concat('Guest', cast(c_custkey % 50 as string)) END"),
    ("title", "CASE c_custkey % 3 WHEN 0 THEN 'MR' WHEN 1 THEN 'MRS' END"),
    ("company", "CASE WHEN c_custkey % 23 = 0 THEN concat('Company & Sons ', cast(c_custkey as string)) END"),
    ("nationality", "concat('N', cast(c_nationkey as string))"),
]
GUEST_NAME_WHERE = "c_custkey % 50 <> 7"  # some guests have no profile
AGENT_NAME_COLS = [
    ("name_id", f"{AGENT_BASE} + s_suppkey"),
    ("last", "cast(NULL as string)"),
    ("first", "cast(NULL as string)"),
    ("title", "cast(NULL as string)"),
    ("company", "s_name"),
    ("nationality", "cast(NULL as string)"),
]

SIGN = "CASE WHEN l_returnflag = 'R' AND l_partkey % 3 = 0 THEN -1 ELSE 1 END"
NET = f"cast({SIGN} * cast(l_extendedprice as decimal(18,2)) as decimal(18,4))"
GROSS = (f"cast({SIGN} * round(cast(l_extendedprice as decimal(18,2)) "
         f"* (1 + cast(l_tax as decimal(4,2))), 2) as decimal(18,4))")
POSTING_ORDER = ("row_number() OVER (PARTITION BY l_orderkey "
                 "ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate)")

CHARGE_COLS = [
    ("trx_no", "l_orderkey * 1000 + 10 * pos"),
    ("resort", RESORT_OF_CUSTOMER),
    ("trx_date", f"{STAY_BEGIN} + cast(l_linenumber % 4 as int)"),
    ("trx_code", "cast(1000 + l_partkey % 40 as string)"),
    ("resv_name_id", "l_orderkey"),
    ("original_resv_name_id", "CASE WHEN l_orderkey % 10 = 0 THEN NULL ELSE l_orderkey END"),
    ("name_id", "o_custkey"),
    ("net_amount", NET),
    ("gross_amount", GROSS),
    ("guest_account_credit", "cast(NULL as decimal(18,4))"),
    ("guest_account_debit", GROSS),
    ("tax_inclusive_yn", "CASE l_suppkey % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' END"),
    ("trx_no_added_by", "cast(NULL as bigint)"),
    ("trx_no_against_package", "CASE WHEN l_partkey % 5 = 1 THEN l_orderkey * 1000 END"),
    ("ft_subtype", "'C'"),
    ("display_yn", "CASE l_partkey % 17 WHEN 3 THEN 'N' WHEN 4 THEN NULL ELSE 'Y' END"),
    ("invoice_type", "CASE l_partkey % 19 WHEN 2 THEN 'CR' WHEN 3 THEN 'INV' END"),
    ("product", "CASE WHEN l_partkey % 5 IN (1, 2) THEN concat('P', cast(l_partkey % 8 as string)) END"),
    ("bill_no", "CASE WHEN l_linenumber % 5 = 0 THEN NULL ELSE l_orderkey * 10 + l_linenumber % 2 END"),
    ("folio_view", "cast(l_linenumber % 2 as int)"),
    ("arrangement_id", "CASE WHEN l_partkey % 6 = 0 THEN l_partkey % 12 END"),
]

# generated tax postings: children of tax-exclusive charges
TAX_CHILD_WHERE = "tax_inclusive_yn = 'N' AND trx_no % 7 <> 0"
CHILD_NET = "cast(round(net_amount * 0.1, 2) as decimal(18,4))"
TAX_CHILD_COLS = [
    ("trx_no", "trx_no + 1"),
    ("resort", "resort"),
    ("trx_date", "trx_date"),
    ("trx_code", "CASE WHEN trx_no % 7 = 1 THEN '1001' ELSE '9000' END"),
    ("resv_name_id", "resv_name_id"),
    ("original_resv_name_id", "original_resv_name_id"),
    ("name_id", "name_id"),
    ("net_amount", CHILD_NET),
    ("gross_amount", CHILD_NET),
    ("guest_account_credit", "cast(NULL as decimal(18,4))"),
    ("guest_account_debit", CHILD_NET),
    ("tax_inclusive_yn", "'Y'"),
    ("trx_no_added_by", "trx_no"),
    ("trx_no_against_package", "cast(NULL as bigint)"),
    ("ft_subtype", "'C'"),
    ("display_yn", "'Y'"),
    ("invoice_type", "cast(NULL as string)"),
    ("product", "cast(NULL as string)"),
    ("bill_no", "bill_no"),
    ("folio_view", "folio_view"),
    ("arrangement_id", "cast(NULL as bigint)"),
]

PAY_KEY = "(o_orderkey + f)"
PAYMENT_COLS = [
    ("trx_no", "o_orderkey * 1000 + 500 + f"),
    ("resort", RESORT_OF_CUSTOMER),
    ("trx_date", f"{STAY_BEGIN} + {STAY_NIGHTS}"),
    ("trx_code", f"CASE WHEN {PAY_KEY} % 9 = 0 THEN '8002' WHEN {PAY_KEY} % 9 = 4 THEN '8003' "
                 f"WHEN {PAY_KEY} % 2 = 0 THEN '8000' ELSE '8001' END"),
    ("resv_name_id", "o_orderkey"),
    ("original_resv_name_id", "o_orderkey"),
    ("name_id", "o_custkey"),
    ("net_amount", "cast(NULL as decimal(18,4))"),
    ("gross_amount", "cast(NULL as decimal(18,4))"),
    ("guest_account_credit", f"CASE WHEN {PAY_KEY} % 13 = 0 THEN NULL WHEN f = 0 "
                             f"THEN cast(cast(o_totalprice as decimal(18,2)) as decimal(18,4)) "
                             f"ELSE cast(cast(floor(o_totalprice) as bigint) % 1000 as decimal(18,4)) END"),
    ("guest_account_debit", f"CASE WHEN {PAY_KEY} % 13 IN (0, 1) THEN cast(25 as decimal(18,4)) END"),
    ("tax_inclusive_yn", "cast(NULL as string)"),
    ("trx_no_added_by", "cast(NULL as bigint)"),
    ("trx_no_against_package", "cast(NULL as bigint)"),
    ("ft_subtype", f"CASE WHEN {PAY_KEY} % 9 = 4 AND {PAY_KEY} % 2 = 0 THEN 'D' ELSE 'FC' END"),
    ("display_yn", "'Y'"),
    ("invoice_type", "cast(NULL as string)"),
    ("product", "cast(NULL as string)"),
    ("bill_no", f"CASE WHEN {PAY_KEY} % 4 = 0 THEN NULL ELSE o_orderkey * 10 + f END"),
    ("folio_view", "cast(f as int)"),
    ("arrangement_id", "cast(NULL as bigint)"),
]

# codes 1000..1039 are charges; 9000 tax; 8000 cash, 8001 card, 8002 city ledger, 8003 deposit
TRX_CODES_COLS = [
    ("resort", RESORT_OF_NATION),
    ("trx_code", "CASE WHEN k < 40 THEN cast(1000 + k as string) WHEN k = 40 THEN '9000' "
                 "ELSE cast(8000 + k - 41 as string) END"),
    ("trx_code_type", "CASE WHEN k IN (39, 40) THEN 'X' WHEN k > 40 THEN 'P' WHEN k % 10 = 7 THEN NULL "
                      "WHEN k % 4 = 0 THEN 'L' ELSE 'E' END"),
    ("description", "CASE k WHEN 40 THEN 'VAT 18' WHEN 41 THEN 'Cash' WHEN 42 THEN 'Credit Card' "
                    "WHEN 43 THEN 'City Ledger' WHEN 44 THEN 'Deposit Transfer' "
                    "ELSE concat('Item ', cast(k as string), CASE WHEN k % 3 = 0 THEN ' & Co' ELSE ' <svc>' END) END"),
    ("cc_type", "CASE WHEN k = 42 THEN 'VA' END"),
    ("ind_billing", "CASE WHEN k = 43 THEN 'N' ELSE 'Y' END"),
]

RESORT_PRODUCTS_COLS = [
    ("resort", RESORT_OF_NATION),
    ("product", "concat('P', cast(k as string))"),
    ("pkg_forcast_group", "CASE WHEN k % 3 = 0 THEN NULL ELSE concat('PKG', cast(k as string)) END"),
]
RESORT_PRODUCTS_WHERE = "NOT (k = 7 AND n_nationkey % 2 = 1)"

FX_RESORT_CURRENCY = "CASE n_regionkey WHEN 3 THEN 'EUR' WHEN 1 THEN 'USD' ELSE 'TRY' END"
FX_COLS = [
    ("resort", RESORT_OF_CUSTOMER),
    ("base_curr_code", f"CASE WHEN l_suppkey % 4 = 3 THEN 'USD' ELSE {FX_RESORT_CURRENCY} END"),
    ("currency_code", "CASE l_partkey % 4 WHEN 0 THEN 'EUR' WHEN 1 THEN 'USD' WHEN 2 THEN 'GBP' ELSE 'TRY' END"),
    ("exchange_rate_type", "CASE l_linenumber % 3 WHEN 0 THEN 'POST' WHEN 1 THEN 'CURR' ELSE 'OTHER' END"),
    ("begin_date", "cast(l_shipdate as date)"),
    ("exchange_rate", "CASE WHEN l_partkey % 50 = 0 THEN NULL WHEN l_partkey % 50 = 1 THEN cast(0 as decimal(18,8)) "
                      "ELSE cast(cast(l_quantity as decimal(18,2)) + cast(l_discount as decimal(18,2)) "
                      "as decimal(18,8)) END"),
]
# nation 9 has no rates after 1995: a gap far longer than the 300-day tolerance
FX_WHERE = "NOT (c_nationkey = 9 AND l_shipdate >= timestamp '1996-01-01 00:00:00')"

RATE_HEADER_COLS = [
    ("resort", RESORT_OF_NATION),
    ("rate_code", "concat('RC', cast(k as string))"),
    ("complimentary_yn", "CASE WHEN k % 4 = 0 THEN 'Y' ELSE 'N' END"),
    ("house_use_yn", "CASE WHEN k = 3 THEN 'Y' ELSE 'N' END"),
]
RATE_HEADER_WHERE = "NOT (k = 8 AND n_nationkey % 2 = 0)"

MARKETS_COLS = [
    ("resort", RESORT_OF_NATION),
    ("market_code", "concat('M', cast(k as string))"),
    ("description", "concat('Market ', cast(k as string))"),
]
MARKETS_WHERE = "NOT (k = 5 AND n_nationkey % 3 = 0)"

ALLOTMENT_COLS = [
    ("resort", RESORT_OF_NATION),
    ("allotment_header_id", "cast(k as bigint)"),
    ("description", "concat('Block ', cast(k as string))"),
]
ALLOTMENT_WHERE = "k % 2 = 0"

NAME_ADDRESS_COLS = [
    ("address_id", "c_custkey"),
    ("country", "concat('C', cast(c_nationkey as string))"),
]
NAME_ADDRESS_WHERE = "c_custkey % 17 <> 0"

TOTALPRICE = "cast(o_totalprice as decimal(18,2))"
STAT_DAILY_COLS = [
    ("resort", RESORT_OF_CUSTOMER),
    ("resv_name_id", "o_orderkey"),
    ("business_date", NIGHT),
    ("room_revenue", f"cast({TOTALPRICE} * 0.01 as decimal(18,4))"),
    ("total_room_tax", f"cast({TOTALPRICE} * 0.0008 as decimal(18,4))"),
]
STAT_DAILY_WHERE = "o_orderkey % 2 = 0"

SUMMARY_COLS = [
    ("resort", RESORT_OF_CUSTOMER),
    ("event_id", "CASE WHEN o_orderkey % 97 = 1 THEN concat('X', cast(o_orderkey as string)) "
                 "ELSE cast(o_orderkey as string) END"),
    ("considered_date", NIGHT),
    ("net_room_revenue", f"cast({TOTALPRICE} * 0.009 as decimal(18,4))"),
    ("room_revenue_tax", f"cast({TOTALPRICE} * 0.0007 as decimal(18,4))"),
]
SUMMARY_WHERE = "o_orderkey % 3 <> 0"

# j = 0: home-resort account; j = 1: second account in the next resort
AR_ACCOUNT_COLS = [
    ("resort", "concat('R', cast((s_nationkey + j) % 25 as string))"),
    ("account_code", "concat(CASE WHEN j = 0 THEN 'A' ELSE 'B' END, cast(s_suppkey as string))"),
    ("name_id", f"{AGENT_BASE} + s_suppkey"),
]
AR_WHERE = "j = 0 OR s_suppkey % 4 = 0"
PPOR_AR_COLS = [
    ("resort", "concat('R', cast((s_nationkey + j) % 25 as string))"),
    ("account_code", "concat(CASE WHEN j = 0 THEN 'A' ELSE 'B' END, cast(s_suppkey as string))"),
    ("acc_code", "CASE WHEN j = 0 AND s_suppkey % 5 = 0 THEN NULL WHEN j = 0 "
                 "THEN concat('120.', cast(s_suppkey as string)) ELSE concat('121.', cast(s_suppkey as string)) END"),
]
PPOR_NAME_AR_COLS = [
    ("name_id", f"{AGENT_BASE} + s_suppkey"),
    ("acc_code", "concat('320.', cast(s_suppkey as string))"),
]
PPOR_NAME_AR_WHERE = "s_suppkey % 3 <> 0"

ARRANGEMENT_COLS = [
    ("resort", RESORT_OF_NATION),
    ("arrangement_id", "cast(k as bigint)"),
    ("arrangement_code", "concat('ARR', cast(k as string))"),
]
ARRANGEMENT_WHERE = "k < 11"

TRANSLATION_COLS = [
    ("resort", RESORT_OF_NATION),
    ("arrangement_id", "CASE WHEN k < 6 THEN cast(k as bigint) END"),
    ("trx_code", "CASE k WHEN 6 THEN '8000' WHEN 7 THEN '8001' END"),
    ("translated_column", "CASE WHEN k < 6 THEN 'Arrangement_desc' ELSE 'DESCRIPTION' END"),
    ("language_code", "CASE WHEN k = 5 THEN 'EN' ELSE 'MK' END"),
    ("description", "CASE k WHEN 6 THEN 'Gotovina' WHEN 7 THEN 'Kartichka' "
                    "ELSE concat('Aranzman ', cast(k as string)) END"),
]

TERMINAL_COLS = [
    ("station_id", "concat('T', cast(n_nationkey as string))"),
    ("description", "CASE n_nationkey % 6 "
                    "WHEN 0 THEN concat(' http://fiscal', cast(n_nationkey as string), ':7479/api/ ') "
                    "WHEN 1 THEN concat('Http://dev', cast(n_nationkey as string)) "
                    "WHEN 2 THEN NULL WHEN 3 THEN 'LOCAL' "
                    "WHEN 4 THEN concat('printer ', cast(n_nationkey as string)) "
                    "ELSE concat('HTTPS://box', cast(n_nationkey as string)) END"),
]
TERMINAL_WHERE = "n_nationkey < 12"  # T12 is referenced by bills but not defined

PARAMS_COLS = [
    ("resort", RESORT_OF_NATION),
    ("param", "'DEPOSIT_LED_TRX_CODE'"),
    ("value", "'8003'"),
]
PARAMS_WHERE = "n_nationkey <> 3"

BILL_KEY = "(o_orderkey + f)"
BILL_BASE = "cast(floor(o_totalprice) as decimal(18,2))"
FOLIO_TAX_STAGE1 = [
    ("bill_no", "o_orderkey * 10 + f"),
    ("resort", RESORT_OF_CUSTOMER),
    ("resv_name_id", "o_orderkey"),
    ("folio_view", "cast(f as int)"),
    ("terminal", f"CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE concat('T', cast({BILL_KEY} % 13 as string)) END"),
    ("total_gross", f"cast(CASE {BILL_KEY} % 17 WHEN 0 THEN NULL WHEN 1 THEN 0 WHEN 2 THEN {BILL_BASE} + 0.35 "
                    f"WHEN 3 THEN -{BILL_BASE} WHEN 4 THEN -{BILL_BASE} ELSE {BILL_BASE} END as decimal(18,2))"),
    ("mix", f"{BILL_KEY} % 11"),
    ("deposit", f"CASE WHEN {BILL_KEY} % 5 = 0 THEN cast(0 as decimal(18,2)) END"),
]
FOLIO_TAX_COLS = [
    ("bill_no", "bill_no"),
    ("resort", "resort"),
    ("resv_name_id", "resv_name_id"),
    ("folio_view", "folio_view"),
    ("terminal", "terminal"),
    ("total_gross", "total_gross"),
    ("cashpay", "cast(CASE mix WHEN 0 THEN NULL WHEN 1 THEN 0 WHEN 2 THEN total_gross - 10 "
                "WHEN 6 THEN total_gross - 7 WHEN 7 THEN total_gross - 7 WHEN 8 THEN NULL WHEN 9 THEN 10 "
                "ELSE total_gross END as decimal(18,2))"),
    ("ccpay", "cast(CASE mix WHEN 1 THEN 0 WHEN 6 THEN 7 WHEN 7 THEN 7 WHEN 8 THEN total_gross "
              "WHEN 10 THEN 0 END as decimal(18,2))"),
    ("deposit", "deposit"),
]

PHONE_WHERE = "(j = 0 AND c_custkey % 4 <> 0) OR (j = 1 AND c_custkey % 3 = 0) " \
              "OR (j = 2 AND c_custkey % 2 = 0) OR (j = 3 AND c_custkey % 9 = 0)"
NAME_PHONE_COLS = [
    ("name_id", "c_custkey"),
    ("phone_role", "CASE j WHEN 0 THEN 'EMAIL' ELSE 'PHONE' END"),
    ("phone_type", "CASE j WHEN 0 THEN 'EMAIL' WHEN 2 THEN 'PHONE' ELSE 'MOBILE' END"),
    ("primary_yn", "CASE WHEN j IN (2, 3) THEN 'Y' ELSE 'N' END"),
    ("seq", "cast(j + 1 as int)"),
    ("phone_number", "CASE j WHEN 0 THEN concat('guest', cast(c_custkey as string), '@mail.test') "
                     "WHEN 2 THEN concat('+90 212 ', cast(c_custkey as string)) "
                     "ELSE concat('+90 5', cast(j as string), ' ', cast(c_custkey as string)) END"),
]

DOCUMENT_WHERE = "(j = 0 AND c_custkey % 3 = 0) OR (j = 1 AND c_custkey % 2 = 0)"
NAME_DOCUMENT_COLS = [
    ("name_id", "c_custkey"),
    ("kind", "CASE j WHEN 0 THEN 'TCKN' ELSE 'PASSPORT' END"),
    ("doc_number", "CASE j WHEN 0 THEN concat('1000', cast(c_custkey as string)) "
                   "ELSE concat('P', cast(c_custkey as string)) END"),
]

ROOM_CATEGORY_COLS = [
    ("resort", RESORT_OF_NATION),
    ("room_category", "CASE WHEN k = 4 THEN '-1' ELSE concat('C', cast(k as string)) END"),
    ("label", "CASE WHEN k = 4 THEN 'Pseudo room' ELSE concat('Room type ', cast(k as string)) END"),
]
ROOM_CATEGORY_WHERE = "NOT (k = 3 AND n_nationkey % 4 = 0)"

# explode ranges (inclusive upper bound) used by the small dimensions built from nation
NATION_FANOUT = {
    "businessdate": 1,
    "trx_codes": 44,
    "resort_products": 7,
    "rate_header": 8,
    "resort_markets": 5,
    "allotment_header": 39,
    "trx_code_arrangement": 10,
    "fin_trx_translation": 7,
    "room_category": 4,
}


# ---------------------------------------------------------------------------
# Spark builders
# ---------------------------------------------------------------------------
def _sel(df: DataFrame, cols: list[tuple[str, str]]) -> DataFrame:
    return df.selectExpr(*[f"{expr} AS {name}" for name, expr in cols])


def _fanout(df: DataFrame, name: str, upto) -> DataFrame:
    """One row per input row and per value 0..upto (no join, just an explode)."""
    upto_col = upto if not isinstance(upto, int) else F.lit(upto)
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), upto_col)))


# storage format version of the materialized tables (part of the derivation key)
STORAGE_LAYOUT = 3

# storage layout when materialized, of tables that are shuffled as they are stored
FACT_LAYOUT = {
    "reservation_daily_elements": ["resort", "reservation_date"],
    "name": ["name_id"],
    "name_phone": ["name_id"],
}
# tables with several rows an order: its narrow row is laid out before they are made, and moves instead of them
ORDER_LAYOUT = {
    "reservation_daily_element_name": ["c_nationkey", "o_orderdate"],
    "reservation_stat_daily": ["c_nationkey", "o_orderdate"],
    "reservation_summary": ["c_nationkey", "o_orderdate"],
    "folio_tax": ["c_nationkey", "o_orderkey"],
}


def _derivation_key(sf_dir: str) -> str:
    """Identifies one derivation: the input files and every expression above."""
    h = hashlib.sha1()
    for name in ["nation", "customer", "supplier", "orders", "lineitem"]:
        p = table_path(sf_dir, name)
        st = os.stat(p) if os.path.exists(p) else None
        h.update(f"{os.path.abspath(p)}:{st.st_size if st else ''}:{st.st_mtime_ns if st else ''}".encode())
    for value in sorted((k, repr(v)) for k, v in globals().items() if k.isupper()):
        h.update(repr(value).encode())
    return h.hexdigest()[:16]


class HotelTables:
    """Lazy dict of the derived hotel tables for one test-data directory.

    With ``materialize`` (the default) each table is derived once, written as
    parquet under ``<spark.checkpoint.dir>/nightaudit-hotel/<key>/<table>``
    (the shared folder the cluster names) and read back from there: queries
    then scan stored hotel tables, as they would in production, instead of
    re-deriving them from the TPC-H tables at every reference. The key covers
    the input files and the derivation expressions, so a change re-derives.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, materialize: bool = True):
        self.spark = spark
        self.sf_dir = sf_dir
        self.materialize = materialize
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            builder: Callable[[], DataFrame] = getattr(self, f"_build_{name}")
            self._cache[name] = self._stored(name, builder) if self.materialize else builder()
        return self._cache[name]

    def _stored(self, name: str, builder: Callable[[], DataFrame]) -> DataFrame:
        base = os.path.join(ensure_checkpoint_dir(self.spark), "nightaudit-hotel", _derivation_key(self.sf_dir),
                            name)
        done = self._complete_copy(base)
        if done is None:
            # each writer writes its own copy, so concurrent runs never clobber each other
            df = builder()
            keys = FACT_LAYOUT.get(name)
            if keys:
                df = self._laid_out(df, keys)
            copy = uuid.uuid4().hex
            df.write.option("compression", "zstd").parquet(os.path.join(base, copy))
            # completion marker, written only after the copy's write has committed
            (self.spark.createDataFrame([(copy,)], "copy string").coalesce(1)
             .write.json(os.path.join(base, f"done-{copy}")))
            done = self._complete_copy(base)
        return self.spark.read.parquet(done)

    def _laid_out(self, df: DataFrame, keys: list[str]) -> DataFrame:
        """Range-partitioned and sorted: many files for parallel scans, and row-group min/max stats that prune filters."""
        n = int(self.spark.conf.get("nightaudit.materialize.partitions", "0")) \
            or 2 * self.spark.sparkContext.defaultParallelism
        return df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)

    def _complete_copy(self, base: str) -> str | None:
        """The first complete copy (smallest id among those with a marker)."""
        try:
            marks = self.spark.read.schema("copy string").json(os.path.join(base, "done-*")).collect()
        except AnalysisException:
            return None
        return os.path.join(base, min(r.copy for r in marks)) if marks else None

    def _src(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    def _orders_customers(self, side: Callable[[DataFrame], DataFrame] = sized_broadcast) -> DataFrame:
        o = self._src("orders")
        c = side(self._src("customer").select("c_custkey", "c_nationkey", "c_mktsegment"))
        return o.join(c, o.o_custkey == c.c_custkey)

    def _orders_of(self, table: str) -> DataFrame:
        oc = self._orders_customers()
        return self._laid_out(oc, ORDER_LAYOUT[table]) if self.materialize else oc

    def _nation_fanout(self, table: str) -> DataFrame:
        return _fanout(self._src("nation"), "k", NATION_FANOUT[table])

    def _build_resort(self):
        return _sel(self._src("nation"), RESORT_COLS)

    def _build_businessdate(self):
        return _sel(self._nation_fanout("businessdate"), BUSINESSDATE_COLS)

    def _build_reservation_name(self):
        # a guest's orders meet for their sequence anyway: many customers are merged there and not broadcast
        oc = self._orders_customers(lookup_side).selectExpr("*", f"{PREV_ORDER_1} AS prev1", f"{PREV_ORDER_2} AS prev2")
        return _sel(oc, RESERVATION_NAME_COLS)

    def _nights(self, table: str) -> DataFrame:
        return _fanout(self._orders_of(table), "k", F.expr(STAY_NIGHTS))

    def _build_reservation_daily_element_name(self):
        return _sel(self._nights("reservation_daily_element_name"), DAILY_ELEMENT_NAME_COLS)

    def _build_reservation_daily_elements(self):
        slots = self["reservation_daily_element_name"].select(
            "resort", "reservation_date", "resv_daily_el_seq").distinct()
        return _sel(slots, DAILY_ELEMENTS_COLS)

    def _build_name(self):
        guests = _sel(self._src("customer").where(GUEST_NAME_WHERE), GUEST_NAME_COLS)
        agents = _sel(self._src("supplier"), AGENT_NAME_COLS)
        return guests.unionByName(agents)

    def _charges(self) -> DataFrame:
        li = self._src("lineitem")
        base = li.join(self._orders_customers(), li.l_orderkey == F.col("o_orderkey"))
        return _sel(base.selectExpr("*", f"{POSTING_ORDER} AS pos"), CHARGE_COLS)

    def _build_financial_transactions(self):
        # a charge and its child come from one row, so the line items are joined once
        types = {f.name: f.dataType for f in T._parse_datatype_string(HOTEL_SCHEMAS["financial_transactions"]).fields}

        def posting(cols):
            return F.struct(*[F.expr(e).cast(types[name]).alias(name) for name, e in cols])
        both = F.array(posting([(name, name) for name, _ in CHARGE_COLS]),
                       F.when(F.expr(TAX_CHILD_WHERE), posting(TAX_CHILD_COLS)))
        charges = self._charges().select(F.explode(both).alias("p")).where(F.col("p").isNotNull()).select("p.*")
        payments = _sel(_fanout(self._orders_customers(), "f", 1), PAYMENT_COLS)
        return charges.unionByName(payments)

    def _build_trx_codes(self):
        return _sel(self._nation_fanout("trx_codes"), TRX_CODES_COLS)

    def _build_resort_products(self):
        return _sel(self._nation_fanout("resort_products").where(RESORT_PRODUCTS_WHERE), RESORT_PRODUCTS_COLS)

    def _build_currency_exchange_rates(self):
        li = self._src("lineitem")
        oc = self._orders_customers()
        n = self._src("nation")
        base = (li.join(oc, li.l_orderkey == F.col("o_orderkey"))
                .join(n, F.col("c_nationkey") == n.n_nationkey))
        return _sel(base.where(FX_WHERE), FX_COLS)

    def _build_rate_header(self):
        return _sel(self._nation_fanout("rate_header").where(RATE_HEADER_WHERE), RATE_HEADER_COLS)

    def _build_resort_markets(self):
        return _sel(self._nation_fanout("resort_markets").where(MARKETS_WHERE), MARKETS_COLS)

    def _build_allotment_header(self):
        return _sel(self._nation_fanout("allotment_header").where(ALLOTMENT_WHERE), ALLOTMENT_COLS)

    def _build_name_address(self):
        return _sel(self._src("customer").where(NAME_ADDRESS_WHERE), NAME_ADDRESS_COLS)

    def _build_reservation_stat_daily(self):
        return _sel(self._nights("reservation_stat_daily").where(STAT_DAILY_WHERE), STAT_DAILY_COLS)

    def _build_reservation_summary(self):
        return _sel(self._nights("reservation_summary").where(SUMMARY_WHERE), SUMMARY_COLS)

    def _suppliers_fanout(self) -> DataFrame:
        return _fanout(self._src("supplier"), "j", 1).where(AR_WHERE)

    def _build_ar_account(self):
        return _sel(self._suppliers_fanout(), AR_ACCOUNT_COLS)

    def _build_ppor_ar(self):
        return _sel(self._suppliers_fanout(), PPOR_AR_COLS)

    def _build_ppor_name_ar(self):
        return _sel(self._src("supplier").where(PPOR_NAME_AR_WHERE), PPOR_NAME_AR_COLS)

    def _build_trx_code_arrangement(self):
        return _sel(self._nation_fanout("trx_code_arrangement").where(ARRANGEMENT_WHERE), ARRANGEMENT_COLS)

    def _build_fin_trx_translation(self):
        return _sel(self._nation_fanout("fin_trx_translation"), TRANSLATION_COLS)

    def _build_pms_terminals(self):
        return _sel(self._src("nation").where(TERMINAL_WHERE), TERMINAL_COLS)

    def _build_params(self):
        return _sel(self._src("nation").where(PARAMS_WHERE), PARAMS_COLS)

    def _build_folio_tax(self):
        stage1 = _sel(_fanout(self._orders_of("folio_tax"), "f", 1), FOLIO_TAX_STAGE1)
        return _sel(stage1, FOLIO_TAX_COLS)

    def _build_name_phone(self):
        return _sel(_fanout(self._src("customer"), "j", 3).where(PHONE_WHERE), NAME_PHONE_COLS)

    def _build_name_document(self):
        return _sel(_fanout(self._src("customer"), "j", 1).where(DOCUMENT_WHERE), NAME_DOCUMENT_COLS)

    def _build_room_category(self):
        return _sel(self._nation_fanout("room_category").where(ROOM_CATEGORY_WHERE), ROOM_CATEGORY_COLS)


TABLE_NAMES = [
    "resort", "businessdate", "reservation_name", "reservation_daily_element_name",
    "reservation_daily_elements", "name", "financial_transactions", "trx_codes", "resort_products",
    "currency_exchange_rates", "rate_header", "resort_markets", "allotment_header", "name_address",
    "reservation_stat_daily", "reservation_summary", "ar_account", "ppor_ar", "ppor_name_ar",
    "trx_code_arrangement", "fin_trx_translation", "pms_terminals", "params", "folio_tax",
    "name_phone", "name_document", "room_category",
]


def hotel_tables(spark: SparkSession, sf_dir: str, materialize: bool = True) -> HotelTables:
    return HotelTables(spark, sf_dir, materialize)
