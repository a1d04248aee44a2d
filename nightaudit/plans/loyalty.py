"""Q1: loyalty stay statement (one row per checked-out stay and guest).

Reference shape: postings x reservation x profile x code, five per-row
package calls and four departure-day subqueries, then GROUP BY 16 columns +
bill number, then GROUP BY the 16 columns with an ordered bill list.

Plan: classify postings (A4), then pre-aggregate them by (resort, stay,
bill) - SUM is decomposable, NULLs included - *before* any lookup. The
lookups (profile, contacts, departure-day agent/company/group/adults) then
touch one row per stay and bill instead of one per posting, and the two
GROUP BYs of the reference run on that small relation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightaudit.functions.oracle import profile_name
from nightaudit.operators.contacts import with_contacts
from nightaudit.operators.lists import bill_number_list
from nightaudit.operators.lookups import checked, departure_day, lookup_roles, lookup_side
from nightaudit.operators.revenue import revenue_classes

MONEY = "decimal(18,4)"

STAY_KEYS = ["resort", "name_id", "confirmation_no", "title", "last", "first", "id_number", "email",
             "mobilephone", "travel_agent", "company", "group_name", "checkin", "checkout", "nights", "adults"]


def stay_bill_revenue(t) -> DataFrame:
    """Per (resort, original_resv_name_id, bill_no): partial sums of A1's terms."""
    c = revenue_classes(t["financial_transactions"], t["trx_codes"], t["resort_products"])
    puan = F.col("is_anemon_puan") == "Y"
    total = F.col("total_revenue")
    return c.groupBy("resort", "original_resv_name_id", "bill_no").agg(
        F.sum("room_revenue").alias("s_room"),
        F.sum(F.when(puan, total).otherwise(F.lit(0))).alias("s_puan"),
        F.sum("pck_revenue").alias("s_pck"),
        F.sum(F.when(puan, F.lit(0)).otherwise(total)).alias("s_nonpuan"),
        F.sum(total).alias("s_total"))


def departure_names(t, rn: DataFrame | None = None) -> DataFrame:
    """J12g + U6, for all reservations or those of ``rn``: (resort, resv_name_id, travel_agent, company,
    group_name, adults, _dep_n), for ``with_departure``."""
    dep = departure_day(t["reservation_daily_element_name"], t["reservation_daily_elements"],
                        t["reservation_name"] if rn is None else rn)
    display = t["name"].select("name_id", profile_name().alias("display"))
    dep = lookup_roles(dep, display, "name_id", {
        "travel_agent_id": {"display": "travel_agent"}, "company_id": {"display": "company"}, "group_id": {"display": "group_name"}},
        {"travel_agent_id": "agent profile", "company_id": "company profile", "group_id": "group profile"})
    return dep.select("resort", "resv_name_id", *DEPARTURE, "_dep_n")


DEPARTURE = ["travel_agent", "company", "group_name", "adults"]


def with_departure(fact: DataFrame, dep: DataFrame) -> DataFrame:
    """``fact`` with what stands on the night of departure, an error for a stay with several such rows."""
    joined = fact.join(dep, ["resort", "resv_name_id"], "left")
    return checked(joined, "_dep_n", DEPARTURE, "departure day", ["resort", "resv_name_id"])


def loyalty_statement(t) -> DataFrame:
    rn = t["reservation_name"].where(F.col("resv_status") == "CHECKED OUT").select(
        "resort", F.col("resv_name_id").alias("original_resv_name_id"), "name_id", "confirmation_no",
        F.col("trunc_begin_date").alias("checkin"), F.col("trunc_end_date").alias("checkout"),
        F.datediff(F.col("trunc_end_date"), F.col("trunc_begin_date")).alias("nights"))
    prof = t["name"].select("name_id", "title", "last", "first")
    dep = departure_names(t, t["reservation_name"].where(F.col("resv_status") == "CHECKED OUT")).withColumnRenamed("resv_name_id", "original_resv_name_id")
    stay = ["resort", "original_resv_name_id"]
    rows = with_contacts(stay_bill_revenue(t).join(rn, stay).join(lookup_side(prof), "name_id"), t["name_phone"], t["name_document"])
    rows = checked(rows.join(dep, stay, "left"), "_dep_n", DEPARTURE, "departure day", stay)
    # A1: GROUP BY the 16 stay columns + bill_no
    a1 = rows.groupBy(*STAY_KEYS, "bill_no").agg(
        F.sum("s_room").alias("r_room"), F.sum("s_puan").alias("r_puan"), F.sum("s_pck").alias("r_pck"),
        F.sum("s_nonpuan").alias("r_nonpuan"), F.sum("s_total").alias("r_total"))
    a1 = a1.select(
        *STAY_KEYS, "bill_no",
        (F.col("r_room") + F.col("r_puan")).alias("room_revenue"),
        (F.col("r_puan") * -1).alias("anemon_puan"),
        F.col("r_pck").alias("pck_revenue"),
        (F.col("r_nonpuan") - F.col("r_room") - F.col("r_pck")).alias("extra_revenue"),
        F.col("r_total").alias("total_revenue"))
    # A2: GROUP BY the 16 stay columns, ordered bill list
    return a1.groupBy(*STAY_KEYS).agg(
        F.sum("room_revenue").cast(MONEY).alias("room_revenue"),
        F.sum("anemon_puan").cast(MONEY).alias("anemon_puan"),
        F.sum("pck_revenue").cast(MONEY).alias("pck_revenue"),
        (F.sum("room_revenue") + F.sum("pck_revenue")).cast(MONEY).alias("room_pck_revenue"),
        F.sum("extra_revenue").cast(MONEY).alias("extra_revenue"),
        F.sum("total_revenue").cast(MONEY).alias("total_revenue"),
        bill_number_list("bill_no").alias("bill_no"))
