"""Every bill of a batch ends up in the table that its outcome names, all tables in one commit.

* ``accepted`` / ``rejected``: the stored bill row with outcome, rule and message (the row trigger lets the insert pass
  or aborts it);
* ``outbox``: the document of every bill that is sent, as history, and ``outbox_live``: one document per (resort,
  bill_no), the one of the newest batch. A bill that arrives again in a later batch replaces its document; one that is
  rejected then leaves the earlier document standing, as the aborted insert would have;
* ``log``: the lines of each decision, in order.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nightaudit.plans.fiscal import fiscal_documents, fiscal_outcomes
from nightaudit.streaming.batch_store import BatchStore, Keyed, newest_wins

#: The rule of the reference's list that decides each outcome; NULL where none of its rules is named.
RULES = {"PASS_ZERO": None, "PASS_RULE6": 6, "SEND": 2, "PASS_NO_DEVICE": 2, "PASS_NO_CASH": 1, "REJECT_RULE3": 3,
         "REJECT_RULE4": 4, "REJECT_RULE5": 5, "REJECT_TERMINAL": None}
MONEY = "decimal(18,2)"
BILL = f"bill_no bigint, resort string, resv_name_id bigint, folio_view int, total_gross {MONEY}"
ROUTED = f"{BILL}, outcome string, rule int, message string, batch bigint"
DOCUMENT = "resort string, bill_no bigint, url string, document string, batch bigint"
LOG = "bill_no bigint, resort string, resv_name_id bigint, folio_view int, seq int, event string, detail string, batch bigint"


def fiscal_store(spark: SparkSession, root: str, buckets: int = 32) -> BatchStore:
    key = ["resort", "bill_no"]
    return BatchStore(spark, root, {"accepted": ROUTED, "rejected": ROUTED, "outbox": DOCUMENT, "log": LOG},
                      {"outbox_live": Keyed(DOCUMENT, key, newest_wins(key, "batch"), buckets=buckets)})


def with_rule(outcomes: DataFrame) -> DataFrame:
    rule = F.lit(None)
    for outcome, number in RULES.items():
        if number is not None:
            rule = F.when(F.col("outcome") == outcome, number).otherwise(rule)
    return outcomes.withColumn("rule", rule.cast("int"))


def _line(event: str, detail: Column, when: Column) -> Column:
    return F.when(when, F.struct(F.lit(event).alias("event"), detail.alias("detail")))


def log_lines(judged: DataFrame) -> DataFrame:
    """K4: (bill_no, resort, resv_name_id, folio_view, seq, event, detail), what the gate notes on its way to the
    outcome. ``judged``: outcomes with the bill's amounts and terminal."""
    o, total = F.col("outcome"), F.coalesce(F.col("total_gross"), F.lit(0).cast(MONEY)).cast("string")
    bill = F.col("bill_no").cast("string")
    judged_on = ~o.isin("PASS_ZERO", "PASS_RULE6")
    in_full = judged_on & ~o.isin("REJECT_RULE3", "PASS_NO_CASH")
    at_device = in_full & ~o.isin("REJECT_RULE4", "REJECT_RULE5")

    def amount(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(0).cast(MONEY)).cast("string")

    lines = F.array(
        _line("zero_total", bill, o == "PASS_ZERO"), _line("rule6", total, o == "PASS_RULE6"),
        _line("no_rule6_payment", bill, judged_on), _line("paid_in_full", bill, in_full),
        _line("rule4", total, o == "REJECT_RULE4"), _line("rule5", total, o == "REJECT_RULE5"),
        _line("device_lookup", bill, at_device),
        _line("device_address", F.col("url"), o.isin("SEND", "PASS_NO_DEVICE")),
        _line("no_device", F.coalesce(F.col("terminal"), F.lit("no terminal")), o.isin("PASS_NO_DEVICE", "REJECT_TERMINAL")),
        _line("rule3", F.concat(F.lit("cash "), amount("cashpay"), F.lit(" card "), amount("ccpay"), F.lit(" total "), total,
                                F.lit(" deposit "), amount("deposit")), o == "REJECT_RULE3"))
    lines = F.filter(lines, lambda x: x.isNotNull())
    return judged.select("bill_no", "resort", "resv_name_id", "folio_view", F.posexplode(lines).alias("seq", "line")).select(
        "bill_no", "resort", "resv_name_id", "folio_view", (F.col("seq") + 1).alias("seq"), "line.*")


def route_batch(store: BatchStore, batch: int, t, bills: DataFrame, small_batch: bool = False,
                postings: DataFrame | None = None, counts: DataFrame | None = None,
                payments: DataFrame | None = None) -> bool:
    """Judge ``bills`` and commit them as batch ``batch``; False if that batch is committed already. ``counts`` and
    ``payments``: the bills' rule counts and payment rows where they are kept (``fiscal_state``)."""
    if store.committed(batch):
        return False
    no = F.lit(batch).cast("long").alias("batch")
    judged = store.stage(fiscal_outcomes(t, bills, small_batch, postings, counts, with_bill=True),
                           f"log/{batch:020d}-judged-{uuid.uuid4().hex}")
    judged = with_rule(store.spark.read.parquet(judged))
    out = judged.select("bill_no", "resort", "resv_name_id", "folio_view", F.col("total_gross").cast(MONEY).alias("total_gross"),
                        "outcome", "rule", "message", no)
    documents = store.stage(fiscal_documents(t, judged, small_batch, postings, payments), f"outbox/{batch:020d}-documents-{uuid.uuid4().hex}")
    documents = store.spark.read.parquet(documents).select("resort", "bill_no", "url", "document", no)
    return store.commit(batch, {
        "accepted": out.where(~F.col("outcome").startswith("REJECT")),
        "rejected": out.where(F.col("outcome").startswith("REJECT")),
        "outbox": documents, "outbox_live": documents,
        "log": log_lines(judged).select("*", no)})
