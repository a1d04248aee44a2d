"""What the gate asks of a folio's postings, kept between batches.

The trigger reads all postings of a bill's folio at every insert. Here two keyed tables hold what it asks: ``folio_counts``
(the two rule counts) and ``folio_payments`` (payments by code), by folio and bill number, NULL for postings that carry
none. A batch of posting changes is a table of postings with ``sign``: 1 for a posting that is stored, -1 for one that is
taken back; a corrected posting is both. Its signed sums are added to the rows of its own folios, and nothing else is read
or written; a batch that was committed before changes nothing. A bill then reads the buckets of its folio.

Codes and parameters count as they stand when a posting arrives, as the code's attributes belong to the posting's day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nightaudit.plans.fiscal import FOLIO, PAYMENT, _With, counted_rows, payment_rows, per_bill, posting_rows
from nightaudit.streaming.batch_store import BatchStore, Keyed, added_up

FOLIO_SCHEMA = "resort string, resv_name_id bigint, folio_view int, bill_no bigint"
COUNTS = f"{FOLIO_SCHEMA}, m bigint, p bigint"
PAYMENTS = f"{FOLIO_SCHEMA}, trx_code string, pay_name string, card string, payment decimal(28,4)"


def folio_store(spark: SparkSession, root: str, buckets: int = 32) -> BatchStore:
    key = [*FOLIO, "bill_no"]
    return BatchStore(spark, root, {}, {
        "folio_counts": Keyed(COUNTS, key, added_up(key, ["m", "p"]), FOLIO, buckets),
        "folio_payments": Keyed(PAYMENTS, [*key, *PAYMENT], added_up([*key, *PAYMENT], ["payment"]), FOLIO, buckets)})


def apply_postings(store: BatchStore, batch: int, t, changes: DataFrame) -> bool:
    """Add ``changes`` (postings with ``sign``) as batch ``batch``; False if it was committed before."""
    if store.committed(batch):
        return False
    rows = posting_rows(_With(t, changes), more=["sign"])
    # one row a posting: the store adds them up where they meet the stored sums, so they move once
    counts = counted_rows(rows, "sign").select(*FOLIO, "bill_no", *[(F.col(c) * F.col("sign")).alias(c) for c in ("m", "p")])
    payments = payment_rows(t, rows, "sign").select(*FOLIO, "bill_no", *PAYMENT, (F.col("payment") * F.col("sign")).alias("payment"))
    return store.commit(batch, {"folio_counts": counts, "folio_payments": payments})


def kept_counts(store: BatchStore, bills: DataFrame) -> DataFrame:
    """The rule counts of ``bills``, as ``fiscal.rule_counts`` computes them from the postings. Reads the bills' buckets."""
    return per_bill(bills, store.read("folio_counts", bills), [], {"mpay_count": "m", "ppost_count": "p"})


def kept_payments(store: BatchStore, bills: DataFrame) -> DataFrame:
    """FOLIO, bill_no, payment group and payment rows of the bills' folios, for ``fiscal.fiscal_payments(rows=...)``."""
    return store.read("folio_payments", bills)
