"""Documents: the postings of the bills that are sent are read and moved once, and those of other folios mostly stay."""

from pyspark.sql import functions as F

from nightaudit.operators import lookups
from nightaudit.operators.lookups import BROADCAST_CONF, marked
from nightaudit.plans import fiscal
from nightaudit.sources.hotel import hotel_tables
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_marks_keep_all_that_are_asked_for(spark):  # F2, F5
    rows = spark.range(20_000).selectExpr("CASE WHEN id % 500 = 0 THEN NULL ELSE concat('R', id % 7) END AS resort", "id AS stay")
    rows = rows.unionByName(rows.limit(10))
    asked = rows.where("stay % 10 = 3 OR stay < 70")
    got = marked(rows, ["resort", "stay"], asked.unionByName(asked))
    assert got.columns == rows.columns
    assert got.exceptAll(rows).count() == 0
    assert rows.join(asked.distinct(), (rows.stay == asked.stay) & rows.resort.eqNullSafe(asked.resort), "left_semi").exceptAll(got).count() == 0
    assert got.count() <= asked.count() + 30
    assert marked(rows, ["resort", "stay"], asked.limit(0)).count() == 0


def test_marks_of_every_bit(spark, monkeypatch):
    monkeypatch.setattr(lookups, "MARK_BITS", 1 << 13)  # so few that all are set: nothing is left out
    rows = spark.range(200_000).select(F.col("id").alias("stay"))
    assert marked(rows.limit(5_000), ["stay"], rows).count() == 5_000


def _documents(spark, t, bound=None):
    if bound is not None:
        spark.conf.set(BROADCAST_CONF, bound)
    try:
        documents = fiscal.fiscal_documents(t, fiscal.stored_outcomes(t))
        return _plan(documents), sorted(map(tuple, documents.collect()), key=repr)
    finally:
        spark.conf.unset(BROADCAST_CONF)


def test_documents_read_the_postings_once(spark):  # F2, F5
    t = hotel_tables(spark, SF_SMALL)
    plan, plain = _documents(spark, t)
    _, moved = _documents(spark, t, "0")
    assert plain == moved and len(plain) > 100
    # all postings are read for their taxes alone; one time each for postings with and without a bill number
    assert sum("Relation" in line and "trx_no_against_package" in line for line in plan.splitlines()) <= 2


def test_marks_come_before_the_folios(spark, monkeypatch):  # else every posting would move to meet them
    plans = []
    monkeypatch.setattr(fiscal, "stored", lambda df, label: plans.append(_plan(df)) or df)
    t = hotel_tables(spark, SF_SMALL)
    outcomes = fiscal.fiscal_outcomes(t)
    spark.conf.set(BROADCAST_CONF, "0")
    try:
        fiscal.sent_postings(t, outcomes.where("outcome = 'SEND'"))
    finally:
        spark.conf.unset(BROADCAST_CONF)
    top = [line for line in plans[-1].splitlines() if "Join" in line]
    assert "folio_view" in top[0] and any("_block" in line for line in top[1:])
