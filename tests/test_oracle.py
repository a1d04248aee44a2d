"""Every registered query against its DuckDB oracle, and the derived tables
themselves, at sf0.001 (the driver repeats this at sf0.01)."""

import pytest

import __spark_entry__ as E
from nightaudit.oracle.hotel_sql import with_hotel_tables
from nightaudit.registry import REGISTRY
from nightaudit.sources.hotel import TABLE_NAMES, hotel_tables
from tests.conftest import SF_SMALL
from tools.compare import compare

QUERIES = REGISTRY
ORACLE = {name: sql for name, sql in E.oracle_sql().items() if name in REGISTRY}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck_small, name):
    assert compare(name, QUERIES[name](spark, SF_SMALL), ORACLE[name], duck_small)


@pytest.mark.parametrize("name", TABLE_NAMES)
def test_derived_table_matches(spark, duck_small, name):
    t = hotel_tables(spark, SF_SMALL)
    assert compare(name, t[name], with_hotel_tables(f"SELECT * FROM {name}"), duck_small)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["resort", "reservation_date"]
    assert df.count() > 0


SPARK_TO_DUCK = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "date": "DATE",
                 "timestamp_ntz": "TIMESTAMP", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_types_match_oracle(spark, duck_small, name):
    """Same column names and types as the oracle (the driver compares schemas)."""
    spark_types = {f.name: f.dataType.simpleString() for f in QUERIES[name](spark, SF_SMALL).schema.fields}
    rel = duck_small.sql(ORACLE[name])
    duck_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert {c: SPARK_TO_DUCK.get(t, t.upper()) for c, t in spark_types.items()} == duck_types


@pytest.mark.parametrize("name", ["inhouse_today", "reservation_detail", "loyalty_statement", "fiscal_documents",
                                  "guest_night_ledger", "asof_stay_rate"])
def test_beyond_broadcast_bound_matches_oracle(spark, duck_small, name):
    """With a tiny broadcast bound every size-checked dimension takes the shuffle
    path and Q3 restricts its dimensions to the slice: the scale code paths."""
    from nightaudit.operators.lookups import BROADCAST_CONF
    spark.conf.set(BROADCAST_CONF, "0")
    try:
        assert compare(name, QUERIES[name](spark, SF_SMALL), ORACLE[name], duck_small)
    finally:
        spark.conf.unset(BROADCAST_CONF)
