"""One commit over several tables: all or nothing, replays change nothing, keyed rows are live once."""

import uuid

import pytest
from pyspark.sql import functions as F

from nightaudit.session import ensure_checkpoint_dir
from nightaudit.streaming.batch_store import BatchStore, Keyed, added_up, newest_wins

ROWS = "k string, n bigint"


@pytest.fixture
def store(spark):
    root = f"{ensure_checkpoint_dir(spark)}/batch-store-{uuid.uuid4().hex}"
    return BatchStore(spark, root, {"history": ROWS, "log": "line string"}, {
        "live": Keyed(ROWS, ["k"], newest_wins(["k"], "n"), buckets=4),
        "sums": Keyed(ROWS, ["k"], added_up(["k"], ["n"]), buckets=4)})


def _batch(spark, *rows):
    df = spark.createDataFrame(list(rows), ROWS)
    return {"history": df, "log": df.select(F.concat("k", F.lit("!")).alias("line")), "live": df, "sums": df}


def _read(store, table):
    return sorted((tuple(r) for r in store.read(table).collect()), key=repr)


def test_tables_change_together(spark, store):
    assert [_read(store, x) for x in ("history", "live")] == [[], []]
    assert store.commit(0, _batch(spark, ("a", 1), ("b", 2), (None, 5)))
    assert store.commit(1, _batch(spark, ("a", 3), ("c", 4), (None, 1)))
    assert _read(store, "history") == sorted([("a", 1), ("b", 2), (None, 5), ("a", 3), ("c", 4), (None, 1)], key=repr)
    assert _read(store, "live") == sorted([("a", 3), ("b", 2), ("c", 4), (None, 5)], key=repr)
    assert _read(store, "sums") == sorted([("a", 4), ("b", 2), ("c", 4), (None, 6)], key=repr)
    assert _read(store, "log") == sorted([("a!",), ("b!",), (None,), ("a!",), ("c!",), (None,)], key=repr)
    # a replay does nothing
    assert not store.commit(1, _batch(spark, ("a", 99)))
    assert _read(store, "sums") == sorted([("a", 4), ("b", 2), ("c", 4), (None, 6)], key=repr)
    # only the buckets of the keys are read
    asked = store.read("live", spark.createDataFrame([("b",)], "k string"))
    assert ("b", 2) in [tuple(r) for r in asked.collect()]
    assert len(asked.inputFiles()) < len(store.read("live").inputFiles())


@pytest.mark.parametrize("at", ["history", "log", "live", "sums", "manifest"])
def test_a_killed_batch_leaves_nothing_visible(spark, store, monkeypatch, at):
    store.commit(0, _batch(spark, ("a", 1)))
    before = {x: _read(store, x) for x in ("history", "log", "live", "sums")}

    class Killed(Exception):
        pass

    def dies(*_):
        raise Killed

    with monkeypatch.context() as m:
        rows = _batch(spark, ("a", 2), ("z", 3))
        if at == "manifest":
            m.setattr(store, "_put", dies)
        else:
            rows[at] = rows[at].select("*", F.raise_error(F.lit("killed")).alias("x")).select(
                *[F.when(F.col("x").isNull(), F.col(c)).alias(c) for c in rows[at].columns])
        with pytest.raises(Exception):
            store.commit(1, rows)
    assert {x: _read(store, x) for x in before} == before and not store.committed(1)
    assert store.commit(1, _batch(spark, ("a", 2), ("z", 3)))
    assert _read(store, "sums") == [("a", 3), ("z", 3)] and _read(store, "history") == [("a", 1), ("a", 2), ("z", 3)]


def test_compaction_and_vacuum_keep_the_tables(spark, store):
    for no in range(3):
        store.commit(no, _batch(spark, ("a", no), ("b", 10 - no)))
    want = {x: _read(store, x) for x in ("history", "log", "live", "sums")}
    store.compact()
    assert {x: _read(store, x) for x in want} == want and store.committed(1)
    assert store.vacuum() > 0
    assert {x: _read(store, x) for x in want} == want and store.committed(1) and not store.committed(3)
    assert not store.commit(2, _batch(spark, ("a", 99)))
    assert store.commit(3, _batch(spark, ("a", 7)))
    assert ("a", 7) in _read(store, "live") and len(_read(store, "history")) == 7
