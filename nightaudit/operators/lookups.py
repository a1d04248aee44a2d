"""Scalar-subquery lookups as joins (J12, J12g, J13) and size-checked broadcast.

A correlated ``(SELECT x FROM dim WHERE dim.k = outer.k)`` returns NULL when
no row matches and raises when more than one does. A plain left join would
silently fan out instead, so ``lookup`` groups the dim by its key, carries the
number of rows through the join and raises on a joined row that uses the value
of a key with several. A duplicate that no row asks for does no harm, whatever
the sizes. Building a lookup starts no job.

Rows with a NULL key match nothing; they are spread over all tasks instead of
meeting in one (``join_per_key``), and both sides of a shuffled lookup come
straight from an exchange, so AQE can split a hot key.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightaudit.session import ensure_checkpoint_dir

# Tables whose plan statistics (file sizes of what is read) stay within these bytes are broadcast;
# for others AQE decides from the shuffle it has measured. Override with the session conf below.
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
BROADCAST_CONF = "nightaudit.broadcast.maxBytes"
# A lookup's table has a row for each key, which files may hold in a hundredth of what it takes in memory: it is broadcast
# if the files that it is read from are, whole, within these bytes (and within the conf above).
LOOKUP_MAX_BYTES = 1024 * 1024
# What a row of a broadcast lookup takes in memory, where the number of its keys is known.
LOOKUP_ROW_BYTES = 256


def fits_broadcast(dim: DataFrame) -> bool:
    """Is the optimizer's size estimate, an upper bound from the sizes of the files that ``dim`` reads, within the limit?
    No job is run and nothing is remembered; a table that has grown is judged anew."""
    return int(str(dim._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= _limit(dim)


def _limit(dim: DataFrame) -> int:
    return int(dim.sparkSession.conf.get(BROADCAST_CONF, str(BROADCAST_MAX_BYTES)))


def sized_broadcast(dim: DataFrame) -> DataFrame:
    """Broadcast ``dim`` if it fits."""
    return F.broadcast(dim) if fits_broadcast(dim) else dim


def fits_lookup(dim: DataFrame) -> bool:
    """May a table of keys and values be broadcast: are the files that ``dim`` reads small, all their columns counted? No
    job is run."""
    leaves = dim._jdf.queryExecution().optimizedPlan().collectLeaves()
    read = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.length()))
    return read <= min(_limit(dim), LOOKUP_MAX_BYTES)


def lookup_side(dim: DataFrame) -> DataFrame:
    """``dim`` as the side of a join that looks up in it: broadcast if it may be; else merged, as Spark's own estimate is
    that of the files too and would have it broadcast."""
    return F.broadcast(dim) if fits_lookup(dim) else dim.hint("merge")


def few_keys(fact: DataFrame, columns: Sequence[str]) -> bool:
    """Are the distinct values of each of ``columns`` so few that a table of them can be broadcast (one pass over these
    columns counts them, to some percent)?"""
    most = _limit(fact) // LOOKUP_ROW_BYTES
    return most > 0 and max(fact.agg(*[F.approx_count_distinct(c) for c in columns]).first()) <= most


def rows_per_key(dim: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """One row per non-NULL key: the keys, ``_n`` (its rows) and the values."""
    return dim.where(_all_not_null(keys)).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), *[F.max(v).alias(v) for v in values])


def join_per_key(fact: DataFrame, per_key: DataFrame, on: dict[str, str], count: str) -> DataFrame:
    """Left join to a table with one row per key (``on``: fact column -> its column; ``count``: a column of it that is
    1 or more). A second key, 0 for every row that can match and a hash of the row where the key is NULL, spreads the
    rows that match nothing."""
    spread = [c for c in fact.columns if c not in on][:8]
    null_key = F.lit(False)
    for k in on:
        null_key = null_key | fact[k].isNull()
    f = fact.withColumn("_spread", F.when(null_key, F.pmod(F.xxhash64(*spread), F.lit(4096)) + 1).otherwise(
        F.lit(0).cast("long")) if spread else F.lit(0).cast("long"))
    d = per_key.withColumn("_zero", F.least(F.col(count), F.lit(0).cast("long")))
    cond = f["_spread"] == d["_zero"]
    for fk, dk in on.items():
        cond = cond & (f[fk] == d[dk])
    return f.join(d, cond, "left").drop("_spread", "_zero")


def checked(joined: DataFrame, count: str, columns: Sequence[str], what: str, keys: Sequence[str],
            when: Column | None = None) -> DataFrame:
    """``joined`` is a left join with a table of one row per key that carries the key's rows in ``count``: ``columns`` raise
    on a row whose key has several (Oracle: ORA-01427). A duplicate that no row asks for does no harm. ``when``: the rows
    that evaluate the subquery; others get NULL and raise nothing. Drops ``count``."""
    err = F.raise_error(F.concat(F.lit(f"single-row lookup on {what} returned more than one row for key "),
                                 F.to_json(F.struct(*keys))))
    one = {c: F.when(F.col(count) > 1, err).otherwise(F.col(c)) for c in columns}
    return joined.withColumns(one if when is None else {c: F.when(when, v) for c, v in one.items()}).drop(count)


def with_rows(fact: DataFrame, dim: DataFrame, on: dict[str, str], values: dict[str, str], count: str) -> DataFrame:
    """A lookup whose check comes later: ``fact`` with the values and, in ``count``, the rows of the key, for ``checked``
    where it is known which rows ask."""
    d = rows_per_key(dim, list(on.values()), list(values)).select(
        *[F.col(k).alias(f"_wr_{k}") for k in on.values()], *[F.col(v).alias(name) for v, name in values.items()],
        F.col("_n").alias(count))
    joined = join_per_key(fact, lookup_side(d), {fk: f"_wr_{dk}" for fk, dk in on.items()}, count)
    return joined.drop(*[f"_wr_{k}" for k in on.values()])


def with_resort(fact: DataFrame, info: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``fact`` with columns of ``plans.detail.resort_info`` (all, or ``columns``) by its resort."""
    counts = [c for c in ("_resort_n", "_open_n") if c in info.columns]
    wanted = list(columns or [c for c in info.columns if c != "resort" and c not in counts])
    out = fact.join(info.select("resort", *wanted, *counts), "resort", "left")
    for count, what in (("_resort_n", "resort"), ("_open_n", "open business date")):
        if count in counts:
            own = [c for c in wanted if (c == "open_business_date") == (count == "_open_n")]
            out = checked(out, count, own, what, ["resort"]) if own else out.drop(count)
    return out


def _all_not_null(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as a parquet table in a fresh folder under the shared
    ``spark.checkpoint.dir`` and read it back: cuts the lineage of a small
    intermediate that several later steps reuse, so it is computed once and a
    lost executor does not recompute it."""
    spark = df.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark), f"nightaudit-{label}", uuid.uuid4().hex)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


#: Bits of ``marked`` (16 MB), and how many of them are one row of its table (and one number in it).
MARK_BITS, MARK_BLOCK, MARK_WORD = 1 << 27, 1 << 12, 1 << 6


def marked(rows: DataFrame, keys: Sequence[str], asked: DataFrame) -> DataFrame:
    """The rows whose ``keys`` may be among those of ``asked``: all that are, and of the others the share of the bits that
    are set. For keys too many to broadcast: a bit is set for the hash of each, which takes ``MARK_BITS`` bits whatever
    their number, and a join with ``asked`` that follows moves few rows that it then drops."""
    place = F.pmod(F.xxhash64(*keys), F.lit(MARK_BITS))
    words = asked.select(place.alias("_at")).groupBy(F.floor(F.col("_at") / MARK_WORD).alias("_word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(_at % {MARK_WORD} as int))")).alias("_bits"))
    per_block = MARK_BLOCK // MARK_WORD
    blocks = words.groupBy(F.floor(F.col("_word") / per_block).alias("_block")).agg(F.map_from_entries(F.collect_list(
        F.struct((F.col("_word") % per_block).cast("int"), "_bits"))).alias("_set"))
    blocks = blocks.select("_block", F.transform(F.sequence(F.lit(0), F.lit(per_block - 1)), lambda i: F.coalesce(
        F.element_at("_set", i), F.lit(0).cast("long"))).alias("_marks"))
    at = rows.withColumn("_at", place)
    met = at.join(F.broadcast(blocks), F.floor(F.col("_at") / MARK_BLOCK) == F.col("_block"))
    word = F.element_at("_marks", (F.floor(F.col("_at") / MARK_WORD) % per_block + 1).cast("int"))
    return met.where(F.getbit(word, (F.col("_at") % MARK_WORD).cast("int")) == 1).drop("_at", "_block", "_marks")


def restrict_to(dim: DataFrame, fact: DataFrame, on: dict[str, str]) -> DataFrame:
    """Keep only the dim rows whose key the fact asks for (left semi join on the
    fact's distinct keys). Exact for per-key lookups and per-key aggregates;
    worth it when the fact is a small slice of what the dim covers."""
    wanted = fact.select(*[F.col(fk).alias(dk) for fk, dk in on.items()]).distinct()
    return dim.join(wanted, list(on.values()), "left_semi")


def lookup(fact: DataFrame, dim: DataFrame, on: dict[str, str], values: dict[str, str], what: str,
           when: Column | None = None, narrow: bool = False, few: DataFrame | None = None) -> DataFrame:
    """Left-join single-row lookup.

    ``on`` maps fact column -> dim column, ``values`` maps dim column -> output
    name. ``when``: the rows that evaluate the subquery; others get NULL and
    raise nothing. ``narrow``: the fact is a small slice - the dim is first
    restricted to its keys (``restrict_to``), which changes no answer and no
    error, as only joined rows raise. ``few``: rows that hold all keys
    that the fact asks for, few of them (``few_keys``): the dim, restricted to them, is broadcast.
    """
    keys = list(on.values())
    tmp = {k: f"_lk_{i}" for i, k in enumerate(keys)}
    out = {v: f"_lv_{i}" for i, v in enumerate(values)}
    if narrow or few is not None:
        dim = restrict_to(dim, fact if few is None else few, on)
    d = rows_per_key(dim, keys, list(values)).select(
        *[F.col(k).alias(tmp[k]) for k in keys], *[F.col(v).alias(out[v]) for v in values], F.col("_n").alias("_lk_n"))
    if not narrow:  # a slice's keys have no size before run time: AQE decides
        d = lookup_side(d) if few is None else F.broadcast(d)
    joined = join_per_key(fact, d, {fk: tmp[dk] for fk, dk in on.items()}, "_lk_n")
    err = F.raise_error(F.concat(F.lit(f"single-row lookup on {what} returned more than one row for key "),
                                 F.to_json(F.struct(*[F.col(fk) for fk in on]))))
    for v, name in values.items():
        one = F.when(F.col("_lk_n") > 1, err).otherwise(F.col(out[v]))
        joined = joined.withColumn(name, one if when is None else F.when(when, one))
    return joined.drop(*tmp.values(), *out.values(), "_lk_n")


def lookup_roles(fact: DataFrame, dim: DataFrame, key: str, roles: dict[str, dict[str, str]], what: dict[str, str]
                 ) -> DataFrame:
    """Single-row lookups of several fact columns in one dim, as ``lookup`` for each: ``roles`` maps a fact column to its
    values (dim column -> output name), ``what`` to its name in errors.

    A dim that can be broadcast (``fits_lookup``) is joined for each role. A larger one is joined once: the distinct combinations of the
    role columns are unpivoted to one narrow row for each id, meet the dim, and come back as one row for each combination,
    so the wide fact is shuffled once for all roles."""
    if fits_lookup(dim):
        for col, own in roles.items():
            fact = lookup(fact, dim, {col: key}, own, what[col])
        return fact
    values = list(dict.fromkeys(v for own in roles.values() for v in own))
    ids = list(roles)
    asked = fact.select(*[F.col(c).alias(f"_lr_{c}") for c in ids]).distinct()
    combination = asked.columns
    each = asked.select("*", F.posexplode(F.array(*combination)).alias("_role", key)).where(F.col(key).isNotNull())
    met = each.join(rows_per_key(dim, [key], values).hint("merge"), key)
    back = met.groupBy(*combination).agg(*[
        F.max(F.when(F.col("_role") == i, F.struct("_n", *own))).alias(f"_role_{i}")
        for i, own in enumerate(roles.values())])
    cond = F.lit(True)
    for c in ids:
        cond = cond & fact[c].eqNullSafe(back[f"_lr_{c}"])
    joined = fact.join(back, cond, "left")
    for i, (col, own) in enumerate(roles.items()):
        err = F.raise_error(F.concat(F.lit(f"single-row lookup on {what[col]} returned more than one row for key "),
                                     F.to_json(F.struct(F.col(col)))))
        for v, name in own.items():
            joined = joined.withColumn(name, F.when(F.col(f"_role_{i}._n") > 1, err).otherwise(F.col(f"_role_{i}.{v}")))
    return joined.drop(*combination, *[f"_role_{i}" for i in range(len(roles))])


def first_account_code(ar_account: DataFrame, ppor_ar: DataFrame) -> DataFrame:
    """One accounting code per agent profile, over all resorts.

    The reference takes "any" row (``ROWNUM = 1`` without ORDER BY); the
    smallest code is the deterministic pick. Both sides are pre-aggregated,
    so no agent can blow up a task.
    """
    p = ppor_ar.where(F.col("acc_code").isNotNull())
    return (ar_account.join(p, ["resort", "account_code"])
            .groupBy("name_id").agg(F.min("acc_code").alias("acc_code")))


def departure_day(dn: DataFrame, e: DataFrame, rn: DataFrame) -> DataFrame:
    """J12g: the nightly row of a stay's departure day (four lookups, one join).

    Returns (resort, resv_name_id, travel_agent_id, company_id, group_id, adults, _dep_n), one row per stay;
    the caller raises on the stays it uses (``checked``).
    """
    slots = e.select("resort", "reservation_date", "resv_daily_el_seq")
    dep = (rn.select("resort", "resv_name_id", F.col("trunc_end_date").alias("reservation_date"))
           .join(dn, ["resort", "resv_name_id", "reservation_date"])
           .join(slots, ["resort", "reservation_date", "resv_daily_el_seq"]))
    return rows_per_key(dep, ["resort", "resv_name_id"], ["travel_agent_id", "company_id", "group_id", "adults"]
                        ).withColumnRenamed("_n", "_dep_n")
