"""Prefix trie of conversations by truncation peeling.

Conversations become chains of keys: the key of a prefix is a running SHA-256 over its turns, cut to 128 bits, so equal
prefixes have equal keys and no text is compared or moved twice. The trie is then peeled from its greatest depth: at depth
d, the conversations that end there join the nodes that survive from depth d + 1 with their last turn stripped, rows of
one key are grouped into a node, and the node goes on, stripped, to depth d - 1. Members, children, leaves and saved bytes
are added up on the way, so every node is found and finished in the round of its depth. A round is one partial aggregation
with one shuffle on the key, and its result is a written table.

Two steps keep the rounds few and the groups small. Equal conversations are one row from the start (their ids are digested
apart). And a chain that no other conversation shares is not peeled turn by turn: where a prefix of 8, 16, 32, ... turns
belongs to one distinct conversation only, all that lies deeper is emitted from that row at once, and the peeling begins
there. The number of rounds is thus at most twice the greatest depth at which different conversations agree, whatever
their length.

The ids that end at a node are hashed in ascending order, which is one sequence: they are joined in chunks of at most
``CHUNK`` ids in parallel, and one pass over the chunks of a node feeds the digest without holding them. A node finds its
parent's smallest member by a join on the key; parents with so many children that they could fill a task are few, by
their number of children, and are broadcast.

Defined results: a null role or text is empty; turns in order of turn, null first, ties by the digest of role and text;
rows without a conv_id belong to no conversation; a conversation without turns ends at the root; repeated rows are repeated
turns; an empty table has no node; other columns are ignored. One conversation is read in one task, as a stream; its keys
(24 bytes a turn) are held at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nightaudit.llm.common import scratch_path, stored, table
from nightaudit.llm.resampling import CRC_TABLE_SQL, crc32_sql

FAMILY = 5
MOST_SHARED = 9
KEY_BYTES = 16
ROOT = bytes(KEY_BYTES)
FIRST_MARK = 8
CHUNK = 4096
#: Parents with more children than this, or than their share of all nodes by HOT_SHARE, are broadcast: HOT_SHARE at most.
HOT_CHILDREN = 10_000
HOT_SHARE = 10_000
#: Rows of the peeling: the chain from the root to this row's depth, and what the row adds to its node.
STATE = ["path", "upto", "conv_id", "n_convs", "kids", "leaves", "saved", "ends"]

CHAIN_SCHEMA = "conv_id long, path array<binary>, upto array<long>"


def turn_digests(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, said, size): the digest of role and text and the text's UTF-8 bytes, for rows with a conv_id."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    return conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("said"),
        F.octet_length(text).cast("long").alias("size"))


class Chain:
    """Keys and running sizes of a conversation's prefixes, from the textless one on."""

    def __init__(self):
        self.sha, self.path, self.upto = hashlib.sha256(), [ROOT], [0]

    def add(self, said: bytes, size: int) -> None:
        self.sha.update(said)
        self.path.append(self.sha.digest()[:KEY_BYTES])
        self.upto.append(self.upto[-1] + size)


def _rows(out: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.list_(pa.binary()), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=["conv_id", "path", "upto"])


def _batched(chains: Iterator[tuple[int, Chain]]) -> Iterator[pa.RecordBatch]:
    out, turns = [], 0
    for conv, chain in chains:
        out.append((conv, chain.path, chain.upto))
        turns += len(chain.path)
        if turns > 20_000:
            yield _rows(out)
            out, turns = [], 0
    if out:
        yield _rows(out)


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*[c.to_pylist() for c in b.columns])


def _chains(rows: Iterator[tuple]) -> Iterator[tuple[int, Chain]]:
    conv, chain = None, None
    for conv_id, said, size in rows:
        if conv_id != conv:
            if chain:
                yield conv, chain
            conv, chain = conv_id, Chain()
        chain.add(said, size)
    if chain:
        yield conv, chain


def _rebuilt(rows: Iterator[tuple]) -> Iterator[tuple[int, Chain]]:
    """Rows (family, conv_id, shared, said, size) in order, each family's base conversation first."""
    family, conv, chain, head, seen, at = None, None, None, [], 0, 0
    for fam, conv_id, shared, said, size in rows:
        if fam != family:
            head, family = [], fam
        if conv_id != conv:
            if chain:
                yield conv, chain
            conv, chain, at = conv_id, Chain(), 0
            if conv_id != fam:
                for turn in head[:shared]:
                    chain.add(*turn)
        at += 1
        if conv_id == fam:
            if len(head) < MOST_SHARED:
                head.append((said, size))
            chain.add(said, size)
        elif at > shared:
            chain.add(said, size)
    if chain:
        yield conv, chain


def chains(conversations: DataFrame) -> DataFrame:
    """(conv_id, path, upto) of the conversations as they are."""
    rows = turn_digests(conversations).repartition("conv_id").sortWithinPartitions(
        "conv_id", F.col("turn").asc_nulls_first(), "said").select("conv_id", "said", "size")
    return rows.mapInArrow(lambda it: _batched(_chains(_stream(it))), CHAIN_SCHEMA)


def rebuilt_chains(conversations: DataFrame) -> DataFrame:
    """(conv_id, path, upto): conversation c begins with the first h turns of conversation c - c % FAMILY and goes on with
    its own turns after its first h; h is the crc32 of its decimal id modulo MOST_SHARED."""
    rows = turn_digests(conversations).withColumns({
        "family": F.col("conv_id") - F.col("conv_id") % FAMILY,
        "shared": F.crc32(F.col("conv_id").cast("string")) % MOST_SHARED})
    ordered = rows.repartition("family").sortWithinPartitions(
        "family", F.col("conv_id") != F.col("family"), "conv_id", F.col("turn").asc_nulls_first(), "said")
    return ordered.select("family", "conv_id", "shared", "said", "size").mapInArrow(
        lambda it: _batched(_rebuilt(_stream(it))), CHAIN_SCHEMA)


def _digest_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, ids) in order of key and chunk; one digest per key."""
    def done():
        cols = list(zip(*out))
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.string())],
                                          names=["e_key", "ends"])
    key, sha, out = None, None, []
    for k, ids in _stream(batches):
        if k != key:
            if sha:
                out.append((key, sha.hexdigest()))
                if len(out) == 10_000:
                    yield done()
                    out = []
            key, sha = k, hashlib.sha256()
        else:
            sha.update(b",")
        sha.update(ids.encode())
    if sha:
        out.append((key, sha.hexdigest()))
    if out:
        yield done()


def _ends(ended: DataFrame) -> DataFrame:
    """``ended``: key, conv_id. (e_key, ends): SHA-256 of the ids that end at the key, ascending."""
    chunk = F.shiftright("conv_id", CHUNK.bit_length() - 1)
    chunks = ended.groupBy("key", chunk.alias("chunk")).agg(
        F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    return chunks.repartition("key").sortWithinPartitions("key", "chunk").select("key", "ids").mapInArrow(
        _digest_chunks, "e_key binary, ends string")


def _classes(own: DataFrame) -> DataFrame:
    """One row per distinct conversation: key, size, path, upto, conv_id (smallest), n_convs, ends."""
    keyed = own.withColumn("key", F.element_at("path", -1))
    grouped = keyed.groupBy("key").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
                                       F.first("path").alias("path"), F.first("upto").alias("upto"))
    return grouped.join(_ends(keyed.select("key", "conv_id")), F.col("key") == F.col("e_key")).drop("e_key").withColumn(
        "size", F.size("path") - 1)


def _cuts(classes: DataFrame) -> DataFrame:
    """(c_key, cut): the least of the depths 8, 16, 32, ... from which on a conversation shares no node."""
    deep = classes.filter(F.col("size") > FIRST_MARK).select("key", "size", "path")
    marks = F.filter(F.array(*[F.lit(FIRST_MARK << k) for k in range(24)]), lambda m: m < F.col("size"))
    at = deep.withColumn("mark", F.explode(marks)).select("key", "mark", F.expr("path[mark]").alias("mark_key"))
    single = at.groupBy("mark_key").agg(F.count("*").alias("n"), F.first("key").alias("c_key"), F.first("mark").alias("mark"))
    return single.filter("n = 1").groupBy("c_key").agg(F.min("mark").alias("cut"))


def _tails(cut: DataFrame) -> DataFrame:
    """The nodes deeper than the cut: one conversation's own chain."""
    deeper = cut.withColumn("depth", F.explode(F.sequence(F.col("cut") + 1, F.col("size"))))
    ends_here = F.col("depth") == F.col("size")
    return deeper.select(
        F.expr("path[depth]").alias("key"), F.expr("path[depth - 1]").alias("parent"), "depth", "conv_id", "n_convs",
        F.when(ends_here, F.lit(0)).otherwise(1).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.expr("upto[size] - upto[depth - 1]")).alias("saved_tokens"),
        F.when(ends_here, F.col("ends")).alias("ends"))


def _entries(classes: DataFrame, cuts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of the peeling with the depth at which they enter it, and the nodes of the chains cut off."""
    known = classes.join(cuts, F.col("key") == F.col("c_key"), "left").drop("c_key")
    whole, cut = known.filter("cut IS NULL"), known.filter("cut IS NOT NULL")
    zero = F.lit(0).cast("long")
    enter = whole.select(F.col("size").alias("depth"), "path", "upto", "conv_id", "n_convs", zero.alias("kids"),
                         zero.alias("leaves"), zero.alias("saved"), "ends")
    stripped = cut.select(
        F.col("cut").alias("depth"), F.expr("slice(path, 1, cut + 1)").alias("path"),
        F.expr("slice(upto, 1, cut + 1)").alias("upto"), "conv_id", "n_convs", (zero + 1).alias("kids"),
        (zero + 1).alias("leaves"), ((F.col("n_convs") - 1) * F.expr("upto[size] - upto[cut]")).alias("saved"),
        F.lit(None).cast("string").alias("ends"))
    return enter.unionByName(stripped), _tails(cut)


def _nodes_at(depth: int, rows: DataFrame) -> DataFrame:
    """The nodes of one depth, from all rows that lie there."""
    grouped = rows.withColumn("key", F.element_at("path", -1)).groupBy("key").agg(
        F.first("path").alias("path"), F.first("upto").alias("upto"), F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "kids", "leaves", "saved")], F.max("ends").alias("ends"))
    own = F.expr(f"upto[{depth}] - upto[{depth - 1}]") if depth else F.lit(0)
    return grouped.withColumns({
        "leaves": F.when(F.col("kids") == 0, F.lit(1)).otherwise(F.col("leaves")).cast("long"),
        "saved": F.col("saved") + (F.col("n_convs") - 1) * own})


def _stripped(nodes: DataFrame, depth: int) -> DataFrame:
    return nodes.select(
        F.slice("path", 1, depth).alias("path"), F.slice("upto", 1, depth).alias("upto"), "conv_id", "n_convs",
        F.lit(1).cast("long").alias("kids"), "leaves", "saved", F.lit(None).cast("string").alias("ends"))


NODE = ["key", "parent", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]


def peel(chained: DataFrame) -> DataFrame:
    """The nodes of the trie, a stored table with the columns of ``NODE``; ``ends`` is null where nothing ends.
    ``chained``: conv_id, path, upto of every conversation, one row each."""
    spark = chained.sparkSession
    classes = stored(_classes(stored(chained, "trie-chains")), "trie-classes")
    entries, tails = _entries(classes, stored(_cuts(classes), "trie-cuts"))
    folder = scratch_path(spark, "trie-entries")
    entries.write.partitionBy("depth").parquet(folder)
    schema = "path array<binary>, upto array<long>, conv_id long, n_convs long, kids long, leaves long, saved long, ends string, depth int"
    entries = spark.read.schema(schema).parquet(folder)
    depths = {r["depth"] for r in entries.select("depth").distinct().collect()}  # one row per depth
    found, nodes = [], None
    for depth in range(max(depths, default=-1), -1, -1):
        rows = entries.filter(F.col("depth") == depth).select(*STATE) if depth in depths else None
        if nodes is not None:
            survivors = _stripped(nodes, depth + 1).select(*STATE)
            rows = survivors if rows is None else rows.unionByName(survivors)
        nodes = stored(_nodes_at(depth, rows), f"trie-depth{depth}")
        found.append(nodes.select(
            "key", (F.expr(f"path[{depth - 1}]") if depth else F.lit(None).cast("binary")).alias("parent"),
            F.lit(depth).alias("depth"), "conv_id", "n_convs", F.col("kids").alias("n_children"),
            F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), "ends"))
    for more in found:
        tails = tails.unionByName(more)
    return stored(tails.select(*NODE), "trie-nodes")


def with_parents(nodes: DataFrame) -> DataFrame:
    """``nodes`` (a stored table) with parent_conv_id, the smallest member of the parent; null for the root."""
    most = max(HOT_CHILDREN, nodes.count() // HOT_SHARE)
    parents = nodes.select(F.col("key").alias("p_key"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    hot = F.broadcast(parents.filter(F.col("n_children") > most).drop("n_children"))  # fewer than HOT_SHARE rows
    cold = parents.filter(F.col("n_children").between(1, most)).drop("n_children")
    of_parent = F.col("parent") == F.col("p_key")
    root = nodes.filter("parent IS NULL").withColumn("parent_conv_id", F.lit(None).cast("long"))
    under = nodes.filter("parent IS NOT NULL")
    few = under.join(hot.select("p_key"), of_parent, "left_anti").join(cold, of_parent).drop("p_key")
    many = under.join(hot, of_parent).drop("p_key")
    return root.unionByName(few).unionByName(many)


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the conversations as they are: key, parent, depth, conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends, parent_conv_id."""
    return with_parents(peel(chains(conversations)))


#: What no ids digest to.
NO_IDS = hashlib.sha256(b"").hexdigest()


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = with_parents(peel(rebuilt_chains(table(spark, sf_dir, "conversations"))))
    return nodes.select("conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children",
                        "n_leaves", "saved_tokens", F.coalesce("ends", F.lit(NO_IDS)).alias("ends_sha256"))


QUERIES = {"op12_prefix_trie": op12_prefix_trie}

ORACLE_SQL = {"op12_prefix_trie": f"""
WITH RECURSIVE {CRC_TABLE_SQL},
own AS (SELECT conv_id AS c, list(struct_pack(r := coalesce(role, ''), x := coalesce(text, '')) ORDER BY turn NULLS FIRST,
        sha256(concat(octet_length(encode(coalesce(role, ''))), ':', coalesce(role, ''), coalesce(text, '')))) AS t
        FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
ids AS (SELECT c, CAST(c AS VARCHAR) AS s FROM own),
h AS (SELECT c, {crc32_sql('s', 'crc.t')} % {MOST_SHARED} AS h FROM ids, crc),
full_ AS (SELECT own.c, list_concat(CASE WHEN own.c % {FAMILY} = 0 THEN own.t[:h] ELSE coalesce(base.t, [])[:h] END,
          own.t[h + 1:]) AS t FROM own JOIN h USING (c) LEFT JOIN own base ON base.c = own.c - own.c % {FAMILY}),
pre AS (SELECT c, d, len(t) AS n, t[:d] AS p FROM (SELECT *, unnest(range(0, len(t) + 1)) AS d FROM full_)),
node AS (SELECT d, p, min(c) AS c, count(*) AS n,
         string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (n = d) AS e FROM pre GROUP BY d, p),
linked AS (SELECT node.*, up.c AS pc FROM node LEFT JOIN node up ON up.d = node.d - 1 AND up.p = node.p[:node.d - 1]),
kids AS (SELECT d - 1 AS d, p[:d - 1] AS p, count(*) AS k FROM node WHERE d > 0 GROUP BY ALL),
joined AS (SELECT linked.*, coalesce(k, 0) AS k FROM linked LEFT JOIN kids USING (d, p)),
worth AS (SELECT d, p, CASE WHEN k = 0 THEN 1 ELSE 0 END AS leaf,
          CASE WHEN d = 0 THEN 0 ELSE (n - 1) * octet_length(encode(p[d].x)) END AS saved FROM joined),
below AS (SELECT a AS d, p[:a] AS p, sum(leaf) AS leaves, sum(saved) AS saved
          FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM worth) GROUP BY ALL)
SELECT CAST(c AS BIGINT) AS conv_id, CAST(d AS BIGINT) AS depth, CAST(pc AS BIGINT) AS parent_conv_id,
       CAST(n AS BIGINT) AS n_convs, CAST(k AS BIGINT) AS n_children, CAST(leaves AS BIGINT) AS n_leaves,
       CAST(below.saved AS BIGINT) AS saved_tokens, sha256(coalesce(e, '')) AS ends_sha256
FROM joined JOIN below USING (d, p)"""}
