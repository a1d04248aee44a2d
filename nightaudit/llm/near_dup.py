"""MinHash near-duplicates: circulant MinHash, banding, exact Jaccard on full shingle sets, connected components.

Signature. Two permutations give all ``COORDINATES`` coordinates: the first (sigma) breaks up the order of a shingle's
32-bit place, the second (pi), shifted round the circle by k, gives coordinate k as the minimum of pi(sigma(x) + k)
over the set. ``BANDS`` bands of ``ROWS`` coordinates make the bucket keys; a pair at Jaccard 0.85 shares no bucket
with probability (1 - 0.85^8)^32 = 4e-5, and less if it is joined over other documents too. Four bits of each
coordinate make a sketch that spares hopeless pairs the exact check (at 0.85 it errs once in 1e8).

Candidates. Equal sets are one class, named by its smallest doc_id, so copies cost one row. In each bucket all classes
are paired with one of them, the pivot, which differs from band to band. Verified pairs are links; connected components
of these leave few open buckets, those that still hold several components. There, and only there, the members outside
the bucket's largest component are paired with every member of another component, so no bucket is capped and no pair of
a bucket goes unexamined unless it is joined already. The work of an open bucket grows with its members times those
outside its largest component.

Two exact bounds spare pairs there: sizes, and shingles that occur in one component only (a copy with many edits of
its own can share too little with any other). A pair that shares several buckets is taken in one of them.

Verification. The words of the documents that share a bucket are read once more, and the 64-bit hashes of their full
shingle sets are intersected in a join on the pairs. Components come from minimum labels with pointer jumping,
every round written to the shared folder; nothing about documents is collected to the driver.

Defined results: a document without words or text has no shingles and is its own component; fewer words than five are
one shingle; rows that share a doc_id are one document; rows without a doc_id take part in no link, have no component
and are kept; an empty table gives an empty result; other columns are ignored, or kept by :func:`keep_one`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nightaudit.llm.common import packed, stored, table, text_or_empty, unpacked

SHINGLE = 5
COORDINATES = 256
ROWS = 8
BANDS = COORDINATES // ROWS
THRESHOLD_PERCENT = 85
#: The sketch has four bits of each coordinate. In a pair at the threshold 36 coordinates differ in the mean, with a
#: standard deviation of 5.6; more than so many differ once in a hundred million pairs.
SKETCH_MOST = 68
CHUNK = 2048
CACHED_WORDS = 150_000
#: Most document ids (8 bytes each) in a broadcast.
BROADCAST_IDS = 2_000_000

_STEP = np.uint64(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def _mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_sets(texts: list[str], cache: dict) -> list[np.ndarray]:
    """Per text, the sorted distinct 64-bit hashes of its shingles. ``bytes.lower`` folds A-Z and nothing else, and
    ``bytes.split`` splits at the contract's white space."""
    out = []
    for text in texts:
        words = text.encode().lower().split()
        n = len(words)
        h = np.fromiter(map(cache.__getitem__, words), np.uint64, n)
        k = min(n, SHINGLE)
        acc = np.full(max(n - k + 1, 0) if n else 0, k, np.uint64)
        for j in range(k):
            acc = _mix64(acc * _STEP + h[j:n - k + 1 + j])
        out.append(np.unique(acc))
    return out


def _permute32(x: np.ndarray, a: int, b: int) -> None:
    """A permutation of the 32-bit numbers, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(a)
    x ^= x >> np.uint32(15)
    x *= np.uint32(b)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Circulant MinHash signatures, one row per set; sets of any size go through in chunks."""
    out = np.full((len(sets), COORDINATES), 0xFFFFFFFF, np.uint32)
    sizes = np.array([len(s) for s in sets], np.int64)
    if not sizes.sum():
        return out
    place = np.concatenate(sets)
    place = (place ^ (place >> np.uint64(32))).astype(np.uint32)
    _permute32(place, 0x85EBCA6B, 0xC2B2AE35)  # sigma
    owner = np.repeat(np.arange(len(sets)), sizes)
    shifts = np.arange(1, COORDINATES + 1, dtype=np.uint32)
    for at in range(0, len(place), CHUNK):
        x = place[at:at + CHUNK, None] + shifts
        _permute32(x, 0x7FEB352D, 0x846CA68B)  # pi, shifted round the circle
        own = owner[at:at + CHUNK]
        first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        out[own[first]] = np.minimum(out[own[first]], np.minimum.reduceat(x, first, axis=0))
    return out


def _keys(sig: np.ndarray) -> np.ndarray:
    parts = sig.reshape(len(sig), BANDS, ROWS).astype(np.uint64)
    acc = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for j in range(ROWS):
        acc = _mix64(acc * _STEP + parts[:, :, j])
    return acc.view(np.int64)


def _sketches(sig: np.ndarray) -> np.ndarray:
    four = ((sig >> np.uint32(3)) & np.uint32(15)).astype(np.uint8)
    return np.ascontiguousarray(four[:, ::2] | (four[:, 1::2] << 4)).view(np.int64)


def _lists(a: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(len(a) + 1, dtype=np.int32) * a.shape[1], pa.array(a.reshape(-1)))


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache = _WordHashes()
    for whole in batches:
        for at in range(0, whole.num_rows, 500):
            b = whole.slice(at, 500)
            sets = shingle_sets(b.column(1).to_pylist(), cache)
            sig = signatures(sets)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                 _lists(_keys(sig)), _lists(_sketches(sig))],
                names=["doc_id", "n_shingles", "set_key", "bands", "sketch"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache = _WordHashes()
    for whole in batches:
        for at in range(0, whole.num_rows, 500):
            b = whole.slice(at, 500)
            sets = shingle_sets(b.column(1).to_pylist(), cache)
            flat = np.concatenate(sets).view(np.int64)
            offsets = np.r_[0, np.cumsum([len(s) for s in sets])].astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(offsets, pa.array(flat))],
                                             names=["node", "shingles"])


def _pairs_left(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """``pairs`` (a, b) whose sizes and sketches leave the threshold open."""
    facts = classes.select("node", "n_shingles", "sketch")
    for side in ("a", "b"):
        pairs = pairs.join(facts.select(F.col("node").alias(side), F.col("n_shingles").alias(f"n_{side}"),
                                        F.col("sketch").alias(f"s_{side}")), side)
    return pairs.filter(_open("n_a", "n_b", "s_a", "s_b")).select("a", "b").distinct()


def _open(n_a: str, n_b: str, s_a: str, s_b: str) -> Column:
    differ = F.lit(0)
    for i in range(COORDINATES // 16):
        v = F.get(s_a, F.lit(i)).bitwiseXOR(F.get(s_b, F.lit(i)))
        v = v.bitwiseOR(F.shiftrightunsigned(v, 1))
        v = v.bitwiseOR(F.shiftrightunsigned(v, 2)).bitwiseAND(F.lit(0x1111111111111111))
        differ = differ + F.bit_count(v)
    return ((F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * THRESHOLD_PERCENT) & (differ <= SKETCH_MOST))


def _few_ids(ids: DataFrame) -> DataFrame:
    """``ids`` (stored, one column) for a join with texts: broadcast if they are at most ``BROADCAST_IDS``."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _shingle_sets(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, shingles), stored: the full sets of the documents that ``nodes`` (stored, distinct) names. The ids are
    broadcast if they are at most ``BROADCAST_IDS``, which leaves the texts where they are."""
    texts = docs.select(F.col("doc_id").alias("node"), text_or_empty().alias("text")).join(_few_ids(nodes), "node", "left_semi")
    return stored(texts.mapInArrow(_sets, "node long, shingles array<long>"), "near-dup-sets")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The links among ``pairs``: exact Jaccard on the full shingle sets."""
    both = (pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b"))
    common = F.size(F.array_intersect("x", "y"))
    return both.select("a", "b", common.alias("c"), (F.size("x") + F.size("y")).alias("n")).filter(
        F.col("c") * 100 >= (F.col("n") - F.col("c")) * THRESHOLD_PERCENT).select("a", "b").distinct()


def components(links: DataFrame, name: str = "near-dup-labels") -> DataFrame:
    """(node, label): the smallest node of the component of every node that a link (a, b) names."""
    edges = stored(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
                   "near-dup-edges")
    labels = stored(edges.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("label")), name)
    while True:
        near = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("label").alias("near"))
        step = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("beyond"))
        new = stored(step.join(jump, "next").select(
            "node", F.col("beyond").alias("label"), (F.col("beyond") < F.col("label")).alias("moved")), name)
        labels = new.select("node", "label")
        if new.filter("moved").isEmpty():
            return labels


def classes_of(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): per document its set key, and per distinct set its smallest doc_id, bands and sketch."""
    rows = stored(docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(
        _signed, "doc_id long, n_shingles long, set_key binary, bands array<long>, sketch array<long>"), "near-dup-rows")
    classes = rows.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(
        "set_key", "n_shingles", "bands", "sketch").agg(F.min("doc_id").alias("node"))
    return rows, stored(classes, "near-dup-classes")


def links_of(docs: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(links, labels): links (a, b) between classes that join everything the threshold joins, and the component of
    every class that has a link."""
    members = classes.select("node", F.explode("bands").alias("key"))
    pivots = members.groupBy("key").agg(
        F.min(F.struct(F.xxhash64("node", "key"), "node")).alias("p"), F.count("*").alias("n")).filter("n > 1")
    pivots = stored(pivots.select("key", F.col("p.node").alias("pivot")), "near-dup-pivots")
    shared = stored(members.join(pivots, "key"), "near-dup-members")  # members of buckets that hold several
    sets = _shingle_sets(stored(shared.select("node").distinct(), "near-dup-nodes"), docs)
    # A document that goes by several texts meets itself in no pair.
    to_pivot = shared.filter("node <> pivot").select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b"))
    first = stored(_pairs_left(to_pivot.distinct(), classes), "near-dup-pairs")
    links = stored(_verified(first, sets), "near-dup-links")
    labels = components(links)

    # Buckets that still hold several components: members outside the largest one meet all members of another one.
    named = shared.select("key", "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    per = named.groupBy("key", "label").agg(F.count("*").alias("n"))
    several = stored(per.groupBy("key").agg(F.max(F.struct("n", "label")).alias("top"), F.count("*").alias("labels"))
                     .filter("labels > 1").select("key", F.col("top.label").alias("main")), "near-dup-open")
    inside = stored(named.join(several, "key"), "near-dup-open-members")
    nodes = inside.select("node", "label").distinct()
    # Shingles of one component only bound what its documents can share with those of another one.
    tokens = sets.join(nodes, "node").select("node", "label", F.explode("shingles").alias("s"))
    across = tokens.groupBy("s").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi").select("s")
    common = tokens.select("node", "s").join(across, "s", "left_semi").groupBy("node").agg(F.count("*").alias("common"))
    facts = stored(classes.select("node", "n_shingles", "sketch", "bands").join(nodes, "node", "left_semi").join(
        common, "node", "left").withColumn("common", F.coalesce("common", F.lit(0))), "near-dup-facts")
    inside = inside.join(facts, "node")
    columns = ("node", "label", "n_shingles", "common", "sketch", "bands")
    x = inside.filter("label <> main").select("key", *[F.col(c).alias(f"x_{c}") for c in columns])
    y = inside.select("key", "main", *[F.col(c).alias(f"y_{c}") for c in columns])
    most = F.least("x_common", "y_common")
    meet = x.join(y, "key").filter(
        (F.col("x_label") != F.col("y_label")) & ((F.col("y_label") == F.col("main")) | (F.col("x_node") < F.col("y_node")))
        & (most * 100 >= (F.col("x_n_shingles") + F.col("y_n_shingles") - most) * THRESHOLD_PERCENT)
        & _open("x_n_shingles", "y_n_shingles", "x_sketch", "y_sketch")
        & (F.array_min(F.array_intersect("x_bands", "y_bands")) == F.col("key")))
    second = meet.select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).distinct()
    second = stored(second.join(first, ["a", "b"], "left_anti"), "near-dup-more-pairs")
    if second.isEmpty():
        return links, labels
    links = stored(links.union(_verified(second, sets)), "near-dup-all-links")
    return links, components(links)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept, n_links (links of its class to other texts that
    were needed or found) and set_key."""
    rows, classes = classes_of(docs)
    links, labels = links_of(docs, classes)
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("n_links"))
    found = stored(classes.select("set_key", "node").join(labels, "node", "left").join(degree, "node", "left").select(
        F.col("set_key").alias("k"), F.coalesce("label", "node").alias("component"), F.coalesce("n_links", F.lit(0)).alias("n_links")),
        "near-dup-components")
    out = rows.select("doc_id", "n_shingles", "set_key").join(found, F.col("set_key") == F.col("k"), "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
                      F.coalesce("n_links", F.lit(0)).alias("n_links"), "set_key")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component of ``docs``, the one with the smallest doc_id, with its columns; rows without shingles or
    doc_id all stay. Of a doc_id's different texts, all but one count as documents of their own that come after all others,
    so that no text goes for another one's copies."""
    rows = packed(docs).withColumns({"doc_id": F.col("q_doc.doc_id"), "text_key": F.xxhash64("q_doc.text")})
    ids = rows.filter("doc_id IS NOT NULL").select("doc_id", "text_key")
    several = ids.groupBy("doc_id").agg(F.min("text_key").alias("first"), F.max("text_key").alias("last")).filter("first <> last")
    more = stored(ids.join(several, "doc_id").filter("text_key <> first").select("doc_id", "text_key").distinct(), "near-dup-more-texts")
    if not more.isEmpty():
        top = ids.agg(F.max("doc_id").alias("top"))  # one row
        named = stored(more.crossJoin(F.broadcast(top)).withColumn("own_id", F.col("top") + 1 + F.monotonically_increasing_id()),
                       "near-dup-own-ids").drop("top")
        rows = rows.join(named, ["doc_id", "text_key"], "left").withColumn("doc_id", F.coalesce("own_id", "doc_id"))
    found = stored(near_duplicates(rows.select("doc_id", F.col("q_doc.text").alias("text"))), "near-dup-result")
    gone = stored(found.filter("NOT kept").select("doc_id").distinct(), "near-dup-gone")
    rest = rows.join(_few_ids(gone), "doc_id", "left_anti")
    # Rows that repeat a kept document: one of them stays.
    again = stored(found.filter("kept AND n_shingles > 0 AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.count("*").alias("n")).filter("n > 1").select("doc_id"), "near-dup-again")
    if not again.isEmpty():
        again = _few_ids(again)
        repeated = rest.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id"])
        rest = rest.join(again, "doc_id", "left_anti").unionByName(repeated)
    return unpacked(rest, docs.columns)


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("set_key")


QUERIES = {"op4_minhash_near_dedup": op4_minhash_near_dedup}

#: Brute force over all pairs of distinct texts that share a shingle. n_links is not part of the contract.
BRUTE_FORCE_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, g FROM (SELECT doc_id, w[i : i + 4] AS g FROM (
  SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, CASE WHEN len(w) > 0 THEN 1 ELSE 0 END) + 1)) AS i FROM d))),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id AS node, doc_id AS other FROM d UNION SELECT r.node, e.b FROM r JOIN e ON r.other = e.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, c.component_id = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT node, min(other) AS component_id FROM r GROUP BY node) c ON c.node = d.doc_id"""
