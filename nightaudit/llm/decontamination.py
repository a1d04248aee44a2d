"""Benchmark decontamination: broadcast hash set of normalised test n-grams, token-window scan, verified hits.

Every benchmark item is lower-cased (A-Z) and cut into windows of ``n`` consecutive words; an item with fewer words
is one window. The windows, keyed by a 64-bit hash of their first ``HEAD`` words, are broadcast. One scan over the
documents hashes the ``HEAD`` words at every place, probes the broadcast set, and where a hash is found compares all
words of the window, so a hash collision or a common opening is never a hit. Only hits and one marker row per document leave the scan: the
shuffle carries a few narrow rows per document and no text. A benchmark beyond ``MAX_BROADCAST_WINDOWS`` is taken in
blocks of that size, one scan of the documents per block; the result is the same.

Defined results: a null or empty text has no words and no hits; null or wordless items have no window; an empty
benchmark hits nothing; repeated rows are judged row by row; item ids are compared as strings; other columns of the
inputs are ignored by :func:`hits` and kept by :func:`remove_documents` and :func:`remove_spans`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nightaudit.llm.common import ascii_lower, ngram_hashes, packed, stored, table, text_or_empty, unpacked, words_of

#: Words stand between these characters; A-Z are lower-cased, so they are no separators.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 13
#: Words of a window that are hashed; enough that a common phrase at the start of many items finds few windows.
HEAD = 8
#: Most benchmark windows in one broadcast (some 200 bytes each).
MAX_BROADCAST_WINDOWS = 1_000_000
#: Most keys of contaminated rows (16 bytes each) in a broadcast.
MAX_BROADCAST_KEYS = 1_000_000
#: Key of the marker that gives each document one row of its own.
MARKER = "xxhash64('one row for each document')"


def _words(col: str = "text") -> Column:
    """Words as written. Hashes are taken of ``lower(word)``, which is fast and folds at least A-Z; where a hash is
    found, the words are compared with A-Z folded and nothing else."""
    return words_of(text_or_empty(col), SEPARATORS)


def benchmark_windows(benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """(h, head, k, w, items): the distinct windows, the hash of their first ``head`` words, their word count, words and
    the sorted ids of their items."""
    words = benchmark.select(F.col("item_id").cast("string").alias("item"), F.transform(_words(), ascii_lower).alias("words"))
    words = words.filter("size(words) > 0").withColumn("k", F.least(F.size("words"), F.lit(n)))
    windows = (words.select("item", "k", F.explode(F.expr("transform(sequence(1, size(words) - k + 1), "
                                                          "i -> slice(words, i, k))")).alias("w"))
               .groupBy("k", "w").agg(F.sort_array(F.collect_set("item")).alias("items")))
    heads = list(range(1, min(n, HEAD) + 1))
    own = F.coalesce(*[F.when(F.col("head") == k, F.get(f"g{k}", F.lit(0))) for k in heads])
    return (ngram_hashes(windows.withColumn("head", F.least("k", F.lit(HEAD))), "w", heads, "g", fold=True)
            .select(own.alias("h"), "head", "k", "w", "items"))


def _scan(docs: DataFrame, windows: DataFrame, lengths: list[int], longest: int, blocks: int) -> DataFrame:
    """(row_key, doc_id, text_key, n_words, start, k, items): one row per hit, and one with k = 0 per document."""
    text = docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.monotonically_increasing_id().alias("row_key"),
                       _words().alias("words"))
    if blocks > 1:  # the row keys must be the same in every scan
        text = stored(text, "decontamination-words")
    hashes = F.concat(*[f"g{k}" for k in lengths], F.array(F.expr(MARKER)))
    rows = (ngram_hashes(text, "words", lengths, "g", fold=True)
            .select("doc_id", "text_key", "row_key", "words", F.size("words").alias("n_words"), hashes.alias("hashes"))
            # never empty; the outer form keeps the optimizer from computing all hashes once more to test for that
            .select("doc_id", "text_key", "row_key", "words", "n_words", F.posexplode_outer("hashes").alias("at", "h")))
    # All head lengths share one array: a window's place in the text is its place there less what stands before.
    before, start = F.lit(0), F.lit(0)
    for k in lengths:
        start = F.when(F.col("head") == k, F.col("at") - before + 1).otherwise(start)
        before = before + F.greatest(F.col("n_words") - (k - 1), F.lit(0))
    rows = rows.withColumnRenamed("h", "row_h")
    parts = []
    for b in range(blocks):
        block = windows.filter(F.pmod(F.col("h"), F.lit(blocks)) == b) if blocks > 1 else windows
        if b == 0:
            block = block.unionByName(block.sparkSession.range(1).select(
                F.expr(MARKER).alias("h"), F.lit(0).alias("head"), F.lit(0).alias("k"), F.array().cast("array<string>").alias("w"),
                F.array().cast("array<string>").alias("items")))
        same = start > 0
        for i in range(longest):
            same = same & ((F.col("k") <= i) | (ascii_lower(F.get("words", start - 1 + i)) == F.get("w", F.lit(i))))
        found = (F.col("row_h") == F.col("h")) & ((F.col("k") == 0) | same)
        parts.append(rows.join(F.broadcast(block), found).select(
            "row_key", "doc_id", "text_key", "n_words", start.alias("start"), "k", "items"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def hits(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW,
         max_broadcast: int = MAX_BROADCAST_WINDOWS) -> DataFrame:
    """Per row of ``docs``: doc_id, text_key (64-bit hash of the text), n_words, hits (sorted array of start, k; start from 1), n_hit (words inside any
    hit), items (sorted ids, as strings, of the items with an occurring window)."""
    windows = benchmark_windows(benchmark, n)
    by_length = {r["k"]: r["n"] for r in windows.groupBy("k").agg(F.count("*").alias("n")).collect()}  # n rows at most
    blocks = max(1, -(-sum(by_length.values()) // max_broadcast))
    rows = _scan(docs, windows, sorted({min(k, HEAD) for k in by_length}), max(by_length, default=0), blocks)
    per_row = rows.groupBy("row_key", "doc_id", "text_key").agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.array_sort(F.collect_set(F.when(F.col("k") > 0, F.struct("start", "k")))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.when(F.col("k") > 0, F.col("items")))))).alias("items"))
    covered = F.expr("aggregate(hits, struct(0L AS n, 0 AS upto), (a, x) -> struct("
                     "a.n + greatest(x.start + x.k - 1 - greatest(a.upto, x.start - 1), 0) AS n, "
                     "greatest(a.upto, x.start + x.k - 1) AS upto), a -> a.n)")
    return per_row.select("doc_id", "text_key", "n_words", "hits", covered.alias("n_hit"), "items")


def contaminated() -> Column:
    return (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))


def remove_documents(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """``docs`` without the contaminated rows, its columns unchanged. Rows are found again by id and text; the texts stay
    where they are if the keys of the contaminated ones are at most ``MAX_BROADCAST_KEYS``."""
    bad = stored(hits(docs, benchmark, n).filter(contaminated()).select("doc_id", "text_key").distinct(), "decontamination-bad")
    bad = F.broadcast(bad) if bad.count() <= MAX_BROADCAST_KEYS else bad
    rest = packed(docs).join(bad, F.col("q_doc.doc_id").eqNullSafe(F.col("doc_id"))
                             & (F.xxhash64("q_doc.text") == F.col("text_key")), "left_anti")
    return unpacked(rest, docs.columns)


def remove_spans(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """(doc_id, text): the words of each row outside every hit, joined by one space; rows without hits keep their
    text as it is. A null text stays null."""
    found = (hits(docs, benchmark, n).filter("n_hit > 0")
             .select(F.col("doc_id").alias("_hit_id"), F.col("text_key").alias("_hit_text"), "hits")
             .dropDuplicates(["_hit_id", "_hit_text"]))
    rest = F.expr("array_join(transform(filter(sequence(1, size(_words)), i -> NOT exists(hits, "
                  "x -> i >= x.start AND i < x.start + x.k)), i -> _words[i - 1]), ' ')")
    joined = docs.select("doc_id", "text").join(found, F.col("doc_id").eqNullSafe(F.col("_hit_id"))
                                                & (F.xxhash64("text") == F.col("_hit_text")), "left")
    return (joined.withColumn("_words", _words())
            .select("doc_id", F.when(F.col("hits").isNull(), F.col("text")).otherwise(rest).alias("text")))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), contaminated().alias("contaminated"))


QUERIES = {"op9_decontamination": op9_decontamination}

_WORDS_SQL = r"""list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^0-9a-z\x{80}-\x{10FFFF}]+'), lambda x: x <> '')"""

ORACLE_SQL = {"op9_decontamination": f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS_SQL} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS_SQL} AS w FROM benchmark),
bk AS (SELECT item, w, least(len(w), {WINDOW}) AS k FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item, k, w[i : i + k - 1] AS win
       FROM (SELECT item, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM bk)),
ks AS (SELECT DISTINCT k FROM bk),
dw AS (SELECT rid, k, i, w[i : i + k - 1] AS win
       FROM (SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k)),
h AS (SELECT rid, i, dw.k, item FROM dw JOIN bw ON dw.k = bw.k AND dw.win = bw.win),
n AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + k)) AS p FROM h) GROUP BY rid),
it AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
       FROM (SELECT DISTINCT rid, item FROM h) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n USING (rid) LEFT JOIN it USING (rid)"""}
