"""Target-distribution importance resampling over hashed word n-grams.

A text's UTF-8 bytes are translated by a 256-byte table that lower-cases A-Z and blanks every separator, ``bytes.split``
yields the words, and zlib's crc32 hashes them; a longer n-gram's hash goes on from the hash of the n-gram that is one word
shorter (chained seeds), so no n-gram is ever joined. Counters reduce the hashes to buckets within a task, and Spark sums
``buckets`` numbers per task, whatever the texts hold.

Two passes over the texts: the first counts the buckets of all documents and of the target, from which each bucket's gain
follows; the second sums the gains of each document's features. Gumbel noise, seeded by the document's id, is added, and
the documents with the highest scores are drawn, which is sampling without replacement in proportion to the weights.

The draw sorts no table in one task. A score is an integer between the least and the greatest gain plus the noise of a
32-bit number, so there are at most some 200,000 different ones: a histogram of the scores gives every score's first rank,
and only the drawn rows of one score are put in order of their ids. The noise spreads different ids over thousands of
scores; rows that repeat an id are counted before they are ordered.

Defined results: a null or empty text has no words, weight 0 and is never drawn; a null id is seeded as an empty string
and comes before all others in a tie; repeated rows are scored and ranked row by row; an empty table gives an empty result;
an empty target leaves every text to the documents' own distribution; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nightaudit.llm.common import stored, table

NGRAM = 1
BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 10
SEED = 2024

#: Digits, letters (in lower case) and all bytes of longer characters stay; every other byte becomes a blank.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(TABLE).split() if text else []


def gram_hashes(own: list[bytes], n: int) -> Iterator[int]:
    """crc32 of all runs of 1 to ``n`` consecutive words, joined by one space."""
    level = list(map(zlib.crc32, own))
    yield from level
    spaced = [b" " + w for w in own] if n > 1 else []
    for k in range(1, n):
        level = list(map(zlib.crc32, islice(spaced, k, None), level))
        yield from level


def _counts(batches: Iterator[pa.RecordBatch], n: int, buckets: int) -> Iterator[pa.RecordBatch]:
    sums: dict[int, Counter] = {}
    for b in batches:
        for side, text in zip(b.column(0).to_pylist(), b.column(1)):
            own = words(text.as_py())
            sums.setdefault(side, Counter()).update(h % buckets for h in gram_hashes(own, n))
    for side, c in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([side] * len(c), pa.int32()), pa.array(c.keys(), pa.int32()), pa.array(c.values(), pa.int64())],
            names=["side", "bucket", "n"])


def bucket_gains(docs: DataFrame, target: DataFrame, n: int = NGRAM, buckets: int = BUCKETS) -> list[int]:
    """Per bucket, the log ratio of the target's share to the documents' share, in thousandths, smoothed by one feature
    a bucket. The counts, ``buckets`` rows at most, come to the driver."""
    texts = docs.select(F.lit(0).alias("side"), "text").unionAll(target.select(F.lit(1).alias("side"), "text"))
    sums = texts.mapInArrow(lambda it: _counts(it, n, buckets), "side int, bucket int, n long").groupBy("bucket").agg(
        *[F.sum(F.when(F.col("side") == k, F.col("n")).otherwise(0)).alias(name) for k, name in enumerate("st")])
    found = {r["bucket"]: (r["s"], r["t"]) for r in sums.collect()}
    s_all, t_all = (sum(x[k] for x in found.values()) for k in (0, 1))
    gains = []
    for b in range(buckets):
        s, t = found.get(b, (0, 0))
        gains.append(math.floor(1000 * math.log(
            float(t + 1) * float(s_all + buckets) / (float(s + 1) * float(t_all + buckets)))))
    return gains


def _totals(batches: Iterator[pa.RecordBatch], gains: list[int], n: int) -> Iterator[pa.RecordBatch]:
    buckets = len(gains)
    for b in batches:
        sizes, features, totals = [], [], []
        for text in b.column(1):
            own = words(text.as_py())
            c = Counter(gram_hashes(own, n))
            sizes.append(len(own))
            features.append(c.total())
            totals.append(sum(gains[h % buckets] * k for h, k in c.items()))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(sizes, pa.int64()), pa.array(features, pa.int64()), pa.array(totals, pa.int64())],
            names=["doc_id", "n_words", "n_features", "total"])


def _noise(doc_id: Column, seed: int) -> Column:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(F.log(-F.log(u)) * -1000.0)


def scores(docs: DataFrame, target: DataFrame, n: int = NGRAM, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_features, weight (floored mean gain) and score (weight plus noise)."""
    gains = bucket_gains(docs, target, n, buckets)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        lambda it: _totals(it, gains, n), "doc_id long, n_words long, n_features long, total long")
    weight = F.when(F.col("n_features") > 0, F.expr("(total - pmod(total, n_features)) div n_features")).otherwise(0)
    return rows.withColumn("weight", weight.cast("long")).select(
        "doc_id", "n_words", "n_features", "weight", (F.col("weight") + _noise(F.col("doc_id"), seed)).alias("score"))


def with_ranks(scored: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """``scored`` (a stored table, as it is read three times) with rank: 1, 2, 3... for the drawn rows, else null."""
    able = scored.filter(F.col("n_words") >= min_words)
    higher = Window.orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, -1)  # one row per score
    starts = able.groupBy("score").agg(F.count("*").alias("n")).select(
        F.col("score").alias("s_score"), F.coalesce(F.sum("n").over(higher), F.lit(0)).alias("s_before"), "n")
    starts = stored(starts, "resampling-scores")
    total = starts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    draws = total * percent // 100
    starts = F.broadcast(starts.filter(F.col("s_before") < draws).drop("n"))  # bounded by the range of scores
    chosen = (F.col("n_words") >= min_words) & F.col("s_before").isNotNull()
    marked = scored.join(starts, F.col("score") == F.col("s_score"), "left")
    same = ["doc_id", "n_words", "n_features", "weight", "score", "s_before"]
    earlier = Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_first(), "n_features", "n_words").rowsBetween(
        Window.unboundedPreceding, -1)
    drawn = marked.filter(chosen).groupBy(*same).agg(F.count("*").alias("copies")).withColumn(
        "first", F.col("s_before") + F.coalesce(F.sum("copies").over(earlier), F.lit(0)) + 1).withColumn(
        "rank", F.explode(F.sequence("first", F.col("first") + F.col("copies") - 1))).withColumn(
        "rank", F.when(F.col("rank") <= draws, F.col("rank")))
    rest = marked.filter(~chosen).withColumn("rank", F.lit(None).cast("long"))
    out = ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    return drawn.select(*out).unionByName(rest.select(*out))


def resample(docs: DataFrame, target: DataFrame, n: int = NGRAM, buckets: int = BUCKETS, seed: int = SEED,
             percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_features, weight, score, rank (null where not drawn)."""
    return with_ranks(stored(scores(docs, target, n, buckets, seed), "resampling-rows"), percent, min_words)


def drawn_documents(docs: DataFrame, ranked: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is drawn in ``ranked``, the result of :func:`resample`, with all their columns."""
    ids = ranked.filter("rank IS NOT NULL").select(F.col("doc_id").alias("q_drawn_id")).distinct()
    return docs.join(ids, docs["doc_id"].eqNullSafe(F.col("q_drawn_id")), "left_semi")


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return ranked.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {"op11_importance_resampling": op11_importance_resampling}

#: DuckDB has no crc32: the table of 256 remainders, and a fold over the hexadecimal digits of the bytes.
CRC_TABLE_SQL = """steps(i, k, v) AS (SELECT i, 0, i FROM range(256) r(i) UNION ALL
  SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM steps WHERE k < 8),
crc AS (SELECT list(v ORDER BY i) AS t FROM steps WHERE k = 8)"""


def crc32_sql(text: str, remainders: str) -> str:
    """DuckDB SQL: the unsigned crc32 of a text's UTF-8 bytes."""
    digit = "strpos('0123456789ABCDEF', substr(hex(encode({0})), {1}, 1)) - 1"
    byte = f"16 * ({digit.format(text, '2 * j - 1')}) + {digit.format(text, '2 * j')}"
    return (f"xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, octet_length(encode({text})) + 1), "
            f"lambda j: CAST({byte} AS BIGINT))), lambda c, b: xor(c >> 8, {remainders}[(xor(c, b) & 255) + 1])), 4294967295)")


ORACLE_SQL = {"op11_importance_resampling": f"""
WITH RECURSIVE {CRC_TABLE_SQL},
d AS (SELECT row_number() OVER () AS rid, doc_id,
      regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                         '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w FROM documents),
b AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                         '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w FROM benchmark),
dw AS (SELECT rid, w, count(*) AS n FROM (SELECT rid, unnest(w) AS w FROM d) GROUP BY ALL),
bw AS (SELECT w, count(*) AS n FROM (SELECT unnest(w) AS w FROM b) GROUP BY ALL),
vocabulary AS MATERIALIZED (SELECT w, {crc32_sql('w', 'crc.t')} % {BUCKETS} AS k
      FROM (SELECT w FROM dw UNION SELECT w FROM bw), crc),
s AS (SELECT k, sum(n) AS n FROM dw JOIN vocabulary USING (w) GROUP BY k),
t AS (SELECT k, sum(n) AS n FROM bw JOIN vocabulary USING (w) GROUP BY k),
al AS (SELECT coalesce((SELECT sum(n) FROM s), 0)::DOUBLE AS s, coalesce((SELECT sum(n) FROM t), 0)::DOUBLE AS t),
gain AS (SELECT k, floor(1000 * ln((coalesce(t.n, 0)::DOUBLE + 1) * (al.s + {BUCKETS})
      / ((coalesce(s.n, 0)::DOUBLE + 1) * (al.t + {BUCKETS}))))::BIGINT AS g
      FROM (SELECT DISTINCT k FROM vocabulary) LEFT JOIN s USING (k) LEFT JOIN t USING (k), al),
f AS (SELECT rid, sum(n * g)::BIGINT AS total FROM dw JOIN vocabulary USING (w) JOIN gain USING (k) GROUP BY rid),
x AS (SELECT rid, doc_id, len(w)::BIGINT AS n_features,
      CASE WHEN len(w) = 0 THEN 0 ELSE floor(total::DOUBLE / len(w))::BIGINT END AS weight,
      (('0x' || substr(sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT::DOUBLE + 0.5) / 4294967296 AS u
      FROM d LEFT JOIN f USING (rid)),
y AS (SELECT *, (weight + floor(-1000 * ln(-ln(u))))::BIGINT AS score FROM x),
z AS (SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST, n_features) AS r,
      count(*) OVER () AS n FROM y WHERE n_features >= {MIN_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN r <= {PERCENT} * n // 100 THEN r END AS rank FROM y LEFT JOIN z USING (rid)"""}
