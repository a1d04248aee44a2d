"""Token counts as delta-maintained rollups with idempotent batch commits.

A :class:`TokenRollup` is a folder in the shared storage. A batch brings changes of documents' counts under a tokenizer
version: ``insert`` (a new count), ``delete`` (the count goes), ``revise`` (a new count takes the place of the old one,
also when source or language change). The batch's documents are looked up in the ledger of committed entries, and every
change becomes signed entries: minus what stood, plus what stands now. Their sums by source, language and tokenizer
version are the batch's delta. Totals are the sum of the deltas of committed batches, so they are never recounted.

Commits. Entries and deltas are written to the batch's own folders (overwriting what a failed attempt left), the commit
record last, and readers only look at committed batches. A batch id that is committed already is passed over, so a
batch can be sent again at any time. :meth:`compact` folds the committed deltas into one snapshot under a new name.

Scale. The ledger holds narrow entries, no texts; the lookup is an equi-join on (doc_id, version). Deltas are aggregated
before the shuffle, so a source with a third of all rows costs one row per task. Only batch ids come to the driver.

Defined results: a null source or language is a group of its own; a null or empty text counts zero tokens; of several
changes of one document and version in a batch, the one with the highest ``seq`` holds (ties: the larger count, then
delete); an insert of a known document acts as a revise, a revise of an unknown one as an insert, a delete of an
unknown one does nothing; rows without a doc_id are left out; an empty batch commits an empty delta.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nightaudit.llm.common import scratch_path, table, text_or_empty

CHANGE = "op string, doc_id long, source string, lang string, version string, n_tokens long, seq long"
_ENTRY = "doc_id long, version string, source string, lang string, n_tokens long, sign int, batch long"
_DELTA = "source string, lang string, version string, n_docs long, n_tokens long, batch long"
_KEYS = ["source", "lang", "version"]


class TokenRollup:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    # ---- commits

    def _folder_has(self, name: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def committed(self) -> list[tuple[int, bool]]:
        """(batch, is a snapshot) of the commit records, in order."""
        if not self._folder_has("commits"):
            return []
        rows = self.spark.read.schema("batch long, snapshot boolean").parquet(f"{self.folder}/commits/*")
        return sorted({(r["batch"], r["snapshot"]) for r in rows.collect()})  # one row per batch

    def _write(self, df: DataFrame, name: str) -> None:
        df.write.mode("overwrite").parquet(f"{self.folder}/{name}")

    def _commit(self, batch: int, snapshot: bool) -> None:
        record = self.spark.range(1).select(F.lit(batch).cast("long").alias("batch"), F.lit(snapshot).alias("snapshot"))
        self._write(record.coalesce(1), f"commits/{'snapshot' if snapshot else 'batch'}-{batch}")

    # ---- batches

    def _ledger(self, batches: list[int]) -> DataFrame:
        """What stands for each document and version: the last entry of the committed batches, if it is a plus."""
        if not batches:
            return self.spark.createDataFrame([], _ENTRY)
        rows = self.spark.read.schema(_ENTRY).parquet(*[f"{self.folder}/entries/batch-{b}" for b in batches])
        last = rows.groupBy("doc_id", "version").agg(F.max(F.struct(
            "batch", "sign", "n_tokens", "source", "lang")).alias("e"))
        return last.filter("e.sign > 0").select("doc_id", "version", "e.source", "e.lang", "e.n_tokens")

    def apply(self, batch: int, changes: DataFrame) -> bool:
        """Commit a batch of changes (columns as in ``CHANGE``; ``seq`` may be missing). False if it was committed."""
        done = [b for b, snapshot in self.committed() if not snapshot]
        if batch in done:
            return False
        if any(b > batch for b in done):
            raise ValueError(f"batch {batch} comes after a later one")
        if "seq" not in changes.columns:
            changes = changes.withColumn("seq", F.lit(0).cast("long"))
        newest = (changes.filter("doc_id IS NOT NULL").groupBy("doc_id", "version")
                  .agg(F.max(F.struct("seq", F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"),
                                      (F.col("op") == "delete").alias("gone"), "source", "lang")).alias("c"))
                  .select("doc_id", "version", "c.*"))
        old = self._ledger(done).select(F.col("doc_id").alias("o_id"), F.col("version").alias("o_version"),
                                        *[F.col(c).alias(f"o_{c}") for c in ("source", "lang", "n_tokens")])
        both = newest.join(old, (F.col("doc_id") == F.col("o_id")) & F.col("version").eqNullSafe(F.col("o_version")), "left")
        minus = F.struct(F.col("o_source").alias("source"), F.col("o_lang").alias("lang"),
                         F.col("o_n_tokens").alias("n_tokens"), F.lit(-1).alias("sign"))
        plus = F.struct("source", "lang", "n_tokens", F.lit(1).alias("sign"))
        entries = both.select("doc_id", "version", F.explode(F.array_compact(F.array(
            F.when(F.col("o_id").isNotNull(), minus), F.when(~F.col("gone"), plus)))).alias("x"))
        entries = entries.select("doc_id", "version", "x.source", "x.lang", "x.n_tokens", "x.sign",
                                 F.lit(batch).cast("long").alias("batch"))
        self._write(entries, f"entries/batch-{batch}")
        stored = self.spark.read.schema(_ENTRY).parquet(f"{self.folder}/entries/batch-{batch}")
        delta = stored.groupBy(*_KEYS).agg(F.sum("sign").cast("long").alias("n_docs"),
                                           F.sum(F.col("sign") * F.col("n_tokens")).cast("long").alias("n_tokens"))
        self._write(delta.withColumn("batch", F.lit(batch).cast("long")), f"deltas/batch-{batch}")
        self._commit(batch, False)
        return True

    # ---- totals

    def _delta_folders(self) -> list[str]:
        committed = self.committed()
        upto = max((b for b, snapshot in committed if snapshot), default=None)
        out = [f"{self.folder}/deltas/batch-{b}" for b, snapshot in committed
               if not snapshot and (upto is None or b > upto)]
        return out + ([f"{self.folder}/deltas/snapshot-{upto}"] if upto is not None else [])

    def totals(self) -> DataFrame:
        """(source, lang, version, n_docs, n_tokens) of what stands; groups without documents are left out."""
        folders = self._delta_folders()
        rows = (self.spark.read.schema(_DELTA).parquet(*folders) if folders else self.spark.createDataFrame([], _DELTA))
        return rows.groupBy(*_KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).filter(
            "n_docs <> 0")

    def compact(self) -> None:
        """Fold all committed deltas into one snapshot; batches committed later add to it."""
        batches = [b for b, snapshot in self.committed() if not snapshot]
        if batches:
            self._write(self.totals().withColumn("batch", F.lit(batches[-1]).cast("long")),
                        f"deltas/snapshot-{batches[-1]}")
            self._commit(batches[-1], True)


#: Tokenizer versions of the query: white-space words, and runs of letters or digits with single other signs.
VERSIONS = {"words-1": r"[^\x20\x09-\x0D]+", "pieces-2": r"[A-Za-z\x{80}-\x{10FFFF}]+|[0-9]+|[^\x20\x09-\x0D]"}


def _count(version: str) -> Column:
    return F.regexp_count(text_or_empty(), F.lit(VERSIONS[version])).cast("long")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after four batches over the whole documents table: all documents are inserted under both versions,
    documents labelled toxic are deleted, the documents of source src0 are revised to a source of their language
    (src0-<lang>), and the second batch is sent once more."""
    docs = table(spark, sf_dir, "documents")
    toxic = table(spark, sf_dir, "labels").filter("toxic = 1").select("doc_id").distinct()
    per_doc = docs.filter("doc_id IS NOT NULL").select("doc_id", "source", "lang", F.create_map(
        *[x for v in VERSIONS for x in (F.lit(v), _count(v))]).alias("counts"))
    inserts = per_doc.select(F.lit("insert").alias("op"), "doc_id", "source", "lang",
                             F.explode("counts").alias("version", "n_tokens"))
    rollup = TokenRollup(spark, scratch_path(spark, "token-rollup"))
    rollup.apply(1, inserts)
    standing = rollup._ledger([1]).select(F.lit("insert").alias("op"), "doc_id", "source", "lang", "version", "n_tokens")
    deletes = standing.join(toxic, "doc_id", "left_semi").withColumn("op", F.lit("delete"))
    rollup.apply(2, deletes)
    rollup.compact()
    revised = (standing.filter("source = 'src0'").join(toxic, "doc_id", "left_anti").withColumn("op", F.lit("revise"))
               .withColumn("source", F.concat_ws("-", "source", "lang")))
    rollup.apply(3, revised)
    rollup.apply(2, deletes)
    return rollup.totals()


QUERIES = {"op3_token_counts": op3_token_counts}

ORACLE_SQL = {"op3_token_counts": r"""
WITH d AS (SELECT doc_id, CASE WHEN source = 'src0' THEN concat_ws('-', source, lang) ELSE source END AS source, lang,
  coalesce(text, '') AS t FROM documents WHERE doc_id IS NOT NULL
  AND doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)),
v AS (SELECT source, lang, 'words-1' AS version, len(regexp_extract_all(t, '[^ \t\n\x0B\f\r]+')) AS n FROM d UNION ALL
  SELECT source, lang, 'pieces-2', len(regexp_extract_all(t, '[A-Za-z\x{80}-\x{10FFFF}]+|[0-9]+|[^ \t\n\x0B\f\r]')) FROM d)
SELECT source, lang, version, count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_tokens FROM v GROUP BY ALL"""}
