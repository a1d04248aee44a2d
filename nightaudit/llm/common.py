"""Helpers shared by the text operators: table readers, stored intermediates, text expressions."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nightaudit.session import ensure_checkpoint_dir

#: The ASCII letters that the word contracts fold.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: Words of the quality and near-duplicate contracts stand between these characters.
SPACE_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder that ``spark.checkpoint.dir`` gives."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/nightaudit-llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage, survives lost executors, and later readers prune columns."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def packed(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` as one struct column, q_doc: no name of theirs can clash with an operator's own."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("q_doc"))


def unpacked(rows: DataFrame, columns: list[str], text: Column | None = None) -> DataFrame:
    """The given columns out of q_doc, with ``text`` in the place of the text if given."""
    return rows.select(*[text.alias("text") if c == "text" and text is not None else F.col(f"q_doc.`{c}`").alias(c)
                         for c in columns])


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def ascii_lower(col: Column) -> Column:
    return F.translate(col, UPPER, LOWER)


def words_of(col: Column, separators: str) -> Column:
    """The words of a non-null text; ``separators`` is a pattern of one or more separating characters."""
    return F.array_remove(F.split(col, separators), "")


def ngram_hashes(df: DataFrame, words: str, lengths: list[int], prefix: str,
                 fold: bool = False) -> DataFrame:
    """Adds, for each length k, an array column <prefix><k>: 64-bit hashes of all windows of k words, in order;
    with ``fold``, without regard to case.

    Windows of 1, 2, 4, ... words are hashed by doubling and a length is put together from its binary digits, so a
    window costs a few hash steps whatever its length; no window is cut out of the text."""
    n = F.size(words)
    out = df.withColumn(f"{prefix}_p1", F.transform(words, lambda w: F.xxhash64(F.lower(w) if fold else w)))
    powers = [1]
    while powers[-1] * 2 <= max(lengths, default=1):
        powers.append(powers[-1] * 2)

    def pair(a: str, b: str, apart: int) -> Column:  # the last places, which lack words, are cut off at the end
        return F.zip_with(a, F.slice(b, F.lit(1 + apart), F.greatest(n, F.lit(0))), lambda x, y: F.xxhash64(x, y))

    for p in powers[1:]:
        out = out.withColumn(f"{prefix}_p{p}", pair(f"{prefix}_p{p // 2}", f"{prefix}_p{p // 2}", p // 2))
    for k in lengths:
        digits = [p for p in reversed(powers) if k & p]
        at = digits[0]
        made = f"{prefix}_p{at}"
        for i, p in enumerate(digits[1:]):
            name = f"{prefix}_{k}_{i}"
            out = out.withColumn(name, pair(made, f"{prefix}_p{p}", at))
            made, at = name, at + p
        out = out.withColumn(f"{prefix}{k}", F.slice(made, F.lit(1), F.greatest(n - (k - 1), F.lit(0))))
    return out.drop(*[c for c in out.columns if c.startswith(f"{prefix}_")])
