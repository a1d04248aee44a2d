"""The pipeline's stages, each held against its operator's own answer or brute force on its own input."""

import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from nightaudit.llm import bpe, decontamination, near_dup, secrets
from nightaudit.llm.common import stored, table
from nightaudit.llm.near_dup import BRUTE_FORCE_SQL
from tools.compare import duck

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = table(spark, SF, "documents")
    columns, results = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), f"test-{name}")
        results.append(docs)
    good, single, clean, redacted, encoded = results
    assert all(r.columns == columns for r in results[:4])
    con = duck(SF)
    folder = good.inputFiles()[0].removeprefix("file://").rpartition("/")[0]
    con.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM read_parquet('{folder}/*.parquet')")
    want = {r[0] for r in con.execute(f"SELECT doc_id FROM ({BRUTE_FORCE_SQL}) WHERE kept").fetchall()}
    assert {r.doc_id for r in single.collect()} == want
    bad = decontamination.hits(single, table(spark, SF, "benchmark")).filter(decontamination.contaminated())
    assert {r.doc_id for r in clean.collect()} == want - {r.doc_id for r in bad.collect()}
    assert redacted.count() == clean.count() and secrets.scan(redacted).filter(
        F.exists("spans", lambda s: s["kind"].isin(1, 2))).count() == 0
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                            mergeable_ranks=bpe.load_ranks(public_tokenizers.path(bpe.RANKS)))
    ids = {r.doc_id: r.ids for r in encoded.collect()}
    assert ids == {r.doc_id: lib.encode_ordinary(r.text) for r in redacted.collect()}


def test_texts_are_not_moved_for_a_few_keys(spark):
    docs = table(spark, SF, "documents")
    results = [near_dup.keep_one(docs), decontamination.remove_documents(docs, table(spark, SF, "benchmark")), secrets.redact(docs)]
    for df in results:
        assert "Exchange hashpartitioning" not in df._jdf.queryExecution().executedPlan().toString()
