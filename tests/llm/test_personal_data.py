import hashlib
import math
import re

import pytest
from pyspark.sql import functions as F

from nightaudit.llm import personal_data as P


def base_spans(t):
    """The contract's patterns as they are written."""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in m.group() if c.isdigit()]
        if 16 <= len(d) <= 19 and sum(sum(divmod(2 * x, 10)) if i % 2 else x for i, x in enumerate(reversed(d))) % 10 == 0:
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t)
                  if 8 <= sum(c.isdigit() for c in m.group()) <= 15]


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def digested(spark, docs_df):
    rows = P.scan(docs_df).withColumn("base", F.filter("spans", lambda x: x["kind"] < P.BASE))
    return rows.select("doc_id", P._joined("base").alias("base"), P._joined("spans").alias("spans")).collect()


HOSTILE = [
    "a@b@c.de x@y.z_w@v.u é.q@é.de 𝒳 a.b+c%d@h-o.st. z@.de @a.b a@b a@b.c.", "1.2.3.4.5.6.7.8.9 256.1.1.1 1.2.3 001.02.3.0004 9.9.9.9",
    "4111 1111 1111 1111 4111-1111-1111-1112 4111  1111 5 4111111111111111-4111111111111111 41111111111111110004",
    "+1 (555) 010-9999 +12 +123-456-78-90-12-34-56-7890 +(1)234 +4930 123456-+49301234567 ++1 2345678", "a@b.c,1.1.1.1;+123456789",
    "1" * 16 + " " + "0" * 16 + "-0" + " 0" * 30, "x" * 50_000, "1" * 50_000, "1." * 20_000, "+1" + "(" * 30_000, "a@b." * 9_000,
    "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1", "(at) at dot [dot] 1-2 - Mr Mrs. Dr", "12345678901234567890 4111111111111111", "\n".join(["a.b@c.de"] * 900)]


def test_base_spans_equal_the_contract(spark, docs, edge_rows):
    rows = edge_rows + [(100 + i, t, "en", "a") for i, t in enumerate(HOSTILE)]
    want = sorted((str(i), joined(base_spans(t or ""))) for i, t, _, _ in rows)
    got = digested(spark, docs(rows))
    assert sorted((str(r.doc_id), r.base) for r in got) == want
    assert digested(spark, docs([])) == []


PLANTED = {"mail": "jane.doe (at) firma (dot) de", "tel": "(030) 555 12 34", "ssn": "123-45-6789", "iban": "DE89 3704 0044 0532 0130 00",
           "name": "Frau Sabine Müller"}
CUE = {"mail": "mail:", "tel": "tel:", "ssn": "ssn:", "iban": "IBAN:", "name": "signed:"}
CLEAN = ["version 10-20-3000 of 2024", "invoice 123 456 789 012", "ref DE88 3704 0044 0532 0130 00", "look at home and dot the letters",
         "isbn 978-3-16-148410-0", "100 200 300", "1000 2000 3001 4000", "order 000-12-3456", "page 12.30 to 14.45", "Mr. President spoke", "the Dr said so"]


@pytest.fixture
def corpus(docs):
    rows = [(i, f"well known words, {CUE[k]} {PLANTED[k]} and more words", "en", "a") for i, k in enumerate(list(PLANTED) * 12)]
    rows += [(1000 + i, f"plain words before {CLEAN[i % len(CLEAN)]} and plain words after", "en", "a") for i in range(90)]
    rows += [(2000 + i, f"write to mail: user{i}@host{i % 3}.example.com or phone: +49 30 55512{i:02d}", "en", "a") for i in range(40)]
    return docs(rows)


def test_planted_data_is_added_and_clean_texts_are_not(spark, corpus):
    got = {r.doc_id: (r.base, r.spans) for r in digested(spark, corpus)}
    texts = {r.doc_id: r.text for r in corpus.collect()}
    for i, k in enumerate(list(PLANTED) * 12):
        at = texts[i].index(PLANTED[k])
        assert got[i] == ("", f"{k}:{at}:{at + len(PLANTED[k])}"), (i, texts[i], got[i])
    assert {i: got[i] for i in got if 1000 <= i < 2000 and got[i][1]} == {}
    assert all(got[i][0] == got[i][1] and got[i][0].count(":") == 4 for i in got if i >= 2000)


def test_redaction_keeps_columns_and_clean_rows(corpus):
    d = corpus.withColumns({"spans": F.lit("s"), "q_pii": F.lit(1), "code": F.lit(2), "row_key": F.lit(3)})
    out = P.redact(d)
    assert out.columns == d.columns
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[0] == "well known words, mail: [MAIL] and more words" and texts[2001] == "write to mail: [EMAIL] or phone: [PHONE]"
    assert texts[1000] == f"plain words before {CLEAN[0]} and plain words after"
    assert P.scan(d).count() == d.count()


def test_em_and_classifier_equal_brute_force(spark, corpus):
    found = P.proposals(corpus).filter("kind >= 0 AND (good OR kind <> 5)").cache()
    rows = found.collect()
    n, m = len(P.LABELERS), len(P.KINDS)
    votes = [[r.code // 3 ** (n - 1 - j) % 3 - 1 for j in range(n)] for r in rows]

    def posteriors(right, wrong, prior):
        out = []
        for r, v in zip(rows, votes):
            z = math.log(prior[r.kind] / (1 - prior[r.kind]))
            for j, x in enumerate(v):
                z += math.log(right[j] / (1 - wrong[j])) if x == 1 else math.log((1 - right[j]) / wrong[j]) if x == -1 else 0
            out.append(1 / (1 + math.exp(-z)))
        return out

    start = list(P.LABELERS.values())
    right, wrong, prior = start, start, [0.5] * m
    for _ in range(12):  # over single proposals, not over the table of patterns
        q = posteriors(right, wrong, prior)
        right = [(sum(p for p, v in zip(q, votes) if v[j] == 1) + 10 * start[j]) / (sum(p for p, v in zip(q, votes) if v[j]) + 10)
                 for j in range(n)]
        wrong = [(sum(1 - p for p, v in zip(q, votes) if v[j] == -1) + 10 * start[j]) / (sum(1 - p for p, v in zip(q, votes) if v[j]) + 10)
                 for j in range(n)]
        prior = [(sum(p for p, r in zip(q, rows) if r.kind == k) + 1) / (sum(r.kind == k for r in rows) + 2) for k in range(m)]
    q = posteriors(right, wrong, prior)
    p = P.with_reliabilities(found.groupBy("kind", "code").agg(F.count("*").alias("n"))).first()["p"]
    assert p["right"] == pytest.approx(right) and p["wrong"] == pytest.approx(wrong) and p["prior"] == pytest.approx(prior)

    size = m * P.FEATURES * P.VALUES
    on, off = [0.0] * size, [0.0] * size
    kind_on, kind_off = [0.0] * m, [0.0] * m
    for r, x in zip(rows, q):
        kind_on[r.kind] += x
        kind_off[r.kind] += 1 - x
        for at in r.features:
            on[at] += x
            off[at] += 1 - x
    weight = [math.log((on[i] + 1) / (off[i] + 1)) - math.log(
        (kind_on[i // (P.FEATURES * P.VALUES)] + P.VALUES) / (kind_off[i // (P.FEATURES * P.VALUES)] + P.VALUES)) for i in range(size)]
    want = sorted((r.kind, r.code, round(math.log((kind_on[r.kind] + 1) / (kind_off[r.kind] + 1)) + sum(weight[i] for i in r.features), 3))
                  for r in rows)
    got = sorted((r.kind, r.code, round(r.odds, 3)) for r in P.scored(P.stored(P.proposals(corpus), "t")).filter("kind >= 0 AND (good OR kind <> 5)").collect())
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want], abs=2e-3)


def test_query_over_the_given_documents(spark):
    sf = "/root/testdata/sf0.001"
    texts = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        texts.setdefault(r.doc_id, []).append(joined(base_spans(r.text or "")))
    for r in P.op13_pii(spark, sf).collect():
        own = [x for x in texts[r.doc_id] if hashlib.sha256(x.encode()).hexdigest() == r.base_sha256]
        assert own and r.n_email + r.n_ip + r.n_card + r.n_phone == len(own[0].split(",")) * bool(own[0])
