import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from nightaudit.llm import resampling as R

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(text, n):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))
    return w, [" ".join(w[i:i + k]) for k in range(1, n + 1) for i in range(len(w) - k + 1)]


def brute(docs, target, n=1, buckets=10_000, seed=2024, percent=10, min_words=20):
    def bucket(g):
        return zlib.crc32(g.encode()) % buckets
    s = Counter(bucket(g) for _, t in docs for g in grams(t, n)[1])
    t = Counter(bucket(g) for x in target for g in grams(x, n)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    rows = []
    for i, text in docs:
        w, g = grams(text, n)
        gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets))))
                for b in map(bucket, g)]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(w)])
    able = sorted((r for r in rows if r[4] >= min_words), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1]))
    drawn = able[:percent * len(able) // 100]
    return sorted((tuple(r[:4] + [next((k + 1 for k, d in enumerate(drawn) if d is r), None)]) for r in rows), key=repr)


def got(df):
    return sorted(map(tuple, df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


@pytest.mark.parametrize("n,buckets", [(1, 10_000), (3, 97)])
def test_equals_brute_force(spark, docs, edge_rows, n, buckets):
    rows = edge_rows + [(100 + i, " ".join(f"Wörd{(i * j) % 31}-x_{j % 7}" for j in range(i % 60)), "en", "a") for i in range(150)]
    rows += [(7, rows[-1][1], "en", "a")] * 40 + [(None, rows[-1][1], "en", "a")] * 30  # repeated rows and ids
    target = ["wörd3 x 5 and Wörd7", "x wörd3", None, ""]
    made = R.resample(docs(rows), spark.createDataFrame([(t,) for t in target], "text string"), n, buckets)
    assert got(made) == brute([(r[0], r[1]) for r in rows], target, n, buckets)


def test_ties_of_a_score_go_by_id(spark):
    rows = spark.createDataFrame([(i, 30, 30, 0, s) for i, s in [(5, 9), (3, 9), (3, 9), (9, 9), (None, 9), (1, 8), (2, 10)] * 5],
                                 "doc_id long, n_words long, n_features long, weight long, score long")
    ranks = sorted((r.rank, r.doc_id) for r in R.with_ranks(rows, percent=50).collect() if r["rank"])
    assert [i for _, i in ranks] == [2] * 5 + [None] * 5 + [3] * 7 and [k for k, _ in ranks] == list(range(1, 18))


def test_empty_tables(spark, docs):
    empty = spark.createDataFrame([], "text string")
    assert R.resample(docs([]), empty).count() == 0
    one = R.resample(docs([(1, "word " * 30, "en", "a")]), empty, percent=100).collect()
    assert one[0]["rank"] == 1


def test_a_target_like_one_source_draws_from_it(spark, docs):
    near, far = "red green blue yellow orange purple " * 5, "north south east west upward down " * 5
    rows = [(i, near if i % 2 else far, "en", "a") for i in range(200)]
    ranked = R.resample(docs(rows), spark.createDataFrame([(near,)], "text string"))
    drawn = {r.doc_id for r in ranked.filter("rank IS NOT NULL").collect()}
    assert len(drawn) == 20 and sum(i % 2 for i in drawn) >= 15
    assert {r.doc_id for r in R.drawn_documents(docs(rows), ranked).collect()} == drawn
