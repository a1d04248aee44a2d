"""Quality rules: base counts per text and robust multivariate outliers.

The base rule fails short texts and texts that repeat themselves. The method then looks at the texts that pass it:
a vector of transformed statistics per text (mean word length, symbols, capitals, duplicated lines, repeated words),
a minimum-covariance-determinant (MCD) estimate of centre and spread for every language and source, and rejection by
Mahalanobis distance.

The MCD is found by concentration steps, all of them grouped aggregates over the narrow statistics table: start at
medians and median absolute deviations, keep the ``KEEP_SHARE`` of each group that lies nearest, take mean and
covariance of those, repeat. The share is cut off at a bin edge of the distances (64 bins to a doubling), so a
threshold is a cumulative count over a bounded number of bins and never a sort of a group; a source with a third of
all rows is pre-aggregated before each shuffle like any other, and the estimates, one row per pool, are broadcast to the
rows after a check of their size. The covariance is factored (Cholesky) and each distance is a forward substitution, in
one fold over arrays, which keeps the plans small: the statistics are one array, and so are the sums of a step.

Two guards keep clean texts: every statistic has a least spread (``FLOOR``), without which a group where nine texts in
ten have no symbol at all would reject the tenth; and, as ratios over few words scatter more, the estimate has for each
statistic a variance that grows with 1 / words, the slope of a regression of the kept texts' squared deviations on it. A
text shorter than its group's mean is judged by the covariance that texts of its length have; the distance itself is the
plain squared Mahalanobis distance, in the steps as in the verdict.

Groups of fewer than ``MIN_GROUP`` texts are pooled by language, and what is then still too small is pooled over all;
a pool below ``MIN_GROUP`` has no estimate and its texts are judged by the base rule alone. Defined results: a null or
empty text has no words and fails the base rule; a null language or source is a group of its own; an empty table gives
an empty result; repeated rows are judged row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nightaudit.llm.common import SPACE_RUN, ngram_hashes, stored, table, text_or_empty, words_of
from nightaudit.operators.lookups import sized_broadcast

MIN_WORDS = 20
REPEAT_WINDOW = 8
KEEP_SHARE = 0.75
STEPS = 4
MIN_GROUP = 60
#: Least standard deviation of each statistic, in its transformed unit.
FLOOR = {"log_word_len": 0.08, "symbols": 0.045, "capitals": 0.06, "dup_lines": 0.15, "repeats": 0.12}
STATS = list(FLOOR)
#: Rejected above this squared distance: chi-square with 5 degrees of freedom exceeds it once in a million.
CUTOFF = 35.9
#: Share of the spread that the nearest KEEP_SHARE of a normal sample shows (5 dimensions); the estimate is divided by it.
CONSISTENCY = 0.707
BINS_PER_DOUBLING = 64

#: The characters that count as symbols.
SYMBOLS = "#*$%&|<>"


def _per_text(docs: DataFrame) -> DataFrame:
    """``docs`` with the base counts of each text (names start with q_)."""
    text = text_or_empty()
    out = docs.withColumn("q_words", words_of(text, SPACE_RUN)).withColumn("q_lines", F.filter(
        F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    out = out.withColumns({
        "q_n_words": F.size("q_words").cast("long"),
        "q_joined": F.array_join("q_words", ""),
        "q_n_lines": F.size("q_lines").cast("long"),
        "q_n_dup_lines": (F.size("q_lines") - F.size(F.array_distinct("q_lines"))).cast("long")})
    out = ngram_hashes(out, "q_words", [REPEAT_WINDOW], "q_windows").withColumnRenamed(
        f"q_windows{REPEAT_WINDOW}", "q_windows")
    out = out.withColumns({
        "q_word_chars": F.length("q_joined").cast("long"),
        "q_n_symbols": (F.length("q_joined") - F.length(F.regexp_replace("q_joined", f"[{SYMBOLS}]", ""))).cast("long"),
        "q_n_capitals": (F.length("q_joined") - F.length(
            F.regexp_replace("q_joined", "[A-Z]", ""))).cast("long"),
        # Windows in order of hash and place; only a text that has equal windows pays for the sort.
        "q_sorted": F.expr("IF(size(array_distinct(q_windows)) < size(q_windows), "
                           "sort_array(transform(q_windows, (h, i) -> struct(h, i))), NULL)")})
    out = out.withColumn("q_repeated", F.expr(
        "sort_array(transform(filter(q_sorted, (x, j) -> x.h = get(q_sorted, j - 1).h OR x.h = get(q_sorted, j + 1).h),"
        " x -> x.i))"))
    return out.withColumn("q_n_repeat_words", F.expr(
        "coalesce(aggregate(q_repeated, struct(0L AS n, 0 AS upto), (a, i) -> struct("
        f"a.n + i + {REPEAT_WINDOW} - greatest(a.upto, i) AS n, i + {REPEAT_WINDOW} AS upto), a -> a.n), 0L)")).drop(
        "q_words", "q_lines", "q_joined", "q_windows", "q_sorted", "q_repeated")


def _vector() -> dict[str, Column]:
    chars = F.greatest(F.col("q_word_chars"), F.lit(1)).cast("double")
    words = F.greatest(F.col("q_n_words"), F.lit(1)).cast("double")
    return {
        "log_word_len": F.log(chars / words),
        "symbols": F.sqrt(F.col("q_n_symbols") / chars),
        "capitals": F.sqrt(F.col("q_n_capitals") / chars),
        "dup_lines": F.sqrt(F.col("q_n_dup_lines") / F.greatest(F.col("q_n_lines"), F.lit(1))),
        "repeats": F.sqrt(F.col("q_n_repeat_words") / words),
    }


def base_failed() -> Column:
    return (F.col("q_n_words") < MIN_WORDS) | (F.col("q_n_repeat_words") * 100 > F.col("q_n_words") * 30)


def _pools(rows: DataFrame) -> DataFrame:
    """(g_lang, g_source, pool): the estimate that each language and source uses; null where there is none."""
    sizes = rows.filter(~F.col("q_base_failed")).groupBy("q_lang", "q_source").agg(F.count("*").alias("n"))
    small = F.col("n") < MIN_GROUP
    of_lang = F.sum(F.when(small, F.col("n"))).over(Window.partitionBy("q_lang"))
    left = sizes.withColumn("lang_n", of_lang)
    rest = left.filter(small & (F.col("lang_n") < MIN_GROUP)).agg(F.sum("n").alias("rest_n"))
    return left.crossJoin(F.broadcast(rest)).select(  # one row
        F.col("q_lang").alias("g_lang"), F.col("q_source").alias("g_source"),
        F.when(~small, F.to_json(F.array("q_lang", "q_source")))
        .when(F.col("lang_n") >= MIN_GROUP, F.to_json(F.array("q_lang")))
        .when(F.col("rest_n") >= MIN_GROUP, F.lit("[]")).alias("pool"))


def _at(i: int, j: int) -> int:
    """Place of (i, j), j <= i, in a lower triangle stored row by row."""
    return i * (i + 1) // 2 + j


def _per_word() -> Column:
    return F.lit(1.0) / F.greatest(F.col("q_n_words"), F.lit(1))


def _doubles(values) -> str:
    return f"array({', '.join(f'{float(v)!r}D' for v in values)})"


#: SQL: the squared Mahalanobis distance of x to the centre m, by the covariance c (lower triangle) with b for each unit of
#: ``shorter`` on its diagonal. Row by row of the Cholesky factor: ``l`` holds the rows so far, ``z`` the solved part.
_DISTANCE = f"""aggregate(sequence(0, {len(STATS) - 1}),
  struct(CAST(array() AS array<double>) AS l, CAST(array() AS array<double>) AS z, 0D AS d),
  (st, i) -> transform(array(aggregate(sequence(0, i), CAST(array() AS array<double>), (r, j) -> concat(r, array(IF(j < i,
      (c[i * (i + 1) div 2 + j] - aggregate(sequence(0, j), 0D, (a, k) -> a + IF(k < j, r[k] * st.l[j * (j + 1) div 2 + k], 0D)))
        / st.l[j * (j + 1) div 2 + j],
      sqrt(greatest(c[i * (i + 1) div 2 + i] + b[i] * shorter - aggregate(r, 0D, (a, v) -> a + v * v),
        {_doubles(FLOOR[k] ** 2 * 1e-3 for k in STATS)}[i]))))))), r ->
    transform(array((x[i] - m[i] - aggregate(zip_with(slice(r, 1, i), st.z, (u, v) -> u * v), 0D, (a, v) -> a + v)) / r[i]),
      z -> struct(concat(st.l, r) AS l, concat(st.z, array(z)) AS z, st.d + z * z AS d))[0])[0],
  st -> st.d)"""


def _with_distance(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """``rows`` with q_distance, the squared Mahalanobis distance to its pool, by the covariance c with b for each unit by
    which 1 / words lies above the pool's mean (null without an estimate)."""
    own = sized_broadcast(estimate.withColumnRenamed("pool", "e_pool"))
    out = rows.join(own, F.col("pool") == F.col("e_pool"), "left")
    out = out.withColumn("shorter", F.greatest(_per_word() - F.col("u_mean"), F.lit(0.0)))
    return out.withColumn("q_distance", F.when(F.col("e_pool").isNotNull(), F.expr(_DISTANCE))).drop(
        "e_pool", "shorter", "m", "c", "b", "u_mean")


#: SQL: what the estimate sums over its texts: 1, u, u^2, x, x u, x^2 u and the products of x (lower triangle).
_MOMENTS = """concat(array(1D, u, u * u), x, transform(x, v -> v * u), transform(x, v -> v * v * u),
  flatten(transform(x, (v, i) -> transform(slice(x, 1, i + 1), w -> v * w))))"""


def _estimate_of(sums: DataFrame) -> DataFrame:
    """(pool, m, c, u_mean, b) from (pool, v): centre, covariance with the least spread added, the mean of 1 / words and
    the variance that each statistic gains with it."""
    p = len(STATS)
    first = {"x": 3, "xu": 3 + p, "xxu": 3 + 2 * p, "xx": 3 + 3 * p}
    mean = [f"(v[{first['x'] + i}] / v[0])" for i in range(p)]
    cov = {(i, j): f"(v[{first['xx'] + _at(i, j)}] / v[0] - {mean[i]} * {mean[j]})" for i in range(p) for j in range(i + 1)}
    u_mean, u_var = "(v[1] / v[0])", "(v[2] / v[0] - v[1] / v[0] * v[1] / v[0])"
    floors = [FLOOR[k] ** 2 for k in STATS]
    c = [f"{cov[i, j]} / {CONSISTENCY}D + {floors[i] if i == j else 0.0!r}D" for i in range(p) for j in range(i + 1)]
    b = []
    for i in range(p):
        with_u = f"(v[{first['xxu'] + i}] - 2 * {mean[i]} * v[{first['xu'] + i}] + {mean[i]} * {mean[i]} * v[1]) / v[0]"
        b.append(f"IF({u_var} > 1e-12D, greatest(({with_u} - {cov[i, i]} * {u_mean}) / {u_var}, 0D) / {CONSISTENCY}D, 0D)")
    return sums.select("pool", *[F.expr(e).alias(name) for name, e in (
        ("m", f"array({', '.join(mean)})"), ("c", f"array({', '.join(c)})"), ("u_mean", u_mean), ("b", f"array({', '.join(b)})"))])


def mcd_estimates(rows: DataFrame) -> DataFrame:
    """``rows``: pool, q_n_words and x (the statistics) of the texts to learn from, stored. One estimate per pool."""
    p = len(STATS)
    start = rows.groupBy("pool").agg(F.array(*[F.percentile_approx(F.col("x")[i], 0.5, 10000) for i in range(p)]).alias("m"))
    near = rows.join(sized_broadcast(stored(start, "mcd-medians").withColumnRenamed("pool", "e_pool")), F.col("pool") == F.col("e_pool"))
    spread = near.groupBy("pool").agg(F.first("m").alias("m"), F.array(
        *[F.percentile_approx(F.abs(F.col("x")[i] - F.col("m")[i]), 0.5, 10000) for i in range(p)]).alias("mad"))
    c = [f"pow(mad[{i}] * 1.4826D, 2) + {FLOOR[STATS[i]] ** 2!r}D" if i == j else "0D" for i in range(p) for j in range(i + 1)]
    estimate = stored(spread.select("pool", "m", F.expr(f"array({', '.join(c)})").alias("c"), F.lit(0.0).alias("u_mean"),
                                    F.expr(f"array_repeat(0D, {p})").alias("b")), "mcd-start")
    for step in range(STEPS):
        binned = _with_distance(rows, estimate).withColumn("bin", F.when(
            F.col("q_distance") <= 1e-6, F.lit(-20 * BINS_PER_DOUBLING)).otherwise(
            F.ceil(F.log2("q_distance") * BINS_PER_DOUBLING)).cast("int")).withColumn("u", _per_word())
        by_place = binned.select("pool", "bin", F.posexplode(F.expr(_MOMENTS)).alias("place", "v")).groupBy(
            "pool", "bin", "place").agg(F.sum("v").alias("v"))
        by_bin = by_place.groupBy("pool", "bin").agg(F.array_sort(F.collect_list(F.struct("place", "v"))).alias("v")).select(
            "pool", "bin", F.transform("v", lambda x: x["v"]).alias("v"))
        # The nearest KEEP_SHARE of a pool: whole bins, up to the one that completes the share.
        in_order = Window.partitionBy("pool").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        inside = (by_bin.withColumn("before", F.coalesce(F.sum(F.col("v")[0]).over(in_order), F.lit(0.0)))
                  .withColumn("all_n", F.sum(F.col("v")[0]).over(Window.partitionBy("pool")))
                  .filter(F.col("before") < F.col("all_n") * KEEP_SHARE))
        sums = inside.groupBy("pool").agg(F.array_sort(F.collect_list(F.struct("bin", "v"))).alias("bins")).select("pool", F.expr(
            "aggregate(slice(bins, 2, size(bins)), bins[0].v, (a, y) -> zip_with(a, y.v, (s, t) -> s + t))").alias("v"))
        estimate = stored(_estimate_of(sums), f"mcd-step{step}")
    return estimate


def _scored(docs: DataFrame, carried: list[str]) -> DataFrame:
    """q_doc (the columns ``carried`` of ``docs`` as a struct), the base counts, q_base_failed, q_distance and q_kept. The
    texts are read once; the counts and what is carried are stored, and the estimates read only the counts."""
    rows = _per_text(docs.select(F.struct(*carried).alias("q_doc"), "text", F.col("lang").alias("q_lang"),
                                 F.col("source").alias("q_source"))).drop("text")
    rows = stored(rows.withColumn("x", F.array(*_vector().values())).withColumn("q_base_failed", base_failed()), "quality-counts")
    pools = sized_broadcast(stored(_pools(rows), "quality-pools"))
    rows = rows.join(pools, F.col("q_lang").eqNullSafe(F.col("g_lang"))
                     & F.col("q_source").eqNullSafe(F.col("g_source")), "left").drop("g_lang", "g_source")
    learn = rows.filter(~F.col("q_base_failed") & F.col("pool").isNotNull()).select("pool", "q_n_words", "x")
    scored = _with_distance(rows, mcd_estimates(learn))
    return scored.withColumn("q_kept", ~F.col("q_base_failed") & ~F.coalesce(
        F.col("q_distance") > CUTOFF, F.lit(False)))


COUNTS = ["q_n_words", "q_word_chars", "q_n_symbols", "q_n_dup_lines", "q_n_repeat_words"]


def score(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The given columns of ``docs`` (names that do not begin with q_), the base counts (``COUNTS``), q_base_failed,
    q_distance and q_kept, one row per row of ``docs``."""
    return _scored(docs, columns).select("q_doc.*", *COUNTS, "q_base_failed", "q_distance", "q_kept")


def filter_documents(docs: DataFrame) -> DataFrame:
    """The kept rows of ``docs`` with its columns, whatever their names."""
    return _scored(docs, docs.columns).filter("q_kept").select("q_doc.*")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = score(table(spark, sf_dir, "documents"), ["doc_id"])
    return rows.select("doc_id", F.col("q_n_words").alias("n_words"), F.col("q_word_chars").alias("word_chars"),
                       F.col("q_n_symbols").alias("n_symbols"), F.col("q_n_dup_lines").alias("n_dup_lines"),
                       F.col("q_n_repeat_words").alias("n_repeat_words"),
                       F.col("q_base_failed").alias("base_failed"), F.col("q_kept").alias("kept"),
                       F.round("q_distance", 4).alias("distance"))


QUERIES = {"op7_quality_rules": op7_quality_rules}
