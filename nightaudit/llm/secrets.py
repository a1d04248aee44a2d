"""Secret scans: pattern matches plus sliding-window Shannon entropy over candidate strings.

Pattern kinds (assign, access, hex) give the base spans. The method adds spans of kind ``entropy``: a candidate is a
maximal run of ``CANDIDATE`` characters, a window of ``WINDOW`` characters slides over it, and the window's own character
class (hex, lower-case or upper-case alphanumeric, base64) sets the entropy that it must reach, so that a key glued to
a name by = _ - or / is judged like a bare one. The entropy is kept by incremental
counts: one character enters and one leaves, and the sum of c * log2(c) over the counts changes by two table steps.
The table is in millionths, so that all engines agree to the last bit. Hot windows that touch make one span.
Windows inside a match of an allow-list pattern, or that touch a placeholder, are passed over, and spans are cut
where base spans lie; what is left of them is added. The SQL text at the end counts every window's characters anew.

Places are found in linear time: the pieces between the matches and the matches themselves become rows, and a running
sum of their lengths within a text gives the code-point offsets. Texts without a match cost one scan for each pattern
and one narrow row; the text itself is never shuffled, and matched strings stay in the task that read them.

Defined results: a null or empty text has no spans; repeated rows are scanned row by row; an empty table gives an
empty result; other columns are ignored by :func:`scan` and kept by :func:`redact`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nightaudit.llm.common import packed, stored, table, text_or_empty, unpacked

#: The patterns of the base kinds. The keyword letters stand in either case.
ASSIGN = (r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"
          r"[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ASSIGN_MIN = 8
# Runs are maximal, so the least length can stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ["assign", "access", "hex", "entropy"]

WINDOW = 20
CANDIDATE = rf"[A-Za-z0-9+/=_-]{{{WINDOW},}}"
#: Candidates that are no secrets: words, numbers, UUIDs, rulers, placeholders, lower-case paths and slugs.
ALLOWED = [r"^[A-Za-z]?[a-z]+$", r"^[A-Z]+$", r"^[0-9=_-]+$", r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
           r"[Ee][Xx][Aa][Mm][Pp][Ll][Ee]|[Pp][Ll][Aa][Cc][Ee][Hh][Oo][Ll][Dd][Ee][Rr]|[Xx]{6}|0123456789|abcdefgh",
           r"^/?[a-z]+([/_-][a-z]+)+/?$"]

#: Bits per character that a window must reach, by its class (SQL for "code point c is of the class"); the first that
#: fits counts, and OTHER_BITS where none does.
WINDOW_CLASSES = {"hex": ("c BETWEEN 48 AND 57 OR c BETWEEN 65 AND 70 OR c BETWEEN 97 AND 102", 3.0),
                  "lower": ("c BETWEEN 48 AND 57 OR c BETWEEN 97 AND 122", 3.6),
                  "upper": ("c BETWEEN 48 AND 57 OR c BETWEEN 65 AND 90", 3.6)}
OTHER_BITS = 3.8
#: The allow-list within a candidate: what a window may lie inside of, and placeholders that it may not touch.
INSIDE = [p.removeprefix("^").removesuffix("$") for p in ALLOWED if p.startswith("^")]
TOUCHED = [p for p in ALLOWED if not p.startswith("^")]

MILLIONTHS = [round(c * math.log2(c) * 1e6) if c else 0 for c in range(WINDOW + 1)]

#: Most spans (some 40 bytes each) in a broadcast.
MAX_BROADCAST_SPANS = 1_000_000


def _most(bits: float) -> int:
    """The largest sum of c * log2(c), in millionths, at which a window still has so many bits per character."""
    return math.floor(WINDOW * (math.log2(WINDOW) - bits) * 1e6)


def _hot(upto: str) -> str:
    """SQL: the spans so far, with the window of state ``st`` that ends before ``upto`` where it is hot."""
    a = f"{upto} - {WINDOW}"
    most = " ".join(f"WHEN st.{k} < {a} THEN {_most(bits)}L" for k, (_, bits) in WINDOW_CLASSES.items())
    return f"""CASE WHEN {upto} < {WINDOW} OR st.total > CASE {most} ELSE {_most(OTHER_BITS)}L END
      OR exists(inside, x -> x.a <= {a} AND x.b >= {upto}) OR exists(touched, x -> x.a < {upto} AND x.b > {a}) THEN st.spans
      WHEN size(st.spans) > 0 AND st.spans[size(st.spans) - 1].b >= {a} THEN concat(
        slice(st.spans, 1, size(st.spans) - 1), array(struct(st.spans[size(st.spans) - 1].a AS a, {upto} AS b)))
      ELSE concat(st.spans, array(struct({a} AS a, {upto} AS b))) END"""


def _places(text: str, pattern: str, least: int = 1) -> str:
    """SQL: the places (a, b), from 0, end exclusive, of the pattern's matches of ``least`` characters in the text column."""
    p = "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"""CASE WHEN {text} RLIKE {p} THEN aggregate(
      zip_with(regexp_extract_all({text}, {p}, 0), split({text}, {p}), (m, p) ->
        named_struct('gap', length(p), 'len', coalesce(length(m), 0))),
      named_struct('at', 0, 'out', CAST(array() AS array<struct<a: int, b: int>>)),
      (st, x) -> named_struct('at', st.at + x.gap + x.len, 'out', IF(x.len < {least}, st.out, concat(st.out, array(
        named_struct('a', st.at + x.gap, 'b', st.at + x.gap + x.len))))), st -> st.out)
      ELSE CAST(array() AS array<struct<a: int, b: int>>) END"""


def with_hot_spans(rows: DataFrame, candidate: str = "s") -> DataFrame:
    """Adds ``spans``: array of (a, b), from 0, end exclusive, the merged hot windows of the candidate string; empty
    if there is none or the allow-list suppresses it, null if the candidate is null."""
    # A match shorter than a window has none inside.
    inside = F.expr(f"concat({', '.join(_places(candidate, p, WINDOW) for p in INSIDE)})")
    touched = F.expr(f"concat({', '.join(_places(candidate, p) for p in TOUCHED)})")
    out = rows.withColumns({"inside": inside, "touched": touched, "steps": F.lit(MILLIONTHS).cast("array<bigint>"), "codes": F.transform(
        F.array_remove(F.split(candidate, ""), ""), lambda c: F.ascii(c))})
    leaving = f"codes[i - {WINDOW}]"
    lasts = ", ".join(f"'{k}', IF({test.replace('c BETWEEN', 'codes[i] BETWEEN')}, st.{k}, i)"
                      for k, (test, _) in WINDOW_CLASSES.items())
    step = f"""named_struct(
      'n', IF(i >= {WINDOW} AND codes[i] = {leaving}, st.n, transform(st.n, (c, k) ->
        c + IF(k = codes[i], 1, 0) - IF(i >= {WINDOW} AND k = {leaving}, 1, 0))),
      'total', st.total + IF(i >= {WINDOW} AND codes[i] = {leaving}, 0L,
        steps[st.n[codes[i]] + 1] - steps[st.n[codes[i]]]
        + IF(i >= {WINDOW}, steps[st.n[{leaving}] - 1] - steps[st.n[{leaving}]], 0L)),
      'spans', {_hot('i')}, {lasts})"""
    step = step.replace(leaving, f"get(codes, i - {WINDOW})")
    last = ", ".join(f"'{k}', -1" for k in WINDOW_CLASSES)  # place of the last character that is not of the class
    spans = f"""CASE WHEN {candidate} IS NULL THEN NULL
      ELSE aggregate(sequence(0, size(codes) - 1),
        named_struct('n', array_repeat(0, 128), 'total', 0L, 'spans', CAST(array() AS array<struct<a: int, b: int>>), {last}),
        (st, i) -> {step}, st -> {_hot('size(codes)')}) END"""
    return out.withColumn("spans", F.expr(spans)).drop("inside", "touched", "steps", "codes")


def _match_rows(docs: DataFrame) -> DataFrame:
    """(row_key, doc_id, text_key, kind, at, gap, len, good, s): one row per match of each pattern, in order, with the
    length of the piece before it; kind -1 once per text."""
    out = docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.monotonically_increasing_id().alias("row_key"),
                      text_or_empty().alias("q_text"))
    patterns = [ASSIGN, ACCESS, HEX, CANDIDATE]
    out = out.withColumns({f"m{k}": F.regexp_extract_all("q_text", F.lit(p), F.lit(0)) for k, p in enumerate(patterns)})
    out = out.withColumns({
        **{f"p{k}": F.when(F.size(f"m{k}") > 0, F.split("q_text", p)) for k, p in enumerate(patterns)},
        "values": F.when(F.size("m0") > 0, F.regexp_extract_all("q_text", F.lit(ASSIGN), F.lit(2)))})
    marks = []
    for k in range(len(patterns)):
        good = f"length(values[i]) >= {ASSIGN_MIN}" if k == 0 else "true"
        s = f"m{k}[i]" if k == 3 else "CAST(NULL AS string)"
        marks.append(F.expr(
            f"IF(size(m{k}) > 0, transform(sequence(0, size(m{k}) - 1), i -> struct({k} AS kind, i AS at, "
            f"length(p{k}[i]) AS gap, length(m{k}[i]) AS len, {good} AS good, {s} AS s)), "
            "CAST(array() AS array<struct<kind: int, at: int, gap: int, len: int, good: boolean, s: string>>))"))
    marker = F.expr("array(struct(-1 AS kind, 0 AS at, 0 AS gap, 0 AS len, true AS good, CAST(NULL AS string) AS s))")
    # never empty; the outer form keeps the optimizer from scanning the texts once more to test for that
    return out.select("row_key", "doc_id", "text_key", F.explode_outer(F.concat(marker, *marks)).alias("m")).select(
        "row_key", "doc_id", "text_key", "m.*")


def scan(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, text_key (64-bit hash of the text) and spans, an array of (start, kind, name, end) in order of start and
    kind; offsets are code points, end exclusive."""
    rows = with_hot_spans(_match_rows(docs)).drop("s").repartition("row_key")
    in_kind = Window.partitionBy("row_key", "kind").orderBy("at")
    rows = rows.withColumn("start", F.sum(F.col("gap") + F.col("len")).over(in_kind) - F.col("len"))
    # A base match is one span; a candidate gives as many as it has hot regions.
    rows = rows.filter("good").withColumn("span", F.explode_outer(F.when(F.col("kind") == 3, F.col("spans")).otherwise(
        F.expr("array(struct(0 AS a, len AS b))")))).filter("kind <> 3 OR span IS NOT NULL")
    rows = rows.select("row_key", "doc_id", "text_key", "kind", (F.col("start") + F.col("span.a")).alias("start"),
                       (F.col("start") + F.col("span.b")).alias("end"))
    base = F.col("kind").between(0, 2)
    by_start = Window.partitionBy("row_key").orderBy("start", "kind")
    upto = by_start.rowsBetween(Window.unboundedPreceding, 0)
    # What base spans leave of a region begins where the region or a base span in it ends or begins, at its own row or
    # that of the base span, and ends with the region or at the next base span. Regions are disjoint.
    rows = rows.withColumns({
        "reach": F.max(F.when(base, F.col("end"))).over(upto),
        "region": F.last(F.when(F.col("kind") == 3, F.col("end")), True).over(upto),
        "next": F.min(F.when(base, F.col("start"))).over(by_start.rowsBetween(1, Window.unboundedFollowing))})
    piece = F.struct(F.lit(3).alias("kind"), F.greatest(F.when(F.col("kind") == 3, F.col("start")), F.col("reach")).alias("start"),
                     F.least("region", "next").alias("end"))
    rows = rows.select("row_key", "doc_id", "text_key", F.explode(F.filter(F.array(
        F.when(F.col("kind") != 3, F.struct("kind", "start", "end")),
        F.when((F.col("kind") >= 0) & F.col("region").isNotNull() & (piece["start"] < piece["end"]), piece)),
        lambda x: x.isNotNull())).alias("x")).select("row_key", "doc_id", "text_key", "x.*")
    name = F.get(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    return rows.groupBy("row_key", "doc_id", "text_key").agg(F.array_sort(F.collect_list(F.when(
        F.col("kind") >= 0, F.struct("start", "kind", name.alias("name"), "end")))).alias("spans")).drop("row_key")


def _joined(spans: str) -> Column:
    return F.expr(f"array_join(transform({spans}, x -> concat_ws(':', x.name, x.start, x.end)), ',')")


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span replaced by ``mark``, overlapping spans once; other columns and clean texts unchanged.
    Rows are found again by id and text; the texts stay where they are if the spans are at most ``MAX_BROADCAST_SPANS``."""
    places = F.transform("spans", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))
    found = stored(scan(docs).filter("size(spans) > 0").select(
        F.col("doc_id").alias("q_id"), F.col("text_key").alias("q_key"), places.alias("q_spans"))
        .dropDuplicates(["q_id", "q_key"]), "secrets-found")
    n_spans = found.agg(F.sum(F.size("q_spans"))).first()[0] or 0  # one number
    found = F.broadcast(found) if n_spans <= MAX_BROADCAST_SPANS else found
    merged = F.expr("aggregate(q_spans, CAST(array() AS array<struct<a: bigint, b: bigint>>), (m, x) -> "
                    "IF(size(m) > 0 AND m[size(m) - 1].b > x.start, concat(slice(m, 1, size(m) - 1), "
                    "array(struct(m[size(m) - 1].a AS a, greatest(m[size(m) - 1].b, x.end) AS b))), "
                    "concat(m, array(struct(x.start AS a, x.end AS b)))))")
    pieces = F.expr("array_join(transform(sequence(0, size(q_merged)), i -> substring(q_doc.text, "
                    "CAST(IF(i = 0, 0, q_merged[greatest(i - 1, 0)].b) + 1 AS int), "
                    "CAST(IF(i = size(q_merged), length(q_doc.text), get(q_merged, i).a) "
                    "- IF(i = 0, 0, q_merged[greatest(i - 1, 0)].b) AS int))), q_mark)")
    joined = packed(docs).join(found, F.col("q_doc.doc_id").eqNullSafe(F.col("q_id")) & (F.xxhash64("q_doc.text") == F.col("q_key")),
                               "left").withColumn("q_merged", merged).withColumn("q_mark", F.lit(mark))
    return unpacked(joined, docs.columns, F.when(F.col("q_spans").isNull(), F.col("q_doc.text")).otherwise(pieces))


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan(table(spark, sf_dir, "documents")).withColumn("base", F.filter("spans", lambda x: x["kind"] < 3))
    counts = [F.expr(f"CAST(size(filter(base, x -> x.kind = {k})) AS bigint)").alias(f"n_{name}")
              for k, name in enumerate(KINDS[:3])]
    return rows.select("doc_id", *counts, F.sha2(_joined("base"), 256).alias("base_sha256"),
                       _joined("spans").alias("spans"))


QUERIES = {"op2_secret_scans": op2_secret_scans}


def _oracle() -> str:
    def q(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    kinds = [ASSIGN, ACCESS, HEX, CANDIDATE]
    # Unnested side by side, the pieces and the matches of a text stay in order.
    parts = "\nUNION ALL\n".join(
        f"SELECT rid, {k} AS kind, i, length(p[i]) AS gap, length(m[i]) AS len, m[i] AS s, "
        + (f"length(v[i]) >= {ASSIGN_MIN}" if k == 0 else "true") + " AS good FROM (SELECT rid, m, p, v, "
        f"unnest(range(1, len(m) + 1)) AS i FROM (SELECT rid, regexp_extract_all(t, {q(p)}) AS m, "
        f"regexp_split_to_array(t, {q(p)}) AS p, " + (f"regexp_extract_all(t, {q(p)}, 2)" if k == 0 else "NULL")
        + " AS v FROM d))" for k, p in enumerate(kinds))
    # Places of allow-list matches in the candidates; True: a window inside is passed over, False: one that touches.
    allowed = "\nUNION ALL\n".join(
        f"SELECT rid, start, {k} AS p, {inside} AS inside, i, length(o[i]) AS gap, length(m[i]) AS len FROM (SELECT rid, start, "
        f"m, o, unnest(range(1, len(m) + 1)) AS i FROM (SELECT rid, start, regexp_extract_all(s, {q(p)}) AS m, "
        f"regexp_split_to_array(s, {q(p)}) AS o FROM cand))"
        for k, (p, inside) in enumerate([(p, True) for p in INSIDE] + [(p, False) for p in TOUCHED]))
    letters = {"hex": "[0-9a-fA-F]+", "lower": "[0-9a-z]+", "upper": "[0-9A-Z]+"}
    most = "CASE " + " ".join(f"WHEN regexp_full_match(w, {q(letters[k])}) THEN {_most(bits)}"
                              for k, (_, bits) in WINDOW_CLASSES.items()) + f" ELSE {_most(OTHER_BITS)} END"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
m AS ({parts}),
placed AS (SELECT *, sum(gap + len) OVER (PARTITION BY rid, kind ORDER BY i) - len AS start FROM m),
base AS (SELECT rid, kind, start, start + len AS stop FROM placed WHERE kind < 3 AND good),
cand AS (SELECT rid, start, s FROM placed WHERE kind = 3),
allow AS ({allowed}),
ban AS (SELECT rid, start, inside, till - len AS b, till AS e FROM (SELECT *, sum(gap + len) OVER (
        PARTITION BY rid, start, p ORDER BY i) AS till FROM allow) WHERE NOT inside OR len >= {WINDOW}),
win AS (SELECT rid, start, a, substr(s, a + 1, {WINDOW}) AS w
        FROM (SELECT *, unnest(range(0, length(s) - {WINDOW} + 1)) AS a FROM cand)),
judged AS (SELECT *, {most} AS most FROM win WHERE NOT EXISTS (SELECT 1 FROM ban WHERE ban.rid = win.rid AND ban.start = win.start
           AND if(inside, b <= a AND e >= a + {WINDOW}, b < a + {WINDOW} AND e > a))),
chars AS (SELECT rid, start, most, a, unnest(string_split(w, '')) AS c FROM judged),
cnt AS (SELECT rid, start, most, a, c, count(*) AS n FROM chars GROUP BY ALL),
hot AS (SELECT rid, start, a FROM cnt GROUP BY rid, start, most, a
        HAVING sum([{', '.join(map(str, MILLIONTHS))}][n + 1]) <= most),
isl AS (SELECT *, sum(CASE WHEN a <= prev + {WINDOW} THEN 0 ELSE 1 END) OVER (PARTITION BY rid, start ORDER BY a) AS g
        FROM (SELECT *, lag(a) OVER (PARTITION BY rid, start ORDER BY a) AS prev FROM hot)),
reg AS (SELECT rid, 3 AS kind, start + min(a) AS start, start + max(a) + {WINDOW} AS stop FROM isl GROUP BY rid, isl.start, g),
opened AS (SELECT rid, start AS a, stop FROM reg UNION SELECT reg.rid, base.stop, reg.stop FROM reg JOIN base ON base.rid = reg.rid
           AND base.stop > reg.start AND base.stop < reg.stop),
pieces AS (SELECT rid, 3 AS kind, a AS start, least(stop, coalesce((SELECT min(start) FROM base
           WHERE base.rid = opened.rid AND base.start > opened.a), stop)) AS stop FROM opened
           WHERE NOT EXISTS (SELECT 1 FROM base WHERE base.rid = opened.rid AND base.start <= opened.a AND base.stop > opened.a)),
spans AS (SELECT * FROM base UNION ALL SELECT * FROM pieces),
named AS (SELECT *, concat([{', '.join(q(k) for k in KINDS)}][kind + 1], ':', CAST(start AS BIGINT), ':', CAST(stop AS BIGINT)) AS x FROM spans),
per AS (SELECT rid, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
        count(*) FILTER (kind = 2) AS n_hex, string_agg(x, ',' ORDER BY start, kind) FILTER (kind < 3) AS b,
        string_agg(x, ',' ORDER BY start, kind) AS spans FROM named GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN per USING (rid)"""


ORACLE_SQL = {"op2_secret_scans": _oracle()}
