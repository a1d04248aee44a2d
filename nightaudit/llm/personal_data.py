"""Personal data by weak supervision: labelers vote, EM weighs them, a span classifier decides.

Nine patterns propose spans. Four are the base kinds (email, ip, card, phone); what passes their checks always stays. Five
are proposals of the method: ``mail`` (addresses written with "at" and "dot"), ``tel`` (numbers without a plus sign),
``ssn``, ``iban`` (with its check digits) and ``name`` (a form of address and a capitalised name). Every proposal, the
failing ones of the base kinds included, gets six votes (for, against, none): two of patterns (its checks; its layout), one
of a gazetteer (domains, calling codes, issuers, countries, first names), two of the context before it (words that announce
such data; words that announce other numbers) and one of its surroundings.

Expectation-maximisation over the table of vote patterns (at most kinds x 3^6 rows, whatever the input) estimates how often
each labeler is right about personal data and about other strings, and how frequent each kind is. Its posteriors are the
soft labels of a naive Bayes classifier over the span itself (length, digits, characters around it, the word before it,
its shape), trained in one aggregate over all proposals. The classifier decides on the proposals of the method; a span that
overlaps a base span is not added, and a failed check is never overruled.

Everything is DataFrame code, the EM a fold in one row; nothing comes to the driver. Each text is read once, the stored
proposals hold no text, and places are running sums of piece lengths, so no text is searched twice for the same string.
All patterns take one pass: repetitions are possessive, and a run is entered at its beginning or where the last match ended.

Defined results: a null or empty text has no spans; repeated rows are scanned row by row; a table without proposals trains
nothing and adds nothing; an empty table gives an empty result; other columns are ignored by :func:`scan` and kept by
:func:`redact`. Offsets are code points, end exclusive.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nightaudit.llm.common import packed, stored, table, text_or_empty, unpacked

LOCAL = "[A-Za-z0-9._%+-]"
CAPITAL, SMALL = r"[A-ZÀ-Þ]", r"[a-zß-ÿ]"
AT, DOT = r"\x20?[(\[]at[)\]]\x20?", r"(?:\x20?[(\[]dot[)\]]\x20?|\x20dot\x20)"
HOST = "[A-Za-z0-9-]"
#: Forms of address that stand before a name.
TITLES = "Mr|Mrs|Ms|Miss|Dr|Prof|Herr|Frau|Monsieur|Madame|Mme|Señor|Señora|Sr|Sra|Don|Doña"
#: The first four are the contract's patterns in possessive form. A lookahead for the first character comes first, as it
#: is the cheapest test.
PATTERNS = {
    "email": rf"(?={LOCAL})(?:\G|(?<!{LOCAL})){LOCAL}++@{HOST}++(?:\.{HOST}++)++",
    "ip": r"(?=[0-9])(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?=[0-9])(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "mail": rf"(?={LOCAL})(?<!{LOCAL}){LOCAL}++(?:{AT}{HOST}++(?:(?:{DOT}|\.){HOST}++)++|\x20at\x20{HOST}++(?:{DOT}{HOST}++)++)",
    "tel": r"(?=[0-9(])(?![0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]))(?<![0-9A-Za-z+.,/-])(?:\([0-9]{2,5}+\)|[0-9]{3,5}+)[\x20/.-][0-9]{2,4}+(?:[\x20.-][0-9]{2,4}+){1,3}+(?![0-9A-Za-z])(?![\x20.-][0-9])",
    "ssn": r"(?=[0-9])(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "iban": r"(?=[A-Z])(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3}+)?(?![0-9A-Za-z])",
    "name": rf"(?=[MDPHFS])(?<![\p{{L}}0-9])(?:{TITLES})\.?\x20{CAPITAL}{SMALL}++(?:\x20{CAPITAL}{SMALL}++)?+",
}
#: Strings without one of which a text has no match of the kind; finding that out costs less than the pattern.
NEEDED = {"email": ["@"], "phone": ["+"], "mail": ["(at)", "[at]", " dot ", "(dot)", "[dot]"], "ssn": ["-"]}
KINDS = list(PATTERNS)
BASE = 4
CONTEXT = 24

#: Gazetteers: endings of host names, calling codes, first digits of card issuers, countries of account numbers, names.
DOMAINS = "com|org|net|edu|gov|info|io|co|eu|de|fr|es|it|uk|at|ch|nl|be|pl|us|ca|mx|br|jp|cn|in|ru|se|no|dk|fi"
CALLING = "1|2[07]|3[0123469]|4[013456789]|5[1-8]|6[0-6]|7|8[1246]|9[0-58]|35[0-9]|42[013]"
ISSUERS = "4|5[1-5]|2[2-7]|6011|65|35|62"
IBAN_COUNTRIES = "AT|BE|CH|CZ|DE|DK|ES|FI|FR|GB|GR|HU|IE|IT|LU|NL|NO|PL|PT|RO|SE"
FIRST_NAMES = ("James|John|Robert|Michael|David|Mary|Patricia|Linda|Susan|Sarah|Anna|Peter|Paul|Thomas|Hans|Karl|Klaus|"
               "Jürgen|Ursula|Sabine|Pierre|Jean|Marie|Claire|Sophie|Carlos|José|Juan|Miguel|María|Carmen|Ana|Luis|Elena")
CUES = ("mail|contact|kontakt|contacto|courriel|correo|write to|tel|phone|call|fax|mobile|mobil|handy|teléfono|ip|host|server|"
        "address|adresse|card|karte|carte|tarjeta|visa|iban|account|konto|compte|cuenta|ssn|social security|name|signed|dear")
COUNTER_CUES = "version|release|isbn|issn|order|invoice|ref|serial|article|part no|section|chapter|page|sha|id|nr|no"

#: The labelers, with the share of its votes in which each is taken to be right before any is seen.
LABELERS = {"checks": 0.95, "layout": 0.8, "gazetteer": 0.7, "cue": 0.9, "counter_cue": 0.9, "surroundings": 0.6}
#: How many votes that first share is worth.
WORTH = 10.0
EM_STEPS = 12
#: Log odds that the classifier must give for a span to be added: nine to one.
ADD_FROM = 2.197
FEATURES, VALUES = 6, 64


def _digits(s: str = "s") -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    places = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(
        i % 2 == 1, F.get(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), c.cast("int"))).otherwise(c.cast("int")))
    return F.aggregate(places, F.lit(0), lambda a, x: a + x) % 10 == 0


def _iban_rest(s: Column) -> Column:
    plain = F.regexp_replace(s, " ", "")
    chars = F.split(F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4)), "")
    return F.aggregate(chars, F.lit(0), lambda a, c: F.when(
        c.rlike("[0-9]"), (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97))


def _is(*kinds: str) -> Column:
    return F.col("kind").isin([KINDS.index(k) for k in kinds])


def _checked() -> Column:
    """Whether the match passes the checks of its kind."""
    digits = _digits()
    return (F.when(_is("ip"), F.forall(F.split("s", r"\."), lambda x: x.cast("double") <= 255))
            .when(_is("card"), _luhn(digits))
            .when(_is("phone"), F.length(digits).between(8, 15))
            .when(_is("tel"), F.length(digits).between(7, 15))
            .when(_is("ssn"), ~F.col("s").rlike("^(000|666|9)|-00-|-0000$"))
            .when(_is("iban"), _iban_rest(F.col("s")) == 1)
            .otherwise(True))


def _vote(yes: Column, no: Column | None = None) -> Column:
    return F.when(yes, 1).when(no if no is not None else F.lit(False), -1).otherwise(0)


def _votes() -> dict[str, Column]:
    s = F.col("s")
    checked = _is("ip", "card", "phone", "iban", "ssn")
    layout = (F.when(_is("email"), s.rlike(r"^[A-Za-z0-9].*\.[A-Za-z]{2,}$"))
              .when(_is("ip"), ~s.rlike(r"(^|\.)0[0-9]"))
              .when(_is("card"), s.rlike(r"^([0-9]{16}|([0-9]{4}[ -]){3}[0-9]{4})$"))
              .when(_is("phone"), s.rlike(r"^\+[0-9]{1,3}[ -]?(\([0-9]{1,5}\))?[ 0-9.-]+$"))
              .when(_is("mail"), s.rlike(r"(?i)[(\[]at[)\]]|dot"))
              .when(_is("tel"), s.rlike(r"^(\(0?[0-9]{2,4}\)|0[0-9]{2,4}|[0-9]{3}[-. ][0-9]{3}[-. ][0-9]{4}$)"))
              .when(_is("iban"), s.rlike(r"^[A-Z]{2}[0-9]{2}( [A-Z0-9]{4})+( [A-Z0-9]{1,3})?$|^[A-Z0-9]+$"))
              .when(_is("name"), s.rlike(rf"{CAPITAL}{SMALL}+\x20{CAPITAL}{SMALL}{{2,}}")))
    listed = (F.when(_is("email", "mail"), s.rlike(rf"(?i)({DOT}|\.)({DOMAINS})$"))
              .when(_is("card"), s.rlike(f"^({ISSUERS})"))
              .when(_is("phone"), s.rlike(rf"^\+({CALLING})"))
              .when(_is("iban"), s.rlike(f"^({IBAN_COUNTRIES})"))
              .when(_is("name"), s.rlike(rf"\x20({FIRST_NAMES})\b")))
    cue = F.col("before").rlike(rf"(?i)(?<![\p{{L}}])({CUES})[\p{{L}}]{{0,6}}[^\p{{L}}]{{0,4}}$")
    counter = F.col("before").rlike(rf"(?i)(?<![\p{{L}}])({COUNTER_CUES})[^\p{{L}}]{{0,4}}$")
    open_left = F.col("before").rlike(r"[\p{L}0-9_/\\&=-]$")
    open_right = F.col("after").rlike(r"^[\p{L}0-9_/\\@=]")
    return {
        "checks": F.when(checked, _vote(F.col("good"), ~F.col("good"))).otherwise(_vote(F.lit(False), ~F.col("good"))),
        "layout": _vote(layout, ~layout),
        "gazetteer": F.when(_is("name"), _vote(listed)).otherwise(_vote(listed, ~listed)),
        "cue": _vote(cue), "counter_cue": _vote(F.lit(False), counter),
        "surroundings": F.when(open_left | open_right, -1).otherwise(1),
    }


def _around(c: Column) -> Column:
    return (F.when(c == "", 0).when(c.rlike(r"\s"), 1).when(c.rlike(r"\p{L}"), 2).when(c.rlike("[0-9]"), 3)
            .when(c.rlike(r"[\"'()\[\]<>{}]"), 4).when(c.rlike("[.,;!?]"), 5).when(c.rlike("[:=]"), 6).otherwise(7))


def _features() -> Column:
    """Places in the table of weights: one value below VALUES for each feature of a kind."""
    shape = F.regexp_replace(F.regexp_replace("s", r"\p{L}+", "a"), "[0-9]+", "0")
    values = [F.least(F.length("s"), F.lit(VALUES - 1)), F.least(F.length(_digits()), F.lit(VALUES - 1)),
              _around(F.right("before", F.lit(1))), _around(F.col("after")),
              F.pmod(F.xxhash64(F.lower(F.regexp_extract("before", r"(\p{L}+)[^\p{L}]*$", 1))), F.lit(VALUES)).cast("int"),
              F.pmod(F.xxhash64(shape), F.lit(VALUES)).cast("int")]
    return F.array(*[(F.col("kind") * FEATURES + k) * VALUES + v for k, v in enumerate(values)])


def _code(votes: dict[str, Column]) -> Column:
    """The votes as one number, a digit of base 3 for each labeler."""
    return reduce(lambda a, x: a * 3 + x, [votes[name] + 1 for name in LABELERS], F.lit(0))


def _digit(code: Column, labeler: int) -> Column:
    return F.floor(code / (3 ** (len(LABELERS) - 1 - labeler))) % 3 - 1


def proposals(docs: DataFrame) -> DataFrame:
    """(row_key, doc_id, text_key, kind, at, gap, len, good, code, features): one row per match of each pattern, in order,
    with the length of the piece before it, and a row of kind -1 per text. No text is kept."""
    out = docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.monotonically_increasing_id().alias("row_key"),
                      text_or_empty().alias("q_text"))
    for k, (name, p) in enumerate(PATTERNS.items()):
        hits = F.regexp_extract_all("q_text", F.lit(p), F.lit(0))
        if name in NEEDED:
            any_of = reduce(lambda a, b: a | b, [F.contains("q_text", F.lit(x)) for x in NEEDED[name]])
            hits = F.when(any_of, hits).otherwise(F.array().cast("array<string>"))
        out = out.withColumn(f"m{k}", hits)
    out = out.withColumns({f"p{k}": F.when(F.size(f"m{k}") > 0, F.split("q_text", p)) for k, p in enumerate(PATTERNS.values())})
    fields = "kind: int, at: int, gap: int, len: int, s: string, before: string, after: string"
    marks = [F.expr(f"IF(size(m{k}) > 0, transform(m{k}, (s, i) -> struct({k} AS kind, i AS at, length(p{k}[i]) AS gap, "
                    f"length(s) AS len, s, right(p{k}[i], {CONTEXT}) AS before, left(p{k}[i + 1], 1) AS after)), "
                    f"CAST(array() AS array<struct<{fields}>>))") for k in range(len(KINDS))]
    marker = F.expr("array(struct(-1 AS kind, 0 AS at, 0 AS gap, 0 AS len, CAST(NULL AS string) AS s, "
                    "CAST(NULL AS string) AS before, CAST(NULL AS string) AS after))")
    rows = out.select("row_key", "doc_id", "text_key", F.explode_outer(F.concat(marker, *marks)).alias("m")).select(
        "row_key", "doc_id", "text_key", "m.*")
    found = F.col("kind") >= 0
    rows = rows.withColumn("good", F.when(found, _checked()).otherwise(True))
    votes = _votes()
    return rows.withColumns({"code": F.when(found, _code(votes)), "features": F.when(found, _features())}).drop(
        "s", "before", "after")


def _each(parts: list[str]) -> str:
    return f"array({', '.join(parts)})"


def with_reliabilities(patterns: DataFrame) -> DataFrame:
    """EM over ``patterns`` (kind, code, n; one row per kind and vote pattern). One row: ``votes``, the patterns in order,
    and ``p``: for each labeler, how often a vote on personal data is for it (``right``) and on other strings against it
    (``wrong``), and for each kind the share of personal data (``prior``)."""
    n, starts = len(LABELERS), list(LABELERS.values())
    votes = F.array(*[_digit(F.col("code"), j).cast("int") for j in range(n)]).alias("v")
    rows = patterns.agg(F.array_sort(F.collect_list(F.struct("kind", "code", votes, F.col("n").cast("double").alias("n")))).alias("votes"))

    def total(value: str) -> str:
        return f"aggregate(qs, 0D, (a, x) -> a + {value})"

    right = _each([f"({total(f'IF(x.v[{j}] = 1, x.n * x.q, 0D)')} + {start * WORTH}D) / "
                   f"({total(f'IF(x.v[{j}] <> 0, x.n * x.q, 0D)')} + {WORTH}D)" for j, start in enumerate(starts)])
    wrong = _each([f"({total(f'IF(x.v[{j}] = -1, x.n * (1 - x.q), 0D)')} + {start * WORTH}D) / "
                   f"({total(f'IF(x.v[{j}] <> 0, x.n * (1 - x.q), 0D)')} + {WORTH}D)" for j, start in enumerate(starts)])
    prior = _each([f"({total(f'IF(x.kind = {k}, x.n * x.q, 0D)')} + 1D) / ({total(f'IF(x.kind = {k}, x.n, 0D)')} + 2D)"
                   for k in range(len(KINDS))])
    labelled = f"transform(votes, x -> struct(x.kind, x.v, x.n, {_posterior('p')} AS q))"
    step = f"transform(array({labelled}), qs -> struct({right} AS right, {wrong} AS wrong, {prior} AS prior))[0]"
    start = _each([f"{x}D" for x in starts])
    first = f"struct({start} AS right, {start} AS wrong, array_repeat(0.5D, {len(KINDS)}) AS prior)"
    return rows.withColumn("p", F.expr(f"aggregate(sequence(1, {EM_STEPS}), {first}, (p, i) -> {step})"))


def _posterior(p: str) -> str:
    """SQL: the probability that the vote pattern x is of personal data."""
    parts = [f"CASE x.v[{j}] WHEN 1 THEN ln({p}.right[{j}] / (1 - {p}.wrong[{j}])) "
             f"WHEN -1 THEN ln((1 - {p}.right[{j}]) / {p}.wrong[{j}]) ELSE 0D END" for j in range(len(LABELERS))]
    return f"1 / (1 + exp(-(ln({p}.prior[x.kind] / (1 - {p}.prior[x.kind])) + {' + '.join(parts)})))"


def classifier(labelled: DataFrame) -> DataFrame:
    """One row, ``weights``: for each kind, feature and value the log odds that it adds (naive Bayes, one proposal of
    smoothing a value), and behind them each kind's own. ``labelled``: kind, features, q."""
    size = len(KINDS) * FEATURES * VALUES
    both = [F.sum("q").alias("q"), F.sum(1 - F.col("q")).alias("o")]
    of_kind = labelled.groupBy("kind").agg(*both)
    of_value = labelled.select(F.explode("features").alias("at"), "q").groupBy("at").agg(*both)
    totals = of_kind.select(F.col("kind").alias("t_kind"), F.col("q").alias("t_q"), F.col("o").alias("t_o"))
    values = (labelled.sparkSession.range(size).withColumn("kind", F.floor(F.col("id") / (FEATURES * VALUES)))
              .join(F.broadcast(of_value), F.col("id") == F.col("at"), "left")  # at most ``size`` rows
              .join(F.broadcast(totals), F.col("kind") == F.col("t_kind"), "left"))

    def odds(q: str, o: str) -> Column:
        return F.log((F.coalesce(F.col(q), F.lit(0.0)) + 1) / (F.coalesce(F.col(o), F.lit(0.0)) + 1))

    whole = F.log((F.coalesce(F.col("t_q"), F.lit(0.0)) + VALUES) / (F.coalesce(F.col("t_o"), F.lit(0.0)) + VALUES))
    weights = values.select(F.col("id"), F.round(odds("q", "o") - whole, 6).alias("w"))
    kinds = labelled.sparkSession.range(len(KINDS)).join(F.broadcast(totals), F.col("id") == F.col("t_kind"), "left").select(
        F.col("id") + size, F.round(odds("t_q", "t_o"), 6).alias("w"))
    return weights.unionAll(kinds).agg(F.transform(F.array_sort(F.collect_list(F.struct("id", "w"))), lambda x: x["w"]).alias("weights"))


def scored(found: DataFrame) -> DataFrame:
    """``found`` (the stored proposals) with odds: the classifier's log odds, null on the rows of kind -1."""
    # A number of too few or too many digits for a telephone tells nothing about telephone numbers.
    proposed = found.filter(f"kind >= 0 AND (good OR kind <> {KINDS.index('tel')})")
    patterns = stored(proposed.groupBy("kind", "code").agg(F.count("*").alias("n")), "pii-votes")
    labels = stored(with_reliabilities(patterns).select(F.explode(F.expr(
        f"transform(votes, x -> struct(x.kind AS l_kind, x.code AS l_code, {_posterior('p')} AS q))")).alias("x")).select("x.*"),
        "pii-labels")
    labelled = proposed.join(F.broadcast(labels), (F.col("kind") == F.col("l_kind")) & (F.col("code") == F.col("l_code")))
    weights = stored(classifier(labelled.select("kind", "features", "q")), "pii-weights")
    own = f"aggregate(features, weights[{len(KINDS) * FEATURES * VALUES} + kind], (a, i) -> a + weights[i])"
    return found.crossJoin(F.broadcast(weights)).withColumn(  # one row
        "odds", F.when(F.col("kind") >= 0, F.expr(own))).drop("weights")


def scan(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, text_key (64-bit hash of the text) and spans, an array of (kind, start, name, end) in
    order of kind and start."""
    rows = scored(stored(proposals(docs), "pii-proposals")).repartition("row_key")
    in_kind = Window.partitionBy("row_key", "kind").orderBy("at")
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(in_kind)).withColumn(
        "start", F.col("end") - F.col("len")).filter(
        (F.col("kind") < 0) | (F.col("good") & ((F.col("kind") < BASE) | (F.col("odds") >= ADD_FROM))))
    base = F.col("kind").between(0, BASE - 1)
    in_order = Window.partitionBy("row_key").orderBy("start", "kind")
    rows = rows.withColumns({
        "reach": F.max(F.when(base, F.col("end"))).over(in_order.rowsBetween(Window.unboundedPreceding, 0)),
        "next": F.min(F.when(base, F.col("start"))).over(in_order.rowsBetween(0, Window.unboundedFollowing))})
    clear = (F.coalesce(F.col("reach"), F.lit(0)) <= F.col("start")) & (
        F.col("next").isNull() | (F.col("next") >= F.col("end")))
    name = F.get(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    return rows.groupBy("row_key", "doc_id", "text_key").agg(F.array_sort(F.collect_list(F.when(
        base | ((F.col("kind") >= BASE) & clear), F.struct("kind", "start", name.alias("name"), "end")))).alias("spans")).drop("row_key")


def _joined(spans: str) -> Column:
    return F.expr(f"array_join(transform({spans}, x -> concat_ws(':', x.name, x.start, x.end)), ',')")


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets, overlapping spans by the kinds of the first; other columns
    and clean texts unchanged. Rows are found again by id and text."""
    found = (scan(docs).filter("size(spans) > 0").dropDuplicates(["doc_id", "text_key"]).select(F.struct(
        "doc_id", "text_key", F.expr("array_sort(transform(spans, x -> struct(x.start AS a, x.end AS b, x.name)))").alias("spans"))
        .alias("q_pii")))
    own = packed(docs).withColumn("q_none", F.lit(0).cast("long"))
    joined = own.join(found, F.col("q_doc.doc_id").eqNullSafe(F.col("q_pii.doc_id"))
                      & (F.xxhash64("q_doc.text") == F.col("q_pii.text_key")), "left")
    text = F.expr(
        "aggregate(q_pii.spans, struct('' AS t, q_none AS upto), (st, x) -> IF(x.a < st.upto, struct(st.t AS t, "
        "greatest(st.upto, x.b) AS upto), struct(concat(st.t, substring(q_doc.text, CAST(st.upto + 1 AS int), "
        "CAST(x.a - st.upto AS int)), '[', upper(x.name), ']') AS t, x.b AS upto)), "
        "st -> concat(st.t, substring(q_doc.text, CAST(st.upto + 1 AS int))))")
    return unpacked(joined, docs.columns, F.when(F.col("q_pii").isNull(), F.col("q_doc.text")).otherwise(text))


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan(table(spark, sf_dir, "documents")).withColumn("base", F.filter("spans", lambda x: x["kind"] < BASE))
    counts = [F.expr(f"CAST(size(filter(base, x -> x.kind = {k})) AS bigint)").alias(f"n_{name}")
              for k, name in enumerate(KINDS[:BASE])]
    return rows.select("doc_id", *counts, F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("spans").alias("spans"))


QUERIES = {"op13_pii": op13_pii}
