"""Q7: fiscal gate for new bills - rule outcome and fiscal document.

The reference is a BEFORE INSERT row trigger: per bill it runs three or
four queries against the postings, then accepts, rejects or sends the bill.
Here all bills of a batch are processed at once:

* J10 - a posting belongs to a bill when it is on the same (resort,
  reservation, folio) and its ``bill_no`` is the bill's or NULL (wildcard).
  Postings are aggregated twice - by (folio, bill_no) for billed ones and by
  folio for the NULL-bill ones - and the two aggregates are joined to the
  bills by equality and added. Counts and sums are additive, so this is
  exact, and no posting is ever paired with every bill of its folio.
* rules R2-R7 are one CASE over per-bill columns, first match wins, in the
  reference's order;
* documents (R8) are built only for bills whose outcome is SEND.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightaudit.functions.oracle import is_fractional, text_concat, to_char_int, to_char_money
from nightaudit.operators.lists import ordered_text_list
from nightaudit.operators.lookups import fits_broadcast, lookup, marked, sized_broadcast, stored
from nightaudit.operators.revenue import calc_tax_percentage, child_tax, with_child_tax

FOLIO = ["resort", "resv_name_id", "folio_view"]

#: What the gate reads of a posting.
POSTING = ["trx_no", *FOLIO, "bill_no", "trx_code", "ft_subtype", "trx_no_added_by", "gross_amount", "net_amount",
           "tax_inclusive_yn", "arrangement_id", "guest_account_credit", "guest_account_debit"]

# fixed values from the reference trigger
DEPOSIT_PARAM = "DEPOSIT_LED_TRX_CODE"
TRANSLATION_LANGUAGE = "MK"
MSG_RULE3 = "RuleErr(3):You cannot use different payment types together"
MSG_RULE4 = "RuleErr(4): You cannot use positive posting in the return invoice."
MSG_RULE5 = "RuleErr(5): The total amount must be an integer. Users must rebate decimal numbers."
MSG_TERMINAL = "terminal not found or not unique"

def _deposit_codes(t) -> DataFrame:
    """U3 ``ppf.get_param(resort, 'DEPOSIT_LED_TRX_CODE')`` as a (resort, value) table."""
    return t["params"].where(F.col("param") == DEPOSIT_PARAM).select("resort", "value")


def posting_rows(t, bills: DataFrame | None = None, small_batch: bool = False, more: list[str] | None = None,
                 where: Column | None = None) -> DataFrame:
    """Postings with their code attributes (inner join, as the reference) and
    the resort's deposit code.

    With ``bills``, only postings on those bills' folios are kept, before any
    aggregation (a left semi join on the folio key). ``small_batch``: the
    bills are a bounded micro-batch, so their folio keys are broadcast after
    a size check and the postings are filtered without being shuffled.
    ``where``: a condition that all wanted postings meet.
    """
    codes = sized_broadcast(t["trx_codes"].select("resort", "trx_code", "trx_code_type", "description",
                                                  "cc_type", "ind_billing"))
    ft = t["financial_transactions"].select(*POSTING, *(more or []))
    if where is not None:
        ft = ft.where(where)
    if bills is not None:
        folios = bills.select(*FOLIO).distinct()
        if small_batch:  # at most one row per bill of the batch
            folios = sized_broadcast(folios)
        ft = ft.join(folios, FOLIO, "left_semi")
    return lookup(ft.join(codes, ["resort", "trx_code"]), _deposit_codes(t), {"resort": "resort"},
                  {"value": "deposit_code"}, "params")


def per_bill(bills: DataFrame, rows: DataFrame, group: list[str], sums: dict[str, str]) -> DataFrame:
    """Wildcard bill match (J10) for additive aggregates.

    ``rows`` carry FOLIO + bill_no + ``group`` columns; returns, per bill
    (FOLIO + bill_no) and ``group`` value, ``SUM(rows[src]) AS out`` for each
    ``out: src`` of ``sums``, over the bill's own rows plus the NULL-bill rows
    of its folio. Both parts are pre-aggregated before they meet the bills.
    """
    aggs = [F.sum(src).alias(out) for out, src in sums.items()]
    billed = rows.where(F.col("bill_no").isNotNull()).groupBy(*FOLIO, "bill_no", *group).agg(*aggs)
    loose = rows.where(F.col("bill_no").isNull()).groupBy(*FOLIO, *group).agg(*aggs)
    # a bill may come twice in a batch; its postings count once
    b = bills.where(F.col("bill_no").isNotNull()).select(*FOLIO, "bill_no").distinct()
    from_billed = billed.join(b, [*FOLIO, "bill_no"], "left_semi")
    from_loose = loose.join(b, FOLIO).select(*FOLIO, "bill_no", *group, *sums)
    return (from_billed.unionByName(from_loose)
            .groupBy(*FOLIO, "bill_no", *group).agg(*[F.sum(out).alias(out) for out in sums]))


def batch_postings(t, bills: DataFrame) -> DataFrame:
    """The postings of a bounded micro-batch's folios, for callers that cache
    them once and pass them to every step (``postings=``). Reads ``bills`` once
    for the range of their reservations: what lies outside is left out by the
    scan. Folios too many to broadcast leave the other postings of that range in:
    every step restricts or counts them per bill itself, so they are not moved for it."""
    return posting_rows(t, bills if few_folios(bills) else None, small_batch=True,
                        where=in_range("resv_name_id", bills, "resv_name_id"))


class _With(dict):
    """The hotel tables with other postings in the place of the stored ones."""

    def __init__(self, t, postings: DataFrame):
        super().__init__(financial_transactions=postings)
        self._t = t

    def __missing__(self, name: str):
        return self._t[name]


def sent_postings(t, send: DataFrame) -> DataFrame:
    """The postings on the folios of ``send`` that a document can have a line of, read and moved once and stored: charges
    with an amount whose code is no tax, and payments. Of the others only those move whose folio shares a mark with one of
    ``send``."""
    deposits = _deposit_codes(t).select("resort", F.col("value").alias("trx_code")).distinct()
    kinds = (t["trx_codes"].groupBy("resort", "trx_code").agg(F.max(F.coalesce("trx_code_type", F.lit("@")) != "X").alias("_charge"))
             .join(deposits.withColumn("_deposit", F.lit(True)), ["resort", "trx_code"], "left"))
    line = ((F.col("gross_amount") != 0) & F.col("_charge")) | (
        F.col("trx_no_added_by").isNull() & ((F.col("ft_subtype") == "FC") | F.col("_deposit")))
    rows = (t["financial_transactions"].select(*POSTING).join(sized_broadcast(kinds), ["resort", "trx_code"]).where(line)
            .select(*POSTING))
    folios = send.select(*FOLIO).distinct()
    if fits_broadcast(folios):
        folios = F.broadcast(folios)
    else:
        rows = marked(rows, FOLIO, folios)
    # the folios are distinct: a left semi join would be moved in front of the marks
    return posting_rows(_With(t, stored(rows.join(folios, FOLIO).select(*POSTING), "fiscal-postings")))


def few_folios(bills: DataFrame) -> bool:
    """Can the folios of ``bills`` be broadcast?"""
    return fits_broadcast(bills.select(*FOLIO).distinct())


def in_range(column: str, keys: DataFrame, key: str) -> Column:
    """Does ``column`` lie between the least and the greatest ``key`` (two values come to the driver)? Holds for every row
    that equals one of them."""
    least, greatest = keys.agg(F.min(key), F.max(key)).first()
    return F.col(column).between(least, greatest)


def _restricted(p: DataFrame, bills: DataFrame) -> DataFrame:
    return p.join(bills.select(*FOLIO).distinct(), FOLIO, "left_semi")


def rule_counts(t, bills: DataFrame, small_batch: bool = False, postings: DataFrame | None = None,
                only_their_folios: bool = True) -> DataFrame:
    """Per bill, the rule-6 payment count and the positive-posting count. The postings of a small batch are restricted
    to its folios; else all are counted per bill before they move, and the counts meet the bills."""
    p = postings if postings is not None else posting_rows(t, bills if only_their_folios and small_batch else None, small_batch)
    return per_bill(bills, counted_rows(p), [], {"mpay_count": "m", "ppost_count": "p"})


def counted_rows(p: DataFrame, *more: str) -> DataFrame:
    """The postings that a rule counts: FOLIO, bill_no, ``m`` (1 for a rule-6 payment), ``p`` (1 for a positive posting)
    and ``more`` of their columns."""
    mpay = ((F.col("trx_no_added_by").isNull() & (F.col("ft_subtype") == "FC")
             & (F.col("deposit_code") != F.col("trx_code")) & (F.col("ind_billing") == "N")))
    ppost = (F.col("gross_amount") > 0) & (F.coalesce(F.col("trx_code_type"), F.lit("@")) != "X")
    mpay, ppost = F.coalesce(mpay, F.lit(False)), F.coalesce(ppost, F.lit(False))
    return p.where(mpay | ppost).select(*FOLIO, "bill_no", mpay.cast("int").alias("m"), ppost.cast("int").alias("p"), *more)


def _terminals(t) -> DataFrame:
    """Per station, how many rows and the trimmed address (SELECT INTO
    raises on 0 or >1 rows, which rejects the bill)."""
    return (t["pms_terminals"].groupBy("station_id")
            .agg(F.count(F.lit(1)).alias("terminal_rows"), F.max(F.trim(F.col("description"))).alias("url")))


def fiscal_outcomes(t, bills: DataFrame | None = None, small_batch: bool = False,
                    postings: DataFrame | None = None, counts: DataFrame | None = None,
                    with_bill: bool = False) -> DataFrame:
    """One outcome per bill: (bill_no, resort, resv_name_id, folio_view, outcome, message, url).
    ``counts``: the bills' rule counts, where they are kept between batches; ``with_bill``: with the bill's terminal and
    payments."""
    every = bills is None
    bills = t["folio_tax"] if every else bills
    if counts is None:
        counts = rule_counts(t, bills, small_batch, postings, only_their_folios=not every)
    b = (bills.join(counts, [*FOLIO, "bill_no"], "left")
         .join(sized_broadcast(_terminals(t)), F.col("terminal") == F.col("station_id"), "left"))
    total = F.coalesce(F.col("total_gross"), F.lit(0))
    paid = F.coalesce(F.col("cashpay"), F.lit(0)) + F.coalesce(F.col("ccpay"), F.lit(0))
    mpay = F.coalesce(F.col("mpay_count"), F.lit(0))
    ppost = F.coalesce(F.col("ppost_count"), F.lit(0))
    outcome = (F.when(total == 0, "PASS_ZERO")
               .when(mpay > 0, "PASS_RULE6")
               .when(total == paid,
                     F.when((ppost > 0) & (F.col("total_gross") < 0), "REJECT_RULE4")
                     .when(is_fractional(F.col("total_gross")), "REJECT_RULE5")
                     .when(F.coalesce(F.col("terminal_rows"), F.lit(0)) != 1, "REJECT_TERMINAL")
                     .when(F.upper(F.col("url")).like("%HTTP%"), "SEND")
                     .otherwise("PASS_NO_DEVICE"))
               .when((paid > 0) & (paid != total), "REJECT_RULE3")
               .otherwise("PASS_NO_CASH"))
    message = (F.when(F.col("outcome") == "REJECT_RULE3", MSG_RULE3)
               .when(F.col("outcome") == "REJECT_RULE4", MSG_RULE4)
               .when(F.col("outcome") == "REJECT_RULE5", MSG_RULE5)
               .when(F.col("outcome") == "REJECT_TERMINAL", MSG_TERMINAL))
    return (b.select("bill_no", "resort", "resv_name_id", "folio_view", "total_gross", outcome.alias("outcome"),
                     "url", *(["terminal", "cashpay", "ccpay", "deposit"] if with_bill else []))
            .withColumn("message", message))


def fiscal_items(t, bills: DataFrame, only_their_folios: bool = False, small_batch: bool = False,
                 postings: DataFrame | None = None, theirs: bool = False) -> DataFrame:
    """A9 + J12j + U2: per bill the item groups (code, description, VAT) with
    ``SUM(gross) <> 0``; ``price`` is ``ABS(SUM(gross))`` and ``item`` its JSON text. ``theirs``: the given postings are
    those of the bills' folios."""
    p = postings if theirs else _restricted(postings, bills) if postings is not None else \
        posting_rows(t, bills if only_their_folios else None, small_batch)
    tr = t["fin_trx_translation"].where((F.col("translated_column") == "Arrangement_desc")
                                        & (F.col("language_code") == TRANSLATION_LANGUAGE))
    key = {"resort": "resort", "arrangement_id": "arrangement_id"}
    rows = p.where((F.col("gross_amount") != 0) & (F.coalesce(F.col("trx_code_type"), F.lit("@")) != "X"))
    rows = lookup(rows, t["trx_code_arrangement"], key, {"arrangement_code": "arrangement_code"}, "trx_code_arrangement")
    # the taxes of a small batch are looked for by its postings, or in their range if these are given; else their sums are
    # smaller than the postings to restrict by
    ft = t["financial_transactions"]
    if postings is not None:
        ft = ft.where(in_range("trx_no_added_by", postings, "trx_no"))
    taxes = child_tax(ft, t["trx_codes"], p if postings is None and small_batch else None)
    rows = (with_child_tax(lookup(rows, tr, key, {"description": "_tr_desc"}, "arrangement translation"), taxes)
            .select(*FOLIO, "bill_no",
                    F.coalesce(F.col("arrangement_code"), F.col("trx_code")).alias("item_code"),
                    F.coalesce(F.col("_tr_desc"), F.col("description")).alias("item_name"),
                    calc_tax_percentage(F.col("tax_inclusive_yn"), F.col("net_amount"), F.col("gross_amount"),
                                        F.col("child_tax")).alias("vat_rate"),
                    "gross_amount"))
    g = per_bill(bills, rows, ["item_code", "item_name", "vat_rate"], {"amount": "gross_amount"})
    g = g.where(F.col("amount") != 0)
    text = text_concat('{"TrxCode":"', F.col("item_code"), '","ItemName": "', F.col("item_name"),
                       '","VatRate": ', to_char_int(F.col("vat_rate")), ',"Price": ',
                       to_char_money(F.abs(F.col("amount"))), ',"Quantity":1', "}")
    return g.select(*FOLIO, "bill_no", "item_code", "item_name", "vat_rate",
                    F.abs(F.col("amount")).cast("decimal(18,2)").alias("price"),
                    F.replace(F.trim(text), F.lit(" "), F.lit("")).alias("item"))


def payment_rows(t, p: DataFrame, *more: str) -> DataFrame:
    """The payments among the postings ``p``: FOLIO, bill_no, trx_code, pay_name, card, payment and ``more``."""
    tr = t["fin_trx_translation"].where((F.col("translated_column") == "DESCRIPTION")
                                        & (F.col("language_code") == TRANSLATION_LANGUAGE))
    is_payment = F.col("trx_no_added_by").isNull() & (
        (F.col("ft_subtype") == "FC") | (F.col("deposit_code") == F.col("trx_code")))
    rows = lookup(p.where(is_payment), tr, {"resort": "resort", "trx_code": "trx_code"}, {"description": "_tr_desc"},
                  "payment translation")
    return rows.select(*FOLIO, "bill_no", "trx_code",
                       F.coalesce(F.col("_tr_desc"), F.col("description")).alias("pay_name"),
                       F.when(F.col("cc_type").isNotNull(), F.lit("1")).otherwise(F.lit("0")).alias("card"),
                       (F.coalesce(F.col("guest_account_credit"), F.lit(0))
                        - F.coalesce(F.col("guest_account_debit"), F.lit(0))).alias("payment"), *more)


PAYMENT = ["trx_code", "pay_name", "card"]


def fiscal_payments(t, bills: DataFrame, only_their_folios: bool = False, small_batch: bool = False,
                    postings: DataFrame | None = None, rows: DataFrame | None = None, theirs: bool = False) -> DataFrame:
    """A10 + U3: per bill the payment groups (code, description, card flag)
    with ``SUM(credit - debit) <> 0``; ``total`` is the absolute sum. ``theirs``: as for the items. ``rows``: FOLIO, bill_no, group and payment, where
    they are kept between batches."""
    if rows is None:
        rows = payment_rows(t, postings if theirs else _restricted(postings, bills) if postings is not None else
                            posting_rows(t, bills if only_their_folios else None, small_batch))
    g = per_bill(bills, rows, PAYMENT, {"amount": "payment"})
    g = g.where(F.col("amount") != 0)
    text = text_concat('{"TrxCode":', F.col("trx_code"), ',"Name": "', F.col("pay_name"),
                       '","PaymentType":0 ', ',"OptionPaymentType": ', F.col("card"), ',"Total": ',
                       to_char_money(F.abs(F.col("amount"))), "}")
    return g.select(*FOLIO, "bill_no", *PAYMENT,
                    F.abs(F.col("amount")).cast("decimal(18,2)").alias("total"),
                    F.replace(F.trim(text), F.lit(" "), F.lit("")).alias("item"))


def fiscal_documents(t, outcomes: DataFrame, small_batch: bool = False,
                     postings: DataFrame | None = None, payments: DataFrame | None = None) -> DataFrame:
    """The JSON document of every SEND bill: (resort, bill_no, url, document).
    Only the postings of the SEND bills' folios are aggregated; but for a small batch they are stored first."""
    send = outcomes.where(F.col("outcome") == "SEND").select(*FOLIO, "bill_no", "total_gross", "url")
    theirs = postings is None and not small_batch
    postings = sent_postings(t, send) if theirs else postings
    items = fiscal_items(t, send, True, small_batch, postings, theirs).groupBy(*FOLIO, "bill_no").agg(
        ordered_text_list("item", ",", [F.col("item_code"), F.col("item_name"), F.col("vat_rate")]).alias("_items"))
    pays = fiscal_payments(t, send, True, small_batch, postings, payments, theirs).groupBy(*FOLIO, "bill_no").agg(
        ordered_text_list("item", ",", [F.col("trx_code"), F.col("pay_name"), F.col("card")]).alias("_pays"))
    doc = text_concat('{"FiscalDocType": ',
                      F.when(F.col("total_gross") > 0, F.lit("1")).otherwise(F.lit("0")),
                      ',"TransactionID" : "', F.col("resort"), "-", F.col("bill_no").cast("string"), '",',
                      '"Items":[', F.col("_items"), "]", ",", '"Payments":[', F.col("_pays"), "]", "}")
    return (send.join(items, [*FOLIO, "bill_no"], "left").join(pays, [*FOLIO, "bill_no"], "left")
            .select("resort", "bill_no", "url", doc.alias("document")))


#: The document's fields and their types.
DOCUMENT_TYPE = ("FiscalDocType int, TransactionID string, "
                 "Items array<struct<TrxCode: string, ItemName: string, VatRate: int, Price: decimal(18,2), Quantity: int>>, "
                 "Payments array<struct<TrxCode: string, Name: string, PaymentType: int, OptionPaymentType: int, "
                 "Total: decimal(18,2)>>")


def fiscal_documents_json(t, outcomes: DataFrame, small_batch: bool = False,
                          postings: DataFrame | None = None, payments: DataFrame | None = None) -> DataFrame:
    """R8 in ``json`` mode: the same documents as typed values, escaped by ``to_json``, lines in order of their fields.
    Texts keep their blanks, and quotes and backslashes in them do no harm. A bill without lines has empty arrays."""
    send = outcomes.where(F.col("outcome") == "SEND").select(*FOLIO, "bill_no", "total_gross", "url")
    item = F.struct(F.col("item_code").alias("TrxCode"), F.col("item_name").alias("ItemName"), F.col("vat_rate").alias("VatRate"),
                    F.col("price").alias("Price"), F.lit(1).alias("Quantity"))
    pay = F.struct(F.col("trx_code").alias("TrxCode"), F.col("pay_name").alias("Name"), F.lit(0).alias("PaymentType"),
                   F.col("card").cast("int").alias("OptionPaymentType"), F.col("total").alias("Total"))
    theirs = postings is None and not small_batch
    postings = sent_postings(t, send) if theirs else postings
    items = fiscal_items(t, send, True, small_batch, postings, theirs).groupBy(*FOLIO, "bill_no").agg(
        F.array_sort(F.collect_list(item)).alias("_items"))
    pays = fiscal_payments(t, send, True, small_batch, postings, payments, theirs).groupBy(*FOLIO, "bill_no").agg(
        F.array_sort(F.collect_list(pay)).alias("_pays"))
    both = send.join(items, [*FOLIO, "bill_no"], "left").join(pays, [*FOLIO, "bill_no"], "left")
    document = F.struct(
        F.when(F.col("total_gross") > 0, 1).otherwise(0).alias("FiscalDocType"),
        F.concat_ws("-", "resort", F.col("bill_no").cast("string")).alias("TransactionID"),
        F.coalesce("_items", F.array()).alias("Items"), F.coalesce("_pays", F.array()).alias("Payments"))
    return both.select("resort", "bill_no", "url", F.to_json(document, {"ignoreNullFields": "false"}).alias("document"))


def document_lines(documents: DataFrame) -> DataFrame:
    """The lines of ``json`` documents, read back from their text: (resort, bill_no, fiscal_doc_type, transaction_id, part,
    pos, code, name, vat_rate, card, amount); a text that does not parse raises."""
    parsed = documents.select("resort", "bill_no", F.from_json("document", DOCUMENT_TYPE, {"mode": "FAILFAST"}).alias("d"))
    none = F.lit(None).cast("int")
    items = F.transform("d.Items", lambda x, i: F.struct(
        F.lit("item").alias("part"), (i + 1).alias("pos"), x["TrxCode"].alias("code"), x["ItemName"].alias("name"),
        x["VatRate"].alias("vat_rate"), none.alias("card"), x["Price"].alias("amount")))
    pays = F.transform("d.Payments", lambda x, i: F.struct(
        F.lit("payment").alias("part"), (i + 1).alias("pos"), x["TrxCode"].alias("code"), x["Name"].alias("name"),
        none.alias("vat_rate"), x["OptionPaymentType"].alias("card"), x["Total"].alias("amount")))
    return parsed.select("resort", "bill_no", F.col("d.FiscalDocType").alias("fiscal_doc_type"),
                         F.col("d.TransactionID").alias("transaction_id"), F.explode(F.concat(items, pays)).alias("x")).select(
        "resort", "bill_no", "fiscal_doc_type", "transaction_id", "x.*")


def stored_outcomes(t, bills: DataFrame | None = None, small_batch: bool = False,
                    path: str | None = None, postings: DataFrame | None = None) -> DataFrame:
    """``fiscal_outcomes`` computed once and written as a table (default: a fresh
    folder under the shared ``spark.checkpoint.dir``); the documents, which use
    the outcomes three times, then start from the stored table."""
    outcomes = fiscal_outcomes(t, bills, small_batch, postings)
    if path is None:
        return stored(outcomes, "fiscal-outcomes")
    outcomes.write.mode("overwrite").parquet(path)
    return outcomes.sparkSession.read.parquet(path)


def fiscal_gate(t, bills: DataFrame | None = None, small_batch: bool = False,
                outcomes_path: str | None = None, postings: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Batch form of the trigger: (outcomes, documents) for ``bills``.
    ``postings``: the bills' postings (``batch_postings``), when the caller caches them."""
    outcomes = stored_outcomes(t, bills, small_batch, outcomes_path, postings)
    return outcomes, fiscal_documents(t, outcomes, small_batch, postings)
