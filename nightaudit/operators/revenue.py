"""Posting classification and revenue rollups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightaudit.operators.lookups import lookup, sized_broadcast
from nightaudit.sources.schemas import in_dates

MONEY = "decimal(18,4)"


def tax_codes(trx_codes: DataFrame) -> DataFrame:
    """(resort, trx_code) of tax codes, type 'X'."""
    return trx_codes.where(F.col("trx_code_type") == "X").select("resort", "trx_code")


def child_tax(ft: DataFrame, trx_codes: DataFrame, parents: DataFrame | None = None) -> DataFrame:
    """Per parent posting, the sum of its generated tax children.

    ``SUM(NVL(net,0))`` over children ``trx_no_added_by = trx_no`` whose code is
    a tax code (EXISTS -> left semi join). Children are not limited by date or
    resort. Output (trx_no, child_tax); postings without tax children are
    absent (the scalar SUM would be NULL). ``parents`` (trx_no): only theirs.
    """
    kids = ft.where(F.col("trx_no_added_by").isNotNull()).select(
        "resort", "trx_code", "trx_no_added_by", "net_amount")
    if parents is not None:
        kids = kids.join(parents.select(F.col("trx_no").alias("trx_no_added_by")).distinct(), "trx_no_added_by", "left_semi")
    kids = kids.join(sized_broadcast(tax_codes(trx_codes)), ["resort", "trx_code"], "left_semi")
    return kids.groupBy(F.col("trx_no_added_by").alias("trx_no")).agg(
        F.sum(F.coalesce(F.col("net_amount"), F.lit(0))).cast(MONEY).alias("child_tax"))


def with_child_tax(postings: DataFrame, taxes: DataFrame) -> DataFrame:
    """``postings`` with ``child_tax``, which only tax-exclusive ('N' or NULL) ones are asked for: these alone meet the
    taxes, NULL for the others."""
    exclusive = F.coalesce(F.col("tax_inclusive_yn"), F.lit("N")) == "N"
    return (postings.where(exclusive).join(taxes, "trx_no", "left")
            .unionByName(postings.where(~exclusive).withColumn("child_tax", F.lit(None).cast(MONEY))))


def ledger_detail(ft: DataFrame, trx_codes: DataFrame, resort: str | None = None,
                  d_from=None, d_to=None) -> DataFrame:
    """A5 (ledger detail): charge postings with net room / net package / tax.

    Filters: ``ft_subtype='C'``, ``display_yn <> 'N'`` (drops NULL), ``NVL(invoice_type,'@') <> 'CR'``,
    code not of type 'X' (NULL type dropped), optional resort and date range.
    Tax: tax-exclusive (``NVL(tax_inclusive_yn,'N')='N'``) -> sum of tax children
    (NULL if none, S3); else gross - net.
    """
    cond = ((F.col("ft_subtype") == "C") & (F.col("display_yn") != "N")
            & (F.coalesce(F.col("invoice_type"), F.lit("@")) != "CR"))
    if resort is not None:
        cond = cond & (F.col("resort") == resort)
    codes = sized_broadcast(trx_codes.where(F.col("trx_code_type") != "X")
                            .select("resort", "trx_code", "trx_code_type"))
    postings = (in_dates(ft.where(cond), "trx_date", d_from, d_to)
                .select("trx_no", "resort", "trx_code", "trx_date", "resv_name_id", "original_resv_name_id",
                        "net_amount", "gross_amount", "tax_inclusive_yn", "trx_no_against_package")
                .join(codes, ["resort", "trx_code"]))
    bounded = resort is not None or d_from is not None or d_to is not None
    with_tax = with_child_tax(postings, child_tax(ft, trx_codes, postings if bounded else None))
    ctype = F.col("trx_code_type")
    net = F.col("net_amount")
    return with_tax.select(
        F.coalesce(F.col("original_resv_name_id"), F.col("resv_name_id")).alias("org_resv_id"),
        "trx_date",
        F.coalesce(F.when(ctype == "L", net), F.lit(0)).alias("net_room"),
        F.coalesce(F.when(F.col("trx_no_against_package").isNotNull() & (ctype != "L"), net),
                   F.lit(0)).alias("net_pck"),
        F.when(F.coalesce(F.col("tax_inclusive_yn"), F.lit("N")) == "N", F.col("child_tax"))
        .otherwise(F.col("gross_amount") - net).alias("tax"),
    )


def daily_stay_revenue(detail: DataFrame) -> DataFrame:
    """A6 (daily revenue): per (org_resv_id, trx_date) gross and net room / package.

    Gross adds the tax only where the net part is non-zero; a NULL tax makes
    that posting's term NULL, which SUM skips (S3) - kept on purpose.
    """
    room, pck, tax = F.col("net_room"), F.col("net_pck"), F.col("tax")
    return detail.groupBy("org_resv_id", "trx_date").agg(
        F.sum(room + F.when(room != 0, tax).otherwise(F.lit(0))).cast(MONEY).alias("room_revenue"),
        F.sum(room).cast(MONEY).alias("net_room_revenue"),
        F.sum(pck + F.when(pck != 0, tax).otherwise(F.lit(0))).cast(MONEY).alias("pck_revenue"),
        F.sum(pck).cast(MONEY).alias("net_pck_revenue"),
    )


def calc_tax(tax_inclusive_yn: Column, child_tax_col: Column) -> Column:
    """U1 ``ppf.calc_tax`` as called by the loyalty view: only for tax-exclusive
    ('N') postings, the sum of tax children (0 when none) [assumed body]; NULL
    ``tax_inclusive_yn`` counts as inclusive here, unlike the ledger (A5)."""
    return F.when(tax_inclusive_yn == "N", F.coalesce(child_tax_col, F.lit(0))).otherwise(F.lit(0))


def calc_tax_percentage(tax_inclusive_yn: Column, net: Column, gross: Column, child_tax_col: Column) -> Column:
    """U2 ``ppf.calc_tax_percentage(..., -1)`` [assumed body]: VAT percent of the
    net amount, rounded; -1 when the net amount is 0 or NULL.
    Tax is the child-tax sum for exclusive ('N') postings, else gross - net."""
    tax = F.when(tax_inclusive_yn == "N", F.coalesce(child_tax_col, F.lit(0))).otherwise(gross - net)
    pct = F.round(tax * 100 / net, 0)
    return F.when(net.isNull() | (net == 0) | tax.isNull(), F.lit(-1)).otherwise(pct).cast("int")


# fixed value: the loyalty-points posting code
POINTS_CODE = "1035"


def revenue_classes(ft: DataFrame, trx_codes: DataFrame, resort_products: DataFrame) -> DataFrame:
    """A4: classify loyalty-view postings into room / package / total revenue.

    Input postings: ``ft_subtype='C'`` and not generated. Output per posting:
    trx_no, resort, original_resv_name_id, bill_no, room_revenue, pck_revenue,
    total_revenue, is_anemon_puan.
      room  = type 'L'                                      -> gross + tax
      pck   = product in a package group and type not L/X   -> gross + tax
      total = gross + tax;  tax = calc_tax (U1)
    """
    postings = (ft.where((F.col("ft_subtype") == "C") & F.col("trx_no_added_by").isNull())
                .select("trx_no", "resort", "trx_code", "original_resv_name_id", "bill_no", "product",
                        "gross_amount", "tax_inclusive_yn"))
    codes = sized_broadcast(trx_codes.select("resort", "trx_code", "trx_code_type"))
    p = lookup(postings.join(codes, ["resort", "trx_code"]), resort_products, {"resort": "resort", "product": "product"},
               {"pkg_forcast_group": "pkg_forcast_group"}, "resort_products")
    p = with_child_tax(p, child_tax(ft, trx_codes))
    total = F.col("gross_amount") + calc_tax(F.col("tax_inclusive_yn"), F.col("child_tax"))
    ctype = F.col("trx_code_type")
    in_pkg = F.col("pkg_forcast_group").isNotNull() & ~F.coalesce(ctype, F.lit("@")).isin("L", "X")
    return p.select(
        "trx_no", "resort", "original_resv_name_id", "bill_no",
        F.coalesce(F.when(ctype == "L", total), F.lit(0)).cast(MONEY).alias("room_revenue"),
        F.coalesce(F.when(in_pkg, total), F.lit(0)).cast(MONEY).alias("pck_revenue"),
        total.cast(MONEY).alias("total_revenue"),
        F.when(F.col("trx_code") == POINTS_CODE, F.lit("Y")).otherwise(F.lit("N")).alias("is_anemon_puan"),
    )
