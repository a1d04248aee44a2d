"""Ordered string aggregation (A7-A10): Oracle's XMLAGG trick as ``listagg``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def ordered_text_list(value: str, sep: str, order: Sequence[Column]) -> Column:
    """``listagg(value, sep) WITHIN GROUP (ORDER BY order...)``.

    NULL values are skipped and an all-NULL group gives NULL. Implemented as
    ``collect_list`` of (order keys, value) structs, sorted and joined, so the
    order keys may be any expressions.
    """
    keyed = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], F.col(value).alias("_v"))
    items = F.filter(F.array_sort(F.collect_list(keyed)), lambda s: s["_v"].isNotNull())
    return F.when(F.size(items) > 0, F.array_join(F.transform(items, lambda s: s["_v"]), sep))


def bill_number_list(bill_no: str = "bill_no") -> Column:
    """Distinct bill numbers of a group, ascending numerically, comma separated.

    The reference joins the numbers with commas and strips the commas that NULL
    bills leave, so the result is the list of non-NULL bills, and NULL when
    there is none.
    """
    c = F.col(bill_no)
    text = F.array_join(F.transform(F.array_sort(F.collect_set(c)), lambda x: x.cast("string")), ",")
    return F.when(F.count(c) > 0, text)
