"""Single-row lookups at every call site: a duplicate that nobody asks for passes, an asked one raises (Oracle: ORA-01427)."""

from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from nightaudit.operators import revenue
from nightaudit.operators.contacts import with_contacts
from nightaudit.plans import detail, fiscal, loyalty
from nightaudit.operators.lookups import with_resort

DAY = date(2024, 2, 3)


def _posting(trx_no, resort, code="1000", arrangement=None, product=None, subtype="C"):
    return (trx_no, resort, DAY, code, 1, 1, 1, D(10), D(12), D(12), None, "Y", None, None, subtype, "Y", None, product, 5, 0, arrangement)


CODES = [(r, c, "L", "Room", None, "N") for r in ("R1", "R2") for c in ("1000",)]


def _night(resort, stay):
    return (resort, DAY, 1, stay, *[None] * 14)


def _with_open_dates(t, resort):
    rows = t["resort"].select("resort").where(F.col("resort") == resort)
    return with_resort(rows, detail.resort_info(t), ["open_business_date"])


def _open_rows(t, resort):
    return detail.on_open_date(t["reservation_daily_element_name"].where(F.col("resort") == resort), t)


def _bills(t, resort):
    return t["folio_tax"].where(F.col("resort") == resort)


class Only(dict):
    def __init__(self, t, **own):
        super().__init__(own)
        self.t = t

    def __missing__(self, name):
        return self.t[name]


def _only(t, resort):
    return Only(t, financial_transactions=t["financial_transactions"].where(F.col("resort") == resort))


SITES = {
    "resort": lambda t, r: with_resort(t["businessdate"].select("resort").where(F.col("resort") == r), detail.resort_info(t), ["resort_name"]),
    "open date": _with_open_dates,
    "open date filter": _open_rows,
    "parameter": lambda t, r: fiscal.rule_counts(_only(t, r), _bills(t, r)),
    "arrangement": lambda t, r: fiscal.fiscal_items(_only(t, r), _bills(t, r)),
    "payment name": lambda t, r: fiscal.fiscal_payments(_only(t, r), _bills(t, r)),
    "product group": lambda t, r: revenue.revenue_classes(_only(t, r)["financial_transactions"], t["trx_codes"], t["resort_products"]),
    "departure day": lambda t, r: loyalty.with_departure(t["reservation_name"].select("resort", "resv_name_id").where(F.col("resort") == r),
                                                         loyalty.departure_names(t)),
    "document": lambda t, r: with_contacts(t["name"].select("name_id").where(F.col("name_id") == (1 if r == "R1" else 2)),
                                           t["name_phone"], t["name_document"]),
}
#: What doubles R1's row, by site.
DOUBLED = {
    "resort": {"resort": [("R1", "One", "TRY"), ("R1", "Uno", "TRY"), ("R2", "Two", "EUR")]},
    "open date": {"businessdate": [("R1", DAY, "OPEN"), ("R1", date(2024, 2, 4), "OPEN"), ("R2", DAY, "OPEN")]},
    "open date filter": {"businessdate": [("R1", DAY, "OPEN"), ("R1", date(2024, 2, 4), "OPEN"), ("R2", DAY, "OPEN")]},
    "parameter": {"params": [("R1", "DEPOSIT_LED_TRX_CODE", "1"), ("R1", "DEPOSIT_LED_TRX_CODE", "2"), ("R2", "DEPOSIT_LED_TRX_CODE", "1")]},
    "arrangement": {"trx_code_arrangement": [("R1", 7, "A"), ("R1", 7, "B"), ("R2", 7, "A")]},
    "payment name": {"fin_trx_translation": [("R1", None, "1000", "DESCRIPTION", "MK", x) for x in "ab"]},
    "product group": {"resort_products": [("R1", "P", "G"), ("R1", "P", "H"), ("R2", "P", "G")]},
    "departure day": {"reservation_daily_element_name": [_night("R1", 1), _night("R1", 1), _night("R2", 1)]},
    "document": {"name_document": [(1, "TCKN", "a"), (1, "TCKN", "b"), (2, "TCKN", "c")]},
}


@pytest.mark.parametrize("site", sorted(SITES))
def test_duplicates(tables, site):
    stay = lambda r: (r, 1, 1, 1, "CHECKED OUT", DAY, DAY, *[None] * 10)
    subtype = "FC" if site in ("parameter", "payment name") else "C"
    own = dict(
        resort=[("R1", "One", "TRY"), ("R2", "Two", "EUR")], businessdate=[("R1", DAY, "OPEN"), ("R2", DAY, "OPEN")],
        trx_codes=CODES, reservation_name=[stay("R1"), stay("R2")],
        reservation_daily_element_name=[_night("R1", 1), _night("R2", 1)],
        reservation_daily_elements=[("R1", DAY, 1, *[None] * 7), ("R2", DAY, 1, *[None] * 7)],
        name=[(1, "A", "B", None, None, None), (2, "C", "D", None, None, None)],
        financial_transactions=[_posting(1, "R1", arrangement=7, product="P", subtype=subtype),
                                _posting(2, "R2", arrangement=7, product="P", subtype=subtype)],
        folio_tax=[(5, r, 1, 0, "T", D(12), D(12), None, None) for r in ("R1", "R2")])
    t = tables(**(own | DOUBLED[site]))
    assert len(SITES[site](t, "R2").collect()) >= 1
    with pytest.raises(Exception, match="more than one row"):
        SITES[site](t, "R1").collect()
