"""DuckDB text of the hotel-table derivation (see ``nightaudit.sources.hotel``).

Every oracle query is ``WITH <hotel tables> <query>``; the column expressions
are the very strings the Spark side evaluates, only the row shapes (joins,
explodes, unions) are spelled in DuckDB's dialect here.
"""

from __future__ import annotations

from nightaudit.sources import hotel as H


def _sel(cols, src: str, where: str | None = None) -> str:
    exprs = ", ".join(f"{expr} AS {name}" for name, expr in cols)
    sql = f"SELECT {exprs} FROM ({src}) _s"
    if where:
        sql += f" WHERE {where}"
    return sql


def _fanout(src: str, var: str, upto) -> str:
    return f"SELECT *, unnest(generate_series(0, {upto})) AS {var} FROM ({src}) _f"


def _nation_fanout(table: str) -> str:
    return _fanout("SELECT * FROM nation", "k", H.NATION_FANOUT[table])


OC = "SELECT * FROM orders JOIN customer ON o_custkey = c_custkey"


def _check_union_order():
    names = [c for c, _ in H.CHARGE_COLS]
    assert names == [c for c, _ in H.TAX_CHILD_COLS] == [c for c, _ in H.PAYMENT_COLS]
    assert [c for c, _ in H.GUEST_NAME_COLS] == [c for c, _ in H.AGENT_NAME_COLS]


def table_ctes() -> list[tuple[str, str]]:
    _check_union_order()
    nights = _fanout(OC, "k", H.STAY_NIGHTS)
    charges = _sel(H.CHARGE_COLS,
                   f"SELECT *, {H.POSTING_ORDER} AS pos FROM lineitem "
                   f"JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey")
    suppliers = f"SELECT * FROM ({_fanout('SELECT * FROM supplier', 'j', 1)}) _j WHERE {H.AR_WHERE}"
    return [
        ("resort", _sel(H.RESORT_COLS, "SELECT * FROM nation")),
        ("businessdate", _sel(H.BUSINESSDATE_COLS, _nation_fanout("businessdate"))),
        ("reservation_name", _sel(H.RESERVATION_NAME_COLS,
                                  f"SELECT *, {H.PREV_ORDER_1} AS prev1, {H.PREV_ORDER_2} AS prev2 FROM ({OC}) _o")),
        ("reservation_daily_element_name", _sel(H.DAILY_ELEMENT_NAME_COLS, nights)),
        ("reservation_daily_elements", _sel(
            H.DAILY_ELEMENTS_COLS,
            "SELECT DISTINCT resort, reservation_date, resv_daily_el_seq FROM reservation_daily_element_name")),
        ("name", _sel(H.GUEST_NAME_COLS, "SELECT * FROM customer", H.GUEST_NAME_WHERE)
         + " UNION ALL " + _sel(H.AGENT_NAME_COLS, "SELECT * FROM supplier")),
        ("_charges", charges),
        ("financial_transactions",
         "SELECT * FROM _charges UNION ALL "
         + _sel(H.TAX_CHILD_COLS, "SELECT * FROM _charges", H.TAX_CHILD_WHERE)
         + " UNION ALL " + _sel(H.PAYMENT_COLS, _fanout(OC, "f", 1))),
        ("trx_codes", _sel(H.TRX_CODES_COLS, _nation_fanout("trx_codes"))),
        ("resort_products", _sel(H.RESORT_PRODUCTS_COLS, _nation_fanout("resort_products"),
                                 H.RESORT_PRODUCTS_WHERE)),
        ("currency_exchange_rates", _sel(
            H.FX_COLS,
            "SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey "
            "JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey",
            H.FX_WHERE)),
        ("rate_header", _sel(H.RATE_HEADER_COLS, _nation_fanout("rate_header"), H.RATE_HEADER_WHERE)),
        ("resort_markets", _sel(H.MARKETS_COLS, _nation_fanout("resort_markets"), H.MARKETS_WHERE)),
        ("allotment_header", _sel(H.ALLOTMENT_COLS, _nation_fanout("allotment_header"), H.ALLOTMENT_WHERE)),
        ("name_address", _sel(H.NAME_ADDRESS_COLS, "SELECT * FROM customer", H.NAME_ADDRESS_WHERE)),
        ("reservation_stat_daily", _sel(H.STAT_DAILY_COLS, nights, H.STAT_DAILY_WHERE)),
        ("reservation_summary", _sel(H.SUMMARY_COLS, nights, H.SUMMARY_WHERE)),
        ("ar_account", _sel(H.AR_ACCOUNT_COLS, suppliers)),
        ("ppor_ar", _sel(H.PPOR_AR_COLS, suppliers)),
        ("ppor_name_ar", _sel(H.PPOR_NAME_AR_COLS, "SELECT * FROM supplier", H.PPOR_NAME_AR_WHERE)),
        ("trx_code_arrangement", _sel(H.ARRANGEMENT_COLS, _nation_fanout("trx_code_arrangement"),
                                      H.ARRANGEMENT_WHERE)),
        ("fin_trx_translation", _sel(H.TRANSLATION_COLS, _nation_fanout("fin_trx_translation"))),
        ("pms_terminals", _sel(H.TERMINAL_COLS, "SELECT * FROM nation", H.TERMINAL_WHERE)),
        ("params", _sel(H.PARAMS_COLS, "SELECT * FROM nation", H.PARAMS_WHERE)),
        ("folio_tax", _sel(H.FOLIO_TAX_COLS, _sel(H.FOLIO_TAX_STAGE1, _fanout(OC, "f", 1)))),
        ("name_phone", _sel(H.NAME_PHONE_COLS, _fanout("SELECT * FROM customer", "j", 3), H.PHONE_WHERE)),
        ("name_document", _sel(H.NAME_DOCUMENT_COLS, _fanout("SELECT * FROM customer", "j", 1),
                               H.DOCUMENT_WHERE)),
        ("room_category", _sel(H.ROOM_CATEGORY_COLS, _nation_fanout("room_category"), H.ROOM_CATEGORY_WHERE)),
    ]


def with_hotel_tables(query: str) -> str:
    """Prefix ``query`` with the CTEs it references (and their inputs)."""
    ctes = table_ctes()
    needed = set()
    deps = {"reservation_daily_elements": {"reservation_daily_element_name"},
            "financial_transactions": {"_charges"}}
    low = query.lower()
    for name, _ in ctes:
        if name.startswith("_"):
            continue
        if _mentions(low, name):
            needed.add(name)
            needed |= deps.get(name, set())
    body = ",\n".join(f"{name} AS ({sql})" for name, sql in ctes if name in needed)
    if not body:
        return query
    stripped = query.lstrip()
    if stripped[:4].upper() == "WITH":
        return f"WITH {body},\n{stripped[4:]}"
    return f"WITH {body}\n{query}"


def _mentions(text: str, word: str) -> bool:
    import re
    return re.search(rf"(?<![a-z0-9_]){re.escape(word)}(?![a-z0-9_])", text) is not None
