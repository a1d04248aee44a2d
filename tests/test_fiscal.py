"""Fiscal trigger rules R2-R9 on hand fixtures: one bill per outcome."""

from decimal import Decimal as D

from nightaudit.plans.fiscal import fiscal_gate


def _ft(trx_no, resv, folio, bill, code, subtype="C", gross=None, net=None, credit=None, debit=None,
        incl="Y", added_by=None, arrangement=None):
    return (trx_no, "R1" if resv < 100 else "R3", None, code, resv, resv, 1,
            None if net is None else D(net), None if gross is None else D(gross),
            None if credit is None else D(credit), None if debit is None else D(debit),
            incl, added_by, None, subtype, "Y", None, None, bill, folio, arrangement)


def _bill(bill, resv, total, cash=None, cc=None, terminal="T0", folio=0):
    m = lambda x: None if x is None else D(x)
    return (bill, "R1" if resv < 100 else "R3", resv, folio, terminal, m(total), m(cash), m(cc), None)


CODES = [(r, c, typ, desc, cc, ind) for r in ("R1", "R3") for c, typ, desc, cc, ind in [
    ("1000", "L", "Room Night", None, "Y"), ("9000", "X", "VAT", None, "Y"), ("8000", "P", "Cash", None, "Y"),
    ("8001", "P", "Credit Card", "VA", "Y"), ("8002", "P", "City Ledger", None, "N"),
    ("8003", "P", "Deposit", None, "Y")]]


def _tables(tables):
    return tables(
        trx_codes=CODES,
        params=[("R1", "DEPOSIT_LED_TRX_CODE", "8003")],          # R3 has no deposit code (NULL)
        pms_terminals=[("T0", " http://fiscal:7479/api/ "), ("T1", "LOCAL"), ("T2", None),
                       ("T9", "http://a"), ("T9", "http://b")],  # T9 duplicated, T5 absent
        trx_code_arrangement=[("R1", 1, "ARR1")],
        fin_trx_translation=[("R1", 1, None, "Arrangement_desc", "MK", "Aranzman 1"),
                             ("R1", None, "8000", "DESCRIPTION", "MK", "Gotovina")],
        financial_transactions=[
            _ft(1, 2, 0, 2, "8002", subtype="FC", credit="100"),                    # rule 6 payment
            _ft(2, 3, 0, 3, "1000", gross="100", net="90"),
            _ft(3, 3, 0, 3, "8000", subtype="FC", credit="100"),
            _ft(4, 3, 0, None, "1000", gross="10", net="10", incl="N"),            # wildcard posting
            _ft(5, 3, 0, None, "9000", gross="1", net="1", added_by=4),             # its tax child
            _ft(6, 3, 0, 999, "1000", gross="55", net="55"),                        # other bill: not ours
            _ft(7, 3, 0, 3, "1000", gross="5", net="5", arrangement=1),
            _ft(8, 3, 0, 3, "1000", gross="7", net="7"),
            _ft(9, 3, 0, 3, "1000", gross="-7", net="-7"),                          # nets out with 8
            _ft(10, 6, 0, None, "1000", gross="10", net="10"),                      # positive on a return bill
            _ft(11, 103, 0, 113, "8002", subtype="FC", credit="100"),               # NULL deposit param
        ])


BILLS = [
    _bill(1, 1, None),                                 # PASS_ZERO
    _bill(2, 2, "100", cash="100"),                    # PASS_RULE6
    _bill(3, 3, "100", cash="100"),                    # SEND
    _bill(4, 4, "100", cash="100", terminal="T1"),     # PASS_NO_DEVICE
    _bill(5, 5, "100", cash="100", terminal="T5"),     # REJECT_TERMINAL (absent)
    _bill(6, 6, "-50", cash="-50"),                    # REJECT_RULE4
    _bill(7, 7, "100.50", cash="100.50"),              # REJECT_RULE5
    _bill(8, 8, "100", cash="30", cc="20"),            # REJECT_RULE3
    _bill(9, 9, "100"),                                # PASS_NO_CASH
    _bill(10, 10, "-50", cash="-20"),                  # PASS_NO_CASH (negative, cash+cc <= 0)
    _bill(11, 11, "100", cash="100", terminal="T9"),   # REJECT_TERMINAL (duplicated)
    _bill(12, 12, "100", cash="100", terminal="T2"),   # PASS_NO_DEVICE (NULL address)
    _bill(113, 103, "100", cash="100", terminal="T1"),  # rule 6 off without a deposit code
    _bill(14, 14, "0", cash="5"),                      # PASS_ZERO
]

EXPECTED = {1: "PASS_ZERO", 2: "PASS_RULE6", 3: "SEND", 4: "PASS_NO_DEVICE", 5: "REJECT_TERMINAL",
            6: "REJECT_RULE4", 7: "REJECT_RULE5", 8: "REJECT_RULE3", 9: "PASS_NO_CASH", 10: "PASS_NO_CASH",
            11: "REJECT_TERMINAL", 12: "PASS_NO_DEVICE", 113: "PASS_NO_DEVICE", 14: "PASS_ZERO"}


def test_one_outcome_per_bill(spark, tables):
    t = _tables(tables)
    bills = spark.createDataFrame(BILLS, "bill_no bigint, resort string, resv_name_id bigint, folio_view int, "
                                         "terminal string, total_gross decimal(18,2), cashpay decimal(18,2), "
                                         "ccpay decimal(18,2), deposit decimal(18,2)")
    outcomes, documents = fiscal_gate(t, bills)
    got = {r.bill_no: r.outcome for r in outcomes.collect()}
    assert got == EXPECTED
    msgs = {r.bill_no: r.message for r in outcomes.collect()}
    assert msgs[8].startswith("RuleErr(3)") and msgs[6].startswith("RuleErr(4)") and msgs[7].startswith("RuleErr(5)")

    docs = {r.bill_no: r.document for r in documents.collect()}
    assert set(docs) == {3}
    assert docs[3] == (
        '{"FiscalDocType": 1,"TransactionID" : "R1-3",'
        '"Items":[{"TrxCode":"1000","ItemName":"RoomNight","VatRate":10,"Price":10.00,"Quantity":1},'
        '{"TrxCode":"1000","ItemName":"RoomNight","VatRate":11,"Price":100.00,"Quantity":1},'
        '{"TrxCode":"ARR1","ItemName":"Aranzman1","VatRate":0,"Price":5.00,"Quantity":1}],'
        '"Payments":[{"TrxCode":8000,"Name":"Gotovina","PaymentType":0,"OptionPaymentType":0,"Total":100.00}]}')
