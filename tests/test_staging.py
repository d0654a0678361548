"""Staging models on hand-made raw rows (cases the fixture does not cover)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

from bankmart.operators import staging
from bankmart.sources import schemas


def raw(spark, schema, rows):
    return spark.createDataFrame(rows, schema)


def cust(cid, first, last, seg="RETAIL", created=dt.date(2020, 1, 1), zip_code="80201"):
    return (cid, first, last, "X@Y.COM ", " 303-1 ", seg, " digital", "co", zip_code, created,
            dt.datetime(2024, 1, 1))


def test_stg_customers(spark, cfg):
    rows = [cust("C1", " mary-jane ", "o'brien"), cust("C2", "ann", None),
            cust(None, "x", "y"), cust("C3", "bo", "li", seg=" premium ",
                                       created=dt.date(2023, 6, 15), zip_code="02134"),
            cust("C4", "al", "ng", created=dt.date(2024, 7, 1))]
    out = {r.customer_id: r for r in
           staging.stg_customers(raw(spark, schemas.CUSTOMERS, rows), cfg).collect()}
    assert set(out) == {"C1", "C2", "C3", "C4"}          # null key dropped
    c1 = out["C1"]
    assert (c1.first_name, c1.last_name, c1.full_name) == ("Mary-Jane", "O'brien", "Mary-Jane O'brien")
    assert out["C2"].full_name is None                   # a missing part nulls the name
    assert c1.email == "x@y.com" and c1.phone == "303-1" and c1.state == "CO"
    assert c1.acquisition_channel == "DIGITAL"
    assert out["C3"].is_premium_customer and out["C3"].customer_segment == "PREMIUM"
    assert out["C3"].zip_code == "02134"                 # stays text
    assert out["C3"].is_new_customer                     # exactly one year before as_of
    assert not c1.is_new_customer
    assert out["C4"].customer_tenure_days == -16         # future date: negative tenure
    assert c1.customer_tenure_days == (dt.date(2024, 6, 15) - dt.date(2020, 1, 1)).days


def test_stg_accounts(spark, cfg):
    def acct(aid, typ, status, closed, bal="10.00"):
        return (aid, "C1", typ, status, " usd", D(bal) if bal else None, D("1.00"), D("0.0150"),
                dt.date(2024, 6, 1), closed, dt.datetime(2024, 1, 1))
    rows = [acct("A1", " checking", "closed ", dt.date(2024, 6, 2)),
            acct("A2", "cd", "CLOSED", None), acct("A3", "brokerage", "active", None, None),
            acct(None, "cd", "ACTIVE", None)]
    out = {r.account_id: r for r in
           staging.stg_accounts(raw(spark, schemas.ACCOUNTS, rows), cfg).collect()}
    assert set(out) == {"A1", "A2", "A3"}
    assert out["A1"].is_closed and not out["A2"].is_closed   # closed needs a closing date
    assert out["A1"].account_category == "DEPOSIT"
    assert out["A2"].account_category == "TERM_DEPOSIT"
    assert out["A3"].account_category == "OTHER" and out["A3"].is_active
    assert out["A3"].balance is None
    assert out["A1"].currency_code == "USD" and out["A1"].account_age_days == 14


def test_stg_transactions(spark, cfg):
    def txn(tid, typ, status, amount, date):
        return (tid, "A1", typ, status, " atm", " 0042 ", " x ", D(amount), date,
                date, dt.datetime(2024, 1, 1) if date else None)
    rows = [txn("T1", "debit ", "posted", "12.50", dt.date(2024, 3, 3)),
            txn("T2", "credit", "POSTED", "-3.00", dt.date(2024, 3, 9)),
            txn("T3", "transfer", "pending", "-7.00", dt.date(2022, 1, 1)),
            txn("T4", "fee", "posted", "2.00", dt.date(2021, 12, 31)),   # before start_date
            txn("T5", "reversal", "reversed", "1.00", None),             # null date drops
            txn(None, "debit", "posted", "1.00", dt.date(2024, 1, 1))]
    out = {r.transaction_id: r for r in
           staging.stg_transactions(raw(spark, schemas.TRANSACTIONS, rows), cfg).collect()}
    assert set(out) == {"T1", "T2", "T3"}
    assert out["T1"].amount == D("-12.50") and out["T1"].amount_abs == D("12.50")
    assert out["T2"].amount == D("3.00")
    assert out["T3"].amount == D("-7.00")                 # other types keep their sign
    assert out["T1"].transaction_month == dt.date(2024, 3, 1)
    assert out["T1"].transaction_year == dt.date(2024, 1, 1)
    assert out["T1"].day_of_week == 0 and out["T2"].day_of_week == 6
    assert out["T1"].is_posted and not out["T3"].is_posted
    assert out["T1"].merchant_category_code == "0042" and out["T1"].channel == "ATM"
    assert out["T1"].transaction_status == "POSTED"


def test_stg_loans(spark, cfg):
    def loan(lid, status, principal, outstanding):
        return (lid, "C1", "auto ", status, D(principal) if principal is not None else None,
                D(outstanding), D("0.0500"), D("10.00"), dt.date(2024, 1, 31), None, None,
                dt.datetime(2024, 1, 1))
    rows = [loan("L1", " delinquent_30", "1000.00", "250.00"),
            loan("L2", "DELINQUENT_120", "0.00", "10.00"),
            loan("L3", None, None, "10.00"), loan("L4", "charged_off", "3.00", "2.00")]
    out = {r.loan_id: r for r in staging.stg_loans(raw(spark, schemas.LOANS, rows), cfg).collect()}
    assert out["L1"].risk_tier == "2_DPD_30" and out["L1"].is_delinquent
    assert out["L1"].amount_paid_down == D("750.00") and out["L1"].pct_paid_down == D("75.00")
    assert out["L2"].risk_tier == "9_UNKNOWN" and out["L2"].is_delinquent
    assert out["L2"].pct_paid_down is None                # zero principal
    assert out["L3"].risk_tier == "9_UNKNOWN" and not out["L3"].is_delinquent
    assert out["L3"].amount_paid_down is None
    assert out["L4"].is_charged_off and not out["L4"].is_delinquent
    assert out["L4"].pct_paid_down == D("33.33")
    assert out["L1"].loan_age_months == 5                 # Jan 31 -> Jun 15


def test_stg_credit_cards(spark, cfg):
    def card(cid, status, limit, balance):
        return (cid, "C1", status, "gold", "points ", D(limit), D(balance), D("1"), D("1"),
                D("75"), D("0.1999"), dt.date(2023, 12, 31), None, None, None,
                dt.datetime(2024, 1, 1))
    rows = [card("K1", "active", "1000.00", "900.00"), card("K2", "Pending_Activation", "0.00", "5.00"),
            card("K3", "SUSPENDED", "3000.00", "2099.99"), card("K4", "ACTIVE", "3.00", "2.00")]
    out = {r.card_id: r for r in
           staging.stg_credit_cards(raw(spark, schemas.CREDIT_CARDS, rows), cfg).collect()}
    assert out["K1"].utilization_risk == "HIGH" and out["K1"].utilization_rate_pct == D("90.00")
    assert out["K2"].utilization_rate_pct is None and out["K2"].utilization_risk == "LOW"
    assert out["K2"].card_status == "PENDING_ACTIVATION" and not out["K2"].is_active
    # 69.9997 % rounds to 70.00 but the band uses the exact ratio
    assert out["K3"].utilization_rate_pct == D("70.00") and out["K3"].utilization_risk == "LOW"
    assert out["K4"].utilization_rate_pct == D("66.67")
    assert out["K1"].available_credit == D("100.00")
    assert out["K1"].card_age_months == 6                 # Dec 31 -> Jun 15


def test_bad_raw_values_fail_unless_lenient(spark, cfg):
    import pytest

    from bankmart.sources import raw as raw_mod

    text = spark.createDataFrame(
        [("A1", "C1", "checking", "active", "usd", "12.50", "1.00", "0.0100", "2024-01-02", None,
          None),
         ("A2", "C1", "checking", "active", "usd", "n/a", "1.00", "0.0100", "2024-01-02", None,
          None)],
        ", ".join(f"{f.name} string" for f in schemas.ACCOUNTS.fields))
    empty = lambda s: spark.createDataFrame([], s)
    others = dict(customers=empty(schemas.CUSTOMERS), transactions=empty(schemas.TRANSACTIONS),
                  loans=empty(schemas.LOANS), credit_cards=empty(schemas.CREDIT_CARDS))
    strict = raw_mod.from_frames(accounts=text, **others)
    with pytest.raises(Exception):
        strict.accounts.collect()
    lenient = raw_mod.from_frames(lenient=True, accounts=text, **others)
    rows = {r.account_id: r.balance for r in lenient.accounts.collect()}
    assert rows == {"A1": D("12.50"), "A2": None}
