"""12-month activity and the customer 360 on hand-made rows."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

from bankmart.config import Config
from bankmart.operators import customer, rollups, staging
from bankmart.sources import schemas

AS_OF = dt.date(2024, 6, 15)
CFG = Config(as_of=AS_OF, start_date="2020-01-01")


def txn(tid, acct, typ, status, amount, date):
    return (tid, acct, typ, status, "ATM", "0001", "x", D(amount), date, date, None)


def accounts(spark, rows):
    return staging.stg_accounts(spark.createDataFrame(
        [(a, c, "CHECKING", "ACTIVE", "USD", D(bal), D(bal), D("0.01"), dt.date(2020, 1, 1),
          None, None) for a, c, bal in rows], schemas.ACCOUNTS), CFG)


def test_window_types_and_statuses(spark):
    year_ago = dt.date(2023, 6, 15)
    rows = [
        txn("t1", "A1", "DEBIT", "POSTED", "10.00", dt.date(2024, 6, 1)),     # spend
        txn("t2", "A1", "debit ", "posted", "-5.00", dt.date(2024, 5, 2)),    # spend, abs
        txn("t3", "A1", "FEE", "POSTED", "2.50", dt.date(2024, 5, 3)),        # fee
        txn("t4", "A1", "CREDIT", "POSTED", "100.00", dt.date(2024, 4, 1)),   # count only
        txn("t5", "A1", "REVERSAL", "POSTED", "10.00", dt.date(2024, 4, 2)),  # excluded
        txn("t6", "A1", "DEBIT", "PENDING", "10.00", dt.date(2024, 4, 3)),    # excluded
        txn("t7", "A2", "DEBIT", "POSTED", "1.00", year_ago),                 # boundary: in
        txn("t8", "A2", "DEBIT", "POSTED", "1.00", year_ago - dt.timedelta(days=1)),  # out
        txn("t9", "A2", "TRANSFER", "POSTED", "7.00", dt.date(2024, 9, 1)),   # future: in
        txn("t10", "A9", "DEBIT", "POSTED", "99.00", dt.date(2024, 6, 1)),    # no account
    ]
    t = staging.stg_transactions(spark.createDataFrame(rows, schemas.TRANSACTIONS), CFG)
    a = accounts(spark, [("A1", "C1", "20000.00"), ("A2", "C1", "1.00"), ("A3", "C2", "5.00")])
    out = {r.customer_id: r for r in customer.txn_activity_12m(t, a, CFG).collect()}
    assert set(out) == {"C1"}                      # C2 has no activity, A9 is unknown
    c1 = out["C1"]
    assert c1.total_transactions_12m == 6          # t1 t2 t3 t4 t7 t9
    assert c1.total_spend_12m == D("16.00")        # t1 + |t2| + t7
    assert c1.total_fees_12m == D("2.50")
    assert c1.last_transaction_date == dt.date(2024, 9, 1)
    # months: 2024-06, 2024-05, 2024-04, 2023-06, 2024-09
    assert c1.active_months_12m == 5


def test_customer_360_rules_on_activity(spark):
    cust = staging.stg_customers(spark.createDataFrame(
        [("C1", "a", "b", "e", "p", "PREMIUM", "DIGITAL", "co", "1", dt.date(2020, 1, 1), None),
         ("C2", "a", "b", "e", "p", "RETAIL", "DIGITAL", "co", "1", dt.date(2024, 6, 1), None),
         ("C3", "a", "b", "e", "p", "RETAIL", "DIGITAL", "co", "1", dt.date(2019, 1, 1), None)],
        schemas.CUSTOMERS), CFG)
    acct = accounts(spark, [("A1", "C1", "20000.00"), ("A3", "C3", "10.00")])
    # C1 active in 10 distinct months, C3 never
    rows = [txn(f"t{m}", "A1", "DEBIT", "POSTED", "1.00", dt.date(2023 + (m > 6), (m + 5) % 12 + 1, 10))
            for m in range(1, 11)]
    t = staging.stg_transactions(spark.createDataFrame(rows, schemas.TRANSACTIONS), CFG)
    empty_loans = staging.stg_loans(spark.createDataFrame([], schemas.LOANS), CFG)
    empty_cards = staging.stg_credit_cards(spark.createDataFrame([], schemas.CREDIT_CARDS), CFG)
    fin = rollups.int_customer_financials(cust, rollups.account_summary(acct),
                                          rollups.loan_summary(empty_loans),
                                          rollups.card_summary(empty_cards))
    c360 = {r.customer_id: r for r in customer.mart_customer_360(
        fin, customer.txn_activity_12m(t, acct, CFG), CFG).collect()}
    c1, c2, c3 = c360["C1"], c360["C2"], c360["C3"]
    assert c1.active_months_12m == 10 and c1.product_depth == 1
    assert c1.engagement_score == 10 * 5 + 15 + 20 + 10          # 95, under the cap
    assert c1.lifecycle_stage == "ACTIVE"                         # depth 1 is not LOYAL
    assert c1.churn_risk == "LOW" and c1.ltv_tier == "TIER_3_STANDARD"
    assert c2.lifecycle_stage == "ONBOARDING" and c2.churn_risk == "MEDIUM"
    assert c2.total_accounts == 0 and c2.product_depth == 0 and c2.days_since_last_txn is None
    assert c3.lifecycle_stage == "DORMANT" and c3.churn_risk == "HIGH"
    assert c1.days_since_last_txn == (AS_OF - max(r[8] for r in rows)).days


def test_closed_accounts_and_all_currencies_count(spark):
    """Balances of closed accounts and of every currency add up (no filter, no FX)."""
    raw_accts = spark.createDataFrame(
        [("A1", "C1", "checking", "active", "usd", D("100.00"), D("1"), D("0.01"),
          dt.date(2020, 1, 1), None, None),
         ("A2", "C1", "savings", "closed", "eur", D("50.00"), D("1"), D("0.01"),
          dt.date(2020, 1, 1), dt.date(2021, 1, 1), None)], schemas.ACCOUNTS)
    acct = staging.stg_accounts(raw_accts, CFG)
    summary = {r.customer_id: r for r in rollups.account_summary(acct).collect()}["C1"]
    assert summary.total_accounts == 2 and summary.active_accounts == 1
    assert summary.total_deposit_balance == D("150.00")
    assert summary.checking_balance == D("100.00") and summary.savings_balance == D("50.00")


def test_surrogate_key_text_null_collides_with_null(spark):
    from pyspark.sql import functions as F

    from bankmart.functions.macros import surrogate_key

    row = spark.createDataFrame([("x", None, "NULL")], "a string, b string, c string").select(
        surrogate_key("a", "b").alias("k1"), surrogate_key("a", "c").alias("k2"),
        surrogate_key(F.lit(1), F.lit(None)).alias("k3")).first()
    assert row.k1 == row.k2                   # by design of the key
    assert len(row.k3) == 32


def test_months_beyond_the_mask_are_exact(spark):
    """Months 10 and 100 years ahead, twice on two accounts of a customer, a duplicated account
    row and a hot account: every distinct month counts once."""
    far10, far100 = dt.date(2034, 3, 5), dt.date(2124, 7, 9)
    edge = [dt.date(2028, 7, 1), dt.date(2028, 8, 1)]             # the mask's last month and the next
    rows = [txn(f"h{i}", "A1", "DEBIT", "POSTED", "1.00", dt.date(2024, 6, 1 + i % 14)) for i in range(300)]
    rows += [txn("f1", "A1", "DEBIT", "POSTED", "1.00", far10), txn("f2", "A2", "DEBIT", "POSTED", "1.00", far10),
             txn("f3", "A2", "FEE", "POSTED", "2.00", far100), txn("f4", "A1", "DEBIT", "POSTED", "1.00", edge[0]),
             txn("f5", "A2", "DEBIT", "POSTED", "1.00", edge[1]), txn("f6", "A3", "DEBIT", "POSTED", "1.00", far100)]
    t = staging.stg_transactions(spark.createDataFrame(rows, schemas.TRANSACTIONS), CFG)
    a = accounts(spark, [("A1", "C1", "1.00"), ("A2", "C1", "1.00"), ("A3", "C2", "1.00"), ("A3", "C2", "1.00")])
    out = {r.customer_id: r for r in customer.txn_activity_12m(t, a, CFG).collect()}
    # 2024-06, 2034-03, 2124-07 and the two at the edge
    assert out["C1"].active_months_12m == 5 and out["C1"].total_transactions_12m == 305
    assert out["C1"].last_transaction_date == far100 and out["C1"].total_fees_12m == D("2.00")
    assert out["C2"].active_months_12m == 1 and out["C2"].total_transactions_12m == 2
