"""Oracle SQL for DuckDB: every registered query, restated as plain SQL.

This is the independent side of the correctness check. It is written the
straightforward way (row-level joins, count(distinct), one statement per
test) so it also checks the Spark side's rewrites (pre-aggregation before
joins, fused checks). DuckDB divides decimals in DOUBLE, so every rounded
ratio and every decimal average is computed here in exact integer
arithmetic, half away from zero, like Spark's decimal ROUND.

The driver's tables (customer, nation, region, orders, lineitem) are views;
the raw banking tables are derived from them exactly as in
``bankmart.sources.fixtures``.
"""

from __future__ import annotations

import re

from bankmart.config import FIXTURE_AS_OF, FIXTURE_START_DATE
from bankmart.sources import schemas

AS_OF = f"DATE '{FIXTURE_AS_OF.isoformat()}'"
AS_OF_TS = f"TIMESTAMP '{FIXTURE_AS_OF.isoformat()} 00:00:00'"
START = f"DATE '{FIXTURE_START_DATE}'"
YEAR_AGO = f"CAST({AS_OF} - INTERVAL 1 YEAR AS DATE)"


# --- exact arithmetic helpers ------------------------------------------------

def hu_div(n: str, d: str) -> str:
    """Integer quotient n/d rounded half away from zero; NULL when d is 0/NULL."""
    n, d = f"CAST(({n}) AS HUGEINT)", f"CAST(({d}) AS HUGEINT)"
    return (f"(CASE WHEN {d} = 0 THEN NULL ELSE sign({n}) * sign({d}) * "
            f"((2 * abs({n}) + abs({d})) // (2 * abs({d}))) END)")


def to_dec(q: str, places: int) -> str:
    """Integer q as q / 10^places, DECIMAL(38, places)."""
    unit = "0." + "0" * (places - 1) + "1"
    return (f"CAST(CAST(({q}) AS DECIMAL(38,0)) * CAST({unit} AS DECIMAL({places + 1},{places}))"
            f" AS DECIMAL(38,{places}))")


def unscaled(x: str, scale: int) -> str:
    return f"CAST(({x}) * {10 ** scale} AS HUGEINT)"


def pct(num: str, den: str, places: int = 2, num_scale: int = 2, den_scale: int = 2) -> str:
    """round(num / nullif(den, 0) * 100, places), exact."""
    n = f"{unscaled(num, num_scale)} * {10 ** (den_scale + 2 + places)}"
    d = f"{unscaled(den, den_scale)} * {10 ** num_scale}"
    return to_dec(hu_div(n, d), places)


def count_pct(num: str, den: str, places: int = 2) -> str:
    return to_dec(hu_div(f"({num}) * {10 ** (2 + places)}", den), places)


def avg_exact(col: str, scale: int = 2, places: int = 6) -> str:
    """avg of a decimal column with ``scale`` digits, rounded once to ``places``."""
    return to_dec(hu_div(f"{unscaled(f'sum({col})', scale)} * {10 ** (places - scale)}",
                         f"count({col})"), places)


def ratio_at_least(num: str, den: str, t: str) -> str:
    return f"(({den}) > 0 AND ({num}) >= {t} * ({den}) OR ({den}) < 0 AND ({num}) <= {t} * ({den}))"


def months_between(a: str, b: str) -> str:
    return f"CAST((year({b}) * 12 + month({b})) - (year({a}) * 12 + month({a})) AS INTEGER)"


def days_between(a: str, b: str) -> str:
    return f"CAST(date_diff('day', {a}, {b}) AS INTEGER)"


def flag(cond: str) -> str:
    return f"coalesce({cond}, false)"


def cnt(cond: str) -> str:
    return f"count(CASE WHEN {cond} THEN 1 END)"


def title(x: str) -> str:
    """Title case, character by character (DuckDB has no initcap): upper case at the start and
    after a space or a delimiter, else lower case."""
    breaks = " !?@\"^#$&~_,.:;+-*%/|\\[](){}<>\t\n\r\f\v"
    chars = f"regexp_extract_all(lower(trim({x})), '(?s).')"
    return (f"array_to_string(list_transform({chars}, lambda c, i: CASE WHEN i = 1 OR "
            f"contains('{breaks}', ({chars})[i - 1]) THEN upper(c) ELSE c END), '')")


def first_name(k: str) -> str:
    """The planted first names (the fixture's list, written out again)."""
    names = (" customer ", "mary-jane", "o''brien", "d\u2019angelo", " anna  maria", "JEAN-luc PAUL",
             "rene\u0301e", "a=b smith", "\u00e9lan (jr.)", "x_y/z", "tab\tname")
    return "[" + ", ".join(f"'{n}'" for n in names) + f"][({k}) % {len(names)} + 1]"


def by_priority(values: tuple[str, ...]) -> str:
    prios = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED")
    arms = " ".join(f"WHEN '{p}' THEN '{v}'" for p, v in zip(prios, values))
    return f"CASE o_orderpriority {arms} ELSE '{values[-1]}' END"


def cust_id(k: str) -> str:
    return f"printf('C%09d', {k})"


def d2(x: str) -> str:
    return f"CAST({x} AS DECIMAL(18,2))"


RISK_TIER = """CASE loan_status WHEN 'CURRENT' THEN '1_CURRENT' WHEN 'DELINQUENT_30' THEN '2_DPD_30'
  WHEN 'DELINQUENT_60' THEN '3_DPD_60' WHEN 'DELINQUENT_90' THEN '4_DPD_90'
  WHEN 'CHARGED_OFF' THEN '5_CHARGED_OFF' WHEN 'PAID_OFF' THEN '0_PAID_OFF' ELSE '9_UNKNOWN' END"""


def util_band(b: str, l: str) -> str:
    return (f"CASE WHEN {ratio_at_least(b, l, '0.90')} THEN 'HIGH' "
            f"WHEN {ratio_at_least(b, l, '0.70')} THEN 'MEDIUM' ELSE 'LOW' END")


# --- CTE library, in dependency order -------------------------------------

CTES: dict[str, str] = {}

CTES["raw_customers"] = f"""
SELECT {cust_id('c.c_custkey')} AS customer_id,
  {first_name('c_custkey')} AS first_name, n.n_name AS last_name,
  CASE WHEN c.c_custkey % 23 = 0 THEN NULL WHEN c.c_custkey % 97 = 0 THEN 'shared@email.com'
       ELSE ' Customer.' || c.c_custkey || '@Email.com ' END AS email,
  ' 555-' || lpad(CAST(c.c_custkey % 10000 AS VARCHAR), 4, '0') AS phone,
  CASE c.c_mktsegment WHEN 'BUILDING' THEN ' small_business' WHEN 'MACHINERY' THEN 'premium'
       WHEN 'FURNITURE' THEN 'Student ' ELSE 'RETAIL' END AS customer_segment,
  ['DIGITAL', 'BRANCH', 'REFERRAL', 'DIRECT_MAIL', 'PARTNER'][c.c_custkey % 5 + 1] AS acquisition_channel,
  lower(substr(r.r_name, 1, 2)) AS state,
  lpad(CAST(c.c_custkey % 100000 AS VARCHAR), 5, '0') AS zip_code,
  DATE '1995-01-01' + CAST((c.c_custkey * 7919) % 2500 AS INTEGER) AS created_at,
  CAST({AS_OF} - CAST(c.c_custkey % 3 AS INTEGER) AS TIMESTAMP) AS updated_at
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey"""

CTES["raw_accounts"] = f"""
SELECT 'A' || o_orderkey AS account_id, {cust_id('o_custkey')} AS customer_id,
  {by_priority(('checking', 'SAVINGS ', 'MONEY_MARKET', 'CD', 'INVESTMENT'))} AS account_type,
  CASE WHEN o_orderstatus <> 'F' THEN 'active' WHEN o_orderkey % 8 = 0 THEN 'FROZEN'
       WHEN o_orderkey % 8 = 1 THEN 'PENDING' ELSE 'CLOSED' END AS account_status,
  ' usd' AS currency_code,
  {d2(d2('o_totalprice') + ' * 0.04')} AS balance,
  {d2(d2('o_totalprice') + ' * 0.03')} AS available_balance,
  CAST(CAST(o_orderkey % 500 AS INTEGER) / 10000 AS DECIMAL(8,4)) AS interest_rate,
  CAST(o_orderdate AS DATE) AS opened_date,
  CASE WHEN o_orderstatus = 'F' AND o_orderkey % 8 = 4 THEN CAST(o_orderdate AS DATE) + 30 END
    AS closed_date,
  {AS_OF_TS} AS updated_at
FROM orders WHERE o_orderkey % 4 IN (0, 1)"""

CTES["raw_loans"] = f"""
SELECT 'L' || o_orderkey AS loan_id, {cust_id('o_custkey')} AS customer_id,
  {by_priority(('personal', 'AUTO', 'HOME_EQUITY', 'STUDENT', 'SMALL_BUSINESS'))} AS loan_type,
  CASE o_orderkey % 36 WHEN 6 THEN 'delinquent_30' WHEN 10 THEN 'DELINQUENT_60'
       WHEN 14 THEN 'DELINQUENT_90' WHEN 18 THEN 'CHARGED_OFF' WHEN 22 THEN 'PAID_OFF'
       WHEN 26 THEN 'DELINQUENT_120' WHEN 30 THEN NULL ELSE 'CURRENT' END AS loan_status,
  {d2(d2('o_totalprice') + ' * 0.10')} AS principal_amount,
  {d2(d2('o_totalprice') + ' * 0.01 * CAST(o_orderkey % 10 AS INTEGER)')} AS outstanding_balance,
  CAST(CAST(o_orderkey % 1200 AS INTEGER) / 10000 AS DECIMAL(8,4)) AS interest_rate,
  {d2(d2('o_totalprice') + ' * 0.002')} AS monthly_payment,
  CAST(o_orderdate AS DATE) AS origination_date,
  CAST(o_orderdate AS DATE) + 1826 AS maturity_date,
  CASE WHEN o_orderkey % 9 <> 0 THEN CAST(o_orderdate AS DATE) + 60 END AS last_payment_date,
  {AS_OF_TS} AS updated_at
FROM orders WHERE o_orderkey % 4 = 2"""

CTES["raw_cards"] = f"""
SELECT 'K' || o_orderkey AS card_id, {cust_id('o_custkey')} AS customer_id,
  CASE WHEN o_orderstatus <> 'F' THEN 'Active' WHEN o_orderkey % 8 = 3 THEN 'SUSPENDED'
       ELSE 'CLOSED' END AS card_status,
  {by_priority(('platinum', 'GOLD', 'CASH_BACK', 'TRAVEL', 'SECURED'))} AS card_product,
  'points ' AS rewards_program,
  CASE WHEN o_orderkey % 52 = 3 THEN CAST(0 AS DECIMAL(18,2))
       ELSE {d2(d2('o_totalprice') + ' * 0.05')} END AS credit_limit,
  {d2(d2('o_totalprice') + ' * 0.005 * CAST(o_orderkey % 11 AS INTEGER)')} AS current_balance,
  {d2(d2('o_totalprice') + ' * 0.001')} AS minimum_payment_due,
  {d2(d2('o_totalprice') + ' * 0.002')} AS last_payment_amount,
  CAST(25 * (o_orderkey % 4) AS DECIMAL(18,2)) AS annual_fee,
  CAST(CAST(1500 + o_orderkey % 1000 AS INTEGER) / 10000 AS DECIMAL(8,4)) AS interest_rate,
  CAST(o_orderdate AS DATE) AS opened_date,
  CAST(NULL AS DATE) AS closed_date,
  CAST(o_orderdate AS DATE) + 45 AS last_payment_date,
  CAST(o_orderdate AS DATE) + 30 AS statement_close_date,
  {AS_OF_TS} AS updated_at
FROM orders WHERE o_orderkey % 4 = 3"""

_TXN_DATE = f"({AS_OF} - CAST((31 * l_partkey + 17 * l_suppkey + 13 * l_linenumber) % 700 AS INTEGER))"
CTES["raw_transactions"] = f"""
SELECT
  CASE WHEN l_quantity = 50 AND l_linenumber = 7 THEN NULL
       ELSE 'T' || concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
                             CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR)) END
    AS transaction_id,
  'A' || CASE WHEN l_orderkey % 4 >= 2 AND l_orderkey % 40 <> 2 THEN l_orderkey - l_orderkey % 4
              ELSE l_orderkey END AS account_id,
  CASE l_linenumber WHEN 1 THEN 'debit' WHEN 2 THEN 'DEBIT ' WHEN 3 THEN 'CREDIT'
       WHEN 4 THEN 'TRANSFER' WHEN 5 THEN 'FEE' WHEN 6 THEN 'INTEREST' WHEN 7 THEN 'REVERSAL' END
    AS transaction_type,
  CASE WHEN l_quantity <= 44 THEN 'posted' WHEN l_quantity <= 46 THEN 'PENDING'
       WHEN l_quantity <= 48 THEN 'REVERSED' ELSE 'FAILED' END AS status,
  CASE l_returnflag WHEN 'A' THEN 'atm' WHEN 'N' THEN 'online ' ELSE 'BRANCH' END AS channel,
  lpad(CAST(l_partkey % 10000 AS VARCHAR), 4, '0') AS merchant_category_code,
  ' part ' || l_partkey AS description,
  CASE WHEN l_suppkey % 2 = 0 THEN -{d2('l_extendedprice')} ELSE {d2('l_extendedprice')} END
    AS amount,
  {_TXN_DATE} AS transaction_date,
  {_TXN_DATE} + 1 AS posted_date,
  CAST({_TXN_DATE} AS TIMESTAMP) AS created_at
FROM lineitem"""

# --- staging ---------------------------------------------------------------

CTES["stg_customers"] = f"""
SELECT customer_id,
  {title('first_name')} AS first_name,
  {title('last_name')} AS last_name,
  {title('first_name')} || ' ' || {title('last_name')} AS full_name,
  lower(trim(email)) AS email, trim(phone) AS phone,
  upper(trim(customer_segment)) AS customer_segment,
  upper(trim(acquisition_channel)) AS acquisition_channel,
  upper(trim(state)) AS state, upper(trim(zip_code)) AS zip_code,
  CAST(created_at AS DATE) AS customer_since_date,
  CAST(updated_at AS TIMESTAMP) AS updated_at,
  {flag("upper(trim(customer_segment)) = 'PREMIUM'")} AS is_premium_customer,
  {flag(f"CAST(created_at AS DATE) >= {YEAR_AGO}")} AS is_new_customer,
  {days_between('CAST(created_at AS DATE)', AS_OF)} AS customer_tenure_days
FROM raw_customers WHERE customer_id IS NOT NULL"""

CTES["stg_accounts"] = f"""
SELECT account_id, customer_id,
  upper(trim(account_type)) AS account_type,
  upper(trim(account_status)) AS account_status,
  upper(trim(currency_code)) AS currency_code,
  CAST(balance AS DECIMAL(18,2)) AS balance,
  CAST(available_balance AS DECIMAL(18,2)) AS available_balance,
  CAST(interest_rate AS DECIMAL(8,4)) AS interest_rate,
  CAST(opened_date AS DATE) AS opened_date, CAST(closed_date AS DATE) AS closed_date,
  CAST(updated_at AS TIMESTAMP) AS updated_at,
  {flag("upper(trim(account_status)) = 'ACTIVE'")} AS is_active,
  {flag("upper(trim(account_status)) = 'CLOSED' AND closed_date IS NOT NULL")} AS is_closed,
  CASE WHEN upper(trim(account_type)) IN ('CHECKING', 'SAVINGS', 'MONEY_MARKET') THEN 'DEPOSIT'
       WHEN upper(trim(account_type)) = 'CD' THEN 'TERM_DEPOSIT'
       WHEN upper(trim(account_type)) = 'INVESTMENT' THEN 'INVESTMENT' ELSE 'OTHER' END
    AS account_category,
  {days_between('CAST(opened_date AS DATE)', AS_OF)} AS account_age_days
FROM raw_accounts WHERE account_id IS NOT NULL"""

CTES["stg_transactions"] = f"""
SELECT transaction_id, account_id,
  upper(trim(transaction_type)) AS transaction_type,
  upper(trim(status)) AS transaction_status,
  upper(trim(channel)) AS channel,
  trim(merchant_category_code) AS merchant_category_code,
  trim(description) AS description,
  CASE WHEN upper(trim(transaction_type)) IN ('CREDIT', 'INTEREST') THEN abs(CAST(amount AS DECIMAL(18,2)))
       WHEN upper(trim(transaction_type)) IN ('DEBIT', 'FEE') THEN -abs(CAST(amount AS DECIMAL(18,2)))
       ELSE CAST(amount AS DECIMAL(18,2)) END AS amount,
  abs(CAST(amount AS DECIMAL(18,2))) AS amount_abs,
  CAST(transaction_date AS DATE) AS transaction_date,
  CAST(date_trunc('month', CAST(transaction_date AS DATE)) AS DATE) AS transaction_month,
  CAST(date_trunc('year', CAST(transaction_date AS DATE)) AS DATE) AS transaction_year,
  CAST(dayofweek(CAST(transaction_date AS DATE)) AS INTEGER) AS day_of_week,
  CAST(posted_date AS DATE) AS posted_date,
  CAST(created_at AS TIMESTAMP) AS created_at,
  {flag("upper(trim(status)) = 'POSTED'")} AS is_posted,
  {flag("upper(trim(transaction_type)) = 'REVERSAL'")} AS is_reversal,
  {flag("upper(trim(transaction_type)) = 'FEE'")} AS is_fee
FROM raw_transactions
WHERE transaction_id IS NOT NULL AND CAST(transaction_date AS DATE) >= {START}"""

CTES["stg_loans"] = f"""
SELECT loan_id, customer_id, loan_type, loan_status, principal_amount, outstanding_balance,
  interest_rate, monthly_payment,
  CAST(principal_amount - outstanding_balance AS DECIMAL(38,2)) AS amount_paid_down,
  {pct('principal_amount - outstanding_balance', 'principal_amount')} AS pct_paid_down,
  origination_date, maturity_date, last_payment_date, updated_at,
  {flag("loan_status LIKE 'DELINQUENT%'")} AS is_delinquent,
  {flag("loan_status = 'CHARGED_OFF'")} AS is_charged_off,
  {flag("loan_status = 'PAID_OFF'")} AS is_paid_off,
  {RISK_TIER} AS risk_tier,
  {months_between('origination_date', AS_OF)} AS loan_age_months
FROM (SELECT loan_id, customer_id, upper(trim(loan_type)) AS loan_type,
        upper(trim(loan_status)) AS loan_status,
        CAST(principal_amount AS DECIMAL(18,2)) AS principal_amount,
        CAST(outstanding_balance AS DECIMAL(18,2)) AS outstanding_balance,
        CAST(interest_rate AS DECIMAL(8,4)) AS interest_rate,
        CAST(monthly_payment AS DECIMAL(18,2)) AS monthly_payment,
        CAST(origination_date AS DATE) AS origination_date,
        CAST(maturity_date AS DATE) AS maturity_date,
        CAST(last_payment_date AS DATE) AS last_payment_date,
        CAST(updated_at AS TIMESTAMP) AS updated_at
      FROM raw_loans WHERE loan_id IS NOT NULL)"""

CTES["stg_credit_cards"] = f"""
SELECT card_id, customer_id, card_status, card_product, rewards_program, credit_limit,
  current_balance, minimum_payment_due, last_payment_amount, annual_fee, interest_rate,
  {pct('current_balance', 'credit_limit')} AS utilization_rate_pct,
  CAST(credit_limit - current_balance AS DECIMAL(38,2)) AS available_credit,
  opened_date, closed_date, last_payment_date, statement_close_date, updated_at,
  {flag("card_status = 'ACTIVE'")} AS is_active,
  {util_band('current_balance', 'credit_limit')} AS utilization_risk,
  {months_between('opened_date', AS_OF)} AS card_age_months
FROM (SELECT card_id, customer_id, upper(trim(card_status)) AS card_status,
        upper(trim(card_product)) AS card_product,
        upper(trim(rewards_program)) AS rewards_program,
        CAST(credit_limit AS DECIMAL(18,2)) AS credit_limit,
        CAST(current_balance AS DECIMAL(18,2)) AS current_balance,
        CAST(minimum_payment_due AS DECIMAL(18,2)) AS minimum_payment_due,
        CAST(last_payment_amount AS DECIMAL(18,2)) AS last_payment_amount,
        CAST(annual_fee AS DECIMAL(18,2)) AS annual_fee,
        CAST(interest_rate AS DECIMAL(8,4)) AS interest_rate,
        CAST(opened_date AS DATE) AS opened_date, CAST(closed_date AS DATE) AS closed_date,
        CAST(last_payment_date AS DATE) AS last_payment_date,
        CAST(statement_close_date AS DATE) AS statement_close_date,
        CAST(updated_at AS TIMESTAMP) AS updated_at
      FROM raw_cards WHERE card_id IS NOT NULL)"""

# --- roll-ups --------------------------------------------------------------

CTES["account_summary"] = f"""
SELECT customer_id, count(*) AS total_accounts, {cnt('is_active')} AS active_accounts,
  CAST(sum(balance) AS DECIMAL(38,2)) AS total_deposit_balance,
  CAST(sum(CASE WHEN account_type = 'CHECKING' THEN balance ELSE 0 END) AS DECIMAL(38,2)) AS checking_balance,
  CAST(sum(CASE WHEN account_type = 'SAVINGS' THEN balance ELSE 0 END) AS DECIMAL(38,2)) AS savings_balance,
  min(opened_date) AS first_account_date, max(opened_date) AS latest_account_date
FROM stg_accounts GROUP BY customer_id"""

CTES["loan_summary"] = f"""
SELECT customer_id, count(*) AS total_loans,
  {cnt('NOT is_paid_off AND NOT is_charged_off')} AS active_loans,
  CAST(sum(outstanding_balance) AS DECIMAL(38,2)) AS total_loan_balance,
  CAST(sum(principal_amount) AS DECIMAL(38,2)) AS total_loan_originated,
  {cnt('is_delinquent')} AS delinquent_loans, {cnt('is_charged_off')} AS charged_off_loans,
  max(origination_date) AS latest_loan_date
FROM stg_loans GROUP BY customer_id"""

CTES["card_summary"] = f"""
SELECT customer_id, count(*) AS total_cards, {cnt('is_active')} AS active_cards,
  CAST(sum(credit_limit) AS DECIMAL(38,2)) AS total_credit_limit,
  CAST(sum(current_balance) AS DECIMAL(38,2)) AS total_card_balance,
  {avg_exact('utilization_rate_pct')} AS avg_utilization_rate,
  CAST(max(CASE WHEN utilization_risk = 'HIGH' THEN 1 ELSE 0 END) AS INTEGER) AS has_high_utilization
FROM stg_credit_cards GROUP BY customer_id"""

_IDENTITY = ("customer_id, full_name, customer_segment, acquisition_channel, state, "
             "customer_since_date, customer_tenure_days, is_premium_customer, is_new_customer")

CTES["int_customer_accounts"] = f"""
SELECT c.customer_id, c.full_name, c.customer_segment, c.acquisition_channel, c.state,
  c.customer_since_date, c.customer_tenure_days, c.is_premium_customer, c.is_new_customer,
  a.account_id, a.account_type, a.account_category, a.account_status,
  a.is_active AS account_is_active, a.opened_date AS account_opened_date, a.account_age_days,
  a.currency_code, a.balance, a.available_balance, a.interest_rate,
  {days_between('c.customer_since_date', 'a.opened_date')} AS days_to_account_open,
  {flag('a.opened_date = c.customer_since_date')} AS is_first_account
FROM stg_customers c JOIN stg_accounts a ON c.customer_id = a.customer_id"""

CTES["int_customer_financials"] = f"""
SELECT c.customer_id, c.full_name, c.customer_segment, c.acquisition_channel, c.state,
  c.customer_since_date, c.customer_tenure_days, c.is_premium_customer, c.is_new_customer,
  coalesce(a.total_accounts, 0) AS total_accounts,
  coalesce(a.active_accounts, 0) AS active_accounts,
  CAST(coalesce(a.total_deposit_balance, 0) AS DECIMAL(38,2)) AS total_deposit_balance,
  CAST(coalesce(a.checking_balance, 0) AS DECIMAL(38,2)) AS checking_balance,
  CAST(coalesce(a.savings_balance, 0) AS DECIMAL(38,2)) AS savings_balance,
  a.first_account_date,
  coalesce(l.total_loans, 0) AS total_loans, coalesce(l.active_loans, 0) AS active_loans,
  CAST(coalesce(l.total_loan_balance, 0) AS DECIMAL(38,2)) AS total_loan_balance,
  CAST(coalesce(l.total_loan_originated, 0) AS DECIMAL(38,2)) AS total_loan_originated,
  coalesce(l.delinquent_loans, 0) AS delinquent_loans,
  coalesce(l.charged_off_loans, 0) AS charged_off_loans,
  coalesce(k.total_cards, 0) AS total_cards, coalesce(k.active_cards, 0) AS active_cards,
  CAST(coalesce(k.total_credit_limit, 0) AS DECIMAL(38,2)) AS total_credit_limit,
  CAST(coalesce(k.total_card_balance, 0) AS DECIMAL(38,2)) AS total_card_balance,
  CAST(coalesce(k.avg_utilization_rate, 0) AS DECIMAL(38,6)) AS avg_utilization_rate,
  CAST(coalesce(k.has_high_utilization, 0) AS INTEGER) AS has_high_utilization,
  CAST(coalesce(a.total_deposit_balance, 0) + coalesce(l.total_loan_balance, 0)
       + coalesce(k.total_card_balance, 0) AS DECIMAL(38,2)) AS total_relationship_value,
  CAST((CASE WHEN coalesce(a.active_accounts, 0) > 0 THEN 1 ELSE 0 END)
     + (CASE WHEN coalesce(l.active_loans, 0) > 0 THEN 1 ELSE 0 END)
     + (CASE WHEN coalesce(k.active_cards, 0) > 0 THEN 1 ELSE 0 END) AS INTEGER) AS product_depth,
  (coalesce(l.delinquent_loans, 0) > 0 OR coalesce(l.charged_off_loans, 0) > 0
   OR coalesce(k.has_high_utilization, 0) = 1) AS has_risk_flag
FROM stg_customers c
LEFT JOIN account_summary a ON c.customer_id = a.customer_id
LEFT JOIN loan_summary l ON c.customer_id = l.customer_id
LEFT JOIN card_summary k ON c.customer_id = k.customer_id"""

CTES["txn_activity_12m"] = f"""
SELECT a.customer_id,
  count(t.transaction_id) AS total_transactions_12m,
  CAST(sum(CASE WHEN t.transaction_type = 'DEBIT' THEN t.amount_abs ELSE 0 END) AS DECIMAL(38,2)) AS total_spend_12m,
  CAST(sum(CASE WHEN t.transaction_type = 'FEE' THEN t.amount_abs ELSE 0 END) AS DECIMAL(38,2)) AS total_fees_12m,
  max(t.transaction_date) AS last_transaction_date,
  count(DISTINCT t.transaction_month) AS active_months_12m
FROM stg_transactions t JOIN stg_accounts a ON t.account_id = a.account_id
WHERE t.transaction_date >= {YEAR_AGO} AND t.is_posted AND NOT t.is_reversal
GROUP BY a.customer_id"""

_M = "coalesce(t.active_months_12m, 0)"
CTES["mart_customer_360"] = f"""
SELECT b.customer_id, b.full_name, b.customer_segment, b.acquisition_channel, b.state,
  b.customer_since_date, b.customer_tenure_days, b.is_premium_customer, b.is_new_customer,
  b.total_accounts, b.active_accounts, b.total_deposit_balance, b.checking_balance,
  b.savings_balance, b.total_loans, b.active_loans, b.total_loan_balance, b.total_cards,
  b.active_cards, b.total_credit_limit, b.total_card_balance, b.avg_utilization_rate,
  b.total_relationship_value, b.product_depth, b.has_risk_flag,
  CAST(coalesce(t.total_transactions_12m, 0) AS BIGINT) AS total_transactions_12m,
  CAST(coalesce(t.total_spend_12m, 0) AS DECIMAL(38,2)) AS total_spend_12m,
  CAST(coalesce(t.total_fees_12m, 0) AS DECIMAL(38,2)) AS total_fees_12m,
  t.last_transaction_date,
  CAST({_M} AS BIGINT) AS active_months_12m,
  CAST(least(100, {_M} * 5 + b.product_depth * 15
       + CASE WHEN b.total_deposit_balance > 10000 THEN 20 ELSE 0 END
       + CASE WHEN b.is_premium_customer THEN 10 ELSE 0 END) AS INTEGER) AS engagement_score,
  CASE WHEN b.customer_tenure_days <= 90 THEN 'ONBOARDING'
       WHEN {_M} = 0 THEN 'DORMANT' WHEN {_M} <= 3 THEN 'AT_RISK'
       WHEN b.product_depth >= 2 AND {_M} >= 9 THEN 'LOYAL' ELSE 'ACTIVE' END AS lifecycle_stage,
  CASE WHEN b.total_relationship_value >= 100000 THEN 'TIER_1_HIGH_VALUE'
       WHEN b.total_relationship_value >= 25000 THEN 'TIER_2_MID_VALUE'
       WHEN b.total_relationship_value >= 5000 THEN 'TIER_3_STANDARD'
       ELSE 'TIER_4_LOW_VALUE' END AS ltv_tier,
  CASE WHEN {_M} = 0 AND b.customer_tenure_days > 90 THEN 'HIGH'
       WHEN {_M} <= 2 THEN 'MEDIUM' ELSE 'LOW' END AS churn_risk,
  {days_between('t.last_transaction_date', AS_OF)} AS days_since_last_txn
FROM int_customer_financials b LEFT JOIN txn_activity_12m t ON b.customer_id = t.customer_id"""

# --- funnel ----------------------------------------------------------------

CTES["acquisition_cohorts"] = f"""
SELECT CAST(date_trunc('month', customer_since_date) AS DATE) AS cohort_month,
  acquisition_channel, customer_segment,
  count(customer_id) AS new_customers,
  {cnt('product_depth >= 2')} AS multi_product_customers,
  {cnt("lifecycle_stage = 'ONBOARDING'")} AS in_onboarding,
  {cnt("lifecycle_stage = 'DORMANT'")} AS dormant,
  {cnt("lifecycle_stage = 'AT_RISK'")} AS at_risk,
  {cnt("lifecycle_stage = 'ACTIVE'")} AS active,
  {cnt("lifecycle_stage = 'LOYAL'")} AS loyal,
  {avg_exact('total_relationship_value')} AS avg_relationship_value,
  avg(engagement_score) AS avg_engagement_score,
  CAST(sum(total_spend_12m) AS DECIMAL(38,2)) AS cohort_total_spend,
  {count_pct(cnt("lifecycle_stage <> 'ONBOARDING' AND customer_tenure_days > 90"),
             cnt('customer_tenure_days > 90'))} AS activation_rate_pct,
  {count_pct(cnt("churn_risk = 'HIGH'"), 'count(customer_id)')} AS churn_risk_rate_pct
FROM mart_customer_360 GROUP BY 1, 2, 3"""

CTES["channel_summary"] = f"""
SELECT acquisition_channel, count(customer_id) AS total_customers,
  {avg_exact('total_relationship_value')} AS avg_ltv,
  avg(customer_tenure_days) AS avg_tenure_days,
  avg(product_depth) AS avg_product_depth,
  avg(engagement_score) AS avg_engagement_score,
  {count_pct(cnt("lifecycle_stage = 'LOYAL'"), 'count(customer_id)', 6)} AS loyal_rate_pct,
  {count_pct(cnt("churn_risk = 'HIGH'"), 'count(customer_id)', 6)} AS high_churn_rate_pct
FROM mart_customer_360 GROUP BY 1"""

CTES["ltv_distribution"] = f"""
SELECT ltv_tier, customer_segment, acquisition_channel,
  count(customer_id) AS customer_count,
  CAST(sum(total_relationship_value) AS DECIMAL(38,2)) AS total_value,
  {avg_exact('total_relationship_value')} AS avg_value,
  avg(customer_tenure_days) AS avg_tenure_days,
  avg(product_depth) AS avg_product_depth
FROM mart_customer_360 GROUP BY 1, 2, 3"""

CTES["mart_acquisition_funnel"] = """
SELECT 'ACQUISITION_COHORT' AS record_type, CAST(cohort_month AS VARCHAR) AS cohort_month,
  acquisition_channel, customer_segment, new_customers, multi_product_customers,
  active, loyal, dormant, at_risk, activation_rate_pct,
  CAST(churn_risk_rate_pct AS DECIMAL(38,6)) AS churn_risk_rate_pct,
  avg_relationship_value, avg_engagement_score, cohort_total_spend
FROM acquisition_cohorts
UNION ALL
SELECT 'CHANNEL_SUMMARY', NULL, acquisition_channel, NULL, total_customers,
  NULL, NULL, NULL, NULL, NULL, NULL, high_churn_rate_pct, avg_ltv, avg_engagement_score, NULL
FROM channel_summary"""

# --- portfolio -------------------------------------------------------------

CTES["loan_portfolio"] = f"""
SELECT l.loan_type, l.risk_tier, l.loan_status, c.customer_segment,
  count(l.loan_id) AS loan_count,
  CAST(sum(l.principal_amount) AS DECIMAL(38,2)) AS total_originated,
  CAST(sum(l.outstanding_balance) AS DECIMAL(38,2)) AS total_outstanding,
  CAST(sum(l.amount_paid_down) AS DECIMAL(38,2)) AS total_paid_down,
  {avg_exact('l.interest_rate', 4, 8)} AS avg_interest_rate,
  avg(l.loan_age_months) AS avg_loan_age_months,
  CAST(sum(CASE WHEN l.is_delinquent THEN l.outstanding_balance ELSE 0 END) AS DECIMAL(38,2)) AS delinquent_balance,
  CAST(sum(CASE WHEN l.is_charged_off THEN l.outstanding_balance ELSE 0 END) AS DECIMAL(38,2)) AS charged_off_balance,
  {cnt('l.is_delinquent')} AS delinquent_count,
  {cnt('l.is_charged_off')} AS charged_off_count
FROM stg_loans l JOIN stg_customers c ON l.customer_id = c.customer_id
GROUP BY 1, 2, 3, 4"""

CTES["card_portfolio"] = f"""
SELECT c.customer_segment, k.card_product, k.utilization_risk,
  count(k.card_id) AS card_count,
  CAST(sum(k.credit_limit) AS DECIMAL(38,2)) AS total_credit_limit,
  CAST(sum(k.current_balance) AS DECIMAL(38,2)) AS total_outstanding_balance,
  CAST(sum(k.available_credit) AS DECIMAL(38,2)) AS total_available_credit,
  {avg_exact('k.utilization_rate_pct')} AS avg_utilization_rate,
  CAST(sum(k.annual_fee) AS DECIMAL(38,2)) AS total_annual_fees,
  {cnt('k.is_active')} AS active_cards,
  {cnt("k.utilization_risk = 'HIGH'")} AS high_utilization_cards
FROM stg_credit_cards k JOIN stg_customers c ON k.customer_id = c.customer_id
GROUP BY 1, 2, 3"""

CTES["deposit_portfolio"] = f"""
SELECT c.customer_segment, a.account_type, a.account_category,
  count(a.account_id) AS account_count,
  {cnt('a.is_active')} AS active_accounts,
  CAST(sum(a.balance) AS DECIMAL(38,2)) AS total_balance,
  {avg_exact('a.balance')} AS avg_balance,
  CAST(sum(a.available_balance) AS DECIMAL(38,2)) AS total_available,
  {avg_exact('a.interest_rate', 4, 8)} AS avg_interest_rate
FROM stg_accounts a JOIN stg_customers c ON a.customer_id = c.customer_id
GROUP BY 1, 2, 3"""

CTES["delinquency_summary"] = f"""
SELECT loan_type, customer_segment,
  CAST(sum(CASE WHEN risk_tier = '1_CURRENT' THEN loan_count ELSE 0 END) AS BIGINT) AS current_count,
  CAST(sum(CASE WHEN risk_tier = '2_DPD_30' THEN loan_count ELSE 0 END) AS BIGINT) AS dpd_30_count,
  CAST(sum(CASE WHEN risk_tier = '3_DPD_60' THEN loan_count ELSE 0 END) AS BIGINT) AS dpd_60_count,
  CAST(sum(CASE WHEN risk_tier = '4_DPD_90' THEN loan_count ELSE 0 END) AS BIGINT) AS dpd_90_count,
  CAST(sum(CASE WHEN risk_tier = '5_CHARGED_OFF' THEN loan_count ELSE 0 END) AS BIGINT) AS charged_off_count,
  CAST(sum(total_outstanding) AS DECIMAL(38,2)) AS total_outstanding,
  CAST(sum(delinquent_balance) AS DECIMAL(38,2)) AS total_delinquent_balance,
  {pct('sum(delinquent_balance)', 'sum(total_outstanding)')} AS delinquency_rate_pct
FROM loan_portfolio GROUP BY 1, 2"""

CTES["mart_portfolio_performance"] = """
SELECT 'LOAN' AS portfolio_type, loan_type AS product, customer_segment,
  risk_tier AS sub_category, loan_count AS record_count,
  total_outstanding AS outstanding_balance, CAST(avg_interest_rate AS DECIMAL(38,8)) AS avg_interest_rate,
  delinquent_balance, delinquent_count, CAST(NULL AS DECIMAL(38,6)) AS utilization_rate
FROM loan_portfolio
UNION ALL
SELECT 'CREDIT_CARD', card_product, customer_segment, utilization_risk, card_count,
  total_outstanding_balance, NULL, NULL, NULL, avg_utilization_rate
FROM card_portfolio
UNION ALL
SELECT 'DEPOSIT', account_type, customer_segment, account_category, account_count,
  total_balance, avg_interest_rate, NULL, NULL, NULL
FROM deposit_portfolio"""

# --- governance ------------------------------------------------------------

CTES["dq_customers"] = f"""
SELECT 'CUSTOMERS' AS entity, count(*) AS total_records,
  {cnt('customer_id IS NULL')} AS null_pk_count, {cnt('email IS NULL')} AS null_email_count,
  {cnt('customer_segment IS NULL')} AS null_segment_count,
  {cnt('acquisition_channel IS NULL')} AS null_channel_count,
  {cnt('customer_since_date IS NULL')} AS null_date_count,
  {count_pct(cnt('customer_id IS NOT NULL AND email IS NOT NULL AND customer_segment IS NOT NULL'), 'count(*)')}
    AS completeness_score_pct
FROM stg_customers"""

CTES["dq_accounts"] = f"""
SELECT 'ACCOUNTS' AS entity, count(*) AS total_records,
  {cnt('account_id IS NULL')} AS null_pk_count, {cnt('customer_id IS NULL')} AS null_fk_count,
  {cnt('balance IS NULL')} AS null_balance_count, {cnt('account_type IS NULL')} AS null_type_count,
  {cnt('account_status IS NULL')} AS null_status_count,
  {count_pct(cnt('account_id IS NOT NULL AND customer_id IS NOT NULL AND balance IS NOT NULL'), 'count(*)')}
    AS completeness_score_pct
FROM stg_accounts"""

CTES["dq_loans"] = f"""
SELECT 'LOANS' AS entity, count(*) AS total_records,
  {cnt('loan_id IS NULL')} AS null_pk_count, {cnt('customer_id IS NULL')} AS null_fk_count,
  {cnt('outstanding_balance IS NULL')} AS null_balance_count,
  {cnt('interest_rate IS NULL')} AS null_rate_count,
  {cnt('risk_tier IS NULL')} AS null_risk_tier_count,
  {count_pct(cnt('loan_id IS NOT NULL AND customer_id IS NOT NULL AND outstanding_balance IS NOT NULL'), 'count(*)')}
    AS completeness_score_pct
FROM stg_loans"""

CTES["dq_scorecard"] = """
SELECT entity, total_records, null_pk_count, completeness_score_pct FROM dq_customers
UNION ALL SELECT entity, total_records, null_pk_count, completeness_score_pct FROM dq_accounts
UNION ALL SELECT entity, total_records, null_pk_count, completeness_score_pct FROM dq_loans"""

CTES["sttm_reconciliation"] = """
SELECT 'CUSTOMER_COUNT_TIE_OUT' AS check_name, s.n AS source_count, m.n AS mart_count,
  s.n - m.n AS variance, CASE WHEN s.n = m.n THEN 'PASS' ELSE 'FAIL' END AS status
FROM (SELECT count(*) AS n FROM stg_customers) s, (SELECT count(*) AS n FROM mart_customer_360) m"""


def _kpi_values() -> str:
    from bankmart.operators.governance import KPI_CATALOG

    def q(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"
    rows = ",\n  ".join("(" + ", ".join(q(v) for v in row) + ")" for row in KPI_CATALOG)
    return (f"SELECT * FROM (VALUES\n  {rows}\n) AS t(kpi_name, kpi_definition, source_mart, "
            "calculation_logic, domain, status)")


CTES["kpi_catalog"] = _kpi_values()

CTES["mart_kpi_governance"] = """
SELECT 'DQ_SCORECARD' AS record_type, entity AS dimension,
  CAST(total_records AS VARCHAR) AS value_1, CAST(completeness_score_pct AS VARCHAR) AS value_2,
  CAST(null_pk_count AS VARCHAR) AS value_3 FROM dq_customers
UNION ALL SELECT 'DQ_SCORECARD', entity, CAST(total_records AS VARCHAR),
  CAST(completeness_score_pct AS VARCHAR), CAST(null_pk_count AS VARCHAR) FROM dq_accounts
UNION ALL SELECT 'DQ_SCORECARD', entity, CAST(total_records AS VARCHAR),
  CAST(completeness_score_pct AS VARCHAR), CAST(null_pk_count AS VARCHAR) FROM dq_loans
UNION ALL SELECT 'KPI_DEFINITION', kpi_name, kpi_definition, source_mart, status FROM kpi_catalog
UNION ALL SELECT 'STTM_RECON', check_name, CAST(source_count AS VARCHAR),
  CAST(mart_count AS VARCHAR), status FROM sttm_reconciliation"""

# --- data tests ------------------------------------------------------------

_RAW_CTE = {"customers": "raw_customers", "accounts": "raw_accounts",
            "transactions": "raw_transactions", "loans": "raw_loans",
            "credit_cards": "raw_cards", "mart_customer_360": "mart_customer_360"}


def _check_union(selects: list[str]) -> str:
    body = "\nUNION ALL\n".join(selects)
    return (f"SELECT test, table_name, column_name, CAST(failures AS BIGINT) AS failures,\n"
            f"  CASE WHEN failures = 0 THEN 'PASS' ELSE 'FAIL' END AS status\nFROM (\n{body}\n)")


def _head(test: str, t) -> str:
    return f"SELECT '{test}' AS test, '{t.table}' AS table_name, '{t.column}' AS column_name, "


def _checks_sql(kind) -> str:
    specs = schemas.SOURCE_TESTS + schemas.MART_TESTS
    out = []
    for t in specs:
        if not isinstance(t, kind):
            continue
        src = _RAW_CTE[t.table]
        if kind is schemas.Unique:
            out.append(_head("unique", t) + f"count(*) AS failures FROM (SELECT {t.column} FROM "
                       f"{src} WHERE {t.column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")
        elif kind is schemas.NotNull:
            out.append(_head("not_null", t) + f"count(*) AS failures FROM {src} "
                       f"WHERE {t.column} IS NULL")
        elif kind is schemas.AcceptedValues:
            vals = ", ".join(f"'{v}'" for v in t.values)
            out.append(_head("accepted_values", t) + f"count(*) AS failures FROM {src} "
                       f"WHERE {t.column} IS NOT NULL AND {t.column} NOT IN ({vals})")
        elif kind is schemas.Relationship:
            out.append(_head("relationships", t) + f"count(*) AS failures FROM {src} c "
                       f"WHERE c.{t.column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM "
                       f"{_RAW_CTE[t.to_table]} p WHERE p.{t.to_column} = c.{t.column})")
    return _check_union(out)


CTES["chk_unique"] = _checks_sql(schemas.Unique)
CTES["chk_not_null"] = _checks_sql(schemas.NotNull)
CTES["chk_accepted_values"] = _checks_sql(schemas.AcceptedValues)
CTES["chk_relationships"] = _checks_sql(schemas.Relationship)


def _freshness_sql() -> str:
    parts = [f"SELECT '{t.table}' AS table_name, '{t.loaded_at_field}' AS loaded_at_field, "
             f"max(CAST({t.loaded_at_field} AS TIMESTAMP)) AS max_loaded_at, "
             f"{AS_OF_TS} AS checked_at FROM {_RAW_CTE[t.table]}"
             for t in schemas.FRESHNESS_TESTS]
    body = "\nUNION ALL\n".join(parts)
    return (f"SELECT *, CASE WHEN age_seconds IS NULL OR age_seconds > 172800 THEN 'ERROR' "
            f"WHEN age_seconds > 86400 THEN 'WARN' ELSE 'PASS' END AS status FROM (\n"
            f"SELECT *, date_diff('second', max_loaded_at, checked_at) AS age_seconds FROM (\n"
            f"{body}))")


CTES["chk_freshness"] = _freshness_sql()

CTES["src_row_counts"] = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {cte}"
    for name, cte in _RAW_CTE.items() if name != "mart_customer_360")

# --- public functions applied to whole tables --------------------------------

CTES["fn_safe_divide"] = f"""
SELECT card_id, current_balance, credit_limit,
  CASE WHEN credit_limit = 0 OR credit_limit IS NULL THEN CAST(0 AS DECIMAL(38,6))
       ELSE {to_dec(hu_div(unscaled('current_balance', 2) + ' * 1000000', unscaled('credit_limit', 2)), 6)}
  END AS balance_to_limit
FROM stg_credit_cards"""

CTES["fn_delinquency_bucket"] = f"""
SELECT loan_id, loan_status, {RISK_TIER} AS delinquency_bucket FROM stg_loans"""

CTES["fn_utilization_risk"] = f"""
SELECT card_id, {util_band('current_balance', 'credit_limit')} AS utilization_risk
FROM stg_credit_cards"""

CTES["fn_months_since"] = f"""
SELECT loan_id, origination_date, {months_between('origination_date', AS_OF)} AS months_since
FROM stg_loans"""

CTES["fn_days_since"] = f"""
SELECT account_id, opened_date, {days_between('opened_date', AS_OF)} AS days_since
FROM stg_accounts"""

CTES["fn_days_since_today"] = f"""
SELECT account_id, opened_date, {days_between('opened_date', 'current_date')} AS days_since
FROM stg_accounts"""

CTES["fn_surrogate_key"] = """
SELECT account_id, customer_id, closed_date,
  md5(concat_ws('|', coalesce(CAST(customer_id AS VARCHAR), 'NULL'),
                     coalesce(CAST(account_id AS VARCHAR), 'NULL'),
                     coalesce(CAST(closed_date AS VARCHAR), 'NULL'))) AS surrogate_key
FROM stg_accounts"""


# How each query's columns are handed to the cross-engine comparison:
# decimals and nullable integers as DOUBLE, dates as TIMESTAMP (midnight). Exact decimals convert
# to the same correctly rounded double in Spark and DuckDB, and doubles and
# timestamps come out alike whatever client conversion the checker applies
# (pandas turns DuckDB decimals into floats and dates into datetime64, but
# Spark's into Decimal and date objects). tests/test_oracle.py checks this
# list against the Spark schemas; __spark_entry__.comparable applies it.
COMPARISON_CASTS: dict[str, dict[str, str]] = {
    'stg_customers': {'customer_since_date': 'TIMESTAMP', 'customer_tenure_days': 'DOUBLE'},
    'stg_accounts': {
        'balance': 'DOUBLE', 'available_balance': 'DOUBLE', 'interest_rate': 'DOUBLE',
        'opened_date': 'TIMESTAMP', 'closed_date': 'TIMESTAMP', 'account_age_days': 'DOUBLE',
    },
    'stg_transactions': {
        'amount': 'DOUBLE', 'amount_abs': 'DOUBLE', 'transaction_date': 'TIMESTAMP',
        'transaction_month': 'TIMESTAMP', 'transaction_year': 'TIMESTAMP',
        'day_of_week': 'DOUBLE', 'posted_date': 'TIMESTAMP',
    },
    'stg_loans': {
        'principal_amount': 'DOUBLE', 'outstanding_balance': 'DOUBLE',
        'interest_rate': 'DOUBLE', 'monthly_payment': 'DOUBLE', 'amount_paid_down': 'DOUBLE',
        'pct_paid_down': 'DOUBLE', 'origination_date': 'TIMESTAMP',
        'maturity_date': 'TIMESTAMP', 'last_payment_date': 'TIMESTAMP',
        'loan_age_months': 'DOUBLE',
    },
    'stg_credit_cards': {
        'credit_limit': 'DOUBLE', 'current_balance': 'DOUBLE', 'minimum_payment_due': 'DOUBLE',
        'last_payment_amount': 'DOUBLE', 'annual_fee': 'DOUBLE', 'interest_rate': 'DOUBLE',
        'utilization_rate_pct': 'DOUBLE', 'available_credit': 'DOUBLE',
        'opened_date': 'TIMESTAMP', 'closed_date': 'TIMESTAMP',
        'last_payment_date': 'TIMESTAMP', 'statement_close_date': 'TIMESTAMP',
        'card_age_months': 'DOUBLE',
    },
    'account_summary': {
        'total_deposit_balance': 'DOUBLE', 'checking_balance': 'DOUBLE',
        'savings_balance': 'DOUBLE', 'first_account_date': 'TIMESTAMP',
        'latest_account_date': 'TIMESTAMP',
    },
    'loan_summary': {
        'total_loan_balance': 'DOUBLE', 'total_loan_originated': 'DOUBLE',
        'latest_loan_date': 'TIMESTAMP',
    },
    'card_summary': {
        'total_credit_limit': 'DOUBLE', 'total_card_balance': 'DOUBLE',
        'avg_utilization_rate': 'DOUBLE', 'has_high_utilization': 'DOUBLE',
    },
    'txn_activity_12m': {
        'total_transactions_12m': 'DOUBLE', 'total_spend_12m': 'DOUBLE',
        'total_fees_12m': 'DOUBLE', 'last_transaction_date': 'TIMESTAMP',
    },
    'int_customer_accounts': {
        'customer_since_date': 'TIMESTAMP', 'customer_tenure_days': 'DOUBLE',
        'account_opened_date': 'TIMESTAMP', 'account_age_days': 'DOUBLE', 'balance': 'DOUBLE',
        'available_balance': 'DOUBLE', 'interest_rate': 'DOUBLE',
        'days_to_account_open': 'DOUBLE',
    },
    'int_customer_financials': {
        'customer_since_date': 'TIMESTAMP', 'customer_tenure_days': 'DOUBLE',
        'total_deposit_balance': 'DOUBLE', 'checking_balance': 'DOUBLE',
        'savings_balance': 'DOUBLE', 'first_account_date': 'TIMESTAMP',
        'total_loan_balance': 'DOUBLE', 'total_loan_originated': 'DOUBLE',
        'total_credit_limit': 'DOUBLE', 'total_card_balance': 'DOUBLE',
        'avg_utilization_rate': 'DOUBLE', 'total_relationship_value': 'DOUBLE',
    },
    'loan_portfolio': {
        'total_originated': 'DOUBLE', 'total_outstanding': 'DOUBLE',
        'total_paid_down': 'DOUBLE', 'avg_interest_rate': 'DOUBLE',
        'delinquent_balance': 'DOUBLE', 'charged_off_balance': 'DOUBLE',
    },
    'card_portfolio': {
        'total_credit_limit': 'DOUBLE',
        'total_outstanding_balance': 'DOUBLE', 'total_available_credit': 'DOUBLE',
        'avg_utilization_rate': 'DOUBLE', 'total_annual_fees': 'DOUBLE',
    },
    'deposit_portfolio': {
        'total_balance': 'DOUBLE',
        'avg_balance': 'DOUBLE', 'total_available': 'DOUBLE', 'avg_interest_rate': 'DOUBLE',
    },
    'delinquency_summary': {
        'current_count': 'DOUBLE', 'dpd_30_count': 'DOUBLE', 'dpd_60_count': 'DOUBLE',
        'dpd_90_count': 'DOUBLE', 'charged_off_count': 'DOUBLE', 'total_outstanding': 'DOUBLE',
        'total_delinquent_balance': 'DOUBLE', 'delinquency_rate_pct': 'DOUBLE',
    },
    'mart_portfolio_performance': {
        'outstanding_balance': 'DOUBLE',
        'avg_interest_rate': 'DOUBLE', 'delinquent_balance': 'DOUBLE',
        'delinquent_count': 'DOUBLE', 'utilization_rate': 'DOUBLE',
    },
    'mart_customer_360': {
        'customer_since_date': 'TIMESTAMP', 'customer_tenure_days': 'DOUBLE',
        'total_deposit_balance': 'DOUBLE', 'checking_balance': 'DOUBLE',
        'savings_balance': 'DOUBLE', 'total_loan_balance': 'DOUBLE',
        'total_credit_limit': 'DOUBLE', 'total_card_balance': 'DOUBLE',
        'avg_utilization_rate': 'DOUBLE', 'total_relationship_value': 'DOUBLE',
        'total_spend_12m': 'DOUBLE', 'total_fees_12m': 'DOUBLE',
        'last_transaction_date': 'TIMESTAMP', 'days_since_last_txn': 'DOUBLE',
    },
    'acquisition_cohorts': {
        'cohort_month': 'TIMESTAMP', 'avg_relationship_value': 'DOUBLE',
        'cohort_total_spend': 'DOUBLE', 'activation_rate_pct': 'DOUBLE',
        'churn_risk_rate_pct': 'DOUBLE',
    },
    'channel_summary': {
        'avg_ltv': 'DOUBLE', 'loyal_rate_pct': 'DOUBLE', 'high_churn_rate_pct': 'DOUBLE',
    },
    'ltv_distribution': {'total_value': 'DOUBLE', 'avg_value': 'DOUBLE'},
    'mart_acquisition_funnel': {
        'multi_product_customers': 'DOUBLE', 'active': 'DOUBLE', 'loyal': 'DOUBLE',
        'dormant': 'DOUBLE', 'at_risk': 'DOUBLE', 'activation_rate_pct': 'DOUBLE',
        'churn_risk_rate_pct': 'DOUBLE', 'avg_relationship_value': 'DOUBLE',
        'cohort_total_spend': 'DOUBLE',
    },
    'dq_customers': {'completeness_score_pct': 'DOUBLE'},
    'dq_accounts': {'completeness_score_pct': 'DOUBLE'},
    'dq_loans': {'completeness_score_pct': 'DOUBLE'},
    'dq_scorecard': {'completeness_score_pct': 'DOUBLE'},
    'chk_freshness': {'age_seconds': 'DOUBLE'},
    'fn_safe_divide': {
        'current_balance': 'DOUBLE', 'credit_limit': 'DOUBLE', 'balance_to_limit': 'DOUBLE',
    },
    'fn_months_since': {'origination_date': 'TIMESTAMP', 'months_since': 'DOUBLE'},
    'fn_days_since': {'opened_date': 'TIMESTAMP', 'days_since': 'DOUBLE'},
    'fn_days_since_today': {'opened_date': 'TIMESTAMP', 'days_since': 'DOUBLE'},
    'fn_surrogate_key': {'closed_date': 'TIMESTAMP'},
}


def _deps(name: str, seen: set[str], order: list[str]) -> None:
    if name in seen:
        return
    seen.add(name)
    body = CTES[name]
    for other in CTES:
        if other != name and re.search(rf"\b{re.escape(other)}\b", body):
            _deps(other, seen, order)
    order.append(name)


def query(name: str, comparable: bool = False) -> str:
    """A self-contained statement producing the ``name`` model."""
    order: list[str] = []
    _deps(name, set(), order)
    ctes = ",\n".join(f"{n} AS (\n{CTES[n].strip()}\n)" for n in order)
    select = "*"
    if comparable and COMPARISON_CASTS.get(name):
        casts = ", ".join(f"CAST({c} AS {t}) AS {c}" for c, t in COMPARISON_CASTS[name].items())
        select = f"* REPLACE ({casts})"
    return f"WITH {ctes}\nSELECT {select} FROM {name}"


def all_queries(names, comparable: bool = True) -> dict[str, str]:
    return {n: query(n, comparable) for n in names}
