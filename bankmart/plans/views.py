"""Staging and intermediate models as Spark SQL text, for views that outlive the session.

A catalog view keeps a query's text, not a DataFrame's plan. Each view model is
rendered from one expression per column; the raw columns take their declared types
inside the view, so its schema is that of the DataFrame model whatever the landed
files say, and casts that change nothing vanish, which leaves filters free to reach
the scan. Rules and thresholds come from ``functions.rules``. Spark keeps
the ANSI mode and time zone of the creating session with a view.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import types as T

from bankmart.config import Config
from bankmart.functions import columns as C
from bankmart.functions import rules as R
from bankmart.operators.rollups import CUSTOMER_IDENTITY
from bankmart.sources import schemas


# --- expressions as text, one for each helper of functions.columns -----------

def text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def trimmed(c: str, case: str = "") -> str:
    return f"{case}(trim({c}))" if case else f"trim({c})"


def upper(c: str) -> str:
    return trimmed(c, "upper")


def title(c: str) -> str:
    spaced = f"regexp_replace(lower(trim({c})), r'{C._WORD_BREAK}', '$1 ')"
    return f"regexp_replace(initcap({spaced}), r'{C._WORD_BREAK} ', '$1')"


def flag(condition: str) -> str:
    return f"coalesce({condition}, false)"


def count_if(condition: str) -> str:
    return f"count(if({condition}, 1, null))"


def chain(branches, otherwise: str) -> str:
    """First true branch wins."""
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in branches) + f" ELSE {otherwise} END"


def one_of(c: str, values) -> str:
    return f"{c} IN ({', '.join(map(text, values))})"


def narrow(c: str, scale: int = 2, digits: int = 22) -> str:
    return f"CAST({c} AS decimal({digits + scale},{scale}))"


def percent(part: str, whole: str) -> str:
    ratio = f"{narrow(part)} * 100 / {narrow(f'nullif({whole}, 0)')}"
    return f"CAST(round({ratio}, 2) AS {C.AMOUNT_SUM})"


def at_least(part: str, whole: str, threshold: str) -> str:
    return (f"CASE WHEN {whole} > 0 THEN {part} >= {threshold} * {whole} "
            f"WHEN {whole} < 0 THEN {part} <= {threshold} * {whole} END")


def months(start: str, end: str) -> str:
    return f"(year({end}) * 12 + month({end})) - (year({start}) * 12 + month({start}))"


def cents(c: str) -> str:
    return f"CAST({c} * 100 AS bigint)"


def money_of(total: str) -> str:
    return f"CAST(CAST({total} AS decimal(38,0)) / 100 AS {C.AMOUNT_SUM})"


def total_of(c: str) -> str:
    return money_of(f"sum({cents(c)})")


# --- models ------------------------------------------------------------------

def _today(cfg: Config) -> str:
    return "current_date()" if cfg.as_of is None else f"DATE'{cfg.as_of.isoformat()}'"


def _select(columns: Mapping[str, str], source: str, where: str = "") -> str:
    listed = ",\n  ".join(c if c == e else f"{e} AS {c}" for c, e in columns.items())
    return f"SELECT\n  {listed}\nFROM {source}" + (f"\nWHERE {where}" if where else "")


def _raw(name: str, relations: Mapping[str, str], lenient: bool) -> str:
    """The raw table with its declared types."""
    cast = "try_cast" if lenient else "CAST"
    listed = ", ".join(f"{cast}({f.name} AS {f.dataType.simpleString()}) AS {f.name}"
                       for f in schemas.RAW_SCHEMAS[name].fields)
    return f"(SELECT {listed} FROM {relations[name]})"


def _as_is(*names: str) -> dict[str, str]:
    return {n: n for n in names}


def _timestamp(c: str) -> str:
    return f"CAST({c} AS {T.TimestampNTZType().simpleString()})"


def _customers(cfg: Config) -> tuple[str, dict[str, str], str]:
    first, last, segment = title("first_name"), title("last_name"), upper("customer_segment")
    today = _today(cfg)
    return "customers", {
        "customer_id": "customer_id", "first_name": first, "last_name": last,
        "full_name": f"concat({first}, ' ', {last})", "email": trimmed("email", "lower"), "phone": trimmed("phone"),
        "customer_segment": segment,
        **{c: upper(c) for c in ("acquisition_channel", "state", "zip_code")},
        "customer_since_date": "created_at", "updated_at": _timestamp("updated_at"),
        "is_premium_customer": flag(f"{segment} = 'PREMIUM'"),
        "is_new_customer": flag(f"created_at >= add_months({today}, -12)"),
        "customer_tenure_days": f"datediff({today}, created_at)",
    }, "customer_id IS NOT NULL"


def _accounts(cfg: Config) -> tuple[str, dict[str, str], str]:
    kind, status = upper("account_type"), upper("account_status")
    return "accounts", {
        **_as_is("account_id", "customer_id"), "account_type": kind, "account_status": status,
        "currency_code": upper("currency_code"),
        **_as_is("balance", "available_balance", "interest_rate", "opened_date", "closed_date"),
        "updated_at": _timestamp("updated_at"),
        "is_active": flag(f"{status} = 'ACTIVE'"),
        "is_closed": flag(f"{status} = 'CLOSED' AND closed_date IS NOT NULL"),
        "account_category": chain([(one_of(kind, types), text(name)) for types, name in R.ACCOUNT_CATEGORIES],
                                  text(R.OTHER_ACCOUNT_CATEGORY)),
        "account_age_days": f"datediff({_today(cfg)}, opened_date)",
    }, "account_id IS NOT NULL"


def _transactions(cfg: Config) -> tuple[str, dict[str, str], str]:
    kind, status = upper("transaction_type"), upper("status")
    return "transactions", {
        **_as_is("transaction_id", "account_id"), "transaction_type": kind, "transaction_status": status,
        "channel": upper("channel"),
        **{c: trimmed(c) for c in ("merchant_category_code", "description")},
        "amount": chain([(one_of(kind, R.CREDIT_TYPES), "abs(amount)"), (one_of(kind, R.DEBIT_TYPES), "-abs(amount)")],
                        "amount"),
        "amount_abs": "abs(amount)", "transaction_date": "transaction_date",
        "transaction_month": "trunc(transaction_date, 'MM')", "transaction_year": "trunc(transaction_date, 'YEAR')",
        "day_of_week": "dayofweek(transaction_date) - 1", "posted_date": "posted_date",
        "created_at": _timestamp("created_at"),
        "is_posted": flag(f"{status} = 'POSTED'"), "is_reversal": flag(f"{kind} = 'REVERSAL'"),
        "is_fee": flag(f"{kind} = 'FEE'"),
    }, f"transaction_id IS NOT NULL AND transaction_date >= DATE'{cfg.start_date}'"


def _loans(cfg: Config) -> tuple[str, dict[str, str], str]:
    status, paid = upper("loan_status"), "(principal_amount - outstanding_balance)"
    return "loans", {
        **_as_is("loan_id", "customer_id"), "loan_type": upper("loan_type"), "loan_status": status,
        **_as_is("principal_amount", "outstanding_balance", "interest_rate", "monthly_payment"),
        "amount_paid_down": f"CAST({paid} AS {C.AMOUNT_SUM})",
        "pct_paid_down": percent(paid, "principal_amount"),
        **_as_is("origination_date", "maturity_date", "last_payment_date"),
        "updated_at": _timestamp("updated_at"),
        "is_delinquent": flag(f"startswith({status}, {text(R.DELINQUENT_PREFIX)})"),
        "is_charged_off": flag(f"{status} = 'CHARGED_OFF'"), "is_paid_off": flag(f"{status} = 'PAID_OFF'"),
        "risk_tier": chain([(f"{status} = {text(s)}", text(t)) for s, t in R.RISK_TIER_BY_STATUS],
                           text(R.UNKNOWN_RISK_TIER)),
        "loan_age_months": months("origination_date", _today(cfg)),
    }, "loan_id IS NOT NULL"


def _credit_cards(cfg: Config) -> tuple[str, dict[str, str], str]:
    used = [(at_least("current_balance", "credit_limit", t), text(band))
            for t, band in ((R.HIGH_UTILIZATION, "HIGH"), (R.MEDIUM_UTILIZATION, "MEDIUM"))]
    return "credit_cards", {
        **_as_is("card_id", "customer_id"),
        **{c: upper(c) for c in ("card_status", "card_product", "rewards_program")},
        **_as_is("credit_limit", "current_balance", "minimum_payment_due", "last_payment_amount", "annual_fee",
                 "interest_rate"),
        "utilization_rate_pct": percent("current_balance", "credit_limit"),
        "available_credit": f"CAST(credit_limit - current_balance AS {C.AMOUNT_SUM})",
        **_as_is("opened_date", "closed_date", "last_payment_date", "statement_close_date"),
        "updated_at": _timestamp("updated_at"),
        "is_active": flag(f"{upper('card_status')} = 'ACTIVE'"),
        "utilization_risk": chain(used, "'LOW'"),
        "card_age_months": months("opened_date", _today(cfg)),
    }, "card_id IS NOT NULL"


STAGING = {"stg_customers": _customers, "stg_accounts": _accounts, "stg_transactions": _transactions,
           "stg_loans": _loans, "stg_credit_cards": _credit_cards}


def _customer_accounts(view: Mapping[str, str]) -> str:
    columns = {c: f"c.{c}" for c in CUSTOMER_IDENTITY} | {
        **{c: f"a.{c}" for c in ("account_id", "account_type", "account_category", "account_status")},
        "account_is_active": "a.is_active", "account_opened_date": "a.opened_date",
        **{c: f"a.{c}" for c in ("account_age_days", "currency_code", "balance", "available_balance",
                                 "interest_rate")},
        "days_to_account_open": "datediff(a.opened_date, c.customer_since_date)",
        "is_first_account": flag("a.opened_date = c.customer_since_date"),
    }
    return _select(columns, f"{view['stg_customers']} c JOIN {view['stg_accounts']} a "
                            "ON c.customer_id = a.customer_id")


# Per staged product: what a customer's rows add up to.
ROLLUPS = {
    "stg_accounts": {
        "total_accounts": "count(*)", "active_accounts": count_if("is_active"),
        "total_deposit_balance": total_of("balance"),
        **{f"{kind.lower()}_balance": money_of(f"sum(if(account_type = '{kind}', {cents('balance')}, 0))")
           for kind in ("CHECKING", "SAVINGS")},
        "first_account_date": "min(opened_date)",
    },
    "stg_loans": {
        "total_loans": "count(*)", "active_loans": count_if("NOT is_paid_off AND NOT is_charged_off"),
        "total_loan_balance": total_of("outstanding_balance"),
        "total_loan_originated": total_of("principal_amount"),
        "delinquent_loans": count_if("is_delinquent"), "charged_off_loans": count_if("is_charged_off"),
    },
    "stg_credit_cards": {
        "total_cards": "count(*)", "active_cards": count_if("is_active"),
        "total_credit_limit": total_of("credit_limit"), "total_card_balance": total_of("current_balance"),
        "avg_utilization_rate": f"CAST(round({narrow(total_of('utilization_rate_pct'))} / "
                                f"{narrow('nullif(count(utilization_rate_pct), 0)', 0, 20)}, 6) AS {C.MONEY_AVG})",
        "has_high_utilization": "max(if(utilization_risk = 'HIGH', 1, 0))",
    },
}


def _customer_financials(view: Mapping[str, str]) -> str:
    source, columns = f"{view['stg_customers']} c", {c: f"c.{c}" for c in CUSTOMER_IDENTITY}
    for staged, sums in ROLLUPS.items():
        source += (f"\nLEFT JOIN (SELECT customer_id, {', '.join(f'{e} AS {c}' for c, e in sums.items())}"
                   f" FROM {view[staged]} GROUP BY customer_id) r_{staged}"
                   f" ON c.customer_id = r_{staged}.customer_id")
        for c in sums:
            whole = C.MONEY_AVG if c == "avg_utilization_rate" else \
                C.AMOUNT_SUM if c.endswith(("_balance", "_originated", "_limit")) else None
            columns[c] = c if c.endswith("_date") else \
                f"CAST(coalesce({c}, 0) AS {whole})" if whole else f"coalesce({c}, 0)"
    columns["has_high_utilization"] = "CAST(coalesce(has_high_utilization, 0) AS int)"
    added = [f"coalesce(total_{c}_balance, 0)" for c in ("deposit", "loan", "card")]
    products = [f"if(coalesce(active_{c}, 0) > 0, 1, 0)" for c in ("accounts", "loans", "cards")]
    columns["total_relationship_value"] = f"CAST({' + '.join(added)} AS {C.AMOUNT_SUM})"
    columns["product_depth"] = f"CAST({' + '.join(products)} AS int)"
    columns["has_risk_flag"] = " OR ".join(
        [f"coalesce({c}, 0) > 0" for c in ("delinquent_loans", "charged_off_loans")]
        + ["coalesce(has_high_utilization, 0) = 1"])
    return _select(columns, source)


INTERMEDIATE = {"int_customer_accounts": _customer_accounts, "int_customer_financials": _customer_financials}

# The views a view reads, in the order they have to exist.
UPSTREAM = {name: () for name in STAGING} | {
    "int_customer_accounts": ("stg_customers", "stg_accounts"),
    "int_customer_financials": ("stg_customers", "stg_accounts", "stg_loans", "stg_credit_cards"),
}


def view_text(name: str, cfg: Config, relations: Mapping[str, str], views: Mapping[str, str],
              lenient: bool = False) -> str:
    """The query of view model ``name`` as Spark SQL.

    ``relations`` names the raw tables (a catalog table or parquet.`folder`),
    ``views`` the catalog views of the models it reads.
    """
    if name in STAGING:
        table, columns, where = STAGING[name](cfg)
        return _select(columns, _raw(table, relations, lenient), where)
    return INTERMEDIATE[name](views)
