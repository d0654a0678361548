"""Raw source tables: explicit schemas, keys, and the declared data tests.

Raw tables are read with these schemas (never inferred). Money is
decimal(18,2), rates decimal(8,4); text keys are strings and are passed
through untouched by staging.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

SOURCE_NAME = "raw_banking"

_S, _DATE, _TS = T.StringType(), T.DateType(), T.TimestampNTZType()
_MONEY, _RATE = T.DecimalType(18, 2), T.DecimalType(8, 4)


def _schema(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in cols])


CUSTOMERS = _schema(
    ("customer_id", _S), ("first_name", _S), ("last_name", _S), ("email", _S),
    ("phone", _S), ("customer_segment", _S), ("acquisition_channel", _S),
    ("state", _S), ("zip_code", _S), ("created_at", _DATE), ("updated_at", _TS),
)

ACCOUNTS = _schema(
    ("account_id", _S), ("customer_id", _S), ("account_type", _S),
    ("account_status", _S), ("currency_code", _S), ("balance", _MONEY),
    ("available_balance", _MONEY), ("interest_rate", _RATE),
    ("opened_date", _DATE), ("closed_date", _DATE), ("updated_at", _TS),
)

TRANSACTIONS = _schema(
    ("transaction_id", _S), ("account_id", _S), ("transaction_type", _S),
    ("status", _S), ("channel", _S), ("merchant_category_code", _S),
    ("description", _S), ("amount", _MONEY), ("transaction_date", _DATE),
    ("posted_date", _DATE), ("created_at", _TS),
)

LOANS = _schema(
    ("loan_id", _S), ("customer_id", _S), ("loan_type", _S), ("loan_status", _S),
    ("principal_amount", _MONEY), ("outstanding_balance", _MONEY),
    ("interest_rate", _RATE), ("monthly_payment", _MONEY),
    ("origination_date", _DATE), ("maturity_date", _DATE),
    ("last_payment_date", _DATE), ("updated_at", _TS),
)

CREDIT_CARDS = _schema(
    ("card_id", _S), ("customer_id", _S), ("card_status", _S), ("card_product", _S),
    ("rewards_program", _S), ("credit_limit", _MONEY), ("current_balance", _MONEY),
    ("minimum_payment_due", _MONEY), ("last_payment_amount", _MONEY),
    ("annual_fee", _MONEY), ("interest_rate", _RATE), ("opened_date", _DATE),
    ("closed_date", _DATE), ("last_payment_date", _DATE),
    ("statement_close_date", _DATE), ("updated_at", _TS),
)

# The seed file ships dates without times; read all text, then the two dates.
SEED_CUSTOMERS = _schema(
    ("customer_id", _S), ("first_name", _S), ("last_name", _S), ("email", _S),
    ("phone", _S), ("customer_segment", _S), ("acquisition_channel", _S),
    ("state", _S), ("zip_code", _S), ("created_at", _DATE), ("updated_at", _DATE),
)

RAW_SCHEMAS: dict[str, T.StructType] = {
    "customers": CUSTOMERS,
    "accounts": ACCOUNTS,
    "transactions": TRANSACTIONS,
    "loans": LOANS,
    "credit_cards": CREDIT_CARDS,
}

PRIMARY_KEYS: dict[str, str] = {
    "customers": "customer_id",
    "accounts": "account_id",
    "transactions": "transaction_id",
    "loans": "loan_id",
    "credit_cards": "card_id",
}

# Accepted domains of the raw sources and of the customer 360 mart.
CUSTOMER_SEGMENTS = ("RETAIL", "SMALL_BUSINESS", "PREMIUM", "STUDENT")
ACQUISITION_CHANNELS = ("DIGITAL", "BRANCH", "REFERRAL", "DIRECT_MAIL", "PARTNER")
ACCOUNT_TYPES = ("CHECKING", "SAVINGS", "MONEY_MARKET", "CD", "INVESTMENT")
ACCOUNT_STATUSES = ("ACTIVE", "CLOSED", "FROZEN", "PENDING")
TRANSACTION_TYPES = ("DEBIT", "CREDIT", "TRANSFER", "FEE", "INTEREST", "REVERSAL")
TRANSACTION_STATUSES = ("POSTED", "PENDING", "REVERSED", "FAILED")
LOAN_TYPES = ("PERSONAL", "AUTO", "HOME_EQUITY", "STUDENT", "SMALL_BUSINESS")
LOAN_STATUSES = ("CURRENT", "DELINQUENT_30", "DELINQUENT_60", "DELINQUENT_90",
                 "CHARGED_OFF", "PAID_OFF")
CARD_STATUSES = ("ACTIVE", "CLOSED", "SUSPENDED", "PENDING_ACTIVATION")
LIFECYCLE_STAGES = ("ONBOARDING", "ACTIVE", "LOYAL", "AT_RISK", "DORMANT")
LTV_TIERS = ("TIER_1_HIGH_VALUE", "TIER_2_MID_VALUE", "TIER_3_STANDARD", "TIER_4_LOW_VALUE")
CHURN_RISKS = ("HIGH", "MEDIUM", "LOW")


# ---------------------------------------------------------------------------
# Declared tests (kind, table, column, argument), in declaration order.
# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class Unique:
    table: str
    column: str


@dataclass(frozen=True)
class NotNull:
    table: str
    column: str


@dataclass(frozen=True)
class AcceptedValues:
    table: str
    column: str
    values: tuple[str, ...]


@dataclass(frozen=True)
class Relationship:
    table: str
    column: str
    to_table: str
    to_column: str


@dataclass(frozen=True)
class Freshness:
    table: str
    loaded_at_field: str


SOURCE_TESTS: tuple = (
    Unique("customers", "customer_id"), NotNull("customers", "customer_id"),
    NotNull("customers", "first_name"), NotNull("customers", "last_name"),
    Unique("customers", "email"), NotNull("customers", "email"),
    AcceptedValues("customers", "customer_segment", CUSTOMER_SEGMENTS),
    AcceptedValues("customers", "acquisition_channel", ACQUISITION_CHANNELS),
    NotNull("customers", "created_at"), NotNull("customers", "updated_at"),

    Unique("accounts", "account_id"), NotNull("accounts", "account_id"),
    NotNull("accounts", "customer_id"),
    Relationship("accounts", "customer_id", "customers", "customer_id"),
    NotNull("accounts", "account_type"),
    AcceptedValues("accounts", "account_type", ACCOUNT_TYPES),
    NotNull("accounts", "account_status"),
    AcceptedValues("accounts", "account_status", ACCOUNT_STATUSES),
    NotNull("accounts", "opened_date"), NotNull("accounts", "balance"),

    Unique("transactions", "transaction_id"), NotNull("transactions", "transaction_id"),
    NotNull("transactions", "account_id"),
    Relationship("transactions", "account_id", "accounts", "account_id"),
    NotNull("transactions", "transaction_type"),
    AcceptedValues("transactions", "transaction_type", TRANSACTION_TYPES),
    NotNull("transactions", "amount"), NotNull("transactions", "transaction_date"),
    AcceptedValues("transactions", "status", TRANSACTION_STATUSES),

    Unique("loans", "loan_id"), NotNull("loans", "loan_id"),
    NotNull("loans", "customer_id"),
    Relationship("loans", "customer_id", "customers", "customer_id"),
    AcceptedValues("loans", "loan_type", LOAN_TYPES),
    AcceptedValues("loans", "loan_status", LOAN_STATUSES),
    NotNull("loans", "origination_date"), NotNull("loans", "principal_amount"),
    NotNull("loans", "outstanding_balance"), NotNull("loans", "interest_rate"),

    Unique("credit_cards", "card_id"), NotNull("credit_cards", "card_id"),
    NotNull("credit_cards", "customer_id"),
    Relationship("credit_cards", "customer_id", "customers", "customer_id"),
    AcceptedValues("credit_cards", "card_status", CARD_STATUSES),
    NotNull("credit_cards", "credit_limit"), NotNull("credit_cards", "current_balance"),
    NotNull("credit_cards", "minimum_payment_due"), NotNull("credit_cards", "opened_date"),
)

MART_TESTS: tuple = (
    Unique("mart_customer_360", "customer_id"), NotNull("mart_customer_360", "customer_id"),
    NotNull("mart_customer_360", "lifecycle_stage"),
    AcceptedValues("mart_customer_360", "lifecycle_stage", LIFECYCLE_STAGES),
    NotNull("mart_customer_360", "ltv_tier"),
    AcceptedValues("mart_customer_360", "ltv_tier", LTV_TIERS),
    NotNull("mart_customer_360", "churn_risk"),
    AcceptedValues("mart_customer_360", "churn_risk", CHURN_RISKS),
    NotNull("mart_customer_360", "engagement_score"),
    NotNull("mart_customer_360", "total_relationship_value"),
    NotNull("mart_customer_360", "product_depth"),
)

FRESHNESS_TESTS: tuple[Freshness, ...] = (
    Freshness("customers", "updated_at"),
    Freshness("accounts", "updated_at"),
    Freshness("transactions", "transaction_date"),
    Freshness("loans", "updated_at"),
    Freshness("credit_cards", "updated_at"),
)
