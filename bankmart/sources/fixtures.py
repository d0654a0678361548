"""Raw banking tables derived from the driver's TPC-H style test tables.

The driver ships customer / nation / region / orders / lineitem Parquet files;
this module maps them, row for row, onto the five raw banking sources so that
every model runs over data whose size grows with the scale factor. Dirt is
planted on purpose (stray spaces, lower case, nulls, invalid statuses,
orphan keys, zero limits) so the staging rules and the data tests have
something to find. Every driver row is used: the orders are partitioned by
key into accounts, loans and cards, every line item becomes a transaction,
and every customer (joined with the 25/5-row nation and region tables)
becomes a raw customer.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bankmart.config import FIXTURE_AS_OF
from bankmart.sources.raw import RawTables, from_frames

# Fixed values of the mapping.
CUSTOMER_EPOCH = dt.date(1995, 1, 1)
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED")
ACCOUNT_TYPE_BY_PRIORITY = ("checking", "SAVINGS ", "MONEY_MARKET", "CD", "INVESTMENT")
LOAN_TYPE_BY_PRIORITY = ("personal", "AUTO", "HOME_EQUITY", "STUDENT", "SMALL_BUSINESS")
CARD_PRODUCT_BY_PRIORITY = ("platinum", "GOLD", "CASH_BACK", "TRAVEL", "SECURED")
CHANNEL_BY_KEY_MOD_5 = ("DIGITAL", "BRANCH", "REFERRAL", "DIRECT_MAIL", "PARTNER")
SEGMENT_BY_MKTSEGMENT = {"BUILDING": " small_business", "MACHINERY": "premium",
                         "FURNITURE": "Student "}
LOAN_STATUS_BY_KEY_MOD_36 = {6: "delinquent_30", 10: "DELINQUENT_60", 14: "DELINQUENT_90",
                             18: "CHARGED_OFF", 22: "PAID_OFF", 26: "DELINQUENT_120",
                             30: None}
TXN_TYPE_BY_LINENUMBER = {1: "debit", 2: "DEBIT ", 3: "CREDIT", 4: "TRANSFER", 5: "FEE",
                          6: "INTEREST", 7: "REVERSAL"}


def _d(value: str) -> Column:
    return F.lit(Decimal(value))


def _money(c: Column) -> Column:
    return c.cast("decimal(18,2)")


def _rate(numerator: Column) -> Column:
    """numerator / 10000 as decimal(8,4), exact."""
    return (numerator.cast("decimal(12,0)") / F.lit(10000)).cast("decimal(8,4)")


def _customer_id(custkey: Column) -> Column:
    return F.format_string("C%09d", custkey)


def _by_priority(values: tuple[str, ...]) -> Column:
    expr = None
    for priority, value in zip(PRIORITIES, values):
        expr = (F.when(F.col("o_orderpriority") == priority, value) if expr is None
                else expr.when(F.col("o_orderpriority") == priority, value))
    return expr.otherwise(values[-1])


def _case_map(key: Column, mapping: dict, default) -> Column:
    expr = None
    for k, v in mapping.items():
        value = F.lit(v).cast("string")
        expr = F.when(key == k, value) if expr is None else expr.when(key == k, value)
    return expr.otherwise(F.lit(default).cast("string"))


# First names by customer key: one and several words, every kind of word break
# and of character that is none (both apostrophes, a combining accent, an equals sign).
FIRST_NAMES = (" customer ", "mary-jane", "o'brien", "d\u2019angelo", " anna  maria", "JEAN-luc PAUL",
               "rene\u0301e", "a=b smith", "\u00e9lan (jr.)", "x_y/z", "tab\tname")


def _ts(d: Column) -> Column:
    return d.cast("timestamp_ntz")


def customers(customer: DataFrame, nation: DataFrame, region: DataFrame,
              as_of: dt.date) -> DataFrame:
    k = F.col("c_custkey")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey)
    base = customer.join(geo.select("n_nationkey", "n_name", "r_name"),
                         customer.c_nationkey == geo.n_nationkey)
    segment = _case_map(F.col("c_mktsegment"), SEGMENT_BY_MKTSEGMENT, "RETAIL")
    return base.select(
        _customer_id(k).alias("customer_id"),
        F.element_at(F.array(*map(F.lit, FIRST_NAMES)), (k % len(FIRST_NAMES) + 1).cast("int"))
        .alias("first_name"),
        F.col("n_name").alias("last_name"),
        F.when(k % 23 == 0, F.lit(None).cast("string"))
         .when(k % 97 == 0, F.lit("shared@email.com"))
         .otherwise(F.concat(F.lit(" Customer."), k.cast("string"), F.lit("@Email.com ")))
         .alias("email"),
        F.concat(F.lit(" 555-"), F.lpad((k % 10000).cast("string"), 4, "0")).alias("phone"),
        segment.alias("customer_segment"),
        _case_map(k % 5, dict(enumerate(CHANNEL_BY_KEY_MOD_5)), None).alias("acquisition_channel"),
        F.lower(F.substring("r_name", 1, 2)).alias("state"),
        F.lpad((k % 100000).cast("string"), 5, "0").alias("zip_code"),
        F.date_add(F.lit(CUSTOMER_EPOCH), ((k * 7919) % 2500).cast("int")).alias("created_at"),
        _ts(F.date_sub(F.lit(as_of), (k % 3).cast("int"))).alias("updated_at"),
    )


def _orders(orders: DataFrame) -> DataFrame:
    return orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                         "o_orderdate", "o_orderpriority")


def accounts(orders: DataFrame, as_of: dt.date) -> DataFrame:
    k = F.col("o_orderkey")
    price = _money(F.col("o_totalprice"))
    finished = F.col("o_orderstatus") == "F"
    opened = F.col("o_orderdate").cast("date")
    return _orders(orders).where((k % 4).isin(0, 1)).select(
        F.concat(F.lit("A"), k.cast("string")).alias("account_id"),
        _customer_id(F.col("o_custkey")).alias("customer_id"),
        _by_priority(ACCOUNT_TYPE_BY_PRIORITY).alias("account_type"),
        F.when(~finished, F.lit("active"))
         .when(k % 8 == 0, F.lit("FROZEN"))
         .when(k % 8 == 1, F.lit("PENDING"))
         .otherwise(F.lit("CLOSED")).alias("account_status"),
        F.lit(" usd").alias("currency_code"),
        _money(price * _d("0.04")).alias("balance"),
        _money(price * _d("0.03")).alias("available_balance"),
        _rate(k % 500).alias("interest_rate"),
        opened.alias("opened_date"),
        F.when(finished & (k % 8 == 4), F.date_add(opened, 30)).alias("closed_date"),
        _ts(F.lit(as_of)).alias("updated_at"),
    )


def loans(orders: DataFrame, as_of: dt.date) -> DataFrame:
    k = F.col("o_orderkey")
    price = _money(F.col("o_totalprice"))
    opened = F.col("o_orderdate").cast("date")
    return _orders(orders).where(k % 4 == 2).select(
        F.concat(F.lit("L"), k.cast("string")).alias("loan_id"),
        _customer_id(F.col("o_custkey")).alias("customer_id"),
        _by_priority(LOAN_TYPE_BY_PRIORITY).alias("loan_type"),
        _case_map(k % 36, LOAN_STATUS_BY_KEY_MOD_36, "CURRENT").alias("loan_status"),
        _money(price * _d("0.10")).alias("principal_amount"),
        _money(price * _d("0.01") * (k % 10)).alias("outstanding_balance"),
        _rate(k % 1200).alias("interest_rate"),
        _money(price * _d("0.002")).alias("monthly_payment"),
        opened.alias("origination_date"),
        F.date_add(opened, 1826).alias("maturity_date"),
        F.when(k % 9 != 0, F.date_add(opened, 60)).alias("last_payment_date"),
        _ts(F.lit(as_of)).alias("updated_at"),
    )


def credit_cards(orders: DataFrame, as_of: dt.date) -> DataFrame:
    k = F.col("o_orderkey")
    price = _money(F.col("o_totalprice"))
    opened = F.col("o_orderdate").cast("date")
    return _orders(orders).where(k % 4 == 3).select(
        F.concat(F.lit("K"), k.cast("string")).alias("card_id"),
        _customer_id(F.col("o_custkey")).alias("customer_id"),
        F.when(F.col("o_orderstatus") != "F", F.lit("Active"))
         .when(k % 8 == 3, F.lit("SUSPENDED"))
         .otherwise(F.lit("CLOSED")).alias("card_status"),
        _by_priority(CARD_PRODUCT_BY_PRIORITY).alias("card_product"),
        F.lit("points ").alias("rewards_program"),
        F.when(k % 52 == 3, _money(F.lit(0)))
         .otherwise(_money(price * _d("0.05"))).alias("credit_limit"),
        _money(price * _d("0.005") * (k % 11)).alias("current_balance"),
        _money(price * _d("0.001")).alias("minimum_payment_due"),
        _money(price * _d("0.002")).alias("last_payment_amount"),
        _money(F.lit(25) * (k % 4)).alias("annual_fee"),
        _rate(F.lit(1500) + k % 1000).alias("interest_rate"),
        opened.alias("opened_date"),
        F.lit(None).cast("date").alias("closed_date"),
        F.date_add(opened, 45).alias("last_payment_date"),
        F.date_add(opened, 30).alias("statement_close_date"),
        _ts(F.lit(as_of)).alias("updated_at"),
    )


def transactions(lineitem: DataFrame, as_of: dt.date) -> DataFrame:
    ok, ln = F.col("l_orderkey"), F.col("l_linenumber")
    pk, sk, qty = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_quantity")
    txn_date = F.date_sub(F.lit(as_of), ((pk * 31 + sk * 17 + ln * 13) % 700).cast("int"))
    # Every line item is a transaction. Lines of account orders stay on their
    # account; lines of loan and card orders are booked to the account order
    # of the same block of four keys, except one block in ten, whose lines
    # keep a key no account has (planted orphans).
    booked_to = F.when(((ok % 4) >= 2) & (ok % 40 != 2), ok - ok % 4).otherwise(ok)
    amount = _money(F.col("l_extendedprice"))
    return (
        lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                        "l_quantity", "l_extendedprice", "l_returnflag")
        .select(
            F.when((qty == 50) & (ln == 7), F.lit(None).cast("string"))
             .otherwise(F.concat(F.lit("T"), F.concat_ws(
                 "-", ok.cast("string"), ln.cast("string"), pk.cast("string"),
                 sk.cast("string")))).alias("transaction_id"),
            F.concat(F.lit("A"), booked_to.cast("string")).alias("account_id"),
            _case_map(ln, TXN_TYPE_BY_LINENUMBER, None).alias("transaction_type"),
            F.when(qty <= 44, F.lit("posted")).when(qty <= 46, F.lit("PENDING"))
             .when(qty <= 48, F.lit("REVERSED")).otherwise(F.lit("FAILED")).alias("status"),
            F.when(F.col("l_returnflag") == "A", F.lit("atm"))
             .when(F.col("l_returnflag") == "N", F.lit("online "))
             .otherwise(F.lit("BRANCH")).alias("channel"),
            F.lpad((pk % 10000).cast("string"), 4, "0").alias("merchant_category_code"),
            F.concat(F.lit(" part "), pk.cast("string")).alias("description"),
            F.when(sk % 2 == 0, -amount).otherwise(amount).alias("amount"),
            txn_date.alias("transaction_date"),
            F.date_add(txn_date, 1).alias("posted_date"),
            _ts(txn_date).alias("created_at"),
        )
    )


# The driver tables' columns used here, declared so reads skip schema inference
# and prune to these columns from the start.
DRIVER_SCHEMAS = {
    "customer": "c_custkey BIGINT, c_nationkey INT, c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
    "orders": ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
               "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"),
    "lineitem": ("l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                 "l_quantity DOUBLE, l_extendedprice DOUBLE, l_returnflag STRING"),
}


def raw_tables(spark: SparkSession, sf_dir: str, as_of: dt.date = FIXTURE_AS_OF) -> RawTables:
    """The five raw banking tables derived from ``sf_dir``'s driver tables."""
    def read(name: str) -> DataFrame:
        return spark.read.schema(DRIVER_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")

    orders = read("orders")
    return from_frames(
        customers=customers(read("customer"), read("nation"), read("region"), as_of),
        accounts=accounts(orders, as_of),
        transactions=transactions(read("lineitem"), as_of),
        loans=loans(orders, as_of),
        credit_cards=credit_cards(orders, as_of),
    )
