"""Declared schemas. Nothing is inferred: an inferred type changes with the data."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "tinyint": T.ByteType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def _struct(spec: str, **nested: T.StructType) -> T.StructType:
    """A struct from "name type, name type, ..."; a type may name one of `nested`."""
    pairs = [field.split() for field in spec.split(",")]
    kinds = {**_TYPES, **nested}
    return T.StructType([T.StructField(name, kinds[kind]) for name, kind in pairs])


# Lake transactions. `posted_date` is the partition key: it lives in the path only.
LAKE_TRANSACTIONS = _struct(
    "transaction_id string, card_id string, account_id string, merchant_id string, txn_timestamp timestamp, "
    "amount_minor bigint, currency string, mcc int, auth_code string, txn_type string, channel string, "
    "status string, pos_entry_mode string, is_recurring boolean, feed_version tinyint"
)
LAKE_TRANSACTIONS_READ = T.StructType([*LAKE_TRANSACTIONS.fields, T.StructField("posted_date", T.DateType())])

# What the processor sends, newest version. v1 lacks the last two fields.
RAW_TRANSACTIONS = _struct(
    "transaction_id string, card_id string, account_id string, merchant_id string, txn_timestamp timestamp, "
    "posted_date date, amount_minor bigint, currency string, mcc int, auth_code string, txn_type string, "
    "channel string, status string, pos_entry_mode string, is_recurring boolean"
)
FIELDS_ADDED_IN_V2 = ("pos_entry_mode", "is_recurring")
RAW_TRANSACTIONS_V1_FIELDS = frozenset(RAW_TRANSACTIONS.names) - set(FIELDS_ADDED_IN_V2)

RAW_CUSTOMER = _struct(
    "customer_id string, created_at string, segment string, marketing_consent boolean, "
    "profile profile, address address, kyc kyc",
    profile=_struct("first_name string, last_name string, date_of_birth string, email string, phone string"),
    address=_struct("line1 string, line2 string, city string, postcode string, country string"),
    kyc=_struct("status string, verified_at string, risk_band string"),
)
LAKE_CUSTOMERS = _struct(
    "customer_id string, created_at timestamp, segment string, marketing_consent boolean, first_name string, "
    "last_name string, date_of_birth date, email string, phone string, address_line1 string, "
    "address_line2 string, city string, postcode string, country string, kyc_status string, "
    "kyc_verified_at timestamp, kyc_risk_band string, document string"
)
LAKE_ACCOUNTS = _struct(
    "account_id string, customer_id string, product_code string, currency string, status string, "
    "opened_date date, closed_date date, overdraft_limit_minor bigint"
)
LAKE_CARDS = _struct(
    "card_id string, account_id string, card_type string, network string, issued_date date, "
    "expiry_date date, status string"
)
LAKE_MERCHANTS = _struct(
    "merchant_id string, merchant_name string, mcc int, category string, country string, "
    "is_online boolean, first_seen_date date"
)
LAKE_FX_RATES = _struct("rate_date date, currency string, rate_to_gbp double, source string")

LAKE_FLAT = {
    "customers": LAKE_CUSTOMERS,
    "accounts": LAKE_ACCOUNTS,
    "cards": LAKE_CARDS,
    "merchants": LAKE_MERCHANTS,
    "fx_rates": LAKE_FX_RATES,
}

DEFECT_LEDGER = _struct("transaction_id string, defect_code string")
