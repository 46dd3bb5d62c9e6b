"""String columns: keys, labels, formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the UK postcode shape promised by the customer contract.
POSTCODE_PATTERN = r"^[A-Z]{1,2}[0-9][A-Z0-9]? ?[0-9][A-Z]{2}$"

# Reader labels that plain capitalisation would get wrong.
LABELS = {
    "unknown": "ATM, fees and unmatched",
    "atm_withdrawal": "ATM withdrawal",
    "misc_retail": "Other retail",
}


def version_key(business_key: Column, valid_from: Column) -> Column:
    return F.md5(F.concat(business_key, F.lit("|"), valid_from.cast("string")))


def padded_id(prefix: str, number: Column, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), width, "0"))


def reader_label(code: Column) -> Column:
    words = F.lower(F.regexp_replace(code, "_", " "))
    label = F.concat(F.upper(F.substring(words, 1, 1)), F.substr(words, F.lit(2)))
    for value, text in LABELS.items():
        label = F.when(code == value, F.lit(text)).otherwise(label)
    return label


def squash(text: Column) -> Column:
    """Lower case without spaces: the shape of a badly keyed postcode."""
    return F.lower(F.regexp_replace(text, " ", ""))


def postcode_ok(postcode: Column) -> Column:
    return postcode.rlike(POSTCODE_PATTERN)
