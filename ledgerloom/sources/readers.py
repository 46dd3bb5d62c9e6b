"""One reader per wire format, and the cheap look at field names the contract gate runs on."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.schemas import (
    LAKE_ACCOUNTS,
    LAKE_CARDS,
    LAKE_CUSTOMERS,
    LAKE_FX_RATES,
    LAKE_MERCHANTS,
    LAKE_TRANSACTIONS_READ,
    RAW_CUSTOMER,
    RAW_TRANSACTIONS,
    RAW_TRANSACTIONS_V1_FIELDS,
)
from ledgerloom.sources.file_index import listed, versions_of

# The tokens the cards extract uses for "no value".
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)
_AVRO_PACKAGE = "org.apache.spark:spark-avro"


# ------------------------------------------------------------------ reading


def read_customers(spark: SparkSession, path: str) -> DataFrame:
    """Nested JSON Lines to flat columns, the line itself kept as `document`.

    A malformed line or a bad `created_at` fails the read; a bad birth date or verification time
    becomes null.
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    nested = lines.select("value", F.from_json("value", RAW_CUSTOMER, {"mode": "FAILFAST"}).alias("c"))
    return nested.select(
        "c.customer_id",
        F.col("c.created_at").cast("timestamp").alias("created_at"),
        "c.segment",
        "c.marketing_consent",
        "c.profile.first_name",
        "c.profile.last_name",
        F.col("c.profile.date_of_birth").try_cast("date").alias("date_of_birth"),
        "c.profile.email",
        "c.profile.phone",
        F.col("c.address.line1").alias("address_line1"),
        F.col("c.address.line2").alias("address_line2"),
        "c.address.city",
        "c.address.postcode",
        "c.address.country",
        F.col("c.kyc.status").alias("kyc_status"),
        F.col("c.kyc.verified_at").try_cast("timestamp").alias("kyc_verified_at"),
        F.col("c.kyc.risk_band").alias("kyc_risk_band"),
        F.trim("value").alias("document"),
    ).select(*LAKE_CUSTOMERS.names)


def _csv(spark: SparkSession, path: str, schema: T.StructType, nulls: tuple[str, ...], lenient: set[str]) -> DataFrame:
    """A CSV bound by header name, every column text first: a declared schema would bind by
    position, an inferred one would change with the data. A column that is not there (a forced
    landing) is null."""
    text = spark.read.csv(path, header=True, inferSchema=False, nullValue="")

    def typed(field: T.StructField) -> Column:
        if field.name not in text.columns:
            return F.lit(None).cast(field.dataType).alias(field.name)
        raw = F.when(~F.col(field.name).isin(*nulls), F.col(field.name))
        value = raw.try_cast(field.dataType) if field.name in lenient else raw.cast(field.dataType)
        return value.alias(field.name)

    return text.select(*[typed(field) for field in schema.fields])


def read_accounts(spark: SparkSession, path: str) -> DataFrame:
    """Only the empty string is null; an unreadable `closed_date` is null too."""
    return _csv(spark, path, LAKE_ACCOUNTS, ("",), {"closed_date"})


def read_cards(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, LAKE_CARDS, NULL_TOKENS, set())


def read_merchants(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LAKE_MERCHANTS).parquet(path)


def read_fx_rates(spark: SparkSession, raw: str) -> DataFrame:
    """One JSON array per file. Read by folder glob, so `rate_date` is the value in the body."""
    return spark.read.schema(LAKE_FX_RATES).option("multiLine", True).json(f"{raw}/fx_rates/rate_date=*")


def _source(spark: SparkSession, fmt: str, path: str | list[str], **options: str) -> DataFrame:
    try:
        return spark.read.format(fmt).options(**options).load(path)
    except AnalysisException as failure:
        if fmt == "avro" and "avro" in str(failure).lower() and "find" in str(failure).lower():
            raise RuntimeError(f"reading Avro needs the {_AVRO_PACKAGE} package on the classpath") from failure
        raise


def partition_dates(spark: SparkSession, base: str) -> DataFrame:
    """The day partitions that hold files, in order."""
    return listed(spark, base).select("day").distinct().orderBy("day")


def writer_fields(spark: SparkSession, path: str, fmt: str) -> frozenset[str]:
    """The field names a transaction file was written with, from its header or footer."""
    if fmt == "json":
        return observe_jsonl(spark, path)
    return frozenset(_source(spark, fmt, path).schema.names)


def writer_version(spark: SparkSession, path: str, fmt: str) -> int:
    """Which writer a transaction file came from, by its own header or footer."""
    return 1 if writer_fields(spark, path, fmt) | {"posted_date"} == RAW_TRANSACTIONS_V1_FIELDS else 2


def read_transactions(
    spark: SparkSession,
    base: str,
    fmt: str = "avro",
    avro_schema: str | None = None,
    index: DataFrame | None = None,
    days: list[dt.date] | None = None,
) -> DataFrame:
    """The mixed history, or only some days of it, as one frame in canonical columns.

    Every file is read with the one full schema: fields a file does not have come back null, none it
    has is left out. `feed_version` is the file's own, as `index` knows it (see `file_index`); without
    an index every file is opened once. `posted_date` is the directory's.
    """
    if index is None:
        files = listed(spark, base)
        index = versions_of(spark, files, lambda path: writer_version(spark, path, fmt))
    if index.isEmpty():
        return spark.createDataFrame([], LAKE_TRANSACTIONS_READ)
    reader = spark.read.format(fmt)
    if fmt == "avro" and avro_schema:
        reader = reader.option("avroSchema", avro_schema)
    else:
        reader = reader.schema(RAW_TRANSACTIONS)
    history = reader.load(base)
    if days is not None:
        history, index = history.where(F.col("posted_date").isin(days)), index.where(F.col("day").isin(days))
    # The metadata column has the name as in a URI.
    name = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))
    history = history.withColumn("_file", name)
    # One row a file; the paths have been on the driver already.
    versions = F.broadcast(index.select("day", "file", "feed_version"))
    tagged = history.join(
        versions, (history["posted_date"] == versions["day"]) & (history["_file"] == versions["file"]), "left"
    )
    return conform(tagged)


def conform(history: DataFrame) -> DataFrame:
    """Canonical columns, types and order; columns a history never had are null."""
    present = set(history.columns)
    return history.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in LAKE_TRANSACTIONS_READ.fields
        ]
    )


# ------------------------------------------------------------------ observing


def _keys(df: DataFrame, document: Column) -> frozenset[str]:
    row = df.select(F.json_object_keys(document).alias("keys")).first()
    return frozenset(row["keys"] or ()) if row else frozenset()


def observe_jsonl(spark: SparkSession, path: str) -> frozenset[str]:
    """Field names of the first line; an empty file has none."""
    return _keys(spark.read.text(path).limit(1), F.col("value"))


def observe_json_array(spark: SparkSession, path: str) -> frozenset[str]:
    return _keys(spark.read.text(path, wholetext=True).limit(1), F.get_json_object("value", "$[0]"))


def observe_csv(spark: SparkSession, path: str) -> frozenset[str]:
    return frozenset(spark.read.csv(path, header=True, inferSchema=False).columns)


def observe_parquet(spark: SparkSession, path: str) -> frozenset[str]:
    return frozenset(spark.read.parquet(path).schema.names)


def _newest(spark: SparkSession, base: str) -> str | None:
    """The greatest path of the greatest day."""
    last = listed(spark, base).agg(F.max(F.struct("day", "path")).alias("f")).first()["f"]
    return last["path"] if last else None


def observe_all(spark: SparkSession, raw: str, transactions_format: str = "avro") -> dict[str, frozenset[str]]:
    """What each feed delivered. A feed without files is absent."""
    simple = {
        "customers": (observe_jsonl, f"{raw}/customers/customers.jsonl"),
        "accounts": (observe_csv, f"{raw}/accounts/accounts.csv"),
        "cards": (observe_csv, f"{raw}/cards/cards.csv"),
        "merchants": (observe_parquet, f"{raw}/merchants/merchants.parquet"),
    }
    observed: dict[str, frozenset[str]] = {}
    for feed, (look, path) in simple.items():
        fields = _if_there(lambda look=look, path=path: look(spark, path))
        if fields is not None:
            observed[feed] = fields
    transactions = _newest(spark, f"{raw}/card_transactions")
    if transactions is not None:
        # The day is read from the directory, so the directory delivers it.
        observed["card_transactions"] = writer_fields(spark, transactions, transactions_format) | {"posted_date"}
    rates = _newest(spark, f"{raw}/fx_rates")
    if rates is not None:
        observed["fx_rates"] = observe_json_array(spark, rates)
    return observed


def _if_there(look):
    try:
        return look()
    except AnalysisException as failure:
        if failure.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
