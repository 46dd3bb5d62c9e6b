"""The marts of one set of feeds, each built once and kept as a written table.

A node is written the first time something asks for it. Consumers then scan a table with known
size, which is what makes the broadcast choices downstream size-checked, and a lost executor
never forces the chain behind it to be recomputed.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.dates import month_key
from ledgerloom.operators.rules import category_medians
from ledgerloom.plans import marts
from ledgerloom.plans.publishing import current_path
from ledgerloom.session import clustered, new_folder, write_and_reload
from ledgerloom.sources.feeds import Feeds, with_auth_date

# Rows of two or three short columns: well under 100 MB once hashed.
BROADCAST_ROWS = 500_000

GOLD_FACT = "fct_card_transaction"
GOLD_FLAT = (
    "dim_customer", "dim_account", "dim_card", "dim_merchant", "dim_txn_context", "dim_date", "fx_rate",
    "agg_customer_category_month", "agg_dq_scorecard", "customer_document",
)


class Warehouse:
    # Whether each file of the fact holds one month.
    months_lie_apart = True

    def __init__(self, spark: SparkSession, feeds: Feeds) -> None:
        self.spark = spark
        self.feeds = feeds
        self.row_counts: dict[str, int] = {}

    def _keep(
        self,
        name: str,
        build: Callable[[], DataFrame],
        partition_by: str | None = None,
        finish: Callable[[DataFrame], DataFrame] | None = None,
    ) -> DataFrame:
        path = new_folder(self.spark, name)
        table, self.row_counts[name] = write_and_reload(build(), path, partition_by, finish)
        return table

    def _small(self, name: str) -> DataFrame:
        """A written table, marked as a broadcast side if counted small."""
        table = getattr(self, name)
        return F.broadcast(table) if self.broadcastable(name) else table

    def _together(self, *names: str) -> None:
        """Build independent tables at the same time, so that small jobs fill the gaps of large ones."""
        with ThreadPoolExecutor(max_workers=len(names)) as pool:
            for built in [pool.submit(getattr, self, name) for name in names]:
                built.result()

    def broadcastable(self, name: str) -> bool:
        """Whether a written table has few enough rows to send a narrow cut of it to every task.

        Callers have a plan for either answer.
        """
        getattr(self, name)
        return self.row_counts[name] <= BROADCAST_ROWS

    def context(self, rule: Column, *columns: str) -> DataFrame:
        """Key and `columns` of the context rows that satisfy `rule`: a broadcast side if counted small."""
        chosen = self.dim_txn_context.where(rule).select("txn_context_key", *columns)
        return F.broadcast(chosen) if self.broadcastable("dim_txn_context") else chosen

    def _keep_clustered(self, name: str, df: DataFrame, *keys: str) -> DataFrame:
        path = new_folder(self.spark, name)
        clustered(df, keys).write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    @cached_property
    def staged(self) -> DataFrame:
        return with_auth_date(self.feeds.transactions)

    @cached_property
    def deduped(self) -> DataFrame:
        grouped = self.feeds.grouped_transactions
        rows = self.feeds.transactions if grouped is None else grouped
        return self._keep("deduped", lambda: marts.deduped(rows))

    @cached_property
    def fx_rate(self) -> DataFrame:
        return self._keep("fx_rate", lambda: marts.fx_daily(self.feeds.fx_rates, self.deduped))

    @cached_property
    def medians(self) -> DataFrame:
        return self._keep("medians", lambda: category_medians(self.deduped))

    @cached_property
    def card_ids(self) -> DataFrame:
        """The distinct ids of the cards extract."""
        return self._keep("card_ids", lambda: self.feeds.cards.select("card_id").distinct())

    @cached_property
    def scored(self) -> DataFrame:
        return marts.scored(self.deduped, self.card_ids, self.medians)

    @cached_property
    def customer_history(self) -> DataFrame:
        if self.feeds.customer_history is not None:
            return self.feeds.customer_history
        # The document is most of a row and no part of the dimension; `customer_document` reads it from the feed.
        taken = tuple(replace(snapshot, rows=snapshot.rows.drop("document")) for snapshot in self.feeds.customers)
        build = lambda: marts.history(taken, "customer_id", marts.WATCHED_CUSTOMER)
        return self._keep("customer_history", build)

    @cached_property
    def account_history(self) -> DataFrame:
        if self.feeds.account_history is not None:
            return self.feeds.account_history
        build = lambda: marts.history(self.feeds.accounts, "account_id", marts.WATCHED_ACCOUNT)
        return self._keep("account_history", build)

    @cached_property
    def dim_customer(self) -> DataFrame:
        return self._keep("dim_customer", lambda: marts.dim_customer(self.customer_history))

    @cached_property
    def dim_account(self) -> DataFrame:
        return self._keep("dim_account", lambda: marts.dim_account(self.account_history))

    @cached_property
    def account_timeline(self) -> DataFrame:
        return self._keep("account_timeline", lambda: marts.account_timeline(self.dim_account, self.dim_customer))

    @cached_property
    def account_lookup(self) -> DataFrame:
        build = lambda: marts.account_lookup(self.deduped, self.card_ids, self.account_timeline)
        return self._keep("account_lookup", build)

    @cached_property
    def dim_card(self) -> DataFrame:
        return self._keep("dim_card", lambda: marts.dim_card(self.feeds.cards))

    @cached_property
    def dim_merchant(self) -> DataFrame:
        return self._keep("dim_merchant", lambda: marts.dim_merchant(self.feeds.merchants))

    @cached_property
    def dim_currency(self) -> DataFrame:
        return marts.dim_currency(self.fx_rate)

    @cached_property
    def dim_date(self) -> DataFrame:
        return self._keep("dim_date", lambda: marts.dim_date(self.deduped))

    @cached_property
    def dim_txn_context(self) -> DataFrame:
        return self._keep("dim_txn_context", lambda: marts.dim_txn_context(self.deduped))

    @cached_property
    def fact_by_month(self) -> DataFrame:
        """The fact in month directories: `posted_month` + the fact's own columns."""
        self._together("deduped", "dim_customer", "dim_account", "dim_merchant", "card_ids")
        self._together("fx_rate", "medians", "dim_txn_context", "account_timeline")
        month = month_key(F.col("posted_date"))
        keys = lambda: marts.fact_keys(
            self.deduped, self.account_lookup, self._small("dim_txn_context")
        ).withColumn("posted_month", month)
        measured = lambda rows: marts.fact_measures(
            rows, self.medians, self._small("fx_rate")
        ).withColumn("posted_month", month)
        return self._keep("fact", keys, "posted_month", measured)

    @cached_property
    def fact(self) -> DataFrame:
        return self.fact_by_month.drop("posted_month")

    @cached_property
    def fact_by_customer(self) -> DataFrame:
        """The fact clustered by customer: the statistics of its files and row groups leave a lookup few to read.

        The date and the id behind the customer spread one with a third of all rows over many files.
        """
        return self._keep_clustered("fact_by_customer", self.fact, "customer_id", "posted_date", "transaction_id")

    @cached_property
    def agg_customer_category_month(self) -> DataFrame:
        build = lambda: marts.agg_customer_category_month(
            self.fact,
            self.context(F.col("is_settled"), "counts_towards_spend", "is_card_not_present"),
            self.dim_merchant,
            self.broadcastable("dim_merchant"),
        )
        return self._keep("agg_customer_category_month", build)

    @cached_property
    def agg_dq_scorecard(self) -> DataFrame:
        return self._keep("agg_dq_scorecard", lambda: marts.agg_dq_scorecard(self.fact))

    @cached_property
    def customer_document(self) -> DataFrame:
        """Documents of the newest customer feed, clustered by id for single-key reads."""
        newest = marts.customer_document(self.feeds.customers[-1].rows)
        return self._keep_clustered("customer_document", newest, "customer_id")

    @cached_property
    def customer_months(self) -> DataFrame:
        """The pre-aggregate clustered by customer: the copy a screen reads."""
        keys = ("customer_id", "month_key", "category")
        return self._keep_clustered("customer_months", self.agg_customer_category_month, *keys)

    @cached_property
    def customer_numbers(self) -> DataFrame:
        """`customer_id, number`: nearly dense numbers from 1, for bitmaps. The rows are written, so they hold."""
        ids = self.fact.where(F.col("customer_id").isNotNull()).select("customer_id").distinct()
        rows = self._keep("customer_numbers", lambda: ids.withColumn("at", F.monotonically_increasing_id()))
        parts = (rows.agg(F.max(F.shiftright("at", 33))).first()[0] or 0) + 1
        within = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
        return rows.select("customer_id", (within * parts + F.shiftright("at", 33) + 1).alias("number"))

    @cached_property
    def active_bitmaps(self) -> DataFrame:
        """`posted_date, bucket, bits`: which customers made a settled purchase on each day, one bit each."""
        context = self.context(F.col("is_settled") & (F.col("txn_type") == "purchase"))
        bought = self.fact.join(context, "txn_context_key").select("posted_date", "customer_id").distinct()
        numbered = bought.join(self.customer_numbers, "customer_id")
        daily = numbered.groupBy("posted_date", F.bitmap_bucket_number("number").alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")
        )
        return self._keep("active_bitmaps", lambda: daily)

    @cached_property
    def staged_customers(self) -> DataFrame:
        return self.feeds.customers[-1].rows

    @cached_property
    def staged_accounts(self) -> DataFrame:
        return self.feeds.accounts[-1].rows

    def gold(self) -> dict[str, DataFrame]:
        """The tables the gold layer is made of, by name."""
        return {name: getattr(self, name) for name in GOLD_FLAT} | {GOLD_FACT: self.fact}


class GoldMarts(Warehouse):
    """The marts read back from an exported gold layer, in whatever session comes later.

    Reports, access patterns and metrics run on it unchanged. What only the feeds hold (staged
    rows, surviving copies) is not part of gold and raises.
    """

    def __init__(self, spark: SparkSession, gold: str, published: bool = True) -> None:
        """The version published under `gold`; or the unpublished tables in that very folder."""
        self.spark = spark
        self.row_counts = {}
        gold = current_path(spark, gold) if published else gold
        for name in GOLD_FLAT:
            self.__dict__[name] = spark.read.parquet(f"{gold}/{name}")
        fact = spark.read.parquet(f"{gold}/{GOLD_FACT}")
        self.__dict__["fact"] = fact.drop("posted_month")
        self.months_lie_apart = "posted_month" in fact.columns
        if "posted_month" not in fact.columns:
            fact = fact.withColumn("posted_month", month_key(F.col("posted_date")))
        self.__dict__["fact_by_month"] = fact
        self.__dict__["customer_months"] = self.agg_customer_category_month

    def broadcastable(self, name: str) -> bool:
        """Counted from the file footers the first time it is asked."""
        if name not in self.row_counts:
            self.row_counts[name] = getattr(self, name).count()
        return self.row_counts[name] <= BROADCAST_ROWS

    @property
    def feeds(self) -> Feeds:
        raise LookupError("the gold layer holds no feeds; build a Warehouse from them")
