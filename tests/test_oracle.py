"""Every registered query against its DuckDB oracle, whole results."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_DIR
from tests.oracle_compare import compare, connect

# Queries of the optional package have tests of their own.
OWN = {*entry._BUILDERS, *entry._INGEST, *entry._OTHER_DELIVERIES}
QUERIES = {name: query for name, query in entry.queries().items() if name in OWN}
ORACLE = {name: sql for name, sql in entry.oracle_sql().items() if name in OWN}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_oracle(spark, con, name):
    rows, problem = compare(QUERIES[name](spark, SF_DIR), con, ORACLE[name])
    assert not problem
    assert rows > 0


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_runs_are_identical(spark, w):
    from ledgerloom.plans import patterns, reports

    for build in (reports.fx_exposure, reports.headline, patterns.top_merchants_per_segment):
        assert build(w).collect() == build(w).collect()


def test_known_counts_of_the_feed_mapping(w):
    """Counts taken independently when the mapping was written down."""
    from pyspark.sql import functions as F

    from ledgerloom.operators.rules import FLAGS

    assert (w.staged.count(), w.deduped.count()) == (6000, 4599)
    failed = w.agg_dq_scorecard.groupBy("defect_code").agg(F.sum("rows_failed").alias("n"))
    assert {r["defect_code"]: r["n"] for r in failed.collect()} == dict(
        zip(FLAGS, (6, 1161, 9, 5, 5, 27, 6), strict=True)
    )
    assert w.dim_txn_context.count() == 78
    assert w.deduped.where("status = 'settled'").count() == 3160
    assert [s.rows.count() for s in w.feeds.customers] == [148, 148, 150]
    history = w.customer_history
    assert history.where("valid_to is not null").count() == 13 + 2
    assert history.where("valid_from > '1996-01-01'").count() == 13 + 2 + 2
    assert w.dim_account.where("is_current and dq_open_with_closed_date").count() == 3
    assert w.account_history.where("valid_to is not null").count() == 11 + 2 + 9
