"""Every core query against its SQL on the smallest tables."""

import pytest

from starweave.plans import audit_queries, match_queries, problem_queries, review_queries
from tests.compare import assert_same
from tests.conftest import DATA

MODULES = (match_queries, audit_queries, review_queries, problem_queries)
QUERIES = {n: f for m in MODULES for n, f in m.QUERIES.items()}
ORACLES = {n: s for m in MODULES for n, s in m.ORACLES.items()}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert_same(QUERIES[name](spark, DATA), duck, ORACLES[name])


def test_decisions_are_mixed(spark):
    kinds = {r.decision for r in match_queries.decision_counts(spark, DATA).collect()}
    assert {"official_confirmed", "manual_review"} <= kinds


def test_entry_has_rows(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
