from collections import Counter

import pytest

from starweave.llm import queries
from tests.compare import assert_same
from tests.conftest import DATA


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, duck, name):
    assert_same(queries.QUERIES[name](spark, DATA), duck, queries.ORACLES[name])


@pytest.mark.parametrize(("name", "columns"), [("p2_found", "hip_source_id bigint, gaia_source_id bigint"), ("p6_ids", "doc_id bigint, ids array<int>"), ("p7_found", "item_id bigint, doc_id bigint"), ("p8_found", "doc_id bigint")])
def test_columns_and_no_repeats(spark, name, columns):
    df = queries.QUERIES[name](spark, DATA)
    assert ", ".join(f"{c} {k}" for c, k in df.dtypes) == columns
    rows = [str(r) for r in df.collect()]
    assert len(rows) == len(set(rows)) > 0


def test_counted_queries_count_the_found_rows(spark):
    """The tables of counts against counts of the rows they are made of."""
    q = {n: [r.asDict() for r in queries.QUERIES[n](spark, DATA).collect()] for n in ("p2_found", "p2_confidence", "p7_found", "p7_leaks", "p8_found", "p8_kinds")}
    sure = sum(r["n_pairs"] for r in q["p2_confidence"] if r["tenth"] >= 5)
    assert sure == len(q["p2_found"]) and {r["tenth"] for r in q["p2_confidence"]} <= set(range(10))
    by_tenth = sorted((r["tenth"], r["mean_cosine"]) for r in q["p2_confidence"])
    assert by_tenth[-1][1] > by_tenth[0][1]
    docs = Counter(r["item_id"] for r in q["p7_found"])
    assert {r["item_id"]: r["n_docs"] for r in q["p7_leaks"]} == docs
    assert all(r["longest"] >= 30 and r["n_with_answer"] <= r["n_docs"] for r in q["p7_leaks"])
    assert sum(r["n_docs"] for r in q["p8_kinds"]) == len(q["p8_found"]) and all(r["n_mostly_residue"] <= r["n_docs"] for r in q["p8_kinds"])
