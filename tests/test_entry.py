"""Driver contract: entry() and every registered query on sf0.001."""

import pytest

import __spark_entry__ as E

SF001 = "/root/testdata/sf0.001"


def test_entry_flagship(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["page_id", "pos", "url", "product", "category", "issue", "depth", "solution"]


def test_every_key_has_oracle_or_is_known_rows_only():
    rows_only = set(E.queries()) - set(E.oracle_sql()) - set(E.LLM_QUERIES)
    assert rows_only == {"extract_cards", "job_flow", "relevance_model", "vector_topk_ann"}


@pytest.mark.parametrize("key", sorted(set(E.queries()) - set(E.LLM_QUERIES)))
def test_query_runs_with_stable_schema(spark, key):
    q = E.queries()[key]
    a = q(spark, SF001)
    n = a.count()
    assert n >= 0
    assert q(spark, SF001).schema == a.schema
