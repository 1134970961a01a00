"""Every query with SQL agrees with DuckDB; the others give rows. Plans hold no all-pairs joins."""

import pytest

from millrace.plans.catalogue import ORACLES, QUERIES
from tools.compare import difference, duck

@pytest.fixture(scope="module")
def con(small):
    return duck(small)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_agrees_with_sql(spark, small, con, name):
    assert difference(QUERIES[name](spark, small), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_gives_rows(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0


def test_the_stop_list_is_the_whole_english_one(spark):
    from millrace.operators.textfeatures import english_stop_words
    from millrace.plans.learning import STOP_WORDS

    assert STOP_WORDS == english_stop_words()


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


STREAMED = {"stream_parse", "stream_first", "stream_low_confidence", "stream_summary", "stream_rate", "stream_monitor",
            "feedback_join_stream", "stream_psi"}


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES and n not in STREAMED])
def test_plan_has_no_all_pairs_join(spark, small, name):
    plan = QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_entry_and_contract(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
