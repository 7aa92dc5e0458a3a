"""Plan checks: pruned scans, no Python in the batch path, one exchange per input."""

from conftest import SF_SMALL
from stockcast.plans.catalog import queries


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _explain(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_snapshot_has_no_python_and_prunes_columns(spark):
    from stockcast.sources import tables

    text = _explain(queries()["project_snapshot"](spark, SF_SMALL))
    assert "Python" not in text and "ArrowEval" not in text
    # lineitem is read with the six columns the lines view needs, not all of them
    # (the fold checkpoints its chunked rows, so look at the view's own plan)
    text = _explain(tables.lines(spark, SF_SMALL))
    scan = [l for l in text.splitlines() if "ReadSchema" in l and "l_orderkey" in l][0]
    assert "l_extendedprice" not in scan and "l_shipdate" not in scan


def test_replay_has_no_python(spark):
    text = _explain(queries()["project_on_order"](spark, SF_SMALL))
    assert "Python" not in text


def test_topic_kinds_need_no_join(spark):
    text = _explain(queries()["categorize_topics"](spark, SF_SMALL))
    assert "Join" not in text
