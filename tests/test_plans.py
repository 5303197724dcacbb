"""Physical plan checks: no single-partition exchange under the windows, no
Python evaluation in feature plans, pruned scans, bounded top-k."""

from paths import SF001
from tidemark.operators import candles as C
from tidemark.plans import dashboard as D
from tidemark.plans import registry as R
from tidemark.plans.features import build_features
from tidemark.sources.tables import ticks


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_plan_has_no_single_partition_or_python(spark):
    plan = _plan(build_features(C.resample(ticks(spark, SF001))))
    assert "SinglePartition" not in plan
    for node in ("ArrowEvalPython", "BatchEvalPython", "FlatMapGroupsInPandas",
                 "MapInPandas"):
        assert node not in plan


def test_scan_reads_only_needed_columns(spark):
    plan = _plan(C.resample(ticks(spark, SF001)))
    read = plan[plan.index("ReadSchema"):].split("\n")[0]
    assert "props" not in read and "user_id" not in read


def test_tail_uses_group_limit(spark):
    plan = _plan(D.last_rows(C.resample(ticks(spark, SF001)), 5))
    assert "WindowGroupLimit" in plan


def test_every_query_has_docstring_and_sql_or_reason():
    rows_only = set(R.QUERIES) - set(R.ORACLE)
    assert rows_only <= {"linreg_predict", "predictions", "model_metrics"}
    for name, fn in R.QUERIES.items():
        assert fn.__doc__, name
