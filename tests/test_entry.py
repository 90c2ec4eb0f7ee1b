"""Driver contract and plan properties of the registered queries (sf0.001)."""

import __spark_entry__ as entry
from formwork.plans.catalog import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and "instanceid" in df.columns


def test_every_query_has_an_oracle_and_runs(spark):
    qs, sql = QUERIES, ORACLE
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert qs.keys() <= entry.queries().keys() and set(sql) <= set(qs)
    missing = set(qs) - set(sql)
    assert missing == set(), f"queries without oracle: {missing}"
    for name, fn in qs.items():
        df = fn(spark, SF)
        df.limit(1).collect()
        assert len(set(df.columns)) == len(df.columns), name


def test_no_python_in_row_paths(spark):
    for name, fn in QUERIES.items():
        plan = fn(spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "EvalPython" not in plan and "PythonUDF" not in plan, name


def test_cutoff_is_pushed_to_the_scan(spark):
    plan = entry.queries()["updated_since"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts," in plan


def test_aggregates_combine_before_shuffling(spark):
    """Skew guard: every aggregate has a map-side partial step, so a key holding a
    large share of the rows is combined before the exchange."""
    for name in ("latest_version", "shared_arcs", "attach_geometry", "update_outbox", "import_summary", "one_hot"):
        plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        if "HashAggregate" in plan or "SortAggregate" in plan:
            assert "partial_" in plan, name
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_lookup_joins_salt_null_keys(spark):
    """Null join keys (id-less create rows, units without id) are spread by a content
    hash instead of landing in one partition."""
    for name in ("update_outbox", "import_summary", "attach_geometry"):
        plan = entry.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        assert "pmod(xxhash64(" in plan and "__lk_real" in plan, name
