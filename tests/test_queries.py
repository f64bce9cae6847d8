import pytest
from oracle import connect, rows

from folioforge.plans import registry


@pytest.fixture(scope="module")
def con(small_data):
    return connect(small_data)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_sql(spark, small_data, con, name):
    got = registry.QUERIES[name](spark, small_data).toPandas()
    want = con.execute(registry.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_query_without_sql_runs(spark, small_data, name):
    got = registry.QUERIES[name](spark, small_data).toPandas()
    assert len(got) > 0 and not got.duplicated().any()
    assert got[got.columns[0]].notna().all()


def test_entry_and_names(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(registry.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_plans_stay_in_the_jvm(spark, small_data):
    for name in ("q25_panel_dedup", "q36_registry_lookup", "q37_source_accuracy", "q40_status_fold"):
        plan = registry.QUERIES[name](spark, small_data)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Cartesian" not in plan
