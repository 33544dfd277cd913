import pytest

from concordat.plans import catalogue, registry

from .comparing import oracle, rows


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_sql(spark, sf, name):
    got = registry.QUERIES[name](spark, sf).toArrow()
    assert len(set(got.column_names)) == len(got.column_names)
    if name in registry.SQL:
        assert rows(got) == rows(oracle(registry.SQL[name], sf))


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_plans_push_down(spark, sf):
    plan = catalogue.QUERIES["closed_filter"](spark, sf)._jdf.queryExecution().toString()
    assert "PushedFilters" in plan and "o_totalprice" not in plan.split("ReadSchema")[-1]
    top = catalogue.QUERIES["dedupe_last_wins"](spark, sf)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in top
