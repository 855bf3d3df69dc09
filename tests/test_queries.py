import pytest
from conftest import rows_of, rows_of_sql

from tidemark import catalog
from tidemark.plans import registry


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_sql(name, spark, duck, sample):
    assert rows_of(catalog.QUERIES[name](spark, sample)) == rows_of_sql(duck, catalog.SQL[name])


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_query_without_sql_has_rows(name, spark, sample):
    assert catalog.QUERIES[name](spark, sample).count() > 0


def test_history_plans_have_no_nested_loop(spark, sample):
    for name in ("drug_safety_asof", "sponsor_history", "sponsor_starts_24m", "nearest_asof"):
        plan = catalog.QUERIES[name](spark, sample)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_what_is_known_of_trials_is_not_sorted_before_its_shuffle(spark):
    known = registry.snapshot(spark, "/root/testdata/sf0.001")
    plan = known.attributes(known.studies.select("nct_id"))._jdf.queryExecution().executedPlan().toString().splitlines()
    for k, line in enumerate(plan):
        if "SortAggregate" in line and "partial_" in line:
            assert "Sort [" in plan[k + 1] and "Exchange hashpartitioning" in plan[k + 2]
