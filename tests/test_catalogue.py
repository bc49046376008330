import pytest
from conftest import cells

from skygrid import catalogue


def test_queries_have_sql():
    assert set(catalogue.QUERIES) == set(catalogue.ORACLES)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_agrees_with_sql(spark, sf_dir, duck, name):
    found = cells(catalogue.QUERIES[name](spark, sf_dir).toPandas())
    assert found == cells(duck.sql(catalogue.ORACLES[name]).df()) and found[1]


def test_entry_runs(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).limit(1).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_selected_stations_reach_the_scan(spark, sf_dir):
    found = catalogue.hourly_interpolation(spark, sf_dir)
    plan = found.where("station_id = '3'")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double>" in plan


@pytest.mark.parametrize("threshold", [500, 666, 750, 800, 900])
def test_validity_filters_gather_no_hours(spark, sf_dir, threshold):
    """Records are aggregated by station and time (partial and final), hours are not."""
    found = catalogue.QUERIES[f"valid_fraction_filter_{threshold}"](spark, sf_dir)
    assert found._jdf.queryExecution().executedPlan().toString().count("Aggregate(") == 2
