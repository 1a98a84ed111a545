import pytest

from tarmac import warehouse as load
from tarmac.operators.star import read_star
from tarmac.plans import views
from tarmac.session import fresh_path


@pytest.fixture(scope="module")
def sources(bed):
    return load.Sources(
        bed.write_csv(bed.airlines, "airlines-csv"),
        bed.write_csv(bed.airports, "airports-csv", ["NULL", "n/a"]),
        bed.flights_csv,
    )


def violations(report):
    return {r.check_name: r.violations for r in report.integrity.collect()}


def test_full_load_twice_gives_the_same_star(spark, bed, star, sources):
    warehouse = fresh_path(spark, "warehouse")
    first = load.load_warehouse(spark, sources, warehouse)
    count = first.star.fact.count()
    second = load.load_warehouse(spark, sources, warehouse)
    assert count == second.star.fact.count() == star.fact.count()
    assert second.star.airline.count() == star.airline.count()
    assert violations(second)["total_orphans"] == 0
    assert second.rejected.count() > 0
    stored = read_star(spark, warehouse)
    columns = star.fact.columns
    assert stored.fact.select(columns).exceptAll(star.fact.select(columns)).isEmpty()


def test_incremental_load_equals_full_load(spark, star, sources):
    warehouse = fresh_path(spark, "warehouse")
    report = load.load_warehouse(spark, sources, warehouse, incremental=True)
    again = load.load_warehouse(spark, sources, warehouse, incremental=True)
    assert sum(b["input_rows"] for b in report.batches) > 0 and again.batches == []
    columns = star.fact.columns
    assert again.star.fact.count() == star.fact.count()
    assert again.star.fact.select(columns).exceptAll(star.fact.select(columns)).isEmpty()


def test_views_can_be_queried_by_name(spark, sources):
    load.load_warehouse(spark, sources, fresh_path(spark, "warehouse"), sample_rows=500)
    assert spark.table("fact_flights").count() <= 500
    found = spark.sql("SELECT airline_code, sum(total_flights) n FROM v_carrier_performance GROUP BY 1")
    assert found.count() > 0


def test_missing_source_is_an_error(spark, sources):
    from dataclasses import replace

    with pytest.raises(load.UnreadableSource, match="flights"):
        load.load_warehouse(spark, replace(sources, flights="/nowhere"), fresh_path(spark, "warehouse"))


def test_the_other_layout_is_refused_before_any_write(spark, star, sources):
    full, incremental = fresh_path(spark, "warehouse"), fresh_path(spark, "warehouse")
    load.load_warehouse(spark, sources, full)
    load.load_warehouse(spark, sources, incremental, incremental=True)
    with pytest.raises(load.LayoutConflict):
        load.load_warehouse(spark, sources, full, incremental=True)
    with pytest.raises(load.LayoutConflict):
        load.load_warehouse(spark, sources, incremental)
    assert read_star(spark, full).fact.count() == read_star(spark, incremental).fact.count() == star.fact.count()


def test_the_calendar_covers_every_flight(star):
    """The mapped flights span two years; views that join the date lose none of them."""
    assert [r.year for r in star.date.select("year").distinct().orderBy("year").collect()] == [2015, 2016]
    known = star.fact.filter("airline_key > 0").count()
    for name in ("v_carrier_performance", "v_airline_rankings", "v_airline_monthly_summary"):
        found = views.VIEWS[name](star, **({"min_flights": 1} if name == "v_airline_rankings" else {}))
        assert found.agg({"total_flights": "sum"}).first()[0] == known, name
