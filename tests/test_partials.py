"""Monthly states: the views from states equal the views from flights, and only touched months are read."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from flights import flights
from tarmac import warehouse as load
from tarmac.operators import partials, trailing
from tarmac.operators.star import load_star, read_star
from tarmac.plans import views
from tarmac.session import fresh_path

SUMMED = sorted(set(views.VIEWS) - {"v_flight_delay_features"})
LOW = {name: {"min_flights": 1} for name in SUMMED if "min_flights" in views.VIEWS[name].__code__.co_varnames}


def rows(star, name):
    return sorted(map(str, views.VIEWS[name](star, **LOW.get(name, {})).collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def kept(spark, bed):
    """A star of its own, its warehouse, and the months whose states were computed."""
    warehouse = fresh_path(spark, "partials")
    star = load_star(spark, bed.flights, bed.airlines, bed.airports, warehouse)
    return star, warehouse, partials.refresh(spark, star, warehouse, views.VIEWS.values())


@pytest.mark.parametrize("name", SUMMED)
def test_views_from_states_equal_views_from_flights(spark, kept, name):
    star, warehouse, months = kept
    stored = partials.attach(spark, star, warehouse)
    assert stored.partials.stale == [] and len(months) == star.fact.select("year", "month").distinct().count()
    assert rows(stored, name) == rows(star, name) != []
    assert "fact_flights" not in plan(views.VIEWS[name](stored))


def test_nothing_to_refresh_without_a_change(spark, kept):
    star, warehouse, _ = kept
    assert partials.refresh(spark, star, warehouse, views.VIEWS.values()) == []


def test_a_load_costs_only_its_months(spark, bed, tmp_path):
    """Three incremental loads: the second and third touch one month each, of which one is loaded already."""
    source, warehouse = str(tmp_path / "flights"), fresh_path(spark, "warehouse")
    sources = load.Sources(bed.write_csv(bed.airlines, "a"), bed.write_csv(bed.airports, "b"), source)
    codes = [r[0] for r in bed.airports.select("IATA_CODE").orderBy("IATA_CODE").limit(2).collect()]
    airline = bed.airlines.select(F.min("IATA_CODE")).first()[0]

    def deliver(first, months, delay):
        listed = [
            {"MONTH": m, "AIRLINE": airline, "ORIGIN_AIRPORT": codes[0], "DESTINATION_AIRPORT": codes[1],
             "FLIGHT_NUMBER": first + i, "DEPARTURE_DELAY": float(delay + 7 * i)}
            for i, m in enumerate(months)
        ]
        flights(spark, *listed).coalesce(1).write.mode("append").option("header", True).csv(source)

    deliver(0, [1, 1, 2, 3, 5], 3)
    load.load_warehouse(spark, sources, warehouse, incremental=True, partials=True)
    seen = []
    for first, months in ((100, [2, 2]), (200, [12])):
        deliver(first, months, 70)
        before = read_star(spark, warehouse)
        loaded = load.load_warehouse(spark, sources, warehouse, incremental=True).star
        assert loaded.partials.stale == []
        listed = partials.signatures(loaded.fact)
        seen.append([m for m, s in listed.items() if partials.signatures(before.fact).get(m) != s])
        plain = read_star(spark, warehouse)
        # Averages from the first changed month on; the flights of months before it are not read.
        assert loaded.trailing.stale == [] and rows(loaded, "v_flight_delay_features") == rows(plain, "v_flight_delay_features")
        for name in ("v_route_optimization", "v_temporal_patterns", "v_executive_dashboard", "v_severity_classification"):
            assert rows(loaded, name) == rows(plain, name) != []
    assert seen == [[(2015, 2)], [(2015, 12)]]
    runs = loaded.partials.runs
    assert sorted(map(sorted, runs.values())) == [[(2015, 1), (2015, 3), (2015, 5)], [(2015, 2)], [(2015, 12)]]


def test_stale_months_are_read_from_the_flights(spark, bed):
    """Facts of one load with the states of another: no month is valid, and no state of it is used."""
    warehouse = fresh_path(spark, "partials")
    early = bed.flights.filter("MONTH <= 2")
    star = load_star(spark, early, bed.airlines, bed.airports, warehouse)
    partials.refresh(spark, star, warehouse, views.VIEWS.values())
    star = load_star(spark, bed.flights, bed.airlines, bed.airports, warehouse)
    stored = partials.attach(spark, star, warehouse)
    assert len(stored.partials.stale) == len(partials.signatures(star.fact)) and not stored.partials.runs
    assert rows(stored, "v_carrier_performance") == rows(star, "v_carrier_performance")


def test_a_refresh_that_breaks_leaves_the_flights_to_read(spark, bed):
    """A view that fails after others were written: no state counts, and the next refresh does all of it."""
    warehouse = fresh_path(spark, "partials")
    star = load_star(spark, bed.flights.filter("MONTH = 1"), bed.airlines, bed.airports, warehouse)

    def failing(given):
        rows = views.flights_of(given).withColumn("lost", F.expr("CAST(raise_error('lost') AS INT)"))
        return views.summed(given, "failing", rows, ["lost"], lambda m: [m.flights().alias("n")])

    with pytest.raises(Exception, match="lost"):
        partials.refresh(spark, star, warehouse, [views.v_airline_rankings, failing])
    assert partials.attach(spark, star, warehouse).partials.runs == {}
    months = partials.refresh(spark, star, warehouse, [views.v_airline_rankings])
    assert months == sorted(partials.signatures(star.fact))
    stored = partials.attach(spark, star, warehouse)
    assert rows(stored, "v_airline_rankings") == rows(star, "v_airline_rankings") != []


def test_trailing_averages_over_three_loads_equal_one_load(spark, bed):
    """Late days included: the second load brings flights before those of the first."""
    parts = [bed.flights.filter("MONTH BETWEEN 4 AND 6"), bed.flights.filter("MONTH IN (2, 5)"), bed.flights]
    warehouse = fresh_path(spark, "trailing")
    seen = []
    for part in parts:
        star = load_star(spark, part, bed.airlines, bed.airports, warehouse)
        trailing.refresh(spark, star, views.trailed_flights(star), warehouse, rows=5, split_rows=40)
        stored = trailing.attach(spark, star, warehouse, rows=5)
        seen.append(stored.trailing.stale)
        assert "fact_flights" not in plan(stored.trailing.featured(views.trailed_flights(stored), 40))
        found = sorted(map(str, views.v_flight_delay_features(stored, rows=5).collect()))
        assert found == sorted(map(str, views.v_flight_delay_features(star, rows=5).collect())) != []
    assert seen == [[], [], []]


def test_new_months_read_the_tails_before_them(spark, bed):
    """Averages of later months from their flights and stored tails alone equal those of one window."""
    star = load_star(spark, bed.flights, bed.airlines, bed.airports, fresh_path(spark, "trailing"))
    flights = views.trailed_flights(star)
    months = sorted(partials.signatures(star.fact))
    early, late = flights.filter(partials.of_months(months[:20])), flights.filter(partials.of_months(months[20:]))
    for split_rows in (10**9, 25):
        found = trailing.with_averages(late, 7, split_rows, trailing.tails(early, 7).transform(last_of_groups))
        whole = trailing.with_averages(flights, 7, 10**9).filter(partials.of_months(months[20:]))
        columns = ["flight_key", "departure_delay_minutes", *trailing.PEERS]
        assert sorted(map(str, found.select(columns).collect())) == sorted(map(str, whole.select(columns).collect())) != []


def last_of_groups(tails):
    backwards = Window.partitionBy("peer", *trailing.KEYS).orderBy(*[F.desc(c) for c in trailing.ORDER])
    return tails.withColumn("r", F.row_number().over(backwards)).filter("r <= 7").drop("r")
