import pytest
from pyspark.sql import functions as F

from flights import flights
from tarmac.functions import rules
from tarmac.operators import facts, quality
from tarmac.plans import views
from tarmac.sources.files import MissingColumns


def build(spark, star, *overrides):
    built = facts.build_fact(flights(spark, *overrides), star)
    return {r.flight_number: r for r in built.collect()}


def test_codes_are_normalised(spark, star):
    rows = build(spark, star, {"AIRLINE": " aa ", "ORIGIN_AIRPORT": "p0", "DESTINATION_AIRPORT": " P1"}, {})
    assert rows[0].airline_key == rows[1].airline_key > 0
    assert rows[0].origin_airport_key == rows[1].origin_airport_key


def test_unmapped_airline_is_kept_and_unmapped_airport_dropped(spark, star):
    rows = build(
        spark, star, {"AIRLINE": "Q1"}, {"ORIGIN_AIRPORT": "10397"}, {"DESTINATION_AIRPORT": "XXX"}
    )
    assert list(rows) == [0] and rows[0].airline_key == 0


def test_missing_critical_fields_and_impossible_dates(spark, star):
    bad = [{"AIRLINE": None}, {"DAY": None}, {"MONTH": 2, "DAY": 30}, {"ORIGIN_AIRPORT": None, "YEAR": None}]
    assert build(spark, star, *bad) == {}
    listed = {r.FLIGHT_NUMBER: r.missing_columns for r in quality.bad_rows(flights(spark, *bad)).collect()}
    assert listed == {0: "AIRLINE", 1: "DAY", 3: "YEAR,ORIGIN_AIRPORT"}


def test_fact_and_rejected_rows_cover_the_source(bed, star):
    rejected = quality.rejected_rows(bed.flights, star.airport)
    assert rejected.count() + star.fact.count() == bed.flights.count()
    kinds = {r.reason.split(" ")[0] for r in rejected.select("reason").distinct().collect()}
    assert {"missing", "unknown"} <= kinds


def test_missing_measures_become_zero(spark, star):
    names = ["DEPARTURE_DELAY", "ARRIVAL_DELAY", "SCHEDULED_TIME", "DISTANCE", "TAIL_NUMBER", "CANCELLED", "DIVERTED"]
    row = build(spark, star, {n: None for n in names})[0]
    assert (row.departure_delay_minutes, row.arrival_delay_minutes, row.distance_miles) == (0, 0, 0)
    assert row.tail_number == "" and not row.is_cancelled and not row.is_diverted
    assert row.reported_departure_delay is None


@pytest.mark.parametrize(
    "delay, severity",
    [
        (-3, "On Time/Early"), (0, "On Time/Early"), (1, "Minor Delay"), (15, "Minor Delay"), (16, "Moderate Delay"),
        (60, "Moderate Delay"), (61, "Significant Delay"), (180, "Significant Delay"), (181, "Severe Delay"),
    ],
)
def test_severity(spark, delay, severity):
    flown, cancelled = (rules.delay_severity(F.lit(c), F.lit(delay)) for c in (False, True))
    assert tuple(spark.range(1).select(flown, cancelled).first()) == (severity, "Cancelled")


def test_primary_cause(spark, star):
    codes = {r.delay_cause_key: r.cause_code for r in star.cause.collect()}
    rows = build(
        spark,
        star,
        {"DEPARTURE_DELAY": 0.0, "WEATHER_DELAY": 5.0},
        {"DEPARTURE_DELAY": 30.0},
        {"DEPARTURE_DELAY": 30.0, "AIR_SYSTEM_DELAY": 30.0, "AIRLINE_DELAY": 30.0},
        {"DEPARTURE_DELAY": 30.0, "LATE_AIRCRAFT_DELAY": 10.0, "WEATHER_DELAY": 20.0},
        {"DEPARTURE_DELAY": 30.0, "SECURITY_DELAY": 1.0},
        {"DEPARTURE_DELAY": 30.0, "AIRLINE_DELAY": 2.0},
    )
    found = [codes[rows[i].delay_cause_key] for i in range(6)]
    assert found == ["NO_DELAY", "UNKNOWN", "AIR_SYSTEM", "WEATHER", "SECURITY", "CARRIER"]
    assert rows[2].total_delay_minutes == 60


def test_cause_missing_in_the_dimension_falls_back_to_unknown(spark, star):
    class Without:
        airline, airport, time = star.airline, star.airport, star.time
        cause = star.cause.filter("cause_code <> 'WEATHER'")

    unknown = star.cause.filter("cause_code = 'UNKNOWN'").first().delay_cause_key
    row = facts.build_fact(flights(spark, {"DEPARTURE_DELAY": 9.0, "WEATHER_DELAY": 9.0}), Without).first()
    assert row.delay_cause_key == unknown


def test_delay_metrics_and_flags(spark):
    raw = flights(spark, {"DEPARTURE_DELAY": 61.0, "ARRIVAL_DELAY": 40.0, "DISTANCE": 1501, "MONTH": 7, "DAY": 4}, {})
    placed = facts.add_date_key(facts.clean(raw)).withColumns({**facts.delay_metrics(), **facts.business_flags()})
    first, second = placed.orderBy("flight_number").collect()
    assert (first.delay_indicator, first.significant_delay, first.severe_delay, first.delay_recovery) == (1, 1, 1, 21)
    assert first.is_weekend_flight and first.is_holiday_period and first.is_long_haul
    assert (second.severe_delay, second.is_weekend_flight, second.is_long_haul) == (0, False, False)


def test_missing_source_column_is_an_error(spark):
    with pytest.raises(MissingColumns):
        facts.clean(flights(spark, {}).drop("AIRLINE"))


def test_cancelled_group_has_null_rates(spark, star):
    from dataclasses import replace

    fact = facts.build_fact(flights(spark, {"CANCELLED": 1}, {"CANCELLED": 1}), star)
    row = views.v_carrier_performance(replace(star, fact=fact)).first()
    assert row.total_flights == row.cancelled_flights == 2 and row.ontime_departure_rate is None
    assert row.cancellation_rate == 100.0 and row.avg_departure_delay is None


def test_view_properties(star):
    carriers = views.v_carrier_performance(star)
    assert carriers.filter("completed_flights + cancelled_flights <> total_flights").isEmpty()
    severity = views.v_severity_classification(star)
    shares = severity.groupBy("airline_code", "year", "quarter").agg(
        F.sum("pct_of_airline_flights").alias("share"), F.count(F.lit(1)).alias("n")
    )
    assert shares.filter("abs(share - 100) > 0.005 * n").isEmpty()
    trends = views.v_historical_delay_trends(star).orderBy("date").first()
    assert trends.delay_7day_moving_avg == pytest.approx(trends.daily_avg_delay, abs=1e-6)
    known = star.fact.join(star.airline, "airline_key", "left_semi").count()
    assert views.v_flight_delay_features(star).count() == known
