import pytest
from pyspark.sql import functions as F

from tarmac.functions import clocks, kpi, rules
from tarmac.operators import dims
from tarmac.oracle.mapping import AIRLINES


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "clock, hour",
    [
        (None, 0), ("0029", 0), ("0030", 1), ("1430", 15), ("2330", 0), ("2359", 0), ("2400", 0),
        ("9999", 3), ("abc", 0), ("905", 9), ("0", 0), ("12.0", 0), ("", 0), ("12345", 0),
    ],
)
def test_nearest_hour(spark, clock, hour):
    assert one(spark, clocks.nearest_hour(clocks.hhmm_number(F.lit(clock).cast("string")))) == hour


@pytest.mark.parametrize(
    "clock, seconds, text",
    [
        ("2400", 0, "00:00:00"), ("0000", 0, "00:00:00"), ("0005", 300, "00:05:00"),
        ("1430", 52200, "14:30:00"), (None, None, None), ("2575", None, None), ("1260", None, None),
    ],
)
def test_clock_seconds_and_text(spark, clock, seconds, text):
    parsed = clocks.seconds_of_day(clocks.hhmm_number(F.lit(clock).cast("string")))
    assert one(spark, parsed) == seconds
    assert one(spark, clocks.clock_text(parsed)) == text


def test_clock_timestamp_moves_2400_to_the_next_day(spark):
    stamp = clocks.clock_timestamp(F.lit("2015-01-31").cast("date"), F.lit(2400))
    assert str(one(spark, stamp)) == "2015-02-01 00:00:00"


@pytest.mark.parametrize(
    "parts, expected",
    [
        ((2015, 2, 28), "2015-02-28"), ((2015, 2, 29), None), ((2016, 2, 29), "2016-02-29"), ((2015, 13, 1), None),
        ((2015, 0, 1), None), ((2015, 4, 31), None), ((2015, 12, 31), "2015-12-31"), ((2015, 1, 0), None),
        ((2015, 1, 32), None), ((None, 1, 1), None),
    ],
)
def test_calendar_date(spark, parts, expected):
    found = one(spark, clocks.calendar_date(*[F.lit(p).cast("int") for p in parts]))
    assert (str(found) if found else None) == expected


def test_airline_types(spark):
    names = spark.createDataFrame(AIRLINES, "code string, name string")
    types = {r.code: r.t for r in names.select("code", rules.airline_type(F.col("name")).alias("t")).collect()}
    assert {c for c, t in types.items() if t == "Major"} == {"AA", "UA", "DL", "WN", "B6", "MQ"}
    assert {c for c, t in types.items() if t == "Regional"} == {"OO"}
    assert {c for c, t in types.items() if t == "Low-Cost"} == {"F9", "NK"}
    assert {c for c, t in types.items() if t == "Other"} == {"US", "AS", "EV", "HA", "VX"}


def test_timezones(spark):
    states = ["CA", "WA", "OR", "TX", "IL", "NY", "FL", "CO", None]
    zones = [one(spark, rules.airport_timezone(F.lit(s).cast("string"))) for s in states]
    assert zones == ["America/Los_Angeles"] * 3 + ["America/Chicago"] * 2 + ["America/New_York"] * 4


@pytest.mark.parametrize(
    "n, size", [(0, "Small"), (999, "Small"), (1000, "Medium"), (10000, "Large"), (50000, "Large"), (50001, "Hub")]
)
def test_airport_size(spark, n, size):
    assert one(spark, rules.airport_size(F.lit(n))) == size


def test_calendar_of_2015(spark):
    dates = dims.build_dates(spark, "2015-01-01", "2015-12-31")
    row = dates.agg(
        F.count(F.lit(1)).alias("days"),
        F.count_if("is_weekend").alias("weekend"),
        F.count_if("is_holiday").alias("holidays"),
        F.count_if("is_business_day").alias("business"),
        *[F.count_if(F.col("season") == s).alias(s) for s in ("Winter", "Spring", "Summer", "Fall")],
    ).first()
    assert tuple(row) == (365, 104, 6, 256, 90, 92, 92, 91)
    first = dates.orderBy("date").first()
    assert (first.date_key, first.day_name, first.month_name, first.day_of_week) == (20150101, "Thursday", "January", 4)


def test_holidays_of_other_years(spark):
    years = spark.createDataFrame([(2016,), (2021,), (2016,)], "year int")
    dates = dims.calendar_of_years(years)
    assert dates.count() == 366 + 365
    found = [str(r.date) for r in dates.filter("is_holiday").orderBy("date").collect()]
    assert found == [
        "2016-01-01", "2016-05-30", "2016-07-04", "2016-09-05", "2016-11-24", "2016-12-25",
        "2021-01-01", "2021-05-31", "2021-07-04", "2021-09-06", "2021-11-25", "2021-12-25",
    ]
    listed = dims.build_dates(spark, "2016-03-01", "2016-03-03", ["2016-03-02"])
    assert [r.is_holiday for r in listed.orderBy("date").collect()] == [False, True, False]


def test_hours(spark):
    hours = {r.hour: r for r in dims.build_times(spark).collect()}
    assert len(hours) == 24 and sum(r.is_business_hours for r in hours.values()) == 10
    assert (hours[5].hour_category, hours[5].time_period) == ("Early Morning", "Overnight")
    seed = {r.hour: r for r in dims.build_times(spark, "seed").collect()}
    assert (seed[5].hour_category, seed[5].time_period, seed[7].time_period) == ("Early Morning", "Early", "Morning")
    assert sum(r.is_business_hours for r in seed.values()) == 12
    with pytest.raises(ValueError):
        dims.build_times(spark, "other")


def test_delay_causes(spark):
    causes = {r.cause_code: r for r in dims.build_delay_causes(spark).collect()}
    assert len(causes) == 8
    assert (causes["NO_DELAY"].cause_name, str(causes["NO_DELAY"].severity_weight)) == ("No Delay", "0.00")
    assert not causes["CANCELLED"].is_controllable


def test_unknown_member(spark):
    dim = dims.with_unknown_member(dims.build_delay_causes(spark), "delay_cause_key")
    unknown = dim.filter("delay_cause_key = 0").first()
    assert unknown.cause_code == "Unknown" and unknown.severity_weight is None and dim.count() == 9


def test_repeated_source_rows_give_one_member(spark):
    rows = spark.createDataFrame([(" aa", "American"), ("AA ", "American")], "IATA_CODE string, AIRLINE string")
    assert [r.airline_code for r in dims.build_airlines(rows).collect()] == ["AA"]


def test_percent_rounds_ties_up_and_survives_empty_groups(spark):
    def share(a, b, digits):
        return one(spark, kpi.percent(F.lit(a).cast("bigint"), F.lit(b).cast("bigint"), digits))

    assert share(1, 800, 2) == 0.13  # 0.125
    assert share(2, 3, 2) == 66.67
    assert share(0, 0, 2) is None


def test_rounded_ratio_and_half_up_are_symmetric(spark):
    def ratio(total, n):
        return one(spark, kpi.rounded_ratio(F.lit(total).cast("bigint"), F.lit(n).cast("bigint"), 1))

    assert ratio(5, 20) == 0.3 and ratio(-5, 20) == -0.3 and ratio(1, 0) is None
    assert one(spark, kpi.half_up(F.lit(-2.5), 0)) == -3.0 and one(spark, kpi.half_up(F.lit(2.5), 0)) == 3.0


def test_population_deviation(spark):
    values = spark.createDataFrame([(1,), (2,), (4,), (None,)], "v int")
    assert values.agg(kpi.stddev_population(F.col("v"))).first()[0] == pytest.approx(1.247219128924647)
    assert values.filter("v is null").agg(kpi.stddev_population(F.col("v"))).first()[0] is None
