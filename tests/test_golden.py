"""Fixed values of the star schema, written out here so that a wrong constant in engine and oracle shows."""

from pyspark.sql import functions as F

from tarmac.functions import rules
from tarmac.operators import dims
from tarmac.oracle import mapping

TYPES = {
    "AA": "Major", "AS": "Other", "B6": "Major", "DL": "Major", "EV": "Other", "F9": "Low-Cost", "HA": "Other",
    "MQ": "Major", "NK": "Low-Cost", "OO": "Regional", "UA": "Major", "US": "Other", "VX": "Other", "WN": "Major",
}

# code: (name, category, controllable, weight)
CAUSES = {
    "NO_DELAY": ("On Time", True, "0.00"), "WEATHER": ("Weather", False, "1.20"), "CARRIER": ("Carrier", True, "1.00"),
    "AIR_SYSTEM": ("Air System", False, "0.80"), "LATE_AIRCRAFT": ("Late Aircraft", True, "0.90"),
    "SECURITY": ("Security", False, "1.10"), "CANCELLED": ("Cancellation", False, "2.00"),
    "UNKNOWN": ("Unknown", True, "1.00"),
}


def test_carrier_types(spark):
    rows = spark.createDataFrame(mapping.AIRLINES, "code string, name string")
    assert {r.code: r.type for r in rows.select("code", rules.airline_type(F.col("name")).alias("type")).collect()} == TYPES


def test_time_zones(spark):
    states = {"CA": "Los_Angeles", "WA": "Los_Angeles", "OR": "Los_Angeles", "TX": "Chicago", "IL": "Chicago",
              "NY": "New_York", "FL": "New_York", "CO": "New_York", "AK": "New_York"}
    rows = spark.createDataFrame([(s,) for s in states], "s string")
    assert {r.s: r.z for r in rows.select("s", rules.airport_timezone(F.col("s")).alias("z")).collect()} == {
        s: f"America/{z}" for s, z in states.items()
    }


def test_causes_and_weights(spark):
    found = {
        r.cause_code: (r.cause_category, r.is_controllable, str(r.severity_weight))
        for r in dims.build_delay_causes(spark).collect()
    }
    assert found == CAUSES


def test_hours_of_both_taxonomies(spark):
    standard = {r.hour: (r.hour_category, r.is_business_hours, r.time_period) for r in dims.build_times(spark).collect()}
    seed = {r.hour: (r.hour_category, r.is_business_hours, r.time_period) for r in dims.build_times(spark, "seed").collect()}
    spans = lambda hours, value: [h for h in range(24) if hours[h][0] == value]
    assert spans(standard, "Early Morning") == [5, 6, 7, 8] and spans(seed, "Early Morning") == [5, 6, 7]
    assert spans(standard, "Evening") == [17, 18, 19, 20] and spans(seed, "Evening") == [18, 19, 20, 21]
    assert [h for h in range(24) if standard[h][1]] == list(range(8, 18))
    assert [h for h in range(24) if seed[h][1]] == list(range(6, 18))


def test_an_unreadable_delay_does_not_stop_exploration(spark):
    from flights import flights
    from tarmac.plans import eda

    rows = flights(spark, {"DEPARTURE_DELAY": float("inf")}, {"ARRIVAL_DELAY": 1e300}, {"DEPARTURE_DELAY": 7.0})
    assert [(r.delay, r.arr_delay) for r in eda.explored(rows).orderBy("FLIGHT_NUMBER").collect()] == [(None, 5), (10, None), (7, 5)]


def test_the_pivot_has_every_carrier(spark):
    from flights import flights
    from tarmac.plans import eda

    rows = eda.explored(flights(spark, {"AIRLINE": "QQ", "DEPARTURE_DELAY": 4.0}, {"DEPARTURE_DELAY": 6.0}))
    assert eda.airport_carrier_pivot(rows).collect()[0].asDict() == {"origin": "P0", "AA": 6.0, "QQ": 4.0}
