"""Referential and value checks of the loaded star schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _orphans(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, zero_allowed: bool) -> DataFrame:
    """Number of fact rows whose key is missing in the dimension.

    The fact is first reduced to one row per key, so the anti join never moves fact rows.
    """
    keys = fact.filter(F.col(fact_key) > 0) if zero_allowed else fact
    per_key = keys.groupBy(F.col(fact_key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    missing = per_key.join(dim.select(F.col(dim_key).alias("key")), "key", "left_anti")
    return missing.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations"))


def orphan_airlines(star) -> DataFrame:
    return _orphans(star.fact, star.airline, "airline_key", "airline_key", True)


def orphan_origins(star) -> DataFrame:
    return _orphans(star.fact, star.airport, "origin_airport_key", "airport_key", True)


def orphan_destinations(star) -> DataFrame:
    return _orphans(star.fact, star.airport, "destination_airport_key", "airport_key", True)


def orphan_dates(star) -> DataFrame:
    return _orphans(star.fact, star.date, "date_key", "date_key", False)


def orphan_causes(star) -> DataFrame:
    return _orphans(star.fact, star.cause, "delay_cause_key", "delay_cause_key", True)


def fk_time(star) -> DataFrame:
    """The departure hour is optional; a non-null key must exist."""
    present = star.fact.filter(F.col("departure_time_key").isNotNull())
    return _orphans(present, star.time, "departure_time_key", "time_key", False)



# Value rules as SQL conditions of a violating row.
VALUE_RULES = {
    "negative_distances": "distance_miles < 0",
    "extreme_delay_count": "departure_delay_minutes > 1440",
    "cancelled_not_flagged": "reported_departure_delay IS NULL AND NOT is_cancelled",
    "chk_distance": "NOT distance_miles > 0",
    "chk_scheduled_time": "NOT scheduled_elapsed_minutes > 0",
    # A check constraint rejects a row only when its condition is false; null passes.
    "chk_cancellation_reason": (
        "NOT ((NOT is_cancelled AND cancellation_reason IS NULL)"
        " OR (is_cancelled AND cancellation_reason IN ('A', 'B', 'C', 'D')))"
    ),
}


def value_violations(fact: DataFrame, rule: str) -> DataFrame:
    return fact.agg(F.count_if(F.expr(VALUE_RULES[rule])).alias("violations"))


def violating_rows(fact: DataFrame, rule: str) -> DataFrame:
    return fact.filter(VALUE_RULES[rule])


def duplicate_codes(star) -> DataFrame:
    """(dimension, violations): codes that occur more than once."""
    codes = {"airline": "airline_code", "airport": "airport_code", "date": "date", "cause": "cause_code"}
    parts = [
        dim.groupBy(codes[name])
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.lit(name).alias("dimension"), F.count_if(F.col("n") > 1).alias("violations"))
        for name, dim in star.dims().items()
        if name in codes
    ]
    return reduce(DataFrame.unionByName, parts)


ORPHAN_CHECKS = {
    "orphan_airlines": orphan_airlines,
    "orphan_origins": orphan_origins,
    "orphan_destinations": orphan_destinations,
    "orphan_dates": orphan_dates,
    "orphan_causes": orphan_causes,
}
QUALITY_RULES = ["negative_distances", "extreme_delay_count", "cancelled_not_flagged"]


def integrity_report(star) -> DataFrame:
    """(check_name, violations) of all orphan and quality checks, with one total per kind.

    All value rules share one pass over the fact.
    """
    values = star.fact.agg(*[F.count_if(F.expr(VALUE_RULES[r])).alias(r) for r in QUALITY_RULES])
    quality = values.unpivot([], QUALITY_RULES, "check_name", "violations")
    orphans = reduce(
        DataFrame.unionByName,
        [
            check(star).select(F.lit(name).alias("check_name"), "violations")
            for name, check in ORPHAN_CHECKS.items()
        ],
    )
    checks = orphans.withColumn("kind", F.lit("total_orphans")).unionByName(
        quality.withColumn("kind", F.lit("total_quality"))
    )
    # Grouping sets give every check and the total of its kind from the same rows.
    return (
        checks.groupingSets([["kind", "check_name"], ["kind"]], "kind", "check_name")
        .agg(F.sum("violations").alias("violations"))
        .select(F.coalesce("check_name", "kind").alias("check_name"), "violations")
    )
