"""Profiling and validation of sources, dimensions and facts. One pass over the data each."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tarmac.functions import clocks, kpi
from tarmac.sources.files import missing_columns, read_text_csv
from tarmac.sources.schemas import CRITICAL


def long_form(totals: DataFrame, label: str = "metric", value: str = "value") -> DataFrame:
    """One row of totals as (metric, value) rows."""
    names = totals.columns
    return totals.unpivot([], names, label, value)


def required_columns_report(sources: dict[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """For every source the required columns it lacks and its row count."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("source"),
            "row_count",
            F.lit(",".join(missing_columns(df, required))).alias("missing_columns"),
        )
        for name, (df, required) in sources.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def check_sources(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """(name, ok): the source exists, is readable and has at least one row."""

    def ok(path: str) -> bool:
        try:
            return not read_text_csv(spark, path).isEmpty()
        except AnalysisException:
            return False

    rows = [(name, ok(path)) for name, path in paths.items()]
    return spark.createDataFrame(rows, "name string, ok boolean")


def source_summary(airlines: DataFrame, airports: DataFrame, flights: DataFrame) -> DataFrame:
    """(source, metric, value) of the three sources, over all rows."""

    def part(name: str, df: DataFrame, **metrics) -> DataFrame:
        totals = df.agg(
            F.count(F.lit(1)).alias("record_count"),
            F.lit(len(df.columns)).cast("bigint").alias("column_count"),
            *[c.cast("bigint").alias(n) for n, c in metrics.items()],
        )
        return long_form(totals).withColumn("source", F.lit(name))

    return reduce(
        DataFrame.unionByName,
        [
            part("airlines", airlines, unique_airlines=F.countDistinct("IATA_CODE")),
            part(
                "airports",
                airports,
                unique_airports=F.countDistinct("IATA_CODE"),
                countries=F.countDistinct("COUNTRY"),
            ),
            part(
                "flights",
                flights,
                unique_airlines=F.countDistinct("AIRLINE"),
                min_year=F.min("YEAR"),
                max_year=F.max("YEAR"),
            ),
        ],
    )


def null_profile(df: DataFrame) -> DataFrame:
    """(column_name, data_type, null_count, row_count), one aggregation over the frame."""
    nulls = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns],
    )
    types = F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair])
    return nulls.unpivot(["row_count"], df.columns, "column_name", "null_count").select(
        "column_name", types[F.col("column_name")].alias("data_type"), "null_count", "row_count"
    )


def profile_columns(df: DataFrame) -> DataFrame:
    return null_profile(df).select(
        "column_name",
        "data_type",
        "null_count",
        kpi.percent(F.col("null_count"), F.col("row_count"), 4).alias("null_pct"),
    )


def fill_factor(df: DataFrame) -> DataFrame:
    filled = F.col("row_count") - F.col("null_count")
    return (
        null_profile(df)
        .select(
            F.col("column_name").alias("variable"),
            F.col("null_count").alias("missing_values"),
            kpi.percent(filled, F.col("row_count"), 4).alias("filling_factor_pct"),
        )
        .orderBy("filling_factor_pct", "variable")
    )


def _member_summary(name: str, dim: DataFrame, extra: dict) -> DataFrame:
    totals = dim.agg(
        F.count(F.lit(1)).alias("record_count"),
        F.lit(len(dim.columns)).cast("bigint").alias("column_count"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in dim.columns],
        *[c.cast("bigint").alias(n) for n, c in extra.items()],
    )
    repeated = dim.groupBy(*dim.columns).agg(F.count(F.lit(1)).alias("n"))
    duplicates = repeated.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_count"))
    return (
        long_form(totals)
        .unionByName(long_form(duplicates))
        .select(F.lit(name).alias("dimension"), "metric", "value")
    )


def dim_summary(star) -> DataFrame:
    """(dimension, metric, value): counts, nulls and duplicates of every dimension, and a few extras."""
    extras = {
        "airline": {"unique_types": F.countDistinct("airline_type")},
        "airport": {"unique_countries": F.countDistinct("country"), "unique_states": F.countDistinct("state")},
        "date": {
            "min_date_key": F.min("date_key"),
            "max_date_key": F.max("date_key"),
            "weekend_count": F.count_if("is_weekend"),
            "holiday_count": F.count_if("is_holiday"),
        },
        "time": {},
        "cause": {},
    }
    parts = [_member_summary(name, dim, extras[name]) for name, dim in star.dims().items()]
    return reduce(DataFrame.unionByName, parts)


def fact_summary(fact: DataFrame) -> DataFrame:
    """Totals and distribution of the fact as (metric, value) rows.

    The exact medians keep one counter per distinct minute or mile, which is bounded by their range.
    """
    delay, distance = F.col("departure_delay_minutes"), F.col("distance_miles")
    metrics = {
        "total_flights": F.count(F.lit(1)),
        "cancelled_flights": F.count_if("is_cancelled"),
        "diverted_flights": F.count_if("is_diverted"),
        "delayed_flights": F.count_if(delay > 0),
        "on_time_flights": F.count_if(delay <= 0),
        "avg_delay_minutes": F.avg(delay),
        "median_delay_minutes": F.median(delay),
        "max_delay_minutes": F.max(delay),
        "min_delay_minutes": F.min(delay),
        "avg_distance_miles": F.avg(distance),
        "median_distance_miles": F.median(distance),
        "max_distance_miles": F.max(distance),
        "zero_distance_flights": F.count_if(distance == 0),
        "airline_key_zeros": F.count_if(F.col("airline_key") == 0),
        "airport_key_zeros": F.count_if(F.col("origin_airport_key") == 0)
        + F.count_if(F.col("destination_airport_key") == 0),
        **{f"null_{c}": F.count_if(F.col(c).isNull()) for c in fact.columns},
    }
    return long_form(fact.agg(*[c.cast("double").alias(n) for n, c in metrics.items()]))


def _missing_fields() -> Column:
    return F.concat_ws(",", *[F.when(F.col(c).isNull(), c) for c in CRITICAL])


def bad_rows(flights: DataFrame) -> DataFrame:
    """Records without a critical field, with the list of missing fields, for the quarantine."""
    return flights.withColumn("missing_columns", _missing_fields()).filter(F.col("missing_columns") != "")


#: Why a row has no place in the fact; a missing field is named behind the first reason.
REASONS = ["missing", "impossible date", "unknown origin airport", "unknown destination airport"]


def with_reason(flights: DataFrame, airports: DataFrame) -> DataFrame:
    """All records with the reason for which the fact has no place for them, null for the others."""
    listed = flights.withColumn("missing_columns", _missing_fields())
    date = clocks.calendar_date(F.col("YEAR"), F.col("MONTH"), F.col("DAY"))
    for role in ("ORIGIN_AIRPORT", "DESTINATION_AIRPORT"):
        known = airports.select(F.col("airport_code").alias("_code"), F.lit(True).alias(f"_{role}"))
        listed = listed.join(known, F.upper(F.trim(role)) == F.col("_code"), "left").drop("_code")
    missing, no_date, no_origin, no_destination = REASONS
    reason = (
        F.when(F.col("missing_columns") != "", F.concat(F.lit(f"{missing} "), "missing_columns"))
        .when(date.isNull(), no_date)
        .when(F.col("_ORIGIN_AIRPORT").isNull(), no_origin)
        .when(F.col("_DESTINATION_AIRPORT").isNull(), no_destination)
    )
    return listed.withColumn("reason", reason).select(*flights.columns, "reason")


def rejected_rows(flights: DataFrame, airports: DataFrame) -> DataFrame:
    """Records that have no place in the fact, with the reason: the complement of the fact build."""
    return with_reason(flights, airports).filter("reason IS NOT NULL")


def observed(listed: DataFrame) -> tuple[DataFrame, Observation]:
    """Records with a reason (see ``with_reason``), of which the rejected ones are counted while an action reads them."""
    seen = Observation("source")
    return listed.observe(seen, F.count("reason").alias("rejected")), seen


def any_rejected(seen: Observation) -> bool:
    """Whether the observed action met a rejected row, or may have.

    Spark collects no metrics where it finds without reading the rows that the result is empty.
    """
    try:
        return seen.get["rejected"] > 0
    except Py4JJavaError:
        return True


def reason_counts(quarantine: DataFrame) -> dict[str, int]:
    """How many rows of a quarantine there are by reason; one number for all missing fields."""
    kinds = [F.count_if(F.col("reason").startswith(r)).alias(r) for r in REASONS]
    return quarantine.agg(*kinds).first().asDict()


def extreme_delays(fact: DataFrame, early: int = -600, late: int = 1440) -> DataFrame:
    delay = F.col("departure_delay_minutes")
    return fact.agg(
        F.count_if(delay < early).alias("very_early"), F.count_if(delay > late).alias("very_late")
    )


def unmapped_codes(placed: DataFrame, star) -> DataFrame:
    """(dimension, unmapped_codes, unmapped_rows): codes of cleaned flights missing in a dimension.

    One pass counts the codes of all roles; only distinct codes meet the dimensions.
    """
    roles = [
        ("airline", "airline_code", star.airline.select("airline_code")),
        ("origin", "origin_code", star.airport.select("airport_code")),
        ("destination", "destination_code", star.airport.select("airport_code")),
        ("time", "departure_hour", star.time.select(F.col("hour").cast("string"))),
    ]
    used = F.array(
        *[
            F.struct(F.lit(name).alias("dimension"), F.col(column).cast("string").alias("code"))
            for name, column, _ in roles
        ]
    )
    codes = (
        placed.select(F.explode(used).alias("_use"))
        .groupBy("_use.dimension", "_use.code")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    known = reduce(
        DataFrame.unionByName,
        [dim.toDF("code").withColumn("dimension", F.lit(name)) for name, _, dim in roles],
    )
    missing = codes.join(known.withColumn("_known", F.lit(True)), ["dimension", "code"], "left")
    unknown = F.col("_known").isNull()
    return missing.groupBy("dimension").agg(
        F.count_if(unknown).alias("unmapped_codes"),
        F.coalesce(F.sum(F.when(unknown, F.col("n"))), F.lit(0)).alias("unmapped_rows"),
    )
