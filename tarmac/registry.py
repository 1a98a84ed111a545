"""All registered queries with their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import lru_cache, reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions import clocks, kpi, rules
from tarmac.operators import dims, facts, integrity, quality
from tarmac.operators.star import Star
from tarmac.oracle import eda as eda_oracles
from tarmac.oracle import mapping
from tarmac.oracle import models as model_oracles
from tarmac.oracle import loading as loading_oracles
from tarmac.oracle import views as view_oracles
from tarmac.plans import eda, examples, models, views
from tarmac.session import COMPILED, PACKED_READS, cut_lineage, fresh_path, settings
from tarmac.sources import files, schemas, tables, versions
from tarmac.streaming import ingest
from tarmac.testbed import Testbed, testbed

Query = Callable[[SparkSession, str], DataFrame]

# Thresholds below the defaults where the test data has too few flights per group.
VIEW_OPTIONS = {
    "v_disruption_analysis": {"min_flights": 2},
    "v_peak_congestion_times": {"min_flights": 20},
}

_QUERIES: dict[str, Callable[[Testbed], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def _add(name: str, query: Callable[[Testbed], DataFrame], oracle: str | None) -> None:
    if name in _QUERIES:
        raise ValueError(f"{name} is registered twice")
    _QUERIES[name] = query
    if oracle is not None:
        _ORACLES[name] = oracle


def _loading(name: str):
    """Register a query of the load under ``name``."""

    def decorate(query: Callable[[Testbed], DataFrame]):
        _add(name, query, loading_oracles.oracle(name))
        return query

    return decorate


# --- sources and sinks -------------------------------------------------------------------------------


@_loading("src_airlines")
def _src_airlines(bed):
    path = bed.write_csv(bed.airlines, "airlines-csv")
    return files.read_airlines(bed.spark, path)


@_loading("src_airports")
def _src_airports(bed):
    path = bed.write_csv(bed.airports, "airports-csv", ["NULL", "n/a"])
    return files.read_airports(bed.spark, path)


@_loading("src_flights")
def _src_flights(bed):
    return bed.flights_from_csv


@_loading("src_row_count")
def _src_row_count(bed):
    return files.row_count(bed.flights_from_csv)


@_loading("src_null_tokens")
def _src_null_tokens(bed):
    text = files.read_text_csv(bed.spark, bed.flights_csv)
    columns = ["AIRLINE", "DESTINATION_AIRPORT", "DEPARTURE_DELAY", "CANCELLATION_REASON", "WEATHER_DELAY"]
    return text.agg(
        *[F.count_if(files.null_tokens_to_null(F.col(c)).isNull()).alias(c.lower()) for c in columns]
    )


def _backslash_n(bed, rows: DataFrame, schema) -> DataFrame:
    r"""The rows written as quoted CSV with ``\N`` for missing values, and read back."""
    path = fresh_path(bed.spark, "backslash-n-csv")
    (
        rows.write.option("header", True)
        .option("nullValue", "\\N")
        .option("quoteAll", True)
        .option("escape", '"')
        .csv(path)
    )
    return files.read_backslash_n(bed.spark, path, schema)


@_loading("src_backslash_n")
def _src_backslash_n(bed):
    return _backslash_n(bed, bed.sql(mapping.CIRCUITS_SQL), schemas.CIRCUITS)


@_loading("src_constructors")
def _src_constructors(bed):
    return _backslash_n(bed, bed.sql(mapping.CONSTRUCTORS_SQL), schemas.CONSTRUCTORS)


@_loading("sample_first_n")
def _sample_first_n(bed):
    return files.first_rows(bed.flights, 1000)


@_loading("sink_append")
def _sink_append(bed):
    path = fresh_path(bed.spark, "append")
    first_half = F.col("MONTH") <= 6
    tables.append(bed.flights.filter(first_half), path, ["YEAR", "MONTH"])
    tables.append(bed.flights.filter(~first_half), path, ["YEAR", "MONTH"])
    tables.append(bed.flights.filter(F.lit(False)), path, ["YEAR", "MONTH"])
    return bed.spark.read.schema(bed.flights.schema).parquet(path)


@_loading("sink_fact")
def _sink_fact(bed):
    path = fresh_path(bed.spark, "fact")
    fact = facts.build_fact(bed.flights, bed.star)
    tables.write_fact(fact, path)
    return bed.spark.read.schema(fact.schema).parquet(path)


@_loading("sink_load_once")
def _sink_load_once(bed):
    path = fresh_path(bed.spark, "load-once")
    later = bed.airlines.filter("IATA_CODE >= 'M'")
    dims.build_airlines(later).write.parquet(path)
    everything = dims.build_airlines(bed.airlines)
    tables.load_once(bed.spark, everything, path, "airline_code", "airline_key")
    return tables.load_once(bed.spark, everything, path, "airline_code", "airline_key")


@_loading("ingest_batches")
def _ingest_batches(bed):
    load = ingest.new_ingest(bed.spark, bed.flights_csv, bed.star, max_files=4)
    load.run()
    return load.fact().select(*[c for c in bed.star.fact.columns if c not in ("year", "month")])


def _deliver(part: DataFrame, source: str) -> None:
    """Add flights to the files in ``source``, as many files as tasks."""
    unchanged = part.write.mode("append").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    with settings(part.sparkSession, **COMPILED, **PACKED_READS):
        unchanged.option("header", True).option("compression", "gzip").csv(source)


@_loading("ingest_resume")
def _ingest_resume(bed):
    """Two runs over one checkpoint: the second one reads only the files added in between, and loads the
    flights of an airport that the first run did not know yet."""
    source = fresh_path(bed.spark, "arriving-csv")
    first_half = F.col("MONTH") <= 6
    early = replace(bed.star, airport=bed.star.airport.filter("airport_code <> 'P3'"))
    load = ingest.new_ingest(bed.spark, source, early)
    for part in (bed.flights.filter(first_half), bed.flights.filter(~first_half)):
        _deliver(part, source)
        load = replace(load)  # a new object, as after a restart
        load.replay()
        load.run()
        load = replace(load, dims=bed.star)
    return load.fact().select(*[c for c in bed.star.fact.columns if c not in ("year", "month")])


@_loading("ingest_redelivered")
def _ingest_redelivered(bed):
    """Two deliveries that overlap by four months: the second one adds only what the first one did not have."""
    source = fresh_path(bed.spark, "arriving-csv")
    load = ingest.new_ingest(bed.spark, source, bed.star)
    for part in (bed.flights.filter("MONTH <= 8 OR MONTH IS NULL"), bed.flights.filter("MONTH > 4 OR MONTH IS NULL")):
        _deliver(part, source)
        load.run()
    return load.fact().select(*[c for c in bed.star.fact.columns if c not in ("year", "month")])


@_loading("load_counts")
def _load_counts(bed):
    """Rows that the full load of the test bed read, loaded and rejected by reason."""
    loaded = bed.star and versions.current(bed.spark, bed.warehouse)
    rows = versions.history(bed.spark, bed.warehouse).filter((F.col("kind") == versions.FULL) & (F.col("epoch") == loaded.epoch))
    return rows.select(F.explode("counts").alias("outcome", "row_count"))


# --- profiling ---------------------------------------------------------------------------------------


@_loading("check_required_columns")
def _check_required_columns(bed):
    return quality.required_columns_report(
        {
            "airlines": (bed.airlines, schemas.REQUIRED["airlines"]),
            "airports": (bed.airports, schemas.REQUIRED["airports"]),
            "flights": (bed.flights, schemas.REQUIRED["flights"]),
            "flights without carrier": (bed.flights.drop("AIRLINE"), schemas.REQUIRED["flights"]),
        }
    )


@_loading("check_sources")
def _check_sources(bed):
    return quality.check_sources(
        bed.spark,
        {
            "flights": bed.flights_csv,
            "airports": bed.write_csv(bed.airports, "airports-csv"),
            "absent": fresh_path(bed.spark, "absent"),
        },
    )


@_loading("source_summary")
def _source_summary(bed):
    return quality.source_summary(bed.airlines, bed.airports, bed.flights)


@_loading("profile_columns")
def _profile_columns(bed):
    return quality.profile_columns(bed.flights)


@_loading("fill_factor")
def _fill_factor(bed):
    return quality.fill_factor(bed.flights)


@_loading("dim_summary")
def _dim_summary(bed):
    return quality.dim_summary(bed.star)


@_loading("fact_summary")
def _fact_summary(bed):
    return quality.fact_summary(bed.star.fact)


@_loading("bad_rows")
def _bad_rows(bed):
    return quality.bad_rows(bed.flights)


@_loading("extreme_delays")
def _extreme_delays(bed):
    return quality.extreme_delays(bed.star.fact, early=-30, late=200)


@_loading("unmapped_codes")
def _unmapped_codes(bed):
    return quality.unmapped_codes(facts.add_hour(facts.add_date_key(facts.clean(bed.flights))), bed.star)


@_loading("table_stats")
def _table_stats(bed):
    bed.star  # loaded first
    stats = tables.table_stats(bed.spark, versions.current(bed.spark, bed.warehouse).fact)
    # The size depends on the writer, so only its presence is compared.
    return stats.select("row_count", (F.col("size_mb") > 0).alias("has_size"))


# --- dimensions ------------------------------------------------------------------------------------------


def _flight_dates(bed) -> DataFrame:
    date = clocks.calendar_date(F.col("YEAR"), F.col("MONTH"), F.col("DAY"))
    return bed.flights.select(date.alias("flight_date")).filter(F.col("flight_date").isNotNull())


def _flights() -> Column:
    return F.count(F.lit(1)).alias("flights")


def _flights_per_hour(bed) -> DataFrame:
    number = clocks.hhmm_number(F.col("SCHEDULED_DEPARTURE")).alias("number")
    parsed = bed.flights.select(number)
    return parsed.groupBy(clocks.nearest_hour(F.col("number")).alias("hour")).agg(_flights())


def _with_flights(dim: DataFrame, counts: DataFrame, key: str) -> DataFrame:
    joined = dim.join(counts, key, "left")
    return joined.select(*dim.columns, F.coalesce("flights", F.lit(0)).alias("flights"))


@_loading("dim_airline")
def _dim_airline(bed):
    return dims.build_airlines(bed.airlines)


@_loading("airline_type")
def _airline_type(bed):
    per_airline = bed.star.fact.groupBy("airline_key").agg(_flights())
    named = per_airline.join(bed.star.airline, "airline_key")
    return named.groupBy(rules.airline_type(F.col("airline_name")).alias("airline_type")).agg(
        F.count(F.lit(1)).alias("airlines"), F.sum("flights").alias("flights")
    )


@_loading("dim_airport")
def _dim_airport(bed):
    return dims.build_airports(bed.airports)


@_loading("airport_timezone")
def _airport_timezone(bed):
    per_airport = bed.star.fact.groupBy(F.col("origin_airport_key").alias("airport_key")).agg(_flights())
    located = per_airport.join(bed.star.airport, "airport_key")
    return located.groupBy(rules.airport_timezone(F.col("state")).alias("timezone")).agg(
        F.count(F.lit(1)).alias("airports"), F.sum("flights").alias("flights")
    )


@_loading("airport_size")
def _airport_size(bed):
    return dims.size_by_volume(bed.star.airport, bed.flights)


@_loading("dim_date")
def _dim_date(bed):
    bounds = _flight_dates(bed).agg(F.min("flight_date").alias("first"), F.max("flight_date").alias("last"))
    return dims.calendar(bounds)


@_loading("is_holiday")
def _is_holiday(bed):
    per_day = _flight_dates(bed).groupBy("flight_date").agg(_flights())
    return per_day.withColumn("is_holiday", rules.is_holiday(F.col("flight_date")))


@_loading("season")
def _season(bed):
    return bed.flights.groupBy(rules.season(F.col("MONTH")).alias("season")).agg(_flights())


@_loading("is_business_day")
def _is_business_day(bed):
    per_day = _flight_dates(bed).groupBy("flight_date").agg(_flights())
    flagged = per_day.select("flights", *dims.calendar_columns("flight_date"))
    return flagged.groupBy("is_business_day").agg(
        F.count(F.lit(1)).alias("days"), F.sum("flights").alias("flights")
    )


@_loading("dim_time")
def _dim_time(bed):
    return _with_flights(dims.build_times(bed.spark), _flights_per_hour(bed), "hour")


@_loading("dim_time_seed")
def _dim_time_seed(bed):
    return _with_flights(dims.build_times(bed.spark, "seed"), _flights_per_hour(bed), "hour")


@_loading("hour_category")
def _hour_category(bed):
    category = rules.hour_category(F.col("hour")).alias("hour_category")
    return _flights_per_hour(bed).groupBy(category).agg(F.sum("flights").alias("flights"))


@_loading("time_period")
def _time_period(bed):
    period = rules.time_period(F.col("hour")).alias("time_period")
    return _flights_per_hour(bed).groupBy(period).agg(F.sum("flights").alias("flights"))


def _flights_per_cause(bed) -> DataFrame:
    caused = facts.add_primary_cause(facts.clean(bed.flights))
    return caused.groupBy(F.col("primary_cause").alias("cause_code")).agg(_flights())


@_loading("dim_delay_cause")
def _dim_delay_cause(bed):
    return _with_flights(dims.build_causes(bed.spark), _flights_per_cause(bed), "cause_code")


@_loading("dim_delay_cause_seed")
def _dim_delay_cause_seed(bed):
    return _with_flights(dims.build_delay_causes(bed.spark), _flights_per_cause(bed), "cause_code")


# --- fact steps ------------------------------------------------------------------------------------------


@_loading("fact_clean")
def _fact_clean(bed):
    return facts.clean(bed.flights)


@_loading("fact_date_key")
def _fact_date_key(bed):
    return facts.add_date_key(facts.clean(bed.flights)).select("flight_key", "flight_date", "date_key")


@_loading("hhmm_to_hour")
def _hhmm_to_hour(bed):
    clock = F.col("SCHEDULED_DEPARTURE").alias("scheduled_departure")
    per_clock = bed.flights.groupBy(clock).agg(_flights())
    return per_clock.withColumn("hour", clocks.nearest_hour(clocks.hhmm_number(F.col("scheduled_departure"))))


@_loading("resolve_airline")
def _resolve_airline(bed):
    keyed = facts.resolve_airline(facts.clean(bed.flights), bed.star.airline)
    return keyed.select("flight_key", "airline_key")


@_loading("resolve_airports")
def _resolve_airports(bed):
    keyed = facts.resolve_airports(facts.clean(bed.flights), bed.star.airport)
    return keyed.select("flight_key", "origin_airport_key", "destination_airport_key")


@_loading("resolve_time")
def _resolve_time(bed):
    keyed = facts.resolve_time(facts.add_hour(facts.clean(bed.flights)), bed.star.time)
    return keyed.select("flight_key", "departure_hour", "departure_time_key")


@_loading("delay_metrics")
def _delay_metrics(bed):
    metrics = facts.delay_metrics()
    return facts.clean(bed.flights).withColumns(metrics).select("flight_key", *metrics)


@_loading("primary_cause")
def _primary_cause(bed):
    caused = facts.resolve_cause(facts.clean(bed.flights), bed.star.cause)
    return caused.select("flight_key", "primary_cause", "delay_cause_key")


@_loading("business_flags")
def _business_flags(bed):
    flags = facts.business_flags()
    return facts.add_date_key(facts.clean(bed.flights)).withColumns(flags).select("flight_key", *flags)


@_loading("fact_finalize")
def _fact_finalize(bed):
    return facts.build_fact(bed.flights, bed.star).select(*facts.LOADED_COLUMNS)


@_loading("total_delay")
def _total_delay(bed):
    return facts.build_fact(bed.flights, bed.star).select("flight_key", "total_delay_minutes")


@_loading("delay_severity")
def _delay_severity(bed):
    return facts.build_fact(bed.flights, bed.star).select("flight_key", "delay_severity_category")


@_loading("fact_flights")
def _fact_flights(bed):
    return facts.build_fact(bed.flights, bed.star)


@_loading("lookup_codes")
def _lookup_codes(bed):
    codes = {
        "airline": ("airline_code", "airline_key"),
        "airport": ("airport_code", "airport_key"),
        "date": ("date", "date_key"),
        "time": ("time_value", "time_key"),
        "cause": ("cause_code", "delay_cause_key"),
    }
    parts = [
        dims.code_lookup(dim, *codes[name]).select(
            F.lit(name).alias("dimension"), F.col("code").cast("string").alias("code"), "key"
        )
        for name, dim in bed.star.dims().items()
    ]
    return reduce(DataFrame.unionByName, parts)


# --- integrity, on a star that was damaged on purpose ---------------------------------------------------


def _incomplete(star: Star) -> Star:
    """The star with one member missing in every dimension."""
    return replace(
        star,
        airline=star.airline.filter("airline_code <> 'DL'"),
        airport=star.airport.filter("airport_code <> 'P3'"),
        date=star.date.filter("month <> 3"),
        time=star.time.filter("hour <> 7"),
        cause=star.cause.filter("cause_code <> 'WEATHER'"),
    )


def _repeated(star: Star) -> Star:
    """The star with one member repeated in every dimension."""
    missing = _incomplete(star).dims()
    return replace(star, **{n: d.unionByName(d.exceptAll(missing[n])) for n, d in star.dims().items()})


def _spoilt(star: Star) -> DataFrame:
    reason = F.when(F.col("flight_number") % 3 != 0, F.col("cancellation_reason"))
    return star.fact.withColumns(
        {
            "distance_miles": F.col("distance_miles") - 400,
            "scheduled_elapsed_minutes": F.col("scheduled_elapsed_minutes") - 90,
            "departure_delay_minutes": F.col("departure_delay_minutes") * 8,
            "reported_departure_delay": F.when(
                F.col("flight_number") % 5 != 0, F.col("reported_departure_delay")
            ),
            "cancellation_reason": reason.when(F.col("flight_number") % 2 == 0, "X"),
        }
    )


for _name, _check in {**integrity.ORPHAN_CHECKS, "fk_time": integrity.fk_time}.items():
    _loading(_name)(lambda bed, check=_check: check(_incomplete(bed.star)))

for _name in integrity.VALUE_RULES:
    _loading(_name)(lambda bed, rule=_name: integrity.value_violations(_spoilt(bed.star), rule))


@_loading("integrity_report")
def _integrity_report(bed):
    return integrity.integrity_report(replace(_incomplete(bed.star), fact=_spoilt(bed.star)))


@_loading("unique_codes")
def _unique_codes(bed):
    return integrity.duplicate_codes(_repeated(bed.star))


# --- views and examples ----------------------------------------------------------------------------------


def _moving_averages_rounded(df: DataFrame) -> DataFrame:
    """Two engines add the days of a frame in different order, so the comparison is to six digits."""
    found = [c for c in df.columns if c.endswith("day_moving_avg")]
    return df.withColumns({c: kpi.half_up(F.col(c), 6) for c in found}) if found else df


for _name, _view in views.VIEWS.items():
    _options = VIEW_OPTIONS.get(_name, {})
    _add(
        _name,
        lambda bed, view=_view, options=_options: _moving_averages_rounded(view(bed.star, **options)),
        view_oracles.view_oracle(_name, **_options),
    )

# The same views from what a warehouse keeps of its months, merged with flights of months that arrived since.
for _name in (
    "v_route_optimization", "v_temporal_patterns", "v_severity_classification", "v_disruption_analysis",
    "v_airline_rankings", "v_executive_dashboard", "v_flight_delay_features",
):
    _options = VIEW_OPTIONS.get(_name, {})
    _add(
        f"kept_{_name[2:]}",
        lambda bed, view=views.VIEWS[_name], options=_options: view(bed.kept_star, **options),
        view_oracles.view_oracle(_name, **_options),
    )

_EXAMPLES = {
    "ex_avg_delay_by_airline": lambda bed: examples.avg_delay_by_airline(bed.star),
    "ex_delay_by_origin": lambda bed: examples.delay_by_origin(bed.star),
    "ex_weather_by_month": lambda bed: examples.weather_by_month(bed.star),
    "ex_worst5_airlines": lambda bed: examples.worst_airlines(bed.star),
    "ex_peak_cells": lambda bed: examples.peak_cells(bed.star, min_flights=20),
    "ex_weather_by_season": lambda bed: examples.weather_by_season(bed.star),
    "ex_recent_trends": lambda bed: _moving_averages_rounded(examples.recent_trends(bed.star)),
}
for _name, _query in _EXAMPLES.items():
    _add(_name, _query, view_oracles.example_oracle(_name))


# --- exploration -----------------------------------------------------------------------------------------


def _explored(bed) -> DataFrame:
    return eda.explored(bed.flights)


def _analysed(bed) -> DataFrame:
    return eda.analysis_flights(_explored(bed))


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: kpi.half_up(F.col(c), digits) for c in columns})


def _long(matrix: DataFrame) -> DataFrame:
    """The filled cells of a matrix whose columns depend on the data, one a row."""
    carriers = [c for c in matrix.columns if c != "origin"]
    return matrix.unpivot("origin", carriers, "airline", "mean_delay").filter("mean_delay IS NOT NULL")


_EDA = {
    "eda_month_filter": lambda bed: eda.month_filter(bed.flights, 1),
    "eda_origin_counts": lambda bed: eda.origin_counts(_explored(bed)),
    "eda_flight_date": lambda bed: eda.flight_dates(_explored(bed)),
    "eda_clock": lambda bed: eda.clock_values(_explored(bed)),
    "eda_departure_ts": lambda bed: eda.departure_timestamps(_explored(bed)),
    "eda_clean": lambda bed: eda.clean(_explored(bed)),
    "eda_airline_stats": lambda bed: eda.airline_stats(_analysed(bed)),
    "eda_airline_share": lambda bed: eda.airline_share(_analysed(bed)),
    "eda_delay_level": lambda bed: eda.delay_levels(_analysed(bed)),
    "eda_delay_histogram": lambda bed: eda.delay_histogram(_analysed(bed)),
    "eda_delay_exp_fit": lambda bed: _rounded(_rounded(eda.delay_exp_fit(_analysed(bed)), 6, "a"), 4, "b"),
    "eda_dep_vs_arr": lambda bed: eda.departure_vs_arrival(_analysed(bed)),
    "eda_airport_count": lambda bed: eda.airport_count(_analysed(bed)),
    "eda_airports_per_airline": lambda bed: eda.airports_per_airline(_analysed(bed)),
    "eda_route_volume": lambda bed: eda.route_volume(_analysed(bed), bed.airports),
    "eda_airport_carrier_pivot": lambda bed: _long(eda.airport_carrier_pivot(_analysed(bed))),
    "eda_route_delay": lambda bed: eda.route_delay(_analysed(bed)),
    "eda_airport_series": lambda bed: eda.airport_series(_analysed(bed), "WN", "P5"),
    "eda_time_of_day": lambda bed: eda.time_of_day(_analysed(bed)),
    "eda_quadratic_fit": lambda bed: _rounded(eda.quadratic_fit(eda.time_of_day(_analysed(bed))), 6, "fit"),
    "eda_airport_census": lambda bed: eda.airport_census(_analysed(bed)),
}
for _name, _query in _EDA.items():
    _add(_name, _query, eda_oracles.oracle(_name))


# --- models ----------------------------------------------------------------------------------------------

CUTOFF = "2015-10-01"
CARRIER = "AA"


def _by_time(bed) -> DataFrame:
    return models.mean_delay_by_time(_analysed(bed), remove_extremes=True)


def _merged(bed, part: str = "all") -> DataFrame:
    """Mean delays of one carrier over all its airports, written out once for repeated fits."""
    flights = _analysed(bed)
    if part != "all":
        flights = dict(zip(("train", "test"), models.time_split(flights, CUTOFF)))[part]
    merged = models.merged_delays(flights.filter(F.col("airline") == CARRIER)).drop("airline")
    return cut_lineage(bed.spark, merged, f"merged-{part}")


def _route_times(bed, part: str) -> DataFrame:
    flights = dict(zip(("train", "test"), models.time_split(_analysed(bed), CUTOFF)))[part]
    reduced = models.dep_arr_features(flights.filter(F.col("airline") == CARRIER)).drop("airline")
    return cut_lineage(bed.spark, reduced, f"route-times-{part}")


def _ols(bed, order: int) -> DataFrame:
    merged = _merged(bed)
    return models.fit_delays(merged, order=order).predict(merged)


def _large_errors(bed) -> DataFrame:
    parts = [
        models.large_error_share(_ols(bed, order)).withColumn("polynomial_order", F.lit(order)) for order in (1, 2)
    ]
    return parts[0].unionByName(parts[1])


def _one_hot(bed) -> DataFrame:
    """The sparse vectors as (size, position of the airport), next to the other columns."""
    encoded = models.one_hot(_merged(bed)).withColumn("_dense", vector_to_array("features"))
    return encoded.select(
        "airport_id",
        "departure_seconds",
        "mean",
        "airport_index",
        F.size("_dense").alias("feature_count"),
        (F.array_position("_dense", 1.0) - 1).cast("int").alias("active_position"),
    )


@lru_cache(maxsize=8)
def _grid(bed) -> models.GridResult:
    """The grid of one test bed, shared by the queries that need it."""
    return models.grid_search(_merged(bed, "train"))


def _residuals(bed) -> DataFrame:
    train, test = models.split_merged(_merged(bed))
    scored = models.fit_delays(train, order=2).predict(test)
    return _rounded(models.residual_terms(scored, at_least=400.0), 4, "squared_error", "prediction")


def _errors(scored: DataFrame, model: models.ridge.Model | None = None) -> DataFrame:
    errors = _rounded(models.mse(scored), 4, "mse", "rmse_minutes")
    if model is None:
        return errors
    return errors.withColumns({"polynomial_order": F.lit(model.order), "alpha": F.lit(model.alpha)})


def _refit(bed) -> DataFrame:
    merged = _merged(bed, "train")
    model = models.refit_best(merged, _grid(bed))
    return _errors(model.predict(merged), model)


def _applied(bed) -> DataFrame:
    model = models.fit_ridge(_merged(bed, "train"), order=2, alpha=0.2)
    return _rounded(model.predict(_merged(bed, "test")), 4, "prediction")


def _ridge(bed) -> DataFrame:
    train, test = models.split_merged(_merged(bed))
    return _errors(models.fit_ridge(train, order=2, alpha=0.3).predict(test))


def _model3(bed) -> DataFrame:
    model, _, scored = models.route_time_model(_route_times(bed, "train"), _route_times(bed, "test"))
    return _errors(scored, model)


def _significant(df: DataFrame, *columns: str, digits: int = 5) -> DataFrame:
    """Errors between very small and very large, rounded to significant digits."""

    def rounded(x: Column) -> Column:
        power = F.floor(F.log10(F.when(x > 0, x).otherwise(1.0))).cast("int") - (digits - 1)
        up, down = F.pow(F.lit(10.0), power), F.pow(F.lit(10.0), -power)
        return F.when(power >= 0, F.floor(x / up + 0.5) * up).otherwise(F.floor(x * down + 0.5) / down)

    return df.withColumns({c: rounded(F.col(c)) for c in columns})


def _split_bias(bed) -> DataFrame:
    found = models.split_bias(_by_time(bed))
    by_order = {f"mse_{k + 1}": F.col("mse_by_order")[k] for k in range(3)}
    return _significant(found.withColumns(by_order).drop("mse_by_order"), "best_mse", *by_order)


def _poly_fit(bed) -> DataFrame:
    fits = models.poly_fit(_by_time(bed), 2, "all")
    c = F.col("coefficients")
    return _rounded(
        fits.select("airline", "origin", "train_points", *[c[k].alias(f"c{k}") for k in range(3)], "mse"),
        3, "c0", "c1", "c2", "mse",
    )


_MODELS = {
    "ml_time_split": lambda bed: models.split_summary(_analysed(bed)),
    "ml_mean_delay_by_time": lambda bed: models.mean_delay_by_time(_analysed(bed)),
    "ml_linear_fit": lambda bed: _rounded(
        models.linear_fit(models.mean_delay_by_time(_analysed(bed))), 6, "slope", "intercept"
    ),
    "ml_outlier_effect": lambda bed: _rounded(
        _rounded(models.outlier_effect(_analysed(bed)), 4, "noon_difference"),
        6, "all_slope", "all_intercept", "trimmed_slope", "trimmed_intercept",
    ),
    "ml_poly_fit": _poly_fit,
    "ml_poly_cv": lambda bed: _significant(models.poly_cv(_by_time(bed)), "mse"),
    "ml_split_bias": _split_bias,
    "ml_eval_holdout": lambda bed: _rounded(
        models.eval_holdout(_analysed(bed), CUTOFF), 4, "mse", "rmse_minutes"
    ),
    "ml_merged_delays": lambda bed: models.merged_delays(_analysed(bed)),
    "ml_airport_index": lambda bed: models.airport_index(_merged(bed)),
    "ml_one_hot": _one_hot,
    "ml_ols_all_airports": lambda bed: _rounded(_ols(bed, 1), 4, "prediction"),
    "ml_large_error_share": _large_errors,
    "ml_poly_all_airports": lambda bed: _rounded(_ols(bed, 2), 4, "prediction"),
    "ml_split_eval": lambda bed: _rounded(models.split_eval(_merged(bed)), 4, "mse", "rmse_minutes"),
    "ml_residual_terms": _residuals,
    "ml_ridge": _ridge,
    "ml_grid_search": lambda bed: _rounded(_grid(bed).to_frame(bed.spark), 4, "mse"),
    "ml_refit_best": _refit,
    "ml_apply_train_labels": _applied,
    "ml_dep_arr_features": lambda bed: models.dep_arr_features(_analysed(bed)),
    "ml_model3": _model3,
    "ml_pred_vs_obs": lambda bed: _rounded(
        models.predicted_vs_observed(_ols(bed, 1)), 4, "slope", "intercept", "correlation"
    ),
}
for _name, _query in _MODELS.items():
    _add(_name, _query, model_oracles.oracle(_name))


def _bound(query: Callable[[Testbed], DataFrame]) -> Query:
    return lambda spark, sf_dir: query(testbed(spark, sf_dir))


def queries() -> dict[str, Query]:
    return {name: _bound(query) for name, query in _QUERIES.items()}


def oracles() -> dict[str, str]:
    return dict(_ORACLES)
