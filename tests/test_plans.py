"""Physical plans: what is joined how, what is read, what is shuffled."""

import re

import pytest
from pyspark.sql import functions as F

from tarmac.operators import facts
from tarmac.plans import eda, views


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(views.VIEWS))
def test_dimensions_are_broadcast_by_size(star, name):
    text = plan(views.VIEWS[name](star))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "SortMergeJoin" not in text


@pytest.mark.parametrize("name", sorted(set(views.VIEWS) - {"v_flight_delay_features"}))
def test_facts_are_aggregated_before_they_are_shuffled(star, name):
    """Below the first exchange over the fact there is always a partial aggregate."""
    text = plan(views.VIEWS[name](star))
    for line in re.findall(r"Exchange hashpartitioning\([^\n]*", text):
        assert "REPARTITION" not in line
    assert "partial_" in text


def test_views_read_only_their_columns(star):
    text = plan(views.v_airline_rankings(star))
    schema = re.search(r"ReadSchema: struct<([^>]*delay[^>]*)>", text).group(1)
    assert set(c.split(":")[0] for c in schema.split(",")) == {"airline_key", "departure_delay_minutes", "is_cancelled"}


def test_month_filter_prunes_partitions(bed):
    text = plan(eda.month_filter(bed.flights, 1))
    assert re.search(r"PartitionFilters: \[[^\]]*MONTH[^\]]*= 1", text)


def test_filters_reach_the_scan(star):
    assert "GreaterThan(departure_delay_minutes,0)" in plan(views.v_root_cause_analysis(star))


def test_fact_build_does_not_shuffle_flights(bed, star):
    text = plan(facts.build_fact(bed.flights, star))
    assert "hashpartitioning" not in text and "SortMergeJoin" not in text


def test_top_routes_is_a_top_k(star):
    assert "TakeOrderedAndProject" in plan(views.v_top_delayed_routes(star, 1))


def test_no_python_in_the_load(bed, star):
    assert "Python" not in plan(facts.build_fact(bed.flights, star).agg(F.count("*")))
