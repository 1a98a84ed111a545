"""What the stages under the queries move and how much of it."""

import pytest
from pyspark.sql import functions as F
from flights import flights

from tarmac.operators import trailing
from tarmac.oracle import mapping
from tarmac.plans import eda
from tarmac.session import settings
from tarmac.sources import tables

PLAN_ONCE = {"spark.sql.adaptive.enabled": "false"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_staged_flights_move_no_row_by_month(bed):
    """Customers meet orders before lines do: the lines are in one join only, and nothing is dealt by month."""
    with settings(bed.spark, **PLAN_ONCE, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        text = plan(bed.sql(mapping.flights_sql("spark")))
    lines = [line for line in text.splitlines() if "Exchange hashpartitioning(l_orderkey" in line]
    assert len(lines) == 1 and text.count("Exchange hashpartitioning(o_custkey") == 1
    assert "REPARTITION" not in text and "REBALANCE" not in text


def test_facts_are_sorted_and_written_where_they_are_read(spark, tmp_path, monkeypatch):
    """One task's flights of two months are two files, each in order; no exchange stands before the write."""
    rows = [("k%d" % i, 20150100 + 100 * (i % 2) + i % 7 + 1, i % 3, 2015, 1 + i % 2) for i in range(60)]
    fact = spark.createDataFrame(rows, "flight_key string, date_key int, origin_airport_key int, year int, month int").coalesce(1)
    tables.write_fact(fact, str(tmp_path / "fact"))
    files = sorted((tmp_path / "fact").glob("year=*/month=*/*.parquet"))
    assert len(files) == 2 and all(".zstd." in f.name for f in files)
    for f in files:
        keys = [(r["date_key"], r["origin_airport_key"]) for r in spark.read.parquet(str(f)).collect()]
        assert keys == sorted(keys)


def test_windows_move_keys_as_bytes(star, spark):
    """The keys come back as they were, and travel at half the length."""
    rows = star.fact.join(star.date.select("date_key", "day_of_week"), "date_key").select(*trailing.ORDER, *trailing.KEYS)
    featured = trailing.with_averages(rows, 30, 2_000_000)
    assert sorted(r[0] for r in featured.select("flight_key").collect()) == sorted(r[0] for r in rows.select("flight_key").collect())
    assert "unhex(" in plan(featured)


def test_clean_formats_after_it_drops(spark):
    """Impossible clocks and dates and missing fields are dropped by their numbers, not by formatted text."""
    rows = flights(spark, {}, {"SCHEDULED_DEPARTURE": "2400"}, {"ARRIVAL_TIME": "1275"}, {"DEPARTURE_TIME": None},
                   {"MONTH": 2, "DAY": 30}, {"SCHEDULED_ARRIVAL": "abc"}, {"ELAPSED_TIME": None}, {"AIRLINE": None})
    cleaned = eda.clean(eda.explored(rows))
    assert cleaned.count() == 2 == cleaned.dropna().count()
    condition = [line for line in plan(cleaned).splitlines() if "Filter" in line]
    assert condition and not any("lpad" in line for line in condition)


@pytest.mark.parametrize("name", ["src_null_tokens"])
def test_delivered_files_are_compressed(bed, name):
    found = bed.spark.read.format("binaryFile").load(bed.flights_csv).select(F.col("path")).collect()
    assert found and all(r["path"].endswith(".csv.gz") for r in found)


def test_settings_come_back(spark):
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, None)
    with pytest.raises(ZeroDivisionError), settings(spark, **{name: "7"}):
        assert spark.conf.get(name) == "7"
        1 / 0
    assert spark.conf.get(name, None) == before
