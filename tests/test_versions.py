"""Loads that break, files that come twice, resets, counts, and what a merge reads."""

import shutil
from dataclasses import replace

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from flights import flights
from tarmac import warehouse as load
from tarmac.operators import facts, merge, quality, star as star_module
from tarmac.operators.star import read_star
from tarmac.session import fresh_path
from tarmac.sources import versions
from tarmac.streaming import ingest


def add_files(df, path):
    df.coalesce(1).write.mode("append").option("header", True).csv(path)


def test_a_load_that_breaks_leaves_the_former_facts(spark, star):
    warehouse = fresh_path(spark, "warehouse")
    with pytest.raises(star_module.NothingLoaded):
        read_star(spark, warehouse)
    for name, dim in star.dims().items():
        dim.write.parquet(star_module.dim_path(warehouse, name))
    good = flights(spark, {}, {"DAY": 6}, {"AIRLINE": None})
    star_module.load_fact(spark, good, star, warehouse)
    before = sorted(r.flight_key for r in read_star(spark, warehouse).fact.collect())
    assert len(before) == 2

    # The second partition fails after the first one has been written.
    more = flights(spark, *[{"DAY": d} for d in range(1, 9)]).repartition(2)
    broken = more.withColumn("DISTANCE", F.when(F.spark_partition_id() == 1, F.raise_error(F.lit("lost"))).otherwise(F.col("DISTANCE")).cast("int"))
    with pytest.raises(PySparkException, match="lost"):
        star_module.load_fact(spark, broken, star, warehouse)
    assert sorted(r.flight_key for r in read_star(spark, warehouse).fact.collect()) == before
    assert versions.history(spark, warehouse).count() == 1

    # The next load takes the folder that the broken one left.
    star_module.load_fact(spark, more, star, warehouse)
    stored = read_star(spark, warehouse)
    assert stored.fact.count() == 8 and versions.current(spark, warehouse).epoch == 2
    counts = versions.last(spark, versions.current(spark, warehouse), versions.FULL)["counts"]
    assert counts["read"] == counts["loaded"] == 8 and counts["missing"] == 0


def test_old_versions_go_when_newer_ones_are_valid(spark, star):
    warehouse = fresh_path(spark, "warehouse")
    for name, dim in star.dims().items():
        dim.write.parquet(star_module.dim_path(warehouse, name))
    held = []
    for n in (1, 2, 3):
        star_module.load_fact(spark, flights(spark, *[{"DAY": d + 1} for d in range(n)]), star, warehouse)
        held.append(read_star(spark, warehouse).fact)
    assert versions.remove_old(spark, warehouse, keep=2) == ["fact_flights/epoch=1", "quarantine/epoch=1"]
    assert held[1].count() == 2 and read_star(spark, warehouse).fact.count() == 3
    assert load.clear(spark, warehouse) == ["fact_flights/epoch=2", "quarantine/epoch=2"]
    assert load.clear(spark, warehouse) == [] and read_star(spark, warehouse).fact.count() == 3


def test_a_file_that_comes_twice_adds_nothing(spark, star):
    source = fresh_path(spark, "arriving")
    first = flights(spark, {}, {"DAY": 6}, {"MONTH": 3}, {"AIRLINE": None}, {"ORIGIN_AIRPORT": "??"})
    add_files(first, source)
    arriving = ingest.new_ingest(spark, source, star)
    arriving.run()
    add_files(first, source)  # the same rows under another name
    arriving.run()
    late = [{"DAY": 6, "FLIGHT_NUMBER": 1}, {"DAY": 7}, {"MONTH": 3}, {"AIRLINE": None, "DAY": 9}]
    add_files(flights(spark, *late), source)
    arriving.run()
    assert arriving.fact().count() == 4 and arriving.quarantine().count() == 3
    got = [(r.batch_id, r.read_rows, r.loaded_rows, r.delivered_before_rows, r.rejected_rows)
           for r in arriving.state().orderBy("batch_id").collect()]
    assert got == [(0, 5, 3, 0, 2), (1, 5, 0, 5, 0), (2, 4, 1, 2, 1)]


def test_a_batch_that_runs_again_does_not_meet_itself(spark, star):
    source = fresh_path(spark, "arriving")
    rows = flights(spark, {}, {"DAY": 6}, {"AIRLINE": None})
    add_files(rows, source)
    arriving = ingest.new_ingest(spark, source, star)
    arriving.run()
    for _ in range(2):
        arriving._write_batch(rows, 0)
    assert arriving.fact().count() == 2 and arriving.quarantine().count() == 1
    assert [(r.loaded_rows, r.rejected_rows) for r in arriving.state().collect()] == [(2, 1)]


def test_merge_reads_only_touched_months(spark, star):
    days = [{"MONTH": m, "DAY": d, "FLIGHT_NUMBER": 7} for m in range(1, 13) for d in range(1, 28)]
    path = fresh_path(spark, "merge")
    facts.build_fact(flights(spark, *days), star).write.partitionBy("year", "month").parquet(path)
    loaded = spark.read.parquet(path)
    dates = [{"MONTH": m, "DAY": d, "FLIGHT_NUMBER": 7} for m, d in ((2, 1), (2, 28), (4, 30))]
    batch = facts.build_fact(flights(spark, *dates), star)
    for most in (4096, 0):  # with the key filter and without
        new = merge.not_loaded(batch, loaded, most_bitmaps=most)
        assert {(r.month, r.date_key % 100) for r in new.collect()} == {(2, 28), (4, 30)}
    assert merge.touched_months(batch) == [(2015, 2), (2015, 4)]
    held = loaded.filter(merge.in_months([(2015, 2), (2015, 4)]))
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert "month" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    files = held.select("_metadata.file_path").distinct()
    assert {r.file_path.split("month=")[1].split("/")[0] for r in files.collect()} == {"2", "4"}
    assert merge.not_loaded(batch.limit(0), loaded).isEmpty()


def test_key_filter_misses_no_key(spark):
    keys = spark.range(5000).select(F.md5(F.col("id").cast("string")).alias("k"))
    others = spark.range(5000, 25_000).select(F.md5(F.col("id").cast("string")).alias("k"))
    bits = merge.key_filter(keys, "k", 2)
    assert bits.count() == 2
    assert merge.may_contain(keys, "k", bits, 2).count() == 5000
    assert merge.may_contain(others, "k", bits, 2).count() < 0.1 * 20_000


def test_replay_reads_only_rows_of_new_airports(spark, star):
    source = fresh_path(spark, "arriving")
    add_files(flights(spark, {}, {"ORIGIN_AIRPORT": "P3"}, {"ORIGIN_AIRPORT": "??"}, {"AIRLINE": None}), source)
    last = star.airport.agg(F.max("airport_key")).first()[0]
    code = star.airport.filter(F.col("airport_key") == last).first()["airport_code"]
    add_files(flights(spark, {"DESTINATION_AIRPORT": code, "DAY": 9}), source)
    early = replace(star, airport=star.airport.filter(F.col("airport_key") < last).filter("airport_code <> 'P3'"))
    arriving = ingest.new_ingest(spark, source, early)
    arriving.run()
    assert arriving.fact().count() == 1
    known = replace(arriving, dims=replace(star, airport=star.airport.filter("airport_code <> 'P3'")))
    assert known.replay() == 1 and known.replay() == 0 and known.fact().count() == 2
    # An airport with a newer key than any replay has seen.
    late = star.airport.filter("airport_code = 'P3'").withColumn("airport_key", F.lit(last + 1))
    later = replace(known, dims=replace(star, airport=known.dims.airport.unionByName(late)))
    assert later.replay() == 1 and later.replay() == 0 and later.fact().count() == 3
    assert sorted(r.reason for r in later.quarantine().collect()) == ["missing AIRLINE", "unknown origin airport"]


@pytest.fixture(scope="module")
def sources(spark, bed):
    folder = fresh_path(spark, "arriving")
    sample = bed.flights.filter(F.col("MONTH") <= 2)
    sample.repartition(2).write.option("header", True).option("ignoreLeadingWhiteSpace", False).csv(folder)
    return load.Sources(bed.write_csv(bed.airlines, "airlines-csv"), bed.write_csv(bed.airports, "airports-csv"), folder), sample


@pytest.mark.parametrize("incremental", [False, True])
def test_counts_equal_the_quarantine(spark, star, sources, incremental):
    paths, sample = sources
    report = load.load_warehouse(spark, paths, fresh_path(spark, "warehouse"), incremental=incremental)
    want = quality.reason_counts(quality.rejected_rows(sample, star.airport))
    assert {k: report.counts[k] for k in want} == want == quality.reason_counts(report.rejected)
    assert report.counts["loaded"] == report.star.fact.count()
    assert report.counts["read"] == sample.count() == report.counts["loaded"] + sum(want.values())


def test_reset_of_a_broken_run(spark, star, sources):
    paths, sample = sources
    warehouse = fresh_path(spark, "warehouse")
    load.load_warehouse(spark, paths, warehouse, incremental=True)
    before = read_star(spark, warehouse).fact.count()
    # A run that died: facts of a batch that the checkpoint does not know, and a position without its state.
    version = versions.current(spark, warehouse)
    spark.read.parquet(version.fact).filter("batch_id = 0").drop("batch_id").write.partitionBy("year", "month").parquet(
        f"{version.fact}/batch_id=7"
    )
    shutil.rmtree(f"{version.checkpoint}/offsets")
    assert read_star(spark, warehouse).fact.count() == 2 * before
    fresh = load.reset(spark, warehouse)
    assert fresh.epoch == version.epoch + 1
    report = load.load_warehouse(spark, paths, warehouse, incremental=True)
    assert report.star.fact.count() == before == report.counts["loaded"]
    kinds = [r.kind for r in load.state(spark, warehouse).collect()]
    assert kinds == ["incremental", "batch", "reset", "batch"]
    assert not spark.read.parquet(f"{warehouse}/fact_flights").select("epoch").distinct().filter("epoch = 1").count()


def test_an_empty_source_and_a_full_warehouse(spark, star):
    warehouse = fresh_path(spark, "warehouse")
    for name, dim in star.dims().items():
        dim.write.parquet(star_module.dim_path(warehouse, name))
    empty = star_module.load_fact(spark, flights(spark, {}).limit(0), star, warehouse)
    assert empty.fact.count() == 0
    with pytest.raises(load.LayoutConflict):
        load.reset(spark, warehouse)
