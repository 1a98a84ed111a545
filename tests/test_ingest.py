from dataclasses import replace

from pyspark.sql import functions as F

from flights import flights
from tarmac.operators import facts, merge
from tarmac.session import fresh_path, settings
from tarmac.sources import tables
from tarmac.streaming import ingest


def add_files(df, path):
    df.coalesce(1).write.mode("append").option("header", True).csv(path)


def test_resume_reset_and_quarantine(spark, star):
    source = fresh_path(spark, "arriving")
    add_files(flights(spark, {}, {"AIRLINE": None}, {"MONTH": 2, "DAY": 30}), source)
    load = ingest.new_ingest(spark, source, star)
    assert [p["input_rows"] for p in load.run()] == [3]
    assert load.fact().count() == 1 and load.quarantine().count() == 2

    assert replace(load).run() == []  # nothing new
    add_files(flights(spark, {"DAY": 6}, {"DAY": 7}), source)
    assert [p["input_rows"] for p in replace(load).run()] == [2]
    assert load.fact().count() == 3
    state = {r.batch_id: (r.read_rows, r.loaded_rows, r.rejected_rows) for r in load.state().collect()}
    assert state == {0: (3, 1, 2), 1: (2, 2, 0)}
    reasons = sorted(r.reason for r in load.quarantine().collect())
    assert reasons == ["impossible date", "missing AIRLINE"]

    fresh = load.reset()
    assert sum(p["input_rows"] for p in fresh.run()) == 5 and fresh.fact().count() == 3


def test_replayed_batch_leaves_no_duplicates(spark, star):
    source = fresh_path(spark, "arriving")
    rows = flights(spark, {}, {"DAY": 6})
    add_files(rows, source)
    load = ingest.new_ingest(spark, source, star)
    load.run()
    load._write_batch(rows, 0)
    assert load.fact().count() == 2


def test_one_batch_per_file_equals_batch_load(spark, bed, star):
    source = fresh_path(spark, "arriving")
    sample = bed.flights.filter(F.col("MONTH") <= 2)
    sample.repartition(3).write.option("header", True).option("ignoreLeadingWhiteSpace", False).csv(source)
    load = ingest.new_ingest(spark, source, star, max_files=1)
    assert len(load.run()) == 3
    columns = facts.FACT_COLUMNS
    expected = facts.build_fact(sample, star).select(*columns)
    assert load.fact().select(*columns).exceptAll(expected).isEmpty()
    assert load.fact().count() == expected.count()


def test_late_airport_is_loaded_from_quarantine(spark, star):
    source = fresh_path(spark, "arriving")
    add_files(flights(spark, {}, {"ORIGIN_AIRPORT": "P3"}, {"AIRLINE": None}), source)
    early = replace(star, airport=star.airport.filter("airport_code <> 'P3'"))
    load = ingest.new_ingest(spark, source, early)
    load.run()
    assert load.fact().count() == 1 and load.quarantine().count() == 2
    late = replace(load, dims=star)
    for _ in range(2):  # again, as after a failure
        late.replay()
        late.run()
        assert late.fact().count() == 2
        assert [r.reason for r in late.quarantine().collect()] == ["missing AIRLINE"]


def test_batches_meet_the_kept_keys_and_not_the_facts(spark, star, monkeypatch):
    """Later batches read one small table of keys a batch; the first one kept none and is looked up in its facts."""
    source = fresh_path(spark, "arriving")
    first = flights(spark, {}, {"DAY": 6}, {"MONTH": 3})
    load = ingest.new_ingest(spark, source, star)
    met = []
    real = merge.not_loaded
    monkeypatch.setattr(merge, "not_loaded", lambda batch, loaded, **rest: met.append(loaded.inputFiles()) or real(batch, loaded, **rest))
    for day in (7, 8, 9):
        add_files(first.unionByName(flights(spark, {"DAY": day})), source)
        load.run()
    assert load.fact().count() == 6
    kinds = [sorted({(path.split("/batch_id=")[1][0], path.split("/epoch=")[0].split("/")[-1]) for path in paths}) for paths in met]
    assert kinds == [[("0", "fact_flights")], [("0", "fact_flights"), ("1", "_keys")]]

    system, folder = tables.file_system(spark, load.version.keys)
    system.delete(folder, True)
    add_files(first.unionByName(flights(spark, {"DAY": 8})), source)
    load.run()
    assert load.fact().count() == 6 and len(met) == 3 and not any("/_keys/" in path for path in met[2])


def test_staged_csv_files_are_as_many_as_their_bytes_ask_for(spark, bed):
    """Many small staged files go to few CSV files, so that loads in batches of files have few batches."""
    path = fresh_path(spark, "small-files")
    spark.range(3000).repartition(150).write.parquet(path)
    with settings(spark, **{"spark.sql.files.maxPartitionBytes": "4m", "spark.sql.files.minPartitionNum": "1"}):
        written = bed.write_csv(spark.read.parquet(path), "few-csv")
    rows = spark.read.option("header", True).csv(written)
    assert rows.count() == 3000 and len(rows.inputFiles()) < 30
