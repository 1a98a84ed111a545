import hashlib
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tarmac.operators.history import hot_groups, needs_split, trailing_average


def sample(spark, n=4000):
    """Flights of which most belong to one group and many of those to one day."""
    draw = random.Random(7)
    rows = []
    for i in range(n):
        group = "hot" if draw.random() < 0.6 else draw.choice("abcdefgh")
        day = 20150105 if draw.random() < 0.4 else 20150101 + draw.randrange(20)
        rows.append((group, day, hashlib.md5(str(i).encode()).hexdigest(), draw.randrange(-20, 200)))
    return spark.createDataFrame(rows, "g string, day int, flight_key string, v int").repartition(7)


def expected(df, rows):
    w = Window.partitionBy("g").orderBy("day", "flight_key").rowsBetween(-rows, -1)
    return {r.flight_key: r.x for r in df.withColumn("x", F.avg("v").over(w)).collect()}


def test_split_groups_give_the_same_result(spark):
    df = sample(spark)
    for split_rows, rows in ((50, 30), (300, 30), (7, 5), (10**9, 30)):
        found = trailing_average(df, df, ["g"], "day", "flight_key", "v", "x", rows, split_rows)
        assert {r.flight_key: r.x for r in found.collect()} == expected(df, rows)
        assert found.columns == [*df.columns, "x"]
        assert found.count() == df.count()


def test_splitting_is_asked_for_where_a_group_is_large(spark):
    df = sample(spark).withColumn("h", F.col("v") % 3)
    assert needs_split(df, [["g"], ["h", "day"], ["g", "h"]], 2000) == [True, False, False]
    assert needs_split(df, [["g"], ["h", "day"], ["g", "h"]], 10**9) == [False, False, False]
    whole = trailing_average(df, df, ["g"], "day", "flight_key", "v", "x", 30, 10**9, split=False)
    assert {r.flight_key: r.x for r in whole.collect()} == expected(df, 30)


def test_repeated_keys_on_a_hot_day(spark):
    """Rows that tie in day and key are ordered by their value, in one window as in chunks."""
    df = sample(spark, 600)
    df = df.union(df.withColumn("v", F.col("v") + 1)).union(df)
    once = trailing_average(df, df, ["g"], "day", "flight_key", "v", "x", 30, 40)
    whole = trailing_average(df, df, ["g"], "day", "flight_key", "v", "x", 30, 10**9, split=False)
    assert sorted(map(str, once.collect())) == sorted(map(str, whole.collect()))


def test_hot_groups_are_bounded(spark):
    df = sample(spark)
    hot = hot_groups(df, ["g"], "day", 500).collect()
    assert [r.g for r in hot] == ["hot"] and hot[0]["_slices"] > 1
    assert len(hot_groups(df, ["g"], "day", 50).collect()) <= 4000 / 50


def test_no_chunk_of_a_hot_group_is_large(spark):
    from tarmac.operators.history import _chunked

    df = sample(spark)
    hot = hot_groups(df, ["g"], "day", 100)
    chunks = _chunked(df, hot, ["g"], "day", "flight_key", "inner").groupBy("g", "_day", "_slice").count()
    assert chunks.agg(F.max("count")).first()[0] <= 2 * 100


def test_chunks_by_keys_in_bytes(spark):
    df = sample(spark)
    packed = df.withColumn("flight_key", F.unhex("flight_key"))
    found = trailing_average(packed, packed, ["g"], "day", "flight_key", "v", "x", 30, 50)
    assert {r.flight_key.hex(): r.x for r in found.collect()} == expected(df, 30)


def test_groups_beyond_the_memory_of_a_task_are_cut(spark, monkeypatch):
    """No window of the averages gets a group of more rows than a task has the memory for, whatever ``split_rows`` is."""
    from tarmac.operators import history, trailing

    draw = random.Random(3)
    rows = [
        (hashlib.md5(str(i).encode()).hexdigest(), 20150101 + i % 28, 1, 2, 1 + i % 2, i % 24, 1 + i % 7, draw.randrange(90))
        for i in range(3000)
    ]
    names = "flight_key string, date_key int, airline_key int, origin_airport_key int, destination_airport_key int, "
    df = spark.createDataFrame(rows, names + "departure_time_key int, day_of_week int, departure_delay_minutes int")
    whole = trailing.with_averages(df, 30, 10**9)
    monkeypatch.setattr(history, "task_memory", lambda _: 199 * history._SHARE * 128)
    assert history.rows_in_memory(df) < 200
    asked = []
    cut = lambda *args: asked.append(args[-2:]) or trailing_average(*args)
    monkeypatch.setattr(trailing, "trailing_average", cut)
    found = trailing.with_averages(df, 30, 10**9)
    assert [split for _, split in asked] == [True, True, False] and all(rows < 200 for rows, _ in asked)
    assert sorted(map(str, found.select(*whole.columns).collect())) == sorted(map(str, whole.collect()))
