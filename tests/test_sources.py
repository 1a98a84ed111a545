import pytest
from pyspark.sql import functions as F

from flights import DEFAULT, flights
from tarmac.operators import dims, quality
from tarmac.sources import files, schemas, tables


def write(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_null_tokens_and_column_order(spark, tmp_path):
    header = [c for c in reversed(schemas.FLIGHTS.fieldNames()) if c != "WEATHER_DELAY"]
    lines = [",".join(header)]
    for token in ("NULL", "null", "N/A", "n/a", ""):
        record = {**DEFAULT, "DEPARTURE_DELAY": token, "TAIL_NUMBER": token}
        lines.append(",".join(str(record.get(c, "")) for c in header))
    df = files.read_flights(spark, write(tmp_path, "flights.csv", "\n".join(lines)))
    assert df.columns == schemas.FLIGHTS.fieldNames() and df.count() == 5
    assert df.filter("DEPARTURE_DELAY is null and TAIL_NUMBER is null and WEATHER_DELAY is null").count() == 5
    assert df.filter("AIRLINE = 'AA' and DISTANCE = 500 and SCHEDULED_DEPARTURE = '0900'").count() == 5


def test_unparseable_numbers_become_null(spark, tmp_path):
    text = "IATA_CODE,AIRPORT,CITY,STATE,COUNTRY,LATITUDE,LONGITUDE\nX,Y,Z,CA,USA,north,12.5\n,Y,Z,,,,\n"
    rows = files.read_airports(spark, write(tmp_path, "a.csv", text)).collect()
    assert len(rows) == 1 and rows[0].LATITUDE is None and rows[0].LONGITUDE == 12.5


def test_missing_required_column(spark, tmp_path):
    with pytest.raises(files.MissingColumns, match="AIRLINE"):
        files.read_airlines(spark, write(tmp_path, "a.csv", "IATA_CODE\nAA\n"))


def test_backslash_n(spark, tmp_path):
    text = (
        "circuitId,circuitRef,name,location,country,lat,lng,alt,url\n"
        '1,"one","A ""quoted"", name","X","Y",1.5,-2.5,10,"http://example.org"\n'
        '2,"two","B","X","Y",1.5,-2.5,\\N,"http://example.org"\n'
    )
    circuits = files.read_backslash_n(spark, write(tmp_path, "c.csv", text), schemas.CIRCUITS)
    one, two = circuits.orderBy("circuitId").collect()
    assert one.name == 'A "quoted", name' and one.alt == 10 and two.alt is None


def test_check_sources(spark, tmp_path):
    paths = {
        "good": write(tmp_path, "good.csv", "a,b\n1,2\n"),
        "empty": write(tmp_path, "empty.csv", "a,b\n"),
        "absent": str(tmp_path / "absent.csv"),
    }
    assert {r.name: r.ok for r in quality.check_sources(spark, paths).collect()} == {
        "good": True, "empty": False, "absent": False,
    }


def test_first_rows_is_deterministic(bed):
    first = files.first_rows(bed.flights, 50).collect()
    again = files.first_rows(bed.flights.repartition(11), 50).collect()
    assert [r.asDict() for r in first] == [r.asDict() for r in again] and len(first) == 50


def test_load_once_keeps_keys(spark, tmp_path):
    schema = "IATA_CODE string, AIRLINE string"
    path = str(tmp_path / "dim")
    dims.build_airlines(spark.createDataFrame([("MM", "M"), ("ZZ", "Z")], schema)).write.parquet(path)
    more = dims.build_airlines(spark.createDataFrame([("AA", "A"), ("MM", "M"), ("BB", "B")], schema))
    tables.load_once(spark, more, path, "airline_code", "airline_key")
    loaded = tables.load_once(spark, more, path, "airline_code", "airline_key")
    assert {r.airline_code: r.airline_key for r in loaded.collect()} == {"MM": 1, "ZZ": 2, "AA": 3, "BB": 4}


def test_table_stats_counts_rows_and_bytes(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).repartition(3).write.parquet(path)
    stats = tables.table_stats(spark, path).first()
    size = sum(f.stat().st_size for f in (tmp_path / "t").glob("*.parquet"))
    assert stats.row_count == 1000 and stats.size_mb == round(size / 1024**2, 2)


def test_append_of_nothing_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    df = flights(spark, {}, {"MONTH": 2})
    tables.append(df, path, ["MONTH"])
    tables.append(df.filter(F.lit(False)), path, ["MONTH"])
    assert spark.read.parquet(path).count() == 2


def test_load_once_extends_the_calendar_with_its_own_keys(spark, tmp_path):
    path = str(tmp_path / "dim_date")
    for year in (2015, 2016):
        days = dims.build_dates(spark, f"{year}-01-01", f"{year}-12-31")
        loaded = tables.load_once(spark, days, path, "date_key", "date_key")
    assert loaded.count() == 365 + 366 and loaded.filter("date_key = 20160229 and day = 29").count() == 1


def test_files_with_different_headers_are_an_error(spark, tmp_path):
    folder = tmp_path / "airlines"
    folder.mkdir()
    (folder / "a.csv").write_text("IATA_CODE,AIRLINE\nAA,American\n")
    (folder / "b.csv").write_text("AIRLINE,IATA_CODE\nDelta,DL\n")
    with pytest.raises(Exception, match="header|schema"):
        files.read_airlines(spark, str(folder)).collect()
