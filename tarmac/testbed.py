"""The test tables as a flight warehouse: raw flights, CSV files and the loaded star schema.

Views read a loaded star schema, so it is loaded once per session and input folder, into a new folder
below the scratch root, and shared by all queries.
"""

from __future__ import annotations

from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.operators import partials, trailing
from tarmac.operators import star as star_module
from tarmac.oracle import mapping
from tarmac.plans import views as plans
from tarmac.session import PACKED_READS, WIDE_WRITES, fresh_path, settings
from tarmac.sources import files, schemas, versions

_BEDS: dict = {}


class Testbed:
    __test__ = False  # not a test class

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def sql(self, query: str) -> DataFrame:
        """Run SQL over the test tables, passed in as named frames."""
        names = ["lineitem", "orders", "customer", "nation"]
        used = {n: self.table(n) for n in names if f" {n}" in query}
        for n in used:
            query = query.replace(f"FROM {n}", f"FROM {{{n}}}").replace(f"JOIN {n} ", f"JOIN {{{n}}} ")
        return self.spark.sql(query, **used)

    @cached_property
    def mapped_flights(self) -> DataFrame:
        """The mapping itself, not materialised."""
        df = self.sql(mapping.flights_sql("spark"))
        return df.select(*[F.col(f.name).cast(f.dataType) for f in schemas.FLIGHTS.fields])

    @cached_property
    def flights(self) -> DataFrame:
        """Raw flights, staged as Parquet partitioned by month; every task writes its months, none moves a row.

        Files are cut small, so that a task that reads some of them can sort their rows in memory."""
        path = fresh_path(self.spark, "flights")
        mapped = self.mapped_flights
        staged = mapped.write.partitionBy("MONTH").option("compression", "zstd").option("maxRecordsPerFile", 100_000)
        with settings(self.spark, **WIDE_WRITES):
            staged.parquet(path)
        return self.spark.read.schema(mapped.schema).parquet(path).select(*mapped.columns)

    @cached_property
    def airlines(self) -> DataFrame:
        """The carriers that fly in the data, with their names."""
        names = self.spark.sql(mapping.airlines_sql())
        seen = self.flights.select(F.upper(F.trim("AIRLINE")).alias("IATA_CODE")).distinct()
        return names.join(seen, "IATA_CODE", "left_semi")

    @cached_property
    def airports(self) -> DataFrame:
        return self.sql(mapping.AIRPORTS_SQL)

    @cached_property
    def star(self) -> star_module.Star:
        return star_module.load_star(
            self.spark, self.flights, self.airlines, self.airports, self.warehouse
        )

    @cached_property
    def warehouse(self) -> str:
        return fresh_path(self.spark, "warehouse")

    @cached_property
    def kept_star(self) -> star_module.Star:
        """The star whose warehouse keeps monthly states, trailing averages and tails of its first loads: the last
        year's flights arrived after the states of the others were written, so its months are merged from flights."""
        spark, warehouse, star = self.spark, fresh_path(self.spark, "kept"), self.star
        folder = versions.current(spark, self.warehouse).fact
        years = sorted(row["year"] for row in star.fact.select("year").distinct().collect())  # a partition column
        early = [f"{folder}/year={year}" for year in years[:-1]]
        if early:
            # The facts as they were: the files of the years before, under the names they still have.
            known = spark.read.schema(star.fact.schema).option("basePath", folder).parquet(*early)
            before = replace(star, fact=known)
            partials.refresh(spark, before, warehouse, plans.VIEWS.values())
            trailing.refresh(spark, before, plans.trailed_flights(before), warehouse)
        return trailing.attach(spark, partials.attach(spark, star, warehouse), warehouse)

    def write_csv(self, df: DataFrame, name: str, tokens: list[str] | None = None) -> str:
        """Write CSV, optionally spelling nulls with different tokens from row to row."""
        path = fresh_path(self.spark, name)
        if tokens:
            spelling = F.element_at(
                F.array(*[F.lit(t) for t in tokens]),
                (F.pmod(F.xxhash64(*df.columns), F.lit(len(tokens))) + 1).cast("int"),
            )
            # The spelling is a column of its own, so that the row is hashed once and not for every null.
            spelt = df.withColumn("_spelling", spelling)
            df = spelt.select(*[F.coalesce(F.col(c).cast("string"), "_spelling").alias(c) for c in df.columns])
        writer = (
            df.write.option("header", True)
            .option("compression", "gzip")
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
        )
        with settings(self.spark, **WIDE_WRITES, **PACKED_READS):
            writer.csv(path)
        return path

    @cached_property
    def flights_csv(self) -> str:
        return self.write_csv(self.flights, "flights-csv", ["NULL", "null", "N/A", "n/a", ""])

    @cached_property
    def flights_from_csv(self) -> DataFrame:
        return files.read_flights(self.spark, self.flights_csv)


def testbed(spark: SparkSession, sf_dir: str) -> Testbed:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _BEDS:
        _BEDS[key] = Testbed(spark, sf_dir.rstrip("/"))
    return _BEDS[key]
