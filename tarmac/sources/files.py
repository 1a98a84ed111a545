"""Readers for the delimited source files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.session import cut_lineage
from tarmac.sources import schemas

# Cell contents that mean "missing", the declared ones and the usual CSV defaults.
NULL_TOKENS = [
    "", "NULL", "null", "N/A", "n/a",
    "NA", "<NA>", "#N/A", "#N/A N/A", "#NA", "None", "NaN", "nan", "-NaN", "-nan",
    "1.#IND", "-1.#IND", "1.#QNAN", "-1.#QNAN",
]


class MissingColumns(ValueError):
    """A source lacks columns that the pipeline cannot do without."""


def null_tokens_to_null(value: Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    return F.when(~value.isin(*tokens), value)


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    present = set(df.columns)
    return [name for name in required if name not in present]


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise MissingColumns(f"missing required columns: {missing}")
    return df


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns to the declared types; null tokens and unparseable cells become null.

    Columns the file lacks are added as nulls, unknown columns are dropped.
    """
    present = set(df.columns)
    columns = []
    for field in schema.fields:
        if field.name not in present:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        text = null_tokens_to_null(F.col(field.name))
        if isinstance(field.dataType, T.IntegerType):
            # whole numbers are often written as 12.0
            value = text.try_cast("double").try_cast("int")
        elif isinstance(field.dataType, T.StringType):
            value = text
        else:
            value = text.try_cast(field.dataType)
        columns.append(value.alias(field.name))
    return df.select(*columns)


def read_text_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All columns as text, named by the header line; files with another header raise an error."""
    return spark.read.option("header", True).option("enforceSchema", False).csv(path)


def read_csv(spark: SparkSession, path, schema: T.StructType, required: Sequence[str]) -> DataFrame:
    return typed(require_columns(read_text_csv(spark, path), required), schema)


def read_airlines(spark: SparkSession, path) -> DataFrame:
    airlines = read_csv(spark, path, schemas.AIRLINES, schemas.REQUIRED["airlines"])
    return airlines.dropna(subset=["IATA_CODE", "AIRLINE"])


def read_airports(spark: SparkSession, path) -> DataFrame:
    airports = read_csv(spark, path, schemas.AIRPORTS, schemas.REQUIRED["airports"])
    return airports.dropna(subset=["IATA_CODE", "AIRPORT", "CITY"])


def read_flights(spark: SparkSession, path) -> DataFrame:
    return read_csv(spark, path, schemas.FLIGHTS, schemas.REQUIRED["flights"])


def read_backslash_n(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    r"""Quoted CSV in which ``\N`` marks a missing value."""
    # With a header the reader binds a declared schema by position, so bind by name afterwards.
    text = (
        spark.read.option("header", True)
        .option("nullValue", "\\N")
        .option("escape", '"')
        .csv(path)
    )
    return text.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


# The natural key of a flight; its hash is the surrogate key of the fact table.
FLIGHT_IDENTITY = [
    "YEAR", "MONTH", "DAY", "AIRLINE", "FLIGHT_NUMBER", "TAIL_NUMBER",
    "ORIGIN_AIRPORT", "DESTINATION_AIRPORT", "SCHEDULED_DEPARTURE",
]


def first_rows(df: DataFrame, n: int, order: Sequence[str] = FLIGHT_IDENTITY) -> DataFrame:
    """The first ``n`` rows in a total order (the row limit of a trial run).

    The rows are sorted in ranges and written once; whole ranges come before the row limit, and only
    the range that holds the n-th row is cut, so no task gets more than a range, whatever ``n`` is.
    """
    spark = df.sparkSession
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = cut_lineage(spark, ranged.withColumn("_range", F.spark_partition_id()), "ranges")
    whole, before = [], 0
    for row in ranged.groupBy("_range").count().orderBy("_range").collect():  # one row a range
        if before + row["count"] > n:
            cut = ranged.filter(F.col("_range") == row["_range"]).orderBy(*order).limit(n - before)
            break
        whole.append(row["_range"])
        before += row["count"]
    else:
        return ranged.drop("_range")
    return ranged.filter(F.col("_range").isin(whole)).unionByName(cut).drop("_range")
