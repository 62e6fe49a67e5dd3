"""Forecast records (S8 / C10): JSON array or JSON lines with camelCase keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.schemas import FORECAST_SOURCE
from starloom.sources.bronze import split_lines


def read_forecast_json(spark: SparkSession, path: str, lines: bool = True) -> DataFrame:
    """A malformed record fails the read; ``split_forecast_lines`` sets
    such lines apart instead."""
    return (spark.read.schema(FORECAST_SOURCE)
            .option("multiLine", not lines)
            .option("mode", "FAILFAST")
            .json(path))


def split_forecast_lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """S8 with a dead letter: (forecast records, rejected lines with reason)."""
    return split_lines(spark, path, FORECAST_SOURCE)


def forecast_rows(records: DataFrame) -> DataFrame:
    """Project source records to the forecast fact columns."""
    return records.select(
        F.col("countryRegion").cast("string").alias("country_region"),
        F.col("brand").cast("string").alias("brand"),
        F.col("forecast").cast("double").alias("forecast"),
        F.col("year").cast("int").alias("year"),
    )


def load_forecast(spark: SparkSession, path: str, lines: bool = True) -> DataFrame:
    """Forecast records -> forecast fact rows, failing on a duplicate
    (country_region, brand, year) as the declared primary key would."""
    from starloom.operators.quality import assert_unique
    rows = forecast_rows(read_forecast_json(spark, path, lines))
    assert_unique(rows, ["country_region", "brand", "year"], "gold_forecast")
    return rows
