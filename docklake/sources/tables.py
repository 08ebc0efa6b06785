"""Readers of the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docklake.functions.text import null_text
from docklake.operators.keyed import latest_per_key
from docklake.schemas import STATION_DIM


def clean_station_dim(stations: DataFrame) -> DataFrame:
    """Missing texts as nulls instead of the text NULL."""
    texts = ("district", "neighborhood", "postal_code", "address")
    return stations.withColumns({name: null_text(F.col(name)) for name in texts})


def station_dim_csv(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """A station dimension load from CSV with a leading ``seq`` column; the last row per id wins."""
    reader = spark.read.schema(f"seq bigint, {STATION_DIM}").options(header="true", **options)
    return clean_station_dim(latest_per_key(reader.csv(path), ["id"], ["seq"]).drop("seq"))


def station_dim(spark: SparkSession, path: str) -> DataFrame:
    return clean_station_dim(spark.read.parquet(path))


def big_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
