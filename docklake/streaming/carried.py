"""Keyed values that a foreachBatch job hands from one micro-batch to the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docklake.session import child_names, delete_path, path_exists


class CarriedTable:
    """One small complete table per micro-batch; a repeated batch starts from the version before it."""

    def __init__(self, path: str, schema: str) -> None:
        self.path = path
        self.schema = schema

    def before(self, spark: SparkSession, batch_id: int) -> DataFrame:
        version = max((v for v in self._versions(spark) if v < batch_id), default=None)
        if version is None:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(self._at(version))

    def store(self, rows: DataFrame, batch_id: int) -> None:
        """Keep ``rows`` as the values after ``batch_id`` and drop versions no retry can need."""
        spark = rows.sparkSession
        rows.write.mode("overwrite").parquet(self._at(batch_id))
        earlier = sorted(v for v in self._versions(spark) if v < batch_id)
        for version in earlier[:-1]:
            delete_path(spark, self._at(version))

    def _at(self, version: int) -> str:
        return f"{self.path}/version={version}"

    def _versions(self, spark: SparkSession) -> list[int]:
        names = child_names(spark, self.path)
        numbers = [int(name.split("=")[1]) for name in names if name.startswith("version=")]
        return [n for n in numbers if path_exists(spark, f"{self._at(n)}/_SUCCESS")]
