"""Named sources: (schema, table) -> stored table.

The models refer to their inputs by name; the catalogue resolves a name to
a Parquet location (or a registered view), so the same model code runs on
test fixtures and on the warehouse.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from cubewise.sinks.published import is_published, read_published


@dataclass
class Catalog:
    spark: SparkSession
    locations: dict[tuple[str, str], str] = field(default_factory=dict)

    def register(self, schema: str, table: str, location: str) -> None:
        self.locations[(schema, table)] = location

    def source(self, schema: str, table: str) -> DataFrame:
        loc = self.locations.get((schema, table))
        if loc is None:
            return self.spark.table(f"{schema}__{table}")
        return read_published(self.spark, loc) if is_published(self.spark, loc) else self.spark.read.parquet(loc)

    def register_view(self, schema: str, table: str, df: DataFrame) -> None:
        df.createOrReplaceTempView(f"{schema}__{table}")
