"""Tables that change in one step.

A version is written to a new folder of its own, and a log entry naming it makes it
the table. Until then readers see the version before; a writer that dies leaves a
folder nobody reads. Two writers of one table cannot both succeed unnoticed.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cubewise.sinks.commits import CommitLog, Entry


def publish(df: DataFrame, target: str, partition_by: Sequence[str] = (), facts: dict | None = None) -> DataFrame:
    """Write rows as the table's next version and return the stored table. ``df``
    may read the table itself. ``facts``: small values kept with the version."""
    spark = df.sparkSession
    log = CommitLog(spark, target)
    seen = log.last()
    version = f"_version-{uuid.uuid4().hex}"
    cols = list(partition_by)
    writer = (df.hint("rebalance", *cols).write.partitionBy(*cols) if cols else df.write)
    writer.parquet(f"{log.folder.path}/{version}")
    log.append({"version": version, "schema": df.schema.jsonValue(), "facts": facts or {}}, seen.number if seen else 0)
    return read_published(spark, target)


def read_published(spark: SparkSession, target: str, version: int | None = None) -> DataFrame:
    """The table as last published (or as its n-th commit made it), with its
    declared types: partition values are not re-typed by inference."""
    entry = version_entry(spark, target, version)
    schema = T.StructType.fromJson(entry.content["schema"])
    return spark.read.schema(schema).parquet(f"{target.rstrip('/')}/{entry.content['version']}")


def version_entry(spark: SparkSession, target: str, version: int | None = None) -> Entry:
    log = CommitLog(spark, target)
    entry = log.last() if version is None else log.entry(version)
    if entry is None:
        raise FileNotFoundError(f"{target}: nothing published")
    return entry


def is_published(spark: SparkSession, target: str) -> bool:
    return CommitLog(spark, target).last() is not None


def expire(spark: SparkSession, target: str, keep: int = 2) -> list[str]:
    """Delete the folders of all but the last ``keep`` versions, and those of writers
    that died. Call it when no load is running; readers of a deleted version fail."""
    log = CommitLog(spark, target)
    kept = {e.content["version"] for e in log.entries()[-max(keep, 1):]}
    gone = [n for n in log.folder.names(folders=True) if n.startswith("_version-") and n not in kept]
    for name in gone:
        log.folder.delete(name)
    return gone
