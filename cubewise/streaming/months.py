"""Tables kept month by month: one snapshot a month, swapped in by a log entry.

Rows carry a ``period`` (first day of the month, NULL for none). A write puts the
new snapshots of some months into a folder of its own
(``snapshots/write=<id>/period=<month>``); a log entry (``sinks.commits``) then names
for every month of the table the write that holds it. So a month is read from
one place however often it was written, and a reader sees either all of a
refresh or nothing of it. A writer that dies leaves a folder nobody reads.

A log entry is as long as the calendar: one name a month.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cubewise.sinks.commits import CommitLog

PERIOD = "period"
SNAPSHOTS = "snapshots"
# How Spark names the folder of rows without a month.
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"


class MonthStore:
    """A table of month snapshots in a folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.log = CommitLog(spark, path)
        self.path = self.log.folder.path
        last = self.log.last()
        self.number = last.number if last else 0
        self.content: dict = last.content if last else {"months": {}, "epoch": None, "touched": []}

    @property
    def months(self) -> dict[str, str]:
        """Month -> the write that holds its snapshot."""
        return self.content["months"]

    def read(self, schema: T.StructType, months: Iterable[str] | None = None) -> DataFrame:
        """The rows of some months (all of them by default) with the declared types."""
        wanted = sorted(self.months if months is None else set(months) & set(self.months))
        fields = [f for f in schema.fields if f.name != PERIOD]
        full = T.StructType([*fields, T.StructField("write", T.StringType()), T.StructField(PERIOD, T.DateType())])
        if not wanted:
            return self.spark.createDataFrame([], full).drop("write")
        root = f"{self.path}/{SNAPSHOTS}"
        return (self.spark.read.schema(full).option("basePath", root)
                .parquet(*[f"{root}/write={self.months[m]}/{PERIOD}={m}" for m in wanted]).drop("write"))

    def write(self, rows: DataFrame) -> dict[str, str]:
        """Store rows as new snapshots, not yet part of the table: month -> write."""
        write = uuid.uuid4().hex
        (rows.hint("rebalance", PERIOD).write.partitionBy(PERIOD)
         .parquet(f"{self.path}/{SNAPSHOTS}/write={write}"))
        names = self.log.folder.names(SNAPSHOTS, f"write={write}", folders=True)
        return {n.removeprefix(f"{PERIOD}="): write for n in names if n.startswith(f"{PERIOD}=")}

    def commit(self, replaced: Iterable[str], snapshots: dict[str, str], epoch: int | None = None) -> None:
        """Put snapshots in the place of the replaced months, in one step; a replaced
        month without a snapshot is gone."""
        touched = sorted(set(replaced) | set(snapshots))
        kept = {m: w for m, w in self.months.items() if m not in touched}
        content = {"months": kept | snapshots, "epoch": epoch, "touched": touched}
        self.number = self.log.append(content, self.number).number
        self.content = content

    def compact(self) -> list[str]:
        """Delete the writes no month needs any more, except those that the entry before
        the last names (a reader may be at it). Call it while no refresh is running."""
        recent = [e.content["months"].values() for e in self.log.entries()[-2:]]
        needed = {w for names in recent for w in names}
        gone = [n for n in self.log.folder.names(SNAPSHOTS, folders=True) if n.removeprefix("write=") not in needed]
        for name in gone:
            self.log.folder.delete(SNAPSHOTS, name)
        return gone


def month_name(period: datetime.date | None) -> str:
    return NO_MONTH if period is None else period.isoformat()


def in_months(months: Iterable[str]) -> Column:
    """Rows of the given months."""
    wanted = list(months)
    dated = F.col(PERIOD).isin([datetime.date.fromisoformat(m) for m in wanted if m != NO_MONTH])
    return F.coalesce(dated, F.lit(False)) | (F.col(PERIOD).isNull() if NO_MONTH in wanted else F.lit(False))
