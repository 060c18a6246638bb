"""Incremental landing: new landing files -> refresh of the affected months.

A file-source stream over the landing directory drives ``foreachBatch``:

1. the batch's rows are staged, tagged with their calendar ``period`` (first
   day of the month; NULL for an unparseable month) and their epoch, and stored;
   the months they touch are the names of the folders written;
2. for these months the new snapshot is the old one and the batch: with ``keys`` a
   key's rows of the latest epoch replace its earlier ones, so a revision may lower
   a value; without, all rows stay and a MAX absorbs repeated ones;
3. the snapshots are swapped in by one log entry (``streaming.months``), which
   carries the epoch: a replayed epoch changes nothing, and a crash before the
   entry leaves the state of before;
4. the fact is rebuilt for the touched months from their snapshots. With
   ``fact_snapshots`` it is a month store too and the months are swapped in one
   step (one without a fact row disappears); else the fact is a plain partitioned
   folder, and dynamic partition overwrite replaces the touched months.

A month is one snapshot however many batches touched it, so a touch reads the
month once, not every batch that ever named it. A replayed epoch still rebuilds
its months' facts (the crash may have come between the two entries).

Different spellings of one month ('Jan', 'January', '1') share a period
partition while the fact rows keep their own grain.

Partitioned writes are clustered with the ``rebalance`` hint: rows of one
month land in few files, and AQE still splits a month holding a large share
of the rows across several tasks. ``build_fact`` must keep the staged
``year`` and ``month`` columns (the period is derived from them).

A stream-stream full outer join would need watermarks and would still delay
one-sided rows; recomputing touched months from their snapshots does not. A
state folder belongs to one checkpoint, which numbers its epochs: a new
checkpoint over a state folder that is not empty is refused.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cubewise.functions import month_number, month_start
from cubewise.operators.project import to_snake_case
from cubewise.plans.staging import stage_centre_stats
from cubewise.sources.csv import CSV_OPTIONS, decode_lines
from cubewise.streaming.months import PERIOD, MonthStore

def calendar_period(df: DataFrame) -> Column:
    """First day of the row's month, from the staged year and month text
    (columns are resolved by name on ``df``)."""
    return month_start("year", month_number("month"))


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a partitioned Parquet table with declared partition-column types
    (no inference: '2021' stays a string)."""
    return spark.read.schema(schema).parquet(path)


def touched_filter(periods: Sequence) -> Column:
    """Partition predicate selecting the given periods (NULL included)."""
    conds = []
    dates = [p for p in periods if p is not None]
    if dates:
        conds.append(F.col(PERIOD).isin(dates))
    if len(dates) < len(periods):
        conds.append(F.col(PERIOD).isNull())
    return reduce(lambda a, b: a | b, conds) if conds else F.lit(False)


EPOCH = "epoch"


@dataclass(frozen=True)
class OtherSide:
    """The fact's second input: where its own stream keeps the staged rows, and
    how that stream reads them."""
    state_dir: str
    landing_schema: T.StructType
    stage: Callable[[DataFrame], DataFrame]

    def history(self, spark: SparkSession, months: Sequence[str]) -> DataFrame:
        staged = self.stage(to_snake_case(spark.createDataFrame([], self.landing_schema)))
        return MonthStore(spark, self.state_dir).read(staged.schema, months).select(staged.columns)


def has_entries(spark: SparkSession, path: str) -> bool:
    """Whether the folder exists and holds anything."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(folder) and len(fs.listStatus(folder)) > 0


def latest_epoch_wins(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The new rows, and the old ones of keys the new rows do not have (NULLs are equal)."""
    replaced = new.select(*[F.col(k).alias(f"_{n}") for n, k in enumerate(keys)]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{n}")) for n, k in enumerate(keys)])
    return old.join(replaced, same, "left_anti").unionByName(new)


def add_epoch(state: MonthStore, staged: DataFrame, epoch_id: int, keys: Sequence[str] | None) -> list[str]:
    """Bring a batch's staged rows (with their period) into the state, once; the
    months it touches."""
    if state.content[EPOCH] is not None and state.content[EPOCH] >= epoch_id:
        if state.content[EPOCH] > epoch_id:
            raise ValueError(f"{state.path} has seen epoch {state.content[EPOCH]}; epoch {epoch_id} is not its next")
        return state.content["touched"]
    spark = state.spark
    columns = [f for f in staged.schema.fields if f.name != PERIOD]
    schema = T.StructType([*columns, T.StructField(EPOCH, T.LongType())])
    fresh = state.write(staged.withColumn(EPOCH, F.lit(epoch_id).cast("long")))
    known = sorted(set(fresh) & set(state.months))
    if known:
        # Months seen before: their new snapshot is written beside the batch's own.
        batch = MonthStore(spark, state.path)
        batch.content = {"months": fresh, EPOCH: None, "touched": []}
        old, new = state.read(schema, known), batch.read(schema, known)
        fresh = fresh | state.write(latest_epoch_wins(old, new, keys) if keys else old.unionByName(new))
    state.commit(fresh, fresh, epoch_id)
    return sorted(fresh)


def refresh_touched(spark: SparkSession, batch: DataFrame, epoch_id: int, state_dir: str, fact_dir: str,
                    build_fact: Callable[..., DataFrame],
                    stage: Callable[[DataFrame], DataFrame] = stage_centre_stats,
                    period: Callable[[DataFrame], Column] = calendar_period,
                    other: OtherSide | None = None, keys: Sequence[str] | None = None,
                    fact_snapshots: bool = False) -> list[str]:
    """Store the batch and rebuild the months it touches: ``build_fact(history)``,
    or ``build_fact(history, other side's history)``. Returns those months."""
    staged = stage(to_snake_case(batch))
    state = MonthStore(spark, state_dir)
    touched = add_epoch(state, staged.withColumn(PERIOD, period(staged)), epoch_id, keys)

    sides = [state.read(staged.schema, touched).select(staged.columns), *([other.history(spark, touched)] if other else [])]
    fact = build_fact(*sides)
    fact = fact.withColumn(PERIOD, period(fact))
    if fact_snapshots:
        table = MonthStore(spark, fact_dir)
        table.commit(touched, table.write(fact))
    else:
        (fact.hint("rebalance", PERIOD).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(PERIOD).parquet(fact_dir))
    return touched


def start_incremental(spark: SparkSession, landing_dir: str, landing_schema: T.StructType, state_dir: str,
                      fact_dir: str, checkpoint: str, build_fact: Callable[..., DataFrame],
                      stage: Callable[[DataFrame], DataFrame] = stage_centre_stats,
                      available_now: bool = True, max_files_per_trigger: int | None = None,
                      other: OtherSide | None = None, keys: Sequence[str] | None = None,
                      fact_snapshots: bool = False) -> StreamingQuery:
    """Start the incremental refresh over ``landing_dir`` (headerless CSV). ``keys``: the
    staged columns that name a series and month; the rows of a key's latest epoch
    count. ``fact_snapshots``: the fact is read with
    ``MonthStore(spark, fact_dir).read(schema)``.

    A fact of two inputs has one stream a side, each with its own state and
    checkpoint and the other's state as ``other``. Both write the same fact
    folder, so run them one after the other.
    """
    if has_entries(spark, state_dir) and not has_entries(spark, f"{checkpoint.rstrip('/')}/offsets"):
        raise ValueError(f"{state_dir} holds epochs of another checkpoint; a new checkpoint would number "
                         "its epochs from 0 and overwrite some of them")
    reader = (spark.readStream.schema(landing_schema).option("header", False)
              .option("mode", "PERMISSIVE").options(**CSV_OPTIONS))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = decode_lines(reader.csv(landing_dir))

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        refresh_touched(spark, batch, epoch_id, state_dir, fact_dir, build_fact, stage, other=other, keys=keys,
                        fact_snapshots=fact_snapshots)

    writer = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
