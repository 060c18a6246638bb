"""What the operators share: reading tables, writing intermediate tables to the
cluster's shared folder, partition counts and row identities."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cubewise.session import scratch_path

# Rows without an id rank after every other row.
LAST_ID = (1 << 63) - 1
# Input bytes (as stored) that one shuffle partition should stand for at most.
PARTITION_BYTES = 16 << 20

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    workers_import_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def workers_import_package(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where the
    driver found it (on a cluster the package is installed or shipped)."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([_ROOT, *paths])


def stored(df: DataFrame, what: str) -> DataFrame:
    """Write the rows to the shared folder and read them back: lost executors
    cost no recomputation, and several readers share one computation."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", what)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(df: DataFrame) -> int:
    """Shuffle partitions for work on df: the session's number, more if the
    input's stored size asks for it."""
    conf = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    # A plan of unknown size claims 2**63 - 1.
    return max(conf, min(size // PARTITION_BYTES, 1 << 20)) if size < 1 << 60 else conf


# What a Python worker keeps from task to task (an operator's remembered words).
KEPT: dict[str, dict] = {}


def lean(run: Callable, own: str | None = None) -> Callable:
    """A function for ``mapInArrow`` whose worker starts without what other operators
    keep (all of ``KEPT`` but ``own``) and gives freed memory back to the system before
    and after it: workers are used again by later stages."""
    @wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept(own)
        give_back()
        yield from run(batches)
        give_back()

    return task


def drop_kept(own: str | None) -> None:
    for name, kept in KEPT.items():
        if name != own:
            kept.clear()


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
    if trim:
        trim(0)


def by_number(docs: DataFrame) -> DataFrame:
    """docs with its columns named _0, _1, ..., so that no name of an operator clashes."""
    return docs.toDF(*[f"_{n}" for n in range(len(docs.columns))])


def by_name(numbered: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns that ``by_number`` renamed, with docs' names again."""
    return numbered.select(*[F.col(f"_{n}").alias(c) for n, c in enumerate(docs.columns)])


def id_order(doc_id: Column) -> Column:
    """The id as a sort and join key; rows without an id rank last."""
    return F.coalesce(doc_id.cast("long"), F.lit(LAST_ID))


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def hex_digest(text: Column) -> Column:
    """Lowercase hex SHA-256 of a string's UTF-8 bytes."""
    return F.sha2(F.encode(text, "UTF-8"), 256)
