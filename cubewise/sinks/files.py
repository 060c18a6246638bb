"""File and table sinks: landing CSV, full-refresh raw load, fact tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cubewise.operators.project import to_snake_case
from cubewise.session import scratch_path
from cubewise.sinks.commits import CommitLog, ConcurrentCommit, Folder
from cubewise.sinks.published import publish
from cubewise.sources.csv import (
    BAD_LINE,
    CSV_OPTIONS,
    decode_lines,
    encode_lines,
    read_checked_lines,
    read_landing_csv,
)


BATCH_COL = "_batch"
FILE_ROWS = 1_000_000
COMPRESSED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": FILE_ROWS}


def land_csv(df: DataFrame, path: str, header: bool = False, single_file: bool = False,
             mode: str = "append", batch: str | None = None) -> bool:
    """Write landing CSV. ``append`` adds files next to earlier loads, so a
    re-ingest duplicates rows (absorbed by MAX in the facts).

    ``batch`` lands the files in a sub-folder ``path/<batch>`` and commits it (ids
    that sort in landing order, e.g. zero-padded timestamps): loads see the batch
    whole or not at all, a landing retried under the same id counts once, and a
    load can keep only the latest batch per key (``load_raw(latest_wins=...)``).
    Returns whether these rows were landed; False if the batch was there already.

    ``single_file`` leaves one file: written as ordered parts by many tasks, then
    joined byte for byte by the file system (``join_parts``). Otherwise the files are
    compressed (gzip: labels repeat in every line), each of at most ``FILE_ROWS`` rows,
    since a compressed file is read by one task.
    """
    root, target = path.rstrip("/"), path.rstrip("/")
    if batch:
        if not batch.strip("/.") or "/" in batch or batch.startswith(("_", ".")):
            raise ValueError(f"not a batch id: {batch!r}")
        if batch in committed_batches(df.sparkSession, root):
            return False
        target = f"{root}/{batch}/{uuid.uuid4().hex}"
    out = encode_lines(df).write.option("header", header).options(**CSV_OPTIONS | {"emptyValue": '""'})
    if single_file:
        parts = f"{root}/_parts-{uuid.uuid4().hex}"
        out.option("header", False).csv(parts)
        names = (f'"{c.replace(chr(34), chr(34) * 2)}"' if set(c) & set(',"\n\r') else c for c in df.columns)
        head = ",".join(names) + "\n" if header else ""
        join_parts(df.sparkSession, parts, f"{target}/part-{uuid.uuid4().hex}.csv", head.encode())
    else:
        out.options(**COMPRESSED).mode(mode).csv(target)
    return commit_batch(df.sparkSession, root, batch, target) if batch else True


def committed_batches(spark: SparkSession, landing: str) -> dict[str, str]:
    """Batch id -> folder below the landing folder, for the committed batches."""
    return {e.content["batch"]: e.content["folder"] for e in reversed(CommitLog(spark, landing).entries())}


def commit_batch(spark: SparkSession, landing: str, batch: str, folder: str) -> bool:
    """Make a written batch visible, unless an attempt of it was committed before."""
    log = CommitLog(spark, landing)
    while True:
        entries = log.entries()
        if any(e.content["batch"] == batch for e in entries):
            log.folder.delete(folder.removeprefix(log.folder.path + "/"))
            return False
        try:
            log.append({"batch": batch, "folder": folder.removeprefix(log.folder.path + "/")},
                       entries[-1].number if entries else 0)
            return True
        except ConcurrentCommit:
            continue


def landing_files(spark: SparkSession, path: str) -> list[str] | None:
    """What a load of a landing folder (or its ``/*``) reads if batches were committed
    there: their folders, and the files landed without a batch. None: no log."""
    root = path.rstrip("/").removesuffix("/*").rstrip("/")
    if any(c in root for c in "*?[{") or not (folders := committed_batches(spark, root)):
        return None
    plain = [n for n in Folder(spark, root).names(folders=False) if not n.startswith(("_", "."))]
    return [f"{root}/{f}" for f in sorted(folders.values())] + [f"{root}/{n}" for n in plain]


def join_parts(spark: SparkSession, parts: str, target: str, head: bytes = b"") -> None:
    """Join a folder's part files, in the order of their names, into one file.

    A file system that joins files itself (HDFS: ``concat``) moves no byte.
    Elsewhere the parts' bytes are copied in order by the JVM, a buffer at a time;
    no task holds the table. The file gets its name when it is whole."""
    folder, goal = Folder(spark, parts), Folder(spark, target)
    names = [n for n in folder.names(folders=False) if n.startswith("part-")]
    if not folder.create(head, "_joined"):
        raise FileExistsError(f"{parts}/_joined")
    try:
        if names:
            folder.fs.concat(folder.at("_joined"), _path_array(spark, [folder.at(n) for n in names]))
    except Exception as e:
        if "Unsupported" not in f"{type(e).__name__} {e}":
            raise
        folder.delete("_joined")
        _copy_parts(spark, folder, names, head)
    goal.fs.mkdirs(goal.at().getParent())
    if not goal.fs.rename(folder.at("_joined"), goal.at()):
        raise OSError(f"cannot name {target}")
    folder.delete()


def _path_array(spark: SparkSession, paths: list):
    array = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Path, len(paths))
    for n, p in enumerate(paths):
        array[n] = p
    return array


def _copy_parts(spark: SparkSession, folder: Folder, names: list[str], head: bytes) -> None:
    out = folder.fs.create(folder.at("_joined"), False)
    try:
        out.write(bytearray(head))
        for name in names:
            part = folder.fs.open(folder.at(name))
            try:
                spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, 1 << 20, False)
            finally:
                part.close()
    finally:
        out.close()


def landing_batch(spark: SparkSession, path: str) -> Column:
    """The batch sub-folder of a landed file under ``path`` (the landing folder
    or its ``/*`` glob); files landed without a batch have '' and so rank below
    every batch. A file outside the landing folder is an error. File paths are
    percent-encoded, as the landing folder's own is here, so its name may hold
    blanks, percent signs or any script."""
    root = path.rstrip("/").removesuffix("/*").rstrip("/")
    if any(c in root for c in "*?[{"):
        raise ValueError(f"batches need one landing folder, not a pattern: {path}")
    root = Folder(spark, root).raw_path() + "/"
    file = F.col("_metadata.file_path")
    rest = F.substring(file, F.locate(root, file) + len(root), F.lit(1 << 20))
    batch = F.when(F.instr(rest, "/") > 0, F.url_decode(F.replace(F.substring_index(rest, "/", 1), F.lit("+"), F.lit("%2B"))))
    outside = F.raise_error(F.concat(F.lit(f"not under {root}: "), file)).cast("string")
    return F.when(F.locate(root, file) == 0, outside).otherwise(F.coalesce(batch, F.lit("")))


def latest_batch_wins(df: DataFrame, keys: Sequence[str], batch_col: str = BATCH_COL) -> DataFrame:
    """Keep, for every key, only the rows of the latest batch holding it.

    A grouped max (partial aggregation) joined back on the keys (NULL-safe)
    rather than a window, so a key holding a large share of the rows is
    reduced map-side and split by AQE's skew-join handling instead of being
    sorted in one task.
    """
    latest = df.groupBy(*keys).agg(F.max(batch_col).alias("_latest_batch"))
    on = reduce(lambda a, b: a & b, [df[k].eqNullSafe(latest[k]) for k in keys])
    joined = df.join(latest, on & (df[batch_col] == latest["_latest_batch"]), "left_semi")
    return joined.drop(batch_col)


def load_raw(spark: SparkSession, path: str | list[str], landing_schema: T.StructType, target: str,
             warehouse_schema: T.StructType | None = None,
             latest_wins: Sequence[str] | None = None) -> DataFrame:
    """Full-refresh load: read every landing file under ``path`` (glob or
    directory) by position, rename to snake_case, enforce the warehouse
    types and publish ``target`` anew (``sinks.published``: readers see the
    table of before until the load is whole). Returns the loaded table.

    Of a landing folder with committed batches only those are read, and files landed
    without a batch. ``latest_wins`` (warehouse key columns): rows landed in batch
    sub-folders are de-duplicated so that each key keeps the rows of its
    latest batch only (a revised re-extract replaces the earlier values
    instead of adding to them).
    """
    committed = landing_files(spark, path) if isinstance(path, str) else None
    df = read_landing_csv(spark, committed or path, landing_schema)
    if latest_wins:
        if not isinstance(path, str):
            raise ValueError("latest_wins needs one landing folder")
        df = df.withColumn(BATCH_COL, landing_batch(spark, path))
    df = to_snake_case(decode_lines(df))
    if warehouse_schema is not None:
        df = df.select(*typed(df, warehouse_schema), *([BATCH_COL] if latest_wins else []))
    if latest_wins:
        # Stored once, so that the text is parsed once; the batches are as many
        # as the landing's sub-folders, and their ranks aggregate by hash.
        df = materialize(df, scratch_path(spark, "landing_batches"), ())
        batches = (["", *sorted(committed_batches(spark, path.rstrip("/").removesuffix("/*").rstrip("/")))] if committed
                   else sorted(r[0] for r in df.select(BATCH_COL).distinct().collect()))
        rank = F.array_position(F.array(*[F.lit(b) for b in batches]).cast("array<string>"), F.col(BATCH_COL))
        df = latest_batch_wins(df.withColumn(BATCH_COL, rank), latest_wins)
    return publish(df, target)


def typed(df: DataFrame, schema: T.StructType) -> list[Column]:
    return [df[f.name].try_cast(f.dataType).alias(f.name) for f in schema.fields]


@dataclass(frozen=True)
class CheckedLoad:
    """A load's table, the lines it could not read, and how many of each."""
    table: DataFrame
    quarantine: DataFrame
    good: int
    bad: int


def load_checked(spark: SparkSession, path: str | list[str], landing_schema: T.StructType, target: str,
                 warehouse_schema: T.StructType | None = None) -> CheckedLoad:
    """``load_raw`` that loses no field unseen. Lines that do not hold exactly the
    declared fields, each of its type, are not loaded with NULLs but set aside
    with their file and whole text, and counted exactly. One pass parses every line
    and writes both; the table and its quarantine (``<target>_quarantine``) are
    published from there."""
    committed = landing_files(spark, path) if isinstance(path, str) else None
    lines = read_checked_lines(spark, committed or path, landing_schema)
    pass_ = scratch_path(spark, "checked_lines")
    lines.withColumn("bad", F.col(BAD_LINE).isNotNull()).write.partitionBy("bad").parquet(pass_)
    seen = spark.read.schema(lines.schema.add("bad", T.BooleanType())).parquet(pass_)
    good = to_snake_case(decode_lines(seen.where("not bad").select(landing_schema.fieldNames())))
    if warehouse_schema is not None:
        good = good.select(*typed(good, warehouse_schema))
    counts = {r["bad"]: r["count"] for r in seen.groupBy("bad").count().collect()}
    n = {"good": counts.get(False, 0), "bad": counts.get(True, 0)}
    quarantine = publish(seen.where("bad").select("file", F.col(BAD_LINE).alias("line")), target.rstrip("/") + "_quarantine", (), n)
    return CheckedLoad(publish(good, target, (), n), quarantine, n["good"], n["bad"])


def materialize(df: DataFrame, target: str, partition_by: Sequence[str] = ("year",)) -> DataFrame:
    """Write a fact as a Parquet table partitioned by ``partition_by`` (so a
    year filter prunes whole directories) and return the stored table. The
    folder is overwritten in place; a table that others read meanwhile is
    published instead (``sinks.published.publish``).

    Rows are first clustered by the partition columns (``rebalance`` hint)
    so each partition is written as few files rather than one per task;
    AQE splits a partition value holding a large share of the rows.
    """
    cols = list(partition_by)
    out = df.hint("rebalance", *cols) if cols else df
    (out.write.mode("overwrite").partitionBy(*cols) if cols else out.write.mode("overwrite")).parquet(target)
    # read back with the declared schema: partition values are not re-typed
    # by inference ('2021' stays a string year)
    return df.sparkSession.read.schema(df.schema).parquet(target)


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Expose a model lazily under a name (a view, not a table)."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """First ``n`` rows, in no particular order."""
    return df.limit(n)
