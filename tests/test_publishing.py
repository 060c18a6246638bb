"""Committed batches, tables that change in one step, quarantined lines, joined files."""

import os

import pytest
from pyspark.sql import functions as F

from cubewise.schemas import LANDING_CENTRE_NO_CATEGORY_SCHEMA, RAW_CENTRE_NO_CATEGORY_SCHEMA
from cubewise.sinks import files
from cubewise.sinks.commits import CommitLog, ConcurrentCommit
from cubewise.sinks.files import committed_batches, land_csv, load_checked, load_raw
from cubewise.sinks.published import expire, publish, read_published
from cubewise.sources.catalog import Catalog

KEYS = ["statistic", "month", "driving_test_centre"]


def rows_of(spark, values, centre="A"):
    return spark.createDataFrame([("s", "2021 January", centre, "Number", v) for v in values], RAW_CENTRE_NO_CATEGORY_SCHEMA)


def load(spark, landing, target, **options):
    return load_raw(spark, f"{landing}/*", LANDING_CENTRE_NO_CATEGORY_SCHEMA, str(target), RAW_CENTRE_NO_CATEGORY_SCHEMA, **options)


def values(df):
    return sorted(r["value"] for r in df.collect())


@pytest.mark.parametrize("name", ["plain", "my landing", "a%20b 100%", "größe 中文", "plus+sign", "x&=;"])
def test_latest_batch_wins_under_any_path(spark, tmp_path, name):
    landing = str(tmp_path / name / "landing dir")
    land_csv(rows_of(spark, [1]), landing)
    land_csv(rows_of(spark, [7]), landing, batch="0002")
    land_csv(rows_of(spark, [4]), landing, batch="0010")
    assert values(load(spark, landing, tmp_path / "raw", latest_wins=KEYS)) == [4]


def test_latest_wins_without_a_log(spark, tmp_path):
    landing = str(tmp_path / "by hand")
    for batch, value in (("0002", 7), ("00 10+", 4)):
        rows_of(spark, [value]).write.csv(f"{landing}/{batch}")
    assert values(load(spark, landing, tmp_path / "raw", latest_wins=KEYS)) == [7]


def test_a_batch_landed_again_counts_once(spark, tmp_path):
    landing = str(tmp_path / "landing")
    assert land_csv(rows_of(spark, [1, 2]), landing, batch="0001")
    assert not land_csv(rows_of(spark, [1, 2]), landing, batch="0001")
    assert land_csv(rows_of(spark, [5]), landing, batch="0002")
    assert values(load(spark, landing, tmp_path / "raw")) == [1, 2, 5]


def test_uncommitted_files_are_ignored(spark, tmp_path, monkeypatch):
    landing = str(tmp_path / "landing")
    land_csv(rows_of(spark, [1]), landing, batch="0001")
    land_csv(rows_of(spark, [9]), landing)

    def dies(*_):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(files, "commit_batch", dies)
    with pytest.raises(RuntimeError):
        land_csv(rows_of(spark, [100]), landing, batch="0002")
    monkeypatch.undo()
    assert values(load(spark, landing, tmp_path / "raw")) == [1, 9]
    assert land_csv(rows_of(spark, [2]), landing, batch="0002")
    assert values(load(spark, landing, tmp_path / "raw")) == [1, 2, 9]
    assert list(committed_batches(spark, landing)) == ["0002", "0001"]


def test_of_two_attempts_that_write_at_once_one_counts(spark, tmp_path):
    landing = str(tmp_path / "landing")
    for attempt in ("x", "y"):
        rows_of(spark, [3]).write.csv(f"{landing}/0001/{attempt}")
    assert [files.commit_batch(spark, landing, "0001", f"{landing}/0001/{a}") for a in ("x", "y")] == [True, False]
    assert values(load(spark, landing, tmp_path / "raw")) == [3]


@pytest.mark.parametrize("bad", ["", "a/b", "_x", ".x", ".."])
def test_batch_ids_that_are_no_folder(spark, tmp_path, bad):
    if bad:
        with pytest.raises(ValueError):
            land_csv(rows_of(spark, [1]), str(tmp_path), batch=bad)


def test_a_load_that_dies_leaves_the_old_table(spark, tmp_path):
    target = str(tmp_path / "table")
    publish(rows_of(spark, [1, 2]), target)
    failing = rows_of(spark, [3]).withColumn("value", F.when(F.col("value") == 3, F.raise_error("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        publish(failing, target)
    assert values(read_published(spark, target)) == [1, 2]
    # A writer that wrote its files and died before, or halfway through, its entry.
    rows_of(spark, [8]).write.parquet(f"{target}/_version-orphan")
    log = CommitLog(spark, target)
    log.folder.create(b'{"version": "_version-orphan"', "_commits", "_000000000002.json")
    assert values(read_published(spark, target)) == [1, 2]
    assert values(publish(rows_of(spark, [4]), target)) == [4]
    assert values(read_published(spark, target, 1)) == [1, 2]


def test_a_table_may_be_rewritten_from_itself(spark, tmp_path):
    target = str(tmp_path / "self table")
    table = publish(rows_of(spark, [1, 2]), target)
    table = publish(table.withColumn("value", F.col("value") + 10), target)
    assert values(table) == [11, 12]
    cat = Catalog(spark)
    cat.register("raw", "t", target)
    assert values(cat.source("raw", "t")) == [11, 12]


def test_writers_that_meet_are_told(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "t"))
    log.append({"version": "a"}, 0)
    with pytest.raises(ConcurrentCommit):
        log.append({"version": "b"}, 0)
    assert log.last().content == {"version": "a"}


def test_expired_versions_and_orphans_go(spark, tmp_path):
    target = str(tmp_path / "t")
    for v in range(4):
        publish(rows_of(spark, [v]), target)
    rows_of(spark, [8]).write.parquet(f"{target}/_version-orphan")
    assert len(expire(spark, target, keep=2)) == 3
    assert values(read_published(spark, target)) == [3] and values(read_published(spark, target, 3)) == [2]


def test_partitions_keep_declared_types(spark, tmp_path):
    df = spark.createDataFrame([("2021", 1), ("0x", 2), (None, 3)], "year string, v int")
    out = publish(df, str(tmp_path / "fact"), ("year",))
    assert out.schema["year"].dataType.simpleString() == "string"
    assert sorted(map(tuple, out.select("year", "v").collect()), key=str) == sorted([("2021", 1), ("0x", 2), (None, 3)], key=str)


GOOD = ['s,2021 January,"say ""B"", ok",Number,3', "s,2021 January,,Number,4", 's,2021 January,"",Number,\\N', "s,2021 May,a,Number,0"]
BAD = ["s,2021 January,a,Number,three", "s,2021 January,a,Number", "s,2021 January,a,Number,3,more", 's,2021 January,"a', 'b",Number,3',
       "s,2021 January,a,Number,3.5", "s,2021 January,a,Number,99999999999999999999", 's,2021 January,x,"Number,7']


def test_quarantine_holds_every_line_not_read(spark, tmp_path):
    folder = tmp_path / "my landing"
    folder.mkdir()
    (folder / "one.csv").write_text("\n".join(GOOD + BAD[:4]) + "\n")
    (folder / "two.csv").write_text("\n".join([*BAD[4:], "", GOOD[3]]) + "\n")
    done = load_checked(spark, f"{folder}/*", LANDING_CENTRE_NO_CATEGORY_SCHEMA, str(tmp_path / "raw"), RAW_CENTRE_NO_CATEGORY_SCHEMA)
    assert (done.good, done.bad) == (5, 8)
    assert sorted(r["line"] for r in done.quarantine.collect()) == sorted(BAD)
    assert {os.path.basename(r["file"]) for r in done.quarantine.collect()} == {"one.csv", "two.csv"}
    got = sorted(((r["driving_test_centre"], r["value"]) for r in done.table.collect()), key=str)
    assert got == sorted([('say "B", ok', 3), (None, 4), ("", None), ("a", 0), ("a", 0)], key=str)


def test_checked_load_equals_the_plain_one_on_clean_files(spark, tmp_path):
    landing = str(tmp_path / "l")
    texts = ['say "B"', " B ", "", None, "a\nb\r\nc", "\x01", "\\N x", "tab\t", '"', ",", "\\", '""', 'x"y"z"']
    df = spark.createDataFrame([("s", "2021 January", t, "Number", n) for n, t in enumerate(texts)], RAW_CENTRE_NO_CATEGORY_SCHEMA)
    land_csv(df, landing, batch="0001")
    done = load_checked(spark, f"{landing}/*", LANDING_CENTRE_NO_CATEGORY_SCHEMA, str(tmp_path / "r"), RAW_CENTRE_NO_CATEGORY_SCHEMA)
    assert done.bad == 0 and sorted(map(tuple, done.table.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    assert load_checked(spark, f"{landing}/*", LANDING_CENTRE_NO_CATEGORY_SCHEMA, str(tmp_path / "r"),
                        RAW_CENTRE_NO_CATEGORY_SCHEMA).quarantine.count() == 0


@pytest.mark.parametrize("header", [False, True])
def test_single_file_is_the_parts_in_order(spark, tmp_path, header):
    landing = str(tmp_path / "single file")
    df = spark.range(1000).repartition(5).select(F.col("id"), F.concat(F.lit("größe "), "id").alias("t"))
    land_csv(df, landing, header=header, single_file=True)
    names = [n for n in os.listdir(landing) if not n.startswith(".")]
    assert len(names) == 1 and names[0].endswith(".csv")
    with open(os.path.join(landing, names[0]), encoding="utf-8") as f:
        lines = f.read().splitlines()
    assert not header or lines.pop(0) == "id,t"
    assert sorted(lines) == sorted(f"{n},größe {n}" for n in range(1000))
