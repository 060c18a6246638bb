"""Physical-plan properties that matter at scale."""

import io
import re
from contextlib import redirect_stdout

from cubewise.plans.facts import centre_fact, county_fact
from cubewise.plans.staging import stage_centre_stats, stage_county_stats
from cubewise.schemas import RAW_CENTRE_SCHEMA, RAW_COUNTY_SCHEMA


def plan_text(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def _inputs(spark):
    api = spark.createDataFrame([("Driving Test Applications Received", "2021 January", "B",
                                  "Tuam, Co. Galway", "Number", 5)], RAW_CENTRE_SCHEMA)
    local = spark.createDataFrame([("Driving Tests Delivered", "2021 January", "Co. Galway", "B",
                                    "Number", 3.0)], RAW_COUNTY_SCHEMA)
    return stage_centre_stats(api), stage_county_stats(local)


def test_fact_shuffles_once_per_side(spark):
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        stg_api, stg_local = _inputs(spark)
        for fact in (county_fact(stg_api, stg_local), centre_fact(stg_api, stg_api)):
            text = plan_text(fact)
            assert "SortMergeJoin" in text and "FullOuter" in text
            # one hash exchange per aggregated side; the join reuses them
            assert len(re.findall(r"Exchange hashpartitioning", text)) == 2, text
            assert "partial_max" in text          # map-side partial aggregation
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_incremental_history_read_is_partition_pruned(spark):
    import datetime as dt

    from pyspark.sql import types as T

    from cubewise.session import scratch_path
    from cubewise.streaming.incremental import read_partitioned, touched_filter

    state = scratch_path(spark, "t_state")
    df = spark.createDataFrame([("a", dt.date(2021, 1, 1)), ("b", dt.date(2021, 2, 1)), ("c", None)],
                               "k string, period date")
    df.write.partitionBy("period").parquet(f"{state}/epoch=0")
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("period", T.DateType()),
                           T.StructField("epoch", T.LongType())])
    pruned = read_partitioned(spark, state, schema).filter(touched_filter([dt.date(2021, 2, 1), None]))
    text = plan_text(pruned)
    assert re.search(r"PartitionFilters: \[.*period", text), text
    assert sorted(r.k for r in pruned.collect()) == ["b", "c"]


def test_condensed_rows_give_the_same_facts_and_report(spark):
    from cubewise.plans.facts import centre_fact, county_fact
    from cubewise.plans.quality_suite import suite_report
    from cubewise.plans.staging import ROWS, condensed, stage_centre_stats, stage_county_stats
    from cubewise.schemas import RAW_CENTRE_SCHEMA, RAW_COUNTY_SCHEMA

    apps = [(s, m, c, z, "Number", v) for s in ("Driving Test Applications Received", None) for m in ("2021 May", "2021M05", None)
            for c in ("B", None) for z in ("Galway, Co. Galway", "Nowhere", None) for v in (3, 3, 5, None)]
    raw_a, raw_c = spark.createDataFrame(apps, RAW_CENTRE_SCHEMA), spark.createDataFrame(
        [(s, m, "Co. Galway", c, "Number", v) for s, m, c, _, _, v in
         [(s, m, c, z, u, None if v is None else float(v)) for s, m, c, z, u, v in apps]], RAW_COUNTY_SCHEMA)
    for agg in ("max", "sum"):
        out = []
        for shrink, keep in ((lambda d: d, []), (lambda d: condensed(d, agg), [ROWS])):
            a, c = stage_centre_stats(shrink(raw_a), keep=keep), stage_county_stats(shrink(raw_c), keep)
            facts = {"county_fact": county_fact(a, c, agg), "centre_fact": centre_fact(a, a, agg)}
            rows = [sorted(map(str, f.collect())) for f in facts.values()]
            report = suite_report({"stg_applications": a, "stg_county": c, **facts}, *keep)
            out.append([*rows, sorted(map(str, report.collect()))])
        assert out[0] == out[1]
    assert condensed(raw_a).count() == 2 * 3 * 2 * 3 * 2


def test_landed_files_are_compressed(spark, tmp_path):
    from cubewise.sinks.files import land_csv, load_raw
    from cubewise.schemas import LANDING_CENTRE_SCHEMA, RAW_CENTRE_SCHEMA

    rows = spark.range(50_000).selectExpr("'Statistic' as statistic", "'2021 May\n' as month", "'B' as driving_test_categories",
                                          "'x, Co. Y' as driving_test_centre", "'Number' as unit", "id as value")
    land_csv(rows, str(tmp_path / "landing"))
    files = list((tmp_path / "landing").glob("part-*"))
    assert sum(f.stat().st_size for f in files) < 50_000 * 40 / 3
    loaded = load_raw(spark, f"{tmp_path}/landing/*", LANDING_CENTRE_SCHEMA, f"{tmp_path}/raw", RAW_CENTRE_SCHEMA)
    assert loaded.exceptAll(rows).isEmpty() and loaded.count() == 50_000
