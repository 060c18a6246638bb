"""Print plan shapes of headline queries as a cluster would plan them
(AQE off, no size-estimate broadcasts): exchanges, broadcasts, join kinds.
Usage: python tests/plan_shapes.py"""

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cubewise import queries as Q  # noqa: E402
from cubewise.session import get_session  # noqa: E402

spark = get_session("local[8]", shuffle_partitions=16, extra={"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"})
sf = "/root/testdata/sf0.01"
names = ["county_fact", "centre_fact", "full_outer_keys", "scorecards_filtered", "applications_vs_delivered_by_month",
         "top10_least_waiting", "yearly_rollup_ratio", "dq_unique", "jsonstat_flatten", "fact_year_partition_filter"]
for n in names:
    df = Q.QUERIES[n](spark, sf)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    t = buf.getvalue()
    shuf = len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition|Exchange RoundRobin", t))
    bc = len(re.findall(r"BroadcastExchange", t))
    smj = len(re.findall(r"SortMergeJoin", t)); bhj = len(re.findall(r"BroadcastHashJoin", t))
    part = "partial_" in t
    tk = "TakeOrderedAndProject" in t
    print(f"| {n} | {shuf} | {bc} | {smj} | {bhj} | {'yes' if part else 'no'} |{' TakeOrderedAndProject' if tk else ''}")
