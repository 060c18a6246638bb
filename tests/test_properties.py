"""Property tests (few examples each: every example is a Spark job)."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cubewise.operators.pivot import full_outer_on, pivot_measures
from cubewise.sources.jsonstat import flatten_cube, parse_documents, validate_jsonstat

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def _doc(sizes, n_values):
    ids = [f"D{i}" for i in range(len(sizes))]
    dims = {d: {"label": f"dim {d}", "category": {"label": {str(j): f"{d}-{j}" for j in range(s)}}}
            for d, s in zip(ids, sizes)}
    return {"result": {"id": ids, "size": sizes, "dimension": dims, "value": list(range(n_values))}}


@SETTINGS
@given(sizes=st.lists(st.integers(1, 4), min_size=1, max_size=4), extra=st.integers(-5, 5))
def test_cube_row_count(spark, sizes, extra):
    cells = 1
    for s in sizes:
        cells *= s
    n_values = max(0, cells + extra)
    df = spark.createDataFrame([("d", json.dumps(_doc(sizes, n_values)))], "doc string, json string")
    valid, _ = validate_jsonstat(parse_documents(df))
    cols = [f"dim D{i}" for i in range(len(sizes))]
    rows = flatten_cube(valid, cols).collect()
    assert len(rows) == min(cells, n_values)
    # every row's labels are the row-major unravel of its position
    for r in rows:
        pos, rest = r.VALUE, r.VALUE
        idx = []
        for s in reversed(sizes):
            idx.append(rest % s)
            rest //= s
        assert [r[c] for c in cols] == [f"D{i}-{j}" for i, j in enumerate(reversed(idx))], pos


keys = st.sampled_from(["a", "b", "c", None])


@SETTINGS
@given(rows=st.lists(st.tuples(keys, st.sampled_from(["s1", "s2", "s3"]), st.integers(0, 9)), max_size=12))
def test_pivot_max_ignores_duplication(spark, rows):
    schema = "k string, s string, v bigint"
    m = {"s1": "m1", "s2": "m2"}
    once = pivot_measures(spark.createDataFrame(rows, schema), ["k"], "s", "v", m).collect()
    twice = pivot_measures(spark.createDataFrame(rows + rows, schema), ["k"], "s", "v", m).collect()
    assert sorted(map(tuple, once), key=str) == sorted(map(tuple, twice), key=str)


@SETTINGS
@given(a=st.lists(keys, max_size=6, unique=True), b=st.lists(keys, max_size=6, unique=True))
def test_full_outer_row_count(spark, a, b):
    left = spark.createDataFrame([(k, 1) for k in a], "k string, x int")
    right = spark.createDataFrame([(k, 2) for k in b], "k string, y int")
    n = full_outer_on(left, right, ["k"]).count()
    non_null = {k for k in a if k is not None} | {k for k in b if k is not None}
    assert n == len(non_null) + a.count(None) + b.count(None)


MONTHS = ["jan", "january", "feb", "february", "mar", "march", "apr", "april", "may", "jun", "june",
          "jul", "july", "aug", "august", "sep", "september", "oct", "october", "nov", "november",
          "dec", "december"]


def _expected_month(text):
    if text is None:
        return None
    low = text.lower()
    names = {m: n for n, pair in enumerate([("jan", "january"), ("feb", "february"), ("mar", "march"),
                                            ("apr", "april"), ("may",), ("jun", "june"), ("jul", "july"),
                                            ("aug", "august"), ("sep", "september"), ("oct", "october"),
                                            ("nov", "november"), ("dec", "december")], start=1) for m in pair}
    if low in names:
        return names[low]
    try:
        return int(text.strip())
    except ValueError:
        return None


spellings = st.one_of(
    st.sampled_from(MONTHS).map(lambda m: m.upper() if len(m) % 2 else m.capitalize()),
    st.integers(-3, 15).map(str),
    st.sampled_from(["Sept", "xyz", "", "1.5", "M01"]),
    st.none(),
)


@SETTINGS
@given(values=st.lists(spellings, min_size=1, max_size=10))
def test_month_number_matches_rule(spark, values):
    from cubewise.functions import month_number

    df = spark.createDataFrame([(v,) for v in values], "m string")
    got = [r[0] for r in df.select(month_number("m")).collect()]
    assert got == [_expected_month(v) for v in values]


def test_hot_key_results_stay_whole(spark):
    """One key holds a third of all rows: grouped operators stay exact and
    no row is dropped."""
    from pyspark.sql import functions as F

    from cubewise.operators.quality import unique
    from cubewise.sinks.files import latest_batch_wins

    n = 3000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
        .alias("k"),
        F.lit("s1").alias("s"), F.col("id").alias("v"),
        (F.col("id") % 2).cast("string").alias("_batch"))
    piv = {r.k: r.m for r in pivot_measures(df, ["k"], "s", "v", {"s1": "m"}, "sum").collect()}
    assert piv["hot"] == sum(range(0, n, 3)) and len(piv) == 1 + (n - n // 3)
    dup = {r.unique_key: r.n_records for r in unique(df, ["k"]).collect()}
    assert dup == {"hot": n // 3}
    kept = latest_batch_wins(df, ["k"]).collect()
    hot_rows = [r for r in kept if r.k == "hot"]
    assert len(hot_rows) == len([i for i in range(0, n, 3) if i % 2 == 1])   # latest batch '1' only
    assert len(kept) == len(hot_rows) + (n - n // 3)
