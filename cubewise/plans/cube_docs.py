"""Build JSON-stat documents from long rows (the inverse of the reader).

Used to land cubes derived from the driver tables: one document per
(nation, year) of the applications rows, with dimensions statistic x month x
category x centre and the row count of each cell as its value (NULL where a
combination has no rows).

Every per-document collection is bounded by the label domains, not by the
data volume: at most |statistics| x |month spellings| x |categories| x
|centres of one nation| cells, whatever the number of underlying rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Dimension ids and labels of the documents (the centre and category ids
# start with 'C', as the reader's naming rule expects).
DIMENSIONS = [
    # (id, label, source column)
    ("STATISTIC", "Statistic", "statistic"),
    ("TLIST(M1)", "Month", "month"),
    ("C01", "Driving Test Categories", "driving_test_categories"),
    ("C02", "Driving Test Centre", "driving_test_centre"),
]

DOC_KEYS = ["doc_nation", "doc_year", "doc_block"]


def _labels(k: int) -> Column:
    return F.col(f"labels_{k}")


def _nulls(k: Column) -> Column:
    return F.array_repeat(F.lit(None).cast("double"), k.cast("int"))


def dense_values(entries: str, total: Column) -> Column:
    """Sorted non-empty cells [(pos, v)] -> dense value array of length
    ``total`` with NULL in empty cells, in one linear pass: each value is
    followed by as many NULLs as the gap to the next position."""
    e = F.col(entries)
    n = F.size(e)
    pos_at = lambda i: F.get(e, i)["pos"]
    next_pos = lambda i: F.when(i < n - 1, pos_at(i + 1)).otherwise(total)
    runs = F.transform(F.sequence(F.lit(0), n - 1),
                       lambda i: F.concat(F.array(F.get(e, i)["v"]), _nulls(next_pos(i) - pos_at(i) - 1)))
    return F.concat(_nulls(pos_at(F.lit(0))), F.flatten(runs))


def cube_documents(long_rows: DataFrame) -> DataFrame:
    """(n_nationkey, [doc_block], statistic, month, category, centre, ...) ->
    (doc_nation, doc_year, doc_block, json) with one JSON-stat document per
    nation, year and block (rows without one form a single block)."""
    return cube_results(long_rows).select(*DOC_KEYS, F.to_json(F.struct("result")).alias("json"))


def cube_results(long_rows: DataFrame) -> DataFrame:
    """The documents of ``cube_documents`` with ``result`` as a struct, not yet text."""
    block = F.col("doc_block") if "doc_block" in long_rows.columns else F.lit(0).alias("doc_block")
    keyed = long_rows.select(
        F.col("n_nationkey").alias("doc_nation"), F.substring("month", 1, 4).alias("doc_year"), block,
        *[F.col(src) for _, _, src in DIMENSIONS])
    src_cols = [src for _, _, src in DIMENSIONS]
    cells = keyed.groupBy(*DOC_KEYS, *src_cols).agg(F.count(F.lit(1)).alias("n"))
    labels = cells.groupBy(*DOC_KEYS).agg(
        *[F.array_sort(F.collect_set(src)).alias(f"labels_{k}") for k, src in enumerate(src_cols)])
    sizes = [F.size(_labels(k)).cast("long") for k in range(len(DIMENSIONS))]
    pos = F.lit(0).cast("long")
    for k, src in enumerate(src_cols):
        pos = pos * sizes[k] + (F.array_position(_labels(k), F.col(src)) - 1)
    total = F.aggregate(F.array(*sizes), F.lit(1).cast("long"), lambda a, x: a * x)
    positioned = cells.join(labels, DOC_KEYS).select(*DOC_KEYS, pos.alias("pos"), "n")
    entries = positioned.groupBy(*DOC_KEYS).agg(
        F.array_sort(F.collect_list(F.struct("pos", F.col("n").cast("double").alias("v")))).alias("cells"))
    docs = labels.join(entries, DOC_KEYS).withColumn("value", dense_values("cells", total))
    dimension = F.create_map(*[
        part for k, (dim_id, label, _) in enumerate(DIMENSIONS) for part in (
            F.lit(dim_id),
            F.struct(F.lit(label).alias("label"),
                     F.struct(F.map_from_arrays(_labels(k), _labels(k)).alias("label")).alias("category")))
    ])
    result = F.struct(
        F.array(*[F.lit(d) for d, _, _ in DIMENSIONS]).alias("id"),
        F.array(*sizes).alias("size"),
        dimension.alias("dimension"),
        F.col("value").alias("value"),
    )
    return docs.select(*DOC_KEYS, result.alias("result"))
