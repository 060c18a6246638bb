"""JSON-stat 2.0 cube reader: landed documents -> long rows.

A cube is an ordered list of dimensions (``id``, ``size``), a label list per
dimension and a flat row-major ``value`` array (last dimension fastest).
Flattening is pure Spark expressions:

* one document is one row (parallelism is across documents);
* ``posexplode(value)`` streams the cells; the dimension index of a cell is
  ``pos div stride % size``, its label ``labels[index]`` (``Unknown`` past
  the end of a short label list);
* the label arrays are referenced, not copied, per cell: generate and
  projection are fused in one code-generated stage.

Documents failing validation are returned separately with a reason instead
of being silently dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cubewise.schemas import (
    CELLS_SCHEMA,
    CUBE_CATEGORY_COLUMN,
    CUBE_CENTRE_COLUMN,
    CUBE_STATISTIC_COLUMN,
    CUBE_STATISTIC_ID,
    JSONSTAT_SCHEMA,
    UNIT_LABEL,
    UNKNOWN_LABEL,
)

CENTRE_COLUMNS = ["Statistic", "Month", "Driving Test Categories", "Driving Test Centre"]
CENTRE_NO_CATEGORY_COLUMNS = ["Statistic", "Month", "Driving Test Centre"]


def read_documents(spark: SparkSession, path: str | list[str], layout: str = "file") -> DataFrame:
    """Landed documents -> (doc, json).

    ``layout='file'``: one document per file (API responses as landed);
    ``layout='lines'``: one document per line.
    """
    if layout == "file":
        raw = spark.read.text(path, wholetext=True)
        doc = F.col("_metadata.file_path")
    elif layout == "lines":
        raw = spark.read.text(path)
        doc = F.concat(F.col("_metadata.file_path"), F.lit("#"), F.xxhash64("value").cast("string"))
    else:
        raise ValueError(layout)
    return raw.select(doc.alias("doc"), F.col("value").alias("json"))


def parse_documents(docs: DataFrame, json_col: str = "json", doc_col: str = "doc") -> DataFrame:
    """(doc, json) -> (doc, result) with the declared JSON-stat schema.
    Malformed text, a text cell or an object-form value give NULL parts."""
    parsed = F.from_json(F.col(json_col), JSONSTAT_SCHEMA)
    return _once(docs.select(F.col(doc_col).alias("doc"), parsed["result"].alias("result")))


def _once(parsed: DataFrame) -> DataFrame:
    """``parsed`` with ``result`` evaluated once a document: what uses or filters it
    stays above a generator and does not repeat its expression."""
    return parsed.select("doc", F.explode_outer(F.array("result")).alias("result"))


def _dim(d: Column) -> Column:
    return F.try_element_at(F.col("result.dimension"), d)


def reject_reason() -> Column:
    r = F.col("result")
    ids, size = r["id"], r["size"]
    labelled = F.forall(ids, lambda d: _dim(d).isNotNull() & _dim(d)["category"]["label"].isNotNull())
    return (
        F.when(r.isNull(), F.lit("missing result"))
        .when(r["dimension"].isNull() | r["value"].isNull(), F.lit("malformed-document"))
        .when(ids.isNull() | size.isNull() | (F.size(ids) == 0) | (F.size(size) == 0),
              F.lit("no-dimension-order"))
        .when(F.size(ids) != F.size(size), F.lit("dimension order and size differ in length"))
        .when(~labelled, F.lit("dimension without category labels"))
    )


def validate_jsonstat(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split parsed documents into (valid, rejected[doc, reason])."""
    tagged = parsed.withColumn("reject_reason", reject_reason())
    valid = tagged.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    rejected = tagged.filter(F.col("reject_reason").isNotNull()).select("doc", "reject_reason")
    return valid, rejected


def column_name(dim_id: Column, dim_label: Column) -> Column:
    """Dimension -> landing column: the statistic dimension, centre and
    category dimensions (ids starting with 'c') get fixed names; any other
    dimension is named by its label."""
    lid, llab = F.lower(dim_id), F.lower(dim_label)
    is_c = lid.startswith("c")
    return (
        F.when(F.upper(dim_id) == F.lit(CUBE_STATISTIC_ID), F.lit(CUBE_STATISTIC_COLUMN))
        .when(is_c & llab.contains("centre"), F.lit(CUBE_CENTRE_COLUMN))
        .when(is_c & llab.contains("categorie"), F.lit(CUBE_CATEGORY_COLUMN))
        .otherwise(dim_label)
    )


def flatten_cube(valid: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Valid parsed documents -> doc, <columns...>, UNIT, VALUE (bigint).

    Cells beyond ``product(size)`` are ignored and a short value array stops
    early; NULL / NaN values become 0 and fractions are truncated toward 0.
    A requested column that no dimension maps to is NULL; when two
    dimensions map to the same column the later one wins.
    """
    cells = (_prepared(valid, columns).select("*", F.posexplode("value").alias("pos", "v"))
             .filter(F.col("pos") < F.col("n_cells")))
    return _indexed(cells, columns).select(*_labelled(columns), F.lit(UNIT_LABEL).alias("UNIT"), _counted(F.col("v")).alias("VALUE"))


def _prepared(valid: DataFrame, columns: Sequence[str]) -> DataFrame:
    """doc, value, n_cells and, for each column, its dimension's labels, stride and size."""
    r = F.col("result")
    ids, size = r["id"], r["size"]
    n = F.size(ids)
    names = F.transform(ids, lambda d: column_name(d, _dim(d)["label"]))
    one = F.lit(1).cast("long")
    strides = F.transform(size, lambda _x, i: F.aggregate(F.slice(size, i + 2, n - i - 1), one,
                                                         lambda acc, y: acc * y))
    meta = [F.col("doc"), r["value"].alias("value"),
            F.aggregate(size, one, lambda acc, y: acc * y).alias("n_cells")]
    for k, c in enumerate(columns):
        found = F.array_position(F.reverse(names), F.lit(c))
        i = F.when(found > 0, n - found)
        meta += [
            F.map_values(_dim(F.get(ids, i))["category"]["label"]).alias(f"labels_{k}"),
            F.get(strides, i).alias(f"stride_{k}"),
            F.get(size, i).alias(f"size_{k}"),
        ]
    return valid.select(*meta)


def _indexed(cells: DataFrame, columns: Sequence[str]) -> DataFrame:
    """With the index in each dimension of the cell at ``pos``: a projection of its own,
    as it is used several times."""
    return cells.withColumns({
        f"index_{k}": F.pmod(F.floor(F.col("pos") / F.col(f"stride_{k}")), F.col(f"size_{k}")).cast("int")
        for k in range(len(columns))})


def _labelled(columns: Sequence[str]) -> list[Column]:
    """doc and the labels of an ``_indexed`` cell."""
    out = [F.col("doc")]
    for k, c in enumerate(columns):
        labels, idx = F.col(f"labels_{k}"), F.col(f"index_{k}")
        label = F.when(idx < F.size(labels), F.get(labels, idx)).otherwise(F.lit(UNKNOWN_LABEL))
        out.append(F.when(labels.isNotNull(), label).alias(c))
    return out


def _counted(v: Column) -> Column:
    return F.coalesce(F.nanvl(v, F.lit(0.0)), F.lit(0.0)).try_cast("bigint")


def parse_cells(docs: DataFrame, json_col: str = "json", doc_col: str = "doc") -> DataFrame:
    """As ``parse_documents``, but ``value`` is kept as it came (a VARIANT). A value
    that is neither an array nor an object counts as none."""
    parsed = _once(docs.select(F.col(doc_col).alias("doc"), F.from_json(F.col(json_col), CELLS_SCHEMA)["result"].alias("result")))
    value = F.col("result.value")
    # Casts that look at the kind and make nothing of the cells.
    listed = (F.try_variant_get(value, "$", "array<boolean>").isNotNull()
              | F.try_variant_get(value, "$", "struct<_: boolean>").isNotNull())
    return _once(parsed.withColumn("result", F.col("result").withField("value", F.when(listed, value))))


def flatten_cells(valid: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Valid documents of ``parse_cells`` -> doc, <columns...>, UNIT, VALUE (bigint),
    CELL (string).

    ``value`` is an array, or an object of cells by position (``{"7": 1.5}``), whose
    absent positions have no row, like those past a short array. CELL is NULL for a
    number or a null (which counts 0); any other cell is no figure, so its VALUE is
    NULL and CELL holds it as written. A key that is no position gives a row without
    labels, CELL holding key and cell. Cells beyond ``product(size)`` are ignored.

    Both forms are one array of cells, beside it the object's keys and positions: what
    is done per cell is generated code, and little enough of it that the JVM compiles it.
    """
    listed = F.try_variant_get("value", "$", "array<variant>")
    keyed = F.try_variant_get("value", "$", "map<string,variant>")
    prepared = (_prepared(valid, columns).withColumns({"listed": listed, "keyed": F.when(listed.isNull(), keyed)})
                .withColumns({"keys": F.map_keys("keyed"), "cells": F.coalesce("listed", F.map_values("keyed"))})
                .withColumn("places", _positions(F.col("keys"))).drop("value", "listed", "keyed"))
    key = F.get("keys", F.col("at"))
    # The outer form, as Spark makes a filter of the inner one's argument, which builds all cells once more.
    cells = (prepared.select("*", F.posexplode_outer("cells").alias("at", "cell")).filter(F.col("at").isNotNull())
             .withColumn("pos", F.when(F.col("places").isNull(), F.col("at").cast("bigint")).otherwise(F.get("places", F.col("at"))))
             .filter(F.coalesce(F.col("pos"), F.lit(-1)) < F.greatest(F.col("n_cells"), F.lit(0))))
    cell, placed = F.col("cell"), F.col("pos").isNotNull()
    # The array form's JSON null is a VARIANT null. Most cells may be empty: their kind is not asked for.
    empty = cell.isNull() | F.is_variant_null(cell)
    number = F.substring(F.schema_of_variant(cell), 1, 4).isin("BIGI", "DOUB", "FLOA", "DECI")
    written = F.to_json(cell)
    columns_out = [c if n == 0 else F.when(placed, c).alias(columns[n - 1]) for n, c in enumerate(_labelled(columns))]
    return _indexed(cells, columns).select(
        *columns_out, F.lit(UNIT_LABEL).alias("UNIT"),
        F.when(placed & empty, F.lit(0).cast("bigint"))
        .when(placed & number, _counted(F.try_variant_get(cell, "$", "double"))).alias("VALUE"),
        F.when(~placed, F.concat(key, F.lit(": "), F.coalesce(written, F.lit("null"))))
        .when(~(empty | number), written).alias("CELL"))


def _positions(keys: Column) -> Column:
    """The keys as positions; NULL for one that is not all digits."""
    digits = lambda k: (F.translate(k, "0123456789", "") == "") & (k != "")
    numbers = keys.try_cast("array<bigint>")
    # Where all are written as numbers are, no key needs a look of its own.
    plain = (numbers.cast("array<string>") == keys) & (F.array_min(numbers) >= 0)
    return F.when(plain, numbers).otherwise(F.transform(keys, lambda k: F.when(digits(k), k.try_cast("bigint"))))


def read_jsonstat_cells(spark: SparkSession, path: str | list[str], columns: Sequence[str] = tuple(CENTRE_COLUMNS),
                        layout: str = "file") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Landed JSON-stat documents of either form of ``value`` -> (long rows, cells that
    are no figures, rejected documents). One cell that is text costs that cell, not
    its document."""
    valid, rejected = validate_jsonstat(parse_cells(read_documents(spark, path, layout)))
    cells = flatten_cells(valid, columns)
    return cells.filter("CELL IS NULL").drop("CELL"), cells.filter("CELL IS NOT NULL").drop("VALUE"), rejected


def read_jsonstat(spark: SparkSession, path: str | list[str], columns: Sequence[str] = tuple(CENTRE_COLUMNS),
                  layout: str = "file", rebalance: bool = False) -> tuple[DataFrame, DataFrame]:
    """Landed JSON-stat documents -> (long rows, rejected documents).

    With ``rebalance`` the flattened cells are redistributed (AQE picks the
    partition count from their size) so that a few very large cubes do not
    leave everything downstream, e.g. the landing write, to one task each.
    """
    valid, rejected = validate_jsonstat(parse_documents(read_documents(spark, path, layout)))
    rows = flatten_cube(valid, columns)
    return (rows.hint("rebalance") if rebalance else rows), rejected
