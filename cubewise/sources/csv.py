"""Declared-schema CSV scans of landing files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cubewise.schemas import HEADER_LABEL


# How landing CSV is written and read. Quotes inside a field are doubled, blanks
# stay, and a NULL (or a field left empty) differs from a quoted empty string.
CSV_OPTIONS = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
               "nullValue": "\\N", "emptyValue": ""}
# A landed file has one line per row, so that scans can split it: line breaks
# inside a text are written as codes (the code character first).
LINE_CODES = [("\x01", "\x010"), ("\n", "\x011"), ("\r", "\x012")]


def encode_lines(df: DataFrame) -> DataFrame:
    return _replace_in_strings(df, LINE_CODES, [plain for plain, _ in LINE_CODES])


def decode_lines(df: DataFrame) -> DataFrame:
    return _replace_in_strings(df, [(code, plain) for plain, code in reversed(LINE_CODES)], [LINE_CODES[0][0]])


def _replace_in_strings(df: DataFrame, pairs: list[tuple[str, str]], signs: list[str]) -> DataFrame:
    """A text that has none of the signs (one look for each) stays as it is."""
    columns = []
    for name, kind in df.dtypes:
        c = text = F.col(f"`{name}`")
        if kind == "string":
            for old, new in pairs:
                c = F.replace(c, F.lit(old), F.lit(new))
            c = F.when(reduce(lambda a, b: a | b, [text.contains(s) for s in signs]), c).otherwise(text)
        columns.append(c.alias(name))
    return df.select(*columns)


def read_landing_csv(spark: SparkSession, path: str | list[str], schema: T.StructType,
                     header: bool = False, corrupt_col: str | None = None) -> DataFrame:
    """Read headerless CSV by position with a fixed schema.

    ``path`` may be a file, a directory or a glob (``landing/*``), or a list
    of them. Unparseable fields become NULL (PERMISSIVE); with
    ``corrupt_col`` the raw text of such lines is kept for counting (the
    reader parses only the columns a query uses, so a count of corrupt lines
    must read every column).
    The scan splits files by ``spark.sql.files.maxPartitionBytes``.
    """
    if corrupt_col:
        schema = T.StructType(list(schema.fields) + [T.StructField(corrupt_col, T.StringType(), True)])
    reader = (spark.read.schema(schema)
              .option("header", header)
              .option("mode", "PERMISSIVE")
              .option("enforceSchema", True)
              .options(**CSV_OPTIONS))
    if corrupt_col:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_col)
    return reader.csv(path)


BAD_LINE = "_bad_line"


def read_checked_lines(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """The declared columns, ``file`` and ``_bad_line``: the whole line where it does not
    hold exactly the declared fields, each of its type, else NULL. A quoted line
    break of another writer makes two such lines, never a shifted row. Empty lines
    are no rows. Files are read as lines, so scans split them as before."""
    with_bad = T.StructType([*schema.fields, T.StructField(BAD_LINE, T.StringType())])
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value").where("value <> ''")
    options = CSV_OPTIONS | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_LINE}
    row = F.from_csv("value", _ddl(with_bad), options)
    parsed = lines.select("file", "value", row.alias("row"))
    # An open quote swallows the rest of its line and can leave the right number of fields.
    quotes = F.char_length("value") - F.char_length(F.replace("value", F.lit('"'), F.lit("")))
    bad = F.when(F.col(f"row.{BAD_LINE}").isNotNull() | (quotes % 2 == 1), F.col("value"))
    return parsed.select(*[F.col("row")[f.name].alias(f.name) for f in schema.fields], "file", bad.alias(BAD_LINE))


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def clean_csv_rows(df: DataFrame, label_col: str, value_col: str) -> DataFrame:
    """Landing clean-up of the county file: drop header rows that reached the
    data (and rows with a NULL label, by three-valued logic) and replace a
    NULL value by 0.0."""
    value = F.coalesce(F.col(value_col).cast("double"), F.lit(0.0)).alias(value_col)
    return (df.filter(F.col(label_col) != F.lit(HEADER_LABEL))
            .select(*[value if c == value_col else F.col(c) for c in df.columns]))
