"""Very large JSON-stat cubes: one document's cells parsed by many tasks.

JSON is not splittable by lines, but the cells of ``value`` are parted by commas.
So the file is read as text with the comma as line separator: Spark's text source
deals byte ranges of one file to many tasks and mends the range borders itself.
The pieces (tokens) are written once, with their order inside the range; then

* tokens are counted per chunk of at most ``CHUNK`` and the counts summed up along
  the file, which gives every token its place in the document;
* the tokens around the cells (dimensions, labels, sizes) are put together again to
  a document with an empty ``value``, parsed as any other;
* the cells join their document's labels chunk by chunk, on the partitioning that
  placed them: tokens cross one exchange, and no task holds more than a chunk's
  tokens of one document together.

Written rather than read twice, because a token's order is that of one scan: a
second scan may be split otherwise when executors come or go.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cubewise.schemas import UNIT_LABEL
from cubewise.session import scratch_path
from cubewise.sources.jsonstat import CENTRE_COLUMNS, _counted, _indexed, _labelled, _prepared, parse_documents, validate_jsonstat

# A power of two: no chunk then holds tokens of two tasks.
CHUNK = 1 << 16
# The key before an array. Inside a JSON string its quotes would be escaped.
OPENS = r'(?<!\\)"value"\s*:\s*\['
CELL = r"^\s*(-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][-+]?[0-9]+)?|null|NaN)\s*$"
PLACE = ["doc", "block", "chunk"]


def store_tokens(spark: SparkSession, path: str | list[str], chunk: int = CHUNK) -> DataFrame:
    """Files -> stored (doc, block, chunk, seq, token): the text between commas, by the
    file's byte range (``block``) and a number rising within it."""
    tokens = spark.read.option("lineSep", ",").text(path).select(
        F.col("_metadata.file_path").alias("doc"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"), F.col("value").alias("token"))
    target = scratch_path(spark, "cube_tokens")
    tokens.withColumn("chunk", F.shiftright("seq", chunk.bit_length() - 1)).write.parquet(target)
    return spark.read.parquet(target)


def _behind_opening() -> Column:
    return F.regexp_replace("token", f"(?s)^.*{OPENS}", "")


def place_chunks(tokens: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Where the chunks and the array of cells lie.

    (doc, block, chunk, first, base, opens, closes) for documents with exactly one
    array ``value``: the chunk's first ``seq``, the place of that token in the document,
    the places of the tokens that open and close the array. The others are returned as
    (doc, reject_reason)."""
    opening = F.col("token").rlike(OPENS)
    # In the opening token only a bracket behind the opening one closes.
    closing = F.when(opening, _behind_opening()).otherwise(F.col("token")).contains("]")
    chunks = tokens.groupBy(*PLACE).agg(
        F.min("seq").alias("first"), F.count("*").alias("n"),
        F.sum(F.when(opening, F.size(F.split("token", OPENS)) - 1)).alias("arrays"),
        F.min(F.when(opening, F.col("seq"))).alias("open_seq"),
        F.collect_set(F.when(closing, F.col("seq"))).alias("close_seqs"))
    along = Window.partitionBy("doc").orderBy("block", "chunk")
    target = scratch_path(tokens.sparkSession, "cube_chunks")
    (chunks.withColumn("base", F.sum("n").over(along) - F.col("n"))
     .withColumn("opens", F.col("base") + F.col("open_seq") - F.col("first"))
     .withColumn("close_places", F.transform("close_seqs", lambda s: F.col("base") + s - F.col("first")))
     .write.parquet(target))
    placed = tokens.sparkSession.read.parquet(target)
    documents = placed.groupBy("doc").agg(F.coalesce(F.sum("arrays"), F.lit(0)).alias("arrays"), F.min("opens").alias("opens"))
    closes = (placed.select("doc", F.explode("close_places").alias("place")).join(documents, "doc")
              .where("place >= opens").groupBy("doc").agg(F.min("place").alias("closes")))
    shaped = documents.join(closes, "doc", "left")
    reason = (F.when(F.col("arrays") == 0, F.lit("no array of values"))
              .when(F.col("arrays") > 1, F.lit("several arrays of values"))
              .when(F.col("closes").isNull(), F.lit("values end too early")))
    rejected = shaped.select("doc", reason.alias("reject_reason")).where("reject_reason is not null")
    whole = shaped.where(reason.isNull()).select("doc", "opens", "closes")
    return placed.select(*PLACE, "first", "base").join(whole, "doc"), rejected


def split_tokens(tokens: DataFrame, chunks: DataFrame) -> DataFrame:
    """Tokens with their ``place``, the ``cell`` they hold (NULL: none) and the ``rest``,
    the text outside the array (NULL: none)."""
    at_open, at_close = F.col("place") == F.col("opens"), F.col("place") == F.col("closes")
    inner = F.when(at_open, _behind_opening()).otherwise(F.col("token"))
    cell = F.when(F.col("place").between(F.col("opens"), F.col("closes")),
                  F.when(at_close, F.substring_index(inner, "]", 1)).otherwise(inner))
    before = F.regexp_extract("token", f"(?s)^(.*{OPENS})", 1)
    behind = F.expr("substr(inner, instr(inner, ']'))")
    rest = (F.when(at_open & at_close, F.concat(before, behind)).when(at_open, before).when(at_close, behind)
            .when(~F.col("place").between(F.col("opens"), F.col("closes")), F.col("token")))
    # An array without cells is one blank token.
    empty = at_open & at_close & (F.trim("cell") == "")
    return (tokens.join(chunks, PLACE).withColumn("place", F.col("base") + F.col("seq") - F.col("first"))
            .withColumn("inner", inner).withColumn("cell", cell).withColumn("rest", rest)
            .withColumn("cell", F.when(~empty, F.col("cell"))).drop("inner", "token"))


def whole_shells(split: DataFrame) -> DataFrame:
    """(doc, json): the documents with an empty ``value``."""
    ordered = F.sort_array(F.collect_list(F.struct("place", "rest", "closes", "opens")))
    parts = split.where("rest is not null").groupBy("doc").agg(ordered.alias("parts"))
    # The opening and the closing token join without a comma: the cells between are gone.
    text = F.aggregate("parts", F.lit(""), lambda acc, p: F.concat(
        acc, F.when((p["place"] == 0) | ((p["place"] == p["closes"]) & (p["closes"] > p["opens"])), F.lit("")).otherwise(F.lit(",")),
        p["rest"]))
    return parts.select("doc", text.alias("json"))


def read_jsonstat_split(spark: SparkSession, path: str | list[str], columns: Sequence[str] = tuple(CENTRE_COLUMNS),
                        chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """Landed JSON-stat documents, one a file -> (long rows, rejected documents).

    The rows of ``jsonstat.read_jsonstat``, for cubes too large for one task. Cells
    are numbers, null or NaN; a document with another cell is rejected as a whole,
    as there. So are documents without an array ``value``, or with several of
    that name anywhere in them, because the pieces do not tell how deep they lie.
    Spark's readers pass over empty files.
    """
    tokens = store_tokens(spark, path, chunk)
    chunks, unshaped = place_chunks(tokens)
    split = split_tokens(tokens, chunks)
    bad = (split.where(F.col("cell").isNotNull() & ~F.col("cell").rlike(CELL)).groupBy("doc")
           .agg(F.count("*").alias("n")).select("doc", F.lit("malformed-document").alias("reject_reason")))
    valid, unread = validate_jsonstat(parse_documents(whole_shells(split)))
    figures = valid.join(bad, "doc", "left_anti")
    labelled = _prepared(figures, columns).drop("value").join(chunks.select(*PLACE), "doc")
    cells = (split.where("cell is not null").select(*PLACE, "cell", (F.col("place") - F.col("opens")).alias("pos"))
             .join(labelled, PLACE).where(F.col("pos") < F.col("n_cells")).drop("block", "chunk"))
    value = F.when(F.trim("cell") != "null", F.trim("cell").try_cast("double"))
    rows = _indexed(cells, columns).select(*_labelled(columns), F.lit(UNIT_LABEL).alias("UNIT"), _counted(value).alias("VALUE"))
    rejected = unshaped.unionByName(bad).unionByName(unread.join(bad, "doc", "left_anti"))
    return rows, rejected
