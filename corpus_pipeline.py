"""A training corpus from the documents table, stage by stage.

Each stage is one operator of ``cubewise.llm`` over all that the stage before
kept; ``run`` writes its result to the shared folder and reads it back as the next
stage's documents. All but the last keep the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cubewise.llm import exact_dedup, langid_crf, packing, pii, simhash
from cubewise.llm.common import by_name, by_number, read_table, stored, workers_import_package


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go, and those that no learned language accounts for:
    too small a share of their words, or of their letters' trigrams, by bounds from
    labelled rows that the model has not learned from. All labelled rows take part in the
    one or the other. If nothing can be learned (no labelled rows), all with a letter
    would be rejected for want of a model; then none is."""
    workers_import_package(spark)
    kept = langid_crf.identified_by_all(docs)
    return docs.where(F.col("text").rlike(r"\p{L}")) if kept is None else kept


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents equal up to white space the one with the smallest id stays."""
    workers_import_package(spark)
    return exact_dedup.kept_rows(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by near fingerprints the one with the smallest id stays."""
    workers_import_package(spark)
    return simhash.representatives(docs)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to surrogates; n_chars follows the new text."""
    workers_import_package(spark)
    text, n_chars = (f"_{docs.columns.index(c)}" for c in ("text", "n_chars"))
    changed = F.size("entities") > 0
    done = pii.surrogates(by_number(docs), text)
    return by_name(done.withColumn(n_chars, F.when(changed, F.char_length(text)).otherwise(F.col(n_chars)).cast(
        dict(docs.dtypes)["n_chars"])), docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces with their places in sequences."""
    workers_import_package(spark)
    # Workers that ran the stages before still hold their memories.
    return packing.pack_documents(docs, memory=250_000)


STAGES = [("language", language), ("exact", exact), ("near", near), ("private", private), ("packed", packed)]

# The conditional random field and the tokenizer have no SQL; tests/llm holds the
# stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for n, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
