"""The corpus pipeline: quality rules, line dedup, near dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
every stage's result as Parquet in the shared checkpoint folder and reads it
back as the next one's documents.  All stages but the last return the columns
of ``documents``; the last returns the packed pieces.

Null and empty texts: the quality rules reject them (fewer than 50 words), so
later stages meet them only where a dedup empties a text; such documents stay.
An empty table goes through every stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from gasledger.llm import decontaminate, line_dedup, near_dedup, packing, quality_rules, tokens
from gasledger.llm.common import table
from gasledger.session import checkpoint_root


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects; cutoffs come from ``labels``."""
    return quality_rules.drop_rejected(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the runs of two and more lines that occur before; ``n_chars`` follows the text."""
    from pyspark.sql import functions as F

    out = line_dedup.drop_repeated_runs(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.length("text").cast(kind))
    return out.select(*docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, similarity 0.8)."""
    return near_dedup.drop_near_duplicates(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of ``benchmark``."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' ids in training sequences."""
    return packing.pack_documents(docs, tokens.default_path())


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("near_dedup", near),
          ("decontamination", clean), ("packing", pack)]

#: tokens and minwise hashes are beyond SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_root(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
