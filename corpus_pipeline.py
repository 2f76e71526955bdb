"""A training corpus from raw documents, stage by stage.

Each stage takes what the one before kept and returns the columns of documents, but for the last, which
returns the packed pieces. Null and empty texts fail the quality rules; a stage given them by itself keeps them.
An empty table gives an empty result. Columns of any name beside doc_id and text pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slowdigest.llm.common import fresh, quoted, staged, table
from slowdigest.llm.line_dedup import dedup_lines
from slowdigest.llm.ngram_join import jaccard_components
from slowdigest.llm.packing import pack
from slowdigest.llm.quality_rules import apply_rules
from slowdigest.llm.queries import vocabulary
from slowdigest.llm.suffix_dedup import remove_repeated


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality rules reject."""
    return apply_rules(docs, table(spark, sf_dir, "labels")).filter("kept").select(*quoted(docs.columns))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Delete later repeats of runs of lines; ``n_chars`` follows the text."""
    return _sized(dedup_lines(docs).select(*quoted(docs.columns)))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each component, null ids last; all without shingles stay.

    Rows are known by a hash of id and text, so rows that share an id, or have none, are judged by their own text.
    Of rows equal in both, one stays.
    """
    key, has, own = fresh(docs, "row_key"), fresh(docs, "has_shingles"), F.xxhash64("doc_id", "text")
    keyed = docs.withColumn(key, own)
    found = staged(
        jaccard_components(docs.select(own.alias("doc_id"), "text"))
        .groupBy(F.col("doc_id").alias(key), "component_id")
        .agg(F.max(F.coalesce("n_shingles", F.lit(0)) > 0).alias(has), F.count("*").alias("n"))
    )
    ranked = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col(key))
    first = (
        keyed.select("doc_id", key)
        .distinct()
        .join(found.filter(has), key)
        .groupBy("component_id")
        .agg(F.min(ranked)[key].alias(key))
    )
    stay = first.select(key, F.lit(True).alias(has)).union(found.filter(~F.col(has)).select(key, has))
    kept = keyed.join(stay, key)
    if found.filter(F.col(has) & (F.col("n") > 1)).limit(1).count():
        kept = kept.filter(has).dropDuplicates([key]).unionByName(kept.filter(~F.col(has)))
    return kept.select(*quoted(docs.columns))


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut strings of 400 bytes that started earlier too; the first occurrence of a passage stays."""
    return _sized(remove_repeated(docs, keep_first=True).select(*quoted(docs.columns)))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 tokens."""
    return pack(docs, vocabulary())


def _sized(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(kind))


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_copies),
    ("suffix-array dedup", repeats),
    ("best-fit packing", packing),
]

#: Hashed models, byte strings and packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n + 1 < len(STAGES):
            docs = staged(docs)
    return docs
