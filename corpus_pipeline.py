"""Corpus pipeline: documents through five operators, one after another.

STAGES lists (name, function). A function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents.

- language: documents without a language (``und``: null or without a letter)
  go.
- quality: documents scored under the classifier's threshold go.
- near_copies: of each SimHash component the document with the smallest
  doc_id stays.
- pii: entities are replaced by surrogates; no document goes.
- packing: every piece of every remaining document gets its place.

Null doc_ids: such rows have no label and rank after every id, in the table's
order; a component of them alone keeps its first row. Repeated rows of one doc_id are copies and
one of them stays; rows of one id with different texts stay when the id does.
Empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import language_mixture, packing, pii_surrogates, quality_gbdt, registry, simhash_golay
from tidemark.llm.common import stage, table


def _aside(docs: DataFrame, *names: str) -> DataFrame:
    """docs with columns of these names called something else meanwhile."""
    return docs.toDF(*(f"{c}__own" if c in names else c for c in docs.columns))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    own = _aside(docs, "lang_pred", "score", "langs", "shares")
    found = language_mixture.predict(own, registry.language_model(docs)).where("lang_pred <> 'und'")
    return found.select(*own.columns).toDF(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    own = _aside(docs, "score", "predicted")
    trees = registry.quality_trees(docs, table(spark, sf_dir, "labels"))
    return quality_gbdt.predict(own, trees).where("predicted = 1").select(*own.columns).toDF(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # A row without an id gets one of its own, after every other.
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(1 << 62) + F.monotonically_increasing_id())
    rows = docs.select(key.alias("_key"), F.sha2(F.col("text").cast("binary"), 256).alias("_text"),
                       F.struct(*docs.columns).alias("_doc"))
    found = simhash_golay.near_copies(docs.select(key.alias("doc_id"), "text"))
    kept = stage(found.where("doc_id = component_id").select(F.col("doc_id").alias("_key")).distinct(), "copy-kept")
    # One shuffle of the texts by id, at every size; repeated rows are dropped
    # where they lie.
    return (rows.join(kept.hint("merge"), "_key", "left_semi").dropDuplicates(["_key", "_text"])
            .select("_doc.*"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    own = _aside(docs, "entities")
    return pii_surrogates.replace_entities(own).select(*own.columns).toDF(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, registry.tokenizer_file(registry.BYTE_BPE), 2048, end_id=0)


STAGES = [("language", language), ("quality", quality), ("near_copies", near_copies), ("pii", pii), ("packing", pack)]

#: The stages are not SQL; tests/llm compares them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage_of in STAGES[:-1]:
        docs = stage(stage_of(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
