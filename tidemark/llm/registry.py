"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    cover_tree, importance_resampling, language_mixture, packing, permutation_index, pii_surrogates, piece_bpe,
    quality_gbdt, scaled_sketch, simhash_golay, token_alignment, token_frames, url_logistic,
)
from tidemark.llm.common import bounded_sample, doc_crc, shared_path, table

BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"
URL_RULES = (
    url_logistic.Rule("allow", "com/"), url_logistic.Rule("block", "example.com/en/"),
    url_logistic.Rule("allow", "www.example.com/en/"), url_logistic.Rule("block", "net/es/"),
    url_logistic.Rule("block", "net/fr/"),
)


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_cover_tree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five highest integer inner products per query (vec_id % 50 = 0)."""
    return cover_tree.top_inner_products(table(spark, sf_dir, "embeddings"), every=50, k=5)


def op2_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest found per query (vec_id % 100 = 0)."""
    return permutation_index.nearest(table(spark, sf_dir, "embeddings"), every=100, k=10)


def quality_trees(docs: DataFrame, labels: DataFrame) -> quality_gbdt.Trees:
    return quality_gbdt.learn(docs, labels.where(F.coalesce(doc_crc(), F.lit(1)) % 5 != 0))


def op3_quality_gbdt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality_gbdt.predict(docs, quality_trees(docs, table(spark, sf_dir, "labels")))
    held_out = F.coalesce(doc_crc() % 5 == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op4_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash_golay.near_copies(table(spark, sf_dir, "documents"))


def op5_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its entities replaced."""
    docs = table(spark, sf_dir, "documents")
    return pii_surrogates.replace_entities(docs).select(
        "doc_id", "text", F.size("entities").alias("n_entities"), "entities")


def op6_url_logistic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url. The small labelled table: a bounded sample
    of urls that a rule decides, labelled with that verdict."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    ruled = url_logistic.judge_by_rules(pages, URL_RULES).where("ruled is not null")
    labelled = bounded_sample(ruled.select("url", (F.col("ruled") == "block").cast("int").alias("label")),
                              "url", url_logistic.LABELLED_ROWS)
    model = url_logistic.learn(labelled)
    return url_logistic.filter_urls(pages, URL_RULES, model).select(
        "page_id", "host", "path", "rule", "verdict", "block_probability")


def op7_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document and the text they decode to, as digests."""
    return piece_bpe.encode_table(table(spark, sf_dir, "documents"), tokenizer_file(PIECE_BPE), digest=True)


def language_model(docs: DataFrame) -> language_mixture.Model:
    return language_mixture.learn(docs.where(F.coalesce(doc_crc(), F.lit(0)) % 3 != 1))


def op8_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = table(spark, sf_dir, "documents")
    found = language_mixture.predict(docs.select("doc_id", "text"), language_model(docs))
    return found.select("doc_id", F.coalesce(doc_crc() % 3 == 1, F.lit(False)).alias("held_out"),
                        "lang_pred", "score", "langs", "shares")


def op9_token_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, written and read back."""
    path = shared_path(spark, "token-frames")
    manifest = token_frames.write_token_files(
        table(spark, sf_dir, "documents"), path, tokenizer_file(BYTE_BPE), end_id=2)
    return token_frames.read_token_files(spark, path, manifest, digest=True)


def op10_config_lp_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file(BYTE_BPE), 2048, end_id=0)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between the tokens of two tokenizers in every document."""
    return token_alignment.align_table(
        table(spark, sf_dir, "documents"), tokenizer_file(BYTE_BPE), tokenizer_file(PIECE_BPE))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance weight of every document for the benchmark's distribution,
    and the draw of 5 % of them."""
    return importance_resampling.resample(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_features", "weight", "score", "rank", "n_words")


def op13_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return scaled_sketch.edited_table(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline (corpus_pipeline.py) over documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_cover_tree_topk, op2_permutation_index, op3_quality_gbdt, op4_simhash_golay, op5_pii_surrogates,
    op6_url_logistic, op7_piece_bpe, op8_language_mixture, op9_token_frames, op10_config_lp_packing,
    op11_token_alignment, op12_importance_resampling, op13_scaled_sketch, pipeline)}

ORACLE = {
    "op1_cover_tree_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT q.vec_id AS query_id, d.vec_id, list_dot_product(q.v, d.v)::BIGINT AS score
            FROM (SELECT * FROM v WHERE vec_id % 50 = 0) q JOIN v d ON d.vec_id <> q.vec_id AND len(d.v) = len(q.v)),
        r AS (
            SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank,
                   vec_id, score FROM s)
        SELECT * FROM r WHERE rank <= 5
    """,
}
