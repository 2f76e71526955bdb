"""The registered queries of the numbered operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slowdigest.llm.bpe import encode_documents
from slowdigest.llm.common import table
from slowdigest.llm.fingerprints import fingerprint_documents
from slowdigest.llm.histogram_shards import shard
from slowdigest.llm.knn_join import top_k
from slowdigest.llm.line_dedup import dedup_lines
from slowdigest.llm.lm_scoring import score_documents
from slowdigest.llm.ngram_join import jaccard_components
from slowdigest.llm.oracles import ORACLES
from slowdigest.llm.packing import pack
from slowdigest.llm.quality_rules import apply_rules
from slowdigest.llm.source_divergence import divergence
from slowdigest.llm.suffix_dedup import remove_repeated
from slowdigest.llm.url_filter import Rule, filter_urls
from slowdigest.llm.whitening import fit, identity_error, whiten

VOCABULARY = "byte_bpe_50k.json"
RULES = [
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
]
#: Verdicts for urls that no rule fits: programs and archives, and login pages.
GLOBS = [("block", g) for g in ("**.exe", "**.zip", "**.tar.gz", "**/login/**", "**/cgi-bin/**")]

#: Passages shorter than the 400 bytes of operator 10: from 250 bytes on (five a word with its blank), over 50 words.
PASSAGES = (250, 50)


def vocabulary(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", "text")


def op1_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    out = apply_rules(_documents(spark, sf), table(spark, sf, "labels"))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return out.select("doc_id", *base, "base_failed", "kept", "score")


def op2_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select("page_id", "url")
    return filter_urls(pages, RULES, GLOBS).select("page_id", "host", "path", "rule", "verdict")


def op3_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_components(_documents(spark, sf))


def op4_histogram_shards(spark: SparkSession, sf: str) -> DataFrame:
    out = shard(_documents(spark, sf), keep=["doc_id"])
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op5_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return pack(_documents(spark, sf), vocabulary())


def op6_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprint_documents(_documents(spark, sf))


def op7_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    out = dedup_lines(_documents(spark, sf))
    return out.select(
        "doc_id", "n_lines", "n_removed", "n_runs", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


def op8_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    return score_documents(_documents(spark, sf), table(spark, sf, "labels"))


def op9_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return encode_documents(_documents(spark, sf), vocabulary())


def op10_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return remove_repeated(_documents(spark, sf), digest=True, passages=PASSAGES)


def op11_exact_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return top_k(table(spark, sf, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 20 == 0)


def op12_source_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return divergence(table(spark, sf, "documents").select("text", "lang", "source"))


def op13_embedding_whitening(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "embeddings").select("vec_id", "embedding")
    model = fit(rows)
    explained = F.array(*(F.lit(v) for v in model.explained)) if model else F.array()
    out = whiten(rows, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return out.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n if model else 0).cast("long").alias("n"),
        # A long by contract; null beyond its range, where the operator's decimal still has it.
        F.col("deviation").try_cast("long").alias("deviation"),
        "whitened",
        F.get(explained, F.col("at")).cast("double").alias("explained"),
        F.lit(identity_error(rows, model) if model else 0.0).alias("identity_error"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_url_filter,
        op3_ngram_join,
        op4_histogram_shards,
        op5_best_fit_packing,
        op6_fingerprints,
        op7_line_dedup,
        op8_lm_scoring,
        op9_bpe,
        op10_suffix_dedup,
        op11_exact_top_k,
        op12_source_divergence,
        op13_embedding_whitening,
    )
}

__all__ = ["ORACLES", "QUERIES"]
