"""Registered queries of the corpus operators, with their production parameters."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.llm.alignment import token_alignment
from scoreloom.llm.decontaminate import contamination
from scoreloom.llm.embedding_dedup import embedding_links
from scoreloom.llm.jaccard_join import jaccard_components
from scoreloom.llm.mixing import mix_sources
from scoreloom.llm.oracles import contamination_sql, embeddings_sql, jaccard_sql, linked_urls_sql, spelling_sql, urls_sql
from scoreloom.llm.quality import quality_scores, train_quality
from scoreloom.llm.repeats import repeated_passages
from scoreloom.llm.secret_scan import KINDS, listed, markov_samples, secret_spans, train_markov
from scoreloom.llm.spelling import spelling_forms, vocabulary
from scoreloom.llm.token_counts import token_counts
from scoreloom.llm.toxicity import toxicity_scores, train_toxicity
from scoreloom.llm.url_filter import judge_urls
from scoreloom.llm.warc import captures_of_pages, resolve_revisits

# Fewer rounds than by default, for the query over a derived web.
LINK_DAMPING, LINK_TOLERANCE = 0.6, 1e-4

# Rules of the url filter: verdict, host, path.
URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document under the word-level BPE of the public tokenizers."""
    import public_tokenizers

    file = Path(public_tokenizers.path("word_bpe_49k.json")).read_text(encoding="utf-8")
    return token_counts(_table(spark, folder, "documents"), file, limit=2048)


def op2_secret_spans(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in every document by pattern and by character models."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    found = secret_spans(docs, train_markov(markov_samples(docs)))
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = '{k}')) as long)").alias(f"n_{k}") for k, *_ in KINDS]
    return found.select("doc_id", *counts, F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))


def op3_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate component of every document: 4 words, similarity 0.85."""
    return jaccard_components(_table(spark, folder, "documents"), words=4, percent=85)


def op4_revisit_resolution(spark: SparkSession, folder: str) -> DataFrame:
    """Revisits of a crawl derived from ``pages``, resolved to full responses."""
    return resolve_revisits(captures_of_pages(_table(spark, folder, "pages")))


def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on every page's url by rules, and by trust over host links."""
    return judge_urls(_table(spark, folder, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def url_trust_over_links(spark: SparkSession, folder: str) -> DataFrame:
    """The url filter over ``pages`` as a web of one host each, which links to the next page's and to that of half its id."""
    pages = _table(spark, folder, "pages").select("page_id", "url")
    host = F.regexp_extract("url", "://([^/?#]*)", 1)
    link = F.concat(F.lit('<a href="//n'), F.col("page_id").cast("string"), F.lit("."), host, F.lit('/">x</a>'))
    targets = pages.select(F.col("page_id").alias("target"), link.alias("link"))
    ids = pages.select("page_id", F.explode(F.array_distinct(F.array(F.col("page_id") + 1, F.expr("page_id div 2")))).alias("target"))
    html = ids.where("page_id <> target").join(targets, "target").groupBy("page_id").agg(F.array_join(F.collect_set("link"), "").alias("html"))
    url = F.replace("url", F.lit("://"), F.concat(F.lit("://n"), F.col("page_id").cast("string"), F.lit(".")))
    web = pages.join(html, "page_id", "left").withColumn("url", url)
    judged = judge_urls(web, URL_RULES, damping=LINK_DAMPING, tolerance=LINK_TOLERANCE)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def held_out(doc_id: str = "doc_id", parts: int = 3, part: int = 1) -> Column:
    """Documents whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts == part, F.lit(False))


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document, learned from labels that are not held out."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    labels = _table(spark, folder, "labels").where(~held_out()).select("doc_id", "toxic")
    return toxicity_scores(docs, train_toxicity(docs, labels)).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op7_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Words that a mix of 150% takes from every document, sources weighing 3, 1, 2 in turn."""
    return mix_sources(_table(spark, folder, "documents"))


def op8_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate component of every embedding within its label, cosine 0.98."""
    return embedding_links(_table(spark, folder, "embeddings"), threshold=0.98)


def op9_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold passages of 50 words or more that occur elsewhere too."""
    return repeated_passages(_table(spark, folder, "documents"), min_words=50)


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark windows of 10 words in every document."""
    found = contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"), window=10)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Words of all documents with the near word they are a variant of."""
    return spelling_forms(vocabulary(_table(spark, folder, "documents")))


def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Byte-level BPE tokens of every document aligned with sentencepiece tokens."""
    import public_tokenizers

    file_a = Path(public_tokenizers.path("byte_bpe_50k.json")).read_text(encoding="utf-8")
    model_b = Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes()
    return token_alignment(_table(spark, folder, "documents"), file_a, model_b)


def op13_quality_ranking(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document, learned from pairs of labels that are not held out."""
    docs, held = _table(spark, folder, "documents").select("doc_id", "text"), held_out(parts=4, part=2)
    labels = _table(spark, folder, "labels").where(~held).select("doc_id", "quality")
    return quality_scores(docs, train_quality(docs, labels)).select("doc_id", held.alias("held_out"), "score", "predicted")


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_token_counts,
            op2_secret_spans,
            op3_jaccard_join,
            op4_revisit_resolution,
            op5_url_filter,
            url_trust_over_links,
            op6_toxicity,
            op7_source_mixing,
            op8_embedding_dedup,
            op9_repeated_passages,
            op10_decontamination,
            op11_spelling_variants,
            op12_token_alignment,
            op13_quality_ranking,
        )
    }


def llm_oracles() -> dict[str, str]:
    """SQL of the queries that SQL can express; the others are tested against plain Python."""
    return {
        "op3_jaccard_join": jaccard_sql(),
        "op5_url_filter": urls_sql(URL_RULES),
        "url_trust_over_links": linked_urls_sql(URL_RULES, LINK_DAMPING, LINK_TOLERANCE),
        "op8_embedding_dedup": embeddings_sql(),
        "op10_decontamination": contamination_sql(),
        "op11_spelling_variants": spelling_sql(),
    }
