"""Registered queries of the operators, one per operator, with production parameters.

Each reads its whole table, has the operator do the work and only derives the
contract's columns from its output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from climastar.session import new_run_dir

from . import (
    bpe, decontaminate, fingerprints, html_extract, kdtree_topk, langid, maxent_lm, merkle_manifest, prefix_trie, simhash_dedup, suffix_dedup,
    url_filter, warc,
)
from .common import staged, table

# Fixed values of the contract.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]
#: Listed is every canonical URL that the crawl reached by a campaign link, one with a ``utm_`` parameter.
CAMPAIGN = r"^[^#]*[?&]utm_"


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    host, path = url_filter.url_host(F.col("url")), url_filter.url_path(F.col("url"))
    listed = (pages.where(F.col("url").rlike(CAMPAIGN))
              .select(url_filter.canonical(host, path).alias("url")))
    return (url_filter.url_filter(pages, listed, URL_RULES)
            .select("page_id", "host", "path", "rule", "verdict", "canonical_url", "listed"))


#: Lies with the tokenizer files of the installed package; never copied.
def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_distance=2)
    return found.select("doc_id", fingerprints.hex_of(F.col("fingerprint")).alias("fingerprint"), "component_id")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer_path())


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_run_dir(spark, "warc")
    warc.write_archives(warc.chunk_table(table(spark, sf_dir, "pages")), path)
    return warc.read_records(spark, path)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal_digests(table(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
            .groupBy("doc_id", "item_id").agg(F.max(F.struct("containment", "n_shared", "n_shingles")).alias("m"))
            .select("doc_id", "item_id", "m.n_shingles", "m.n_shared", "m.containment"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return langid.identify(docs).select("doc_id", "held_out", "lang_pred", "score")


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent_lm.score(table(spark, sf_dir, "documents"))


def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (html_extract.extract(table(spark, sf_dir, "pages"))
            .select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars")))


def op10_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = staged(fingerprints.edited_fingerprints(table(spark, sf_dir, "documents")), "fingerprints")
    # The search's query set: every document whose id is divisible by 20, against all.
    return fingerprints.count_neighbours(prints, F.col("doc_id") % 20 == 0, radius=3)


def op11_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kdtree_topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.manifest(table(spark, sf_dir, "documents"), tampered=merkle_manifest.every_third())


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = F.col("conv")
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"), base=conv - conv % 20,
                                   heads=F.crc32(conv.cast("string").cast("binary")) % 4, most=3)


QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_simhash_dedup": op2_simhash_dedup,
    "op3_html_extract": op3_html_extract,
    "op4_bpe": op4_bpe,
    "op5_warc": op5_warc,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_decontaminate": op7_decontaminate,
    "op8_language_id": op8_language_id,
    "op9_lm_score": op9_lm_score,
    "op10_document_fingerprints": op10_document_fingerprints,
    "op11_exact_topk": op11_exact_topk,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_prefix_trie": op13_prefix_trie,
}
