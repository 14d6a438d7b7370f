"""One query per corpus operator, over whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spanloom.llm.centroids import cluster_vectors
from spanloom.llm.conversations import damaged_repairs
from spanloom.llm.exact_dedup import exact_dedup
from spanloom.llm.jaccard_join import jaccard_components
from spanloom.llm.language import identify_languages
from spanloom.llm.mixing import mix_sources
from spanloom.llm.packing import pack_documents
from spanloom.llm.quality import quality_rules
from spanloom.llm.secrets import scan_secrets
from spanloom.llm.sharding import shard_documents
from spanloom.llm.sql import SQL, URL_RULES
from spanloom.llm.substring_dedup import remove_repeats
from spanloom.llm.suffix_dedup import remove_byte_repeats
from spanloom.llm.url_filters import UrlRule, filter_urls

__all__ = ["QUERIES", "SQL"]

RULES = [UrlRule(*rule) for rule in URL_RULES]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _of(operator, table: str = "documents"):
    return lambda spark, sf_dir: operator(_table(spark, sf_dir, table))



QUERIES = {
    "op1_substring_dedup": _of(lambda docs: remove_repeats(docs).drop("kept_text")),
    "op2_exact_dedup": _of(exact_dedup),
    "op3_secret_scans": _of(scan_secrets),
    "op4_ngram_jaccard_join": _of(jaccard_components),
    "op5_source_mixing": _of(mix_sources),
    "op6_suffix_array_dedup": _of(lambda docs: remove_byte_repeats(docs).drop("kept_bytes")),
    "op7_language_id": _of(identify_languages),
    "op8_best_fit_packing": _of(pack_documents),
    "op9_quality_rules": _of(quality_rules),
    "op10_url_filters": _of(lambda pages: filter_urls(pages, RULES), "pages"),
    "op11_centroid_clustering": _of(cluster_vectors, "embeddings"),
    "op12_conversation_repair": _of(damaged_repairs, "conversations"),
    "op13_sharding": _of(shard_documents),
}
