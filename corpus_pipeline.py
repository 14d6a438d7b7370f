"""From raw documents to packed sequences.

Stages take and return documents; each works on what the one before it kept, as written and read
again. A document is known by its ``doc_id``: rows that share one share the decisions of all stages
but exact dedup, which tells them apart by text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm.exact_dedup import exact_dedup
from spanloom.llm.jaccard_join import jaccard_components
from spanloom.llm.mixing import repeat_documents
from spanloom.llm.packing import pack_documents
from spanloom.llm.quality import quality_rules
from spanloom.llm.words import small_batches
from spanloom.operators.joins import checked_join, free_names
from spanloom.operators.lineage import cut_lineage

# Keys of rejected rows are broadcast up to this measured size, else joined by a shuffle.
MAX_BROADCAST_BYTES, SALTS = 16 << 20, 32
# Workers stay alive between stages, so packing holds fewer words and bytes here than on its own.
CACHED_CHUNKS, SLICE_BYTES = 200_000, 1 << 20
# Near copies: sets of five words, of which two share 80 percent or more.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def _key(text: Column | None = None) -> Column:
    """A document's id as text, with its text's digest when rows of one id are told apart."""
    own = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    return own if text is None else F.concat(own, F.lit(":"), text)


def _joined(marked: DataFrame, keys: DataFrame, key: str, how: str) -> DataFrame:
    return checked_join(marked, keys, [key], [key, "text"], how, MAX_BROADCAST_BYTES, SALTS)


def _without(docs: DataFrame, decisions: DataFrame, kept: Column) -> DataFrame:
    """The rows of ``docs`` but those of ids that have no row ``kept`` in ``decisions``."""
    (key,) = free_names(docs.columns, "_key")
    found = decisions.groupBy(_key().alias(key)).agg(F.max(kept).alias("kept"))
    rejected = cut_lineage(found.filter("not kept").select(key))
    return _joined(docs.select(*docs.columns, _key().alias(key)), rejected, key, "left_anti").drop(key)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; an id goes when all its rows are rejected."""
    return _without(docs, quality_rules(docs), F.col("kept"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id; of rows that share text and id, one."""
    (key,) = free_names(docs.columns, "_key")
    found = exact_dedup(docs).groupBy(_key(F.col("text_sha256")).alias(key))
    keys = cut_lineage(found.agg(F.max("kept").alias("kept"), F.count("*").alias("n")))
    text = F.sha2(F.coalesce("text", F.lit("")), 256)
    marked = docs.select(*docs.columns, _key(text).alias(key))
    kept = _joined(marked, keys.filter("not kept").select(key), key, "left_anti")
    tied = keys.filter("kept and n > 1").select(key)
    alone = _joined(kept, tied, key, "left_anti")
    first = _joined(kept, tied, key, "left_semi").dropDuplicates([key])
    return alone.unionByName(first).drop(key)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents the one with the least id."""
    least = F.col("doc_id").eqNullSafe(F.col("component_id"))
    with small_batches(spark):
        return _without(docs, jaccard_components(docs, NEAR_WORDS, NEAR_PERCENT), least)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it; documents without words are not taken."""
    return repeat_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences."""
    with small_batches(spark):
        return pack_documents(docs, cached_chunks=CACHED_CHUNKS, slice_bytes=SLICE_BYTES)


STAGES = [
    ("quality rules", quality),
    ("exact dedup", exact),
    ("near dedup", near),
    ("source mixing", mix),
    ("packing", pack),
]

# Tokens, robust estimates and components are not expressed in SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for position, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if position + 1 < len(STAGES):
            docs = cut_lineage(docs)
    return docs
