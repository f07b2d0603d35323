"""Corpus pipeline: quality rules, n-gram Jaccard join, benchmark decontamination, mixing, sharding.

Each stage takes all rows its predecessor kept and returns the columns of documents (the last adds
shard and slot). A driver that wants each stage on disk writes it between calls; ``run`` writes them
to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldline.llm.common import materialize, table
from foldline.llm.decontaminate import drop_contaminated
from foldline.llm.mixing import mix_documents
from foldline.llm.ngram_join import ngram_jaccard_join
from foldline.llm.quality import quality_filter
from foldline.llm.sharding import shard_documents


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_filter(docs)


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by shingle similarity: that of the smallest doc_id, ids that
    are null last. Each (doc_id, text) is judged by itself, so an id with two texts may keep both.

    Rows repeated with one doc_id and text stay once, the least by their other columns. Null and
    wordless texts are linked with nothing. An empty table stays empty; only doc_id and text are
    read, and columns of any other names come back as they are."""
    key = F.xxhash64("doc_id", "text").alias("key")
    groups = ngram_jaccard_join(docs.select(key, "text"), "key").select("key", "component_id").distinct()
    counted = docs.select(key, "doc_id").groupBy("key").agg(F.max("doc_id").alias("doc_id"), F.count("*").alias("n"))
    named = materialize(groups.join(counted, "key"), "distinct-groups")
    place = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("key"))
    first = named.groupBy("component_id").agg(F.min(place).alias("first"))
    dropped = named.join(first, "component_id").where(F.col("key") != F.col("first.key")).select("key")
    dropped = materialize(dropped, "distinct-dropped")
    repeated = named.where("n > 1").join(dropped, "key", "left_anti").select("key")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), key)
    kept = packed.join(dropped.union(repeated), "key", "left_anti").select("_row")
    if not repeated.isEmpty():
        kept = kept.union(packed.join(repeated, "key", "left_semi").groupBy("key").agg(F.min("_row").alias("_row")).select("_row"))
    return kept.select("_row.*")


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mix_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and slot."""
    return shard_documents(docs)


STAGES = [
    ("quality_rules", keep_quality),
    ("ngram_jaccard_join", keep_distinct),
    ("decontaminate", drop_benchmark),
    ("mix", mix_sources),
    ("shard", shard),
]

ORACLE_SQL = None  # the tests hold every stage against a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table at ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
