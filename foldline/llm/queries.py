"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .common import table
from .decontaminate import find_items
from .language_id import identify_language
from .language_model import score_documents
from .mixing import mix_report
from .ngram_join import ngram_jaccard_join
from .oracles import ORACLE_SQL  # noqa: F401
from .pii import pii_report
from .quality import quality_report
from .sharding import shard_report
from .site_tree import extract_main_text
from .spelling import spelling_variants
from .token_files import token_round_trip
from .warc import warc_round_trip
from .whitening import whitening_report


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a fair-queued mix of all documents takes of each."""
    return mix_report(table(spark, sf_dir, "documents"))


def op2_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents on a bounded ring of 40 shards; law rows."""
    return shard_report(table(spark, sf_dir, "documents"))


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every whole page."""
    return extract_main_text(table(spark, sf_dir, "pages"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole document: base counts and digest, and all spans."""
    return pii_report(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC records, read back from the archives."""
    return warc_round_trip(table(spark, sf_dir, "pages"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items whose 5-word shingles lie to 75 % or more in a document: one row a pair."""
    return find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probability of every whole document under a recurrent language model."""
    return score_documents(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every whole document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality_report(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of whole documents linked by a 5-word-shingle similarity of 0.75 or more."""
    return ngram_jaccard_join(table(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written as Simple-8b files and read back."""
    return token_round_trip(table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings whitened on the 16 leading components of the distinct vectors."""
    return whitening_report(table(spark, sf_dir, "embeddings"))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole document, by known words first, then by character n-grams."""
    return identify_language(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of whole documents, their near words and the frequent forms they stand for."""
    return spelling_variants(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_mix": op1_mix,
    "op2_shard": op2_shard,
    "op3_main_text": op3_main_text,
    "op4_pii": op4_pii,
    "op5_warc": op5_warc,
    "op6_decontaminate": op6_decontaminate,
    "op7_lm_score": op7_lm_score,
    "op8_quality_rules": op8_quality_rules,
    "op9_ngram_jaccard_join": op9_ngram_jaccard_join,
    "op10_token_files": op10_token_files,
    "op11_whitening": op11_whitening,
    "op12_language_id": op12_language_id,
    "op13_spelling_variants": op13_spelling_variants,
}
