"""The registered queries of this subpackage: each operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read
from .decontam import contaminated
from .fill_middle import fill_middle, restored
from .license_scan import license_scan
from .line_dedup import line_dedup
from .mixing import mix_sources, n_words, taken
from .neighbours import build_index, search_index
from .ngram_join import jaccard_groups
from .quality_rules import quality_rules
from .resampling import resample
from .sharding import shard
from .sql import SQL  # noqa: F401  (the driver entry reads it here)
from .token_count import token_counts
from .toxicity import held_out, toxicity, train
from .url_filter import url_filter

#: The rules of the url contract.
URL_RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
#: The mix: languages' weights inside every domain, share of all tokens, and epochs at most.
MIX = {"share": 0.8, "epochs": 2, "weights": {f"domain{d}/{lang}": w for d in range(4) for lang, w in (("en", 4.0), ("de", 2.0), ("fr", 2.0), ("es", 1.0))}}
TOKENIZER = "piece_bpe_32k.model"


def domain_of_source(source: Column) -> Column:
    """Four domains, by the number at the end of a source's name; sources without one are in domain0."""
    number = F.coalesce(F.regexp_extract(source, r"(\d{1,9})$", 1).try_cast("int"), F.lit(0))
    return F.concat(F.lit("domain"), (number % 4).cast("string"))


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(read(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity(docs, train(docs, read(spark, sf_dir, "labels")))
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(read(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read(spark, sf_dir, "documents"))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(read(spark, sf_dir, "pages"), read(spark, sf_dir, "labels"), URL_RULES).drop("good_bound")


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    mixed = taken(mix_sources(docs, domain_of_source(F.col("source")), **MIX), epoch="epoch")
    return mixed.select("doc_id", domain_of_source(F.col("source")).alias("domain"), "lang", "source", "epoch", n_words(F.col("text")).alias("n_tokens"))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op9_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(read(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(read(spark, sf_dir, "documents"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle(read(spark, sf_dir, "documents").select("doc_id", "text"))
    digests = F.sha2(F.col("output").cast("binary"), 256), F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digests[0].alias("output_sha256"), digests[1].alias("restored_sha256"))


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    index = build_index(rows, "vec_id", "embedding")
    return search_index(index, rows.filter("vec_id % 50 = 0"), "vec_id", "embedding")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_ngram_jaccard_join, op2_token_counts, op3_toxicity, op4_line_dedup, op5_quality_rules, op6_url_filters, op7_source_mixing, op8_benchmark_decontamination, op9_license_scans, op10_sharding, op11_importance_resampling, op12_fill_in_middle, op13_nearest_neighbours)
    return {f.__name__: f for f in found}
