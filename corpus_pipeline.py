"""The corpus pipeline: STAGES in their order, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import read, stage, unstage
from tidemark.llm.decontam import without_contaminated
from tidemark.llm.mixing import mix_sources, taken
from tidemark.llm.ngram_join import jaccard_groups
from tidemark.llm.queries import MIX, domain_of_source
from tidemark.llm.sharding import shard
from tidemark.llm.toxicity import toxicity, train


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score below 0.5. The model learns from the labelled rows of docs outside the held-out fold."""
    inner = docs.select(F.struct(*docs.columns).alias("row"), "text")
    return toxicity(inner, train(docs, read(spark, sf_dir, "labels"))).filter("score < 0.5").select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of similar ones: that of the smallest doc_id. Rows without doc_id or without words belong to
    no group and stay. Of rows with the same doc_id and text one stays; different texts of one doc_id are told apart."""
    row = ["doc_id", "k1", "k2"]
    groups = stage(jaccard_groups(docs, by_text=True), "groups")
    drop = groups.filter(~F.col("stays")).select(row).distinct()
    again = groups.filter("doc_id is not null").groupBy(row).count().filter("count > 1").select(row)

    def those(df: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        keys = keys.select([F.col(c).alias(f"_{c}") for c in row])
        return df.join(keys, (df["doc_id"] == keys["_doc_id"]) & (F.xxhash64(df["text"]) == keys["_k1"]) & (F.hash(df["text"]) == keys["_k2"]), how)

    once = those(docs, drop.unionByName(again).distinct(), "left_anti")
    more = those(those(docs, again, "left_semi"), drop, "left_anti").dropDuplicates(["doc_id", "text"])
    return once.unionByName(more)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, word for word or re-parameterised."""
    return without_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources by the weights of MIX; a document that two epochs take is there twice."""
    return taken(mix_sources(docs, domain_of_source(F.col("source")), **MIX))


def to_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row's shard and slot, with its text, language and source."""
    return shard(docs, carry=("text", "lang", "source"))


STAGES = [("toxicity", drop_toxic), ("ngram_jaccard_join", drop_near_copies), ("benchmark_decontamination", drop_benchmark), ("source_mixing", mix), ("sharding", to_shards)]

#: SQL can express neither the trained model nor the similarity join at a bearable cost.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs, last = read(spark, sf_dir, "documents"), None
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
        unstage(last)
        last = docs
    return docs
