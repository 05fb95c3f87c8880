"""The corpus pipeline: from documents to shards of a mixed, clean corpus.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it
kept. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketflow.llm import deobfuscation, mixing, spaced_seeds, splitters, tensor_minhash
from marketflow.llm.common import table
from marketflow.session import new_path

SHARDS = 16
#: target shares of tokens: prose, toxic, poor
TARGETS = [0.92, 0.0, 0.08]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose restored text scores below the threshold; the labels of all ids may be learnt from."""
    model = deobfuscation.fit(docs, table(spark, sf_dir, "labels"), folds=1, held_out=1)
    return deobfuscation.clean(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its five-word shingles."""
    return tensor_minhash.keep_one_each(docs, size=5, percent=80)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return spaced_seeds.decontaminate(docs, table(spark, sf_dir, "benchmark"), least_tokens=1)


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rates say: none is lost, prose repeats until it holds its share of tokens."""
    labelled = table(spark, sf_dir, "labels").select("doc_id", mixing.domain_of_labels().alias("label"))
    return mixing.mix(docs, labelled, TARGETS, least=1.0, most=4.0)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot: shards of equal bytes in the order of doc_id."""
    return splitters.shard_documents(docs, SHARDS).select("doc_id", "size", "text_crc32", "shard", "slot")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_to_targets),
    ("sharding", shard),
]

# trained classifiers decide two of the stages; SQL can't express them
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
