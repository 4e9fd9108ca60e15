"""The training-corpus pipeline: the stages a raw document table goes through, in order.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the last return the
columns of ``documents``. An empty table passes every stage empty; further columns are carried along, whatever their
names. What each stage does with nulls, empty texts, ties and repeated rows stands with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from widelines.llm import decontaminate, mixing, near_dup, quality, sharding
from widelines.llm.storage import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go. Null and empty texts have no words and go; repeated rows are judged
    alike; null ids don't matter."""
    return quality.keep_good(docs)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one of the smallest id: five-word shingles, similarity 0.8
    or more (exactly 0.8 counts). Texts without words are near to nothing and stay; so do rows without an id, which
    name no document; rows that share an id are one document and stay or go together."""
    return near_dup.keep_one(docs, size=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go of whose words at least one in twenty (exactly one included) lies in a window of a benchmark item.
    Null and empty texts stay, and null items match nothing; repeated rows are judged alike."""
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, so that every source comes near its target of words. Documents
    without words take no part and go; a null source is one of its own; repeated rows are drawn each for itself."""
    return mixing.mixed_documents(docs)


def maglev_sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its slot and shard, by its id (without one, by its text); rows of one id share a shard."""
    return sharding.placed(docs, sharding.document_key())


STAGES = [
    ("quality_rules", quality_rules),
    ("minhash_near_dedup", minhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("maglev_sharding", maglev_sharding),
]

#: Not expressible as one SQL statement of reasonable size; tested on edge rows, not yet against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
