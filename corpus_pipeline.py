"""A corpus pipeline of five stages; each reads what the one before it has written."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silvertide.llm import decontaminate, mixing, simhash, slots, toxicity
from silvertide.llm.shared import materialize, set_aside


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold.

    Null and empty texts get the base rate of the examples. Repeated rows are scored alike and stay repeated; rows keep all
    their columns, also those named like the score or its evidence. An empty table stays empty; without labels nothing goes.
    """
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    renamed, columns = set_aside(docs, ("toxicity", "evidence"))
    return toxicity.score(renamed, model).where(F.col("toxicity") < toxicity.THRESHOLD).select(*columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one whose id names the component.

    Null and empty texts are one group. Null ids come last. Of rows with equal id and text the one with the least hash of
    the whole row stays. Columns of any name keep their values; an empty table stays empty.
    """
    return simhash.representatives(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with the benchmark.

    Null and empty texts share none, nor does anything with null or empty items. Repeated rows stay repeated; columns named like
    those of the marks keep their values. An empty table stays empty, and an empty benchmark keeps all.
    """
    renamed, columns = set_aside(docs, ("n_words", "hit_ranges", "hit_items"))
    marked = decontaminate.decontaminate(renamed, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return marked.where(F.size("hit_ranges") == 0).select(*columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mix takes it: never, once or twice.

    Null and empty texts have no words and are not taken. A null source is a source, the last. Repeated rows are taken one by
    one, equal lengths by a seeded hash. Columns of any name keep their values; an empty table stays empty.
    """
    return mixing.taken_documents(docs)


def place_in_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every row: shard and position in it, by the map of slots that is stored for this corpus.

    Null texts count as empty, null ids as a value of their own; repeated rows have places of their own. Other columns are
    left out; an empty table gives no place. A later run over the same folder uses the stored map, and edits it where the
    shards have become uneven.
    """
    maps = slots.map_folder(spark, f"pipeline-{hashlib.sha256(sf_dir.encode()).hexdigest()[:16]}")
    return slots.shard_documents(docs, maps=maps).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "virtual_slot")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("mix", mix_sources),
    ("shard", place_in_shards),
]

#: The scores of the first stage come from a fitted model; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each one's result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
