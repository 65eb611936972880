"""Corpus preparation: five stages over documents, each written before the next one reads it.

Every stage takes (spark, docs, sf_dir) and works on all rows of `docs`. The first four return the
columns of documents; the last one adds the mixing rate and the number of copies of each document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotscout.llm.decontaminate import find_benchmark
from lotscout.llm.line_dedup import drop_repeated_chunks
from lotscout.llm.mixing import mixed
from lotscout.llm.quality_classifier import scored, trained
from lotscout.llm.queries import table
from lotscout.llm.simhash import near_duplicates
from lotscout.sources.snapshot import stage_table


# Poor documents are gone by then; what is left of that domain has no target.
MIXTURE = {"clean": 0.97, "toxic": 0.03}


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores 0.5 or more."""
    machine = trained(docs, table(spark, sf_dir, "labels"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), "text")
    good = scored(rows, machine, ["row"]).where(F.col("score") >= 0.5)
    return good.select("row.*")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the chunks of lines that stand elsewhere first."""
    return drop_repeated_chunks(docs).select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one that names the group.

    Of rows that share that doc_id, one stays; documents without an id stand for themselves.
    """
    named = near_duplicates(docs)
    ids = named.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    ids = stage_table(ids, "representatives")
    kept = docs.join(ids, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.unionByName(docs.where(F.col("doc_id").isNull())).select(*docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window; rows with one doc_id and text are one document.

    The index carries only what names a document, and the few that are hit are joined back.
    """
    named = docs.select(F.col("doc_id").alias("hit_id"), F.md5("text").alias("hit_digest"), "text")
    found = find_benchmark(named, table(spark, sf_dir, "benchmark"))
    hit = stage_table(found.where(F.col("n_hit") > 0).select("hit_id", "hit_digest").distinct(), "hit-documents")
    same = docs["doc_id"].eqNullSafe(hit["hit_id"]) & (F.md5(docs["text"]) == hit["hit_digest"])
    return docs.join(hit, same, "left_anti")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their rate and copies; those without a copy are out of the mixture."""
    out = mixed(docs, table(spark, sf_dir, "labels"), docs.columns, MIXTURE)
    return out.where(F.col("copies") > 0)


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_lines),
    ("simhash near-dedup", keep_one_of_each),
    ("benchmark decontamination", drop_benchmark),
    ("source mixing", mix),
]

# Hashes of 64 bits and a fitted model cannot be expressed in SQL; tests hold the stages against
# brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
