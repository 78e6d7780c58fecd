"""A corpus from raw documents to shards: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import cotraining, decontaminate, mixing, ngram_join, sharding
from quarry.llm.storage import saved
from quarry.llm.tables import table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labels at hand, keeps; all columns stay.

    Rows without doc_id are kept, as no verdict can be told to them; rows that repeat a doc_id go if one of them is
    rejected. Without labels of both classes everything is kept. An empty table gives an empty one.
    """
    judged = cotraining.classified(docs, table(spark, sf_dir, "labels"))
    return docs.join(judged.filter("not kept").select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of every group of near duplicates; all columns stay.

    Texts without words are in no group and stay, as do rows without doc_id. Of rows that repeat a doc_id and a text
    one stays; rows of one doc_id with different texts stay or go together. An empty table gives an empty one.
    """
    groups = ngram_join.joined(docs)
    ids = groups.groupBy("doc_id").agg(F.bool_and(F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))).alias("least"), F.count("*").alias("n"))
    ids = saved(ids.filter("doc_id is not null and (not least or n > 1)"), "grouped")
    once = docs.join(ids.select("doc_id"), "doc_id", "left_anti").select(*docs.columns)
    again = docs.join(ids.filter("least").select("doc_id"), "doc_id", "left_semi").select(*docs.columns)
    return once.unionByName(again.dropDuplicates(["doc_id", "text"]))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth stands in the benchmark; all columns stay.

    Rows without doc_id or text are kept; rows that repeat a doc_id go if one of them is contaminated. An empty
    benchmark drops nothing, an empty table gives an empty one.
    """
    judged = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark"))
    return docs.join(judged.filter("contaminated").select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample with the target weights of source, language and topic; all columns stay.

    The doc_id alone draws the lot, so rows that repeat one share their fate unless their cells differ, when one
    kept row keeps all. Rows without doc_id can draw none and are left out. An empty table gives an empty one.
    """
    chosen = mixing.mixed(docs).filter("kept").select("doc_id").distinct()
    return docs.join(chosen, "doc_id", "left_semi").select(*docs.columns)


def cut_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every document that is left.

    Null texts count as empty; rows without doc_id and repeated rows get slots of their own. An empty table gives
    an empty one.
    """
    return sharding.sharded(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram join", keep_one_of_each_group),
    ("benchmark decontamination", drop_contaminated),
    ("source mixing", mix_sources),
    ("sharding", cut_shards),
]

#: The classifier is fitted by array operations and cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; the documents between stages are kept in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
