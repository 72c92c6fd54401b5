"""The training-data pipeline over ``documents``: STAGES in order, each written as Parquet and reread.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``docs``, whatever they are named and of whatever type.  A stage judges a row by its doc_id
and text together (under a 64-bit hash of both, made anew where it is needed, so that no row is written twice): rows
of one doc_id with different texts are judged each by itself.  Null doc_ids stay null.

All stages: an empty table gives an empty table; texts are read whole, however long;
columns other than ``doc_id``, ``text`` and ``lang`` are passed on unread.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm import bpe, decontaminate, jaccard_join, langid, toxicity
from folio.llm.common import join_ids, table, written


def _key() -> Column:
    i, t = F.col("doc_id").cast("string"), F.col("text")
    return F.xxhash64(i.isNull(), i, t.isNull(), t)  # the hash itself passes nulls over


def _asked(docs: DataFrame) -> DataFrame:
    """``docs`` for an operator: doc_id is the row's key."""
    return docs.select(_key().alias("doc_id"), "text")


def _listed(ids: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The keys in ``ids`` (their doc_id), written first, so that they are made once and counted; under a new name."""
    key = f"key_{uuid4().hex}"
    return written(ids.select(F.col("doc_id").alias(key)).distinct(), name), key


def _without(docs: DataFrame, ids: DataFrame, name: str) -> DataFrame:
    """``docs`` less the rows whose key is a doc_id of ``ids``."""
    gone, key = _listed(ids, name)
    return join_ids(docs.withColumn(key, _key()), gone, key, "left_anti").drop(key)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that language identification rejects go.

    Null and empty texts, and texts without a letter, go; equal texts share their fate.  Without any learned language
    every text goes."""
    judged = langid.identify(_asked(docs), langid.fit(docs))
    return _without(docs, judged.filter("rejected"), "rejected-language")


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents predicted toxic go.

    Null and empty texts have the score of no term, and stay unless most labelled documents are toxic; equal texts share
    their fate.  Without labels nothing goes."""
    judged = toxicity.score_toxicity(_asked(docs), toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return _without(docs, judged.filter("predicted = 1"), "rejected-toxic")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: one document of each group stays, the one of the smallest doc_id (rows without an id after those with
    one; of equal ids, and of repeated rows, one).

    Null and empty texts, and texts without a word, are in no group and stay."""
    classes = jaccard_join.near_duplicates(_asked(docs)).groupBy("doc_id").agg(F.min("class_id").alias("class_id"), F.count("*").alias("n"))
    classes = written(classes, "near-duplicate-classes")  # a row a key; rows of one key have one class
    again = classes.groupBy("class_id").count().filter("count > 1").select("class_id")
    members = join_ids(classes.select("doc_id", "class_id"), written(again, "near-duplicate-groups"), "class_id", "left_semi")
    ids = docs.select(_key().alias("doc_id"), F.col("doc_id").cast("long").alias("id")).distinct()
    members = written(members.join(ids, "doc_id"), "near-duplicate-members")
    first = members.groupBy("class_id").agg(F.min_by("doc_id", F.struct(F.col("id").isNull(), "id", "doc_id")).alias("doc_id"))
    kept = _without(docs, members.select("doc_id").join(first.select("doc_id"), "doc_id", "left_anti"), "near-duplicates")
    repeated, key = _listed(classes.filter("n > 1"), "repeated-rows")
    n = repeated.count()
    if not n:
        return kept
    keyed = kept.withColumn(key, _key())
    one = join_ids(keyed, repeated, key, "left_semi", n).dropDuplicates([key])
    return join_ids(keyed, repeated, key, "left_anti", n).unionByName(one).drop(key)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents that hold a benchmark item go.

    Null and empty texts hold nothing and stay; so does everything where the benchmark is empty."""
    return _without(docs, decontaminate.contaminated(_asked(docs), table(spark, sf_dir, "benchmark")), "contaminated")


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: the digests of the ids and of the decoded text; a null text is encoded as an empty one, repeated rows give
    a row each."""
    return bpe.encode_documents(docs)


STAGES = [
    ("language", language),
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("bpe", encoded),
]
ORACLE_SQL = None  # fitted models and tokenizers are not SQL; tests hold the rows against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
