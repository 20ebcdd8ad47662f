"""A corpus pipeline of five stages: from raw documents to packed token sequences.

Each stage gets what its predecessor kept and decides on all of it.  A document is its
doc_id, text, language and source together: the operators get a hash of these in place of
the doc_id, so rows without a doc_id are judged like others, rows that share one are judged
by their own texts, and of rows equal in all four the near-duplicate stage keeps one.
Rejected keys are written first; while their file is under the broadcast limit of the
joins, they are broadcast and the texts are filtered without a shuffle.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roamkit.llm import neardup, packing, quality, secret_scan, toxicity
from roamkit.llm.queries import BYTE_VOCABULARY
from roamkit.llm.shared import stage
from roamkit.operators.joins import bounded_broadcast


def row_key(docs: DataFrame) -> Column:
    """What a document is told by; NULL and empty differ."""
    given = [docs[c] for c in ("doc_id", "text", "lang", "source") if c in docs.columns]
    return F.xxhash64(*given, *[c.isNull() for c in given])


def by_key(docs: DataFrame) -> DataFrame:
    """``docs`` as the operators get them: the row's key in place of its doc_id."""
    return docs.withColumn("doc_id", row_key(docs))


def without(docs: DataFrame, keys: DataFrame, name: str) -> DataFrame:
    """``docs`` without the rows whose key is among ``keys`` (column doc_id)."""
    gone = bounded_broadcast(stage(keys.select("doc_id").distinct(), name))
    return docs.join(gone, row_key(docs) == gone["doc_id"], "left_anti")


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine calls toxic go."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return without(docs, toxicity.score(by_key(docs), model).where(F.col("score") >= toxicity.THRESHOLD), "toxic")


def poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or are outliers of their language and source go."""
    return without(docs, quality.rules(by_key(docs)).where("not kept"), "poor")


def copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group stays (one without a doc_id where none has any), in one row."""
    own = docs.select(row_key(docs).alias("doc_id"), docs["doc_id"].alias("own"))
    of = stage(neardup.near_duplicates(by_key(docs)).join(own, "doc_id"), "classes")
    first = F.min(F.struct(F.col("own").isNull().alias("none"), "own", "doc_id"))["doc_id"]
    stays = of.groupBy("class_id").agg(F.count("*").alias("n"), first.alias("stays")).where("n > 1")
    one = without(docs, of.join(stays, "class_id").where("doc_id <> stays"), "copies")
    again = stage(one.groupBy(row_key(one).alias("doc_id")).agg(F.count("*").alias("n")).where("n > 1").select("doc_id"), "repeated")
    if again.isEmpty():
        return one
    rows = one.join(again, row_key(one) == again["doc_id"], "left_semi")
    key = ["doc_id", *[c for c in ("text", "lang", "source") if c in docs.columns]]
    return without(one, again, "repeated-rows").unionByName(rows.dropDuplicates(key))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts; n_chars follows."""
    clean = secret_scan.masked(docs, secret_scan.scan(docs))
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all pieces in sequences of 1024 tokens."""
    return packing.op5(docs, public_tokenizers.path(BYTE_VOCABULARY))


STAGES = [("toxicity", toxic), ("quality rules", poor), ("near-duplicates", copies), ("secret scans", secrets), ("packing", packed)]

#: A trained model decides in the first stage, so SQL can't give the rows; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
