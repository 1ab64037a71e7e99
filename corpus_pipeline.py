"""The corpus pipeline: toxicity, language, near copies, mixture, packing, in this order.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and returns a
DataFrame; all but the last return the columns of `documents`. `run` applies them, each result
written as Parquet and read again.

* toxicity: documents predicted toxic (score 0.3 or more) go.
* language: documents go when no language is found (`und`), or when the found one has no majority
  of the text (score under 0.5).
* near_copies: of each component of linked documents the one with the smallest doc_id stays (of
  rows with that id, the first by the hash of their text, of rows equal in both, the first by source
  and language; rows without an id stay unless a document with one is in their component).
* mixture: a document is repeated as often as the mix takes it, to the nearest whole copy; those
  the mix does not take go.
* packing: pieces of all kept documents in sequences of at most 2048 tokens.

Stages that hand texts to Python set Spark's largest Arrow batch (`packing.BATCH_BYTES`) to 4 MB, since by default an
executor, its socket and a task each hold 10,000 texts at once. Stages are lazy, so the setting stays with the session;
`run` puts it back.

Null and empty texts have no language, so they end at the second stage. An empty table passes
through as an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docketflow.llm import common, jaccard, language, mixing, packing, toxicity


def few_texts(spark: SparkSession) -> None:
    """From now on Spark hands about 4 MB at a time to Python."""
    spark.conf.set(packing.BATCH_BYTES, "4m")


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier, fitted on their learning fold, does not reject."""
    few_texts(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    (score,) = common.unused(docs, "toxicity")
    return toxicity.score(docs, model, out=score).filter(F.col(score) < toxicity.THRESHOLD).select(*docs.columns)


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language that holds the majority of the text."""
    few_texts(spark)
    pred, share = common.unused(docs, "language", "share")
    found = language.predict(docs, language.fit(docs), pred=pred, share_col=share)
    return found.filter((F.col(pred) != "und") & (F.col(share) >= 0.5)).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies."""
    few_texts(spark)
    rows = common.written(jaccard.rows(docs).filter("root IS NOT NULL"), "pipeline-rows")
    first = rows.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first"))
    rows = rows.join(first, "root").withColumn("stays", F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("row") == F.col("first.row")))
    keys = common.written(rows.groupBy("doc_id", "row").agg(F.max("stays").alias("stays"), F.count("*").alias("alike")), "pipeline-keys")
    kept = met(docs, keys.filter("NOT stays"), F.xxhash64(docs.text), "left_anti")
    twice = keys.filter("stays AND alike > 1")
    if twice.isEmpty():
        return kept
    once, number = met(kept, twice, F.xxhash64(kept.text), "left_semi"), common.unused(docs, "number")[0]
    order = W.partitionBy("doc_id", "text").orderBy("source", "lang")
    once = once.withColumn(number, F.row_number().over(order)).filter(F.col(number) == 1).select(*docs.columns)
    return met(kept, twice, F.xxhash64(kept.text), "left_anti").union(once)


def met(docs: DataFrame, keys: DataFrame, row: Column, how: str) -> DataFrame:
    """docs joined with a table of (doc_id, row), whose columns get names that docs lacks; keys are broadcast
    while they are counted small enough, so that text is not shuffled."""
    names = common.unused(docs, *keys.columns)
    keys = keys.toDF(*names)
    here = docs["doc_id"].eqNullSafe(keys[names[0]]) & (row == keys[names[1]])
    return docs.join(F.broadcast(keys) if common.small_enough(keys, 40) else keys, here, how)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    row = F.xxhash64(F.col("source").isNull(), "source", "text")
    taken = mixing.schedule(docs, row=row).filter("size > 0")
    taken = taken.groupBy("doc_id", "row").agg(F.sort_array(F.collect_list(F.round(F.col("taken") / F.col("size")).cast("int")), False).alias("copies"))
    taken = common.written(taken.filter("copies[0] > 0"), "pipeline-mix")
    there = met(docs, taken, row, "inner")
    copies = F.col(there.columns[-1])
    n, copy = common.unused(there, "n", "copy")
    out = there.filter(F.size(copies) == 1).withColumn(n, F.element_at(copies, 1))
    # rows alike in id, source and text each get a share of their own
    if not taken.filter("size(copies) > 1").isEmpty():
        number = F.row_number().over(W.partitionBy(*there.columns[-3:-1]).orderBy(there.columns[-2]))
        alike = there.filter(F.size(copies) > 1).withColumn(n, number).withColumn(n, F.element_at(copies, F.col(n)))
        out = out.unionByName(alike.filter(F.col(n) > 0))
    return out.withColumn(copy, F.explode(F.sequence(F.lit(1), n))).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, as op3 returns them."""
    return packing.digest(packing.pack(docs, packing.default_tokenizer()))


STAGES = [("toxicity", toxic), ("language", languages), ("near_copies", near_copies), ("mixture", mixture), ("packing", packed)]

#: SQL expresses neither the classifiers nor the packing; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    whole = spark.conf.get(packing.BATCH_BYTES)
    try:
        for name, stage in STAGES:
            docs = common.written(stage(spark, docs, sf_dir), f"stage-{name}")
    finally:
        spark.conf.set(packing.BATCH_BYTES, whole)
    return docs
