"""The corpus pipeline: toxic text goes, text that fails the quality rules goes, one of each group of
near duplicates stays, sources are mixed to target weights, and what is left is encoded.

Each stage calls one operator of ``alignfold.llm`` on all that its predecessor kept. Toxicity is
learnt from the labelled documents of the stage's own input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alignfold.llm import bpe, host_rules, mixing, simhash, toxicity
from alignfold.llm.common import WORD, free_name, id_crc, row_key, scratch_path, text_or_empty

TOXIC_AT = 0.3


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below TOXIC_AT. The model learns from the labels of three quarters of the ids."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels, id_crc() % 4 != 2)
    out = free_name(docs, "toxicity")
    scored = toxicity.score(docs, model, carry=tuple(c for c in docs.columns if c != "doc_id"), out=out)
    return scored.filter(F.col(out) < TOXIC_AT).select(*same(docs))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and whose host is good. Rows equal in all columns share a verdict."""
    keyed, row = with_key(docs)
    judged = host_rules.judge(keyed.select("doc_id", "text", "source", F.col(row).alias("_row")), carry=("_row",))
    kept = judged.filter("kept").select(F.col("_row").alias(row)).distinct()
    return keyed.join(kept, row, "left_semi").select(*same(docs))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group the row of the smallest id (null ids last; of rows with one id, the smallest key)."""
    keyed, row = with_key(docs)
    found = simhash.near_duplicates(keyed.select("doc_id", "text", F.col(row).alias("_row")), carry=("_row",))
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")
    kept = found.groupBy("component").agg(F.min(first).alias("k")).select(F.col("k._row").alias(row))
    # rows equal in all columns have one key: one of them stays
    return keyed.join(kept, row).dropDuplicates([row]).select(*same(docs))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice."""
    keyed, row = with_key(docs)
    narrow = keyed.select("doc_id", "source", F.regexp_count(text_or_empty(), F.lit(WORD)).alias("words"),
                          F.col(row).alias("_row"))
    mixed, _ = mixing.mix_rows(narrow, F.col("words"), F.array("source"), mixing.repeating([3, 1, 2]), share=1.5, passes=2,
                          carry=("_row",))
    # one row for each time a row is taken; rows equal in all columns are dealt out by their number
    times = mixed.groupBy(F.col("_row").alias(row)).agg(F.sum(F.size("given")).cast("int").alias("_times")).filter("_times > 0")
    again = keyed.dropDuplicates([row]).join(times, row)
    return again.withColumn(row, F.explode(F.sequence(F.lit(1), F.col("_times")))).select(*same(docs))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, and the digest of the text that they decode to."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    back = bpe.encode(docs, ranks, public_tokenizers.PATTERN, decoded=True)
    return back.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


def same(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def with_key(docs: DataFrame) -> tuple[DataFrame, str]:
    row = free_name(docs, "row_key")
    return docs.withColumn(row, row_key(docs)), row


STAGES = [("toxicity", toxicity_stage), ("quality", quality_stage), ("near_duplicates", near_duplicate_stage),
          ("mixing", mixing_stage), ("encoding", encoding_stage)]
ORACLE_SQL = None  # a trained classifier and a tokenizer: tested against brute force instead


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table of documents, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
