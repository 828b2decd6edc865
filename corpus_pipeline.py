"""From raw documents to packed training sequences: five stages, each of which reads what the one before it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tessera.llm import decontaminate, near_dedup, packing, quality, secrets
from tessera.llm.common import long_texts, save
from tessera.llm.queries import TOKENIZER

#: Stages on word shingles take five words and a similarity of 0.8 or more.
SHINGLE, PERCENT = 5, 80
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.

    Null, empty and blank texts are judged by the share of good labels alone; repeated rows fare alike; rows without
    doc_id are judged by their text. Very long texts are judged whole; no rows give no rows; extra columns stay.
    """
    long_texts(spark)
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id stays.

    Of repeated rows, equal in doc_id and text, one stays; rows that share a doc_id with other texts are one document.
    Rows without doc_id and texts without words stay, unless repeated under one doc_id. No rows give no rows; extra
    columns stay.
    """
    long_texts(spark)
    found = save(near_dedup.near_duplicates(docs, SHINGLE, PERCENT))
    gone = save(found.where("not kept").select("doc_id").distinct())
    again = save(found.where("kept and doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"))
    left = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    if again.isEmpty():
        return left
    first = Window.partitionBy("doc_id", F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256), F.col("text").isNull()).orderBy(F.xxhash64(*docs.columns))
    repeated = left.join(again, "doc_id", "left_semi").select(*docs.columns, F.row_number().over(first).alias("__row")).where("__row = 1")
    return left.join(again, "doc_id", "left_anti").select(*docs.columns).unionByName(repeated.select(*docs.columns))


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    Rows without doc_id and null or blank texts stay; repeated rows fare alike; very long texts are searched whole; no
    rows give no rows; extra columns stay.
    """
    long_texts(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark in the text; n_chars follows. All documents stay, as null texts do.

    Empty and very long texts, repeated rows and rows without doc_id are treated as any other; extra columns stay.
    """
    long_texts(spark)
    text = secrets.redact(F.col("text").cast("string"))
    out = docs.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of at most 1024 tokens.

    A null or empty text is one piece of one token; repeated rows and rows without doc_id each take their place; no rows
    give no rows; extra columns are left out.
    """
    long_texts(spark)
    return packing.pack(docs, TOKENIZER)


STAGES = [("quality", quality_stage), ("near_dedup", dedup_stage), ("benchmark", benchmark_stage), ("secrets", secrets_stage), ("packing", packing_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents; each one's result is a scratch table that the next reads."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = save(docs)
    return docs
