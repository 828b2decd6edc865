"""The operators as queries over the tables of a folder."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import curve_packing, decontaminate, divergence, html_text, lm_score, media, near_dedup, packing, pii, quality, rollup, secrets, whitening
from .common import long_texts, save, scratch_path
from .oracle import ORACLE_SQL  # noqa: F401

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    long_texts(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_read(spark, sf_dir, "pages"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"), TOKENIZER)


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_read(spark, sf_dir, "documents"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_scan(_read(spark, sf_dir, "documents"))


def op5_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(_read(spark, sf_dir, "documents"), pii.session_key(spark))


def op6_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = _read(spark, sf_dir, "labels").where("quality = 1 and toxic = 0").select("doc_id")
    return lm_score.cross_entropy_difference(_read(spark, sf_dir, "documents"), good)


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op8_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents arrive in one batch under the source "inbox" with an estimate of four characters a token; the next
    batch revises them to their counts; the next deletes them from there and inserts them under their own sources; the
    last two come again and change nothing, and the batches are compacted before totals are read."""
    docs = _read(spark, sf_dir, "documents").withColumn("estimate", F.coalesce(F.floor(F.length("text") / 4), F.lit(0)).cast("long"))
    counts = save(rollup.counted(docs, TOKENIZER, "byte_bpe_50k", "estimate"))
    store = rollup.Rollup(spark, scratch_path(spark, "rollup"))
    none = F.lit(None).cast("long").alias("old_tokens")
    inbox = [F.lit("inbox").alias("source"), "lang", "tokenizer"]
    store.commit("0001-arrive", counts.select(F.lit("insert").alias("op"), *inbox, F.col("estimate").alias("n_tokens"), none))
    revised = counts.select(F.lit("revise").alias("op"), *inbox, "n_tokens", F.col("estimate").alias("old_tokens"))
    moved = counts.select(F.lit("delete").alias("op"), *inbox, "n_tokens", none).unionByName(counts.select(F.lit("insert").alias("op"), *rollup.KEY, "n_tokens", none))
    store.commit("0002-count", revised)
    store.commit("0003-move", moved)
    store.compact()
    store.commit("0002-count", revised)
    store.commit("0003-move", moved)
    return store.totals()


def drawn(embedding: np.ndarray, edited: bool) -> bytes:
    """A PGM picture that an embedding determines, or a copy of it: cropped, brighter or darker, noisy, maybe turned."""
    seed = np.frombuffer(np.rint(np.asarray(embedding, np.float64) * 1e4).astype(np.int32).tobytes() or b"0000", np.uint32)
    rng = np.random.default_rng(seed)
    x = np.kron(rng.integers(0, 256, (16, 16)), np.ones((5, 5))).astype(np.float64)
    x = media._box(x, 1)
    if edited:
        top, left = rng.integers(0, 9, 2)
        x = np.clip((x[top : 80 - 8 + top, left : 80 - 8 + left] - 128) * rng.uniform(0.7, 1) + 128 + rng.uniform(-20, 20) + rng.normal(0, 2, (72, 72)), 0, 255)
        x = np.rot90(x, int(rng.integers(0, 4)))
    return b"P5 %d %d 255\n" % x.shape[::-1] + np.rint(x).astype(np.uint8).tobytes()


def pictures(vectors: DataFrame) -> DataFrame:
    """media_id, content: for each embedding its picture (twice its vec_id) and an edited copy (one more)."""

    @F.pandas_udf("array<binary>")
    def draw(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series([None if e is None else [drawn(e, False), drawn(e, True)] for e in s])

    return vectors.select("vec_id", F.posexplode(draw("embedding")).alias("copy", "content")).select((2 * F.col("vec_id") + F.col("copy")).alias("media_id"), "content")


def op9_image_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables hold no pictures, so each embedding is drawn, and drawn again as an edited copy."""
    return media.copies(pictures(_read(spark, sf_dir, "embeddings")))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergences(_read(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.by_component(whitening.whiten(_read(spark, sf_dir, "embeddings")))


def op13_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curve_packing.pack(_read(spark, sf_dir, "documents"), TOKENIZER)


QUERIES = {f.__name__: f for f in (op1_main_text, op2_best_fit_packing, op3_near_duplicates, op4_secret_scan, op5_pseudonyms, op6_cross_entropy, op7_decontaminate, op8_token_rollup, op9_image_copies, op10_quality, op11_divergence, op12_whitening, op13_curve_packing)}
