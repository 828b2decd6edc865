"""Quality by nearest-neighbour voting over latent-semantic vectors.

A bounded sample of labelled texts is turned into hashed counts of byte pairs and of word repetitions, weighted by
inverse document frequency and reduced by a truncated singular value decomposition. The labelled vectors (at most
2 * PER_CLASS rows of DIMENSIONS floats, under 1 MB) are broadcast; every document's vector is multiplied with all of
them, block by block, and its nearest labelled vectors vote with their similarity as weight.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import gram_hashes, word_bytes

PER_CLASS = 1500
DIMENSIONS = 64
NEIGHBOURS = 25
PAIRS = 2048
REPEAT = 6
_EXTRA = 6
WIDTH = PAIRS + _EXTRA
_PART = 1 << 20
_BIN = ((np.arange(65536, dtype=np.uint64) * np.uint64(0x9E3779B1)) >> np.uint64(11)).astype(np.int64) % PAIRS


def counts(text: str | None) -> np.ndarray:
    """Damped counts of hashed byte pairs and of repeated words of a whole text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    out = np.zeros(WIDTH, np.float32)
    for at in range(0, len(raw), _PART):
        b = np.frombuffer(raw[at : at + _PART + 1], np.uint8).astype(np.int64)
        if len(b) > 1:
            out[:PAIRS] += np.bincount(_BIN[b[:-1] * 256 + b[1:]], minlength=PAIRS)
    words = gram_hashes(word_bytes(text), 1)
    if len(words) > 1:
        for lag in range(1, 5):
            out[PAIRS + lag - 1] = 8 * np.count_nonzero(words[lag:] == words[:-lag])
        out[PAIRS + 4] = len(words) - len(np.unique(words))
    out[PAIRS + 5] = len(words)
    out = np.log1p(out)
    out[PAIRS : PAIRS + 5] *= REPEAT
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


class Model:
    """Weights, projection, labelled vectors and their labels."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        rng = np.random.default_rng(5)
        self.y = y.astype(np.float32)
        self.base = float(y.mean()) if len(y) else 0.5
        self.idf = (np.log((1 + len(x)) / (1 + (x > 0).sum(0))) + 0.2).astype(np.float32)
        z = _unit(x * self.idf) if len(x) else x
        d = max(1, min(DIMENSIONS, len(x)))
        q = rng.standard_normal((WIDTH, d + 16)).astype(np.float32)
        for _ in range(6 if len(x) else 0):
            q, _ = np.linalg.qr(z.T @ (z @ q))
        u = np.linalg.svd(z @ q, full_matrices=False)[2][:d].T if len(x) else np.eye(d + 16, d, dtype=np.float32)
        self.project = (q @ u).astype(np.float32)
        self.vectors = _unit(z @ self.project)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        x = np.stack([counts(t) for t in texts])
        return self.vote(x)

    def vote(self, x: np.ndarray) -> np.ndarray:
        v = _unit((x * self.idf) @ self.project)
        if not len(self.y):
            return np.full(len(v), self.base)
        near = v @ self.vectors.T
        k = min(NEIGHBOURS, len(self.y))
        # Of neighbours as near as the last one, those with the smaller doc_id come first, as the vectors lie in its order.
        last = -np.partition(-near, k - 1, axis=1)[:, k - 1 : k]
        tied = near == last
        chosen = (near > last) | (tied & (np.cumsum(tied, 1) <= k - (near > last).sum(1, keepdims=True)))
        w = np.where(chosen, np.maximum(near, 0), 0).astype(np.float64) ** 4
        total = w.sum(1)
        said = (w @ self.y) / np.maximum(total, 1e-12)
        return np.where((total > 1e-12) & x.any(1), np.clip(said, 0, 1), self.base)


def held_out(doc_id: Column) -> Column:
    """Documents whose labels no model may learn from; a null id is none of them."""
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS) -> Model:
    """A model of up to per_class rows of each label, dealt by a hash of doc_id from all rows not held out.

    Rows of labels without doc_id or label are skipped; of several labels of one document the largest counts. Without any
    labelled document every score is 0.5.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).where(~held_out(F.col("doc_id")) & F.col("y").isin(0, 1))
    known = known.groupBy("doc_id").agg(F.max("y").alias("y"))
    # At most 2 * per_class rows, so the broadcast is bounded.
    chosen = known.where("y = 0").orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class).unionByName(known.where("y = 1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class))
    ids = chosen.collect()
    small = docs.sparkSession.createDataFrame([tuple(r) for r in ids], "doc_id long, y int")
    schema = pa.schema([("doc_id", pa.int64()), ("y", pa.int32()), ("at", pa.list_(pa.int32())), ("n", pa.list_(pa.float32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [counts(t) for t in b.column("text").to_pylist()]
            at = [np.flatnonzero(r).astype(np.int32) for r in rows]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("y"), pa.array(at, pa.list_(pa.int32())), pa.array([r[i] for r, i in zip(rows, at, strict=True)], pa.list_(pa.float32()))], schema=schema)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(small), "doc_id")
    got = texts.mapInArrow(run, "doc_id long, y int, at array<int>, n array<float>").toArrow().to_pandas().drop_duplicates("doc_id").sort_values("doc_id")
    x = np.zeros((len(got), WIDTH), np.float32)
    for i, (at, n) in enumerate(zip(got["at"], got["n"], strict=True)):
        x[i, np.asarray(at, int)] = n
    return Model(x, got["y"].to_numpy())


def scorer(docs: DataFrame, model: Model):
    """A function from a text column to the score column."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = shared.value
        for texts in batches:
            parts = [model.scores(texts.iloc[at : at + 256].tolist()) for at in range(0, len(texts), 256)]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return score


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per row of docs, whatever its other columns.

    Null, empty and blank texts hold nothing to compare and get the share of label 1 in the sample as score. Rows with a
    null doc_id are scored and not held out; repeated rows are scored alike; very long texts are counted whole, part by
    part. No rows give no rows.
    """
    score = scorer(docs, fit(docs, labels))
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), score(F.col("text").cast("string")).alias("score"))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without the rows that the classifier rejects (score under 0.5); columns as they are."""
    score = scorer(docs, fit(docs, labels))
    return docs.where(score(F.col("text").cast("string")) >= 0.5)
