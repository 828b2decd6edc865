"""Whitening of embeddings: rows centred by exact sums, their Gram matrix by RowMatrix, its eigenvectors on the driver.

Entries become whole numbers, so sums and deviations are exact. What reaches the driver is one sum per dimension and one
matrix of dimensions by dimensions; what is broadcast is the matrix of the components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, functions as F

from .common import drop, save

COMPONENTS = 8
#: Entries are floor(SCALE * entry) + SHIFT.
SCALE, SHIFT = 1024, 100_000
#: A component whose eigenvalue is not above this share of the largest one has no variance that doubles can tell.
NOISE = 1e-12


def whole(embedding: Column) -> Column:
    """The entries as whole numbers."""
    return F.transform(embedding, lambda c: F.floor(SCALE * c.cast("double")) + F.lit(SHIFT).cast("long"))


def finite(embedding: Column) -> Column:
    """True of vectors without null, NaN or infinite entries."""
    return embedding.isNotNull() & F.forall(embedding, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))


def covariance(rows: DataFrame, column: str, n: int, size: int) -> np.ndarray:
    """The Gram matrix of centred arrays of doubles, divided by n."""
    vectors = MLUtils.convertVectorColumnsFromML(rows.select(array_to_vector(F.col(column)).alias("v")), "v")
    return RowMatrix(vectors, n, size).computeGramianMatrix().toArray() / n


def components(v: np.ndarray, count: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a covariance, falling, and their unit eigenvectors as columns."""
    e, u = np.linalg.eigh(v)
    order = np.argsort(-e, kind="stable")[:count]
    return e[order], u[:, order]


def _apply(shared, n: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums, u, root = shared.value
        for f in frames:
            if not len(f):
                continue
            y = np.stack(f["x"].to_numpy()) * n - sums
            # Squares beyond 64 bits are summed as Python's whole numbers.
            wide = y.astype(object) if float(np.abs(y).max()) ** 2 * y.shape[1] >= 2**62 else y
            w = np.where(root > 0, (y / n) @ u / np.where(root > 0, root, 1), 0.0)
            yield pd.DataFrame({"vec_id": f["vec_id"], "deviation": [str(d) for d in (wide * wide).sum(1)], "whitened": list(w)})

    return run


def whiten(embeddings: DataFrame, count: int = COMPONENTS) -> DataFrame:
    """vec_id, n, deviation decimal(38,0), whitened, explained (arrays by component), identity_error: one row per vector.

    Vectors that are null or hold null or non-finite entries are dropped, as are those whose length is not the most
    frequent one (of equally frequent lengths the longest) and vectors without entries. Components without variance
    have whitened and explained 0, and identity_error speaks of the others, 0 if there are none. Rows with a null vec_id
    and repeated rows are rows of their own; no rows give no rows; columns besides vec_id and embedding are ignored.
    Entries whose whole number, times the number of rows, goes beyond 64 bits are an error.
    """
    spark = embeddings.sparkSession
    fit = embeddings.where(finite(F.col("embedding")) & (F.size("embedding") > 0)).select(F.col("vec_id").cast("long").alias("vec_id"), whole(F.col("embedding")).alias("x"))
    frequent = fit.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    schema = "vec_id long, n long, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"
    if frequent is None:
        return spark.createDataFrame([], schema)
    size, n = frequent["size"], frequent["count"]
    fit = fit.where(F.size("x") == size)
    # One row per dimension reaches the driver.
    by_dim = fit.select(F.posexplode("x").alias("at", "x")).groupBy("at").agg(F.sum("x").alias("s")).orderBy("at").collect()
    sums = np.array([r["s"] for r in by_dim], np.int64)
    s = F.lit(sums.tolist()).cast("array<long>")
    centred = fit.select(F.zip_with("x", s, lambda x, t: (x * F.lit(n) - t).cast("double") / F.lit(float(n))).alias("c"))
    v = covariance(centred, "c", n, size)
    e, u = components(v, count)
    real = e > NOISE * max(e[0], 0)
    root = np.where(real, np.sqrt(np.maximum(e, 0)), 0)
    shared = spark.sparkContext.broadcast((sums, u, root))
    rows = save(fit.mapInPandas(_apply(shared, n), "vec_id long, deviation string, whitened array<double>").withColumn("deviation", F.col("deviation").cast("decimal(38,0)")))
    mean = rows.select(*(F.avg(F.col("whitened")[i]) for i in range(len(e)))).first()
    off = rows.select(F.zip_with("whitened", F.lit([float(m) for m in mean]), lambda w, m: w - m).alias("c"))
    error = np.abs(covariance(off, "c", n, len(e)) - np.eye(len(e)))[np.ix_(real, real)].max(initial=0.0)
    trace = float(np.trace(v))
    explained = [float(x) if r and trace > 0 else 0.0 for x, r in zip(e / (trace or 1.0), real, strict=True)]
    return rows.select("vec_id", F.lit(n).cast("long").alias("n"), "deviation", "whitened", F.lit(explained).cast("array<double>").alias("explained"), F.lit(float(error)).alias("identity_error"))


def by_component(whitened: DataFrame) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: one row per vector and component, from 1.

    A deviation beyond 64 bits is null; whiten() has it as a decimal.
    """
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c")
    out = whitened.select("vec_id", "n", F.expr("try_cast(deviation as long)").alias("deviation"), "identity_error", each)
    return out.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", F.col("c.whitened").alias("whitened"), F.col("c.explained").alias("explained"), "identity_error")
