"""The best products of two large tables of vectors, exactly, by pairs of tiles that can still hold one of them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..sources import scratch
from .relational import top_per_group

#: Vectors that rows are gathered around, rows they are chosen from, rows of a tile, and the most tiles of a table; beyond
#: that tiles grow.
PIVOTS, SAMPLE, TILE, MOST_TILES = 256, 4096, 2048, 16_384
#: The most tiles of the left table that one task holds while tiles of the right one pass.
HELD = 32
#: Products of matrices and sums in the order of the dimensions differ by less than this share of the vectors' lengths.
SLACK = 1e-9
_TILE = "tile long, pivot long, keys array<{key}>, n int, width int, body binary, centre array<double>, radius double, size double"


def _tiles(df: DataFrame, key: str, vector: str, pivots: np.ndarray, tile: int, copies: int | None = None) -> DataFrame:
    """Rows packed into tiles of vectors that lie near the same pivot, each with its centre, radius and greatest length.

    Vectors of floats stay floats. Of equal vectors of a tile the first copies by key are kept, if that is given.
    """
    typed = "array<float>" if df.schema[vector].dataType.simpleString() == "array<float>" else "array<double>"
    rows = df.where(F.col(vector).isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("key"), F.col(vector).cast(typed).alias("v"))
    kind = rows.schema["key"].dataType.simpleString()

    def near(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                yield f.assign(pivot=np.argmax(2 * np.stack(f["v"].to_numpy()).astype(np.float64) @ pivots.T - (pivots**2).sum(1), axis=1))

    at = scratch.table(rows.mapInPandas(near, f"key {kind}, v {typed}, pivot long"), "near")
    counts = at.groupBy("pivot").agg(F.count("*").alias("n"))  # PIVOTS rows
    total = counts.agg(F.sum("n")).first()[0] or 0
    tile = max(tile, -(-total // MOST_TILES))
    lots = at.join(F.broadcast(counts), "pivot").withColumn("lot", F.pmod(F.xxhash64("key"), F.ceil(F.col("n") / tile)))

    def pack(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("key", kind="stable")
        body = np.stack(f["v"].to_numpy())
        if copies is not None:
            first = pd.Series([v.tobytes() for v in body]).pipe(lambda v: v.groupby(v).cumcount()).to_numpy() < copies
            f, body = f[first], body[first]
        x = body.astype(np.float64)
        centre = x.mean(0)
        away = np.linalg.norm(x - centre, axis=1)
        return pd.DataFrame({"tile": [0], "pivot": [f["pivot"].iloc[0]], "keys": [f["key"].tolist()], "n": [len(f)], "width": [body.itemsize], "body": [body.tobytes()], "centre": [centre.tolist()], "radius": [float(away.max())], "size": [float(np.linalg.norm(x, axis=1).max())]})

    packed = lots.groupBy("pivot", "lot").applyInPandas(pack, _TILE.format(key=kind))
    return scratch.table(packed.withColumn("tile", F.monotonically_increasing_id()), "tiles")


def _spread(rows: np.ndarray, count: int) -> np.ndarray:
    """So many of the rows, each the farthest from those chosen before it."""
    chosen, away = [0], np.full(len(rows), np.inf)
    while len(chosen) < min(count, len(rows)):
        away = np.minimum(away, ((rows - rows[chosen[-1]]) ** 2).sum(1))
        chosen.append(int(away.argmax()))
    return rows[chosen]


def _bounds(left: DataFrame, right: DataFrame) -> DataFrame:
    """a, b, bound: no product of a row of tile a with one of tile b is greater.

    Centres of the right tiles, MOST_TILES rows, are broadcast. The bound is the lesser of that of the two balls and of
    the greatest lengths.
    """
    other = right.select("tile", "centre", "radius", "size").orderBy("tile").toPandas()
    if not len(other):
        return left.select(F.col("tile").alias("a"), F.col("tile").alias("b"), "radius").limit(0).withColumnRenamed("radius", "bound")
    names, c, r, size = other["tile"].to_numpy(), np.stack(other["centre"].to_numpy()), other["radius"].to_numpy(), other["size"].to_numpy()
    long = np.linalg.norm(c, axis=1)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for t, centre, radius, most in zip(f["tile"], f["centre"], f["radius"], f["size"], strict=True):
                centre = np.asarray(centre)
                ball = c @ centre + radius * long + r * np.linalg.norm(centre) + radius * r
                yield pd.DataFrame({"a": t, "b": names, "bound": np.minimum(ball, most * size) * (1 + SLACK) + SLACK})

    return left.select("tile", "centre", "radius", "size").mapInPandas(run, "a long, b long, bound double")


def _holder() -> type:
    """The class of what a task holds, made here so that it is sent to executors with the code that uses it."""

    class Held:
        """Rows of a left tile with the k best products of each that have been met."""

        def __init__(self, keys, x: np.ndarray, k: int):
            self.keys, self.x, self.k, self.long = np.asarray(keys), x, k, np.linalg.norm(x, axis=1)
            self.sim, self.other = np.full((len(x), k), -np.inf), None

        def meet(self, others: np.ndarray, y: np.ndarray) -> None:
            """Matrix products find what can be among the best; what is kept is the sum in the order of the dimensions, which
            does not depend on tiles."""
            k, s, last = self.k, self.x @ y.T, self.sim[:, -1]
            if self.other is None:
                self.other = np.empty(self.sim.shape, others.dtype)
            if np.isneginf(last).any():
                last = np.maximum(last, np.partition(s, len(y) - k, axis=1)[:, len(y) - k] if len(y) > k else s.min(1))
            i, j = np.nonzero(s >= (last - SLACK * self.long * (np.linalg.norm(y, axis=1).max() + 1))[:, None])
            if not len(i):
                return
            sim = np.zeros(len(i))
            for d in range(y.shape[1]):
                sim += self.x[i, d] * y[j, d]
            rows = np.unique(i)
            had = self.sim[rows] > -np.inf
            i, sim, names = np.concatenate([np.repeat(rows, had.sum(1)), i]), np.concatenate([self.sim[rows][had], sim]), np.concatenate([self.other[rows][had], others[j]])
            order = np.lexsort((pd.factorize(names, sort=True)[0], -sim, i))
            i, sim, names = i[order], sim[order], names[order]
            place = np.arange(len(i)) - np.searchsorted(i, i)
            best = place < k
            self.sim[i[best], place[best]], self.other[i[best], place[best]] = sim[best], names[best]

        def found(self, a: int) -> pd.DataFrame:
            i, j = np.nonzero(self.sim > -np.inf)
            return pd.DataFrame({"a": a, "left": self.keys[i], "right": self.other[i, j] if len(i) else [], "sim": self.sim[i, j]})

    return Held


def _products(pairs: DataFrame, left: DataFrame, right: DataFrame, k: int) -> DataFrame:
    """a, left, right, sim: of each left row the k best products in its pairs of tiles, ties by right.

    A task holds some left tiles of neighbouring pivots, and each right tile that one of them has a pair with passes once;
    so right tiles are sent once for each lot of left tiles, not once a pair, and only the best leave a task.
    """
    kinds = [t.schema["keys"].dataType.elementType.simpleString() for t in (left, right)]
    spark = pairs.sparkSession
    tiles = [r.tile for r in left.select("tile", "pivot").orderBy("pivot", "tile").collect()]  # MOST_TILES names and some
    held = max(1, min(HELD, -(-len(tiles) // (2 * spark.sparkContext.defaultParallelism))))
    lots = max(1, -(-len(tiles) // held))
    met = pairs.join(F.broadcast(spark.createDataFrame([(t, i // held) for i, t in enumerate(tiles)], "a long, at int")), "a")
    asked = met.groupBy("at", F.col("b").alias("tile")).agg(F.collect_list("a").alias("for"))
    none = lambda kind: F.lit(None).cast(f"array<{kind}>")
    own = left.join(F.broadcast(met.select(F.col("a").alias("tile"), "at").distinct()), "tile").select("at", none("bigint").alias("for"), "tile", "n", "width", F.col("keys").alias("lk"), none(kinds[1]).alias("rk"), "body")
    passing = right.join(asked, "tile").select("at", "for", "tile", "n", "width", none(kinds[0]).alias("lk"), F.col("keys").alias("rk"), "body")

    Held = _holder()  # noqa: N806

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, tiles = None, {}
        for f in frames:
            for at, wanted, tile, n, lk, rk, width, body in zip(f["at"], f["for"], f["tile"], f["n"], f["lk"], f["rk"], f["width"], f["body"], strict=True):
                if at != now:
                    yield from (t.found(a) for a, t in tiles.items())
                    now, tiles = at, {}
                x = np.frombuffer(body, f"f{width}").reshape(n, -1).astype(np.float64)
                if wanted is None:
                    tiles[tile] = Held(lk, x, k)
                else:
                    for a in wanted:
                        tiles[a].meet(np.asarray(rk), x)
        yield from (t.found(a) for a, t in tiles.items())

    rows = own.unionByName(passing).repartitionById(lots, F.col("at")).sortWithinPartitions("at", F.col("for").isNotNull(), "tile")
    return rows.mapInPandas(run, f"a long, left {kinds[0]}, right {kinds[1]}, sim double")


def top_products(left: DataFrame, right: DataFrame, key: str, other: str, k: int = 15, vector: str = "embedding", tile: int = TILE) -> DataFrame:
    """key, other, sim, rank: for each row of left the k rows of right of the greatest product, ties by other.

    Both tables may be large: they are packed into tiles of neighbouring vectors. Each left tile meets the right tile with
    the greatest bound first, which gives its rows a k-th best; after that only pairs of tiles whose bound reaches the
    least of these. Nothing is left out that could be among the k best. Keys are unique in their table; rows without key
    or vector are left out; vectors are of one length.
    """
    # One pivot for each tile that the right table fills, PIVOTS at most, chosen from vectors drawn by a hash of their keys.
    several = min(PIVOTS, 1 + right.count() // tile)
    sample = right.where(F.col(vector).isNotNull()).orderBy(F.xxhash64(other), other).limit(SAMPLE).select(F.col(vector).cast("array<double>")).collect()
    if not sample:
        empty = left.select(F.col(key), F.lit(0.0).alias("sim"), F.lit(1).alias("rank")).limit(0)
        return empty.select(key, F.lit(None).cast(right.schema[other].dataType).alias(other), "sim", "rank")
    pivots = _spread(np.array([s[0] for s in sample]), several)
    a, b = _tiles(left, key, vector, pivots, tile), _tiles(right, other, vector, pivots, tile, k)
    bounds = scratch.table(_bounds(a, b), "bounds")
    best = scratch.table(bounds.groupBy("a").agg(F.max_by("b", F.struct("bound", "b")).alias("b")), "bounds")
    named = lambda df: df.withColumnsRenamed({"left": key, "right": other})
    found = scratch.table(_products(best, a, b, k), "products")
    # The least k-th best of a tile's rows; a row with fewer than k so far has none, and all pairs of its tile are met.
    kth = top_per_group(found, ["left"], k, F.desc("sim"), "right").groupBy("a", "left").agg(F.count("*").alias("n"), F.min("sim").alias("sim"))
    reach = kth.groupBy("a").agg(F.when(F.min("n") >= k, F.min("sim")).otherwise(F.lit(float("-inf"))).alias("reach"))
    rest = bounds.join(best, ["a", "b"], "left_anti").join(reach, "a").where("bound >= reach").select("a", "b")
    every = found.unionByName(_products(scratch.table(rest, "pairs"), a, b, k))
    return named(top_per_group(every, ["left"], k, F.desc("sim"), "right").select("left", "right", "sim", "rank"))
