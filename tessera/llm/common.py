"""Scratch tables, connected components and text hashing shared by the operators."""

from __future__ import annotations

import atexit
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

_OWN: dict[str, SparkSession] = {}
_LOCAL: list[str] = []


def long_texts(spark: SparkSession) -> None:
    """Arrow batches of 1,000 rows, unless the session has its own size: a batch of texts is in memory several times."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, "1000")


def scratch_root(spark: SparkSession) -> str:
    """The folder that driver and executors share, named in spark.checkpoint.dir.

    Where that is unset, a local session gets a temporary folder; on a cluster it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        if not _LOCAL:
            _LOCAL.append("file://" + tempfile.mkdtemp(prefix="tessera-"))
        root = _LOCAL[0]
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new name in the scratch folder; what is written there is deleted at the end of the process."""
    path = f"{scratch_root(spark)}/tessera-{name}-{uuid.uuid4().hex}"
    _OWN[path] = spark
    return path


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def save(df: DataFrame) -> DataFrame:
    """Write df to a scratch table and read it back, which cuts the lineage and survives lost executors.

    The table stays until drop() or the end of the process.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def drop(*tables: DataFrame) -> None:
    """Delete scratch tables that nothing reads any more."""
    for t in tables:
        if (path := getattr(t, "_scratch", None)) in _OWN:
            _delete(_OWN.pop(path), path)


@atexit.register
def _drop_all() -> None:
    for path, spark in list(_OWN.items()):
        try:
            _delete(spark, path)
        except Exception:  # noqa: BLE001  the session is gone
            return


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of edges(a, b); component is the smallest node reachable.

    Alternating large-star and small-star rounds: each node passes its smallest neighbour on, so the work of a round is
    linear in the edges and the rounds grow with the logarithm of the longest path. Each round is a scratch table. Only
    two counts reach the driver. Nulls and loops are dropped; no edges give no rows.
    """
    e = save(edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Saved, so that the joins below read two tables and a hub's rows can be split among tasks.
        low = save(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = save(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = save(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        nxt = save(small.where("u <> v").distinct())
        got = nxt.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        drop(e, low, large, least)
        e = nxt
        if tuple(got) == mark:
            break
        mark = tuple(got)
    out = e.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    final = save(out.unionByName(roots))
    drop(e)
    return final


# Hashes of byte ranges: a polynomial over a piece of text, divided by the power at its start, then mixed.
_LONG = 1 << 16
_P = 0x9E3779B97F4A7C15 | 1
with np.errstate(over="ignore"):
    _POW = np.cumprod(np.full(_LONG + 1, _P, np.uint64))
    _INV = np.cumprod(np.full(_LONG + 1, pow(_P, -1, 1 << 64), np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_bytes(text: str | None) -> list[bytes]:
    """Words between ASCII white space, with A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _ranges(words: list[bytes], k: int) -> np.ndarray:
    joined = np.frombuffer(b" ".join(words), np.uint8).astype(np.uint64)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = ends - np.fromiter(map(len, words), np.int64, len(words)) - 1
    total = np.zeros(len(joined) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum((joined + np.uint64(1)) * _POW[: len(joined)], out=total[1:])
        first, last = starts[: len(words) - k + 1], ends[k - 1 :] - 1
        return mix((total[last] - total[first]) * _INV[first] + (last - first).astype(np.uint64))


def gram_hashes(words: list[bytes], k: int) -> np.ndarray:
    """64-bit hashes of all runs of k words in order; of the whole sequence if it has fewer words; none of no words."""
    if not words:
        return np.zeros(0, np.uint64)
    k = min(k, len(words))
    out, at = [], 0
    while at + k <= len(words):
        end, size = at, 0
        while end < len(words) and (size + len(words[end]) + 1 < _LONG or end < at + k):
            size += len(words[end]) + 1
            end += 1
        if size >= _LONG:  # a run that holds a huge word
            import xxhash

            out.append(np.array([xxhash.xxh3_64_intdigest(b" ".join(words[at : at + k]))], np.uint64))
            at += 1
            continue
        out.append(_ranges(words[at:end], k))
        at = end - k + 1
    return np.concatenate(out)
