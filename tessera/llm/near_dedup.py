"""Near-duplicate documents by b-bit MinHash.

Minima of many hash functions are cut to their low bits and packed; bands of whole minima propose candidates; bit counts
of packed signatures, corrected for chance agreement, estimate similarity; what may reach the threshold is confirmed on
full shingle sets.

Exact copies collapse to one representative first. The members of a band bucket are joined to its smallest member only,
never pair by pair, and the connected sets of these stars are the clusters in which links are sought. A cluster is dealt
out in blocks of bounded rows and bytes. Each block is compared within itself and with a few pivots of its cluster;
documents that are then outside their cluster's largest component are compared with all its blocks. So every pair of
different components inside a cluster is tested, and no task holds more than two blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import components, drop, gram_hashes, mix, save, word_bytes

BANDS = 40
MISS = 1e-5
BITS = 2
BLOCK_ROWS = 128
BLOCK_BYTES = 2 << 20
PIVOTS = 8


def band_rows(similarity: float, bands: int = BANDS, miss: float = MISS) -> int:
    """Most rows a band may have for a pair at the threshold to miss all bands with a chance of miss at most."""
    r = 1
    while r < 16 and (1 - similarity ** (r + 1)) ** bands <= miss:
        r += 1
    return r


class Signer:
    """Signatures of documents: shingle count, key of the word sequence, band keys, packed low bits."""

    def __init__(self, shingle: int, rows: int, bands: int = BANDS):
        rng = np.random.default_rng(77)
        self.shingle, self.rows, self.bands, self.k = shingle, rows, bands, rows * bands
        draw = lambda n: rng.integers(1, 1 << 63, n, dtype=np.uint64)
        self.xor, self.mul = ((draw(self.k) >> np.uint64(31)).astype(np.uint32)[:, None] for _ in range(2))
        self.mul |= np.uint32(1)
        self.weights, self.salts = draw(rows) | np.uint64(1), draw(bands)

    def sets(self, text: str | None) -> np.ndarray:
        return np.unique(gram_hashes(word_bytes(text), self.shingle))

    def __call__(self, text: str | None) -> tuple:
        words = word_bytes(text)
        if not words:
            return 0, None, None, None
        grams = np.unique(gram_hashes(words, self.shingle))
        x, low = (grams >> np.uint64(32)).astype(np.uint32), np.full(self.k, 0xFFFFFFFF, np.uint32)
        for at in range(0, len(x), 512):
            np.minimum(low, ((x[None, at : at + 512] ^ self.xor) * self.mul).min(1), out=low)
        with np.errstate(over="ignore"):
            keys = mix((low.reshape(self.bands, self.rows).astype(np.uint64) * self.weights).sum(1) + self.salts)
        bits = ((low[:, None] >> np.arange(BITS, dtype=np.uint32)) & 1).astype(np.uint8)
        return len(grams), xxhash.xxh3_128_digest(b" ".join(words)), keys.view(np.int64), np.packbits(bits.ravel()).tobytes()


def _sign(signer: Signer):
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("key", pa.binary()), ("bands", pa.list_(pa.int64())), ("sketch", pa.binary()), ("size", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                texts = part.column("text").to_pylist()
                n, key, bands, sketch = zip(*map(signer, texts), strict=True)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(c, f.type) for c, f in zip((n, key, bands, sketch, [len(t or "") for t in texts]), list(schema)[1:], strict=True))], schema=schema)

    return run


def estimates(sketches: list[bytes], k: int) -> np.ndarray:
    """Similarity of all pairs by the share of agreeing b-bit minima, less the agreement that chance gives."""
    x = np.frombuffer(b"".join(sketches), np.uint8).reshape(len(sketches), -1)
    bits = np.unpackbits(x, axis=1)[:, : k * BITS].reshape(len(x), k, BITS).astype(np.float32)
    codes = (bits * (2 ** np.arange(BITS))).sum(2)
    same = np.zeros((len(x), len(x)), np.float32)
    for v in range(1 << BITS):
        hot = (codes == v).astype(np.float32)
        same += hot @ hot.T
    chance = 0.5**BITS
    return (same / k - chance) / (1 - chance)


def _confirm(signer: Signer, percent: int):
    """Links inside one unit of documents: each pair of different components is tested on full sets."""
    t = percent / 100
    chance = 0.5**BITS
    p = t + (1 - t) * chance
    floor = t - 6 * (p * (1 - p) / signer.k) ** 0.5 / (1 - chance)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf[[xxhash.xxh3_128_digest(b" ".join(word_bytes(t))) == k for t, k in zip(pdf.text, pdf.key, strict=True)]].sort_values("side").drop_duplicates(["doc_id", "key"])
        if (n := len(pdf)) < 2:
            return pd.DataFrame({"a": [], "b": []}).astype("int64")
        may = np.triu(estimates(pdf.sketch.tolist(), signer.k) >= floor, 1)
        side, comp = pdf.side.to_numpy(), pdf.comp.to_numpy()
        if side.any():
            may &= (side == 1)[:, None] | (side == 1)[None, :]
            may &= comp[:, None] != comp[None, :]
        near = np.flatnonzero(may.any(0) | may.any(1))
        links = np.zeros((n, n), bool)
        if len(near):
            sets = [signer.sets(x) for x in pdf.text.iloc[near]]
            sizes = np.array([len(s) for s in sets], np.int64)
            values, code = np.unique(np.concatenate(sets), return_inverse=True)
            row = np.repeat(np.arange(len(near)), sizes)
            shared = np.bincount(code) > 1
            code, row = (np.cumsum(shared) - 1)[code[keep]] if (keep := shared[code]).any() else code[:0], row[keep]
            both, order = np.zeros((len(near),) * 2, np.float64), np.argsort(code, kind="stable")
            code, row = code[order], row[order]
            for at in range(0, int(shared.sum()), 4096):
                i, j = np.searchsorted(code, (at, at + 4096))
                x = np.zeros((len(near), 4096), np.float32)
                x[row[i:j], code[i:j] - at] = 1
                both += x @ x.T
            union = sizes[:, None] + sizes[None, :] - both
            links[np.ix_(near, near)] = 100 * both >= percent * union
        links &= may
        # a spanning forest holds all that components need
        root = list(range(n))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        out, ids = [], pdf.doc_id.tolist()
        for i, j in zip(*np.nonzero(links), strict=True):
            a, b = find(int(i)), find(int(j))
            if a != b:
                root[a] = b
                out.append((ids[i], ids[j]))
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    return run


def near_duplicates(docs: DataFrame, shingle: int = 3, percent: int = 85) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, kept.

    Documents are linked when 100 * shared >= percent * united distinct shingles of so many lower-cased words. Component
    ids are the smallest doc_id reachable over links. A null or blank text has no shingles and no links. Rows that share
    a doc_id are one document with the links of each. A row with a null doc_id links to nothing: its component_id is null
    and it is kept. No rows give no rows; columns besides doc_id and text are ignored.
    """
    signer = Signer(shingle, band_rows(percent / 100))
    base = save(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text")).mapInArrow(_sign(signer), "doc_id long, n_shingles long, key binary, bands array<long>, sketch binary, size long"))
    live = base.where("doc_id is not null and key is not null")
    reps = save(live.groupBy("key").agg(F.min_by(F.struct("doc_id", "bands", "sketch", "size"), "doc_id").alias("r")).select("key", "r.*"))
    copies = live.select("doc_id", "key").join(reps.select("key", F.col("doc_id").alias("rep")), "key").where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    banded = reps.select("doc_id", F.explode("bands").alias("band"))
    leaders = save(banded.groupBy("band").agg(F.min("doc_id").alias("leader"), F.max("doc_id").alias("last")).where("leader < last").select("band", "leader"))
    stars = banded.join(leaders, "band").where("doc_id <> leader").select(F.col("doc_id").alias("a"), F.col("leader").alias("b"))
    clusters = components(stars)
    sized = clusters.join(reps.select(F.col("doc_id").alias("node"), "key", "sketch", "size"), "node")
    extent = save(sized.groupBy("component").agg(F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("size") / BLOCK_BYTES)).alias("blocks")))
    spot = F.shiftright(F.xxhash64("node"), 20)
    members = save(sized.join(extent, "component").select(F.col("node").alias("doc_id"), "key", "component", "sketch", "blocks", F.pmod(spot, "blocks").alias("block"), (F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks") * BLOCK_ROWS) < PIVOTS).alias("pivot")))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    held = save(members.join(texts, "doc_id"))
    drop(leaders, clusters, extent)
    none = [F.lit(-1).cast("long").alias("y"), F.lit(0).alias("side"), F.lit(0).cast("long").alias("comp")]
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    what = ["doc_id", "key", "sketch", "text", "component"]
    own = held.select(*what, F.col("block").alias("x"), *none)
    shared = held.where("pivot and blocks > 1").select(*what, every("blocks").alias("x"), *none)
    unit, confirm = ["component", "x", "y"], _confirm(signer, percent)
    links = first = save(own.unionByName(shared).groupBy(*unit).applyInPandas(confirm, "a long, b long"))
    big = held.where("blocks > 1")
    if not big.isEmpty():
        joined = components(first).select(F.col("node").alias("doc_id"), F.col("component").alias("found"))
        wide = save(big.join(joined, "doc_id", "left").withColumn("comp", F.coalesce("found", "doc_id")))
        main = save(wide.groupBy("component", "comp").count().groupBy("component").agg(F.max_by("comp", F.struct("count", "comp")).alias("main")))
        left = wide.join(main, "component").where("comp <> main")
        lots = save(left.groupBy("component").agg(F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum(F.length("text")) / BLOCK_BYTES)).alias("lots")))
        a = left.join(lots, "component").select(*what, every("blocks").alias("x"), F.pmod(F.shiftright(F.xxhash64("doc_id", F.lit(2)), 20), "lots").alias("y"), F.lit(1).alias("side"), "comp")
        b = wide.join(lots, "component").select(*what, F.col("block").alias("x"), every("lots").alias("y"), F.lit(2).alias("side"), "comp")
        links = first.unionByName(save(a.unionByName(b).groupBy(*unit).applyInPandas(confirm, "a long, b long")))
        drop(wide, main, lots)
    found = components(links.unionByName(copies)).select(F.col("node").alias("doc_id"), F.col("component").alias("least"))
    drop(members, held, first, reps)
    component = F.coalesce("least", "doc_id")
    return base.join(found, "doc_id", "left").select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
