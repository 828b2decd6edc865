"""Best-fit packing of token sequences in rounds, from lots of a partition to all partitions together.

Each task tokenizes its documents, cuts long ones, and packs the pieces of a lot best-fit: longest first, each into the
fullest bin that still holds it. Bins that are full or nearly so are emitted; what lies in the others goes on. The next
round merges the rest of the lots of neighbouring partitions and packs it anew, which again emits nearly full bins. What is
left then is packed at the root: what best fit does depends on how many pieces there are of each length only, at most
CAPACITY numbers, so the driver packs those counts by runs of equal bins, and pieces, numbered within their length, are
given their places. So no piece is held back or left out, however much is left over.

The pieces of an underfull bin go on one by one and not as the bin that they lay in: bins that stay together would keep
out what lies in other partitions (partitions of 600 and of 400 tokens would take 60 sequences where 40 do).
"""

from __future__ import annotations

import base64
import functools
import pathlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer

from .common import save

CAPACITY = 1024
#: Characters from which on a text goes to tokenizers, as tiktoken takes time that grows faster than a single long word.
FAST = 1_000_000
#: Pieces that a task packs at a time, partitions whose lots are merged, and the fill from which on a bin is emitted.
LOT, MERGED, NEARLY = 16_384, 8, 1020
_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, lot int, bin int, offset long"
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("part", pa.int32()), ("lot", pa.int32()), ("bin", pa.int32()), ("offset", pa.int64())])
_OUT = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


class Encoder:
    """Token ids of byte_bpe_50k.

    tiktoken gives the ids of the tokenizers file five times faster for the same vocabulary. Texts that spell out a
    special token, or that tiktoken cannot take, go to tokenizers itself.
    """

    def __init__(self, path: str):
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, pathlib.Path(path).with_suffix(".tiktoken").read_bytes().splitlines())}
        self.path, self.fast = path, tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    @functools.cached_property
    def exact(self) -> Tokenizer:
        return Tokenizer.from_file(self.path)

    def __call__(self, text: str) -> np.ndarray:
        if "<|endoftext|>" not in text and len(text) < FAST:
            try:
                return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4")
            except ValueError:  # what UTF-8 can't hold
                pass
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, "<u4")


@functools.lru_cache(2)
def encoder(path: str) -> Encoder:
    """One a Python worker, which serves many tasks."""
    return Encoder(path)


def pieces(doc_id: int | None, ids: np.ndarray, capacity: int = CAPACITY) -> list[tuple]:
    """(doc_id, piece, start, length, ids_crc32) of a document's ids: whole, or cut so that only the first may be short."""
    first = len(ids) % capacity or capacity
    cuts = [0, *range(first, len(ids) + 1, capacity)] if len(ids) > capacity else [0, len(ids)]
    return [(doc_id, i, a, b - a, zlib.crc32(ids[a:b].tobytes())) for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]


def best_fit(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Bins of indices: longest first, each into the fullest bin that still holds it."""
    bins: list[list[int]] = []
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    free = 0  # bit r: some bin has room r
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        n = sizes[i]
        if up := free >> n:
            r = n + (up & -up).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                free ^= 1 << r
            bins[b].append(i)
        else:
            r, b = capacity, len(bins)
            bins.append([i])
        if r - n:
            room[r - n].append(b)
            free |= 1 << (r - n)
    return bins


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit of counts[n] pieces of each length n: (length, first, last, sequence_id, each, offset).

    The pieces numbered first to last - 1 of their length go, each of them a bin, to the bins from sequence_id on; the
    bin's first one lies at offset. Bins have the same totals as those of best_fit, in time that does not depend on counts.
    """
    out: list[tuple[int, int, int, int, int, int]] = []
    room: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # runs (first bin, bins) by their room
    used = 0
    for n in sorted(counts, reverse=True):
        at, left = 0, counts[n]
        for r in range(n, capacity + 1):
            # Best fit fills a bin with pieces of one length as far as they go before it turns to the next.
            k = r // n
            while left and (room[r] or r == capacity):
                first, bins = room[r].pop() if room[r] else (used, -(-left // k))
                used = max(used, first + bins)
                full = min(bins, left // k)
                for b, m, each in ((first, full, k), (first + full, int(full < bins and left > full * k), left - full * k)):
                    if m:
                        out.append((n, at, at + m * each, b, each, capacity - r))
                        room[r - each * n].append((b, m))
                        at, left = at + m * each, left - m * each
                        first, bins = b + m, bins - m
                if bins:
                    room[r].append((first, bins))
    return out


def emitted(sizes: list[int], capacity: int = CAPACITY) -> tuple[list[int | None], list[int]]:
    """Bin and offset of each piece by best fit; no bin for those whose bin stays under NEARLY of 1024."""
    bin_, offset, nth = [None] * len(sizes), [0] * len(sizes), 0
    for b in best_fit(sizes, capacity):
        if sum(sizes[i] for i in b) * CAPACITY >= NEARLY * capacity:
            at = 0
            for i in b:
                bin_[i], offset[i] = nth, at
                at += sizes[i]
            nth += 1
    return bin_, offset


def _cut(path: str, end_id: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, lot, held = encoder(path), TaskContext.get().partitionId(), 0, []
        tail = np.array([end_id], "<u4")

        def rows():
            """A lot's pieces with their places, in batches."""
            nonlocal held, lot
            bin_, offset = emitted([x[3] for x in held], capacity)
            every = [(*x, part, lot, b, o) for x, b, o in zip(held, bin_, offset, strict=True)]
            held, lot = [], lot + 1
            for at in range(0, len(every), 4096):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*every[at : at + 4096], strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)

        for b in batches:
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                held += pieces(doc_id, np.concatenate([encode(text.as_py() or ""), tail]), capacity)
                if len(held) >= LOT:
                    yield from rows()
        if held:
            yield from rows()

    return run


def _merge(capacity: int):
    def run(left: pd.DataFrame) -> pd.DataFrame:
        """The left pieces of some lots packed together; those that are left again are numbered within their length."""
        left = left.sort_values(["part", "doc_id", "start"], kind="stable")
        bin_, offset = emitted(left["length"].tolist(), capacity)
        left = left.assign(bin=pd.array(bin_, "Int32"), offset=offset)
        return left.assign(nth=left.groupby([left["bin"].isna(), "length"]).cumcount())

    return run


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece of a document.

    A null or empty text is the end id alone. Rows are packed one by one, so repeated rows and null doc_ids each take
    their place; very long texts are packed whole. No rows give no rows; columns besides doc_id and text are ignored.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    cut = save(texts.mapInArrow(_cut(tokenizer, end_id, capacity), _PIECE))
    # Numbers of sequences: by round, then by where it packed them.
    number = lambda level, of, lot: (((of.cast("long") * (1 << 20) + lot) * (1 << 20) + F.col("bin")) * 3 + level).alias("sequence_id")
    first = cut.where("bin is not null").withColumn("sequence_id", number(0, F.col("part"), F.col("lot")))
    group = F.floor(F.col("part") / MERGED).cast("long").alias("group")
    left = cut.where("bin is null").withColumn("group", group)
    merged = save(left.groupBy("group", "lot").applyInPandas(_merge(capacity), _PIECE + ", group long, nth long"))
    second = merged.where("bin is not null").withColumn("sequence_id", number(1, F.col("group"), F.col("lot")))
    rest = merged.where("bin is null").drop("offset", "bin")
    counts = save(rest.groupBy("group", "lot", "length").agg(F.count("*").alias("n")))
    total = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity rows at most
    before = Window.partitionBy("length").orderBy("group", "lot").rowsBetween(Window.unboundedPreceding, -1)
    base = save(counts.select("group", "lot", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    runs = docs.sparkSession.createDataFrame(plan(total, capacity), "of long, first long, last long, bin long, each long, at long")
    ranked = rest.join(base, ["group", "lot", "length"]).withColumn("nth", F.col("base") + F.col("nth"))
    placed = ranked.join(F.broadcast(runs), F.expr("length = of and nth >= first and nth < last"))
    sequence, offset = F.expr("(bin + (nth - first) div each) * 3 + 2"), F.expr("at + (nth - first) % each * length")
    third = placed.withColumn("sequence_id", sequence).withColumn("offset", offset)
    return first.select(*_OUT).unionByName(second.select(*_OUT)).unionByName(third.select(*_OUT))
