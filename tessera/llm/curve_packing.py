"""Packing of neighbouring documents into sequences, along a Hilbert curve through projected document vectors.

Each document's token ids are hashed to a vector of damped counts, which fixed random directions project to a few
coordinates; their place on a Hilbert curve is the document's key. Documents are range-sorted by key, so those of like
words come to lie in one range and next to each other, and each range is filled into sequences in that order without
gaps. A range's last tokens, too few for a sequence, become sequences of powers of two, which need no padding either.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import drop, mix, save
from .packing import CAPACITY, encoder

#: Cells of a document's vector, coordinates it is projected to, and bits of each coordinate in the key.
CELLS, COORDINATES, BITS = 1024, 4, 15
#: Where coordinates of unit vectors end on the grid; what lies beyond is at the edge.
REACH = 2.5
#: Tokens in a row of the tokenized table, so that a very long document is many rows.
ROW_TOKENS = 16_384
#: Tokens a range is meant to hold, and the most ranges there are; beyond that they grow.
RANGE_TOKENS, MOST_RANGES = 4_000_000, 20_000
_TOKENS = "key long, doc_id long, lot int, nth long, start long, doc_tokens long, wide string, ids binary"
_ROW = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("lot", pa.int32()), ("nth", pa.int64()), ("start", pa.int64()), ("doc_tokens", pa.int64()), ("wide", pa.string()), ("ids", pa.binary())])
_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_OUT = pa.schema([(c.split()[0], pa.int64()) for c in _PIECE.split(", ")])


@functools.lru_cache(1)
def _directions() -> np.ndarray:
    return np.random.default_rng(13).standard_normal((CELLS, COORDINATES))


@functools.lru_cache(1)
def _cells(ids: int) -> np.ndarray:
    """The cell that each token id is hashed to."""
    return (mix(np.arange(ids, dtype=np.uint64)) % np.uint64(CELLS)).astype(np.int64)


def coordinates(docs: list[np.ndarray]) -> np.ndarray:
    """Places of documents on the grid, one a row, each coordinate from 0 to 2 ** BITS - 1."""
    most = 1 + max((int(d.max()) for d in docs if len(d)), default=0)
    cells = _cells(1 << (most - 1).bit_length())
    v = np.log1p(np.stack([np.bincount(cells[d], minlength=CELLS) for d in docs]))
    at = v @ _directions() / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
    return np.clip((at + REACH) / (2 * REACH) * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)


def hilbert_keys(at: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places on the Hilbert curve through a grid of 2 ** bits points a side: neighbouring keys are neighbouring points.

    Bits are taken from the highest down. The cube entered at a level is turned as the Gray code of its corner asks: the
    curve inside is the mirrored or exchanged one, so coordinates below that level are mirrored or exchanged.
    """
    x, key = at.T.astype(np.int64).copy(), np.zeros(len(at), np.int64)
    for level in range(bits - 1, -1, -1):
        low = np.int64((1 << level) - 1)
        for i in range(len(x)):
            high = (x[i] >> level & 1).astype(bool)
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[i] ^= swap
            x[0] ^= np.where(high, low, swap)
    odd = np.zeros(len(at), np.int64)
    for level in range(bits - 1, -1, -1):
        for i in range(len(x)):
            odd ^= x[i] >> level & 1
            key = key << 1 | odd
    return key


def _tokenize(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, lot, nth, tail = encoder(path), TaskContext.get().partitionId(), 0, np.array([end_id], "<u4")
        held, size = [], 0

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), _ROW, strict=True)], schema=_ROW)

        def lots(b: pa.RecordBatch) -> Iterator[tuple[list, list[np.ndarray]]]:
            """Documents of a batch some hundreds at a time, fewer where they are long."""
            names, docs, tokens = [], [], 0
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                names.append(doc_id)
                docs.append(np.concatenate([encode(text.as_py() or ""), tail]))
                tokens += len(docs[-1])
                if len(docs) == 256 or tokens > 1 << 20:
                    yield names, docs
                    names, docs, tokens = [], [], 0
            if docs:
                yield names, docs

        for b in batches:
            for names, docs in lots(b):
                keys = hilbert_keys(coordinates(docs)).tolist()
                for doc_id, ids, key in zip(names, docs, keys, strict=True):
                    wide = "<u2" if int(ids.max()) < 1 << 16 else "<u4"
                    for at in range(0, len(ids), ROW_TOKENS):
                        part = ids[at : at + ROW_TOKENS].astype(wide).tobytes()
                        held.append((key, doc_id, lot, nth, at, len(ids), wide, part))
                        size += len(part)
                        if size > 1 << 22:
                            yield rows()
                            held, size = [], 0
                    nth += 1
        if held:
            yield rows()

    return run


def tails(length: int) -> list[int]:
    """The powers of two that length is the sum of, falling."""
    return [1 << i for i in range(length.bit_length() - 1, -1, -1) if length >> i & 1]


class Filler:
    """Sequences of capacity tokens from documents in order; pieces of the open sequence are held, at most its tokens."""

    def __init__(self, lot: int, capacity: int):
        self.lot, self.capacity, self.nth, self.out = lot, capacity, 0, []
        self.open: list[tuple[tuple, int, np.ndarray]] = []  # (document, start, ids)
        self.room = capacity

    def add(self, doc: tuple, start: int, ids: np.ndarray) -> None:
        while len(ids):
            part, ids = ids[: self.room], ids[self.room :]
            self.open.append((doc, start, part))
            start += len(part)
            self.room -= len(part)
            if not self.room:
                self._close(self.open)
                self.open, self.room = [], self.capacity

    def finish(self) -> None:
        left, self.open = self.open, []
        for n in tails(self.capacity - self.room):
            own = []
            while n:
                doc, start, ids = left[0]
                own.append((doc, start, ids[:n]))
                left[0:1] = [(doc, start + n, ids[n:])] if len(ids) > n else []
                n -= len(own[-1][2])
            self._close(own)
        self.room = self.capacity

    def _close(self, parts: list) -> None:
        sequence, offset = (self.lot << 40) + self.nth, 0
        self.nth += 1
        while parts:
            doc, start, ids = parts[0]
            crc, n, i = zlib.crc32(ids.tobytes()), len(ids), 1
            while i < len(parts) and parts[i][0] == doc:  # the rows of a very long document go on in one piece
                crc, n, i = zlib.crc32(parts[i][2].tobytes(), crc), n + len(parts[i][2]), i + 1
            self.out.append((doc[0], start, n, crc, doc[3], sequence, offset))
            offset, parts = offset + n, parts[i:]


def _fill(capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filler = Filler(TaskContext.get().partitionId(), capacity)

        def rows():
            columns = zip(*filler.out, strict=True)
            filler.out = []
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_OUT)

        for b in batches:
            for doc_id, lot, nth, start, total, wide, ids in zip(*(b.column(c).to_pylist() for c in ("doc_id", "lot", "nth", "start", "doc_tokens", "wide")), b.column("ids"), strict=True):
                filler.add((doc_id, lot, nth, total), start, np.frombuffer(ids.as_buffer(), wide).astype("<u4"))
                if len(filler.out) > 5000:
                    yield rows()
        filler.finish()
        if filler.out:
            yield rows()

    return run


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: one row per piece of a document.

    A null or empty text is the end id alone. Documents are cut where a sequence is full and nowhere else but at the end
    of a range. Documents of one key, as copies are, lie next to each other in the order of doc_id and of the rows; they
    may be split between ranges. Rows are packed one by one, so repeated rows and null doc_ids each take their place; very
    long texts are packed whole; no rows give no rows; columns besides doc_id and text are ignored.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    tokens = save(texts.mapInArrow(_tokenize(tokenizer, end_id), _TOKENS))
    total = tokens.where("start = 0").agg(F.sum("doc_tokens")).first()[0] or 0
    ranges = min(MOST_RANGES, 1 + total // RANGE_TOKENS)
    order = ["key", "doc_id", "lot", "nth", "start"]
    lined = tokens.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    # Written, because another run of the plan may draw other range bounds.
    out = save(lined.mapInArrow(_fill(capacity), _PIECE))
    drop(tokens)
    return out
