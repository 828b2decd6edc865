"""Cross-entropy difference of two matched bigram models with exact counts.

A target model and a background model share one vocabulary, one order and one smoothing. Documents are dealt into lots of
rows as they are read, and lots into parts of some bytes of text. Each part's words and bigrams, as 63-bit hashes with
their counts, are cut into ranges of the hash; a range is summed over all parts, and each part gets back the totals of its
grams in their order. So what is gathered grows with the input, is spread by hash, and no count is approximate. Lots are
sized and ranges are numbered by the bytes of all texts, so that a task holds as much of a large table as of a small one,
in whatever partitions it comes.

A document's own counts are left out of the models that score it, so none is favoured by its own text, and a text that
occurs elsewhere too stands apart. Its score is its mean loss per word under the background less that under the target:
higher is more like the target.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from .common import gram_hashes, save, word_bytes

BIGRAM_SHARE = 0.7
PSEUDO = 0.5
#: Rows of a lot at most, as a power of two; of texts that are longer on average, fewer.
LOT_BITS = 12
#: Bytes of text of a lot on average, and of a part at most if it has more than one text.
LOT_BYTES = 8 << 20
#: Bytes of text whose grams are summed in one range.
RANGE_BYTES = 16 << 20
#: Target ids that may be broadcast, under 64 MB; with more, texts and ids are shuffled by doc_id.
BROADCAST_IDS = 2_000_000
_COUNTS = pa.schema([("range", pa.int32()), ("lot", pa.int64()), ("part", pa.int32()), ("grams", pa.binary()), ("background", pa.binary()), ("target", pa.binary())])
_TOTALS = pa.schema([("range", pa.int32()), ("lot", pa.int64()), ("part", pa.int32()), ("background", pa.binary()), ("target", pa.binary()), ("proof", pa.int64()), ("words", pa.int64()), ("all_b", pa.int64()), ("all_t", pa.int64())])
_SCORES = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("target_loss", pa.float64()), ("background_loss", pa.float64()), ("score", pa.float64())])
_ODD = np.uint64(1)


def _grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words, which are even, and of the bigrams, which are odd."""
    words = word_bytes(text)
    return gram_hashes(words, 1) & ~_ODD, (gram_hashes(words, 2) if len(words) > 1 else np.zeros(0, np.uint64)) | _ODD


def _pack(x: np.ndarray) -> bytes:
    """64-bit numbers as zstandard of their byte planes."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x).astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes())


def _unpack(data: pa.BinaryScalar) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data.as_buffer()), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view("<i8").ravel()


def _steps(grams: np.ndarray) -> np.ndarray:
    """Sorted hashes as differences, whose high bytes are mostly zero."""
    return np.diff(grams, prepend=np.uint64(0)).view(np.int64)


def _hashes(data: pa.BinaryScalar) -> np.ndarray:
    return np.cumsum(_unpack(data).view(np.uint64), dtype=np.uint64)


def _proof(grams: np.ndarray, counts: np.ndarray) -> int:
    """A sum over all grams of a lot, by which a lot that was read differently is found."""
    with np.errstate(over="ignore"):
        return int((grams * counts.astype(np.uint64)).sum(dtype=np.uint64).astype(np.int64))


def _parts(rows: Iterable[tuple], most: int) -> Iterator[tuple]:
    """(lot, part, text, *others) of rows of (lot, text, *others) in their order, with at most that many bytes of text in a
    part or one longer text."""
    at, part, held = None, 0, 0
    for lot, text, *others in rows:
        size = text.as_buffer().size if text.is_valid else 0
        if lot != at:
            at, part, held = lot, 0, 0
        elif held and held + size > most:
            part, held = part + 1, 0
        held += size
        yield lot, part, text.as_py(), *others


def _count(ranges: int, most: int):
    edges = np.array([(i << 64) // ranges for i in range(1, ranges)], np.uint64)

    def counted(lot: int, part: int, every: list, aimed: list) -> pa.RecordBatch:
        grams, b = np.unique(np.concatenate(every), return_counts=True)
        t = np.zeros(len(grams), np.int64)
        if aimed:
            own, n = np.unique(np.concatenate(aimed), return_counts=True)
            t[np.searchsorted(grams, own)] = n
        cuts = [0, *np.searchsorted(grams, edges).tolist(), len(grams)]
        at = [(i, x, y) for i, (x, y) in enumerate(zip(cuts, cuts[1:], strict=False)) if x < y]
        columns = [[_pack(f(v[x:y])) for _, x, y in at] for v, f in ((grams, _steps), (b, np.asarray), (t, np.asarray))]
        return pa.RecordBatch.from_arrays([pa.array([i for i, _, _ in at], pa.int32()), pa.array([lot] * len(at), pa.int64()), pa.array([part] * len(at), pa.int32()), *[pa.array(c, pa.binary()) for c in columns]], schema=_COUNTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, every, aimed = None, [], []
        rows = (row for batch in batches for row in zip(batch.column("lot").to_pylist(), batch.column("text"), batch.column("target").to_pylist(), strict=True))
        for lot, part, text, target in _parts(rows, most):
            if (lot, part) != at:
                if every:
                    yield counted(*at, every, aimed)
                at, every, aimed = (lot, part), [], []
            one, two = _grams(text)
            if len(one):
                every += [one, two]
                aimed += [one, two] if target else []
        if every:
            yield counted(*at, every, aimed)

    return run


def _sum(table: pa.Table) -> pa.Table:
    """A range's totals: for each part those of its grams in their order, and one row of lot -1 for the whole range."""
    sizes = [zstandard.frame_content_size(x.as_buffer()) // 8 for x in table.column("grams")]
    ends = np.cumsum(sizes).tolist()
    places = list(zip([0, *ends], ends, strict=False))
    # Counts of a part are under 2^32, as a text is under 2 GB.
    grams, b, t = (np.empty(ends[-1], kind) for kind in (np.uint64, np.uint32, np.uint32))
    for column, into, f in (("grams", grams, _hashes), ("background", b, _unpack), ("target", t, _unpack)):
        for (x, y), data in zip(places, table.column(column), strict=True):
            into[x:y] = f(data)
    order = np.argsort(grams, kind="stable")
    lined = grams[order]
    new = np.concatenate([[True], lined[1:] != lined[:-1]])
    first = np.flatnonzero(new)
    even = lined[first] & _ODD == 0
    del lined
    all_b, all_t = (np.add.reduceat(x[order], first, dtype=np.int64) for x in (b, t))
    which = np.empty(len(grams), np.uint32 if len(grams) < 1 << 32 else np.int64)
    which[order] = np.cumsum(new, dtype=which.dtype) - which.dtype.type(1)
    del order, new, first
    rows, r = [], table.column("range")[0].as_py()
    for lot, part, (x, y) in zip(table.column("lot").to_pylist(), table.column("part").to_pylist(), places, strict=True):
        rows.append((r, lot, part, _pack(all_b[which[x:y]]), _pack(all_t[which[x:y]]), _proof(grams[x:y], b[x:y]), 0, 0, 0))
    rows.append((r, -1, 0, b"", b"", 0, int(even.sum()), int(all_b[even].sum()), int(all_t[even].sum())))
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _TOTALS, strict=True)], schema=_TOTALS)


def _own(of: np.ndarray, gram: np.ndarray, grams: int) -> np.ndarray:
    """For each place how often its gram occurs in its own document."""
    _, where, n = np.unique(of * grams + gram, return_inverse=True, return_counts=True)
    return n[where]


def _score(size: int, totals: tuple[int, int], most: int):
    def scored(ids: pa.Array, pairs: list, aimed: np.ndarray, known: pa.Table) -> pa.Table:
        n = np.array([len(one) for one, _ in pairs], np.int64)
        one, two = (np.concatenate([p[k] for p in pairs]) for k in (0, 1))
        pairs.clear()
        follows = np.ones(len(one), bool)  # words that have one before them
        starts = (np.cumsum(n) - n)[n > 0]
        follows[starts] = False
        grams, at = np.unique(np.concatenate([one, two]), return_inverse=True)
        known = known.sort_by("range")
        if _proof(grams, np.bincount(at, minlength=len(grams))) != int(np.array(known.column("proof").to_pylist(), np.int64).sum()):
            raise RuntimeError("the rows of docs were dealt differently when read again: write docs to a table first")
        b, t = (np.concatenate([np.zeros(0, np.int64), *[_unpack(x) for x in known.column(c)]]) for c in ("background", "target"))
        if not len(one):
            means = [np.full(len(n), np.nan)] * 2
        else:
            first, second = at[: len(one)], at[len(one) :]
            of = np.repeat(np.arange(len(n)), n)
            own_one, own_two = _own(of, first, len(grams)), _own(of[follows], second, len(grams))
            before = np.flatnonzero(follows) - 1
            means = []
            for counts, total, inside in ((t, totals[1], aimed), (b, totals[0], np.ones(len(n), bool))):
                # What a document itself added to this model is taken away again.
                mine = inside[of]
                c = (counts[first] - own_one * mine).astype(np.float64)
                p = (c + PSEUDO) / (total - (n * inside)[of] + PSEUDO * size)
                two = counts[second] - own_two * mine[follows]
                p[follows] = (1 - BIGRAM_SHARE) * p[follows] + BIGRAM_SHARE * np.where(c[before] > 0, two / np.maximum(c[before], 1), p[follows])
                mean = np.full(len(n), np.nan)
                mean[n > 0] = np.add.reduceat(-np.log(p), starts) / n[n > 0]
                means.append(mean)
        columns = [pa.array(x, pa.float64(), mask=n == 0) for x in (*means, means[1] - means[0])]
        return pa.Table.from_arrays([ids, pa.array(n), *columns], schema=_SCORES)

    def run(texts: pa.Table, known: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return _SCORES.empty_table()
        order = np.argsort(texts.column("row").to_numpy())  # as counted
        ids, aimed = texts.column("doc_id").combine_chunks().take(pa.array(order)), np.array(texts.column("target").to_pylist(), bool)[order]
        text, of = texts.column("text"), known.column("part").to_numpy()
        out, start, at, pairs = [], 0, 0, []

        def close(end: int) -> None:
            out.append(scored(ids.slice(start, end - start), pairs, aimed[start:end], known.filter(pa.array(of == at))))

        for i, (_, part, words) in enumerate(_parts(((0, text[int(k)]) for k in order), most)):
            if part != at:
                close(i)
                start, at = i, part
            pairs.append(_grams(words))
        close(texts.num_rows)
        return pa.concat_tables(out)

    return run


def cross_entropy_difference(docs: DataFrame, target_ids: DataFrame) -> DataFrame:
    """doc_id, n_words, target_loss, background_loss, score: one row per row of docs, whatever its other columns.

    The target model counts the documents whose doc_id is in target_ids, the background model all. A text without words
    has no losses and no score (nulls). Null doc_ids are scored and are no targets; repeated rows count and are scored
    each, with their own counts left out and the others' left in. Where no other document is a target the target model is
    uniform. Very long texts are scored whole; no rows give no rows. docs is read for its size and then twice, and must come
    in the same partitions and order; where it does not, the run fails.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    n, size = texts.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    bits = max(0, min(LOT_BITS, int(math.log2(LOT_BYTES * max(1, n) / max(1, size)))))
    ranges = max(8, -(-size // RANGE_BYTES))
    texts = texts.withColumn("row", F.monotonically_increasing_id()).withColumn("lot", F.shiftright("row", bits))
    ids = target_ids.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct().withColumn("target", F.lit(True))
    ids = save(ids)
    few = ids.count() <= BROADCAST_IDS
    marked = texts.join(F.broadcast(ids) if few else ids, "doc_id", "left").select("doc_id", "text", "row", "lot", F.coalesce("target", F.lit(False)).alias("target"))
    if not few:
        marked = marked.repartition("lot").sortWithinPartitions("row")  # counted lot by lot
    counts = marked.select("lot", "text", "target").mapInArrow(_count(ranges, LOT_BYTES), "range int, lot long, part int, grams binary, background binary, target binary")
    totals = save(counts.groupBy("range").applyInArrow(_sum, "range int, lot long, part int, background binary, target binary, proof long, words long, all_b long, all_t long"))
    size, *every = totals.where("lot = -1").agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("words", "all_b", "all_t")]).first()
    known = totals.where("lot >= 0").select("range", "lot", "part", "background", "target", "proof")
    return marked.groupBy("lot").cogroup(known.groupBy("lot")).applyInArrow(_score(max(1, size), tuple(every), LOT_BYTES), "doc_id long, n_words long, target_loss double, background_loss double, score double")
