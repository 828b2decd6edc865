"""Copies of images by local descriptors.

Multiscale Harris corners, as many as the picture's area asks for, get an orientation from their patch's intensity
centroid and a binary descriptor of 128 brightness tests turned by it. A descriptor is cut into TABLES words of 64 bits,
and images that share MEET words are candidates (Hamming tables: a pair of descriptors within one bit always shares one).
Buckets of up to RARE images are joined with themselves. In larger ones each image is compared with a few pivots, and
what is then outside the bucket's largest component meets the others again by a second word; so every candidate pair is
compared or already in one class, and no bucket gives all its pairs.

Keypoints of candidates are matched within NEAR bits, best for both; a pair is a copy when INLIERS places agree on one
rotation, scale and shift.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import components, drop, save

TABLES = 2
WORDS = 4
LEVELS = (1.0, 0.7071, 0.5)
#: Corners of a level: at least so many, and one per so many of its pixels.
PER_LEVEL, PIXELS = 16, 400
RADIUS = 8
MEET = 2
RARE = 64
PIVOTS = 4
INLIERS = 6
CELL = 6.0
NEAR = 24
SHIFT = 2.0
TURN = 0.2
LOT = 256

_rng = np.random.default_rng(31)
_TESTS = np.clip(_rng.normal(0, RADIUS / 2, (32 * WORDS, 2, 2)), -RADIUS + 1, RADIUS - 1)
_DISC = np.array([(x, y) for x in range(-RADIUS, RADIUS + 1) for y in range(-RADIUS, RADIUS + 1) if x * x + y * y <= RADIUS * RADIUS])


def _png(data: bytes) -> np.ndarray | None:
    at, packed, head = 8, b"", None
    while at + 8 <= len(data):
        n, kind = struct.unpack(">I4s", data[at : at + 8])
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", data[at + 8 : at + 8 + 13])
        elif kind == b"IDAT":
            packed += data[at + 8 : at + 8 + n]
        at += n + 12
    if head is None or head[2] != 8 or head[3] not in (0, 2, 4, 6) or head[6]:
        return None
    width, height, c = head[0], head[1], {0: 1, 2: 3, 4: 2, 6: 4}[head[3]]
    raw = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(height, 1 + width * c).astype(np.int32)
    out = np.zeros((height + 1, width + 1, c), np.int32)
    for y in range(height):
        line, up, kind = raw[y, 1:].reshape(width, c), out[y], raw[y, 0]
        if kind in (0, 2):
            out[y + 1, 1:] = (line + (up[1:] if kind else 0)) & 255
            continue
        for x in range(width):
            a, b, d = out[y + 1, x], up[x + 1], up[x]
            if kind == 4:
                p, q, r = abs(b - d), abs(a - d), abs(a + b - 2 * d)
                add = np.where((p <= q) & (p <= r), a, np.where(q <= r, b, d))
            else:
                add = a if kind == 1 else (a + b) // 2
            out[y + 1, x + 1] = (line[x] + add) & 255
    return out[1:, 1:, : 3 if c > 2 else 1].mean(2)


def decode(data: bytes | None) -> np.ndarray | None:
    """Grey values of a PNG (8 bits, not interlaced), PGM or PPM (binary) image; None of anything else or broken."""
    try:
        if data[:8] == b"\x89PNG\r\n\x1a\n":
            got = _png(data)
            return None if got is None else got.astype(np.float32)
        if data[:2] in (b"P5", b"P6"):
            width, height, top, pixels = _netpbm(data)
            c = 3 if data[:2] == b"P6" else 1
            return np.frombuffer(pixels, np.uint8, width * height * c).reshape(height, width, c).mean(2, dtype=np.float32) * (255 / top)
    except (ValueError, TypeError, IndexError, zlib.error, struct.error):
        pass
    return None


def _netpbm(data: bytes) -> tuple:
    at, fields = 2, []
    while len(fields) < 3:
        while data[at : at + 1].isspace() or data[at : at + 1] == b"#":
            at = data.index(b"\n", at) + 1 if data[at : at + 1] == b"#" else at + 1
        end = at
        while data[end : end + 1].isdigit():
            end += 1
        fields.append(int(data[at:end]))
        at = end
    if not 0 < fields[2] < 256:
        raise ValueError("only 8 bits")
    return *fields, data[at + 1 :]


def _box(x: np.ndarray, r: int) -> np.ndarray:
    p = np.pad(x, ((r + 1, r), (r + 1, r)), mode="edge").cumsum(0).cumsum(1)
    n = 2 * r + 1
    return (p[n:, n:] - p[:-n, n:] - p[n:, :-n] + p[:-n, :-n]) / (n * n)


def _resize(x: np.ndarray, scale: float) -> np.ndarray:
    if scale == 1:
        return x
    h, w = (max(1, round(n * scale)) for n in x.shape)
    ys, xs = (np.clip((np.arange(n) + 0.5) / scale - 0.5, 0, m - 1) for n, m in ((h, x.shape[0]), (w, x.shape[1])))
    y0, x0 = ys.astype(int), xs.astype(int)
    y1, x1 = np.minimum(y0 + 1, x.shape[0] - 1), np.minimum(x0 + 1, x.shape[1] - 1)
    fy, fx = (ys - y0)[:, None], (xs - x0)[None, :]
    return (x[y0][:, x0] * (1 - fx) + x[y0][:, x1] * fx) * (1 - fy) + (x[y1][:, x0] * (1 - fx) + x[y1][:, x1] * fx) * fy


def keypoints(image: np.ndarray) -> list[tuple[float, float, float, float, bytes]]:
    """x, y (at full size), scale, angle and descriptor of each corner."""
    out, edge = [], RADIUS + 2
    for scale in LEVELS:
        g = _resize(_box(image.astype(np.float64), 1) if scale < 1 else image.astype(np.float64), scale)
        h, w = g.shape
        if min(h, w) < 2 * edge + 3:
            break
        s = _box(g, 1)
        dy, dx = np.gradient(s)
        a, b, c = _box(dx * dx, 2), _box(dy * dy, 2), _box(dx * dy, 2)
        r = a * b - c * c - 0.05 * (a + b) ** 2
        inner = r[edge:-edge, edge:-edge]
        around = np.stack([r[edge + i : h - edge + i, edge + j : w - edge + j] for i in (-1, 0, 1) for j in (-1, 0, 1) if i or j])
        ys, xs = np.nonzero((inner > around.max(0)) & (inner > 1.0))
        best = np.argsort(-inner[ys, xs], kind="stable")[: max(PER_LEVEL, h * w // PIXELS)]
        if not len(best):
            continue
        ys, xs = ys[best] + edge, xs[best] + edge
        patch = s[ys[:, None] + _DISC[:, 1], xs[:, None] + _DISC[:, 0]]
        angle = np.arctan2((patch * _DISC[:, 1]).sum(1), (patch * _DISC[:, 0]).sum(1))
        cos, sin = np.cos(angle)[:, None, None], np.sin(angle)[:, None, None]
        px, py = _TESTS[None, :, :, 0], _TESTS[None, :, :, 1]
        smooth = _box(g, 2)
        x = np.clip(np.rint(xs[:, None, None] + cos * px - sin * py), 0, w - 1).astype(int)
        y = np.clip(np.rint(ys[:, None, None] + sin * px + cos * py), 0, h - 1).astype(int)
        v = smooth[y, x]
        bits = np.packbits(v[:, :, 0] < v[:, :, 1], axis=1)
        out += [(float((xx + 0.5) / scale), float((yy + 0.5) / scale), scale, float(t), d.tobytes()) for xx, yy, t, d in zip(xs, ys, angle, bits, strict=True)]
    return out


_ROWS = pa.schema([("media_id", pa.int64()), ("key", pa.binary()), ("places", pa.list_(pa.float32())), ("codes", pa.list_(pa.int32()))])


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, 500):
            part, keys, places, codes = b.slice(at, 500), [], [], []
            for data in part.column("content"):
                image = decode(data.as_py())
                keys.append(None if image is None else hashlib.sha256(struct.pack("<II", *image.shape) + np.rint(image).astype(np.uint8).tobytes()).digest())
                found = [] if image is None or not image.size else keypoints(image)
                places.append([v for p in found for v in p[:4]])
                codes.append(np.frombuffer(b"".join(p[4] for p in found), np.int32))
            yield pa.RecordBatch.from_arrays([part.column("media_id"), pa.array(keys, pa.binary()), pa.array(places, pa.list_(pa.float32())), pa.array(codes, pa.list_(pa.int32()))], schema=_ROWS)


def matches(pa_: np.ndarray, ca: np.ndarray, pb: np.ndarray, cb: np.ndarray) -> int:
    """Keypoints of two images (places of 4 numbers, codes of WORDS numbers) whose descriptors and geometry agree."""
    a, b = np.asarray(ca, np.int32).view(np.uint32).reshape(-1, WORDS), np.asarray(cb, np.int32).view(np.uint32).reshape(-1, WORDS)
    if not len(a) or not len(b):
        return 0
    # Rows of a are taken in lots, so that two large pictures need no table of all their pairs.
    best, to, back, frm = [], [], np.full(len(b), 999), np.zeros(len(b), int)
    for at in range(0, len(a), LOT):
        bits = np.bitwise_count(a[at : at + LOT, None] ^ b[None]).sum(2)
        best.append(bits.min(1))
        to.append(bits.argmin(1))
        low = bits.min(0)
        frm = np.where(low < back, at + bits.argmin(0), frm)
        back = np.minimum(back, low)
    best, to = np.concatenate(best), np.concatenate(to)
    i = np.flatnonzero((best <= NEAR) & (frm[to] == np.arange(len(a))))
    x, y = np.asarray(pa_, np.float64).reshape(-1, 4), np.asarray(pb, np.float64).reshape(-1, 4)
    return consensus(np.hstack([x[i], y[to[i]]]))


def consensus(pairs: np.ndarray) -> int:
    """Most places that agree on one rotation, scale and shift, of keypoint pairs (x, y, scale, angle of both a row).

    Corners of one place at several scales count once: places are squares of CELL pixels of the first image.
    """
    if len(pairs) < INLIERS:
        return 0
    xa, ya, sa, ta, xb, yb, sb, tb = pairs.T
    turn, zoom = tb - ta, sa / sb
    cos, sin = np.cos(turn) * zoom, np.sin(turn) * zoom
    dx, dy = xb - (cos * xa - sin * ya), yb - (sin * xa + cos * ya)
    cell = np.unique(np.floor(xa / CELL) * 1e6 + np.floor(ya / CELL), return_inverse=True)[1]
    most = 0
    for at in range(0, len(pairs), LOT):
        s = slice(at, at + LOT)
        # Row i: the shift and turn of pair i applied to all pairs.
        x = cos[s, None] * xa - sin[s, None] * ya + dx[s, None]
        y = sin[s, None] * xa + cos[s, None] * ya + dy[s, None]
        apart = np.abs((turn[s, None] - turn + np.pi) % (2 * np.pi) - np.pi)
        fits = (np.hypot(x - xb, y - yb) <= SHIFT * np.maximum(1, zoom)[s, None] / np.minimum(1, sa)) & (apart <= TURN) & (np.abs(np.log(zoom[s, None] / zoom)) < 0.4)
        most = max(most, *(len(np.unique(cell[f])) for f in fits))
    return most


def _least(links: DataFrame) -> DataFrame:
    return components(links).select(F.col("node").alias("rep"), F.col("component").alias("comp"))


def candidates(met: DataFrame) -> DataFrame:
    """a < b, once for each word that they share, of met(rep, word, n) in words of at most RARE images."""
    rare = met.where(F.col("n") <= RARE)
    return rare.select(F.col("rep").alias("a"), "word").join(rare.select(F.col("rep").alias("b"), "word"), "word").where("a < b").select("a", "b")


def pivoted(met: DataFrame) -> DataFrame:
    """a < b: in each word of more than RARE images each image with the word's pivots.

    Pivots are the images that PIVOTS hashes put first, so words of the same images have the same pivots.
    """
    hot = met.where(F.col("n") > RARE)
    first = [F.min(F.struct(F.xxhash64("rep", F.lit(i)).alias("h"), F.col("rep"))).alias(f"p{i}") for i in range(PIVOTS)]
    pivots = hot.groupBy("word").agg(*first).select("word", F.explode(F.array_distinct(F.array(*[F.col(f"p{i}.rep") for i in range(PIVOTS)]))).alias("p"))
    return hot.join(pivots, "word").where("rep <> p").select(F.least("rep", "p").alias("a"), F.greatest("rep", "p").alias("b"))


def left_over(met: DataFrame, found: DataFrame) -> DataFrame:
    """a < b: images of different components that share MEET words, one of them with more than RARE images.

    In each such word the images outside its largest component meet the others again by a second word, so that only pairs
    that share two words are made. A word whose images are one component costs nothing.
    """
    hot = save(met.where(F.col("n") > RARE).join(found, "rep", "left").select("rep", "word", F.coalesce("comp", "rep").alias("comp")))
    sizes = hot.groupBy("word", "comp").count()
    main = save(sizes.groupBy("word").agg(F.max_by("comp", F.struct("count", "comp")).alias("main"), F.count("*").alias("parts")).where("parts > 1").select("word", "main"))
    second = hot.join(main, "word").join(met.select("rep", F.col("word").alias("next")), "rep").where("next <> word")
    second = save(second.select("word", "next", "rep", "comp", (F.col("comp") != F.col("main")).alias("out")))
    one = second.where("out").select("word", "next", F.col("rep").alias("x"), F.col("comp").alias("cx"))
    two = second.select("word", "next", F.col("rep").alias("y"), F.col("comp").alias("cy"))
    return one.join(two, ["word", "next"]).where("cx <> cy").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def copies(media: DataFrame) -> DataFrame:
    """media_id, class_id, n_points: one row per row of media(media_id, content), whatever its other columns.

    class_id is the smallest media_id reachable over links; images of equal pixels are one class. Null, empty and
    unreadable contents (see decode) have null n_points and are in a class of their own; rows that share a media_id are in
    the class of each; a null media_id is in no class (null). No rows give no rows.
    """
    base = save(media.select(F.col("media_id").cast("long").alias("media_id"), "content").mapInArrow(_describe, "media_id long, key binary, places array<float>, codes array<int>"))
    reps = save(base.where("media_id is not null and key is not null").groupBy("key").agg(F.min("media_id").alias("rep")))
    n_points = F.when(F.col("key").isNotNull(), F.floor(F.size("places") / 4)).cast("int").alias("n_points")
    ids = save(base.select("media_id", "key", n_points).join(reps, "key", "left").select("media_id", "n_points", "rep"))
    points = save(base.withColumnRenamed("media_id", "rep").join(reps, ["key", "rep"], "left_semi").select("rep", "places", "codes"))
    drop(base, reps)
    # Words of one table of the two get an even number, those of the other an odd one.
    half = lambda i: F.shiftleft(F.get("codes", i).cast("long"), 32).bitwiseOR(F.pmod(F.get("codes", i + 1).cast("long"), F.lit(1 << 32)))
    table = lambda i: (half(i).bitwiseOR(F.lit(1)) - F.when(i % WORDS == 0, 1).otherwise(0)).cast("long")
    words = F.transform(F.when(F.size("codes") > 0, F.sequence(F.lit(0), F.size("codes") - 1, F.lit(WORDS // TABLES))), table)
    word = points.select("rep", F.explode(F.array_distinct(words)).alias("word"))
    sizes = save(word.groupBy("word").agg(F.count("*").alias("n")).where("n > 1"))
    met = save(word.join(sizes, "word"))

    @F.pandas_udf("long")
    def agreeing(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            yield pd.Series([matches(*x) for x in zip(*columns, strict=True)], dtype="int64")

    def confirmed(pairs: DataFrame) -> DataFrame:
        pairs = save(pairs)
        at = lambda x: points.select(F.col("rep").alias(x), F.col("places").alias(f"places_{x}"), F.col("codes").alias(f"codes_{x}"))
        n = agreeing("places_a", "codes_a", "places_b", "codes_b")
        links = save(pairs.join(at("a"), "a").join(at("b"), "b").select("a", "b", n.alias("n")).where(F.col("n") >= INLIERS).select("a", "b"))
        drop(pairs)
        return links

    shared = candidates(met)
    hot = not sizes.where(F.col("n") > RARE).isEmpty()
    if hot:
        shared = shared.unionByName(pivoted(met))
    links = confirmed(shared.groupBy("a", "b").count().where(F.col("count") >= MEET).select("a", "b"))
    if hot:
        links = links.unionByName(confirmed(left_over(met, _least(links)).distinct()))
    drop(sizes, met)
    found = components(links.unionByName(ids.where("media_id <> rep").select(F.col("media_id").alias("a"), F.col("rep").alias("b")))).select(F.col("node").alias("media_id"), F.col("component").alias("least"))
    return ids.join(found, "media_id", "left").select("media_id", F.coalesce("least", "media_id").alias("class_id"), "n_points")
