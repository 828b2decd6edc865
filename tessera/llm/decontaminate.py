"""Benchmark decontamination by spaced seeds, in DataFrame functions only.

A seed hashes the words of a window at the positions that a fixed mask marks; the others are ignored, so a substituted
word there does not matter. Benchmark items and documents are hashed at every position under each mask. Equal hashes name
a document, an item and the offset between them. Around each such offset the item is laid on the document and the equal
words are counted, which tolerates substitutions at any place.

Of WINDOW words with the substitutions that SHARE allows one of the two masks always finds a window that is equal where
it looks. Items with fewer words have masks of their own that lose none either: with k substitutions allowed the
positions are dealt into k + 1 groups or more, and each mask ignores k of them. Documents are hashed under these only if
the benchmark holds items so short.
"""

from __future__ import annotations

import functools
import itertools
import math

from pyspark.sql import Column, DataFrame, functions as F

from .common import drop, save

MASKS = ("1101011", "1100100101")
WINDOW = 13
SHARE = 0.8
#: Seeds of the benchmark that may be broadcast, about 40 bytes each; with more, both sides are shuffled by the hash.
BROADCAST_SEEDS = 1_000_000
#: Offsets of an item in a document that are verified in one row.
RUN = 4096


def words(text: Column) -> Column:
    """Lower-cased words between ASCII white space."""
    return F.split(F.btrim(F.lower(text), F.lit(" \t\n\x0b\f\r")), "[\\x20\\x09-\\x0D]+")


def short_masks(n: int) -> list[tuple[int, str]]:
    """(first position, mask) that find every item of n < WINDOW words with as many substitutions as SHARE allows."""
    k = n - math.ceil(SHARE * n)
    groups = 1 if not k else 3 if k == 1 else 2 * k
    out = []
    for gone in itertools.combinations(range(groups), k):
        mask = "".join("0" if i * groups // n in gone else "1" for i in range(n))
        out.append((mask.index("1"), mask.strip("0")))
    return out


def _seed(mask: str, shortest: int) -> Column:
    """The seed of a mask at words[at]; null where the mask reaches beyond the last word."""
    seed = F.xxhash64(F.lit(mask), *[F.get("words", F.col("at") + i) for i, c in enumerate(mask) if c == "1"])
    return seed if len(mask) == shortest else F.when(F.col("at") <= F.size("words") - len(mask), seed)


def seeded(tokens: DataFrame, key: str, masks: tuple[str, ...] = MASKS) -> DataFrame:
    """key, at, seed for each mask and each position of tokens.words.

    Positions are exploded first, so that hashing is compiled and no array of seeds is held.
    """
    shortest = min(map(len, masks))
    starts = F.when(F.size("words") >= shortest, F.sequence(F.lit(0), F.size("words") - shortest))
    placed = tokens.select(key, "words", F.explode(starts).alias("at"))
    return placed.select(key, "at", F.explode(F.array(*[_seed(m, shortest) for m in masks])).alias("seed")).where("seed is not null")


def item_seeds(items: DataFrame) -> tuple[DataFrame, tuple[str, ...]]:
    """seed, item_id, from of items(item_id, words), and the masks under which documents are to be hashed."""
    found = [seeded(items.where(F.size("words") >= WINDOW), "item_id").select("seed", "item_id", F.col("at").alias("from"))]
    masks = set(MASKS)
    # At most WINDOW - 1 rows.
    for n in sorted(r[0] for r in items.select(F.size("words").alias("n")).where(F.col("n") < WINDOW).distinct().collect()):
        for first, mask in short_masks(n):
            at = items.where(F.size("words") == n).select("item_id", "words", F.lit(first).alias("at"))
            found.append(at.select(_seed(mask, len(mask)).alias("seed"), "item_id", F.col("at").alias("from")))
            masks.add(mask)
    return functools.reduce(DataFrame.unionByName, found), tuple(sorted(masks))


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, at, matched, compared: where a benchmark item lies in a document, best place first.

    at is the word of the document on which the item's first word falls (negative: the item begins before the document),
    matched the equal words there, compared the item's words inside the document. A place counts if some WINDOW words of
    the item in a row (all, of shorter ones) have SHARE of their words equal in the document. One row per doc_id and
    item_id. Null and blank texts have no words; rows with a null doc_id or item_id are not sought; rows that share an id
    are each searched; very long texts are searched whole, and words that repeat at thousands of offsets are verified in
    runs of RUN offsets, a row of which holds the words that it reaches only. Empty tables give no rows; other columns are ignored.
    """
    items = benchmark.where("item_id is not null and text is not null").select("item_id", words(F.col("text")).alias("words")).where("words[0] <> ''")
    texts = docs.where("doc_id is not null and text is not null").select("doc_id", "text")
    seeds, masks = item_seeds(items)
    known = save(seeds.distinct())
    side = F.broadcast(known) if known.count() <= BROADCAST_SEEDS else known
    offset = (F.col("at") - F.col("from")).alias("offset")
    hits = save(seeded(texts.select("doc_id", words(F.col("text")).alias("words")), "doc_id", masks).join(side, "seed").select("doc_id", "item_id", offset).distinct())
    # The words that a run of offsets reaches are cut out of a text once, and its places are counted within that row.
    runs = hits.groupBy("doc_id", "item_id", F.floor(F.col("offset") / RUN).alias("run")).agg(F.collect_list("offset").alias("offsets"), F.greatest(F.lit(0), F.min("offset")).alias("low"), F.max("offset").alias("high"))
    sized = runs.join(items.select("item_id", F.size("words").alias("length")).groupBy("item_id").agg(F.max("length").alias("length")), "item_id")
    cut = sized.join(texts, "doc_id").withColumn("words", words(F.col("text")))
    near = F.slice("words", F.col("low") + 1, F.greatest(F.lit(0), F.col("high") + F.col("length") - F.col("low")))
    pairs = cut.select("doc_id", "item_id", "offsets", "low", near.alias("near"), F.size("words").alias("m")).join(items.withColumnRenamed("words", "item"), "item_id")
    total = lambda a: F.aggregate(a, F.lit(0), lambda s, x: s + x)
    span = F.least(F.size("item"), F.lit(WINDOW))

    def place(offset: Column) -> Column:
        """struct(matched, back, compared) of the item at an offset, null if too little of it is there."""
        equal = F.transform("item", lambda w, i: F.when(F.coalesce(F.when(i + offset >= 0, F.get("near", i + offset - F.col("low"))) == w, F.lit(False)), 1).otherwise(0))
        compared = F.greatest(F.lit(0), F.least(F.size("item"), F.col("m") - offset) - F.greatest(F.lit(0), -offset))

        def judged(e: Column) -> Column:
            found = F.exists(F.sequence(F.lit(1), F.size(e) - span + 1), lambda i: total(F.slice(e, i, span)) >= SHARE * span)
            return F.when(found, F.struct(total(e).alias("matched"), (-offset).alias("back"), compared.alias("compared")))

        return F.get(F.transform(F.array(equal), judged), F.lit(0))  # so that equal is computed once

    laid = pairs.select("doc_id", "item_id", F.array_max(F.transform("offsets", place)).alias("best")).where("best is not null")
    best = laid.groupBy("doc_id", "item_id").agg(F.max("best").alias("best"))
    drop(known)
    return best.select("doc_id", "item_id", (-F.col("best.back")).alias("at"), "best.matched", "best.compared")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the rows in which a benchmark item was found; rows with a null doc_id stay; columns as they are."""
    leaks = save(overlaps(docs, benchmark).select("doc_id").distinct())
    return docs.join(leaks, "doc_id", "left_anti").select(*docs.columns)
