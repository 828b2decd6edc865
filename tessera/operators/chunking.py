"""Chunks and sentences of reports of any length: no row and no task holds a whole report.

A report's parts are dealt into lots of neighbouring ordinals. What runs from part to part (a running sum, the last mark)
is taken within each lot and shifted by what the lots before it hold, of which there are few.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import text as X
from ..sources import scratch

#: Ordinals in a lot.
LOT = 4096


def _same(a: str, b: str, *columns: str) -> Column:
    """Equality of keys, null keys among them."""
    out = F.lit(True)
    for c in columns:
        out = out & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return out


def running(df: DataFrame, key: str, lot: Column, order: list, sums: dict[str, Column]) -> DataFrame:
    """df with, for each name of sums, the sum over the rows of its key before it, in an order that lot follows."""
    rows = df.withColumn("__lot", lot)
    here = Window.partitionBy(key, "__lot").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(key).orderBy("__lot").rowsBetween(Window.unboundedPreceding, -1)
    lots = rows.groupBy(key, "__lot").agg(*[F.sum(c).alias(f"__{n}") for n, c in sums.items()])
    zero = F.lit(0).cast("long")
    base = lots.select(key, "__lot", *[F.coalesce(F.sum(f"__{n}").over(before), zero).alias(f"__{n}") for n in sums])
    inner = rows.select("*", *[F.coalesce(F.sum(c).over(here), zero).alias(n) for n, c in sums.items()])
    joined = inner.alias("i").join(base.alias("b"), _same("i", "b", key, "__lot"))
    return joined.select(*[f"i.{c}" for c in df.columns], *[(F.col(f"i.{n}") + F.col(f"b.__{n}")).alias(n) for n in sums])


def _first_above(points: DataFrame, probes: DataFrame, width: int) -> DataFrame:
    """key, i, to: for each probe(key, i, v) the first of points(key, i, v), whose v rises with i, of a greater v.

    Values are dealt into buckets of the given width. A probe's answer lies in its own bucket or is the first point of the
    next one that has any, so only one row a bucket is lined up by key.
    """
    bucket = F.floor(F.col("v") / width)
    both = points.select("key", F.lit(None).cast("long").alias("i"), "v", F.col("i").alias("to")).unionByName(probes.select("key", "i", "v", F.lit(None).cast("long").alias("to"))).withColumn("b", bucket)
    above = Window.partitionBy("key", "b").orderBy(F.desc("v"), F.col("to").isNotNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = both.withColumn("own", F.min("to").over(above)).where("i is not null")
    rest = Window.partitionBy("key").orderBy("b").rowsBetween(1, Window.unboundedFollowing)
    after = both.groupBy("key", "b").agg(F.min("to").alias("first")).select("key", "b", F.min("first").over(rest).alias("next"))
    return own.alias("o").join(after.alias("a"), _same("o", "a", "key", "b")).select("o.key", "o.i", F.coalesce("o.own", "a.next").alias("to"))


def packed_spread(df: DataFrame, key: str, ordinal: str, text: str, most: int, lot: int = LOT) -> DataFrame:
    """key, chunk, text as relational.packed_parts() gives them, for reports of any number of parts.

    Where a chunk that starts at a part would end does not depend on the chunks before it, so each part knows where the
    next one would start, by a search in the running lengths. Which parts do start a chunk is found by pointer doubling:
    after k rounds the first 2 ** k starts are known and pointers lead 2 ** k chunks on. Each round is a join of written
    tables. A null text is an empty one; ordinals are numbers, and equal ones, which are taken in the order of their texts,
    are in one lot.
    """
    at = F.floor(F.col("o") / lot)
    parts = df.select(F.col(key).alias("key"), F.col(ordinal).cast("long").alias("o"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    # q: the length of all parts before this one, each with the blank line after it.
    lined = running(parts, "key", at, ["o", "t"], {"i": F.lit(1).cast("long"), "q": (F.length("t") + 2).cast("long")})
    lined = scratch.table(lined.drop("o").withColumn("end", F.col("q") + F.length("t") + 2), "parts")
    some = lined.where(F.length("t") > 0)
    found = _first_above(some.select("key", "i", F.col("end").alias("v")), some.select("key", "i", (F.col("q") + most + 4).alias("v")), most + 5)
    following = Window.partitionBy("key", "__lot").orderBy("i")
    # A part that is too long for any chunk is one of its own: the next start is the next part with text.
    line = some.select("key", "i", F.floor(F.col("i") / lot).alias("__lot"))
    rest = Window.partitionBy("key").orderBy("__lot").rowsBetween(1, Window.unboundedFollowing)
    firsts = line.groupBy("key", "__lot").agg(F.min("i").alias("first")).select("key", "__lot", F.min("first").over(rest).alias("beyond"))
    after = line.select("key", "i", "__lot", F.lead("i").over(following).alias("near")).alias("l").join(firsts.alias("f"), _same("l", "f", "key", "__lot"))
    after = after.select("l.key", "l.i", F.coalesce("l.near", "f.beyond").alias("after"))
    hop = scratch.table(_hops(found, after), "hops")
    starts = scratch.table(some.groupBy("key").agg(F.min("i").alias("i")).withColumn("chunk", F.lit(0)), "starts")
    step, known = 1, [starts]
    while True:
        reached = known[0]
        for k in known[1:]:
            reached = reached.unionByName(k)
        new = reached.alias("r").join(hop.alias("h"), _same("r", "h", "key", "i")).select("r.key", F.col("h.to").alias("i"), (F.col("r.chunk") + step).alias("chunk"))
        new = scratch.table(new, "starts")
        if new.isEmpty():
            break
        known.append(new)
        hop = scratch.table(hop.alias("a").join(hop.alias("b"), F.col("a.key").eqNullSafe(F.col("b.key")) & (F.col("a.to") == F.col("b.i"))).select("a.key", "a.i", "b.to"), "hops")
        step *= 2
    # Each part takes the last start at or before it, and belongs to that chunk if it still fits.
    marked = lined.alias("p").join(reached.alias("r"), _same("p", "r", "key", "i"), "left").select("p.*", F.when(F.col("r.chunk").isNotNull(), F.struct(F.col("p.i").alias("s"), F.col("p.q").alias("q"), F.col("r.chunk").alias("chunk"))).alias("own"))
    marked = marked.withColumn("__lot", F.floor(F.col("i") / lot))
    upto, before = Window.partitionBy("key", "__lot").orderBy("i"), Window.partitionBy("key").orderBy("__lot").rowsBetween(Window.unboundedPreceding, -1)
    carried = marked.groupBy("key", "__lot").agg(F.max("own").alias("last")).select("key", "__lot", F.max("last").over(before).alias("carried"))
    taken = marked.withColumn("here", F.max("own").over(upto)).alias("m").join(carried.alias("c"), _same("m", "c", "key", "__lot")).withColumn("of", F.coalesce("here", "carried"))
    members = taken.where((F.col("i") == F.col("of.s")) | (F.col("end") <= F.col("of.q") + most + 4))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "t"))), lambda x: x["t"]), "\n\n")
    return members.groupBy(F.col("m.key").alias(key), F.col("of.chunk").alias("chunk")).agg(joined.alias("text"))


def _hops(found: DataFrame, after: DataFrame) -> DataFrame:
    """Where the chunk after each part's begins: where the part's own ends, and at least one part on."""
    both = found.alias("f").join(after.alias("a"), _same("f", "a", "key", "i"))
    return both.where("f.to is not null and a.after is not null").select("f.key", "f.i", F.greatest("f.to", "a.after").alias("to"))


class PageParts:
    """Table function: the parts of a lot's blocks, each with the page of the last mark before it."""

    def __init__(self):
        self.page, self.begun = None, False

    def eval(self, row):
        if not self.begun:
            self.page, self.begun = row["carried"], True
        # What stands before the first mark goes on from the block before; then marks and texts by turns.
        first, *rest = re.split(X.MARK, row["text"] or "")
        yield row["stem"], row["ordinal"], 0, self.page, first
        for k in range(0, len(rest), 2):
            self.page = int(rest[k])
            yield row["stem"], row["ordinal"], k // 2 + 1, self.page, rest[k + 1]


def paged_parts(blocks: DataFrame, lot: int = LOT) -> DataFrame:
    """stem, ordinal, part, page, body of blocks(stem, ordinal, text) of reports with [[page:N]] marks.

    A block that begins without a mark goes on with the page of the block before it. Blocks stream through a table
    function in their order, a lot a partition; the page that a lot begins with is carried over from the lots before it.
    """
    rows = blocks.select("stem", F.col("ordinal").cast("long").alias("ordinal"), "text").withColumn("lot", F.floor(F.col("ordinal") / lot))
    marks = F.regexp_extract_all("text", F.lit(X.MARK), 1)
    last = F.when(F.size(marks) > 0, F.struct("ordinal", F.element_at(marks, -1).cast("int").alias("page")))
    before = Window.partitionBy("stem").orderBy("lot").rowsBetween(Window.unboundedPreceding, -1)
    carried = rows.groupBy("stem", "lot").agg(F.max(last).alias("last")).select("stem", "lot", F.max("last").over(before)["page"].alias("carried"))
    known = rows.alias("r").join(carried.alias("c"), _same("r", "c", "stem", "lot")).select("r.*", "c.carried")
    kind = rows.schema["stem"].dataType.simpleString()
    parts = F.udtf(PageParts, returnType=f"stem {kind}, ordinal long, part int, page int, body string")
    return parts(known.asTable().partitionBy("stem", "lot").orderBy("ordinal"))


def streamed_sentences(blocks: DataFrame, least: int = 40, cap: int = 1200, most: int = 800, lot: int = LOT) -> DataFrame:
    """stem, sentence_idx, page, sentence as disclosure.page_sentences() gives them, of blocks(stem, ordinal, text).

    Sentences end with their block or page. Of more than cap sentences every one stays that an even thinning takes.
    """
    body = F.regexp_replace("body", r"(?U)\s+", " ")
    said = paged_parts(blocks, lot).select("stem", "ordinal", "part", "page", X.sentences(body, least, most).alias("s")).where(F.size("s") > 0)
    said = scratch.table(said, "sentences")
    placed = running(said, "stem", F.floor(F.col("ordinal") / lot), ["ordinal", "part"], {"at": F.size("s").cast("long")})
    total = said.groupBy("stem").agg(F.sum(F.size("s")).alias("n"))
    each = placed.alias("p").join(total.alias("t"), _same("p", "t", "stem")).select("p.stem", "p.page", "p.at", "t.n", F.posexplode("p.s").alias("k", "sentence"))
    idx = F.col("at") + F.col("k")
    if not cap:
        return each.select("stem", idx.cast("int").alias("sentence_idx"), "page", "sentence")
    # Of n sentences those at floor(i * n / cap) for each i under cap; i is known from the place.
    i = F.ceil(idx * F.lit(cap) / F.col("n"))
    thin = F.col("n") > cap
    kept = each.select("stem", "page", "sentence", idx.alias("idx"), "n", F.when(thin, i).otherwise(idx).alias("i"))
    kept = kept.where(~thin | ((F.col("i") < cap) & (F.floor(F.col("i") * F.col("n") / F.lit(cap)) == F.col("idx"))))
    return kept.select("stem", F.col("i").cast("int").alias("sentence_idx"), "page", "sentence")
