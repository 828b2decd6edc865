"""Audit of how sources of one language differ in the words they use.

Words are counted by language and source. What a word adds to the distance of two sources depends on its counts in all
sources of the language only, so words with the same sparse vector of counts are one vector with a multiplicity: pairs of
sources are evaluated once per distinct vector where both have the word, and its value is multiplied. Words that only one
of two sources has are summed from that source's own distinct values, words that neither has from their number alone, so
the work is that of the entries which are not zero. Ranks are those of the original words.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import drop, save

#: Documents of a language that hold a word which is kept.
LEAST_DOCUMENTS = 30
#: Ranks of words given for a group.
TOP = 50
#: What is added to every count, and the whole that shares are scaled to.
ADDED, WHOLE = 5, 1_000_000_000
#: Words a task holds before it gives its partial counts on.
HELD = 300_000
_LETTERS = bytes(b if 97 <= b < 123 or b >= 128 else b + 32 if 65 <= b < 91 else 32 for b in range(256))
_COUNTS = "lang string, source string, term string, n long, docs long"
_SCHEMA = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def terms(text: bytes) -> list[bytes]:
    """Runs of A-Z, a-z and whatever lies beyond ASCII, with A-Z lower-cased, of a text in UTF-8."""
    return text.translate(_LETTERS).split()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0

    def rows():
        for (lang, source), (n, in_docs) in held.items():
            words = list(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(words)), pa.array([source] * len(words)), pa.array(words, pa.binary()).cast(pa.string()), pa.array(n.values(), pa.int64()), pa.array(map(in_docs.__getitem__, words), pa.int64())],
                schema=_SCHEMA,
            )

    for b in batches:
        for lang, source, text in zip(b.column("lang").to_pylist(), b.column("source").to_pylist(), b.column("text"), strict=True):
            words = terms(text.as_buffer().to_pybytes())
            if words:
                n, in_docs = held.setdefault((lang, source), (Counter(), Counter()))
                size -= len(n)
                n.update(words)
                in_docs.update(set(words))
                size += len(n)
            if size > HELD:
                yield from rows()
                held, size = {}, 0
    yield from rows()


def kept_counts(docs: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """lang, source, term, n: occurrences of words that at least so many documents of their language hold."""
    texts = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    part = texts.withColumn("text", F.encode("text", "utf-8")).mapInArrow(_count, _COUNTS)
    counts = part.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    in_lang = F.sum("docs").over(Window.partitionBy("lang", "term"))
    return counts.withColumn("docs", in_lang).where(F.col("docs") >= least).select("lang", "source", "term", "n")


def share(count: Column | str, total: Column | str, size: Column | str) -> Column:
    """1 + floor(WHOLE * (count + ADDED) / (total + ADDED * size)) in exact numbers; null where nothing is kept."""
    count, total, size = ((F.col(c) if isinstance(c, str) else c).cast("long") for c in (count, total, size))
    over = (F.lit(WHOLE).cast("decimal(38,0)") * (count + ADDED)).alias("over")
    under = total + ADDED * size
    return F.when(under > 0, 1 + F.call_function("div", over, under.cast("decimal(38,0)"))).cast("long")


def vectors(kept: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lang, term, vec) of all words, and (lang, vec, m, total) of the distinct vectors of counts, named by a word of theirs.

    Vectors are told apart by their number of entries, their sum and 128 bits of hashes of all entries, so no row ever
    holds a whole vector.
    """
    one, two = F.xxhash64("source", "n"), F.xxhash64(F.lit("vector"), "n", "source")
    own = ["lang", "total", "entries", "one", "two"]
    words = save(kept.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.count("*").alias("entries"), F.bit_xor(one).alias("one"), F.bit_xor(two).alias("two")))
    distinct = save(words.groupBy(*own).agg(F.count("*").alias("m"), F.min("term").alias("vec")))
    return words.join(distinct, own).select("lang", "term", "vec"), distinct.select("lang", "vec", "m", "total")


def divergences(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank of every pair of sources of a language and of each group's own words.

    Part pair: value is the summed difference of the shares of all kept words of the language in both sources. Part term:
    value is by how much a word's share in the source exceeds that in the language, for the first `top` words.
    Null lang, source and text count as empty. A text without words gives its group, all of whose shares are those of a
    count of zero; a language without kept words gives pairs of value 0 and no words. Repeated rows are documents of
    their own; ties are ranked by item in UTF-8; very long texts are counted whole; no rows give no rows; columns besides
    lang, source and text are ignored.
    """
    kept = save(kept_counts(docs, least))
    of_words, distinct = vectors(kept)
    empty = F.lit(0).cast("long")
    langs = kept.groupBy("lang").agg(F.sum("n").alias("all"), F.count_distinct("term").alias("size"))
    groups = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    groups = groups.join(kept.groupBy("lang", "source").agg(F.sum("n").alias("own"), F.count("*").alias("has")), ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["own", "has", "all", "size"])
    groups = save(groups.withColumn("zero", F.coalesce(share(empty, "own", "size"), empty)))
    entries = kept.withColumnRenamed("term", "vec").join(distinct, ["lang", "vec"]).join(groups, ["lang", "source"])
    entries = save(entries.select("lang", "vec", "m", "source", "zero", share("n", "own", "size").alias("p"), share("total", "all", "size").alias("q")))

    a, b = (entries.select("lang", "vec", "m", *(F.col(c).alias(f"{c}_{x}") for c in ("source", "zero", "p"))) for x in "ab")
    m = F.col("m")
    met = a.join(b.drop("m"), ["lang", "vec"]).where("source_a < source_b").groupBy("lang", "source_a", "source_b").agg(
        F.sum(m).alias("shared"), F.sum(m * (F.abs(F.col("p_a") - F.col("p_b")) - F.abs(F.col("p_a") - F.col("zero_b")) - F.abs(F.col("p_b") - F.col("zero_a")))).alias("both")
    )
    both_ways = groups.select("lang", F.col("source").alias("source_a"), F.col("has").alias("has_a"), F.col("zero").alias("zero_a"), "size")
    both_ways = both_ways.join(groups.select("lang", F.col("source").alias("source_b"), F.col("has").alias("has_b"), F.col("zero").alias("zero_b")), "lang").where("source_a <> source_b")
    # Words of a alone against b's share of a count of zero: running sums of a's values, read where b's share stands among them.
    values = entries.groupBy("lang", F.col("source").alias("source_a"), F.col("p").alias("at")).agg(F.sum("m").alias("m"))
    marks = both_ways.select("lang", "source_a", F.col("zero_b").alias("at"), F.lit(0).cast("long").alias("m"), "source_b")
    up_to, whole = Window.partitionBy("lang", "source_a").orderBy("at"), Window.partitionBy("lang", "source_a")
    at = F.col("at")
    lined = values.withColumn("source_b", F.lit(None).cast("string")).unionByName(marks)
    lined = lined.select("lang", "source_a", "source_b", at, F.sum("m").over(up_to).alias("n"), F.sum(m * at).over(up_to).alias("s"), F.sum("m").over(whole).alias("all_n"), F.sum(m * at).over(whole).alias("all_s"))
    alone = lined.where("source_b is not null").select("lang", "source_a", "source_b", (at * (2 * F.col("n") - F.col("all_n")) + F.col("all_s") - 2 * F.col("s")).alias("alone"))
    there = alone.where("source_a < source_b")
    back = alone.where("source_a > source_b").select("lang", F.col("source_b").alias("source_a"), F.col("source_a").alias("source_b"), F.col("alone").alias("back"))
    key = ["lang", "source_a", "source_b"]
    value = F.coalesce("both", empty) + F.coalesce("alone", empty) + F.coalesce("back", empty)
    value += (F.col("size") - F.col("has_a") - F.col("has_b") + F.coalesce("shared", empty)) * F.abs(F.col("zero_a") - F.col("zero_b"))
    pairs = save(both_ways.where("source_a < source_b").join(met, key, "left").join(there, key, "left").join(back, key, "left").select(*key, value.alias("value")))
    pairs = pairs.select("lang", F.col("source_a").alias("source"), F.col("source_b").alias("item"), "value").unionByName(pairs.select("lang", F.col("source_b").alias("source"), F.col("source_a").alias("item"), "value"))

    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    above = entries.where("p > q").select("lang", "source", "vec", (F.col("p") - F.col("q")).alias("value"))
    words = above.join(of_words, ["lang", "vec"]).select("lang", "source", F.col("term").alias("item"), "value").withColumn("rank", rank).where(F.col("rank") <= top)
    out = pairs.withColumn("rank", rank).withColumn("part", F.lit("pair")).unionByName(words.withColumn("part", F.lit("term")))
    out = save(out.select("lang", "source", "part", "item", "value", "rank"))
    drop(kept, groups, entries)
    return out
