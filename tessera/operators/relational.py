"""Ordered and keyed steps that several plans share. Each takes its order as a column; none relies on input order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources import scratch

def first_wins(df: DataFrame, keys: list[str], *order: str | Column) -> DataFrame:
    """One row per key, nulls equal: the first in order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def top_per_group(df: DataFrame, keys: list[str], k: int, *order: str | Column, rank: str = "rank") -> DataFrame:
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(rank) <= k)


def not_done(df: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key has no output yet."""
    return df.join(done.select(*keys).distinct(), keys, "left_anti")


def with_defaults(left: DataFrame, right: DataFrame, keys: list[str], defaults: dict[str, object]) -> DataFrame:
    """Left join whose missing right columns get defaults."""
    out = left.join(right.select(*keys, *defaults), keys, "left")
    return out.select(*left.columns, *[F.coalesce(F.col(c), F.lit(v)).alias(c) for c, v in defaults.items()])


def round_robin(df: DataFrame, key: str, ordinal: str, gap: float | None = None, lots: int = 64) -> DataFrame:
    """turn and first_ordinal: sorted by these, rows of different keys alternate. With gap, start_after: the seconds
    after which a row's turn comes when each key waits so long between two.

    Rows are numbered inside lots of the ordinal's range first and then shifted by what the key has in earlier lots, so no
    task sorts all rows of one key. ordinal is a number.
    """
    ends = df.agg(F.min(ordinal).alias("__low"), F.max(ordinal).alias("__high"))
    lot = F.least(F.floor((F.col(ordinal) - F.col("__low")) / F.greatest(F.col("__high") - F.col("__low") + 1, F.lit(1)) * lots), F.lit(lots - 1)).cast("int")
    dealt = df.join(F.broadcast(ends)).withColumn("__lot", F.coalesce(lot, F.lit(0))).drop("__low", "__high")
    sizes = dealt.groupBy(key, "__lot").agg(F.count("*").alias("__n"), F.min(ordinal).alias("__first"))
    w = Window.partitionBy(key)
    base = sizes.withColumn("__base", F.coalesce(F.sum("__n").over(w.orderBy("__lot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("first_ordinal", F.min("__first").over(w)).select(F.col(key).alias("__key"), F.col("__lot").alias("__of"), "__base", "first_ordinal")
    inside = dealt.withColumn("turn", F.row_number().over(Window.partitionBy(key, "__lot").orderBy(ordinal)))
    out = inside.join(base, inside[key].eqNullSafe(base["__key"]) & (inside["__lot"] == base["__of"])).withColumn("turn", (F.col("turn") + F.col("__base")).cast("int")).drop("__lot", "__base", "__key", "__of")
    return out if gap is None else out.withColumn("start_after", (F.col("turn") - 1) * F.lit(float(gap)))


def profiled(df: DataFrame, columns: list[str], distinct: Column | None = None, total: bool = True) -> DataFrame:
    """dimension, value, n and with distinct n_distinct: rows, and distinct values of a column, for each value of each
    column and, as dimension "*", of all; missing values are None.

    One aggregate over grouping sets, so each row is read once and partial counts are all that is shuffled.
    """
    names = [f"__{i}" for i in range(len(columns))]
    named = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("None")).alias(n) for c, n in zip(columns, names, strict=True)], *([] if distinct is None else [distinct.alias("__d")]))
    counts = [F.count("*").alias("n"), *([] if distinct is None else [F.count_distinct("__d").alias("n_distinct")])]
    grouped = named.groupingSets([[n] for n in names] + ([[]] if total else []), *names).agg(F.grouping_id().alias("__g"), *counts)
    # A set's id has a bit for each column that is not in it, the first column's highest.
    every = (1 << len(names)) - 1
    which = F.lit("*")
    for i, c in enumerate(columns):
        which = F.when(F.col("__g") == every - (1 << len(names) - 1 - i), c).otherwise(which)
    return grouped.select(which.alias("dimension"), F.coalesce(*names).alias("value"), "n", *([] if distinct is None else ["n_distinct"]))


def value_counts(df: DataFrame, columns: list[str], k: int) -> DataFrame:
    """dimension, value, n, rank: the k most frequent values of each column in one pass; missing values are None."""
    return top_per_group(profiled(df, columns, total=False), ["dimension"], k, F.desc("n"), "value")


def latest(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The current row of each key of an append-only log."""
    return first_wins(df, keys, *order)


def packed_parts(df: DataFrame, key: str, ordinal: str, text: str, most: int) -> DataFrame:
    """key, chunk, text: parts in order joined by blank lines, a new chunk where one would exceed most characters."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct(F.col(ordinal).alias("o"), F.col(text).alias("t")))), lambda x: x["t"])

    def step(s: Column, part: Column) -> Column:
        full = (F.length(s["now"]) > 0) & (F.length(s["now"]) + F.length(part) > most)
        joined = F.when(F.length(s["now"]) == 0, part).otherwise(F.concat(s["now"], F.lit("\n\n"), part))
        return F.struct(F.when(full, F.array_append(s["done"], s["now"])).otherwise(s["done"]).alias("done"), F.when(full, part).otherwise(joined).alias("now"))

    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("now"))
    chunks = F.aggregate("parts", start, step, lambda s: F.when(F.length(s["now"]) > 0, F.array_append(s["done"], s["now"])).otherwise(s["done"]))
    return df.groupBy(key).agg(parts.alias("parts")).select(key, F.posexplode(chunks).alias("chunk", "text"))


def ranked(df: DataFrame, value: str, buckets: int = 256) -> DataFrame:
    """df with rank, the mean place of equal values from 1 on; nulls have none.

    Values are sorted in ranges, a task each, and shifted by what earlier ranges hold, so no task sorts all rows. They are
    written once: a sum of doubles computed anew can differ in its last digits, and a row then misses its own place.
    """
    return _ranked(scratch.table(df, "ranked"), value, buckets)


def _ranked(df: DataFrame, value: str, buckets: int = 256) -> DataFrame:
    """As ranked(), of a table that gives the same values whenever it is read."""
    some = df.where(F.col(value).isNotNull())
    cuts = some.approxQuantile(value, [i / buckets for i in range(1, buckets)], 0.001) if buckets > 1 and not some.isEmpty() else []
    at = F.lit(0)
    if cuts := sorted(set(cuts)):
        at = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < F.col(value)))
    dealt = some.withColumn("__at", at)
    sizes = dealt.groupBy("__at").agg(F.count("*").alias("__n"))
    base = sizes.select(F.col("__at").alias("__of"), F.coalesce(F.sum("__n").over(Window.orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__base"))
    counts = dealt.groupBy("__at", value).agg(F.count("*").alias("__n"))
    upto = counts.withColumn("__sum", F.sum("__n").over(Window.partitionBy("__at").orderBy(value)))
    place = upto.join(F.broadcast(base), upto["__at"] == base["__of"]).select(F.col(value).alias("__value"), (F.col("__base") + F.col("__sum") - (F.col("__n") - 1) / 2.0).alias("rank"))
    return df.join(place, df[value] == place["__value"], "left").drop("__value")


def quantiles(df: DataFrame, value: str, shares: dict[str, float]) -> DataFrame:
    """One row of exact quantiles of value, interpolated: a column for each name of shares.

    A value counts once however often it occurs, so what one task sums up are places, not all rows. The counts are written
    once, as in ranked().
    """
    counts = scratch.table(df.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("__v")).agg(F.count("*").alias("__n")), "counts")
    r = _ranked(counts, "__v")
    # rank orders the distinct values; places count rows.
    lots = r.withColumn("__lot", F.floor(F.col("rank") / 10_000))
    sums = lots.groupBy("__lot").agg(F.sum("__n").alias("__s"))
    base = sums.select(F.col("__lot").alias("__of"), F.coalesce(F.sum("__s").over(Window.orderBy("__lot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__base"))
    upto = lots.withColumn("__end", F.sum("__n").over(Window.partitionBy("__lot").orderBy("rank")))
    spans = upto.join(F.broadcast(base), upto["__lot"] == base["__of"]).select("__v", (F.col("__base") + F.col("__end") - F.col("__n")).alias("__from"), (F.col("__base") + F.col("__end")).alias("__to"))
    total = counts.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("__total"))
    placed = spans.join(F.broadcast(total))

    def one(share: float):
        place = share * (F.col("__total") - 1)
        low, high = F.floor(place), F.ceil(place)
        pick = lambda at: F.max(F.when((F.col("__from") <= at) & (at < F.col("__to")), F.col("__v").cast("double")))
        return pick(low) + F.max(place - low) * (pick(high) - pick(low))

    return placed.agg(*[one(q).alias(n) for n, q in shares.items()])


def rank_sum_test(df: DataFrame, value: str, flag: Column) -> DataFrame:
    """n_true, n_false, mean_true, mean_false, u, p: the means by flag and a two-sided rank-sum test.

    u is that of the rows where flag holds; p comes from the normal approximation with corrections for ties and
    continuity. Nulls of value or flag are left out.
    """
    rows = ranked(df.select(F.col(value).cast("double").alias("__v"), flag.alias("__f")).where("__v is not null and __f is not null"), "__v")
    ties = rows.groupBy("__v").agg(F.count("*").alias("t")).agg(F.coalesce(F.sum(F.col("t").cast("double") * F.col("t") * F.col("t") - F.col("t")), F.lit(0.0)).alias("ties"))
    s = rows.agg(F.count_if("__f").alias("n_true"), F.count_if(~F.col("__f")).alias("n_false"), F.avg(F.when(F.col("__f"), F.col("__v"))).alias("mean_true"), F.avg(F.when(~F.col("__f"), F.col("__v"))).alias("mean_false"), F.sum(F.when(F.col("__f"), F.col("rank"))).alias("sum")).join(ties)
    a, b = F.col("n_true").cast("double"), F.col("n_false").cast("double")
    n, u = a + b, F.col("sum") - a * (a + 1) / 2
    z = F.greatest(F.abs(u - a * b / 2) - 0.5, F.lit(0.0)) / F.sqrt(a * b / 12 * (n + 1 - F.col("ties") / F.nullif(n * (n - 1), F.lit(0.0))))
    # Abramowitz and Stegun 7.1.26, good to 1.5e-7.
    x = z / F.sqrt(F.lit(2.0))
    t = 1 / (1 + 0.3275911 * x)
    p = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429)))) * F.exp(-x * x)
    return s.select("n_true", "n_false", "mean_true", "mean_false", u.alias("u"), F.least(F.lit(1.0), p).alias("p"))
