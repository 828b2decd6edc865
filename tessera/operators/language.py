"""Language profiles of character trigrams, fitted on labelled texts and scored in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources import scratch

#: Trigrams that a language's profile holds, its most frequent ones.
PROFILE = 2000
#: Weights are this many times the natural logarithm of a share, as whole numbers, so that sums are exact.
SCALE = 1000
#: Known trigrams that a text needs, or its language is unknown.
LEAST = 20
#: Pieces of texts whose scores are broadcast.
PIECES = 100_000


def _plain(text: Column) -> Column:
    return F.concat(F.lit(" "), F.regexp_replace(F.lower(text), r"[^\p{L}]+", " "), F.lit(" "))


def _grams(plain: Column) -> Column:
    return F.regexp_extract_all(plain, F.lit(r"(?s)(?=(...))."), 1)


def trigrams(text: Column) -> Column:
    """All runs of three characters of a text whose letters are lower-cased and whose other characters are one blank."""
    return _grams(_plain(text))


def _pieces(text: Column) -> Column:
    """The text of trigrams() cut before each blank, each piece with two characters of what follows: every trigram is in one."""
    return F.regexp_extract_all(_plain(text), F.lit("(?s)(?=( [^ ]*.{0,2})) [^ ]*"), 1)


def counted(texts: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """lang, piece, m: how often each piece stands in texts of a language, written once for fit() and scores()."""
    each = texts.select(F.col(lang).alias("lang"), F.explode(_pieces(F.col(text))).alias("piece"))
    return scratch.table(each.groupBy("lang", "piece").agg(F.count("*").alias("m")), "counted")


def fit(texts: DataFrame, lang: str = "lang", text: str = "text", size: int = PROFILE, pieces: DataFrame | None = None) -> DataFrame:
    """gram, lang, gain, floor: the profiles of labelled texts; languages times size rows at most.

    floor is the weight of a trigram that the language's profile lacks, gain what one that it has weighs more. Rows
    without language or text are left out. Of equally frequent trigrams the first in order are taken. Trigrams are made of
    pieces, their counted() ones if not given, so that equal pieces are cut up once.
    """
    own = (counted(texts, lang, text) if pieces is None else pieces).where(F.col("lang").isNotNull())
    counts = own.select("lang", "m", F.explode(_grams(F.col("piece"))).alias("gram")).groupBy("lang", "gram").agg(F.sum("m").alias("c"))
    total = F.sum("c").over(Window.partitionBy("lang"))
    first = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("c"), "gram"))
    top = counts.withColumn("n", total).withColumn("r", first).where(F.col("r") <= size)
    weight = lambda c: F.round(SCALE * F.log(c / (F.col("n") + size).cast("double"))).cast("long")
    floor = weight(F.lit(1.0))
    return top.select("gram", "lang", (weight(F.col("c") + 1.0) - floor).alias("gain"), floor.alias("floor"))


def scores(docs: DataFrame, profiles: DataFrame, key: str, text: str = "text", pieces: DataFrame | None = None, most: int = PIECES) -> DataFrame:
    """key, lang, known, score: for each row with a known trigram and each language the logarithm of its likelihood.

    Trigrams that no profile holds count for no language. Keys are those of the rows; equal ones are one text. What the
    most frequent of pieces, counted() ones of docs if not given, add to a score is found once and broadcast; all others
    are looked up trigram by trigram, so the scores do not depend on pieces.
    """
    profiles = scratch.table(profiles, "profiles")
    floors = [(r.lang, r.floor) for r in profiles.select("lang", "floor").distinct().orderBy("lang").collect()]
    if not floors:
        return docs.select(key, F.lit("").alias("lang"), F.lit(0).cast("long").alias("known"), F.lit(0).cast("long").alias("score")).limit(0)
    listed = profiles.groupBy(F.col("gram").alias("__gram")).agg(*[F.coalesce(F.sum(F.when(F.col("lang") == l, F.col("gain"))), F.lit(0)).alias(f"__g{i}") for i, (l, _) in enumerate(floors)])  # noqa: E741
    gains = [f"__g{i}" for i in range(len(floors))]
    each = docs.select(key, F.explode(_pieces(F.col(text))).alias("__piece"))
    own = counted(docs.withColumn("__lang", F.lit("")), "__lang", text) if pieces is None else pieces
    often = own.groupBy(F.col("piece").alias("__piece")).agg(F.sum("m").alias("m")).orderBy(F.desc("m"), "__piece").limit(most).select("__piece")
    found = often.select("__piece", F.explode_outer(_grams(F.col("__piece"))).alias("__gram")).join(F.broadcast(listed), "__gram", "left")
    common = found.groupBy("__piece").agg(F.count("__g0").alias("__k"), *[F.coalesce(F.sum(g), F.lit(0)).alias(g) for g in gains])
    common = scratch.table(common.coalesce(1), "pieces")
    met = each.join(F.broadcast(common), "__piece", "left")
    rare = F.when(F.col("__k").isNull(), _grams(F.col("__piece")))
    # A frequent piece is one row without trigram, so nothing of it is looked up again.
    rows = met.select(key, "__k", *gains, F.explode_outer(rare).alias("__gram")).alias("m").join(F.broadcast(listed).alias("p"), "__gram", "left")
    known = F.coalesce(F.col("__k"), F.col("p.__g0").isNotNull().cast("long"))
    sums = rows.groupBy(key).agg(F.sum(known).alias("known"), *[F.sum(F.coalesce(f"m.{g}", f"p.{g}")).alias(g) for g in gains]).where("known > 0")
    langs = F.array(*[F.struct(F.lit(lang).alias("lang"), (F.col("known") * floor + F.col(g)).alias("score")) for g, (lang, floor) in zip(gains, floors, strict=True)])
    return sums.select(key, "known", F.inline(langs)).select(key, "lang", "known", "score")


def detected(docs: DataFrame, profiles: DataFrame, key: str, text: str = "text", least: int = LEAST, pieces: DataFrame | None = None) -> DataFrame:
    """key, lang, known, score of every key of docs: the likeliest language, the first in order of equal ones.

    A text of fewer known trigrams than least is unknown, with score null; so is one without letters and a null text.
    """
    ranked = scores(docs, profiles, key, text, pieces).where(F.col("known") >= least)
    best = ranked.groupBy(key).agg(F.min(F.struct((-F.col("score")).alias("s"), "lang", "known")).alias("m")).select(key, "m.lang", "m.known", (-F.col("m.s")).alias("score"))
    best = best.alias("b")
    d = docs.select(key).distinct().alias("d")
    out = d.join(best, F.col(f"d.{key}").eqNullSafe(F.col(f"b.{key}")), "left")
    return out.select(f"d.{key}", F.coalesce("b.lang", F.lit("unknown")).alias("lang"), F.coalesce("b.known", F.lit(0)).alias("known"), "b.score")
