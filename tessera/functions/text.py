"""Column expressions over report texts; all run inside the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from . import lexicon as L

WORD = r"[^\s\x0B]+"
MARK = r"\[\[page:(\d+)\]\]"


def let(value: Column, f) -> Column:
    """f(value) with value computed once, however often f uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def clean_text(raw: Column) -> Column:
    """Form feeds and carriage returns become line breaks, three and more line breaks two, runs of blanks one; stripped."""
    c = F.translate(raw, "\f\r", "\n\n")
    return strip(F.regexp_replace(F.regexp_replace(c, "\n{3,}", "\n\n"), "[ \t]{2,}", " "))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"(?U)\S+")).cast("long")


def word_count_without_marks(text: Column) -> Column:
    return word_count(F.regexp_replace(text, MARK, " "))


def page_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"\[\[page:")).cast("long")


def tokens(text: Column, stopwords: list[str] = L.STOPWORDS) -> Column:
    """Lower-cased runs of three and more a-z that are no stopwords, duplicates kept."""
    found = F.regexp_extract_all(F.lower(text), F.lit("[a-z]{3,}"), 0)
    return F.filter(found, lambda w: ~w.isin(*stopwords))


def top_words(words: Column, n: int = 20) -> Column:
    """struct(word, n) of the n most frequent words of an array, ties by first occurrence, counted inside the row."""

    def runs(s: Column) -> Column:
        # Equal words follow each other, the first place of each ahead; a run ends where the next one starts.
        starts = F.filter(F.transform(s, lambda x, i: F.when((i == 0) | (F.get(s, i - 1)["word"] != x["word"]), i)), lambda i: i.isNotNull())
        return let(starts, lambda b: F.transform(b, lambda i, k: F.struct((i - F.coalesce(F.get(b, k + 1), F.size(s))).alias("less"), F.get(s, i)["at"].alias("at"), F.get(s, i)["word"].alias("word"))))

    placed = F.array_sort(F.transform(words, lambda w, i: F.struct(w.alias("word"), i.alias("at"))))
    return F.transform(F.slice(F.array_sort(let(placed, runs)), 1, n), lambda x: F.struct(x["word"].alias("word"), (-x["less"]).cast("long").alias("n")))


def hits(text: Column, words: list[str]) -> Column:
    return F.regexp_count(text, F.lit(L.keyword_search(words))).cast("long")


def density(part: Column, total: Column) -> Column:
    return F.round(part / F.greatest(total, F.lit(1)), 3)


def dominant(environment: Column, social: Column, governance: Column) -> Column:
    """The pillar with most; ties go to the first; all zero: unknown."""
    none = (environment == 0) & (social == 0) & (governance == 0)
    return F.when(none, "unknown").when((environment >= social) & (environment >= governance), "environment").when(social >= governance, "social").otherwise("governance")


def metrics(text: Column, cap: int = 200) -> Column:
    """Snippets of numbers with units by pattern, then place; first occurrences only, at most cap."""
    found = F.concat(*[F.regexp_extract_all(text, F.lit("(?i)" + p), 0) for p in L.METRICS])
    return F.slice(F.array_distinct(F.transform(found, strip)), 1, cap)


def sentences(text: Column, least: int = 30, most: int | None = None) -> Column:
    """Sentences of at least so many characters; of longer ones than most, the head."""
    out = F.filter(F.transform(F.split(text, r"(?<=[.!?])\s+"), strip), lambda s: F.length(s) >= least)
    return out if most is None else F.transform(out, lambda s: F.substring(s, 1, most))


def plain_sentences(text: Column, least: int = 30, cap: int = 400, most: int = 800) -> Column:
    """Sentences without page marks, white space collapsed, evenly thinned to cap (0: all)."""
    flat = F.regexp_replace(F.regexp_replace(text, MARK, " "), r"(?U)\s+", " ")
    return thinned(sentences(flat, least, most), cap)


def thinned(items: Column, cap: int) -> Column:
    """Element floor(i * size / cap) for each i under cap, where there are more than cap."""
    if not cap:
        return items

    def some(all_: Column) -> Column:
        picked = F.transform(F.sequence(F.lit(0), F.lit(cap - 1)), lambda i: F.get(all_, F.floor(i * F.size(all_) / cap).cast("int")))
        return F.when(F.size(all_) > cap, picked).otherwise(all_)

    return let(items, some)


def language_sample(text: Column) -> Column:
    """The first 4000 characters, of texts over 12000 also 4000 from the middle and the last."""
    n = F.length(text)
    long = F.concat_ws("\n", F.substring(text, 1, 4000), F.substr(text, F.floor(n / 2).cast("int") + 1, F.lit(4000)), F.substr(text, n - 3999, F.lit(4000)))
    return F.when(n > 12000, long).otherwise(F.substring(text, 1, 4000))


def language(text: Column, least_words: int = 40, least_share: float = 0.04) -> Column:
    """The language whose function words are the largest share of the sample's words; unknown where there is too little."""
    words = F.regexp_extract_all(F.lower(language_sample(text)), F.lit(r"[\p{L}\p{Nl}\p{No}]+"), 0)
    every = sorted({w for known in L.LANGUAGE_WORDS.values() for w in known.split()})
    some = F.filter(words, lambda w: w.isin(*every))

    def best(found: Column) -> Column:
        scored = [F.struct(F.size(F.filter(found["some"], lambda w: w.isin(*known.split()))).alias("n"), F.lit(-i).alias("rank"), F.lit(lang).alias("lang")) for i, (lang, known) in enumerate(L.LANGUAGE_WORDS.items())]
        top = F.array_max(F.array(*scored))
        return F.when((found["n"] >= least_words) & (top["n"] / found["n"] >= least_share), top["lang"]).otherwise("unknown")

    # As the only element of an array, what best() uses several times is computed once.
    once = F.array(F.struct(F.size(words).alias("n"), some.alias("some")))
    return F.when(text.isNotNull(), F.get(F.transform(once, best), F.lit(0))).otherwise("unknown")


def is_index_row(s: Column) -> Column:
    """A row of a content index rather than a disclosure."""
    codes = F.size(F.array_distinct(F.regexp_extract_all(s, F.lit(L.CODE), 0)))
    return s.rlike("(?i)" + L.INDEX_PHRASE) | ((codes >= 2) & (F.length(s) < 400)) | ((codes >= 1) & (F.length(s) < 160) & strip(s).rlike(L.PAGE_REFERENCE))


def value_and_unit(span: Column) -> Column:
    """struct(value, unit) of the first number; nulls where there is none."""
    pattern = F.lit("(?i)" + L.VALUE)
    raw = F.regexp_replace(F.regexp_extract(span, "(?i)" + L.VALUE, 1), "[ \u00a0]", "")
    raw = F.regexp_replace(raw, r"[.,]+$", "")
    number = F.when(raw.rlike(L.GROUPED), F.replace(raw, F.lit(","), F.lit(""))).when(raw.rlike(L.DECIMAL_COMMA), F.replace(raw, F.lit(","), F.lit("."))).otherwise(F.replace(raw, F.lit(","), F.lit("")))
    value = number.try_cast("double")
    unit = F.nullif(F.regexp_extract_all(span, pattern, 2)[0], F.lit(""))
    return F.struct(value.alias("value"), F.when(value.isNotNull(), unit).alias("unit"))


def plausible(value: Column, unit: Column, span: Column) -> Column:
    whole = value == F.floor(value)
    return F.when(value.isNull(), False).when(unit.isNotNull(), True).when(whole & value.between(1900, 2100), False).when(whole & (value < 10), False).otherwise(F.coalesce(span.rlike("(?i)" + L.MEASURE), F.lit(False)))


def year_after(text: Column, cue: str) -> Column:
    """The first year of 1900 to 2099 within 40 characters without a full stop after a cue."""
    return F.regexp_extract(text, rf"(?i)(?:{cue})[^.]{{0,40}}?((?:19|20)\d{{2}})", 1).try_cast("int")


def as_int(value: Column) -> Column:
    """Integer part of a number in text; null of anything else, not-a-number and infinity."""
    n = strip(value.cast("string")).try_cast("double")
    return F.when(n.isNull() | F.isnan(n) | (F.abs(n) > 2_147_483_647), None).otherwise(n.try_cast("int"))


def clean_name(name: Column, most: int = 80) -> Column:
    kept = strip(F.regexp_replace(name, r"(?U)[^\w\s-]", ""))
    return F.substring(F.regexp_replace(kept, r"(?U)\s+", "_"), 1, most)


def stem(company: Column, isin: Column, year: Column, start: Column, end: Column) -> Column:
    """The key of a report; a bound of 0 counts as missing, as does an empty isin."""
    some = lambda c: F.coalesce(c, F.lit(0)) != 0
    pages = F.when(some(start) & some(end), F.concat(F.lit("p"), start.cast("string"), F.lit("-"), end.cast("string")))
    return F.concat_ws("_", clean_name(company), F.coalesce(F.nullif(strip(isin), F.lit("")), F.lit("noisin")), F.when(some(year), year.cast("string")), pages)


def page_range(start: Column, end: Column, total: Column) -> Column:
    first = F.greatest(F.lit(1), F.least(F.coalesce(F.nullif(start, F.lit(0)), F.lit(1)), total))
    last = F.greatest(first, F.least(F.coalesce(F.nullif(end, F.lit(0)), total), total))
    return F.struct(first.alias("start"), last.alias("end"))


def useful_table(rows: Column) -> Column:
    """At least two rows, two cells in some row, four cells with text and a cell with a word of four letters."""
    cells = F.filter(F.flatten(rows), lambda c: F.coalesce(strip(c), F.lit("")) != "")
    wide = F.coalesce(F.array_max(F.transform(rows, F.size)), F.lit(0)) >= 2
    return F.coalesce((F.size(rows) >= 2) & wide & (F.size(cells) >= 4) & F.exists(cells, lambda c: c.rlike(r"[\p{L}]{4,}")), F.lit(False))


def positive_label(label: Column) -> Column:
    c = F.lower(label)
    return c.isin("yes", "commitment", "1", "true", "label_1") | c.contains("commit") | c.endswith("_1")


def theme_of_label(label: Column) -> Column:
    c = F.lower(label)
    return F.when(c.contains("environ"), "environment").when(c.contains("social"), "social").when(c.contains("govern"), "governance").otherwise("none")


def transient_error(message: Column) -> Column:
    """Whether what a server said passes, so that it is worth asking again."""
    return F.lower(message).rlike("|".join(L.TRANSIENT))


def is_transient(message: str) -> bool:
    """As transient_error(), of one message in a task."""
    return re.search("|".join(L.TRANSIENT), message.lower()) is not None


def repaired_json(raw: Column) -> Column:
    """JSON text of a sloppy answer: as it is, from its fence, from its outermost braces, or closed; null of the rest."""

    def first_good(c: Column, otherwise) -> Column:
        return let(c, lambda x: F.when(F.try_parse_json(x).isNotNull(), x).otherwise(otherwise(x)))

    def unfenced(text: Column) -> Column:
        inside = strip(F.regexp_extract(text, r"(?s)```(?:json)?\s*(.+?)```", 1))
        return let(F.nullif(inside, F.lit("")), lambda x: F.when(x.isNull(), braced(text)).otherwise(first_good(x, braced)))

    def braced(body: Column) -> Column:
        whole = F.nullif(F.regexp_extract(body, r"(?s)\{.*\}", 0), F.lit(""))
        return first_good(F.coalesce(whole, F.nullif(F.regexp_extract(body, r"(?s)\{.*", 0), F.lit(""))), closed)

    def closed(cut: Column) -> Column:
        tidy = F.regexp_replace(F.regexp_replace(cut, r",\s*([}\]])", "$1"), r"[\s,]+$", "")
        missing = lambda t, a, b: F.greatest(F.regexp_count(t, F.lit(a)) - F.regexp_count(t, F.lit(b)), F.lit(0))
        full = lambda t: F.concat(t, F.repeat(F.lit("]"), missing(t, r"\[", r"\]")), F.repeat(F.lit("}"), missing(t, r"\{", r"\}")))
        return first_good(let(tidy, full), lambda x: F.lit(None).cast("string"))

    return first_good(strip(raw), unfenced)


def megabytes(n: Column) -> Column:
    """Bytes as MB with one digit."""
    return F.concat(F.call_function("format_number", n / (1024 * 1024), F.lit("0.0")), F.lit(" MB"))


def percent(part: Column, whole: Column) -> Column:
    """part of whole with one digit; nothing of nothing is 0.0%."""
    return F.concat(F.format_number(F.coalesce(100 * part / F.nullif(whole, F.lit(0)), F.lit(0.0)), 1), F.lit("%"))


def safe_name(name: Column, most: int = 60) -> Column:
    """Everything but word characters as _, the head of long names."""
    return F.substring(F.regexp_replace(name, r"(?U)[^\w]", "_"), 1, most)
