"""The report index and its summary tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as X, url as U
from .relational import first_wins, top_per_group, with_defaults

#: What a summary shows of reports that were never fetched or read.
DOWNLOAD_DEFAULTS = {"download_status": "not_attempted", "pdf_bytes": 0}
EXTRACTION_DEFAULTS = {"extraction_status": "not_attempted", "language": "unknown", "pdf_pages": 0, "pages_extracted": 0, "word_count": 0, "tables_found": 0, "text_file": "", "table_file": ""}


def normalised(raw: DataFrame, years: list[int] | None = None) -> DataFrame:
    """Index rows of raw reports (nested company, text numbers): repaired links with a host, keys, one row per filing.

    With years, rows of other or unknown years go. Of rows with equal link and page range the first ordinal stays.
    """
    name = lambda c: F.coalesce(F.nullif(X.strip(F.col(c).cast("string")), F.lit("")), F.lit(""))
    df = raw.select(
        F.col("id").cast("string").alias("doc_id"), F.coalesce(F.nullif(name("company.name"), F.lit("")), F.lit("unknown")).alias("company"),
        *[name(f"company.{c}").alias(c) for c in ("isin", "lei", "country", "sector", "industry")],
        X.as_int(F.col("year")).alias("report_year"), name("type").alias("doc_type"), name("csrd_compliant").alias("csrd_compliant"), name("auditor").alias("auditor"), name("publication_date").alias("publication_date"),
        U.clean_url(F.col("original_link")).alias("link"), X.as_int(F.col("pdfpage_sust_start")).alias("page_start"), X.as_int(F.col("pdfpage_sust_end")).alias("page_end"), "ordinal",
    )
    if years:
        df = df.where(F.col("report_year").isin(*years))
    df = first_wins(df.where(U.has_host(F.col("link"))), ["link", "page_start", "page_end"], "ordinal")
    return df.withColumn("stem", X.stem(F.col("company"), F.col("isin"), F.col("report_year"), F.col("page_start"), F.col("page_end")))


def usable(status: Column) -> Column:
    return status.startswith("success") | (status == "skipped")


def summary(index: DataFrame, downloads: DataFrame, extractions: DataFrame) -> DataFrame:
    """The master table: index rows with what their download and their extraction came to."""
    return with_defaults(with_defaults(index, downloads, ["stem"], DOWNLOAD_DEFAULTS), extractions, ["stem"], EXTRACTION_DEFAULTS)


def mirrored(index: DataFrame, mirror: DataFrame) -> DataFrame:
    """index with mirror, the first mirror(link, download, ordinal) row of an equal link key."""
    keyed = first_wins(mirror.withColumn("__key", U.mirror_key(F.col("link"))), ["__key"], "ordinal").select("__key", F.col("download").alias("mirror"))
    return index.withColumn("__key", U.mirror_key(F.col("link"))).join(keyed, "__key", "left").drop("__key")


def totals(summary: DataFrame) -> DataFrame:
    """One row: reports, usable and failed downloads, and words, pages and tables of what was read."""
    ok, read = usable(F.col("download_status")), F.col("extraction_status") == "success"
    over = lambda c: F.coalesce(F.sum(F.when(read, F.col(c)).cast("long")), F.lit(0))
    return summary.agg(F.count("*").alias("reports"), F.count_if(ok).alias("downloaded"), F.count_if(~ok).alias("failed"), F.count_if(read).alias("extracted"), over("word_count").alias("words"), over("pages_extracted").alias("pages"), over("tables_found").alias("tables"))


def outcome(attempts: DataFrame) -> DataFrame:
    """stem, status, attempts: what recorded fetch attempts came to; the first success, else a challenge, else the last.

    attempts(stem, attempt_no, strategy, http_status, server, body_sample, error_class); successes after the first
    strategy carry its name.
    """
    from ..functions.lexicon import CHALLENGES, RETRY_STATUS

    body = F.lower(F.coalesce("body_sample", F.lit("")))
    wall = F.lit(None).cast("string")
    wall = F.when(F.lower(F.coalesce("server", F.lit(""))).contains("cloudflare"), "cloudflare_challenge").otherwise(wall)
    for name, marks in reversed(CHALLENGES):
        wall = F.when(F.greatest(*[body.contains(m) for m in marks]), name).otherwise(wall)
    refused = F.col("http_status").isin(*RETRY_STATUS)
    status = (
        F.when(F.col("error_class").isNotNull(), F.col("error_class")).when(refused & wall.isNotNull(), wall)
        .when(F.col("http_status") == 200, F.when(F.col("strategy") == "plain", "success").otherwise(F.concat(F.lit("success:"), F.col("strategy")))).otherwise(F.concat(F.lit("http_"), F.col("http_status").cast("string")))
    )
    rank = F.when(status.startswith("success"), 0).when(status.endswith("_challenge") | (status == "akamai_denied"), 1).otherwise(2)
    order = F.struct(rank.alias("r"), F.when(rank < 2, F.col("attempt_no")).otherwise(-F.col("attempt_no")).alias("n"))
    return attempts.groupBy("stem").agg(F.min_by(status, order).alias("status"), F.count("*").alias("attempts"))


def to_retry(log: DataFrame, reason: str | None = None, exact: bool = False) -> DataFrame:
    """Rows of a download log that failed, the first of each url; exact: also successes by a named way."""
    failed = log.where(~F.col("status").isin("success", "skipped") if exact else ~usable(F.col("status")))
    out = first_wins(failed, ["url"], "ordinal")
    return out if reason is None else out.where(F.col("status") == reason)


def with_mirror(outcomes: DataFrame, mirrors: DataFrame, status: str = "success:mirror") -> DataFrame:
    """outcomes(stem, status) in which failures that mirrors(stem, mirror) holds a copy of succeed in the end."""
    out = outcomes.join(mirrors.where("mirror is not null").select("stem", "mirror"), "stem", "left")
    return out.withColumn("status", F.when(~usable(F.col("status")) & F.col("mirror").isNotNull(), status).otherwise(F.col("status")))


#: Columns that a workbook may lack.
FILLED = ("doc_id", "lei", "doc_type", "csrd_compliant", "csrd_report_number", "auditor", "publication_date", "country", "sector", "industry")


def of_workbook(sheet: DataFrame, years: list[int] | None = None) -> DataFrame:
    """Index rows of a sheet of text columns: those with a link, page bounds as numbers, missing columns filled.

    The year is report_year, else the first of year, Year and fiscal year that there is. With years, rows of an unknown
    year stay.
    """
    have = {c: F.col(f"`{c}`") for c in sheet.columns}
    year = next((have[c] for c in ("report_year", "year", "Year", "fiscal year") if c in have), F.lit(None).cast("string"))
    named = {"sector": "SASB sector", "industry": "SASB industry", "page_start": "start PDF", "page_end": "end PDF"}
    get = lambda c: have.get(c, have.get(named.get(c, c)))
    text = lambda c: F.lit("").alias(c) if get(c) is None else F.coalesce(get(c), F.lit("")).alias(c)
    bound = lambda c: (F.lit(None).cast("int") if get(c) is None else X.as_int(get(c))).alias(c)
    rest = [have[c] for c in ("company", "isin", "ordinal") if c in have]
    df = sheet.select(*rest, X.strip(have["link"]).alias("link"), bound("page_start"), bound("page_end"), X.as_int(year).alias("report_year"), *[text(c) for c in FILLED])
    df = df.where(F.col("link").startswith("http"))
    return df if not years else df.where(F.col("report_year").isin(*years) | F.col("report_year").isNull())


def master(index: DataFrame, downloads: DataFrame, extractions: DataFrame) -> DataFrame:
    """The summary as it is written: 23 columns, the link as source_url."""
    s = summary(index, downloads, extractions)
    kept = ["company", "isin", "report_year", "country", "industry", "sector", "doc_type", "csrd_compliant", "auditor", "publication_date", "page_start", "page_end"]
    return s.select(*kept, F.col("link").alias("source_url"), *DOWNLOAD_DEFAULTS, *EXTRACTION_DEFAULTS)


def stem_of_summary(s: DataFrame) -> Column:
    """The key of a summary row, by the rule of the index, whose columns it has."""
    return X.stem(F.coalesce(s["company"], F.lit("")), s["isin"], X.as_int(s["report_year"]), X.as_int(s["page_start"]), X.as_int(s["page_end"]))


def failed_extraction(failures: DataFrame) -> DataFrame:
    """Result rows of failures(stem, error)."""
    none = {"language": "unknown", "pages_extracted": 0, "word_count": 0, "tables_found": 0, "pdf_pages": 0}
    return failures.select("stem", F.lit("failed").alias("extraction_status"), "error", *[F.lit(v).alias(c) for c, v in none.items()], *[F.lit(None).cast("string").alias(c) for c in ("text_file", "table_file")])


def reusable(texts: DataFrame, pdfs: DataFrame) -> DataFrame:
    """Results of texts(stem, text, text_file, text_time, tables_json) that are no older than the file they come from.

    pdfs(stem, pdf_time) are those still there; a text without one is good. Counts are taken from the text.
    """
    from ..sources.files import table_count

    t = texts.join(pdfs.select("stem", "pdf_time"), "stem", "left").where("pdf_time is null or text_time >= pdf_time")
    n, text = table_count(F.col("tables_json")), F.col("text")
    return t.select(
        "stem", F.lit("success").alias("extraction_status"), F.lit("").alias("error"), X.language(text).alias("language"), X.page_count(text).cast("int").alias("pages_extracted"), F.lit(0).alias("pdf_pages"),
        X.word_count_without_marks(text).alias("word_count"), n.alias("tables_found"), "text_file", F.when(n > 0, F.concat(F.lit("tables/"), "stem", F.lit("_tables.json"))).alias("table_file"),
    )


def overlay(fresh: DataFrame, cached: DataFrame, key: str = "stem") -> DataFrame:
    """The rows of both; where both have a key the cached one."""
    return cached.unionByName(fresh.join(cached.select(key), key, "left_anti"), allowMissingColumns=True)


def failure_counts(summary: DataFrame, k: int = 5) -> DataFrame:
    """value, n, rank: the k most frequent statuses of failed downloads."""
    n = summary.where(~usable(F.col("download_status"))).groupBy(F.col("download_status").alias("value")).agg(F.count("*").alias("n"))
    return top_per_group(n, [], k, F.desc("n"), "value")


def archive_totals(raw: DataFrame, country: Column) -> DataFrame:
    """reports, linked, ranged, countries of raw reports; a missing country is one of its own."""
    some = lambda c: F.coalesce(F.nullif(F.nullif(F.col(c).cast("string"), F.lit("")), F.lit("0")), F.lit(None))
    ranged = some("pdfpage_sust_start").isNotNull() & some("pdfpage_sust_end").isNotNull()
    return raw.agg(F.count("*").alias("reports"), F.count_if(F.coalesce(F.col("original_link"), F.lit("")).startswith("http")).alias("linked"), F.count_if(ranged).alias("ranged"), F.count_distinct(F.coalesce(country, F.lit("None"))).alias("countries"))
