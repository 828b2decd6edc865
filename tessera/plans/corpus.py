"""Queries of building a corpus: index sources, files, selection, extraction, sinks and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X, url as U
from ..operators import index as I, keywords as K, relational as R, selection as E
from ..sources import devalue, files, scratch, sinks
from ..streaming import incremental
from . import fixtures as Z
from .queries import DOCUMENTS, _FOUND, _INDEX, _REPORTS, _SUMMARY, _TOKENS, _quoted, _raw, _reports, _spread, _t, query

_YEARS = [2021, 2022]


@query(f"""with s as ({Z.plain(Z.SHEET)}), n as (select *, cast(row_number() over (order by k) + 3 as bigint) as ordinal from s where nation = (select max(nation) from s)),
i as (select ordinal, company, trim(link) as link, cast(try_cast(nullif(page_start, '') as double) as int) as page_start, case when page_end = 'nan' then null else try_cast(page_end as int) end as page_end, case when year_text = 'nan' then null else cast(year_text as int) end as report_year, segment as country from n)
select *, '' as doc_type, '' as sector from i where link like 'http%' and (report_year in (2021, 2022) or report_year is null)""")
def workbook_index(spark, sf):
    """The newest of several workbooks, its header in row 3, as index rows."""
    sheet = files.workbook(Z.workbooks(spark, sf))
    return I.of_workbook(sheet, _YEARS).select("ordinal", "company", "link", "page_start", "page_end", "report_year", "country", "doc_type", "sector")


_SUMMARIES = f"s as ({Z.plain(Z.SUMMARIES)})"


@query(f"""with {_SUMMARIES}, t as ({Z.plain(Z.TEXTS)}), e as (select * from s where extraction_status = 'success' and language = 'en' and trim(text_file) <> ''), j as (select ordinal, t.stem, t.path as text_path, company, report_year, word_count from e join t on t.stem = 't' || e.ordinal)
select ordinal, stem, text_path, 'esrs_output/' || stem || '.json' as out_path, company, report_year, word_count from j where ordinal % 9 <> 0""")
def report_selection(spark, sf):
    """Reports with a text, at its recorded place or under its name, that have no output yet."""
    done = _t(spark, sf, "orders").where("o_orderkey % 9 = 0").select(F.concat(F.lit("t"), F.col("o_orderkey").cast("string")).alias("stem"))
    jobs = E.jobs(Z.table(spark, sf, Z.SUMMARIES), Z.table(spark, sf, Z.TEXTS), done)
    return jobs.select("ordinal", "stem", "text_path", "out_path", "meta.company", "meta.report_year", "meta.word_count")


@query("select o_orderkey, o_custkey from orders order by o_orderkey limit 50 offset 100")
def selection_window(spark, sf):
    return E.window(_t(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", 100, 50)


@query(f"""with {_INDEX}, k as (select *, regexp_replace(trim(regexp_replace(company, '[^A-Za-z0-9_\\s#-]|#', '', 'g')), '\\s+', '_', 'g') || '_' || case when isin = '' then 'noisin' else isin end || case when report_year is null then '' else '_' || report_year end || case when page_start is null then '' else '_p' || page_start || '-' || page_end end as stem from idx),
d as ({Z.plain(Z.DOWNLOADS)}), e as ({Z.plain(Z.EXTRACTIONS)})
select company, k.isin, k.report_year, country, '' as industry, '' as sector, '' as auditor, page_start, page_end, link as source_url, coalesce(d.download_status, 'not_attempted') as download_status, coalesce(d.pdf_bytes, 0) as pdf_bytes, coalesce(e.extraction_status, 'not_attempted') as extraction_status, coalesce(e.language, 'unknown') as language, coalesce(e.word_count, 0) as word_count
from k left join d on d.stem = k.doc_id left join e on e.stem = k.doc_id""")
def summary_projection(spark, sf):
    """The master summary under the names that it is written with."""
    index = I.normalised(_raw(spark, sf)).withColumn("stem", F.col("doc_id"))
    master = I.master(index, Z.table(spark, sf, Z.DOWNLOADS), Z.table(spark, sf, Z.EXTRACTIONS))
    return master.select("company", "isin", "report_year", "country", "industry", "sector", "auditor", "page_start", "page_end", "source_url", "download_status", "pdf_bytes", "extraction_status", "language", "word_count")


@query(f"with {_SUMMARIES} select ordinal, 'Company_' || ordinal || '_Co_' || case when isin = '' then 'noisin' else isin end || '_' || report_year || case when page_start = '' then '' else '_p' || page_start || '-' || page_end end as stem from s")
def rebuilt_stems(spark, sf):
    df = Z.table(spark, sf, Z.SUMMARIES)
    return df.select("ordinal", I.stem_of_summary(df).alias("stem"))


@query(f"""with rep as ({_REPORTS}), documents as (select doc_id, 'en' as lang, text from rep), {_TOKENS}, w as (select doc_id, string_agg(word, ', ' order by rank) as top_keywords from top where rank <= 10 group by doc_id), m as (select doc_id, list_distinct(list_transform({' || '.join(_FOUND)}, lambda x: trim(x))) as found from rep)
select rep.doc_id, coalesce(top_keywords, '') as top_keywords, cast(len(found) as int) as metric_hits from rep join m using (doc_id) left join w using (doc_id)""")
def document_profile(spark, sf):
    """The flat rows of a table of reports."""
    return K.flat(K.profile(_reports(spark, sf))).select("doc_id", "top_keywords", "metric_hits")


@query(f"with rep as ({_REPORTS}) select doc_id, substr(regexp_replace(company || ' ' || country, '[^A-Za-z0-9_]', '_', 'g'), 1, 60) || '.json' as file, doc_id as inside from rep")
def document_details(spark, sf):
    """What is written of each report: a safe file name, and all of its profile as JSON."""
    d = K.detail(K.profile(_reports(spark, sf)), F.concat_ws(" ", "company", "country"))
    return d.select(F.get_json_object("body", "$.doc_id").cast("long").alias("doc_id"), "file", F.get_json_object("body", "$.doc_id").cast("long").alias("inside"))


@query("select 'o' || o_orderkey as stem, 'failed' as extraction_status, 'open: ' || o_orderpriority as error, 'unknown' as language, 0 as pages_extracted, 0 as word_count, 0 as tables_found, 0 as pdf_pages, cast(null as varchar) as text_file, cast(null as varchar) as table_file from orders where o_orderstatus = 'P'")
def failed_extractions(spark, sf):
    f = _t(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("stem"), F.concat(F.lit("open: "), "o_orderpriority").alias("error"))
    return I.failed_extraction(f)


@query(f"""with x as ({Z.plain(Z.STORED)}), k as (select cast(substr(stem, 2) as bigint) as k, * from x), c as (select stem, 1 + case when k % 2 = 0 then 1 else 0 end as pages_extracted, cast(len(regexp_extract_all(regexp_replace(text, '\\[\\[page:\\d+\\]\\]', ' ', 'g'), '\\S+')) as bigint) as word_count, case when k % 3 = 0 then 2 else 0 end as tables_found, case when k % 3 = 0 then 'tables/' || stem || '_tables.json' end as table_file from k where k % 4 = 0 or text_time >= k % 7),
f as (select stem, 7 as pages_extracted, cast(0 as bigint) as word_count, 0 as tables_found, cast(null as varchar) as table_file from k)
select * from c union all select * from f where stem not in (select stem from c)""")
def reusable_extractions(spark, sf):
    """Texts no older than their PDF are taken as they are; the rest is read again. A cached result wins."""
    stored = Z.table(spark, sf, Z.STORED)
    key = F.substring("stem", 2, 20).cast("long")
    pdfs = stored.where(key % 4 != 0).select("stem", (key % 7).alias("pdf_time"))
    cached = I.reusable(stored, pdfs).select("stem", "pages_extracted", "word_count", "tables_found", "table_file")
    fresh = stored.select("stem", F.lit(7).alias("pages_extracted"), F.lit(0).cast("long").alias("word_count"), F.lit(0).alias("tables_found"), F.lit(None).cast("string").alias("table_file"))
    return I.overlay(fresh, cached)


@query(f"with p as ({Z.plain(Z.PAYLOADS)}) select event_id, contains(lower(coalesce(content_type, '')), 'pdf') or contains(lower(coalesce(content_type, '')), 'octet-stream') or body like '\\%PDF%' escape '\\' as is_pdf, contains(substr(body, 1, 1024), '%PDF') as is_report, contains(substr(body, 1, 1024), '%PDF') and length(body) >= 10000 as valid from p")
def payload_checks(spark, sf):
    head = F.col("body").cast("binary")
    return Z.table(spark, sf, Z.PAYLOADS).select("event_id", files.is_pdf(F.col("content_type"), head).alias("is_pdf"), files.is_report(head).alias("is_report"), files.valid_pdf(head).alias("valid"))


@query("""with l as (select page_id, 'https://cdn.example.com/annual-' || page_id % 7 || '.pdf?v=1' as a, regexp_extract(url, '^(https?://[^/?#]+)', 1) || '/files/a' || page_id || '.pdf' as b from pages),
u as (select page_id, unnest([a, b, 'mailto:x.pdf']) as link, unnest([0, 1, 2]) as pos from l) select page_id, cast(pos as int) as pos, link from u""")
def recovery_links(spark, sf):
    return Z.table(spark, sf, Z.LANDING).select("page_id", F.posexplode(U.recover_links(F.col("html"), F.col("url"))).alias("pos", "link"))


@query(f"with d as ({Z.plain(Z.DOWNLOADS)}), f as (select url, download_status as status, ordinal from d where download_status not in ('success', 'skipped') qualify row_number() over (partition by url order by ordinal) = 1) select * from f where status = 'http_403'")
def retry_exact(spark, sf):
    """The strict worklist, which takes successes by a named way too, of one reason."""
    return I.to_retry(Z.table(spark, sf, Z.DOWNLOADS).withColumnRenamed("download_status", "status"), "http_403", exact=True).select("url", "status", "ordinal")


@query(f"with s as ({Z.plain(Z.INDEX)}) select count(*) as reports, count(*) filter (link like 'http%') as linked, count(*) filter (s is not null and e is not null and s <> '0' and e <> '0') as ranged, count(distinct country) as countries from s")
def archive_totals(spark, sf):
    raw = _raw(spark, sf)
    return I.archive_totals(raw, F.col("company.country"))


@query(f"with {_SUMMARY} select download_status as value, count(*) as n, cast(row_number() over (order by count(*) desc, download_status) as int) as rank from summary where not (download_status like 'success%' or download_status = 'skipped') group by 1 qualify rank <= 5")
def failure_counts(spark, sf):
    index = _t(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("stem"))
    return I.failure_counts(I.summary(index, Z.table(spark, sf, Z.DOWNLOADS), Z.table(spark, sf, Z.EXTRACTIONS)))


@query(f"with d as ({Z.plain(Z.DOWNLOADS)}) select stem, case when not (download_status like 'success%' or download_status = 'skipped') and ordinal % 10 = 1 then 'success:mirror' else download_status end as status from d")
def mirror_last(spark, sf):
    d = Z.table(spark, sf, Z.DOWNLOADS)
    mirrors = d.select("stem", F.when(F.col("ordinal") % 10 == 1, F.concat(F.lit("m/"), "stem")).alias("mirror"))
    return I.with_mirror(d.select("stem", F.col("download_status").alias("status")), mirrors).select("stem", "status")


@query("select event_id, value * 2 as doubled from events")
def resume_stream(spark, sf):
    """Files that arrive in two lots, the second with repeats of the first; a run in between and one run too many."""
    events = _t(spark, sf, "events").select("event_id", "value")
    base = scratch.folder(spark, "stream")
    events.where("event_id % 2 = 0").write.parquet(f"{base}/in")
    run = lambda: incremental.run_once(incremental.arriving(spark, f"{base}/in", events.schema, files=4), lambda b: b.select("event_id", (F.col("value") * 2).alias("doubled")), ["event_id"], f"{base}/out", f"{base}/check")
    run()
    events.where("event_id % 2 = 1 or event_id % 4 = 0").write.mode("append").parquet(f"{base}/in")
    run()
    run()
    return spark.read.parquet(f"{base}/out").select("event_id", "doubled")


@query("select c_custkey, case when c_custkey % 3 = 0 then 'recovered' when c_custkey % 2 = 0 then 'http_403' else 'success' end as status, case when c_custkey % 3 = 0 then 'r2' else 'r1' end as run_id from customer")
def append_log(spark, sf):
    """A log appended to by two runs, one of which is repeated; the latest status of each key."""
    path = scratch.folder(spark, "log")
    c = _t(spark, sf, "customer").select("c_custkey")
    sinks.append(c.withColumn("status", F.when(F.col("c_custkey") % 2 == 0, "http_403").otherwise("success")), path, "r1")
    for _ in range(2):
        sinks.append(c.where("c_custkey % 3 = 0").withColumn("status", F.lit("recovered")), path, "r2")
    return sinks.current(spark.read.parquet(path), ["c_custkey"])


@query("select c_custkey, case when c_custkey % 4 = 0 then null else c_name || ', \"the\" first' || chr(10) || 'line' end as name, case when c_custkey % 5 = 0 then null else c_acctbal end as balance from customer")
def csv_round_trip(spark, sf):
    """A table written as CSV, with commas, quotes, line breaks and nulls, and read back by its schema."""
    path = scratch.folder(spark, "csv")
    k = F.col("c_custkey")
    name = F.when(k % 4 == 0, None).otherwise(F.concat("c_name", F.lit(', "the" first\nline')))
    sinks.overwrite_csv(_t(spark, sf, "customer").select("c_custkey", name.alias("name"), F.when(k % 5 == 0, None).otherwise(F.col("c_acctbal")).alias("balance")), path)
    return files.csv(spark, path, "c_custkey long, name string, balance double")


@query("select c_nationkey as nation, c_custkey, c_name || ' é' as name from customer")
def json_files(spark, sf):
    path = scratch.folder(spark, "json")
    sinks.json_rows(_t(spark, sf, "customer").select(F.col("c_nationkey").alias("nation"), "c_custkey", F.concat("c_name", F.lit(" é")).alias("name")), path, "nation")
    return spark.read.schema("c_custkey long, name string, nation int").json(path)


@query("select 'E' || (n_regionkey + 1) as standard, 'E' || (n_regionkey + 1) || '-' || n_nationkey as dr_code, n_name as dr_title from nation union all select 'ESRS2', 'BP-1', 'Basis'")
def taxonomy_scan(spark, sf):
    return files.taxonomy(Z.table(spark, sf, Z.LINES)).select("standard", "dr_code", "dr_title")


@query("select 'r' || page_id as id, cast(2000 + page_id % 30 as int) as year, 'C' || page_id as company, cast(null as varchar) as country from pages")
def payload_scan(spark, sf):
    """Reports named in tagged payloads and in the scripts of pages."""
    rows = devalue.reports(_spread(Z.bodies(spark, sf)), "id string, year int, company struct<name:string,country:string>", required=True)
    return rows.select("id", "year", "company.name", "company.country").withColumnRenamed("name", "company")


_BASES = ["https://b.example.com/api", "https://a.example.com/api", "https://c.example.com/api"]


@query(f"with a as ({Z.plain(Z.ANSWERS)}), g as (select path, base, body, list_position([{_quoted(_BASES)}], base) as r from a where http_status = 200 and body <> '<html>') select path, base from g group by path, base, r qualify row_number() over (partition by path order by r) = 1")
def api_failover(spark, sf):
    """The first base in order that answered each request with JSON."""
    return devalue.first_answer(Z.table(spark, sf, Z.ANSWERS), _BASES).select("path", "base")


@query("""with p as (select p_partkey as k, cast(greatest(p_partkey % 100, p_partkey % 300) + 4 as int) as n from part) select cast(k as varchar) as path, case when k % 5 = 0 then 'bad_zip:BadZipFile' when k % 5 = 1 then 'zip_without_pdf' when n < 60 then 'file_too_small' when n > 250 then 'too_large_0MB' end as error, case when k % 5 > 1 and n between 60 and 250 then n end as bytes from p""")
def zip_members(spark, sf):
    """The largest PDF member of each archive, or why there is none."""
    got = files.pdf_of_zip(_spread(Z.archives(spark, sf), DOCUMENTS, "path"), most=250, least=60)
    return got.select("path", "error", F.length("pdf").alias("bytes"))


_PAGED = f"""t as ({Z.plain(Z.TABLED)}), n as (select stem, max(page) as pdf_pages, min(a) as a from t group by stem), r as (select stem, pdf_pages, greatest(1, least(case when a = 0 then 1 else a end, pdf_pages)) as s, a from n), k as (select *, greatest(s, least(case when a = 1 then pdf_pages else a + 2 end, pdf_pages)) as e from r)"""


@query(f"""with {_PAGED}, own as (select t.*, s, e, pdf_pages from t join k using (stem) where page between s and e), j as (select stem, string_agg('[[page:' || page || ']]' || chr(10) || coalesce(text, ''), chr(10) || chr(10) order by page) as text, cast(count(*) filter (b = 1) as int) as tables_found from own group by stem)
select k.stem, k.pdf_pages, case when text is null then 'failed' else 'success' end as extraction_status, case when text is null then 0 else e - s + 1 end as pages_extracted, coalesce(tables_found, 0) as tables_found, cast(coalesce(len(regexp_extract_all(regexp_replace(text, '\\[\\[page:\\d+\\]\\]', ' ', 'g'), '[^\\s\\x0B\\x{{85}}\\x{{A0}}]+')), 0) as bigint) as word_count, length(text) as n_chars from k left join j using (stem)""")
def page_extraction(spark, sf):
    """Page rows to marked texts and useful tables, within clamped page ranges, landed as files and read back."""
    tabled = Z.table(spark, sf, Z.TABLED)
    grid = lambda *rows: F.array(*[F.array(*[F.lit(c) for c in r]) for r in rows])
    good, small, narrow, bare = grid(("Name", "x"), ("b", "c")), grid(("Name", "x")), grid(("Name",), ("word",), ("more",), ("else",)), grid(("1", "2"), ("3", "4"))
    b = F.col("b")
    tables = F.when(b == 1, F.array(good, small)).when(b == 2, F.array(narrow, bare)).when(b == 3, F.array(small))
    pages = tabled.select("stem", "page", "text", tables.alias("tables"))
    tasks = tabled.groupBy("stem").agg(F.max("page").alias("pdf_pages"), F.min("a").alias("a")).select("stem", F.col("a").alias("page_start"), F.when(F.col("a") == 1, None).otherwise(F.col("a") + 2).alias("page_end"), "pdf_pages")
    got = files.from_pages(tasks, pages)
    path = scratch.folder(spark, "texts")
    sinks.extraction_files(got, path)
    texts, found = spark.read.parquet(f"{path}/texts"), spark.read.parquet(f"{path}/tables").select("stem", files.table_count(F.col("tables_json")).alias("tables_found"))
    out = got.select("stem", "pdf_pages", "extraction_status", "pages_extracted", "word_count").join(texts, "stem", "left").join(found, "stem", "left")
    return out.select("stem", "pdf_pages", "extraction_status", "pages_extracted", F.coalesce("tables_found", F.lit(0)).alias("tables_found"), "word_count", F.length("text").cast("long").alias("n_chars"))


@query("select page_id, regexp_extract(url, '^(https?://[^/?#]+)', 1) || '/' as referer, 'x' as agent, cast(4 as int) as n from pages")
def request_headers(spark, sf):
    h = U.headers(F.col("url"), "x")
    return _t(spark, sf, "pages").select("page_id", h["Referer"].alias("referer"), h["User-Agent"].alias("agent"), F.size(h).alias("n"))


@query("with h as (select page_id, lower(regexp_extract(url, '://([^/?#:]+)', 1)) as host from pages) select page_id, cast(row_number() over (partition by host order by page_id) - 1 as double) * 1.5 as start_after from h")
def host_schedule(spark, sf):
    """When each request may start if a host gets one at a time, so many seconds apart."""
    return R.round_robin(_t(spark, sf, "pages").select("page_id", U.host(F.col("url")).alias("host")), "host", "page_id", gap=1.5).select("page_id", "start_after")


@query("select o_orderkey, printf('%.1f MB', o_custkey * 1000003 / 1048576.0) as size, printf('%.1f%%', 100.0 * (o_orderkey % 7) / 7) as share from orders")
def text_formats(spark, sf):
    o = _t(spark, sf, "orders")
    return o.select("o_orderkey", X.megabytes(F.col("o_custkey") * 1000003).alias("size"), X.percent(F.col("o_orderkey") % 7, F.lit(7)).alias("share"))


@query(f"""with s as ({Z.plain(Z.SPANS)}), v as (select *, l_orderkey % 7 as c from s), n as (select *, case c when 0 then 1900 + l_orderkey % 200 when 1 then l_orderkey % 10 when 3 then l_orderkey % 900 when 5 then null when 6 then l_orderkey % 90 + 0.5 else l_orderkey % 900 + 10 end as value from v)
select l_orderkey, l_linenumber, cast(value as double) as value, case c when 3 then 'tonnes' when 6 then '%' end as unit, case when value is null then false when c in (3, 6) then true when value between 1900 and 2100 and value = floor(value) then false when value < 10 then false else c = 4 end as plausible from n""")
def plausible_values(spark, sf):
    """Numbers with and without units, years and list numbers among them."""
    v = Z.table(spark, sf, Z.SPANS).withColumn("v", X.value_and_unit(F.col("span")))
    return v.select("l_orderkey", "l_linenumber", "v.value", "v.unit", X.plausible(F.col("v.value"), F.col("v.unit"), F.col("span")).alias("plausible"))


