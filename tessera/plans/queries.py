"""Queries of the reference's operators over the test tables, each with SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import lexicon as L, text as X, url as U
from ..operators import disclosure as D, index as I, keywords as K, merge as M, relational as R, semantic as S
from . import fixtures as Z

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


#: Rows that a task of expensive expressions takes: documents of any length, reports of some hundred characters.
DOCUMENTS, REPORTS = 5_000, 50_000


def _tasks(df: DataFrame, most: int) -> int:
    """How many tasks a table is dealt out to: one a core, more where one would take more than most rows."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // most))


#: Parts up to which Spark's shuffle writes rows straight to their files; for more it gathers a task's rows in memory first.
PARTS = 200


def _spread(df: DataFrame, most: int = DOCUMENTS, *by: str) -> DataFrame:
    """Rows of a table dealt out to _tasks() for expensive expressions; as they are where as many parts hold rows, none over
    twice its share. A file is cut into parts that may hold nothing, as a row group is read by one of them whole.

    They go by the hash of some columns (of all without any) to at most PARTS parts or as many as there are cores, so that no
    task holds the texts that it deals out; rows dealt out in turn are sorted in memory first.
    """
    held = df.groupBy(F.spark_partition_id().alias("part")).count().agg(F.count("*").alias("parts"), F.coalesce(F.max("count"), F.lit(0)).alias("largest"), F.coalesce(F.sum("count"), F.lit(0)).alias("rows")).first()
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, min(-(-held["rows"] // most), PARTS))
    even = held["parts"] >= tasks and held["largest"] * tasks <= 2 * held["rows"]
    return df if even else df.repartition(tasks, *(by or df.columns))


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents dealt out by doc_id and text: rows without doc_id do not meet in one task."""
    return _spread(_t(spark, sf, "documents"), DOCUMENTS, "doc_id", "text")


def _reports(spark: SparkSession, sf: str) -> DataFrame:
    """Reports in _tasks() parts: both sides are dealt out by customer, so the join keeps them whether it broadcasts or not."""
    orders, customer, nation = (_t(spark, sf, n) for n in ("orders", "customer", "nation"))
    tasks = _tasks(orders, REPORTS)
    return spark.sql(Z.REPORTS, orders=orders.repartition(tasks, "o_custkey"), customer=customer.repartition(tasks, "c_custkey"), nation=nation)


def _quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def _count(column: str, pattern: str) -> str:
    return f"cast(len(regexp_extract_all({column}, '{pattern}')) as bigint)"


_REPORTS = Z.plain(Z.REPORTS)
_TOKENS = f"""tok as (select doc_id, unnest(l) as word, generate_subscripts(l, 1) as pos from (select doc_id, regexp_extract_all(lower(text), '[a-z]{{3,}}') as l from documents where lang = 'en')),
kw as (select doc_id, word, count(*) as n, min(pos) as f from tok where word not in ({_quoted(L.STOPWORDS)}) group by all),
top as (select doc_id, word, n, row_number() over (partition by doc_id order by n desc, f) as rank from kw qualify rank <= 20)"""
_HITS = {p: _count("text", L.keyword_pattern(w)) for p, w in L.THEMES.items()}
_SCORED = f"""rep as ({_REPORTS}), cl as (select doc_id, company, country, report_year, trim(text) as text from rep),
h as (select *, {', '.join(f'{v} as {p}' for p, v in _HITS.items())} from cl),
scored as (select doc_id, company, country, report_year, text, environment, social, governance, {', '.join(f'round({p} / greatest(environment + social + governance, 1), 3) as {p}_density' for p in L.PILLARS)},
 case when environment = 0 and social = 0 and governance = 0 then 'unknown' when environment >= social and environment >= governance then 'environment' when social >= governance then 'social' else 'governance' end as dominant_pillar from h)"""


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    return K.scores(_reports(spark, sf))


@query(f"with {_TOKENS} select word, cast(sum(n) as bigint) as n from top group by word")
def top_keywords(spark, sf):
    """Sums of each English document's twenty most frequent words."""
    return K.corpus_keywords(_documents(spark, sf).where("lang = 'en'"), n=None)


@query(f"with {_TOKENS} select word, cast(sum(n) as bigint) as n from top group by word order by n desc, word limit 15")
def chart_keywords(spark, sf):
    return K.corpus_keywords(_documents(spark, sf).where("lang = 'en'"))


@query(f"with {_TOKENS} select doc_id, word, n, cast(rank as int) as rank from top")
def document_keywords(spark, sf):
    return K.document_keywords(_documents(spark, sf).where("lang = 'en'"))


@query(f"with {_SCORED} select doc_id, {_count('text', '[^ ]+')} as word_count, environment, social, governance, environment_density, social_density, governance_density, dominant_pillar from scored")
def pillar_scores(spark, sf):
    return _scored(spark, sf).select("doc_id", "word_count", *L.PILLARS, *[f"{p}_density" for p in L.PILLARS], "dominant_pillar")


@query(f"with {_SCORED} select dominant_pillar, count(*) as n from scored where dominant_pillar <> 'unknown' group by 1")
def dominant_pillars(spark, sf):
    return K.pillar_counts(_scored(spark, sf))


@query(f"with {_SCORED} select {', '.join(f'round(avg({p}), 6) as {p}' for p in L.PILLARS)} from scored")
def mean_hits(spark, sf):
    return K.mean_hits(_scored(spark, sf))


@query(f"""with {_SCORED}, top as (select country, count(*) as reports from scored group by 1 order by reports desc, country limit 10),
m as (select country, reports, {', '.join(f'avg({p}_density) as {p}' for p in L.PILLARS)} from scored join top using (country) group by all)
select country, reports, {', '.join(f'round({p} / nullif(environment + social + governance, 0), 6) as {p}' for p in L.PILLARS)} from m""")
def country_mix(spark, sf):
    return K.country_mix(_scored(spark, sf))


@query(f"with {_SCORED} select report_year as year, count(*) as reports, {', '.join(f'round(avg({p}_density), 6) as {p}' for p in L.PILLARS)} from scored group by 1")
def year_comparison(spark, sf):
    return K.year_comparison(_scored(spark, sf), F.col("report_year").cast("string"))


_SENTENCES = "unnest(string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)))"


@query(f"""with rep as ({_REPORTS}), s as (select doc_id, trim({_SENTENCES}) as sentence from rep), e as ({' union all '.join(f"select doc_id, '{p}' as pillar, {_count('sentence', L.keyword_pattern(w))} as hits, sentence from s where length(sentence) >= 30" for p, w in L.THEMES.items())})
select doc_id, pillar, hits, sentence, cast(row_number() over (partition by doc_id, pillar order by hits desc, sentence desc) as int) as rank from e where hits > 0 qualify rank <= 3""")
def key_sentences(spark, sf):
    return K.key_sentences(_reports(spark, sf))


_FOUND = [f"regexp_extract_all(text, '(?i){p}')" for p in L.METRICS]


@query(f"with rep as ({_REPORTS}), m as (select doc_id, {' || '.join(_FOUND)} as found from rep), f as (select doc_id, unnest(found) as snippet, generate_subscripts(found, 1) as pos from m) select doc_id, trim(snippet) as snippet, cast(row_number() over (partition by doc_id order by min(pos)) - 1 as int) as pos from f group by doc_id, trim(snippet)")
def metric_snippets(spark, sf):
    return _reports(spark, sf).select("doc_id", F.posexplode(X.metrics(F.col("text"))).alias("pos", "snippet"))


_SAMPLE = "case when length(text) > 12000 then substr(text, 1, 4000) || chr(10) || substr(text, cast(floor(length(text) / 2.0) as bigint) + 1, 4000) || chr(10) || substr(text, length(text) - 3999, 4000) else substr(text, 1, 4000) end"


@query(
    "with w as (select doc_id, lang, regexp_extract_all(lower(" + _SAMPLE + "), '[\\p{L}\\p{Nl}\\p{No}]+') as ws from documents), s as ("
    + " union all ".join(f"select doc_id, lang, len(ws) as n, len(list_filter(ws, lambda x: x in ({_quoted(dict.fromkeys(v.split()))}))) / nullif(len(ws), 0) as share, '{k}' as detected, {i} as i from w" for i, (k, v) in enumerate(L.LANGUAGE_WORDS.items()))
    + "), b as (select *, row_number() over (partition by doc_id order by share desc, i) as r from s) select lang, case when n >= 40 and share >= 0.04 then detected else 'unknown' end as detected, count(*) as n from b where r = 1 group by 1, 2"
)
def language_profile(spark, sf):
    return _documents(spark, sf).select("lang", X.language(F.col("text")).alias("detected")).groupBy("lang", "detected").agg(F.count("*").alias("n"))


@query("select doc_id, cast(len(regexp_extract_all(text, '[^\\s\\x0B\\x{85}\\x{A0}]+')) as bigint) as word_count, cast(0 as bigint) as pages, length(regexp_replace(trim(regexp_replace(regexp_replace(translate(text, chr(12) || chr(13), chr(10) || chr(10)), '\\n{3,}', chr(10) || chr(10), 'g'), '[ \\t]{2,}', ' ', 'g'), ' ' || chr(9) || chr(10)), '', '')) as clean_length from documents")
def word_counts(spark, sf):
    t = F.col("text")
    return _t(spark, sf, "documents").select("doc_id", X.word_count_without_marks(t).alias("word_count"), X.page_count(t).alias("pages"), F.length(X.clean_text(t)).cast("long").alias("clean_length"))


def _raw(spark, sf):
    company = F.struct(F.col("name"), "isin", F.lit(None).cast("string").alias("lei"), "country", F.lit("").alias("sector"), F.lit("").alias("industry"))
    return Z.table(spark, sf, Z.INDEX).select("id", "ordinal", company.alias("company"), F.col("year_text").alias("year"), F.col("kind").alias("type"), F.lit("full").alias("csrd_compliant"), F.lit("").alias("auditor"), F.lit("").alias("publication_date"), F.col("link").alias("original_link"), F.col("s").alias("pdfpage_sust_start"), F.col("e").alias("pdfpage_sust_end"))


_CLEAN_LINK = "case when link like 'hhttps://%' then substr(link, 2) when link like '//%' then 'https:' || link when link like '%://%' then link else 'https://' || link end"
_INDEX = f"""src as ({Z.plain(Z.INDEX)}), n as (select id as doc_id, case when name = '' then 'unknown' else name end as company, isin, country, try_cast(try_cast(year_text as double) as int) as report_year, year_text, replace({_CLEAN_LINK}, ' ', '%20') as link, cast(s as int) as page_start, cast(e as int) as page_end, ordinal from src),
idx as (select doc_id, company, isin, country, case when year_text = 'nan' then null else report_year end as report_year, link, page_start, page_end, ordinal from n where link not like '%//nodot%' qualify row_number() over (partition by link, page_start, page_end order by ordinal) = 1)"""


@query(f"""with {_INDEX} select doc_id, company, isin, country, report_year, link, page_start, page_end, ordinal, regexp_replace(trim(regexp_replace(company, '[^A-Za-z0-9_\\s#-]|#', '', 'g')), '\\s+', '_', 'g') || '_' || case when isin = '' then 'noisin' else isin end || case when report_year is null then '' else '_' || report_year end || case when page_start is null then '' else '_p' || page_start || '-' || page_end end as stem from idx""")
def report_index(spark, sf):
    return I.normalised(_raw(spark, sf)).select("doc_id", "company", "isin", "country", "report_year", "link", "page_start", "page_end", "ordinal", "stem")


@query(f"with {_INDEX}, y as (select * from n where report_year in (1996, 1997) and link not like '%//nodot%' qualify row_number() over (partition by link, page_start, page_end order by ordinal) = 1) select report_year, count(*) as reports, count(*) filter (page_start is not null and page_end is not null) as ranged from y group by 1")
def reports_per_year(spark, sf):
    df = I.normalised(_raw(spark, sf), [1996, 1997])
    return df.groupBy("report_year").agg(F.count("*").alias("reports"), F.count_if(F.col("page_start").isNotNull() & F.col("page_end").isNotNull()).alias("ranged"))


_BASED = "replace(case when trim(url) like 'hhttp%' then substr(trim(url), 2) when trim(url) like '//%' then 'https:' || trim(url) when trim(url) like '%://%' then trim(url) else 'https://' || trim(url) end, ' ', '%20')"


@query(f"with u as ({Z.plain(Z.URLS)}), c as (select page_id, {_BASED} as link from u) select page_id, link, lower(rtrim(split_part(regexp_replace(link, '^https?://', ''), '?', 1), '/')) as mirror_key, lower(regexp_extract(link, '://([^/?#:]+)', 1)) as host from c")
def url_repair(spark, sf):
    link = U.clean_url(F.col("url"))
    return Z.table(spark, sf, Z.URLS).select("page_id", link.alias("link")).select("page_id", "link", U.mirror_key(F.col("link")).alias("mirror_key"), U.host(F.col("link")).alias("host"))


@query("with h as (select page_id, lower(regexp_extract(url, '://([^/?#:]+)', 1)) as host from pages) select page_id, host, cast(row_number() over (partition by host order by page_id) as int) as turn, min(page_id) over (partition by host) as first_ordinal from h")
def host_round_robin(spark, sf):
    return R.round_robin(_t(spark, sf, "pages").select("page_id", U.host(F.col("url")).alias("host")), "host", "page_id")


@query("""with l as (select page_id, 'https://cdn.example.com/annual-' || page_id % 7 || '.pdf?v=1' as a, regexp_extract(url, '^(https?://[^/?#]+)', 1) || '/files/a' || page_id || '.pdf' as b, 'https://cdn.example.com/media/' || page_id || '/download' as c from pages),
u as (select page_id, unnest([a, b, c]) as link, unnest([0, 1, 2]) as pos from l) select page_id, cast(pos as int) as pos, link from u""")
def link_candidates(spark, sf):
    return Z.table(spark, sf, Z.LANDING).select("page_id", F.posexplode(U.report_links(F.col("html"), F.col("url"), 4)).alias("pos", "link"))


@query(f"""with {_INDEX}, m as (select replace(link, 'https://', 'http://') || '/' as link, 'mirror/' || doc_id as download, ordinal from idx where ordinal % 7 = 0),
k as (select lower(rtrim(split_part(regexp_replace(link, '^https?://', ''), '?', 1), '/')) as key, download, row_number() over (partition by lower(rtrim(split_part(regexp_replace(link, '^https?://', ''), '?', 1), '/')) order by ordinal) as r from m)
select doc_id, k.download as mirror from idx left join k on k.r = 1 and k.key = lower(rtrim(split_part(regexp_replace(idx.link, '^https?://', ''), '?', 1), '/'))""")
def mirror_join(spark, sf):
    index = I.normalised(_raw(spark, sf))
    mirror = index.where("ordinal % 7 = 0").select(F.concat(F.replace("link", F.lit("https://"), F.lit("http://")), F.lit("/")).alias("link"), F.concat(F.lit("mirror/"), "doc_id").alias("download"), "ordinal")
    return I.mirrored(index, mirror).select("doc_id", "mirror")


_SUMMARY = f"""i as (select cast(o_orderkey as string) as stem, o_custkey from orders), d as ({Z.plain(Z.DOWNLOADS)}), x as ({Z.plain(Z.EXTRACTIONS)}),
summary as (select stem, coalesce(d.download_status, 'not_attempted') as download_status, coalesce(d.pdf_bytes, 0) as pdf_bytes, coalesce(x.extraction_status, 'not_attempted') as extraction_status, coalesce(x.language, 'unknown') as language, coalesce(x.pdf_pages, 0) as pdf_pages, coalesce(x.pages_extracted, 0) as pages_extracted, coalesce(x.word_count, 0) as word_count, coalesce(x.tables_found, 0) as tables_found, coalesce(x.text_file, '') as text_file, coalesce(x.table_file, '') as table_file from i left join d using (stem) left join x using (stem))"""


def _summary(spark, sf):
    index = _t(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("stem"))
    return I.summary(index, Z.table(spark, sf, Z.DOWNLOADS), Z.table(spark, sf, Z.EXTRACTIONS))


@query(f"with {_SUMMARY} select * from summary")
def master_summary(spark, sf):
    return _summary(spark, sf)


@query(f"with {_SUMMARY}, s as (select *, download_status like 'success%' or download_status = 'skipped' as ok, extraction_status = 'success' as r from summary) select count(*) as reports, count(*) filter (ok) as downloaded, count(*) filter (not ok) as failed, count(*) filter (r) as extracted, cast(coalesce(sum(word_count) filter (r), 0) as bigint) as words, cast(coalesce(sum(pages_extracted) filter (r), 0) as bigint) as pages, cast(coalesce(sum(tables_found) filter (r), 0) as bigint) as tables from s")
def summary_totals(spark, sf):
    return I.totals(_summary(spark, sf))


@query(f"with {_SUMMARY}, p as (select 'download_status' as dimension, download_status as value from summary union all select 'extraction_status', extraction_status from summary union all select 'language', language from summary) select dimension, value, count(*) as n, cast(row_number() over (partition by dimension order by count(*) desc, value) as int) as rank from p group by 1, 2 qualify rank <= 6")
def status_counts(spark, sf):
    return R.value_counts(_summary(spark, sf), ["download_status", "extraction_status", "language"], 6)


@query("""with p as (select 'country' as dimension, n_name as value from customer join nation on c_nationkey = n_nationkey union all select 'segment', c_mktsegment from customer)
select dimension, value, count(*) as n, cast(row_number() over (partition by dimension order by count(*) desc, value) as int) as rank from p group by 1, 2 qualify rank <= 8""")
def archive_profile(spark, sf):
    c = _t(spark, sf, "customer").join(_t(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("country"), F.col("c_mktsegment").alias("segment"))
    return R.value_counts(c, ["country", "segment"], 8)


@query("select doc_id from documents where doc_id not in (select doc_id from labels where doc_id is not null)")
def not_yet_done(spark, sf):
    return R.not_done(_t(spark, sf, "documents").select("doc_id"), _t(spark, sf, "labels"), ["doc_id"])


@query("select min(doc_id) as doc_id, source from documents group by text, source")
def first_wins_dedup(spark, sf):
    return R.first_wins(_t(spark, sf, "documents").withColumn("__text", F.sha2("text", 256)), ["__text", "source"], "doc_id").select("doc_id", "source")


@query(f"with d as ({Z.plain(Z.DOWNLOADS)}) select url, download_status as status, ordinal from d where not (download_status like 'success%' or download_status = 'skipped') qualify row_number() over (partition by url order by ordinal) = 1")
def retry_worklist(spark, sf):
    return I.to_retry(Z.table(spark, sf, Z.DOWNLOADS).withColumnRenamed("download_status", "status")).select("url", "status", "ordinal")


_CASE = " when ".join(f"{' or '.join(f'contains(b, {_quoted([m])})' for m in marks)} then '{name}'" for name, marks in L.CHALLENGES)


@query(f"""with a as (select *, lower(coalesce(body_sample, '')) as b from ({Z.plain(Z.ATTEMPTS)})), w as (select *, case when {_CASE} when contains(lower(coalesce(server, '')), 'cloudflare') then 'cloudflare_challenge' end as wall from a),
s as (select stem, attempt_no, case when error_class is not null then error_class when http_status in ({', '.join(map(str, L.RETRY_STATUS))}) and wall is not null then wall when http_status = 200 then case when strategy = 'plain' then 'success' else 'success:' || strategy end else 'http_' || http_status end as status from w),
r as (select *, case when status like 'success%' then 0 when status like '%\\_challenge' escape '\\' or status = 'akamai_denied' then 1 else 2 end as k, count(*) over (partition by stem) as attempts from s)
select stem, status, attempts from r qualify row_number() over (partition by stem order by k, case when k < 2 then attempt_no else -attempt_no end) = 1""")
def attempt_outcomes(spark, sf):
    return I.outcome(Z.table(spark, sf, Z.ATTEMPTS))


_SIMS = "a as (select vec_id as topic, embedding as e from embeddings where vec_id < 10), s as (select e.label as stem, e.vec_id as sentence_idx, a.topic, list_dot_product(cast(e.embedding as double[]), cast(a.e as double[])) as sim from embeddings e, a)"


def _vectors(spark, sf):
    v = _t(spark, sf, "embeddings")
    anchors = v.where("vec_id < 10").select(F.col("vec_id").alias("topic"), F.col("embedding").alias("anchor_embedding"))
    return S.similarities(v.select(F.col("label").alias("stem"), F.col("vec_id").alias("sentence_idx"), "embedding"), anchors)


_TOPICS = f"{_SIMS}, k as (select *, row_number() over (partition by stem, topic order by sim desc, sentence_idx) as r from s), t as (select stem, topic, round(avg(sim), 4) as score from k where r <= 15 group by 1, 2)"


@query(f"with {_TOPICS} select * from t")
def topic_scores(spark, sf):
    v = _t(spark, sf, "embeddings")
    anchors = v.where("vec_id < 10").select(F.col("vec_id").alias("topic"), F.col("embedding").alias("anchor_embedding"))
    top = S.top_similarities(v.select(F.col("label").alias("stem"), F.col("vec_id").alias("sentence_idx"), "embedding"), anchors, "stem", "topic")
    return top.groupBy("stem", "topic").agg(F.round(F.avg("sim"), 4).alias("score"))


@query(f"with {_TOPICS}, p as (select stem, {', '.join(f'round(coalesce(avg(score) filter ({w}), 0.0), 4) as {p}' for p, w in (('environment', 'topic < 5'), ('social', 'topic between 5 and 8'), ('governance', 'topic = 9')))} from t group by 1) select *, case when environment = 0 and social = 0 and governance = 0 then 'unknown' when environment >= social and environment >= governance then 'environment' when social >= governance then 'social' else 'governance' end as dominant from p")
def topic_pillars(spark, sf):
    topics = S.topic_scores(_vectors(spark, sf), "stem", "topic")
    return S.pillar_scores(topics, "stem", F.when(F.col("topic") < 5, "environment").when(F.col("topic") < 9, "social").otherwise("governance"))


_HITSQL = f"""z as ({Z.plain(Z.SIMS)}), r as (select *, row_number() over (partition by stem, dr_code order by sim desc, sentence_idx) as rank from z), hits as (select * from r where rank <= 4 and sim >= 0.45),
ban as (select stem, dr_code, sentence_idx from (select *, row_number() over (partition by stem, sentence_idx order by sim desc, dr_code desc) as n from hits where rank = 1) where n > 3), kept as (select h.* from hits h anti join ban b on h.stem = b.stem and h.dr_code = b.dr_code and h.sentence_idx = b.sentence_idx)"""


@query(f"with {_HITSQL} select stem, dr_code, sentence_idx, sim, cast(rank as int) as rank from kept")
def shortlist_ban(spark, sf):
    return D.without_overused(D.shortlist(Z.table(spark, sf, Z.SIMS)))


_BEST = f"{_HITSQL}, q as (select *, row_number() over (partition by stem, dr_code order by rank) as place from kept), n as ({Z.plain(Z.ENTAILMENT)}), best as (select q.stem, q.dr_code, n.score as entail, q.sentence_idx from q join n on q.stem = n.stem and q.dr_code = n.dr_code and q.sentence_idx = n.sentence_idx where place <= 2 and n.score > 0 qualify row_number() over (partition by q.stem, q.dr_code order by n.score desc, q.place) = 1)"


@query(f"with {_BEST} select * from best")
def best_entailment(spark, sf):
    hits = D.without_overused(D.shortlist(Z.table(spark, sf, Z.SIMS)))
    return D.best_entailment(D.queue(hits), Z.table(spark, sf, Z.ENTAILMENT))


@query(f"with {_BEST}, t as (select stem, dr_code, max(sim) as top_sim from kept group by 1, 2), m as (select stem, substr(dr_code, 1, 2) as standard, count(*) >= 2 as material from best where entail >= 0.55 group by 1, 2) select t.stem, t.dr_code, round(least(1.0, 0.45 * top_sim / 0.6 + 0.55 * coalesce(entail, 0.0)), 3) as confidence, case when coalesce(entail, 0.0) >= 0.55 then 'reported' when not coalesce(material, false) then 'not_material_omitted' else 'material_not_reported' end as status from t left join best b on t.stem = b.stem and t.dr_code = b.dr_code left join m on m.stem = t.stem and m.standard = substr(t.dr_code, 1, 2)")
def disclosure_status(spark, sf):
    hits = D.without_overused(D.shortlist(Z.table(spark, sf, Z.SIMS)))
    best = D.best_entailment(D.queue(hits), Z.table(spark, sf, Z.ENTAILMENT))
    codes = hits.select(F.substring("dr_code", 1, 2).alias("standard"), "dr_code").distinct()
    rows = hits.groupBy("stem", "dr_code").agg(F.max("sim").alias("top_sim")).join(best, D.HIT, "left").withColumn("standard", F.substring("dr_code", 1, 2)).join(D.material_standards(best, codes), ["stem", "standard"], "left")
    entail = F.coalesce("entail", F.lit(0.0))
    return rows.select("stem", "dr_code", D.confidence(F.col("top_sim"), entail).alias("confidence"), D.status(entail, F.lit(None).cast("string"), F.lit(True), F.coalesce("material", F.lit(False)), F.lit(False)).alias("status"))


_LABELLED = "d as (select source as stem, case when quality = 1 then case when toxic = 1 then 'Social' else 'Environmental' end else case when toxic = 1 then 'Governance' else 'None' end end as label, case when quality = 1 then 'yes' else 'no' end as climate, case when toxic = 1 then 'commitment' else 'none' end as pledge from documents join labels using (doc_id))"


def _labelled(spark, sf):
    d = _t(spark, sf, "documents").join(_t(spark, sf, "labels"), "doc_id")
    good, bad = F.col("quality") == 1, F.col("toxic") == 1
    label = F.when(good & bad, "Social").when(good, "Environmental").when(bad, "Governance").otherwise("None")
    return d.select(F.col("source").alias("stem"), label.alias("label"), F.when(good, "yes").otherwise("no").alias("climate"), F.when(bad, "commitment").otherwise("none").alias("pledge"))


@query(f"with {_LABELLED} select stem, count(*) as n_sentences, round(count(*) filter (label = 'Environmental') / count(*), 4) as environment_share, round(count(*) filter (label = 'Social') / count(*), 4) as social_share, round(count(*) filter (label = 'Governance') / count(*), 4) as governance_share, round(count(*) filter (label = 'None') / count(*), 4) as none_share from d group by 1")
def label_shares(spark, sf):
    return S.label_shares(_labelled(spark, sf), "stem", F.col("label"))


@query(f"with {_LABELLED}, c as (select stem, count(*) as n, count(*) filter (climate = 'yes') as climate_sentences, count(*) filter (climate = 'yes' and pledge = 'commitment') as climate_commitments from d group by 1), r as (select stem, climate_sentences, climate_commitments, round(climate_sentences / n, 4) as climate_share, case when climate_sentences > 0 then round(climate_commitments / climate_sentences, 4) else 0.0 end as commitment_rate from c) select *, round(climate_share * (1 - commitment_rate), 4) as greenwashing_index from r")
def climate_signals(spark, sf):
    return S.climate_signals(_labelled(spark, sf), "stem", F.col("climate"), F.col("pledge"))


@query(f"""with m as (select conv_id as stem, turn + 1 as page, regexp_replace(text, '\\s+', ' ', 'g') as t, turn from conversations), p as (select stem, page, turn, string_split(regexp_replace(t, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)) as ss from m), u as (select stem, page, turn, unnest(ss) as s, generate_subscripts(ss, 1) as i from p), k as (select stem, page, turn, i, substr(trim(s), 1, 800) as sentence from u where length(trim(s)) >= 40)
select stem, cast(row_number() over (partition by stem order by page, turn, i) - 1 as int) as sentence_idx, cast(page as int) as page, sentence from k""")
def page_sentences(spark, sf):
    marked = F.concat(F.lit("[[page:"), (F.col("turn") + 1).cast("string"), F.lit("]]\n"), "text")
    c = _t(spark, sf, "conversations").where("text is not null").groupBy(F.col("conv_id").alias("stem")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", marked.alias("t")))), lambda x: x["t"]), "\n\n").alias("text"))
    return D.page_sentences(c)


@query("""with recursive p as (select conv_id, text, row_number() over (partition by conv_id order by turn, text) as i from conversations where text is not null), r as (
select conv_id, i, 0 as chunk, text as now from p where i = 1 union all
select p.conv_id, p.i, case when length(r.now) > 0 and length(r.now) + length(p.text) > 900 then r.chunk + 1 else r.chunk end, case when length(r.now) > 0 and length(r.now) + length(p.text) > 900 then p.text when length(r.now) = 0 then p.text else r.now || chr(10) || chr(10) || p.text end from r join p on p.conv_id = r.conv_id and p.i = r.i + 1)
select conv_id, cast(chunk as int) as chunk, cast(max(length(now)) as int) as n_chars from r group by 1, 2 having max(length(now)) > 0""")
def chunk_packing(spark, sf):
    return R.packed_parts(_t(spark, sf, "conversations").where("text is not null"), "conv_id", "turn", "text", 900).select("conv_id", "chunk", F.length("text").alias("n_chars"))


_DISC = f"d as ({Z.plain(Z.DISCLOSURES)})"


def _disclosures(spark, sf):
    return Z.table(spark, sf, Z.DISCLOSURES).withColumn("quality_flags", F.array("flag"))


@query(f"with {_DISC} select stem, dr_code, status, confidence, chunk_no, pos from d qualify row_number() over (partition by stem, dr_code order by coalesce(confidence, 0) desc, chunk_no, pos) = 1")
def merge_best_confidence(spark, sf):
    return M.best_disclosures(_disclosures(spark, sf)).select("stem", "dr_code", "status", "confidence", "chunk_no", "pos")


_MAND = f"count(distinct case when status = 'reported' and dr_code in ({_quoted(L.MANDATORY)}) then dr_code end)"


@query(f"with {_DISC} select stem, count(*) as n_disclosures, {', '.join(f'''count(*) filter (status = '{s}') as n_{s}''' for s in L.STATUSES)}, {_MAND} as esrs2_reported, cast(12 as bigint) as esrs2_total, {_MAND} = 12 as esrs2_complete, {', '.join(f'''count(*) filter (status = 'reported' and starts_with(coalesce(standard, dr_code), '{s}')) as {s.lower()}_reported''' for s in L.STANDARDS)}, cast(sum(n_datapoints) as bigint) as n_datapoints, count(*) as n_quality_flags, array_to_string(list_sort(list_distinct(list(flag))), '|') as quality_flags, round(avg(confidence), 3) as avg_confidence from d group by 1")
def flatten_coverage(spark, sf):
    return M.flatten(_disclosures(spark, sf))


@query(f"with {_DISC} select stem, count(distinct case when status = 'reported' then dr_code end) as material_drs_reported, count(*) filter (status = 'material_not_reported') as material_drs_missing, coalesce(array_to_string(list_sort(list_distinct(list(dr_code) filter (status = 'phase_in_deferred'))), '|'), '') as phase_ins_invoked, {_MAND} = 12 as esrs2_complete from d group by 1")
def coverage_summary(spark, sf):
    return M.coverage_summary(_disclosures(spark, sf))


@query("select event_id, cast(json_extract(props, '$.k') as bigint) as k from events where props is not null")
def json_repair(spark, sf):
    return Z.table(spark, sf, Z.DAMAGED).select("event_id", F.get_json_object(X.repaired_json(F.col("raw")), "$.k").cast("long").alias("k"))


_NUMBER = "'(?i)emissions were (\\d+),(\\d+) '"


@query(f"with rep as ({_REPORTS}) select doc_id, cast(regexp_extract(text, {_NUMBER}, 1) || regexp_extract(text, {_NUMBER}, 2) as double) as value, 'tCO2e' as unit, true as plausible, try_cast(nullif(regexp_extract(text, '(?i)baseline[^.]{{0,40}}?((?:19|20)\\d\\d)', 1), '') as int) as baseline_year, try_cast(nullif(regexp_extract(text, '(?i)(?:target|by)[^.]{{0,40}}?((?:19|20)\\d\\d)', 1), '') as int) as target_year from rep")
def parse_values(spark, sf):
    df = _reports(spark, sf).withColumn("span", F.regexp_extract("text", r"emissions were ([\d,]+ tCO2e)", 1))
    df = df.withColumn("v", X.value_and_unit(F.col("span")))
    return df.select("doc_id", "v.value", "v.unit", X.plausible(F.col("v.value"), F.col("v.unit"), F.col("span")).alias("plausible"), X.year_after(F.col("text"), "baseline").alias("baseline_year"), X.year_after(F.col("text"), "target|by").alias("target_year"))


@query(f"with rep as ({_REPORTS}), s as (select doc_id, trim({_SENTENCES}) as sentence from rep) select count(*) as sentences, count(*) filter (sentence like 'E1-6 Gross%') as index_rows from s where length(sentence) >= 30")
def index_rows(spark, sf):
    s = _reports(spark, sf).select(F.explode(X.sentences(F.col("text"), 30)).alias("s"))
    return s.agg(F.count("*").alias("sentences"), F.count_if(X.is_index_row(F.col("s"))).alias("index_rows"))


@query(f"with s as (select doc_id, list_filter(list_transform(string_split(regexp_replace(trim(regexp_replace(text, '\\s+', ' ', 'g')), '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda x: substr(trim(x), 1, 800)), lambda x: length(x) >= 30) as l from documents), i as (select doc_id, l, unnest(range(least(len(l), 10))) as i from s) select doc_id, cast(i as int) as pos, case when len(l) > 10 then l[cast(floor(i * len(l) / 10.0) as bigint) + 1] else l[i + 1] end as sentence from i")
def even_subsample(spark, sf):
    return _documents(spark, sf).select("doc_id", F.posexplode(X.plain_sentences(F.col("text"), cap=10)).alias("pos", "sentence"))


@query("select l_orderkey, greatest(1, least(case when l_linenumber % 3 = 0 then 1 else l_linenumber * 5 end, 20)) as page_start, greatest(greatest(1, least(case when l_linenumber % 3 = 0 then 1 else l_linenumber * 5 end, 20)), least(case when l_quantity < 10 then 20 else cast(floor(l_quantity) as int) end, 20)) as page_end, l_linenumber from lineitem")
def page_ranges(spark, sf):
    n = F.col("l_linenumber")
    r = X.page_range(F.when(n % 3 == 0, 0).otherwise(n * 5), F.when(F.col("l_quantity") < 10, None).otherwise(F.floor("l_quantity").cast("int")), F.lit(20))
    return _t(spark, sf, "lineitem").select("l_orderkey", r["start"].alias("page_start"), r["end"].alias("page_end"), "l_linenumber")


@query("with c as (select o_custkey, count(*) as n, sum(o_totalprice) as total from orders group by 1), r as (select *, rank() over (order by n) + (count(*) over (partition by n) - 1) / 2.0 as rk from c) select count(*) as n, round(corr(n, total), 6) as r, round(quantile_cont(total, 0.05), 4) as p5, round(median(total), 4) as median, round(sum(rk) filter (o_custkey % 2 = 0), 2) as rank_sum from r")
def validation_statistics(spark, sf):
    c = _t(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("total"))
    stats = R.ranked(c, "n").agg(F.count("*").alias("n"), F.round(F.corr("n", "total"), 6).alias("r"), F.round(F.sum(F.when(F.col("o_custkey") % 2 == 0, F.col("rank"))), 2).cast("double").alias("rank_sum"))
    found = R.quantiles(c, "total", {"p5": 0.05, "median": 0.5}).select(F.round("p5", 4).alias("p5"), F.round("median", 4).alias("median"))
    return stats.join(found)


@query("select user_id, event_type, event_id from events qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1")
def latest_status(spark, sf):
    return R.latest(_t(spark, sf, "events"), ["user_id", "event_type"], F.desc("ts"), F.desc("event_id")).select("user_id", "event_type", "event_id")


@query("select l_orderkey, count(*) >= 2 and count(*) * 2 >= 4 as useful from lineitem group by 1")
def useful_tables(spark, sf):
    rows = _t(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.array(F.col("l_linenumber").cast("string"), F.lit("quantity"))).alias("rows"))
    return rows.select("l_orderkey", X.useful_table(F.col("rows")).alias("useful"))
