"""Queries of disclosures over recorded models, and of steps that bite: limits, retries, sources that are discarded."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import lexicon as L, text as X, url as U
from ..operators import disclosure as D, merge as M, ports, selection as E
from ..sources import scratch
from ..streaming import incremental
from . import fixtures as Z
from .extraction import _LADDER
from .queries import SQL, _raw, _t, query

# What an answering model found for a report and code: a number with a unit, a year, a small number, nothing, too unsure.
RECORDED = """
select concat('r', cast(n as string)) as stem, concat('E', cast(i as string), '-', cast(l as string)) as dr_code,
  case when (n + i + l) % 5 = 0 then '42 tonnes' when (n + i + l) % 5 = 1 then 'in 2019' when (n + i + l) % 5 = 2 then '7' when (n + i + l) % 5 = 3 then cast(null as string) else '12,5 %' end as span, cast((n + 3 * l) % 10 as double) / 10 as score
from (select distinct l_suppkey % 40 as n, l_partkey % 5 + 1 as i, l_linenumber as l from {lineitem}) a
"""
_QUANTITY = f"st.dr_code in ({', '.join(repr(c) for c in L.QUESTIONS)}) or regexp_matches(lower(st.dr_title), '{'|'.join(L.QUANTITY_WORDS)}')"
_ANSWERED = f"""{_LADDER}, answers as ({Z.plain(RECORDED)}),
aa as (select st.*, span, score, status = 'reported' and ({_QUANTITY}) as asked, coalesce(span in ('42 tonnes', '12,5 %'), false) as good from st left join answers on answers.stem = st.stem and answers.dr_code = st.dr_code),
ff as (select *, round(least(1.0, 0.45 * coalesce(top_sim, 0.0) / 0.6 + 0.55 * entail), 3) as confidence, asked and good and score >= 0.35 as taken from aa),
flagged as (select *, list_filter([case when asked and span is not null and not good then 'value_rejected_implausible' end, case when asked and span is not null and not coalesce(taken, false) then 'value_not_parsed' end,
case when status = 'reported' and dr_code = 'E1-6' and not contains(lower(quote), 'scope 3') then 'scope_3_not_in_evidence' end, case when status = 'reported' and contains(lower(dr_title), 'target') and not contains(quote, 'baseline of 2019') then 'target_without_baseline' end], lambda x: x is not null) as flags from ff)"""


def _rows(spark, sf):
    sentences, codes = Z.table(spark, sf, Z.SENTENCES), Z.table(spark, sf, Z.CODES)
    return D.disclosures(sentences.select("stem").distinct(), codes, sentences, Z.table(spark, sf, Z.SIMS), Z.table(spark, sf, Z.ENTAILMENT), Z.table(spark, sf, RECORDED))


@query(f"""with {_ANSWERED} select stem, dr_code, status, array_to_string(flags, '|') as flags, case when coalesce(taken, false) then cast(case when span = '42 tonnes' then 42.0 else 12.5 end as double) end as value, case when coalesce(taken, false) then case when span = '42 tonnes' then 'tonnes' else '%' end end as unit, case when coalesce(taken, false) then score end as qa from flagged""")
def answer_flags(spark, sf):
    """Datapoints and flags by recorded answers: plausible, implausible, unsure ones, and none."""
    p = F.col("datapoint")
    return _rows(spark, sf).select("stem", "dr_code", "status", F.array_join("quality_flags", "|").alias("flags"), p["value"].alias("value"), p["unit"].alias("unit"), p["qa_confidence"].alias("qa"))


_TOPICAL = "standard <> 'ESRS2'"


@query(f"""with {_ANSWERED}, per as (select stem, count(*) as n_disclosures, {', '.join(f"count(*) filter (status = '{s}') as n_{s}" for s in L.STATUSES)}, count(*) filter (coalesce(taken, false)) as n_datapoints, cast(sum(len(flags)) as bigint) as n_quality_flags, round(avg(confidence), 3) as avg_confidence from flagged group by 1),
fl as (select stem, string_agg(distinct f, '|' order by f) as quality_flags from (select stem, unnest(flags) as f from flagged) group by 1), mt as (select stem, standard, count(*) filter (status = 'reported') >= 2 as material from flagged where {_TOPICAL} group by all),
top as (select stem, coalesce(string_agg(standard, '|' order by standard) filter (material), '') as material_topics, coalesce(string_agg(standard, '|' order by standard) filter (not material), '') as non_material_topics from mt group by 1), every as (select distinct stem from sent)
select concat(case when e = 1 then 'none-' else '' end, every.stem) as stem, case when e = 1 then 0 else n_disclosures end as n_disclosures, {', '.join(f"case when e = 1 then 0 else n_{s} end as n_{s}" for s in L.STATUSES)}, case when e = 1 then 0 else n_datapoints end as n_datapoints, case when e = 1 then 0 else n_quality_flags end as n_quality_flags, case when e = 1 then '' else coalesce(quality_flags, '') end as quality_flags, case when e = 0 then avg_confidence end as avg_confidence,
case when e = 1 then '' else material_topics end as material_topics, case when e = 1 then '' else non_material_topics end as non_material_topics, e = 0 and cast(substr(every.stem, 2) as int) % 2 = 0 as method_described, e = 0 and cast(substr(every.stem, 2) as int) % 3 = 0 as iro2_index_present, case when e = 0 then cast(substr(every.stem, 2) as bigint) % 4 end as index_rows
from every cross join (values (0), (1)) x(e) left join per on per.stem = every.stem left join fl on fl.stem = every.stem left join top on top.stem = every.stem""")
def recorded_results(spark, sf):
    """Nested results of reports over recorded similarities, entailments and answers, flattened; and as many reports without
    any sentence, whose sections are empty."""
    rows = _rows(spark, sf)
    codes = Z.table(spark, sf, Z.CODES).withColumn("line", F.crc32("dr_code"))
    k = F.expr("cast(substring(stem, 2, 9) as int)")
    stems = Z.table(spark, sf, Z.SENTENCES).select("stem").distinct()
    says = F.concat(F.lit("We report. "), F.when(k % 2 == 0, "A Double Materiality assessment was made. ").otherwise(""), F.when(k % 3 == 0, "See the content index.").otherwise(""))
    reports = stems.select("stem", says.alias("text")).unionByName(stems.select(F.concat(F.lit("none-"), "stem").alias("stem"), F.lit(None).cast("string").alias("text")))
    got = D.results(reports, codes, rows, stems.select("stem", (k % 4).alias("n")))
    flat = M.flat_results(got).join(got.select("stem", F.col("result.document_meta.index_rows_filtered").alias("index_rows")), "stem")
    return flat.select("stem", "n_disclosures", *[f"n_{s}" for s in L.STATUSES], "n_datapoints", "n_quality_flags", "quality_flags", "avg_confidence", "material_topics", "non_material_topics", F.col("materiality_method_described").alias("method_described"), "iro2_index_present", "index_rows")


@query(f"with {_LADDER} select kept.stem, dr_code, string_agg(sentence, ' ' order by rank) as context from kept join sent on sent.stem = kept.stem and sent.sentence_idx = kept.sentence_idx group by 1, 2")
def answer_contexts(spark, sf):
    """What an answering model is given for a report and code: its surviving sentences in order of rank."""
    hits = D.without_overused(D.shortlist(Z.table(spark, sf, Z.SIMS)))
    return D.contexts(hits, Z.table(spark, sf, Z.SENTENCES))


@query("""select page_id, list_slice(['https://cdn.example.com/r' || page_id || '-' || 0 || '.pdf', 'https://cdn.example.com/r' || page_id || '-' || 1 || '.pdf', 'https://cdn.example.com/r' || page_id || '-' || 2 || '.pdf', 'https://cdn.example.com/r' || page_id || '-' || 3 || '.pdf', 'https://cdn.example.com/r' || page_id || '-' || 4 || '.pdf'], 1, 4) as links from pages""")
def first_links(spark, sf):
    """Of more links on a page than are tried, the first four."""
    link = lambda i: F.concat(F.lit('<a href="https://cdn.example.com/r'), F.col("page_id").cast("string"), F.lit(f'-{i}.pdf">x</a>'))
    html = F.concat(F.lit("<html><body>"), *[link(i) for i in range(7)], F.lit("</body></html>"))
    return _t(spark, sf, "pages").select("page_id", U.report_links(html, F.col("url"), 4).alias("links"))


@query("select stem, raw, error from (select 'c' || c_custkey as stem, case when c_custkey % 4 = 3 then null when c_custkey % 4 = 2 and c_custkey % 3 = 2 then null else c_name end as raw, case when c_custkey % 4 = 3 then 'bad request' when c_custkey % 4 = 2 and c_custkey % 3 = 2 then 'error 529: Overloaded' end as error from customer)")
def retried_chunks(spark, sf):
    """A model that fails now and then: what passes is asked again up to four times, the rest is a failure at once."""

    def model():
        tried: dict[str, int] = {}

        def run(text: str) -> str:
            key, name = (int(x) if x.isdigit() else x for x in text.split(":", 1))
            tried[text] = tried.get(text, 0) + 1
            if key % 4 == 3:
                assert tried[text] == 1
                raise ValueError("bad request")
            if key % 4 == 2 and tried[text] <= (3 if key % 3 < 2 else 9):
                raise RuntimeError("error 529: Overloaded")
            return name

        return run

    chunks = _t(spark, sf, "customer").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("stem"), F.lit(0).alias("chunk_no"), F.concat(F.col("c_custkey").cast("string"), F.lit(":"), "c_name").alias("text"))
    return ports.ask(chunks, model, wait=0.0).select("stem", "raw", "error")


@query("select event_id, user_id, 0 as files_left from events")
def discarded_sources(spark, sf):
    """Files that are deleted once a stream has taken them in: the rows are all there, the files are gone."""
    base = scratch.folder(spark, "discard")
    events = _t(spark, sf, "events").select("event_id", "user_id")
    for lot in range(2):
        events.where(f"event_id % 2 = {lot}").coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = incremental.arriving(spark, f"{base}/in", events.schema, files=1, discard=True)
        incremental.run_once(stream, lambda b: b, ["event_id"], f"{base}/out", f"{base}/check")
    # A file is deleted with the commit after the one that read it, so one more of no rows is let in.
    events.where("event_id < 0").coalesce(1).write.mode("append").parquet(f"{base}/in")
    incremental.run_once(incremental.arriving(spark, f"{base}/in", events.schema, files=1, discard=True), lambda b: b, ["event_id"], f"{base}/out", f"{base}/check")
    left = spark.read.parquet(f"{base}/in").count()
    return spark.read.parquet(f"{base}/out").select("event_id", "user_id", F.lit(left).cast("int").alias("files_left"))


@query("select page_id, 'https://x.example.com/p/' || page_id || '.pdf' as target from pages")
def unwrapped_links(spark, sf):
    """The targets of links that lead through a redirect, some of them twice."""
    plain = F.concat(F.lit("https://x.example.com/p/"), F.col("page_id").cast("string"), F.lit(".pdf"))
    once = F.concat(F.lit("https://www.google.com/url?sa=t&url="), F.url_encode(plain))
    twice = F.concat(F.lit("https://www.google.com/url?url="), F.url_encode(once))
    return _t(spark, sf, "pages").select("page_id", U.unwrapped(U.unwrapped(F.when(F.col("page_id") % 3 == 0, plain).when(F.col("page_id") % 3 == 1, once).otherwise(twice))).alias("target"))


@query(f"select * from ({SQL['report_selection']}) order by ordinal limit 25")
def limited_jobs(spark, sf):
    """The first 25 reports still to do, counted after those that are done have gone."""
    done = _t(spark, sf, "orders").where("o_orderkey % 9 = 0").select(F.concat(F.lit("t"), F.col("o_orderkey").cast("string")).alias("stem"))
    jobs = E.jobs(Z.table(spark, sf, Z.SUMMARIES), Z.table(spark, sf, Z.TEXTS), done, limit=25)
    return jobs.select("ordinal", "stem", "text_path", "out_path", "meta.company", "meta.report_year", "meta.word_count")


_SAID = "case event_id % 8 when 0 then 'Rate Limit reached' when 1 then 'HTTP 529' when 2 then 'Request TIMEOUT' when 3 then 'error 500: internal' when 4 then 'bad request' when 5 then 'overloaded_error' when 6 then 'HTTP 404' else 'no key' end"


@query(f"select event_id, event_id % 8 in (0, 1, 2, 3, 5) as again from (select event_id, {_SAID} as m from events)")
def transient_errors(spark, sf):
    """Which failures of a server are worth asking again."""
    said = _t(spark, sf, "events").select("event_id", F.expr(_SAID).alias("m"))
    return said.select("event_id", X.transient_error(F.col("m")).alias("again"))


@query(f"select id, name, isin, country, year_text as year, link, s as page_start from ({Z.plain(Z.INDEX)})")
def payload_dump(spark, sf):
    """All reports as they came, written as JSON lines and read back by their schema, nulls and nested fields with them."""
    path = scratch.folder(spark, "dump")
    raw = _raw(spark, sf)
    raw.write.json(path)
    back = spark.read.schema(raw.schema).json(path)
    return back.select("id", "company.name", "company.isin", "company.country", "year", F.col("original_link").alias("link"), F.col("pdfpage_sust_start").alias("page_start"))
