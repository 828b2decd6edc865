"""Queries of disclosure extraction: composites over recorded models, merged results, averages and tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import lexicon as L
from ..operators import disclosure as D, merge as M, ports, relational as R, semantic as S
from ..sources import files, scratch
from . import fixtures as Z
from .queries import _BEST, _DISC, _LABELLED, _MAND, _TOPICS, _disclosures, _labelled, _reports, _t, _vectors, query

TAXONOMY = """
### ESRS 2 — General
- `BP-1` — Basis for the preparation of the results of a period
- `GOV-1` — Role of the board and its directors
### ESRS E1 — Climate
- `E1-1` — Plan for solar and wind power
- `E1-4` — Targets of a reduction of carbon by a year
- `E1-5` — Energy use and the baseline year
- `E1-6` — Gross Scope 1 emissions were measured in tCO2e
### ESRS S1 — Workforce
- `S1-13` — Training reached employees and workers with education
- `S1-14` — Health and safety of workers
### ESRS G1 — Conduct
- `G1-1` — The board approved the policy on ethics, compliance and anti-corruption
"""


def taxonomy(spark: SparkSession) -> DataFrame:
    return files.taxonomy_of(spark, TAXONOMY)


@query()
def neural_extraction(spark, sf):
    """From report texts to nested results by stand-in models, one row per report; n_chars of its JSON."""
    reports = _reports(spark, sf).select(F.col("doc_id").cast("string").alias("stem"), F.concat(F.lit("[[page:7]]\n"), "text").alias("text"))
    got = D.neural(reports, taxonomy(spark), ports.embed(ports.hashed_embedder(256)), ports.entailment(ports.overlap_entailment), ports.answer(ports.number_answerer))
    return M.flat_results(got)


_CODES, _SENT = f"codes as ({Z.plain(Z.CODES)})", f"sent as ({Z.plain(Z.SENTENCES)})"


_LADDER = f"""{_BEST}, {_CODES}, {_SENT}, reports as (select distinct stem from sent), t as (select stem, dr_code, sim as top_sim, sentence_idx as top_idx from kept qualify row_number() over (partition by stem, dr_code order by rank) = 1),
m as (select best.stem, codes.standard, count(*) >= 2 as material from best join codes using (dr_code) where entail >= 0.55 and standard <> 'ESRS2' group by 1, 2),
rr as (select reports.stem, codes.*, top_sim, coalesce(entail, 0.0) as entail, coalesce(material, false) as material, coalesce(best.sentence_idx, top_idx) as sentence_idx from reports cross join codes left join t on t.stem = reports.stem and t.dr_code = codes.dr_code left join best on best.stem = reports.stem and best.dr_code = codes.dr_code left join m on m.stem = reports.stem and m.standard = codes.standard),
qq as (select rr.*, page, sentence as quote from rr left join sent s on s.stem = rr.stem and s.sentence_idx = rr.sentence_idx),
st as (select *, case when entail >= 0.55 then 'reported' when quote like '%phase-in%' then 'phase_in_deferred' when top_sim is null then 'not_addressed' when not material and standard <> 'ESRS2' then 'not_material_omitted' else 'material_not_reported' end as status from qq)"""


@query(f"""with {_LADDER}
select stem, dr_code, standard, status, round(least(1.0, 0.45 * coalesce(top_sim, 0.0) / 0.6 + 0.55 * entail), 3) as confidence, page, quote,
concat_ws('|', case when status = 'reported' and dr_code = 'E1-6' and not contains(lower(quote), 'scope 3') then 'scope_3_not_in_evidence' end, case when status = 'reported' and contains(lower(dr_title), 'target') and not contains(quote, 'baseline of 2019') then 'target_without_baseline' end) as flags from st""")
def status_ladder(spark, sf):
    """Every status, evidence and flag, over tables of similarities and entailments."""
    sentences = Z.table(spark, sf, Z.SENTENCES)
    codes = Z.table(spark, sf, Z.CODES)
    rows = D.disclosures(sentences.select("stem").distinct(), codes, sentences, Z.table(spark, sf, Z.SIMS), Z.table(spark, sf, Z.ENTAILMENT))
    return rows.select("stem", "dr_code", "standard", "status", "confidence", "page", "quote", F.array_join("quality_flags", "|").alias("flags"))


@query(f"with {_CODES} select dr_code, dr_code in ({', '.join(repr(c) for c in L.QUESTIONS)}) or regexp_matches(lower(dr_title), '{'|'.join(L.QUANTITY_WORDS)}') as quantitative, contains(lower(dr_title), 'target') as target, case dr_code {' '.join(f'''when '{k}' then '{v}' ''' for k, v in L.QUESTIONS.items())} else 'What is the reported ' || dr_title || '?' end as question from codes")
def code_questions(spark, sf):
    q = D.questions(Z.table(spark, sf, Z.CODES))
    return q.select("dr_code", D.is_quantitative(F.col("dr_code"), F.col("dr_title")).alias("quantitative"), D.is_target(F.col("dr_title")).alias("target"), "question")


# Recorded answers: a part's text holds the answer of a model to it. Chunk 0 of a report has no material topics.
PARTS = """
select concat('r', cast(l_orderkey as string)) as stem, cast(l_linenumber as int) as page,
  case when l_orderkey % 11 = 3 and l_linenumber = 2 then 'ANSWER sorry' else concat('ANSWER ', case when l_linenumber % 2 = 0 then 'Here it is: ' else '' end, '{{"document_meta":{{"assurance":"a', cast(l_linenumber as string), '"}},"materiality_assessment":{{"material_topics":[', case when l_linenumber >= 2 then concat('"E', cast(l_linenumber as string), '"') else '' end, ']}},"disclosures":[{{"standard":"E1","dr_code":"E1-', cast(l_partkey % 3 as string), '","status":"', case when l_returnflag = 'A' then 'reported' when l_returnflag = 'N' then 'material_not_reported' else 'phase_in_deferred' end, '","confidence":0.', cast(l_suppkey % 9 as string), ',"datapoints":[{{"name":"x","value":1}}],"quality_flags":["f', cast(l_linenumber as string), '"]}},{{"dr_code":null,"status":"not_addressed"}}],"coverage_summary":{{"esrs2_complete":true}}}}', case when l_linenumber % 3 = 0 then ' as asked' else '' end) end as text
from {lineitem}
"""

_PARTS = """p as (select 'r' || l_orderkey as stem, l_linenumber as c, 'E1-' || l_partkey % 3 as dr_code, case l_returnflag when 'A' then 'reported' when 'N' then 'material_not_reported' else 'phase_in_deferred' end as status, (l_suppkey % 9) / 10.0 as confidence, l_orderkey from lineitem),
f as (select distinct stem from p where l_orderkey % 11 = 3 and c = 2), g as (select * from p where stem not in (select stem from f)), n as (select stem, count(*) as n, min(c) as c0, min(case when c >= 2 then c end) as c2 from g group by stem),
b as (select * from g qualify row_number() over (partition by stem, dr_code order by confidence desc, c, status) = 1)"""


@query(f"""with {_PARTS} select b.stem, count(*) + any_value(n) as n_disclosures, count(*) filter (status = 'reported') as n_reported, count(*) filter (status = 'material_not_reported') as n_material_not_reported, any_value(n) as n_not_addressed, count(*) as n_datapoints, array_to_string(list_sort(list_distinct(list('f' || b.c))), '|') as quality_flags, round(avg(confidence), 3) as avg_confidence, any_value(n) = 1 as esrs2_complete,
'a' || any_value(coalesce(c2, c0)) as assurance, any_value(coalesce('E' || c2, '')) as material_topics from b join n using (stem) group by b.stem""")
def llm_extraction(spark, sf):
    """Parts packed into chunks, a recorded model asked about each, answers repaired, parsed and merged, and flattened.

    Reports with an answer that can't be read are put aside.
    """
    parts = Z.table(spark, sf, PARTS)

    def model():
        return lambda text: text.split("ANSWER ", 1)[1]

    got, _ = ports.extract(parts, model, most=10, wait=0.0)
    return M.flat_results(got).select("stem", "n_disclosures", "n_reported", "n_material_not_reported", "n_not_addressed", "n_datapoints", "quality_flags", "avg_confidence", "esrs2_complete", "assurance", "material_topics")


@query(f"with {_PARTS} select stem from f")
def llm_failures(spark, sf):
    """The reports that llm_extraction puts aside."""
    return ports.extract(Z.table(spark, sf, PARTS), lambda: lambda text: text.split("ANSWER ", 1)[1], most=10, wait=0.0)[1].select("stem")


@query(f"with {_DISC}, c as (select stem, {', '.join(f'''count(*) filter (status = '{s}') as n_{s}''' for s in L.STATUSES)}, {_MAND} = 12 as complete from d group by 1) select {', '.join(f'round(avg(n_{s}), 6) as avg_{s}' for s in L.STATUSES)}, count(*) filter (complete) as complete from c")
def coverage_averages(spark, sf):
    """Coverage rows appended by a run, and their averages."""
    path = scratch.folder(spark, "coverage")
    failures = spark.createDataFrame([("x", "sorry")], "stem string, error string")
    return M.write_outputs(M.flatten(_disclosures(spark, sf)), failures, f"{path}/out", f"{path}/failed", "r1")


def _pillars(spark, sf):
    topics = S.topic_scores(_vectors(spark, sf), "stem", "topic")
    lookup = spark.sql("select cast(id as bigint) as topic, case when id < 5 then 'environment' when id < 9 then 'social' else 'governance' end as pillar from range(10)")
    by = S.topic_pillars(topics, lookup, "topic")
    return S.pillar_scores(by, "stem", F.col("pillar"))


_SEM = f"{_TOPICS}, p as (select 'src' || stem as stem, {', '.join(f'round(coalesce(avg(score) filter ({w}), 0.0), 4) as {p}' for p, w in (('environment', 'topic < 5'), ('social', 'topic between 5 and 8'), ('governance', 'topic = 9')))} from t group by 1)"
_CLIMATE = f"{_LABELLED}, c as (select stem, count(*) as n, count(*) filter (climate = 'yes') as k, count(*) filter (climate = 'yes' and pledge = 'commitment') as kc from d group by 1), g as (select stem, n, round(round(k / n, 4) * (1 - case when k > 0 then round(kc / k, 4) else 0.0 end), 4) as greenwashing_index, round(k / n, 4) as climate_share from c)"


def _semantic(spark, sf):
    pillars = _pillars(spark, sf).withColumn("stem", F.concat(F.lit("src"), F.col("stem").cast("string")))
    labelled = _labelled(spark, sf)
    return S.report_scores(pillars, "stem", S.label_shares(labelled, "stem", F.col("label")), S.climate_signals(labelled, "stem", F.col("climate"), F.col("pledge")))


@query(f"with {_SEM}, {_CLIMATE} select p.stem, environment as sem_environment, social as sem_social, governance as sem_governance, n as n_sentences, climate_share, greenwashing_index from p left join g on g.stem = p.stem")
def semantic_report(spark, sf):
    """Pillar scores by a topic lookup, label shares and climate signals of each report in one row."""
    return _semantic(spark, sf).select("stem", "sem_environment", "sem_social", "sem_governance", "n_sentences", "climate_share", "greenwashing_index")


@query(f"with {_SEM}, {_CLIMATE} select round(avg(environment), 6) as avg_sem_environment, round(avg(social), 6) as avg_sem_social, round(avg(governance), 6) as avg_sem_governance, round(avg(greenwashing_index), 6) as avg_greenwashing_index from p left join g on g.stem = p.stem")
def semantic_averages(spark, sf):
    return S.score_averages(_semantic(spark, sf))


@query("""with c as (select o_custkey, count(*) as v from orders group by 1), r as (select v, o_custkey % 2 = 0 as f, rank() over (order by v) + (count(*) over (partition by v) - 1) / 2.0 as rk from c), t as (select sum(cast(t as double) * t * t - t) as ties from (select count(*) as t from c group by v)),
s as (select count(*) filter (f) as n_true, count(*) filter (not f) as n_false, avg(v) filter (f) as mt, avg(v) filter (not f) as mf, sum(rk) filter (f) as rs from r), u as (select *, cast(n_true as double) as a, cast(n_false as double) as b, rs - n_true * (n_true + 1) / 2.0 as u from s),
z as (select *, greatest(abs(u - a * b / 2) - 0.5, 0.0) / sqrt(a * b / 12 * (a + b + 1 - ties / ((a + b) * (a + b - 1)))) / sqrt(2.0) as x from u, t), k as (select *, 1 / (1 + 0.3275911 * x) as t1 from z)
select n_true, n_false, round(mt, 6) as mean_true, round(mf, 6) as mean_false, round(u, 2) as u, round(least(1.0, t1 * (0.254829592 + t1 * (-0.284496736 + t1 * (1.421413741 + t1 * (-1.453152027 + t1 * 1.061405429)))) * exp(-x * x)), 6) as p from k""")
def flag_comparison(spark, sf):
    """Means by a flag and the rank-sum test of their difference."""
    c = _t(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("v"))
    t = R.rank_sum_test(c, "v", F.col("o_custkey") % 2 == 0)
    return t.select("n_true", "n_false", F.round("mean_true", 6).alias("mean_true"), F.round("mean_false", 6).alias("mean_false"), F.round("u", 2).alias("u"), F.round("p", 6).alias("p"))
