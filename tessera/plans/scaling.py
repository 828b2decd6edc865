"""Queries of tables that batches are merged into, of streams with state, and of reports of any length."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from ..functions import url as U
from ..operators import chunking as C, language as G, merge as M, nearest as N, ports, relational as R, tables as B
from ..sources import files, scratch
from ..sources.upserts import UpsertTable
from ..streaming import incremental, stateful
from . import fixtures as Z
from .extraction import PARTS, _PARTS
from .queries import SQL, _t, _tasks, query

#: Rows of a lot that arrive in one file, and lots of reports for each partition of their state.
ARRIVING, LOTS = 250_000, 256


@query("""with d as (select * from (values ('first', 1), ('second', 2), ('third', 3)) b(batch, v)),
r as (select l_orderkey, l_linenumber, batch, v, case when v = 1 then l_quantity else l_quantity * 10 * v end as quantity, v = 3 and l_linenumber = 4 as gone from lineitem cross join d where v = 1 or (v = 2 and l_orderkey % 3 = 0) or (v = 3 and l_linenumber % 2 = 0))
select l_orderkey, l_linenumber, batch, quantity from r qualify row_number() over (partition by l_orderkey, l_linenumber order by v desc, quantity desc) = 1 and not gone""")
def upsert_batches(spark, sf):
    """Three overlapping batches merged by key, the last one with deletes; compacted in between; the second comes again."""
    table = UpsertTable(spark, scratch.folder(spark, "upserts"), ["l_orderkey", "l_linenumber"])
    lines = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("quantity"))
    named = lambda name, df: table.upsert(df.withColumn("batch", F.lit(name)), name, F.desc("quantity"), deleted=(F.col("batch") == "third") & (F.col("l_linenumber") == 4))
    second = lines.where("l_orderkey % 3 = 0").withColumn("quantity", F.col("quantity") * 20)
    named("first", lines)
    named("second", second)
    table.compact()
    table.vacuum()
    named("third", lines.where("l_linenumber % 2 = 0").withColumn("quantity", F.col("quantity") * 30))
    named("second", second)
    return table.read().select("l_orderkey", "l_linenumber", "batch", "quantity")


@query("""with recursive p as (select lower(regexp_extract(url, '://([^/?#:]+)', 1)) as host, page_id as request, (page_id + 1) * 400 as arrival, page_id % 7 * 900 as lasts from pages), o as (select *, row_number() over (partition by host order by arrival, request) as i from p),
s as (select host, request, i, arrival as start_ms, arrival + lasts as end_ms from o where i = 1 union all
select o.host, o.request, o.i, greatest(o.arrival, s.end_ms + 1500), greatest(o.arrival, s.end_ms + 1500) + o.lasts from s join o on o.host = s.host and o.i = s.i + 1)
select host, request, start_ms, end_ms from s""")
def host_gate(spark, sf):
    """Requests that arrive in lots, one in flight for each host and 1.5 seconds between them, with a restart after each lot."""
    base = scratch.folder(spark, "gate")
    pages = _t(spark, sf, "pages").select(U.host(F.col("url")).alias("host"), F.col("page_id").alias("request"), F.timestamp_millis((F.col("page_id") + 1) * 400).alias("at"), (F.col("page_id") % 7 * 0.9).alias("lasts"))
    last = pages.agg(F.max("request")).first()[0] or 0
    state, out = stateful.state_session(spark, 2), UpsertTable(spark, f"{base}/out", ["request"])
    # The last row, of no host of the table, moves time on until every request has had its turn.
    ends = spark.range(1).select(F.lit("#end").alias("host"), F.lit(-1).cast("long").alias("request"), F.timestamp_millis((F.col("id") + 1) * (last + 2) * 10_000).alias("at"), F.lit(0.0).alias("lasts"))
    lots = [pages.where(f"request <= {last // 2}"), pages.where(f"request > {last // 2}"), ends]
    for lot in lots:
        lot.coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = incremental.arriving(state, f"{base}/in", pages.schema, files=1)
        incremental.upsert(stateful.host_starts(stream, 1.5, "0 seconds"), out, f"{base}/check")
    return out.read().where("request >= 0").select("host", "request", F.col("start").alias("start_ms"), F.col("end").alias("end_ms"))


@query(SQL["llm_extraction"])
def gathered_extraction(spark, sf):
    """As llm_extraction, with answers that arrive in lots as a stream: each report lands when its last chunk has answered."""
    base = scratch.folder(spark, "gather")
    parts = Z.table(spark, sf, PARTS)
    chunks = R.packed_parts(parts, "stem", "page", "text", 10).withColumnRenamed("chunk", "chunk_no")
    tasks = _tasks(parts, ARRIVING)
    counted = chunks.withColumn("chunks", F.count("*").over(Window.partitionBy("stem")).cast("int"))
    counted.repartition(2 * tasks, "stem", "chunk_no").write.parquet(f"{base}/chunks")  # two lots of as many files as tasks
    state, out = stateful.state_session(spark, max(8, tasks)), UpsertTable(spark, f"{base}/out", ["stem"])
    arrived = incremental.arriving(state, f"{base}/chunks", "stem string, chunk_no int, text string, chunks int", files=tasks)
    answers = ports.ask(arrived, lambda: lambda text: text.split("ANSWER ", 1)[1], wait=0.0).withColumn("answered_at", F.current_timestamp())

    def land(batch, number):
        out.upsert(M.flat_results(ports.results(batch)[0]), f"lot-{number}")

    stateful.gathered(answers, 86_400, lots=LOTS * tasks).writeStream.foreachBatch(land).option("checkpointLocation", f"{base}/check").trigger(availableNow=True).start().awaitTermination()
    return out.read().select("stem", "n_disclosures", "n_reported", "n_material_not_reported", "n_not_addressed", "n_datapoints", "quality_flags", "avg_confidence", "esrs2_complete", "assurance", "material_topics")


@query(SQL["chunk_packing"])
def chunk_doubling(spark, sf):
    """As chunk_packing, with chunk starts found by pointer doubling."""
    c = _t(spark, sf, "conversations").where("text is not null")
    return C.packed_spread(c, "conv_id", "turn", "text", 900, lot=64).select("conv_id", "chunk", F.length("text").alias("n_chars"))


@query(f"""with b as (select conv_id as stem, turn, text, last_value(case when turn % 3 = 0 then turn + 1 end ignore nulls) over (partition by conv_id order by turn) as page from conversations where text is not null),
u as (select stem, page, turn, unnest(ss) as s, generate_subscripts(ss, 1) as i from (select *, string_split(regexp_replace(regexp_replace(text, '\\s+', ' ', 'g'), '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)) as ss from b)),
k as (select *, substr(trim(s), 1, 800) as sentence, row_number() over (partition by stem order by turn, i) - 1 as idx, count(*) over (partition by stem) as n from u where length(trim(s)) >= 40),
t as (select *, case when n > 6 then cast(ceil(idx * 6 / n) as bigint) else idx end as j from k)
select stem, cast(j as int) as sentence_idx, cast(page as int) as page, sentence from t where n <= 6 or (j < 6 and j * n // 6 = idx)""")
def streamed_sentences(spark, sf):
    """Sentences of blocks of which every third begins a page, thinned to six a conversation."""
    text = F.when(F.col("turn") % 3 == 0, F.concat(F.lit("[[page:"), (F.col("turn") + 1).cast("string"), F.lit("]]\n"), "text")).otherwise(F.col("text"))
    blocks = _t(spark, sf, "conversations").where("text is not null").select(F.col("conv_id").alias("stem"), F.col("turn").alias("ordinal"), text.alias("text"))
    return C.streamed_sentences(blocks, cap=6, lot=4)


@query("""with p as (select 'country' as dimension, n_name as value, c_mktsegment as d from customer join nation on c_nationkey = n_nationkey union all select 'segment', c_mktsegment, c_mktsegment from customer union all select '*', null, c_mktsegment from customer)
select dimension, value, count(*) as n, count(distinct d) as n_distinct from p group by 1, 2""")
def archive_sets(spark, sf):
    """Reports and their segments by country, by segment and in all, from one aggregate over grouping sets."""
    c = _t(spark, sf, "customer").join(_t(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("country"), F.col("c_mktsegment").alias("segment"))
    return R.profiled(c, ["country", "segment"], F.col("segment"))


@query("select user_id, event_type, event_id, ts from events qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1")
def status_stream(spark, sf):
    """The current row of each user and type of a log that arrives in lots, in which rows come up to a day late or twice."""
    base = scratch.folder(spark, "status")
    kind = _t(spark, sf, "events").schema["ts"].dataType
    events = _t(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type")  # a watermark takes no other
    at = F.unix_micros
    low, high = events.agg(F.min(at(F.col("ts"))), F.max(at(F.col("ts")))).first()
    if low is None:
        return events.select("user_id", "event_type", "event_id", F.col("ts").cast(kind).alias("ts"))
    tasks = _tasks(events, ARRIVING)
    state, out = stateful.state_session(spark, tasks), UpsertTable(spark, f"{base}/out", ["user_id", "event_type"])
    late = F.when(F.col("event_id") % 3 == 0, 20 * 3_600_000_000).otherwise(0)
    dealt = events.withColumn("lot", F.least(F.floor((at(F.col("ts")) + late - low) / ((high - low + 1) / 2)), F.lit(1)))
    # The last row, of no user, moves time on until every span has closed.
    end = events.agg(F.lit(-1).cast("long").alias("event_id"), (F.max("ts") + F.expr("interval 1 year")).alias("ts"), F.lit(-1).cast("long").alias("user_id"), F.lit("end").alias("event_type"))
    lots = [dealt.where(f"lot = {i} or lot = {i} - 1 and event_id % 50 = 0") for i in range(2)] + [end]
    for lot in lots:
        lot.select(*events.columns).repartition(tasks, "event_id").write.mode("append").parquet(f"{base}/in")
        stream = incremental.arriving(state, f"{base}/in", events.schema, files=tasks)  # a lot at a time
        incremental.upsert(incremental.current_status(stream, ["user_id", "event_type"], "ts", "event_id", "6 hours", "2 days"), out, f"{base}/check", F.desc("ts"), F.desc("event_id"))
    return out.read().where("event_id >= 0").select("user_id", "event_type", "event_id", F.col("ts").cast(kind).alias("ts"))


DRIFTED = """
select event_id, concat('e', cast(event_id as string)) as stem, concat('Here it is: ', case when event_id % 6 = 0 then replace(props, '}}', ', "note": [1]}}') when event_id % 6 = 1 then '{{"k": "7"}}' when event_id % 6 = 2 then '{{"k": "many", "z": null}}' when event_id % 6 = 3 then '{{"k": [1, 2]}}' when event_id % 6 = 4 then 'no answer' else props end, ' as asked') as raw
from {events} where props is not null
"""
_DRIFTED = "e as (select event_id, event_id % 6 as m, cast(json_extract(props, '$.k') as bigint) as k from events where props is not null)"


@query(f"with {_DRIFTED} select event_id, case when m in (0, 5) then k when m = 1 then 7 end as k, case m when 2 then 'k:STRING' when 3 then 'k:ARRAY<BIGINT>' else '' end as drift, case m when 0 then 'note' when 2 then 'z' else '' end as unknown from e where m <> 4")
def variant_results(spark, sf):
    """Answers whose fields have other types than asked for, or other names: kept, typed where that can be, and named."""
    good, _ = M.variants(Z.table(spark, sf, DRIFTED))
    rows = M.shredded(good, {"k": "bigint"})
    found = F.transform("drift", lambda d: F.concat(d["field"], F.lit(":"), d["found"]))
    return rows.select("event_id", "k", F.array_join(found, "|").alias("drift"), F.array_join("unknown", "|").alias("unknown"))


@query(f"with {_DRIFTED}, d as (select case m when 0 then 'note' when 2 then 'z' end as field, 'unknown' as found from e where m in (0, 2) union all select 'k', case m when 2 then 'STRING' else 'ARRAY<BIGINT>' end from e where m in (2, 3)) select field, found, count(*) as n from d group by 1, 2")
def variant_drift(spark, sf):
    return M.drift_counts(M.shredded(M.variants(Z.table(spark, sf, DRIFTED))[0], {"k": "bigint"}))


@query("""with p as (select a.vec_id, b.vec_id as other, list_inner_product(cast(a.embedding as double[]), cast(b.embedding as double[])) as sim from embeddings a, embeddings b)
select vec_id, other, round(sim, 6) as sim, cast(row_number() over (partition by vec_id order by sim desc, other) as int) as rank from p qualify rank <= 5""")
def nearest_vectors(spark, sf):
    """The five nearest of all embeddings to each of them, by tiles of both sides."""
    e = _t(spark, sf, "embeddings").select("vec_id", "embedding")
    return N.top_products(e, e.withColumnRenamed("vec_id", "other"), "vec_id", "other", 5).withColumn("sim", F.round("sim", 6))


_GRAMS = """t as (select doc_id, lang, ' ' || regexp_replace(lower(text), '[^\\p{L}]+', ' ', 'g') || ' ' as s from documents where text is not null),
g as (select doc_id, lang, unnest(list_transform(range(1, length(s) - 1), lambda i: substr(s, i, 3))) as gram from t)"""


@query(f"""with {_GRAMS}, c as (select lang, gram, count(*) as c from g where lang is not null group by all), n as (select *, sum(c) over (partition by lang) + 2000 as n from c qualify row_number() over (partition by lang order by c desc, gram) <= 2000),
w as (select lang, gram, cast(round(1000 * ln((c + 1.0::double) / n)) as bigint) as w, cast(round(1000 * ln(1.0::double / n)) as bigint) as floor from n),
k as (select doc_id, gram, count(*) as m from g where gram in (select gram from w) group by all), known as (select doc_id, sum(m) as known from k group by 1 having sum(m) >= 20), l as (select distinct lang, floor from w),
s as (select k.doc_id, l.lang, any_value(known) as known, cast(sum(m * coalesce(w, floor)) as bigint) as score from k join known using (doc_id) cross join l left join (select lang, gram, w from w) w on w.gram = k.gram and w.lang = l.lang group by 1, 2),
b as (select * from s qualify row_number() over (partition by doc_id order by score desc, lang) = 1)
select d.doc_id, coalesce(b.lang, 'unknown') as lang, cast(coalesce(b.known, 0) as bigint) as known, score from documents d left join b on b.doc_id = d.doc_id""")
def language_profiles(spark, sf):
    """The likeliest language of every document by trigram profiles of all labelled ones."""
    docs = _t(spark, sf, "documents").select("doc_id", "lang", "text")
    pieces = G.counted(docs)
    return G.detected(docs, G.fit(docs, pieces=pieces), "doc_id", pieces=pieces)


DRAWN = """
select concat('c', cast(conv_id as string)) as stem, cast(turn + 1 as int) as page, role, cast(2 + turn % 2 as int) as n_rows, cast(2 + conv_id % 3 as int) as n_columns, conv_id % 5 = 0 as joined from (select conv_id, turn, max(role) as role from {conversations} group by conv_id, turn) where turn % 3 <> 2
"""


def _drawn(spark, sf):
    """Rules and words of a table on each page: rows 20 high and columns 50 wide from (30, 40), lines off by up to a point
    and drawn in two overlapping halves; where joined, no line parts the first two cells of the first row."""
    t = Z.table(spark, sf, DRAWN)
    own = ["stem", "page"]
    r, c = F.col("n_rows"), F.col("n_columns")
    line = lambda *ends: F.struct(*[(F.lit(v) if isinstance(v, int) else v).cast("double").alias(n) for v, n in zip(ends, ("x0", "y0", "x1", "y1"), strict=True)])
    at_x, at_y = lambda i: 30 + 50 * i, lambda i: 40 + 20 * i
    off = lambda i: (F.col("page") + i) % 3 * 0.5 - 0.5
    across = F.transform(F.sequence(F.lit(0), r), lambda i: F.array(line(at_x(0) - 1, at_y(i) + off(i), at_x(c) / 2 + 20, at_y(i)), line(at_x(c) / 2 + 10, at_y(i), at_x(c) + 1, at_y(i) + off(i))))
    top = lambda i: F.when(F.col("joined") & (i == 1) & (c > 1), at_y(1)).otherwise(at_y(0))
    down = F.transform(F.sequence(F.lit(0), c), lambda i: F.array(line(at_x(i) + off(i), top(i), at_x(i), at_y(r) - 10), line(at_x(i), at_y(r) - 15, at_x(i), at_y(r))))
    loose = F.array(F.array(line(F.lit(10), F.lit(400), F.lit(300), F.lit(400)), line(F.lit(5), F.lit(5), F.lit(5), F.lit(5))))
    rules = t.select(*own, F.explode(F.flatten(F.concat(across, down, loose))).alias("l")).select(*own, "l.*")
    spots = F.transform(F.sequence(F.lit(0), r - 1), lambda i: F.transform(F.sequence(F.lit(0), c - 1), lambda j: F.struct((at_x(j) + 25).cast("double").alias("x"), (at_y(i) + 10).cast("double").alias("y"), F.concat("role", F.lit("-"), i.cast("string"), F.lit("-"), j.cast("string")).alias("text"))))
    words = t.select(*own, F.explode(F.flatten(spots)).alias("w")).select(*own, "w.*")
    return rules, words.unionByName(t.select(*own, F.lit(500.0).alias("x"), F.lit(10.0).alias("y"), F.lit("outside").alias("text")))


@query(f"""with t as ({Z.plain(DRAWN)}), g as (select *, unnest(range(n_rows)) as i from t), h as (select *, unnest(range(n_columns)) as j from g),
w as (select *, case when joined and i = 0 and j = 1 then '' when joined and i = 0 and j = 0 then role || '-0-0 ' || role || '-0-1' else role || '-' || i || '-' || j end as said from h),
r as (select stem, page, i, string_agg(said, '|' order by j) as row from w group by all) select stem, page, string_agg(row, '/' order by i) as grid from r group by all""")
def ruled_tables(spark, sf):
    """Tables recovered from the lines drawn on pages, as text: rows parted by /, cells by |."""
    rules, words = _drawn(spark, sf)
    grid = F.array_join(F.transform(F.get("tables", F.lit(0)), lambda row: F.array_join(row, "|")), "/")
    return B.grids(rules, words).where("size(tables) = 1").select("stem", "page", grid.alias("grid"))


@query(f"""with t as ({Z.plain(DRAWN)}), u as (select *, n_rows * n_columns - case when joined then 1 else 0 end >= 4 as useful from t), p as (select stem, max(page) as pdf_pages, cast(count(*) filter (useful) as int) as tables_found from u group by 1)
select stem, cast(pdf_pages as int) as pdf_pages, 'success' as extraction_status, tables_found from p""")
def ruled_extraction(spark, sf):
    """Extraction results of pages whose tables are recovered from their lines; a table of too few cells does not count."""
    rules, words = _drawn(spark, sf)
    pages = Z.table(spark, sf, DRAWN).select("stem", "page", F.col("role").alias("text")).join(B.grids(rules, words).hint("merge"), ["stem", "page"], "left")
    none = F.lit(None).cast("int")
    tasks = pages.groupBy("stem").agg(F.max("page").alias("pdf_pages")).select("stem", none.alias("page_start"), none.alias("page_end"), "pdf_pages")
    return files.from_pages(tasks, pages).select("stem", "pdf_pages", "extraction_status", "tables_found")
