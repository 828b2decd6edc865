"""SQL that gives the rows of the queries it can express, by another way than theirs: all shingles and all words joined."""

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: Sets of shingles, linked by counting the shingles that two sets share; components by reachability.
OP3 = f"""with recursive words as (select doc_id, list_filter(string_split_regex({LOWER.format("coalesce(text, '')")}, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as w from documents),
grams as (select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')] else list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) end) as g from words),
sized as (select doc_id, cast(len(g) as bigint) as n, md5(array_to_string(list_sort(g), chr(10))) as k, g from grams),
reps as (select min(doc_id) as rep, k, any_value(n) as n, any_value(g) as g from sized where n > 0 group by k),
places as (select rep, n, unnest(g) as s from reps),
pairs as (select a.rep as a, b.rep as b from places a join places b on a.s = b.s and a.rep < b.rep group by a.rep, b.rep, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))),
links as (select a, b from pairs union select b, a from pairs union select rep, rep from reps),
reach as (select a, b from links union select reach.a, links.b from reach join links on reach.b = links.a),
least as (select a as rep, min(b) as component from reach group by a)
select d.doc_id, d.n as n_shingles, coalesce(component, d.doc_id) as component_id, d.doc_id = coalesce(component, d.doc_id) as kept from sized d left join reps on d.k = reps.k and d.n > 0 left join least on least.rep = reps.rep"""
WORDS = "string_split_regex(trim(lower(text), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '[\\x20\\x09-\\x0D]+')"
#: Items laid on documents wherever one word is equal, and the equal words counted in windows.
OP7 = f"""with d as (select doc_id, {WORDS} as w from documents where doc_id is not null and text is not null), i as (select item_id, {WORDS} as v from benchmark where item_id is not null and text is not null),
dw as (select doc_id, len(w) as m, unnest(w) as word, generate_subscripts(w, 1) - 1 as p from d), iw as (select item_id, len(v) as n, least(len(v), 13) as span, unnest(v) as word, generate_subscripts(v, 1) - 1 as k from i where v[1] <> ''),
eq as (select doc_id, item_id, m, n, span, p - k as off, k from dw join iw on dw.word = iw.word),
likely as (select doc_id, item_id, off from eq group by doc_id, item_id, off, span having count(*) >= 0.8 * span),
own as (select eq.* from eq join likely using (doc_id, item_id, off)),
starts as (select distinct doc_id, item_id, off, span, least(k, n - span) as s from own),
hit as (select distinct doc_id, item_id, off from (select s.doc_id, s.item_id, s.off, s.s, s.span from starts s join own o on o.doc_id = s.doc_id and o.item_id = s.item_id and o.off = s.off and o.k between s.s and s.s + s.span - 1 group by all having count(*) >= 0.8 * s.span)),
laid as (select doc_id, item_id, off, count(*) as matched, greatest(0, least(any_value(n), any_value(m) - off) - greatest(0, -off)) as compared from own join hit using (doc_id, item_id, off) group by doc_id, item_id, off)
select doc_id, item_id, cast(off as int) as "at", cast(matched as int) as matched, cast(compared as int) as compared from laid qualify row_number() over (partition by doc_id, item_id order by matched desc, off) = 1"""

#: Shares of all kept words in all groups, zeros too, and every word of every pair of sources.
OP11 = f"""with texts as (select row_number() over () as id, coalesce(lang, '') as lang, coalesce(source, '') as source, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[a-z\\x{{80}}-\\x{{10FFFF}}]+') as w from documents),
occurrences as (select id, lang, source, unnest(w) as term from texts),
kept as (select lang, term from occurrences group by lang, term having count(distinct id) >= 30),
counts as (select lang, source, term, cast(count(*) as hugeint) as n from occurrences join kept using (lang, term) group by all),
grp as (select distinct lang, source from texts),
sizes as (select lang, count(*) as v from kept group by lang),
dense as (select g.lang, g.source, k.term, coalesce(c.n, 0) as n from grp g join kept k on g.lang = k.lang left join counts c on c.lang = g.lang and c.source = g.source and c.term = k.term),
shares as (select lang, source, term, n, cast(1 + 1000000000 * (n + 5) // (sum(n) over (partition by lang, source) + 5 * v) as bigint) as p from dense join sizes using (lang)),
whole as (select lang, term, cast(1 + 1000000000 * (n + 5) // (sum(n) over (partition by lang) + 5 * v) as bigint) as q from (select lang, term, sum(n) as n from dense group by lang, term) join sizes using (lang)),
pairs as (select a.lang, a.source, b.source as item, cast(coalesce(sum(abs(s.p - t.p)), 0) as bigint) as value from grp a join grp b on a.lang = b.lang and a.source <> b.source left join shares s on s.lang = a.lang and s.source = a.source left join shares t on t.lang = b.lang and t.source = b.source and t.term = s.term group by all),
words as (select lang, source, term as item, p - q as value from shares join whole using (lang, term) where n > 0 and p > q),
ranked as (select *, 'pair' as part, row_number() over (partition by lang, source order by value desc, item) as rank from pairs union all
select *, 'term' as part, row_number() over (partition by lang, source order by value desc, item) as rank from words)
select lang, source, part, item, value, cast(rank as int) as rank from ranked where part = 'pair' or rank <= 50"""

ORACLE_SQL = {"op3_near_duplicates": OP3, "op7_decontaminate": OP7, "op11_divergence": OP11}
