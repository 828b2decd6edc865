"""Report-shaped tables made of the test tables by SQL that Spark and other engines read alike."""

from __future__ import annotations

import io
import re
import zipfile
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

REPORTS = """
select o.o_orderkey as doc_id, c.c_name as company, n.n_name as country, cast(year(o.o_orderdate) as int) as report_year,
  concat('In this period we measured our own results with care. Our gross Scope 1 emissions were ', cast(o.o_orderkey % 900 + 100 as string), ',', lpad(cast(o.o_custkey % 1000 as string), 3, '0'), ' tCO2e in ', cast(year(o.o_orderdate) as string), '. ',
    case when o.o_orderkey % 3 = 0 then 'The baseline year 2019 had a higher energy use, and we target a 42 % reduction of carbon by 2030. ' else '' end,
    case when o.o_orderkey % 4 = 1 then concat('Training reached ', cast(o.o_custkey % 5000 as string), ' employees and workers with health and safety education. ') else '' end,
    case when o.o_orderkey % 5 < 2 then 'The board and its directors approved the audit policy on ethics, compliance and anti-corruption. ' else '' end,
    case when o.o_orderkey % 7 = 2 then 'Onboarding of cardboard, sewage and windows counts for nothing here. E1-6 Gross Scope 1, 2, 3 and total GHG emissions 87' else 'Costs were EUR 1.2 million for solar and wind power.' end) as text
from {orders} o join {customer} c on o.o_custkey = c.c_custkey join {nation} n on c.c_nationkey = n.n_nationkey
"""
INDEX = """
select cast(o.o_orderkey as string) as id, o.o_orderkey as ordinal, case when o.o_orderkey % 11 = 0 then '' else concat(c.c_name, ' & Co. S.A.') end as name, case when o.o_orderkey % 4 = 0 then '' else concat('XS', cast(c.c_custkey as string)) end as isin,
  n.n_name as country, case when o.o_orderkey % 13 = 0 then 'nan' else concat(cast(year(o.o_orderdate) as string), '.0') end as year_text, o.o_orderpriority as kind,
  concat(case when o.o_orderkey % 5 = 0 then 'hhttps://' when o.o_orderkey % 5 = 1 then '//' when o.o_orderkey % 5 = 2 then '' else 'https://' end, case when o.o_orderkey % 17 = 3 then 'nodot' else 'files.example.com' end, '/r/', cast(o.o_custkey as string), ' a.pdf') as link,
  case when o.o_orderkey % 3 = 0 then cast(null as string) else cast(o.o_orderkey % 3 * 10 as string) end as s, case when o.o_orderkey % 3 = 0 then cast(null as string) else cast(o.o_orderkey % 3 * 20 as string) end as e
from {orders} o join {customer} c on o.o_custkey = c.c_custkey join {nation} n on c.c_nationkey = n.n_nationkey
"""
DOWNLOADS = """
select cast(o_orderkey as string) as stem, case when o_orderstatus = 'F' then 'success' when o_orderstatus = 'O' then 'http_403' else 'success:referer' end as download_status, cast(floor(o_totalprice) as bigint) as pdf_bytes, o_orderkey as ordinal, concat('u', cast(o_custkey as string)) as url
from {orders} where o_orderkey % 4 <> 3
"""
EXTRACTIONS = """
select cast(l_orderkey as string) as stem, case when min(l_linestatus) = 'F' then 'success' else 'error' end as extraction_status, case when l_orderkey % 3 = 0 then 'de' else 'en' end as language, cast(count(*) as int) as pdf_pages, cast(count(*) as int) as pages_extracted, cast(floor(sum(l_quantity)) as bigint) as word_count, cast(count(distinct l_returnflag) as int) as tables_found, 't' as text_file, '' as table_file
from {lineitem} group by l_orderkey
"""
URLS = """
select page_id, case when page_id % 5 = 0 then concat('h', url) when page_id % 5 = 1 then replace(replace(url, 'https:', ''), 'http:', '') when page_id % 5 = 2 then replace(replace(url, 'https://', ''), 'http://', '') when page_id % 5 = 3 then concat(' ', url, '/a b ') else url end as url
from {pages}
"""
LANDING = """
select page_id, url, concat(html, '<a href="/files/a', cast(page_id as string), '.pdf">x</a><iframe src="https://cdn.example.com/annual-', cast(page_id % 7 as string), '.pdf?v=1"></iframe><a href="mailto:x.pdf">m</a><a href="https://cdn.example.com/media/', cast(page_id as string), '/download">d</a>') as html
from {pages}
"""
ATTEMPTS = """
select concat('s', cast(user_id as string)) as stem, cast(event_id as int) as attempt_no, case when event_id % 4 = 0 then 'plain' when event_id % 4 = 1 then 'referer' else 'browser' end as strategy,
  case when event_id % 6 = 0 then 200 when event_id % 6 < 3 then 403 else 404 end as http_status, case when event_id % 10 = 1 then 'cloudflare' else 'nginx' end as server, case when event_id % 8 = 1 then 'Just a moment' when event_id % 8 = 2 then 'Access Denied' else 'sorry' end as body_sample, case when event_id % 9 = 4 then 'timeout' else cast(null as string) end as error_class
from {events}
"""
DAMAGED = """
select event_id, props as whole, case when event_id % 5 = 0 then props when event_id % 5 = 1 then replace(props, '}}', ',}}') when event_id % 5 = 2 then replace(props, '}}', '') when event_id % 5 = 3 then concat('Here is the result: ', props, ' as asked') else concat('```json ', props, ' ```') end as raw
from {events} where props is not null
"""
SIMS = """
select concat('r', cast(l_suppkey % 40 as string)) as stem, concat('E', cast(l_partkey % 5 + 1 as string), '-', cast(l_linenumber as string)) as dr_code, cast(l_orderkey % 60 as int) as sentence_idx, cast(max(floor(l_extendedprice) % 1000) as double) / 1000 as sim
from {lineitem} group by 1, 2, 3
"""
ENTAILMENT = """
select concat('r', cast(l_suppkey % 40 as string)) as stem, concat('E', cast(l_partkey % 5 + 1 as string), '-', cast(l_linenumber as string)) as dr_code, cast(l_orderkey % 60 as int) as sentence_idx, cast(max(floor(l_extendedprice * 3) % 100) as double) / 100 as score
from {lineitem} group by 1, 2, 3
"""
DISCLOSURES = """
select concat('r', cast(l_suppkey % 50 as string)) as stem, case when l_linenumber < 5 then concat('E', cast(l_linenumber as string)) else cast(null as string) end as standard, case when l_partkey % 6 = 0 then concat('GOV-', cast(l_partkey % 5 + 1 as string)) when l_partkey % 6 = 1 then concat('S', cast(l_linenumber % 4 + 1 as string), '-1') else concat('E', cast(l_linenumber % 5 + 1 as string), '-', cast(l_partkey % 6 as string)) end as dr_code,
  case when l_returnflag = 'A' then 'reported' when l_returnflag = 'N' then 'material_not_reported' when l_partkey % 3 = 0 then 'phase_in_deferred' else 'not_addressed' end as status, case when l_orderkey % 9 = 0 then cast(null as double) else cast(floor(l_discount * 100) as double) / 100 end as confidence, cast(l_orderkey as int) as chunk_no, cast(l_linenumber as int) as pos, cast(l_partkey % 3 as int) as n_datapoints, case when l_partkey % 2 = 0 then 'flag_a' else 'flag_b' end as flag
from {lineitem}
"""

SHEET = """
select n.n_name as nation, c.c_custkey as k, c.c_name as company, case when c.c_custkey % 7 = 0 then 'ftp://x/y.pdf' when c.c_custkey % 5 = 0 then concat(' https://files.example.com/', cast(c.c_custkey as string), '.pdf ') else concat('http://files.example.com/', cast(c.c_custkey as string), '.pdf') end as link,
  case when c.c_custkey % 4 = 0 then '' else concat(cast(c.c_custkey % 50 as string), '.0') end as page_start, case when c.c_custkey % 4 = 1 then 'nan' else cast(c.c_custkey % 50 + 9 as string) end as page_end,
  case when c.c_custkey % 3 = 0 then 'nan' else cast(2020 + c.c_custkey % 4 as string) end as year_text, c.c_mktsegment as segment
from {customer} c join {nation} n on c.c_nationkey = n.n_nationkey
"""
SUMMARIES = """
select o_orderkey as ordinal, concat('Company ', cast(o_orderkey as string), ' & Co.') as company, case when o_orderkey % 4 = 0 then '' else concat('XS', cast(o_custkey as string)) end as isin, cast(2020 + o_orderkey % 5 as string) as report_year, 'x' as country, 's' as sector, 'i' as industry, 'a' as auditor, 'full' as csrd_compliant,
  case when o_orderkey % 3 = 0 then '' else cast(o_orderkey % 3 * 10 as string) end as page_start, case when o_orderkey % 3 = 0 then '' else cast(o_orderkey % 3 * 20 as string) end as page_end, cast(o_custkey as bigint) as word_count,
  case when o_orderstatus = 'P' then 'failed' else 'success' end as extraction_status, case when o_orderkey % 8 = 5 then 'de' else 'en' end as language,
  case when o_orderkey % 5 = 0 then ' ' when o_orderkey % 5 = 1 then concat('elsewhere/t', cast(o_orderkey as string), '.txt') else concat('texts/t', cast(o_orderkey as string), '.txt') end as text_file
from {orders}
"""
TEXTS = """
select concat('texts/t', cast(o_orderkey as string), '.txt') as path, concat('t', cast(o_orderkey as string)) as stem from {orders} where o_orderkey % 6 <> 0
"""
STORED = """
select concat('t', cast(o_orderkey as string)) as stem, concat('[[page:1]]', chr(10), 'some words ', o_orderpriority, chr(10), chr(10), case when o_orderkey % 2 = 0 then concat('[[page:2]]', chr(10), 'more') else '' end) as text, concat('texts/t', cast(o_orderkey as string), '.txt') as text_file, o_orderkey % 10 as text_time,
  case when o_orderkey % 3 = 0 then '[{{"page":1,"rows":[["a","b"]]}},{{"page":2,"rows":[]}}]' when o_orderkey % 3 = 1 then '[{{"page":1' else cast(null as string) end as tables_json
from {orders}
"""
PAYLOADS = """
select event_id, case when event_id % 4 = 0 then 'application/pdf' when event_id % 4 = 1 then 'text/html' when event_id % 4 = 2 then 'binary/Octet-Stream' else cast(null as string) end as content_type,
  concat(case when event_id % 3 = 0 then '%PDF-1.7 ' when event_id % 3 = 1 then 'header %PDF ' else '<html>' end, event_type, repeat(' filler', cast(event_id % 7 * 400 as int))) as body
from {events}
"""
ANSWERS = """
select concat('https://', case when o_orderkey % 3 = 0 then 'a' when o_orderkey % 3 = 1 then 'b' else 'c' end, '.example.com/api') as base, concat('/documents/', cast(o_custkey as string)) as path, case when o_orderkey % 5 = 0 then 503 else 200 end as http_status, case when o_orderkey % 7 = 0 then '<html>' else concat('{{"id":', cast(o_orderkey as string), '}}') end as body
from {orders}
"""
LINES = """
select cast(n_regionkey * 100 + 1 as int) as line, concat('### ESRS E', cast(n_regionkey + 1 as string), ' — ', r_name) as value from {nation} join {region} on n_regionkey = r_regionkey group by n_regionkey, r_name
union all select cast(n_regionkey * 100 + 2 + n_nationkey as int), concat('- `E', cast(n_regionkey + 1 as string), '-', cast(n_nationkey as string), '` — ', n_name) from {nation}
union all select 1000, '### Cross-cutting' union all select 1001, '- `MDR-P` — no' union all select 1002, '### ESRS 1 — no' union all select 1003, '- `A` — no' union all select 1004, '### ESRS 2 — general' union all select 1005, '- `BP-1` — Basis' union all select 1006, 'prose'
"""
TABLED = """
select concat('c', cast(conv_id as string)) as stem, cast(turn + 1 as int) as page, max(text) as text, cast(conv_id % 5 as int) as a, cast(turn % 4 as int) as b from {conversations} group by conv_id, turn
"""
SPANS = """
select l_orderkey, l_linenumber, case when l_orderkey % 7 = 0 then concat(cast(1900 + l_orderkey % 200 as string), ' was it') when l_orderkey % 7 = 1 then cast(l_orderkey % 10 as string) when l_orderkey % 7 = 2 then concat(cast(l_orderkey % 900 + 10 as string), ' in all') when l_orderkey % 7 = 3 then concat(cast(l_orderkey % 900 as string), ' tonnes')
  when l_orderkey % 7 = 4 then concat(cast(l_orderkey % 900 + 10 as string), ' cases, 3 incidents') when l_orderkey % 7 = 5 then 'none' else concat(cast(l_orderkey % 90 as string), ',5 %') end as span
from {lineitem}
"""
CODES = """
select distinct concat('E', cast(l_partkey % 5 + 1 as string)) as standard, concat('E', cast(l_partkey % 5 + 1 as string), '-', cast(l_linenumber as string)) as dr_code, case when l_linenumber % 3 = 0 then 'Targets of waste' when l_linenumber % 3 = 1 then 'Water consumption' else 'Policies' end as dr_title from {lineitem}
union all select 'ESRS2', 'BP-1', 'Basis' union all select 'ESRS2', 'GOV-1', 'Bodies' union all select 'E1', 'E1-9', 'Effects'
"""
SENTENCES = """
select concat('r', cast(s_suppkey % 40 as string)) as stem, cast(i as int) as sentence_idx, cast(i % 7 + 1 as int) as page, case when i % 5 = 0 then concat('Given under the phase-in provision number ', cast(i as string), ' of the standard.') when i % 5 = 1 then concat('We used ', cast(i + 12 as string), ' tonnes against a baseline of 2019, scope 3 too.') else concat('Sentence ', cast(i as string), ' says what was done in the year.') end as sentence
from (select distinct s_suppkey % 40 as s_suppkey from {supplier}) s, (select distinct l_orderkey % 60 as i from {lineitem}) l
"""


def names(sql: str) -> list[str]:
    return sorted(set(re.findall(r"(?<!\{)\{(\w+)\}(?!\})", sql)))


def plain(sql: str) -> str:
    """The SQL over the tables' own names."""
    return sql.format(**{n: n for n in names(sql)}).strip()


def table(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    return spark.sql(sql, **{n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names(sql)})


def _zip(members: dict[str, bytes]) -> bytes:
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for name, body in members.items():
            z.writestr(name, body)
    return buffer.getvalue()


def xlsx(sheet: str, rows: list[list[str | None]], first: int = 1) -> bytes:
    """A workbook of one sheet of text whose rows begin at row first; a cell is written where it stands, or shared."""
    shared: dict[str, int] = {}
    lines = []
    for y, row in enumerate(rows, first):
        cells = []
        for x, v in enumerate(row):
            at = (chr(64 + x // 26) if x >= 26 else "") + chr(65 + x % 26) + str(y)
            if v is not None and x % 2:
                cells.append(f'<c r="{at}" t="inlineStr"><is><t xml:space="preserve">{escape(v)}</t></is></c>')
            elif v is not None:
                cells.append(f'<c r="{at}" t="s"><v>{shared.setdefault(v, len(shared))}</v></c>')
        lines.append(f'<row r="{y}">{"".join(cells)}</row>')
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    strings = "".join(f'<si><t xml:space="preserve">{escape(v)}</t></si>' for v in shared)
    return _zip({
        "xl/workbook.xml": f'<workbook {main} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="{sheet}" sheetId="1" r:id="rId1"/></sheets></workbook>'.encode(),
        "xl/_rels/workbook.xml.rels": b'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/sharedStrings.xml": f"<sst {main}>{strings}</sst>".encode(),
        "xl/worksheets/sheet1.xml": f"<worksheet {main}><sheetData>{''.join(lines)}</sheetData></worksheet>".encode(),
    })


def workbooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """path, content: a workbook for each nation, whose sheet holds its customers under a header in row 3."""
    header = ["company", "link", "start\nPDF", "end PDF", "Year", "country"]

    @F.pandas_udf("binary")
    def made(rows: pd.Series) -> pd.Series:
        body = lambda r: [[x["company"], x["link"], x["page_start"], x["page_end"], x["year_text"], x["segment"]] for x in r]
        return pd.Series([xlsx("csrd", [["a title"], [], header, *body(r)]) for r in rows])

    row = F.struct("k", "company", "link", "page_start", "page_end", "year_text", "segment")
    by = table(spark, sf_dir, SHEET).groupBy("nation").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    return by.select(F.concat(F.lit("archive_"), "nation", F.lit(".xlsx")).alias("path"), made("rows").alias("content"))


def archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """path, content: a ZIP for each part: a short and a longer PDF, or no PDF, or no archive at all."""

    @F.pandas_udf("binary")
    def made(keys: pd.Series) -> pd.Series:
        def one(k: int) -> bytes:
            if k % 5 == 0:
                return b"no archive"
            if k % 5 == 1:
                return _zip({"a.xhtml": b"x" * 50})
            return _zip({"a.pdf": b"%PDF" + b"a" * (k % 100), "dir/B.PDF": b"%PDF" + b"b" * (k % 300), "c.txt": b"c" * 900})

        return pd.Series([one(k) for k in keys])

    return spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").cast("string").alias("path"), made("p_partkey").alias("content"))


def bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """body: for each page a payload that names one report, by turns as tagged values and as a page's script."""
    i, y = F.col("page_id").cast("string"), (2000 + F.col("page_id") % 30).cast("string")
    nodes = F.concat(F.lit('{"nodes":[{"type":"skip"},{"type":"data","data":[{"documents":1},[2],{"id":3,"year":4,"company":5},"r'), i, F.lit('",'), y, F.lit(',{"name":6,"country":-1},"C'), i, F.lit('"]}]}'))
    page = F.concat(F.lit("<html><script>const d = {x:[1], documents:[{id:\"r"), i, F.lit('",year:'), y, F.lit(',company:{name:"C'), i, F.lit('",country:undefined}}]};</script>'))
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select(F.when(F.col("page_id") % 2 == 0, nodes).otherwise(page).alias("body"))
