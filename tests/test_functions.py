"""Column expressions and sources on hand-made cases."""

import io
import json
import math
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import lexicon as L, text as X, url as U
from tessera.operators import ports
from tessera.sources import devalue, files, sinks


def one(spark, expr, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'int' if isinstance(v, int) else 'double' if isinstance(v, float) else 'string'}" for k, v in values.items()))
    return df.select(expr.alias("x")).first().x


@pytest.mark.parametrize(("given", "want"), [
    ("hhttps://x.com/a b.pdf", "https://x.com/a%20b.pdf"), ("//x.com/r.pdf", "https://x.com/r.pdf"), ("x.com/r.pdf", "https://x.com/r.pdf"), (" https://x.com ", "https://x.com"),
    ("https://www.google.com/url?q=z&url=https%3A%2F%2Fx.com%2Fa.pdf", "https://x.com/a.pdf"), ("", ""), (None, None),
])
def test_clean_url(spark, given, want):
    assert one(spark, U.clean_url(F.col("v")), v=given) == want


def test_url_parts(spark):
    assert one(spark, U.mirror_key(F.col("v")), v="HTTPS://X.com/A/?b=1") == "x.com/a"
    assert one(spark, U.host(F.col("v")), v="https://WWW.x.com:80/a") == "www.x.com"
    assert one(spark, U.has_host(F.col("v")), v="https://localhost/a") is False
    html = '<meta http-equiv="refresh" content="0;url=/go.html"><a href="b.pdf">b</a><a href="/Annual.pdf?x=1">a</a><a href="javascript:x.pdf">j</a><embed src="b.pdf"><a href="/media/1/download">d</a>'
    got = one(spark, U.report_links(F.col("v"), F.lit("https://x.com/dir/page.html")), v=html)
    assert got == ["https://x.com/Annual.pdf?x=1", "https://x.com/go.html", "https://x.com/dir/b.pdf", "https://x.com/media/1/download"]


@pytest.mark.parametrize(("given", "want"), [("12.0", 12), ("nan", None), ("", None), ("x", None), (None, None), (" 7 ", 7), ("-3.9", -3), ("inf", None), ("1e30", None)])
def test_as_int(spark, given, want):
    assert one(spark, X.as_int(F.col("v")), v=given) == want


def test_stem_and_ranges(spark):
    df = spark.createDataFrame([("A & B S.A.", "", 2024, 10, 20), ("Ünï/co", "XS1", None, 0, 5)], "c string, i string, y int, s int, e int")
    assert [r[0] for r in df.select(X.stem(*[F.col(c) for c in "ciyse"])).collect()] == ["A_B_SA_noisin_2024_p10-20", "Ünïco_XS1"]
    assert tuple(one(spark, X.page_range(F.lit(5), F.lit(400), F.lit(90)), v="")) == (5, 90)
    assert tuple(one(spark, X.page_range(F.lit(0), F.lit(None).cast("int"), F.lit(90)), v="")) == (1, 90)


def test_keyword_hits(spark):
    hits = lambda t, p: one(spark, X.hits(F.col("v"), L.THEMES[p]), v=t)
    assert hits("onboarding cardboard board boards", "governance") == 2
    assert hits("wind winds windows", "environment") == 2
    assert hits("sewage wages", "social") == 1 and hits("", "social") == 0
    assert [len(L.THEMES[p]) for p in L.PILLARS] == [22, 21, 17]
    got = [one(spark, X.dominant(F.lit(a), F.lit(b), F.lit(c)), v="") for a, b, c in ((3, 3, 1), (0, 0, 0), (0, 2, 2), (0, 0, 1))]
    assert got == ["environment", "unknown", "social", "governance"]


@pytest.mark.parametrize(("span", "value", "unit"), [("124,500 tCO2e", 124500, "tCO2e"), ("124 500 tCO2e", 124500, "tCO2e"), ("124 500 tCO2e", 124500, "tCO2e"), ("42,3 %", 42.3, "%"), ("37 2024", 37, None), ("none", None, None), (None, None, None)])
def test_values(spark, span, value, unit):
    got = one(spark, X.value_and_unit(F.col("v")), v=span)
    assert (got.value, got.unit) == (value, unit)


def test_plausible(spark):
    p = lambda v, u, s: one(spark, X.plausible(F.lit(v).cast("double"), F.lit(u).cast("string"), F.col("v")), v=s)
    assert [p(2024, None, "2024 t"), p(5, None, "5 t"), p(500, None, "500"), p(500, None, "500 employees"), p(3, "t", "3 t"), p(None, None, "")] == [False, False, False, True, True, False]
    assert one(spark, X.year_after(F.col("v"), "target|by"), v="we target net zero by 2040 or 2050") == 2040
    assert one(spark, X.year_after(F.col("v"), "baseline"), v="baseline. 2019") is None


@pytest.mark.parametrize(("row", "want"), [
    ("E1-6 Gross GHG emissions ....... p.87", True), ("In FY2024 our gross Scope 1 emissions were 124,500 tCO2e (2023: 131,200 tCO2e), calculated using the operational-control approach.", False),
    ("E1-1 and E1-2 are covered", True), ("See the content index for all", True), ("E1-6 is told in prose", False),
])
def test_index_rows(spark, row, want):
    assert one(spark, X.is_index_row(F.col("v")), v=row) is want


@pytest.mark.parametrize(("raw", "want"), [('{"a":1}', {"a": 1}), ('```json\n{"a":[1,2,]}\n```', {"a": [1, 2]}), ('Here: {"a":1} done', {"a": 1}), ('{"a":[1,2', {"a": [1, 2]}), ('{"a":1,', {"a": 1}), ("no json", None), ("", None), (None, None)])
def test_repaired_json(spark, raw, want):
    got = one(spark, X.repaired_json(F.col("v")), v=raw)
    assert (got and json.loads(got)) == want


def test_text_shapes(spark):
    assert one(spark, X.clean_text(F.col("v")), v="\f a\r\n\n\n\nb  \t c ") == "a\n\nb c"
    assert one(spark, X.thinned(F.sequence(F.lit(0), F.lit(9)), 4), v="") == [0, 2, 5, 7]
    assert one(spark, X.word_count_without_marks(F.col("v")), v="[[page:1]]\nfür Über") == 2
    assert one(spark, X.metrics(F.col("v")), v="5 MWh, 5 MWh and 3 % of 12 staff for $ 5m") == ["5 MWh", "3 % of", "12 staff", "$ 5m"]
    assert one(spark, X.language(F.col("v")), v="der die das und von " * 20) == "de" and one(spark, X.language(F.col("v")), v="short") == "unknown"
    tables = [([["Name", "x"], ["b", "c"]], True), ([["Name", "x"]], False), ([["1", "2"], ["3", "4"]], False), ([], False)]
    df = spark.createDataFrame([(t,) for t, _ in tables], "t array<array<string>>")
    assert [r[0] for r in df.select(X.useful_table(F.col("t"))).collect()] == [w for _, w in tables]
    assert [one(spark, X.positive_label(F.col("v")), v=v) for v in ("YES", "LABEL_1", "no", "commitment")] == [True, True, False, True]


def test_devalue(spark):
    assert devalue.unflatten([{"documents": 1}, [2, 2], {"id": 3, "n": -3, "set": 4, "m": 6}, "a", ["Set", 3, 5], 7, ["Map", 3, 5]])["documents"][0]["set"] == ["a", 7]
    loop = devalue.unflatten([{"self": 0, "x": 1}, ["Date", "2024"]])
    assert loop["self"] is loop and loop["x"] == "2024"
    assert math.isnan(devalue.unflatten(-3)) and devalue.unflatten([["BigInt", "12"]]) == 12
    body = json.dumps({"nodes": [{"type": "skip"}, {"type": "data", "data": [{"documents": 1}, [2], {"id": 3, "year": 4, "me": 2}, "r1", 2024]}]})
    page = "<script>const d = {documents:[{id:'x' && \"r2\",year:2023}]}</script>".replace("'x' && ", "")
    rows = devalue.reports(spark.createDataFrame([(body,), (page,), ("junk",), (None,)], "body string"), "id string, year int").collect()
    assert sorted((r.id, r.year) for r in rows) == [("r1", 2024), ("r2", 2023)]


def test_files(spark, tmp_path):
    t = files.taxonomy_of(spark, "### ESRS 1 — x\n- `A` — no\n### ESRS 2 — G\n- `BP-1` — Basis — of\nx\n### Cross-cutting\n- `MDR-P` — no\n### ESRS E1 — C\n- `E1-1` — Plan")
    assert [(r.standard, r.dr_code, r.dr_title) for r in t.orderBy("line").collect()] == [("ESRS2", "BP-1", "Basis — of"), ("E1", "E1-1", "Plan")]
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("a.pdf", b"%PDF small")
        z.writestr("b.PDF", b"%PDF the larger")
    rows = {r.path: r for r in files.pdf_of_zip(spark.createDataFrame([("z", bytearray(buffer.getvalue())), ("bad", bytearray(b"x"))], "path string, content binary")).collect()}
    assert bytes(rows["z"].pdf) == b"%PDF the larger" and rows["bad"].error.startswith("bad_zip")
    sinks.append(spark.createDataFrame([("a", 1)], "k string, v int"), str(tmp_path / "log"), "r1")
    for _ in range(2):
        sinks.append(spark.createDataFrame([("a", 2), ("b", 3)], "k string, v int"), str(tmp_path / "log"), "r2")
    log = spark.read.parquet(str(tmp_path / "log"))
    assert log.count() == 3 and sorted((r.k, r.v) for r in sinks.current(log, ["k"]).collect()) == [("a", 2), ("b", 3)]
    sinks.overwrite_csv(spark.createDataFrame([("a,b", None)], "company string, report_year int"), str(tmp_path / "csv"))
    assert files.csv(spark, str(tmp_path / "csv"), "company string, report_year int").collect() == [("a,b", None)]
    (tmp_path / "texts").mkdir()
    (tmp_path / "texts" / "A_x.txt").write_text("one\ntwo")
    assert files.texts(spark, str(tmp_path / "texts")).collect() == [("A_x", "one\ntwo")]


def test_ports(spark):
    df = spark.createDataFrame([("solar power",), ("power solar",), (None,)], "t string")
    v = [r[0] for r in df.select(ports.embed(ports.hashed_embedder(16))("t")).collect()]
    assert np.allclose(v[0], v[1]) and np.isclose(np.linalg.norm(v[0]), 1) and not any(v[2])
    assert [r[0] for r in df.select(ports.entailment(ports.overlap_entailment)("t", F.lit("solar wind"))).collect()] == [0.5, 0.5, 0.0]
    assert ports.best_span(np.array([0.1, 0.8]), np.array([0.7, 0.3])) is None and ports.best_span(np.array([0.9, 0.1]), np.array([0.1, 0.9]))[:2] == (0, 1)

    def model():
        seen = []

        def run(text):
            seen.append(text)
            if text == "bad":
                raise ValueError("nope")
            if seen.count(text) == 1:
                raise RuntimeError("429 rate limit")
            return "{}"

        return run

    rows = {r.stem: r for r in ports.ask(spark.createDataFrame([("a", 0, "x"), ("b", 0, "bad")], "stem string, chunk_no int, text string"), model, wait=0.0).collect()}
    assert rows["a"].raw == "{}" and rows["b"].error == "nope"
