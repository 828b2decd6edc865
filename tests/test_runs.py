"""Whole runs on small tables, model ports, ranks, and the log of compiled expressions."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera import __main__ as cli, runs
from tessera.functions import text as X, url as U
from tessera.operators import disclosure as D, index as I, merge as M, ports, relational as R, semantic as S
from tessera.plans import fixtures as Z
from tessera.plans.extraction import TAXONOMY
from tessera.sources import devalue, files, sinks
from tessera.sources.upserts import UpsertTable


def test_runs_from_index_to_worklist(spark, tmp_path):
    at = lambda n: str(tmp_path / n)
    (tmp_path / "books").mkdir()
    rows = [["t"], [], ["company", "link", "start\nPDF", "end PDF", "fiscal year"], ["A & B", " http://a.com/x.pdf", "3", "9", "2024.0"], ["C", "ftp://c.com", "", "", ""], ["D", "https://d.com/y.pdf", "nan", None, None], ["E", "https://e.com/z.pdf", "1", "2", "2020"]]
    for name, body in (("csrd_1.xlsx", [["old"]]), ("csrd_2.xlsx", rows)):
        (tmp_path / "books" / name).write_bytes(Z.xlsx("csrd", body))
    cli.main(["index", "--workbooks", at("books"), "--years", "2024", "--out", at("index")], spark)
    index = spark.read.option("header", True).csv(at("index"))
    assert sorted((r.company, r.report_year, r.page_start) for r in index.collect()) == [("A & B", "2024", "3"), ("D", None, None)]
    (tmp_path / "payload.txt").write_text(json.dumps({"nodes": [{"type": "data", "data": [{"documents": 1}, [2], {"id": 3, "year": 4, "original_link": 5, "company": 6}, "r1", 2024, "hhttps://x.com/a.pdf", {"name": 7, "country": 8}, "Comp", "FR"]}]}))
    cli.main(["index", "--payloads", at("payload.txt"), "--out", at("live"), "--dump", at("dump")], spark)
    dumped = spark.read.json(at("dump")).first()
    assert (dumped.id, dumped.original_link, dumped.company.country, dumped.ordinal) == ("r1", "hhttps://x.com/a.pdf", "FR", 0)
    live = spark.read.option("header", True).csv(at("live")).first()
    assert (live.company, live.link, live.stem) == ("Comp", "https://x.com/a.pdf", "Comp_noisin_2024")
    stems = ["Comp_noisin_2024", "Other_noisin"]
    full = spark.createDataFrame([("Comp", "", 2024, "FR", "i", "s", "t", "full", "a", "2025", None, None, "https://x.com/a.pdf", stems[0]), ("Other", "", None, "DE", "i", "s", "t", "", "", "", 1, 2, "https://y.com/b.pdf", stems[1])], "company string, isin string, report_year int, country string, industry string, sector string, doc_type string, csrd_compliant string, auditor string, publication_date string, page_start int, page_end int, link string, stem string")
    full.write.parquet(at("i"))
    spark.createDataFrame([(s, "success", 20_000) for s in stems], "stem string, download_status string, pdf_bytes long").write.parquet(at("d"))
    text = {s: "".join(f"[[page:{p}]]\n" + "Scope 1 emissions were 124,500 tCO2e measured in the year. We set targets of a reduction of carbon by 2030 for the plan. " for p in (1, 2)) for s in stems}
    (tmp_path / "texts").mkdir()
    for s, t in text.items():
        (tmp_path / "texts" / f"{s}.txt").write_text(t)
    ext = [(s, "success", "en", 2, 2, 30, 0, f"elsewhere/{s}.txt", "") for s in stems]
    spark.createDataFrame(ext, "stem string, extraction_status string, language string, pdf_pages int, pages_extracted int, word_count long, tables_found int, text_file string, table_file string").write.parquet(at("e"))
    totals = runs.summarise(spark, runs.SummaryOptions(at("i"), at("d"), at("e"), at("summary"))).first()
    assert (totals.reports, totals.downloaded, totals.words) == (2, 2, 60)
    cli.main(["keywords", "--summary", at("summary"), "--texts", at("texts"), "--out", at("nlp")], spark)
    flat = spark.read.option("header", True).csv(at("nlp/nlp_results"))
    assert {r.stem: r.dominant_pillar for r in flat.collect()} == dict.fromkeys(stems, "environment")
    (tmp_path / "taxonomy.md").write_text(TAXONOMY)
    neural = ["neural", "--summary", at("summary"), "--texts", at("texts"), "--taxonomy", at("taxonomy.md"), "--out", at("esrs")]
    with pytest.raises(SystemExit, match="no model ports"):
        cli.main(neural, spark)
    cli.main([*neural, "--stand-ins", "--limit", "1", "--run-id", "r1"], spark)
    results = UpsertTable(spark, at("esrs/results"), ["stem"])
    assert results.read().count() == 1
    cli.main([*neural, "--stand-ins", "--run-id", "r1"], spark)
    cli.main([*neural, "--stand-ins"], spark)
    done = results.read()
    assert sorted((r.stem, r.run_id) for r in done.collect()) == [(stems[0], "r1"), (stems[1], "r1")]
    assert sorted(r.stem for r in UpsertTable(spark, at("esrs/coverage"), ["stem"]).read().collect()) == stems
    assert done.select("result.disclosures").first()[0][0].dr_code == "BP-1"
    sinks.append(spark.createDataFrame([("a", "u1", "http_403"), ("b", "u2", "success:referer"), ("c", "u3", "success")], "stem string, url string, status string"), at("log"), "1")
    cli.main(["worklist", "--log", at("log"), "--out", at("todo")], spark)
    assert [r.url for r in spark.read.option("header", True).csv(at("todo")).collect()] == ["u1"]
    assert {r.url for r in runs.worklist(spark, at("log"), at("todo2"), exact=True).collect()} == {"u1", "u2"}
    failed = runs.ask_models(spark, runs.TextOptions(at("summary"), at("texts"), at("llm")), ports.recorded({}, '{"disclosures":[{"dr_code":"E1-1","status":"reported"}]')).first()
    assert failed.avg_reported == 1.0


def test_neural_result(spark):
    reports = spark.createDataFrame([("r", "[[page:3]]\nGross Scope 1 emissions were measured in tCO2e, 124,500 tCO2e of them in scope 3. The double materiality of it was assessed with care by the board. E1-6 Gross GHG emissions of the year and more words 87"), ("empty", "short")], "stem string, text string")
    codes = files.taxonomy_of(spark, TAXONOMY)
    got = {r.stem: r.result for r in D.neural(reports, codes, ports.embed(ports.hashed_embedder(512)), ports.entailment(ports.overlap_entailment), ports.answer(ports.number_answerer)).collect()}
    assert got["empty"].disclosures is None and got["empty"].document_meta is None
    r = got["r"]
    assert r.document_meta.index_rows_filtered == 1 and r.materiality_assessment.method_described and not r.document_meta.iro2_index_present
    ds = {d.dr_code: d for d in r.disclosures}
    assert [d.dr_code for d in r.disclosures] == [c.dr_code for c in codes.orderBy("line").collect()]
    e = ds["E1-6"]
    # The first number of the context is the 1 of Scope 1, which no quantity is.
    assert (e.status, e.evidence[0].page, e.datapoints, e.quality_flags) == ("reported", 3, [], ["value_rejected_implausible", "value_not_parsed"])
    flat = {r.stem: r for r in M.flat_results(D.neural(reports, codes, ports.embed(ports.hashed_embedder(512)), ports.entailment(ports.overlap_entailment))).collect()}
    assert flat["empty"].n_disclosures == 0 and flat["empty"].avg_confidence is None and flat["r"].n_disclosures == 9


def test_ports_isolate_bad_texts(spark):
    def picky(texts):
        if "bad" in texts:
            raise ValueError("no")
        return [("yes", 0.9) for _ in texts]

    df = spark.createDataFrame([("good",), ("bad",), ("fine",), (None,)], "t string").coalesce(1)
    assert [(r.c.label, r.c.error) for r in df.select(ports.classify(lambda: picky)("t").alias("c")).collect()] == [("yes", None), (None, "no"), ("yes", None), ("yes", None)]
    sizes = []

    def longest(texts):
        sizes.append([len(t) for t in texts])
        return [0.5] * len(texts)

    ports._batched(longest, ["a", "abc", "ab", ""], len, 2)
    assert sizes == [[3, 2], [1, 0]]
    spans = df.select(ports.answer(ports.number_answerer)(F.lit("q"), F.concat(F.coalesce("t", F.lit("")), F.lit(" has 12 tonnes"))).alias("a")).collect()
    assert spans[0].a.span == "12 tonnes" and spans[0].a.score == 1.0
    assert df.select(ports.answer(ports.number_answerer)(F.lit("q"), "t").alias("a")).first().a.span is None


def test_providers():
    assert ports.provider("ollama", "m", environment={}).key == "ollama"
    assert ports.provider("groq", "m", environment={"GROQ_API_KEY": "k"}, base_url="http://x").base_url == "http://x"
    with pytest.raises(ValueError, match="HF_TOKEN"):
        ports.provider("hf", "m", environment={})
    seen = []

    def send(server, request):
        seen.append("response_format" in request)
        if seen[-1]:
            raise RuntimeError("Response_Format is not supported")
        return request["messages"][1]["content"]

    assert ports.chat(send, ports.provider("vllm", "m", environment={}), "system")()("hello") == "hello" and seen == [True, False]


def test_merge_order_and_single_chunks(spark):
    raw = [("one", 0, '{"disclosures":[{"dr_code":"A","status":"reported"}],"coverage_summary":{"esrs2_complete":true,"material_drs_reported":7}}'), ("two", 0, '{"document_meta":{"assurance":"x"},"disclosures":[{"dr_code":null,"status":"s"},{"dr_code":"B","confidence":0.2},{"dr_code":"A","confidence":0.9}]}'), ("two", 1, '{"disclosures":[{"dr_code":"B","status":"reported","confidence":0.2},{"dr_code":"C"}],"materiality_assessment":{"material_topics":["E1"]},"document_meta":{"assurance":"y"}}')]
    good, _ = M.parsed(spark.createDataFrame(raw, "stem string, chunk_no int, raw string"))
    got = {r.stem: r.result for r in M.merged(good).collect()}
    assert got["one"].coverage_summary.material_drs_reported == 7
    two = got["two"]
    assert [d.dr_code for d in two.disclosures] == ["B", "A", "C", None] and two.disclosures[0].status is None and two.document_meta.assurance == "y"
    assert two.coverage_summary.material_drs_reported == 0 and not two.coverage_summary.esrs2_complete


def test_ranks_and_quantiles(spark):
    rng = np.random.default_rng(3)
    values = [float(v) for v in rng.integers(0, 40, 500)] + [float(v) for v in rng.normal(size=300)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)] + [(900, None)], "i int, v double")
    order = sorted(values)
    want = {v: (order.index(v) + 1 + len(order) - order[::-1].index(v)) / 2 for v in values}
    for buckets in (256, 3, 1):
        assert all(r["rank"] == (None if r.v is None else want[r.v]) for r in R.ranked(df, "v", buckets).collect())
    q = R.quantiles(df, "v", {"a": 0.0, "b": 0.05, "c": 0.5, "d": 1.0}).first()
    assert list(q) == pytest.approx(np.quantile(values, [0, 0.05, 0.5, 1]).tolist())
    none = R.rank_sum_test(df.where("i < 0"), "v", F.col("i") > 1).first()
    assert none.n_true == 0 and none.u is None
    assert R.quantiles(df.where("i < 0"), "v", {"a": 0.5}).first().a is None


def test_round_robin_in_lots(spark):
    df = spark.range(500).select(F.when(F.col("id") % 3 > 0, "hot").otherwise("x").alias("h"), "id")
    got = {r.id: r for r in R.round_robin(df, "h", "id", gap=2.0, lots=7).collect()}
    seen = {}
    for i in range(500):
        h = "hot" if i % 3 else "x"
        seen[h] = seen.get(h, 0) + 1
        assert (got[i].turn, got[i].first_ordinal, got[i].start_after) == (seen[h], 1 if h == "hot" else 0, 2.0 * (seen[h] - 1))
    assert R.round_robin(df.limit(0), "h", "id").count() == 0


def test_top_similarities_in_blocks(spark):
    rng = np.random.default_rng(2)
    rows = [(f"r{i % 3}", i, rng.normal(size=8).tolist()) for i in range(90)] + [("r0", 200, None)]
    rows += [("r1", 300 + i, rows[1][2]) for i in range(4)]  # ties
    s = spark.createDataFrame(rows, "stem string, sentence_idx int, embedding array<double>").repartition(5)
    a = spark.createDataFrame([(f"t{i}", rng.normal(size=8).tolist()) for i in range(4)], "topic string, anchor_embedding array<double>")
    got = {(r.stem, r.topic, r.sentence_idx, round(r.sim, 9), r["rank"]) for r in S.top_similarities(s, a, "stem", "topic", 5).collect()}
    want = {(r.stem, r.topic, r.sentence_idx, round(r.sim, 9), r["rank"]) for r in R.top_per_group(S.similarities(s.where("embedding is not null"), a), ["stem", "topic"], 5, F.desc("sim"), "sentence_idx").select("stem", "topic", "sentence_idx", "sim", "rank").collect()}
    assert got == want and len(got) == 60
    with pytest.MonkeyPatch.context() as m:
        m.setattr(S, "MOST_ANCHORS", 3)
        with pytest.raises(ValueError, match="anchors"):
            S.top_similarities(s, a, "stem", "topic")
        with pytest.raises(ValueError, match="anchors"):
            S.similarities(s, a)


def test_sources_that_fail(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="no prompt"):
        files.prompt(str(tmp_path / "none.md"))
    with pytest.raises(Exception, match="no list of reports"):
        devalue.reports(spark.createDataFrame([("<html>",)], "body string"), "id string", required=True).collect()
    results, bad = sinks.split_failures(spark.createDataFrame([("a", None), ("b", "no")], "stem string, error string"))
    assert [r.stem for r in results.collect()] == ["a"] and [r.error for r in bad.collect()] == ["no"]
    deep = "https://x.com/a.pdf"
    for _ in range(5):
        deep = "https://www.google.com/url?url=" + deep.replace("%", "%25").replace(":", "%3A").replace("/", "%2F").replace("?", "%3F").replace("=", "%3D")
    assert spark.createDataFrame([(deep,)], "u string").select(U.clean_url(F.col("u"))).first()[0] == "https://x.com/a.pdf"
    assert spark.range(1).select(X.safe_name(F.lit("A/b c" * 20))).first()[0] == ("A_b_c" * 20)[:60]
    assert I.FILLED[0] == "doc_id"
