"""Plans whose tasks must not grow with the input."""

import random
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.functions import text as X
from tessera.operators import disclosure as D, keywords as K, language as G, merge as M, nearest as N, ports, relational as R, semantic as S, tables as B
from tessera.plans import extraction as E, queries as Q, scaling as P
from tessera.streaming import stateful

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_profiles_are_ranked_inside_their_rows(spark):
    docs = spark.createDataFrame([(1, "wind wind solar carbon solar board and tea tea tea " * 3 + "."), (2, ""), (3, None)], "doc_id int, text string")
    got = {r.doc_id: r for r in K.profile(docs).collect()}
    words = Counter("wind wind solar carbon solar board tea tea tea".split() * 3)
    assert [(w.word, w.n) for w in got[1].top_keywords_full] == words.most_common() and got[1].env_sentences
    assert all(got[k].top_keywords_full == [] and got[k].gov_sentences == [] for k in (2, 3))
    df = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    assert "Exchange" not in plan(K.profile(df)) and "Exchange" not in plan(K.document_keywords(df))


def test_words_of_equal_counts_by_first_place(spark):
    df = spark.createDataFrame([(["b", "a", "a", "c", "b", "d"],), ([],), (None,)], "w array<string>")
    got = [r.t and [tuple(x) for x in r.t] for r in df.select(X.top_words(F.col("w"), 3).alias("t")).collect()]
    assert got == [[("b", 2), ("a", 2), ("c", 1)], [], None]


def test_tables_are_dealt_out_by_their_rows(spark, monkeypatch):
    monkeypatch.setattr(Q, "REPORTS", 100)
    n = spark.read.parquet(f"{SF}/orders.parquet").count()
    assert Q._reports(spark, SF).rdd.getNumPartitions() == -(-n // 100)
    assert Q._spread(spark.range(100, numPartitions=5), 10).rdd.getNumPartitions() == 10


def test_no_task_holds_the_texts_that_it_deals_out(spark, monkeypatch):
    assert "RoundRobin" not in plan(Q._documents(spark, SF))
    monkeypatch.setattr(Q, "PARTS", 9)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    dealt = Q._spread(docs, 1, "doc_id")
    assert "hashpartitioning(doc_id" in plan(dealt) and dealt.rdd.getNumPartitions() == 9
    assert sorted(dealt.collect()) == sorted(docs.collect())
    assert Q._spread(spark.range(1000, numPartitions=5), 1).rdd.getNumPartitions() == 9


def test_parts_of_a_file_that_hold_nothing_do_not_count(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")  # one row group
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        whole = Q._t(spark, str(tmp_path), "documents")
        assert whole.rdd.getNumPartitions() > 8 and whole.select(F.spark_partition_id()).distinct().count() == 1
        dealt = Q._documents(spark, str(tmp_path))
        assert dealt.select(F.spark_partition_id()).distinct().count() == 4 and sorted(dealt.collect()) == sorted(docs.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    uneven = spark.range(100, numPartitions=1).union(spark.range(3, numPartitions=3))
    assert "Exchange" in plan(Q._spread(uneven)) and "Exchange" not in plan(Q._spread(spark.range(100, numPartitions=4)))


def test_rows_without_doc_id_do_not_meet_in_one_task(spark, tmp_path):
    df = spark.range(200).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"), F.lit("en").alias("lang"))
    df.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    held = Q._documents(spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()
    assert len(held) == 4 and max(r["count"] for r in held) < 100


def test_sentences_are_split_once_however_many_are_picked(spark):
    df = spark.createDataFrame([("One sentence that is long enough stands here. " * 30,)], "text string")
    thin = df.select(X.plain_sentences(F.col("text"), cap=10).alias("s"))
    assert len(thin.first().s) == 10 and thin._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1


def test_results_of_a_report_are_merged_in_one_shuffle(spark):
    rows = [("s", i, '{"disclosures":[{"dr_code":"A","confidence":0.%d},{"dr_code":null,"status":"n%d"}]}' % (i, i)) for i in range(3)]
    merged = M.merged(M.parsed(spark.createDataFrame(rows, "stem string, chunk_no int, raw string"))[0])
    assert [(d.dr_code, d.confidence, d.status) for d in merged.first().result.disclosures] == [("A", 0.2, None), (None, None, "n0"), (None, None, "n1"), (None, None, "n2")]
    assert plan(merged).count("Exchange hashpartitioning") <= 2  # one of each of the two branches


def test_ruled_tables_broadcast_no_rows_of_pages(spark):
    square = [(0.0, 0.0, 9.0, 0.0), (0.0, 9.0, 9.0, 9.0), (0.0, 0.0, 0.0, 9.0), (9.0, 0.0, 9.0, 9.0)]
    rules = spark.createDataFrame([("a", 1, *r) for r in square], "stem string, page int, x0 double, y0 double, x1 double, y1 double")
    words = spark.createDataFrame([("a", 1, 5.0, 5.0, "w")], "stem string, page int, x double, y double, text string")
    points = B.crossings(B.segments(rules))
    assert all("Broadcast" not in plan(df) for df in (points, B.cells(points), B.grids(rules, words)))
    assert B.grids(rules, words).first().tables == [[["w"]]]


def test_top_similarities_of_many_reports_in_one_batch(spark):
    rows = [(f"r{i % 7}", i, [float(i % 3), float(i % 5)]) for i in range(140)]
    anchors = [("a", [1.0, 0.0]), ("b", [0.5, 0.25])]
    got = {tuple(r) for r in S.top_similarities(spark.createDataFrame(rows, "stem string, sentence_idx int, embedding array<float>"), spark.createDataFrame(anchors, "dr_code string, anchor_embedding array<float>"), "stem", "dr_code", 4).collect()}
    want = set()
    for stem in {r[0] for r in rows}:
        for code, v in anchors:
            best = sorted((-(x[0] * v[0] + x[1] * v[1]), i) for s, i, x in rows if s == stem)[:4]
            want |= {(stem, code, i, -s, n) for n, (s, i) in enumerate(best, 1)}
    assert got == want


@pytest.mark.parametrize("name", ["gathered_extraction", "status_stream"])
def test_lots_arrive_in_as_many_files_as_their_rows_need(spark, monkeypatch, name):
    seen = []

    def arriving(state, path, schema, files):
        seen.append((files, int(state.conf.get("spark.sql.shuffle.partitions"))))
        raise InterruptedError

    monkeypatch.setattr(P, "ARRIVING", 100)
    monkeypatch.setattr(P.incremental, "arriving", arriving)
    with pytest.raises(InterruptedError):
        Q.QUERIES[name](spark, SF)
    assert seen[0][0] >= 10 and seen[0][1] >= 10


def test_places_of_values_that_differ_whenever_they_are_computed(spark):
    shaken = F.udf(lambda i: i + random.choice((0.0, 1e-9, 2e-9)), "double").asNondeterministic()
    df = spark.range(2001).select("id", shaken("id").alias("v"))
    q = R.quantiles(df, "v", {"low": 0.05, "half": 0.5, "high": 0.95}).first()
    assert [round(x, 6) for x in q] == [100, 1000, 1900]
    assert all(r["rank"] == r["id"] + 1 for r in R.ranked(df, "v").collect())


def test_right_tiles_are_sent_once_for_each_lot_of_left_tiles(spark, monkeypatch):
    rows = [(i, [float(i * 7 % 11), float(i % 5), float(i % 3)]) for i in range(400)]
    df = spark.createDataFrame(rows, "i int, embedding array<double>")
    sent, products = [], N._products
    monkeypatch.setattr(N, "_products", lambda pairs, *rest: sent.append((pairs.count(), products(pairs, *rest))) or sent[-1][1])
    got = {(r.i, r.j, r.sim) for r in N.top_products(df, df.withColumnRenamed("i", "j"), "i", "j", 3, tile=10).collect()}
    want = {(i, j, -s) for i, x in rows for s, j in sorted((-(x[0] * y[0] + x[1] * y[1] + x[2] * y[2]), j) for j, y in rows)[:3]}
    assert got == want
    assert sent[1][1].count() <= 1200 and sent[1][0] > 100  # of all pairs only the best of each row leave a task


def test_texts_are_cut_up_once_for_all_languages(spark):
    rows = [(1, "en", "the man and the dog and \U00010428\U00010429\U0001042a the man"), (1, "en", "The dog!"), (2, "de", "der Mann und der Hund, der Hund")]
    docs = spark.createDataFrame(rows, "doc_id int, lang string, text string")
    profiles = G.fit(docs)
    grams = Counter(t[i : i + 3] for t in (" der mann und der hund der hund ",) for i in range(len(t) - 2))
    assert {r.gram for r in profiles.where("lang = 'de'").collect()} == set(grams)
    assert "\U00010428\U00010429\U0001042a" in {r.gram for r in profiles.collect()} and all(len(r.gram) == 3 for r in profiles.collect())
    some, none = G.scores(docs, profiles, "doc_id"), G.scores(docs, profiles, "doc_id", most=0)
    assert some.collect() and sorted(some.collect()) == sorted(none.collect())
    assert some._jdf.queryExecution().optimizedPlan().toString().count("Generate explode(regexp_extract_all") == 1


def test_keywords_behind_one_first_letter_count_the_same(spark):
    words = sorted({w for t in X.L.THEMES.values() for w in t})
    texts = [" ".join(random.Random(i).choices([*words, "WIND", "winds", "window", "Scope 1,", "co", "c", "anti-corruption's", "-", "Ωind", "e1"], k=60)) for i in range(40)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for said in (*X.L.THEMES.values(), ["", "a"], ["É", "é-1", "e.x", "ex"]):
        counts = df.select(X.hits(F.col("text"), said).alias("n"), F.regexp_count("text", F.lit(X.L.keyword_pattern(said))).alias("m")).collect()
        assert all(r.n == r.m for r in counts)
    assert X.L.keyword_search(["carbon", "climate", "wind"]) == r"(?i)\b(?:c(?:arbon\w*|limate\w*)|w(?:inds?\b))"


def test_reports_of_a_lot_are_gathered_by_one_call_of_the_state():
    class State:
        value, calls = None, 0

        def get(self):
            self.calls += 1
            return self.value

        def update(self, value):
            self.calls, self.value = self.calls + 1, value

    class Handle:
        timers: list = []

        def getValueState(self, name, schema):
            return State()

        def registerTimer(self, at):
            self.timers.append(at)

        def deleteTimer(self, at):
            self.timers.remove(at)

    class Times:
        def getCurrentWatermarkInMs(self):
            return 0

    gather = stateful.Gather(1000)
    gather.init(Handle())
    rows = [dict(lot=1, stem=f"s{i}", chunk_no=n, chunks=2, raw=f"{i}{n}", error=None, answered_at=i) for i in range(100) for n in (0, 1)]
    first, second = rows[: 2 * 50] + rows[100::2], rows[101::2] + rows[:3]
    got = [[r[:3] for f in gather.handleInputRows((1,), iter([pd.DataFrame(lot)]), Times()) for r in f.itertuples(index=False, name=None)] for lot in (first, second)]
    assert got[0] == [(f"s{i}", n, f"{i}{n}") for i in range(50) for n in (0, 1)]
    assert got[1] == [(f"s{i}", n, f"{i}{n}") for i in range(50, 100) for n in (0, 1)]  # what came again is late
    assert gather.held.calls == 4 and gather.handle.timers == [1000]


def test_sentences_of_a_report_are_shuffled_no_more_than_its_hits(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(D.scratch, "table", lambda df, name="table", write=D.scratch.table: seen.append((name, plan(df))) or write(df, name))
    text = "Before any page the gross Scope 1 emissions were measured in tCO2e. [[page:3]] Gross Scope 1 emissions were measured in tCO2e, 124,500 of them. Energy use and the baseline year is 2019 here."
    reports = spark.createDataFrame([("r", text), ("again", text), ("empty", "short"), ("none", None)], "stem string, text string")
    got = {r.stem: r.result for r in D.neural(reports, E.taxonomy(spark), ports.embed(ports.hashed_embedder(256)), ports.entailment(ports.overlap_entailment), ports.answer(ports.number_answerer)).collect()}
    assert got["empty"].disclosures is None and got["none"].disclosures is None and got["r"] == got["again"]
    said = {d.dr_code: d for d in got["r"].disclosures}
    assert (said["E1-6"].status, said["E1-6"].evidence[0].page, said["E1-5"].evidence[0].page) == ("reported", None, 3)
    # The texts stay in their rows; hits are dealt out, and once more after each model.
    (_, base), (_, found) = seen
    assert "Exchange" not in base and found.count("Exchange hashpartitioning") <= 3 and "SortMergeJoin" not in found


def test_a_text_that_comes_several_times_is_embedded_once(spark, tmp_path):
    def model():
        def run(texts):
            with open(tmp_path / "asked", "a") as f:
                f.write("".join(t + "\n" for t in texts))
            return [[float(len(t)), 1.0] for t in texts]

        return run

    df = spark.createDataFrame([("aa",), ("b",), ("aa",), (None,), ("aa",)], "t string").coalesce(1)
    got = [r.v for r in df.select(ports.embed(model)("t").alias("v")).collect()]
    assert got[0] == got[2] == got[4] != got[1] and sorted((tmp_path / "asked").read_text().split("\n")) == ["", "", "aa", "b"]
