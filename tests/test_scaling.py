"""Ruled tables, language profiles, products of two large tables, grouping sets, watermarked status and variant results."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import language as G, merge as M, nearest as N, relational as R, tables as B
from tessera.sources.upserts import UpsertTable
from tessera.streaming import incremental, stateful

RULES, WORDS = "stem string, page int, x0 double, y0 double, x1 double, y1 double", "stem string, page int, x double, y double, text string"


def grid_lines(x, y):
    return [(x[0], v, x[-1], v) for v in y] + [(v, y[0], v, y[-1]) for v in x]


def test_ruled_tables(spark):
    two = grid_lines([0, 100, 200], [0, 20, 40]) + grid_lines([0, 60, 300], [100, 120, 140, 160])
    # The second row of the third table is one wide cell, the first column one high cell; lines are drawn in pieces, askew.
    merged = [(0, 0, 100, 1), (98, 0, 301, 0), (100, 20.5, 300, 20), (0, 40, 300, 41), (0, 0, 0.5, 40), (100, 0, 100, 19), (100, 18, 100, 40), (200, 0, 200, 21), (300, 0, 300, 40)]
    only = [(0, 0, 100, 0), (0, 50, 100, 50), (50, 60, 50, 90), (3, 3, 3, 3), (0, 0, 90, 90), (None, 0, 1, 1)]
    rules = [("a", 1, *map(float, r)) for r in two] + [("a", 2, *map(float, r)) for r in merged] + [("b", 1, *[None if v is None else float(v) for v in r]) for r in only]
    words = [("a", 1, 10.0, 10.0, "one"), ("a", 1, 40.0, 10.0, "more"), ("a", 1, 150.0, 30.0, "x"), ("a", 1, 500.0, 500.0, "away"), ("a", 1, 70.0, 150.0, "low"), ("a", 2, 50.0, 30.0, "high"), ("a", 2, 250.0, 30.0, "wide"), ("a", 2, 250.0, 10.0, "top"), ("b", 1, 10.0, 10.0, "no table")]
    got = {(r.stem, r.page): r.tables for r in B.grids(spark.createDataFrame(rules, RULES), spark.createDataFrame(words, WORDS)).collect()}
    assert got == {
        ("a", 1): [[["one more", ""], ["", "x"]], [["", ""], ["", ""], ["", "low"]]],
        ("a", 2): [[["high", "", "top"], ["", "wide", ""]]],
    }
    assert B.grids(spark.createDataFrame([], RULES), spark.createDataFrame(words, WORDS)).collect() == []


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", "text")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    profiles = G.fit(docs.where(~held))
    assert profiles.groupBy("lang").count().agg(F.max("count")).first()[0] <= G.PROFILE
    got = G.detected(docs.where(held), profiles, "doc_id").withColumnRenamed("lang", "found").join(docs, "doc_id").where("found <> 'unknown'")
    right, n = got.agg(F.count_if(F.col("found") == F.col("lang")), F.count("*")).first()
    assert n > 250 and right / n > 0.97, (right, n)
    plan = G.detected(docs, profiles, "doc_id")._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_language_edges(spark):
    fit = spark.createDataFrame([("en", "the man and the dog " * 9), ("de", "der Mann und der Hund " * 9), (None, "x"), ("fr", None), ("fr", "")], "lang string, text string")
    profiles = G.fit(fit)
    assert {r.lang for r in profiles.select("lang").distinct().collect()} <= {"en", "de", "fr"}
    docs = [(1, "The dog, the man AND the dog!" * 3), (2, "der hund und der mann " * 3), (3, None), (4, ""), (5, "12 34 !"), (6, "the"), (None, "und der hund und der mann"), (7, "the man and the dog " * 20_000)]
    got = {r.k: (r.lang, r.known, r.score) for r in G.detected(spark.createDataFrame(docs, "k int, text string"), profiles, "k").collect()}
    assert {k: v[0] for k, v in got.items()} == {1: "en", 2: "de", 3: "unknown", 4: "unknown", 5: "unknown", 6: "unknown", None: "de", 7: "en"}
    assert got[4] == ("unknown", 0, None) and got[7][1] == 400_000
    # The score is the sum of the weights, trigram by trigram.
    own = {(r.lang, r.gram): r.gain + r.floor for r in profiles.collect()}
    floor = {r.lang: r.floor for r in profiles.collect()}
    known = {g for _, g in own}
    text = " der hund und der mann der hund und der mann der hund und der mann "
    grams = [text[i : i + 3] for i in range(len(text) - 2)]
    assert got[2] == ("de", sum(g in known for g in grams), sum(own.get(("de", g), floor["de"]) for g in grams if g in known))


def brute_products(left, right, k):
    out = set()
    for i, x in left:
        sims = []
        for j, y in right:
            s = 0.0
            for a, b in zip(x, y, strict=True):
                s += a * b
            sims.append((-s, j))
        out |= {(i, j, -s, n) for n, (s, j) in enumerate(sorted(sims)[:k], 1)}
    return out


@pytest.mark.parametrize(("tile", "most"), [(2048, 16_384), (7, 16_384), (7, 3)])
def test_products_of_two_tables_by_tiles(spark, monkeypatch, tile, most):
    monkeypatch.setattr(N, "MOST_TILES", most)
    monkeypatch.setattr(N, "PIVOTS", 5)
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(4, 6)) * 3
    make = lambda n: [(int(i), (centres[i % 4] * rng.uniform(0.1, 2) + rng.normal(size=6) * 0.1).tolist()) for i in range(n)]
    left, right = make(60), make(90)
    right += [(500 + i, right[3][1]) for i in range(6)] + [(600, [0.0] * 6)]  # ties and no direction
    left += [(900, [0.0] * 6)]
    schema = "{} int, embedding array<double>"
    a = spark.createDataFrame(left + [(901, None)], schema.format("i")).repartition(3)
    b = spark.createDataFrame(right + [(None, [1.0] * 6)], schema.format("j")).repartition(4)
    got = {(r.i, r.j, r.sim, r["rank"]) for r in N.top_products(a, b, "i", "j", 4, tile=tile).collect()}
    assert got == brute_products(left, right, 4)


def test_products_of_few_rows(spark):
    schema = "{} string, embedding array<float>"
    a = spark.createDataFrame([("x", [1.0, 0.0])], schema.format("i"))
    b = spark.createDataFrame([("y", [0.5, 0.0]), ("z", [-1.0, 0.0])], schema.format("j"))
    assert [(r.i, r.j, r.sim, r["rank"]) for r in N.top_products(a, b, "i", "j").orderBy("rank").collect()] == [("x", "y", 0.5, 1), ("x", "z", -1.0, 2)]
    assert N.top_products(a, b.limit(0), "i", "j").collect() == [] and N.top_products(a.limit(0), b, "i", "j").collect() == []


def test_tiles_that_hold_none_of_the_best_are_skipped(spark, monkeypatch):
    rng = np.random.default_rng(1)
    centres = np.eye(8) * 10
    rows = [(i, (centres[i % 8] + rng.normal(size=8) * 0.01).tolist()) for i in range(800)]
    df = spark.createDataFrame(rows, "i int, embedding array<double>")
    seen, products = [], N._products
    monkeypatch.setattr(N, "PIVOTS", 32)
    monkeypatch.setattr(N, "_products", lambda pairs, *rest: seen.append(pairs.count()) or products(pairs, *rest))
    assert N.top_products(df, df.withColumnRenamed("i", "j"), "i", "j", 3, tile=50).count() == 2400
    tiles = seen[0]
    assert sum(seen) < tiles * tiles / 3, seen


def test_grouping_sets_read_rows_once(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", None, "y"), ("b", 1, "y"), (None, 2, None)], "k string, v int, d string")
    got = {(r.dimension, r.value, r.n, r.n_distinct) for r in R.profiled(df, ["k", "v"], F.col("d")).collect()}
    assert got == {("k", "a", 2, 2), ("k", "b", 1, 1), ("k", "None", 1, 0), ("v", "1", 2, 2), ("v", "2", 1, 0), ("v", "None", 1, 1), ("*", None, 4, 2)}
    plan = R.profiled(df, ["k", "v"], F.col("d"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Expand") == 1 and "Generate" not in plan
    assert {(r.dimension, r.value, r.n, r["rank"]) for r in R.value_counts(df, ["k", "v"], 1).collect()} == {("k", "a", 2, 1), ("v", "1", 2, 1)}


def test_state_of_a_status_stream_is_bounded(spark, tmp_path):
    state, arrive = stateful.state_session(spark, 2), str(tmp_path / "in")
    out = UpsertTable(spark, str(tmp_path / "out"), ["k"])
    sizes, want = [], {}
    for lot in range(6):
        # New keys every hour; a row comes half an hour late, one comes again, and one comes far too late.
        rows = [(f"k{lot}-{i % 5}", f"s{i}", lot * 3600 + i * 60) for i in range(20)]
        late = [(f"k{lot - 1}-0", "late", lot * 3600 - 900)] if lot else []
        lost = [("k0-0", "lost", 10)] if lot == 5 else []
        for k, s, t in rows + late:
            want[k] = max(want.get(k, (-1, "")), (t, s))
        spark.createDataFrame(rows + late + rows[:1] + lost, "k string, status string, t long").coalesce(1).select("k", "status", F.timestamp_seconds("t").alias("ts")).write.mode("append").parquet(arrive)
        stream = incremental.arriving(state, arrive, "k string, status string, ts timestamp", files=1)
        now = incremental.current_status(stream, ["k"], "ts", "status", "30 minutes", "1 hour")
        sizes.append(_run(now, out, str(tmp_path / "check")))
    end = spark.createDataFrame([("end", "s", 10**6)], "k string, status string, t long")
    for _ in range(2):
        end = end.withColumn("t", F.col("t") * 2)
        end.coalesce(1).select("k", "status", F.timestamp_seconds("t").alias("ts")).write.mode("append").parquet(arrive)
        _run(incremental.current_status(incremental.arriving(state, arrive, "k string, status string, ts timestamp", files=1), ["k"], "ts", "status", "30 minutes", "1 hour"), out, str(tmp_path / "check"))
    got = {r.k: (int(r.ts.timestamp()), r.status) for r in out.read().where("k <> 'end'").collect()}
    assert got == want
    assert max(sizes) <= 22 < len(want), sizes


def _run(stream, table, check):
    """As incremental.upsert(), and how many rows the state holds at its end."""
    query = stream.writeStream.outputMode("append").foreachBatch(lambda b, n: table.upsert(b, f"s-{n}", F.desc("ts"), F.desc("status"))).option("checkpointLocation", check).trigger(availableNow=True).start()
    query.awaitTermination()
    return query.lastProgress["stateOperators"][0]["numRowsTotal"]


def test_variants_keep_what_no_schema_names(spark):
    raws = ['{"a": 1, "b": "x", "c d": [1]}', '```json\n{"a": "12", "b": null}\n```', '{"a": {"n": 1}, "b": 7}', '{"a": 1.5}', "[1, 2]", '"text"', "nothing", None, '{"a": true, "b": ["x"]}']
    good, bad = M.variants(spark.createDataFrame([("s", i, r) for i, r in enumerate(raws)], "stem string, chunk_no int, raw string"))
    assert bad.count() == 2
    rows = {r.chunk_no: r for r in M.shredded(good, {"a": "bigint", "b": "string"}).withColumn("kept", F.to_json("v")).collect()}
    assert [rows[i].a for i in (0, 1, 2, 3)] == [1, 12, None, 1] and rows[2].b == "7" and json.loads(rows[0].kept)["c d"] == [1]
    assert rows[0].unknown == ["c d"] and rows[0].drift == [] and rows[1].drift == []
    assert [(d.field, d.found) for d in rows[2].drift] == [("a", "OBJECT<n: BIGINT>")]
    assert rows[4].a is None and rows[4].drift == [] and rows[4].unknown == []
    counted = {(r.field, r.found): r.n for r in M.drift_counts(M.shredded(good, {"a": "bigint", "b": "string"})).collect()}
    assert counted[("c d", "unknown")] == 1 and counted[("a", "OBJECT<n: BIGINT>")] == 1
