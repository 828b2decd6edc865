"""Queries against their SQL on the smallest tables, and the plans that SQL can't express."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tessera.operators import disclosure as D, merge as M, relational as R
from tessera.plans.queries import QUERIES, SQL
from tessera.sources import files
from tessera.streaming import incremental

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return round(float(v), 6) if type(v).__name__ == "Decimal" else v


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    result = duck.execute(SQL[name])
    names = [d[0] for d in result.description]
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall()), key=repr)
    assert sorted(names) == columns and got == want and got


def test_registry(spark):
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).limit(1).count() == 1


def test_top_k_is_limited_before_the_shuffle(spark):
    plan = QUERIES["key_sentences"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Python" not in plan and "ReadSchema: struct<o_orderkey" in plan


def test_disclosures(spark):
    taxonomy = files.taxonomy_of(spark, "### ESRS 2 — G\n- `BP-1` — Basis\n### ESRS E1 — C\n- `E1-4` — Targets of climate\n- `E1-6` — Gross emissions\n- `E1-9` — Effects\n### ESRS E2 — P\n- `E2-1` — Policies")
    reports = spark.createDataFrame([("r",), ("empty",)], "stem string")
    said = ["Scope 1 emissions were 124,500 tCO2e against the baseline of 2019.", "Our targets for the climate are set without numbers at all.", "This is given under the phase-in provision of the standard."]
    sentences = spark.createDataFrame([("r", i, i + 1, s) for i, s in enumerate(said)], "stem string, sentence_idx int, page int, sentence string")
    sims = spark.createDataFrame([("r", "E1-6", 0, 0.6), ("r", "E1-4", 1, 0.9), ("r", "E1-9", 2, 0.5), ("r", "E2-1", 1, 0.2)], "stem string, dr_code string, sentence_idx int, sim double")
    entail = spark.createDataFrame([("r", "E1-6", 0, 0.6), ("r", "E1-4", 1, 0.7), ("r", "E1-9", 2, 0.2)], "stem string, dr_code string, sentence_idx int, score double")
    answers = spark.createDataFrame([("r", "E1-6", "124,500 tCO2e", 0.8)], "stem string, dr_code string, span string, score double")
    got = {(r.stem, r.dr_code): r for r in D.disclosures(reports, taxonomy, sentences, sims, entail, answers).collect()}
    assert len(got) == 10 and all(got["empty", c].status == "not_addressed" for c in ("BP-1", "E1-6"))
    e16 = got["r", "E1-6"]
    assert (e16.status, e16.confidence, e16.page, e16.quality_flags) == ("reported", 0.78, 1, ["scope_3_not_in_evidence"])
    assert (e16.datapoint.value, e16.datapoint.unit, e16.datapoint.baseline_year) == (124500.0, "tCO2e", 2019)
    assert got["r", "E1-4"].quality_flags == ["target_without_baseline"] and got["r", "E1-9"].status == "phase_in_deferred" and got["r", "E2-1"].status == "not_addressed"


def test_chunks_merge_and_flatten(spark):
    parts = spark.createDataFrame([("r", i, "x" * 40) for i in range(3)], "stem string, page int, text string")
    assert [len(r.text) for r in R.packed_parts(parts, "stem", "page", "text", 100).orderBy("chunk").collect()] == [82, 40]
    raw = [("r", 0, '{"disclosures":[{"dr_code":"BP-1","status":"reported","confidence":0.4,"quality_flags":["b"]},{"dr_code":null,"status":"not_addressed"}]}'), ("r", 1, 'Here: {"disclosures":[{"dr_code":"BP-1","status":"not_addressed","confidence":0.9,"datapoints":[{"name":"a","value":1}],"quality_flags":["b","a"]}'), ("s", 0, "sorry")]
    good, bad = M.parsed(spark.createDataFrame(raw, "stem string, chunk_no int, raw string"))
    merged = M.best_disclosures(M.exploded(good))
    flat = M.flatten(merged.withColumn("quality_flags", F.coalesce("quality_flags", F.array().cast("array<string>")))).first()
    assert (flat.n_disclosures, flat.n_reported, flat.n_not_addressed, flat.n_datapoints, flat.quality_flags, flat.avg_confidence) == (2, 0, 2, 1, "a|b", 0.9)
    assert [r.stem for r in bad.collect()] == ["s"]


def test_stream_twice_is_once(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    df = spark.read.parquet(f"{SF}/events.parquet").select("event_id", "event_type", "value")
    df.where("event_id < 500").write.parquet(source)

    def run():
        stream = incremental.arriving(spark, source, df.schema, files=1)
        incremental.run_once(stream, lambda b: b.withColumn("double", F.col("value") * 2), ["event_id"], out, check)

    run()
    run()
    df.where("event_id >= 400").write.mode("append").parquet(source)
    run()
    assert spark.read.parquet(out).count() == spark.read.parquet(out).select("event_id").distinct().count() == df.count()
