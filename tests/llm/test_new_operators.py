"""Source divergence, whitening and curve packing against brute force and exact round trips."""

import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import curve_packing, divergence, queries, whitening

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"


# --- 11

def brute_divergences(rows, least, top):
    """Every word of every pair of sources, one by one."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = [(lang or "", source or "", re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(lower))) for lang, source, text in rows]
    out = []
    for lang in {w[0] for w in words}:
        in_docs = Counter(t for g, _, w in words if g == lang for t in set(w))
        kept = [t for t, n in in_docs.items() if n >= least]
        counts = {s: Counter() for g, s, _ in words if g == lang}
        for g, s, w in words:
            if g == lang:
                counts[s].update(t for t in w if in_docs[t] >= least)
        whole = sum(counts.values(), Counter())

        def shares(c):
            total = sum(c.values())
            return {t: 1 + 1_000_000_000 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}

        q, p = shares(whole), {s: shares(c) for s, c in counts.items()}
        for s in counts:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in counts if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, items, limit in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, i) for i, (item, value) in enumerate(items[:limit], 1)]
    return sorted(out)


def divergence_rows(df):
    return sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in df.collect())


def word_rows(rng, n=160):
    vocabulary = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(90)] + ["Ünder", "straße", "日本", "naïve"]
    odds = 1 / np.arange(1, len(vocabulary) + 1)
    rows = []
    for i in range(n):
        lang = ["en", "en", "fr", "xx"][i % 4]
        # A hot source, and one whose words are all its own.
        source = "hot" if i % 3 == 0 else "own" if i % 11 == 0 else f"s{i % 5}"
        words = rng.choice(vocabulary, int(rng.integers(1, 40)), p=odds / odds.sum()) if lang != "xx" else [f"only{chr(97 + i % 26)}{chr(97 + i // 26)}"]
        words = [w + "q" for w in words] if source == "own" else words
        rows.append((lang, source, " 12.".join(w.upper() if k % 7 == 0 else w for k, w in enumerate(words))))
    return rows


@pytest.mark.parametrize("held", [300_000, 3])
def test_divergences_against_every_word_of_every_pair(spark, monkeypatch, held):
    monkeypatch.setattr(divergence, "HELD", held)
    rows = word_rows(np.random.default_rng(3))
    rows += [(None, None, None), ("en", None, ""), ("en", "empty", "12 34"), ("en", "hot", "and " * 50_000), (None, "s", "and and")] + rows[:20]
    df = spark.createDataFrame([(i, t, g, s, None) for i, (g, s, t) in enumerate(rows)], DOCS).repartition(5)
    clash = df.withColumn("term", F.lit(1)).withColumn("n", F.lit("x")).withColumn("p", F.lit(None).cast("int")).withColumn("rank", F.lit(0))
    got = divergence_rows(divergence.divergences(clash, 3, 6))
    assert got == brute_divergences(rows, 3, 6)
    assert any(r[2] == "pair" and r[4] == 0 for r in got) and any(r[1] == "empty" and r[4] > 0 for r in got)


def test_divergences_of_no_rows(spark):
    assert divergence_rows(divergence.divergences(spark.createDataFrame([], DOCS))) == []
    one = spark.createDataFrame([(1, "a b", "en", "s", 3)], DOCS)
    assert divergence_rows(divergence.divergences(one)) == []
    # One source alone has no other to differ from, and no share above its language's.
    assert divergence_rows(divergence.divergences(one, 1)) == []


def test_words_of_equal_counts_are_one_vector(spark):
    rows = [("en", f"s{i}", "alpha beta") for i in range(4)] + [("en", "s1", "gamma"), ("en", "s2", "delta")]
    kept = divergence.kept_counts(spark.createDataFrame([(i, t, g, s, 0) for i, (g, s, t) in enumerate(rows)], DOCS), 1)
    words, distinct = divergence.vectors(kept)
    assert {(r.term, r.vec) for r in words.collect()} == {("alpha", "alpha"), ("beta", "alpha"), ("gamma", "gamma"), ("delta", "delta")}
    assert {(r.vec, r.m, r.total) for r in distinct.collect()} == {("alpha", 2, 4), ("gamma", 1, 1), ("delta", 1, 1)}


def test_shares_are_exact_beyond_64_bits(spark):
    count, total, size = 10**15 + 7, 3 * 10**16 + 1, 10**9
    got = spark.range(1).select(divergence.share(F.lit(count), F.lit(total), F.lit(size))).first()[0]
    assert got == 1 + 10**9 * (count + 5) // (total + 5 * size)


def test_op11_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    got = divergence_rows(queries.op11_divergence(spark, SF))
    assert got and got == sorted(con.execute(f"select lang, source, part, item, value, rank from ({queries.ORACLE_SQL['op11_divergence']})").fetchall())


# --- 12

VECTORS = "vec_id long, embedding array<float>, label int"


def brute_whitening(vectors, count=8):
    """Whole numbers, exact sums, the covariance by fsum of products of centred entries."""
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(r[j] for r in x) for j in range(d)]
    y = [[n * r[j] - s[j] for j in range(d)] for r in x]
    v = np.array([[math.fsum(r[j] * r[k] for r in y) / n**3 for k in range(d)] for j in range(d)])
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:count], u[:, ::-1][:, :count]
    return [sum(c * c for c in r) for r in y], np.array(y, float) / n @ u / np.sqrt(e), e / np.trace(v)


def test_whitening_against_whole_numbers(spark):
    rng = np.random.default_rng(4)
    vectors = (rng.standard_normal((120, 12)) @ rng.standard_normal((12, 12)) / 5).astype(np.float32)
    rows = [(i, [float(c) for c in v], 0) for i, v in enumerate(vectors)]
    odd = [(900, None, 0), (901, [1.0, None] + [0.0] * 10, 0), (902, [float("nan")] + [0.0] * 11, 0), (903, [float("-inf")] + [0.0] * 11, 0), (904, [], 0), (905, [1.0] * 11, 0)]
    df = spark.createDataFrame(rows + odd, VECTORS).repartition(4)
    got = whitening.by_component(whitening.whiten(df.withColumn("x", F.lit("clash")).withColumn("n", F.lit(None).cast("int")))).collect()
    deviation, whitened, explained = brute_whitening(vectors)
    assert len(got) == 120 * 8 and {(r.vec_id, r.component) for r in got} == set(itertools.product(range(120), range(1, 9)))
    signs = {r.component: np.sign(r.whitened) * np.sign(whitened[0, r.component - 1]) for r in got if r.vec_id == 0}
    for r in got:
        assert (r.n, r.deviation) == (120, deviation[r.vec_id])
        assert abs(r.whitened * signs[r.component] - whitened[r.vec_id, r.component - 1]) < 1e-9
        assert abs(r.explained - explained[r.component - 1]) < 1e-12 and r.identity_error < 1e-9


def test_whitening_of_few_equal_and_repeated_rows(spark):
    def run(rows):
        return whitening.by_component(whitening.whiten(spark.createDataFrame(rows, VECTORS))).collect()

    assert run([]) == [] and run([(1, None, 0), (2, [], 0)]) == []
    alone = run([(1, [0.5, 0.25, 0.0], 0)])
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in alone] == [(i, 1, 0, 0.0, 0.0, 0.0) for i in (1, 2, 3)]
    line = run([(i, [i / 8, i / 4], 0) for i in range(9)] + [(None, [0.0, 0.0], 0), (3, [3 / 8, 3 / 4], 0)])
    assert len(line) == 22 and {r.whitened for r in line if r.component == 2} == {0.0}
    assert sum(r.vec_id is None for r in line) == 2 and abs(next(r.explained for r in line) - 1) < 1e-9
    # Of two lengths that are equally frequent the longer one is taken.
    assert {r.vec_id for r in run([(1, [1.0], 0), (2, [1.0, 2.0], 0)])} == {2}


def test_deviations_beyond_64_bits_are_exact(spark):
    vectors = [[1e9 * i, -1e9 * i * i] for i in range(40)]
    df = spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], VECTORS)
    deviation, _, _ = brute_whitening(vectors)
    rows = whitening.whiten(df)
    assert {r.vec_id: int(r.deviation) for r in rows.collect()} == dict(enumerate(deviation)) and max(deviation) > 2**63
    assert all(r.deviation is None or r.deviation == deviation[r.vec_id] for r in whitening.by_component(rows).collect())


def test_op12_on_all_embeddings(spark):
    own = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    deviation, whitened, _ = brute_whitening([r.embedding for r in own])
    got = {(r.vec_id, r.component): r for r in queries.op12_whitening(spark, SF).collect()}
    assert len(got) == 8 * len(own)
    for i, r in enumerate(own):
        assert got[r.vec_id, 1].deviation == deviation[i]
        assert all(abs(abs(got[r.vec_id, k + 1].whitened) - abs(whitened[i, k])) < 1e-7 for k in range(8))


# --- 13

@pytest.mark.parametrize(("sides", "bits"), [(2, 3), (3, 2), (4, 2)])
def test_curve_visits_all_points_step_by_step(sides, bits):
    points = list(itertools.product(range(1 << bits), repeat=sides))
    by_key = dict(zip(curve_packing.hilbert_keys(np.array(points), bits).tolist(), points, strict=True))
    assert sorted(by_key) == list(range(len(points)))
    line = np.array([by_key[i] for i in range(len(points))])
    assert (np.abs(np.diff(line, axis=0)).sum(1) == 1).all()


def check_packing(got, texts, capacity=1024):
    """Pieces give back every document's ids, and sequences have no gaps and no padding."""
    tok = Tokenizer.from_file(PATH)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(texts)
    for doc_id, text in texts.items():
        ids, at = np.array(tok.encode(text or "", add_special_tokens=False).ids + [0], "<u4"), 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
            assert zlib.crc32(ids[at : at + r.length].tobytes()) == r.ids_crc32
            at += r.length
        assert at == len(ids)
    for rows in sequences.values():
        end = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == end
            end += r.length
        assert end <= capacity and (end == capacity or end & (end - 1) == 0)
    return sequences


@pytest.mark.parametrize("range_tokens", [4_000_000, 3_000])
def test_curve_packing_round_trip(spark, monkeypatch, range_tokens):
    monkeypatch.setattr(curve_packing, "RANGE_TOKENS", range_tokens)
    monkeypatch.setattr(curve_packing, "ROW_TOKENS", 700)
    rng = np.random.default_rng(1)
    texts = {i: " ".join(rng.choice([f"word{k}" for k in range(300)], int(rng.integers(0, 900)))) for i in range(60)}
    texts |= {100: None, 101: "", 102: " é日本\x00 ", 103: "long " * 20_000} | {200 + i: "the same text again " * 30 for i in range(40)}
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in texts.items()], DOCS).repartition(4)
    got = curve_packing.pack(df.withColumn("key", F.lit("clash")).withColumn("ids", F.lit(1)), PATH).collect()
    sequences = check_packing(got, texts)
    # Ends of ranges cost a few sequences and nothing else does.
    ranges = {i >> 40 for i in sequences}
    assert len(sequences) <= sum(r.length for r in got) // 1024 + 10 * len(ranges)
    assert len(ranges) > 5 if range_tokens == 3_000 else len(ranges) == 1


def test_curve_packing_edges(spark):
    assert curve_packing.pack(spark.createDataFrame([], DOCS), PATH).collect() == []
    rows = [(None, "a b", "", "", 0), (None, "a b", "", "", 0), (5, "c", "", "", 0), (5, "c", "", "", 0), (5, "other", "", "", 0)]
    got = curve_packing.pack(spark.createDataFrame(rows, DOCS), PATH).collect()
    assert sum(r.length for r in got) == 3 + 3 + 2 + 2 + 2 and len({(r.sequence_id, r.offset) for r in got}) == len(got)
    assert sum(r.length for r in got if r.doc_id is None) == 6


@given(st.lists(st.integers(1, 90), max_size=40))
@settings(max_examples=100, deadline=None)
def test_filler_loses_nothing_and_pads_nothing(sizes):
    filler, at = curve_packing.Filler(3, 32), 0
    for i, n in enumerate(sizes):
        filler.add((i, 0, i, n), 0, np.arange(at, at + n, dtype="<u4"))
        at += n
    filler.finish()
    used = Counter()
    for _, _, n, _, _, sequence, offset in filler.out:
        assert offset == used[sequence]
        used[sequence] += n
    assert sum(used.values()) == sum(sizes) and all(n == 32 or n & (n - 1) == 0 for n in used.values())
    assert sum(n == 32 for n in used.values()) >= sum(sizes) // 32 and len(used) <= sum(sizes) // 32 + 5


def test_neighbours_on_the_curve_are_alike(spark):
    """Next documents share their language far more often than documents drawn at random, and copies are neighbours."""
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", "text").collect()
    tok = Tokenizer.from_file(PATH)
    keys = curve_packing.hilbert_keys(curve_packing.coordinates([np.array(tok.encode(r.text, add_special_tokens=False).ids + [0], "<u4") for r in rows]))
    keyed = sorted((int(k), r.doc_id, r.lang) for k, r in zip(keys, rows, strict=True))
    same = np.mean([a[2] == b[2] for a, b in itertools.pairwise(keyed)])
    n = Counter(r.lang for r in rows)
    drawn = sum((k / len(rows)) ** 2 for k in n.values())
    assert same > drawn + 0.2, (same, drawn)


def test_op13_on_all_documents(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    check_packing(queries.op13_curve_packing(spark, SF).collect(), texts)
