"""Model ports: Arrow batches in and out, one model per Python worker, failures as rows.

A port takes a factory that makes the model. The stand-ins are deterministic, so plans can be run and tested without
model files.
"""

from __future__ import annotations

import os
import re
import time
import zlib
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.lexicon import PROVIDERS
from ..functions.text import is_transient, repaired_json
from ..sources import scratch, sinks
from .merge import merged, parsed
from .relational import packed_parts

Embedder = Callable[[list[str]], np.ndarray]


@dataclass(frozen=True)
class Provider:
    """A model server: address, key, model, and whether it is asked for JSON."""

    base_url: str
    key: str
    model: str
    json_mode: bool = True


def provider(name: str, model: str, base_url: str | None = None, key: str | None = None, environment: Mapping[str, str] = os.environ) -> Provider:
    """A known server's settings; the key is the given one, that of its variable, or the one that keyless servers take."""
    url, variable, none = PROVIDERS[name]
    key = key or environment.get(variable) or none
    if not key:
        raise ValueError(f"{name} needs a key: set {variable}")
    return Provider(base_url or url, key, model)


def chat(send: Callable[[Provider, dict], str], server: Provider, system: str, most: int = 8000) -> Callable[[], Callable[[str], str]]:
    """A factory for ask(): send(server, request) posts a chat request. A server that rejects JSON mode is asked without."""

    def factory() -> Callable[[str], str]:
        def run(text: str) -> str:
            request = {"model": server.model, "messages": [{"role": "system", "content": system}, {"role": "user", "content": text}], "temperature": 0, "max_tokens": most}
            if not server.json_mode:
                return send(server, request)
            try:
                return send(server, request | {"response_format": {"type": "json_object"}})
            except Exception as e:
                if "response_format" not in str(e).lower():
                    raise
                return send(server, request)

        return run

    return factory


def recorded(answers: Mapping[str, str], default: str | None = None) -> Callable[[], Callable[[str], str]]:
    """A factory for ask() that replays answers by their text."""

    def factory() -> Callable[[str], str]:
        def run(text: str) -> str:
            if text not in answers and default is None:
                raise KeyError("no recorded answer")
            return answers.get(text, default)

        return run

    return factory


def _batched(model: Callable[[list], list], items: list, length: Callable, batch: int) -> list[tuple]:
    """(result, error) of each item: batches longest first; where a batch fails its items are tried one by one."""
    out: list[tuple] = [(None, None)] * len(items)
    order = sorted(range(len(items)), key=lambda i: -length(items[i]))
    for at in range(0, len(order), batch):
        part = order[at : at + batch]
        try:
            for i, x in zip(part, model([items[i] for i in part]), strict=True):
                out[i] = (x, None)
        except Exception:  # noqa: BLE001  one bad text must not end the run
            for i in part:
                try:
                    out[i] = (next(iter(model([items[i]]))), None)
                except Exception as e:  # noqa: BLE001
                    out[i] = (None, str(e) or type(e).__name__)
    return out


def embed(factory: Callable[[], Embedder], batch: int = 64):
    """text -> array<float>, unit length; null where the model fails on a text."""

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = factory()
        for s in batches:
            # A text that a batch of rows holds several times is given to the model once.
            at, texts = pd.factorize(s.fillna(""))
            made = [None if v is None else v / max(np.linalg.norm(v), 1e-12) for v, _ in _batched(lambda x: np.asarray(model(x), np.float32), list(texts), len, batch)]
            yield pd.Series([made[i] for i in at], dtype=object)

    return run


def classify(factory: Callable[[], Callable[[list[str]], list[tuple[str, float]]]], batch: int = 32):
    """text -> struct(label, score, error)."""

    @F.pandas_udf(T.StructType().add("label", "string").add("score", "double").add("error", "string"))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = factory()
        for s in batches:
            made = _batched(model, s.fillna("").tolist(), len, batch)
            yield pd.DataFrame([(*(x or (None, None)), e) for x, e in made], columns=["label", "score", "error"])

    return run


def entailment(factory: Callable[[], Callable[[list[tuple[str, str]]], list[float]]], batch: int = 16):
    """premise, hypothesis -> probability; null where the model fails on a pair."""

    @F.pandas_udf(T.DoubleType())
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        model = factory()
        for a, b in batches:
            made = _batched(model, list(zip(a.fillna(""), b.fillna(""), strict=True)), lambda x: len(x[0]) + len(x[1]), batch)
            yield pd.Series([x for x, _ in made], dtype="float64")

    return run


def answer(factory: Callable[[], Callable[[str, str], tuple[list[str], np.ndarray, np.ndarray]]]):
    """question, context -> struct(span, score).

    The model gives the context's words and each one's chances to begin and to end the answer; a span that best_span
    rejects is null with score 0, as is that of a context on which the model fails; it is not asked without a context.
    """

    @F.pandas_udf(T.StructType().add("span", "string").add("score", "double"))
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        model = factory()

        def one(question: str, context: str | None) -> tuple[str | None, float]:
            if context is None:
                return None, 0.0
            try:
                words, starts, ends = model(question, context)
                found = best_span(np.asarray(starts), np.asarray(ends)) if len(words) else None
            except Exception:  # noqa: BLE001  one bad context must not end the run
                found = None
            return (None, 0.0) if found is None else (" ".join(words[found[0] : found[1] + 1]), found[2])

        for q, c in batches:
            yield pd.DataFrame([one(a, b) for a, b in zip(q.fillna(""), c.where(c.notna(), None), strict=True)], columns=["span", "score"])

    return run


def best_span(starts: np.ndarray, ends: np.ndarray, most: int = 30) -> tuple[int, int, float] | None:
    """Start, end and sqrt(p * q) of the likeliest answer; None if it ends before it starts or is too long."""
    i, j = int(np.argmax(starts)), int(np.argmax(ends))
    return None if j < i or j - i > most else (i, j, float(np.sqrt(starts[i] * ends[j])))


def ask(chunks: DataFrame, factory: Callable[[], Callable[[str], str]], tries: int = 4, wait: float = 4.0) -> DataFrame:
    """chunks(stem, chunk_no, text) -> stem, chunk_no, raw, error; transient errors are tried again, with doubled waits.

    chunks may be a stream; further columns of it pass.
    """
    schema = T.StructType([f for f in chunks.schema if f.name not in ("text", "raw", "error")]).add("raw", "string").add("error", "string")
    others = [f.name for f in schema if f.name not in ("raw", "error")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = factory()
        for b in batches:
            rows = []
            for text in b["text"]:
                raw, error = None, None
                for k in range(tries):
                    try:
                        raw, error = model(text), None
                        break
                    except Exception as e:  # noqa: BLE001  one bad chunk must not end the run
                        error = str(e) or type(e).__name__
                        if k + 1 == tries or not is_transient(error):
                            break
                        time.sleep(wait * 2**k)
                rows.append((raw, error))
            yield b[others].assign(raw=[r for r, _ in rows], error=[e for _, e in rows])

    return chunks.select(*others, "text").mapInPandas(run, schema)


def hashed_embedder(dimensions: int = 64) -> Callable[[], Embedder]:
    """A stand-in: bags of words hashed to signed dimensions."""

    def factory() -> Embedder:
        def run(texts: list[str]) -> np.ndarray:
            out = np.zeros((len(texts), dimensions), np.float32)
            for i, t in enumerate(texts):
                for w in t.lower().split():
                    h = zlib.crc32(w.encode())
                    out[i, h % dimensions] += 1 if h >> 16 & 1 else -1
            return out

        return run

    return factory


def overlap_entailment() -> Callable[[list[tuple[str, str]]], list[float]]:
    """A stand-in: the share of the hypothesis's words that the premise has."""

    def run(pairs: list[tuple[str, str]]) -> list[float]:
        sets = [(set(a.lower().split()), set(b.lower().split())) for a, b in pairs]
        return [len(a & b) / len(b) if b else 0.0 for a, b in sets]

    return run


def number_answerer() -> Callable[[str, str], tuple[list[str], np.ndarray, np.ndarray]]:
    """A stand-in: the first number of the context, to the word after it."""

    def run(question: str, context: str) -> tuple[list[str], np.ndarray, np.ndarray]:
        words = context.split()
        starts, ends = np.zeros(len(words)), np.zeros(len(words))
        at = next((i for i, w in enumerate(words) if re.match(r"\d", w)), None)
        if at is None:
            return [], starts, ends
        starts[at] = ends[min(at + 1, len(words) - 1)] = 1.0
        return words, starts, ends

    return run


def extract(parts: DataFrame, factory: Callable[[], Callable[[str], str]], most: int, ordinal: str = "page", tasks: int | None = None, tries: int = 4, wait: float = 4.0) -> tuple[DataFrame, DataFrame]:
    """(stem, result) and (stem, error) of parts(stem, ordinal, text): parts packed into chunks of at most so many
    characters, a model's answer to each, parsed, and merged into one result a report.

    A report one of whose chunks fails is a failure as a whole. With tasks, so many ask at a time.
    """
    chunks = packed_parts(parts, "stem", ordinal, "text", most).withColumnRenamed("chunk", "chunk_no")
    if tasks:
        chunks = chunks.repartition(tasks, "stem")
    return results(ask(chunks, factory, tries, wait))


def results(answers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(stem, result) and (stem, error) of answers(stem, chunk_no, raw, error), which are written to a table first, so
    that no model is asked twice and both results come from the same answers."""
    # Repaired once, where they are written; three later steps read it.
    answers = scratch.table(answers.withColumn("__json", repaired_json(F.col("raw"))), "answers")
    said, silent = sinks.split_failures(answers)
    good, bad = parsed(said)
    failed = silent.select("stem", "error").unionByName(bad).groupBy("stem").agg(F.min("error").alias("error"))
    return merged(good.join(failed.select("stem"), "stem", "left_anti")), failed
