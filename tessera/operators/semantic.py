"""Scores of sentences against anchors by embeddings, and shares of classifier labels."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as X
from .relational import top_per_group

#: Anchors that may be broadcast.
MOST_ANCHORS = 10_000


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def similarities(sentences: DataFrame, anchors: DataFrame) -> DataFrame:
    """sentences x anchors with sim, the cosine of unit vectors embedding and anchor_embedding.

    The anchors are a dimension (a taxonomy): as rows of one array column they reach every sentence without a join.
    """
    n = anchors.count()
    if n > MOST_ANCHORS:
        raise ValueError(f"{n} anchors; at most {MOST_ANCHORS} make a dimension")
    keys = [c for c in anchors.columns if c != "anchor_embedding"]
    one = anchors.agg(F.collect_list(F.struct(*keys, "anchor_embedding")).alias("__anchors"))
    wide = sentences.join(F.broadcast(one)).withColumn("__a", F.explode("__anchors"))
    return wide.select(*sentences.columns, *[F.col(f"__a.{k}").alias(k) for k in keys], dot(F.col("embedding"), F.col("__a.anchor_embedding")).alias("sim"))


def top_similarities(sentences: DataFrame, anchors: DataFrame, report: str, topic: str, k: int = 15, ordinal: str = "sentence_idx") -> DataFrame:
    """report, topic, ordinal, sim: per report and topic the k sentences of highest cosine, ties by ordinal."""
    return top_per_group(batch_similarities(sentences, anchors, report, topic, k, ordinal), [report, topic], k, F.desc("sim"), ordinal)


def batch_similarities(sentences: DataFrame, anchors: DataFrame, report: str, topic: str, k: int = 15, ordinal: str = "sentence_idx", floor: float | None = None, others: tuple[str, ...] = ()) -> DataFrame:
    """The rows that top_similarities() takes its own from; with floor, those at or over it; others are columns of sentences
    that go with them.

    Sentences meet the anchors in blocks of one matrix product, and each Arrow batch passes on its own k best of every
    report and topic only; so what is shuffled does not hold sentences x anchors. The anchors are at most MOST_ANCHORS.
    """
    rows = anchors.select(topic, "anchor_embedding").limit(MOST_ANCHORS + 1).collect()
    if len(rows) > MOST_ANCHORS:
        raise ValueError(f"at most {MOST_ANCHORS} anchors make a dimension")
    names, matrix = [r[0] for r in rows], np.array([r[1] for r in rows], np.float64).reshape(len(rows), -1)
    types = {f.name: f.dataType.simpleString() for f in sentences.schema.fields} | {topic: anchors.schema[topic].dataType.simpleString()}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b = b[b["embedding"].notna()]
            if not len(b) or not len(names):
                continue
            b = b.sort_values([report, ordinal], kind="stable")
            group = b.groupby(report, sort=False, dropna=False).ngroup().to_numpy()
            sim = np.zeros((len(b), len(names)))
            for at in range(0, len(b), 4096):
                # Sums in the order of the dimensions, as an aggregate takes them.
                x, block = np.stack(b["embedding"].iloc[at : at + 4096].to_numpy()).astype(np.float64), sim[at : at + 4096]
                for d in range(matrix.shape[1]):
                    block += x[:, d : d + 1] * matrix[None, :, d]
            keys, ordinals, found, rest = b[report].to_numpy(), b[ordinal].to_numpy(), [], {c: b[c].to_numpy() for c in others}
            starts = np.searchsorted(group, group)  # rows of a report follow each other
            for j, name in enumerate(names):
                order = np.lexsort((-sim[:, j], group))
                best = order[np.arange(len(b)) - starts < k]
                if floor is not None:
                    best = best[sim[best, j] >= floor]
                found.append(pd.DataFrame({report: keys[best], topic: [name] * len(best), ordinal: ordinals[best], "sim": sim[best, j], **{c: rest[c][best] for c in others}}))
            yield pd.concat(found)

    schema = ", ".join([f"{report} {types[report]}, {topic} {types[topic]}, {ordinal} {types[ordinal]}, sim double", *[f"{c} {types[c]}" for c in others]])
    return sentences.select(report, ordinal, "embedding", *others).mapInPandas(run, schema)


def topic_scores(sims: DataFrame, report: str, topic: str, k: int = 15) -> DataFrame:
    """report, topic, score: the mean of the k highest similarities, 4 digits."""
    top = top_per_group(sims, [report, topic], k, F.desc("sim"), "sentence_idx")
    return top.groupBy(report, topic).agg(F.round(F.avg("sim"), 4).alias("score"))


def pillar_scores(topics: DataFrame, report: str, pillar: Column) -> DataFrame:
    """report, environment, social, governance, dominant: means of rounded topic scores."""
    by = topics.withColumn("__p", pillar)
    means = by.groupBy(report).agg(*[F.round(F.coalesce(F.avg(F.when(F.col("__p") == p, F.col("score"))), F.lit(0.0)), 4).alias(p) for p in ("environment", "social", "governance")])
    return means.withColumn("dominant", X.dominant(F.col("environment"), F.col("social"), F.col("governance")))


def label_shares(labelled: DataFrame, report: str, label: Column) -> DataFrame:
    theme = X.theme_of_label(label)
    share = lambda t: F.round(F.count_if(theme == t) / F.greatest(F.count("*"), F.lit(1)), 4).alias(f"{t}_share")
    return labelled.groupBy(report).agg(F.count("*").alias("n_sentences"), *[share(t) for t in ("environment", "social", "governance", "none")])


def climate_signals(labelled: DataFrame, report: str, climate: Column, commitment: Column) -> DataFrame:
    """Share of climate sentences, rate of commitments among them, and share * (1 - rate), all of rounded terms."""
    yes = X.positive_label(climate)
    n = labelled.groupBy(report).agg(F.count("*").alias("n"), F.count_if(yes).alias("climate_sentences"), F.count_if(yes & X.positive_label(commitment)).alias("climate_commitments"))
    n = n.withColumn("climate_share", F.round(F.col("climate_sentences") / F.greatest(F.col("n"), F.lit(1)), 4)).withColumn("commitment_rate", F.when(F.col("climate_sentences") > 0, F.round(F.col("climate_commitments") / F.nullif("climate_sentences", F.lit(0)), 4)).otherwise(0.0))
    return n.withColumn("greenwashing_index", F.round(F.col("climate_share") * (1 - F.col("commitment_rate")), 4)).drop("n")


def topic_pillars(topics: DataFrame, lookup: DataFrame, topic: str) -> DataFrame:
    """topics with the pillar that lookup(topic, pillar) names; a dimension, so it is broadcast."""
    return topics.join(F.broadcast(lookup.select(topic, "pillar")), topic, "left")


def report_scores(pillars: DataFrame, report: str, shares: DataFrame | None = None, climate: DataFrame | None = None) -> DataFrame:
    """One row per report: its pillar scores, and where their models were there label shares and climate signals."""
    out = pillars.select(report, *[F.col(p).alias(f"sem_{p}") for p in ("environment", "social", "governance")], F.col("dominant").alias("sem_dominant_pillar"))
    for part in (shares, climate):
        if part is not None:
            out = out.join(part.drop(*[c for c in part.columns if c != report and c in out.columns]), report, "left")
    return out


def score_averages(scored: DataFrame) -> DataFrame:
    """One row: means of the scores that there are, six digits."""
    have = [c for c in ("sem_environment", "sem_social", "sem_governance", "greenwashing_index") if c in scored.columns]
    return scored.agg(*[F.round(F.avg(c), 6).alias(f"avg_{c}") for c in have])
