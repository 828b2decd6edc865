"""Token counts by source, language and tokenizer version, kept by signed deltas.

A batch of changes becomes signed sums (inserts add, deletes take away, revisions add the difference), a few rows
however large the batch. A commit writes them to a folder of their own and renames it to the batch's name; a batch whose
folder exists was committed before and changes nothing, so a repeated or half-done commit can be run again. Totals are
sums over committed folders. compact() sums them into a base that knows the batches it holds, so totals read the last
base and what came after. The folder needs a file system that renames folders at once, as HDFS and local ones do; most
object stores do not.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from .packing import encoder

KEY = ["source", "lang", "tokenizer"]
SCHEMA = "source string, lang string, tokenizer string, n_docs long, n_tokens long"


def counted(docs: DataFrame, path: str, tokenizer: str, *keep: str) -> DataFrame:
    """doc_id, source, lang, tokenizer, n_tokens and columns keep of each row of docs; a null or empty text has 0 tokens."""

    @F.pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = encoder(path)
        for texts in batches:
            yield pd.Series([len(encode(t)) if t else 0 for t in texts], dtype="int64")

    return docs.select("doc_id", "source", "lang", *keep, F.lit(tokenizer).alias("tokenizer"), tokens(F.col("text").cast("string")).alias("n_tokens"))


def signed(changes: DataFrame) -> DataFrame:
    """Sums by KEY of changes(op, source, lang, tokenizer, n_tokens, old_tokens); op is insert, delete or revise.

    Null keys are a group of their own; a null count is 0; repeated rows count each; no rows give no rows; rows of another
    op are an error. Other columns are ignored.
    """
    n, old, op = F.coalesce("n_tokens", F.lit(0)), F.coalesce("old_tokens", F.lit(0)), F.col("op")
    wrong = F.raise_error(F.concat(F.lit("unknown op "), F.coalesce(op, F.lit("null"))))
    docs = F.when(op == "insert", 1).when(op == "delete", -1).when(op == "revise", 0).otherwise(wrong.cast("int"))
    tokens = F.when(op == "insert", n).when(op == "delete", -n).when(op == "revise", n - old)
    return changes.groupBy(*KEY).agg(F.sum(docs.cast("long")).alias("n_docs"), F.sum(tokens.cast("long")).alias("n_tokens"))


class Rollup:
    """The committed batches of a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._paths = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._paths(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._paths(self.path))

    def _named(self, kind: str) -> list[str]:
        return sorted(n[len(kind) + 1 :] for s in self._fs.listStatus(self._paths(self.path)) if (n := s.getPath().getName()).startswith(kind + "=") and s.isDirectory())

    def batches(self) -> list[str]:
        return self._named("batch")

    def _land(self, draft, place) -> bool:
        """Rename a finished draft to its place; False if another one is there."""
        if not self._fs.exists(place) and self._fs.rename(draft, place):
            inside = self._paths(place, draft.getName())
            if not self._fs.exists(inside):  # else another one came first and the rename went into its folder
                return True
            self._fs.delete(inside, True)
            return False
        self._fs.delete(draft, True)
        return False

    def _draft(self):
        return self._paths(f"{self.path}/_draft-{uuid.uuid4().hex}")

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Apply a batch once; False if it was applied before. Of two commits of one batch at a time, one wins."""
        place = self._paths(f"{self.path}/batch={batch}")
        if self._fs.exists(place):
            return False
        draft = self._draft()
        signed(changes).write.parquet(draft.toString())
        return self._land(draft, place)

    def _base(self) -> tuple[int, list[str]]:
        """Number of the last base (0: none) and the batches that it holds."""
        bases = self._named("base")
        if not bases:
            return 0, []
        held = self.spark.read.schema("batch string").json(f"{self.path}/base={bases[-1]}/_batches")
        return int(bases[-1]), [r.batch for r in held.collect()]

    def _sums(self) -> tuple[int, list[str], DataFrame]:
        number, held = self._base()
        names = sorted(set(self.batches()) - set(held))
        paths = [f"{self.path}/batch={n}" for n in names] + ([f"{self.path}/base={number:012d}"] if number else [])
        if not paths:
            return number, held, self.spark.createDataFrame([], SCHEMA)
        parts = self.spark.read.schema(SCHEMA).parquet(*paths)
        return number, held + names, parts.groupBy(*KEY).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))

    def compact(self) -> bool:
        """Sum all committed batches into a new base; False if another compaction made it first. Batches stay as marks."""
        number, held, sums = self._sums()
        draft = self._draft()
        sums.write.parquet(draft.toString())
        self.spark.createDataFrame([(b,) for b in held], "batch string").write.json(f"{draft.toString()}/_batches")
        return self._land(draft, self._paths(f"{self.path}/base={number + 1:012d}"))

    def totals(self) -> DataFrame:
        """Sums by KEY; groups without documents and tokens are left out."""
        return self._sums()[2].where("n_docs <> 0 or n_tokens <> 0")
