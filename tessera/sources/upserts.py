"""Keyed tables that batches are merged into: each batch is a folder of its own, and reading takes the latest row of a key.

    path/rows/__version=00000003   a batch's rows, as Parquet; a deleted key is a row with __deleted
    path/base/__version=00000002   one row per key of what all batches up to that version left
    path/batches/<name>            the batches that are in

A batch is written beside its place and renamed into it, so it is there as a whole or not at all, and a batch that is in
is not merged again. One writer at a time; readers see the versions there are when they list them.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

DELETED = "__deleted"


class UpsertTable:
    """A table of one row per key at path. Batches may overlap, come late, or come twice."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str]):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self._jvm = spark.sparkContext._jvm
        self._fs = self._at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _versions(self, kind: str) -> list[int]:
        """The versions there are of a kind; as many as batches since the last vacuum()."""
        at = self._at(kind)
        names = [s.getPath().getName() for s in self._fs.listStatus(at)] if self._fs.exists(at) else []
        return sorted(int(n[10:]) for n in names if re.fullmatch(r"__version=\d{8}", n))

    def _land(self, df: DataFrame, kind: str, version: int) -> None:
        staged, place = f"_staged-{uuid.uuid4().hex}", f"{kind}/__version={version:08d}"
        df.write.parquet(f"{self.path}/{staged}")
        self._fs.mkdirs(self._at(kind))
        if self._fs.exists(self._at(place)) or not self._fs.rename(self._at(staged), self._at(place)):
            raise RuntimeError(f"{self.path}: version {version} was written by another writer")

    def exists(self) -> bool:
        return bool(self._versions("base") or self._versions("rows"))

    def holds(self, batch: str) -> bool:
        return self._fs.exists(self._at(f"batches/{batch}"))

    def upsert(self, rows: DataFrame, batch: str | None = None, *order: Column, deleted: Column | None = None) -> bool:
        """Merge a batch: its rows take the place of those with their keys. Whether it was new.

        Of rows with equal keys the first by order is taken, or where they tie any of the equal ones by a hash of all
        columns. A row where deleted holds removes its key. Null keys are keys. A batch without a name is always new.
        """
        batch = batch or uuid.uuid4().hex
        if not re.fullmatch(r"[\w.=-]+", batch):
            raise ValueError(f"a batch is named by letters, digits and . = - _, not {batch!r}")
        if self.holds(batch):
            return False
        gone = F.lit(False) if deleted is None else F.coalesce(deleted, F.lit(False))
        marked = rows.select(*rows.columns, gone.alias(DELETED))
        first = Window.partitionBy(*self.keys).orderBy(*order, F.xxhash64(*map(_hashable, marked.schema)))
        kept = marked.withColumn("__n", F.row_number().over(first)).where("__n = 1").drop("__n")
        version = 1 + max([0, *self._versions("base"), *self._versions("rows")])
        self._land(kept, "rows", version)
        self._fs.mkdirs(self._at("batches"))
        self._fs.create(self._at(f"batches/{batch}"), True).close()
        return True

    def _merged(self) -> DataFrame:
        """One row per key, deleted ones among them, of the last base and the batches after it."""
        bases, versions = self._versions("base"), self._versions("rows")
        last = bases[-1] if bases else 0
        deltas = [f"{self.path}/rows/__version={v:08d}" for v in versions if v > last]
        read = self.spark.read.option("mergeSchema", True)
        base = read.parquet(f"{self.path}/base/__version={last:08d}") if bases else None
        if not deltas:
            if base is None:
                raise FileNotFoundError(f"{self.path} holds no batch")
            return base
        newer = read.option("basePath", f"{self.path}/rows").parquet(*deltas)
        latest = Window.partitionBy(*self.keys).orderBy(F.desc("__version"))
        newer = newer.withColumn("__n", F.row_number().over(latest)).where("__n = 1").drop("__n", "__version")
        if base is None:
            return newer
        # The base is not shuffled where the keys of what came since are few enough to be broadcast by size.
        b, n = base.alias("b"), newer.select(*self.keys).alias("n")
        same = [F.col(f"b.{k}").eqNullSafe(F.col(f"n.{k}")) for k in self.keys]
        return b.join(n, same, "left_anti").select("b.*").unionByName(newer, allowMissingColumns=True)

    def read(self) -> DataFrame:
        """The current row of every key. Columns that only some batches have are null in the others' rows."""
        return self._merged().where(f"not {DELETED}").drop(DELETED)

    def compact(self) -> None:
        """Write the current rows as a new base; what was there stays for those who read it, until vacuum()."""
        versions = self._versions("rows")
        bases = self._versions("base")
        if versions and versions[-1] > (bases[-1] if bases else 0):
            self._land(self._merged().where(f"not {DELETED}"), "base", versions[-1])

    def vacuum(self) -> None:
        """Delete what the last base has made unnecessary; batches are still known by name."""
        bases = self._versions("base")
        for kind in ("base", "rows"):
            for v in self._versions(kind):
                if bases and v <= bases[-1] and (kind, v) != ("base", bases[-1]):
                    self._fs.delete(self._at(f"{kind}/__version={v:08d}"), True)


def _hashable(field) -> Column:
    """A column as what xxhash64 takes; maps and variants as text."""
    c = F.col(f"`{field.name}`")
    return F.to_json(F.struct(c)) if "map<" in field.dataType.simpleString() or "variant" in field.dataType.simpleString() else c
