"""A folder of this process in the place that driver and executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, SparkSession] = {}
_LOCAL: list[str] = []


def folder(spark: SparkSession, name: str) -> str:
    """A new path under spark.checkpoint.dir (in a local session without one, a temporary folder); deleted at exit."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        if not _LOCAL:
            _LOCAL.append("file://" + tempfile.mkdtemp(prefix="tessera-"))
        root = _LOCAL[0]
    path = f"{root.rstrip('/')}/tessera-{name}-{uuid.uuid4().hex}"
    _OWN[path] = spark
    return path


def table(df: DataFrame, name: str = "table") -> DataFrame:
    """df written to a folder() and read back: what a model or a shuffle gave stays the same if executors are lost."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@atexit.register
def _drop_all() -> None:
    for path, spark in list(_OWN.items()):
        try:
            target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # noqa: BLE001  the session is gone
            return
