"""Where results go. Files are committed whole by Spark's protocol."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.relational import latest


def overwrite_csv(df: DataFrame, path: str) -> None:
    """Numbers and text as text; nulls as empty fields."""
    df.write.mode("overwrite").option("header", True).option("emptyValue", "").option("escape", '"').csv(path)


def append(df: DataFrame, path: str, run_id: str) -> None:
    """Rows of one run; the run's rows replace those of an earlier try with its id."""
    df.withColumn("run_id", F.lit(run_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)


def current(log: DataFrame, keys: list[str], *tie: str) -> DataFrame:
    """The latest run's row of each key."""
    return latest(log, keys, F.desc("run_id"), *[F.desc(c) for c in tie])


def json_rows(df: DataFrame, path: str, *partition: str) -> None:
    df.write.mode("overwrite").partitionBy(*partition).json(path)


def split_failures(df: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """Results and failures of a table in which failed rows carry an error."""
    return df.where(F.col(error).isNull()).drop(error), df.where(F.col(error).isNotNull())


def extraction_files(results: DataFrame, path: str) -> None:
    """The text of each result as texts/<stem>, and the tables of those that have any as tables/<stem>, one row each."""
    results.where("text is not null").select("stem", "text").write.mode("overwrite").parquet(f"{path}/texts")
    results.where("tables_json is not null").select("stem", "tables_json").write.mode("overwrite").parquet(f"{path}/tables")
