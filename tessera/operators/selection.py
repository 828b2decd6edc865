"""Which reports an analysis still has to do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as X
from .index import stem_of_summary
from .relational import not_done

META = ["company", "isin", "report_year", "country", "sector", "industry", "auditor", "csrd_compliant", "word_count"]


def extracted(summary: DataFrame, language: str | None = "en") -> DataFrame:
    """Rows that were read, have a text file and are in a language; without a column language all languages."""
    df = summary.where((F.col("extraction_status") == "success") & (F.coalesce(X.strip(F.col("text_file")), F.lit("")) != ""))
    return df.where(F.col("language") == language) if language and "language" in summary.columns else df


def name_of(path: Column) -> Column:
    """A path's last part without its ending."""
    return F.regexp_replace(F.regexp_replace(path, r"^.*/", ""), r"\.[^.]+$", "")


def with_texts(summary: DataFrame, texts: DataFrame, rebuilt: bool = False) -> DataFrame:
    """summary with stem and path of texts(path, stem): by the recorded path, else by its name (rebuilt: by the row's own
    key). Rows without a text go."""
    other = stem_of_summary(summary) if rebuilt else name_of(F.col("text_file"))
    have = texts.select(F.col("path").alias("__path"), F.col("stem").alias("__stem"))
    exact = have.select(F.col("__path").alias("__exact"), F.col("__stem").alias("__exact_stem"))
    df = summary.withColumn("__key", other)
    df = df.join(exact, df["text_file"] == exact["__exact"], "left").join(have, df["__key"] == have["__stem"], "left")
    df = df.withColumn("text_path", F.coalesce("__exact", "__path")).withColumn("stem", F.coalesce("__exact_stem", "__stem"))
    return df.where("text_path is not null").drop("__key", "__exact", "__exact_stem", "__path", "__stem")


def jobs(summary: DataFrame, texts: DataFrame, done: DataFrame | None = None, out_dir: str = "esrs_output", limit: int | None = None, ordinal: str = "ordinal") -> DataFrame:
    """stem, text_path, out_path, meta of the English reports that have a text and no output in done(stem) yet."""
    df = with_texts(extracted(summary), texts)
    if done is not None:
        df = not_done(df, done, ["stem"])
    out = df.select(ordinal, "stem", "text_path", F.concat(F.lit(f"{out_dir}/"), "stem", F.lit(".json")).alias("out_path"), F.struct("stem", *META).alias("meta"))
    return out.orderBy(ordinal).limit(limit) if limit else out


def window(df: DataFrame, ordinal: str, start: int = 0, limit: int | None = None) -> DataFrame:
    """Rows from place start on in order, at most limit (0 and null: all)."""
    out = df.orderBy(ordinal).offset(start) if start else df.orderBy(ordinal)
    return out.limit(limit) if limit else out
