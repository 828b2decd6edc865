"""Tables from files, with schemas and never inferred types."""

from __future__ import annotations

import io
import pathlib
import re
import zipfile
from xml.etree import ElementTree
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions import text as X

SUMMARY = "company string, isin string, report_year int, country string, industry string, sector string, doc_type string, csrd_compliant string, auditor string, publication_date string, page_start int, page_end int, source_url string, download_status string, pdf_bytes long, extraction_status string, language string, pdf_pages int, pages_extracted int, word_count long, tables_found int, text_file string, table_file string"
DOWNLOAD_LOG = "stem string, company string, isin string, url string, final_url string, status string, bytes long, dest string"
TABLES = "array<struct<page:int,rows:array<array<string>>>>"


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def numbered(df: DataFrame, name: str = "ordinal") -> DataFrame:
    """df, as read from files, with the place of each row in them: files by name, rows as they stand there.

    Rows are numbered within the part of a file that one task reads and shifted by the parts before it, so the numbers do
    not depend on how files are split or dealt to tasks.
    """
    own = ["__file", "__block"]
    rows = df.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__id"))
    before = Window.orderBy(*own).rowsBetween(Window.unboundedPreceding, -1)  # one row a part of a file
    base = rows.groupBy(*own).agg(F.count("*").alias("__n")).select(*own, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    here = rows.withColumn("__at", F.row_number().over(Window.partitionBy(*own).orderBy("__id")))
    return here.join(base, own).withColumn(name, F.col("__base") + F.col("__at") - 1).drop(*own, "__id", "__at", "__base")


def texts(spark: SparkSession, path: str) -> DataFrame:
    """stem, text of whole files."""
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    return spark.read.text(path, wholetext=True).select(F.url_decode(F.regexp_replace(name, r"\.[^.]+$", "")).alias("stem"), F.col("value").alias("text"))


def taxonomy(lines: DataFrame) -> DataFrame:
    """standard, dr_code, dr_title, line of lines(line, value) of a markdown list under headings.

    A heading names the standard of the items below it; general requirements and cross-cutting items are left out. It is
    a dimension of some hundred rows, ordered in one task.
    """
    heading = F.col("value").startswith("### ")
    code = F.regexp_extract("value", r"ESRS\s+(E\d|S\d|G\d|2|1)\b", 1)
    named = F.when(heading, F.when(code == "2", "ESRS2").when(code != "", code).otherwise("-"))
    item = r"^-\s+`([^`]+)`\s+—\s+(.+)$"
    df = lines.withColumn("standard", F.last(named, ignorenulls=True).over(Window.orderBy("line").rowsBetween(Window.unboundedPreceding, 0)))
    text = F.trim("value")
    return df.where(~heading & text.rlike(item) & ~F.col("standard").isin("-", "1")).select("standard", F.regexp_extract(text, item, 1).alias("dr_code"), F.regexp_extract(text, item, 2).alias("dr_title"), "line")


def taxonomy_of(spark: SparkSession, markdown: str) -> DataFrame:
    return taxonomy(spark.createDataFrame(list(enumerate(markdown.splitlines())), "line int, value string"))


def table_count(json: Column) -> Column:
    """Tables in a tables file; 0 where it can't be read."""
    return F.coalesce(F.size(F.from_json(json, TABLES)), F.lit(0))


def prompt(path: str) -> str:
    """The text of a prompt file, read on the driver; an error that names it where it is missing."""
    try:
        return pathlib.Path(path).read_text(encoding="utf-8")
    except FileNotFoundError:
        raise FileNotFoundError(f"no prompt file {path}") from None


def is_pdf(content_type: Column, head: Column) -> Column:
    """By its declared type, or by its first bytes."""
    kind = F.lower(F.coalesce(content_type, F.lit("")))
    return kind.contains("pdf") | kind.contains("octet-stream") | F.coalesce(F.hex(F.substring(head, 1, 4)) == "25504446", F.lit(False))


def is_report(head: Column) -> Column:
    """Bytes that hold %PDF in their first KB or begin as a ZIP archive."""
    start = F.hex(F.substring(head, 1, 1024))
    return start.contains("25504446") | start.startswith("504B0304")


def valid_pdf(content: Column, least: int = 10_000) -> Column:
    return (F.length(content) >= least) & F.hex(F.substring(content, 1, 1024)).contains("25504446")


def pdf_of_zip(archives: DataFrame, most: int = 500 << 20, least: int = 0) -> DataFrame:
    """archives(path, content) with pdf, the largest .pdf member, or error, why there is none.

    A member of under least bytes is file_too_small.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for path, content in zip(b["path"], b["content"], strict=True):
                pdf, error = None, None
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        members = [i for i in z.infolist() if i.filename.lower().endswith(".pdf")]
                        best = max(members, key=lambda i: i.file_size, default=None)
                        if best is None:
                            error = "zip_without_pdf"
                        elif best.file_size > most:
                            error = f"too_large_{best.file_size >> 20}MB"
                        elif best.file_size < least:
                            error = "file_too_small"
                        else:
                            pdf = z.read(best)
                except (zipfile.BadZipFile, TypeError, RuntimeError) as e:
                    error = f"bad_zip:{type(e).__name__}"
                rows.append((path, pdf, error))
            yield pd.DataFrame(rows, columns=["path", "pdf", "error"])

    return archives.select("path", "content").mapInPandas(run, "path string, pdf binary, error string")


_CELL = re.compile(r"([A-Z]+)\d+")
_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _sheet(content: bytes, sheet: str) -> Iterator[tuple[int, list[str | None]]]:
    """Row number and cells as text of a sheet of an XLSX file."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in i.iter(_NS + "t")) for i in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(_NS + "si")]
        ids = {s.get("name"): s.get(_REL) for s in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(_NS + "sheet")}
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        if sheet not in ids:
            raise ValueError(f"no sheet {sheet}")
        target = targets[ids[sheet]].lstrip("/")
        with z.open(target if target.startswith("xl/") else f"xl/{target}") as f:
            at = 0
            for _, row in ElementTree.iterparse(f):
                if row.tag != _NS + "row":
                    continue
                at = int(row.get("r") or at + 1)
                cells: dict[int, str | None] = {}
                for c in row.iter(_NS + "c"):
                    column = 0
                    for letter in _CELL.match(c.get("r"))[1]:
                        column = column * 26 + ord(letter) - 64
                    v = c.findtext(_NS + "v")
                    if c.get("t") == "inlineStr":
                        v = "".join(t.text or "" for t in c.iter(_NS + "t"))
                    cells[column] = shared[int(v)] if c.get("t") == "s" and v is not None else v
                yield at, [cells.get(i) for i in range(1, max(cells, default=0) + 1)]
                row.clear()


def workbook_rows(files: DataFrame, sheet: str) -> DataFrame:
    """path, row, cells of a sheet of each of files(path, content), which are XLSX; dates stay the numbers they are."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, content in zip(b["path"], b["content"], strict=True):
                rows = list(_sheet(content, sheet))
                yield pd.DataFrame({"path": [path] * len(rows), "row": [n for n, _ in rows], "cells": [c for _, c in rows]})

    return files.select("path", "content").mapInPandas(run, "path string, row int, cells array<string>")


def workbook(files: DataFrame, sheet: str = "csrd", header: int = 3) -> DataFrame:
    """The sheet of the last path of files(path, content) as text columns named by its header row, and ordinal.

    Line breaks in names become blanks; a name that comes twice gets a number.
    """
    newest = files.join(F.broadcast(files.agg(F.max("path").alias("path"))), "path")
    rows = workbook_rows(newest, sheet)
    names, seen = [], {}
    for n in (rows.where(F.col("row") == header).select("cells").first() or [[]])[0]:
        n = (n or "").replace("\n", " ").strip() or "unnamed"
        seen[n] = seen.get(n, 0) + 1
        names.append(n if seen[n] == 1 else f"{n}.{seen[n] - 1}")
    return rows.where(F.col("row") > header).select(F.col("row").cast("long").alias("ordinal"), *[F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(names)])


def from_pages(tasks: DataFrame, pages: DataFrame, all_tables: bool = False) -> DataFrame:
    """Extraction results of tasks(stem, page_start, page_end, pdf_pages) over pages(stem, page, text, tables).

    The range is clamped to the pages there are; text joins the pages of it, each after its mark. Tables are
    array<array<array<string>>>, of which the useful ones count. A task without pages fails.
    """
    r = X.page_range(F.col("page_start"), F.col("page_end"), F.col("pdf_pages"))
    t = tasks.select("stem", "pdf_pages", r.alias("r")).select("stem", "pdf_pages", "r.*")
    own = pages.join(t.select("stem", "start", "end").hint("merge"), "stem").where("page between start and end")
    useful = F.coalesce(F.col("tables"), F.array().cast("array<array<array<string>>>"))
    useful = useful if all_tables else F.filter(useful, X.useful_table)
    marked = F.concat(F.lit("[[page:"), F.col("page").cast("string"), F.lit("]]\n"), F.coalesce("text", F.lit("")))
    listed = F.transform(useful, lambda rows: F.struct(F.col("page"), rows.alias("rows")))
    joined = own.groupBy("stem").agg(F.array_sort(F.collect_list(F.struct("page", marked.alias("t"), listed.alias("tables")))).alias("p"))
    joined = joined.select("stem", F.array_join(F.transform("p", lambda x: x["t"]), "\n\n").alias("text"), F.flatten(F.transform("p", lambda x: x["tables"])).alias("tables"))
    df = t.join(joined.hint("merge"), "stem", "left")
    text, good = F.col("text"), F.col("text").isNotNull()
    return df.select(
        "stem", F.when(good, "success").otherwise("failed").alias("extraction_status"), F.when(good, "").otherwise("parse: no pages").alias("error"), X.language(text).alias("language"), F.when(good, F.col("end") - F.col("start") + 1).otherwise(0).alias("pages_extracted"), "pdf_pages",
        F.coalesce(X.word_count_without_marks(text), F.lit(0)).alias("word_count"), F.when(good, F.size("tables")).otherwise(0).alias("tables_found"), "text", F.when(F.size("tables") > 0, F.to_json("tables")).alias("tables_json"),
    )
