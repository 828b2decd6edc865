"""The whole runs: an index, a summary, keyword scores, extracted disclosures, a worklist of failures.

Each takes a session and typed options and writes tables; `python -m tessera` has a subcommand for each.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .functions import url as U
from .operators import disclosure, index, keywords, merge, ports, relational, selection
from .sources import devalue, files, scratch, sinks
from .sources.upserts import UpsertTable
from .streaming import incremental, stateful

RAW = "id string, year string, type string, csrd_compliant string, csrd_report_number string, pdfpage_sust_start string, pdfpage_sust_end string, original_link string, publication_date string, auditor string, company struct<id:string,lei:string,isin:string,name:string,sector:string,country:string,industry:string>"


@dataclass(frozen=True)
class IndexOptions:
    """Where the index comes from (payloads or workbooks), its years, and which part of it is taken."""

    out: str
    payloads: str | None = None
    workbooks: str | None = None
    years: tuple[int, ...] = ()
    start: int = 0
    limit: int | None = None
    #: Where all reports of the payloads go as they are, as JSON lines.
    dump: str | None = None


def build_index(spark: SparkSession, o: IndexOptions) -> DataFrame:
    """The report index as CSV under out; recorded payloads are text files, workbooks XLSX files."""
    years = list(o.years) or None
    if o.workbooks:
        sheets = spark.read.format("binaryFile").load(o.workbooks).select("path", "content")
        df = index.of_workbook(files.workbook(sheets), years)
        df = df.where(U.has_host(F.col("link")))
    else:
        bodies = files.numbered(spark.read.text(o.payloads, wholetext=True), "number").withColumnRenamed("value", "body")
        raw = devalue.reports(bodies, RAW, required=True, at="number")
        if o.dump:
            raw.write.mode("overwrite").json(o.dump)
        df = index.normalised(raw, years)
    turns = relational.round_robin(df.withColumn("__host", U.host(F.col("link"))), "__host", "ordinal").drop("__host")
    sinks.overwrite_csv(selection.window(turns, "ordinal", o.start, o.limit), o.out)
    return turns


@dataclass(frozen=True)
class SummaryOptions:
    """Tables (Parquet) of the index, of downloads and of extractions, and where the summary goes."""

    index: str
    downloads: str
    extractions: str
    out: str


def summarise(spark: SparkSession, o: SummaryOptions) -> DataFrame:
    """The master summary as CSV under out; the totals are returned."""
    read = spark.read.parquet
    master = index.master(read(o.index), read(o.downloads), read(o.extractions))
    sinks.overwrite_csv(master, o.out)
    return index.totals(files.csv(spark, o.out, files.SUMMARY))


@dataclass(frozen=True)
class TextOptions:
    """The summary (CSV), the texts (whole files), and where results go."""

    summary: str
    texts: str
    out: str
    limit: int | None = None
    overwrite: bool = False


def _jobs(spark: SparkSession, o: TextOptions, done: DataFrame | None) -> DataFrame:
    texts = files.texts(spark, o.texts)
    rows = files.numbered(files.csv(spark, o.summary, files.SUMMARY))
    jobs = selection.jobs(rows, texts.withColumn("path", F.concat("stem", F.lit(".txt"))), done, o.out, o.limit)
    return jobs.join(texts, "stem")


def _table(spark: SparkSession, o: TextOptions) -> UpsertTable:
    """The nested results of all runs, one per report."""
    return UpsertTable(spark, f"{o.out}/results", ["stem"])


def _done(table: UpsertTable, overwrite: bool) -> DataFrame | None:
    return table.read().select("stem") if not overwrite and table.exists() else None


def analyse(spark: SparkSession, o: TextOptions) -> DataFrame:
    """Keyword scores of the English reports: flat rows as CSV, details as Parquet; the pillar counts are returned."""
    docs = _jobs(spark, o, None).select("stem", "text", "meta.company", "meta.isin", "meta.report_year", "meta.country", "meta.industry", "meta.sector")
    profile = keywords.profile(docs, "stem")
    keywords.detail(profile, F.col("stem")).write.mode("overwrite").parquet(f"{o.out}/details")
    flat = keywords.flat(profile)
    sinks.overwrite_csv(flat, f"{o.out}/nlp_results")
    return keywords.pillar_counts(flat)


def disclose(spark: SparkSession, o: TextOptions, taxonomy: DataFrame, embed, entail, answer=None, run_id: str | None = None) -> DataFrame:
    """Disclosures of the English reports that have none yet, by model ports; averages of the run are returned.

    Results of earlier runs stay, whatever run_id they have; it is a label, by default a new one.
    """
    run_id, table = run_id or uuid.uuid4().hex, _table(spark, o)
    jobs = scratch.table(_jobs(spark, o, _done(table, o.overwrite)), "jobs")
    table.upsert(disclosure.neural(jobs.select("stem", "text"), taxonomy, embed, entail, answer).withColumn("run_id", F.lit(run_id)))
    results = table.read().join(jobs.select("stem"), "stem", "left_semi").drop("run_id")
    none = spark.createDataFrame([], "stem string, error string")
    return merge.write_outputs(merge.flat_results(results, jobs.select("stem", "meta.company", "meta.country")), none, f"{o.out}/coverage", f"{o.out}/failures", run_id)


def ask_models(spark: SparkSession, o: TextOptions, factory, chunk: int = 60_000, run_id: str | None = None, lots: int = 8, timeout: float = 86_400) -> DataFrame:
    """As disclose(), by one model asked about each chunk of a report; reports that fail are put aside.

    Chunks are asked about in lots, and a report's result is in the table as soon as its last chunk has answered, so a run
    that is cut off has kept what was done; run again with the same run_id it goes on from its checkpoint, else it starts
    over with the reports that have no result.
    """
    run_id, table = run_id or uuid.uuid4().hex, _table(spark, o)
    work = f"{o.out}/runs/{run_id}"
    state = stateful.state_session(spark)
    if not files.exists(spark, f"{work}/chunks/_SUCCESS"):
        parts = _jobs(spark, o, _done(table, o.overwrite)).select("stem", F.posexplode(F.split("text", r"(?=\[\[page:\d+\]\])")).alias("page", "text"))
        packed = relational.packed_parts(parts, "stem", "page", "text", chunk).withColumnRenamed("chunk", "chunk_no")
        sized = packed.withColumn("chunks", F.count("*").over(Window.partitionBy("stem")).cast("int"))
        sized.repartition(lots, "stem", "chunk_no").write.mode("overwrite").parquet(f"{work}/chunks")
    arrived = incremental.arriving(state, f"{work}/chunks", "stem string, chunk_no int, text string, chunks int", files=1)
    answers = ports.ask(arrived, factory).withColumn("answered_at", F.current_timestamp())

    def land(batch: DataFrame, number: int) -> None:
        results, failures = ports.results(batch)
        merge.write_outputs(merge.flat_results(results), failures, f"{o.out}/coverage", f"{o.out}/failures", run_id)
        table.upsert(results.withColumn("run_id", F.lit(run_id)), f"{run_id}-{number}")

    stateful.gathered(answers, timeout).writeStream.foreachBatch(land).option("checkpointLocation", f"{work}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    coverage = UpsertTable(spark, f"{o.out}/coverage", ["stem"])
    return merge.corpus_averages(coverage.read().where(F.col("run_id") == run_id))


def worklist(spark: SparkSession, log: str, out: str, only: str | None = None, limit: int | None = None, exact: bool = False) -> DataFrame:
    """The failures of a download log (Parquet with run_id) that are worth another try, as CSV under out."""
    df = sinks.current(files.numbered(spark.read.parquet(log)), ["stem"], "ordinal")
    todo = selection.window(index.to_retry(df, only, exact), "ordinal", 0, limit)
    sinks.overwrite_csv(todo, out)
    return todo
