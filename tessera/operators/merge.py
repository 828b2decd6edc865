"""Chunk results into report results, and report results into flat coverage rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.lexicon import MANDATORY, STANDARDS, STATUSES
from ..functions.text import let, repaired_json
from .relational import top_per_group

RESULT = """
document_meta struct<company:string,reporting_period:string,framework_version:string,consolidation_scope:string,assurance:string,iro2_index_present:boolean,extraction_method:string,index_rows_filtered:bigint>,
materiality_assessment struct<method_described:boolean,material_topics:array<string>,non_material_topics:array<string>,undetermined_topics:array<string>>,
disclosures array<struct<standard:string,dr_code:string,dr_title:string,status:string,confidence:double,
  evidence:array<struct<quote:string,page:int>>,datapoints:array<struct<name:string,value:double,unit:string,scope_or_breakdown:string,period:string,baseline_year:int,target_year:int,prior_year_value:double,qa_confidence:double>>,
  quality_flags:array<string>,notes:string>>,
coverage_summary struct<esrs2_complete:boolean,material_drs_reported:bigint,material_drs_missing:bigint,phase_ins_invoked:array<string>>
"""


def parsed(answers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Results and failures of answers(stem, chunk_no, raw): rows with the repaired JSON as result, rows with an error.

    Answers that have been repaired already carry it as __json.
    """
    rows = answers if "__json" in answers.columns else answers.withColumn("__json", repaired_json(F.col("raw")))
    good = rows.where("__json is not null").select("stem", "chunk_no", F.from_json("__json", RESULT).alias("result"))
    return good, rows.where("__json is null").select("stem", F.concat(F.lit("unparseable: "), F.substring(F.coalesce("raw", F.lit("")), 1, 200)).alias("error"))


def variants(answers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """As parsed(), with the result as a variant v: fields that no schema names and values of any type are kept."""
    rows = answers.withColumn("v", F.try_parse_json(repaired_json(F.col("raw"))))
    return rows.where("v is not null").drop("raw"), rows.where("v is null").select("stem", F.concat(F.lit("unparseable: "), F.substring(F.coalesce("raw", F.lit("")), 1, 200)).alias("error"))


def shredded(rows: DataFrame, fields: dict[str, str], v: str = "v") -> DataFrame:
    """rows with a typed column for each of fields (name: type) of the variant v, what drifted, and what is unknown.

    A value that the type can hold is cast to it. Of one that it can't, the column is null and drift, an array of
    struct(field, found), has its field and the type that was found. unknown are the names of fields beside these, sorted.
    """
    path = lambda f: f"$['{f}']" if not f.isidentifier() else f"$.{f}"
    at = lambda f: F.try_variant_get(v, path(f), "variant")
    typed = {f: F.try_variant_get(v, path(f), t) for f, t in fields.items()}
    said = lambda f: at(f).isNotNull() & ~F.is_variant_null(at(f))
    drift = [F.when(typed[f].isNull() & said(f), F.struct(F.lit(f).alias("field"), F.schema_of_variant(at(f)).alias("found"))) for f in fields]
    names = F.json_object_keys(F.to_json(v))
    unknown = F.array_sort(F.array_except(F.coalesce(names, F.array().cast("array<string>")), F.array(*map(F.lit, fields))))
    return rows.select("*", *[c.alias(f) for f, c in typed.items()], F.array_compact(F.array(*drift)).alias("drift"), unknown.alias("unknown"))


def drift_counts(rows: DataFrame) -> DataFrame:
    """field, found, n of the drift of shredded() rows; an unknown field is one whose found is unknown."""
    each = F.concat("drift", F.transform("unknown", lambda f: F.struct(f.alias("field"), F.lit("unknown").alias("found"))))
    return rows.select(F.explode(each).alias("d")).groupBy("d.field", "d.found").agg(F.count("*").alias("n"))


def exploded(results: DataFrame) -> DataFrame:
    """The disclosures of results(stem, chunk_no, result) as rows."""
    rows = results.select("stem", "chunk_no", F.posexplode("result.disclosures").alias("pos", "d"))
    return rows.select("stem", "chunk_no", "pos", "d.*").withColumn("n_datapoints", F.coalesce(F.size("datapoints"), F.lit(0)))


def best_disclosures(rows: DataFrame) -> DataFrame:
    """Of rows(stem, chunk_no, pos, dr_code, confidence, ...) the most confident of each code, first on ties; a null
    confidence is 0. Rows without code all stay."""
    keyed = top_per_group(rows.where("dr_code is not null"), ["stem", "dr_code"], 1, F.desc(F.coalesce("confidence", F.lit(0.0))), "chunk_no", "pos", rank="__r").drop("__r")
    return keyed.unionByName(rows.where("dr_code is null"))


def meta_chunk(chunks: DataFrame) -> DataFrame:
    """Of chunks(stem, chunk_no, material_topics, ...) the first with material topics, else the first."""
    w = Window.partitionBy("stem").orderBy((F.coalesce(F.size("material_topics"), F.lit(0)) <= 0).cast("int"), "chunk_no")
    return chunks.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def coverage_summary(disclosures: DataFrame) -> DataFrame:
    """stem, material_drs_reported, material_drs_missing, phase_ins_invoked, esrs2_complete."""
    code = lambda s: F.when(F.col("status") == s, F.col("dr_code"))
    mandatory = F.count_distinct(F.when((F.col("status") == "reported") & F.col("dr_code").isin(*MANDATORY), F.col("dr_code")))
    return disclosures.groupBy("stem").agg(F.count_distinct(code("reported")).alias("material_drs_reported"), F.count_if(F.col("status") == "material_not_reported").alias("material_drs_missing"), F.array_join(F.array_sort(F.collect_set(code("phase_in_deferred"))), "|").alias("phase_ins_invoked"), (mandatory == len(MANDATORY)).alias("esrs2_complete"))


def flatten(disclosures: DataFrame) -> DataFrame:
    """One wide row per stem of disclosures(stem, standard, dr_code, status, confidence, n_datapoints, quality_flags)."""
    reported = F.col("status") == "reported"
    place = F.coalesce("standard", "dr_code")
    mandatory = F.count_distinct(F.when(reported & F.col("dr_code").isin(*MANDATORY), F.col("dr_code")))
    flags = F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("quality_flags")))), "|")
    return disclosures.groupBy("stem").agg(
        F.count("*").alias("n_disclosures"), *[F.count_if(F.col("status") == s).alias(f"n_{s}") for s in STATUSES], mandatory.alias("esrs2_reported"), F.lit(len(MANDATORY)).cast("long").alias("esrs2_total"), (mandatory == len(MANDATORY)).alias("esrs2_complete"),
        *[F.count_if(reported & place.startswith(s)).alias(f"{s.lower()}_reported") for s in STANDARDS], F.coalesce(F.sum("n_datapoints"), F.lit(0)).cast("long").alias("n_datapoints"), F.sum(F.size("quality_flags")).cast("long").alias("n_quality_flags"), flags.alias("quality_flags"), F.round(F.avg("confidence"), 3).alias("avg_confidence"),
    )


def merged(results: DataFrame) -> DataFrame:
    """stem, result: one result per report of results(stem, chunk_no, result).

    A single chunk's result passes as it is. Of several the most confident disclosure of each code stays, then those
    without code; meta and materiality come from the first chunk with material topics, else from the first; the coverage
    summary is counted over the merged disclosures.
    """
    kind = results.select("result.disclosures").schema[0].dataType
    fields = ["standard", "dr_code", "dr_title", "status", "confidence", "evidence", "datapoints", "quality_flags", "notes"]
    # One shuffle brings a report's chunks together; what follows is sorted inside its row.
    whole = results.groupBy("stem").agg(F.array_sort(F.collect_list(F.struct("chunk_no", "result"))).alias("__all"))

    def of_chunk(c: Column) -> Column:
        ds = F.coalesce(c["result"]["disclosures"], F.array().cast(kind))
        return F.transform(ds, lambda d, i: F.struct((-F.coalesce(d["confidence"], F.lit(0.0))).alias("less"), c["chunk_no"].alias("chunk_no"), i.alias("pos"), F.struct(*[d[f].alias(f) for f in fields]).alias("d")))

    def firsts(rows: Column, *order: str) -> Column:
        """The first row of each code by order, codes in their order."""
        placed = F.array_sort(F.transform(rows, lambda r: F.struct(r["d"]["dr_code"].alias("code"), *[r[o].alias(o) for o in order], r["d"].alias("d"))))
        return let(placed, lambda s: F.filter(s, lambda r, i: (i == 0) | (F.get(s, i - 1)["code"] != r["code"])))

    def merged_rows(rows: Column) -> Column:
        # A code keeps the place where it first occurred; disclosures without code follow.
        keyed, loose = F.filter(rows, lambda r: r["d"]["dr_code"].isNotNull()), F.filter(rows, lambda r: r["d"]["dr_code"].isNull())
        best = F.arrays_zip(firsts(keyed, "chunk_no", "pos").alias("at"), firsts(keyed, "less", "chunk_no", "pos").alias("best"))
        coded = F.transform(best, lambda x: F.struct(x["at"]["chunk_no"].alias("chunk_no"), x["at"]["pos"].alias("pos"), x["best"]["d"].alias("d")))
        rest = F.transform(loose, lambda r: F.struct(r["chunk_no"].alias("chunk_no"), r["pos"].alias("pos"), r["d"].alias("d")))
        return F.transform(F.concat(F.array_sort(coded), F.array_sort(rest)), lambda x: x["d"])

    topics = lambda c: F.coalesce(F.size(c["result"]["materiality_assessment"]["material_topics"]), F.lit(0)) > 0
    head = F.coalesce(F.get(F.filter("__all", topics), F.lit(0)), F.get("__all", F.lit(0)))["result"]
    several = whole.where(F.size("__all") > 1)
    many = several.select("stem", head["document_meta"].alias("document_meta"), head["materiality_assessment"].alias("materiality_assessment"), let(F.flatten(F.transform("__all", of_chunk)), merged_rows).cast(kind).alias("disclosures"))
    codes = lambda s: F.transform(F.filter("disclosures", lambda d: d["status"] == s), lambda d: d["dr_code"])
    reported = F.array_distinct(codes("reported"))
    cover = F.struct(
        (F.size(F.array_except(F.array(*map(F.lit, MANDATORY)), reported)) == 0).alias("esrs2_complete"), F.size(reported).cast("long").alias("material_drs_reported"),
        F.size(codes("material_not_reported")).cast("long").alias("material_drs_missing"), codes("phase_in_deferred").alias("phase_ins_invoked"),
    )
    one = whole.where(F.size("__all") == 1).select("stem", F.get("__all", F.lit(0))["result"].alias("result"))
    return one.unionByName(many.select("stem", F.struct("document_meta", "materiality_assessment", "disclosures", cover.alias("coverage_summary")).alias("result")))


def flat_results(results: DataFrame, meta: DataFrame | None = None) -> DataFrame:
    """One wide row per row of results(stem, result), after meta's columns: counts as in flatten(), topics, and what the
    result says of itself. A completeness that the result states wins over the counted one."""
    r = lambda c: F.col(f"result.{c}")
    ds = F.coalesce(r("disclosures"), F.array().cast(results.select("result.disclosures").schema[0].dataType))
    is_ = lambda d, s: F.coalesce(d["status"] == s, F.lit(False))
    count = lambda s, start="": F.size(F.filter(ds, lambda d: is_(d, s) & place(d).startswith(start))).cast("long")
    codes = F.array_distinct(F.transform(F.filter(ds, lambda d: is_(d, "reported")), lambda d: d["dr_code"]))
    place = lambda d: F.coalesce(d["standard"], d["dr_code"], F.lit(""))
    flags = F.flatten(F.transform(ds, lambda d: F.coalesce(d["quality_flags"], F.array().cast("array<string>"))))
    sure = F.filter(F.transform(ds, lambda d: d["confidence"]), lambda c: c.isNotNull())
    mandatory = F.size(F.array_intersect(F.array(*map(F.lit, MANDATORY)), codes))
    pipe = lambda c: F.coalesce(F.array_join(r(c), "|"), F.lit(""))
    yes = lambda c: F.coalesce(r(c), F.lit(False))
    out = results.select(
        "stem", F.size(ds).cast("long").alias("n_disclosures"), *[count(s).alias(f"n_{s}") for s in STATUSES], mandatory.cast("long").alias("esrs2_reported"), F.lit(len(MANDATORY)).cast("long").alias("esrs2_total"),
        F.coalesce(r("coverage_summary.esrs2_complete"), mandatory == len(MANDATORY)).alias("esrs2_complete"), *[count("reported", s).alias(f"{s.lower()}_reported") for s in STANDARDS],
        pipe("materiality_assessment.material_topics").alias("material_topics"), pipe("materiality_assessment.non_material_topics").alias("non_material_topics"), yes("materiality_assessment.method_described").alias("materiality_method_described"), pipe("coverage_summary.phase_ins_invoked").alias("phase_ins_invoked"),
        F.aggregate(ds, F.lit(0).cast("long"), lambda n, d: n + F.coalesce(F.size(d["datapoints"]), F.lit(0))).alias("n_datapoints"), F.size(flags).cast("long").alias("n_quality_flags"), F.array_join(F.array_sort(F.array_distinct(flags)), "|").alias("quality_flags"),
        F.round(F.aggregate(sure, F.lit(0.0), lambda s, c: s + c) / F.nullif(F.size(sure), F.lit(0)), 3).alias("avg_confidence"), F.coalesce(r("document_meta.assurance"), F.lit("unknown")).alias("assurance"), yes("document_meta.iro2_index_present").alias("iro2_index_present"),
    )
    return out if meta is None else meta.join(out, "stem")


def corpus_averages(coverage: DataFrame) -> DataFrame:
    return coverage.agg(*[F.round(F.avg(f"n_{s}"), 6).alias(f"avg_{s}") for s in STATUSES], F.count_if("esrs2_complete").alias("complete"))


def write_outputs(rows: DataFrame, failures: DataFrame, out: str, failed: str, run_id: str) -> DataFrame:
    """Merge the rows of a run into the table at out by stem, put failures aside, and give the averages of the run's rows.

    Rows of other stems stay, whatever run wrote them. A stem that has a row is no failure any more.
    """
    from ..sources import sinks, upserts

    spark = rows.sparkSession
    table, aside = upserts.UpsertTable(spark, out, ["stem"]), upserts.UpsertTable(spark, f"{failed}-table", ["stem"])
    table.upsert(rows.withColumn("run_id", F.lit(run_id)))
    written = table.read().where(F.col("run_id") == run_id)
    gone = written.select("stem", F.lit(None).cast("string").alias("error"), F.lit(True).alias("gone"))
    aside.upsert(failures.select("stem", "error", F.lit(False).alias("gone")).unionByName(gone), None, F.col("gone"), deleted=F.col("gone"))
    sinks.overwrite_csv(aside.read().select("stem", "error"), failed)
    return corpus_averages(written)
