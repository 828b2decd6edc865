"""Reports processed as they arrive, each once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.relational import not_done
from ..sources.files import exists
from ..sources.upserts import UpsertTable


#: Folders of a ledger.
LEDGER = 64


def arriving(spark: SparkSession, path: str, schema, files: int = 8, discard: bool = False) -> DataFrame:
    """A stream of Parquet files; at most so many per trigger, which bounds what waits unprocessed."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files)
    if discard:
        reader = reader.option("cleanSource", "delete")
    return reader.parquet(path)


def run_once(stream: DataFrame, process: Callable[[DataFrame], DataFrame], keys: list[str], out: str, checkpoint: str) -> None:
    """Process what has arrived and isn't in out yet, then stop; run again, it does only what is new.

    A batch's rows replace those of an earlier try of the same batch, so a crash between write and checkpoint leaves no
    row twice. Which keys are done stands in a ledger beside out, of keys only, dealt by a hash into LEDGER folders; a
    batch reads the folders of its own keys.
    """
    spark = stream.sparkSession
    ledger = f"{out.rstrip('/')}-keys"

    def land(batch: DataFrame, number: int) -> None:
        lot = F.pmod(F.xxhash64(*keys), F.lit(LEDGER))
        dealt = batch.dropDuplicates(keys).withColumn("lot", lot.cast("int")).persist()
        new = dealt
        if exists(spark, ledger):
            lots = [r.lot for r in dealt.select("lot").distinct().collect()]  # at most LEDGER
            new = not_done(dealt, spark.read.parquet(ledger).where(F.col("lot").isin(lots) & (F.col("batch") != number)), ["lot", *keys])
        new = new.persist()
        process(new.drop("lot")).withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(out)
        new.select(*keys, "lot").withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "lot").parquet(ledger)
        new.unpersist()
        dealt.unpersist()

    stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def upsert(stream: DataFrame, table: UpsertTable, checkpoint: str, *order, name: str = "stream") -> None:
    """Merge what has arrived into a keyed table, then stop; a micro-batch that is tried again is merged once.

    Batches are named after the stream and the number of the micro-batch, so streams that write one table need names of
    their own, and a new checkpoint a new name.
    """

    def land(batch: DataFrame, number: int) -> None:
        table.upsert(batch, f"{name}-{number}", *order)

    stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def current_status(log: DataFrame, keys: list[str], time: str, tie: str, span: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """The last row of each key in each span of time of a streamed log, by time and tie, once the watermark has passed it.

    Rows may come up to delay late and more than once; what comes later still is left out. The state holds keys of open
    spans only, however long the log is. Merged into an upsert table with upsert(..., F.desc(time)), whose latest row of
    a key is then its current status.
    """
    spans = log.withWatermark(time, delay).groupBy(F.window(time, span), *keys)
    return spans.agg(F.max_by(F.struct(*log.columns), F.struct(time, tie)).alias("r")).select("r.*")
