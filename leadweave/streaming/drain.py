"""The unattended loop as a stream: pending leads arrive as files, each micro-batch is crawled into the store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadweave.operators.contacts import crawl
from leadweave.operators.export import export, history
from leadweave.operators.store import Snapshots, stats

FETCH_BUCKETS = 64


def page_bucket() -> Column:
    return F.pmod(F.xxhash64("domain"), F.lit(FETCH_BUCKETS)).cast("int")


def write_fetch(fetch: DataFrame, path: str) -> None:
    """Fetched pages in partitions by a hash of their domain, so that a batch reads only those of its own domains."""
    fetch.withColumn("bucket", page_bucket()).repartition("bucket").write.partitionBy("bucket").parquet(path)


def drain(spark: SparkSession, leads_path: str, fetch_path: str, store: Snapshots, checkpoint: str, files: int = 1, now: Column | None = None) -> None:
    """Drain a folder of lead files (``domain``) against the pages of :func:`write_fetch` into the store.

    A restart goes on after the last finished batch; a batch that is done again writes the same results, so the
    outcome is the same however often it is interrupted.
    """

    def step(batch: DataFrame, number: int) -> None:
        mine = batch.select("domain").distinct()
        touched = [r[0] for r in mine.select(page_bucket().alias("b")).distinct().collect()]
        pages = batch.sparkSession.read.parquet(fetch_path).filter(F.col("bucket").isin(*touched or [-1])).drop("bucket")
        store.apply(crawl(mine, pages), now)

    stream = spark.readStream.schema("domain string").option("maxFilesPerTrigger", files).parquet(leads_path)
    query = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def unattended(spark: SparkSession, store: Snapshots, fetch_path: str, campaign: DataFrame, sent: DataFrame, work: str, files: int = 2, per_file: int = 10_000, now: Column | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Drain all pending leads of the store, then (rows to export, reasons of the others, report)."""
    pending = store.read().filter("status = 'pending'").select("domain")
    pending.write.option("maxRecordsPerFile", per_file).parquet(f"{work}/queue")
    drain(spark, f"{work}/queue", fetch_path, store, f"{work}/checkpoint", files, now)
    leads = store.read()
    return *export(leads, *history(campaign, sent)), stats(leads)
