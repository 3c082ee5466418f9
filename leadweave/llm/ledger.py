"""Duplicates hidden by formatting differences: an incremental ledger of canonical keys.

A record's key is a 128-bit digest of its fields without their writing. The ledger keeps, by bucket of the key, how
many copies of every key have come and the earliest representative. A new batch is aggregated first (partial sums
before the shuffle, so a key with a third of all rows costs one row a task), then full-outer-joined with the matching
buckets only; counts add up and the least id stays. Buckets that no key of the batch falls into are neither read nor
written. Every step writes new files and then its numbered state file, of which the greatest counts: an interrupted step
changes nothing, and a new process opens the folder and goes on. The files of the version before stay until the next
step, for those who still read them.

Defined results: NULL and blank fields are equal to each other; placeholders are missing in addresses only; fields of
any length count whole, since only their digest travels; repeated rows are copies; an empty batch changes nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadweave.llm.address import canon_address
from leadweave.llm.fold import canon
from leadweave.session import Pointer, cut, delete_path, list_names, table, work_path


def digest(*parts: Column) -> Column:
    """16 bytes of the parts in order; no part's text can imitate a border."""
    return F.unhex(F.md5(F.concat_ws("\x01", *parts)))


def unordered(a: Column, b: Column) -> Column:
    return F.concat_ws("\x02", F.least(a, b), F.greatest(a, b))


def lead_key(src: str = "leads") -> Column:
    """Leads: domain and email may have changed places."""
    return digest(F.lit(src), unordered(canon_address(F.col("domain")), canon_address(F.col("email"))), canon(F.col("name")), canon(F.col("city")), canon(F.col("country")))


def list_key(src: str = "incoming_list") -> Column:
    return digest(F.lit(src), canon(F.col("country")), canon(F.col("company")), canon_address(F.col("email")), canon_address(F.col("website")))


#: Keys that a bucket has room for when the ledger is made.
BUCKET_KEYS = 250_000


class Ledger:
    """Counts by key: ``key binary, n long, first_id long``, in ``buckets`` of a hash of the key."""

    SCHEMA = "key binary, n long, first_id long"

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int = 32):
        self.spark, self.path = spark, (path or work_path(spark, "ledger")).rstrip("/")
        self.pointer = Pointer(spark, self.path)
        self.buckets = self.pointer.read()[1].get("buckets", buckets)

    def read(self, buckets=None) -> DataFrame:
        parts = self.pointer.read()[1].get("parts", {})
        at = [f"{self.path}/{p}" for b, p in sorted(parts.items()) if buckets is None or int(b) in buckets]
        return self.spark.read.schema(self.SCHEMA).parquet(*at) if at else self.spark.createDataFrame([], self.SCHEMA)

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64("key"), F.lit(self.buckets)).cast("int")

    def add(self, batch: DataFrame) -> None:
        """Take in a batch of (``key``, ``id``)."""
        version, state = self.pointer.read()
        parts = dict(state.get("parts", {}))
        new = batch.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"))
        if parts:
            new = cut(new, "batch")
            touched = {r[0] for r in new.select(self.bucket().alias("b")).distinct().collect()}
            old = self.read(touched).select("key", F.col("n").alias("n0"), F.col("first_id").alias("f0"))
            whole = new.join(old, "key", "full_outer").select("key", (F.coalesce("n", F.lit(0)) + F.coalesce("n0", F.lit(0))).alias("n"), F.least("first_id", "f0").alias("first_id"))
        else:
            whole = new
        at = f"v{version + 1}-{uuid.uuid4().hex[:8]}"
        # as many tasks as buckets: both follow the size that the ledger was made for
        whole.withColumn("bucket", self.bucket()).repartition(self.buckets, "bucket").write.partitionBy("bucket").parquet(f"{self.path}/{at}")
        dirs = {n.split("=")[1]: f"{at}/{n}" for n in list_names(self.spark, f"{self.path}/{at}") if n.startswith("bucket=")}
        old_files = [parts[b] for b in dirs if b in parts]
        self.pointer.write(version + 1, {"buckets": self.buckets, "parts": parts | dirs, "old": old_files})
        for p in state.get("old", []):
            delete_path(self.spark, f"{self.path}/{p}")
        if parts:
            delete_path(self.spark, new._leadweave_path)

    def copies(self, rows: DataFrame, total: int, hot: int = 1000) -> DataFrame:
        """``rows`` (``key``, ``id``, ...) of keys with more than one copy, with ``first_id`` and ``n``.

        At most ``hot`` keys can hold a ``hot``-th of all rows each: those are broadcast, so their rows stay where
        they are; all other keys meet their rows in a shuffle.
        """
        many = self.read().filter("n > 1")
        big = F.col("n") >= F.lit(max(2, total // hot))
        heavy = F.broadcast(many.filter(big))
        there = rows.join(heavy, "key")
        rest = rows.join(heavy.select("key"), "key", "left_anti").join(many.filter(~big), "key")
        return there.unionByName(rest)


def keyed(spark: SparkSession, d: str) -> DataFrame:
    """(src, id, arrival, key) of both tables of a folder."""
    leads = table(spark, d, "leads").select(F.lit("leads").alias("src"), F.col("seq").alias("id"), F.coalesce(F.col("batch_no"), F.lit(0)).alias("arrival"), lead_key().alias("key"))
    lists = table(spark, d, "incoming_list").select(F.lit("incoming_list").alias("src"), F.col("row_id").alias("id"), F.coalesce(F.col("list_no"), F.lit(0)).alias("arrival"), list_key().alias("key"))
    return leads.unionByName(lists)


def replay(rows: DataFrame, rounds: int = 3, path: str | None = None) -> tuple[Ledger, int]:
    """The ledger after all arrivals of ``rows``, taken in in ``rounds`` batches in order of arrival; and the row count."""
    low, high, total = rows.agg(F.min("arrival"), F.max("arrival"), F.count(F.lit(1))).first()
    ledger = Ledger(rows.sparkSession, path, buckets=min(4096, max(8, total // BUCKET_KEYS)))
    if total:
        step = max(1, -(-(high - low + 1) // rounds))
        for at in range(low, high + 1, step):
            ledger.add(rows.filter((F.col("arrival") >= at) & (F.col("arrival") < at + step)))
    return ledger, total
