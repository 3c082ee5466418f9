"""The lead store: first-wins insertion, updates by key, the work queue, versioned snapshots, reports."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leadweave.constants import JUNK_HOSTS
from leadweave.functions import text as T
from leadweave.session import Pointer, cut, list_names

LEADS = "seq long, domain string, name string, city string, country string, source string, status string, email string, all_mails string, note string, checked_at timestamp"


def first_wins(rows: DataFrame, key: str = "domain", order: str = "seq") -> DataFrame:
    """The first row of each key. A group limit runs before the shuffle, so a hot key sends one row a task."""
    w = Window.partitionBy(key).orderBy(order)
    return rows.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def insert_absent(new: DataFrame, existing: DataFrame) -> DataFrame:
    """Rows of ``new`` to insert: stored key not empty, no junk host, first of its key, not there yet."""
    x = new.withColumn("domain", T.stored_key(F.col("domain"))).filter((F.col("domain") != "") & ~F.col("domain").isin(*JUNK_HOSTS))
    return first_wins(x).join(existing.select("domain"), "domain", "left_anti")


def promote_pending(leads: DataFrame, mails: DataFrame, now: Column | None = None) -> DataFrame:
    """Pending leads with a valid address in ``mails`` (domain, mail, seq) become done with the first one, checked at
    ``now`` (the current time)."""
    first = mails.filter(T.is_email(T.strip(F.col("mail")))).groupBy("domain").agg(F.min_by(T.strip(F.col("mail")), "seq").alias("_m"))
    x = leads.join(first, "domain", "left")
    turn = (F.col("status") == "pending") & F.col("_m").isNotNull()
    new = {"status": F.lit("done"), "email": F.col("_m"), "note": F.lit("OSM etiketinden"), "checked_at": clock(now)}
    return x.select(*[F.when(turn, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in leads.columns])


def apply_results(leads: DataFrame, results: DataFrame, now: Column | None = None) -> DataFrame:
    """Overwrite status, email, all_mails, note and time of leads that have a crawl result (one a domain)."""
    cols = ("status", "email", "all_mails", "note")
    r = results.select("domain", F.struct(*cols, clock(now).alias("checked_at")).alias("_r"))
    x = leads.join(r, "domain", "left")
    return x.select(*[F.when(F.col("_r").isNotNull(), F.col(f"_r.{c}")).otherwise(F.col(c)).alias(c) if c in (*cols, "checked_at") else F.col(c) for c in leads.columns])


def clock(now: Column | None) -> Column:
    """``now`` or the current time, to the second."""
    return F.date_trunc("second", F.current_timestamp() if now is None else now)


def queue_batch(leads: DataFrame, limit: int) -> DataFrame:
    """The next pending leads in order of insertion."""
    return leads.filter("status = 'pending'").orderBy("seq").limit(limit)


def status_counts(leads: DataFrame) -> DataFrame:
    return leads.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def pending_count(leads: DataFrame) -> DataFrame:
    return leads.agg(F.count_if(F.col("status") == "pending").alias("pending"))


def stats(leads: DataFrame, n: int = 8) -> DataFrame:
    """The report (``what``, ``name``, ``n``): the pool's size, leads by status, the sources with the most."""
    total = leads.agg(F.count(F.lit(1)).alias("n")).select(F.lit("total").alias("what"), F.lit(None).cast("string").alias("name"), "n")
    by_status = status_counts(leads).select(F.lit("status").alias("what"), F.col("status").alias("name"), "n")
    return total.unionByName(by_status).unionByName(top_sources(leads, n).select(F.lit("source").alias("what"), F.col("source").alias("name"), "n"))


def top_sources(leads: DataFrame, n: int = 8) -> DataFrame:
    """The sources with the most leads; ties by name."""
    return leads.groupBy("source").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc_nulls_first("source")).limit(n)


class Snapshots:
    """The lead table in buckets of its key. A version is a list of folders a bucket; a step writes new folders and then
    its version file (:class:`Pointer`), so nothing that is being read is overwritten, a step that fails changes
    nothing, and any process can open the store again.

    An insertion adds folders; results rewrite the buckets they touch, and so does an insertion into a bucket of more
    than ``parts`` folders.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 32, parts: int = 16):
        self.spark, self.path, self.parts = spark, path.rstrip("/"), parts
        self.pointer = Pointer(spark, self.path)
        self.buckets = self.pointer.read()[1].get("buckets", buckets)

    def version(self) -> int:
        return self.pointer.version()

    def bucket(self):
        return F.pmod(F.xxhash64("domain"), F.lit(self.buckets)).cast("int")

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        at = [p for b, ps in self.pointer.read()[1].get("parts", {}).items() if buckets is None or int(b) in buckets for p in ps]
        return self.spark.read.schema(LEADS).parquet(*[f"{self.path}/{p}" for p in at]) if at else self.spark.createDataFrame([], LEADS)

    def _touched(self, rows: DataFrame) -> list[int]:
        return [r[0] for r in rows.select(self.bucket().alias("b")).distinct().collect()]

    def _write(self, rows: DataFrame, replace: bool, last: int) -> int:
        """A new version with ``rows`` added to their buckets, or in place of them."""
        v, state = self.pointer.read()
        at = f"v{v + 1}-{uuid.uuid4().hex[:8]}"
        rows = rows.withColumn("_b", self.bucket())
        rows.repartition("_b").write.partitionBy("_b").parquet(f"{self.path}/{at}")
        new = {n.split("=")[1]: f"{at}/{n}" for n in list_names(self.spark, f"{self.path}/{at}") if n.startswith("_b=")}
        parts = dict(state.get("parts", {}))
        for b, p in new.items():
            parts[b] = [p] if replace else [*parts.get(b, []), p]
        self.pointer.write(v + 1, {"buckets": self.buckets, "parts": parts, "last": last})
        return v + 1

    def insert(self, new: DataFrame) -> int:
        """Insert absent leads; ``seq`` goes on from the largest. Running the same batch again changes nothing."""
        _, state = self.pointer.read()
        last, parts = state.get("last", 0), state.get("parts", {})
        rows = insert_absent(new, self.read().select("domain"))
        shape = self.spark.createDataFrame([], LEADS)
        have = [c for c in shape.columns if c in rows.columns and c != "seq"]
        rows = rows.withColumn("seq", F.col("seq") + last)
        rows = rows if "status" in have else rows.withColumn("status", F.lit("pending"))
        rows = cut(shape.unionByName(rows.select("seq", *dict.fromkeys([*have, "status"])), allowMissingColumns=True), "insert")
        n, high = rows.agg(F.count(F.lit(1)), F.max("seq")).first()
        if n:
            full = [int(b) for b, ps in parts.items() if len(ps) >= self.parts]
            self._write(rows, False, high)
            if full:
                self._write(self.read(full), True, high)
        return n

    def apply(self, results: DataFrame, now: Column | None = None) -> int:
        """Overwrite the leads that have a result (one a domain); only their buckets are read and written."""
        results = cut(results, "results")
        touched = self._touched(results)
        state = self.pointer.read()[1]
        old = self.read(touched or [-1])
        n = old.join(results.select("domain"), "domain", "left_semi").count()
        if n:
            self._write(apply_results(old, results, now), True, state.get("last", 0))
        return n
