"""Sources: tagged map elements, link pages, seeds, and CSV files."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leadweave.constants import BATCH_OFFICE_TYPES, HREF, JUNK_HOSTS, OFFICE_TYPES, SOCIAL
from leadweave.functions import text as T
from leadweave.session import cut

ELEMENT = "type string, id long, tags map<string,string>"
RESPONSE = f"elements array<struct<{ELEMENT.replace(' ', ': ', 1).replace(', id ', ', id: ').replace(', tags ', ', tags: ')}>>"


def read_responses(spark: SparkSession, path: str, lines: bool = False, columns: str = "") -> DataFrame:
    """Elements of saved map responses (JSON, one a file or, with ``lines``, one a line), each with the ``columns`` (a
    schema) of its response."""
    schema = f"{columns}, {RESPONSE}" if columns else RESPONSE
    df = spark.read.schema(schema).json(path, multiLine=not lines)
    return df.select(*df.columns[:-1], F.explode("elements").alias("e")).select(*df.columns[:-1], "e.*")


def tag(*names: str) -> Column:
    """The first of some tags that isn't missing or empty, else ''."""
    return F.coalesce(*[F.nullif(F.try_element_at("tags", F.lit(n)), F.lit("")) for n in names], F.lit(""))


def ingest_osm(elements: DataFrame, area: str, country: str = "", types: tuple[str, ...] = OFFICE_TYPES) -> DataFrame:
    """Leads of map elements (``seq``, ``type``, ``tags``): one row a key, named by its first element, with the first
    valid address of any. Nodes and ways whose office is one of ``types``; relations don't count."""
    x = elements.filter(F.col("type").isin("node", "way") & F.try_element_at("tags", F.lit("office")).isin(*types))
    mail = tag("email", "contact:email")
    x = x.select("seq", T.lead_key(tag("website", "contact:website"), mail).alias("domain"), mail.alias("mail"), tag("name").alias("name"), F.coalesce(F.nullif(tag("addr:city"), F.lit("")), F.lit(area)).alias("city"))
    valid = T.is_email(T.strip(F.col("mail")))
    g = x.filter("domain <> ''").groupBy("domain").agg(
        F.min(F.struct("seq", "name", "city")).alias("f"), F.min(F.when(valid, F.struct("seq", T.strip(F.col("mail")).alias("mail")))).alias("m")
    )
    done = F.col("m").isNotNull()
    return g.select(
        F.col("f.seq").alias("seq"), "domain", F.col("f.name").alias("name"), F.col("f.city").alias("city"), F.lit(country).alias("country"), F.lit(f"osm:{area}").alias("source"),
        F.when(done, "done").otherwise("pending").alias("status"), F.col("m.mail").alias("email"), F.when(done, "OSM etiketinden").alias("note"),
    )


def first_variant(responses: DataFrame) -> DataFrame:
    """Of the name variants of each city (``city``, ``pos``, ``elements``), the first whose response has elements."""
    return responses.filter(F.size("elements") > 0).groupBy("city").agg(F.min_by("elements", "pos").alias("elements"))


def harvest(responses: DataFrame, only: str = "", types: tuple[str, ...] = BATCH_OFFICE_TYPES) -> DataFrame:
    """Elements (``ord``, ``country``, ``used``, ``seq``, ``domain``, ``name``, ``city``, ``mail``) of a batch of areas.

    ``responses``: ``ord`` (order of the areas), ``country``, ``pos`` and ``name`` of the area's name variants, and the
    ``elements`` found under it. ``only`` is a comma-separated list of countries, all if empty. Of each area the first
    variant with elements counts. Elements without a key are left out.
    """
    wanted = [c.strip().upper() for c in only.split(",") if c.strip()]
    x = responses.filter(F.col("country").isin(*wanted)) if wanted else responses
    x = x.filter(F.size("elements") > 0).groupBy("ord", "country").agg(F.min_by(F.struct("name", "elements"), "pos").alias("r"))
    x = x.select("ord", "country", F.col("r.name").alias("used"), F.posexplode("r.elements").alias("seq", "e")).select("ord", "country", "used", F.col("seq").cast("long").alias("seq"), "e.*")
    x = x.filter(F.col("type").isin("node", "way") & F.try_element_at("tags", F.lit("office")).isin(*types))
    mail = tag("email", "contact:email")
    x = x.select("ord", "country", "used", "seq", T.lead_key(tag("website", "contact:website"), mail).alias("domain"), tag("name").alias("name"), F.coalesce(F.nullif(tag("addr:city"), F.lit("")), "used").alias("city"), F.when(T.is_email(T.strip(mail)), T.strip(mail)).alias("mail"))
    return x.filter("domain <> ''")


def harvested_leads(elements: DataFrame) -> DataFrame:
    """Leads of :func:`harvest`: one a key, from its first element, done with the first valid address of any."""
    at = F.struct("ord", "seq")
    g = elements.groupBy("domain").agg(F.min_by(F.struct("ord", "name", "city", "country", "used"), at).alias("f"), F.min_by("mail", F.when(F.col("mail").isNotNull(), at)).alias("m"))
    done = F.col("m").isNotNull()
    return g.select(
        "domain", F.col("f.name").alias("name"), F.col("f.city").alias("city"), F.col("f.country").alias("country"), F.concat(F.lit("osm:"), F.col("f.used")).alias("source"), F.col("f.ord").alias("ord"),
        F.when(done, "done").otherwise("pending").alias("status"), F.col("m").alias("email"), F.when(done, "OSM etiketinden").alias("note"),
    )


def harvest_counts(elements: DataFrame, existing: DataFrame) -> DataFrame:
    """Per area (``ord``, ``country``, ``used``): its elements with a key, how many leads are new and how many elements
    have a valid address. The grand totals are the row with NULLs."""
    new = harvested_leads(elements).join(existing.select("domain"), "domain", "left_anti").filter(~F.col("domain").isin(*JUNK_HOSTS)).groupBy("ord").agg(F.count(F.lit(1)).alias("new"))
    per = elements.groupBy("ord", "country", "used").agg(F.count(F.lit(1)).alias("elements"), F.count("mail").alias("ready")).join(new, "ord", "left").withColumn("new", F.coalesce("new", F.lit(0)))
    total = per.agg(F.sum("elements").alias("elements"), F.sum("ready").alias("ready"), F.sum("new").alias("new"))
    return per.unionByName(total, allowMissingColumns=True)


def ingest_links(pages: DataFrame) -> DataFrame:
    """(url, domain) of absolute links of pages (``url``, ``html``), without the page's own host and social sites."""
    x = pages.select("url", T.host(F.col("url")).alias("own"), F.explode(F.regexp_extract_all(F.col("html"), F.lit(HREF), F.lit(1))).alias("link"))
    x = x.select("url", "own", T.host(F.col("link")).alias("domain"))
    social = F.col("domain").rlike("|".join(map(re.escape, SOCIAL)))
    return x.filter((F.col("domain") != "") & (F.col("domain") != F.col("own")) & ~social).select("url", "domain").distinct()


def ingest_seed(spark: SparkSession, domains: str, country: str = "", city: str = "") -> DataFrame:
    """Leads of a comma-separated list."""
    x = spark.range(1).select(F.posexplode(T.split_list(F.lit(domains))).alias("seq", "d"))
    return x.select(F.col("seq").cast("long").alias("seq"), T.stored_key(F.col("d")).alias("domain"), F.lit(city).alias("city"), F.lit(country).alias("country"), F.lit("seed").alias("source"))


def seeds(df: DataFrame, column: str, keep: list[str]) -> DataFrame:
    """``keep``, ``pos`` and ``domain`` of the comma-separated lists in a column."""
    return df.select(*keep, F.posexplode(T.split_list(F.col(column))).alias("pos", "d")).select(*keep, "pos", T.stored_key(F.col("d")).alias("domain"))


def curated_seed(targets: DataFrame, source: str = "taxtech-secili") -> DataFrame:
    """Leads of a hand-picked list (``seq``, ``domain``, ``name``, ``country``), of a source of their own."""
    return targets.select("seq", T.stored_key(F.col("domain")).alias("domain"), "name", F.lit("").alias("city"), "country", F.lit(source).alias("source"))


def read_csv(spark: SparkSession, path: str, columns: list[str], order: str | None = None) -> DataFrame:
    """A CSV file with a header, all columns text, empty fields ''; a missing file gives no rows.

    ``order`` names a column for the place of the row, from 0, in the files by name. A file with quoted line breaks
    isn't split, so its rows come in order; only the numbers of rows of the files go to one place.
    """
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    schema = ", ".join(f"`{c}` string" for c in columns)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], schema)
    df = spark.read.schema(schema).csv(path, header=True, multiLine=True, escape='"', enforceSchema=False, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    out = df.select(*[T.text(F.col(c)).alias(c) for c in columns])
    if order is None:
        return out
    x = cut(df.select(*[T.text(F.col(c)).alias(c) for c in columns], F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_at")), "csv")
    per = x.groupBy("_file").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    per = per.select("_file", (before - F.col("_first")).alias("_shift"))
    return x.join(per, "_file").select((F.col("_at") + F.col("_shift")).alias(order), *columns)


def write_csv(df: DataFrame, path: str, single: bool = True) -> None:
    """Text that a CSV reader of any language takes: header, CR LF, quotes doubled. An empty table gives its header.
    ``single`` writes one file, for results that people read."""
    out = df.coalesce(1) if single else df
    out.write.mode("overwrite").csv(path, header=True, lineSep="\r\n", escape='"', quote='"', emptyValue="", nullValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
