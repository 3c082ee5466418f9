"""Queries of the training-data problems (p1 to p9) and their SQL, where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadweave.session import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


# ------------------------------------------------------------------ 1: typed values to a canonical list


def _p1(spark: SparkSession, d: str) -> DataFrame:
    from leadweave.llm import canonical_map as cm

    countries, cities = table(spark, d, "ref_countries"), table(spark, d, "ref_cities")
    codes = cm.country_codes(countries)
    leads = cm.typed(table(spark, d, "leads").select("seq", "city", "country"), "city", cities, "city")
    lists = cm.typed(table(spark, d, "incoming_list").select("row_id", "country"), "country", countries, "country")
    towns = cm.map_list(leads, "city", "country", cities, "city_id", "country", ["city", "other_name"], codes)
    lands = cm.map_list(lists, "country", None, countries, "country_id", "code", ["country", "other_names"], codes, code_is_entry=True)
    return towns.select(F.lit("leads").alias("src"), F.col("seq").alias("row_id"), "ref_id", F.col("city").alias("value")).unionByName(
        lands.select(F.lit("incoming_list").alias("src"), "row_id", "ref_id", F.col("country").alias("value"))
    )


@query
def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Every typed town or country with the entry that it denotes, -1 if none."""
    return _p1(spark, d).select("src", "row_id", "ref_id")


@query
def p1_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """The report: values that denote no entry, with their number of rows."""
    return _p1(spark, d).filter("ref_id < 0").groupBy("src", "value").agg(F.count(F.lit(1)).alias("n_rows"))


# ------------------------------------------------------------------ 3: duplicates hidden by formatting


def _p3(spark: SparkSession, d: str):
    from leadweave.llm import ledger as lg
    from leadweave.session import cut

    rows = cut(lg.keyed(spark, d), "keys")
    return rows, *lg.replay(rows)


@query
def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Every row that isn't the first of its group of copies."""
    rows, ledger, total = _p3(spark, d)
    return ledger.copies(rows, total).filter("id <> first_id").select("src", "first_id", F.col("id").alias("row_id"))


@query
def p3_groups(spark: SparkSession, d: str) -> DataFrame:
    """One row a record: its first row and its number of copies."""
    rows, ledger, _ = _p3(spark, d)
    firsts = rows.select("src", "key", F.col("id").alias("first_id"))
    return firsts.join(ledger.read(), ["key", "first_id"]).select("src", "first_id", F.col("n").alias("n_copies"))


# ------------------------------------------------------------------ 7: test texts in training text


def _p7(spark: SparkSession, d: str) -> DataFrame:
    from leadweave.llm.leakage import leaks

    return leaks(table(spark, d, "documents").select("doc_id", "text"), table(spark, d, "eval_items"))


@query
def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Every document with the test item of which it holds a third or more."""
    return _p7(spark, d).select("doc_id", "item_id").distinct()


@query
def p7_passages(spark: SparkSession, d: str) -> DataFrame:
    """The same with the share covered and the longest verbatim match with its places."""
    return _p7(spark, d)


@query
def p7_clean(spark: SparkSession, d: str) -> DataFrame:
    """The documents that stay when those with test texts are removed."""
    from leadweave.llm.leakage import without_leaks

    return without_leaks(table(spark, d, "documents").select("doc_id", "source"), _p7(spark, d))


# ------------------------------------------------------------------ 8: sources to target weights


def _p8(spark: SparkSession, d: str):
    from leadweave.llm import mixture as mx

    sized = mx.sizes(table(spark, d, "documents").select("doc_id", "source", "text"))
    planned = mx.plan(sized, table(spark, d, "mix_targets"))
    return mx.mix(sized, planned), planned


@query
def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    """Every copy of a document in the mixture."""
    return _p8(spark, d)[0]


@query
def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    """The shares reached."""
    from leadweave.llm.mixture import shares

    return shares(*_p8(spark, d))


# ------------------------------------------------------------------ 9: abusive, hateful or sexual content


def _p9(spark: SparkSession, d: str) -> DataFrame:
    from leadweave.llm.safety import score

    return score(table(spark, d, "documents"), table(spark, d, "doc_labels"))


@query
def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Every document with language of a kind."""
    from leadweave.llm.safety import THRESHOLD

    return _p9(spark, d).filter(F.col("score") >= THRESHOLD).select("doc_id", "kind").distinct()


@query
def p9_scores(spark: SparkSession, d: str) -> DataFrame:
    """Score and evidence of every document and kind."""
    return _p9(spark, d)


@query
def p9_rates(spark: SparkSession, d: str) -> DataFrame:
    """Rates per source."""
    from leadweave.llm.safety import rates

    return rates(_p9(spark, d))


# ------------------------------------------------------------------ 6: new batches against all history


@query
def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Every lead that is known from the sent log, the campaign file or an earlier batch."""
    from leadweave.llm import known as kn

    providers = kn.provider_hosts(table(spark, d, "mail_providers"))
    return kn.known_leads(table(spark, d, "leads"), table(spark, d, "sent_log"), table(spark, d, "firmalar"), providers)


# ------------------------------------------------------------------ 5: variant spellings of names


def _p5(spark: SparkSession, d: str) -> DataFrame:
    from leadweave.llm import firms
    from leadweave.llm.known import provider_hosts
    from leadweave.llm.variants import name_classes

    rows = firms.source_rows(spark, d, ("leads", "firmalar", "incoming_list"))
    return name_classes(rows, provider_hosts(table(spark, d, "mail_providers")))


@query
def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Every pair of rows whose names are spelled differently and mean the same firm."""
    from leadweave.llm.variants import variant_pairs

    return variant_pairs(_p5(spark, d))


@query
def p5_classes(spark: SparkSession, d: str) -> DataFrame:
    """The class of every row with a readable name, and whether the name itself shows it or another column does."""
    from leadweave.llm.firms import SOURCES

    names = F.array(*[F.lit(s) for s in SOURCES])
    return _p5(spark, d).select(F.element_at(names, F.col("src").cast("int") + 1).alias("src"), F.col("id").alias("row_id"), "label", "named")


# ------------------------------------------------------------------ 4: entities across sources


def _p4(spark: SparkSession, d: str):
    from leadweave.llm import matching as mt
    from leadweave.llm.canonical_map import country_codes
    from leadweave.llm.known import provider_hosts

    return mt.matches(mt.matching_rows(spark, d), provider_hosts(table(spark, d, "mail_providers")), country_codes(table(spark, d, "ref_countries")))


@query
def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Every pair of rows of two tables that belong to the same firm."""
    from leadweave.llm import matching as mt

    return mt.cross_pairs(mt.firm_classes(*_p4(spark, d)))


@query
def p4_matches(spark: SparkSession, d: str) -> DataFrame:
    """Matches between records of two tables, each named by its first row, with their confidence."""
    from leadweave.llm.matching import SOURCES

    names = F.array(*[F.lit(s) for s in SOURCES])
    keyed, m = _p4(spark, d)
    one = keyed.groupBy("src", "k").agg(F.min("id").alias("id"))
    q, x = (one.select(F.col("src").alias(f"src_{s}"), F.col("k").alias(f"k_{s}"), F.col("id").alias(f"id_{s}")) for s in "qd")
    m = m.filter("src_q <> src_d").join(q, ["src_q", "k_q"]).join(x, ["src_d", "k_d"])
    return m.select(F.element_at(names, F.col("src_q") + 1).alias("src_a"), F.col("id_q").alias("id_a"), F.element_at(names, F.col("src_d") + 1).alias("src_b"), F.col("id_d").alias("id_b"), "score", "confidence")
