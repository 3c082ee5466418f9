"""Export and merge: new rows against history by address and by organisation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadweave.constants import FREEMAIL
from leadweave.functions import text as T
from leadweave.session import cut


def history(campaign: DataFrame, sent: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(known mails, known organisations) of the campaign file and the sent log."""
    mail = F.lower(T.strip(F.col("email")))
    mails = sent.select(mail.alias("mail")).unionByName(campaign.select(mail.alias("mail"))).filter("mail <> ''").distinct()
    orgs = campaign.select(T.known_org_key(T.campaign_country(F.col("oncelik"), F.col("sehir")), F.col("site"), mail).alias("org")).distinct()
    return mails, orgs


def export(leads: DataFrame, mails: DataFrame, orgs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows to export, reasons of skipped ones).

    ``domain`` is unique, so rows that share an organisation share the address as well: known rows go first, then the
    first row of each address stays. Reasons in order: ``ulkesiz`` (no country), ``mail``, ``kurum``.
    """
    x = leads.filter("status = 'done' and email is not null").select("country", "domain", "name", "city", "note", F.lower(T.strip(F.col("email"))).alias("mail"))
    x = x.withColumn("cc", F.upper(T.strip(F.col("country"))))
    site = F.when(F.contains("domain", F.lit("@")) | F.col("domain").isin(*FREEMAIL), "").otherwise(F.col("domain"))
    x = x.withColumn("site", site).withColumn("org", T.org_key(F.col("cc"), F.col("site"), F.col("mail")))
    x = x.join(mails.withColumn("km", F.lit(True)), "mail", "left").join(orgs.withColumn("ko", F.lit(True)), "org", "left")
    able = (F.col("cc") != "") & F.col("km").isNull() & F.col("ko").isNull()
    x = x.withColumn("able", able).withColumn("at", F.struct(T.text(F.col("country")).alias("c"), F.col("domain").alias("d")))
    # the first able row of each address; partial minima before the shuffle, so a hot address costs one row a task
    first = x.filter("able").groupBy("mail").agg(F.min("at").alias("taken"))
    x = x.join(first, "mail", "left").withColumn("kept", F.col("able") & F.coalesce(F.col("at") == F.col("taken"), F.lit(False)))
    # a row of a known organisation whose address an earlier kept row took counts as 'mail'
    earlier = F.coalesce(F.col("taken") < F.col("at"), F.lit(False))
    reason = F.when(F.col("cc") == "", "ulkesiz").when(F.col("km") | earlier, "mail").otherwise("kurum")
    rows = x.filter("kept").select(F.concat("cc", F.lit("-EN")).alias("oncelik"), F.coalesce(F.nullif("name", F.lit("")), F.substring_index("mail", "@", 1)).alias("firma"), T.text(F.col("city")).alias("sehir"), F.col("mail").alias("email"), "site", T.text(F.col("note")).alias("dil_notu"))
    return rows, x.filter("not kept").select("domain", reason.alias("reason"))


def greedy(rows: DataFrame, order: str = "seq", a: str = "mail", b: str = "org") -> DataFrame:
    """The rows that a sequential pass keeps when a kept row blocks its two keys and a dropped one blocks none.

    Per round, rows that are the first of both their groups stay, and all that share a key with them go; rounds run
    until none is left. Every round is written to the shared folder; groups are reduced to their minimum before the
    shuffle, so hot keys cost one row a task.
    """
    left, kept = cut(rows.select(order, a, b), "greedy"), None
    while True:
        first = lambda k: left.groupBy(k).agg(F.min(order).alias(order))
        now = left.join(first(a).select(order, a), [order, a], "left_semi").join(first(b).select(order, b), [order, b], "left_semi")
        now = cut(now, "kept")
        kept = now if kept is None else kept.unionByName(now)
        left = cut(left.join(now.select(a), a, "left_anti").join(now.select(b), b, "left_anti"), "greedy", free=(left,))
        if left.isEmpty():
            return rows.join(kept.select(order), order, "left_semi")


def merge(verified: DataFrame, mails: DataFrame, orgs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows to add, reasons) of a verified list (seq, country, company, email, website[, contact_type, notes]).

    Reasons: ``ulke-kodu-yok`` (unknown country), ``mail``, ``kurum``; derived from what was kept before the row.
    """
    v = verified
    for c in ("contact_type", "notes"):
        if c not in v.columns:
            v = v.withColumn(c, F.lit(None).cast("string"))
    h = T.host(F.col("website"))
    x = v.withColumn("code", T.country_code(F.col("country"))).withColumn("mail", F.lower(T.strip(F.col("email")))).withColumn("site", F.when(h.isin(*FREEMAIL), "").otherwise(h))
    x = cut(x.withColumn("org", T.org_key(F.col("code"), F.col("site"), F.col("mail"))), "merge")
    coded = x.filter("code is not null")
    fresh = coded.join(mails, "mail", "left_anti").join(orgs, "org", "left_anti")
    kept = cut(greedy(fresh.select("seq", "mail", "org")).select("seq", "mail", "org"), "fresh")
    note = F.substring(F.concat_ws(" - ", F.nullif("contact_type", F.lit("")), F.nullif("notes", F.lit(""))), 1, 110)
    out = coded.join(kept.select("seq"), "seq", "left_semi")
    out = out.select("seq", F.concat("code", F.lit("-EN")).alias("oncelik"), T.strip(F.col("company")).alias("firma"), T.strip(F.col("country")).alias("sehir"), F.col("mail").alias("email"), "site", note.alias("dil_notu"))
    rest = x.join(kept.select("seq"), "seq", "left_anti").join(mails.withColumn("km", F.lit(True)), "mail", "left")
    rest = rest.join(kept.groupBy("mail").agg(F.min("seq").alias("by_mail")), "mail", "left")
    reason = F.when(F.col("code").isNull(), "ulke-kodu-yok").when(F.col("km") | (F.col("by_mail") < F.col("seq")), "mail").otherwise("kurum")
    return out, rest.select("seq", reason.alias("reason"))
