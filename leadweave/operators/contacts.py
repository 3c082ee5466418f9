"""Published addresses: find and decode them in pages, clean and rank them, take the first page that yields."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadweave.constants import CF_ATTRIBUTE, CONTACT_PATHS, EMAIL, FREEMAIL, JUNK_HOSTS, JUNK_LOCALS, JUNK_SUBSTRINGS
from leadweave.functions import text as T


def find_mails(html: Column) -> Column:
    """Addresses of a page, plain and decoded ones, each once. Pages without either sign skip the expressions."""
    plain = F.when(F.contains(html, F.lit("@")), F.regexp_extract_all(html, F.lit(f"({EMAIL})"), F.lit(1)))
    hexed = F.when(F.contains(html, F.lit("data-cfemail")), F.regexp_extract_all(html, F.lit(CF_ATTRIBUTE), F.lit(1)))
    none = F.array().cast("array<string>")
    decoded = F.filter(F.transform(F.coalesce(hexed, none), T.cf_decode), lambda m: F.contains(m, F.lit("@")))
    return F.array_union(F.coalesce(plain, none), decoded)


def keep_mail(m: Column, domain: Column, strict: bool = False) -> Column:
    """The rules for one tidy address of a domain: shape, length, junk, ownership.

    An address is the firm's own on its host, below it, where the host contains the domain's last two labels
    (``strict``: equals them), or at a mail provider.
    """
    local, at = F.substring_index(m, "@", 1), F.substring_index(m, "@", -1)
    junk = m.rlike("|".join(map(re.escape, JUNK_SUBSTRINGS)))
    near = (T.root(at) == T.root(domain)) if strict else F.contains(at, T.root(domain))
    own = (at == domain) | F.endswith(at, F.concat(F.lit("."), domain)) | near | at.isin(*FREEMAIL)
    return T.is_email(m) & (F.length(m) <= 90) & ~junk & ~local.isin(*JUNK_LOCALS) & ~at.isin(*JUNK_HOSTS) & own


def clean_mails(raw: Column, domain: Column, strict: bool = False) -> Column:
    """Addresses that pass the rules, each once, best first."""
    kept = F.filter(F.array_distinct(F.transform(raw, T.tidy_mail)), lambda m: keep_mail(m, domain, strict))
    return F.transform(F.array_sort(F.transform(kept, T.rank)), lambda r: r["m"])


def frontier(hosts: DataFrame, paths: tuple[str, ...] = CONTACT_PATHS, schemes: tuple[str, ...] = ("https", "http")) -> DataFrame:
    """Every page to try for every ``domain``, in order: (domain, scheme, path_idx, path, ord, url)."""
    tries = F.array(*[F.struct(F.lit(s).alias("scheme"), F.lit(k).alias("path_idx"), F.lit(p).alias("path"), F.lit(i * len(paths) + k).alias("ord")) for i, s in enumerate(schemes) for k, p in enumerate(paths)])
    x = hosts.select("domain", F.explode(tries).alias("t")).select("domain", "t.*")
    return x.withColumn("url", T.join_url(F.concat("scheme", F.lit("://"), "domain"), F.col("path")))


def extract_sites(fetch: DataFrame, strict: bool = False) -> DataFrame:
    """(domain, status, email, all_mails, note) of fetched pages (domain, scheme, ord, path, http_status, error, html).

    The first page with a clean address wins. Pages over http count only if https found no address at all and its
    last failure wasn't an HTTP status. Without a hit the last failure decides: ``error`` unless it is none or a 4xx.
    One aggregation by domain; pages are reduced before the shuffle, so a domain with very many pages is no hot spot.
    """
    ok = F.col("error").isNull() & (F.col("http_status") < 400)
    raw = F.when(ok, find_mails(F.col("html")))
    none = F.array().cast("array<string>")
    p = fetch.select("domain", "scheme", "ord", "path", F.coalesce(raw, none).alias("raw"), F.when(~ok, F.coalesce("error", F.concat(F.lit("HTTP "), F.col("http_status")))).alias("fail"))
    p = p.withColumn("hit", clean_mails(F.col("raw"), F.col("domain"), strict)).withColumn("top", F.when(F.size("hit") > 0, F.struct("ord", "path", "hit")))
    s = lambda name: F.col("scheme") == name
    g = p.groupBy("domain").agg(
        F.min(F.when(s("https"), F.col("top"))).alias("a"),
        F.min(F.when(s("http"), F.col("top"))).alias("b"),
        F.max(F.when(s("https") & F.col("fail").isNotNull(), F.struct("ord", "fail")))["fail"].alias("fa"),
        F.max(F.when(s("http") & F.col("fail").isNotNull(), F.struct("ord", "fail")))["fail"].alias("fb"),
        F.max(s("https") & (F.size("raw") > 0)).alias("seen"),
    )
    second = ~F.coalesce("seen", F.lit(False)) & ~F.startswith(F.coalesce("fa", F.lit("")), F.lit("HTTP"))
    g = g.withColumn("top", F.coalesce("a", F.when(second, F.col("b")))).withColumn("fail", F.when(second, F.coalesce("fb", "fa")).otherwise(F.col("fa")))
    g = g.withColumn("hit", F.col("top.hit"))
    status = F.when(F.col("hit").isNotNull(), "done").when(F.col("fail").isNotNull() & ~F.startswith("fail", F.lit("HTTP 4")), "error").otherwise("noemail")
    note = F.when(F.col("hit").isNotNull(), F.concat(F.lit("bulundu: "), F.when(F.col("top.path") == "", "/").otherwise(F.col("top.path")))).otherwise(F.coalesce("fail", F.lit("")))
    return g.select("domain", status.alias("status"), F.try_element_at("hit", F.lit(1)).alias("email"), F.coalesce(F.concat_ws(",", F.slice("hit", 1, 6)), F.lit("")).alias("all_mails"), note.alias("note"))


def crawl(queue: DataFrame, fetch: DataFrame, strict: bool = False) -> DataFrame:
    """One result for every ``domain`` of a queue: a key that is an address is its own result, a site without any page
    has none and no failure."""
    q = queue.select("domain").filter("domain is not null").distinct()
    mail = F.contains("domain", F.lit("@"))
    own = q.filter(mail).select("domain", F.lit("done").alias("status"), F.col("domain").alias("email"), F.col("domain").alias("all_mails"), F.lit("kaynak etiketinden").alias("note"))
    sites = q.filter(~mail)
    seen = extract_sites(fetch.join(sites, "domain", "left_semi"), strict)
    x = sites.join(seen, "domain", "left")
    x = x.select("domain", F.coalesce("status", F.lit("noemail")).alias("status"), "email", F.coalesce("all_mails", F.lit("")).alias("all_mails"), F.coalesce("note", F.lit("")).alias("note"))
    return own.unionByName(x)


def crawl_counts(results: DataFrame) -> DataFrame:
    """One row: results and how many of them have an address."""
    return results.agg(F.count(F.lit(1)).alias("sites"), F.count_if(F.col("email").isNotNull()).alias("with_mail"))


VERIFY_PATHS = 10


def verify_claims(claims: DataFrame, fetch: DataFrame) -> DataFrame:
    """(row_id, outcome) of claims (row_id, email, website, source_url) against pages (domain, path_idx, url,
    http_status, error, html).

    A claim's pages are the one at ``source_url`` and the first ten contact pages of its website. ``site-yok``: no
    website, whatever the source; ``DOGRULANDI``: one of its pages that came without an error and below 400 shows the
    address, as it stands or obfuscated; ``sitede-yok``: there is such a page, none shows it; ``erisilemedi``: there is
    none. Pages are reduced to their addresses, partly before the shuffle; a claim meets one row a (place, address).
    """
    c = claims.select("row_id", F.lower(T.strip(F.col("email"))).alias("mail"), F.nullif(T.host(F.col("website")), F.lit("")).alias("domain"), (T.strip(F.col("website")) == "").alias("none"), F.nullif("source_url", F.lit("")).alias("url"))
    ok = fetch.filter("error is null and http_status < 400")
    place = F.filter(F.array(F.when(F.col("path_idx") < VERIFY_PATHS, F.struct(F.lit("d").alias("kind"), F.col("domain").alias("at"))), F.struct(F.lit("u").alias("kind"), F.col("url").alias("at"))), lambda p: p["at"].isNotNull())
    # a page shows the empty address as well: whether there is a page at all
    mails = F.array_union(F.array(F.lit("")), F.transform(find_mails(F.col("html")), F.lower))
    shown = ok.select(F.explode(place).alias("p"), mails.alias("mails")).select("p.kind", "p.at", F.explode("mails").alias("mail")).distinct()

    def look(x: DataFrame, kind: str, at: str, mail: Column, flag: str) -> DataFrame:
        s = shown.filter(F.col("kind") == kind).select(F.col("at").alias(at), F.col("mail").alias("_m"), F.lit(True).alias(flag))
        return x.withColumn("_m", mail).join(s, [at, "_m"], "left").drop("_m")

    asked = F.nullif("mail", F.lit(""))
    x = look(look(c, "d", "domain", asked, "hit_d"), "u", "url", asked, "hit_u")
    x = look(look(x, "d", "domain", F.lit(""), "ok_d"), "u", "url", F.lit(""), "ok_u")
    outcome = F.when(F.col("none"), "site-yok").when(F.coalesce("hit_d", "hit_u"), "DOGRULANDI").when(F.coalesce("ok_d", "ok_u"), "sitede-yok").otherwise("erisilemedi")
    return x.select("row_id", outcome.alias("outcome"))


def verify_list(claims: DataFrame, fetch: DataFrame, banned: list[str]) -> tuple[DataFrame, DataFrame]:
    """(claims that were verified, with their columns; counters (``what``, ``n``)).

    Claims whose company, email or website contains one of ``banned`` aren't looked up. Counters: ``total``,
    ``banned``, ``candidates`` and every outcome.
    """
    hit = contains_any(text_blob(["company", "email", "website"]), banned)
    able = claims.filter(~hit)
    outcomes = verify_claims(able, fetch)
    kept = able.join(outcomes.filter("outcome = 'DOGRULANDI'").select("row_id"), "row_id", "left_semi").select(*claims.columns)
    count = claims.agg(F.count(F.lit(1)).alias("total"), F.count_if(hit).alias("banned"), F.count_if(~hit).alias("candidates"))
    count = count.select(F.explode(F.map_from_arrays(F.array(F.lit("total"), F.lit("banned"), F.lit("candidates")), F.array("total", "banned", "candidates"))).alias("what", "n"))
    return kept, count.unionByName(histogram(outcomes, "outcome", OUTCOMES).select(F.col("outcome").alias("what"), "n"))


OUTCOMES = ("DOGRULANDI", "sitede-yok", "erisilemedi", "site-yok")


def histogram(df: DataFrame, column: str, values: tuple[str, ...]) -> DataFrame:
    """Rows by value, with 0 for those of ``values`` that don't occur."""
    seen = df.select(F.col(column)).unionByName(df.sparkSession.createDataFrame([(v,) for v in values], f"{column} string").withColumn("zero", F.lit(0)), allowMissingColumns=True)
    return seen.groupBy(column).agg(F.count_if(F.col("zero").isNull()).alias("n"))


def text_blob(columns: list[str]) -> Column:
    """The columns joined by blanks, in lower case."""
    return F.lower(F.concat_ws(" ", *[T.text(F.col(c)) for c in columns]))


def contains_any(blob: Column, words: list[str]) -> Column:
    """Whether the text holds one of some words, inside others too."""
    return blob.rlike("|".join(map(re.escape, words))) if words else F.lit(False)


def keyword_filter(df: DataFrame, columns: list[str], keep: list[str], veto: list[str] = ()) -> DataFrame:
    """Rows whose columns, joined and in lower case, contain one of ``keep`` and none of ``veto``."""
    return df.filter(contains_any(text_blob(columns), keep) & ~contains_any(text_blob(columns), veto))


def filter_counts(df: DataFrame, columns: list[str], keep: list[str], veto: list[str] = ()) -> DataFrame:
    """One row: rows kept by :func:`keyword_filter` and all rows."""
    hit = contains_any(text_blob(columns), keep) & ~contains_any(text_blob(columns), veto)
    return df.agg(F.count_if(hit).alias("kept"), F.count(F.lit(1)).alias("total"))
