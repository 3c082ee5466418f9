"""Queries over the contact pipeline's operators, each with the SQL that says the same.

The tables hold no fetched pages and no map responses, so these queries derive them from the tables, in the same way
on both sides: a document is a page of its site, a row of the incoming list a map element.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadweave.constants import CF_ATTRIBUTE, CONTACT_PATHS, COUNTRY_CODES, EMAIL, FREEMAIL, HREF, JUNK_HOSTS, JUNK_LOCALS, JUNK_SUBSTRINGS, LEGACY_TAGS, OFFICE_TYPES, PRIORITY_LOCALS, SOCIAL  # noqa: F401
from leadweave.functions import text as T
from leadweave.operators import contacts, export as ex, store
from leadweave.plans.registry import query
from leadweave.session import table, work_path
from leadweave.sources import readers
from leadweave.streaming.drain import drain, unattended, write_fetch


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def values(xs) -> str:
    return "(" + ", ".join(q(x) for x in xs) + ")"


def d_strip(x: str) -> str:
    return f"regexp_replace(coalesce({x}, ''), {q(T.STRIP)}, '', 'g')"


def d_host(x: str) -> str:
    v = f"lower({d_strip(x)})"
    h = f"lower(regexp_extract(CASE WHEN contains({v}, '://') THEN {v} ELSE 'https://' || {v} END, {q(T.URL_HOST)}, 1))"
    return f"(CASE WHEN {v} IN ('', '-', 'n/a', 'none') OR starts_with({h}, '[') THEN '' ELSE regexp_replace({h}, '^www\\.', '') END)"


def d_valid(x: str) -> str:
    return f"regexp_full_match(coalesce({x}, ''), {q(EMAIL)})"


def d_key(site: str, mail: str) -> str:
    h, m = d_host(site), f"lower({d_strip(mail)})"
    return f"(CASE WHEN {h} <> '' AND {h} NOT IN {values(FREEMAIL)} THEN {h} WHEN {d_valid(m)} THEN {m} ELSE {h} END)"


def d_stored(x: str) -> str:
    return f"(CASE WHEN contains(coalesce({x}, ''), '@') THEN lower({d_strip(x)}) ELSE {d_host(x)} END)"


def d_country(tag: str, city: str) -> str:
    t = f"upper({d_strip(tag)})"
    cases = " ".join(f"WHEN {t} = {q(k)} THEN {q(v)}" if v != "AE" else f"WHEN {t} = {q(k)} THEN CASE WHEN contains(lower(coalesce({city}, '')), 'qatar') THEN 'QA' ELSE 'AE' END" for k, v in LEGACY_TAGS.items())
    return f"(CASE {cases} ELSE regexp_replace({t}, '-EN$', '') END)"


D_CLEAN = f"""(regexp_full_match(m, {q(EMAIL)}) AND length(m) <= 90
  AND NOT ({' OR '.join(f'contains(m, {q(s)})' for s in JUNK_SUBSTRINGS)})
  AND split_part(m, '@', 1) NOT IN {values(JUNK_LOCALS)} AND split_part(m, '@', -1) NOT IN {values(JUNK_HOSTS)}
  AND (split_part(m, '@', -1) = d OR ends_with(split_part(m, '@', -1), '.' || d)
       OR contains(split_part(m, '@', -1), regexp_extract(d, '(?:[^.]*\\.)?[^.]*$')) OR split_part(m, '@', -1) IN {values(FREEMAIL)}))"""
D_RANK = f"CASE WHEN split_part(m, '@', 1) IN {values(PRIORITY_LOCALS)} THEN 0 ELSE 1 END, length(m), m"


def d_tidy(x: str) -> str:
    return f"lower(trim({d_strip(x)}, {q(T.PUNCTUATION)}))"


@query(f"SELECT seq, {d_host('domain')} AS host FROM leads")
def host_normalize(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "leads").select("seq", T.host(F.col("domain")).alias("host"))


@query(f"SELECT seq, {d_key('domain', 'email')} AS key FROM leads")
def lead_keys(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "leads").select("seq", T.lead_key(F.col("domain"), F.col("email")).alias("key"))


@query(f"SELECT seq, coalesce(nullif({d_host('domain')}, ''), CASE WHEN contains(coalesce(email, ''), '@') THEN split_part(lower({d_strip('email')}), '@', -1) END, '') AS key FROM leads")
def batch_keys(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "leads").select("seq", T.batch_key(F.col("domain"), F.col("email")).alias("key"))


@query(f"SELECT seq, {d_valid('email')} AS ok FROM leads")
def email_valid(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "leads").select("seq", T.is_email(F.col("email")).alias("ok"))


@query(f"SELECT doc_id, mail, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(text, {q(EMAIL)})) AS mail FROM documents) GROUP BY ALL")
def email_findall(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").filter(F.contains("text", F.lit("@")))
    return docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(f"({EMAIL})"), F.lit(1))).alias("mail")).groupBy("doc_id", "mail").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH x AS (SELECT log_id, hex(email) AS h, coalesce(length(hex(email)), 0) // 2 AS n FROM sent_log),
b AS (SELECT log_id, n, list_transform(range(1, n + 1), lambda i: ('0x' || substr(h, 2 * i - 1, 2))::INT) AS b FROM x)
SELECT log_id, array_to_string(list_transform(b, lambda c: chr(c)), '') AS mail,
CASE WHEN n = 0 THEN '' ELSE array_to_string(list_transform(b[:n - 1], lambda c: chr(c)), '') || chr(xor(xor(b[n], 90) >> 4, 90)) END AS cut_mail, '' AS broken FROM b""")
def cf_decode(spark: SparkSession, d: str) -> DataFrame:
    """Addresses obfuscated here, byte by byte, and decoded again: whole, without their last digit, and broken."""
    raw = F.hex(F.encode(T.text(F.col("email")), "utf-8"))
    at = F.filter(F.sequence(F.lit(1), F.greatest(F.length(raw), F.lit(1)), F.lit(2)), lambda p: p < F.length(raw))
    byte = lambda p: F.lower(F.lpad(F.hex(F.conv(F.substring(raw, p, 2), 16, 10).cast("int").bitwiseXOR(F.lit(0x5A))), 2, "0"))
    hexed = F.concat(F.lit("5a"), F.array_join(F.transform(at, byte), ""))
    x = table(spark, d, "sent_log").select("log_id", hexed.alias("h"))
    html = F.concat(F.lit('<a data-cfemail="'), F.col("h"), F.lit('">'))
    short = F.when(F.length("h") > 2, F.expr("substring(h, 1, length(h) - 1)")).otherwise("")
    return x.select("log_id", T.cf_decode(F.regexp_extract(html, CF_ATTRIBUTE, 1)).alias("mail"), T.cf_decode(short).alias("cut_mail"), T.cf_decode(F.concat("h", F.lit("z"))).alias("broken"))


@query(f"""WITH r AS (SELECT seq, {d_host('domain')} AS d, unnest(string_split(all_mails, ',')) AS raw FROM leads WHERE all_mails IS NOT NULL),
t AS (SELECT DISTINCT seq, d, {d_tidy('raw')} AS m FROM r),
k AS (SELECT seq, m, row_number() OVER (PARTITION BY seq ORDER BY {D_RANK}) AS n FROM t WHERE {D_CLEAN})
SELECT seq, max(CASE WHEN n = 1 THEN m END) AS email, string_agg(m, ',' ORDER BY n) FILTER (WHERE n <= 6) AS all_mails FROM k GROUP BY seq""")
def clean_rank_emails(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "leads").filter("all_mails is not null").select("seq", contacts.clean_mails(F.split("all_mails", ","), T.host(F.col("domain"))).alias("m"))
    return x.filter(F.size("m") > 0).select("seq", F.get("m", F.lit(0)).alias("email"), F.concat_ws(",", F.slice("m", 1, 6)).alias("all_mails"))


@query(f"""WITH p AS (SELECT DISTINCT coalesce(source_url, '') AS url, unnest(regexp_extract_all('<a href="' || coalesce(website, '') || '"> <a href="' || coalesce(source_url, '') || '">', {q(HREF)}, 1)) AS link FROM incoming_list),
h AS (SELECT url, {d_host('url')} AS own, {d_host('link')} AS domain FROM p)
SELECT DISTINCT url, domain FROM h WHERE domain <> '' AND domain <> own AND NOT ({' OR '.join(f'contains(domain, {q(s)})' for s in SOCIAL)})""")
def links_harvest(spark: SparkSession, d: str) -> DataFrame:
    html = F.concat(F.lit('<a href="'), T.text(F.col("website")), F.lit('"> <a href="'), T.text(F.col("source_url")), F.lit('">'))
    return readers.ingest_links(table(spark, d, "incoming_list").select(T.text(F.col("source_url")).alias("url"), html.alias("html")))


PATHS = "(VALUES " + ", ".join(f"({k}, {q(p)})" for k, p in enumerate(CONTACT_PATHS)) + ") AS p(k, path)"


@query(f"""WITH h AS (SELECT DISTINCT {d_host('domain')} AS domain FROM leads)
SELECT domain, (s.i * {len(CONTACT_PATHS)} + p.k)::INT AS ord, s.scheme || '://' || domain || path AS url FROM h, (VALUES (0, 'https'), (1, 'http')) AS s(i, scheme), {PATHS} WHERE domain <> ''""")
def frontier(spark: SparkSession, d: str) -> DataFrame:
    hosts = table(spark, d, "leads").select(T.host(F.col("domain")).alias("domain")).filter("domain <> ''").distinct()
    return contacts.frontier(hosts).select("domain", "ord", "url")


def fetched(spark: SparkSession, d: str) -> DataFrame:
    """Documents as fetched pages of their sites."""
    i = F.col("doc_id")
    status = F.when(i % 7 == 0, 404).when(i % 11 == 0, 503).otherwise(200)
    return table(spark, d, "documents").filter("site is not null").select(
        F.lower("site").alias("domain"), F.when(i % 5 == 0, "http").otherwise("https").alias("scheme"), i.alias("ord"), F.concat(F.lit("/p"), i).alias("path"),
        (i % len(CONTACT_PATHS)).cast("int").alias("path_idx"), F.concat(F.lit("https://"), F.lower("site"), F.element_at(F.array(*[F.lit(p) for p in CONTACT_PATHS]), (i % len(CONTACT_PATHS)).cast("int") + 1)).alias("url"),
        status.alias("http_status"), F.when(i % 13 == 0, "ConnectTimeout").alias("error"), T.text(F.col("text")).alias("html"),
    )


D_FETCH = f"""pages AS (SELECT lower(site) AS domain, CASE WHEN doc_id % 5 = 0 THEN 'http' ELSE 'https' END AS scheme, doc_id AS ord, '/p' || doc_id AS path, (doc_id % {len(CONTACT_PATHS)})::INT AS path_idx,
'https://' || lower(site) || [{', '.join(q(p) for p in CONTACT_PATHS)}][doc_id % {len(CONTACT_PATHS)} + 1] AS url,
CASE WHEN doc_id % 7 = 0 THEN 404 WHEN doc_id % 11 = 0 THEN 503 ELSE 200 END AS http_status, CASE WHEN doc_id % 13 = 0 THEN 'ConnectTimeout' END AS error, coalesce(text, '') AS html FROM documents WHERE site IS NOT NULL)"""
D_SITES = f"""{D_FETCH},
raws AS (SELECT domain, scheme, ord, path, unnest(regexp_extract_all(html, {q(EMAIL)})) AS raw FROM pages WHERE error IS NULL AND http_status < 400),
mails AS (SELECT DISTINCT domain AS d, scheme, ord, path, {d_tidy('raw')} AS m FROM raws),
good AS (SELECT * FROM mails WHERE {D_CLEAN}),
firsts AS (SELECT d, min(CASE WHEN scheme = 'https' THEN ord END) AS a, min(CASE WHEN scheme = 'http' THEN ord END) AS b FROM good GROUP BY d),
fails AS (SELECT *, coalesce(error, 'HTTP ' || http_status) AS fail FROM pages WHERE error IS NOT NULL OR http_status >= 400),
lasts AS (SELECT domain, arg_max(fail, ord) FILTER (WHERE scheme = 'https') AS fa, arg_max(fail, ord) FILTER (WHERE scheme = 'http') AS fb FROM fails GROUP BY domain),
seen AS (SELECT DISTINCT domain FROM raws WHERE scheme = 'https'),
one AS (SELECT f.domain, fi.a, fi.b, fa, fb, (s.domain IS NULL AND NOT starts_with(coalesce(fa, ''), 'HTTP')) AS second FROM (SELECT DISTINCT domain FROM pages) f
  LEFT JOIN firsts fi ON fi.d = f.domain LEFT JOIN lasts l ON l.domain = f.domain LEFT JOIN seen s ON s.domain = f.domain),
two AS (SELECT domain, coalesce(a, CASE WHEN second THEN b END) AS top, CASE WHEN second THEN coalesce(fb, fa) ELSE fa END AS fail FROM one),
ranked AS (SELECT d, ord, path, m, row_number() OVER (PARTITION BY d, ord ORDER BY {D_RANK}) AS n FROM good),
best AS (SELECT d, ord, any_value(path) AS path, max(CASE WHEN n = 1 THEN m END) AS email, string_agg(m, ',' ORDER BY n) FILTER (WHERE n <= 6) AS all_mails FROM ranked GROUP BY d, ord),
sites AS (SELECT t.domain, CASE WHEN top IS NOT NULL THEN 'done' WHEN fail IS NOT NULL AND NOT starts_with(fail, 'HTTP 4') THEN 'error' ELSE 'noemail' END AS status,
  b.email, coalesce(b.all_mails, '') AS all_mails, CASE WHEN top IS NOT NULL THEN 'bulundu: ' || b.path ELSE coalesce(fail, '') END AS note
  FROM two t LEFT JOIN best b ON b.d = t.domain AND b.ord = t.top)"""


@query(f"WITH {D_SITES} SELECT * FROM sites")
def site_first_hit(spark: SparkSession, d: str) -> DataFrame:
    return contacts.extract_sites(fetched(spark, d))


@query(f"""WITH e AS (SELECT row_id AS seq, coalesce(website, '') AS site, coalesce(email, '') AS mail, coalesce(company, '') AS name FROM incoming_list
WHERE row_id % 10 <> 0 AND row_id % 3 <> 0),
k AS (SELECT *, {d_key('site', 'mail')} AS domain FROM e)
SELECT min(seq) AS seq, domain, arg_min(name, seq) AS name, 'Area' AS city, CASE WHEN count(*) FILTER (WHERE {d_valid(d_strip('mail'))}) > 0 THEN 'done' ELSE 'pending' END AS status,
arg_min({d_strip('mail')}, seq) FILTER (WHERE {d_valid(d_strip('mail'))}) AS email FROM k WHERE domain <> '' GROUP BY domain""")
def osm_ingest(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("row_id")
    tags = F.create_map(F.lit("name"), T.text(F.col("company")), F.lit("website"), F.lit(""), F.lit("contact:website"), T.text(F.col("website")), F.lit("email"), T.text(F.col("email")), F.lit("office"), F.when(i % 3 == 0, "consulting").otherwise("accountant"))
    kind = F.when(i % 10 == 0, "relation").when(i % 2 == 0, "way").otherwise("node")
    elements = table(spark, d, "incoming_list").select(i.alias("seq"), kind.alias("type"), tags.alias("tags"))
    return readers.ingest_osm(elements, "Area", "DE", OFFICE_TYPES).select("seq", "domain", "name", "city", "status", "email")


@query("""WITH v AS (SELECT city_id, city, unnest(list_filter([{'p': 0, 'name': city}, {'p': 1, 'name': other_name}], lambda x: x.name IS NOT NULL)) AS v FROM ref_cities),
found AS (SELECT city_id, city, v.p AS p FROM v WHERE NOT (city_id % 4 = 0 AND v.p = 0))
SELECT city_id, city, min(p) AS pos FROM found GROUP BY ALL""")
def city_variants(spark: SparkSession, d: str) -> DataFrame:
    """The first name variant of each town whose response isn't empty; every fourth town's first name finds nothing."""
    x = table(spark, d, "ref_cities").select("city_id", "city", F.posexplode(F.array_compact(F.array("city", "other_name"))).alias("pos", "name"))
    empty = F.array().cast("array<int>")
    r = x.select(F.struct("city_id", "city").alias("city"), "pos", F.when((F.col("city_id") % 4 == 0) & (F.col("pos") == 0), empty).otherwise(F.array("pos")).alias("elements"))
    return readers.first_variant(r).select("city.city_id", "city.city", F.get("elements", F.lit(0)).alias("pos"))


RESPONSE_ROWS, ONLY = 200, "de, NL ,TR"


def responses(spark: SparkSession, d: str) -> DataFrame:
    """Map responses saved as JSON lines and read again: the incoming list in areas of ``RESPONSE_ROWS`` rows, which have
    the towns' names and countries in turn. Every fourth area finds nothing under its first name."""
    i = F.col("row_id")
    tags = F.create_map(F.lit("name"), T.text(F.col("company")), F.lit("website"), F.lit(""), F.lit("contact:website"), T.text(F.col("website")), F.lit("contact:email"), T.text(F.col("email")), F.lit("office"), F.when(i % 3 == 0, "lawyer").when(i % 3 == 1, "consulting").otherwise("accountant"), F.lit("addr:city"), F.when(i % 2 == 0, T.text(F.col("country"))).otherwise(""))
    e = table(spark, d, "incoming_list").select(F.floor(i / RESPONSE_ROWS).alias("ord"), F.struct(F.when(i % 10 == 0, "relation").when(i % 4 < 2, "way").otherwise("node").alias("type"), i.alias("id"), tags.alias("tags")).alias("e"))
    e = e.groupBy("ord").agg(F.array_sort(F.collect_list("e"), lambda a, b: F.when(a["id"] < b["id"], -1).otherwise(1)).alias("elements"))
    towns = table(spark, d, "ref_cities")
    n = towns.agg(F.max("city_id") + 1).first()[0] or 1
    town = towns.select("city_id", "country", F.posexplode(F.array_compact(F.array("city", "other_name"))).alias("pos", "name"))
    x = e.withColumn("city_id", F.col("ord") % n).join(F.broadcast(town), "city_id")
    nothing = (F.col("ord") % 4 == 0) & (F.col("pos") == 0)
    x = x.select("ord", "country", "pos", "name", F.when(nothing, F.slice("elements", 1, 0)).otherwise(F.col("elements")).alias("elements"))
    at = work_path(spark, "responses")
    x.write.json(at)
    return spark.read.schema(f"ord long, country string, pos int, name string, {readers.RESPONSE}").json(at)


D_HARVEST = f"""e AS (SELECT row_id // {RESPONSE_ROWS} AS ord, (row_number() OVER (PARTITION BY row_id // {RESPONSE_ROWS} ORDER BY row_id)) - 1 AS seq, row_id, coalesce(website, '') AS site, coalesce(email, '') AS mail,
  coalesce(company, '') AS name, CASE WHEN row_id % 2 = 0 THEN coalesce(country, '') ELSE '' END AS town FROM incoming_list),
area AS (SELECT o.ord, c.country, CASE WHEN o.ord % 4 = 0 THEN c.other_name ELSE c.city END AS used FROM (SELECT DISTINCT ord FROM e) o JOIN ref_cities c ON c.city_id = o.ord % (SELECT max(city_id) + 1 FROM ref_cities)),
el AS (SELECT ord, country, used, seq, {d_key('site', 'mail')} AS domain, name, coalesce(nullif(town, ''), used) AS city, CASE WHEN {d_valid(d_strip('mail'))} THEN {d_strip('mail')} END AS mail
  FROM e JOIN area USING (ord) WHERE used IS NOT NULL AND row_id % 10 <> 0 AND row_id % 3 <> 0),
els AS (SELECT * FROM el WHERE domain <> '' AND country IN ('DE', 'NL', 'TR')),
hl AS (SELECT domain, arg_min(name, (ord, seq)) AS name, arg_min(city, (ord, seq)) AS city, arg_min(country, (ord, seq)) AS country, 'osm:' || arg_min(used, (ord, seq)) AS source, arg_min(ord, (ord, seq)) AS ord,
  CASE WHEN count(mail) > 0 THEN 'done' ELSE 'pending' END AS status, arg_min(mail, (ord, seq)) FILTER (WHERE mail IS NOT NULL) AS email FROM els GROUP BY domain)"""


@query(f"WITH {D_HARVEST} SELECT domain, name, city, country, source, status, email FROM hl")
def harvest_leads(spark: SparkSession, d: str) -> DataFrame:
    """Leads of a batch of areas of some countries, from saved responses."""
    return readers.harvested_leads(readers.harvest(responses(spark, d), ONLY)).select("domain", "name", "city", "country", "source", "status", "email")


@query(f"""WITH {D_HARVEST}, old AS (SELECT DISTINCT {d_stored('domain')} AS domain FROM leads),
n AS (SELECT ord, count(*) AS new FROM hl WHERE domain NOT IN (SELECT domain FROM old) AND domain NOT IN {values(JUNK_HOSTS)} GROUP BY ord),
p AS (SELECT ord, country, used, count(*) AS elements, count(mail) AS ready, coalesce(any_value(n.new), 0) AS new FROM els LEFT JOIN n USING (ord) GROUP BY ord, country, used)
SELECT * FROM p UNION ALL SELECT NULL, NULL, NULL, sum(elements)::BIGINT, sum(ready)::BIGINT, sum(new)::BIGINT FROM p""")
def harvest_counts(spark: SparkSession, d: str) -> DataFrame:
    """New leads and ready addresses by area and in all."""
    old = table(spark, d, "leads").select(T.stored_key(F.col("domain")).alias("domain")).distinct()
    return readers.harvest_counts(readers.harvest(responses(spark, d), ONLY), old)


@query(f"""WITH p AS (SELECT row_id, generate_subscripts(l, 1) - 1 AS k, unnest(l) AS x FROM (SELECT row_id,
list_filter(list_transform(string_split(coalesce(website, '') || ', ' || coalesce(email, '') || ',', ','), lambda v: {d_strip('v')}), lambda v: v <> '') AS l FROM incoming_list))
SELECT row_id, k::INT AS pos, {d_stored('x')} AS domain FROM p""")
def seed_split(spark: SparkSession, d: str) -> DataFrame:
    """Lists of a website and an address as seeds."""
    text = F.concat(T.text(F.col("website")), F.lit(", "), T.text(F.col("email")), F.lit(","))
    return readers.seeds(table(spark, d, "incoming_list").select("row_id", text.alias("list")), "list", ["row_id"])


@query(f"""WITH t AS (SELECT row_no AS seq, {d_stored('site')} AS domain, firma AS name, {d_country('oncelik', 'sehir')} AS country FROM firmalar),
f AS (SELECT * FROM t WHERE domain <> '' AND domain NOT IN {values(JUNK_HOSTS)} QUALIFY row_number() OVER (PARTITION BY domain ORDER BY seq) = 1)
SELECT seq, domain, name, '' AS city, country, 'taxtech-secili' AS source FROM f WHERE domain NOT IN (SELECT DISTINCT {d_stored('domain')} FROM leads)""")
def curated_seed(spark: SparkSession, d: str) -> DataFrame:
    """The campaign's firms as a hand-picked list: those that the pool doesn't have."""
    targets = table(spark, d, "firmalar").select(F.col("row_no").alias("seq"), F.col("site").alias("domain"), F.col("firma").alias("name"), T.campaign_country(F.col("oncelik"), F.col("sehir")).alias("country"))
    return store.insert_absent(readers.curated_seed(targets), pool(spark, d))


D_NEW = f"""new AS (SELECT seq, {d_stored(d_key('domain', 'email'))} AS domain FROM leads),
firsts AS (SELECT domain, min(seq) AS seq FROM new WHERE domain <> '' AND domain NOT IN {values(JUNK_HOSTS)} GROUP BY domain)"""


@query(f"WITH {D_NEW}, old AS (SELECT DISTINCT {d_host('site')} AS domain FROM firmalar) SELECT seq, domain FROM firsts WHERE domain NOT IN (SELECT domain FROM old)")
def first_wins_upsert(spark: SparkSession, d: str) -> DataFrame:
    new = table(spark, d, "leads").select("seq", T.lead_key(F.col("domain"), F.col("email")).alias("domain"))
    old = table(spark, d, "firmalar").select(T.host(F.col("site")).alias("domain")).distinct()
    return store.insert_absent(new, old).select("seq", "domain")


def noon():
    """The time that updates get here, so that both sides have the same."""
    return F.lit("2025-01-01 12:00:00").cast("timestamp_ntz")


def pool(spark: SparkSession, d: str) -> DataFrame:
    """The raw harvest after the first-wins rule: one lead a stored key."""
    x = table(spark, d, "leads").withColumn("domain", T.stored_key(F.col("domain"))).filter("domain <> ''")
    return store.first_wins(x)


D_POOL = f"""pool AS (SELECT * FROM (SELECT seq, {d_stored('domain')} AS domain, name, city, country, source, status, email, all_mails, note, checked_at FROM leads) WHERE domain <> ''
QUALIFY row_number() OVER (PARTITION BY domain ORDER BY seq) = 1)"""


@query(f"""WITH {D_POOL}, mails AS (SELECT {d_host('website')} AS domain, arg_min({d_strip('email')}, row_id) AS mail FROM incoming_list WHERE {d_valid(d_strip('email'))} GROUP BY 1)
SELECT seq, CASE WHEN p THEN 'done' ELSE status END AS status, CASE WHEN p THEN mail ELSE email END AS email, CASE WHEN p THEN 'OSM etiketinden' ELSE note END AS note,
CASE WHEN p THEN TIMESTAMP '2025-01-01 12:00:00' ELSE checked_at END AS checked_at FROM (SELECT pool.*, mail, coalesce(status = 'pending' AND mail IS NOT NULL, false) AS p FROM pool LEFT JOIN mails USING (domain))""")
def promote_pending(spark: SparkSession, d: str) -> DataFrame:
    mails = table(spark, d, "incoming_list").select(T.host(F.col("website")).alias("domain"), F.col("email").alias("mail"), F.col("row_id").alias("seq"))
    return store.promote_pending(pool(spark, d), mails, noon()).select("seq", "status", "email", "note", "checked_at")


@query(f"""WITH {D_POOL}, {D_SITES} SELECT seq, CASE WHEN s.domain IS NULL THEN p.status ELSE s.status END AS status, CASE WHEN s.domain IS NULL THEN p.email ELSE s.email END AS email,
CASE WHEN s.domain IS NULL THEN p.all_mails ELSE s.all_mails END AS all_mails, CASE WHEN s.domain IS NULL THEN p.note ELSE s.note END AS note,
CASE WHEN s.domain IS NULL THEN p.checked_at ELSE TIMESTAMP '2025-01-01 12:00:00' END AS checked_at FROM pool p LEFT JOIN sites s ON s.domain = p.domain""")
def apply_results(spark: SparkSession, d: str) -> DataFrame:
    return store.apply_results(pool(spark, d), contacts.extract_sites(fetched(spark, d)), noon()).select("seq", "status", "email", "all_mails", "note", "checked_at")


@query(f"WITH {D_POOL} SELECT seq, domain FROM pool WHERE status = 'pending' ORDER BY seq LIMIT 100")
def queue_batch(spark: SparkSession, d: str) -> DataFrame:
    return store.queue_batch(pool(spark, d), 100).select("seq", "domain")


@query("SELECT status, count(*) AS n FROM leads GROUP BY status")
def status_counts(spark: SparkSession, d: str) -> DataFrame:
    return store.status_counts(table(spark, d, "leads"))


@query("SELECT count(*) FILTER (WHERE status = 'pending') AS pending FROM leads")
def pending_count(spark: SparkSession, d: str) -> DataFrame:
    return store.pending_count(table(spark, d, "leads"))


@query("""SELECT 'total' AS what, NULL::VARCHAR AS name, count(*) AS n FROM leads UNION ALL SELECT 'status', status, count(*) FROM leads GROUP BY status
UNION ALL SELECT 'source', source, n FROM (SELECT source, count(*) AS n FROM leads GROUP BY source ORDER BY n DESC, source NULLS FIRST LIMIT 8)""")
def stats(spark: SparkSession, d: str) -> DataFrame:
    """The report on the pool."""
    return store.stats(table(spark, d, "leads"))


@query("SELECT source, count(*) AS n FROM leads GROUP BY source ORDER BY n DESC, source NULLS FIRST LIMIT 8")
def top_sources(spark: SparkSession, d: str) -> DataFrame:
    return store.top_sources(table(spark, d, "leads"))


@query(f"SELECT row_no, {d_country('oncelik', 'sehir')} AS country FROM firmalar")
def campaign_country(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "firmalar").select("row_no", T.campaign_country(F.col("oncelik"), F.col("sehir")).alias("country"))


D_CODE = "CASE " + " ".join(f"WHEN {d_strip('country')} = {q(k)} THEN {q(v)}" for k, v in COUNTRY_CODES.items()) + " END"


@query(f"SELECT row_id, {D_CODE} AS code FROM incoming_list")
def country_code(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "incoming_list").select("row_id", T.country_code(F.col("country")).alias("code"))


D_HISTORY = f"""known AS (SELECT DISTINCT lower({d_strip('email')}) AS mail FROM (SELECT email FROM sent_log UNION ALL SELECT email FROM firmalar) WHERE {d_strip('email')} <> ''),
orgs AS (SELECT DISTINCT CASE WHEN lower({d_strip('site')}) IN ('', '-', 'n/a', 'none') THEN {d_country('oncelik', 'sehir')} || ':email:' || lower({d_strip('email')}) ELSE {d_country('oncelik', 'sehir')} || ':' || {d_host('site')} END AS org FROM firmalar)"""
D_EXPORTED = f"""{D_HISTORY},
x AS (SELECT *, lower({d_strip('email')}) AS mail, upper({d_strip('country')}) AS cc, CASE WHEN contains(domain, '@') OR domain IN {values(FREEMAIL)} THEN '' ELSE domain END AS site FROM pool WHERE status = 'done' AND email IS NOT NULL),
y AS (SELECT *, CASE WHEN site <> '' THEN cc || ':' || site ELSE cc || ':email:' || mail END AS org FROM x),
z AS (SELECT y.*, k.mail IS NOT NULL AS km, o.org IS NOT NULL AS ko FROM y LEFT JOIN known k ON k.mail = y.mail LEFT JOIN orgs o ON o.org = y.org),
f AS (SELECT *, (cc <> '' AND NOT km AND NOT ko) AS able FROM z),
g AS (SELECT *, able AND row_number() OVER (PARTITION BY mail, able ORDER BY country NULLS FIRST, domain) = 1 AS kept FROM f),
h AS (SELECT *, min(CASE WHEN kept THEN coalesce(country, '') || chr(1) || domain END) OVER (PARTITION BY mail) < coalesce(country, '') || chr(1) || domain AS earlier FROM g)"""
D_EXPORT = f"{D_POOL}, {D_EXPORTED}"


@query(f"WITH {D_EXPORT} SELECT cc || '-EN' AS oncelik, coalesce(nullif(name, ''), split_part(mail, '@', 1)) AS firma, coalesce(city, '') AS sehir, mail AS email, site, coalesce(note, '') AS dil_notu FROM h WHERE kept")
def export_new(spark: SparkSession, d: str) -> DataFrame:
    return ex.export(pool(spark, d), *ex.history(table(spark, d, "firmalar"), table(spark, d, "sent_log")))[0]


@query(f"WITH {D_EXPORT} SELECT CASE WHEN cc = '' THEN 'ulkesiz' WHEN km OR coalesce(earlier, false) THEN 'mail' ELSE 'kurum' END AS reason, count(*) AS n FROM h WHERE NOT kept GROUP BY 1")
def export_skip_reasons(spark: SparkSession, d: str) -> DataFrame:
    _, why = ex.export(pool(spark, d), *ex.history(table(spark, d, "firmalar"), table(spark, d, "sent_log")))
    return why.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def _merge(spark: SparkSession, d: str):
    return ex.merge(table(spark, d, "incoming_list").withColumnRenamed("row_id", "seq"), *ex.history(table(spark, d, "firmalar"), table(spark, d, "sent_log")))


D_MERGE = f"""{D_HISTORY},
mx AS (SELECT row_id AS seq, {D_CODE} AS code, lower({d_strip('email')}) AS mail, CASE WHEN {d_host('website')} IN {values(FREEMAIL)} THEN '' ELSE {d_host('website')} END AS site, company, country FROM incoming_list),
my AS (SELECT *, CASE WHEN site <> '' AND NOT contains(site, '@') THEN code || ':' || site ELSE code || ':email:' || mail END AS org FROM mx),
fresh AS (SELECT seq, mail, org, row_number() OVER (ORDER BY seq) AS i FROM my WHERE code IS NOT NULL AND mail NOT IN (SELECT mail FROM known) AND org NOT IN (SELECT org FROM orgs WHERE org IS NOT NULL)),
walk AS (SELECT 0::BIGINT AS i, NULL::BIGINT AS seq, NULL::VARCHAR AS mail, false AS kept, []::VARCHAR[] AS mails, []::VARCHAR[] AS taken
  UNION ALL SELECT f.i, f.seq, f.mail, NOT list_contains(w.mails, f.mail) AND NOT list_contains(w.taken, f.org),
  CASE WHEN NOT list_contains(w.mails, f.mail) AND NOT list_contains(w.taken, f.org) THEN list_append(w.mails, f.mail) ELSE w.mails END,
  CASE WHEN NOT list_contains(w.mails, f.mail) AND NOT list_contains(w.taken, f.org) THEN list_append(w.taken, f.org) ELSE w.taken END FROM walk w JOIN fresh f ON f.i = w.i + 1),
mk AS (SELECT seq, mail FROM walk WHERE kept)"""


@query(f"""WITH RECURSIVE {D_MERGE} SELECT seq, code || '-EN' AS oncelik, {d_strip('company')} AS firma, {d_strip('country')} AS sehir, mail AS email, site, '' AS dil_notu FROM my WHERE seq IN (SELECT seq FROM mk)""")
def merge_greedy(spark: SparkSession, d: str) -> DataFrame:
    """Sequential two-key deduplication."""
    return _merge(spark, d)[0]


@query(f"""WITH RECURSIVE {D_MERGE}, by_mail AS (SELECT mail, min(seq) AS first FROM mk GROUP BY mail)
SELECT CASE WHEN code IS NULL THEN 'ulke-kodu-yok' WHEN mail IN (SELECT mail FROM known) OR coalesce(first < seq, false) THEN 'mail' ELSE 'kurum' END AS reason, count(*) AS n
FROM my LEFT JOIN by_mail USING (mail) WHERE seq NOT IN (SELECT seq FROM mk) GROUP BY 1""")
def merge_skip_reasons(spark: SparkSession, d: str) -> DataFrame:
    return _merge(spark, d)[1].groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


BANNED = ["staffing", "treuhand"]
# an address of the page, plain or obfuscated; the tables hold no obfuscated ones
D_VERIFY = f"""{D_FETCH}, c AS (SELECT row_id, lower({d_strip('email')}) AS mail, {d_host('website')} AS domain, {d_strip('website')} = '' AS nothing, source_url AS url,
 regexp_matches(lower(coalesce(company, '') || ' ' || coalesce(email, '') || ' ' || coalesce(website, '')), '{'|'.join(BANNED)}') AS banned FROM incoming_list),
ok AS (SELECT *, list_transform(regexp_extract_all(html, {q(EMAIL)}), lambda m: lower(m)) AS mails FROM pages WHERE error IS NULL AND http_status < 400),
tried AS (SELECT c.row_id, list_contains(p.mails, c.mail) AS hit FROM c JOIN ok p ON p.domain = c.domain AND p.path_idx < 10 UNION ALL SELECT c.row_id, list_contains(p.mails, c.mail) FROM c JOIN ok p ON p.url = c.url AND c.url <> ''),
t AS (SELECT row_id, bool_or(hit) AS hit FROM tried GROUP BY row_id),
v AS (SELECT row_id, CASE WHEN nothing THEN 'site-yok' WHEN t.row_id IS NULL THEN 'erisilemedi' WHEN hit THEN 'DOGRULANDI' ELSE 'sitede-yok' END AS outcome, banned FROM c LEFT JOIN t USING (row_id))"""


@query(f"WITH {D_VERIFY} SELECT row_id, outcome FROM v")
def verify_claims(spark: SparkSession, d: str) -> DataFrame:
    return contacts.verify_claims(table(spark, d, "incoming_list"), fetched(spark, d))


@query(f"WITH {D_VERIFY}, o(outcome) AS (VALUES ('DOGRULANDI'), ('sitede-yok'), ('erisilemedi'), ('site-yok')) SELECT outcome, count(row_id) AS n FROM o LEFT JOIN v USING (outcome) GROUP BY outcome")
def verify_histogram(spark: SparkSession, d: str) -> DataFrame:
    return contacts.histogram(contacts.verify_claims(table(spark, d, "incoming_list"), fetched(spark, d)), "outcome", contacts.OUTCOMES)


LIST_COLUMNS = ["row_id", "country", "company", "email", "website", "source_url"]


@query(f"""WITH {D_VERIFY}, k AS (SELECT row_id FROM v WHERE outcome = 'DOGRULANDI' AND NOT banned)
SELECT (row_number() OVER (ORDER BY row_id)) - 1 AS seq, row_id::VARCHAR AS row_id, {', '.join(f"coalesce({c}, '') AS {c}" for c in LIST_COLUMNS[1:])} FROM incoming_list WHERE row_id IN (SELECT row_id FROM k)""")
def verify_driver(spark: SparkSession, d: str) -> DataFrame:
    """The list without banned firms, verified; the kept rows pass through a CSV file and come back in its order."""
    kept, _ = contacts.verify_list(table(spark, d, "incoming_list"), fetched(spark, d), BANNED)
    at = work_path(spark, "verified")
    readers.write_csv(kept.select(F.col("row_id").cast("string").alias("row_id"), *[T.text(F.col(c)).alias(c) for c in LIST_COLUMNS[1:]]).orderBy(F.col("row_id").cast("long")), at)
    return readers.read_csv(spark, at, LIST_COLUMNS, order="seq")


@query(f"""WITH {D_VERIFY}, o(outcome) AS (VALUES ('DOGRULANDI'), ('sitede-yok'), ('erisilemedi'), ('site-yok'))
SELECT outcome AS what, count(row_id) AS n FROM o LEFT JOIN (SELECT * FROM v WHERE NOT banned) USING (outcome) GROUP BY outcome
UNION ALL SELECT 'total', count(*) FROM v UNION ALL SELECT 'banned', count(*) FROM v WHERE banned UNION ALL SELECT 'candidates', count(*) FROM v WHERE NOT banned""")
def verify_counts(spark: SparkSession, d: str) -> DataFrame:
    return contacts.verify_list(table(spark, d, "incoming_list"), fetched(spark, d), BANNED)[1]


@query("SELECT row_no FROM firmalar WHERE regexp_matches(lower(coalesce(firma, '') || ' ' || coalesce(site, '') || ' ' || coalesce(email, '')), 'steuer|tax|audit') AND NOT regexp_matches(lower(coalesce(firma, '') || ' ' || coalesce(site, '') || ' ' || coalesce(email, '')), 'treuhand|staffing')")
def keyword_filter(spark: SparkSession, d: str) -> DataFrame:
    return contacts.keyword_filter(table(spark, d, "firmalar"), ["firma", "site", "email"], ["steuer", "tax", "audit"], ["treuhand", "staffing"]).select("row_no")


@query("""SELECT count(*) FILTER (WHERE regexp_matches(b, 'steuer|tax|audit') AND NOT regexp_matches(b, 'treuhand|staffing')) AS kept, count(*) AS total
FROM (SELECT lower(coalesce(firma, '') || ' ' || coalesce(site, '') || ' ' || coalesce(email, '')) AS b FROM firmalar)""")
def filter_counts(spark: SparkSession, d: str) -> DataFrame:
    """How many rows the filter keeps, and of how many."""
    return contacts.filter_counts(table(spark, d, "firmalar"), ["firma", "site", "email"], ["steuer", "tax", "audit"], ["treuhand", "staffing"])


@query("SELECT coalesce(oncelik, '') AS oncelik, coalesce(firma, '') AS firma, coalesce(sehir, '') AS sehir, coalesce(email, '') AS email, coalesce(site, '') AS site, coalesce(dil_notu, '') AS dil_notu FROM firmalar")
def csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """The campaign file written as CSV and read again."""
    cols = ["oncelik", "firma", "sehir", "email", "site", "dil_notu"]
    at = work_path(spark, "csv")
    readers.write_csv(table(spark, d, "firmalar").select(*[T.text(F.col(c)).alias(c) for c in cols]), at, single=False)
    return readers.read_csv(spark, at, cols)


@query(f"WITH {D_NEW} SELECT seq, domain FROM firsts")
def snapshot_insert(spark: SparkSession, d: str) -> DataFrame:
    """All leads inserted into a versioned store, the same batch twice: the second changes nothing."""
    s = store.Snapshots(spark, work_path(spark, "store"))
    new = table(spark, d, "leads").select("seq", T.lead_key(F.col("domain"), F.col("email")).alias("domain"), "name", "city", "country", "source")
    s.insert(new)
    if s.insert(new):
        raise AssertionError("a repeated batch changed the store")
    return s.read().select("seq", "domain")


D_CRAWLED = f"""{D_POOL.replace("pool AS", "pool0 AS")}, {D_SITES},
pool AS (SELECT seq, p.domain, name, city, country, source, CASE WHEN t AND contains(p.domain, '@') THEN 'done' WHEN t THEN coalesce(s.status, 'noemail') ELSE p.status END AS status,
 CASE WHEN t AND contains(p.domain, '@') THEN p.domain WHEN t THEN s.email ELSE p.email END AS email, CASE WHEN t AND contains(p.domain, '@') THEN p.domain WHEN t THEN coalesce(s.all_mails, '') ELSE p.all_mails END AS all_mails,
 CASE WHEN t AND contains(p.domain, '@') THEN 'kaynak etiketinden' WHEN t THEN coalesce(s.note, '') ELSE p.note END AS note, CASE WHEN t THEN TIMESTAMP '2025-01-01 12:00:00' ELSE checked_at END AS checked_at, t
 FROM (SELECT *, coalesce(status = 'pending', false) AS t FROM pool0) p LEFT JOIN sites s ON s.domain = p.domain)"""


def _filled(spark: SparkSession, d: str) -> store.Snapshots:
    s = store.Snapshots(spark, work_path(spark, "store"), buckets=8)
    s.insert(pool(spark, d))
    return s


@query(f"WITH {D_CRAWLED} SELECT domain, status, email, all_mails, note, checked_at FROM pool WHERE domain NOT IN {values(JUNK_HOSTS)}")
def drain_stream(spark: SparkSession, d: str) -> DataFrame:
    """The store after its pending leads were drained as a stream of files."""
    s, at = _filled(spark, d), work_path(spark, "drain")
    write_fetch(fetched(spark, d), f"{at}/fetch")
    s.read().filter("status = 'pending'").select("domain").repartition(4, "domain").write.parquet(f"{at}/queue")
    drain(spark, f"{at}/queue", f"{at}/fetch", s, f"{at}/checkpoint", 2, noon())
    return s.read().select("domain", "status", "email", "all_mails", "note", "checked_at")


@query(f"WITH {D_CRAWLED} SELECT count(*) AS sites, count(email) AS with_mail FROM pool WHERE t")
def crawl_counts(spark: SparkSession, d: str) -> DataFrame:
    """How many pending leads were crawled, and how many of them have an address now."""
    return contacts.crawl_counts(contacts.crawl(pool(spark, d).filter("status = 'pending'"), fetched(spark, d)))


@query(f"WITH {D_CRAWLED}, {D_EXPORTED} SELECT cc || '-EN' AS oncelik, coalesce(nullif(name, ''), split_part(mail, '@', 1)) AS firma, coalesce(city, '') AS sehir, mail AS email, site, coalesce(note, '') AS dil_notu FROM h WHERE kept AND domain NOT IN {values(JUNK_HOSTS)}")
def unattended_export(spark: SparkSession, d: str) -> DataFrame:
    """The unattended loop to its end: drain, then export."""
    s, at = _filled(spark, d), work_path(spark, "loop")
    write_fetch(fetched(spark, d), f"{at}/fetch")
    return unattended(spark, s, f"{at}/fetch", table(spark, d, "firmalar"), table(spark, d, "sent_log"), at, now=noon())[0]
