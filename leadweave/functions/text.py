"""Scalar functions of the contact pipeline as columns: hosts, keys, addresses, tags. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadweave.constants import COUNTRY_CODES, EMAIL, FREEMAIL, LEGACY_TAGS, PLACEHOLDERS, PRIORITY_LOCALS

#: White space that a strip removes, in a form that Java's and RE2's regular expressions share.
SPACE = r"\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
STRIP = f"^[{SPACE}]+|[{SPACE}]+$"
URL_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?([^/?#:@]*)"
#: The same without hosts in brackets.
HOST = URL_HOST.replace("([^", r"((?!\[)[^", 1)
PUNCTUATION = ".,;:'\"()<>"


def text(c: Column) -> Column:
    """NULL as ''."""
    return F.coalesce(c, F.lit(""))


def strip(c: Column) -> Column:
    """Without white space at the ends; NULL as ''."""
    return F.regexp_replace(text(c), STRIP, "")


def host(c: Column) -> Column:
    """Normalised host of a site: lower case, no scheme, user, port, path, nor one leading ``www.``; '' if missing."""
    # one chain of calls in which nothing stands twice: generated code stays small where hosts are keys
    v = F.regexp_replace(F.lower(strip(c)), r"\A(?:" + "|".join(PLACEHOLDERS) + r")\z", "")
    v = F.regexp_replace(v, r"(?s)\A(?!.*://)", "https://")
    return F.regexp_replace(F.lower(F.regexp_extract(v, HOST, 1)), r"^www\.", "")


def is_email(c: Column) -> Column:
    """The whole text is one address."""
    return text(c).rlike(rf"\A(?:{EMAIL})\z")


def lead_key(site: Column, mail: Column) -> Column:
    """The firm's own host; where that is missing or a mail provider's, its valid address; else the host."""
    h, m = host(site), F.lower(strip(mail))
    return F.when((h != "") & ~h.isin(*FREEMAIL), h).when(is_email(m), m).otherwise(h)


def batch_key(site: Column, mail: Column) -> Column:
    """The batch harvester's other rule: the host, or what follows the last ``@``; '' for a mail without ``@``."""
    m = F.lower(strip(mail))
    return F.coalesce(F.nullif(host(site), F.lit("")), F.when(F.contains(m, F.lit("@")), F.substring_index(m, "@", -1)), F.lit(""))


def stored_key(c: Column) -> Column:
    """The key under which a lead is stored: addresses lower case and stripped, sites as hosts."""
    return F.when(F.contains(text(c), F.lit("@")), F.lower(strip(c))).otherwise(host(c))


def cf_decode(hexed: Column) -> Column:
    """Decode an obfuscated address: the first byte is the key of all others; a digit left at the end is a byte of its
    own. Text that isn't hexadecimal gives ''."""
    h = text(hexed)
    byte = lambda p: F.conv(F.substring(h, p, 2), 16, 10).cast("int")
    chars = F.transform(F.sequence(F.lit(3), F.length(h), F.lit(2)), lambda p: F.char(byte(p).bitwiseXOR(byte(F.lit(1)))))
    whole = h.rlike(r"\A[0-9a-fA-F]{3,}\z")
    return F.when(whole, F.array_join(chars, "")).otherwise("")


def tidy_mail(c: Column) -> Column:
    """An address without white space and punctuation around it, lower case."""
    return F.lower(F.trim(strip(c), F.lit(PUNCTUATION)))


def rank(mail: Column) -> Column:
    """Sort key of an address: general local parts first, then the shortest, then by text."""
    return F.struct(F.when(F.substring_index(mail, "@", 1).isin(*PRIORITY_LOCALS), 0).otherwise(1).alias("r"), F.length(mail).alias("n"), mail.alias("m"))


def root(domain: Column) -> Column:
    """The last two labels of a domain."""
    return F.substring_index(domain, ".", -2)


def join_url(base: Column, path: Column) -> Column:
    """An absolute path on a base; an empty path keeps the base."""
    return F.when(path == "", base).otherwise(F.concat(F.regexp_extract(base, r"^[^:]+://[^/?#]*", 0), path))


def campaign_country(tag: Column, city: Column) -> Column:
    """Country of a campaign tag: old tags by table, others without ``-EN``; the Gulf's Qatar by its city."""
    t = F.upper(strip(tag))
    old = F.create_map(*[F.lit(x) for kv in LEGACY_TAGS.items() for x in kv])
    c = F.try_element_at(old, t)
    gulf = F.when((c == "AE") & F.contains(F.lower(text(city)), F.lit("qatar")), "QA").otherwise(c)
    return F.when(c.isNotNull(), gulf).otherwise(F.regexp_replace(t, r"-EN$", ""))


def country_code(name: Column) -> Column:
    """Code of a country's name, NULL if it isn't in the list."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in COUNTRY_CODES.items() for x in kv]), strip(name))


def org_key(country: Column, site: Column, mail: Column) -> Column:
    """Organisation: country and own host, or country and address where there is no own host."""
    own = (site != "") & ~site.isin(*FREEMAIL) & ~F.contains(site, F.lit("@"))
    return F.when(own, F.concat(country, F.lit(":"), site)).otherwise(F.concat(country, F.lit(":email:"), mail))


def known_org_key(country: Column, site: Column, mail: Column) -> Column:
    """The same for history: only a missing site falls back to the address."""
    s = F.lower(strip(site))
    return F.when(s.isin("", *PLACEHOLDERS), F.concat(country, F.lit(":email:"), mail)).otherwise(F.concat(country, F.lit(":"), host(s)))


def split_list(c: Column) -> Column:
    """Parts of a comma-separated text, stripped, without empty ones."""
    return F.filter(F.transform(F.split(text(c), ","), strip), lambda p: p != "")
