"""Canonical mail addresses and hosts, as columns: what is left of an address when its writing is taken away."""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadweave.constants import PLACEHOLDERS
from leadweave.llm.fold import visible, visible_col

#: Punctuation that may enclose or follow an address.
AROUND = "\"'`´‘’“”„«»‹›<>()[]{}.,;:!?*|…"


def bare(c: Column) -> Column:
    """``c`` without white space, invisible characters, ``mailto:`` and enclosing punctuation, lower case; '' if missing."""
    v = F.trim(visible_col(c), F.lit(AROUND))
    v = F.trim(F.regexp_replace(v, r"\Amailto:", ""), F.lit(AROUND))
    return F.when(v.isin(*PLACEHOLDERS), "").otherwise(v)


def is_mail(v: Column) -> Column:
    """A bare address with an ``@`` before any slash."""
    return v.rlike(r"\A[^/@]*@")


def mail_of(v: Column) -> Column:
    """The bare value as a mail address, '' if it is none."""
    return F.when(is_mail(v), v).otherwise("")


def host_of(v: Column) -> Column:
    """The host of a bare web address: no scheme, user, leading ``www.``, port, path or final dot; '' for a mail address."""
    h = F.regexp_replace(v, r"\A[a-z][a-z0-9+.-]*:/+", "")
    h = F.regexp_replace(F.regexp_replace(h, r"[/?#\\].*\z", ""), r"(:[0-9]*)?\.*\z", "")
    return F.when(is_mail(v), "").otherwise(F.regexp_replace(h, r"\Awww\.", ""))


def canon_address(c: Column) -> Column:
    """``m:address`` or ``w:host``, '' if missing."""
    v = bare(c)
    return F.when(v == "", "").when(is_mail(v), F.concat(F.lit("m:"), v)).otherwise(F.concat(F.lit("w:"), host_of(v)))


# The same in Python, for operators that work on batches anyway.

_SCHEME, _AFTER, _PORT = re.compile(r"\A[a-z][a-z0-9+.-]*:/+"), re.compile(r"[/?#\\].*\Z", re.S), re.compile(r"(?::[0-9]*)?\.*\Z")
_AT = re.compile(r"[^/@]*@")


@lru_cache(1 << 14)
def bare_text(value: str | None) -> str:
    """:func:`bare` of one value."""
    v = visible(value or "").strip(AROUND)
    if v.startswith("mailto:"):
        v = v[7:].strip(AROUND)
    return "" if v in PLACEHOLDERS else v


def host_text(v: str) -> str:
    """:func:`host_of` of one bare value."""
    return "" if not v or _AT.match(v) else _PORT.sub("", _AFTER.sub("", _SCHEME.sub("", v)), count=1).removeprefix("www.")


def mail_text(v: str) -> str:
    """:func:`mail_of` of one bare value."""
    return v if _AT.match(v) else ""
