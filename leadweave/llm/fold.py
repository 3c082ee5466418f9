"""Folding of "writing": white space, invisible characters, letter case, punctuation, Unicode encodings.

ASCII values stay in the JVM; only values with other characters travel to an Arrow-batched Python function.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

NON_ASCII = r"[^\x00-\x7F]"


# Turkish dotless i and the capital with a dot lose the difference under plain upper/lower casing: both are i here.
class _Table(dict):
    """A translation table that fills itself, character by character."""

    def __init__(self, of):
        super().__init__({ord("ı"): of("i"), ord("İ"): of("i")})
        self.of = of

    def __missing__(self, code: int) -> str:
        self[code] = got = self.of(chr(code))
        return got


def _folded(c: str) -> str:
    return unicodedata.normalize("NFC", c.casefold())


def _bare_letter(c: str) -> str:
    c = unicodedata.normalize("NFKD", unicodedata.normalize("NFKD", c).casefold())
    return "".join(x if x.isalnum() else " " for x in c if not unicodedata.combining(x) and unicodedata.category(x) != "Cf")


_CANON = _Table(lambda c: "".join(x for x in _folded(c) if x.isalnum()))
_VISIBLE = _Table(lambda c: "".join(x for x in _folded(c) if not x.isspace() and unicodedata.category(x)[0] not in "CZ"))
_PLAIN = _Table(_bare_letter)


def canon_word(s: str) -> str:
    """Letters and digits of ``s``, case folded, NFKC; accents stay."""
    return (s if s.isascii() else unicodedata.normalize("NFKC", s)).translate(_CANON)


def visible(s: str) -> str:
    """``s`` lower case and NFKC without white space and invisible characters; punctuation stays."""
    return (s if s.isascii() else unicodedata.normalize("NFKC", s)).translate(_VISIBLE)


def strip_marks(s: str) -> str:
    """``s`` case folded, without accents, every run of other characters one blank; invisible characters vanish."""
    return " ".join(s.translate(_PLAIN).split())


def unmojibake(s: str) -> str:
    """Undo UTF-8 bytes read as Windows-1252, in either letter case; ``s`` itself if it isn't that."""
    if re.search(r"[ÃãÂâÄäÅå][^\sA-Za-z]", s):
        for t in (s, re.sub(r"[ãâäå](?=[^\sA-Za-z])", lambda m: m[0].upper(), s)):
            for enc in ("cp1252", "latin-1"):
                try:
                    return t.encode(enc).decode("utf-8")
                except UnicodeError:
                    pass
    return s


def _vector(f):
    return F.pandas_udf(lambda s: pd.Series([None if x is None else f(x) for x in s], dtype=object), "string")


def _ascii_or(c: Column, ascii_expr: Column, f) -> Column:
    odd = c.rlike(NON_ASCII)
    return F.when(odd, _vector(f)(F.when(odd, c))).otherwise(ascii_expr)


def canon(c: Column) -> Column:
    """Column form of :func:`canon_word`; NULL becomes ''."""
    return F.coalesce(_ascii_or(c, F.regexp_replace(F.lower(c), "[^a-z0-9]", ""), canon_word), F.lit(""))


def visible_col(c: Column) -> Column:
    """Column form of :func:`visible`; NULL becomes ''."""
    return F.coalesce(_ascii_or(c, F.regexp_replace(F.lower(c), r"[\x00-\x20\x7F]", ""), visible), F.lit(""))
