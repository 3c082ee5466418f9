"""Words of a text without its writing and markup."""

from __future__ import annotations

import html
import re
import unicodedata

_INLINE = re.compile(r"</?(?:a|abbr|b|big|code|em|font|i|mark|s|small|span|strong|sub|sup|tt|u)(?:\s[^<>]*)?/?>", re.I)
_TAG = re.compile(r"</?[A-Za-z!][^<>]*>")
_WORD = re.compile(r"[^\W_]+")
#: UTF-8 bytes read as Windows-1252: a lead byte and its continuation bytes.
_MOJIBAKE = re.compile("[ÂÃÄÅâ][\x80-\xbf€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ]{1,3}")


def _undo(m: re.Match) -> str:
    for enc in ("cp1252", "latin-1"):
        try:
            return m[0].encode(enc).decode("utf-8")
        except UnicodeError:
            pass
    return m[0]


def without_markup(t: str) -> str:
    """``t`` without tags, entities as their characters."""
    if "&" in t:
        t = html.unescape(t)
    if "<" in t:
        t = _TAG.sub(" ", _INLINE.sub("", t))
    return t


def folded(t: str) -> str:
    """``t`` case folded, NFKC, without invisible characters; line by line the same as at once."""
    if not t.isascii():
        t = unicodedata.normalize("NFKC", _MOJIBAKE.sub(_undo, t))
        for c in set(t):
            if not c.isascii() and (c in "ıİ" or unicodedata.category(c) == "Cf"):
                t = t.replace(c, "i" if c in "ıİ" else "")
        t = unicodedata.normalize("NFC", t.casefold())
        return t.replace("i̇", "i")
    return t.lower()


def plain(text: str | None) -> str:
    """``text`` case folded, NFKC, without markup and invisible characters; '' for NULL."""
    return folded(without_markup(text or ""))


def words(text: str | None) -> list[str]:
    return _WORD.findall(plain(text))
