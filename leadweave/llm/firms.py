"""What rows of several tables say about the firm behind them: readings of names, sites and mail addresses.

A reading is a set of identifying words. Which words identify is counted over all rows, not listed: a word of names
identifies if it also stands in the site or mail address of most rows that have both, a word of addresses if it also
stands in the name. So professions, legal forms, given names, role mailboxes and the additions of hosts fall out in
any language, while surnames and branch words stay.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache
from itertools import product

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadweave.constants import PLACEHOLDERS
from leadweave.llm.batches import with_row_function
from leadweave.llm.edit import damerau
from leadweave.llm.fold import canon_word, strip_marks, unmojibake
from leadweave.llm.known import Parser
from leadweave.llm.spelling import Spelling, spelling
from leadweave.llm.components import components

#: Sources in the order of their names.
SOURCES = ("firmalar", "incoming_list", "leads", "sent_log")
_LETTERS = re.compile(r"[^\W\d_]+")


#: A capital between two other letters.
_INNER = re.compile(r"[^\W\d_A-ZÀ-ÖØ-Þ][A-ZÀ-ÖØ-Þ][^\W\d_A-ZÀ-ÖØ-Þ]")
_CAPITAL = re.compile(r"(?<=[a-z])[A-Z](?=[a-z])")
_TOKEN, _RUN = re.compile(r"[a-z0-9]+"), re.compile(r"[a-z]+")


def name_words(name: str | None) -> list[str]:
    """Words of a name without accents, numbers left out; a capital inside a word begins another."""
    t = name or ""
    if t.isascii():
        if not (t.islower() or t.isupper()):
            t = _CAPITAL.sub(" \\g<0>", t)
        return list(dict.fromkeys([w for w in _TOKEN.findall(t.lower()) if not w.isdigit()]))
    t = unicodedata.normalize("NFC", unmojibake(t))
    if _INNER.search(t):
        t = "".join(" " + c if c.isupper() and k and t[k - 1].islower() and t[k + 1 : k + 2].islower() else c for k, c in enumerate(t))
    return list(dict.fromkeys(w for w in strip_marks(t).split() if not w.isdigit()))


def _label_words(label: str) -> str:
    """The words of a site's label, joined by blanks."""
    return " ".join(w for w in (_TOKEN.findall(label) if label.isascii() else strip_marks(label).split()) if not w.isdigit())


def _mail_words(local: str) -> str:
    """The runs of letters of the distinctive part of a mail address, joined by blanks."""
    return " ".join(_RUN.findall(local) if local.isascii() else _LETTERS.findall(strip_marks(local)))


class Words:
    """Cuts the columns of a row into words; ``providers`` are the hosts that many firms share."""

    def __init__(self, providers: list[str], canon: bool = True):
        self.parser, self.canon = Parser(providers), canon
        self.of = self._of

    def _of(self, name: str | None, email: str | None, site: str | None):
        """(name words, site words, mail words, address, site, hash of the name without writing)."""
        address, kind, text, host = self.parser.parse(email, site)
        label = host.partition(".")[0] if host else ""
        canon = 0
        if self.canon and name:
            if name.isascii():
                letters = "" if name.strip().lower() in PLACEHOLDERS else "".join(_TOKEN.findall(name.lower()))
            else:
                letters = canon_word(name)
            canon = xxhash.xxh64_intdigest(letters) >> 1 if letters else 0
        sites = _label_words(label) if label else ""
        mails = "" if not text else _mail_words(text) if kind == "p" else sites if text == label else _label_words(text)
        return " ".join(name_words(name)), sites, mails, address, host, canon


def words(rows: DataFrame, keep: list[str], providers: list[str]) -> DataFrame:
    """``keep`` and ``names``, ``sites``, ``mails`` (words joined by blanks) and ``canon``, a hash of the name without its
    writing (0 if there is none), of rows with ``name``, ``email``, ``site``."""

    def make():
        of = Words(providers).of

        def one(name, email, site):
            names, sites, mails, _, _, canon = of(name, email, site)
            return names, sites, mails, canon

        return one

    return with_row_function(rows, make, ["name", "email", "site"], "names string, sites string, mails string, canon long", keep)


def sides(x: DataFrame, least: int = 5, share: int = 50_000) -> tuple[frozenset[str], dict[str, int], int]:
    """(generic, strong, rows) of :func:`words`: words that don't identify, and words that do with their rows, among the
    frequent ones. Frequent is a word in more than one of ``share`` rows, so there are at most ``share`` times the
    words of a row. A generic word stands beside at least four sets of other words: copies of one row don't make one.
    """
    other, own = F.concat("sites", F.lit(" "), "mails"), F.replace("names", F.lit(" "), F.lit(""))
    squeezed = F.concat(F.replace("sites", F.lit(" "), F.lit("")), F.lit(" "), F.replace("mails", F.lit(" "), F.lit("")))
    beside = F.expr("shiftleft(1L, cast(pmod(xxhash64(sort_array(split(names, ' '))), 64L) as int))")

    def side(words: Column, text: Column) -> DataFrame:
        # the texts once a row, not once a word; outer, else a filter before it splits the words two more times
        y = x.select(F.array_distinct(F.split(words, " ")).alias("ws"), F.trim(text).alias("t"), beside.alias("c"))
        y = y.select(F.explode_outer("ws").alias("w"), "t", "c").filter(F.length("w") > 2)
        there = F.col("t") != ""
        return y.groupBy("w").agg(F.count(F.lit(1)).alias("n"), F.count_if(there).alias("both"), F.count_if(there & F.contains("t", "w")).alias("hit"), F.bit_count(F.bit_or("c")).alias("c"))

    total = x.count()
    frequent = (F.col("n") >= max(least, total / share)) & (F.col("both") > 0)
    got = side(F.col("names"), squeezed).unionByName(side(other, own)).filter(frequent)
    generic, strong = set(), {}
    for w, n, both, hit, c in got.collect():
        if hit < 0.5 * both and c >= 4:
            generic.add(w)
        else:
            strong[w] = strong.get(w, 0) + n
    return frozenset(generic), {w: n for w, n in strong.items() if w not in generic}, total


def near_words(a: str, b: str, edits: int = 1) -> bool:
    if a == b:
        return True
    if abs(len(a) - len(b)) > edits or min(len(a), len(b)) <= 3 * edits:
        return False
    if edits == 1 and a[0] != b[0] and a[-1] != b[-1]:  # one edit leaves one end
        return False
    return damerau(a, b, edits) <= edits


def near_sets(x: tuple[str, ...], y: tuple[str, ...], edits: int = 1) -> bool:
    """Two readings whose words pair up, each within some edits; joined words are compared with the words together."""
    if len(x) == len(y):
        left = list(y)
        for w in sorted(x, key=lambda w: w not in y):
            hit = next((v for v in left if v == w), None) or next((v for v in left if near_words(w, v, edits)), None)
            if hit is None:
                return False
            left.remove(hit)
        return True
    if len(x) > len(y):
        x, y = y, x
    if len(x) < len(y) <= 6:
        # two words of y may stand together in x
        for i, v in enumerate(y):
            for j, w in enumerate(y):
                if i != j and any(near_words(u, v + w, edits) for u in x):
                    rest = tuple(sorted([z for k, z in enumerate(y) if k not in (i, j)] + [v + w]))
                    if near_sets(x, rest, edits):
                        return True
    return False


def hash_of(text: str) -> int:
    k = xxhash.xxh64_intdigest(text)
    return k - (1 << 64) if k >= 1 << 63 else k


class Reader:
    """Readings of a row's words, given the generic words and the spelling of the strong ones."""

    def __init__(self, generic: frozenset[str], known: Spelling):
        self.generic, self.known, self.strong = generic, known, known.counts
        self.read = self._read
        self.plain = lru_cache(1 << 18)(lambda w: len(w) < 3 or w in generic)
        #: Strong and sound, so it stands for itself.
        self.good = lru_cache(1 << 18)(lambda w: len(w) > 2 and w in self.strong and w not in generic and known.sound(w))
        #: What a word adds to a reading: nothing, itself or the two words it is joined of.
        self.pieces = lru_cache(1 << 18)(lambda w: () if len(w) < 3 or w in generic else known.apart(w) if len(w) >= 8 else (w,))
        self.pair = self._pair
        self.fixed = self._fixed

    def core(self, ws: list[str], against: list[str]) -> tuple[str, ...]:
        """Identifying words, sorted, joined ones apart; beyond two, only those that are strong or near a word of another
        column. One short word alone must stand in another column as well."""
        pieces, c = self.pieces, []
        for w in ws:
            for x in pieces(w):
                if x not in c:
                    c.append(x)
        if len(c) < 2:
            return () if not c or (len(c[0]) < 8 and c[0] not in against) else (c[0],)
        if len(c) > 2:
            strong = self.strong
            sure = [w for w in c if w in strong or any(near_words(w, v) for v in against)]
            c = sure if len(sure) >= 2 else c
        c.sort()
        return tuple(c)

    def _pair(self, text: str) -> tuple[str, ...] | None:
        """Two sound identifying words, sorted, if that is what the words of a column are."""
        w = text.split(" ")
        if len(w) == 2:
            a, b = w
            if a != b and self.good(a) and self.good(b):
                return (a, b) if a < b else (b, a)
        return None

    def _read(self, names: str, sites: str, mails: str) -> tuple[tuple[str, ...], list[tuple[str, ...]]]:
        """(key, other readings that mean the same), as words. What stands in one row may be two slips a word apart."""
        # most rows say the same two words everywhere
        pair = self.pair(sites or mails)
        if pair:
            a, b = pair
            said, plain = names.split(" "), self.plain
            if not names or (a in said and b in said):
                for w in said if not sites or not mails or mails == sites else [*said, *mails.split(" ")]:
                    if w != a and w != b and not plain(w):
                        break
                else:
                    return pair, []
        elif names and not sites and not mails:
            w = tuple(sorted(x for x in names.split(" ") if not self.plain(x)))
            if len(w) == 2 and self.good(w[0]) and self.good(w[1]):
                return w, []
        alike = sites == mails
        names, sites, mails = names.split(), sites.split(), mails.split()
        n, s = self.core(names, sites + mails), self.core(sites, names + mails)
        m = s if alike else self.core(mails, names + sites)
        found = [(r, p) for p, r in enumerate((s, n, m)) if r]
        if not found:
            return (), []
        if s == n or s == m or (not s and n == m):
            best = found[0][0]
        else:
            best = min(found, key=lambda x: (len(x[0]) < 2, not all(map(self.known.sound, x[0])), -min(len(x[0]), 4), x[1]))[0]
        return best, sorted({r for r, _ in found if r != best and near_sets(best, r, 2)})

    def _fixed(self, reading: tuple[str, ...]) -> list[str] | None:
        """What the reading can be a slip of: every word that isn't sound may stand for an established one. None if all
        its words are sound."""
        if all(map(self.known.sound, reading)):
            return None
        choices = [[(w,), *self.known.readings(w)] for w in reading]
        return sorted({" ".join(sorted(dict.fromkeys(x for p in c for x in p))) for c in product(*choices)} - {" ".join(reading)})

    def cuts(self, reading: tuple[str, ...]) -> list[str]:
        """The reading with a long word that isn't established cut where an established one begins or ends."""
        known, out = self.known, set()
        for i, w in enumerate(reading):
            if len(w) >= 8 and w not in self.strong:
                for k in range(4, len(w) - 3):
                    for a, b in ((w[:k], w[k:]), (w[: k - 1] + w[k], w[k - 1] + w[k + 1 :])):
                        if (a in self.strong or b in self.strong) and (known.sound(a) or known.sound(b)):
                            out.add(" ".join(sorted({*reading[:i], a, b, *reading[i + 1 :]})))
        return sorted(out)

    def lone(self, reading: tuple[str, ...]) -> bool:
        """Whether it has a word that isn't established, so that the right word may be unknown."""
        return any(w not in self.strong for w in reading)


def read(x: DataFrame, keep: list[str], generic: frozenset[str], strong: dict[str, int], terms=None, more: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` and ``key`` (words joined by blanks) and ``k`` (its hash) of :func:`words`, with ``terms``, a function of
    the reader, the key, the row's other readings and the columns ``more`` that gives longs; NULL where the task has seen
    all of this before. Without it: ``others`` (the other readings) and
    ``cuts`` (readings with joined words apart; a bar between them), ``clean`` (the key holds no slip) and ``named`` (the
    name itself shows the key)."""
    sent = x.sparkSession.sparkContext.broadcast(strong)

    def make():
        reader, seen = Reader(generic, spelling(sent)), set()

        def one(names, sites, mails, *more):
            key, others = reader.read(names, sites, mails)
            if not key:
                return (None, None, None) if terms else (None,) * 6
            text = " ".join(key)
            if terms:
                # a repeated row needs no terms again
                what = hash((names, sites, mails, *more))
                if what in seen:
                    return text, hash_of(text), None
                if len(seen) > 1 << 18:
                    seen.clear()
                seen.add(what)
                return text, hash_of(text), terms(reader, key, others, *more)
            clean = all(map(reader.known.sound, key))
            cuts = [] if clean and not others else {c for r in (key, *others) for c in reader.cuts(r)}
            said = names.split()
            return text, hash_of(text), "|".join(map(" ".join, others)) or None, "|".join(sorted(cuts)) or None, clean, all(w in said for w in key) or near_sets(key, reader.core(said, key), 2)

        return one

    out = "key string, k long, " + ("terms array<long>" if terms else "others string, cuts string, clean boolean, named boolean")
    return with_row_function(x, make, ["names", "sites", "mails", *more], out, keep)


def source_rows(spark, d: str, tables: tuple[str, ...]) -> DataFrame:
    """(src, id, name, email, site) of the tables of a folder, ``src`` as a number in ``SOURCES``."""
    from leadweave.session import table

    none = F.lit(None).cast("string")
    shape = {
        "leads": ("seq", F.col("name"), F.col("email"), F.col("domain")),
        "firmalar": ("row_no", F.col("firma"), F.col("email"), F.col("site")),
        "incoming_list": ("row_id", F.col("company"), F.col("email"), F.col("website")),
        "sent_log": ("log_id", none, F.col("email"), none),
    }
    out = None
    for t in tables:
        i, n, e, s = shape[t]
        x = table(spark, d, t).select(F.lit(SOURCES.index(t)).cast("byte").alias("src"), F.col(i).alias("id"), n.alias("name"), e.alias("email"), s.alias("site"))
        out = x if out is None else out.unionByName(x)
    return out


def ordered_pairs(rows: DataFrame, by: str, differ: str) -> DataFrame:
    """(src_a, id_a, src_b, id_b), sources by name, of rows that share ``by`` and differ in ``differ``, the smaller
    (source, id) first."""
    a, b = rows.alias("a"), rows.alias("b")
    first = (F.col("a.src") < F.col("b.src")) | ((F.col("a.src") == F.col("b.src")) & (F.col("a.id") < F.col("b.id")))
    j = a.join(b, (F.col(f"a.{by}") == F.col(f"b.{by}")) & (F.col(f"a.{differ}") != F.col(f"b.{differ}")) & first)
    names = F.array(*[F.lit(s) for s in SOURCES])
    name = lambda c: F.element_at(names, F.col(c).cast("int") + 1)
    return j.select(name("a.src").alias("src_a"), F.col("a.id").alias("id_a"), name("b.src").alias("src_b"), F.col("b.id").alias("id_b"))


def with_labels(rows: DataFrame, links: DataFrame, a: str, b: str) -> DataFrame:
    """``rows`` with ``label``: the least of the class of ``k`` under the links, ``k`` itself if it has none."""
    return rows.join(components(links, a, b).withColumnRenamed("node", "k"), "k", "left").withColumn("label", F.coalesce("label", "k"))
