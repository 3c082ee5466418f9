"""Deduplicating new batches against all history: a persistent index of band keys.

An entry is a mail address or a site, without its writing. Its first band key is a hash of the whole; an entry with a
word that can be a slip (see :class:`Spelling`) has one more for every established word that it can stand for, with the
rest as it is. So two slips of one address meet in the address, whether that is an entry or not. An entry with a word
that isn't established has, besides, keys of the parts that one slip on each side must leave, since there the right
word may be unknown: minwise values of the word's pieces together with the other words, as many as it has pieces.
Every key is stored with its entry and the entry's signature (the parity of each letter's count, and a hash of the digits
and marks), in partitions of a hash of the key.

The index is a folder: partitions by step, the established words, and numbered state files of which the greatest
counts. A new process opens it and goes on. A batch reads only the partitions its own keys fall into and, in
these, the keys marked in its bitmap of fixed size. Candidates share a key, their signatures must be within the reach
of two slips, then the entries are compared by edit distance. After that the keys of the entries that the index didn't
hold yet are appended; known ones add nothing.

Entries carry ``since``, their order of arrival, so several batches can be told about each other in one step.

Defined results: NULL, blank and placeholder addresses are known from nowhere; a NULL batch counts as the last; equal
batches don't know each other; ties don't matter, since a row is either known or not; texts of any length are compared
whole; empty history knows nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadweave.llm.address import AROUND, bare_text, host_text, mail_text
from leadweave.llm.batches import with_row_function
from leadweave.llm.edit import damerau
from leadweave.llm.marks import Marks
from leadweave.llm.spelling import Spelling, established, spelling
from leadweave.session import Pointer, cut, delete_path, work_path

SLIPS = 2  # one on each side


def _h(text: str, seed: int) -> int:
    return xxhash.xxh64_intdigest(text, seed)


def pieces(word: str) -> set[str]:
    """Beginnings and ends, of three letters or, in short words, of two: one edit leaves one of them."""
    out = set()
    if len(word) >= 6:
        out |= {word[:3] + "<", ">" + word[-3:]}
    if len(word) <= 7:
        out |= {word[:2] + "<", ">" + word[-2:]}
    return out


@lru_cache(1 << 16)
def minwise(word: str, n: int = 4) -> tuple[int, ...]:
    """The ``n`` least hashes of the word's pieces."""
    return tuple(sorted(_h(p, 0) for p in pieces(word))[:n])


_LETTERS = re.compile(r"[^\W\d_]+")


def shorter(word: str, most: int) -> set[str]:
    """The word without up to ``most`` (1 or 2) of its letters. Both spellings of one slip have such a form of one letter
    less in common, those of a slip on each side one of two less."""
    n = len(word)
    out = {word} | {word[:i] + word[i + 1 :] for i in range(n)}
    if most == 2:
        out |= {word[:i] + word[i + 1 : j] + word[j + 1 :] for j in range(n) for i in range(j)}
    return out


def pieces_or_forms(word: str) -> set[str]:
    """:func:`pieces`; in words of up to five letters a slip can destroy both, so these have shorter forms as well."""
    return pieces(word) | (shorter(word, 1) if len(word) <= 5 else set())


def twice(word: str, alone: bool) -> set[str]:
    """Forms of which two spellings, one slip on each side away from one word, have one in common. A word that stands
    ``alone`` needs rarer ones. That word may be a letter longer or shorter than the spelling at hand."""
    lengths, out = range(max(1, len(word) - 1), len(word) + 2), set()
    if lengths[0] <= (10 if alone else 4):
        out |= shorter(word, 2)
    if alone:
        # four blocks, a letter between them: a slip changes one, so two are left, moved as a slip before them moves them
        for b in {min((n - 3) // 4, 8) for n in lengths if n > 10}:
            at = [k * (b + 1) for k in range(4)]
            for i in range(4):
                for j in range(i):
                    for di, dj in {(0, 0), (1, 0), (-1, 0), (1, 1), (-1, -1)}:
                        if at[j] + dj >= 0:
                            out.add(f"{b} {j} {i} {word[at[j] + dj : at[j] + dj + b]} {word[at[i] + di : at[i] + di + b]}")
    else:
        # slips in the beginning and the end leave the middle, moved by one at most
        for b in {min((n - 2) // 3, 8) for n in lengths if n > 4}:
            out |= {word[:b] + "<", ">" + word[-b:]} | {f"{b}<{word[k : k + b]}>" for k in (b, b + 1, b + 2)}
    return out


def letter_words(text: str) -> tuple[str, str, list[str]]:
    """(the text but for its ending, the ending, words of the first). A slip is in a word; another ending is another place."""
    at = text.rfind(".")
    body, ending = (text[:at], text[at:]) if at > text.find("@") else (text, "")
    return body, ending, _LETTERS.findall(body)


def band_keys(kind: str, text: str, known: Spelling) -> tuple[list[int], bool]:
    """(band keys of a text, signed 64 bits each, the whole text's first; whether it has a word that isn't established).
    Texts one slip apart have a key in common, and so have texts that are both one slip away from a third."""
    body, ending, w = letter_words(text)
    frame = kind + _LETTERS.sub("a", body) + ending
    first = _h(frame + " " + " ".join(w), 1)
    rare = [i for i, x in enumerate(w) if not known.sound(x)]
    if not rare:
        return [first - (1 << 64) if first >= 1 << 63 else first], False
    out = {_h(frame + " " + " ".join([*w[:i], v, *w[i + 1 :]]), 1) for i in rare for v in known.options(w[i])}
    lone = [i for i in rare if w[i] not in known.counts]
    for i in lone:
        x, rest = w[i], " ".join(w[:i] + w[i + 1 :])
        out |= {_h(f"{frame} {i} {m} {rest}", 2) for m in minwise(x)}
        if len(x) <= 5:
            out |= {_h(f"{frame} {i} {p} {rest}", 3) for p in shorter(x, 1)}
        out |= {_h(f"{frame} {i} {p} {rest}", 4) for p in twice(x, len(w) == 1)}
    for i, j in {(min(i, j), max(i, j)) for i in lone for j in range(len(w)) if i != j}:
        rest = " ".join(w[:i] + w[i + 1 : j] + w[j + 1 :])
        out |= {_h(f"{frame} {i} {p} {j} {q} {rest}", 5) for p in pieces_or_forms(w[i]) for q in pieces_or_forms(w[j])}
    return [k - (1 << 64) if k >= 1 << 63 else k for k in (first, *(out - {first}))], bool(lone)


def signature(kind: str, text: str) -> int:
    """26 bits: parity of each letter's count (others fold onto them); 36 bits: hash of kind, digits and marks."""
    bits = 0
    for c in text:
        if c.isalpha():
            bits ^= 1 << (ord(c) - 97) % 26
    return (_h(kind + _LETTERS.sub("", text), 7) & ((1 << 36) - 1)) << 26 | bits


def slips(a: str, b: str) -> int:
    """Edits between two texts of equal digits and marks, 99 if those differ or there are more than ``SLIPS``."""
    if _LETTERS.sub("", a) != _LETTERS.sub("", b):
        return 99
    d = damerau(a, b, SLIPS)
    return d if d <= SLIPS else 99


def plausible(a: str, b: str, known: Spelling) -> bool:
    """The texts have equal digits, marks and endings and are within two slips, and what differs can be slips: a word
    edited once has a side that isn't sound, a word edited twice has two."""
    x, end_x, v = letter_words(a)
    y, end_y, w = letter_words(b)
    if end_x != end_y or slips(x, y) > SLIPS:
        return False
    return all(p == q or damerau(p, q) + known.sound(p) + known.sound(q) <= 2 for p, q in zip(v, w, strict=True))


class BandIndex:
    """Entries (``kind``, ``text``, ``origin``, ``since``) by band key in a folder. ``counts``: the established words,
    given when the index is made and read from it when it is opened again."""

    ENTRY = "kind string, text string, origin string, since int"
    SCHEMA = f"key long, whole boolean, sig long, {ENTRY}"

    def __init__(self, spark: SparkSession, path: str | None = None, counts: dict[str, int] | None = None, buckets: int = 32):
        self.spark, self.path = spark, (path or work_path(spark, "bands")).rstrip("/")
        self.pointer = Pointer(spark, self.path)
        version, state = self.pointer.read()
        if not version:
            state = {"buckets": buckets, "steps": []}
            spark.createDataFrame(list((counts or {}).items()), "w string, n long").write.mode("overwrite").parquet(f"{self.path}/words")
            self.pointer.write(1, state)
        else:
            counts = {r[0]: r[1] for r in spark.read.parquet(f"{self.path}/words").collect()}
        self.buckets = state["buckets"]
        self.sent = spark.sparkContext.broadcast(counts or {})

    def keys(self, entries: DataFrame) -> DataFrame:
        """All band keys of entries; ``whole`` marks the one of the text as it stands."""
        sent = self.sent

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = spelling(sent)
            for b in batches:
                key, whole, sig, at = [], [], [], []
                kinds, texts = (b.column(c).to_numpy(zero_copy_only=False).tolist() for c in ("kind", "text"))
                for i, (k, t) in enumerate(zip(kinds, texts, strict=True)):
                    own, lone = band_keys(k, t, known)
                    key += own
                    n = len(own)
                    if n == 1:
                        whole.append(True)
                        sig.append(None)
                        at.append(i)
                    else:
                        whole += [True, *[False] * (n - 1)]
                        sig += [signature(k, t) if lone else None] * n
                        at += [i] * n
                rest = b.take(pa.array(at, pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(whole, pa.bool_()), pa.array(sig, pa.int64()), *rest.columns], ["key", "whole", "sig", *rest.schema.names])

        return entries.select("kind", "text", "origin", F.col("since").cast("int").alias("since")).mapInArrow(run, self.SCHEMA)

    def bucket(self) -> Column:
        return F.pmod(F.col("key"), F.lit(self.buckets)).cast("int")

    def append(self, keys: DataFrame) -> None:
        """Add keys of accepted entries to their partitions. The step counts once its state file is written."""
        version, state = self.pointer.read()
        step = f"step={version}"
        rows = keys.withColumn("bucket", self.bucket()).repartition("bucket")
        rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{step}")
        self.pointer.write(version + 1, state | {"steps": [*state["steps"], step]})

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        steps = self.pointer.read()[1]["steps"]
        if not steps:
            return self.spark.createDataFrame([], self.SCHEMA)
        df = self.spark.read.option("basePath", self.path).schema(self.SCHEMA + ", step int, bucket int").parquet(*[f"{self.path}/{s}" for s in steps])
        return (df if buckets is None else df.filter(F.col("bucket").isin(*buckets))).drop("step", "bucket")

    @staticmethod
    def within_reach(a: Column, b: Column) -> Column:
        """Signatures that two slips can be apart: equal digits and marks, at most four letters of other parity. Entries
        without one have no keys but of whole texts."""
        x = a.bitwiseXOR(b)
        return F.coalesce((F.shiftright(x, 26) == 0) & (F.bit_count(x) <= 2 * SLIPS), F.lit(True))

    def matching(self, keys: DataFrame) -> DataFrame:
        """The stored keys that some keys can meet: only their partitions are read, and what isn't marked is left there."""
        touched = [r[0] for r in keys.select(self.bucket().alias("x")).distinct().collect()]
        return Marks(keys, "key").keep(self.read(touched or [-1]), "key")

    def hits(self, keys: DataFrame, stored: DataFrame) -> DataFrame:
        """(``kind``, ``text``, ``origin``, ``since``): for every probed text and origin the least ``since`` of the
        stored entries that mean the same."""
        p = keys.select("key", "kind", "text", "sig", "whole")
        s = stored.select("key", F.col("kind").alias("k2"), F.col("text").alias("t2"), F.col("sig").alias("s2"), "origin", "since", F.col("whole").alias("w2"))
        p, s = p.alias("p"), s.alias("s")
        pairs = p.join(s, "key").filter((F.col("kind") == F.col("k2")) & self.within_reach(F.col("sig"), F.col("s2")))
        # equal texts meet in their whole keys as well: there they count, once
        same = (F.col("text") == F.col("t2"))
        pairs = pairs.filter(~same | (F.col("whole") & F.col("w2")))
        one = pairs.groupBy("kind", "text", "t2", "origin").agg(F.min("since").alias("since"))
        sent = self.sent

        def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            known = spelling(sent)
            for pdf in filter(len, batches):
                yield pdf.loc[[plausible(a, b, known) for a, b in zip(pdf["text"], pdf["t2"], strict=True)], ["kind", "text", "origin", "since"]]

        good = one.filter("text <> t2").mapInPandas(verify, self.ENTRY)
        good = good.unionByName(one.filter("text = t2").select("kind", "text", "origin", "since"))
        return good.groupBy("kind", "text", "origin").agg(F.min("since").alias("since"))


# ------------------------------------------------------------------ addresses

#: Labels below a country's ending under which firms register, such as ``co`` in ``co.uk``.
SECOND_LEVEL = ("ac", "biz", "co", "com", "edu", "gen", "gob", "gov", "ind", "info", "ltd", "me", "name", "ne", "net", "nom", "or", "org", "plc", "sch", "web")
_MAIL = re.compile(r"(?:mailto:)?([a-z0-9][a-z0-9._%-]*)(?:\+[a-z0-9._%+-]*)?@([a-z0-9][a-z0-9.-]*[a-z0-9])")
_WEB = re.compile(r"(?:https?://)?(?:www\.)?([a-z0-9][a-z0-9.-]*[a-z0-9])(?::[0-9]*)?(?:/[!-~]*)?")
_EDGES = AROUND + " \t\r\n\xa0\u200b"


def registered(host: str, second: frozenset[str] = frozenset(SECOND_LEVEL)) -> str:
    """The host without subdomains: the ending and the label before it. An ending has two labels if the last one is a
    country's (two letters) and the one before is one of ``second``."""
    labels = host.split(".")
    if len(labels) < 3:
        return host
    n = 3 if len(labels) > 2 and len(labels[-1]) == 2 and labels[-2] in second else 2
    return ".".join(labels[-n:])


def name_label(host: str) -> str:
    """The label before the ending, the whole of a host without dots."""
    return registered(host).split(".")[0]


class Parser:
    """Parts of a mail address and a site; ``providers`` are the hosts that many firms share, ``second`` the labels of
    two-part endings."""

    def __init__(self, providers: list[str], second: frozenset[str] = frozenset(SECOND_LEVEL)):
        self.providers, self.second = frozenset(providers), second
        # one edit leaves a host's first four letters or what follows the fifth as they are
        heads, tails = {}, {}
        for p in providers:
            heads.setdefault(p[:4], []).append(p)
            tails.setdefault(len(p[5:]), {}).setdefault(p[5:], []).append(p)
        begins, ends = tuple(heads), tuple({p[5:] for p in providers})

        def like(host: str) -> bool:
            if host in self.providers:
                return True
            if not host.startswith(begins) and not host.endswith(ends):
                return False
            near = heads.get(host[:4], []) + [p for k, at in tails.items() for p in at.get(host[-k:] if k else "", ())]
            return any(damerau(host, p, 1) <= 1 for p in near)

        def parts(host: str) -> tuple[bool, str, str | None]:
            at, s = like(host), registered(host, self.second)
            return at, name_label(host), None if not host or (at if s == host else at or like(s)) else s

        #: Of a host: whether it is a provider's, its label, and :meth:`site`. Most mail addresses are at the row's site.
        self.parts = lru_cache(1 << 16)(parts)
        self.parse = self._parse

    def mailbox(self, mail: str) -> tuple[str | None, str | None, str | None]:
        """(address without tag, kind, distinctive text); kind ``p`` at a provider, else ``h``."""
        local, _, host = mail.partition("@")
        local, host = local.split("+", 1)[0], host.rpartition("@")[2]
        if not local or not host:
            return None, None, None
        at, label, _ = self.parts(host)
        return f"{local}@{host}", "p" if at else "h", local if at else label

    def site(self, host: str) -> str | None:
        """Host without subdomains; None for a provider's."""
        return self.parts(host)[2]

    @staticmethod
    def split(value: str | None) -> tuple[str, str]:
        """(mail address, host) of a value, one of them ''."""
        if not value:
            return "", ""
        v = value.lower()
        if v[0] in _EDGES or v[-1] in _EDGES:
            v = v.strip(_EDGES)
        if v.isascii():
            # a web address has an @ behind a slash only, a mail address has no slash
            if ("@" not in v or "/" in v) and (m := _WEB.fullmatch(v)):
                return ("", m[1]) if v != "none" else ("", "")
            if m := _MAIL.fullmatch(v):
                return f"{m[1]}@{m[2]}", ""
        v = bare_text(value)
        return mail_text(v), host_text(v)

    def _parse(self, one: str | None, other: str | None):
        mail, host = self.split(one)
        mail2, host2 = self.split(other)
        mail, host = mail or mail2, host2 or host
        return (*(self.mailbox(mail) if mail else (None, None, None)), self.site(host) if host else None)


def parsed(df: DataFrame, keep: list[str], one: str, other: str, providers: list[str]) -> DataFrame:
    """``keep`` and ``address``, ``kind``, ``text``, ``site`` of the mail address and web address in two columns."""
    return with_row_function(df, lambda: Parser(providers).parse, [one, other], "address string, kind string, text string, site string", keep)


def provider_hosts(table: DataFrame, bound: int = 1000) -> list[str]:
    """The shared providers' hosts; the list must not exceed ``bound``, since every address is compared with it."""
    rows = [r[0].strip().lower() for r in table.filter("host is not null").select("host").distinct().limit(bound + 1).collect()]
    if len(rows) > bound:
        raise ValueError(f"more than {bound} mail providers")
    return sorted(rows)


def as_entries(df: DataFrame, origin: str, since: Column) -> DataFrame:
    """Distinct entries of rows with ``address`` and ``site`` (one may be missing)."""
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).alias("text")) for k, c in (("m", "address"), ("s", "site")) if c in df.columns])
    x = df.select(F.explode(kinds).alias("e"), since.cast("int").alias("since")).select("e.kind", "e.text", "since").filter("text is not null")
    return x.groupBy("kind", "text").agg(F.min("since").alias("since")).withColumn("origin", F.lit(origin))


LAST = (1 << 31) - 1


def add_batch(index: BandIndex, rows: DataFrame) -> DataFrame:
    """(``seq``, ``hist_src``) of the rows (``seq``, ``batch``, ``address``, ``site``) of one or several batches that are
    known from the index or from an earlier one of these batches; then what the index didn't hold is appended."""
    keys = cut(index.keys(as_entries(rows, "leads", F.col("batch"))), "probe")
    stored = cut(index.matching(keys), "stored")
    mine = keys.filter("kind = 'm'")
    found = cut(index.hits(keys, stored.unionByName(mine)), "hits")
    # a text that the index holds from leads already adds nothing; the others are accepted spellings
    there = stored.filter("whole and origin = 'leads'").select("kind", "text")
    index.append(mine.join(there, ["kind", "text"], "left_anti").select(keys.columns))
    delete_path(index.spark, keys._leadweave_path)
    delete_path(index.spark, stored._leadweave_path)
    since = lambda o: F.min(F.when(F.col("origin") == o, F.col("since")))
    by = found.groupBy("kind", "text").agg(since("sent_log").alias("sent"), since("leads").alias("first"), since("firmalar").alias("campaign"))
    m = rows.filter("address is not null").select("seq", "batch", F.lit("m").alias("kind"), F.col("address").alias("text"))
    s = rows.filter("site is not null").select("seq", "batch", F.lit("s").alias("kind"), F.col("site").alias("text"))
    x = m.unionByName(s).join(by, ["kind", "text"])
    src = F.array_compact(F.array(F.when(F.col("sent").isNotNull() & (F.col("kind") == "m"), "sent_log"), F.when((F.col("first") < F.col("batch")) & (F.col("kind") == "m"), "leads"), F.when(F.col("campaign").isNotNull() & (F.col("kind") == "s"), "firmalar")))
    return x.select("seq", F.explode(src).alias("hist_src"))


def known_leads(leads: DataFrame, sent: DataFrame, campaign: DataFrame, providers: list[str], rounds: int = 2, path: str | None = None) -> DataFrame:
    """(``seq``, ``hist_src``): every lead already known, once per history.

    The histories go into a new index first, then the batches in order of arrival, in ``rounds`` steps.
    """
    spark = leads.sparkSession
    nothing = F.lit(None).cast("string").alias("nothing")
    rows = cut(parsed(leads.select("seq", F.coalesce("batch_no", F.lit(LAST)).alias("batch"), "email", "domain"), ["seq", "batch"], "email", "domain", providers).drop("kind", "text"), "leads")
    boxes = as_entries(parsed(sent.select("email", nothing), [], "email", "nothing", providers).select("address"), "sent_log", F.lit(0))
    sites = as_entries(parsed(campaign.select(F.col("site").alias("web"), nothing), [], "nothing", "web", providers).select("site"), "firmalar", F.lit(0))
    old = cut(boxes.unionByName(sites), "history")
    text = old.select("text").unionByName(rows.select(F.explode(F.array("address", "site")).alias("text")).filter("text is not null"))
    words = text.select(F.explode(F.array_distinct(F.split(F.regexp_replace("text", r"\.[^.@]*\z", ""), r"[^\p{L}]+"))).alias("w"))
    n_old = old.count()
    index = BandIndex(spark, path, established(words, text.count()), buckets=min(1024, max(8, n_old // 250_000)))
    index.append(index.keys(old))
    delete_path(spark, old._leadweave_path)
    low, high = rows.filter(F.col("batch") < LAST).agg(F.min("batch"), F.max("batch")).first()
    steps = sorted({low + (high - low + 1) * k // rounds for k in range(rounds)}) if low is not None else [0]
    out = None
    for at, end in zip(steps, [*steps[1:], None], strict=True):
        here = rows if len(steps) == 1 else rows.filter((F.col("batch") >= at) & (F.col("batch") < end) if end is not None else F.col("batch") >= at)
        got = cut(add_batch(index, here), "known")
        out = got if out is None else out.unionByName(got)
    return out.distinct()
