"""Mapping free-entered values to a canonical list.

A BK-tree over the names of the reference list, under Levenshtein's distance (a true metric, so the triangle
inequality holds), returns every name within the threshold; a swap of neighbouring letters counts as one edit. The list is sharded by its group (a
country code); a value's own group is searched first, then the other shards, and the winners of the shards merge by
(distance, own group, id). Up to ``max_broadcast`` entries the trees travel with the tasks and the whole operator is
one map without a shuffle; a larger list stays on the executors: entries are salted over shards, values are sent to
every shard in blocks and the winners of every step merge, so the answers are the same.

A value is compared in these writings, in order; the first that hits wins: the whole value, the value without post
codes, country codes and names, and words that only say "part of" or "region of", then every run of its words. Equal
writings are the tree's hits at distance 0.
Truncated values ("Skiskerh.") match the one entry that they begin.

Defined results: NULL and blank values give -1 when they are asked for; ties go to the own group, then the smallest
id; a NULL group searches all shards; an empty reference list gives -1 everywhere; very long values are compared
whole, but a value that is longer than every entry by more than the threshold costs no comparison; repeated rows
stay repeated rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadweave.llm.edit import BKTree
from leadweave.llm.fold import strip_marks, unmojibake

#: Words around a place's name that denote a part of it or the region named after it.
PART_WORDS = frozenset(
    "region regio raum area bereich umgebung omgeving cevresi greater gross gemeente gemeinde kreis landkreis district bezirk"
    " province provinz provincie il ili gulf city of stadt stad sehri town the in near bei bij old new"
    " mitte altstadt neustadt innenstadt zentrum centrum center centre merkez merkezi downtown nord noord north kuzey sud zuid"
    " south guney ost oost east dogu west bati hq eu republic republik".split()
)
#: Parts of a name that writers leave out or shorten.
SAINTS = ("sankt", "saint", "sint")
LEADING = ("bad", "yeni", *SAINTS)
TRAILING = ("am see", "on sea", "aan zee")
THRESHOLD = 1


def radius(word: str, threshold: int = THRESHOLD) -> int:
    """Edits allowed for a word: none in words of up to three letters, nor (see ``_near``) in names of up to four."""
    return threshold if len(word) > 3 else 0


def name_forms(name: str) -> list[tuple[int, str]]:
    """(rank, writing) of a reference name: whole (0), with a shortened or missing part (1)."""
    full = strip_marks(name)
    out = [(0, full)]
    words = full.split()
    if words and words[0] in SAINTS:
        out += [(0, " ".join([x, *words[1:]])) for x in ("st", *SAINTS) if x != words[0]]
    short = full
    if words and words[0] in LEADING and len(words) > 1:
        short = " ".join(words[1:])
        out.append((1, short))
    for base in {full, short}:
        for tail in TRAILING:
            if base.endswith(" " + tail):
                out.append((1, base[: -len(tail) - 1]))
    if len(words) > 1:
        out.append((1, "".join(w[0] for w in words)))  # initials
    return [(r, w) for r, w in out if len(w) > 1]


class Matcher:
    """Trees by shard over (id, group, name) entries; ``resolve`` maps one typed value."""

    def __init__(self, entries: list[tuple[int, str, list[str]]], codes: dict[str, str] | None = None, code_is_entry: bool = False, threshold: int = THRESHOLD):
        self.threshold, self.code_is_entry = threshold, code_is_entry
        self.codes = {k: v for k, v in (codes or {}).items()}  # folded country name or code -> code
        self.ids: dict[str, dict[str, tuple[int, int]]] = defaultdict(dict)  # writing -> group -> best (rank, id)
        for i, group, names in entries:
            for name in names:
                for rank, w in name_forms(name):
                    at = self.ids[w]
                    at[group] = min(at.get(group, (9, i)), (rank, i))
            if code_is_entry and group:
                self.ids[group.lower()][group] = min(self.ids[group.lower()].get(group, (9, i)), (0, i))
        words_of = defaultdict(set)
        for w, groups in self.ids.items():
            for g in groups:
                words_of[g].add(w)
        self.trees = {g: BKTree(sorted(ws)) for g, ws in words_of.items()}
        self.everything = BKTree(sorted(self.ids))
        self.sorted = sorted(self.ids)
        self.longest = max(map(len, self.ids), default=0)
        self.most_words = max((w.count(" ") + 1 for w in self.ids), default=0)
        self.resolve = lru_cache(1 << 16)(self._resolve)

    def _hits(self, found: list[tuple[int, str]], group: str | None, groups=None) -> list[tuple[int, int, int, int]]:
        """(0 in the own group else 1, distance, rank, id) of writings at their distances."""
        return [(int(g != group), d, *at) for d, w in found for g, at in self.ids[w].items() if groups is None or g in groups]

    def _exact(self, word: str, group: str | None) -> list:
        return self._hits(self.everything.search(word, 0), group) if len(word) <= self.longest else []

    def _near(self, word: str, group: str | None) -> list:
        """Every writing within the threshold, of the own group if it has one."""
        r = radius(word, self.threshold)
        if len(word) > self.longest + r or not r:
            return []
        for groups in ([group] if group in self.trees else [], [g for g in self.trees if g != group]):
            got = [h for g in groups for h in self._hits([x for x in self.trees[g].search(word, r) if len(x[1]) > 4], group, (g,))]
            if got:
                return got
        return []

    def _begins(self, word: str, group: str | None) -> list:
        """The entries that a truncated value begins: a range of the sorted writings."""
        if len(word.replace(" ", "")) < 4:
            return []
        low, high = bisect_left(self.sorted, word), bisect_left(self.sorted, word + "\U0010ffff")
        return self._hits([(len(w) - len(word), w) for w in self.sorted[low:high]], group)

    def steps(self, text: str | None, group: str | None) -> Iterator[tuple[int, bool, list]]:
        """What the value can denote, step by step, of which the first that tells counts: (step, whether the entry must be
        the only one, hits). The steps of a value are the same whatever part of the list a matcher holds."""
        text = unmojibake(text or "")
        group = (group or "").strip().upper() or None
        full = strip_marks(text)
        if not full:
            return
        yield 0, False, self._exact(full, group)
        if self.code_is_entry:
            joined = full.replace(" ", "")
            if len(joined) <= 4:
                yield 1, False, self._exact(joined, group)
        words = full.split()
        # what the text itself says about the country decides where the row is silent
        kept, said = [], None
        tail = re.split(r"[,(/]| - ", text)
        for part in tail[1:]:
            said = said or self.codes.get(strip_marks(part))
        first = re.match(r"\s*([A-Za-z]{1,3})\s*[- ]\s*\d{3,6}\b", text)
        if first:
            said = said or self.codes.get(first[1].lower())
        for part in tail if not self.code_is_entry else [text]:
            p = strip_marks(part)
            if len(tail) > 1 and p in self.codes and part is not tail[0]:
                continue
            kept += [w for w in p.split() if not any(c.isdigit() for c in w)]
        if first and kept and kept[0] == first[1].lower():
            kept = kept[1:]
        group = group or said
        core = [w for w in kept if w not in PART_WORDS]
        tries = list(dict.fromkeys(" ".join(x) for x in (kept, core) if x))
        for k, t in enumerate(tries):
            yield 2 + k, False, self._exact(t, group)
        if text.rstrip().endswith("."):
            for k, t in enumerate(tries):
                yield 4 + k, True, self._begins(t, group)
        for k, t in enumerate(dict.fromkeys([full, *tries])):
            yield 6 + k, False, self._near(t, group)
        # runs of words inside a longer value, longest first; only whole names, not their short forms
        known = [w in PART_WORDS or any(c.isdigit() for c in w) or bool(self.codes.get(w)) for w in words]
        before = [0]
        for x in known:
            before.append(before[-1] + (not x))
        for n in range(min(self.most_words, len(words) - 1), 0, -1):
            for k in range(len(words) - n + 1):
                if before[k] + before[-1] - before[k + n] == 0:
                    run = " ".join(words[k : k + n])
                    if len(run) > 4 and run in self.ids and min(self.ids[run].values())[0] == 0:
                        yield 1000 - n, False, [h for h in self._exact(run, group)]
                        return

    def _resolve(self, text: str | None, group: str | None) -> int:
        return decide((step, alone, h) for step, alone, hits in self.steps(text, group) for h in [hits] if h)


def decide(outcomes) -> int:
    """The id of the first step that tells: the least (other group, distance, rank, id); where the entry must be the only
    one, the one of the own group or, without one there, of all."""
    for _, alone, hits in outcomes:
        if not alone:
            return min(hits)[3]
        ids = {h[3] for h in hits if not h[0]} or {h[3] for h in hits}
        if len(ids) == 1:
            return ids.pop()
    return -1


def map_values(df: DataFrame, value: str, group: str | None, entries: list[tuple[int, str, list[str]]], codes: dict[str, str] | None = None, code_is_entry: bool = False, threshold: int = THRESHOLD, out: str = "ref_id") -> DataFrame:
    """``df`` with ``out``, the id of the entry that ``value`` denotes or -1; one map, no shuffle.

    The entries travel with the tasks, so their number must be bounded: see :func:`read_entries`.
    """

    made: list[Matcher] = []

    @F.pandas_udf("long")
    def resolve(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        if not made:
            made.append(Matcher(entries, codes, code_is_entry, threshold))
        for values, groups in batches:
            yield pd.Series([made[0].resolve(v, g) for v, g in zip(values, groups, strict=True)], dtype="int64")

    made.clear()
    return df.withColumn(out, resolve(F.col(value), F.col(group) if group else F.lit(None).cast("string")))


def read_entries(ref: DataFrame, id_col: str, group_col: str, name_cols: list[str], separator: str = "|", max_broadcast: int = 200_000) -> list[tuple[int, str, list[str]]] | None:
    """The reference list for the tasks, or None when it has more than ``max_broadcast`` entries."""
    rows = ref.select(id_col, group_col, *name_cols).limit(max_broadcast + 1).collect()
    if len(rows) > max_broadcast:
        return None
    return [(r[0], r[1], [n for c in r[2:] if c for n in c.split(separator) if n.strip()]) for r in rows]


def map_values_sharded(df: DataFrame, value: str, group: str | None, ref: DataFrame, id_col: str, group_col: str, name_cols: list[str], codes: dict[str, str] | None = None, code_is_entry: bool = False, shards: int = 2, block_rows: int = 20_000, threshold: int = THRESHOLD, out: str = "ref_id", separator: str = "|") -> DataFrame:
    """The same for a list too large to travel: every distinct value meets every shard's trees, winners merge.

    Entries are salted over ``shards``; each (shard, block of values) is one group of bounded size. A shard returns, of
    every step of a value, its best hit with its distance (of a step that wants the only entry, its first two of the own
    group and of the others); merged by step, they give what one matcher over the whole list gives.
    """
    g = F.col(group) if group else F.lit(None).cast("string")
    q = df.select(F.col(value).alias("_v"), g.alias("_g")).distinct()
    # a block has about block_rows values: hashing spreads them evenly
    blocks = max(1, -(-q.count() // block_rows))
    q = q.withColumn("_b", F.pmod(F.xxhash64("_v", "_g"), F.lit(blocks))).withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    names = F.concat_ws(separator, *[F.col(c) for c in name_cols])
    r = ref.select(F.col(id_col).cast("long").alias("_id"), F.col(group_col).alias("_rg"), names.alias("_n"))
    r = r.withColumn("_s", F.pmod(F.xxhash64("_id"), F.lit(shards)).cast("int")).withColumn("_b", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    hit = "_step int, _alone boolean, _o int, _d int, _r int, _i long"

    def one(values: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        rows = [(int(i), g, [n for n in names.split(separator) if n.strip()]) for i, g, names in zip(entries["_id"], entries["_rg"], entries["_n"], strict=True)]
        m, got = Matcher(rows, codes, code_is_entry, threshold), []
        for v, g in zip(values["_v"], values["_g"], strict=True):
            for step, alone, hits in m.steps(v, g):
                if not alone:
                    kept = [min(hits)] if hits else []
                else:
                    firsts = {h[0]: {} for h in hits}
                    for h in sorted(hits):
                        firsts[h[0]].setdefault(h[3], h)
                    kept = [h for x in firsts.values() for h in list(x.values())[:2]]
                got += [(v, g, step, alone, *h) for h in kept]
        return pd.DataFrame(got, columns=["_v", "_g", "_step", "_alone", "_o", "_d", "_r", "_i"])

    def merge(hits) -> int:
        steps = defaultdict(list)
        for h in hits:
            steps[h["_step"], h["_alone"]].append((h["_o"], h["_d"], h["_r"], h["_i"]))
        return decide((step, alone, steps[step, alone]) for step, alone in sorted(steps))

    decided = F.pandas_udf(lambda s: pd.Series([merge(x) for x in s], dtype="int64"), "long")
    won = q.groupBy("_s", "_b").cogroup(r.groupBy("_s", "_b")).applyInPandas(one, f"_v string, _g string, {hit}")
    won = won.groupBy("_v", "_g").agg(F.collect_list(F.struct("_step", "_alone", "_o", "_d", "_r", "_i")).alias("_h")).select("_v", "_g", decided("_h").alias("_i"))
    on = df[value].eqNullSafe(won["_v"]) & (df[group].eqNullSafe(won["_g"]) if group else F.lit(True))
    return df.join(won, on, "left").drop("_v", "_g").withColumn(out, F.coalesce("_i", F.lit(-1))).drop("_i")


def typed(df: DataFrame, value: str, ref: DataFrame, name: str) -> DataFrame:
    """Rows whose value is neither NULL nor blank and not letter for letter a name of the list."""
    known = ref.select(F.col(name).alias("_k")).filter("_k is not null").distinct()
    return df.filter(F.col(value).rlike(r"[^\s]")).join(F.broadcast(known), F.col(value) == F.col("_k"), "left_anti")


def country_codes(countries: DataFrame, bound: int = 2000) -> dict[str, str]:
    """Folded country names and codes -> code; a list of more than ``bound`` countries is an error."""
    out = {}
    rows = countries.select("code", "country", "other_names").limit(bound + 1).collect()
    if len(rows) > bound:
        raise ValueError(f"more than {bound} countries")
    for r in rows:
        for n in [r[0], r[1], *(r[2] or "").split("|")]:
            if n and n.strip():
                out[strip_marks(n)] = r[0]
    return out


def map_list(df: DataFrame, value: str, group: str | None, ref: DataFrame, id_col: str, group_col: str, name_cols: list[str], codes: dict[str, str] | None = None, code_is_entry: bool = False, max_broadcast: int = 200_000) -> DataFrame:
    """:func:`map_values` where the list is small enough to travel, :func:`map_values_sharded` beyond that."""
    entries = read_entries(ref, id_col, group_col, name_cols, max_broadcast=max_broadcast)
    if entries is not None:
        return map_values(df, value, group, entries, codes, code_is_entry)
    return map_values_sharded(df, value, group, ref, id_col, group_col, name_cols, codes, code_is_entry, shards=-(-ref.count() // max_broadcast))
