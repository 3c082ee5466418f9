"""Matching entities across sources without keys: cross-table retrieval with BM25.

Rows of a table with the same identifying reading are one record, a document of the index; its terms come from all
attributes of its rows: whole readings and what they can be slips of, their words, mail addresses, sites, towns and
countries. Every record retrieves the best two of every table, its own included, by BM25.

Top-k pruning: readings, addresses and sites are the essential terms. A record that shares none of them with another shares
a word, a town or a country at most, which is less than half of its own score and so under the least share of a match;
only lists of essential terms bring up candidates, the other terms are added for these. A list of up to ``FULL``
records is read whole. A longer one gives all pairs that can be among the best two of a record and table:

* those that share a further term of up to ``FULL`` of its records,
* those that can be spellings of one firm, which the score favours,
* else two share only terms that many of its records have. Of all that share the same ones, or more, the score is least
  with these, times a factor that falls with the length: no record can beat the three shortest of a table (one may be the
  record itself). So they stand for every combination of such terms. Records with more than ``SUBSETS`` such terms
  meet the whole list.

So the best two are those of comparing all pairs, and the long lists that two records share count once in their score.

A candidate is a match if it is the nearest, if the test holds the other way round as well (the other's nearest in
this table is this record), if the two can be spellings of one firm (an edit test), and if its confidence is one half
or more. The confidence is a logistic function of the gap to the second and of the share of the record's own score,
calibrated on first bests that share an exact address or site and are spelled within an edit a word (matches) and on bests that do
neither (others), at most ``CALIBRATION`` of each kind. Spellings inside one table aren't one to one, so there the
nearest needn't be mutual. Records of equal readings pass the same retrieval, test and confidence.

Defined results: rows without identifying words match nothing; NULL attributes give no terms; ties go to the least
record; repeated rows are one record and pair with every row of their match; empty tables give no pairs.
"""


from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadweave.llm.batches import with_row_function
from leadweave.llm.fold import strip_marks
from leadweave.llm import firms
from leadweave.llm.firms import SOURCES
from leadweave.llm.components import components
from leadweave.llm.marks import Marks
from leadweave.llm.spelling import SHARE, shorter
from leadweave.session import cut, table

#: A list of more records is split by their other terms; so many terms that more records share are read in all combinations.
FULL, SUBSETS = 64, 8
CALIBRATION = 5_000
#: Constants of BM25.
K1, B = 1.2, 0.4


def reading_terms(reader: firms.Reader, key: tuple[str, ...], others, *places) -> list[int]:
    """Essential terms of a row: each reading and what it can be a slip of, its address and site (hashes). A reading with a
    word that isn't established has also the terms that stay equal when that word holds a slip or when its words are
    written together. Terms of addresses and sites are odd, all others even."""
    if not others and all(map(reader.known.sound, key)):
        return [firms.hash_of(" ".join(key)) & ~1, *[p | 1 for p in places[1:] if p]]
    out = set()
    for r in (key, *others):
        out.add(firms.hash_of(" ".join(r)) & ~1)
        fixed = reader.fixed(r)
        if fixed is not None:
            out |= {firms.hash_of(f) & ~1 for f in fixed}
            if reader.lone(r):
                out |= {t & ~1 for t in loose_terms(r, reader.strong)}
    # src comes first
    out |= {p | 1 for p in places[1:] if p}
    return list(out)


def loose_terms(reading: tuple[str, ...], strong=()) -> set[int]:
    """Forms of which two readings an edit in one word that isn't established apart have one in common, and so have
    readings of one or two words that are written together."""
    out = set()
    for i, x in enumerate(reading):
        if x not in strong:
            rest = " ".join(reading[:i] + reading[i + 1 :])
            out |= {firms.hash_of(f"f {p} {rest}") for p in shorter(x)}
    if len(reading) == 1:
        out |= {firms.hash_of("j " + p) for p in shorter(reading[0])}
    elif len(reading) == 2:
        out |= {firms.hash_of("j " + reading[0] + reading[1]), firms.hash_of("j " + reading[1] + reading[0])}
    return out


def matching_rows(spark, d: str) -> DataFrame:
    """(src, id, name, email, site, town, land) of the four tables."""
    out, none = None, F.lit(None).cast("string")
    shape = {
        "leads": ("seq", F.col("name"), F.col("email"), F.col("domain"), F.col("city"), F.col("country")),
        "firmalar": ("row_no", F.col("firma"), F.col("email"), F.col("site"), F.col("sehir"), F.col("oncelik")),
        "incoming_list": ("row_id", F.col("company"), F.col("email"), F.col("website"), none, F.col("country")),
        "sent_log": ("log_id", none, F.col("email"), none, none, F.col("oncelik")),
    }
    for t, (i, n, e, s, town, land) in shape.items():
        x = table(spark, d, t).select(F.lit(SOURCES.index(t)).cast("byte").alias("src"), F.col(i).alias("id"), n.alias("name"), e.alias("email"), s.alias("site"), town.alias("town"), land.alias("land"))
        out = x if out is None else out.unionByName(x)
    return out


def _hash(text: str | None) -> int | None:
    return xxhash.xxh64_intdigest(text) >> 1 if text else None


def records(rows: DataFrame, providers: list[str], codes: dict[str, str]) -> tuple[DataFrame, dict[str, int], int]:
    """(rows with their record's ``rec``, ``key``, its hash ``k``, essential ``terms``, and hashes of ``town`` and ``land``; established words with their rows; number of rows)."""

    def make():
        of = firms.Words(providers, canon=False).of
        town_of = lru_cache(1 << 14)(lambda t: _hash(strip_marks(t or "")))
        land_of = lru_cache(1 << 14)(lambda t: _hash(codes.get(strip_marks(t or ""), (t or "").strip().upper()[:2])))

        def one(name, email, site, town, land):
            names, sites, mails, address, host, _ = of(name, email, site)
            return names, sites, mails, _hash(address) or 0, _hash(host) or 0, town_of(town), land_of(land)

        return one

    x = with_row_function(rows, make, ["name", "email", "site", "town", "land"], "names string, sites string, mails string, address long, host long, town long, land long", ["src", "id"])
    said = cut(x, "words")
    generic, strong, total = firms.sides(said)
    x = firms.read(said, ["src", "id", "town", "land"], generic, strong, reading_terms, ("src", "address", "host"))
    x = x.filter("key is not null").withColumn("rec", F.xxhash64("src", "k"))
    return cut(x, "rows", free=(said,)), strong, total


def essential_terms(x: DataFrame) -> DataFrame:
    """(rec, src, term) of rows."""
    return x.select("rec", "src", F.explode("terms").alias("term"))


def near_readings(keys: list[tuple[str, ...]]) -> set[tuple[int, int]]:
    """(i, j), i < j, of all readings of a list that can be spellings of one another by ``firms.near_sets``, and some more: every
    word is looked up with the words of the list an edit away, and two words of a reading also as one."""
    at: dict[str, set[str]] = {}
    for w in {w for k in keys for w in k}:
        for s in shorter(w):
            at.setdefault(s, set()).add(w)
    near = lru_cache(1 << 16)(lambda w: [v for v in set().union(*(at.get(s, ()) for s in shorter(w))) if firms.near_words(w, v)])
    having: dict[tuple[str, ...], list[int]] = {}
    for i, k in enumerate(keys):
        having.setdefault(k, []).append(i)

    def joined(k: tuple[str, ...]) -> set[tuple[str, ...]]:
        out, todo = {k}, [k]
        while todo:
            k = todo.pop()
            for i, v in enumerate(k if len(k) <= 6 else ()):
                for j, w in enumerate(k):
                    if i != j and near(v + w):
                        z = tuple(sorted([x for n, x in enumerate(k) if n not in (i, j)] + [v + w]))
                        if z not in out:
                            out.add(z)
                            todo.append(z)
        return out

    out = set()
    for k, mine in having.items():
        for z in joined(k):
            options = [near(w) for w in z]
            if math.prod(map(len, options)) > len(having):
                found = [y for y in having if len(y) == len(z) and firms.near_sets(z, y)]
            else:
                found = [y for y in {tuple(sorted(c)) for c in product(*options)} if y in having]
            out |= {(min(i, j), max(i, j)) for y in found for i in mine for j in having[y] if i != j}
    return out


def within(hot: DataFrame, other: DataFrame, docs: DataFrame | None) -> DataFrame:
    """(a, b), a < b: of lists (rec, src, term) longer than ``FULL`` all pairs that can be the best two of a record and table."""
    listed = hot.select("rec", "src", F.col("term").alias("list"))
    also = Marks(listed, "rec").keep(other.select("rec", "term"), "rec").unionByName(hot.select("rec", "term")).distinct()
    if docs is None:
        own = listed.select("rec", F.lit(0).alias("size"), F.lit(None).cast("string").alias("key")).distinct()
    else:
        own = Marks(listed, "rec").keep(docs, "rec").select("rec", (F.size(F.split("key", " ")) + F.size("towns") + F.size("lands")).alias("size"), "key")
    listed = cut(listed.join(own, "rec"), "hot-lists")
    w = Window.partitionBy("list", "term")
    both = cut(listed.drop("size", "key").join(also, "rec").filter("list <> term").withColumn("n", F.count(F.lit(1)).over(w)).filter("n > 1"), "split-lists")
    # what few records of a list share brings these together
    few = both.filter(F.col("n") <= FULL).groupBy("list", "term").agg(F.sort_array(F.collect_list("rec")).alias("recs"))
    out = few.select("recs", F.posexplode("recs").alias("k", "a")).select("a", F.explode(F.slice("recs", F.col("k") + 2, F.lit(FULL))).alias("b"))
    pair = lambda df: df.filter("rec <> to").select(F.least("rec", "to").alias("a"), F.greatest("rec", "to").alias("b"))
    # else two records share terms that many have: among those that share as much, the shortest three of a table win
    many = both.filter(F.col("n") > FULL).groupBy("list", "rec").agg(F.sort_array(F.collect_list("term")).alias("terms"))
    listed = cut(listed.join(many, ["list", "rec"], "left").withColumn("terms", F.coalesce("terms", F.array().cast("array<long>"))), "shared")
    parts = F.expr("transform(sequence(0, shiftleft(1, size(terms)) - 1), m -> xxhash64(list, filter(terms, (t, i) -> (shiftright(m, i) & 1) = 1)))")
    each = listed.filter(F.size("terms") <= SUBSETS).select("rec", "src", "size", F.explode(parts).alias("part"))
    first = each.withColumn("r", F.row_number().over(Window.partitionBy("part", "src").orderBy("size", "rec"))).filter("r <= 3")
    out = out.unionByName(pair(each.join(first.select("part", F.col("rec").alias("to")), "part")))
    # records with more such terms meet their whole list
    out = out.unionByName(pair(listed.filter(F.size("terms") > SUBSETS).select("list", "rec").join(listed.select("list", F.col("rec").alias("to")), "list")))
    if docs is not None:

        def spelled(t: pa.Table) -> pa.Table:
            recs = t.column("rec").to_pylist()
            found = near_readings([tuple(k.split(" ")) for k in t.column("key").to_pylist()])
            return pa.table({"rec": pa.array([recs[i] for i, _ in found], pa.int64()), "to": pa.array([recs[j] for _, j in found], pa.int64())})

        out = out.unionByName(pair(listed.select("list", "rec", "key").groupBy("list").applyInArrow(spelled, "rec long, to long")))
    return out.distinct()


def candidates(post: DataFrame, other: DataFrame, total: int = 1, docs: DataFrame | None = None) -> DataFrame:
    """(a, b, essential, same): pairs of records, a < b, that share an essential term, of postings (rec, src, term), with the
    weights of these terms and whether one of them is an address or a site. ``other`` gives the further terms (rec, term)
    of records in lists longer than ``FULL``, ``docs`` their :func:`documents`; without these all are as long and none is near another."""
    w = Window.partitionBy("term")
    # the lists of more than one record
    found = post.withColumn("n", F.count(F.lit(1)).over(w)).filter("n > 1").distinct().withColumn("n", F.count(F.lit(1)).over(w).cast("int")).filter("n > 1")
    found = cut(found, "lists")
    weight = lambda n: F.log(1 + (F.lit(float(total)) - n + 0.5) / (n + 0.5))
    odd = lambda t: t.bitwiseAND(F.lit(1)) == 1
    l = found.filter(F.col("n") <= FULL).groupBy("term", "n").agg(F.sort_array(F.collect_list("rec")).alias("recs"))
    out = l.select("term", "n", "recs", F.posexplode("recs").alias("k", "a")).select("a", F.explode(F.slice("recs", F.col("k") + 2, F.lit(FULL))).alias("b"), "term", "n")
    out = out.select("a", "b", weight(F.col("n")).alias("essential"), odd(F.col("term")).alias("same"))
    hot = found.filter(F.col("n") > FULL)
    known = not hot.isEmpty()
    if known:
        out = out.unionByName(within(hot, other, docs).select("a", "b", F.lit(0.0).alias("essential"), F.lit(False).alias("same")))
    out = out.groupBy("a", "b").agg(F.sum("essential").alias("essential"), F.bool_or("same").alias("same"))
    if known:
        # whatever brought two records together, the long lists that they share count once
        held = hot.groupBy("rec").agg(F.collect_list(F.struct("term", "n")).alias("held"))
        out = out.join(held.select(F.col("rec").alias("a"), F.col("held").alias("p")), "a", "left").join(held.select(F.col("rec").alias("b"), F.col("held").alias("q")), "b", "left")
        shared = F.coalesce(F.array_intersect("p", "q"), F.array().cast("array<struct<term: bigint, n: int>>"))
        more = F.aggregate(shared, F.lit(0.0), lambda s, x: s + weight(x["n"]))
        out = out.select("a", "b", (F.col("essential") + more).alias("essential"), (F.col("same") | F.exists(shared, lambda x: odd(x["term"]))).alias("same"))
    return out.select("a", "b", F.col("essential").cast("float").alias("essential"), "same")


def frequent(x: DataFrame, column: str, total: int) -> dict[int, int]:
    """How many rows have a value, of those in more than one of ``SHARE``; rarer ones weigh as if they were as many."""
    return {r[0]: r[1] for r in x.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > total / SHARE).collect()}


def documents(x: DataFrame) -> DataFrame:
    """One row a record: ``rec``, ``src``, ``k``, ``key``, and its ``towns`` and ``lands``."""
    return x.groupBy("rec").agg(F.first("src").alias("src"), F.first("k").alias("k"), F.first("key").alias("key"), F.collect_set("town").alias("towns"), F.collect_set("land").alias("lands"))


def scored(x: DataFrame, cand: DataFrame, strong: dict[str, int], total: int) -> DataFrame:
    """Both directions of every candidate: (q, d, src_q, src_d, k_q, k_d, score, own, exact, same)."""
    spark = x.sparkSession
    ends = cand.select(F.explode(F.array("a", "b")).alias("rec"))
    docs = cut(documents(Marks(ends, "rec").keep(x, "rec")), "documents")
    sent = spark.sparkContext.broadcast((strong, frequent(x, "town", total), frequent(x, "land", total)))
    one = docs.select("rec", F.struct("src", "k", "key", "towns", "lands").alias("x"))
    pairs = cand.join(one.select(F.col("rec").alias("a"), F.col("x").alias("p")), "a").join(one.select(F.col("rec").alias("b"), F.col("x").alias("q")), "b")
    pairs = pairs.select(
        "a", "b", F.col("p.src").alias("src_a"), F.col("q.src").alias("src_b"), F.col("p.key").alias("key_a"), F.col("q.key").alias("key_b"), F.col("p.k").alias("k_a"), F.col("q.k").alias("k_b"),
        "essential", "same", F.array_intersect("p.towns", "q.towns").alias("towns"), F.array_intersect("p.lands", "q.lands").alias("lands"),
        (F.size("p.towns") + F.size("p.lands")).alias("n_a"), (F.size("q.towns") + F.size("q.lands")).alias("n_b"),
    )
    average = 5.0
    rare = math.log(1 + total)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, towns_n, lands_n = sent.value
        idf = lambda n: math.log(1 + (total - n + 0.5) / (n + 0.5))
        least = total / SHARE
        weights: dict[str, float] = {}

        def weight(w: str) -> float:
            got = weights.get(w)
            if got is None:
                got = weights[w] = idf(max(words.get(w, 1), 1))
            return got

        for b in batches:
            out = []
            cols = [b.column(c).to_pylist() for c in ("a", "b", "src_a", "src_b", "key_a", "key_b", "k_a", "k_b", "essential", "same", "towns", "lands", "n_a", "n_b")]
            for ra, rb, sa, sb, ka, kb, ha, hb, essential, same, towns, lands, na, nb in zip(*cols, strict=True):
                x = tuple(ka.split(" "))
                y = x if ha == hb else tuple(kb.split(" "))
                sum_x = sum(map(weight, x))
                if ha == hb:
                    near, got = True, sum_x
                else:
                    near = firms.near_sets(x, y)
                    got = sum(weight(w) for w in x if w in y)
                    if near:  # slips and joined writings count a little less than equal words
                        got += 0.8 * max(sum(weight(w) for w in x if w not in y), sum(weight(w) for w in y if w not in x))
                exact = near or (same and len(x) == len(y) and any(firms.near_words(v, w) for v in x for w in y))
                got += essential + sum(idf(max(towns_n.get(t, 0), least)) for t in towns or ()) + sum(idf(max(lands_n.get(t, 0), least)) for t in lands or ())
                own_x = sum_x + rare
                own_y = own_x if ha == hb else sum(map(weight, y)) + rare
                # every term stands once in a record, so BM25's saturation is a matter of the document's length
                for q, d, sq, sd, kq, kd, own, n in ((ra, rb, sa, sb, ha, hb, own_x, nb + len(y)), (rb, ra, sb, sa, hb, ha, own_y, na + len(x))):
                    out.append((q, d, sq, sd, kq, kd, got * (K1 + 1) / (1 + K1 * (1 - B + B * n / average)), own, exact, same))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [()] * 10, SCORED, strict=True)], names=NAMES)

    return pairs.mapInArrow(judge, "q long, d long, src_q byte, src_d byte, k_q long, k_d long, score float, own float, exact boolean, same boolean")


NAMES = ["q", "d", "src_q", "src_d", "k_q", "k_d", "score", "own", "exact", "same"]
SCORED = [pa.int64(), pa.int64(), pa.int8(), pa.int8(), pa.int64(), pa.int64(), pa.float32(), pa.float32(), pa.bool_(), pa.bool_()]


def calibrate(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a logistic function, by Newton steps with a little shrinkage."""
    a = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(a.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = a.T @ (a * (p * (1 - p))[:, None]) + 1e-2 * np.eye(len(w))
        w = w + np.linalg.solve(h, a.T @ (y - p) - 1e-2 * w)
    return w


def matches(rows: DataFrame, providers: list[str], codes: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(rows with their ``rec`` and ``k``, matches (q, d, src_q, src_d, k_q, k_d, score, confidence) between records)."""
    x, strong, total = records(rows, providers, codes)
    further = x.select("rec", F.explode(F.array_compact(F.concat(F.transform(F.split("key", " "), lambda w: F.xxhash64(w)), F.array("town", F.bitwise_not("land"))))).alias("term")).distinct()
    cand = cut(candidates(essential_terms(x), further, total, documents(x)), "candidates")
    pairs = cut(scored(x, cand, strong, total), "scored", free=(cand,))
    w = Window.partitionBy("q", "src_d").orderBy(F.desc("score"), "d")
    best = pairs.select("*", F.row_number().over(w).alias("r"), F.lead("score").over(w).alias("next"))
    best = best.filter("r <= 2").withColumn("gap", 1 - F.coalesce("next", F.lit(0.0)) / F.col("score")).withColumn("part", F.least(F.col("score") / F.col("own"), F.lit(2.0)))
    best = cut(best.drop("next"), "best", free=(pairs,))
    sample = lambda c: best.filter(c).orderBy(F.xxhash64("q", "d")).limit(CALIBRATION).select("gap", "part").collect()
    yes = sample("r = 1 and same and exact and k_q = k_d") + sample("r = 1 and exact and k_q <> k_d")
    no = sample("r = 2 and not same and not exact") + sample("r = 1 and not same and not exact")
    a = np.array([list(r) for r in [*yes, *no]] or [[0.0, 0.0]], float)
    y = np.array([1.0] * len(yes) + [0.0] * len(no) if yes or no else [0.0])
    c = calibrate(a, y) if yes and no else np.array([-2.0, 1.0, 4.0])
    confidence = 1 / (1 + F.exp(-(F.lit(float(c[0])) + F.lit(float(c[1])) * F.col("gap") + F.lit(float(c[2])) * F.col("part"))))
    first = best.filter("r = 1").withColumn("confidence", confidence)
    # the other's nearest in this record's table is this record, or the namesake that it has there
    back = first.select(F.col("q").alias("d"), F.col("src_d").alias("src_q"), F.col("d").alias("back"), F.col("k_d").alias("back_key"))
    m = first.filter("exact").join(back, ["d", "src_q"], "left")
    mutual = (F.col("back") == F.col("q")) | (F.col("back_key") == F.col("k_d")) | (F.col("src_q") == F.col("src_d"))
    m = cut(m.filter(mutual & (F.col("confidence") >= 0.5)).select("q", "d", "src_q", "src_d", "k_q", "k_d", "score", "confidence"), "matches", free=(best,))
    return x, m


#: For every set of matched pairs of four tables (bits in the order of ``PAIRS``), the first table that each is connected with.
PAIRS = [(i, j) for i in range(4) for j in range(i + 1, 4)]


def _roots() -> list[list[int]]:
    out = []
    for bits in range(1 << len(PAIRS)):
        root = list(range(4))
        for _ in range(3):
            for k, (i, j) in enumerate(PAIRS):
                if bits >> k & 1:
                    root[i] = root[j] = min(root[i], root[j])
        out.append(root)
    return out


ROOTS = _roots()


def firm_classes(x: DataFrame, found: DataFrame) -> DataFrame:
    """(src, id, label): rows whose record has a match, by class: what is connected by matches.

    Matches of equal readings connect the at most four records of a reading; that is closed without a join. Only the other
    matches are edges between these.
    """
    pair = F.expr("CASE " + " ".join(f"WHEN least(src_q, src_d) = {i} AND greatest(src_q, src_d) = {j} THEN {1 << n}" for n, (i, j) in enumerate(PAIRS)) + " ELSE 0 END")
    equal = found.filter("k_q = k_d and src_q <> src_d").select(F.col("k_q").alias("k"), pair.alias("bit")).groupBy("k").agg(F.bit_or("bit").alias("bits"))
    # a reading's node of a table, as a number
    root = F.expr("element_at(element_at(array(" + ", ".join("array(" + ", ".join(map(str, r)) + ")" for r in ROOTS) + "), coalesce(bits, 0) + 1), src + 1)")
    node = F.xxhash64("k", root.cast("byte"))
    ends = found.select(F.col("k_q").alias("k"), F.col("src_q").alias("src")).unionByName(found.select(F.col("k_d").alias("k"), F.col("src_d").alias("src"))).distinct()
    nodes = cut(ends.join(equal, "k", "left").select("k", "src", node.alias("node")), "nodes")
    link = found.filter("k_q <> k_d").select("k_q", "src_q", "k_d", "src_d")
    link = link.join(nodes.select(F.col("k").alias("k_q"), F.col("src").alias("src_q"), F.col("node").alias("a")), ["k_q", "src_q"]).join(nodes.select(F.col("k").alias("k_d"), F.col("src").alias("src_d"), F.col("node").alias("b")), ["k_d", "src_d"])
    labels = components(link.select("a", "b"), "a", "b").withColumnRenamed("node", "n")
    nodes = nodes.join(labels, F.col("node") == F.col("n"), "left").select("k", "src", F.coalesce("label", "node").alias("label"))
    return Marks(ends, "k").keep(x.select("src", "id", "k"), "k").join(nodes, ["k", "src"]).select("src", "id", "label")


def cross_pairs(classes: DataFrame) -> DataFrame:
    """Pairs of rows of different tables in one class."""
    return firms.ordered_pairs(classes, "label", "src")
