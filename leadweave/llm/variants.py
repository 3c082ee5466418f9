"""Variant spellings of names typed by people.

Distinct identifying words are joined with each other by a prefix-filtered set-similarity join on their letter triples:
one edit destroys at most four triples, so two words an edit apart share one of the rarest five of each. The join runs
on the vocabulary, which grows far slower than the rows. Of two similar words the rarer one is a slip if the other is
several times more frequent (a ratio, whatever the size), or both may be if few rows say anything about them. A name's signature are its
identifying words, each as it stands or as the word it is a slip of: names that share less than one whole
signature are under the least similarity. Candidates are verified by a soft weighted token similarity, in which a pair of
similar words counts with its similarity and rare words weigh more. Verified links, and those between the readings of one
row's own columns, make classes.

Defined results: rows without a name aren't linked; names that differ in writing only aren't a pair; names without
identifying words are linked through their row's site or mail address (``named`` says which); repeated rows pair with every variant;
empty tables give no pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import product

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadweave.llm.edit import damerau
from leadweave.llm import firms
from leadweave.llm.marks import Marks
from leadweave.llm.spelling import FEW, RATIO, spelling
from leadweave.session import cut

#: Triples that one edit destroys at most.
LOST = 4
SIMILARITY = 0.75


def triples(word: F.Column) -> F.Column:
    """Letter triples of a word with its ends marked; with a word of up to four letters, all of whose triples a swap can
    destroy, also its sorted letters."""
    w = F.concat(F.lit("^"), word, F.lit("$"))
    t = F.transform(F.sequence(F.lit(1), F.greatest(F.length(w) - 2, F.lit(1))), lambda k: F.substring(w, k, 3))
    letters = F.concat(F.lit("="), F.array_join(F.array_sort(F.split(word, "")), ""))
    return F.when(F.length(word) <= 4, F.concat(t, F.array(letters))).otherwise(t)


def similar_words(words: DataFrame) -> DataFrame:
    """(``w``, ``n``) -> (``w``, ``v``): words one edit apart, ``v`` a word of which ``w`` can be a slip: several times
    more frequent, or of few rows both and then the more frequent or, in a tie, the first."""
    g = words.select("w", "n", F.posexplode(triples(F.col("w"))).alias("at", "g"))
    # the global order of triples: rarest first
    order = g.groupBy("g").agg(F.count(F.lit(1)).alias("f"))
    g = g.join(order, "g")
    rank = F.row_number().over(Window.partitionBy("w").orderBy("f", "g", "at"))
    prefix = cut(g.withColumn("r", rank).filter(F.col("r") <= LOST + 1).select("w", "n", "g", "at"), "prefix")
    # an edit moves a triple by one place at most
    a = prefix.select("g", F.explode(F.array(F.col("at") - 1, F.col("at"), F.col("at") + 1)).alias("at"), "w", F.col("n").alias("nw"))
    b = prefix.select("g", "at", F.col("w").alias("v"), F.col("n").alias("nv"))
    up = (F.col("nv") >= RATIO * (F.col("nw") - FEW)) & ((F.col("nv") > F.col("nw")) | ((F.col("nv") == F.col("nw")) & (F.col("v") < F.col("w"))))
    end = (F.substring("w", 1, 1) == F.substring("v", 1, 1)) | (F.substring("w", -1, 1) == F.substring("v", -1, 1))
    near = (F.abs(F.length("w") - F.length("v")) <= 1) & end & (F.levenshtein("w", "v", 2) >= 0)
    pairs = a.join(b, ["g", "at"]).filter(up & near).select("w", "v").distinct()
    return pairs.filter(one_edit("w", "v"))


def one_edit(a: str, b: str) -> F.Column:
    return F.pandas_udf(lambda x, y: pd.Series([min(len(p), len(q)) > 3 and damerau(p, q, 1) <= 1 for p, q in zip(x, y, strict=True)], dtype="bool"), "boolean")(a, b)


def soft_similarity(x: list[str], y: list[str], weight: dict[str, float]) -> float:
    """Soft weighted token similarity of two word sets, 0 to 1: matched weight over all weight, each pair of words once."""
    left, got = list(y), 0.0
    for w in sorted(x, key=lambda w: -weight.get(w, 1.0)):
        best = max(left, key=lambda v: (v == w, -damerau(w, v)), default=None)
        if best is None:
            continue
        s = 1 - damerau(w, best) / max(len(w), len(best))
        if s >= 0.6:
            left.remove(best)
            got += s * (weight.get(w, 1.0) + weight.get(best, 1.0))
    whole = sum(weight.get(w, 1.0) for w in [*x, *y])
    return got / whole if whole else 0.0


def spelled_links(rows: DataFrame, strong: dict[str, int]) -> DataFrame:
    """Links (``a``, ``b``), as hashes, between keys whose words are variants, of :func:`firms.read`'s rows.

    Keys of sound words only hold no slip and take part as targets. What can't be a target of another reading is left out
    by a bitmap, before anything is shuffled.
    """
    spark = rows.sparkSession
    h = F.pandas_udf(lambda s: pd.Series([firms.hash_of(t) for t in s], dtype="int64"), "long")
    own = rows.filter("others is not null").select("k", F.explode(F.split("others", "[|]")).alias("other")).distinct()
    own = cut(own.withColumn("o", h("other")), "own")
    cuts = rows.filter("cuts is not null").select("k", F.explode(F.split("cuts", "[|]")).alias("key"))
    known = spark.sparkContext.broadcast(strong)
    unsound = F.pandas_udf(lambda s: pd.Series([not all(map(spelling(known).sound, t.split(" "))) for t in s], dtype="bool"), "boolean")
    dirty = rows.filter(~F.col("clean")).select("k", "key").unionByName(own.select(F.col("o").alias("k"), F.col("other").alias("key")).filter(unsound("key"))).unionByName(cuts)
    dirty = cut(dirty.distinct().withColumn("ws", F.split("key", " ")), "dirty")
    by_word = dirty.select("k", "key", F.explode("ws").alias("w"))
    total = max(2, sum(strong.values()))
    # every word: the established ones with their rows, the others from the keys that have them
    sure = spark.createDataFrame(list(strong.items()), "w string, n long")
    vocabulary = by_word.groupBy("w").agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(sure.select("w")), "w", "left_anti").unionByName(sure)
    similar = cut(similar_words(cut(vocabulary, "words")), "similar")
    # each word may stand for each of its similar words
    options = by_word.join(similar, "w").groupBy("k", "key").agg(F.collect_set(F.concat_ws(" ", "w", "v")).alias("swaps"))

    def swap(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in filter(len, batches):
            out = []
            for k, key, swaps in zip(pdf["k"], pdf["key"], pdf["swaps"], strict=True):
                to: dict[str, list[str]] = {}
                for pair in swaps:
                    w, v = pair.split(" ")
                    to.setdefault(w, [w]).append(v)
                for words in product(*[to.get(w, [w]) for w in key.split(" ")]):
                    other = " ".join(sorted(set(words)))
                    if other != key:
                        out.append((key, k, other, firms.hash_of(other)))
            yield pd.DataFrame(out, columns=["key", "k", "other", "o"])

    swapped = options.mapInPandas(swap, "key string, k long, other string, o long")
    # a cut reading of sound words is a candidate as it stands
    swapped = cut(swapped.unionByName(cuts.distinct().select("key", "k", F.col("key").alias("other"), h("key").alias("o"))), "swapped")
    every = rows.select("k").unionByName(own.select(F.col("o").alias("k")))
    targets = Marks(swapped, "o").keep(every, "k").select(F.col("k").alias("o")).distinct()
    direct = swapped.join(targets, "o")
    # two rare spellings whose common form stands nowhere
    lost = swapped.join(targets, "o", "left_anti")
    first = lost.groupBy("other").agg(F.min(F.struct("key", "k")).alias("first"))
    meet = lost.join(first, "other").filter("k <> first.k")
    links = direct.select(F.col("key").alias("x"), F.col("other").alias("y"), F.col("k").alias("a"), F.col("o").alias("b"))
    links = links.unionByName(meet.select(F.col("first.key").alias("x"), F.col("key").alias("y"), F.col("first.k").alias("a"), F.col("k").alias("b"))).distinct()
    # words that aren't established and stand together in one of two keys
    single = dirty.filter(F.size("ws") == 1).select(F.col("key").alias("j"), F.col("k").alias("b"))
    double = dirty.filter(F.size("ws") == 2).select(F.explode(F.array(F.concat(F.col("ws")[0], F.col("ws")[1]), F.concat(F.col("ws")[1], F.col("ws")[0]))).alias("j"), F.col("k").alias("a"))
    joined = double.join(single, "j").select("a", "b").distinct()

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        class Weight(dict):
            def get(self, w, default=None):
                return math.log(1 + total / (strong.get(w, 0) + 1))

        weight = Weight()
        for pdf in filter(len, batches):
            yield pdf.loc[[soft_similarity(x.split(), y.split(), weight) >= SIMILARITY for x, y in zip(pdf["x"], pdf["y"], strict=True)], ["a", "b"]]

    return links.mapInPandas(verify, "a long, b long").unionByName(joined).unionByName(own.select(F.col("k").alias("a"), F.col("o").alias("b")))


def name_classes(rows: DataFrame, providers: list[str]) -> DataFrame:
    """(``src``, ``id``, ``canon``, ``named``, ``label``) of rows with ``name``, ``email``, ``site``: the class of each row,
    and whether its name shows it."""
    said = cut(firms.words(rows, ["src", "id"], providers).select("src", "id", "names", "sites", "mails", "canon"), "words")
    generic, strong, _ = firms.sides(said)
    x = cut(firms.read(said, ["src", "id", "canon"], generic, strong).filter("key is not null"), "readings", free=(said,))
    return firms.with_labels(x.select("src", "id", "canon", "named", "k"), spelled_links(x, strong), "a", "b").select("src", "id", "canon", "named", "label")


def variant_pairs(classes: DataFrame) -> DataFrame:
    """Pairs of rows of one class whose names differ in more than writing."""
    return firms.ordered_pairs(classes.filter("canon <> 0"), "label", "canon")
