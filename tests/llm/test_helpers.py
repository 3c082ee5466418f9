"""Metrics, trees, components, addresses and folding."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from leadweave.llm import address as A
from leadweave.llm import fold
from leadweave.llm.components import components
from leadweave.llm.edit import BKTree, Levenshtein, damerau


def lev(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return row[-1]


WORD = st.text("abc", max_size=7)


@settings(max_examples=300, deadline=None)
@given(WORD, WORD, WORD)
def test_metrics(a, b, c):
    assert Levenshtein(a).to(b) == lev(a, b)
    assert damerau(a, b) == damerau(b, a) <= lev(a, b) <= 2 * damerau(a, b)
    assert damerau(a, c) <= damerau(a, b) + damerau(b, c)


@settings(max_examples=60, deadline=None)
@given(st.sets(WORD, max_size=40), WORD, st.integers(0, 2))
def test_tree_finds_all(words, w, r):
    assert BKTree(sorted(words)).search(w, r) == sorted((damerau(w, x), x) for x in words if damerau(w, x) <= r)


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(50)] + [(100 + i, 101 + i) for i in range(20)] + [(7, 7), (None, 3)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    want = {x: find(x) for x in parent}
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


VALUES = [None, "", " ", "-", "n/a", "<a@b.nl>", "mailto:A@B.nl;", "a @ b.nl", "a​@b.nl", "\"a.b@c.nl\"", "https://www.a.nl:443/x?y", "WWW.A.nl.", "user@a.nl/x", "http://a.nl/@x", "Köln.test", "Köln.test", "ﬁrm.nl", "İstanbul.test", "x" * 5000]


def test_address_columns_equal_python(spark):
    rows = spark.createDataFrame([(v,) for v in VALUES], "v string")
    got = rows.select("v", A.bare(F.col("v")).alias("b"), A.host_of(A.bare(F.col("v"))).alias("h"), A.mail_of(A.bare(F.col("v"))).alias("m"), fold.canon(F.col("v")).alias("c")).collect()
    for v, b, h, m, c in got:
        bare = A.bare_text(v)
        assert (b, h, m, c) == (bare, A.host_text(bare), A.mail_text(bare), fold.canon_word(v or ""))


def test_fold():
    assert fold.canon_word("Köln-Straße") == fold.canon_word("KÖLN STRASSE")
    assert fold.canon_word("Kö") != fold.canon_word("Ko")
    assert fold.strip_marks("Ş.T.İ  Ltd") == "s t i ltd"
    assert fold.unmojibake("BindrÃ¶ltepe") == "Bindröltepe"
    assert fold.unmojibake("Àé") == "Àé"
