"""Evaluation texts leaking into training text, by suffix arrays over the training side.

Every task builds suffix arrays over shards of its documents (whole documents, about ``shard_words`` words each) and
binary-searches every suffix of every test text in them. A suffix of the training text whose first ``min_words``
words aren't all words of the test set can't hold a passage and stays out of the array. A hit is extended to its
longest verbatim match; the positions that a document covers of an item are the union of its passages. Documents
never leave their task: the scan is one map, without a shuffle, and what travels is the test set, in blocks of
``block_words`` words if it is large.

Defined results: NULL and empty texts hold nothing; an item of fewer than ``min_words`` words never leaks; repeated
documents come out each; equal items come out each; a document longer than a shard is a shard of its own; columns of
the documents other than the two that are named don't matter.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadweave.llm.text import words

MIN_WORDS = 8
MIN_SHARE = 1 / 3


def suffix_array(ids: np.ndarray) -> np.ndarray:
    """Positions of ``ids`` in the order of their suffixes, by prefix doubling. Zeros end a suffix."""
    n = len(ids)
    if not n:
        return np.zeros(0, np.int64)
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64)
    k = 1
    while True:
        after = np.zeros(n, np.int64)
        after[: max(0, n - k)] = rank[k:] + 1
        order = np.lexsort((after, rank))
        r, a = rank[order], after[order]
        fresh = np.ones(n, np.int64)
        fresh[1:] = (r[1:] != r[:-1]) | (a[1:] != a[:-1])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(fresh) - 1
        k *= 2
        if rank[order[-1]] == n - 1 or k >= n:
            return order


def _keys(ids: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` words at each position as one comparable byte string."""
    rows = ids[at[:, None] + np.arange(n)[None, :]].astype(">u4")
    return np.ascontiguousarray(rows).view(f"S{4 * n}").ravel()


class TestSet:
    """Suffixes of the test texts over their own vocabulary; word numbers start at 1."""

    __test__ = False

    def __init__(self, items: list[tuple[int, str]], min_words: int = MIN_WORDS):
        self.min_words, self.vocabulary = min_words, {}
        self.item, self.length, ids, starts = [], [], [], []
        owner, offset = [], []
        for i, text in items:
            w = [self.vocabulary.setdefault(x, len(self.vocabulary) + 1) for x in words(text)]
            if len(w) < min_words:
                continue
            self.item.append(i)
            self.length.append(len(w))
            here = len(ids)
            ids += [*w, 0]
            for k in range(len(w) - min_words + 1):
                starts.append(here + k)
                owner.append(len(self.item) - 1)
                offset.append(k)
        self.ids = np.array(ids + [0] * min_words, np.int64)
        self.starts, self.owner, self.offset = np.array(starts, np.int64), np.array(owner, np.int64), np.array(offset, np.int64)
        self.keys = _keys(self.ids, self.starts, min_words) if starts else np.zeros(0, f"S{4 * min_words}")

    def search(self, docs: list[tuple[object, list[int]]]) -> Iterator[tuple[object, int, int, int, int, int]]:
        """(document, item index, words covered, longest match, its place in the document, its place in the item)."""
        n = self.min_words
        seq, place, doc = [], [], []
        for d, w in docs:
            # runs of test words of n or more, a zero between them
            run = 0
            for k, x in enumerate([*w, 0]):
                if x:
                    run += 1
                    continue
                if run >= n:
                    seq += [*w[k - run : k], 0]
                    place += range(k - run, k + 1)
                    doc += [d] * (run + 1)
                run = 0
        if not seq or not len(self.starts):
            return
        ids = np.array(seq + [0] * n, np.int64)
        sa = suffix_array(ids[: len(seq)])
        # suffixes with n words before their end
        zero = np.flatnonzero(ids == 0)
        left = zero[np.searchsorted(zero, sa)] - sa
        sa, left = sa[left >= n], left[left >= n]
        keys = _keys(ids, sa, n)
        low, high = np.searchsorted(keys, self.keys, "left"), np.searchsorted(keys, self.keys, "right")
        covered, longest = defaultdict(set), {}
        for t in np.flatnonzero(high > low):
            o, k, s = int(self.owner[t]), int(self.offset[t]), int(self.starts[t])
            rest = self.length[o] - k
            for j in range(low[t], high[t]):
                p = int(sa[j])
                m = n
                top = min(rest, int(left[j]))
                while m < top and ids[p + m] == self.ids[s + m]:
                    m += 1
                key = (doc[p], o)
                covered[key].update(range(k, k + n))
                if m > longest.get(key, (0,))[0]:
                    longest[key] = (m, place[p], k)
        for (d, o), c in covered.items():
            yield d, o, len(c), *longest[d, o]


def find_leaks(docs: DataFrame, items: list[tuple[int, str]], id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, shard_words: int = 2_000_000) -> DataFrame:
    """Every (document, item) that share a passage of ``min_words`` or more words in a row, with the share covered."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tests = TestSet(items, min_words)
        shard, size = [], 0

        def flush() -> pd.DataFrame:
            rows = [(d, tests.item[o], c, tests.length[o], c / tests.length[o], m, at, k) for d, o, c, m, at, k in tests.search(shard)]
            return pd.DataFrame(rows, columns=["doc_id", "item_id", "covered", "item_words", "share", "longest", "doc_word", "item_word"])

        for pdf in filter(len, batches):
            for d, text in zip(pdf["_d"], pdf["_t"], strict=True):
                w = [tests.vocabulary.get(x, 0) for x in words(text)]
                if len(w) >= min_words:
                    shard.append((d, w))
                    size += len(w)
                if size >= shard_words:
                    yield flush()
                    shard, size = [], 0
        yield flush()

    schema = "doc_id long, item_id long, covered int, item_words int, share double, longest int, doc_word int, item_word int"
    return docs.select(F.col(id_col).cast("long").alias("_d"), F.col(text_col).alias("_t")).mapInPandas(scan, schema)


def leaks(docs: DataFrame, tests: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, min_share: float = MIN_SHARE, block_items: int = 20_000) -> DataFrame:
    """:func:`find_leaks` against a table (``item_id``, ``text``), block after block of the test set, of a share or more."""
    out, last = None, None
    while True:
        q = tests.select("item_id", "text").filter("item_id is not null")
        rows = (q if last is None else q.filter(F.col("item_id") > last)).orderBy("item_id").limit(block_items).collect()
        if rows or out is None:
            part = find_leaks(docs, [(r[0], r[1]) for r in rows], id_col, text_col, min_words).filter(F.col("share") >= min_share - 1e-12)
            out = part if out is None else out.unionByName(part)
        if len(rows) < block_items:
            return out
        last = rows[-1][0]


def without_leaks(docs: DataFrame, found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The documents that hold no test text."""
    return docs.join(found.select(F.col("doc_id").alias("_leak")).distinct(), F.col(id_col) == F.col("_leak"), "left_anti")
