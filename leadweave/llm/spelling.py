"""Which words are established, and which established word a slip can stand for.

A word is established if it stands in more than one of ``SHARE`` of all entries, so there are at most ``SHARE`` times the
words of an entry such words, whatever the data: they can travel with the tasks. Whether an established word can
itself be a slip of another is a matter of their ratio, not of a fixed count, so a common misspelling stays one however
many rows there are.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadweave.llm.edit import damerau

SHARE = 50_000
#: So many times more frequent is a word of which another is a slip. Of the other's entries the first ``FEW`` don't
#: count: so few say nothing about it.
RATIO, FEW = 4, 4


def shorter(word: str) -> set[str]:
    """The word and what is left of it without one letter: words one edit apart have one of these in common."""
    return {word, *(word[:i] + word[i + 1 :] for i in range(len(word)))}


class Spelling:
    """Established words with their numbers of entries."""

    def __init__(self, counts: dict[str, int], ratio: int = RATIO):
        self.counts, self.ratio = counts, ratio
        self.at: dict[str, list[str]] = {}
        for w in counts:
            if len(w) > 1:
                for s in shorter(w):
                    self.at.setdefault(s, []).append(w)
        self.options = lru_cache(1 << 18)(self._options)
        self.sound = lru_cache(1 << 18)(self._sound)
        self.apart = lru_cache(1 << 18)(self._apart)

    def _near(self, word: str) -> list[str]:
        least = self.ratio * (self.counts.get(word, 0) - FEW)
        found = {v for s in shorter(word) for v in self.at.get(s, ()) if v != word and self.counts[v] >= least}
        return sorted(v for v in found if damerau(word, v, 1) <= 1)

    def parts(self, word: str) -> list[tuple[str, str]]:
        """Two established words that stand together in the word."""
        n = len(word)
        return [(word[:i], word[i:]) for i in range(4, n - 3) if word[:i] in self.counts and word[i:] in self.counts] if n >= 8 else []

    def _sound(self, word: str) -> bool:
        """The word, or both words that it is joined of, are established and no slips."""
        if word in self.counts:
            return not self._near(word)
        return any(not self._near(a) and not self._near(b) for a, b in self.parts(word))

    def _apart(self, word: str) -> tuple[str, ...]:
        """The word, or the two established words that it is joined of."""
        if word in self.counts:
            return (word,)
        return max(self.parts(word), key=lambda p: (min(self.counts[x] for x in p), p), default=(word,))

    def _options(self, word: str) -> tuple[str, ...]:
        """The established words, or two of them joined, of which the word can be a slip."""
        return tuple(sorted({"".join(p) for p in self.readings(word)}))

    def readings(self, word: str) -> list[tuple[str, ...]]:
        """The same with the joined words apart."""
        if self.sound(word):
            return []
        out = {(v,) for v in self._near(word)}
        if len(word) >= 8 and word not in self.counts:
            for i in range(4, len(word) - 3):
                a, b = word[:i], word[i:]
                if a in self.counts:
                    out |= {(a, v) for v in self._near(b)}
                if b in self.counts:
                    out |= {(v, b) for v in self._near(a)}
                # a swap over the border
                a, b = a[:-1] + b[0], a[-1] + b[1:]
                if a in self.counts and b in self.counts:
                    out.add((a, b))
        return sorted(out)


_made: list[tuple[object, Spelling]] = []


def spelling(sent) -> Spelling:
    """The object of a broadcast dictionary, made once a Python process and broadcast."""
    counts = sent.value
    if not _made or _made[0][0] is not counts:
        _made[:] = [(counts, Spelling(counts))]
    return _made[0][1]


def established(words: DataFrame, entries: int, share: int = SHARE) -> dict[str, int]:
    """The established words of a column ``w`` with one row a word of an entry: those in more than one of ``share`` of the
    ``entries``, and in two at least."""
    got = words.filter(F.length("w") > 0).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    return {r[0]: r[1] for r in got.filter(F.col("n") >= max(2, entries / share)).collect()}
