"""Edit metrics and the metric tree built on them (plain Python, used inside Arrow-batched operators)."""

from __future__ import annotations

from collections.abc import Iterable


def damerau(a: str, b: str, limit: int | None = None) -> int:
    """Unrestricted Damerau-Levenshtein distance: a true metric (insert, delete, replace, swap of neighbours).

    With ``limit`` any value above it may come back as ``limit + 1``. Empty strings are at the other's length.
    """
    if a == b:
        return 0
    if limit is not None and abs(len(a) - len(b)) > limit:
        return limit + 1
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    k = 0
    while k < len(a) and k < len(b) and a[k] == b[k]:
        k += 1
    a, b = a[k:], b[k:]
    if not a or not b:
        return len(a) + len(b)
    if limit is not None and min(len(a), len(b)) > 3 and Levenshtein(a).to(b) > 2 * limit:
        return limit + 1  # a swap counts at most twice there
    far = len(a) + len(b)
    last: dict[str, int] = {}
    rows = [[far] * (len(b) + 2), [far, *range(len(b) + 1)]]
    for i, x in enumerate(a, 1):
        row, col = [far, i], 0
        up = rows[i]
        for j, y in enumerate(b, 1):
            k = last.get(y, 0)
            if x == y:
                cost = up[j]
                row.append(cost)
                col = j
                continue
            best = min(up[j], up[j + 1], row[j]) + 1
            if k and col:
                best = min(best, rows[k][col] + (i - k - 1) + 1 + (j - col - 1))
            row.append(best)
        last[x] = i
        rows.append(row)
    return rows[-1][-1]


class Levenshtein:
    """Distances from one word to many, bit-parallel (Myers 1999): a column of the table is two integers."""

    def __init__(self, word: str):
        self.n, self.full = len(word), (1 << len(word)) - 1
        self.at: dict[str, int] = {}
        for k, c in enumerate(word):
            self.at[c] = self.at.get(c, 0) | 1 << k

    def to(self, other: str) -> int:
        if not self.n:
            return len(other)
        plus, minus, score, top, full = self.full, 0, self.n, 1 << (self.n - 1), self.full
        for c in other:
            eq = self.at.get(c, 0)
            x = eq | minus
            h = (((eq & plus) + plus) ^ plus) | eq
            up, down = (minus | ~(h | plus)) & full, plus & h
            if up & top:
                score += 1
            elif down & top:
                score -= 1
            up, down = (up << 1 | 1) & full, (down << 1) & full
            plus, minus = (down | ~(x | up)) & full, up & x
        return score


class BKTree:
    """Burkhard-Keller tree over distinct words under Levenshtein's distance, a true metric.

    ``search`` returns every (distance, word) within ``radius`` by :func:`damerau`. A swap of neighbours counts once
    there and twice for Levenshtein, so the tree is searched within twice the radius and the hits are verified. A child
    at edge ``e`` can hold a hit only if ``|e - distance to the node|`` is within that, by the triangle inequality.
    """

    def __init__(self, words: Iterable[str] = ()):
        self.root: tuple[str, dict] | None = None
        for w in words:
            self.add(w)

    def add(self, word: str) -> None:
        if self.root is None:
            self.root = (word, {})
            return
        node, metric = self.root, Levenshtein(word)
        while d := metric.to(node[0]):
            if d not in node[1]:
                node[1][d] = (word, {})
                return
            node = node[1][d]

    def search(self, word: str, radius: int) -> list[tuple[int, str]]:
        found, stack, metric, within = [], [self.root] if self.root else [], Levenshtein(word), 2 * radius
        while stack:
            at, children = stack.pop()
            d = metric.to(at)
            if d <= within and (exact := damerau(word, at, radius)) <= radius:
                found.append((exact, at))
            stack += [c for e, c in children.items() if -within <= e - d <= within]
        return sorted(found)
