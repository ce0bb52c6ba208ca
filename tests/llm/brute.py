"""Plain Python versions of the operators."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

from gridloom.llm.katz import LARGEST, discounts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
END, BEGIN = ("end",), ("begin",)


class Katz:
    """The model of word runs, by dictionaries."""

    def __init__(self, texts: list[list], order: int = 3):
        self.order, self.docs, self.count, self.after = order, len(texts), Counter(), defaultdict(set)
        for words in texts:
            for gram in self.grams(words):
                for k in range(1, order + 1):
                    self.count[gram[-k:]] += 1
                    self.after[gram[-k:-1]].add(gram[-1])
        self.n, self.v = sum(self.count[w,] for w in self.after[()]), len(self.after[()])
        self.kept = []
        for k in range(1, order + 1):
            times = Counter(c for gram, c in self.count.items() if len(gram) == k)
            self.kept.append(discounts([times[r] for r in range(1, LARGEST + 2)]))

    def grams(self, words: list) -> list[tuple]:
        padded = [BEGIN] * (self.order - 1) + [*words, END]
        return [tuple(padded[i : i + self.order]) for i in range(len(words) + 1)]

    def word(self, w) -> float:
        return (self.count[w,] + 0.5) / (self.n + 0.5 * (self.v + 1))

    def stays(self, gram) -> float:
        r = self.count[gram]
        return r * self.kept[len(gram) - 1][r - 1] if r <= LARGEST else r - 0.5

    def times(self, context) -> int:
        return self.n if not context else self.docs if set(context) == {BEGIN} else self.count[context]

    def weight(self, context) -> float:
        left = 1 - sum(self.stays((*context, w)) for w in self.after[context]) / self.times(context)
        return left / (1 - sum(self.probability((*context[1:], w)) for w in self.after[context]))

    def probability(self, gram) -> float:
        context = gram[:-1]
        if self.count[gram]:
            return self.stays(gram) / self.times(context)
        if not context:
            return 1 - sum(self.stays((w,)) for w in self.after[()]) / self.n if self.n else 1.0
        return (self.weight(context) if self.times(context) else 1.0) * self.probability(gram[1:])


def katz_scores(rows: list[tuple[int, str | None]], order: int = 3) -> list[tuple]:
    words = {i: WORD.findall((t or "").translate(LOWER)) for i, t in rows}
    out = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows}
    model = Katz([words[i] for i, _ in rows if not out[i]], order)
    made = []
    for i, _ in rows:
        w = words[i]
        made.append((
            i, out[i], len(w) + 1, sum(model.count[x,] > 0 for x in [*w, END]), model.n, sum(math.log10(model.word(x)) for x in [*w, END]),
            sum(math.log10(model.probability(gram)) for gram in model.grams(w)),
        ))
    return made


def kept_words(rows: list[tuple[int | None, str | None]], window: int) -> list[tuple]:
    """Per row: id, words, removed words, what is left."""
    split = [(2**63 - 1 if i is None else i, WORD.findall(t or "")) for i, t in rows]
    least: dict[tuple, int] = {}
    for i, w in split:
        for s in range(len(w) - window + 1):
            key = tuple(w[s : s + window])
            least[key] = min(least.get(key, i), i)
    made = []
    for (given, _), (i, w) in zip(rows, split):
        gone = {p for s in range(len(w) - window + 1) if least[tuple(w[s : s + window])] < i for p in range(s, s + window)}
        made.append((given, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return made


def similar(rows: list[tuple[int | None, str | None]]) -> list[tuple]:
    """Per row: id, number of shingles, component; a null id is the largest."""
    ids = [2**63 - 1 if i is None else i for i, _ in rows]
    sets = []
    for _, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    up = list(range(len(rows)))

    def root(i: int) -> int:
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                up[root(i)] = root(j)
    least: dict[int, int] = {}
    for i in range(len(rows)):
        least[root(i)] = min(least.get(root(i), ids[i]), ids[i])
    return [(ids[i], len(sets[i]), least[root(i)]) for i in range(len(rows))]
