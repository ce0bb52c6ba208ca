"""Conversation repair, the k-means tree and collocations against plain versions, with nulls, ties, repeated rows, no rows, long groups."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from gridloom.llm import collocations, conversation_repair, kmeans_tree
from gridloom.llm.common import NO_ID

# Conversation repair


def plain_edits(rows):
    """(cost, audit, lines) of the cheapest edits by trying all edits row by row; rows are (role, text, fault)."""
    nxt = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
    wanted = {0: "u", 1: "u", 2: "a", 3: "u"}
    name = {"u": "user", "a": "assistant"}

    def inserted(states):
        for _ in range(4):
            for q, (c, a, lines) in list(states.items()):
                new, to = (c + 3, a + "I", [*lines, name[wanted[q]] + ":"]), nxt[q, wanted[q]]
                states[to] = min(states.get(to, new), new)
        return states

    states = inserted({0: (0, "", [])})
    for role, text, fault in rows:
        after = {}
        for q, (c, a, lines) in states.items():
            moves = [(q, (c + 4, a + "D", lines))]
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                moves.append((nxt[q, wanted[q]], (c + 3 + more, a + "R", [*lines, f"{name[wanted[q]]}:{text}"])))
                if (q, role[:1]) in nxt:
                    moves.append((nxt[q, role[:1]], (c + more, a + "K", [*lines, f"{role}:{text}"])))
            for to, best in moves:
                after[to] = min(after.get(to, best), best)
        states = inserted(after)
    return min(states[q] for q in (0, 3) if q in states)


def plain_repair(table):
    out = {}
    for conv in {r[0] for r in table}:
        kept = []
        for _, turn, role, text in (r for r in table if r[0] == conv):
            role, text = (" " if v is None else v for v in (role, text))
            draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
            kept += [(turn, "user" if draw == 4 else role, text)] * (0 if draw == 0 else 2 if draw == 3 else 1)
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults = set(), []
        for _, role, text in kept:
            words = text.strip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not words else "duplicate" if (role, text) in seen else "" if words[-1] in ".!?" else "truncated")
            seen.add((role, text))
        turns = [t for t, _, _ in kept if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(kept))
        cost, audit, lines = plain_edits([(role, text, f) for (_, role, text), f in zip(kept, faults)])
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def talks(seed, n=60, most=9):
    r = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(r.randrange(1, most)):
            role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = r.choice(["One.", "Two!", "three", " ", "", None, "Ünï?", "four\nfive. ", " ", "x" * 40_000 + "."])
            rows.append((conv, r.choice([turn, turn, turn + 2, None]), role, text))
    return [*rows, rows[3], rows[3], (None, 1, "user", "Null id."), (None, None, "assistant", "Yes.")]


CONVERSATIONS = "conv_id long, turn long, role string, text string, copies int, long_id long"


@pytest.mark.parametrize("settings", [{}, {"segment": 3}, {"long_rows": 4, "segment": 2}, {"long_rows": 0, "segment": 5}])
def test_repaired_conversations(spark, settings):
    rows = talks(5)
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], CONVERSATIONS).repartition(4)
    got = {r[0]: tuple(r)[1:] for r in conversation_repair.repair(df, **settings).collect()}
    assert got == plain_repair(rows)


def test_one_conversation_of_many_rows_is_dealt_out(spark):
    r = random.Random(9)
    rows = [(7, i // 3, r.choice(["user", "assistant"]), r.choice(["A.", "b", "C?", f"{i}."])) for i in range(3000)]
    df = spark.createDataFrame([(*x, 1, 2) for x in rows], CONVERSATIONS)
    assert {x[0]: tuple(x)[1:] for x in conversation_repair.repair(df, long_rows=500).collect()} == plain_repair(rows)


def test_no_conversations_and_dropped_ones(spark):
    assert conversation_repair.repair(spark.createDataFrame([], CONVERSATIONS)).count() == 0
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    for settings in ({}, {"long_rows": 0}):
        row = conversation_repair.repair(spark.createDataFrame([(gone, 0, "user", "Hi.", 1, 2)], CONVERSATIONS), **settings).first()
        assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_lattice_search_finds_the_least_of_all_cheapest_paths():
    r = random.Random(2)
    for _ in range(3000):
        steps = tuple((r.choice("suax"), r.random() < 0.3) for _ in range(r.randrange(7)))
        want = plain_edits([({"s": "system", "u": "user", "a": "assistant", "x": "x"}[c], "", "truncated" if t else "") for c, t in steps])[:2]
        assert conversation_repair.cheapest(steps, conversation_repair.START, conversation_repair.ACCEPTED) == want
        assert conversation_repair.edits(steps * 4, 3) == conversation_repair.cheapest(steps * 4, conversation_repair.START, conversation_repair.ACCEPTED)


# The k-means tree


def plain_nearest(rows, most=5):
    good = [(i, np.array(v, float)) for i, v in rows if v and None not in v and np.isfinite(np.array(v, float)).all() and np.array(v, float).any()]
    good = [(i, v if abs(v).max() < 1e9 else v / 2.0**997) for i, v in good]
    out = {}
    for at, (i, v) in enumerate(good):
        if i is not None and i % 50 == 0:
            scores = [(-kmeans_tree.cosines(v[None], w[None])[0], NO_ID if j is None else j) for k, (j, w) in enumerate(good) if k != at and len(w) == len(v)]
            out[i] = [(r + 1, j, -s) for r, (s, j) in enumerate(sorted(scores)[:most])]
    return out


VECTORS = "vec_id long, embedding array<double>, label int, cls string, leaf int"


def test_nearest_vectors_with_odd_ones(spark):
    r = np.random.default_rng(4)
    rows = [(i, r.normal(size=6).tolist()) for i in range(400)]
    rows += [(i, rows[3][1]) for i in range(1000, 1030)] + [(2000, rows[3][1]), (50 * 77, rows[7][1])]
    rows += [(4000, None), (4050, []), (4100, [0.0] * 6), (4150, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (4200, [float("nan")] * 6), (4250, [1.0, 2.0]), (4251, [2.0, 1.0]), (None, rows[9][1])]
    rows += [(4300, [1e300 * x for x in rows[5][1]]), (4350, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame([(*x, 1, "c", 2) for x in rows], VECTORS).repartition(5)
    want = plain_nearest(rows)
    for settings in ({"recall": 1.0}, {"recall": 1.0, "part_rows": 7, "block_rows": 3}):
        got = {}
        for x in kmeans_tree.search(df, **settings).collect():
            got.setdefault(x.query_id, []).append((x.rank, NO_ID if x.vec_id is None else x.vec_id, x.score))
        got = {k: sorted(v) for k, v in got.items()}
        assert got == {k: v for k, v in want.items() if v} and 4350 not in got and [x[1] for x in got[4250]] == [4251]
    assert kmeans_tree.search(df.where("false")).count() == 0


def test_recall_of_the_tree_on_the_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    want = {k: {j for _, j, _ in v} for k, v in plain_nearest([(r.vec_id, r.embedding) for r in df.select("vec_id", "embedding").collect()]).items()}
    hits = sum(x.vec_id in want[x.query_id] for x in kmeans_tree.search(df).collect())
    assert hits >= 0.95 * sum(map(len, want.values()))


def test_clustered_vectors_need_few_leaves(spark):
    r = np.random.default_rng(8)
    centers = r.normal(size=(60, 24))
    x = centers[r.integers(60, size=6000)] + 0.05 * r.normal(size=(6000, 24))
    tree = kmeans_tree.fit_tree(kmeans_tree._unit_rows(x))
    order = list(tree.best_bins(kmeans_tree._unit_rows(x[:1])[0]))
    assert sorted(order) == np.flatnonzero(tree.count == 0).tolist() and order[0] == tree.leaf_of(kmeans_tree._unit_rows(x[:1]))[0]
    df = spark.createDataFrame([(i, v, 1, "c", 2) for i, v in enumerate(x.tolist())], VECTORS)
    got = kmeans_tree.search(df).collect()
    want = plain_nearest(list(enumerate(x.tolist())))
    hits = sum(g.vec_id in {j for _, j, _ in want[g.query_id]} for g in got)
    assert len(got) == 600 and hits >= 0.93 * 600


def test_equal_vectors_are_one_leaf():
    assert kmeans_tree.fit_tree(np.ones((500, 4)) / 2).leaves == 1


# Collocations


def plain_collocations(rows, support, first):
    counts, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        good = {p: a for p, a in f.items() if len(p) > 1 and a >= support}
        hidden = {p[i:j] for p in good for i in range(len(p)) for j in range(i + 2, len(p) + 1) if j - i < len(p) and good[p] >= good[p[i:j]]}
        scored = []
        for p, a in good.items():
            if p not in hidden:
                score, _, left, right = min((1000 * a * n[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), left, right))
        for i, (s, a, p, left, right) in enumerate(sorted(scored)[:first]):
            out.append((lang, i + 1, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


@pytest.mark.parametrize("settings", [{"shards": 1}, {"shards": 3}, {"shards": 8, "bits": 64}, {"shards": 40, "first_rows": 7}])
def test_collocations(spark, settings):
    r = random.Random(3)
    words = ["a", "b", "C", "dé", "漢字", "e'f", "g-h", "new", "york", " "]
    rows = []
    for i in range(150):
        text = "".join(r.choice(words) + r.choice([" ", " ", " ", "\t ", ". ", ",", "\n"]) for _ in range(r.choice([0, 1, 5, 60])))
        rows.append((r.choice(["en", "en", "fr", None, "é"]), text + " New York  city hall of" * r.randrange(3) + r.choice(["", " a a a a a"])))
    rows += [("en", None), ("zz", ""), rows[0], rows[0], ("en", "a b " * 3000)]
    df = spark.createDataFrame([(i, t, lang, 1, "p", 3) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string, n int, phrase string, rank int").repartition(6)
    got = collocations.collocations(df, support=12, **settings)
    want = plain_collocations(rows, 12, settings.get("first_rows", 2000))
    assert want and sorted(tuple(x) for x in got.collect()) == want
    assert collocations.collocations(df.where("false")).count() == 0


def test_scores_beyond_64_bits(spark):
    rows = [(2_000_000_007, 10_000_000_000_019, 3_000_000_019, 5_000_000_029), (99_999_999_999_999_999, 99_999_999_999_999_999, 10**17 - 3, 10**17 - 7), (100, 10**16, 100, 100)]
    got = collocations.with_score(spark.createDataFrame(rows, "a long, n long, l long, r long")).collect()
    assert [x.score for x in got] == [1000 * a * n // (x * y) for a, n, x, y in rows]
