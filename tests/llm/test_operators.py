"""Each operator against a plain version, with nulls, empty and long texts, ties, repeated rows, no rows, and clashing columns."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gridloom.llm import byte_bpe, hnsw, katz, ngram_join, packing, substring_dedup, syncmers, toxicity, url_filter, vector_links, warc
from gridloom.llm.common import NO_ID, crc_fold, gram_hashes, word_hashes
from gridloom.llm import components as component_steps
from gridloom.llm.components import components
from gridloom.sources.scratch import scratch_path, written
from tests.llm import brute

TEXTS = "doc_id long, text string, _id string, _text string, ids int, shard int"


def texts(spark, rows, parts=3):
    """Documents with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "x", "y", 1, 2) for i, t in rows], TEXTS).repartition(parts)


def sample_texts(seed, n=40):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(200)] + ["É", "ß!", "漢字", "I'll", "(a)", "12", "don't."]
    made = [" ".join(r.choice(words) for _ in range(r.choice([0, 1, 3, 30, 120]))) for _ in range(n)]
    return made + ["", None, "  \t\n ", made[3], made[3], "a" * 3000, "one\u00a0two\x1cthree\r\n four"]


def as_rows(list_of_texts):
    return list(enumerate(list_of_texts)) + [(None, "a null id"), (3, list_of_texts[3])]


def same_id(i):
    return NO_ID if i is None else i


# Words and components


def test_word_hashes_follow_words():
    text = b" aa b\taa\x0bcc\n" + b"z" * 10
    h = word_hashes(text)
    assert len(h) == 5 and h[0] == h[2] and len(set(h.tolist())) == 4
    g = gram_hashes(np.concatenate([h, h]), 5)
    assert len(g) == 6 and g[0] == g[5] and len(gram_hashes(h, 6)) == 0
    long = word_hashes(b"x yy zzz " * 200_000)
    assert len(long) == 600_000 and len(np.unique(long)) == 3
    assert len(word_hashes(b"q" * 2_500_000 + b" r")) == 2


def test_components(spark):
    r = random.Random(3)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(150)] + [(0, i) for i in range(400, 430)] + [(i, i + 1) for i in range(500, 540)] + [(7, 7), (None, 3)]
    up = {}

    def root(i):
        while up.setdefault(i, i) != i:
            i = up[i]
        return i

    for a, b in edges:
        if a is not None and a != b:
            a, b = sorted((root(a), root(b)))
            up[b] = a
    got = {x.node: x.component for x in components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {i: root(i) for i in list(up)}
    assert components(spark.createDataFrame([], "src long, dst long")).count() == 0


@pytest.mark.parametrize("few", [0, component_steps.FEW_EDGES])
def test_components_rounds(spark, monkeypatch, few):
    """Stars need no round, and few edges none either; rounds and one task give the same."""
    tables = []
    monkeypatch.setattr(component_steps, "FEW_EDGES", few)
    monkeypatch.setattr(component_steps, "written", lambda df, label: tables.append(label) or written(df, label))
    stars = spark.createDataFrame([(c, c + 100 * k) for c in range(5) for k in range(1, 30)], "src long, dst long").repartition(4)
    assert {x.node: x.component for x in components(stars).collect()} == {c + 100 * k: c for c in range(5) for k in range(30)}
    assert len(tables) == 1 + (few > 0)
    tables.clear()
    chain = spark.createDataFrame([((7 * i) % 101, (7 * i + 7) % 101) for i in range(100)] + [(200, 201), (201, 201)], "src long, dst long").repartition(9)
    assert {x.node: x.component for x in components(chain).collect()} == {i: 0 for i in range(101)} | {200: 200, 201: 200}
    assert few == 0 or len(tables) == 2


@pytest.mark.parametrize("few", [0, component_steps.FEW_EDGES])
def test_joined_regions(spark, monkeypatch, few):
    monkeypatch.setattr(component_steps, "FEW_EDGES", few)
    rows = [(1, b"c"), (1, b"b"), (2, b"b"), (2, b"d"), (2, b"d"), (3, b"a"), (4, b"a"), (5, b"x"), (5, b"y"), (6, b"d"), (6, b"e")]
    cells = ngram_join.joined_regions(spark.createDataFrame(rows, "region long, cls binary").repartition(4)).collect()
    assert sorted((bytes(x.cell), bytes(x.cls)) for x in cells) == [(b"b", b"b"), (b"b", b"c"), (b"b", b"d"), (b"b", b"e"), (b"x", b"x"), (b"x", b"y")]


# 1 URL filter


URLS = [
    "http://Foo.Example.NET/en/1?x=1", "https://example.net/en/", "http://a.net", "http://b.net/", "https://spam-farm.example.org/fr/2", "ftp://www.SPAM-farm.example.org/3.html?utm_source=a&b=2#c",
    "http://spam-farm.example.org/3/?b=2&ref=q", "http://x.example.com/de/1", "http://x.example.com/des", "http://xexample.com/de/1", "no scheme", "", None, "a://b://c/d", "http://?q", "http://h#/en/",
]


@pytest.mark.parametrize("bytes_allowed", [url_filter.BROADCAST_BYTES, 0])
def test_url_filter(spark, bytes_allowed):
    rows = [(i, u, "clash", 1) for i, u in enumerate(URLS)] + [(4, URLS[4], "clash", 1), (None, URLS[0], "clash", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, canonical string, block int")
    got = url_filter.judge(pages, url_filter.denied_urls(pages), broadcast_bytes=bytes_allowed).collect()
    assert len(got) == len(rows)
    by_id = {x.page_id: x for x in got}
    assert [(by_id[i].host, by_id[i].path, by_id[i].rule, by_id[i].verdict) for i in range(len(URLS))] == [
        ("foo.example.net", "/en/1", "example.net/en/", "allow"), ("example.net", "/en/", "example.net/en/", "allow"), ("a.net", "", None, "allow"), ("b.net", "/", "net/", "block"),
        ("spam-farm.example.org", "/fr/2", "org/fr/", "allow"), ("www.spam-farm.example.org", "/3.html", None, "block"), ("spam-farm.example.org", "/3/", None, "block"),
        ("x.example.com", "/de/1", "example.com/de/", "block"), ("x.example.com", "/des", None, "allow"), ("xexample.com", "/de/1", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"),
        ("", "", None, "allow"), ("b:", "//c/d", None, "allow"), ("", "", None, "allow"), ("h", "", None, "allow"),
    ]
    assert url_filter.judge(pages.limit(0), url_filter.denied_urls(pages)).count() == 0
    assert {x.verdict for x in url_filter.judge(pages, url_filter.denied_urls(pages).limit(0), rules=()).collect()} == {"allow"}


def test_bloom_filter_has_no_false_negatives(spark):
    listed = spark.range(3000).select(F.concat(F.lit("u"), "id").alias("canonical"))
    blocks = 94
    words = url_filter.bloom_blocks(listed, blocks)
    probes = spark.range(6000).select(F.concat(F.lit("u"), "id").alias("canonical"), F.col("id")).withColumn("block", url_filter._block(F.col("canonical"), blocks))
    hit = F.lit(True)
    for i in range(url_filter.WORDS):
        hit = hit & (F.col(f"w{i}").bitwiseAND(url_filter._bit(F.col("canonical"), i)) != 0)
    found = probes.join(words, "block").where(hit).agg(F.sum((F.col("id") < 3000).cast("int")), F.sum((F.col("id") >= 3000).cast("int"))).first()
    assert found[0] == 3000 and (found[1] or 0) < 60


# 2 Packing


def test_packing(spark):
    odd = ["a<|endoftext|>b", "<|startoftext|> Aé<|endoftext|><|endoftext|>", "<|ENDOFTEXT|> <|end oftext|>", " <| <|endoftext|>.\u0301x"]
    rows = as_rows(sample_texts(1)) + [(99, "long text here " * 5000), *enumerate(odd, 200)]
    tokenizer = Tokenizer.from_file(packing.TOKENIZER)
    pieces = packing.pack(texts(spark, rows), length=256, block_tokens=4096, with_ids=True).collect()
    ids = {}
    for p in sorted(pieces, key=lambda p: (same_id(p.doc_id), p.start)):
        assert p.length == len(p.ids) and p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes())
        ids.setdefault((p.doc_id, p.doc_tokens), []).append(p)
    for i, t in rows:
        whole = [*tokenizer.encode(t or "", add_special_tokens=False).ids, packing.END_ID]
        own = ids[i, len(whole)]
        copies = sum(1 for j, u in rows if j == i and u == t)
        assert sum(p.length for p in own) == copies * len(whole)
        for p in own:
            assert p.ids == whole[p.start : p.start + p.length]
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for s in sequences.values():
        end = 0
        for offset, length in sorted(s):
            assert offset == end
            end += length
        assert end <= 256
    assert packing.pack(texts(spark, []).limit(0)).count() == 0


def test_assignment_balances_cost_and_leaves_one_gap():
    r = random.Random(4)
    for _ in range(100):
        tokens = [r.randint(1, r.choice([20, 300, 5000])) for _ in range(r.randint(1, 200))]
        cost, filled = {}, {}
        for _, _, n, s, _ in packing.assign(tokens, 512):
            cost[s] = cost.get(s, 0) + packing.piece_cost(n, 512)
            filled[s] = filled.get(s, 0) + n
        assert len(filled) == -(-sum(tokens) // 512) and sum(512 - x for x in filled.values()) < 512
    costs = {}
    for _, _, n, s, _ in packing.assign([100] * 40 + [10] * 108, 512):
        costs[s] = costs.get(s, 0) + packing.piece_cost(n, 512)
    assert max(costs.values()) < 1.1 * sorted(costs.values())[1]


# 3 WARC


def test_warc(spark):
    page = "<html><!-- x <p>no</p> --><style>p{}</style><SCRIPT>var a='<b>';</SCRIPT><h1>A &amp; B</h1><p>one <b>two</b><br/>three&nbsp; &#233;</p><p"
    rows = [("<urn:1>", "http://a/", "2024", "HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n", page, None, "k"), ("<urn:2>", None, None, None, None, None, "k"), (None, "u", "d", "h", "", "sha256:given", "k")]
    responses = spark.createDataFrame(rows + rows[:1], "record_id string, target_uri string, warc_date string, http_header string, payload string, payload_digest string, header string")
    got = warc.derivatives(responses).collect()
    assert len(got) == 8
    text = next(x for x in got if x.refers_to == "<urn:1>" and x.warc_type == "conversion")
    assert text.block == "A & B\none two\nthree é" and text.content_length == len(text.block.encode())
    meta = next(x for x in got if x.refers_to == "<urn:1>" and x.warc_type == "metadata")
    assert f"source-payload-digest: sha256:{hashlib.sha256(page.encode()).hexdigest()}\r\n" in meta.block and "source-header: Content-Type: text/html\r\n" in meta.block
    assert next(x for x in got if x.refers_to is None).source_payload_digest == "sha256:given"
    assert len({x.record_id for x in got}) == 6
    for record, x in zip(warc.serialized(spark.createDataFrame(got)).collect(), got):
        header, rest = bytes(record.record).split(b"\r\n\r\n", 1)
        fields = dict(line.split(": ", 1) for line in header.decode().split("\r\n")[1:])
        block = rest[: int(fields["Content-Length"])]
        assert rest[len(block) :] == b"\r\n\r\n" and fields["WARC-Block-Digest"] == warc.sha256(block) and fields.get("WARC-Refers-To") == x.refers_to
    assert warc.derivatives(responses.limit(0)).count() == 0
    path = scratch_path(spark, "warc")
    warc.write_warc(warc.derivatives(responses), path)
    found = []
    for file in spark.read.format("binaryFile").load(path).collect():
        rest = bytes(file.content)
        while rest:
            header, rest = rest.split(b"\r\n\r\n", 1)
            lines = header.decode().split("\r\n")
            size = int(dict(line.split(": ", 1) for line in lines[1:])["Content-Length"])
            assert lines[0] == "WARC/1.1" and rest[size : size + 4] == b"\r\n\r\n"
            found.append((header + b"\r\n", rest[:size]))
            rest = rest[size + 4 :]
    assert sorted(found) == sorted((x.header.encode(), x.block.encode()) for x in got)


# 4 Substring dedup


@pytest.mark.parametrize("window", [4, 7])
def test_substring_dedup(spark, window):
    r = random.Random(window)
    passages = [[f"p{i}_{j}" for j in range(r.randint(window, 3 * window))] for i in range(5)]
    made = []
    for _ in range(60):
        words = []
        for _ in range(r.randint(0, 4)):
            words += r.choice(passages) if r.random() < 0.5 else [f"w{r.randrange(1000)}" for _ in range(r.randint(0, 9))]
        made.append("\n".join(words))
    rows = as_rows(made + ["", None, "same same same same " * 9, "same " * 30])
    got = substring_dedup.remove_repeats(texts(spark, rows), window=window, keep=("shard",)).collect()
    want = brute.kept_words(rows, window)
    assert sorted((same_id(x.doc_id), x.n_words, x.n_removed, x.kept_text) for x in got) == sorted((same_id(i), *rest) for i, *rest in want)
    assert {x.shard for x in got} == {2}
    assert substring_dedup.remove_repeats(texts(spark, rows).limit(0)).count() == 0
    unchanged = {x.doc_id: x.kept_text for x in substring_dedup.remove_repeats(texts(spark, rows), window=window, as_is=True).where("n_removed = 0").collect()}
    assert all(unchanged[i] == (t or "") for i, t in rows if i in unchanged and i is not None and i != 3)


def test_count_min_never_underestimates():
    keys = np.random.default_rng(1).integers(0, 500, 4000).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    true = np.unique(keys, return_counts=True)
    count = dict(zip(true[0].tolist(), true[1].tolist()))
    estimate = substring_dedup.count_min_estimates(keys)
    assert all(e >= count[k] for e, k in zip(estimate.tolist(), keys.tolist()))


# 5 N-gram join


def test_word_ids_of_letters(monkeypatch):
    """Words of small Latin letters go straight to the model, with the same ids; words met lately are not encoded again."""
    r, tokenizer = random.Random(8), Tokenizer.from_file(packing.TOKENIZER)
    marks = [chr(i) for i in range(33, 0x180)] + ["\u0301", "e\u0301", "ﬁ", "Σας", "İ", "ſ"]
    words = marks + [c * 2 for c in marks] + ["".join(r.choices(packing._LETTERS, k=r.randrange(1, 40))) for _ in range(300)]
    words += ["".join(r.choices(packing._LETTERS + "AÉ'.1", k=6)) for _ in range(300)] + ["é" * 3000]
    words = [w for w in words if "\x85" not in w and "\xa0" not in w]
    lists = [" ".join(words[i : i + 50]) for i in range(0, len(words), 50)] + words
    assert [np.frombuffer(b, "<u4").tolist() for b in packing.encoded_texts(lists)] == [e.ids for e in tokenizer.encode_batch(lists, add_special_tokens=False)]
    packing._words.cache_clear()
    seen, encode = [], packing._encoded_parts
    monkeypatch.setattr(packing, "CACHED", 3)
    monkeypatch.setattr(packing, "_encoded_parts", lambda parts, path: seen.extend(parts) or encode(parts, path))
    for text in ("ab cd", "ef gh", "ij", "ab kl", "ab"):
        assert np.frombuffer(packing.word_ids(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert sorted(p for p in seen if p) == ["ab", "cd", "ef", "gh", "ij", "kl"]
    packing._words.cache_clear()



@pytest.mark.parametrize("sizes", [{}, {"leaf": 12, "pivots": 3, "block": 6}])
def test_ngram_join(spark, sizes):
    r = random.Random(8)
    words = [f"w{i}" for i in range(2000)]
    base = [r.choice(words) for _ in range(90)]
    made = []
    for _ in range(70):
        t = list(base)
        for _ in range(r.choice([0, 1, 2, 3, 4])):
            t[r.randrange(len(t))] = r.choice(words)
        made.append(" ".join(t))
    for _ in range(15):
        b = [r.choice(words) for _ in range(r.randint(1, 60))]
        for _ in range(r.randint(1, 4)):
            t = list(b)
            t[r.randrange(len(t))] = r.choice(words)
            made.append("\t".join(t).upper())
    rows = as_rows(made + ["", None, "  ", "a", "A", "a b c d e", "A b c d E"])
    got = ngram_join.similar_documents(texts(spark, rows), **sizes).collect()
    assert sorted((same_id(x.doc_id), x.n_shingles, same_id(x.component_id)) for x in got) == sorted(brute.similar(rows))
    if not sizes:
        assert ngram_join.similar_documents(texts(spark, rows).limit(0)).count() == 0


# 6 Toxicity


def test_toxicity(spark):
    r = random.Random(6)
    clean = ["alpha", "beta", "gamma", "delta", "omega", "sigma"]
    rows, labels, bad = [], [], []
    for i in range(400):
        sentences = [" ".join(r.choice(clean) for _ in range(6)) for _ in range(r.randint(1, 12))]
        toxic = r.random() < 0.3
        if toxic:
            sentences.insert(r.randrange(len(sentences) + 1), "you are a " + r.choice(["ROTTEN", "zubadix", "zubador"]) + " one")
        rows.append((i, ". ".join(sentences)))
        labels.append((i, int(toxic)))
        bad.append(toxic)
    rows += [(1000, ""), (1001, None), (None, "alpha"), (3, rows[3][1])]
    held = crc_fold(F.col("doc_id")) == 0
    given = spark.createDataFrame([*labels, (None, 1), (5, None), (7, labels[7][1])], "doc_id long, toxic int")
    model = toxicity.fit(texts(spark, rows), given, train=~held)
    got = toxicity.score(texts(spark, rows), model, keep=("shard",)).collect()
    assert len(got) == len(rows) and {x.shard for x in got} == {2}
    for x in got:
        if x.doc_id is not None and x.doc_id < 400:
            assert x.predicted == int(bad[x.doc_id]) and 0 <= x.score <= 1
            text = rows[x.doc_id][1]
            assert [("you are a" in text[s.start : s.end]) for s in x.offending] == [True] * int(bad[x.doc_id])
        else:
            assert x.predicted == 0 and x.score == pytest.approx(model.leak)
    nothing = toxicity.fit(texts(spark, rows), given.limit(0))
    assert nothing.features == () and toxicity.score(texts(spark, rows).limit(0), nothing).count() == 0
    again = toxicity.fit(texts(spark, rows), given, train=~held)
    assert again == model


def test_scores_are_the_noisy_or_of_sentences(spark):
    model = toxicity.Model(("^vile$", "^vil", "ugly$", "^été$"), (1.5, 0.25, 0.75, 0.5), -1.0, 0.02)
    parts = ["a vile thing", "Vile, vile", "ugly", "fine", "ÉTÉ 7 vile", "x-ugly-y", ""]
    r = random.Random(3)
    rows = [(i, "".join(r.choice(parts) + r.choice([". ", "!", "\n", "?"]) for _ in range(r.randrange(12)))) for i in range(60)] + [(90, None), (91, "")]

    def plain(text):
        clean = 1 - model.leak
        for sentence in re.split(r"[.!?\n]+", text or ""):
            marked = "^" + "$^".join(w for w in re.split(r"[\W\d_]+", sentence.lower())) + "$"
            found = [w for f, w in zip(model.features, model.weights) if f in marked]
            clean *= 1 - 1 / (1 + math.exp(-(model.bias + sum(found)))) if found else 1
        return 1 - clean

    got = {x.doc_id: x.score for x in toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert got == pytest.approx({i: plain(t) for i, t in rows}, abs=1e-12) and len(set(got.values())) > 5


def test_noisy_or_gradient_raises_the_likelihood():
    bags, labels = [[[0], [1]], [[1]], [[1], [1]], [[0]]], np.array([1.0, 0.0, 0.0, 1.0])
    weights, bias = toxicity.train_noisy_or(bags, labels, 2, 0.01)
    assert weights[0] + bias > 1 and weights[1] + bias < -1


def test_counts_in_bags_equal_repeats():
    bags, times, labels = [[[0], [1]], [[1]], [[1], [0, 1]], [[0]]], [[3, 200], [120], [70, 1], [2]], np.array([1.0, 0.0, 0.0, 1.0])
    repeated = [[s for s, n in zip(b, t) for _ in range(n)] for b, t in zip(bags, times)]
    one, two = toxicity.train_noisy_or(bags, labels, 2, 0.01, times=times), toxicity.train_noisy_or(repeated, labels, 2, 0.01)
    assert one[0] == pytest.approx(two[0], rel=1e-6) and one[1] == pytest.approx(two[1], rel=1e-6)


def test_fit_sees_every_sentence_of_a_long_text(spark, monkeypatch):
    rows = [(i, "you rotten one. alpha beta") for i in range(6)] + [(10 + i, "alpha beta. gamma") for i in range(40)]
    rows.append((99, "you rotten one. " * 300 + "alpha. beta"))
    seen, train = [], toxicity.train_noisy_or

    def watched(bags, *given, times=None):
        seen.extend(sum(t) for t in times or [[1] * len(b) for b in bags])
        return train(bags, *given, times=times)

    monkeypatch.setattr(toxicity, "train_noisy_or", watched)
    toxicity.fit(texts(spark, rows), spark.createDataFrame([(i, int(i < 10)) for i, _ in rows], "doc_id long, toxic int"))
    assert sorted(seen) == [1] * 6 + [300]


# 7 Vectors


def test_vector_links(spark):
    r = np.random.default_rng(7)
    base = r.normal(size=(40, 16))
    near = np.concatenate([base[i % 5] + 0.05 * r.normal(size=16) for i in range(60)]).reshape(60, 16)
    vectors = [v.tolist() for v in np.concatenate([base, near, base[:3], base[:2] * 4])]
    vectors += [None, [], [0.0] * 16, [float("nan")] * 16, [1.0, None] * 8, [float("inf")] * 16, [1.0, 2.0], [2.0, 4.0]]
    rows = [(i, v, "clash") for i, v in enumerate(vectors)] + [(None, vectors[0], "clash"), (4, vectors[4], "clash")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, cls string").repartition(4)
    ids = [same_id(i) for i, *_ in rows]
    valid = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v, _ in rows]
    linked = [[False] * len(rows) for _ in rows]
    for i, a in enumerate(rows):
        for j, b in enumerate(rows):
            if i != j and valid[i] and valid[j] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1]), np.array(b[1])
                linked[i][j] = x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.95
    least, changed = list(ids), True
    while changed:
        changed = False
        for i in range(len(rows)):
            m = min([least[i], *(least[j] for j in range(len(rows)) if linked[i][j])])
            changed, least[i] = changed or m != least[i], m
    want = sorted((ids[i], sum(linked[i]), least[i], ids[i] == least[i]) for i in range(len(rows)))
    got = vector_links.near_vectors(df, least_shards=3, block_rows=50).collect()
    assert sorted((same_id(x.vec_id), x.n_links, same_id(x.component_id), x.kept) for x in got) == want
    assert vector_links.near_vectors(df.limit(0)).count() == 0


def test_beams_widen_until_a_large_group_is_found():
    r = np.random.default_rng(9)
    x = np.concatenate([r.normal(size=(900, 32)), r.normal(size=32) + 0.02 * r.normal(size=(400, 32))]).astype(np.float32)
    x = (x / np.linalg.norm(x, axis=1, keepdims=True))[r.permutation(1300)]
    graph = hnsw.build(x)
    again = hnsw.Graph.from_bytes(x, graph.to_bytes())
    found = np.zeros((1300, 1300), bool)
    for rows, places in vector_links.ask(again, x, 0.95, beam=16):
        q, c = np.nonzero(places >= 0)
        found[rows[q], places[q, c]] = True
    assert (found & (x @ x.T >= 0.95)).sum() >= 0.99 * (x @ x.T >= 0.95).sum()


# 8 Syncmers


def test_syncmers(spark):
    rows = as_rows(sample_texts(8)) + [(50, "漢" * 9), (51, "😀 b c d")]
    got = syncmers.compare_with_edits(texts(spark, rows), range_rows=7).collect()
    order = sorted(((same_id(i), t or "") for i, t in rows), key=lambda x: (x[0], x[1].encode()))
    want = []
    for k, (i, t) in enumerate(order):
        follows = order[(k + 1) % len(order)][1]
        cut = len(t) // 4
        want.append((i, len(t), t[: len(t) - cut] + follows[:cut]))
    assert sorted((same_id(x.doc_id), x.n_chars, x.edited) for x in got) == sorted(want)
    prints = {}
    for i, t in rows:
        prints.setdefault(t or "", set()).update(tuple(x.prints) for x in got if same_id(x.doc_id) == same_id(i) and x.n_chars == len(t or ""))
    assert len(prints[rows[3][1]]) == 1
    assert all(0 <= x.near_edited <= 1 and 0 <= x.near_next <= 1 for x in got)
    long = [x for x in got if x.n_chars > 300]
    assert np.mean([x.near_edited for x in long if x.doc_id != 45]) > 0.4
    assert syncmers.compare_with_edits(texts(spark, rows).limit(0)).count() == 0


def test_anchors_are_free_of_context(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    df = spark.createDataFrame([(f"a b c {passage} x y", f"q {passage}")], "one string, two string")
    one, two = df.select(syncmers.anchors(F.col("one")), syncmers.anchors(F.col("two"))).first()
    inner = {a.hash: a.position for a in one if 3 <= a.position and a.position + syncmers.K <= 43}
    other = {a.hash: a.position for a in two}
    assert len(inner) > 8 and all(other[h] - p == -2 for h, p in inner.items())


def plain_anchors(text, k=syncmers.K, s=syncmers.S):
    """(place, hash) of each run of k words whose least run of s words is the first or the last."""
    def chained(values):
        h = 42
        for v in values:
            h = xxhash.xxh64_intdigest((v % 2**64).to_bytes(8, "little"), h)
        return h

    words = re.split(r"[\x20\x09-\x0D]+", text)
    words = [0] * (k - 1) + [xxhash.xxh64_intdigest(w.encode(), 42) for w in words] + [0] * (k - 1)
    signed = lambda v: v - 2**64 if v >= 2**63 else v
    grams = [chained(words[i : i + s]) for i in range(len(words) - s + 1)]
    found = []
    for i in range(len(words) - k + 1):
        inner = [signed(g) for g in grams[i : i + k - s + 1]]
        if min(inner) in (inner[0], inner[-1]):
            found.append((i - (k - 1), signed(chained([grams[i + j] for j in sorted({*range(0, k - s, s), k - s})]))))
    return found


def test_anchors_are_the_closed_syncmers(spark):
    rows = [t or "" for t in sample_texts(9)] + ["a a a a a a a a", "x", "one two", " lead and trail "]
    df = spark.createDataFrame(list(enumerate(rows)), "i int, t string").select("i", syncmers.anchors(F.col("t")).alias("a"))
    for x in df.collect():
        assert [(a.position, a.hash) for a in x.a] == plain_anchors(rows[x.i]), rows[x.i][:60]


def _shared_words(one, two, k=syncmers.K):
    """Plain version of the likeness of two lists of (position, hash)."""
    places = [{}, {}]
    for found, text in zip(places, (one, two)):
        for p, h in text:
            found.setdefault(h, []).append(p)
    pairs = [pair for h in places[0].keys() & places[1].keys() for pair in zip(places[0][h], places[1][h])]
    covered = 0
    for side in (sorted(pairs), sorted((q, p) for p, q in pairs)):
        for (p, q), (p_next, q_next) in zip(side, side[1:]):
            covered += min(k, p_next - p) if q_next > q else 0
        covered += k if side else 0
    return covered / sum(text[-1][0] - text[0][0] + k for text in (one, two))


def test_likeness_is_of_all_anchors_by_position(spark):
    r = random.Random(80)
    long = [f"w{r.randrange(5000)}" for _ in range(6000)]
    other, passage = [f"v{r.randrange(5000)}" for _ in range(6000)], [f"p{i}" for i in range(80)]
    with_passage = [long[:2000] + passage + long[2000:], other[:4500] + passage + other[4500:]]
    changed = [long[:i] + ["changed"] + long[i + 1 :] for i in (0, 17, 3000, 5999)]
    x, y, again = ([f"{c}{i}" for i in range(30)] for c in "xyr")
    cases = [(long, c) for c in changed] + [(long, long), (long, other), tuple(with_passage), (again + x + again + y + again, again + y + again + x + again)]
    cases += [(["a"] * 50, ["a"] * 60), ([], []), ([], ["a"]), (x + y, y + x)]
    df = spark.createDataFrame([(i, " ".join(a), " ".join(b)) for i, (a, b) in enumerate(cases)], "i int, a string, b string")
    df = df.select("i", syncmers.anchors(F.col("a")).alias("a"), syncmers.anchors(F.col("b")).alias("b"))
    got = df.select("*", syncmers.likeness(F.col("a"), F.col("b")).alias("ab"), syncmers.likeness(F.col("b"), F.col("a")).alias("ba")).orderBy("i").collect()
    for row, (a, b) in zip(got, cases):
        assert row.ab == pytest.approx(_shared_words(row.a, row.b)) and row.ab == pytest.approx(row.ba)
        assert (row.ab == 1) == (a == b) and [(p, h) for p, h in row.a] == sorted((p, h) for p, h in row.a)
        assert (row.a == row.b) == (a == b)
    assert all(0.99 < x.ab < 1 for x in got[:4]) and got[5].ab == 0 and 70 / 6080 < got[6].ab < 85 / 6080 and got[7].ab < 1 and 0.7 < got[11].ab < 1


# 9 Katz backoff


@pytest.mark.parametrize(("unit_tokens", "order"), [(katz.UNIT_TOKENS, katz.ORDER), (400, katz.ORDER), (400, 2), (300, 4)])
def test_katz(spark, unit_tokens, order):
    r = random.Random(9)
    words = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(r.choice(words[: r.choice([3, 10, 40])]) for _ in range(r.randint(0, 30)))) for i in range(150)]
    rows += [(900, None), (901, ""), (902, "Zzz NEW w1 q"), (903, "a b " * 50), (904, "once W1")]
    got = sorted(tuple(x) for x in katz.score_documents(texts(spark, rows), crc_fold(F.col("doc_id")) == 1, unit_tokens=unit_tokens, order=order).collect())
    for a, b in zip(got, sorted(brute.katz_scores(rows, order)), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], abs=1e-6) and a[6] == pytest.approx(b[6], abs=1e-5)


def test_katz_is_normalised_and_handles_few_rows(spark):
    model = brute.Katz([["a", "b", "a", "c"], ["a", "b"], ["d"] * 30] * 3)
    contexts = {gram[i:-1] for words in (["a", "b", "a", "c"], ["b", "d", "d"], ["new"]) for gram in model.grams(words) for i in range(3)}
    for context in contexts:
        assert sum(model.probability((*context, w)) for w in [*model.after[()], "unknown"]) == pytest.approx(1)
    rows = [(1, "a b"), (1, "a b"), (None, "a")]
    got = katz.score_documents(texts(spark, rows), F.lit(True)).collect()
    assert {x.train_tokens for x in got} == {0} and {x.n_known for x in got} == {0} and {x.score for x in got} == {0.0} and None in {x.doc_id for x in got}
    assert katz.score_documents(texts(spark, rows).limit(0), F.lit(False)).count() == 0
    assert ((d := katz.discounts([100, 40, 20, 12, 8, 6])) > 0).all() and (d < 1).all() and katz.discounts([0] * 6).tolist() == [0.5, 0.75, 2.5 / 3, 3.5 / 4, 4.5 / 5]


# 10 Byte-level BPE


@pytest.fixture(scope="module")
def reference_encoding():
    with open(byte_bpe.RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe(spark, reference_encoding):
    rows = as_rows(sample_texts(10)) + [(60, "a  b   c\n\n d'll\t\t!!..."), (61, "<|endoftext|>"), (62, "😀é漢" * 50), (63, " " * 300 + "-" * 300)]
    encoded = byte_bpe.encode(texts(spark, rows), offsets=True)
    got = encoded.collect()
    want = [(same_id(i), reference_encoding.encode_ordinary(t or "")) for i, t in rows]
    assert sorted((same_id(x.doc_id), x.ids) for x in got) == sorted(want)
    whole = {same_id(i): t or "" for i, t in rows}
    for x in got:
        text, tokens = whole[same_id(x.doc_id)], [reference_encoding.decode_single_token_bytes(t) for t in x.ids]
        if x.doc_id == 3:
            continue
        at = 0
        for token, start, end in zip(tokens, x.starts, x.ends):
            assert text[start:end].encode().find(token) >= 0 and len(text[:start].encode()) <= at < len(text[:end].encode())
            at += len(token)
    decoded = byte_bpe.decode(encoded).collect()
    assert sorted((same_id(x.doc_id), x.decoded_text) for x in decoded) == sorted((same_id(i), t or "") for i, t in rows)
    ids = reference_encoding.encode_ordinary("漢")
    assert len(ids) > 1
    parts = byte_bpe.decode(spark.createDataFrame([(1, ids[:1]), (2, ids[1:]), (3, None)], "doc_id long, ids array<int>")).collect()
    assert b"".join(bytes(x.decoded) for x in parts).decode() == "漢" and "\ufffd" in parts[0].decoded_text
    assert byte_bpe.encode(texts(spark, rows).limit(0)).count() == 0


def test_byte_bpe_equals_ranks_on_odd_texts(reference_encoding):
    r = random.Random(2)
    alphabet = ["a", "b", " ", "  ", "\n", "\t", "'s", "'ll", "é", "ß", "漢", "😀", "\u0301", "\x85", "\x1c", "\u3000", "-", "==", "1", "the", "tion", "\r\n", "\xa0", "A", "'", ".", ",!"]
    for _ in range(3000):
        text = "".join(r.choice(alphabet) for _ in range(r.randint(0, 25)))
        assert np.frombuffer(byte_bpe.encode_text(text), "<u4").tolist() == reference_encoding.encode_ordinary(text)
