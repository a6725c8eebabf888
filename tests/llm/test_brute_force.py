"""Operators against plain versions of themselves, and their defined results for odd input."""

import collections
import hashlib
import random
import struct

import numpy as np
import pytest
import regex
import xxhash

from atlasmill.llm import chat, decontaminate, html_text, imatch, secrets, substring_dedup, toxicity
from test_llm import text


def spark_hash(*parts):
    """xxhash64 of Spark: seed 42, each part's hash the seed of the next."""
    seed = 42
    for p in parts:
        b = p.encode() if isinstance(p, str) else struct.pack("<q", p[0]) if isinstance(p, tuple) else struct.pack("<i", p)
        seed = xxhash.xxh64_intdigest(b, seed=seed)
    return seed


def sign(h):
    return h - (1 << 64) if h >> 63 else h


def test_fingerprints_against_plain_python(spark):
    rng = random.Random(21)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 30))) for _ in range(40)] + [None, "", "Ünïque, once!", "w1-w1_W2"]
    texts += [texts[3], texts[3]]
    df = spark.createDataFrame([(i, t, "x", 1.5) for i, t in enumerate(texts)], "doc_id long, text string, fingerprint string, part double")
    terms = lambda t: {w for w in regex.split(r"[^\p{L}\p{N}]+", t.lower()) if w}
    df_of = collections.Counter(w for t in texts for w in terms(t or ""))
    least, most = 0.05, 0.4
    lexicon = {w for w, n in df_of.items() if max(2.0, least * len(texts)) <= n <= max(max(2.0, least * len(texts)), most * len(texts))}
    assert 10 < len(lexicon) < 70

    def entries(t):
        held = collections.defaultdict(int)
        for w in terms(t) & lexicon:
            term = sign(spark_hash(w))
            held[sign(spark_hash((term,), 17)) % 16] ^= spark_hash((term,), 29)
        return sorted(f"{s:02x}{h & 0xFFFFFFFF:08x}" for s, h in held.items()) or [f"whole{spark_hash(t):x}"]

    texts = [t or "" for t in texts]
    got = {r.doc_id: r for r in imatch.fingerprints(spark, df, least=least, most=most, subsets=16).collect()}
    alike = lambda a, b: len(set(a) & set(b)) / len(set(a) | set(b))
    for i, t in enumerate(texts):
        after = texts[(i + 1) % len(texts)]
        k = len(t) // 4
        edited = t[: len(t) - k] + after[:k]
        a, b, c = entries(t), entries(edited), entries(after)
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        if not a[0].startswith("whole"):
            assert r.fingerprint == ".".join(a)
        if not b[0].startswith("whole"):
            assert r.edited_fingerprint == ".".join(b)
        assert (r.near_edited, r.near_next) == pytest.approx((alike(a, b), alike(a, c)))


def quadratic(d, c):
    """Best chain's score."""
    f = []
    for j in range(len(d)):
        before = [f[i] - substring_dedup.COST * (d[j] - d[i] + c[j] - c[i]) for i in range(j) if d[i] < d[j] and c[i] < c[j]]
        f.append(substring_dedup.K + max([0.0, *before]))
    return max(f)


def test_best_chain_against_quadratic():
    rng = np.random.default_rng(5)
    for _ in range(60):
        pairs = sorted({(int(a), int(b)) for a, b in rng.integers(0, 30, (25, 2))})
        d, c = (np.array(x) for x in zip(*pairs, strict=True))
        score = lambda ch: substring_dedup.K * len(ch) - substring_dedup.COST * ((d[ch[-1]] - d[ch[0]]) + (c[ch[-1]] - c[ch[0]]))
        assert max(score(ch) for ch in substring_dedup.chains(d, c)) == pytest.approx(quadratic(d.tolist(), c.tolist()))


def naive_main_text(pages):
    """Blocks of unmarked pages of one host without runs of LONG tokens that another page has."""
    tokens = {i: " ".join(html_text.blocks(h)[0]).split(" ") for i, h in pages.items()}
    n = html_text.LONG
    seen = collections.defaultdict(set)
    for i, t in tokens.items():
        for p in range(len(t) - n + 1):
            seen[tuple(t[p : p + n])].add(i)
    out = {}
    for i, t in tokens.items():
        gone = {q for p in range(len(t) - n + 1) if len(seen[tuple(t[p : p + n])]) > 1 for q in range(p, p + n)}
        out[i] = " ".join(x for q, x in enumerate(t) if q not in gone) if len(gone) < len(t) else " ".join(t)
    return out


def test_unmarked_pages_against_all_runs(spark):
    rng = random.Random(9)
    parts = [text(rng.randint(3, 14), 7000 + i) for i in range(8)]
    pages = {i: "<body>" + "".join(f"<div>{x}</div>" for x in [*rng.sample(parts, rng.randint(0, 3)), text(rng.randint(5, 25), 7100 + i), *rng.sample(parts, rng.randint(0, 2))]) + "</body>" for i in range(30)}
    df = spark.createDataFrame([(i, f"http://h.org/{i}", h, "x", 2) for i, h in pages.items()], "page_id long, url string, html string, text string, n_chars int")
    got = {r.page_id: r.text for r in html_text.extract(spark, df.drop("text", "n_chars"), shard=7).collect()}
    assert got == naive_main_text(pages)


def test_clashing_columns_and_odd_rows(spark):
    docs = spark.createDataFrame([(1, text(30, 1), "a", 1, 2), (None, None, "a", 1, 2), (1, text(30, 1), "a", 1, 2), (2, "", "a", 1, 2)], "doc_id long, text string, id string, item int, similarity int")
    items = spark.createDataFrame([(1, text(30, 1), 3), (1, text(30, 1), 3), (None, None, 3)], "item_id long, text string, doc_id int")
    assert {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(spark, docs, items).collect()} == {(1, 1)}
    turns = spark.createDataFrame([(1, 0, "ann", "hi", "x"), (1, 0, "ann", "hi", "x"), (1, 1, "bob", "yo " * 50_000, "x"), (None, None, None, None, "x")], "conv_id long, turn int, role string, text string, segment string")
    got = chat.rotate(turns).collect()
    assert {r.perspective for r in got if r.conv_id == 1} == {"ann", "bob"}
    pages = spark.createDataFrame([(1, "http://a.b/", "<p>" + "word " * 100_000, 1, "t"), (None, None, None, 1, "t")], "page_id long, url string, html string, parts int, text string")
    assert sorted(r.n for r in html_text.extract(spark, pages).selectExpr("length(text) AS n").collect()) == [0, 499_999]


def test_more_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    machine = toxicity.train(spark, none, labels)
    assert toxicity.score(spark, none, machine).count() == 0 and secrets.redact(spark, none).count() == 0
    assert chat.rotate(spark.createDataFrame([], "conv_id long, turn int, role string, text string")).count() == 0
    assert html_text.extract(spark, spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_long_texts(spark):
    long = text(120_000, 3)
    df = spark.createDataFrame([(1, long), (2, "x " + long + " password=hunter22"), (3, "a" * 300_000)], "doc_id long, text string")
    machine = toxicity.Machine(np.full(1 << toxicity.HASH_BITS, -1, np.int32), 0.0, np.zeros(1), np.zeros((1, toxicity.LATENT)))
    assert [r.score for r in toxicity.score(spark, df, machine).collect()] == [0.5] * 3
    assert sorted(len(r.secret_spans) for r in secrets.find_secrets(spark, df).collect()) == [0, 1, 1]  # a long run of hex letters is a match
    got = substring_dedup.repeats(spark, df).collect()
    assert [(r.doc_id, r.start, r.end, r.other_doc_id) for r in got] == [(2, 1, 120_001, 1)]


def test_repeats_of_an_id_with_two_texts(spark):
    passage = text(80, 8000)
    rows = [(1, f"a {text(20, 8001)} {passage}"), (2, f"a {passage} {text(20, 8002)}"), (2, "b " + text(90, 8003)), (2, "b " + text(90, 8003)), (3, "b " + text(90, 8003))]
    for order in (rows, rows[::-1]):
        got = substring_dedup.repeats(spark, spark.createDataFrame(order, "doc_id long, text string")).collect()
        assert [(r.doc_id, r.other_doc_id) for r in got] == [(2, 1)] and got[0].end - got[0].start >= 80
