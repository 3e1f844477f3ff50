"""Operators 11 to 13 against brute force, numeric gradients and held-out accuracy."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from pulsekit.llm import align, langid, queries, runs

SF = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").toPandas().sort_values("doc_id")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- 11 runs

def brute_runs(w):
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1) if j > i else i + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def periodic(rng):
    w = []
    while rng.random() < 0.85:
        if rng.random() < 0.4:
            w += [rng.choice(b"abc") for _ in range(rng.randint(1, 6))]
        else:
            u = [rng.choice(b"ab") for _ in range(rng.randint(1, 5))]
            w += (u * rng.randint(1, 9))[: rng.randint(1, 45)]
    return [bytes([x]) for x in w]


def test_runs_equal_brute_force_on_periodic_texts():
    rng = random.Random(5)
    for _ in range(400):
        texts = [periodic(rng) for _ in range(rng.randint(1, 6))]
        for w, got in zip(texts, runs.runs_of_texts(texts)):
            assert got == brute_runs(w)


def test_long_uniform_and_separated_texts():
    n = 60_000
    broken = [w for k in range(3000) for w in [b"x%d" % k, *[b"a"] * 6]]
    got = runs.runs_of_texts([[b"a"] * n, [], broken, [b"a", b"b"] * 30_000 + [b"a"]])
    assert got[0] == [(0, n, 1)] and got[1] == [] and got[3] == [(0, 60_001, 2)]
    assert got[2] == [(7 * k + 1, 6, 1) for k in range(3000)]


def expected_runs(doc_id, text):
    w = (text or "").encode().split()
    if doc_id is not None and w and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    found = brute_runs(w)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else None
    return (len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))


def test_op11_equals_brute_force(spark, documents):
    got = {r[0]: tuple(r[1:]) for r in queries.op11_runs(spark, SF).collect()}
    short = documents[documents.text.str.len().fillna(0) < 8000]
    assert len(got) == len(documents) and len(short) > 100
    assert any(got[i][0] for i in short.doc_id)
    for i, text in zip(short.doc_id, short.text):
        assert got[i] == expected_runs(i, text)


def test_runs_of_odd_rows(spark):
    rows = [(1, None, 0), (2, "", 0), (3, " \t ", 0), (4, "x " * 7, 0), (4, "x " * 7, 0), (None, "a b " * 6 + "a b", 0), (5, "a b", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int")
    got = sorted(runs.find_runs(docs).collect(), key=str)
    assert len(got) == 7
    by = {r["doc_id"]: ([tuple(x) for x in r["runs"]], r["collapsed"]) for r in got}
    assert by == {1: ([], ""), 2: ([], ""), 3: ([], ""), 4: ([(0, 7, 1)], "x"), None: ([(0, 7, 1)], "a b"), 5: ([], "a b")}
    assert runs.digest(runs.find_runs(docs.limit(0))).count() == 0


# ---- 12 language

def test_gradients_equal_numeric_ones():
    rng = np.random.default_rng(0)
    table, out = rng.normal(size=(30, 4)), rng.normal(size=(4, 3))
    text = np.repeat(np.arange(6), [3, 1, 5, 2, 4, 3])
    feature, label, share = rng.integers(0, 30, len(text)), rng.integers(0, 3, 6), rng.uniform(0.5, 2, 6)
    _, rows, g_table, g_out = langid.gradients(table, out, feature, text, label, share)
    dense, eps = np.zeros_like(table), 1e-6
    dense[rows] = g_table
    loss = lambda: langid.gradients(table, out, feature, text, label, share)[0]
    for x, g in ((table, dense), (out, g_out)):
        for at in np.ndindex(x.shape):
            keep = x[at]
            x[at] = keep + eps
            up = loss()
            x[at] = keep - eps
            down = loss()
            x[at] = keep
            assert abs((up - down) / (2 * eps) - g[at]) < 1e-5


def test_scores_are_those_of_the_mean_of_features():
    texts = ["der hund und die katze", "the dog and the cat", "le chien et le chat"] * 10
    model = langid.train(texts, ["de", "en", "fr"] * 10)
    langs, scores = langid.Scorer(model).predict(["THE dog", None, "12 ²!", "", "und die 7 hund"])
    flat, size = langid.features(["the", "dog"])
    z = model["scores"][flat].sum(axis=0, dtype=np.float64) / size.sum()
    assert langs == ["en", "und", "und", "und", "de"] and scores[1:4].tolist() == [0, 0, 0]
    assert abs(scores[0] - langid.softmax(z[None])[0].max()) < 1e-6


def test_op12_held_out_accuracy(spark, documents):
    got = {r["doc_id"]: r for r in queries.op12_langid(spark, "/root/testdata/sf0.01").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").toPandas()
    assert set(got) == set(docs.doc_id)
    held = [(got[i]["lang_pred"], x) for i, x in zip(docs.doc_id, docs.lang) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= got[i]["score"] <= 1 for i in docs.doc_id)
    assert len(held) > 200 and sum(a == b for a, b in held) / len(held) >= 0.98


def test_language_of_odd_rows(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "42 ²", "en"), (4, "the cat", "en"), (5, "der hund", "de"), (None, "the cat", "en"), (6, "das tier", None),
            (5, "der hund", "de")]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, lang string, score double")
    got = langid.identify(docs, langid.fit(docs)).collect()
    assert len(got) == len(rows) and [r["lang"] for r in got][:6] == ["und", "und", "und", "en", "de", "en"]
    nothing = langid.identify(docs, langid.fit(docs.limit(0))).collect()
    assert {(r["lang"], r["score"], r["accepted"]) for r in nothing} == {("und", 0.0, False)}
    assert langid.identify(docs.limit(0), langid.fit(docs)).count() == 0


def test_rejection_bound_separates_foreign_words():
    rng = random.Random(2)
    syllables = {"aa": ["ka", "to", "mi"], "bb": ["shr", "wen", "glo"], "cc": ["xu", "qi", "zho"]}
    make = lambda s, n: " ".join("".join(rng.choice(s) for _ in range(3)) for _ in range(n))
    texts = [(make(s, 60), k) for k, s in syllables.items() for _ in range(40)]
    model = langid.train([t for t, _ in texts], [k for _, k in texts])
    known = [(make(s, 30), k) for k, s in syllables.items() for _ in range(20)]
    langs, score = langid.Scorer(model).predict([t for t, _ in known])
    assert langs == [k for _, k in known] and (score >= model["bound"]).mean() > 0.9


# ---- 13 alignment

def brute_alignment(texts):
    tok = Tokenizer.from_file(A)
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in keep]
    byte = {chr(b): b for b in keep} | {chr(256 + i): b for i, b in enumerate(rest)}
    docs, count = [], Counter()
    for t in texts:
        raw = (" " + t).encode() if t else b""
        a = tok.encode(" " + t, add_special_tokens=False) if t else None
        a_ids, a_bytes = (a.ids, [bytes(byte[c] for c in x) for x in a.tokens]) if t else ([], [])
        b_ids = sp.encode(t or "")
        b_bytes = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, sp.id_to_piece(i)) for i in b_ids)]
        if b"".join(a_bytes) != raw or b"".join(b_bytes) != raw:
            a_ids, b_ids, a_bytes, b_bytes = [], [], [], []
        ends = [np.cumsum([len(x) for x in y]).tolist() if y else [] for y in (a_bytes, b_bytes)]
        shared = sorted(set(ends[0]) & set(ends[1]))
        groups, i, j, links = [], 0, 0, []
        for e in shared:
            i2, j2 = ends[0].index(e) + 1, ends[1].index(e) + 1
            groups.append(",".join(map(str, a_ids[i:i2])) + "|" + ",".join(map(str, b_ids[j:j2])))
            for x in range(i, i2):
                for y in range(j, j2):
                    if max(ends[0][x] - len(a_bytes[x]), ends[1][y] - len(b_bytes[y])) < min(ends[0][x], ends[1][y]):
                        links.append((a_ids[x], b_ids[y]))
            i, j = i2, j2
        count.update(links)
        docs.append((len(a_ids), len(b_ids), links, ";".join(groups)))
    high = Counter()
    for (_, b), n in count.items():
        high[b] = max(high[b], n)
    return [(a, b, len(g.split(";")) if g else 0, len(x), sum(count[p] for p in x), sum(count[p] == high[p[1]] for p in x), sha(g) if g else "", g)
            for a, b, x, g in docs], count


ODD = [None, "", " ", "  two  spaces ", "a <|endoftext|> b <s> </s>", "tab\tand\nline\r\n  x", "Ünïcödé 日本語 🎉 ▁ x", "日本語🎉é", "▁", "x" * 5000,
       "a b　c", "don't stop 12345 ... !!!", "\x00\x01 ﻿"]


def test_alignment_of_odd_rows_in_many_chunks(spark):
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice(" \n\tabzéß日🎉.1'") for _ in range(rng.randint(1, 60))) for _ in range(300)] + ["the cat"] * 40
    docs = spark.createDataFrame([(None if i == 3 else i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, chunk int").repartition(3)
    out, pairs = align.align(docs, A, B, keep_groups=True, chunk_chars=200)
    want, count = brute_alignment(texts)
    got = {3 if r["doc_id"] is None else r["doc_id"]: tuple(r[1:]) for r in out.collect()}
    assert got == dict(enumerate(want))
    assert {(r["a"], r["b"]): r["total"] for r in pairs.collect()} == count


def test_op13_equals_brute_force(spark, documents):
    want, _ = brute_alignment(documents.text.tolist())
    got = {r["doc_id"]: r for r in queries.op13_align(spark, SF).collect()}
    for i, w in zip(documents.doc_id, want):
        r = got[i]
        assert (r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["count_sum"], r["n_best"], r["groups_sha256"]) == w[:7]
    assert len(got) == len(want)


def test_alignment_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    out, pairs = align.align(docs, A, B)
    assert out.count() == 0 and pairs.count() == 0
