"""Length of clean documents (operator 6), names of page elements and unclosed ones (operator 8), whole search of fillings (operator 10)."""

import time
import zlib
from collections import Counter

import numpy as np
import pytest

from pulsekit.llm import html_text, packing, toxicity


def test_noisy_or_gradient_is_numeric():
    rng = np.random.default_rng(1)
    doc = np.repeat(np.arange(8), [1, 3, 2, 4, 1, 2, 5, 2])
    sent, feat = rng.integers(0, len(doc), 60), rng.integers(0, 7, 60)
    y, share, w, bias = np.array([1.0, 0, 1, 0, 1, 0, 1, 0]), rng.uniform(0.5, 2, 8), rng.normal(size=7), -1.0
    _, grad, _ = toxicity.noisy_or(w, bias, doc, sent, feat, y, share)
    loss = lambda w, b: toxicity.noisy_or(w, b, doc, sent, feat, y, share)[0]
    eps = 1e-6
    for k in range(8):
        step = np.eye(8)[k] * eps
        numeric = (loss(w + step[:7], bias + step[7]) - loss(w - step[:7], bias - step[7])) / (2 * eps)
        assert abs(numeric - grad[k]) < 1e-6


@pytest.fixture(scope="module")
def labelled(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").toPandas()
    x = docs.merge(spark.read.parquet("/root/testdata/sf0.1/labels.parquet").toPandas(), on="doc_id")
    x["held"] = [zlib.crc32(str(i).encode()) % 5 == 0 for i in x.doc_id]
    return x


def test_clean_documents_stay_clean_at_any_length(labelled):
    train, held = labelled[~labelled.held], labelled[labelled.held]
    model = toxicity.train(train.text.tolist(), train.toxic.tolist())
    scorer = toxicity.Scorer(model)
    score = lambda t: scorer.document(t)[0]
    worst = held[held.toxic == 1].text.tolist()  # some of these labels are noise
    without = toxicity.Scorer({**model, "floor": -99.0})
    recall = np.mean([score(t) >= 0.5 for t in worst])
    assert recall >= 0.9 and recall >= np.mean([without.document(t)[0] >= 0.5 for t in worst]) - 0.011
    clean = [t for t in held[held.toxic == 0].text if max(map(scorer.sentence, toxicity.sentences(t)), default=-30) <= 0]  # as above
    for words in (0, 4000, 20_000):
        joined, now, n = [], [], 0
        for t in clean:
            now.append(t)
            n += len(t.split())
            if n >= words:
                joined.append("\n".join(now))
                now, n = [], 0
        assert np.mean([score(t) >= 0.5 for t in joined]) <= 0.02, words


ARTICLE = "<h1>Title here</h1>" + "<p>" + "plain words of the story go on " * 12 + "</p>" * 1 + "<p>" + "second part of the story " * 10 + "</p>"


@pytest.mark.parametrize("around", ['<div class="content with-sidebar">{}</div>', '<div class="no-banner wrapper">{}</div>', '<div class="post has-related">{}</div>',
                                    '<div class="page-search">{}</div>', '<div class="main-menu-layout">{}</div>', "<form>{}</form>", '<div class="search">{}</div>'])
def test_names_do_not_throw_pages_away(around):
    text = "\n\n".join(html_text.extract(f"<html><body>{around.format(ARTICLE)}</body></html>", {}))
    assert "story go on" in text and "second part" in text


def test_comments_marked_as_articles_are_left_out():
    page = f"<body><article>{ARTICLE}</article><article class='comment'><p>{'reader says so ' * 5}</p></article></body>"
    text = "\n\n".join(html_text.extract(page, {}))
    assert "second part" in text and "reader says" not in text


def test_many_unclosed_elements_are_read_in_linear_time():
    n = 100_000
    began = time.time()
    html_text.extract("<div>" * n + "word " * 50 + "</span>" * n + "</p>" * n, {})
    html_text.extract("<b>" * n + "<p>word" * n + "</i>" * n, {})
    assert time.time() - began < 30


def bins(plan):
    return sum(t for t, _ in plan)


def test_search_leaves_no_filling_out():
    rng = np.random.default_rng(3)
    three = Counter(rng.integers(1200, 1500, 3000).tolist())  # never more than three a sequence
    plan, bound, proven = packing.search(three)
    assert Counter({n: sum(t * ls.count(n) for t, ls in plan) for n in three}) == three
    assert bins(plan) == 1000 and not proven and bound <= 1000 < bins(packing.best_fit(three, 4096))


def test_proof_flag_holds_on_cases_that_best_fit_does_not_solve():
    def fewest(items, room):
        """By subsets: the fewest sequences, then the least filled last one."""
        best = {0: (1, 0)}
        for mask in range(1, 1 << len(items)):
            ways = []
            for i, n in enumerate(items):
                if mask >> i & 1:
                    k, used = best[mask ^ 1 << i]
                    ways.append((k, used + n) if used + n <= room else (k + 1, n))
            best[mask] = min(ways)
        return best[(1 << len(items)) - 1][0]

    rng, hard = np.random.default_rng(4), 0
    while hard < 40:
        items = rng.integers(15, 60, rng.integers(6, 11)).tolist()
        counts = Counter(items)
        if bins(packing.best_fit(counts, 100)) == packing.lower_bound(counts, 100):
            continue
        hard += 1
        plan, _, proven = packing.search(counts, 100)
        assert proven and bins(plan) == fewest(items, 100)
        plan, _, proven = packing.search(counts, 100, nodes=1, steps=1)
        assert not proven and Counter(n for t, ls in plan for n in ls * t) == counts


def test_pack_with_columns_of_its_own_names(spark):
    rows = [(i, 0, 1 + i % 7, "a", 5, "b", "c") for i in range(50)]
    given = spark.createDataFrame(rows, "doc_id long, piece int, length long, __place string, Offset int, sequence_id string, __PLACE_ string")
    out = packing.pack(given, 10, order=("doc_id", "piece"))
    assert out.columns == ["doc_id", "piece", "length", "__place", "__PLACE_", "sequence_id", "offset"]
    got = out.toPandas()
    assert len(got) == 50 and (got.groupby("sequence_id").length.sum() <= 10).all() and set(got["__place"]) == {"a"}
