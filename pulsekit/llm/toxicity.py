"""Toxic documents by multiple-instance learning (operator 6).

A document is a bag of sentences of which at least one must be toxic for the
document to be. Each sentence has a score, the logistic of the summed weights
of its words and word beginnings; noisy-or, 1 - prod(1 - score), combines them
to the document's score, and the weights are trained through it from document
labels alone. The trained weights then locate the sentences that offend.

The small scores of many harmless sentences would add up in a long document,
so a sentence counts only from a learned floor on: a quarter of the way from the logits
of harmless sentences (all but one in 10,000 of the clean documents that the
model calls clean) to those of the worst sentences of toxic documents (all but
one in 100 of those that it calls toxic).

Training uses a bounded sample of the labelled rows (``SAMPLE`` documents of either
class, in the order of a hash of the id, as many as ``SAMPLE_CHARS`` characters
hold); everything else covers all rows. Words are
runs of letters and digits in lower case; features are the word and its first
3, 4 and 5 characters, if at least ``MIN_DOCS`` sample documents have them and
their share of toxic documents is ``LIFT`` standard deviations off the sample's.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.llm.common import need, workers_ready

SAMPLE, SAMPLE_CHARS, MIN_DOCS, LIFT, FEATURES = 3000, 12_000_000, 4, 2.5, 30_000
EPOCHS, RATE, DECAY = 150, 0.1, 1e-4
MEMO = 200_000
_SENTENCE = re.compile(r"[^.!?\n]+[.!?\n]*")
_WORD = re.compile(r"[^\W_]+")


def sentences(text: str | None) -> list[str]:
    """Runs up to a full stop, exclamation or question mark, or line end; together they are the text."""
    return _SENTENCE.findall(text or "")


def features(word: str) -> list[str]:
    return [f"={word}", *(f"^{word[:k]}" for k in (3, 4, 5) if len(word) > k)]


def noisy_or(w: np.ndarray, bias: float, doc: np.ndarray, sent: np.ndarray, feat: np.ndarray, y: np.ndarray,
             share: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """(loss, its gradient by weights and bias, logits of the sentences).

    ``doc``: document of each sentence; ``sent``, ``feat``: sentence and number of each feature that occurs.
    The loss is the mean of ``share`` times the log loss of a document's noisy-or.
    """
    z = np.clip(np.bincount(sent, w[feat], len(doc)) + bias, -30, 30)
    clean = np.bincount(doc, -np.logaddexp(0, z), len(y))  # log of prod(1 - score)
    p = np.maximum(-np.expm1(clean), 1e-300)
    loss = float((share * np.where(y == 1, -np.log(p), -clean)).mean())
    # d loss / d z_s = score_s for a clean document, -score_s (1 - p) / p for a toxic one
    g = np.where(y == 1, -np.exp(clean) / np.maximum(p, 1e-9), 1.0) * share / len(y)
    gz = g[doc] / (1 + np.exp(-z))
    return loss, np.append(np.bincount(feat, gz[sent], len(w)), gz.sum()), z


def learned_floor(z: np.ndarray, doc: np.ndarray, y: np.ndarray) -> float:
    """Logit from which a sentence counts, from the documents that the model gets right (labels may be wrong)."""
    clean = np.bincount(doc, -np.logaddexp(0, z), len(y))
    called = -np.expm1(clean) >= 0.5
    worst = np.full(len(y), -30.0)
    np.maximum.at(worst, doc, z)
    harmless, toxic = z[(y[doc] == 0) & ~called[doc]], worst[(y == 1) & called]
    if not len(harmless) or not len(toxic):
        return 0.0
    bad = float(np.quantile(toxic, 0.01))
    return min(0.75 * float(np.quantile(harmless, 0.9999)) + 0.25 * bad, bad)


def train(texts: list[str], labels: list[int]) -> dict:
    """Weights by gradient descent (Adam) on the log loss of the noisy-or of each document."""
    seen, known, bags = Counter(), {}, []  # known: one string a word
    for t in texts:
        bags.append([[known.setdefault(w, w) for w in _WORD.findall(s.lower())] for s in sentences(t)])
        seen.update({f for words in bags[-1] for w in set(words) for f in features(w)})
    toxic = Counter(f for bag, y in zip(bags, labels) if y for f in {f for words in bag for w in set(words) for f in features(w)})
    rate = sum(labels) / len(labels)
    lift = {f: (toxic[f] - n * rate) / np.sqrt(n * rate * (1 - rate)) for f, n in seen.items() if n >= MIN_DOCS}
    names = sorted((f for f, z in lift.items() if abs(z) >= LIFT), key=lambda f: (-seen[f], f))[:FEATURES]
    index = {f: i for i, f in enumerate(names)}
    doc, sent, feat, n_sent = [], [], [], 0
    for d, bag in enumerate(bags):
        for words in bag or [[]]:
            doc.append(d)
            for f in {i for w in set(words) for f in features(w) if (i := index.get(f)) is not None}:
                sent.append(n_sent)
                feat.append(f)
            n_sent += 1
    doc, sent, feat = (np.array(x, np.int64) for x in (doc, sent, feat))
    y = np.array(labels, np.float64)
    share = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())) * len(y)  # both classes weigh the same
    w, bias = np.zeros(len(names)), -4.0
    m, v, t = np.zeros(len(names) + 1), np.zeros(len(names) + 1), 0
    for _ in range(EPOCHS):
        _, grad, _ = noisy_or(w, bias, doc, sent, feat, y, share)
        grad[:-1] += DECAY * w
        t += 1
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        step = RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, bias = w - step[:-1], bias - step[-1]
    floor = learned_floor(noisy_or(w, bias, doc, sent, feat, y, share)[2], doc, y)
    return {"weights": {f: float(x) for f, x in zip(names, w) if abs(x) > 1e-6}, "bias": float(bias), "floor": floor}


_NOTHING: dict[str, float] = {}


class Scorer:
    """Applies a trained model; a word's summed weight is kept in a bounded memo."""

    def __init__(self, model: dict):
        self.weights, self.bias, self.floor = model["weights"], model["bias"], model["floor"]
        self.memo: dict[str, dict[str, float]] = {}

    def of(self, word: str) -> dict[str, float]:
        got = self.memo.get(word)
        if got is None:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            got = self.memo[word] = {f: x for f in features(word) if (x := self.weights.get(f))} or _NOTHING
        return got

    def sentence(self, text: str) -> float:
        """Logit; each feature counts once a sentence."""
        found: dict[str, float] = {}
        for w in set(_WORD.findall(text.lower())):
            found |= self.of(w)
        return self.bias + sum(found.values())

    def document(self, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
        """(score, [(start, end, score) of each sentence that is more likely toxic than not])."""
        clean, spans = 0.0, []
        for s in _SENTENCE.finditer(text or ""):
            z = min(max(self.sentence(s.group()), -30.0), 30.0)
            if z < self.floor:
                continue
            clean -= float(np.logaddexp(0, z))
            if z > 0:
                spans.append((s.start(), s.end(), 1 / (1 + np.exp(-z))))
        return float(-np.expm1(clean)), spans


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE,
        chars: int = SAMPLE_CHARS) -> dict:
    """Train on up to ``sample`` labelled documents of either class, of up to ``chars`` characters together.

    Rows without a label, id or text are not used. Without documents of both
    classes the model calls nothing toxic.
    """
    known = need(labels, id_col, label_col).toDF("doc_id", "label").filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    rows = []
    for value in (0, 1):
        ids = known.filter(F.col("label") == value).select("doc_id").distinct().orderBy(*order).limit(sample)
        # at most `sample` ids of 8 bytes: bounded, whatever the corpus
        mine = need(docs, id_col, text_col).toDF("doc_id", "text").filter("text is not null").join(F.broadcast(ids), "doc_id")
        room, chosen = chars, []
        # a row an id of the sample; those that do not fit any more are passed over
        for r in mine.groupBy("doc_id").agg(F.sum(F.length("text")).alias("n")).orderBy(*order).collect():
            if r["n"] <= room:
                chosen.append((r["doc_id"],))
                room -= r["n"]
        fits = docs.sparkSession.createDataFrame(chosen, ids.schema)
        rows += [(r["text"], value) for r in mine.join(F.broadcast(fits), "doc_id").orderBy("doc_id", "text").limit(sample).collect()]
    if len({y for _, y in rows}) < 2:
        return {"weights": {}, "bias": -30.0, "floor": 0.0}
    return train([t for t, _ in rows], [y for _, y in rows])


def _score(model: str, at: int):
    """Task: append score and spans to the rows; the text is column ``at``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(json.loads(model))
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        for batch in batches:
            got = [scorer.document(t.as_py()) for t in batch.column(at)]
            spans = [[{"start": a, "end": b, "score": float(x)} for a, b, x in s] for _, s in got]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([s for s, _ in got], pa.float64()), pa.array(spans, kind)],
                                             names=[*batch.schema.names, "__score", "__spans"])

    return run


def score(docs: DataFrame, model: dict, text_col: str = "text", score_col: str = "score", spans_col: str = "sentences", keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns of every row (all, if None) with its score and its offending sentences.

    A score is from 0 to 1; null and empty texts score 0 (no sentence), and so
    does a text, however long, without a sentence above the floor. Spans
    are code point offsets. Repeated rows get equal scores. Names that the
    kept columns have already are refused.
    """
    workers_ready(docs.sparkSession)
    keep = list(docs.columns if keep is None else keep)
    if {score_col, spans_col} & set(keep):
        raise ValueError(f"{score_col}, {spans_col} clash with columns of the input; name others")
    cols = keep if text_col in keep else [*keep, text_col]
    src = docs.select(*[F.col(f"`{c}`") for c in cols])
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields)
    out = src.mapInArrow(_score(json.dumps(model), cols.index(text_col)),
                         f"{kinds}, __score double, __spans array<struct<start:int,end:int,score:double>>")
    return out.select(*[F.col(f"`{c}`") for c in keep], F.col("__score").alias(score_col), F.col("__spans").alias(spans_col))
