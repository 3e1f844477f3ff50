"""Language identification by averaged subword embeddings (operator 12).

A word is a run of letters in lower case; its features are the word itself and
its pieces of 1 to 4 characters, with marks at both ends, hashed into
``BUCKETS`` rows of an embedding table. The mean of a text's feature vectors
goes through a linear softmax over the languages. Both are trained by plain
stochastic gradient descent, in numpy, on whole documents and on stretches of
them, so that short texts are known too.

Training takes a bounded sample: up to ``SAMPLE`` documents a language, in the
order of a hash of the id, and no more than ``SAMPLE_CHARS`` characters a
language (the first document always stays). Of these, every fifth document
calibrates: a temperature makes the scores probabilities there, and the
rejection bound is the smallest score above which at most ``ERROR`` of the
calibration texts are wrong. A prediction is the likeliest language, its score,
and whether the score reaches that bound.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsekit.llm.common import GOLDEN, mix, need, workers_ready

SAMPLE, SAMPLE_CHARS, STRETCHES = 200, 400_000, 10  # documents and characters a language, stretches of a document
BUCKETS, DIM, PIECES = 1 << 16, 16, (1, 2, 3, 4)
EPOCHS, RATE, BATCH, ERROR = 5, 20.0, 64, 0.01
LONGEST = 6.5  # stretches have 1 to 2 ** LONGEST words, evenly by their logarithm
GROUP = 3_000_000  # characters scored together
UNKNOWN = "und"
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters, in lower case."""
    return _WORD.findall((text or "").lower())


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket numbers of all words' features in a row, how many each word has)."""
    char = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le"), "<u4").astype(np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2
    end = np.cumsum(size)
    word, left = np.repeat(np.arange(len(words)), size), np.repeat(end, size) - np.arange(len(char))
    place = np.repeat(size, size) - left
    whole = np.add.reduceat(mix(char + GOLDEN * (place + 1).astype(np.uint64)), end - size) if len(words) else char
    found, owner, h = [whole], [np.arange(len(words))], np.zeros(len(char), np.uint64)
    for n in range(1, max(PIECES) + 1):
        h = mix((h[: len(char) - n + 1] ^ char[n - 1 :]) + np.uint64(int(GOLDEN) * n & 0xFFFFFFFFFFFFFFFF))
        if n in PIECES:
            fits = left[: len(h)] >= n
            found.append(h[fits])
            owner.append(word[: len(h)][fits])
    owner = np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return (np.concatenate(found)[order] % np.uint64(BUCKETS)).astype(np.int64), np.bincount(owner, minlength=len(words))


class Lexicon:
    """The features of a fixed list of words, by their numbers."""

    def __init__(self, words: list[str]):
        self.number = {w: i for i, w in enumerate(dict.fromkeys(words))}
        self.flat, self.size = features(list(self.number))
        self.start = np.cumsum(self.size) - self.size

    def bag(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(features of all texts in a row, text of each); a text is the numbers of its words."""
        words = np.concatenate(texts)
        size = self.size[words]
        ends = np.cumsum(size)
        at = np.arange(ends[-1]) - np.repeat(ends - size - self.start[words], size)
        return self.flat[at], np.repeat(np.repeat(np.arange(len(texts)), [len(t) for t in texts]), size)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def gradients(table: np.ndarray, out: np.ndarray, feature: np.ndarray, text: np.ndarray, label: np.ndarray, share: np.ndarray):
    """(loss, features that occur, their gradient, gradient of the output layer) of one batch.

    The loss is the mean over the texts of ``share`` times the log loss of the softmax.
    """
    n = np.bincount(text, minlength=len(label)).astype(np.float64)
    starts = np.flatnonzero(np.diff(text, prepend=-1))
    mean = np.add.reduceat(table[feature], starts, axis=0) / n[:, None]
    p = softmax(mean @ out)
    rows = np.arange(len(label))
    loss = float(-(share * np.log(np.maximum(p[rows, label], 1e-300))).mean())
    p[rows, label] -= 1
    g = p * (share / len(label))[:, None]
    back = (g @ out.T) / n[:, None]
    order = np.argsort(feature, kind="stable")
    seen = np.flatnonzero(np.diff(feature[order], prepend=-1))
    return loss, feature[order][seen], np.add.reduceat(back[text[order]], seen, axis=0), mean.T @ g


def train(texts: list[str], labels: list[str], seed: int = 7) -> dict:
    """Model of the labelled texts: languages, score per bucket and language, temperature, rejection bound."""
    names = sorted(set(labels))
    rng = np.random.default_rng(seed)
    bags = [words_of(t) for t in texts]
    lexicon = Lexicon([w for bag in bags for w in bag])
    learn: list[tuple[np.ndarray, int]] = []
    check: list[tuple[np.ndarray, int]] = []
    seen = dict.fromkeys(names, 0)
    for bag, label in zip(bags, labels):
        words = np.array([lexicon.number[w] for w in bag], np.int64)
        if not len(words):
            continue
        seen[label] += 1
        mine = check if seen[label] % 5 == 0 else learn
        y = names.index(label)
        for _ in range(STRETCHES):
            size = min(len(words), int(2 ** rng.uniform(0, LONGEST)))
            at = int(rng.integers(len(words) - size + 1))
            mine.append((words[at : at + size], y))
    check = check or learn
    table = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM))
    out = np.zeros((DIM, len(names)))
    share = np.bincount([y for _, y in learn], minlength=len(names)).astype(np.float64)
    share = len(learn) / np.maximum(share, 1) / len(names)  # each language weighs the same
    steps, step = EPOCHS * -(-len(learn) // BATCH), 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(learn))
        for k in range(0, len(order), BATCH):
            batch = [learn[i] for i in order[k : k + BATCH]]
            label = np.array([y for _, y in batch])
            feature, text = lexicon.bag([t for t, _ in batch])
            _, rows, g_table, g_out = gradients(table, out, feature, text, label, share[label])
            rate = RATE * (1 - step / steps)
            table[rows] -= rate * g_table
            out -= rate * g_out / DIM
            step += 1
    scores = table @ out  # the mean of feature scores is the score of the mean
    feature, text = lexicon.bag([t for t, _ in check])
    z = np.add.reduceat(scores[feature], np.flatnonzero(np.diff(text, prepend=-1)), axis=0) / np.bincount(text)[:, None]
    label = np.array([y for _, y in check])
    rows = np.arange(len(label))
    heats = np.geomspace(0.1, 10, 81)
    loss = [-np.log(np.maximum(softmax(z / t)[rows, label], 1e-300)).mean() for t in heats]
    heat = float(heats[int(np.argmin(loss))])
    p = softmax(z / heat)
    best, right = p.max(axis=1), p.argmax(axis=1) == label
    order = np.argsort(-best, kind="stable")
    wrong = np.cumsum(~right[order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero(wrong <= ERROR)
    bound = float(best[order[good[-1]]]) if len(good) else 1.0
    return {"langs": names, "scores": (scores / heat).astype(np.float32), "bound": bound, "heat": heat}


class Scorer:
    """Texts -> (language, score)."""

    def __init__(self, model: dict):
        self.model = model

    def of(self, words: list[str]) -> np.ndarray:
        """A row a word: the sums of its features' scores, and their number (0 for what has no letter)."""
        flat, size = features(words)
        starts, scores = np.cumsum(size) - size, self.model["scores"]
        out = [np.add.reduceat(scores[flat, c], starts, dtype=np.float64) for c in range(scores.shape[1])]
        out = np.column_stack([*out, size])
        out[[i for i, w in enumerate(words) if not w.isalpha() and not any(map(str.isalpha, w))]] = 0
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        names = self.model["langs"]
        if not names:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        words = [words_of(t) for t in texts]
        sizes = np.array([len(w) for w in words])
        flat = pa.array([w for row in words for w in row], pa.string()).dictionary_encode()
        sums = self.of(flat.dictionary.to_pylist()) if len(flat) else None
        total = np.zeros((len(texts), len(names) + 1))
        some = np.flatnonzero(sizes)
        if len(some):
            starts = (np.cumsum(sizes) - sizes)[some]
            at = flat.indices.to_numpy(zero_copy_only=False)
            for c in range(len(names) + 1):
                total[some, c] = np.add.reduceat(sums[at, c], starts)
        n = total[:, -1]
        p = softmax(total[:, :-1] / np.maximum(n, 1)[:, None])
        best = p.argmax(axis=1)
        return [names[b] if k else UNKNOWN for b, k in zip(best.tolist(), n.tolist())], np.where(n > 0, p.max(axis=1), 0.0)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE,
        chars: int = SAMPLE_CHARS) -> dict:
    """Train on a bounded sample of the rows with an id, a text and a language.

    Up to ``sample`` documents a language, of them as many as ``chars``
    characters hold (one at least). Languages are few; one row each is
    gathered besides. Without any such row the model knows no language and
    predicts ``und``.
    """
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    known = need(docs, id_col, text_col, lang_col).toDF("doc_id", "text", "lang").filter(
        "doc_id is not null and lang is not null and text is not null")
    # the first rows of each language are found within the tasks before they meet
    first = known.select("doc_id", "lang", F.length("text").alias("n")).filter(F.col("n") <= chars).withColumn(
        "k", F.row_number().over(Window.partitionBy("lang").orderBy(*order, "n"))).filter(F.col("k") <= sample)
    room = first.withColumn("n", F.sum("n").over(Window.partitionBy("lang").orderBy("k"))).filter(
        (F.col("n") <= chars) | (F.col("k") == 1)).select("doc_id", "lang").distinct()
    # at most `sample` ids a language
    rows = known.join(F.broadcast(room), ["doc_id", "lang"]).select("lang", "text", "doc_id").distinct().orderBy("doc_id", "lang", "text").collect()
    if not rows:
        return {"langs": [], "scores": np.zeros((BUCKETS, 0), np.float32), "bound": 1.0, "heat": 1.0}
    return train([r["text"] for r in rows], [r["lang"] for r in rows])


def identify(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang, score, accepted): the likeliest language of each whole text.

    A null text, and one without a letter, is ``und`` with score 0 and not
    accepted; a text in no language of the model gets the nearest one, which
    ``accepted`` (score at or above the calibrated bound) is there to reject.
    Very long texts are read whole. Every row is answered by itself; any id,
    null too, is carried along, other columns are not read.
    """
    workers_ready(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))  # BUCKETS x languages numbers
    bound = model["bound"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(pickle.loads(shared.value))
        for batch in batches:
            texts, at = batch.column(1).to_pylist(), 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size < GROUP):
                    size += len(texts[end] or "")
                    end += 1
                lang, score = scorer.predict(texts[at:end])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, end - at), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                     pa.array([x != UNKNOWN and s >= bound for x, s in zip(lang, score.tolist())], pa.bool_())],
                    names=["doc_id", "lang", "score", "accepted"])
                at = end

    src = need(docs, id_col, text_col).toDF("doc_id", "text")
    return src.mapInArrow(run, f"doc_id {src.schema[0].dataType.simpleString()}, lang string, score double, accepted boolean")
