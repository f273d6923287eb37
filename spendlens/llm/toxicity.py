"""Toxicity: a subsequence string kernel support vector machine on Nyström landmarks.

Two words are compared by their common subsequences of three characters, each weighted by
a decay to the length it spans in either word (spans are bounded). The kernel is normalised
and raised to a power, so close words count and others hardly do. Inserted characters and
gaps only lower it; words spelled letter by letter are joined first.

Sentences are compared by the sum of the kernel over their pairs of words. On landmark words
the Nyström map makes that linear: a sentence is the sum of its words' features, so the machine's
margin is a sum of shares of words, which tasks keep for words they have met.

Labels belong to whole texts. Every sentence of a clean text is a clean one; of a toxic text
the sentence with the highest margin is taken, and the machine is trained again on that, a few
rounds. A text's score is the logistic of its highest sentence margin, fitted on the sample.
The sample is bounded; scoring reads whole texts and needs no shuffle.

Defined cases: null and empty texts get the margin of a sentence without words; without rows
of both labels every score is the share of toxic rows (0 if there are none); an empty
table gives an empty result; repeated rows and rows without an id are scored like others;
further columns are ignored.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import kept_by_worker, small_batches
from spendlens.llm.language_id import not_held_out, training_sample
from spendlens.llm.words import word_numbers, word_spans

DECAY = 0.6
SPAN = 7
POWER = 3
LANDMARKS = 96
#: Bounds of the training sample: rows of each label, characters learnt from a row, clean sentences in all.
SAMPLE_ROWS = 1000
SAMPLE_CHARS = 10_000
CLEAN_SENTENCES = 30_000
ROUNDS = 3
TOXIC_FROM = 0.7

_SENTENCES = re.compile(r"(?<=[.!?])\s+|\n+")
_END_MARKS = np.frombuffer(b".!?", np.uint8)
#: White space beyond ASCII's.
_SPACES = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_SPELLED = re.compile(r"(?<!\S)\S(?:[ .\-_*]\S){3,}(?!\S)")
#: Punctuation counts as characters of a word; at its end it does not.
_EDGES = ".,;:!?\"'()[]{}«»¿¡…"
_CODES = 64  # characters are hashed to so many classes


def plain(text: str) -> str:
    """Lower-cased, words spelled letter by letter joined, every white space one that bytes know."""
    text = text.lower()
    if _SPACES.search(text):
        text = _SPACES.sub(" ", text)
    return _SPELLED.sub(lambda m: m.group()[::2], text) if _SPELLED.search(text) else text


def sentences(text: str) -> list[set[str]]:
    """Words of each sentence that has any, as a set: a word that is repeated says no more."""
    return [s for part in _SENTENCES.split(plain(text)) if (s := set(part.split()))] or [set()]


def bare(sentence: set[str]) -> set[str]:
    return {b for b in (w.strip(_EDGES) for w in sentence) if b}


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position of the word, subsequence, weight): each word's subsequences of three characters, summed up."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    codes = np.where(points < 128, points & 31, 32 + points % 32)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), sizes)
    n, owners, grams, weights = len(codes), [], [], []
    for span in range(3, min(SPAN, n) + 1):
        first = np.flatnonzero(owner[:n - span + 1] == owner[span - 1:])
        for middle in range(1, span - 1):
            owners.append(owner[first])
            grams.append((codes[first] * _CODES + codes[first + middle]) * _CODES + codes[first + span - 1])
            weights.append(np.full(len(first), DECAY ** span))
    if not owners:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    owners, grams, weights = map(np.concatenate, (owners, grams, weights))
    key = owners * _CODES ** 3 + grams
    if len(words) * _CODES ** 3 < 1 << 31:
        key = key.astype(np.int32)  # sorts faster
    order = np.argsort(key)
    key, new = key[order].astype(np.int64), np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    first = np.flatnonzero(new)
    key = key[first]
    return key // _CODES ** 3, key % _CODES ** 3, np.add.reduceat(weights[order], first)


class Kernel:
    """Similarity of words to landmark words."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        owner, gram, weight = subsequences(landmarks)
        norm = np.sqrt(np.bincount(owner, weight ** 2, len(landmarks)))
        by = np.argsort(gram, kind="stable")
        # a subsequence's landmarks, one after another
        self.landmark, self.weight = owner[by], (weight / np.maximum(norm[owner], 1e-12))[by]
        self.size = np.bincount(gram, minlength=_CODES ** 3)
        self.first = np.cumsum(self.size) - self.size

    def __call__(self, words: list[str]) -> np.ndarray:
        owner, gram, weight = subsequences(words)
        norm = np.sqrt(np.bincount(owner, weight ** 2, len(words)))
        hit = np.flatnonzero(self.size[gram])
        sizes = self.size[gram[hit]]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.first[gram[hit]] - (ends - sizes), sizes)
        cell = np.repeat(owner[hit] * len(self.landmarks), sizes) + self.landmark[at]
        out = np.bincount(cell, np.repeat(weight[hit], sizes) * self.weight[at], len(words) * len(self.landmarks))
        out = out.reshape(len(words), -1) / np.maximum(norm, 1e-12)[:, None]
        return (out.clip(0, 1) ** POWER).astype(np.float32)


@dataclass
class Model:
    landmarks: list[str]
    weights: np.ndarray  # on the kernel's values: Nyström map and machine in one
    bias: float
    slope: float
    offset: float


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 3e-3) -> np.ndarray:
    """Squared-hinge support vector machine by Newton steps on its support vectors."""
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(len(w))
    penalty[-1, -1] = 1e-6  # the bias
    for _ in range(15):
        margin = y * (x @ w)
        inside = margin < 1
        a = x[inside] * weight[inside, None]
        new = np.linalg.solve(a.T @ x[inside] + penalty, a.T @ y[inside])
        if np.abs(new - w).max() < 1e-6:
            break
        w = new
    return w


def _logistic(v: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic fitted to margins (Platt's smoothed targets)."""
    n1, n0 = y.sum(), len(y) - y.sum()
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([v, np.ones(len(v))], axis=1)
    ridge = np.diag([1e-2, 1e-6])

    def loss(theta):
        z = x @ theta
        return (np.logaddexp(0, z) - t * z).sum() + theta @ ridge @ theta / 2

    theta = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (p - t) + ridge @ theta)
        size = 1.0
        while size > 1e-6 and loss(theta - size * step) > loss(theta):
            size /= 2  # far out the curvature says too little
        theta = theta - size * step
        if np.abs(size * step).max() < 1e-7:
            break
    a, b = theta
    return float(a), float(b)


def train(texts: list[str], labels: list[int]) -> Model | None:
    toxic = [[bare(s) for s in sentences(t)] for t, y in zip(texts, labels) if y == 1]
    clean = [[bare(s) for s in sentences(t)] for t, y in zip(texts, labels) if y == 0]
    if not toxic or not clean:
        return None
    in_toxic = Counter(w for doc in toxic for w in {w for s in doc for w in s})
    in_clean = Counter(w for doc in clean for w in {w for s in doc for w in s})

    def odds(w):
        return math.log((in_toxic[w] + 0.5) / (len(toxic) + 1)) - math.log((in_clean[w] + 0.5) / (len(clean) + 1))

    # half of the landmarks tell the labels apart, half are the commonest words
    telling = sorted((w for w in in_toxic if len(w) > 2), key=lambda w: (-in_toxic[w] / len(toxic) * odds(w), w))
    common = sorted((w for w in in_clean if len(w) > 2), key=lambda w: (-in_clean[w], w))
    landmarks = list(dict.fromkeys(telling[:LANDMARKS // 2] + common[:LANDMARKS // 2]))
    if not landmarks:
        return None
    kernel = Kernel(landmarks)
    values, vectors = np.linalg.eigh(kernel(landmarks).astype(float))
    keep = values > 1e-4
    nystrom = (vectors[:, keep] / np.sqrt(values[keep])).astype(np.float32)

    every = sorted(set(in_toxic) | set(in_clean))
    place = {w: i for i, w in enumerate(every)}
    features = np.concatenate([kernel(every[i:i + 5000]) @ nystrom for i in range(0, len(every), 5000)])

    def sums(some):
        out = np.zeros((len(some), features.shape[1] + 1))
        out[:, -1] = 1
        for i, s in enumerate(some):
            if s:
                out[i, :-1] = features[[place[w] for w in sorted(s)]].sum(axis=0)
        return out

    rng = np.random.default_rng(11)
    clean_sentences = [s for doc in clean for s in doc]
    negative = sums([clean_sentences[i] for i in rng.permutation(len(clean_sentences))[:CLEAN_SENTENCES]])
    bags = [sums(doc) for doc in toxic]
    telling_of = {w: odds(w) for w in in_toxic}
    witness = [int(np.argmax([max((telling_of[w] for w in s), default=-9.0) for s in doc])) for doc in toxic]
    y = np.concatenate([np.ones(len(bags)), -np.ones(len(negative))])
    weight = np.concatenate([np.full(len(bags), 1.0), np.full(len(negative), 3 * len(bags) / len(negative))])
    for _ in range(ROUNDS):
        w = _svm(np.concatenate([np.array([b[i] for b, i in zip(bags, witness)]), negative]), y, weight)
        witness = [int((b @ w).argmax()) for b in bags]
    # the witnesses once more with a character inserted into their telling word
    shares = dict(zip(every, features @ w[:-1]))
    told = [max(sorted(doc[i]), key=shares.get, default="") for doc, i in zip(toxic, witness)]
    changed = [t[:at] + str(rng.choice(list("._-*") + [t[at - 1]])) + t[at:]
               for t in told if len(t) > 2 for at in [int(rng.integers(1, len(t)))]]
    whole = [(b[i], t) for b, i, t in zip(bags, witness, told) if len(t) > 2]
    if whole:
        extra = np.array([b for b, _ in whole])
        extra[:, :-1] += kernel(changed) @ nystrom - features[[place[t] for _, t in whole]]
        w = _svm(np.concatenate([np.array([b[i] for b, i in zip(bags, witness)]), negative, extra]),
                 np.concatenate([y, np.ones(len(extra))]), np.concatenate([weight, np.full(len(extra), 1.0)]))
    best = [(b @ w).max() for b in bags]
    slope, offset = _logistic(np.array(best + [(sums(doc) @ w).max() for doc in clean]),
                              np.concatenate([np.ones(len(best)), np.zeros(len(clean))]))
    return Model(landmarks, (nystrom @ w[:-1]).astype(np.float32), float(w[-1]), slope, offset)


class Scorer:
    """Scores texts; keeps the shares of words met before (by their numbers), in two generations of ``most`` words."""

    def __init__(self, model: Model, most: int = 600_000):
        self.model, self.most = model, most
        self.kernel = Kernel(model.landmarks)
        self.share: dict[int, float] = {}
        self.older: dict[int, float] = {}

    def known(self, number: int) -> float | None:
        if (share := self.share.get(number)) is None and (share := self.older.get(number)) is not None:
            self.share[number] = share
        return share

    def learn(self, numbers: list[int], words: list[str]) -> None:
        """Shares of words met for the first time, those of the words without punctuation at their ends."""
        bare = [w.strip(_EDGES) for w in words]
        self.share.update((n, 0.0) for n, b in zip(numbers, bare) if not b)
        some = [(n, b) for n, b in zip(numbers, bare) if b]
        own = word_numbers(" ".join([b for _, b in some]).encode()).tolist()
        new = {o: b for o, (_, b) in zip(own, some) if self.known(o) is None}
        for i in range(0, len(new), 2000):
            part = [*new][i:i + 2000]
            self.share.update(zip(part, (self.kernel([new[o] for o in part]) @ self.model.weights).tolist()))
        self.share.update((n, self.share[o]) for o, (n, _) in zip(own, some))

    def shares(self, data: bytes, spans, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(shares of the distinct words, which of them each word is)."""
        if len(self.share) > self.most:
            self.share, self.older = {}, self.share
        distinct, first, which = np.unique(numbers, return_index=True, return_inverse=True)
        distinct = distinct.tolist()
        found = list(map(self.share.get, distinct))
        missing = [i for i, share in enumerate(found) if share is None and self.known(distinct[i]) is None]
        if missing:
            start, end = spans[0][first[missing]].tolist(), spans[1][first[missing]].tolist()
            self.learn([distinct[i] for i in missing], [data[a:b].decode() for a, b in zip(start, end)])
        for i, share in enumerate(found):
            if share is None:
                found[i] = self.share[distinct[i]]
        return np.array(found), which

    def margins(self, texts: list[str]) -> np.ndarray:
        """The highest sentence sum of each text; 0 without words. All texts at once, on their bytes."""
        out = np.zeros(len(texts))
        parts = [plain(t).encode() for t in texts]
        data = b"\n".join(parts)
        spans = start, end = word_spans(np.frombuffer(data, np.uint8))
        if not len(start):
            return out
        owner = np.searchsorted(np.cumsum([len(p) + 1 for p in parts]), start, side="right")
        share, which = self.shares(data, spans, word_numbers(data, spans))
        chars = np.frombuffer(data, np.uint8)
        lines = np.concatenate([[0], np.cumsum(chars == 10)])
        new = np.ones(len(start), bool)
        new[1:] = np.isin(chars[end[:-1] - 1], _END_MARKS) | (lines[start[1:]] > lines[end[:-1]])
        sentence = np.cumsum(new) - 1
        # a sentence is the set of its words
        pairs = np.sort(sentence * len(share) + which)
        pairs = pairs[np.r_[True, pairs[1:] != pairs[:-1]]]
        sums = np.bincount(pairs // len(share), share[pairs % len(share)])
        own = owner[new]
        firsts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        out[own[firsts]] = np.maximum.reduceat(sums, firsts)
        return out

    def score(self, texts: list[str]) -> list[float]:
        m = self.model
        return (1 / (1 + np.exp(-np.clip(m.slope * (self.margins(texts) + m.bias) + m.offset, -30, 30)))).tolist()


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", folds: int = 3, held_out: int = 1, sample_rows: int = SAMPLE_ROWS,
             toxic_from: float = TOXIC_FROM) -> DataFrame:
    """One row per input row: doc_id, held_out (never learnt from), score, predicted."""
    spark = docs.sparkSession
    small_batches(spark)
    marks = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y")).where("y in (0, 1)")
    sample = training_sample(docs, marks, not_held_out("id", folds, held_out), id_col, text_col, sample_rows, SAMPLE_CHARS)
    model = train([t for t, _ in sample], [y for _, y in sample])
    share = sum(y for _, y in sample) / len(sample) if sample else 0.0
    shared, name = spark.sparkContext.broadcast(model), uuid.uuid4().hex

    def run(batches):
        scorer = kept_by_worker(name, lambda: Scorer(shared.value)) if shared.value else None
        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            scores = scorer.score(texts) if scorer else [share] * len(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores, pa.float64()),
                 pa.array([int(s >= toxic_from) for s in scores], pa.int32())],
                names=["doc_id", "held_out", "score", "predicted"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.coalesce(~not_held_out(id_col, folds, held_out), F.lit(False)).alias("held_out"),
                        F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int"))
