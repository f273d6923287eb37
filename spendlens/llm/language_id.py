"""Language identification: averaged hashed subword embeddings under a linear softmax.

A word's subwords are its character n-grams with border marks, hashed to buckets. A text is
the mean of its subwords' embeddings, classified by a linear softmax; both are trained
together by stochastic gradient descent in numpy on sentences of a bounded, labelled sample.
A part of the sample is kept out of training: it sets the softmax's temperature and the
confidence below which a prediction is rejected.

Since the softmax is linear, a word's share of the class scores is a fixed vector; tasks
keep it for words they have met. Predicting needs no shuffle.

Defined cases: a text without letters (or null) is ``und`` with score 0 and rejected; an
empty table gives an empty result; without labelled rows every text is ``und``; repeated
rows and rows without an id are predicted like others; further columns are ignored.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from spendlens.llm.common import kept_by_worker, small_batches
from spendlens.llm.words import mixed

BUCKETS = 1 << 16
DIMENSION = 16
GRAMS = (1, 2, 3, 4)
#: Bounds of the training sample: rows of each language, characters learnt from a row, sentences in all.
SAMPLE_ROWS = 800
SAMPLE_CHARS = 20_000
SAMPLE_SENTENCES = 24_000
#: Rows of a label up to which longer texts fill up its sample, cut.
LEAST_ROWS = 100
EPOCHS = 4
#: Of correctly predicted texts kept out of training, so many may be rejected.
REJECTED_RIGHT = 0.001
UNKNOWN = "und"

#: Candidate runs; characters like fractions and circled digits in them are no letters.
LETTERS = re.compile(r"[^\W\d_]+")


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(position of the word, bucket) of every subword of the words, by n and then by place."""
    text = "".join([f"<{w}>" for w in words])
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    owner = np.repeat(np.arange(len(words)), sizes)
    inner = np.ones(len(points), bool)
    inner[np.cumsum(sizes) - 1] = inner[np.cumsum(sizes) - sizes] = False
    owners, buckets = [], []
    value = np.zeros(len(points), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        # a gram's number grows by one character a round
        value = value[:len(points) - n + 1] * np.uint64(0x100000001B3) + points[n - 1:]
        if n in GRAMS:
            own = owner[:len(value)] == owner[n - 1:] if n > 1 else inner
            owners.append(owner[:len(value)][own])
            buckets.append((mixed(value[own] + np.uint64(n)) & np.uint64(BUCKETS - 1)).astype(np.int64))
    return np.concatenate(owners), np.concatenate(buckets)


def letters_of(text: str) -> list[str]:
    """Runs of letters (Unicode's letter categories), lower-cased."""
    runs = LETTERS.findall(text.lower())
    if text.isascii():
        return runs
    return [w for run in runs for w in ([run] if run.isalpha() else "".join(c if c.isalpha() else " " for c in run).split())]


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray  # of each bucket: embedding times softmax weights
    bias: np.ndarray
    temperature: float
    least_confidence: float


def _bags(sentences: list[list[str]]) -> list[np.ndarray]:
    """Each sentence's subwords."""
    words = sorted(set().union(*sentences))
    owner, bucket = subwords(words)
    bucket = bucket[np.argsort(owner, kind="stable")]
    own = dict(zip(words, np.split(bucket, np.cumsum(np.bincount(owner, minlength=len(words)))[:-1])))
    return [np.concatenate([own[w] for w in s]) for s in sentences]


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def train(texts: list[str], languages: list[str]) -> Model | None:
    """Trains on the texts' sentences; every fifth text is kept out for calibration."""
    names = sorted(set(languages))
    if not names:
        return None
    rng = np.random.default_rng(7)
    code = {n: i for i, n in enumerate(names)}
    sentences, labels, kept_out = [], [], []
    for i, (text, language) in enumerate(zip(texts, languages)):
        parts = [letters_of(p) for p in re.split(r"[.!?\n]+", text)]
        parts = [p for p in parts if p]
        if not parts:
            continue
        if i % 5 == 4:
            kept_out.append((parts, code[language]))
        else:
            sentences += parts
            labels += [code[language]] * len(parts)
    if not sentences:
        return None
    pick = rng.permutation(len(sentences))[:SAMPLE_SENTENCES]
    labels = np.array(labels)[pick]
    bags = _bags([sentences[i] for i in pick])
    share = np.bincount(labels, minlength=len(names)) / len(labels)
    weight = (1 / np.maximum(share, 1e-9) / len(names))[labels]
    embeddings = rng.normal(0, 1 / DIMENSION, (BUCKETS, DIMENSION))
    weights, bias = np.zeros((DIMENSION, len(names))), np.zeros(len(names))
    size, steps = 32, EPOCHS * (-(-len(bags) // 32))
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), size):
            rows = order[at:at + size]
            rate = 0.5 * (1 - step / steps)
            step += 1
            ids = np.concatenate([bags[r] for r in rows])
            sizes = np.array([len(bags[r]) for r in rows])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            hidden = np.add.reduceat(embeddings[ids], starts) / sizes[:, None]
            error = _softmax(hidden @ weights + bias)
            error[np.arange(len(rows)), labels[rows]] -= 1
            error *= weight[rows, None]
            back = error @ weights.T
            weights -= rate * hidden.T @ error
            bias -= rate * 0.1 * error.sum(axis=0)
            np.add.at(embeddings, ids, -rate * np.repeat(back / sizes[:, None], sizes, axis=0))
    scores = embeddings @ weights

    def logits(parts):
        return scores[subwords([w for words in parts for w in words])[1]].mean(axis=0) + bias

    if not kept_out:
        return Model(names, scores, bias, 1.0, 0.0)
    # whole texts and their first sentences, so that short texts count too
    cases = [(p, y) for p, y in kept_out] + [(p[:1], y) for p, y in kept_out]
    x, y = np.array([logits(p) for p, _ in cases]), np.array([y for _, y in cases])
    loss = {t: -np.log(_softmax(x / t)[np.arange(len(y)), y] + 1e-12).mean() for t in np.geomspace(0.05, 5, 40)}
    temperature = min(loss, key=loss.get)
    p = _softmax(x / temperature)
    right = np.sort(p.max(axis=1)[p.argmax(axis=1) == y])
    least = float(right[int(REJECTED_RIGHT * len(right))]) if len(right) else 0.0
    return Model(names, scores, bias, float(temperature), min(least, 0.5) * (1 - 1e-9))


class Predictor:
    def __init__(self, model: Model, most: int = 300_000):
        self.model, self.most = model, most
        self.place: dict[str, int] = {}
        self.table = np.zeros((1024, len(model.languages) + 1))

    def learn(self, words: list[str]) -> None:
        if len(self.place) + len(words) > len(self.table):
            self.table = np.concatenate([self.table, np.zeros((len(words) + len(self.table), self.table.shape[1]))])
        owner, bucket = subwords(words)
        first = len(self.place)
        rows = self.table[first:first + len(words)]
        for c in range(rows.shape[1] - 1):
            rows[:, c] = np.bincount(owner, self.model.scores[bucket, c], len(words))
        rows[:, -1] = np.bincount(owner, minlength=len(words))
        self.place.update(zip(words, range(first, first + len(words))))

    def predict(self, texts: list[str]) -> list[tuple[str, float, bool]]:
        """(language, confidence, accepted) of each text."""
        words = [letters_of(t) for t in texts]
        if len(self.place) > self.most:
            self.place.clear()
        if new := list(set().union(*words).difference(self.place)):
            self.learn(new)
        out, m, place = [], self.model, self.place.__getitem__
        for w in words:
            if not w:
                out.append((UNKNOWN, 0.0, False))
                continue
            rows = self.table[np.fromiter(map(place, w), np.int64, len(w))].sum(axis=0)
            p = _softmax((rows[None, :-1] / rows[-1] + m.bias) / m.temperature)[0]
            best = int(p.argmax())
            out.append((m.languages[best], float(p[best]), bool(p[best] >= m.least_confidence)))
        return out


def training_sample(docs: DataFrame, marks: DataFrame, where, id_col: str, text_col: str,
                    rows: int, chars: int, least: int = LEAST_ROWS) -> list[tuple[str, object]]:
    """(text, label) of rows that ``marks`` (id, y) marks: of at most ``rows`` ids of each label, the first by
    a hash of the id. Texts of more than ``chars`` characters come after all others and only up to ``least`` rows
    of their label, cut at a line's or sentence's end, so a label that has long texts alone is learnt, too. Ids
    without a text are left out before ranking, so they take no other row's place. Ids are ranked without
    their texts, and texts are fetched for those picked, so none is shuffled. One job ranks the ids of
    all labels, with the first of each kept map-side."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"))
    ids = (texts.where(F.length("t") > 0).select("id", (F.length("t") > chars).alias("long"))
           .groupBy("id").agg(F.min("long").alias("long")))
    ranked = (marks.where(where & F.col("y").isNotNull() & F.col("id").isNotNull()).select("id", "y").distinct()
              .join(ids, "id").select("y", F.struct("long", F.xxhash64("id").alias("rank"), "id").alias("r")))
    first = F.row_number().over(Window.partitionBy("y").orderBy("r"))  # Spark keeps the first rows of a label map-side
    picked = (ranked.withColumn("n", first).where(F.col("n") <= rows).where((~F.col("r.long")) | (F.col("n") <= least))
              .select("r.rank", "r.id", "y").collect())
    if not picked:
        return []
    # at most ``rows`` times the number of labels
    schema = StructType([StructField("rank", LongType()), StructField("id", LongType()), marks.schema["y"]])
    few = docs.sparkSession.createDataFrame([tuple(r) for r in picked], schema)
    found = texts.where(F.length("t") > 0).join(F.broadcast(few), "id").select("rank", "id", "t", "y").collect()
    return [(shortened(r.t, chars), r.y) for r in sorted(found, key=lambda r: (r[0], r[1], r.t, str(r.y)))]


def shortened(text: str, chars: int) -> str:
    """A text of more than ``chars`` characters, cut after the last line or sentence that ends before."""
    if len(text) <= chars:
        return text
    ends = [m.end() for m in re.finditer(r"[.!?\n]", text[:chars])]
    return text[:ends[-1] if ends else chars]


def not_held_out(id_col: str, folds: int, out: int):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds != out


def fitted(docs: DataFrame, id_col: str, text_col: str, lang_col: str, folds: int, held_out: int, sample_rows: int):
    """A function that gives a worker its predictor (None where nothing could be learnt)."""
    marks = docs.select(F.col(id_col).cast("long").alias("id"), F.col(lang_col).cast("string").alias("y"))
    sample = training_sample(docs, marks, not_held_out("id", folds, held_out), id_col, text_col, sample_rows, SAMPLE_CHARS)
    model = train([t for t, _ in sample], [str(y) for _, y in sample])
    shared, name = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex
    return lambda: kept_by_worker(name, lambda: Predictor(shared.value)) if shared.value else None


def predicted(predictor: Predictor | None, texts: list[str | None]) -> list[tuple[str, float, bool]]:
    return predictor.predict([t or "" for t in texts]) if predictor else [(UNKNOWN, 0.0, False)] * len(texts)


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                folds: int = 4, held_out: int = 2, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per input row: doc_id, held_out (never learnt from), lang_pred, score (calibrated confidence),
    accepted."""
    small_batches(docs.sparkSession)
    predictor = fitted(docs, id_col, text_col, lang_col, folds, held_out, sample_rows)

    def run(batches):
        own = predictor()
        for batch in batches:
            rows = predicted(own, batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([r[0] for r in rows], pa.string()),
                 pa.array([r[1] for r in rows], pa.float64()), pa.array([r[2] for r in rows], pa.bool_())],
                names=["doc_id", "held_out", "lang_pred", "score", "accepted"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.coalesce(~not_held_out(id_col, folds, held_out), F.lit(False)).alias("held_out"),
                        F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, accepted boolean"))


def accepted_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  folds: int = 4, held_out: int = 2, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs``, whole, whose language is predicted with enough confidence: one map, no join."""
    small_batches(docs.sparkSession)
    predictor = fitted(docs, id_col, text_col, lang_col, folds, held_out, sample_rows)
    at = docs.columns.index(text_col)

    def run(batches):
        own = predictor()
        for batch in batches:
            yield batch.filter(pa.array([r[2] for r in predicted(own, batch.column(at).cast(pa.string()).to_pylist())], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)

