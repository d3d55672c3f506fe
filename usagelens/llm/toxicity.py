"""Toxicity: a convolutional text classifier trained in numpy.

A word's embedding is the sum of hashed rows for the word and its beginnings, so words unseen in training
are known by their stems. Filters over one, two and three adjacent words are rectified, the highest value
of each over the whole text is kept (max pooling), and a logistic layer weighs them. Training runs in one
task, on a bounded sample of labelled rows, and only the model reaches the driver; scoring runs in tasks over
every text.

Scores know nothing of languages, labels or sources. Where a decision is wanted, each language has a
threshold of its own, calibrated on labelled rows that training did not see.
"""

from __future__ import annotations

import pickle
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from usagelens.functions.joins import hint_if_small
from usagelens.llm.common import pieces, stored, with_columns

#: Labelled rows that training uses at most, of each label: those with the smallest seeded hash.
MAX_ROWS = 4000
BUCKETS = 1 << 16
DIM = 16
FILTERS = 8
WIDTHS = (1, 2, 3)
EPOCHS = 5
#: Small samples are gone through more often, until there were so many steps.
MIN_STEPS = 400
BATCH = 32
SEED = 5
INIT = 0.02
#: Share of words left out at random, anew in each step, so that no filter rests on words of a single text.
LEFT_OUT = 0.5
#: Every this many sampled rows one is kept out of training, to calibrate.
CALIBRATE = 5
#: Logits are counted in steps of this size to choose thresholds.
STEP = 1 / 64
#: Scores from here on count as toxic; calibration moves the scale so that this is the best single threshold.
THRESHOLD = 0.3
#: A language with fewer calibration rows of a label than this uses the common threshold.
MIN_CALIBRATION = 8
WORD = re.compile(r"[^\W\d_]+")
BEGINNINGS = (3, 4, 5)
N_ROWS = 1 + len(BEGINNINGS)
# Positions that are scored at a time, and words whose filter values a task keeps.
POSITIONS = 1 << 16
KEPT_WORDS = 3 << 16


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def row_of(part: str) -> int:
    return 1 + xxhash.xxh32_intdigest(part) % (BUCKETS - 1)


def rows_of(words: list[str], beginnings: dict[str, int]) -> np.ndarray:
    """The embedding rows of each word; row 0 is empty and stands for a missing beginning.

    `beginnings` keeps the rows of those met before.
    """
    flat = []
    for w in words:
        flat.append(row_of(w))
        for n in BEGINNINGS:
            if len(w) <= n:
                flat.append(0)
                continue
            start = w[:n]
            row = beginnings.get(start)
            if row is None:
                row = beginnings[start] = row_of(start + "-")
            flat.append(row)
    return np.array(flat, dtype=np.int32).reshape(-1, N_ROWS)


@dataclass
class Packed:
    """Texts as one sequence of word numbers: each has a word at least and two empty ones after it, the last three."""

    ids: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def packed(texts: list[list[int]]) -> Packed:
    sizes = np.array([max(1, len(t)) for t in texts])
    ends = np.cumsum(sizes + 2) - 2
    flat = [x for t in texts for x in (*(t or (0,)), 0, 0)]
    return Packed(np.array([*flat, 0], dtype=np.int64), ends - sizes, ends)


@dataclass
class Model:
    embedding: np.ndarray
    filters: dict[int, np.ndarray]  # width -> (width, DIM, FILTERS)
    biases: dict[int, np.ndarray]
    weights: np.ndarray
    bias: float
    scale: float = 1.0
    thresholds: dict[str, float] = field(default_factory=dict)
    #: Rows of each label (clean, toxic) among all labelled ones, for each row that training left out.
    left_out: tuple[float, float] = (1.0, 1.0)

    def values(self, rows: np.ndarray) -> np.ndarray:
        """What a word adds to each filter at each place in it."""
        vectors = self.embedding[rows].sum(axis=1)
        kernels = [self.filters[w][k] for w in WIDTHS for k in range(w)]
        return (vectors @ np.concatenate(kernels, axis=1)).astype(np.float32)

    def convolved(self, values: np.ndarray, text: Packed) -> list[np.ndarray]:
        """For each width, the filters' values at every position (before the rectifier)."""
        out, place, n = [], 0, len(text.ids) - max(WIDTHS) + 1
        for w in WIDTHS:
            total = np.repeat(self.biases[w][None, :].astype(np.float32), n, axis=0)
            for k in range(w):
                total += values[text.ids[k : k + n], place * FILTERS : (place + 1) * FILTERS]
                place += 1
            out.append(total)
        return out

    def pooled(self, values: np.ndarray, text: Packed) -> np.ndarray:
        cuts = np.stack([text.starts, text.ends], axis=1).ravel()
        maps = self.convolved(values, text)
        highest = [np.maximum.reduceat(m, cuts, axis=0)[::2] for m in maps]
        return np.maximum(np.concatenate(highest, axis=1), 0)

    def logits(self, values: np.ndarray, text: Packed) -> np.ndarray:
        return (self.pooled(values, text) @ self.weights + self.bias) * self.scale


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fresh_model(rng: np.random.Generator) -> Model:
    embedding = rng.normal(0, INIT, (BUCKETS, DIM)).astype(np.float32)
    embedding[0] = 0
    return Model(
        embedding,
        {w: rng.normal(0, 0.3 / np.sqrt(w), (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS},
        {w: np.zeros(FILTERS, dtype=np.float32) for w in WIDTHS},
        rng.normal(0, 0.3, FILTERS * len(WIDTHS)).astype(np.float32),
        0.0,
    )


class Adagrad:
    def __init__(self, rate: float):
        self.rate, self.seen = rate, {}

    def step(self, name: str, array: np.ndarray, grad: np.ndarray, rows: np.ndarray | None = None) -> None:
        seen = self.seen.setdefault(name, np.full_like(array, 1e-6))
        if rows is None:
            seen += grad**2
            array -= self.rate * grad / np.sqrt(seen)
        else:
            keys, at = np.unique(rows, return_inverse=True)
            total = np.zeros((len(keys), array.shape[1]), dtype=array.dtype)
            np.add.at(total, at, grad)
            seen[keys] += total**2
            array[keys] -= self.rate * total / np.sqrt(seen[keys])


def train(texts: list[str | None], labels: list[int], langs: list[str | None], seed: int = SEED) -> Model:
    """Train on most of the rows, calibrate on the rest; without both labels, a model that scores all alike."""
    rng = np.random.default_rng(seed)
    model = fresh_model(rng)
    known: dict[str, int] = {}
    numbered = [[known.setdefault(w, len(known) + 1) for w in words_of(t)] for t in texts]
    rows = np.concatenate([np.zeros((1, N_ROWS), dtype=np.int32), rows_of(list(known), {})])
    y = np.array(labels, dtype=np.float32)
    held = np.arange(len(y)) % CALIBRATE == CALIBRATE - 1
    fit = np.flatnonzero(~held)
    if len(set(y[fit])) < 2:
        model.weights[:] = 0
        # Without examples of both labels nothing is known but the label itself.
        model.bias = 2.0 if len(y) and y.min() == 1 else -2.0
        return model
    # Both labels weigh the same.
    weight = np.where(y == 1, 0.5 / max(1e-9, y[fit].mean()), 0.5 / max(1e-9, 1 - y[fit].mean()))
    adagrad = Adagrad(0.05)
    for _ in range(max(EPOCHS, MIN_STEPS * BATCH // len(fit))):
        for batch in np.array_split(rng.permutation(fit), max(1, len(fit) // BATCH)):
            some = [np.where(rng.random(len(numbered[i])) < LEFT_OUT, 0, numbered[i]).tolist() for i in batch]
            learn_batch(model, adagrad, rows, some, y[batch], weight[batch])
    calibrate(model, score_numbered(model, rows, numbered), y, langs, held)
    return model


def learn_batch(model: Model, adagrad: Adagrad, rows: np.ndarray, texts, y: np.ndarray, weight: np.ndarray) -> None:
    text = packed(texts)
    local, text.ids = np.unique(text.ids, return_inverse=True)
    words = rows[local]
    maps = model.convolved(model.values(words), text)
    at = np.array([[a + m[a:b].argmax(axis=0) for m in maps] for a, b in zip(text.starts, text.ends)])
    # at: (text, width, filter) -> position of the highest value
    high = np.stack([m[at[:, i], np.arange(FILTERS)] for i, m in enumerate(maps)], axis=1)
    features = np.maximum(high, 0).reshape(len(y), -1)
    error = (sigmoid(features @ model.weights + model.bias) - y) * weight / len(y)
    back = (error[:, None] * model.weights[None, :]).reshape(high.shape) * (high > 0)
    touched, grads = [], []
    vectors = model.embedding[words].sum(axis=1)
    for i, w in enumerate(WIDTHS):
        kernel_grad = np.zeros_like(model.filters[w])
        g = back[:, i]
        for k in range(w):
            word = text.ids[at[:, i] + k]  # (text, filter)
            kernel_grad[k] = np.einsum("tfd,tf->df", vectors[word], g)
            to_words = g[:, :, None] * model.filters[w][k].T[None]  # (text, filter, DIM)
            used = g != 0
            touched.append(word[used])
            grads.append(to_words[used])
        adagrad.step(f"filter{w}", model.filters[w], kernel_grad)
        adagrad.step(f"bias{w}", model.biases[w], g.sum(axis=0))
    word, grad = np.concatenate(touched), np.concatenate(grads)
    if len(word):
        of_rows = words[word]
        adagrad.step("embedding", model.embedding, np.repeat(grad, N_ROWS, axis=0), of_rows.ravel())
        model.embedding[0] = 0
    adagrad.step("weights", model.weights, features.T @ error)
    bias = np.array([model.bias], dtype=np.float32)
    adagrad.step("bias", bias, np.array([error.sum()]))
    model.bias = float(bias[0])


def score_numbered(model: Model, rows: np.ndarray, texts: list[list[int]]) -> np.ndarray:
    out = []
    for i in range(0, len(texts), BATCH):
        text = packed(texts[i : i + BATCH])
        local, text.ids = np.unique(text.ids, return_inverse=True)
        out.append(model.logits(model.values(rows[local]), text))
    return np.concatenate(out) if out else np.zeros(0)


def best_cut(logits: np.ndarray, y: np.ndarray) -> float:
    """The logit that separates the labels with the highest F1, midway between its neighbours."""
    order = np.argsort(-logits)
    hit = np.cumsum(y[order])
    f1 = 2 * hit / (np.arange(1, len(y) + 1) + y.sum())
    best = np.flatnonzero(f1 >= f1.max() - 1e-9)
    at = int(best[len(best) // 2])
    low = logits[order[at + 1]] if at + 1 < len(y) else logits[order[at]] - 1
    return float((logits[order[at]] + low) / 2)


def calibrate(model: Model, logits: np.ndarray, y: np.ndarray, langs: list[str | None], held: np.ndarray) -> None:
    """Move the logits so that THRESHOLD is the best common cut, and find the best one by language."""
    use = held if 0 < y[held].sum() < held.sum() else np.ones_like(held)
    wanted = float(np.log(THRESHOLD / (1 - THRESHOLD)))
    shift = wanted - best_cut(logits[use], y[use])
    model.bias += shift
    names = np.array([x or "" for x in langs])
    for lang in {x for x in langs if x}:
        own = use & (names == lang)
        if min(y[own].sum(), (1 - y[own]).sum()) >= MIN_CALIBRATION:
            model.thresholds[lang] = float(sigmoid(np.array(best_cut(logits[own] + shift, y[own]))))


def best_step(steps: np.ndarray, clean: np.ndarray, toxic: np.ndarray) -> float:
    """`best_cut` over counted logits: steps in ascending order, and how many rows of each label lie in each."""
    steps, clean, toxic = steps[::-1], clean[::-1], toxic[::-1]
    f1 = 2 * np.cumsum(toxic) / (np.cumsum(clean + toxic) + toxic.sum())
    best = np.flatnonzero(f1 >= f1.max() - 1e-9)
    at = int(best[len(best) // 2])
    low = steps[at + 1] if at + 1 < len(steps) else steps[at] - 1 / STEP
    return float((steps[at] + low) / 2 * STEP)


def cuts_from(model: Model, counts: list[tuple[str | None, int, int, int]]) -> None:
    """As `calibrate`, from (lang, toxic, step, rows) over rows that training left out.

    Training takes as many rows of either label, so the rarer label is rarer still among those left; the model's
    `left_out` gives each label the weight it has among all rows. Without both labels, the model stays as it is.
    """
    def cut(rows: list[tuple[str | None, int, int, int]], least: int) -> float | None:
        steps, at = np.unique([r[2] for r in rows], return_inverse=True)
        of = np.zeros((2, len(steps)))
        np.add.at(of, ([r[1] for r in rows], at), [r[3] for r in rows])
        return best_step(steps, *(of * np.array(model.left_out)[:, None])) if min(of.sum(axis=1)) >= least else None

    if not counts or (common := cut(counts, 1)) is None:
        return
    shift = float(np.log(THRESHOLD / (1 - THRESHOLD))) - common
    model.bias += shift
    model.thresholds.clear()
    by_lang: dict[str, list[tuple[str | None, int, int, int]]] = {}
    for row in counts:
        if row[0]:
            by_lang.setdefault(row[0], []).append(row)
    for lang, rows in by_lang.items():
        if (own := cut(rows, MIN_CALIBRATION)) is not None:
            model.thresholds[lang] = float(sigmoid(np.array(own + shift)))


def logit_counts(rows: DataFrame, model: Model) -> list[tuple[str | None, int, int, int]]:
    """(lang, toxic, step, rows) for `rows` (text, toxic, lang): one for each step of logits that occurs."""
    tables = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        scorer = Scorer(tables.value)
        for batch in batches:
            for part in pieces(batch, "text"):
                steps = np.rint(scorer.logits(part.column("text").to_pylist()) / STEP).astype(np.int64)
                marks = part.column("toxic").cast(pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("lang"), marks, pa.array(steps)], names=["lang", "toxic", "step"])

    found = rows.select("text", "toxic", "lang").mapInArrow(run, "lang string, toxic long, step long")
    return [tuple(r) for r in found.groupBy("lang", "toxic", "step").count().collect()]


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """Train on at most `max_rows` labelled texts of each label; set thresholds by all those left out of training.

    A document counts once; of several texts under an id the least one is used.

    `labels` is (doc_id, toxic 0 or 1); rows with another or no label, and null ids, teach nothing; of
    two labels of a document 1 counts. The sample
    are the rows with the smallest seeded hash, so it is the same in every run.
    """
    marked = with_columns(labels, "doc_id", "toxic").filter("toxic in (0, 1)")
    marked = marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    hashed = marked.withColumn("place", F.xxhash64(F.lit(SEED), "doc_id"))
    texts = with_columns(docs, "doc_id", "text", "lang").filter("text is not null")
    least = F.min(F.struct("text", "lang", "toxic")).alias("row")
    known = texts.join(hint_if_small(stored(hashed, "toxicity-labels")), "doc_id").groupBy("doc_id", "place").agg(least).select("doc_id", "place", "row.*")
    known = stored(known, "toxicity")
    by_label = [known.filter(F.col("toxic") == t).orderBy("place", "doc_id").limit(max_rows) for t in (0, 1)]
    # The sample is one partition; its rows that `train` holds out are numbered by multiples of CALIBRATE.
    numbered = by_label[0].unionByName(by_label[1]).withColumn("n", F.row_number().over(Window.orderBy("place", "doc_id")))
    sample = numbered.select("text", "toxic", "lang")
    used = numbered.filter(F.col("n") % CALIBRATE != 0).select("doc_id")

    def run(batches):
        texts, marks, langs = [], [], []
        for batch in batches:
            for column, held in zip(batch.columns, (texts, marks, langs)):
                held += column.to_pylist()
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train(texts, marks, langs))], pa.binary())], names=["model"])

    trained = sample.mapInArrow(run, "model binary").first()
    if not trained:
        return train([], [], [])
    model = pickle.loads(trained.model)
    if model.weights.any():
        counts = logit_counts(known.join(F.broadcast(used), "doc_id", "left_anti"), model)
        total = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}  # two rows
        left = [sum(r[3] for r in counts if r[1] == t) for t in (0, 1)]
        model.left_out = tuple(total.get(t, 0) / max(1, left[t]) for t in (0, 1))
        cuts_from(model, counts)
    return model


class Scorer:
    """A model with the filter values of the words met so far."""

    def __init__(self, model: Model):
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.beginnings: dict[str, int] = {}
        self.values = self.model.values(np.zeros((1, N_ROWS), dtype=np.int32))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return sigmoid(self.logits(texts))

    def logits(self, texts: list[str | None]) -> np.ndarray:
        out, waiting, size = [], [], 0
        for text in texts:
            words = words_of(text)
            waiting.append(words)
            size += len(words) + 2
            if size > POSITIONS:
                out.append(self.score_some(waiting))
                waiting, size = [], 0
        if waiting:
            out.append(self.score_some(waiting))
        return np.concatenate(out) if out else np.zeros(0)

    def score_some(self, texts: list[list[str]]) -> np.ndarray:
        if len(self.known) > KEPT_WORDS:
            self.forget()
        known = self.known
        new = list({w for t in texts for w in t if w not in known})
        if new:
            for w in new:
                known[w] = len(known) + 1
            if len(known) >= len(self.values):
                more = np.zeros((max(len(self.values), len(new)), self.values.shape[1]), dtype=np.float32)
                self.values = np.concatenate([self.values, more])
            self.values[len(known) - len(new) + 1 : len(known) + 1] = self.model.values(rows_of(new, self.beginnings))
        text = packed([[known[w] for w in t] for t in texts])
        return self.model.logits(self.values, text)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0 to 1) for each row of `docs` (doc_id, text).

    The whole text counts. A null text, an empty one and one without words score alike, as one empty word.
    Rows may repeat, ids may be null; extra columns are ignored.
    """
    rows = with_columns(docs, "doc_id", "text")
    tables = docs.sparkSession.sparkContext.broadcast(model)
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        scorer = Scorer(tables.value)
        for batch in batches:
            for part in pieces(batch, "text"):
                found = scorer.scores(part.column("text").to_pylist()).astype(np.float64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found)], names=["doc_id", "score"])

    return rows.mapInArrow(run, f"doc_id {id_type}, score double")


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of `docs`, all columns, that score below the threshold of their language.

    A language without a threshold of its own, or none, uses THRESHOLD.
    """
    with_columns(docs, "text", "lang")
    tables = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        scorer = Scorer(tables.value)
        cuts = tables.value.thresholds
        for batch in batches:
            for part in pieces(batch, "text"):
                found = scorer.scores(part.column("text").to_pylist())
                limits = [cuts.get(x, THRESHOLD) for x in part.column("lang").to_pylist()]
                yield part.filter(pa.array(found < np.array(limits), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
