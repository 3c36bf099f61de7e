"""Quality scores from random-indexing word vectors and a small network.

Every word has a sparse random index vector. A word's vector is its own index plus
the indexes of its neighbours, gathered over the labelled sample. Vectors are pooled
per document beside a few shape counts, scored by a two-layer network in numpy, and
turned into probabilities by a temperature fitted on labelled rows kept aside.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm.common import map_batches, small_batches, stored, texts_of

#: Labelled rows that a model is fitted on, at most; more are thinned by a hash.
SAMPLE_ROWS = 20_000
SLOTS, WIDTH, NONZERO, WINDOW = 1 << 14, 64, 6, 2
SHAPES, EXTRAS = 32, 5
HIDDEN, EPOCHS, RATE, DECAY, BATCH = 32, 60, 0.003, 1e-4, 128
KEPT_TOKENS = 500_000
TOKEN = re.compile(r"\w+|[^\w\s]+")


@lru_cache(maxsize=1)
def index_vectors() -> np.ndarray:
    """Random index of every slot: a few entries of plus or minus one."""
    random = np.random.default_rng(17)
    index = np.zeros((SLOTS, WIDTH), np.float32)
    places = random.permuted(np.tile(np.arange(WIDTH), (SLOTS, 1)), axis=1)[:, :NONZERO]
    signs = random.choice(np.array([-1, 1], np.float32), (SLOTS, NONZERO))
    np.put_along_axis(index, places, signs, axis=1)
    return index


_known: dict[str, int] = {}


def _token_id(token: str) -> int:
    """Slot of the lower-case token times ``SHAPES``, plus its shape."""
    kind = 0 if token.isalpha() else 1 if token.isdigit() else 2 if token.isalnum() else 3
    case = 2 if token.isupper() and len(token) > 1 else 0 if token.islower() else 1
    long = min(2, len(token) // 4) if kind == 0 else min(2, len(token) - 1)
    shape = (kind * 3 + long) * 3 + case if kind == 0 else 9 + (kind - 1) * 3 + long
    found = zlib.crc32(token.lower().encode()) % SLOTS * SHAPES + shape
    if len(_known) >= KEPT_TOKENS:
        _known.clear()
    _known[token] = found
    return found


def token_ids(text: str) -> np.ndarray:
    get = _known.get
    return np.array([get(t) or _token_id(t) for t in TOKEN.findall(text)], np.int64)


def features(text: str, vectors: np.ndarray) -> np.ndarray:
    """Mean word vector, shares of shapes, and five counts of the whole text."""
    ids = token_ids(text)
    out = np.zeros(WIDTH + SHAPES + EXTRAS, np.float32)
    lines = [line for line in text.split("\n") if line.strip()]
    if len(ids):
        slots = ids // SHAPES
        used, counts = np.unique(slots, return_counts=True)
        out[:WIDTH] = counts.astype(np.float32) @ vectors[used] / len(ids)
        out[WIDTH : WIDTH + SHAPES] = np.bincount(ids % SHAPES, minlength=SHAPES) / len(ids)
        out[-5] = np.mean(slots[1:] == slots[:-1]) ** 0.5 if len(ids) > 1 else 0
        out[-4] = math.log1p(len(ids)) / 8
        out[-3] = len(used) / len(ids) ** 0.8
        out[-2] = 1 - len(set(lines)) / max(1, len(lines))
        out[-1] = math.log1p(len(lines)) / 8
    return out


def _neighbour_sums(sample: DataFrame) -> np.ndarray:
    """Sum of the indexes of each slot's neighbours over the sample, and its count."""
    small_batches(sample.sparkSession)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, sums = index_vectors(), np.zeros((SLOTS, WIDTH), np.float32)
        seen = np.zeros(SLOTS, bool)
        for batch in batches:
            for text in texts_of(batch.column(0)):
                slots = token_ids(text) // SHAPES
                seen[slots] = True
                for step in range(1, WINDOW + 1):
                    left, right = slots[:-step], slots[step:]
                    np.add.at(sums, left, index[right])
                    np.add.at(sums, right, index[left])
        used = np.flatnonzero(seen)
        if len(used):
            rows = [sums[u].tolist() for u in used]
            yield pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int32()), pa.array(rows, pa.list_(pa.float32()))], names=["slot", "vector"]
            )

    parts = sample.select("text").mapInArrow(gather, "slot int, vector array<float>")
    total = parts.groupBy("slot").agg(*(F.sum(F.col("vector")[i]).alias(f"v{i}") for i in range(WIDTH)))
    sums = np.zeros((SLOTS, WIDTH))
    for row in total.collect():
        sums[row[0]] = row[1:]
    return sums


@dataclass(frozen=True)
class Model:
    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    layers: tuple[np.ndarray, np.ndarray, np.ndarray, float]
    temperature: float

    def probabilities(self, rows: np.ndarray) -> np.ndarray:
        logits = _logits((rows - self.mean) / self.scale, self.layers) / self.temperature
        return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))


def _logits(x: np.ndarray, layers: tuple) -> np.ndarray:
    w1, b1, w2, b2 = layers
    return np.maximum(x @ w1 + b1, 0) @ w2 + b2


def train_network(x: np.ndarray, y: np.ndarray) -> tuple:
    """Two layers, fitted by Adam on the log loss; the same rows give the same network."""
    random = np.random.default_rng(5)
    width = x.shape[1]
    state = [
        random.normal(0, (2 / width) ** 0.5, (width, HIDDEN)), np.zeros(HIDDEN),
        random.normal(0, (1 / HIDDEN) ** 0.5, HIDDEN), np.zeros(1),
    ]
    first, second = [np.zeros_like(s) for s in state], [np.zeros_like(s) for s in state]
    step = 0
    for _ in range(EPOCHS):
        order = random.permutation(len(x))
        for at in range(0, len(x), BATCH):
            rows = order[at : at + BATCH]
            a, b = x[rows], y[rows]
            hidden = np.maximum(a @ state[0] + state[1], 0)
            error = (1 / (1 + np.exp(-np.clip(hidden @ state[2] + state[3], -30, 30))) - b) / len(rows)
            back = np.outer(error, state[2]) * (hidden > 0)
            grads = [a.T @ back + DECAY * state[0], back.sum(0), hidden.T @ error + DECAY * state[2], error.sum(keepdims=True)]
            step += 1
            for s, g, m, v in zip(state, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                s -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return state[0], state[1], state[2], float(state[3][0])


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least log loss on rows that the network was not fitted on."""
    def loss(t: float) -> float:
        z = logits / t
        return float(np.mean(np.logaddexp(0, z) - y * z))

    return min((float(t) for t in np.geomspace(0.25, 8, 41)), key=loss)


def fit(docs: DataFrame, labels: DataFrame, label: str, id: str = "doc_id", text: str = "text") -> Model:
    """A model of ``label`` (0 or 1) from labelled documents.

    At most some ``SAMPLE_ROWS`` labelled ids take part, chosen by a hash of the id. Rows
    with a null id or label teach nothing; an id with several labels counts once, with
    the larger. A null text is empty. Without any labelled row every score is one half.
    """
    clean = (
        labels.select(labels[id].alias("id"), labels[label].cast("double").alias("label"))
        .where("id is not null and label is not null")
        .groupBy("id").agg(F.max("label").alias("label"))
    )
    share = min(1.0, SAMPLE_ROWS / max(1, clean.count()))
    chosen = clean.where(F.shiftrightunsigned(F.xxhash64("id"), 11) / float(1 << 53) < share)
    # Bounded by SAMPLE_ROWS, so it may go to every task.
    texts = docs.select(docs[id].alias("id"), docs[text].alias("text"))
    sample = stored(texts.join(F.broadcast(chosen), "id"), "sample")
    sums = _neighbour_sums(sample)
    own = index_vectors()
    norms = np.linalg.norm(sums, axis=1, keepdims=True)
    vectors = (own / NONZERO**0.5 + sums / np.maximum(norms, 1e-9)).astype(np.float32)
    rows = _featured(sample.select("id", "label", "text"), vectors).orderBy("order", "label").collect()
    width = WIDTH + SHAPES + EXTRAS
    x = np.array([r["features"] for r in rows], np.float64).reshape(-1, width)
    y = np.array([r["label"] for r in rows], np.float64)
    mean, scale = (x.mean(0), x.std(0) + 1e-3) if len(x) else (np.zeros(width), np.ones(width))
    if not len(x):
        zero = (np.zeros((width, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), 0.0)
        return Model(vectors, mean, scale, zero, 1.0)
    x = (x - mean) / scale
    aside = np.arange(len(x)) % 5 == 4
    layers = train_network(x[~aside], y[~aside])
    temperature = fit_temperature(_logits(x[aside], layers), y[aside]) if aside.any() else 1.0
    return Model(vectors, mean, scale, layers, temperature)


def _featured(sample: DataFrame, vectors: np.ndarray) -> DataFrame:
    shared = sample.sparkSession.sparkContext.broadcast(vectors)
    hashed = sample.select(F.xxhash64("id", "text").alias("order"), "label", "text")

    def pooled(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [features(t, shared.value).tolist() for t in texts_of(batch.column(2))]
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:2], pa.array(rows, pa.list_(pa.float32()))], names=["order", "label", "features"]
        )

    return map_batches(hashed, pooled, "order long, label double, features array<float>")


def score(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id`` and ``score`` of every row; a null text is scored as an empty one.

    Only ``id`` and ``text`` are read. Rows are independent, so repeated rows get equal
    scores and null ids stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id].dataType.simpleString()

    def scored(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = shared.value
        rows = np.array([features(t, model.vectors) for t in texts_of(batch.column(1))])
        found = model.probabilities(rows.astype(np.float64))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], names=[id, "score"])

    return map_batches(docs.select(docs[id], docs[text]), scored, f"`{id}` {kind}, score double")
