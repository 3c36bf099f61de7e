"""Toxicity from character n-grams scaled by naive Bayes log-count ratios.

A text has a feature for every bucket that one of its character n-grams falls into. A
feature's size is the log ratio of the texts with it among toxic and among other ones,
so what tells nothing is nearly silent before the fit. A logistic regression with weight
decay is fitted on these scaled features.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.llm.common import map_batches, small_batches, stored, texts_of

#: Labelled rows that a model is fitted on, at most; of each label up to half of it.
SAMPLE_ROWS = 12_000
SIZES = (4, 5, 6)
BUCKET_BITS = 22
BUCKETS = 1 << BUCKET_BITS
#: Texts added to both counts of a ratio: what few texts tell counts little.
SMOOTHING = 20
#: Buckets in fewer texts of the sample, or with a smaller ratio, have no feature.
MIN_TEXTS, MIN_RATIO = 4, 1.0
EPOCHS, BATCH, RATE, DECAY = 40, 64, 0.02, 1e-3
#: Characters that are hashed at once, so a long text needs no more memory than this.
WINDOW = 1 << 20

_STEP, _SPREAD = np.uint64(1_000_003), np.uint64(0x9E3779B97F4A7C15)


def grams(text: str) -> Iterator[np.ndarray]:
    """Buckets of all character n-grams of the whole lower-cased text, a window at a time.

    All white space counts as a blank, and the text stands between two of them.
    """
    points = f" {' '.join(text.lower().split())} ".encode("utf-32-le", "surrogatepass")
    codes = np.frombuffer(points, np.uint32).astype(np.uint64)
    for at in range(0, len(codes), WINDOW):
        part = codes[at : at + WINDOW + max(SIZES) - 1]
        run = part
        for size in range(2, min(max(SIZES), len(part)) + 1):
            run = run[:-1] * _STEP + part[size - 1 :]
            if size in SIZES:
                yield ((run + np.uint64(size)) * _SPREAD >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)


def buckets(text: str, wanted: np.ndarray | None = None) -> np.ndarray:
    """Sorted different buckets of a text, or those of them that ``wanted`` marks."""
    found = [np.unique(g if wanted is None else g[wanted[g]]) for g in grams(text)]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int32)


@dataclass(frozen=True)
class Model:
    """Sorted buckets, the weight times ratio of each, and the bias."""

    kept: np.ndarray
    weights: np.ndarray
    bias: float

    @cached_property
    def wanted(self) -> np.ndarray:
        return marked(self.kept)

    def probability(self, text: str) -> float:
        found = np.searchsorted(self.kept, buckets(text, self.wanted))
        logit = float(self.weights[found].sum()) + self.bias
        return float(1 / (1 + np.exp(-np.clip(logit, -30, 30))))


def marked(kept: np.ndarray) -> np.ndarray:
    out = np.zeros(BUCKETS, bool)
    out[kept] = True
    return out


def log_ratio(n_toxic: float, n_other: float) -> Column:
    """Naive Bayes log-count ratio of a bucket from the ``toxic`` and ``other`` texts with it.

    Toxic texts are counted as if there were as many as others before ``SMOOTHING`` is
    added to both, so a bucket that is spread evenly has the ratio 0.
    """
    scaled = F.col("toxic") * (n_other / n_toxic)
    return F.log((scaled + SMOOTHING) / (F.col("other") + SMOOTHING))


def train(rows: list[np.ndarray], y: np.ndarray, weight: np.ndarray, ratios: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression on the scaled features, by Adam.

    A row lists its features' places in ``ratios``. Equal rows give equal weights.
    """
    random = np.random.default_rng(11)
    weights, first, second = (np.zeros(len(ratios)) for _ in range(3))
    bias, step = np.zeros(3), 0
    weight = weight / weight.mean()
    for epoch in range(EPOCHS):
        rate = RATE / (1 + epoch)
        order = random.permutation(len(rows))
        for at in range(0, len(rows), BATCH):
            chosen = order[at : at + BATCH]
            columns = np.concatenate([rows[i] for i in chosen])
            owner = np.repeat(np.arange(len(chosen)), [len(rows[i]) for i in chosen])
            scaled = ratios[columns]
            logits = np.bincount(owner, weights[columns] * scaled, len(chosen)) + bias[0]
            error = (1 / (1 + np.exp(-np.clip(logits, -30, 30))) - y[chosen]) * weight[chosen] / len(chosen)
            gradient = np.bincount(columns, error[owner] * scaled, len(ratios)) + DECAY * weights
            step += 1
            for value, g, m, v in ((weights, gradient, first, second), (bias[:1], error.sum(), bias[1:2], bias[2:])):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                value -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return weights, float(bias[0])


def _labelled(labels: DataFrame, label: str, id: str) -> DataFrame:
    """``id``, ``label`` and ``weight`` of a bounded sample, drawn by a hash of the id."""
    clean = (
        labels.select(labels[id].alias("id"), labels[label].cast("int").alias("label"))
        .where("id is not null and label in (0, 1)")
        .groupBy("id").agg(F.max("label").alias("label"))
    )
    counts = {r["label"]: r["n"] for r in clean.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = {k: min(1.0, SAMPLE_ROWS / 2 / n) for k, n in counts.items()}
    # Toxic rows are rare: half way, in powers, between their share and an equal one.
    raised = math.sqrt(counts.get(0, 1) / counts.get(1, 1))
    toxic = F.col("label") == 1
    draw = F.shiftrightunsigned(F.xxhash64("id"), 11) / float(1 << 53)
    mine = F.when(toxic, share.get(1, 1.0)).otherwise(share.get(0, 1.0))
    return clean.where(draw < mine).withColumn("weight", F.when(toxic, raised).otherwise(1.0) / mine)


def _ratios(sample: DataFrame, n_toxic: int, n_other: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted buckets that have a feature, and the log ratio of each."""
    small_batches(sample.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((2, BUCKETS), np.int32)
        for batch in batches:
            for kind, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                found[kind, buckets(text)] += 1
        used = np.flatnonzero(found.any(0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(found[1, used], pa.int64()), pa.array(found[0, used], pa.int64())],
            names=["bucket", "toxic", "other"],
        )

    parts = sample.select("label", "text").mapInArrow(count, "bucket int, toxic long, other long")
    totals = parts.groupBy("bucket").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    told = totals.where(F.col("toxic") + F.col("other") >= MIN_TEXTS).select("bucket", log_ratio(n_toxic, n_other).alias("ratio"))
    # At most BUCKETS rows, and few of them tell anything.
    table = told.where(F.abs("ratio") >= MIN_RATIO).orderBy("bucket").toArrow()
    return table["bucket"].to_numpy(), table["ratio"].to_numpy()


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", id: str = "doc_id", text: str = "text") -> Model:
    """A model of ``label`` (0 or 1) from labelled documents.

    Some ``SAMPLE_ROWS`` labelled ids take part at most, chosen by a hash of the id, of
    each label up to half. Rows with a null id or label teach nothing; an id with several
    labels counts once, with the larger. A null text is empty. Where only one label is
    known, every score is that label, and one half without any labelled row.
    """
    # Bounded by SAMPLE_ROWS, so it may go to every task.
    chosen = F.broadcast(_labelled(labels, label, id))
    texts = docs.select(docs[id].alias("id"), docs[text].alias("text"))
    sample = stored(texts.join(chosen, "id").select("id", "label", "weight", "text"), "sample")
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        bias = {0: -30.0, 1: 30.0}[next(iter(sizes))] if sizes else 0.0
        return Model(np.zeros(0, np.int32), np.zeros(0), bias)
    kept, ratios = _ratios(sample, sizes[1], sizes[0])
    shared = sample.sparkSession.sparkContext.broadcast(kept)

    def featured(batch: pa.RecordBatch) -> pa.RecordBatch:
        wanted = marked(shared.value)
        rows = [np.searchsorted(shared.value, buckets(t, wanted)) for t in texts_of(batch.column(3))]
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(rows, pa.list_(pa.int32()))], names=["order", "label", "weight", "places"]
        )

    hashed = sample.select(F.xxhash64("id", "text").alias("order"), "label", "weight", "text")
    rows = map_batches(hashed, featured, "order long, label int, weight double, places array<int>")
    table = rows.orderBy("order", "label").toArrow()
    places = [np.array(p, np.int64) for p in table["places"].to_pylist()]
    y, weight = table["label"].to_numpy().astype(float), table["weight"].to_numpy()
    weights, bias = train(places, y, weight, ratios)
    return Model(kept, weights * ratios, bias)


def score(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id`` and ``score`` of every row, from its whole text; a null text is an empty one.

    Only ``id`` and ``text`` are read, other columns may have any name. Rows are
    independent, so repeated rows get equal scores and null ids stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id].dataType.simpleString()

    def scored(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shared.value.probability(t) for t in texts_of(batch.column(1))]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], names=[id, "score"])

    return map_batches(docs.select(docs[id], docs[text]), scored, f"`{id}` {kind}, score double")
