"""Quality classifier: supervised subword embeddings.

A text is the bag of its words and of its character 3- and 4-grams, hashed into buckets,
and of a token for every word that repeats the first, second or third word before it.
Every bucket has a learned vector; the mean of a text's vectors goes through a softmax
layer. Vectors and layer are trained together by stochastic gradient descent in numpy on a
bounded sample of labelled rows, with a step size per bucket that falls with its past
gradients. As the layer is linear, a trained bucket counts with one number, the difference
of its two class scores; these numbers are broadcast (their count is a parameter), and a
text of any length is scored as their mean.

Defined results: null and empty texts have no grams and get the share of good rows in the
sample; repeated rows get equal scores; without labels every score is 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .grams import Texts
from .labelled import one_text, sample

#: Labelled rows that the model is trained on; size of the hash space and of the vectors.
MAX_TRAIN = 3000
BITS, DIM = 17, 10
EPOCHS, STEP_SIZE, SEED = 12, 0.3, 11
SIZES = (3, 4)
#: Word distances that have a token for repeats.
LAGS = (1, 2, 3)


def _buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> K.U64(64 - BITS)).astype(np.int64)


def _repeats(t: Texts):
    """(bucket, places of words) of the repeat tokens, by distance."""
    doc, h = t.words.doc, t.words.hashes
    for lag in LAGS:
        same = (h[lag:] == h[:-lag]) & (doc[lag:] == doc[:-lag])
        yield int(_buckets(K.mix(np.array([lag], K.U64)))[0]), np.flatnonzero(same) + lag


def text_buckets(texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text the distinct buckets and their counts."""
    t = Texts(texts)
    owner, bucket = [t.words.doc], [_buckets(t.words.hashes)]
    for b, at in _repeats(t):
        owner.append(t.words.doc[at])
        bucket.append(np.full(len(at), b))
    for n in SIZES:
        hashes, valid = t.grams(n)
        at = np.flatnonzero(valid)
        owner.append(t.owner(at))
        bucket.append(_buckets(hashes[at]))
    key, count = np.unique((np.concatenate(owner) << BITS) | np.concatenate(bucket), return_counts=True)
    cut = np.searchsorted(key >> BITS, np.arange(len(texts) + 1))
    return [(key[a:b] & ((1 << BITS) - 1), count[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]


@dataclass
class Model:
    """Per bucket the difference of the class scores, and that of the layer's own terms."""

    weights: np.ndarray
    bias: float
    prior: float


def train(rows: list[tuple[np.ndarray, np.ndarray]], good: np.ndarray) -> Model:
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (1 << BITS, DIM))
    layer, bias = rng.uniform(-0.5, 0.5, (DIM, 2)), np.zeros(2)
    past, past_layer, past_bias = np.full(1 << BITS, 1e-4), 1e-4, 1e-4
    prior = (good.sum() + 1) / (len(good) + 2)
    if len(good) == 0:
        return Model(np.zeros(1 << BITS), 0.0, 0.5)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            ids, counts = rows[i]
            if not len(ids):
                continue
            share = counts / counts.sum()
            mean = share @ vectors[ids]
            z = mean @ layer + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[int(good[i])] -= 1  # gradient of the loss by the scores
            back = layer @ p
            past_layer += (p @ p) * (mean @ mean)
            past_bias += p @ p
            layer -= STEP_SIZE / np.sqrt(past_layer) * np.outer(mean, p)
            bias -= STEP_SIZE / np.sqrt(past_bias) * p
            past[ids] += share**2 * (back @ back)
            vectors[ids] -= (STEP_SIZE * share / np.sqrt(past[ids]))[:, None] * back
    return Model((vectors @ (layer[:, 1] - layer[:, 0])).astype(np.float32), float(bias[1] - bias[0]), float(prior))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        where: Column | None = None, max_train: int = MAX_TRAIN) -> Model:
    """The model of at most ``max_train`` labelled rows (those for which ``where`` holds)."""
    chosen = sample(labels, id_col, label_col, max_train, where)
    texts = one_text(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), chosen)

    def run(batches):
        for batch in batches:
            _, offsets = K.text_bytes(batch.column(2))
            for lo, hi in K.row_groups(offsets):
                part = batch.slice(lo, hi - lo)
                found = text_buckets(part.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.string()), part.column(1), pa.array([a.astype(np.uint32).tobytes() for a, _ in found], pa.binary()),
                     pa.array([b.astype(np.uint16 if b.max(initial=0) < 65536 else np.uint32).tobytes() for _, b in found], pa.binary())],
                    names=["id", "label", "ids", "counts"])

    K.bounded_batches(docs.sparkSession)
    rows = texts.mapInArrow(run, "id string, label int, ids binary, counts binary").toPandas().sort_values(["id", "ids"])
    bags = []
    for a, b in zip(rows["ids"], rows["counts"], strict=True):
        ids = np.frombuffer(a, np.uint32).astype(np.int64)
        bags.append((ids, np.frombuffer(b, np.uint16 if len(b) == 2 * len(ids) else np.uint32).astype(np.float64)))
    return train(bags, rows["label"].to_numpy() == 1)


def score_texts(texts: list[str | None], model: Model) -> np.ndarray:
    t = Texts(texts)
    values, extra = model.weights[_buckets(t.words.hashes)].astype(float), np.ones(len(t.words.hashes))
    for b, at in _repeats(t):
        values[at] += model.weights[b]
        extra[at] += 1
    total, count = t.word_sums(values), t.word_sums(extra)
    for n in SIZES:
        hashes, valid = t.grams(n)
        total += t.sums(np.where(valid, model.weights[_buckets(hashes)], 0))
        count += t.sums(valid)
    z = total / np.maximum(count, 1) + model.bias
    return np.where(count > 0, 1 / (1 + np.exp(-np.clip(z, -40, 40))), model.prior)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``score`` (0 to 1, higher: good likelier) of every row, over whole texts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        _, offsets = K.text_bytes(batch.column(1))
        parts = [score_texts(batch.column(1).slice(lo, hi - lo).to_pylist(), shared.value) for lo, hi in K.row_groups(offsets)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(parts), pa.float64())], names=[id_col, "score"])

    return K.text_map(docs.select(id_col, text_col), run, f"{id_col} {kind}, score double")
