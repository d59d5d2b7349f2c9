"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages. Every passage is encoded; gated attention gives it a weight within its document; the
weighted sum of the encodings is scored. Only documents have labels: which passages matter is learned with the rest.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilake.llm.texts import map_arrow, utf8

PASSAGE_BYTES = 512
TRAINING_DOCS = 2_000     # labelled documents at most that the model is fitted on, those with the smallest hash
TRAINING_BYTES = 32_768   # of a training document's text at most; scoring always reads whole texts
HIDDEN, GATE = 24, 12
EPOCHS, BATCH, RATE, DECAY, SEED = 30, 128, 0.01, 1e-4, 5
ACCEPT = 0.7

_SYMBOLS = b"!|%#*$&@=+<>/\\{}[]^~`_\"'()?;:-,."
_UPPER, _LOWER, _DIGIT, _SPACE, _LINE, _WIDE, _MARK, _OTHER = range(8)
_LAGS = tuple(range(2, 25))
_CLASS = np.full(256, _OTHER, dtype=np.uint8)
_CLASS[[b for b in range(256) if chr(b).isupper() and b < 128]] = _UPPER
_CLASS[[b for b in range(256) if chr(b).islower() and b < 128]] = _LOWER
_CLASS[list(b"0123456789")] = _DIGIT
_CLASS[list(b" \t")] = _SPACE
_CLASS[list(b"\r\n")] = _LINE
_CLASS[128:] = _WIDE
_CLASS[list(b".,;:?'\"-()")] = _MARK
_SYMBOL = np.full(256, len(_SYMBOLS), dtype=np.uint8)
_SYMBOL[list(_SYMBOLS)] = np.arange(len(_SYMBOLS))
WIDTH = 8 + 64 + len(_SYMBOLS) + 4


def passages(data: bytes) -> np.ndarray:
    """One row of WIDTH features per passage of PASSAGE_BYTES bytes; an empty text is one passage of nothing."""
    n = len(data)
    if n == 0:
        return np.zeros((1, WIDTH), dtype=np.float32)
    raw = np.frombuffer(data, dtype=np.uint8)
    starts = np.arange(0, n, PASSAGE_BYTES)
    bags = len(starts)
    size = np.diff(np.append(starts, n)).astype(np.float32)
    place = np.repeat(np.arange(bags, dtype=np.int32), size.astype(np.int64))
    kind = _CLASS[raw]
    out = np.empty((bags, WIDTH), dtype=np.float32)
    pair = np.bincount(place[1:] * 64 + kind[:-1] * np.int32(8) + kind[1:], minlength=bags * 64)[:bags * 64].reshape(bags, 64)
    out[:, :8] = np.bincount(place * 8 + kind, minlength=bags * 8).reshape(bags, 8)
    out[:, 8:72] = pair
    marks = len(_SYMBOLS)
    out[:, 72:72 + marks] = np.bincount(place * np.int32(marks + 1) + _SYMBOL[raw], minlength=bags * (marks + 1)).reshape(bags, -1)[:, :marks]
    out[:, :72 + marks] /= size[:, None]
    # how much repeats at a fixed distance: repeated words and lines
    best, total = np.zeros(bags, dtype=np.float32), np.zeros(bags, dtype=np.float32)
    for lag in _LAGS:
        if lag >= n:
            break
        same = np.add.reduceat(np.concatenate([raw[lag:] == raw[:-lag], np.zeros(lag, dtype=bool)]), starts, dtype=np.int32) / size
        best = np.maximum(best, same)
        total += same
    out[:, -4] = best
    out[:, -3] = total / len(_LAGS)
    out[:, -2] = np.log1p(size) / 7
    words = out[:, _SPACE] + out[:, _LINE] + 1 / size
    out[:, -1] = np.minimum(3.0, np.log1p((1 - words) / words))
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class AttentionModel:
    """Encoder, gated attention and scorer, with the scaling of the features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, dict]:
        """Scores of bags whose passages lie one after another from ``starts`` on, and what the gradient needs."""
        w = self.weights
        x = (x - self.mean) / self.scale
        encoded = np.tanh(x @ w["E"] + w["e"])
        view, gate = np.tanh(encoded @ w["V"]), _sigmoid(encoded @ w["U"])
        raw = (view * gate) @ w["a"]
        bag = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(x))))
        shifted = np.exp(raw - np.maximum.reduceat(raw, starts)[bag])
        attention = shifted / np.add.reduceat(shifted, starts)[bag]
        pooled = np.add.reduceat(encoded * attention[:, None], starts, axis=0)
        score = _sigmoid(pooled @ w["c"] + w["b"])
        return score, {"x": x, "encoded": encoded, "view": view, "gate": gate, "bag": bag, "attention": attention, "pooled": pooled}

    def gradient(self, seen: dict, error: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of the mean cross entropy; ``error`` is (score - label) / bags."""
        w, bag, encoded, attention = self.weights, seen["bag"], seen["encoded"], seen["attention"]
        view, gate = seen["view"], seen["gate"]
        d_pooled = error[:, None] * w["c"]
        d_attention = (d_pooled[bag] * encoded).sum(axis=1)
        inner = np.add.reduceat(attention * d_attention, starts)
        d_raw = attention * (d_attention - inner[bag])
        d_view = d_raw[:, None] * w["a"] * gate * (1 - view**2)
        d_gate = d_raw[:, None] * w["a"] * view * gate * (1 - gate)
        d_encoded = attention[:, None] * d_pooled[bag] + d_view @ w["V"].T + d_gate @ w["U"].T
        d_hidden = d_encoded * (1 - encoded**2)
        return {"E": seen["x"].T @ d_hidden, "e": d_hidden.sum(axis=0), "V": encoded.T @ d_view, "U": encoded.T @ d_gate,
                "a": (view * gate).T @ d_raw, "c": seen["pooled"].T @ error, "b": np.array(error.sum())}


def train(bags: list[np.ndarray], labels: np.ndarray) -> AttentionModel:
    """Fit with Adam; same bags and labels give the same model."""
    rng = np.random.default_rng(SEED)
    every = np.concatenate(bags)
    std = every.std(axis=0)
    shape = {"E": (every.shape[1], HIDDEN), "e": HIDDEN, "V": (HIDDEN, GATE), "U": (HIDDEN, GATE), "a": GATE, "c": HIDDEN, "b": ()}
    weights = {k: rng.normal(0, 0.2 if k != "E" else every.shape[1] ** -0.5, s) if k not in "eb" else np.zeros(s) for k, s in shape.items()}
    model = AttentionModel(every.mean(axis=0), np.where(std > 1e-6, std, 1.0), weights)
    first, second, step = {k: 0.0 for k in weights}, {k: 0.0 for k in weights}, 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(bags))
        rate = RATE * 0.5 * (1 + np.cos(np.pi * epoch / EPOCHS))
        for at in range(0, len(order), BATCH):
            chosen = order[at:at + BATCH]
            sizes = np.array([len(bags[i]) for i in chosen])
            starts = np.cumsum(sizes) - sizes
            score, seen = model.forward(np.concatenate([bags[i] for i in chosen]), starts)
            slopes = model.gradient(seen, (score - labels[chosen]) / len(chosen), starts)
            step += 1
            for k, slope in slopes.items():
                slope = slope + DECAY * model.weights[k]
                first[k] = 0.9 * first[k] + 0.1 * slope
                second[k] = 0.999 * second[k] + 0.001 * slope**2
                model.weights[k] = model.weights[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return model


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = TRAINING_DOCS) -> AttentionModel | None:
    """Model from ``docs`` (doc_id, text) and ``labels`` (doc_id, label 0 or 1; other labels don't count); None without both.

    Half of ``most`` labels per class at most are used, in the order of a hash of the id; the shift of the class shares is
    taken back afterwards, so scores follow the labels' own frequency. Only the sample's texts are read on.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).select("doc_id", F.col(label).cast("int").alias("label"))
    counts = {r[0]: r[1] for r in known.groupBy("label").count().collect()}
    if len(counts) < 2:
        return None
    hashed = known.withColumn("h", F.xxhash64("doc_id"))
    part = lambda value: hashed.filter(F.col("label") == value).orderBy("h", "doc_id").limit(most // 2)
    chosen = part(0).unionByName(part(1)).select("doc_id", "label").dropDuplicates(["doc_id"])  # at most ``most`` rows
    texts = docs.select("doc_id", F.substring(utf8(), 1, TRAINING_BYTES).alias("text"))
    rows = _features(texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label")).orderBy("doc_id", "features").collect()
    used = {value: sum(r[2] == value for r in rows) for value in (0, 1)}
    if not all(used.values()):
        return None
    bags = [np.frombuffer(r[1], dtype=np.float32).reshape(-1, WIDTH) for r in rows]
    model = train(bags, np.array([r[2] for r in rows], dtype=np.float64))
    model.weights["b"] = model.weights["b"] + np.log(counts[1] / counts[0]) - np.log(used[1] / used[0])
    return model


def _features(rows: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            data = [passages(t.as_py()).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary()), batch.column(2)], names=["doc_id", "features", "label"])

    return map_arrow(rows, run, "doc_id bigint, features binary, label int")


def score_quality(docs: DataFrame, model: AttentionModel | None, accept: float = ACCEPT) -> DataFrame:
    """(doc_id, score, predicted) of every row of ``docs`` (doc_id bigint, text string; further columns are ignored).

    The whole text counts; a null text is an empty one and is scored as one empty passage. Without a model every score is
    0.5. Repeated and null ids each keep their row; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for batch in batches:
            bags = [passages(t.as_py()) for t in batch.column(1)]
            if model is None or not bags:
                scores = np.full(len(bags), 0.5)
            else:
                sizes = np.array([len(b) for b in bags])
                scores, _ = model.forward(np.concatenate(bags), np.cumsum(sizes) - sizes)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), utf8().alias("text"))
    return map_arrow(rows, run, "doc_id bigint, score double").withColumn("predicted", (F.col("score") >= accept).cast("int"))
