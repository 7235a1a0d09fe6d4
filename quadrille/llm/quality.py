"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages. Every passage of the whole text is encoded (shares of byte classes and of hashed byte
pairs, through a learned tanh layer); gated attention weighs the passages, and a logistic layer scores the weighted
passage. Only document labels are used. The model is fitted on a bounded sample of labelled rows; scoring is one pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quadrille.llm.words import FOLD, chunks, mix, releasing, text_buffers

#: Bytes of a passage.
PASSAGE = 400
#: Labelled rows that the model is fitted on, half of each label where there are enough; and the most passages, spread
#: evenly over the text, that one of them brings into the fit. Scoring reads all passages of all texts.
MOST_LABELLED = 3000
PAIR_BUCKETS = 256
HIDDEN, GATE = 24, 12

_CLASS = np.zeros(256, np.int64)
_CLASS[97:123] = np.arange(26)
_CLASS[65:91] = 26
_CLASS[48:58] = 27
_marks = [b for b in range(33, 127) if not chr(b).isalnum()]
_CLASS[_marks] = 28 + np.arange(len(_marks))
_CLASS[32], _CLASS[10] = 60, 61
_CLASS[[b for b in range(32) if b != 10] + [127]] = 62
_CLASS[128:192], _CLASS[192:224], _CLASS[224:240], _CLASS[240:256] = 63, 64, 65, 66
CLASSES = 67
FEATURES = CLASSES + PAIR_BUCKETS
_PAIR = (mix(np.arange(1 << 16, dtype=np.uint64)) % np.uint64(PAIR_BUCKETS)).astype(np.int64)


def passage_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage, and the index of each text's first passage (plus the total). An empty text has one."""
    sizes = np.diff(offsets)
    count = np.maximum(1, -(-sizes // PASSAGE))
    first = np.concatenate(([0], np.cumsum(count)))
    place = np.arange(len(data)) - np.repeat(offsets[:-1], sizes)
    owner = np.repeat(first[:-1], sizes) + place // PASSAGE
    total = int(first[-1])
    classes = np.bincount(owner * CLASSES + _CLASS[data], minlength=total * CLASSES).reshape(total, CLASSES)
    folded = FOLD[data].astype(np.int64)
    inner = np.flatnonzero(place[1:] > 0) + 1
    pair = _PAIR[(folded[inner - 1] << 8) | folded[inner]]
    pairs = np.bincount(owner[inner] * PAIR_BUCKETS + pair, minlength=total * PAIR_BUCKETS).reshape(total, PAIR_BUCKETS)
    size = np.maximum(1, classes.sum(1, keepdims=True))
    return np.sqrt(np.concatenate((classes, pairs), 1) / size, dtype=np.float32), first


class Model:
    """Weights of the encoder, the gated attention and the scorer."""

    def __init__(self, seed: int = 7):
        draw = np.random.default_rng(seed)
        shapes = {"w": (FEATURES, HIDDEN), "b": (HIDDEN,), "v": (HIDDEN, GATE), "u": (HIDDEN, GATE), "a": (GATE,), "c": (HIDDEN,), "d": (1,)}
        self.weights = {n: (draw.standard_normal(s) / np.sqrt(s[0]) if len(s) > 1 or n in "ac" else np.zeros(s)).astype(np.float32) for n, s in shapes.items()}

    def forward(self, x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        p = self.weights
        starts, sizes = first[:-1], np.diff(first)
        hidden = np.tanh(x @ p["w"] + p["b"])
        tanh, gate = np.tanh(hidden @ p["v"]), 1 / (1 + np.exp(-(hidden @ p["u"])))
        logit = (tanh * gate) @ p["a"]
        power = np.exp(logit - np.repeat(np.maximum.reduceat(logit, starts), sizes))
        attention = power / np.repeat(np.add.reduceat(power, starts), sizes)
        bag = np.add.reduceat(attention[:, None] * hidden, starts)
        score = 1 / (1 + np.exp(-np.clip(bag @ p["c"] + p["d"], -30, 30)))
        return {"hidden": hidden, "tanh": tanh, "gate": gate, "attention": attention, "bag": bag, "score": score}

    def gradients(self, x, first, y, share) -> dict[str, np.ndarray]:
        p, f = self.weights, self.forward(x, first)
        sizes = np.diff(first)
        error = ((f["score"] - y) * share).astype(np.float32)
        bag = np.repeat(error[:, None] * p["c"], sizes, 0)
        hidden = f["attention"][:, None] * bag
        toward = (f["hidden"] * bag).sum(1)
        mean = np.repeat(np.add.reduceat(f["attention"] * toward, first[:-1]), sizes)
        logit = f["attention"] * (toward - mean)
        gated = logit[:, None] * p["a"]
        tanh = gated * f["gate"] * (1 - f["tanh"] ** 2)
        gate = gated * f["tanh"] * f["gate"] * (1 - f["gate"])
        hidden = (hidden + tanh @ p["v"].T + gate @ p["u"].T) * (1 - f["hidden"] ** 2)
        return {
            "w": x.T @ hidden, "b": hidden.sum(0), "v": f["hidden"].T @ tanh, "u": f["hidden"].T @ gate,
            "a": (f["tanh"] * f["gate"]).T @ logit, "c": f["bag"].T @ error, "d": error.sum(keepdims=True),
        }

    def fit(self, x: np.ndarray, first: np.ndarray, y: np.ndarray, *, epochs: int = 60, batch: int = 128, rate: float = 3e-3, decay: float = 1e-4) -> Model:
        """Adam on shuffled batches; both labels weigh the same."""
        draw = np.random.default_rng(11)
        share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
        moment = {n: (np.zeros_like(w), np.zeros_like(w)) for n, w in self.weights.items()}
        step = 0
        for _ in range(epochs):
            order = draw.permutation(len(y))
            for at in range(0, len(y), batch):
                own = order[at : at + batch]
                sizes = first[own + 1] - first[own]
                rows = np.repeat(first[own] - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())
                found = self.gradients(x[rows], np.concatenate(([0], np.cumsum(sizes))), y[own], share[own] / len(own))
                step += 1
                for n, g in found.items():
                    g = g + decay * self.weights[n]
                    m, v = moment[n]
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    self.weights[n] -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        return self


def held_out(key: str = "doc_id"):
    """Whether a row is kept from the fit: crc32 of its id as text, modulo 3, is 1. A null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % 3 == 1


def _encoding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        x, first = passage_features(*text_buffers(batch.column("text")))
        rows = []
        for a, b in zip(first[:-1], first[1:]):
            rows.append(x[a:b].astype(np.float16).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), pa.array(rows)], names=["doc_id", "quality", "passages"])


def fit_quality(docs: DataFrame, labels: DataFrame, *, label: str = "quality", key: str = "doc_id", most: int = MOST_LABELLED) -> Model:
    """Fits on up to ``most`` labelled rows that are not held out; which ones is decided by a hash of their id.

    Labels other than 0 and 1 and rows without an id are left out; of an id with several labels the lowest counts.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull() & ~held_out(key)).groupBy(F.col(key).cast("long").alias("doc_id"))
    known = known.agg(F.min(F.col(label).cast("int")).alias("quality"))
    halves = [known.where(F.col("quality") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most // 2) for k in (0, 1)]
    chosen = F.broadcast(halves[0].unionByName(halves[1]))  # at most ``most`` rows of two numbers
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(chosen, "doc_id")
    found = texts.mapInArrow(releasing(_encoding), "doc_id long, quality int, passages binary").collect()
    model = Model()
    if not found:
        return model
    found.sort(key=lambda r: (r.doc_id, bytes(r.passages)))
    bags = [np.frombuffer(r.passages, np.float16).reshape(-1, FEATURES) for r in found]
    first = np.concatenate(([0], np.cumsum([len(b) for b in bags])))
    return model.fit(np.concatenate(bags).astype(np.float32), first, np.array([r.quality for r in found]))


def _scoring(shared, text: str, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in chunks(batches, text, most=1 << 20):
            score = model.forward(*passage_features(*text_buffers(batch.column(text))))["score"].astype(np.float64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names=[*batch.schema.names, name])

    return run


def with_quality(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with the score of each text (a column of that name is replaced); one pass without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop(name)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    return docs.mapInArrow(releasing(_scoring(shared, "text", name)), schema)


def quality_scores(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.5, key: str = "doc_id") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    Null texts are empty texts, which have one empty passage and a score like any other. Null and repeated ids are
    kept. Without labelled rows the model stays as it was drawn. An empty table gives no rows; other columns are ignored.
    """
    model = fit_quality(docs, labels, key=key)
    scored = with_quality(docs.select(F.col(key).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), model)
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
