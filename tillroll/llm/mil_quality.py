"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words. Each passage is
described by shares of character classes and of kinds of words, by word
lengths and by repetition within the passage, and encoded by a tanh layer.
Gated attention (tanh and sigmoid branches, multiplied) weighs the passages;
the weighted sum of the encodings gives the document's score. All weights are
learned together from document labels, so which passages decide is learned
as well. Inputs are the text alone.

Fitting takes at most ``SAMPLE`` labelled documents, half of each class where
there are as many, the smallest by a hash of their id, weighted back to the
shares of all labelled rows. Fitting, like scoring, reads every passage of a
document; the driver holds ``FEATURES`` small floats for each passage of the
fitted documents, a step's passages go through the model in parts.

Results: one row per row. Null text counts as empty; an empty text is one
empty passage. Labels without a class or id are left out; a document labelled
more than once has its mean label, from a half on 1. Without labels of both
classes every score is the share of label 1 (1 if there is no label). Null or
repeated ids are rows like any other. An empty table gives no rows. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import crc32_of_id, id_and_text, slices

PASSAGE = 64
SAMPLE = 8000
ACCEPT = 0.7
HIDDEN, GATES, STEPS, BATCH, RATE = 16, 8, 900, 256, 0.01

# Character classes: lower, upper, digit, space, line end, stop, quote, bracket, other sign, byte of other letters.
_CLASS = np.full(256, 8, np.uint8)
for _members, _number in ((b"abcdefghijklmnopqrstuvwxyz", 0), (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 1), (b"0123456789", 2),
                          (b" \t", 3), (b"\r\n", 4), (b".,;:?", 5), (b"\"'`", 6), (b"()[]{}<>", 7),
                          (bytes(range(128, 256)), 9)):
    _CLASS[list(_members)] = _number
CLASSES = 10
FEATURES = CLASSES + 11


def passage_features(words: list[str]) -> list[float]:
    """Numbers that describe a passage."""
    if not words:
        return [0.0] * (FEATURES - 1) + [1.0]
    n = len(words)
    signs = np.frombuffer(" ".join(words).encode(), np.uint8)
    shares = np.bincount(_CLASS[signs], minlength=CLASSES) / len(signs)
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    lengths = list(map(len, words))
    mean = sum(lengths) / n
    pairs = len(set(zip(words, words[1:])))
    return [
        *shares.tolist(),
        len(counts) / n,
        max(counts.values()) / n,
        pairs / max(1, n - 1),
        min(mean, 40.0) / 10,
        min(max(lengths), 60) / 20,
        min(sum((x - mean) ** 2 for x in lengths) / n, 100.0) / 20,
        sum(map(str.isupper, words)) / n,
        sum(map(str.isalpha, words)) / n,
        sum(not any(map(str.isalnum, w)) for w in words) / n,
        np.log1p(n) / 4,
        0.0,
    ]


def bag(text: str) -> np.ndarray:
    """Features of the passages of a text."""
    words = text.split()
    starts = list(range(0, len(words), PASSAGE)) or [0]
    return np.array([passage_features(words[a:a + PASSAGE]) for a in starts])


class Model:
    """Encoder, gated attention and output; ``parameters`` in a dict."""

    def __init__(self, parameters: dict[str, np.ndarray]):
        self.p = parameters

    @staticmethod
    def fresh(seed: int = 7) -> "Model":
        r = np.random.default_rng(seed)

        def weights(a: int, b: int) -> np.ndarray:
            return r.normal(0, a ** -0.5, (a, b))

        return Model({
            "mean": np.zeros(FEATURES), "scale": np.ones(FEATURES),
            "W": weights(FEATURES, HIDDEN), "b": np.zeros(HIDDEN),
            "V": weights(HIDDEN, GATES), "U": weights(HIDDEN, GATES), "w": weights(GATES, 1)[:, 0],
            "c": weights(HIDDEN, 1)[:, 0], "d": np.zeros(1),
        })

    def forward(self, x: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> tuple:
        p = self.p
        e = np.tanh(np.clip((x - p["mean"]) / p["scale"], -6, 6) @ p["W"] + p["b"])
        t, s = np.tanh(e @ p["V"]), 1 / (1 + np.exp(-(e @ p["U"])))
        logit = (t * s) @ p["w"]
        a = np.exp(logit - np.repeat(np.maximum.reduceat(logit, begins), sizes))
        a /= np.repeat(np.add.reduceat(a, begins), sizes)
        z = np.add.reduceat(a[:, None] * e, begins)
        return e, t, s, a, z, 1 / (1 + np.exp(-(z @ p["c"] + p["d"][0])))

    def score(self, bags: list[np.ndarray]) -> np.ndarray:
        sizes = np.array([len(b) for b in bags])
        return self.forward(np.concatenate(bags), np.cumsum(sizes) - sizes, sizes)[-1]

    def gradient(self, x, begins, sizes, label, weight) -> dict[str, np.ndarray]:
        p = self.p
        e, t, s, a, z, y = self.forward(x, begins, sizes)
        dy = weight * (y - label) / weight.sum()
        dz = np.repeat(dy[:, None] * p["c"], sizes, axis=0)
        da = (dz * e).sum(1)
        dlogit = a * (da - np.repeat(np.add.reduceat(a * da, begins), sizes))
        dt = dlogit[:, None] * p["w"] * s * (1 - t * t)
        ds = dlogit[:, None] * p["w"] * t * s * (1 - s)
        de = (a[:, None] * dz + dt @ p["V"].T + ds @ p["U"].T) * (1 - e * e)
        scaled = np.clip((x - p["mean"]) / p["scale"], -6, 6)
        return {"W": scaled.T @ de, "b": de.sum(0), "V": e.T @ dt, "U": e.T @ ds, "w": (t * s).T @ dlogit,
                "c": z.T @ dy, "d": np.array([dy.sum()])}


def fit(bags: list[np.ndarray], labels: np.ndarray, weights: np.ndarray, seed: int = 7) -> Model:
    """Adam on mini-batches; the same bags give the same model."""
    model, r = Model.fresh(seed), np.random.default_rng(seed)
    whole = np.concatenate(bags)
    model.p["mean"], model.p["scale"] = whole.mean(0), whole.std(0) + 0.02
    first = {k: np.zeros_like(v) for k, v in model.p.items()}
    second = {k: np.zeros_like(v) for k, v in model.p.items()}
    for step in range(1, STEPS + 1):
        chosen = r.choice(len(bags), min(BATCH, len(bags)), replace=False)
        sizes = np.array([len(bags[i]) for i in chosen])
        x = np.concatenate([bags[i] for i in chosen])
        slope = model.gradient(x, np.cumsum(sizes) - sizes, sizes, labels[chosen], weights[chosen])
        rate = RATE * (1 - 0.9 * step / STEPS)
        for k, g in slope.items():
            g = g + 1e-4 * model.p[k]
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            model.p[k] = model.p[k] - rate * (first[k] / (1 - 0.9 ** step)) / (
                np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    return model


def _bag_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in slices(batch):
            bags = [bag(t).astype(np.float32).tobytes() for t in rows.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(bags, pa.binary())],
                                             ["doc_id", "passages"])


def learn(docs: DataFrame, labels: DataFrame, usable: Column | None = None, sample: int = SAMPLE) -> Model | float:
    """Fits the classifier, from rows of ``labels`` (doc_id, quality) that
    satisfy ``usable``; a share if there are not both classes."""
    known = labels.filter("doc_id is not null and quality is not null")
    if usable is not None:
        known = known.filter(usable)
    known = known.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    totals = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(totals) < 2:
        return float(max(totals, default=1))
    halves = [known.filter(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample // 2) for c in (0, 1)]
    chosen = halves[0].unionByName(halves[1])
    texts = id_and_text(docs)
    chosen_texts = texts.join(F.broadcast(chosen), "doc_id")  # at most ``sample`` small rows
    rows = chosen_texts.select("doc_id", "text", "label")
    bags = rows.select("doc_id", "text").mapInArrow(_bag_batches, "doc_id long, passages binary")
    label = {r["doc_id"]: r["label"] for r in chosen.collect()}
    found = sorted((r["doc_id"], bytes(r["passages"])) for r in bags.toLocalIterator())
    y = np.array([label[i] for i, _ in found], float)
    if len(set(y)) < 2:
        return float(y.mean()) if len(y) else 1.0
    weights = np.array([totals[int(c)] / max(1, (y == c).sum()) for c in y])
    return fit([np.frombuffer(p, np.float32).reshape(-1, FEATURES) for _, p in found], y, weights)


def _score_batches(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        for batch in batches:
            for rows in slices(batch):
                texts = rows.column(1).to_pylist()
                scores = np.full(len(texts), own) if isinstance(own, float) else own.score([bag(t) for t in texts])
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return run


def quality_scores(docs: DataFrame, model: Model | float) -> DataFrame:
    """``doc_id, score`` of every row: the probability of label 1."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # a few hundred numbers
    return id_and_text(docs).mapInArrow(_score_batches(held), "doc_id long, score double")


def held_out(column: str = "doc_id") -> Column:
    """Rows the classifier is not fitted on."""
    return F.coalesce(crc32_of_id(column) % 4 == 2, F.lit(False))


def _keep_batches(model, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        for batch in batches:
            for rows in slices(batch):
                texts = [t or "" for t in rows.column(rows.schema.get_field_index("text")).to_pylist()]
                scores = np.full(len(texts), own) if isinstance(own, float) else own.score([bag(t) for t in texts])
                yield rows.filter(pa.array(scores >= least))

    return run


def keep_quality(docs: DataFrame, model: Model | float, least: float = ACCEPT) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, all columns."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_keep_batches(held, least), docs.schema)
