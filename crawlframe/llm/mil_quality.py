"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of a fixed number of words. Every passage becomes a vector: the mix of
word shapes (class of the first and last character, length), shares of character classes, and how
often words repeat. A small layer encodes it; gated attention (tanh times sigmoid) weighs the encoded
passages against each other; the score comes from the weighted sum, so one bad passage of a long
document can count as much as it should. Weights are learned from document labels alone.

The fit uses a bounded sample of labelled documents on the driver: the first ``FIT_DOCUMENTS`` by hash, each with all its passages,
up to the one that fills ``FIT_PASSAGES``. Scoring is one pass over whole texts
without a shuffle; all passages of a document are encoded.

Cases: null or empty text is a bag of one passage without words and is scored like any other; repeated
rows have equal scores; of several texts of a labelled doc_id that of the least hash is learned; repeated labels of a document count once (the least); labels that are null are
left out; without labels of both kinds every score is the share of label 1, or 0.5 without any; an
empty table gives an empty result; other columns are no input.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlframe.llm.shared import store, text_of
from crawlframe.llm.words import WordSlice, text_slices

PASSAGE_WORDS = 96
#: Bounds of the sample a model is fitted on.
FIT_DOCUMENTS, FIT_PASSAGES = 4000, 40_000
HIDDEN, ATTENTION = 16, 8
EPOCHS, RATE, DECAY = 250, 0.02, 1e-4

# classes: lower, upper, digit, sentence mark, other sign, beyond ASCII
_CLASS = np.full(256, 4, np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 0, 1, 2, 5
for _c in ".,;:?'\"-()":
    _CLASS[ord(_c)] = 3
_N_CLASS, _N_LENGTH = 6, 4
_SHAPES = _N_CLASS * _N_CLASS * _N_LENGTH
FEATURES = _SHAPES + _N_CLASS + 4


def passages(part: WordSlice, raw: np.ndarray, size: int = PASSAGE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows of all passages of a slice in order, and the number of passages of each document (one at least)."""
    words = np.diff(part.first)
    per_doc = np.maximum(1, -(-words // size))
    first = np.cumsum(per_doc) - per_doc
    n = int(per_doc.sum())
    doc = np.repeat(np.arange(len(words)), words)
    own = first[doc] + (np.arange(len(doc)) - part.first[doc]) // size
    count = np.maximum(np.bincount(own, minlength=n), 1)[:, None]
    lengths = part.ends - part.starts
    kind = _CLASS[raw]
    head, tail = kind[part.starts].astype(np.int64), kind[part.ends - 1]
    bucket = np.minimum(lengths // 4, _N_LENGTH - 1)
    shape = (head * _N_CLASS + tail) * _N_LENGTH + bucket
    shapes = np.bincount(own * _SHAPES + shape, minlength=n * _SHAPES).reshape(n, _SHAPES) / count
    classes = np.empty((n, _N_CLASS))
    size_of = np.bincount(own, lengths, minlength=n)
    for c in range(_N_CLASS):
        total = np.concatenate([[0], np.cumsum(kind == c, dtype=np.int64)])
        classes[:, c] = np.bincount(own, total[part.ends] - total[part.starts], minlength=n)
    classes /= np.maximum(size_of, 1)[:, None]
    h = part.hashes()
    by = np.lexsort((h, own))
    again = np.zeros(len(h), bool)
    again[1:] = (h[by][1:] == h[by][:-1]) & (own[by][1:] == own[by][:-1])
    repeats = np.bincount(own[by], again, minlength=n)[:, None] / count
    bare = np.bincount(own, (lengths == 1) & (head >= 3), minlength=n)[:, None] / count
    extra = [repeats, bare, np.log1p(size_of)[:, None] / 8, size_of[:, None] / count / 10]
    return np.hstack([shapes, classes, *extra]), per_doc


@dataclass
class Model:
    """Weights of the encoder, the gated attention and the score."""

    mean: np.ndarray
    spread: np.ndarray
    weights: dict[str, np.ndarray]
    constant: float | None = None

    def scores(self, x: np.ndarray, per_doc: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(per_doc), self.constant)
        return forward(self.weights, (x - self.mean) / self.spread, per_doc)["p"]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def forward(w: dict[str, np.ndarray], x: np.ndarray, per_doc: np.ndarray) -> dict[str, np.ndarray]:
    starts = np.cumsum(per_doc) - per_doc
    h = np.tanh(x @ w["W"] + w["b"])
    t, g = np.tanh(h @ w["V"]), _sigmoid(h @ w["U"])
    e = (t * g) @ w["a"]
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), per_doc))
    attention = e / np.repeat(np.add.reduceat(e, starts), per_doc)
    z = np.add.reduceat(attention[:, None] * h, starts)
    return {"h": h, "t": t, "g": g, "attention": attention, "z": z, "p": _sigmoid(z @ w["c"] + w["d"][0])}


def fit(x: np.ndarray, per_doc: np.ndarray, y: np.ndarray, epochs: int = EPOCHS) -> Model:
    """Adam on the mean log loss, both labels weighing the same."""
    if len(y) == 0 or y.min() == y.max():
        return Model(np.zeros(FEATURES), np.ones(FEATURES), {}, float(y.mean()) if len(y) else 0.5)
    mean, spread = x.mean(0), x.std(0) + 0.02
    x = (x - mean) / spread
    rng = np.random.default_rng(7)
    sizes = {"W": (FEATURES, HIDDEN), "b": (HIDDEN,), "V": (HIDDEN, ATTENTION), "U": (HIDDEN, ATTENTION), "a": (ATTENTION,), "c": (HIDDEN,), "d": (1,)}
    w = {k: rng.normal(0, 1 / np.sqrt(s[0]), s) if k not in "bd" else np.zeros(s) for k, s in sizes.items()}
    m, v = ({k: np.zeros(s) for k, s in sizes.items()} for _ in range(2))
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    starts = np.cumsum(per_doc) - per_doc
    for step in range(1, epochs + 1):
        f = forward(w, x, per_doc)
        do = (f["p"] - y) * weight
        grad = {"c": f["z"].T @ do, "d": np.array([do.sum()])}
        dz = np.repeat(do[:, None] * w["c"], per_doc, axis=0)
        alpha, h, t, g = f["attention"], f["h"], f["t"], f["g"]
        da = (dz * h).sum(1)
        de = alpha * (da - np.repeat(np.add.reduceat(alpha * da, starts), per_doc))
        grad["a"] = (t * g).T @ de
        dt, dg = de[:, None] * w["a"] * g * (1 - t * t), de[:, None] * w["a"] * t * g * (1 - g)
        grad["V"], grad["U"] = h.T @ dt, h.T @ dg
        dh = (dz * alpha[:, None] + dt @ w["V"].T + dg @ w["U"].T) * (1 - h * h)
        grad["W"], grad["b"] = x.T @ dh, dh.sum(0)
        for k in w:
            grad[k] = grad[k] + DECAY * w[k]
            m[k] = 0.9 * m[k] + 0.1 * grad[k]
            v[k] = 0.999 * v[k] + 0.001 * grad[k] ** 2
            w[k] = w[k] - RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return Model(mean, spread, w)


def _slices(column: pa.Array) -> Iterator[tuple[WordSlice, np.ndarray, np.ndarray]]:
    for part in text_slices(column):
        yield part, *passages(part, part.raw)


def fit_on_labels(docs: DataFrame, labels: DataFrame, used: Column, documents: int = FIT_DOCUMENTS, most: int = FIT_PASSAGES) -> Model:
    """A model from ``labels`` (doc_id, label) of the rows that meet ``used`` (a condition on doc_id)."""
    own = labels.filter(used & F.col("label").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("label").alias("label"))
    place = F.xxhash64("doc_id")
    sample = own.orderBy(place, "doc_id").limit(documents)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, x, per_doc in _slices(batch.column(2)):
                ends = np.cumsum(per_doc)
                rows = [x[e - k : e].astype(np.float32).tobytes() for e, k in zip(ends, per_doc, strict=True)]
                at, n = part.rows.start, len(part.rows)
                columns = [batch.column(0).slice(at, n), batch.column(1).slice(at, n), pa.array(per_doc.astype(np.int64)), pa.array(rows, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "label", "passages", "x"])

    # the sample's size is bounded by its parameters
    joined = docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).join(F.broadcast(sample), "doc_id")
    single = joined.groupBy("doc_id", F.col("label").cast("int").alias("label")).agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    bags = store(single.mapInArrow(encode, "doc_id long, label int, passages long, x binary"), "bags")
    before = F.sum("passages").over(Window.orderBy(place, "doc_id").rowsBetween(Window.unboundedPreceding, -1))
    within = bags.select("doc_id", "passages").withColumn("before", F.coalesce(before, F.lit(0))).filter(F.col("before") < most).select("doc_id")
    rows = bags.join(F.broadcast(within), "doc_id").toPandas().sort_values("doc_id")
    bags = [np.frombuffer(x, np.float32).reshape(-1, FEATURES) for x in rows["x"]]
    x = np.vstack(bags).astype(np.float64) if bags else np.empty((0, FEATURES))
    return fit(x, np.array([len(b) for b in bags], np.int64), rows["label"].to_numpy(np.float64))


def quality_scores(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of every row of ``docs`` and its score, 0 to 1."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            found = [own.scores(x, per_doc) for _, x, per_doc in _slices(batch.column(batch.num_columns - 1))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(np.concatenate([np.empty(0), *found]))], names=[*batch.schema.names[:-1], "_score"]
            )

    rows = docs.select(*keep, text_of().alias("_text"))
    schema = docs.select(*keep).withColumn("_score", F.lit(0.0)).schema
    return rows.mapInArrow(score, schema)


def without_low_quality(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """``docs`` without the rows that score below ``least``; all their columns."""
    scored = quality_scores(docs, model, tuple(docs.columns))
    return scored.filter(F.col("_score") >= least).select(*docs.columns)
