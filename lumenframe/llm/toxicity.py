"""Toxicity by a classifier chain of linear models.

The categories stand in an order; the model of each sees the text and the probabilities of the earlier
ones. For its training those are out-of-fold predictions, so that it meets probabilities as uncertain
as later ones. Features: words and their 5-grams, hashed, counted over a text's distinct words.

Training takes at most ``SAMPLE`` labelled rows, chosen by hash; scoring reads every whole text. Edge
cases: a null text is empty; an empty text has the features of none; a category without both classes
in the sample gets its base rate (0 without labels) for all; equal texts get equal scores; rows keep
their other columns, but for one named ``_p``; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_limits, stage, table, unit_hash, widened

#: Labelled rows that training reads at most, hashed features, features of one model, folds.
SAMPLE, SPACE, CHOSEN, FOLDS = 6000, 1 << 18, 400, 5
#: Categories in the order of the chain: name, label column, value that means yes.
CATEGORIES = (("junk", "quality", 0), ("toxic", "toxic", 1))


def word_features(word: str) -> list[int]:
    marked = f"<{word}>"
    grams = {marked, *(marked[i : i + 5] for i in range(len(marked) - 4))}
    return [zlib.crc32(g.encode("utf-8", "surrogatepass")) % SPACE for g in grams]


class _Cache(dict):
    """Results by word, emptied between texts when it has grown large."""

    def __init__(self, function, limit: int = 300_000):
        self.function, self.limit = function, limit

    def __missing__(self, word: str):
        out = self[word] = self.function(word)
        return out

    def of(self, text: str) -> list:
        if len(self) > self.limit:
            self.clear()
        return list(map(self.__getitem__, words_of(text)))


def words_of(text: str) -> set[str]:
    return {w.strip(".,;:!?\"'()") for w in text.lower().split()}


def text_features(text: str, cache: _Cache) -> np.ndarray:
    """Hashed features of a text, one for each distinct word that has it."""
    found = cache.of(text)
    return np.array([f for x in found for f in x], np.uint32)


@dataclass
class Linear:
    """Logistic regression on chosen features, the text's size and the earlier probabilities."""

    chosen: np.ndarray
    weights: np.ndarray
    base: float | None = None

    def inputs(self, rows: list[np.ndarray], sizes: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        x = np.zeros((len(rows), len(self.chosen)))
        for i, ids in enumerate(rows):
            at = np.searchsorted(self.chosen, ids)
            at[at == len(self.chosen)] = 0
            hit = at[self.chosen[at] == ids] if len(self.chosen) else at[:0]
            np.add.at(x[i], hit, 1)
        return np.hstack([np.ones((len(rows), 1)), np.log1p(sizes)[:, None] / 10, earlier, np.log1p(x)])

    def predict(self, rows: list[np.ndarray], sizes: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        if self.base is not None:
            return np.full(len(rows), self.base)
        return 1 / (1 + np.exp(-np.clip(self.inputs(rows, sizes, earlier) @ self.weights, -30, 30)))

    @classmethod
    def fit(cls, rows: list[np.ndarray], sizes: np.ndarray, earlier: np.ndarray, y: np.ndarray, ridge: float = 0.3) -> Linear:
        n1, n0 = int(y.sum()), int((1 - y).sum())
        if not n1 or not n0:
            return cls(np.empty(0, np.uint32), np.empty(0), n1 / len(y) if len(y) else 0.0)
        have = np.zeros((2, SPACE))
        for ids, v in zip(rows, y):
            have[int(v), np.unique(ids)] += 1
        p = have.sum(0) / len(y)
        z = np.abs(have[1] / n1 - have[0] / n0) / np.sqrt(np.maximum(p * (1 - p), 1e-9) * (1 / n1 + 1 / n0))
        z[have.sum(0) < 5] = 0
        best = np.argsort(-z, kind="stable")[:CHOSEN]
        model = cls(np.sort(best[z[best] > 0]).astype(np.uint32), np.empty(0))
        x = model.inputs(rows, sizes, earlier)
        w = np.zeros(x.shape[1])
        penalty = np.full(x.shape[1], ridge)
        penalty[0] = 1e-6
        for _ in range(25):
            q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            h = (x * np.maximum(q * (1 - q), 1e-6)[:, None]).T @ x + np.diag(penalty)
            step = np.linalg.solve(h, x.T @ (y - q) - penalty * w)
            w += step
            if np.abs(step).max() < 1e-6:
                break
        model.weights = w
        return model


@dataclass
class Chain:
    names: list[str]
    models: list[Linear]

    @classmethod
    def fit(cls, rows: list[np.ndarray], sizes: np.ndarray, folds: np.ndarray, labels: np.ndarray, names: list[str]) -> Chain:
        earlier, models = np.zeros((len(rows), 0)), []
        for k in range(len(names)):
            models.append(Linear.fit(rows, sizes, earlier, labels[:, k]))
            out = np.zeros(len(rows))
            for f in range(FOLDS):
                a, b = np.flatnonzero(folds != f), np.flatnonzero(folds == f)
                if len(a) and len(b):
                    m = Linear.fit([rows[i] for i in a], sizes[a], earlier[a], labels[a, k])
                    out[b] = m.predict([rows[i] for i in b], sizes[b], earlier[b])
            earlier = np.hstack([earlier, out[:, None]])
        return cls(list(names), models)

    def predict(self, rows: list[np.ndarray], sizes: np.ndarray) -> np.ndarray:
        earlier = np.zeros((len(rows), 0))
        for m in self.models:
            earlier = np.hstack([earlier, m.predict(rows, sizes, earlier)[:, None]])
        return earlier


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache = _Cache(word_features, 100_000)
    for batch in batches:
        found = [text_features(x or "", cache).tobytes() for x in batch.column("text").to_pylist()]
        sizes = [len(words_of(x or "")) for x in batch.column("text").to_pylist()]
        kept = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), pa.array(sizes, pa.int64()), pa.array(found, pa.binary())], names=[*kept, "size", "features"])


def train(docs: DataFrame, labels: DataFrame, categories=CATEGORIES, sample: int = SAMPLE) -> Chain:
    """A chain from at most ``sample`` rows of ``labels``, the first by a hash of their doc_id."""
    arrow_limits(docs.sparkSession)
    yes = [F.coalesce((F.col(c) == v).cast("int"), F.lit(0)).alias(f"y{i}") for i, (_, c, v) in enumerate(categories)]
    chosen = labels.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long"), *yes, unit_hash("toxicity-sample", "doc_id").alias("u"))
    chosen = stage(chosen.orderBy("u", "doc_id", *(f"y{i}" for i in range(len(categories)))).limit(sample), "labels")
    # the sample's size is a parameter, so its broadcast is bounded
    joined = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", *(f"y{i}" for i in range(len(categories))), "u")
    schema = "doc_id long, " + "".join(f"y{i} int, " for i in range(len(categories))) + "u double, size long, features binary"
    # repeated documents must not swell what the driver gets
    found = joined.mapInArrow(_featurise, schema).orderBy("u", "doc_id", "features").limit(sample).collect()
    rows = [np.frombuffer(bytes(r.features), np.uint32) for r in found]
    y = np.array([[float(r[f"y{i}"]) for i in range(len(categories))] for r in found]).reshape(len(found), len(categories))
    folds = np.array([zlib.crc32(str(r.doc_id).encode()) % FOLDS for r in found], int)
    return Chain.fit(rows, np.array([float(r["size"]) for r in found]), folds, y, [c[0] for c in categories])


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """``docs`` and, last, an array ``_p`` of the chain's probabilities; the text is read whole."""
    arrow_limits(docs.sparkSession)
    docs = docs.drop("_p")
    used = np.unique(np.concatenate([m.chosen for m in chain.models] or [np.empty(0, np.uint32)]))
    wanted = set(used.tolist())
    schema = widened(docs, "_p array<double>")
    text_at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _Cache(lambda w: [f for f in word_features(w) if f in wanted])
        for batch in batches:
            rows, sizes = [], []
            for x in batch.column(text_at).to_pylist():
                found = cache.of(x or "")
                sizes.append(len(found))
                rows.append(np.array([f for y in filter(None, found) for f in y], np.uint32))
            p = chain.predict(rows, np.array(sizes, float))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(p), pa.list_(pa.float64()))], names=[*batch.schema.names, "_p"])

    return docs.mapInArrow(run, schema)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = train(docs, table(spark, sf_dir, "labels"))
    out = score(docs, chain)
    p = {n: F.get("_p", F.lit(i)) for i, n in enumerate(chain.names)}
    return out.select("doc_id", *(c.alias(f"p_{n}") for n, c in p.items()), (p["toxic"] >= 0.5).alias("toxic"), (p["toxic"] < 0.5).alias("kept"))
