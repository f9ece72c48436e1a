"""Quality classifier: a byte-level convolutional network over overlapping chunks of the whole text.

Chunks of 512 bytes, each overlapping the next by 64, are scored by the network; the mean and the lowest chunk
score of a text are combined into one probability by a logistic fit. Labels come from at most about
`per_class` texts of each label. NULL and empty texts score 0; without any label every other text scores 0.5.
Repeated rows score alike. Rows without an id are scored like all others and count as not held out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablex.llm.batches import in_arrow
from tablex.llm import bytecnn
from tablex.llm.common import packed, remainder, table, unpacked
from tablex.llm.learning import class_sample, training_windows

SHAPE = bytecnn.Shape(length=512, step=448, stride=4, widths=(2,), filters=32, classes=2)
PER_CLASS = 2000
PER_TEXT = 4
EPOCHS = 8


def combiner(mean: np.ndarray, low: np.ndarray, y: np.ndarray, steps: int = 30) -> np.ndarray:
    """Weights of (mean, lowest, 1), by Newton steps with a pull toward (1, 0, 0)."""
    x, start = np.column_stack([mean, low, np.ones(len(mean))]), np.array([1.0, 0.0, 0.0])
    w = start.copy()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        pull = 1.0
        slope = x.T @ (p - y) + pull * (w - start)
        curve = (x * (p * (1 - p))[:, None]).T @ x + pull * np.eye(3)
        w = w - np.linalg.solve(curve, slope)
    return w


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", per_class: int = PER_CLASS, per_text: int = PER_TEXT, epochs: int = EPOCHS) -> dict:
    """The network and its combiner, from documents whose id is labelled; a label given twice counts as its lower value."""
    known = labels.where(F.col(doc_id).isNotNull() & F.col(label).isin(0, 1)).groupBy(doc_id).agg(F.min(label).cast("int").alias("q_label"))
    classes, picked = class_sample(known, "q_label", doc_id, per_class)
    # The sample is bounded by `per_class`: it is broadcast, and no text is shuffled.
    rows = docs.select(F.col(doc_id), F.col(text).alias("q_text")).join(F.broadcast(picked), doc_id)
    x, y, of = training_windows(rows, classes, "q_label", doc_id, "q_text", SHAPE, per_text)
    if not len(x):
        return {"net": None, "mix": None}
    y = np.array(classes)[y]
    net = bytecnn.train(x, y, SHAPE, epochs)
    z = bytecnn.scores(net, x, SHAPE)
    z = z[:, 1] - z[:, 0]
    first = np.flatnonzero(np.diff(of, prepend=-1))
    mean, low = np.add.reduceat(z, first) / np.diff(np.append(first, len(z))), np.minimum.reduceat(z, first)
    return {"net": net, "mix": combiner(mean, low, y[first])}


def scored(docs: DataFrame, model: dict, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (all by default) with q_score, in place of any of that name."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("q_score", "q_text")]
    kept = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text).cast("binary").alias("q_text"))
    # One score of label 1 against label 0, so that the lowest chunk is the one likeliest of label 0.
    net = model["net"] and {**model["net"], "out": model["net"]["out"][:, 1:] - model["net"]["out"][:, :1], "bias": model["net"]["bias"][1:] - model["net"]["bias"][:1]}
    mix, shape = model["mix"], bytecnn.Shape(**{**vars(SHAPE), "classes": 1})

    def score(batches):
        for batch in batches:
            bodies = batch.column("q_text").to_pylist()
            if net is None:
                found = np.full(len(bodies), 0.5)
            else:
                z = np.array([(m[0], low[0], 1.0) for m, low in bytecnn.text_scores(net, bodies, shape)]).reshape(-1, 3)
                found = 1 / (1 + np.exp(-np.clip(z @ mix, -30, 30)))
            found = np.where([bool(b) for b in bodies], found, 0.0)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(found, pa.float64())], names=[*keep, "q_score"])

    return in_arrow(kept, score, T.StructType([*kept.schema.fields[:-1], T.StructField("q_score", T.DoubleType())]))


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(remainder(doc_id, 3) == 1, F.lit(False))


def good(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The documents that score at least the threshold; columns as given."""
    model = learn(docs, labels.where(~held_out(doc_id)), doc_id, text)
    found = scored(packed(docs, doc_id, text), model, text).where(F.col("q_score") >= threshold)
    return unpacked(found, docs.columns, (doc_id, text))


def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = learn(docs, table(spark, folder, "labels").where(~held_out()))
    found = scored(docs, model, keep=["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), F.col("q_score").alias("score"), (F.col("q_score") >= 0.5).cast("int").alias("predicted"))


QUERIES = {"op1_quality_classifier": op1_quality_classifier}
ORACLES: dict[str, str] = {}
