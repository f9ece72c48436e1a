"""Language identification: a byte convolutional network with filters of three widths over fixed-length windows.

Windows of 256 bytes cover the whole text; their class scores are averaged and the softmax of the mean is the
prediction. NULL texts and texts without a letter are `und` with score 0, and so is every text if no
language was given to learn from. Repeated rows are predicted alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablex.llm.batches import in_arrow
from tablex.llm import bytecnn
from tablex.llm.common import remainder, table
from tablex.llm.learning import class_sample, training_windows

WINDOW = 256
STRIDE, WIDTHS, FILTERS = 2, (1, 2, 3), 24
PER_CLASS = 600
PER_TEXT = 4
EPOCHS = 5


def learn(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", per_class: int = PER_CLASS, per_text: int = PER_TEXT, epochs: int = EPOCHS) -> dict:
    """The network and its languages, from rows with a language and an id."""
    rows = docs.where(F.col(lang).isNotNull() & F.col(doc_id).isNotNull() & F.col(text).isNotNull()).select(F.col(doc_id).alias("l_id"), F.col(text).alias("l_text"), F.col(lang).alias("l_lang"))
    shape = bytecnn.Shape(WINDOW, WINDOW, STRIDE, WIDTHS, FILTERS, 0)
    classes, picked = class_sample(rows, "l_lang", "l_id", per_class)
    x, y, _ = training_windows(picked, classes, "l_lang", "l_id", "l_text", shape, per_text)
    shape.classes = len(classes)
    return {"classes": classes, "shape": shape, "net": bytecnn.train(x, y, shape, epochs) if len(x) else None}


def identified(docs: DataFrame, model: dict, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (all by default) with l_pred and l_score, in place of any of these names."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("l_pred", "l_score", "l_text")]
    letter = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    kept = docs.select(*[F.col(f"`{c}`") for c in keep], F.when(letter, F.col(text)).cast("binary").alias("l_text"))
    net, classes, shape = model["net"], model["classes"], vars(model["shape"])

    def predict(batches):
        for batch in batches:
            bodies = batch.column("l_text").to_pylist()
            names, sure = [None] * len(bodies), np.zeros(len(bodies))
            if net is not None and bodies:
                p = bytecnn.softmax(np.array([mean for mean, _ in bytecnn.text_scores(net, bodies, bytecnn.Shape(**shape))]))
                names, sure = [classes[k] for k in p.argmax(axis=1)], p.max(axis=1)
            known = [b is not None and net is not None for b in bodies]
            names = [n if k else "und" for n, k in zip(names, known)]
            found = [pa.array(names, pa.string()), pa.array(np.where(known, sure, 0.0), pa.float64())]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *found], names=[*keep, "l_pred", "l_score"])

    return in_arrow(kept, predict, T.StructType([*kept.schema.fields[:-1], T.StructField("l_pred", T.StringType()), T.StructField("l_score", T.DoubleType())]))


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(remainder(doc_id, 5) == 0, F.lit(False))


def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = learn(docs.where(~held_out()))
    found = identified(docs.select("doc_id", "text"), model, keep=["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), F.col("l_pred").alias("lang_pred"), F.col("l_score").alias("score"))


QUERIES = {"op8_language_id": op8_language_id}
ORACLES: dict[str, str] = {}
