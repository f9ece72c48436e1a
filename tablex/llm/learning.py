"""Bounded, reproducible training windows of labelled texts, taken by executors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablex.llm.batches import in_arrow
from tablex.llm.bytecnn import Shape, some_windows

#: So many classes have `per_class` rows each; of more, each has a share of as many rows in all.
FULL_CLASSES = 200


def class_sample(rows: DataFrame, label: str, row_id: str, per_class: int) -> tuple[list, DataFrame]:
    """(classes, rows): about `per_class` rows of each label, picked by a hash of their id, so that a rerun picks the same.

    Every label is learned. At most about FULL_CLASSES * per_class rows, or one of each label, whatever the table's size.
    """
    counts = rows.groupBy(label).count().orderBy(F.desc("count"), label).collect()  # one row per label
    if not counts:
        return [], rows.where(F.lit(False))
    each = max(1.0, min(per_class, FULL_CLASSES * per_class / len(counts)))
    share = F.create_map(*[F.lit(v) for r in counts for v in (r[0], min(1.0, each / r[1]))])
    chance = F.pmod(F.xxhash64(F.lit("train"), F.col(row_id)), F.lit(1 << 30)) / F.lit(1 << 30)
    return sorted(r[0] for r in counts), rows.where(chance < share[F.col(label)])


def training_windows(rows: DataFrame, classes: list, label: str, row_id: str, text: str, shape: Shape, per_text: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows, class of each window, text of each window) of a bounded sample, at most `per_text` from a text."""
    picked = rows.select(F.col(row_id).alias("id"), F.col(label).alias("label"), F.col(text).cast("binary").alias("text"))

    def cut(batches):
        for batch in batches:
            bodies = [some_windows(t or b"", shape, per_text).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(bodies, pa.binary())], names=["id", "label", "windows"])

    kinds = rows.select(row_id, label).schema
    taken = in_arrow(picked, cut, f"id {kinds[row_id].dataType.simpleString()}, label {kinds[label].dataType.simpleString()}, windows binary").collect()
    taken.sort(key=lambda r: (r[0], r[1], bytes(r[2])))
    x = [np.frombuffer(bytes(r[2]), np.uint8).reshape(-1, shape.length) for r in taken]
    number = {c: k for k, c in enumerate(classes)}
    sizes = [len(w) for w in x]
    y = np.repeat([number[r[1]] for r in taken], sizes).astype(np.int64)
    return np.concatenate(x) if x else np.zeros((0, shape.length), np.uint8), y, np.repeat(np.arange(len(x)), sizes)
