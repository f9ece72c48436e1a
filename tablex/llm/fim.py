"""Fill-in-middle transformation: a text cut into prefix, middle and suffix, put in the order a model learns to fill from.

Units are lines (each with its line end) or code points. Two of a text's four numbers, from the SHA-256 of the seed and
the id, choose the cuts, the third whether the text is transformed and the fourth its form:

    psm     <P> prefix <S> suffix <M> middle
    spm     <S> suffix <P> prefix <M> middle
    plain   the text as it is: an empty one, one that holds a sentinel, or one the rate leaves out

Cuts are taken in UTF-8. A sparse index of exceptions holds only the multibyte characters: the place of each and the
bytes in excess of one up to it. A binary search in it turns byte places into code points and back; between exceptions,
and in a text of ASCII alone, both differ by a constant.

NULL and empty texts are plain with an empty output. A NULL id counts as the word null in the seed. Rows alike are
transformed alike. An empty table gives an empty one. Columns of the caller keep their values unless they have a name of
the result's (f_…). A text of any length is one row of a task; its index takes 16 bytes per multibyte character.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablex.llm.batches import in_arrow
from tablex.llm.common import table

# The sentinels of the output.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = "7"
#: Texts transformed, and those of them in spm form, of 100.
RATE, SPM = 100, 50

RESULT = T.StructType(
    [
        T.StructField("f_n", T.LongType()),
        T.StructField("f_form", T.StringType()),
        T.StructField("f_prefix_chars", T.LongType()),
        T.StructField("f_middle_chars", T.LongType()),
        T.StructField("f_output", T.BinaryType()),
    ]
)


class SparseIndex:
    """Code points and bytes of a UTF-8 text, by its multibyte characters alone."""

    def __init__(self, text: bytes):
        raw = np.frombuffer(text, np.uint8)
        self.size = len(raw)
        self.at = np.flatnonzero(raw >= 0xC0)  # first bytes of multibyte characters
        lead = raw[self.at]
        self.excess = np.concatenate(([0], np.cumsum(1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0))))
        self.chars_at = self.at - self.excess[:-1]  # their places in code points

    def chars(self, at: int) -> int:
        """Code points before a byte place, which no character crosses."""
        return int(at - self.excess[np.searchsorted(self.at, at)])

    def bytes(self, at: int) -> int:
        """Bytes before a code point."""
        return int(at + self.excess[np.searchsorted(self.chars_at, at)])


def draws(doc_id, seed: str = SEED) -> tuple[int, ...]:
    digest = hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[4 * k : 4 * k + 4], "big") for k in range(4))


def transform(text: bytes, doc_id, unit: str = "line", seed: str = SEED, rate: int = RATE, spm: int = SPM) -> tuple:
    """(units, form, code points of the prefix, of the middle, output) of one text."""
    index = SparseIndex(text)
    if unit == "line":
        ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
        if text and (not len(ends) or ends[-1] != len(text)):
            ends = np.append(ends, len(text))
        n = len(ends)
    else:
        n = index.chars(len(text))
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or h3 % 100 >= rate or any(mark.encode() in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    cuts = sorted((h1 % (n + 1), h2 % (n + 1)))
    if unit == "line":
        a, b = (int(ends[c - 1]) if c else 0 for c in cuts)
    else:
        a, b = (index.bytes(c) for c in cuts)
    before, upto = index.chars(a), index.chars(b)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    if h4 % 100 < spm:
        return n, "spm", before, upto - before, b"".join((s, suffix, p, prefix, m, middle))
    return n, "psm", before, upto - before, b"".join((p, prefix, s, suffix, m, middle))


def fill_in_middle(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", unit: str = "line", seed: str = SEED, rate: int = RATE, spm: int = SPM, keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (all by default) with f_n, f_form, f_prefix_chars, f_middle_chars and f_output (UTF-8)."""
    if unit not in ("line", "char"):
        raise ValueError(f"unit {unit!r}: line or char")
    keep = [c for c in (docs.columns if keep is None else keep) if c not in RESULT.names and c not in ("f_id", "f_text")]
    kept = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(doc_id).cast("string").alias("f_id"), F.col(text).cast("binary").alias("f_text"))

    def cut(batches):
        for batch in batches:
            names, bodies = batch.column("f_id").to_pylist(), batch.column("f_text").to_pylist()
            found = [transform(body or b"", name, unit, seed, rate, spm) for name, body in zip(names, bodies)]
            new = [pa.array([f[k] for f in found], kind) for k, kind in enumerate((pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *new], names=[*keep, *RESULT.names])

    return in_arrow(kept, cut, T.StructType([*kept.schema.fields[: len(keep)], *RESULT.fields]))


def restored(output: Column, form: Column) -> Column:
    """The text an output was made from. No part of it holds a sentinel, and no sentinel overlaps itself."""
    body = F.substring_index(output, MIDDLE, 1)  # without the middle
    middle = F.substring_index(output, MIDDLE, -1)
    psm = F.concat(F.substring_index(F.substring_index(body, PREFIX, -1), SUFFIX, 1), middle, F.substring_index(body, SUFFIX, -1))
    spm = F.concat(F.substring_index(body, PREFIX, -1), middle, F.substring_index(F.substring_index(body, SUFFIX, -1), PREFIX, 1))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


def op11_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    found = fill_in_middle(table(spark, folder, "documents"), keep=["doc_id"])
    text = F.col("f_output").cast("string")
    return found.select(
        "doc_id",
        F.col("f_n").alias("n"),
        F.col("f_form").alias("form"),
        F.col("f_prefix_chars").alias("prefix_chars"),
        F.col("f_middle_chars").alias("middle_chars"),
        F.sha2("f_output", 256).alias("output_sha256"),
        F.sha2(restored(text, F.col("f_form")).cast("binary"), 256).alias("restored_sha256"),
    )


QUERIES = {"op11_fill_in_middle": op11_fill_in_middle}
ORACLES = {
    "op11_fill_in_middle": r"""
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units,
           sha256('7:' || coalesce(doc_id::VARCHAR, 'null')) AS h
    FROM documents
), draws AS (
    SELECT doc_id, t, units, len(units) AS n,
           ('0x' || h[1:8])::UBIGINT % (len(units) + 1) AS c1, ('0x' || h[9:16])::UBIGINT % (len(units) + 1) AS c2,
           ('0x' || h[17:24])::UBIGINT % 100 AS c3, ('0x' || h[25:32])::UBIGINT % 100 AS c4
    FROM texts
), cuts AS (
    SELECT doc_id, t, n,
           CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR c3 >= 100 THEN 'plain'
                WHEN c4 < 50 THEN 'spm' ELSE 'psm' END AS form,
           array_to_string(list_slice(units, 1, least(c1, c2)::BIGINT), '') AS p,
           array_to_string(list_slice(units, least(c1, c2)::BIGINT + 1, greatest(c1, c2)::BIGINT), '') AS m,
           array_to_string(list_slice(units, greatest(c1, c2)::BIGINT + 1, n), '') AS s
    FROM draws
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                   ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM cuts
"""
}
