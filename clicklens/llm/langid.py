"""Language identification by string-kernel classification.

The kernel of two texts is the number of distinct character n-grams of 1 to 3
characters that both hold, over the root of the product of their own numbers
(blended-spectrum presence kernel, normalised). N-grams are hashed to ``DIMS``
places. All labelled texts train one-versus-rest kernel ridge regression in the
span of Nystroem landmarks, some of these texts; texts are then scored in
batches as (presence x landmarks) x coefficients.

Letters are compared in lower case; runs of ASCII characters other than
letters count as one space. The score is the winner's share of the positive
outputs, between 0 and 1.

Defined cases: null texts and texts without a letter are ``und`` with score 0;
with no labelled row, so are all; ties go to the smallest language name; null
doc_ids are predicted, never held out and never trained on; an empty table
gives no rows; the input's columns are kept,
those named like a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

N_MAX = 3
DIMS = 1 << 15
#: Landmarks of all languages, of each as many, and one at least.
LANDMARKS = 96
RIDGE = 1e-3
UNKNOWN = "und"
#: Characters hashed at once, and texts scored at once.
PIECE, BATCH = 1 << 20, 64

_ASCII = np.array([c if 97 <= c <= 122 else 32 for c in range(128)], np.uint32)
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


@dataclass
class Model:
    languages: list[str]
    landmarks: np.ndarray  # DIMS x m, presence over root of the count
    coefficients: np.ndarray  # m x languages


def held_out(doc_id: F.Column) -> F.Column:
    """Whether crc32 of the id as text leaves remainder 2 by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))


def _mark(text: str, row: np.ndarray) -> None:
    """Marks the n-grams of the whole text in ``row``, piece by piece."""
    for at in range(0, max(1, len(text)), PIECE):
        part = text[max(0, at - N_MAX + 1) : at + PIECE].lower()
        c = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), "<u4")
        c = np.where(c < 128, _ASCII[np.minimum(c, 127)], c)
        space = c == 32
        c = c[~(space & np.concatenate([[True], space[:-1]]))] if len(c) else c
        h = np.zeros(len(c), np.uint32)
        for n in range(1, N_MAX + 1):
            if len(c) < n:
                break
            h = h[: len(c) - n + 1] * np.uint32(31) + (c[n - 1 :] + np.uint32(n)) * _FACTORS[n - 1]
            g = h ^ (h >> np.uint32(15))
            row[((g * np.uint32(0x2C1B3C6D)) >> np.uint32(17)).astype(np.int64)] = 1


def presence(texts: list[str | None]) -> np.ndarray:
    """Presence of hashed n-grams, one row per text."""
    out = np.zeros((len(texts), DIMS), np.float32)
    for row, t in zip(out, texts, strict=True):
        if t:
            _mark(t, row)
    return out


def _kernel(texts: list[str | None], marks: np.ndarray) -> np.ndarray:
    """The kernel of each text with each landmark."""
    x = presence(texts)
    return x @ marks / np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))


def _landmarks(rows: DataFrame, named: DataFrame, per: int) -> np.ndarray:
    """Of (lang, text, h) ``rows``: ``per`` texts of each language, the first by the hash of the id, as unit columns.

    ``named`` are their (lang, h, hash of the text). The landmarks' presence bits (4 KiB each) come to the driver.
    """
    first = named.withColumn("_place", F.row_number().over(Window.partitionBy("lang").orderBy("h", "th"))).filter(F.col("_place") <= per)
    first = stored(first.groupBy("lang", "h", "th").agg(F.count("*").alias("times")), "language-landmarks")
    texts = rows.withColumn("th", F.xxhash64("text")).join(F.broadcast(first), ["lang", "h", "th"])
    texts = texts.groupBy("lang", "h", "th", "times").agg(F.first("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, BATCH):
                part = b.slice(at, BATCH)
                bits = np.packbits(presence(part.column("text").to_pylist()).astype(bool), axis=1)
                yield pa.RecordBatch.from_arrays([*part.columns[:4], pa.array([x.tobytes() for x in bits], pa.binary())], ["lang", "h", "th", "times", "bits"])

    found = texts.mapInArrow(run, "lang string, h long, th long, times long, bits binary").collect()
    found.sort(key=lambda r: (r["lang"], r["h"], r["th"]))
    marks = np.unpackbits(np.stack([np.frombuffer(r["bits"], np.uint8) for r in found for _ in range(r["times"])]), axis=1).astype(np.float32)
    marks /= np.sqrt(np.maximum(marks.sum(axis=1, keepdims=True), 1))
    return np.ascontiguousarray(marks.T)


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> Model:
    """Ridge regression over all of ``labelled``, in the span of ``LANDMARKS`` of its texts.

    Tasks send the sums of their rows' products, landmarks times landmarks and
    languages; these and one row per language come to the driver.
    """
    rows = labelled.filter(F.col(text).rlike(r"\p{L}")).select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(F.col(doc_id).cast("string")).alias("h"))
    named = stored(rows.select("lang", "h", F.xxhash64("text").alias("th")), "language-rows")
    counts = {r["lang"]: r["count"] for r in named.groupBy("lang").count().collect()}
    languages = sorted(counts)
    if not languages:
        return Model([], np.zeros((DIMS, 0), np.float32), np.zeros((0, 0), np.float32))
    marks = _landmarks(rows, named, max(1, LANDMARKS // len(languages)))
    m = marks.shape[1]
    weight = 1 / np.array([counts[n] for n in languages])  # languages count alike
    shared = labelled.sparkSession.sparkContext.broadcast(({n: i for i, n in enumerate(languages)}, weight, marks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, weight, marks = shared.value
        total = np.zeros((m, m + len(place)))
        for b in batches:
            for at in range(0, b.num_rows, BATCH):
                part = b.slice(at, BATCH)
                k = _kernel(part.column(1).to_pylist(), marks).astype(float)
                name = np.array([place[n] for n in part.column(0).to_pylist()])
                weighed = k * weight[name][:, None]
                total[:, :m] += k.T @ weighed
                np.add.at(total.T, m + name, weighed)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(m)), pa.array([x.tobytes() for x in total], pa.binary())], ["mark", "part"])

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(p) for p in sorted(frame["part"]))  # in one order, however they arrive
        return pd.DataFrame({"mark": [frame["mark"].iloc[0]], "part": [total.tobytes()]})

    sums = np.zeros((m, m + len(languages)))
    for r in rows.select("lang", "text").mapInArrow(run, "mark long, part binary").groupBy("mark").applyInPandas(add, "mark long, part binary").collect():
        sums[r["mark"]] = np.frombuffer(r["part"])
    shared.destroy()
    left = sums[:, :m] + RIDGE * ((marks.T @ marks).astype(float) + 1e-6 * np.eye(m))
    return Model(languages, marks, np.linalg.solve(left, sums[:, m:]).astype(np.float32))


def predict(docs: DataFrame, model: Model, text: str = "text", names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with language and score, in columns called ``names``; only the text column is looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*(c for c in docs.columns if c not in names))
    rows = rows.withColumn(names[0], F.lit("")).withColumn(names[1], F.lit(0.0))
    at = rows.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            best, score = [], []
            for start in range(0, b.num_rows, BATCH):
                texts = b.column(at).slice(start, BATCH).to_pylist()
                lettered = np.array([bool(t) and any(map(str.isalpha, t)) for t in texts])
                if not m.languages:
                    best += [UNKNOWN] * len(texts)
                    score += [0.0] * len(texts)
                    continue
                k = _kernel([t if ok else None for t, ok in zip(texts, lettered, strict=True)], m.landmarks)
                f = np.maximum(k @ m.coefficients, 0).astype(float)
                top, total = f.argmax(axis=1), f.sum(axis=1)
                share = np.where(total > 0, f[np.arange(len(f)), top] / np.where(total > 0, total, 1), 0)
                best += [m.languages[i] if ok else UNKNOWN for i, ok in zip(top, lettered, strict=True)]
                score += np.where(lettered, share, 0.0).tolist()
            yield pa.RecordBatch.from_arrays([*b.columns[:-2], pa.array(best, pa.string()), pa.array(score, pa.float64())], b.schema.names)

    return rows.mapInArrow(run, rows.schema)
