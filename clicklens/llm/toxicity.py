"""Toxicity by a factorization machine over hashed terms.

A text's terms are its words and the first ``PREFIX`` bytes of each (so that
inflected forms meet), hashed to 32 bits; only presence counts. The score is
the logistic value of

    w0 + sum_i w_i + 1/2 (|sum_i v_i|^2 - sum_i |v_i|^2)

over the present terms that the model knows: w_i is a term's own weight, and
the inner product of v_i and v_j is what two terms weigh together, such as an
insult with the mention of a group, which no sum of single weights tells from
either alone.

Training: up to ``PER_LABEL`` labelled ids of each label, chosen by a hash of
the id, then up to twice as many distinct texts of them; the model knows at
most ``TERMS`` terms, those that best tell the labels apart, each by a
likelihood ratio of ``LEAST_RATIO`` or more. Both labels weigh alike. Adaptive
gradient steps over ``EPOCHS`` passes, in an order fixed by a seed, so that a
rerun gives the same model.

Defined cases: null and empty texts hold no terms and score the logistic value
of w0; without labelled texts of both labels every score is the share of
toxic texts among them (0 if none); of an id with several labels, and of equal
texts with different ones, the higher label counts; null ids, and null labels,
are never learned from and null ids never held out; repeated rows are scored
like others; an empty table gives no rows; other columns are kept, those named
like a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import span_hashes, stored

#: Bounds of what is learned from: ids of each label, and terms of the model.
PER_LABEL, TERMS = 4000, 1 << 13
PREFIX = 5
#: Least likelihood ratio (chi-square with one degree of freedom, 1 in 1,000 by chance) of a term to be known.
LEAST_RATIO = 10.8
FACTORS, EPOCHS, STEP, DECAY, BATCH = 8, 20, 0.1, 1e-3, 32
#: Bytes of text whose terms are worked out at once.
PIECE = 1 << 19

_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


@dataclass
class Model:
    terms: np.ndarray  # sorted hashes
    bias: float
    weights: np.ndarray  # a number per term
    factors: np.ndarray  # terms x FACTORS


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves remainder 0 by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the terms of ``data`` and where their words begin."""
    buf = np.frombuffer(data, np.uint8)
    edge = np.flatnonzero(np.diff(_WORD_BYTE[buf], prepend=False, append=False))
    starts, ends = edge[0::2], edge[1::2]
    whole = span_hashes(buf, starts, ends) >> np.uint64(32)
    stem = span_hashes(buf, starts, np.minimum(ends, starts + PREFIX)) & np.uint64(0xFFFFFFFF)
    return np.concatenate([whole, stem]).astype(np.uint32), np.concatenate([starts, starts])


def _cut(data: bytes) -> Iterator[bytes]:
    """Pieces of a long text that end where a word ends."""
    at = 0
    while at < len(data):
        end = at + PIECE
        while end < len(data) and _WORD_BYTE[data[end]]:
            end += 1
        yield data[at:end]
        at = end


def term_rows(texts: list[str | None], known: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For groups of whole texts: (index of the first, text of each term within the group, the term).

    Terms come sorted by text and once per text: as hashes, or as places in
    ``known``, others left out.
    """

    def once(owner: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if known is not None:
            place = np.searchsorted(known, h)
            keep = np.append(known, 0)[place] == h
            keep &= place < len(known)
            owner, h = owner[keep], place[keep]
        key = np.unique(owner.astype(np.uint64) << np.uint64(32) | h.astype(np.uint64))
        return (key >> np.uint64(32)).astype(np.int64), (key & np.uint64(0xFFFFFFFF)).astype(np.int64)

    group: list[bytes] = []
    first, size = 0, 0

    def flush() -> tuple[int, np.ndarray, np.ndarray]:
        h, at = _hashes(b"\n".join(group))
        begins = np.cumsum([0] + [len(t) + 1 for t in group])
        return first, *once(np.searchsorted(begins, at, side="right") - 1, h)

    for i, text in enumerate(texts):
        data = (text or "").lower().encode("utf-8", "surrogatepass")
        if group and size + len(data) > PIECE:
            yield flush()
            group, size, first = [], 0, i
        if len(data) > PIECE:
            parts = [once(np.zeros(len(h), np.int64), h)[1] for h, _ in map(_hashes, _cut(data))]
            terms = np.unique(np.concatenate(parts))
            yield i, np.zeros(len(terms), np.int64), terms
            first = i + 1
        else:
            group.append(data)
            size += len(data) + 1
    if group:
        yield flush()


def _telling(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Terms that tell the labels apart: at most ``TERMS``, by likelihood ratio against chance, sorted."""
    flat = np.concatenate([*rows, np.zeros(0, np.uint32)])
    terms, inverse, counts = np.unique(flat, return_inverse=True, return_counts=True)
    toxic = np.bincount(inverse, np.repeat(labels, [len(r) for r in rows]), len(terms))
    n, t = len(rows), float(labels.sum())
    ratio = np.zeros(len(terms))
    for seen, of in ((toxic, t), (counts - toxic, n - t)):
        for part, whole in ((seen, counts), (of - seen, n - counts)):
            expected = whole * (of / max(n, 1))
            ratio += 2 * part * np.log(np.where(part > 0, part, 1) / np.where(part > 0, expected, 1))
    best = np.lexsort((terms, -ratio))[:TERMS]
    return np.sort(terms[best[(ratio[best] >= LEAST_RATIO) & (counts[best] >= 2)]])


def train(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    """Fits the machine to texts, given by their distinct term hashes, and their 0/1 labels."""
    share = float(labels.mean()) if len(labels) else 0.0
    terms = _telling(rows, labels)
    factors = np.random.default_rng(1).normal(0, 0.05, (len(terms), FACTORS)).astype(np.float32)
    if not 0 < share < 1:
        return Model(terms[:0], _logit(share), np.zeros(0, np.float32), factors[:0])
    weights = np.zeros(len(terms), np.float32)
    bias, bias_sum = 0.0, 1e-6
    w_sum, v_sum = np.full(len(terms), 1e-6, np.float32), np.full((len(terms), FACTORS), 1e-6, np.float32)
    known = [np.searchsorted(terms, r)[np.isin(r, terms, assume_unique=True)] for r in rows]
    importance = np.where(labels > 0, 0.5 / share, 0.5 / (1 - share))
    order = np.random.default_rng(2)
    for _ in range(EPOCHS):
        turn = order.permutation(len(rows))
        for at in range(0, len(turn), BATCH):
            batch = turn[at : at + BATCH]
            sizes = np.array([len(known[i]) for i in batch])
            ids = np.concatenate([known[i] for i in batch])
            owner = np.repeat(np.arange(len(batch)), sizes)
            v = factors[ids]
            total = _sums(owner, v, len(batch))
            z = bias + np.bincount(owner, weights[ids], len(batch)) + 0.5 * ((total**2).sum(axis=1) - np.bincount(owner, (v**2).sum(axis=1), len(batch)))
            slope = ((_logistic(z) - labels[batch]) * importance[batch]).astype(np.float32)
            bias_sum += float(slope.sum()) ** 2
            bias -= STEP * float(slope.sum()) / bias_sum**0.5
            places, inverse = np.unique(ids, return_inverse=True)
            g = np.bincount(inverse, slope[owner], len(places)).astype(np.float32) + DECAY * weights[places]
            w_sum[places] += g**2
            weights[places] -= STEP * g / np.sqrt(w_sum[places])
            gv = _sums(inverse, slope[owner][:, None] * (total[owner] - v), len(places)) + DECAY * factors[places]
            v_sum[places] += gv**2
            factors[places] -= STEP * 0.3 * gv / np.sqrt(v_sum[places] + 1e-2)
    return Model(terms, bias, weights, factors)


def _sums(owner: np.ndarray, values: np.ndarray, count: int) -> np.ndarray:
    return np.stack([np.bincount(owner, c, count) for c in values.T], axis=1).astype(np.float32)


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _logit(p: float) -> float:
    p = min(max(p, 1e-12), 1 - 1e-12)
    return float(np.log(p / (1 - p)))


def scores(texts: list[str | None], model: Model) -> np.ndarray:
    """Score of each text, between 0 and 1."""
    z = np.full(len(texts), model.bias)
    for first, owner, terms in term_rows(texts, model.terms):
        if not len(owner):
            continue
        n = int(owner[-1]) + 1
        v = model.factors[terms]
        pairs = (_sums(owner, v, n) ** 2).sum(axis=1) - np.bincount(owner, (v**2).sum(axis=1), n)
        z[first : first + n] += np.bincount(owner, model.weights[terms], n) + 0.5 * pairs
    return _logistic(z)


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic") -> Model:
    """Trains on a bounded sample of the labelled documents.

    The sample's terms come to the driver: of ``2 * PER_LABEL`` distinct texts.
    """
    given = labels.filter(F.col(doc_id).isNotNull() & F.col(label).isNotNull())
    given = given.groupBy(F.col(doc_id).alias("_id")).agg((F.max(label) > 0).cast("int").alias("_label"))
    turn = F.xxhash64(F.col("_id").cast("string"))
    ids = [given.filter(F.col("_label") == k).orderBy(turn, "_id").limit(PER_LABEL) for k in (0, 1)]
    wanted = stored(ids[0].unionAll(ids[1]), "toxicity-ids")
    # At most 2 * PER_LABEL rows, which a hot id joins with all of its documents.
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(wanted), "_id").select("_label", "_text")
    rows = rows.select("_label", F.xxhash64("_text").alias("_th"), "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found: list[bytes] = [b""] * b.num_rows
            for first, owner, terms in term_rows(b.column(2).to_pylist()):
                if len(owner):
                    bounds = np.searchsorted(owner, np.arange(int(owner[-1]) + 2))
                    for k in range(len(bounds) - 1):
                        found[first + k] = terms[bounds[k] : bounds[k + 1]].astype("<u4").tobytes()
            yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(found, pa.binary())], ["label", "th", "terms"])

    held = stored(rows.mapInArrow(run, "label int, th long, terms binary"), "toxicity-terms")
    texts = held.groupBy("th").agg(F.max("label").alias("best")).orderBy(F.xxhash64("th"), "th").limit(2 * PER_LABEL)
    sample = held.join(F.broadcast(texts), "th").groupBy("th").agg(F.max("best").alias("label"), F.first("terms").alias("terms"))
    got = sorted(sample.collect(), key=lambda r: r["th"])
    return train([np.frombuffer(r["terms"], "<u4") for r in got], np.array([r["label"] for r in got], np.float64))


def score_texts(docs: DataFrame, model: Model, text: str = "text", names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """``docs`` with score and 0/1 prediction, in columns called ``names``; only the text column is looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*(c for c in docs.columns if c not in names))
    at = rows.columns.index(text)
    rows = rows.withColumn(names[0], F.lit(0.0)).withColumn(names[1], F.lit(0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            found = scores(b.column(at).to_pylist(), m)
            yield pa.RecordBatch.from_arrays([*b.columns[:-2], pa.array(found), pa.array((found >= 0.5).astype(np.int32))], b.schema.names)

    return rows.mapInArrow(run, rows.schema)
