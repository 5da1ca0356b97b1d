"""Passages of at least ``PASSAGE`` words that repeat across texts, by sparse suffix arrays.

1. Of every run of ``WINDOW`` word positions, the one whose next ``HEAD`` words
hash lowest (a minimiser) is retained, so any shared passage of
``HEAD + WINDOW - 1 = PASSAGE`` words retains the same suffix in both texts.
2. Retained suffixes are sorted by their heads, in ranges that may split a
head over tasks, and compared with their neighbours; undecided heads at the
edges of ranges are settled by one small aggregation. 3. Matches are extended
left and right: all windows of ``PASSAGE`` words around a shared suffix are
sorted and compared in the same way, and the shared ones joined to spans.

The result is exact: the words covered by windows of ``PASSAGE`` words that
occur in two different texts. Equal texts are one text with several
documents; they are spans as a whole. Nothing is compared pair by pair.

Words are runs without white space, compared as they stand. Defined cases:
null, empty and shorter texts have no spans; repeats within one text alone do
not count; rows of equal id and text are one document; null ids are carried;
an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import span_hashes, stored, word_hashes

PASSAGE, WINDOW = 50, 32
HEAD = PASSAGE - WINDOW + 1
KEYS = "key long, th long, pos int"
NULL_ID = -(1 << 63)


def _signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def minimisers(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions retained in a text's words, and the hashes of their heads."""
    n = len(words)
    if n < PASSAGE:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.arange(n - HEAD + 1)
    heads = span_hashes(words, at, at + HEAD)
    low = np.lib.stride_tricks.sliding_window_view(heads, WINDOW).argmin(axis=1)
    kept = np.unique(low + np.arange(len(low)))
    return kept, heads[kept]


def _sections(h: np.ndarray, size: int = 1 << 20) -> Iterator[tuple[int, np.ndarray]]:
    """A text's words in sections that overlap by a passage, so that arrays stay bounded."""
    for a in range(0, max(1, len(h) - PASSAGE + 1), size):
        yield a, h[a : a + size + PASSAGE - 1]


def _batch(keys: list[np.ndarray], ths: list[np.ndarray], poss: list[np.ndarray], extra: list | None = None) -> pa.RecordBatch:
    cat = lambda parts, kind: np.concatenate(parts).astype(kind, copy=False) if parts else np.zeros(0, kind)
    columns = [pa.array(cat(keys, np.int64)), pa.array(cat(ths, np.int64)), pa.array(cat(poss, np.int32))]
    return pa.RecordBatch.from_arrays(columns, ["key", "th", "pos"])


def suffixes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(key, th, pos) of retained suffixes and, with key null, (doc_id, th, pos = words) of each text long enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                ths, ids = part.column(1).to_numpy(), part.column(0)
                texts = [t.encode("utf-8", "surrogatepass") for t in part.column(2).to_pylist()]
                keys, owner, poss, size = [], [], [], []
                for first, h, cuts in word_hashes(texts):
                    for k, (a, z) in enumerate(zip(cuts, cuts[1:], strict=False)):
                        size.append(z - a)
                        for shift, words in _sections(h[a:z]):
                            p, head = minimisers(words)
                            keys.append(_signed(head))
                            owner.append(np.full(len(p), ths[first + k]))
                            poss.append(p + shift)
                size = np.array(size, np.int32)
                long_ = size >= PASSAGE
                found = _batch(keys, owner, poss)
                n, m = found.num_rows, int(long_.sum())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.concat_arrays([found.column(0), pa.nulls(m, pa.int64())]), pa.concat_arrays([found.column(1), pa.array(ths[long_])]),
                        pa.concat_arrays([found.column(2), pa.array(size[long_])]), pa.concat_arrays([pa.nulls(n, pa.int64()), ids.filter(pa.array(long_))]),
                    ],
                    ["key", "th", "pos", "doc_id"],
                )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), F.col(text).alias("text")).filter(F.col("text").isNotNull())
    return rows.mapInArrow(run, f"{KEYS}, doc_id long")


# ------------------------------------------------------- sort and compare

SHARED, EDGE, MARK = 0, 1, 2


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows, sorted by (key, th, pos), whose key another text has.

    A key that has one text so far at either end of the range is undecided
    (EDGE); a shared key there leaves two of its rows as marks. Rows are held
    only while a key has one text.
    """

    def out(rows: np.ndarray, state: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(rows[0]), pa.array(rows[1]), pa.array(rows[2].astype(np.int32)), pa.array(np.full(rows.shape[1], state, np.int32))], ["key", "th", "pos", "state"])

    held = np.zeros((3, 0), np.int64)
    shared_key, marks, at_start = False, None, True
    for b in batches:
        if not b.num_rows:
            continue
        rows = np.stack([b.column(i).to_numpy().astype(np.int64) for i in range(3)])
        last_key = marks[0, 0] if marks is not None else None
        go_on = shared_key and rows[0, 0] == last_key
        if shared_key and not go_on:
            if at_start:
                yield out(marks, MARK)
            at_start, shared_key = False, False
        rows = np.concatenate([held, rows], axis=1)
        held = np.zeros((3, 0), np.int64)
        first = np.flatnonzero(np.concatenate([[True], rows[0, 1:] != rows[0, :-1]]))
        stop = np.append(first[1:], rows.shape[1])
        many = rows[1, first] != rows[1, stop - 1]
        many[0] |= go_on
        keep = np.repeat(many, stop - first)
        if at_start and len(first) > 1:  # the range's first key has ended
            if many[0]:
                yield out(marks if go_on else rows[:, [0, stop[0] - 1]], MARK)
            else:
                yield out(rows[:, : stop[0]], EDGE)
            at_start = False
        yield out(rows[:, keep], SHARED)
        shared_key = bool(many[-1])
        if shared_key:
            if not (go_on and len(first) == 1):
                marks = rows[:, [first[-1], rows.shape[1] - 1]]
        else:
            held, marks = rows[:, first[-1] :], None
    if held.shape[1]:
        yield out(held, EDGE)
    elif shared_key:
        yield out(marks, MARK)


def shared(rows: DataFrame, name: str) -> DataFrame:
    """The (key, th, pos) rows of a stored table whose key occurs with another th."""
    ordered = rows.repartitionByRange("key", "th", "pos").sortWithinPartitions("key", "th", "pos")
    found = stored(ordered.mapInArrow(_compare, f"{KEYS}, state int"), name)
    # Two keys per range at most are open; their texts decide.
    edges = found.filter(F.col("state") != SHARED)
    keys = edges.groupBy("key").agg(F.min("th").alias("low"), F.max("th").alias("high")).filter("low <> high").select("key")
    more = edges.filter(F.col("state") == EDGE).join(stored(keys, name), "key")
    return found.filter(F.col("state") == SHARED).select("key", "th", "pos").union(more.select("key", "th", "pos"))


def windows(found: DataFrame, docs: DataFrame, texts: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(key, th, pos) of every window of ``PASSAGE`` words that holds a shared suffix's head.

    Of equal texts one document, the first of ``texts``, is read.
    """
    spots = found.groupBy("th").agg(F.sort_array(F.collect_set("pos")).alias("spots")).join(texts.select("th", "doc_key"), "th")
    key = F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID))
    rows = docs.select(key.alias("doc_key"), F.xxhash64(text).alias("th"), F.col(text).alias("text"))
    rows = rows.join(spots, ["doc_key", "th"]).select("th", "spots", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                ths = part.column(0).to_numpy()
                spots = part.column(1).to_pylist()
                texts = [t.encode("utf-8", "surrogatepass") for t in part.column(2).to_pylist()]
                for first, h, cuts in word_hashes(texts):
                    keys, owner, poss = [], [], []
                    for k, (a, z) in enumerate(zip(cuts, cuts[1:], strict=False)):
                        n = z - a - PASSAGE + 1
                        spot = np.array(spots[first + k], np.int64)
                        mark = np.zeros(n + 1, np.int64)  # a suffix's windows start from WINDOW - 1 before it
                        np.add.at(mark, np.maximum(0, spot - WINDOW + 1), 1)
                        np.add.at(mark, np.minimum(n, spot + 1), -1)
                        start = np.flatnonzero(np.cumsum(mark)[:n] > 0)
                        for s in range(0, len(start), 1 << 20):
                            some = start[s : s + (1 << 20)]
                            low = int(some[0])
                            words = h[a + low : a + int(some[-1]) + PASSAGE]
                            keys.append(_signed(span_hashes(words, some - low, some - low + PASSAGE)))
                            owner.append(np.full(len(some), ths[first + k]))
                            poss.append(some)
                    yield _batch(keys, owner, poss)

    return rows.mapInArrow(run, KEYS)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of the union of windows, from (th, pos) sorted."""
    th = start = end = None
    for b in batches:
        if not b.num_rows:
            continue
        t, p = b.column(0).to_numpy(), b.column(1).to_numpy().astype(np.int64)
        new = np.concatenate([[True], (t[1:] != t[:-1]) | (p[1:] > p[:-1] + PASSAGE)])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(t)) - 1
        spans = [[int(t[f]), int(p[f]), int(p[z]) + PASSAGE] for f, z in zip(first, last, strict=True)]
        if th == spans[0][0] and spans[0][1] <= end:
            spans[0][1] = start
        elif th is not None:
            spans.insert(0, [th, start, end])
        th, start, end = spans.pop()
        columns = list(zip(*spans, strict=True)) if spans else [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["th", "start_word", "end_word"])
    if th is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (th, start, end)], ["th", "start_word", "end_word"])


def repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, start_word, end_word, copies): the repeated spans of every document, end exclusive.

    ``copies`` is the number of documents with the same whole text; where it
    is over 1 the document's one span is all of it.
    """
    rows = stored(suffixes(docs, text, doc_id), "suffixes")
    owners = rows.filter("key is null").select("doc_id", "th", F.col("pos").alias("words")).distinct()
    key = F.coalesce("doc_id", F.lit(NULL_ID))
    texts = stored(owners.groupBy("th").agg(F.min(key).alias("doc_key"), F.count(F.lit(1)).alias("copies"), F.max("words").alias("words")), "suffix-texts")
    heads = shared(rows.filter("key is not null").select("key", "th", "pos"), "suffix-heads")
    around = stored(windows(heads.select("th", "pos").distinct(), docs, texts, text, doc_id), "suffix-windows")
    found = shared(around, "suffix-shared").select("th", "pos").distinct()
    spans = found.repartition("th").sortWithinPartitions("th", "pos").mapInArrow(_joined, "th long, start_word long, end_word long")
    single = texts.filter("copies = 1").select("th", "copies").join(spans, "th")
    whole = texts.filter("copies > 1").select("th", "copies", F.lit(0).cast("long").alias("start_word"), F.col("words").cast("long").alias("end_word"))
    parts = stored(single.unionByName(whole), "suffix-spans")  # a text of very many documents: the join can split it
    return owners.join(parts, "th").select("doc_id", "start_word", "end_word", "copies")
