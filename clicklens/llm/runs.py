"""Periodic runs in texts, found by recompression.

The words of a chunk of whole texts are numbered, with a separator of its own
before, between and after the texts, and compressed in rounds: *block
compression* replaces every maximal stretch of one symbol by a symbol for
(symbol, length); *pair compression* splits the symbols into left and right
ones and replaces every left symbol followed by a right one by a symbol for
the pair. Equal symbols of a round stand for equal words and the rules of all
rounds are a run-length grammar; a text of n words takes O(log n) rounds. The
rounds end when no symbol occurs twice.

A *longest common extension* of two places climbs the rounds while both stand
at the edge of a symbol (one step at most per pair round, one block per block
round brings them there), and descends from the first symbols that differ: a
few array look-ups per round, for all queries of a chunk at once, to the left
as to the right.

A run of period q repeats its words q apart over max(q, 12 - q) places or
more, so every such stretch holds a multiple of that number: the candidates of
all periods form a *harmonic grid*, and those whose two words agree are
extended both ways by the grammar. Extensions are exact and maximal; of one
stretch found for several periods the smallest counts.

Defined cases: null and empty texts have no words and no runs; a text is never
cut, it may fill a chunk by itself (about 150 bytes a word); equal texts have
equal results; null ids and repeated rows are rows like others; an empty table
gives no rows; other columns are kept, those named like a result column are
replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Shortest run; a run also holds its period twice.
LEAST_WORDS = 12
#: Words of texts that are compressed together, and candidates that are extended together.
CHUNK_WORDS, QUERIES = 1 << 17, 1 << 19
#: Times that candidates which lie within a stretch just found are taken out.
SIFTS = 4

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


@dataclass
class Round:
    """Symbols of a round, and for each its symbol in the next one, which covers ``first`` to ``last``."""

    symbols: np.ndarray
    blocks: bool = False
    above: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    first: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    last: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))


def _close(now: Round, begins: np.ndarray, names: np.ndarray) -> Round:
    """Links ``now`` with the round above it, whose symbols begin where ``begins`` is set."""
    now.above = (np.cumsum(begins) - 1).astype(np.int32)
    now.first = np.flatnonzero(begins).astype(np.int32)
    now.last = (np.append(now.first[1:], len(begins)) - 1).astype(np.int32)
    return Round(pd.factorize(names)[0].astype(np.int32))


def compress(words: np.ndarray) -> list[Round]:
    """The rounds of block and pair compression of ``words``, whose first and last symbol occur once."""
    rounds = [Round(pd.factorize(words)[0].astype(np.int32))]
    for salt in range(1, 1 << 20):
        now = rounds[-1]
        s = now.symbols
        if int(s.max()) + 1 == len(s):
            break
        begins = np.append(True, s[1:] != s[:-1])
        if not begins.all():
            now.blocks = True
            at = np.flatnonzero(begins)
            length = np.diff(np.append(at, len(s)))
            rounds.append(_close(now, begins, s[at].astype(np.int64) * (int(length.max()) + 1) + length))
            now = rounds[-1]
            s = now.symbols
        count = int(s.max()) + 1
        mixed = (np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64(salt * 0xD1B54A32D192ED03 & (1 << 64) - 1)
        left = ((mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(63)).astype(bool)[s]
        pairs, others = left[:-1] & ~left[1:], ~left[:-1] & left[1:]
        if others.sum() > pairs.sum():
            pairs = others
        if not pairs.any():
            continue
        begins = np.append(True, ~pairs)
        at = np.flatnonzero(begins)
        double = np.append(pairs, False)[at]
        names = s[at].astype(np.int64)
        names[double] = (names[double] + 1) * count + s[at[double] + 1]
        rounds.append(_close(now, begins, names))
    return rounds


def common_extension(rounds: list[Round], a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
    """Words that agree from places ``a`` and ``b`` on (``step`` 1) or back (-1), those places included; a != b."""
    x, y = a.astype(np.int32), b.astype(np.int32)
    height = np.zeros(len(a), np.int16)
    live = np.arange(len(a))
    for h, r in enumerate(rounds):
        u, v = x[live], y[live]
        same = r.symbols[u] == r.symbols[v]
        height[live] = h
        live, u, v = live[same], u[same], v[same]
        if not len(live):
            break
        near, far = (r.first, r.last) if step > 0 else (r.last, r.first)
        up, vp = r.above[u], r.above[v]
        inside = (near[up] != u) | (near[vp] != v)
        if r.blocks:
            left_u, left_v = (far[up] - u) * step + 1, (far[vp] - v) * step + 1
            ends = inside & (left_u != left_v)
            if ends.any():
                taken = np.minimum(left_u, left_v)[ends] * step
                x[live[ends]], y[live[ends]] = u[ends] + taken, v[ends] + taken
                live, up, vp, inside = live[~ends], up[~ends], vp[~ends], inside[~ends]
        # Within a symbol both stand on its last word or block: what follows begins a symbol.
        x[live], y[live] = up + inside * np.int32(step), vp + inside * np.int32(step)
    for h in range(int(height.max(initial=0)) - 1, -1, -1):
        r = rounds[h]
        near, far = (r.first, r.last) if step > 0 else (r.last, r.first)
        live = np.flatnonzero(height > h)
        up, vp = x[live], y[live]
        u, v = near[up], near[vp]
        same = (r.symbols[u] == r.symbols[v]).astype(np.int32)
        if r.blocks:
            same *= np.minimum((far[up] - u) * step, (far[vp] - v) * step) + 1
        x[live], y[live] = u + same * np.int32(step), v + same * np.int32(step)
    return (x - a) * step


def _stretches(rounds: list[Round], at: np.ndarray, period: np.ndarray, grid: np.ndarray) -> Iterator[np.ndarray]:
    """(start, end, period) of the maximal stretches around candidates, which come sorted by period and place."""
    for sift in range(SIFTS + 1):
        if not len(at):
            return
        chained = np.append(False, (period[1:] == period[:-1]) & (at[1:] - at[:-1] == grid[1:]))
        ask = np.ones(len(at), bool) if sift == SIFTS else ~chained
        i, p = at[ask], period[ask]
        ends = i + common_extension(rounds, i, i + p, 1)
        starts = i - common_extension(rounds, i - 1, i - 1 + p, -1)
        yield np.stack([starts, ends + p, p], axis=1)
        if sift == SIFTS:
            return
        # A candidate inside the stretch of the one its chain begins with would find that again.
        reach = ends[np.cumsum(ask) - 1]
        keep = chained & (at >= reach)
        at, period, grid = at[keep], period[keep], grid[keep]


def maximal_runs(words: np.ndarray, longest: int, least: int = LEAST_WORDS) -> np.ndarray:
    """Runs of ``words`` as rows (start, end, smallest period), sorted by start, then period.

    ``words`` begins and ends with a symbol of its own; no run is longer than ``longest``.
    """
    rounds, found, size = compress(words), [], 0
    waiting: list[tuple[np.ndarray, int, int]] = []
    top = longest // 2

    def flush() -> None:
        at = np.concatenate([w[0] for w in waiting])
        counts = [len(w[0]) for w in waiting]
        period = np.repeat([w[1] for w in waiting], counts)
        grid = np.repeat([w[2] for w in waiting], counts)
        for s in _stretches(rounds, at, period, grid):
            found.append(s[s[:, 1] - s[:, 0] >= np.maximum(least, 2 * s[:, 2])])
        waiting.clear()

    s = rounds[0].symbols
    for p in range(1, top + 1):
        grid = max(p, least - p)
        agree = np.flatnonzero(s[: len(s) - p : grid] == s[p::grid])
        if len(agree):
            waiting.append((agree * grid, p, grid))
            size += len(agree)
            if size >= QUERIES:
                flush()
                size = 0
    if waiting:
        flush()
    if not found:
        return np.zeros((0, 3), np.int64)
    runs = np.concatenate(found).astype(np.int64)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    runs = runs[np.append(True, (runs[1:, :2] != runs[:-1, :2]).any(axis=1))] if len(runs) else runs
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


class _Numbers(dict):
    """Numbers of the words met, counted from 0."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _chunk(texts: list[list[bytes]], least: int) -> Iterator[tuple[np.ndarray, bytes]]:
    """Runs and kept words of each text of a chunk."""
    numbers = _Numbers()
    sizes = np.array([len(t) for t in texts])
    begins = np.cumsum(sizes + 1) - sizes
    words = np.empty(int(sizes.sum()) + len(texts) + 1, np.int64)
    words[0] = -1
    for k, (b, t) in enumerate(zip(begins, texts, strict=True)):
        words[b : b + len(t)] = list(map(numbers.__getitem__, t))
        words[b + len(t)] = -2 - k
    runs = maximal_runs(words, int(sizes.max()), least)
    after = np.zeros(len(words) + 1, np.int64)
    np.add.at(after, runs[:, 0] + runs[:, 2], 1)
    np.add.at(after, runs[:, 1], -1)
    dropped = np.cumsum(after) > 0
    cuts = np.searchsorted(runs[:, 0], np.append(begins, len(words)))
    for k, (b, t) in enumerate(zip(begins, texts, strict=True)):
        mine = runs[cuts[k] : cuts[k + 1]]
        if len(mine):
            mine = np.stack([mine[:, 0] - b, mine[:, 1] - mine[:, 0], mine[:, 2]], axis=1)
            t = [t[i] for i in np.flatnonzero(~dropped[b : b + len(t)])]
        yield mine, b" ".join(t)


def find_runs(docs: DataFrame, text: str = "text", least: int = LEAST_WORDS, names: tuple[str, str] = ("runs", "collapsed")) -> DataFrame:
    """``docs`` with each text's runs (by start, then period) and its words less those that a run repeats.

    ``collapsed`` drops every word that lies in a run behind the run's first
    period, and joins the others by one space.
    """
    rows = docs.select(*(c for c in docs.columns if c not in names))
    at = rows.columns.index(text)
    rows = rows.withColumn(names[0], F.lit(None).cast(RUNS)).withColumn(names[1], F.lit(""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column = b.column(at).cast(pa.binary())
            parts, kept, counts = [], [], []
            texts: list[list[bytes]] = []
            room = CHUNK_WORDS
            for i in range(b.num_rows + 1):
                last = i == b.num_rows
                # bytes.split() cuts at 0x20 and 0x09-0x0D.
                t = [] if last else (column[i].as_py() or b"").split()
                if texts and (last or len(t) > room):
                    for runs, words in _chunk(texts, least):
                        parts.append(runs)
                        counts.append(len(runs))
                        kept.append(words)
                    texts, room = [], CHUNK_WORDS
                if not last:
                    texts.append(t)
                    room -= len(t) + 1
            flat = np.concatenate(parts) if parts else np.zeros((0, 3), np.int64)
            lists = pa.ListArray.from_arrays(
                pa.array(np.cumsum([0, *counts]), pa.int32()),
                pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, k])) for k in range(3)], ["start", "length", "period"]),
            )
            yield pa.RecordBatch.from_arrays([*b.columns[:-2], lists, pa.array(kept, pa.binary()).cast(pa.string())], b.schema.names)

    return rows.mapInArrow(run, rows.schema)
