"""Benchmark decontamination by latent semantic retrieval.

1. Passages of 32 words give document frequencies of hashed terms. 2. A
randomised SVD (range finder with power rounds; products with the TF-IDF matrix
run over its rows in Spark) of all passages of the corpus and the benchmark
gives ``RANK`` latent directions, those after the leading few, which only tell
languages apart. Each task sends TERMS x (SKIPPED + RANK + OVERSAMPLE) numbers a round.
3. Every document's windows, at every eighth word, are compared with the
benchmark's passages by cosine in the latent space (each direction scaled to
unit variance). 4. Candidates are checked word by word: the longest common
subsequence of the item and the text around the window, and whether the
item's answer stands there. A document holds an item if the subsequence has
``LCS_SURE`` of its words, or ``LCS_LEAST`` of them and the answer, in some run
of the item's length and a quarter (``STEP`` words at least) on both sides.
5. The cosine can miss such runs, so they are also searched for exactly: of an
item's rarest words, those that may be missing and ``RARE_LEAST`` more, a run
that holds it has at least ``RARE_LEAST``. Runs with as many are counted and
checked like the candidates, so that no pair is lost.

Words are runs of letters and digits, ASCII letters in lower case; a character
of a script written without spaces is a word. An item's answer is its
``answer`` column where the benchmark has one, else its last ``ANSWER_WORDS``
words. Of items of fewer than ``LEAST_WORDS`` words all words must stand in the
text one after another; an item without words is nowhere.

Defined cases: null and empty texts hold nothing; null ids are carried as they
are; repeated documents each give their rows; equal items each match; an empty
corpus or benchmark gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, word_hashes

TERMS = 1 << 14
PASSAGE = 32
STEP = 8
#: Passages of an item: of 32 words, or of 16 where it has fewer than this.
SHORT_ITEM = 25
LEAST_WORDS = 8
#: Directions of the space, after the ``SKIPPED`` leading ones, which tell languages and common words.
RANK, SKIPPED, OVERSAMPLE, ROUNDS, SEED = 96, 8, 16, 2, 11
#: Passages of a stored row, and of the rows that a task works on at once.
PASSAGE_ROWS, CHUNK = 256, 16_384
#: Rows that are summed at once, where those of a term are added up.
FAN = 16
COSINE = 0.6
LCS_SURE, LCS_LEAST, ANSWER_WORDS = 0.75, 0.6, 5
#: Rare words of an item that a run must have to be looked at; any number from 1 gives the same result.
RARE_LEAST = 4
#: Benchmark items that are searched for in one pass over the corpus.
ITEMS_AT_ONCE = 2000
#: Words whose vectors a task holds at once; longer documents go in sections that overlap
#: by OVERLAP words, or by the longest run that is searched for where that is more.
SECTION, OVERLAP, GROUP_WORDS = 24_000, 512, 24_000
ROWS_PER_BLOCK = 64
#: Windows that are compared at once.
WINDOWS = 512

_CLEAN = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


#: Thai, Lao, Burmese, Khmer, kana, Han: their characters, their punctuation, and the first bytes of both in UTF-8.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3021-\u3029\u3031-\u30fa\u30fc-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]")
_UNSPACED_MARKS = re.compile("[\u3000-\u3004\u3008-\u3020\u3030\u30fb\uff01-\uff0f\uff1a-\uff20\uff3b-\uff40\uff5b-\uff65]+")
_UNSPACED_LEADS = [bytes([b]) for b in (0xE0, 0xE1, *range(0xE3, 0xEA), 0xEF, 0xF0)]


def _clean(text: str) -> bytes:
    data = text.encode("utf-8", "replace")
    if not text.isascii() and any(b in data for b in _UNSPACED_LEADS):
        data = _UNSPACED.sub(r" \g<0> ", _UNSPACED_MARKS.sub(" ", text)).encode("utf-8", "replace")
    return data.translate(_CLEAN)


def _bytes(texts: list[str | None]) -> list[bytes]:
    return [_clean(t) if t else b"" for t in texts]


def _terms(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(50)).astype(np.uint16)


def _passages(hashes: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Distinct terms of each passage of 32 words, as rows padded with TERMS."""
    n = np.diff(cuts)
    per = -(-n // PASSAGE)
    base = np.cumsum(per) - per
    owner = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(hashes)) - cuts[:-1][owner]
    rows = np.full((int(per.sum()), PASSAGE), TERMS, np.uint16)
    rows[base[owner] + at // PASSAGE, at % PASSAGE] = _terms(hashes)
    rows.sort(axis=1)
    rows[:, 1:][rows[:, 1:] == rows[:, :-1]] = TERMS
    return rows


def _passage_rows(docs: DataFrame, text: str) -> DataFrame:
    """The passages of all texts, up to ``PASSAGE_ROWS`` of them in a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                for _, h, cuts in word_hashes(_bytes(b.column(0).slice(at, 1000).to_pylist())):
                    rows = _passages(h, cuts)
                    parts = [rows[k : k + PASSAGE_ROWS].tobytes() for k in range(0, len(rows), PASSAGE_ROWS)]
                    yield pa.RecordBatch.from_arrays([pa.array(parts, pa.binary())], ["terms"])

    return docs.select(text).mapInArrow(run, "terms binary")


def _unpacked(column: pa.Array) -> Iterator[np.ndarray]:
    """Passages of packed rows, about ``CHUNK`` at a time."""
    step = CHUNK // PASSAGE_ROWS
    for at in range(0, len(column), step):
        yield np.frombuffer(b"".join(column.slice(at, step).to_pylist()), np.uint16).reshape(-1, PASSAGE)


def _counted(passages: DataFrame) -> tuple[np.ndarray, int]:
    """Passages that hold each term, and all passages; a task sends one row per term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, passages = np.zeros(TERMS + 1, np.int64), 0
        for b in batches:
            for rows in _unpacked(b.column(0)):
                total += np.bincount(rows.ravel(), minlength=TERMS + 1)
                passages += len(rows)
        total[TERMS] = passages
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(TERMS + 1)), pa.array(total)], ["term", "n"])

    found = passages.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(TERMS + 1, np.int64)
    for r in found:  # one row per term
        out[r["term"]] = r["n"]
    return out[:TERMS], int(out[TERMS])


def term_counts(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, int]:
    """Passages that hold each term, and all passages."""
    return _counted(_passage_rows(docs, text))


# ------------------------------------------------------------- latent space


def _row_sums(rows: np.ndarray, table: np.ndarray, sizes: np.ndarray | None = None, block: int = 512) -> np.ndarray:
    """Sums of the rows of ``table`` that each row of ``rows`` lists, a block at a time; a row of zeros follows them.

    With ``sizes``, in descending order, only so many of a row's first numbers count; zeros stand behind them.
    """
    out = np.empty((len(rows) + 1, table.shape[1]), table.dtype)
    out[-1] = 0
    held = np.empty((block, table.shape[1]), table.dtype)
    for at in range(0, len(rows), block):
        width = rows.shape[1] if sizes is None else sizes[at]
        columns = np.ascontiguousarray(rows[at : at + block, :width].T).astype(np.intp)
        total, part = out[at : at + columns.shape[1]], held[: columns.shape[1]]
        np.take(table, columns[0], axis=0, out=total, mode="clip")
        for column in columns[1:]:
            np.take(table, column, axis=0, out=part, mode="clip")
            total += part
    return out


def _sums_by_term(rows: np.ndarray, values: np.ndarray, total: np.ndarray) -> None:
    """Adds to ``total[term]`` the values of the rows that hold the term: sums of ``FAN`` of them, of these, and so on.

    ``values`` has a row of zeros after those of ``rows``.
    """
    order = np.argsort(rows.ravel(), kind="stable").astype(np.int32)
    term = rows.ravel()[order]
    term = term[: np.searchsorted(term, TERMS)].astype(np.int32)
    ids = order[: len(term)] >> np.int32(PASSAGE.bit_length() - 1)
    while len(term):
        first = np.flatnonzero(np.append(True, term[1:] != term[:-1])).astype(np.int32)
        size = np.diff(np.append(first, np.int32(len(term))))
        one = first[size == 1]
        total[term[one]] += values[ids[one]]
        more = np.repeat(size > 1, size)
        first, size = first[size > 1], size[size > 1]
        names, ids = term[first], ids if more.all() else ids[more]
        groups = -(-size // FAN)
        base = np.cumsum(groups) - groups
        listed = np.full(groups.sum() * FAN, len(values) - 1, np.int32)
        listed[np.arange(len(ids), dtype=np.int32) + np.repeat((base * FAN - (np.cumsum(size) - size)).astype(np.int32), size)] = ids
        # By size, so that a block adds up no more than its own largest group has.
        held = np.full(len(listed) // FAN, FAN, np.int8)
        held[base + groups - 1] = size - FAN * (groups - 1)
        by_size = np.argsort(-held, kind="stable")
        values = _row_sums(listed.reshape(-1, FAN)[by_size], values, held[by_size])
        term, ids = np.repeat(names, groups), np.empty(len(held), np.int32)
        ids[by_size] = np.arange(len(held), dtype=np.int32)


def _products(passages: DataFrame, idf: np.ndarray, q: np.ndarray, gram: bool) -> np.ndarray:
    """A^T A q, or with ``gram`` (A q)^T A q, where A's rows are the unit TF-IDF vectors of all ``passages``.

    Tasks send partial products in blocks of ``ROWS_PER_BLOCK`` rows, which
    are summed by block; terms (or directions) times directions come to the driver.
    """
    height, width = (q.shape[1] if gram else TERMS), q.shape[1]
    table = np.vstack([idf[:, None] * q, np.zeros((1, width))]).astype(np.float32)
    shared = passages.sparkSession.sparkContext.broadcast((np.append(idf * idf, np.float32(0)), table))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squares, table = shared.value
        z = np.zeros((height, width), np.float64 if gram else np.float32)
        for b in batches:
            for rows in _unpacked(b.column(0)):
                square = np.maximum(squares[rows].sum(axis=1), 1e-18)[:, None]
                y = _row_sums(rows, table)
                if gram:
                    y[:-1] /= np.sqrt(square)
                    z += y.T @ y
                else:
                    y[:-1] /= square
                    _sums_by_term(rows, y, z)
        blocks = range(0, height, ROWS_PER_BLOCK)
        yield pa.RecordBatch.from_arrays([pa.array([k // ROWS_PER_BLOCK for k in blocks], pa.int64()), pa.array([z[k : k + ROWS_PER_BLOCK].astype(np.float32).tobytes() for k in blocks], pa.binary())], ["block", "part"])

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(len(frame["part"].iloc[0]) // 4)
        for p in sorted(frame["part"]):  # in one order, however they arrive
            total += np.frombuffer(p, np.float32)
        return pd.DataFrame({"block": [frame["block"].iloc[0]], "part": [total.astype(np.float32).tobytes()]})

    found = passages.mapInArrow(run, "block long, part binary").groupBy("block").applyInPandas(add, "block long, part binary").collect()
    out = np.zeros((height, width))
    for r in found:
        out[r["block"] * ROWS_PER_BLOCK : (r["block"] + 1) * ROWS_PER_BLOCK] = np.frombuffer(r["part"], np.float32).reshape(-1, width)
    shared.destroy()
    return out if gram else idf[:, None] * out


@dataclass
class Space:
    projection: np.ndarray  # TERMS + 1 x RANK: idf times the scaled right singular vectors, and zeros for no term
    idf: np.ndarray


def fit(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> Space:
    """The latent space, of all passages of the corpus and the benchmark."""
    passages = stored(_passage_rows(docs, text).union(_passage_rows(benchmark, text)), "latent-passages")
    counts, total = _counted(passages)
    idf = np.log((1 + total) / (1 + counts)).astype(np.float32)
    rng = np.random.default_rng(SEED)
    q = np.linalg.qr(rng.normal(size=(TERMS, SKIPPED + RANK + OVERSAMPLE)))[0]
    for _ in range(ROUNDS):
        q = np.linalg.qr(_products(passages, idf, q, gram=False))[0]
    small = _products(passages, idf, q, gram=True)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(-values)
    order = order[values[order] > 1e-6 * max(values.max(), 1e-12)]  # a small corpus has fewer directions
    # As many directions as passages would set every passage apart, near copies included.
    rank = min(RANK, max(8, total // 4))
    skipped = min(SKIPPED, max(0, len(order) - RANK))
    top = order[skipped : skipped + rank]
    scale = 1 / np.sqrt(values[top])
    projection = idf[:, None] * (q @ vectors[:, top]) * scale
    return Space(np.vstack([projection, np.zeros((1, len(top)))]).astype(np.float32), idf)


# ------------------------------------------------------------------- search


@dataclass
class Rare:
    """Rare words of items: any run of words that holds item i has ``least[i]`` of the item's."""

    seen: np.ndarray  # by the top SEEN_BITS of a hash: whether a word may be one of them
    words: np.ndarray  # sorted; the items of words[k] are items[cuts[k]:cuts[k + 1]]
    cuts: np.ndarray
    items: np.ndarray
    least: np.ndarray


@dataclass
class Items:
    """Benchmark items that are searched for together."""

    ids: list[int | None]
    words: list[np.ndarray]
    answers: list[np.ndarray]
    queries: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # by window steps: vectors, item, offset in the item
    passages: list[tuple[int, np.ndarray]]  # of each item: words of a passage, vectors
    widths: np.ndarray  # words of the runs that are searched for each item
    needs: np.ndarray  # words of each item that such a run must have in order
    needed: list[int]  # the same as a list
    sizes: np.ndarray  # words of each item
    slacks: np.ndarray  # words that may stand before and behind it
    least: list[float]  # share of each item that holds with the answer, and without
    sure: list[float]
    known: list[np.ndarray]  # distinct words of each item, sorted
    masks: list[dict[int, int]]  # of each item's words, see _lcs_length
    rare: Rare


SEEN_BITS = 20


def _seen(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SEEN_BITS)).astype(np.int64)


def _slack(words: np.ndarray) -> int:
    return max(STEP, len(words) // 4)


def _rare(words: list[np.ndarray], needs: np.ndarray, idf: np.ndarray) -> Rare:
    least = np.minimum(needs, RARE_LEAST)
    # At most len - need of an item's words are missing, so that ``least`` of these are there.
    own = [np.unique(w[np.argsort(-idf[_terms(w)], kind="stable")[: len(w) - n + k]]) for w, n, k in zip(words, needs, least, strict=True)]
    hashes = np.concatenate([np.zeros(0, np.uint64), *own])
    items = np.repeat(np.arange(len(own), dtype=np.int32), [len(o) for o in own])
    order = np.argsort(hashes, kind="stable")
    found, cuts = np.unique(hashes[order], return_index=True)
    seen = np.zeros(1 << SEEN_BITS, bool)
    seen[_seen(found)] = True
    return Rare(seen, found, np.append(cuts, len(hashes)), items[order], least)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def _one(text: str | None) -> np.ndarray:
    found = list(word_hashes(_bytes([text])))
    return found[0][1] if found else np.zeros(0, np.uint64)


def items_of(rows: list[tuple[int | None, str | None, str | None]], space: Space) -> Items:
    ids, words, answers, passages, widths, needs, least, sure = [], [], [], [], [], [], [], []
    found: dict[int, list[tuple[np.ndarray, int, int]]] = {PASSAGE // STEP: [], PASSAGE // STEP // 2: []}
    for item, text, answer in rows:
        w = _one(text)
        if not len(w):
            continue
        short = len(w) < LEAST_WORDS  # searched for word by word only
        a = _one(answer)
        size = PASSAGE if len(w) >= SHORT_ITEM else PASSAGE // 2
        starts = sorted({*range(0, max(1, len(w) - size + 1), size), max(0, len(w) - size)})
        made = [space.projection[_terms(w[s : s + size])].sum(axis=0) for s in starts]
        if not short:
            found[size // STEP] += [(v, len(ids), s) for v, s in zip(made, starts, strict=True)]
        passages.append((min(size, len(w)), _unit(np.stack(made))))
        widths.append(len(w) if short else len(w) + 2 * _slack(w))
        needs.append(len(w) if short else math.ceil(LCS_LEAST * len(w) - 1e-6))
        least.append(1.0 if short else LCS_LEAST)
        sure.append(1.0 if short else LCS_SURE)
        ids.append(item)
        words.append(w)
        answers.append(a if len(a) else w[-ANSWER_WORDS:])
    queries = {k: (_unit(np.stack([f[0] for f in v])), np.array([f[1] for f in v]), np.array([f[2] for f in v])) for k, v in found.items() if v}
    needed, needs = needs, np.array(needs, np.int64)
    sizes, slacks = (np.array([f(w) for w in words], np.int64) for f in (len, _slack))
    return Items(ids, words, answers, queries, passages, np.array(widths, np.int64), needs, needed, sizes, slacks, least, sure, [np.unique(w) for w in words], [_masks(w) for w in words], _rare(words, needs, space.idf))


def _masks(item: np.ndarray) -> dict[int, int]:
    """The places of each word of an item, as bits."""
    masks: dict[int, int] = {}
    for i, w in enumerate(item.tolist()):
        masks[w] = masks.get(w, 0) | 1 << i
    return masks


def _lcs_length(masks: dict[int, int], size: int, text: list[int], least: int = 0) -> int:
    """Length of the longest common subsequence, a text word at a time on the item's bits; 0 if it cannot be ``least``."""
    found = [*filter(None, map(masks.get, text))]
    if len(found) < least:
        return 0
    row = full = (1 << size) - 1
    for m in found:
        u = row & m
        row = ((row + u) | (row - u)) & full
    return size - row.bit_count()


def _lcs(item: np.ndarray, text: list[int]) -> int:
    return _lcs_length(_masks(item), len(item), text)


def _holds(text: np.ndarray, part: np.ndarray) -> bool:
    if not len(part) or len(text) < len(part):
        return False
    found = text[: len(text) - len(part) + 1] == part[0]
    for k in range(1, len(part)):
        if not found.any():
            return False
        found &= text[k : k + len(found)] == part[k]
    return bool(found.any())


def _sections(groups, items: Items | None = None) -> Iterator[list[tuple[int, int, np.ndarray]]]:
    """(text, first word, words) sections, in lists of about GROUP_WORDS words; any run of an item's width is whole in one."""
    overlap = max(OVERLAP, int(items.widths.max(initial=0)) if items else 0)
    held: list[tuple[int, int, np.ndarray]] = []
    size = 0
    for first, h, cuts in groups:
        for k, (a, b) in enumerate(itertools.pairwise(cuts.tolist())):
            for s in range(a, max(a + 1, b - overlap), SECTION):
                part = h[s : min(b, s + SECTION + overlap)]
                if not len(part):
                    continue
                held.append((first + k, s - a, part))
                size += len(part)
                if size >= GROUP_WORDS:
                    yield held
                    held, size = [], 0
    if held:
        yield held


def _matches(sections: list[tuple[int, int, np.ndarray]], space: Space, items: Items) -> Iterator[tuple[int, int, float, float, int, bool]]:
    """(text, item, cosine, share of the item in order, first word, answer found) of verified candidates."""
    sizes = np.array([len(s[2]) for s in sections])
    terms = np.append(_terms(np.concatenate([s[2] for s in sections])), np.uint16(TERMS))
    per = -(-sizes // STEP)
    base, begin = np.cumsum(per) - per, np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(sections)), per)
    place = ((begin - base * STEP)[owner] + np.arange(per.sum()) * STEP)[:, None] + np.arange(STEP)
    # Behind the end of a section stands no term, nor behind the last section.
    place = np.where(place < (begin + sizes)[owner, None], place, len(terms) - 1)
    behind = np.full((PASSAGE // STEP, STEP), len(terms) - 1)
    padded = _row_sums(terms[np.concatenate([place, behind])], space.projection)
    sums = padded[: len(place)]
    end = (base + per)[owner]
    for steps, (vectors, item, offset) in items.queries.items():
        # A window is ``steps`` sums of its section from each start on; a short section is one window.
        every = np.arange(len(sums))
        inside = every + steps <= end
        first = inside | (every == base[owner])
        start, query, near = [], [], []
        for at in range(0, len(sums), WINDOWS):
            windows = sums[at : at + WINDOWS].copy()
            for j in range(1, steps):
                windows += padded[at + j : at + j + len(windows)]
            for k in np.flatnonzero(first[at : at + WINDOWS] & ~inside[at : at + WINDOWS]).tolist():
                windows[k] = sums[at + k : end[at + k]].sum(axis=0)
            product = windows @ vectors.T
            size = np.maximum(np.sqrt(np.einsum("ij,ij->i", windows, windows)), 1e-9)
            w, q = np.divmod(np.flatnonzero((product > np.where(first[at : at + WINDOWS], COSINE * size, np.inf)[:, None]).ravel()), len(vectors))
            start.append(at + w)
            query.append(q)
            near.append(product[w, q] / size[w])
        start, query, near = (np.concatenate(x) for x in (start, query, near))
        # Passages of an item that point to the same place of it in the text are one candidate, with the best cosine.
        k, i, at = owner[start], item[query], (start - base[owner[start]]) * STEP - offset[query]
        order = np.lexsort((-near, at, i, k))
        k, i, at, near = k[order], i[order], at[order], near[order]
        fresh = np.append(True, (k[1:] != k[:-1]) | (i[1:] != i[:-1]) | (at[1:] != at[:-1]))[: len(k)]
        k, i, at, near = k[fresh], i[fresh], at[fresh], near[fresh]
        lo, hi = np.maximum(0, at - items.slacks[i]), at + items.sizes[i] + items.slacks[i]
        for k, i, lo, hi, near in zip(k.tolist(), i.tolist(), lo.tolist(), hi.tolist(), near.tolist(), strict=True):
            own = items.words[i]
            share = _lcs_length(items.masks[i], len(own), sections[k][2][lo:hi].tolist(), items.needed[i]) / len(own)
            if share >= LCS_LEAST:
                text, shift, words = sections[k]
                answer = _holds(words[lo:hi], items.answers[i])
                if share >= LCS_SURE or answer:
                    yield text, i, near, share, shift + lo, answer
    yield from _exact_matches(sections, space, items)


def _rare_runs(words: np.ndarray, begin: np.ndarray, items: Items) -> Iterator[tuple[int, int, int, int]]:
    """(section, item, first, last): where a run of the item's width may start, by the rare words in it."""
    rare = items.rare
    at = np.flatnonzero(rare.seen[_seen(words)])
    if not len(at):
        return
    k = np.minimum(np.searchsorted(rare.words, words[at]), len(rare.words) - 1)
    same = rare.words[k] == words[at]
    at, k = at[same], k[same]
    n = rare.cuts[k + 1] - rare.cuts[k]
    item = rare.items[np.repeat(rare.cuts[k] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
    order = np.argsort(item, kind="stable")
    item, word = item[order], np.repeat(at, n)[order]
    section = np.searchsorted(begin, word, "right") - 1
    end = np.arange(len(item)) + rare.least[item] - 1
    a = np.flatnonzero(end < len(item))
    b = end[a]
    near = (item[a] == item[b]) & (section[a] == section[b]) & (word[b] - word[a] < items.widths[item[a]])
    a, b = a[near], b[near]
    if not len(a):
        return
    item, section, last = item[a], section[a], word[a]
    first = np.maximum(begin[section], word[b] - items.widths[item] + 1)
    fresh = np.flatnonzero(np.concatenate([[True], (item[1:] != item[:-1]) | (section[1:] != section[:-1]) | (first[1:] > last[:-1] + 1)]))
    yield from zip(section[fresh].tolist(), item[fresh].tolist(), first[fresh].tolist(), last[np.append(fresh[1:], len(a)) - 1].tolist(), strict=True)


def _best_run(items: Items, i: int, text: np.ndarray, first: int, last: int, best: tuple | None) -> tuple | None:
    """(share, answer found, start) of the best run that holds the item, of those starting from first to last.

    What a range of runs has together bounds each of them; ranges are halved.
    """
    own, width = items.words[i], int(items.widths[i])
    ranges = [(first, last)]
    while ranges:
        x, y = ranges.pop()
        part = text[x : y + width]
        share = _lcs_length(items.masks[i], len(own), part.tolist(), items.needed[i]) / len(own)
        if share < items.least[i] or best and share < best[0]:
            continue
        holds = _holds(part, items.answers[i])
        if share < items.sure[i] and not holds or best and (share, holds) <= best[:2]:
            continue
        if x == y:
            best = (share, holds, x)
        else:
            ranges += [((x + y) // 2 + 1, y), (x, (x + y) // 2)]
    return best


def _exact_matches(sections: list[tuple[int, int, np.ndarray]], space: Space, items: Items) -> Iterator[tuple[int, int, float, float, int, bool]]:
    """The same for the best run of each section and item, found without the latent space."""
    sizes = np.array([len(s[2]) for s in sections])
    begin = np.cumsum(sizes) - sizes
    best: dict[tuple[int, int], tuple] = {}
    for k, i, first, last in _rare_runs(np.concatenate([s[2] for s in sections]), begin, items):
        old = best.get((k, i))
        if old and old[:2] == (1.0, True):
            continue
        first, last, width = first - int(begin[k]), last - int(begin[k]), int(items.widths[i])
        known, words = items.known[i], sections[k][2]
        part = words[first : last + width]
        own = known.take(known.searchsorted(part), mode="clip") == part
        if np.count_nonzero(own) < items.needed[i]:
            continue
        count = np.append(0, np.cumsum(own))
        start = np.arange(last - first + 1)
        full = count[np.minimum(start + width, len(count) - 1)] - count[start] >= items.needs[i]
        edge = np.flatnonzero(np.diff(full, prepend=False, append=False)) + first
        for x, y in zip(edge[0::2].tolist(), edge[1::2].tolist(), strict=True):
            old = _best_run(items, i, words, x, y - 1, old)
        if old:
            best[k, i] = old
    for (k, i), (share, answer, start) in best.items():
        text, shift, words = sections[k]
        own = items.words[i]
        around = words[start : start + int(items.widths[i])]
        size, vectors = items.passages[i]
        # The match starts with the last word from which on the run has as much of the item.
        low, high = 0, len(around) - 1
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if _lcs_length(items.masks[i], len(own), around[middle:].tolist()) / len(own) == share else (low, middle - 1)
        sums = np.cumsum(np.vstack([np.zeros((1, vectors.shape[1])), space.projection[_terms(around)]]), axis=0)
        size = min(size, len(around))
        cosine = float((_unit(sums[size:] - sums[: len(sums) - size]) @ vectors.T).max())
        yield text, i, cosine, share, shift + max(0, start + low - _slack(own)), answer


RESULT = "doc_id long, item_id long, cosine double, lcs double, first_word long, answer boolean"


def search(docs: DataFrame, space: Space, items: Items, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast((space, items))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, items = shared.value
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                ids, texts = b.column(0).slice(at, 1000).to_pylist(), b.column(1).slice(at, 1000).to_pylist()
                best: dict[tuple[int, int], tuple] = {}
                for group in _sections(word_hashes(_bytes(texts)), items):
                    for k, item, cosine, share, word, answer in _matches(group, space, items):
                        old = best.get((k, item))
                        if old is None or (share, answer, cosine, -word) > (old[1], old[3], old[0], -old[2]):
                            best[k, item] = (cosine, share, word, answer)
                rows = [(ids[k], items.ids[i], *best[k, i]) for k, i in sorted(best)]
                columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], [c.split()[0] for c in RESULT.split(", ")])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, RESULT)


def contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id") -> DataFrame:
    """(doc_id, item_id, cosine, lcs, first_word, answer): the items that documents hold.

    The benchmark goes through the driver in blocks of ``ITEMS_AT_ONCE`` items,
    each searched for in a pass over the corpus.
    """
    space = fit(docs, benchmark, text)
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")
    rows = benchmark.select(F.col(item_id).cast("long"), F.col(text), answer).toLocalIterator()
    found = None
    while block := [tuple(r) for r in itertools.islice(rows, ITEMS_AT_ONCE)]:
        part = search(docs, space, items_of(block, space), text, doc_id)
        found = part if found is None else found.union(part)
    return docs.sparkSession.createDataFrame([], RESULT) if found is None else found
