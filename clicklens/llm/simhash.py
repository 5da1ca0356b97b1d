"""SimHash near-duplicates found through pivot distance tables.

A fingerprint bit is 1 if set in over half of a text's shingle hashes. Equal
fingerprints collapse first, so copies cost one row. Fingerprints within
``max_bits`` agree on at least ``blocks - max_bits`` of ``blocks`` bit blocks
(pigeonhole); rows that share such a set of blocks meet in a bucket. Each
fingerprint carries its Hamming distances to ``N_PIVOTS`` reference
fingerprints; in a bucket, a pair whose distances to any pivot differ by more
than ``max_bits`` is discarded (triangle inequality), and survivors are
verified by their own distance. A task keeps a forest of links, not all pairs,
and buckets past ``TILE`` rows are compared tile by tile in separate tasks.

Defined cases: null and empty texts, and texts without words, have fingerprint
zero and are linked like any other; fewer words than a shingle form one
shingle; repeated rows are all returned; null doc_ids are returned and take no
part in the smallest id of a component (null if all of it are); an empty table
gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, small_side, stored
from .components import components

SEED = 42
NULL_ID = -(1 << 63)
N_PIVOTS = 32
#: Rows of a bucket that one task compares with one another.
TILE = 4096
_WORDS = re.compile(WORD).findall
_LOWER = {c: c + 32 for c in range(65, 91)}


def _simhash(text: str | None, shingle: int) -> int:
    words = _WORDS(text.translate(_LOWER)) if text else []
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    ones, n = np.zeros(64, np.int64), max(1, len(words) - shingle + 1)
    for at in range(0, n, 1 << 16):  # bounded arrays for very long texts
        part = words[at : at + (1 << 16) + shingle - 1]
        if len(part) <= shingle:
            h = [digest(" ".join(part), SEED)]
        else:
            h = [digest(" ".join(g), SEED) for g in zip(*(part[i:] for i in range(shingle)), strict=False)]
        bits = np.unpackbits(np.array(h, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist())


def fingerprints(docs: DataFrame, shingle: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, th, fp): the 64-bit fingerprint of each whole text, as a signed long; th is a hash that tells texts apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([_simhash(t, shingle) for t in b.column(2).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps.view(np.int64))], ["doc_id", "th", "fp"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, th long, fp long")


def pivots(n: int = N_PIVOTS) -> np.ndarray:
    """Reference fingerprints: fixed by the seed, spread evenly."""
    return np.random.default_rng(SEED).integers(0, 1 << 64, n, dtype=np.uint64)


def bit_blocks(n_distinct: int, max_bits: int, rows_per_bucket: int = 4) -> tuple[int, int]:
    """(blocks, agreeing): blocks of the 64 bits, and how many must agree so that buckets stay small.

    ``blocks = max_bits + agreeing``; the agreeing blocks hold about log2 of
    the distinct fingerprints, so a bucket of unrelated rows has a few.
    """
    need = math.log2(max(2, n_distinct / rows_per_bucket))
    agreeing = 1
    while agreeing < 8 and 64 * agreeing / (max_bits + agreeing) < need:
        agreeing += 1
    return max_bits + agreeing, agreeing


def _linked(fp: np.ndarray, key: np.ndarray, table: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among rows of equal key; ``key`` is sorted."""
    n = len(fp)
    root = np.arange(n)
    left, right = [], []
    refs = pivots(table.shape[1])[:, None]
    alive = np.arange(n - 1)
    shift = 1
    while len(alive):
        alive = alive[alive + shift < n]
        alive = alive[key[alive] == key[alive + shift]]
        a = alive[root[alive] != root[alive + shift]]
        for p in range(len(refs)):  # the pivot table: discard by one coordinate after another
            if not len(a):
                break
            a = a[np.abs(table[a, p] - table[a + shift, p]) <= max_bits]
        a = a[np.bitwise_count(fp[a] ^ fp[a + shift]) <= max_bits]
        joined = False
        for i in a.tolist():
            x, y = i, i + shift
            while root[x] != x:
                x = root[x]
            while root[y] != y:
                y = root[y]
            if x != y:
                root[max(x, y)] = min(x, y)
                left.append(i)
                right.append(i + shift)
                joined = True
        while joined and not np.array_equal(up := root[root], root):
            root = up
        shift += 1
    return np.array(left, np.int64), np.array(right, np.int64)


def _compare(max_bits: int, n_pivots: int):
    """Streams rows sorted by key; whole keys are compared together, several at a time."""

    def links(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["k", "t", "u"], kind="stable")
        fp = frame["fp"].to_numpy(np.int64).view(np.uint64)
        group = frame.groupby(["k", "t", "u"], sort=False).ngroup().to_numpy()
        table = np.bitwise_count(fp[:, None] ^ pivots(n_pivots)[None, :]).astype(np.int16)
        a, b = _linked(fp, group, table, max_bits)
        signed = fp.view(np.int64)
        return pd.DataFrame({"a": signed[a], "b": signed[b]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None  # rows of the last key so far, which may go on; a tile pair bounds them
        for frame in batches:
            if not len(frame):
                continue
            rows = frame if held is None else pd.concat([held, frame], ignore_index=True)
            last = rows.iloc[-1]
            open_ = (rows["k"] == last["k"]) & (rows["t"] == last["t"]) & (rows["u"] == last["u"])
            held = rows[open_]
            if not open_.all():
                yield links(rows[~open_])
        if held is not None:
            yield links(held)

    return run


def links(distinct: DataFrame, max_bits: int) -> DataFrame:
    """(a, b): links between distinct fingerprints ``fp`` that connect whatever lies within ``max_bits``."""
    n_blocks, agreeing = bit_blocks(distinct.count(), max_bits)
    edges = [round(64 * i / n_blocks) for i in range(n_blocks + 1)]
    keys = []
    for c, chosen in enumerate(itertools.combinations(range(n_blocks), agreeing)):
        mask = sum(((1 << edges[i + 1]) - (1 << edges[i])) for i in chosen)
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.xxhash64(F.col("fp").bitwiseAND(F.lit(signed)), F.lit(c)))
    rows = distinct.select("fp", F.explode(F.array(*keys)).alias("k"))
    # Buckets of one row need no comparison; large ones are cut into tiles, and each pair of tiles is a task's work.
    sizes = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # Both sides of the join below are plain shuffles, so a hot key can be split.
    sizes = stored(sizes.select("k", F.ceil(F.col("n") / TILE).cast("int").alias("tiles")), "simhash-buckets")
    own = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    met = rows.join(sizes, "k").withColumn("own", own)
    met = met.select("fp", "k", "own", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
    met = met.select("fp", "k", F.least("own", "other").alias("t"), F.greatest("own", "other").alias("u"))
    met = met.repartition("k", "t", "u").sortWithinPartitions("k", "t", "u", "fp")
    return met.mapInPandas(_compare(max_bits, N_PIVOTS), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, shingle: int, max_bits: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, th, fp, component_id, group): component_id is the smallest doc_id reachable over links.

    ``group`` is the component's smallest fingerprint: it tells components
    apart even where ids are null or repeat. ``th`` is a hash of the text.
    """
    prints = stored(fingerprints(docs, shingle, text, doc_id), "simhash")
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "simhash-distinct")
    found = stored(links(distinct.select("fp"), max_bits), "simhash-links")
    member = components(found)  # (node, root) of linked fingerprints
    smallest = member.join(distinct.withColumnRenamed("fp", "node"), "node").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    linked = member.join(smallest, "root").select(F.col("node").alias("fp"), "component_id", F.col("root").alias("group"))
    ids = distinct.join(linked, "fp", "left")
    ids = ids.select("fp", F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("group", "fp").alias("group"))
    ids = stored(ids, "simhash-components")  # a fingerprint may be shared by very many rows: the join can split it
    return prints.join(ids, "fp").select("doc_id", "th", "fp", "component_id", "group")


def one_of_each(docs: DataFrame, shingle: int, max_bits: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with one document of each component: that of the smallest id (null last), then text hash."""
    found = stored(near_duplicates(docs, shingle, max_bits, text, doc_id), "simhash-found")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")
    best = found.groupBy("group").agg(F.min(order).alias("b"))
    own = found.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("_key"), F.col("th").alias("_th"))
    kept = best.select(F.coalesce("b.doc_id", F.lit(NULL_ID)).alias("_key"), F.col("b.th").alias("_th"))
    gone = stored(own.distinct().join(kept.distinct(), ["_key", "_th"], "left_anti"), "simhash-gone")
    rows = docs.withColumn("_key", F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID))).withColumn("_th", F.xxhash64(text))
    rows = rows.join(small_side(gone), ["_key", "_th"], "left_anti")
    if own.groupBy("_key", "_th").count().filter("count > 1").limit(1).count():
        rows = rows.dropDuplicates(["_key", "_th"])  # rows of equal id and text are one document
    return rows.select(*docs.columns)


def hex_print(fp) -> F.Column:
    """16 lower-case hex digits of a signed-long fingerprint."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
