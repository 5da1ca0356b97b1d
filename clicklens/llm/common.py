"""Helpers the operators of this package share."""

from __future__ import annotations

import ctypes
import itertools
import sys
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

# Workers live on from task to task: what they free should go back to the system. Arrow
# takes its memory from malloc, and malloc maps large blocks (option -3) on their own. Of
# smaller ones up to 16 MB stay (option -1), so that arrays in a loop don't get new pages each time.
pa.set_memory_pool(pa.system_memory_pool())
if sys.platform == "linux":
    ctypes.CDLL(None).mallopt(-3, 1 << 20)
    ctypes.CDLL(None).mallopt(-1, 1 << 24)

#: Spaces as the text contracts have them: 0x20 and 0x09-0x0D.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

#: Bytes of text that are hashed at once; bounds the working arrays of a task.
PIECE_BYTES = 1 << 19
#: Bytes whose words are hashed with arrays that stay in a processor's cache; a word's hash does not depend on it.
BLOCK_BYTES = 1 << 16


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared folder and read again.

    Cuts the lineage: what follows survives the loss of an executor without
    running ``df`` a second time, and ``df`` runs once however often it is used.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of two or three numbers that a join may send whole to every task.
BROADCAST_ROWS = 200_000


def small_side(stored_rows: DataFrame) -> DataFrame:
    """A stored side of a join, to be broadcast if it is counted as small; else the join shuffles.

    Either way the join's result is the same; the count reads file footers.
    """
    return F.broadcast(stored_rows) if stored_rows.count() <= BROADCAST_ROWS else stored_rows


def let(name: str, value: str, body: str) -> str:
    """SQL: ``body`` with ``name`` standing for ``value``, which is worked out once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def in_rows(array: str) -> str:
    """SQL: an array (a name) cut into about as many rows as each is long; an empty one has none."""
    width = f"greatest(1, cast(ceil(sqrt(size({array}))) as int))"
    cut = let("_w", width, f"transform(sequence(0, (size({array}) - 1) div _w), _k -> slice({array}, _k * _w + 1, _w))")
    return f"if(size({array}) > 0, {cut}, array())"


def sums_before(numbers: str) -> str:
    """SQL: of each element of an array<int> the sum of those before it.

    A fold that appends to its own array copies it each time; summed row by row
    of ``in_rows`` a copy is a row long at most, so n numbers take n times the root of n.
    """
    fold = "aggregate({0}, named_struct('at', 0, 'to', cast(array() as array<int>)), (_a, _x) -> named_struct('at', _a.at + {1}, 'to', array_append(_a.to, _a.at)))"
    whole = f"flatten(zip_with(_r, {fold.format('_r', '_x.at')}.to, (_s, _o) -> transform(_s.to, _v -> _v + _o)))"
    rows = let("_n", numbers, f"transform({in_rows('_n')}, _c -> {fold.format('_c', '_x')})")
    return f"{let('_r', rows, whole)}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_SPACE_BYTES = _IS_SPACE.tobytes()
_P = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS["p"]) < n:
        size = max(n, PIECE_BYTES + (PIECE_BYTES >> 1))
        for name, base in (("p", _P), ("inv", pow(_P, -1, 1 << 64))):
            with np.errstate(over="ignore"):
                _POWERS[name] = np.concatenate(
                    [np.ones(1, np.uint64), np.cumprod(np.full(size, base, np.uint64), dtype=np.uint64)]
                )
    return _POWERS["p"], _POWERS["inv"]


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values, so that their order and low bits are even."""
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x81DADEF4BC2DD44D)
    h ^= h >> np.uint64(33)
    return h


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit polynomial hash of each ``buf[start:end]`` (``buf``: bytes or any integers)."""
    p, inv = _powers(len(buf) + 1)
    sums = np.empty(len(buf) + 1, np.uint64)
    sums[0] = 0
    sums[1:] = buf
    sums[1:] += np.uint64(1)
    sums[1:] *= p[: len(buf)]
    np.cumsum(sums[1:], out=sums[1:])
    h = sums[ends]
    h -= sums[starts]
    h *= inv[starts]
    length = (ends - starts).astype(np.uint64)
    length *= np.uint64(0xD6E8FEB86659FD93)
    h += length
    return mix64(h)


def _hash_piece(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    buf = np.frombuffer(data, np.uint8)
    space = np.ones(len(buf) + 2, bool)
    space[1:-1] = np.frombuffer(data.translate(_SPACE_BYTES), bool)
    edge = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edge[0::2], edge[1::2]
    hashes = np.empty(len(starts), np.uint64)
    cuts = np.searchsorted(starts, np.arange(0, len(buf) + BLOCK_BYTES, BLOCK_BYTES)).tolist()
    for j, k in itertools.pairwise(cuts):
        if j < k:
            first = starts[j]
            hashes[j:k] = span_hashes(buf[first : ends[k - 1]], starts[j:k] - first, ends[j:k] - first)
    return hashes, starts


def word_hashes(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For groups of whole texts: (index of the first, word hashes, words before each text).

    A group holds about ``PIECE_BYTES``; a longer text is hashed in pieces cut
    at white space and is a group by itself.
    """
    group: list[bytes] = []
    first, size = 0, 0

    def flush():
        data = b"\n".join(group)
        h, starts = _hash_piece(data)
        begin = np.cumsum([0] + [len(t) + 1 for t in group])
        return first, h, np.searchsorted(starts, begin)

    for i, t in enumerate(texts):
        if size + len(t) > PIECE_BYTES and group:
            yield flush()
            group, first, size = [], i, 0
        if len(t) > PIECE_BYTES:
            parts = [_hash_piece(p)[0] for p in pieces(t)]
            h = np.concatenate(parts)
            yield i, h, np.array([0, len(h)])
            first = i + 1
        else:
            group.append(t)
            size += len(t) + 1
    if group:
        yield flush()


def pieces(data: bytes) -> Iterator[bytes]:
    """``data`` in pieces of about ``PIECE_BYTES`` that end at white space."""
    at = 0
    while at < len(data):
        end = at + PIECE_BYTES
        while end < len(data) and not _IS_SPACE[data[end]]:
            end += 1
        yield data[at:end]
        at = end


def ship(spark: SparkSession) -> None:
    """Makes a session ready for these operators; the registered queries call it.

    Sends this package to the executors' Python workers, once per application:
    the same as passing it with ``--py-files``, needed because the workers run
    functions of these modules and need not share the driver's folders. Where
    the session leaves Arrow batches at Spark's default of 10,000 rows, they
    are set to ``BATCH_ROWS``: a row here is a whole text, and both the JVM and
    the worker hold a batch of them.
    """
    if spark.conf.get(_BATCH, "10000") == "10000":
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    sc = spark.sparkContext
    if _SHIPPED.get("app") == sc.applicationId:
        return
    root = Path(__file__).resolve().parents[1]
    file = Path(tempfile.mkdtemp(prefix=f"{root.name}-")) / f"{root.name}.zip"
    with zipfile.ZipFile(file, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(file))
    _SHIPPED["app"] = sc.applicationId


_SHIPPED: dict[str, str] = {}
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 2000
