"""Token-ID output as static range-ANS blocks.

Texts become token ids; one frequency table, counted over all ids, is shared
by every block. A block holds consecutive ids of a shard and is coded by
``LANES`` interleaved 64-bit range-ANS states that emit 32-bit words. Every
``STEPS_PER_CHECKPOINT`` steps the states are kept as a checkpoint, so the
segments between checkpoints decode side by side, within and across blocks.

File format (a folder): ``blocks/`` is Parquet with one row per block (shard,
block number, tokens before it in the shard, document ids and token counts,
words, checkpoint states, words per segment, CRC-32), ``table/`` is Parquet
with the frequency of each id, ``scale`` bits being the sum of frequencies.
Shards are ranges of ascending doc_id; order is (shard, block, position).

Defined cases: a null text is empty; an empty text is its end id alone; null
doc_ids come first; rows with equal doc_id are all kept, ordered by their ids;
an empty table gives a folder without blocks. Other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
import os
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import span_hashes, stored

LANES = 256
STEPS_PER_CHECKPOINT = 256
BLOCK_TOKENS = LANES * STEPS_PER_CHECKPOINT * 4
GROUP = 16  # blocks coded at once in a task
LOW = np.uint64(1 << 31)
#: Distinct words whose ids a worker remembers, at some 40 bytes each; past it, the memory starts anew.
CACHE_WORDS = 1_500_000

IDS = "doc_id long, n_tokens long, ids binary"
BLOCKS = (
    "shard int, block int, offset long, n_tokens int, first_doc long, head_open boolean, tail_open boolean,"
    " doc_ids array<long>, doc_tokens array<int>, words binary, states binary, segment_words binary, crc long"
)


# ---------------------------------------------------------------- text to ids

#: A comma or full stop that belongs to a run of marks, so that its word must stay whole.
_ODD_MARK = r"[^\p{L}\p{N}\s][,.][ \n]"
#: Texts whose words are encoded together.
SLICE = 1000


#: What may be a special token, and the one letter whose lower case ends in a mark, which belongs to the punctuation behind it.
_NOT_BY_WORD = "<\\||\u0130"


class TextEncoder:
    """Encodes texts with a tokenizer that cuts at white space and ignores case.

    Each distinct word of a worker's recent texts goes to the tokenizer once;
    ids of a text are those of its words in a row. A tokenizer of another kind
    gets whole texts.
    """

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are the parallelism
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.model = self.tokenizer.model
        # The visible character that stands for each byte of a word of letters.
        alone = ByteLevel(add_prefix_space=False, use_regex=False)
        self.shown = {c: "".join(p for p, _ in alone.pre_tokenize_str(chr(c))) for c in range(128, 0x250) if chr(c).isalpha()}
        self.forget()
        self.by_word = '"type":"Lowercase"' in tokenizer_json.replace(" ", "") and self._cuts_at_spaces()

    def forget(self) -> None:
        """Starts the memory anew: sorted hashes of words, and where their ids stand in ``table``."""
        self.hashes, self.rows = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.table, self.begin, self.sizes = np.zeros(0, np.uint32), np.zeros(0, np.int32), np.zeros(0, np.int32)

    def _cuts_at_spaces(self) -> bool:
        probe = ["One two,  three.\nfour\tfive\r\nsix", "a.b, c,d . e", "naïve Café. x", "Straße über’s ÉTÉ. won't ***, ok"]
        want = [i for ids in self._whole(probe) for i in ids]
        return self._by_words(pa.array(probe))[0].tolist() == want

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _letters(self, words: list[str]) -> list[list[int] | None]:
        """Ids of words that are one run of lower-case Latin letters, straight from the tokenizer's model; else None."""
        tokenize, shown, out = self.model.tokenize, self.shown, []
        for w in words:
            if not w.isalpha():
                out.append(None)
                continue
            if not w.isascii():
                if max(w) > "\u024f" or not w.islower() or not unicodedata.is_normalized("NFC", w):
                    out.append(None)
                    continue
                w = w.translate(shown)
            out.append([t.id for t in tokenize(w)])
        return out

    def _learn(self, words: list[str], hashes: np.ndarray) -> None:
        ids = self._letters(words)
        rest = [i for i, x in enumerate(ids) if x is None]
        for i, x in zip(rest, self._whole([words[i] for i in rest]), strict=True):
            ids[i] = x
        sizes = np.fromiter(map(len, ids), np.int32, len(ids))
        rows = np.arange(len(self.sizes), len(self.sizes) + len(ids), dtype=np.int32)
        self.begin = np.concatenate([self.begin, (len(self.table) + np.cumsum(sizes) - sizes).astype(np.int32)])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.table = np.concatenate([self.table, np.fromiter(itertools.chain.from_iterable(ids), np.uint32, int(sizes.sum()))])
        order = np.argsort(hashes)
        at = np.searchsorted(self.hashes, hashes[order])
        self.hashes, self.rows = np.insert(self.hashes, at, hashes[order]), np.insert(self.rows, at, rows[order])

    def _rows(self, words: pa.StringArray) -> np.ndarray:
        """Rows of distinct words, by 64-bit hash; the words that are not remembered are learned."""
        offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
        data = np.frombuffer(words.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if len(words) else np.zeros(0, np.uint8)
        hashes = span_hashes(data, offsets[:-1] - offsets[0], offsets[1:] - offsets[0])
        if len(self.hashes) > CACHE_WORDS:
            self.forget()
        at = np.searchsorted(self.hashes, hashes)
        known = np.append(self.hashes, np.uint64(0))[at] == hashes
        known &= at < len(self.hashes)
        if not known.all():
            self._learn(words.filter(pa.array(~known)).to_pylist(), hashes[~known])
            at = np.searchsorted(self.hashes, hashes)
        return self.rows[at]

    def _by_words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        low = pc.ascii_lower(texts)
        odd = pc.match_substring_regex(low, _ODD_MARK)
        apart = low
        for mark in (", ", ". ", ",\n", ".\n"):
            apart = pc.replace_substring(apart, mark, f" {mark[0]} ")
        apart = pc.replace_substring_regex(apart, r"([\p{L}\p{N}])([,.])$", r"\1 \2")
        lists = pc.ascii_split_whitespace(pc.if_else(odd, low, apart))
        words = lists.flatten().dictionary_encode()
        index = self._rows(words.dictionary)[words.indices.to_numpy(zero_copy_only=False)]
        n = self.sizes[index]
        stop = np.cumsum(n, dtype=np.int64)
        total = int(stop[-1]) if len(stop) else 0
        at = np.repeat((self.begin[index] - (stop - n)).astype(np.int32), n)
        at += np.arange(total, dtype=np.int32)
        cuts = lists.offsets.to_numpy()
        return self.table[at], np.concatenate([[0], stop])[cuts - cuts[0]]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and where each text's ids begin and the last one's end."""
        special = pc.match_substring_regex(texts, _NOT_BY_WORD).to_numpy(zero_copy_only=False) if self.by_word else np.ones(len(texts), bool)
        if not special.any():
            return self._by_words(texts)
        # A text that words may not tell, or any text of an unknown tokenizer, is encoded whole.
        whole = self._whole([t.as_py() for t in texts.filter(pa.array(special))])
        ids, cuts = self._by_words(texts.filter(pa.array(~special))) if not special.all() else (np.zeros(0, np.uint32), np.zeros(1, np.int64))
        rest, parts = iter(np.split(ids, cuts[1:-1])), iter(whole)
        found = [np.array(next(parts), np.uint32) if s else next(rest) for s in special]
        return np.concatenate(found), np.concatenate([[0], np.cumsum([len(x) for x in found])])


_ENCODERS: dict[int, TextEncoder] = {}


def token_ids(docs: DataFrame, tokenizer_json: str, end_id: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_tokens, ids): the ids of each whole text plus ``end_id``.

    ``ids`` holds unsigned little-endian integers of 2 bytes where every id of
    the vocabulary fits, else of 4.
    """
    from tokenizers import Tokenizer

    size = max(Tokenizer.from_str(tokenizer_json).get_vocab_size(with_added_tokens=True), end_id + 1)
    kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hash(shared.value)
        if key not in _ENCODERS:
            _ENCODERS.clear()
            _ENCODERS[key] = TextEncoder(shared.value)
        for b in batches:
            for at in range(0, b.num_rows, SLICE):
                part = b.slice(at, SLICE)
                ids, cuts = _ENCODERS[key].encode(part.column(1).cast(pa.string()))
                ids = np.insert(ids.astype(kind), cuts[1:], end_id)
                cuts = cuts + np.arange(len(cuts))
                data = pa.Array.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer((cuts * kind.itemsize).astype(np.int32)), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(cuts)), data], ["doc_id", "n_tokens", "ids"])

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return source.mapInArrow(encode, IDS)


def _id_batches(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, where each row begins) of a batch whose last two columns are n_tokens and ids, without copying."""
    n = b.column(b.num_columns - 2).to_numpy()
    data = b.column(b.num_columns - 1)
    offsets = np.frombuffer(data.buffers()[1], np.int32)[data.offset : data.offset + len(data) + 1]
    raw = np.frombuffer(data.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    width = len(raw) // max(1, int(n.sum()))
    yield raw.view("<u2" if width == 2 else "<u4"), np.concatenate([[0], np.cumsum(n)])


# ------------------------------------------------------------ frequency table


def token_counts(ids: DataFrame) -> DataFrame:
    """(token, n) over all ids; a task sends one row per distinct id."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1, np.int64)
        for b in batches:
            for ids, _ in _id_batches(b):
                found = np.bincount(ids)
                if len(found) > len(total):
                    found, total = total, found
                total[: len(found)] += found
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], ["token", "n"])

    return ids.select("n_tokens", "ids").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def scaled(counts: np.ndarray, bits: int) -> np.ndarray:
    """Frequencies near ``counts`` that sum to ``2**bits``, at least 1 wherever a count is."""
    total, room = int(counts.sum()), 1 << bits
    if total == 0:
        return np.zeros_like(counts)
    freq = np.where(counts > 0, np.maximum(1, np.floor(counts.astype(float) * room / total)), 0).astype(np.int64)
    off = room - int(freq.sum())
    order = np.argsort(-freq, kind="stable")
    at = 0
    while off:  # the most frequent ids take what rounding left over
        i = order[at % len(order)]
        step = off if off > 0 else max(off, -(int(freq[i]) // 2))
        if freq[i] + step >= 1 and step:
            freq[i] += step
            off -= step
        at += 1
    return freq


def scale_bits(n_symbols: int) -> int:
    return min(28, max(16, math.ceil(math.log2(max(2, n_symbols))) + 4))


# ------------------------------------------------------------------ the coder


def encode_blocks(symbols: np.ndarray, freq: np.ndarray, bits: int) -> list[tuple[bytes, bytes, bytes]]:
    """Codes ``symbols`` of shape (blocks, steps, LANES): (words, states, words per segment) of each."""
    blocks, steps, _ = symbols.shape
    f = freq.astype(np.uint64)
    start = np.cumsum(f) - f
    limit = (f << np.uint64(63 - bits))
    x = np.full((blocks, LANES), LOW, np.uint64)
    n_seg = -(-steps // STEPS_PER_CHECKPOINT)
    states = np.zeros((blocks, n_seg, LANES), "<u8")
    counts = np.zeros((steps, blocks), np.int64)
    words: list[np.ndarray] = [np.zeros(0, "<u4")] * steps
    for s in range(steps - 1, -1, -1):
        sym = symbols[:, s, :]
        fs = f[sym]
        full = x >= limit[sym]
        counts[s] = full.sum(axis=1)
        words[s] = x[full].astype("<u4")
        x = np.where(full, x >> np.uint64(32), x)
        q = x // fs
        x = (q << np.uint64(bits)) + (x - q * fs) + start[sym]
        if s % STEPS_PER_CHECKPOINT == 0:
            states[:, s // STEPS_PER_CHECKPOINT] = x
    flat = np.concatenate(words)
    owner = np.repeat(np.tile(np.arange(blocks), steps), counts.ravel())
    cuts = np.arange(0, steps, STEPS_PER_CHECKPOINT)
    per_seg = np.add.reduceat(counts, cuts, axis=0).astype("<u4")
    return [(flat[owner == g].tobytes(), states[g].tobytes(), per_seg[:, g].tobytes()) for g in range(blocks)]


def decode_segments(
    states: np.ndarray, words: np.ndarray, begin: np.ndarray, steps: int, freq: np.ndarray, start: np.ndarray, slots: np.ndarray, bits: int
) -> np.ndarray:
    """Symbols, shaped (segments, steps * LANES), of segments that begin at ``states`` and ``words[begin]``."""
    x, pos = states.astype(np.uint64), begin.astype(np.int64).copy()
    out = np.empty((len(x), steps, LANES), slots.dtype)
    low, shift = np.uint64((1 << bits) - 1), np.uint64(bits)
    for s in range(steps):
        slot = x & low
        sym = slots[slot]
        out[:, s] = sym
        x = freq[sym] * (x >> shift) + slot - start[sym]
        need = x < LOW
        n = np.count_nonzero(need, axis=1)
        lane = np.flatnonzero(need.ravel())
        at = np.arange(len(lane)) + np.repeat(pos - (np.cumsum(n) - n), n)
        flat = x.ravel()
        flat[lane] = (flat[lane] << np.uint64(32)) | words[at]
        pos += n
    return out.reshape(len(x), -1)


class _Packer:
    """Cuts a shard's documents, in order, into blocks and codes them in groups."""

    def __init__(self, shard: int, freq: np.ndarray, bits: int):
        self.shard, self.freq, self.bits = shard, freq, bits
        self.pad = int(np.argmax(freq))
        self.docs: list[tuple[int | None, int, bool]] = []  # id, tokens in this block, whether it began earlier
        self.parts: list[np.ndarray] = []
        self.held, self.block, self.offset, self.doc_no = 0, 0, 0, 0
        self.ready: list[dict] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        at, began = 0, False
        while True:
            part = ids[at : at + BLOCK_TOKENS - self.held]
            at += len(part)
            self.parts.append(part)
            self.docs.append((doc_id, len(part), began))
            self.held += len(part)
            open_ = at < len(ids)
            if self.held == BLOCK_TOKENS:
                self._cut(open_)
            if not open_:
                break
            began = True
        self.doc_no += 1

    def _cut(self, open_: bool) -> None:
        if not self.docs:
            return
        ids = np.concatenate(self.parts).astype(np.uint32)
        self.ready.append(
            {
                "shard": self.shard, "block": self.block, "offset": self.offset, "n_tokens": len(ids),
                "first_doc": self.doc_no + 1 - len(self.docs), "head_open": self.docs[0][2], "tail_open": open_,
                "doc_ids": [d[0] for d in self.docs], "doc_tokens": [d[1] for d in self.docs], "ids": ids,
            }
        )
        self.block, self.offset = self.block + 1, self.offset + len(ids)
        self.docs, self.parts, self.held = [], [], 0

    def coded(self, last: bool = False) -> Iterator[dict]:
        if last and self.docs:
            self.doc_no -= 1  # _cut counts from the document being added
            self._cut(False)
        while len(self.ready) >= GROUP or last and self.ready:
            group, self.ready = self.ready[:GROUP], self.ready[GROUP:]
            steps = [-(-r["n_tokens"] // LANES) for r in group]
            for n in sorted(set(steps)):
                same = [r for r, k in zip(group, steps, strict=True) if k == n]
                symbols = np.full((len(same), n * LANES), self.pad, np.uint32)
                for row, r in zip(symbols, same, strict=True):
                    ids = r.pop("ids")
                    row[: len(ids)] = ids
                for r, (words, states, per_seg) in zip(same, encode_blocks(symbols.reshape(len(same), n, LANES), self.freq, self.bits), strict=True):
                    crc = zlib.crc32(per_seg, zlib.crc32(states, zlib.crc32(words)))
                    yield r | {"words": words, "states": states, "segment_words": per_seg, "crc": crc}


def _arrow_schema() -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in BLOCKS.split(","))])


def write_token_files(ids: DataFrame, path: str) -> None:
    """Writes ``ids`` (of ``token_ids``, stored) under ``path`` in ascending doc_id order.

    The frequency table has one row per id of the vocabulary at most and is
    all that reaches the driver.
    """
    spark = ids.sparkSession
    rows = token_counts(ids).collect()
    n_symbols = max((r["token"] for r in rows), default=0) + 1
    counts = np.zeros(n_symbols, np.int64)
    for r in rows:
        counts[r["token"]] = r["n"]
    bits = scale_bits(n_symbols)
    freq = scaled(counts, bits)
    spark.createDataFrame([(int(t), int(freq[t]), bits) for t in np.flatnonzero(freq)], "token long, freq long, scale int").coalesce(1).write.parquet(f"{path}/table")
    shared, schema = spark.sparkContext.broadcast(freq), _arrow_schema()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(TaskContext.get().partitionId(), shared.value, bits)
        for b in batches:
            doc_ids = b.column(0).to_pylist()
            for ids, cuts in _id_batches(b):
                for i, start, stop in zip(doc_ids, cuts, cuts[1:], strict=False):
                    packer.add(i, ids[start:stop])
                    for r in packer.coded():
                        yield pa.RecordBatch.from_pylist([r], schema)
        for r in packer.coded(last=True):
            yield pa.RecordBatch.from_pylist([r], schema)

    ordered = ids.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "ids")
    ordered.mapInArrow(pack, BLOCKS).write.parquet(f"{path}/blocks")


# -------------------------------------------------------------------- reading


def _combine(crc1: int, crc2: int, length2: int) -> int:
    """CRC-32 of a joined sequence from those of its parts: zero bytes are appended by squaring matrices."""
    matrix = [0xEDB88320] + [1 << i for i in range(31)]  # one zero bit

    def times(m: list[int], v: int) -> int:
        out, i = 0, 0
        while v:
            if v & 1:
                out ^= m[i]
            v >>= 1
            i += 1
        return out

    bits = length2 * 8
    while bits:
        if bits & 1:
            crc1 = times(matrix, crc1)
        matrix = [times(matrix, c) for c in matrix]
        bits >>= 1
    return crc1 ^ crc2


FRAGMENTS = "shard int, doc_no long, doc_id long, offset long, n_tokens long, crc long, whole boolean"


def _decoded(rows: list[dict], freq: np.ndarray, start: np.ndarray, slots: np.ndarray, bits: int) -> Iterator[tuple[dict, np.ndarray]]:
    """Each block with its ids; the segments of all ``rows`` decode together."""
    jobs: dict[int, list[tuple[int, int, np.ndarray, np.ndarray]]] = {}
    for k, r in enumerate(rows):
        if zlib.crc32(r["segment_words"], zlib.crc32(r["states"], zlib.crc32(r["words"]))) != r["crc"]:
            raise ValueError(f"token file: block {r['block']} of shard {r['shard']} fails its checksum")
        words, per_seg = np.frombuffer(r["words"], "<u4").astype(np.uint64), np.frombuffer(r["segment_words"], "<u4").astype(np.int64)
        states = np.frombuffer(r["states"], "<u8").reshape(-1, LANES)
        steps, ends = -(-r["n_tokens"] // LANES), np.cumsum(per_seg)
        for j in range(len(states)):
            n = min(STEPS_PER_CHECKPOINT, steps - j * STEPS_PER_CHECKPOINT)
            jobs.setdefault(n, []).append((k, j, states[j], words[ends[j] - per_seg[j] : ends[j]]))
    found: list[dict[int, np.ndarray]] = [{} for _ in rows]
    for n, group in jobs.items():
        sizes = np.array([len(g[3]) for g in group])
        symbols = decode_segments(np.stack([g[2] for g in group]), np.concatenate([g[3] for g in group]), np.cumsum(sizes) - sizes, n, freq, start, slots, bits)
        for (k, j, _, _), s in zip(group, symbols, strict=True):
            found[k][j] = s
    for r, parts in zip(rows, found, strict=True):
        yield r, np.concatenate([parts[j] for j in sorted(parts)])[: r["n_tokens"]]


def _coder(spark: SparkSession, path: str):
    rows = spark.read.parquet(f"{path}/table").collect()  # at most one row per id of the vocabulary
    if not rows:
        return None
    bits, n = rows[0]["scale"], max(r["token"] for r in rows) + 1
    freq = np.zeros(n, np.uint64)
    for r in rows:
        freq[r["token"]] = r["freq"]
    return spark.sparkContext.broadcast((freq, bits))


def _with_ids(path: str, spark: SparkSession, emit, schema: str) -> DataFrame:
    shared = _coder(spark, path)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = None
        for b in batches:
            if tables is None:
                freq, bits = shared.value
                slots = np.repeat(np.arange(len(freq), dtype=np.uint32 if len(freq) > 1 << 16 else np.uint16), freq.astype(np.int64))
                tables = (freq, np.cumsum(freq) - freq, slots, bits)
            for at in range(0, b.num_rows, GROUP):
                for r, ids in _decoded(b.slice(at, GROUP).to_pylist(), *tables):
                    yield emit(r, ids)

    return spark.read.schema(BLOCKS).parquet(f"{path}/blocks").mapInArrow(decode, schema)


def read_token_ids(spark: SparkSession, path: str) -> DataFrame:
    """(shard, doc_no, doc_id, offset, ids): the ids of each part of a document, as 32-bit integers, block by block."""

    def emit(r: dict, ids: np.ndarray) -> pa.RecordBatch:
        cuts = np.concatenate([[0], np.cumsum(r["doc_tokens"])])
        n = len(r["doc_ids"])
        return pa.RecordBatch.from_arrays(
            [
                pa.array([r["shard"]] * n, pa.int32()), pa.array(np.arange(n) + r["first_doc"], pa.int64()), pa.array(r["doc_ids"], pa.int64()),
                pa.array(cuts[:-1] + r["offset"], pa.int64()), pa.array([ids[a:b].astype(np.int32) for a, b in zip(cuts, cuts[1:], strict=False)], pa.list_(pa.int32())),
            ],
            ["shard", "doc_no", "doc_id", "offset", "ids"],
        )

    return _with_ids(path, spark, emit, "shard int, doc_no long, doc_id long, offset long, ids array<int>")


def read_token_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone.

    A document cut over blocks joins the checksums of its parts; those few
    rows, one per block of the document, are all that is shuffled.
    """

    def emit(r: dict, ids: np.ndarray) -> pa.RecordBatch:
        cuts = np.concatenate([[0], np.cumsum(r["doc_tokens"])])
        data, n = memoryview(ids.astype("<u4").tobytes()), len(r["doc_ids"])
        crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(cuts, cuts[1:], strict=False)]
        whole = np.ones(n, bool)
        whole[0] &= not r["head_open"]
        whole[-1] &= not r["tail_open"]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([r["shard"]] * n, pa.int32()), pa.array(np.arange(n) + r["first_doc"], pa.int64()), pa.array(r["doc_ids"], pa.int64()),
                pa.array(cuts[:-1] + r["offset"], pa.int64()), pa.array(np.diff(cuts), pa.int64()), pa.array(crc, pa.int64()), pa.array(whole),
            ],
            [c.split()[0] for c in FRAGMENTS.split(", ")],
        )

    @F.udf("long")
    def joined(parts):
        crc = 0
        for p in sorted(parts, key=lambda p: p["offset"]):
            crc = _combine(crc, p["crc"], 4 * p["n_tokens"])
        return crc

    parts = stored(_with_ids(path, spark, emit, FRAGMENTS), "token-digests")
    cut = (
        parts.filter(~F.col("whole")).groupBy("shard", "doc_no")
        .agg(F.first("doc_id").alias("doc_id"), F.min("offset").alias("offset"), F.sum("n_tokens").alias("n_tokens"), F.collect_list(F.struct("offset", "n_tokens", "crc")).alias("parts"))
        .select("shard", "doc_id", "offset", "n_tokens", joined("parts").alias("crc"))
    )
    docs = parts.filter("whole").select("shard", "doc_id", "offset", "n_tokens", "crc").unionByName(cut)
    totals = spark.read.schema(BLOCKS).parquet(f"{path}/blocks").groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    # One row per shard, and there are as many shards as write tasks.
    base = totals.select("shard", (F.sum("total").over(Window.orderBy("shard")) - F.col("total")).alias("base"))
    return docs.join(F.broadcast(base), "shard").select("doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", F.col("crc").alias("ids_crc32"))
