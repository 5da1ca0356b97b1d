"""Phrase collocations from FM-indexes over word numbers, one per shard.

1. *Strips.* Texts are cut into pieces and words; the words of each language
   are numbered in the order met, up to about ``STRIP_WORDS`` a strip. A strip
   is a row: its words with their counts, and the pieces as numbers.
2. *Words.* Counts are summed over shards; words met ``least`` times or more
   get a number of their own. Others end phrases: no phrase with a rarer word
   can be a candidate.
3. *Index.* Strips of a language are put together to shards of about
   ``SHARD_WORDS``, renumbered by the frequent words (the numbers come back by
   a join on each strip's own words) and indexed: the Burrows-Wheeler transform of the sequence and of the reversed sequence,
   their suffixes sorted as deep as a phrase may be long, which is all that
   phrases of ``LONGEST`` words need.
4. *Pairs.* Every word's interval is extended to the left by all its preceding
   words at once; counts are summed over shards, and a shard gets back which
   of its pairs are frequent.
5. *Longer phrases*, a word more each time. The intervals of the frequent
   phrases are found again and extended to the left in the index or to the
   right in the reversed index, both kept in step, where the new phrase's other
   end is frequent too. Counts are summed, and the frequent ones come back.
6. *Scores.* Parts are counted phrases themselves, found by joins. A phrase is
   dropped for a longer one if its most frequent extension by one word to the
   left or right is frequent enough; that covers longer ones, for every phrase
   between two has a count between theirs.

Every count is exact: pruning only leaves out what cannot reach ``least``.
Counts move as one row per shard and phrase, so a hot language, text or word
is summed within shards first; a shard fits in a task's memory (about 50
bytes a word; its intervals are extended ``SLICE`` places at a time); no list of a language's phrases is ever held by
one task.

Defined cases: null texts are empty; a null language is ``und``; an empty
table gives no rows; repeated rows count each; ids and further columns are not
looked at; ties are ordered by count, then phrase.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cached_property, partial, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small_side, stored

#: Words of a strip, of all open strips of a task, and of a shard; the last text or strip may take it past this.
STRIP_WORDS, OPEN_WORDS, SHARD_WORDS = 1 << 20, 1 << 22, 2 << 20
#: Words of the longest phrase, and how deep suffixes are sorted.
LONGEST = 4
LEAST, TOP = 30, 2000
SCALE, COVERED = 2_000_000, (4, 5)
UNKNOWN = "und"

#: The contract's pieces end at . , ; : ! ? and 0x0A-0x0D; a byte that UTF-8 never holds stands for them.
_END = b"\xff"
_CLEAN = bytes(
    255 if chr(c) in ".,;:!?\n\x0b\x0c\r" else c + 32 if 65 <= c <= 90 else c for c in range(256)
)

_STRIP = "strip long, lang string, size long, words array<string>, counts array<long>, sequence binary"
_STRIP_ROW = pa.schema(
    [("strip", pa.int64()), ("lang", pa.string()), ("size", pa.int64()), ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64())), ("sequence", pa.binary())]
)
_KEYS = [f"w{k}" for k in range(LONGEST)]


class _Strip:
    """Words of one language as numbers; 0 stands between pieces."""

    def __init__(self, lang: str):
        self.lang, self.parts, self.size = lang, [], 0
        self.numbers: dict[bytes, int] = _Numbers({_END: 0})

    def add(self, text: bytes) -> None:
        # bytes.split() cuts at blanks and tabs: the line ends are piece ends by now.
        words = text.translate(_CLEAN).replace(_END, b" \xff ").split()
        if words:
            self.parts.append(np.array([*map(self.numbers.__getitem__, words), 0], np.int32))
            self.size += len(words)

    def columns(self) -> tuple[list[str], list[int], bytes]:
        sequence = np.concatenate(self.parts)
        words = [w.decode("utf-8") for w in list(self.numbers)[1:]]
        return words, np.bincount(sequence, minlength=len(words) + 1)[1:].tolist(), _packed(sequence)


def _packed(numbers: np.ndarray) -> bytes:
    return len(numbers).to_bytes(8, "little") + pa.compress(numbers.astype("<i4").tobytes(), "zstd", asbytes=True)


def _unpacked(data: pa.Scalar) -> np.ndarray:
    raw = data.as_buffer()
    size = 4 * int.from_bytes(raw[:8].to_pybytes(), "little")
    return np.frombuffer(pa.decompress(raw[8:], size, "zstd"), "<i4")


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def strips(docs: DataFrame, text: str, lang: str, strip_words: int = STRIP_WORDS) -> DataFrame:
    """One row per strip: (strip, lang, size, words, counts, sequence); ``size`` is the sum of the counts."""
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)), F.col(text).cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        made = TaskContext.get().partitionId() << 32
        open_: dict[str, _Strip] = {}

        def close(s: _Strip) -> pa.RecordBatch:
            nonlocal made
            made += 1
            words, counts, sequence = s.columns()
            values = ([x] for x in (made - 1, s.lang, sum(counts), words, counts, sequence))
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, _STRIP_ROW, strict=True)], schema=_STRIP_ROW)

        size = 0
        for b in batches:
            langs, texts = b.column(0).to_pylist(), b.column(1).cast(pa.binary())
            for k, name in enumerate(langs):
                data = texts[k].as_py()
                if not data:
                    continue
                strip = open_.get(name) or open_.setdefault(name, _Strip(name))
                size -= strip.size
                strip.add(data)
                size += strip.size
                # Many languages share the room of a task.
                full = strip if strip.size >= strip_words else max(open_.values(), key=lambda s: s.size) if size >= OPEN_WORDS else None
                if full:
                    size -= full.size
                    yield close(open_.pop(full.lang))
        for s in open_.values():
            if s.size:
                yield close(s)

    return rows.mapInArrow(run, _STRIP)


def shards(sizes: DataFrame, shard_words: int) -> DataFrame:
    """Which shard each strip (strip, lang, size) goes to: strips of a language in order, up to ``shard_words``.

    The window holds three numbers per strip.
    """
    before = F.sum("size").over(Window.partitionBy("lang").orderBy("strip")) - F.col("size")
    return sizes.select("strip", F.xxhash64("lang", F.floor(before / shard_words)).alias("shard"))


def numbered(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` with numbers from 1 in a column ``name``, without gaps: partitions count on from one another."""
    placed = rows.withColumn("_partition", F.spark_partition_id()).withColumn("_place", F.monotonically_increasing_id())
    placed = stored(placed, "numbered")
    sizes = placed.groupBy("_partition").agg(F.count("*").alias("_rows"))
    # One row per partition of ``rows``.
    before = sizes.select("_partition", (F.sum("_rows").over(Window.orderBy("_partition")) - F.col("_rows")).alias("_before"))
    place = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(F.broadcast(before), "_partition").select(*rows.columns, (1 + F.col("_before") + place).alias(name))


# ------------------------------------------------------------------ the index


def _order(key: np.ndarray) -> np.ndarray:
    """Stable order of whole numbers from 0 on: places are sorted along in the low bits, where there is room."""
    bits = len(key).bit_length()
    if not len(key) or int(key.max()).bit_length() + bits > 63:
        return np.argsort(key, kind="stable")
    place = key.astype(np.int64)
    place <<= bits
    place |= np.arange(len(key), dtype=np.int32 if bits < 32 else np.int64)
    place.sort()
    place &= (1 << bits) - 1
    return place


def _ranks(key: np.ndarray) -> np.ndarray:
    """The rank of each number among the distinct ones."""
    order = _order(key)
    key = key[order]
    new = np.append(False, key[1:] != key[:-1])
    rank = np.empty(len(key), np.int32)
    rank[order] = np.cumsum(new, dtype=np.int32)
    return rank


def transform(sequence: np.ndarray, depth: int) -> np.ndarray:
    """Burrows-Wheeler transform of a cyclic sequence, its rotations sorted by their first ``depth`` numbers."""
    n, reach = len(sequence), 1
    rank = sequence
    while reach < depth:
        # Ranks by twice as many numbers, from those of a rotation and of the one ``reach`` on.
        key = rank.astype(np.int64)
        key *= int(rank.max()) + 1
        key += np.roll(rank, -reach)
        reach *= 2
        rank = _ranks(key) if reach < depth else key
    return sequence[_order(rank) - 1] if n else sequence


#: Places of an index that are extended at once; bounds the working arrays beside it.
SLICE = 1 << 18


class Side:
    """One transform: intervals of phrases, and their extensions by the number before them."""

    def __init__(self, bwt: np.ndarray):
        self.bwt = bwt
        counts = np.bincount(bwt, minlength=1)
        self.ends = np.cumsum(counts)
        self.begins = self.ends - counts

    @cached_property
    def step(self) -> np.ndarray:
        """Where a rotation goes when its last number comes first."""
        step = np.empty(len(self.bwt), np.int32)
        step[_order(self.bwt)] = np.arange(len(self.bwt), dtype=np.int32)
        return step

    def extend(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
        """All extensions of disjoint intervals: (interval, number before it, low, high, place behind smaller numbers)."""
        size = high - low
        of = np.repeat(np.arange(len(low)), size)
        place = np.repeat(low - (np.cumsum(size) - size), size) + np.arange(len(of))
        key = of * (len(self.ends) + 1) + self.bwt[place]
        order = np.argsort(key)
        key = key[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        count = np.diff(np.append(first, len(key)))
        of, number = of[order[first]], self.bwt[place[order[first]]].astype(np.int64)
        # Rotations with the same last number keep their order when it comes first.
        begin = np.minimum.reduceat(self.step[place[order]], first) if len(key) else first
        behind = first - (np.cumsum(size) - size)[of]
        real = number > 0
        return of[real], number[real], begin[real], (begin + count)[real], behind[real]


class Index:
    """Both transforms of a shard; number 0 ends phrases."""

    def __init__(self, forward: np.ndarray, backward: np.ndarray):
        self.forward, self.backward = Side(forward), Side(backward)

    def words(self) -> tuple[np.ndarray, ...]:
        """Phrases of one word: (words, low, high, low in the reversed index)."""
        number = np.flatnonzero(self.forward.ends > self.forward.begins)
        number = number[number > 0]
        return number[:, None], self.forward.begins[number], self.forward.ends[number], self.backward.begins[number]

    def to_left(self, phrases: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
        words, low, high, back = phrases
        of, number, lo, hi, behind = self.forward.extend(low, high)
        return np.column_stack([number, words[of]]), lo, hi, back[of] + behind

    def to_right(self, phrases: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
        words, low, high, back = phrases
        of, number, lo, hi, behind = self.backward.extend(back, back + high - low)
        ahead = low[of] + behind
        return np.column_stack([words[of], number]), ahead, ahead + hi - lo, lo


def _chosen(phrases: tuple[np.ndarray, ...], keep: np.ndarray) -> tuple[np.ndarray, ...]:
    return tuple(p[keep] for p in phrases)


def _slices(phrases: tuple[np.ndarray, ...]) -> Iterator[tuple[np.ndarray, ...]]:
    """Phrases in parts of up to ``SLICE`` places; one with more is a part by itself. At least one part."""
    before = np.cumsum(phrases[2] - phrases[1])
    a, done = 0, 0
    while True:
        b = max(a + 1, int(np.searchsorted(before, done + SLICE, "right")))
        yield tuple(p[a:b] for p in phrases)
        if b >= len(before):
            return
        a, done = b, before[b - 1]


def _widened(phrases: tuple[np.ndarray, ...], extend: Callable, keep: Callable) -> tuple[np.ndarray, ...]:
    """All extensions whose words ``keep`` takes, a slice at a time."""
    found = []
    for part in _slices(phrases):
        made = extend(part)
        found.append(_chosen(made, keep(made[0])))
    return tuple(np.concatenate(column) for column in zip(*found, strict=True))


class _Known:
    """A set of phrases of one length, given as rows; looked up column by column."""

    def __init__(self, phrases: np.ndarray, size: int):
        self.size, self.levels = size, []
        at = phrases[:, 0].astype(np.int64)
        for column in phrases.T[1:]:
            keys, at = np.unique(at * size + column, return_inverse=True)
            self.levels.append(keys)

    def among(self, words: np.ndarray) -> np.ndarray:
        """Which rows begin one of the phrases, or are one where they are as long."""
        at, found = words[:, 0].astype(np.int64), np.ones(len(words), bool)
        for keys, column in zip(self.levels, words.T[1:], strict=False):
            key = at * self.size + column
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            found &= keys[at] == key
        return found


def extended(index: Index, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Phrases a word longer than the rows of ``frequent`` that begin and end with one of them, and their counts."""
    length, size = frequent.shape[1], len(index.forward.ends)
    known = _Known(frequent, size)
    # Found from right to left: what is met on the way ends a frequent phrase.
    ends = [_Known(frequent[:, length - k :], size) for k in range(1, length + 1)]
    now = index.words()
    now = _chosen(now, np.isin(now[0][:, 0], frequent[:, -1]))
    for k in range(1, length):
        now = _widened(now, index.to_left, ends[k].among)
    if length % 2:
        now = _widened(now, index.to_right, lambda words: known.among(words[:, 1:]))
    else:
        now = _widened(now, index.to_left, lambda words: known.among(words[:, :-1]))
    return now[0], now[2] - now[1]


# ------------------------------------------------------------------ the stages


def _build(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
    """Index of one shard, from its strips and the numbers of their frequent words."""
    if not left.num_rows or not right.num_rows:
        return _INDEX.empty_table()
    strip, at, found = (right.column(c).to_numpy() for c in ("strip", "at", "number"))
    # Numbers of the shard follow the words' own numbers.
    numbers, short = np.unique(found, return_inverse=True)
    parts = [np.zeros(1, np.int32)]
    for k in range(left.num_rows):
        sequence = _unpacked(left.column("sequence")[k])
        number = np.zeros(int(sequence.max()) + 1, np.int32)
        mine = strip == left.column("strip")[k].as_py()
        number[at[mine]] = short[mine] + 1
        sequence = number[sequence]
        parts.append(sequence[(sequence > 0) | np.append(False, sequence[:-1] > 0)])
    sequence = np.concatenate(parts)
    sides = (_packed(transform(s, LONGEST)) for s in (sequence, sequence[::-1]))
    return pa.table({"shard": [key[0].as_py()], "numbers": [numbers.tolist()], **dict(zip(("forward", "backward"), ([x] for x in sides), strict=True))}, schema=_INDEX)


_INDEX = pa.schema([("shard", pa.int64()), ("numbers", pa.list_(pa.int64())), ("forward", pa.binary()), ("backward", pa.binary())])


def _joined(a: np.ndarray, b: np.ndarray) -> pa.Array:
    """Two word numbers as one long."""
    return pa.array(a << 32 | b)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for k in range(b.num_rows):
            numbers = np.append(0, b.column(1)[k].values.to_numpy())
            side = Side(_unpacked(b.column(2)[k]))
            number = np.flatnonzero(side.ends > side.begins)[1:]
            for number, begin, end in _slices((number, side.begins[number], side.ends[number])):
                of, before, low, high, _ = side.extend(begin, end)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(of), b.column(0)[k].as_py())), _joined(numbers[before], numbers[number[of]]), pa.array(high - low)], ["shard", "pair", "n"])


_LONGER = pa.schema([("shard", pa.int64()), ("front", pa.int64()), ("rest", pa.int64()), ("n", pa.int64())])


def _longer(length: int, key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
    """Counts of one shard's phrases of ``length`` words, from its index and its frequent shorter ones."""
    if not left.num_rows or not right.num_rows:
        return _LONGER.empty_table()
    numbers = np.append(0, left.column("numbers")[0].values.to_numpy())
    index = Index(*(_unpacked(left.column(c)[0]) for c in ("forward", "backward")))
    front, rest = right.column("front").to_numpy(), right.column("rest").to_numpy()
    given = [front >> 32, front & 0xFFFFFFFF, rest >> 32, rest & 0xFFFFFFFF][: length - 1]
    words, n = extended(index, np.column_stack([np.searchsorted(numbers, x) for x in given]))
    w = [numbers[words[:, k]] if k < length else np.zeros(len(words), np.int64) for k in range(LONGEST)]
    return pa.table([pa.array(np.full(len(n), key[0].as_py())), _joined(w[0], w[1]), _joined(w[2], w[3]), pa.array(n)], schema=_LONGER)


def _frequent(counts: DataFrame, least: int, name: str) -> DataFrame:
    """Of (shard, front, rest, n): the phrases met ``least`` times in all, for each shard that holds them.

    One exchange: a phrase's counts of all shards meet, and each goes on with their sum.
    """
    summed = counts.withColumn("f", F.sum("n").over(Window.partitionBy("front", "rest"))).filter(F.col("f") >= least)
    return stored(summed.select(F.col("shard").alias("home"), "front", "rest", "f"), name)


def phrase_counts(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, strip_words: int = STRIP_WORDS, shard_words: int = SHARD_WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(languages with their word counts, frequent words, frequent phrases).

    Words: (lang, word, number, f). Phrases of 1 to ``LONGEST`` words: their
    words' numbers in ``w0``, ``w1`` ... (0 behind the last) and f. Numbers
    stay under 2**31, so that two of them make a long.
    """
    cut = stored(strips(docs, text, lang, strip_words), "collocation-strips")
    sizes = cut.select("strip", "lang", "size")
    totals = sizes.groupBy("lang").agg(F.sum("size").alias("n"))
    # A row per strip.
    homes = small_side(stored(shards(sizes, shard_words), "collocation-shards"))

    words = cut.select(F.col("strip").alias("_strip"), "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "_one"))
    words = words.select("_strip", "lang", (F.col("at") + 1).alias("at"), F.col("_one.words").alias("word"), F.col("_one.counts").alias("n"))
    frequent = words.groupBy("lang", "word").agg(F.sum("n").alias("f")).filter(F.col("f") >= least)
    frequent = stored(numbered(frequent, "number"), "collocation-words")

    back = words.join(frequent, ["lang", "word"]).withColumnRenamed("_strip", "strip").join(homes, "strip").select(F.col("shard").alias("home"), "strip", "at", "number")
    index = cut.select("strip", "sequence").join(homes, "strip").groupBy("shard").cogroup(back.groupBy("home"))
    index = stored(index.applyInArrow(_build, "shard long, numbers array<long>, forward binary, backward binary"), "collocation-index")

    zero = F.lit(0).cast("long")
    counts = index.mapInArrow(_pairs, "shard long, pair long, n long").select("shard", F.col("pair").alias("front"), zero.alias("rest"), "n")
    tables = [frequent.select(F.shiftleft(F.col("number"), 32).alias("front"), zero.alias("rest"), "f")]
    for length in range(2, LONGEST + 1):
        if length > 2:
            given = often.select("home", "front", "rest").groupBy("home")
            counts = index.groupBy("shard").cogroup(given).applyInArrow(partial(_longer, length), "shard long, front long, rest long, n long")
        if length < LONGEST:
            often = _frequent(counts, least, f"collocation-{length}-words")
            tables.append(often.select("front", "rest", "f").distinct())
        else:
            tables.append(counts.groupBy("front", "rest").agg(F.sum("n").alias("f")).filter(F.col("f") >= least))
    table = stored(reduce(DataFrame.unionByName, tables), "collocation-phrases")
    halves = [h for c in ("front", "rest") for h in (F.shiftright(F.col(c), 32), F.col(c).bitwiseAND(F.lit(0xFFFFFFFF)))]
    return totals, frequent, table.select(*(h.alias(k) for h, k in zip(halves, _KEYS, strict=True)), "f")


def _size() -> Column:
    return sum(((F.col(c) > 0).cast("int") for c in _KEYS[1:]), F.lit(1))


def _part(begin: Column, length: Column) -> Column:
    """Words of the array ``ws`` from ``begin`` on, padded with 0 to ``LONGEST``."""
    return F.slice(F.concat(F.slice("ws", begin + 1, length), F.array_repeat(F.lit(0).cast("long"), LONGEST)), 1, LONGEST)


#: Of the columns a, l and r; the product may pass 64 bits.
_SCORE = f"(cast(a as decimal(20,0)) * cast({SCALE} as decimal(10,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP, strip_words: int = STRIP_WORDS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Each language's first ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

    ``a``, ``l`` and ``r`` count the phrase and the parts of its weakest cut,
    ``n`` all words of the language; the score is floor(``SCALE`` a / (l + r)).
    """
    totals, words, counted = phrase_counts(docs, text, lang, least, strip_words, shard_words)
    table = counted.select(F.array(*_KEYS).alias("ws"), _size().alias("size"), "f")
    parts = table.select(F.col("ws").alias("part"), F.col("f").alias("part_f"))
    phrases = table.filter(F.col("size") >= 2)

    cuts = phrases.select("ws", "size", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("ws", "a", "k", _part(F.lit(0), F.col("k")).alias("head"), _part(F.col("k"), F.col("size") - F.col("k")).alias("tail"))
    cuts = cuts.join(parts.select(F.col("part").alias("head"), F.col("part_f").alias("l")), "head")
    cuts = cuts.join(parts.select(F.col("part").alias("tail"), F.col("part_f").alias("r")), "tail")
    scored = cuts.withColumn("score", F.expr(_SCORE)).groupBy("ws", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))

    # The most frequent phrase that is one word longer, to the left or right.
    wider = phrases.filter(F.col("size") >= 3)
    ends = F.array(_part(F.lit(0), F.col("size") - 1), _part(F.lit(1), F.col("size") - 1))
    wider = wider.select(F.explode(ends).alias("ws"), "f").groupBy("ws").agg(F.max("f").alias("wider"))
    share, of = COVERED
    left_out = F.coalesce(F.col("wider").cast("decimal(20,0)") * of >= F.col("a").cast("decimal(20,0)") * share, F.lit(False))
    scored = scored.join(wider, "ws", "left").filter(~left_out)

    # A phrase is of its words' language; ties at the last rank stay until the phrases' letters order them.
    named = words.select(F.col("number"), "lang", "word")
    scored = scored.select("ws", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), F.col("best.score").alias("score"))
    scored = scored.join(named.select(F.col("number").alias("_first"), "lang"), F.col("ws")[0] == F.col("_first")).drop("_first")
    leading = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    held = stored(scored.withColumn("_rank", F.rank().over(leading)).filter(F.col("_rank") <= top).drop("_rank"), "collocation-leading")
    spelled = held.select("*", F.posexplode("ws").alias("_at", "_number")).filter(F.col("_number") > 0)
    spelled = spelled.join(named.select(F.col("number").alias("_number"), "word"), "_number")
    spelled = spelled.groupBy("lang", "ws", "a", "l", "r", "score").agg(F.array_sort(F.collect_list(F.struct("_at", "word"))).alias("_words"))
    phrase = F.array_join(F.col("_words.word"), " ")
    spelled = spelled.select("lang", phrase.alias("phrase"), "a", "l", "r", "score")
    # The leading phrases of a language: ``top`` of them, and ties.
    final = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    spelled = spelled.withColumn("rank", F.row_number().over(final).cast("long")).filter(F.col("rank") <= top)
    # One row per language.
    return spelled.join(stored(totals, "collocation-totals"), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


#: The registered query in DuckDB's SQL: words with their places in the piece, n-grams by self-joined places.
ORACLE_SQL = r"""
WITH docs AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS d,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
cut AS (SELECT lang, d, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM docs),
pieces AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM cut),
grams AS (
  SELECT lang, k.k AS k, unnest(list_transform(range(1, len(w) - k.k + 2), lambda i: list_slice(w, i, i + k.k - 1))) AS g
  FROM pieces, range(1, 5) AS k(k) WHERE len(w) >= k.k),
f AS (SELECT lang, k, g, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, g, f AS a FROM f WHERE k >= 2 AND f >= 30),
cut_at AS (SELECT lang, k, g, a, unnest(range(1, k)) AS j FROM cand),
parts AS (SELECT *, list_slice(g, 1, j) AS head, list_slice(g, j + 1, k) AS tail FROM cut_at),
cuts AS (
  SELECT p.lang, p.g, p.a, p.j, h.f AS l, t.f AS r, (2000000::HUGEINT * p.a) // (h.f::HUGEINT + t.f) AS score
  FROM parts p JOIN f h ON h.lang = p.lang AND h.g = p.head JOIN f t ON t.lang = p.lang AND t.g = p.tail),
weakest AS (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, j) AS o FROM cuts),
inner_of AS (
  SELECT x.lang, x.a, unnest(list_transform(range(1, x.k - s.s + 2), lambda i: list_slice(x.g, i, i + s.s - 1))) AS g
  FROM cand x, range(2, 4) AS s(s) WHERE s.s < x.k),
widest AS (SELECT lang, g, max(a) AS a FROM inner_of GROUP BY ALL),
covered AS (SELECT c.lang, c.g FROM cand c JOIN widest x ON x.lang = c.lang AND x.g = c.g WHERE 100::HUGEINT * x.a >= 80::HUGEINT * c.a),
kept AS (SELECT * FROM weakest WHERE o = 1 AND NOT EXISTS (SELECT 1 FROM covered v WHERE v.lang = weakest.lang AND v.g = weakest.g)),
ranked AS (
  SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score::BIGINT AS score,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank FROM kept)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score
FROM ranked r JOIN totals t ON t.lang = r.lang WHERE r.rank <= 2000
"""
