"""Phrase collocations against counting every n-gram, and the index against searching the sequence."""

import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from clicklens.llm import collocations as C

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    found = {}
    for (lang, g), a in f.items():
        if len(g) < 2 or a < least:
            continue
        cuts = [(2_000_000 * a // (f[lang, g[:k]] + f[lang, g[k:]]), k) for k in range(1, len(g))]
        score, k = min(cuts)
        found.setdefault(lang, {})[g] = (score, a, f[lang, g[:k]], f[lang, g[k:]])
    out = []
    for lang, of in found.items():
        covered = {g[i : i + k] for g, (_, a, *_) in of.items() for k in range(2, len(g)) for i in range(len(g) - k + 1) if 100 * a >= 80 * of[g[i : i + k]][1]}
        kept = sorted(((-s, -a, " ".join(g).encode(), l, r) for g, (s, a, l, r) in of.items() if g not in covered))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(kept[:top])]
    return sorted(out)


def corpus(seed, count):
    r = random.Random(seed)
    phrases = ["new york city", "as well as", "in the long run", "aa aa aa", "Été chaud"]
    for _ in range(count):
        words = []
        for _ in range(r.randint(0, 30)):
            words.append(r.choice(phrases) if r.random() < 0.3 else r.choice("abcdefgh") * r.randint(1, 2))
            words[-1] += r.choice(["", "", "", "", ".", ", ", "!\n", "\t", "\x0b"])
        yield " ".join(words), r.choice(["en", "en", "en", "fr", None])


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_against_counting_all_phrases(lspark):
    rows = [*corpus(1, 300), ("", "en"), (None, "en"), (None, None), (" \t. ", "de"), ("one two", "xx"), *([("same words over and over", "en")] * 20)]
    docs = lspark.createDataFrame(rows, "text string, lang string").repartition(3)
    for least, top, strip, shard in ((3, 10_000, 100, 250), (5, 25, 1 << 20, 1 << 21)):
        found = C.collocations(docs, least=least, top=top, strip_words=strip, shard_words=shard)
        assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        want = brute(rows, least, top)
        assert got(found) == want and len(want) > 20


def test_index_finds_every_phrase():
    r = np.random.default_rng(4)
    for size, letters in ((1, 2), (30, 2), (300, 4), (2000, 60)):
        body = r.integers(0, letters, size)
        seq = np.append(0, body[(body > 0) | np.append(True, body[:-1] > 0)]).astype(np.int32)
        index = C.Index(C.transform(seq, C.LONGEST), C.transform(seq[::-1], C.LONGEST))
        ring = np.concatenate([seq, seq[: C.LONGEST]])
        for path in (["l", "l", "l"], ["r", "r", "r"], ["l", "r", "l"], ["r", "l", "r"]):
            now = index.words()
            for k, way in enumerate(path, 2):
                now = index.to_left(now) if way == "l" else index.to_right(now)
                want = Counter(tuple(ring[i : i + k].tolist()) for i in range(len(seq)))
                want = {g: c for g, c in want.items() if 0 not in g}
                assert dict(zip(map(tuple, now[0].tolist()), (now[2] - now[1]).tolist(), strict=True)) == want


def test_extended_phrases_begin_and_end_with_given_ones():
    r = np.random.default_rng(7)
    for size, letters in ((12, 3), (400, 4), (3000, 9)):
        seq = np.append(0, r.integers(1, letters, size)).astype(np.int32)
        index = C.Index(C.transform(seq, C.LONGEST), C.transform(seq[::-1], C.LONGEST))
        body = seq[1:].tolist()
        for k in (2, 3):
            shorter = {tuple(body[i : i + k]) for i in range(len(body) - k + 1)}
            given = sorted(g for g in shorter if r.random() < 0.5)
            want = Counter(tuple(body[i : i + k + 1]) for i in range(len(body) - k))
            want = {g: n for g, n in want.items() if g[1:] in given and g[:-1] in given}
            words, n = C.extended(index, np.array(given))
            assert dict(zip(map(tuple, words.tolist()), n.tolist(), strict=True)) == want


def test_slices_change_nothing(monkeypatch):
    r = np.random.default_rng(9)
    seq = np.append(0, r.zipf(1.5, 4000) % 12).astype(np.int32)
    seq = seq[(seq > 0) | np.append(True, seq[:-1] > 0)]
    index = C.Index(C.transform(seq, C.LONGEST), C.transform(seq[::-1], C.LONGEST))
    numbers = list(range(1, len(index.forward.ends)))
    row = pa.RecordBatch.from_arrays([pa.array([5]), pa.array([numbers]), pa.array([C._packed(index.forward.bwt)])], ["shard", "numbers", "forward"])

    def results():
        pairs = pa.Table.from_batches(C._pairs(iter([row])))
        found = [C.extended(index, np.unique(np.lib.stride_tricks.sliding_window_view(seq[seq > 0], k)[::2], axis=0)) for k in (2, 3)]
        return pairs.to_pydict(), [(w.tolist(), n.tolist()) for w, n in found]

    whole = results()
    body = seq.tolist()
    want = Counter((a, b) for a, b in zip(body, body[1:] + body[:1], strict=True) if a and b)
    assert dict(zip(whole[0]["pair"], whole[0]["n"], strict=True)) == {a << 32 | b: n for (a, b), n in want.items()}
    for size in (1, 7, 500):
        monkeypatch.setattr(C, "SLICE", size)
        assert results() == whole


def test_memory_of_a_shard_is_a_few_bytes_a_word():
    """Beside its input a shard takes under 45 bytes a word to index, and under 33 to count pairs and longer phrases."""
    r = np.random.default_rng(11)
    n = 1 << 21
    seq = np.append(0, (r.random(n) ** 3 * 20_000).astype(np.int32))

    def peak(of):
        tracemalloc.start()
        try:
            out = of()
            return out, tracemalloc.get_traced_memory()[1] / n
        finally:
            tracemalloc.stop()

    forward, made = peak(lambda: C.transform(seq, C.LONGEST))
    assert made < 45
    row = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([list(range(1, 20_000))]), pa.array([C._packed(forward)])], ["shard", "numbers", "forward"])
    total, made = peak(lambda: sum(b.num_rows for b in C._pairs(iter([row]))))
    assert made < 33 and total > n // 4
    backward = C.transform(seq[::-1], C.LONGEST)
    given = np.unique(np.column_stack([seq[1:-1], seq[2:]])[:2000], axis=0)
    given = given[(given > 0).all(axis=1)]
    _, made = peak(lambda: C.extended(C.Index(forward, backward), given))
    assert made < 33


def test_order_and_ranks():
    r = np.random.default_rng(12)
    for key in (r.integers(0, 9, 1000), r.integers(0, 1 << 60, 1000), np.repeat(r.integers(0, 1 << 60, 10), 9), np.zeros(0, np.int64), np.array([7])):
        assert (C._order(key) == np.argsort(key, kind="stable")).all()
        assert (C._ranks(key) == np.unique(key, return_inverse=True)[1]).all()


def test_products_past_64_bits(lspark):
    a, left, right = 4 * 10**18, 5 * 10**18, 4 * 10**18 + 1
    row = lspark.createDataFrame([(a, left, right)], "a long, l long, r long").select(F.expr(C._SCORE).alias("score")).first()
    assert row["score"] == 2_000_000 * a // (left + right)


def test_odd_rows(lspark, odd_docs):
    rows = [(r["text"], r["lang"]) for r in odd_docs.select("text", "lang").collect()]
    assert got(C.collocations(odd_docs, least=2)) == brute(rows, 2, 2000)


def test_empty_table(lspark, no_docs):
    assert C.collocations(no_docs).collect() == []


def test_numbers_have_no_gaps(lspark):
    rows = lspark.range(0, 1000, 1, 7)
    assert sorted(r["n"] for r in C.numbered(rows.filter("id % 3 = 0"), "n").collect()) == list(range(1, 335))


def test_copies_of_a_text_add_no_rows():
    text = np.random.default_rng(5).integers(1, 30, 600)
    grams = {k: Counter(tuple(text[i : i + k].tolist()) for i in range(len(text) - k + 1)) for k in (2, 3, 4)}
    for copies in (1, 5, 25):
        sequence = np.append(0, np.tile(np.append(text, 0), copies)).astype(np.int32)
        sides = [C._packed(C.transform(s, C.LONGEST)) for s in (sequence, sequence[::-1])]
        index = pa.table({"shard": [7], "numbers": [list(range(1, 30))], "forward": sides[:1], "backward": sides[1:]}, schema=C._INDEX)
        pairs = pa.Table.from_batches(C._pairs(iter(index.to_batches())))
        # A row for each phrase of the shard, whatever its count.
        assert pairs.num_rows == len(grams[2]) and sum(pairs.column("n").to_pylist()) == copies * grams[2].total()
        given = pa.table({"home": [7] * pairs.num_rows, "front": pairs.column("pair"), "rest": [0] * pairs.num_rows})
        for length in (3, 4):
            found = C._longer(length, (pa.scalar(7),), index, given)
            assert found.num_rows == len(grams[length]) and sum(found.column("n").to_pylist()) == copies * grams[length].total()
            given = pa.table({"home": found.column("shard"), "front": found.column("front"), "rest": found.column("rest")})
