"""Periodic runs against brute force, and the grammar's extensions against comparing words."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from clicklens.llm import queries, runs

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words, least=12):
    """Maximal runs by comparing words for every period."""
    found = {}
    for p in range(1, len(words) // 2 + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j + p - i >= max(least, 2 * p):
                found.setdefault((i, j + p), p)
            i = max(j, i + 1)
    return sorted((s, e - s, p) for (s, e), p in found.items())


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0], r[2]))


def collapse(words, rows):
    drop = {i for s, n, p in rows for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in drop)


def random_texts(seed, count):
    r = random.Random(seed)
    for _ in range(count):
        size = r.choice([0, 1, 5, 11, 12, 13, 30, 60, 120, 250])
        words = [r.choice("abcdefgh"[: r.choice([1, 2, 3, 8])]) for _ in range(size)]
        if r.random() < 0.6 and size:
            a, p = r.randrange(size), r.randint(1, 20)
            words = words[:a] + [words[a + (i - a) % min(p, size - a)] for i in range(a, size)]
        yield words


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return list(b[:n])


def test_runs_against_brute_force():
    texts = [*random_texts(1, 400), fibonacci(400), ["x"] * 300, ["a", "b"] * 150, list("aab" * 40 + "aac" * 40)]
    for least in (2, 12):
        got = list(runs._chunk([[w.encode() for w in t] for t in texts], least))
        for t, (found, kept) in zip(texts, got, strict=True):
            want = ordered(brute(t, least))
            assert [tuple(r) for r in found.tolist()] == want
            assert kept.decode() == collapse(t, want)


def test_few_sifts_and_queries_change_nothing(monkeypatch):
    texts = [[w.encode() for w in t] for t in (*random_texts(2, 60), fibonacci(300), ["x"] * 200)]
    want = [(r.tolist(), k) for r, k in runs._chunk(texts, 12)]
    monkeypatch.setattr(runs, "SIFTS", 0)
    monkeypatch.setattr(runs, "QUERIES", 7)
    assert [(r.tolist(), k) for r, k in runs._chunk(texts, 12)] == want


@pytest.mark.parametrize("step", [1, -1])
def test_extensions_of_the_grammar(step):
    r = np.random.default_rng(5)
    for size in (3, 40, 400):
        for letters in (1, 2, 5):
            body = r.integers(0, letters, size)
            body[size // 2 :] = body[: size - size // 2]
            s = np.concatenate([[-1], body, [-2]])
            rounds = runs.compress(s)
            assert len(rounds[-1].symbols) == len(set(rounds[-1].symbols.tolist()))
            a, b = r.integers(0, len(s), (2, 500))
            a, b = a[a != b], b[a != b]
            got = runs.common_extension(rounds, a, b, step)
            for i, j, n in zip(a.tolist(), b.tolist(), got.tolist(), strict=True):
                k = 0
                while 0 <= i < len(s) and 0 <= j < len(s) and s[i] == s[j]:
                    i, j, k = i + step, j + step, k + 1
                assert k == n


def test_rounds_grow_with_the_logarithm():
    for s in (np.zeros(1 << 15, np.int64), np.random.default_rng(0).integers(0, 3, 1 << 15)):
        rounds = runs.compress(np.concatenate([[-1], s, [-2]]))
        assert len(rounds) < 2 * 60
        assert sum(len(x.symbols) for x in rounds) < 10 * len(s)


def edited(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def test_query_against_brute_force(lspark):
    got = {r["doc_id"]: r for r in queries.QUERIES["op11_runs"](lspark, SF).collect()}
    docs = lspark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    planted = 0
    for d in docs:
        words = edited(d["doc_id"], WORD.findall(d["text"] or ""))
        if len(words) > 4000:
            continue
        want, r = ordered(brute(words)), got[d["doc_id"]]
        planted += bool(want)
        assert r["n_runs"] == len(want)
        best = max(want, key=lambda x: (x[1], -x[0], -x[2]), default=None)
        values = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (r["start"], r["length"], r["period"], r["exponent_milli"]) == values
        listed = "".join(f"{s},{n},{p}\n" for s, n, p in want)
        assert r["runs_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(collapse(words, want).encode()).hexdigest()
    assert planted > 10


def test_odd_rows(lspark, odd_docs):
    got = runs.find_runs(odd_docs.withColumnRenamed("base", "runs"))
    assert got.columns == [c if c != "base" else "runs" for c in odd_docs.columns if c != "base"] + ["runs", "collapsed"]
    rows = got.collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        words = WORD.findall(r["text"] or "")
        if r["doc_id"] == 7:
            assert [tuple(x) for x in r["runs"]] == [(0, 120_000, 3)] and r["collapsed"] == "lorem ipsum dolor"
        else:
            assert r["runs"] == [] and r["collapsed"] == " ".join(words)


def test_only_blanks_of_the_contract_part_words(lspark):
    docs = lspark.createDataFrame([(1, "a b  c\x1cd\x0be\x0cf " * 20)], "doc_id long, text string")
    assert [tuple(r) for r in runs.find_runs(docs).first()["runs"]] == [(0, 80, 4)]


def test_empty_table(lspark, no_docs):
    assert runs.find_runs(no_docs).collect() == []
