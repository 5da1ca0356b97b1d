"""SimHash near-duplicates against all pairs, and components against union-find."""

import random
import re

import numpy as np
import pytest
import xxhash

from clicklens.llm import queries, simhash
from clicklens.llm.components import components

from .conftest import SF


def plain_print(text, shingle=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    parts = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    hashes = [xxhash.xxh64(p.encode(), seed=42).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(n, pairs):
    up = list(range(n))

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def brute(fps, bits=4):
    x = np.array(fps, np.uint64)
    return roots(len(x), [(i, j) for i in range(len(x)) for j in range(i + 1, len(x)) if int(x[i] ^ x[j]).bit_count() <= bits])


def test_query_against_all_pairs(lspark):
    docs = lspark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    fps = [plain_print(r["text"]) for r in docs]
    want = [(r["doc_id"], f"{f:016x}", docs[c]["doc_id"]) for r, f, c in zip(docs, fps, brute(fps))]
    assert [tuple(r) for r in queries.QUERIES["op6_simhash"](lspark, SF).orderBy("doc_id").collect()] == want


@pytest.mark.parametrize("tile", [4096, 16])
@pytest.mark.parametrize("bits", [0, 2, 4])
def test_links_of_dense_balls_and_chains(lspark, monkeypatch, tile, bits):
    """Random prints, a dense ball, chains of single-bit steps; buckets whole and in tiles."""
    monkeypatch.setattr(simhash, "TILE", tile)
    rnd = random.Random(bits)
    fps = {rnd.getrandbits(64) for _ in range(400)}
    center, chain = rnd.getrandbits(64), rnd.getrandbits(64)
    for _ in range(150):
        fps.add(center ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(0, 7))))
    for b in rnd.sample(range(64), 40):
        chain ^= 1 << b
        fps.add(chain)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    found = simhash.links(lspark.createDataFrame([(f,) for f in signed], "fp long"), bits).collect()
    at = {f: i for i, f in enumerate(signed)}
    for r in found:
        assert ((r["a"] ^ r["b"]) & (1 << 64) - 1).bit_count() <= bits
    assert roots(len(fps), [(at[r["a"]], at[r["b"]]) for r in found]) == brute(fps, bits)


def test_blocks_agree_by_pigeonhole():
    for n in (1, 10**3, 10**6, 10**12):
        for bits in (0, 4, 8):
            blocks, agreeing = simhash.bit_blocks(n, bits)
            assert blocks - bits == agreeing and 64 >= blocks


def test_components(lspark):
    rnd = random.Random(1)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(rnd.randrange(200, 300), rnd.randrange(200, 300)) for _ in range(70)] + [(400, 400)]
    got = {r["node"]: r["root"] for r in components(lspark.createDataFrame(pairs, "a long, b long")).collect()}
    want = roots(401, pairs)
    assert got == {n: want[n] for p in pairs if p[0] != p[1] for n in p}


def test_odd_rows(lspark, odd_docs):
    got = simhash.near_duplicates(odd_docs, 4, 4).collect()
    assert len(got) == odd_docs.count()
    zero = [r for r in got if r["fp"] == 0]
    assert {r["doc_id"] for r in zero} == {2, 3, 4, None} and {r["component_id"] for r in zero} == {2}
    assert [r["component_id"] for r in got if r["doc_id"] is None and r["fp"]] == [None]
    kept = simhash.one_of_each(odd_docs, 4, 4)
    assert kept.columns == odd_docs.columns
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept.select("doc_id", "text").collect())[:3] == [(0, "a text without an id"), (1, "the quick brown fox jumps over the lazy dog"), (2, "")]
    assert kept.count() == len({r["group"] for r in got})


def test_empty_table(lspark, no_docs):
    assert simhash.near_duplicates(no_docs, 4, 4).collect() == []
    assert simhash.one_of_each(no_docs, 4, 4).collect() == []


def test_very_long_text(lspark):
    words = [f"w{i % 997}" for i in range(70_000)]  # crosses the bounded arrays
    assert simhash._simhash(" ".join(words), 4) == plain_print(" ".join(words))
