"""Repeated passages against all windows of the texts."""

import re

import pytest

from clicklens.llm import queries, suffixes

from .conftest import SF

N = suffixes.PASSAGE


def brute(rows):
    """Spans by listing every window of N words."""
    texts = {(i, t) for i, t in rows if t is not None}
    words = {k: re.findall(r"[^\x20\x09-\x0D]+", k[1]) for k in texts}
    where, copies = {}, {}
    for k, w in words.items():
        copies.setdefault(k[1], set()).add(k[0])
        for i in range(len(w) - N + 1):
            where.setdefault(tuple(w[i : i + N]), set()).add(k[1])
    out = set()
    for k, w in words.items():
        if len(w) < N:
            continue
        if len(copies[k[1]]) > 1:
            out.add((k[0], 0, len(w), len(copies[k[1]])))
            continue
        covered = sorted({j for i in range(len(w) - N + 1) if len(where[tuple(w[i : i + N])]) > 1 for j in range(i, i + N)})
        for j in covered:
            if j - 1 not in covered:
                end = j
                while end in covered:
                    end += 1
                out.add((k[0], j, end, 1))
    return out


def test_query_against_brute_force(lspark):
    rows = [tuple(r) for r in lspark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert {tuple(r) for r in queries.QUERIES["op2_repeats"](lspark, SF).collect()} == brute(rows)


@pytest.mark.parametrize("partitions", ["1", "5"])
def test_planted_passages(lspark, partitions):
    """A passage that most texts share, shorter ones, chains, and repeats within a text; in few and many ranges."""
    import random

    rnd = random.Random(4)
    some = lambda n: [f"w{rnd.randrange(10**6)}" for _ in range(n)]
    hot, edge, short = some(70), some(N), some(N - 1)
    rows = []
    for i in range(60):
        w = some(rnd.randrange(0, 90))
        if i % 3:
            w += hot
        w += some(rnd.randrange(0, 40))
        w += edge if i in (3, 44) else short if i % 7 == 0 else []
        rows.append((i, " ".join(w + some(rnd.randrange(0, 5)))))
    rows += [(100, " ".join(hot[:55] + hot[:55])), (101, " ".join(["x"] * 200)), (102, rows[5][1]), (103, rows[5][1])]
    old = lspark.conf.get("spark.sql.shuffle.partitions")
    lspark.conf.set("spark.sql.shuffle.partitions", partitions)
    lspark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {tuple(r) for r in suffixes.repeats(lspark.createDataFrame(rows, "doc_id long, text string")).collect()}
    finally:
        lspark.conf.set("spark.sql.shuffle.partitions", old)
        lspark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == brute(rows)


def test_odd_rows(lspark, odd_docs):
    text = " ".join(f"w{i}" for i in range(60))
    more = lspark.createDataFrame([(None, text), (8, f"other words {text}"), (8, f"other words {text}")], "doc_id long, text string")
    docs = odd_docs.unionByName(more, allowMissingColumns=True)
    got = sorted(map(tuple, suffixes.repeats(docs).collect()), key=str)
    assert got == sorted([(None, 0, 60, 1), (8, 2, 62, 1)], key=str)


def test_empty_table(lspark, no_docs):
    assert suffixes.repeats(no_docs).collect() == []
