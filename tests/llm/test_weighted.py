"""Weighted fingerprints: digests against Python, collisions against generalised Jaccard."""

import hashlib
import re
from collections import Counter

import numpy as np

from clicklens.llm import queries, weighted

SF = "/root/testdata/sf0.01"


def words(text):
    return Counter(re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower()))


def jaccard(a, b):
    both = set(a) | set(b)
    return sum(min(a[k], b[k]) for k in both) / sum(max(a[k], b[k]) for k in both) if both else 1.0


def edited(rows):
    """(doc_id, text, edited, next text) for rows of distinct ids."""
    rows = sorted(rows, key=lambda r: -r[0])
    for k, (i, t) in enumerate(rows):
        t, other = t or "", rows[(k + 1) % len(rows)][1] or ""
        cut = len(t) // 3
        yield i, t, t[: len(t) - cut] + other[:cut], other


def test_query_against_brute_force(lspark):
    rows = [tuple(r) for r in lspark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = {r["doc_id"]: r for r in queries.QUERIES["op10_fingerprints"](lspark, SF).collect()}
    assert len(got) == len(rows)
    off = {"near_edited": [], "near_next": []}
    by_text = {}
    for i, t, e, other in edited(rows):
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(e.encode()).hexdigest())
        assert by_text.setdefault(t, r["fingerprint"]) == r["fingerprint"]
        assert by_text.setdefault(e, r["edited_fingerprint"]) == r["edited_fingerprint"]
        a, n = words(t), weighted.SAMPLES
        off["near_edited"].append(r["near_edited"] - jaccard(a, words(e)))
        off["near_next"].append(r["near_next"] - jaccard(a, words(other)))
        pairs = [r["fingerprint"][4 * k : 4 * k + 4] == r["edited_fingerprint"][4 * k : 4 * k + 4] for k in range(n)]
        assert r["near_edited"] == sum(pairs) / n
    for x in map(np.array, off.values()):
        assert abs(x.mean()) < 0.02 and x.std() < 1.2 * 0.5 / weighted.SAMPLES**0.5


def test_weights_count(lspark):
    """Same words, other frequencies: the share of equal samples is the generalised Jaccard."""
    rnd = np.random.default_rng(2)
    rows, want = [], []
    for i in range(120):
        a, b = rnd.integers(1, 9, 40), rnd.integers(1, 9, 40)
        rows.append((i, *(" ".join(f"w{i}x{j} " * int(n) for j, n in enumerate(x)) for x in (a, b))))
        want.append(np.minimum(a, b).sum() / np.maximum(a, b).sum())
    texts = lspark.createDataFrame(rows, "id long, a string, b string")
    got = weighted.signatures(texts, "a", "b", ["id"]).withColumn("near", weighted.likeness("first_print", "second_print")).toPandas().sort_values("id")
    assert abs((got.near - np.array(want)).mean()) < 0.02


def test_neighbours(lspark):
    for ids in ([5], [3, 1, 2], list(range(0, 400, 7)), [-5, 0, 9]):
        got = {r["id"]: r["next_id"] for r in weighted.next_ids(lspark.createDataFrame([(i,) for i in ids], "id long")).collect()}
        down = sorted(ids, reverse=True)
        assert got == {i: down[(k + 1) % len(down)] for k, i in enumerate(down)}


def test_odd_rows_and_empty_tables(lspark, odd_docs, no_docs):
    got = weighted.fingerprints(odd_docs).collect()
    assert len(got) == odd_docs.count()
    blank = weighted.NO_SAMPLE * weighted.SAMPLES
    assert {r["fingerprint"] for r in got if r["doc_id"] in (2, 3, 4)} == {blank}
    assert all(r["near_edited"] == 1 for r in got if r["doc_id"] in (2, 3))
    assert len({(r["fingerprint"], r["edited_sha256"]) for r in got if r["doc_id"] == 1}) == 1
    assert weighted.fingerprints(no_docs).collect() == []


def test_no_python_on_the_main_path(lspark):
    plan = queries.QUERIES["op10_fingerprints"](lspark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_repeated_rows_weigh_once(lspark):
    """Equal texts have equal fingerprints, also where one of them stands in repeated rows."""
    rnd = np.random.default_rng(5)
    text = " ".join(f"w{n}" for n in rnd.integers(0, 60, 200))
    rows = [(1, text), (1, text), (1, text), (2, text), (3, "another text with other words"), (1, "a second text of one id")]
    got = weighted.fingerprints(lspark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    assert len({r["fingerprint"] for r in got if r["n_chars"] == len(text)}) == 1
