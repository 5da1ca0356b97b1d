"""Decontamination: planted and edited items, the pieces against plain versions."""

import random
import tracemalloc

import numpy as np
import pytest

from clicklens.llm import common, decontam, queries
from clicklens.llm.common import word_hashes

SF = "/root/testdata/sf0.01"


def words_of(text):
    return "".join(chr(b) for b in (text or "").encode().translate(decontam._CLEAN)).split()


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_query_finds_the_planted_items(lspark):
    """Against every run of five words: a document holds an item if it has most of the item's runs."""
    docs = {r["doc_id"]: words_of(r["text"]) for r in lspark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = {r["item_id"]: words_of(r["text"]) for r in lspark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    runs = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    own = {i: runs(w) for i, w in items.items()}
    want = {(d, i) for d, w in docs.items() for i, o in own.items() if len(o & runs(w)) >= 0.6 * len(o)}
    got = queries.QUERIES["op4_decontamination"](lspark, SF).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want and len(got) == len(want) > 0


@pytest.fixture(scope="module")
def planted(spark):
    """Items whole, with few and with many words changed, between other text."""
    rnd = random.Random(3)
    vocabulary = [f"{a}{b}{c}" for a in "brgdt" for b in "aeiou" for c in ("n", "st", "lm", "rk", "p")]
    some = lambda n: rnd.choices(vocabulary, k=n)
    items = [(i, " ".join(some(rnd.randrange(12, 70)))) for i in range(30)]
    docs = [(i, " ".join(some(rnd.randrange(20, 300)))) for i in range(300)]
    for kind, rate in ((1000, 0.0), (2000, 0.08), (3000, 0.8)):
        for i, text in items:
            w = [rnd.choice(vocabulary) if rnd.random() < rate else x for x in text.split()]
            docs.append((kind + i, " ".join(some(rnd.randrange(0, 200)) + w + some(rnd.randrange(0, 200)))))
    schema = "doc_id long, text string"
    return spark.createDataFrame(docs, schema), spark.createDataFrame(items, "item_id long, text string")


def test_edited_items(lspark, planted):
    docs, items = planted
    got = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(docs, items).collect()}
    assert all((1000 + i, i) in got for i in range(30))
    assert sum((2000 + i, i) in got for i in range(30)) >= 27
    assert not any(d < 1000 or d >= 3000 for d, _ in got)


def test_blocks_of_items_agree(lspark, planted, monkeypatch):
    docs, items = planted
    whole = sorted(map(tuple, decontam.contaminated(docs, items).collect()))
    monkeypatch.setattr(decontam, "ITEMS_AT_ONCE", 7)
    assert [r[:2] for r in sorted(map(tuple, decontam.contaminated(docs, items).collect()))] == [r[:2] for r in whole]


def test_answer_decides_between_the_thresholds(lspark, monkeypatch):
    monkeypatch.setattr(decontam, "COSINE", 0.3)  # so small a corpus tells passages apart less well
    rnd = random.Random(8)
    item = [f"word{i}" for i in range(40)]
    edited = [f"other{i}" if i % 10 in (0, 3, 6) else w for i, w in enumerate(item)]  # seven tenths in order
    noise = lambda: [f"n{rnd.randrange(999)}" for _ in range(60)]
    docs = [(1, " ".join([*noise(), *edited[:-1], "left", "bank", *noise()])), (2, " ".join([*noise(), *edited, *noise()]))]
    docs += [(i, " ".join(noise())) for i in range(3, 40)]
    benchmark = lspark.createDataFrame([(7, " ".join(item), "left bank")], "item_id long, text string, answer string")
    got = decontam.contaminated(lspark.createDataFrame(docs, "doc_id long, text string"), benchmark).collect()
    share = plain_lcs(item, edited) / len(item)
    assert decontam.LCS_LEAST <= share < decontam.LCS_SURE
    assert [(r["doc_id"], r["answer"]) for r in got] == [(1, True)]


def test_subsequence_length():
    rnd = random.Random(5)
    for _ in range(200):
        a, b = ([rnd.randrange(6) for _ in range(rnd.randrange(1, 90))] for _ in "ab")
        assert decontam._lcs(np.array(a), b) == plain_lcs(a, b)


def test_space_finds_topics(lspark, monkeypatch):
    """With as many directions as topics, passages of one topic lie together and others apart."""
    monkeypatch.setattr(decontam, "RANK", 12)
    monkeypatch.setattr(decontam, "SKIPPED", 0)
    rnd = random.Random(6)
    topics = [[f"t{k}w{i}" for i in range(30)] for k in range(12)]
    texts = [" ".join(rnd.choices(topics[i % 12], k=32)) for i in range(240)]
    docs = lspark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    space = decontam.fit(docs, docs.filter("doc_id < 12"))
    counts, _ = decontam.term_counts(docs)
    x = np.stack([space.projection[decontam._terms(next(word_hashes([t.encode()]))[1])].sum(axis=0) for t in texts])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    same = np.array([[i % 12 == j % 12 for j in range(240)] for i in range(240)])
    cosine = x @ x.T
    assert cosine[same].mean() > 0.9 and abs(cosine[~same].mean()) < 0.1
    assert counts.sum() == sum(len(set(t.split())) for t in texts)


def test_long_documents_are_cut_in_sections(lspark, planted, monkeypatch):
    docs, items = planted
    monkeypatch.setattr(decontam, "SECTION", 100)
    monkeypatch.setattr(decontam, "OVERLAP", 150)
    space = decontam.fit(docs, items)
    batch = decontam.items_of([tuple(r) + (None,) for r in items.collect()], space)
    rnd = random.Random(9)
    rows = []
    for i, text in items.collect():
        rows.append(" ".join(f"z{rnd.randrange(10**5)}" for _ in range(rnd.randrange(0, 900))) + " " + text + " tail" * 300)
    found = set()
    for group in decontam._sections(word_hashes([r.encode() for r in rows])):
        found |= {(k, i) for k, i, *_ in decontam._matches(group, space, batch)}
    assert {(k, k) for k in range(len(rows))} <= found


def test_odd_rows_and_empty_tables(lspark, odd_docs, no_docs):
    benchmark = lspark.createDataFrame([(1, None), (2, ""), (None, "the quick brown fox jumps over the lazy dog"), (3, "too short")], "item_id long, text string")
    got = decontam.contaminated(odd_docs, benchmark).collect()
    assert [(r["doc_id"], r["item_id"]) for r in got] == [(1, None), (1, None)]
    assert decontam.contaminated(no_docs, benchmark).collect() == []
    assert decontam.contaminated(odd_docs, benchmark.limit(0)).collect() == []


def edited(rnd, words, rate):
    """A copy with a share of the words replaced, no two replacements alike."""
    out = list(words)
    for i in rnd.sample(range(len(out)), round(rate * len(out))):
        out[i] = f"edit{rnd.randrange(10**9)}"
    return out


def test_answer_decides_at_the_production_thresholds(lspark):
    rnd = random.Random(8)
    item = [f"word{i}" for i in range(40)]
    changed = [w if i % 20 in (0, 1, 3, 4, 6, 7, 9, 10, 12, 13, 15, 16, 18) else f"other{i}" for i, w in enumerate(item)]
    noise = lambda: [f"n{rnd.randrange(999)}" for _ in range(60)]
    docs = [(1, " ".join([*noise(), *changed[:-1], "left", "bank", *noise()])), (2, " ".join([*noise(), *changed, *noise()]))]
    docs += [(i, " ".join(noise())) for i in range(3, 40)]
    benchmark = lspark.createDataFrame([(7, " ".join(item), "left bank")], "item_id long, text string, answer string")
    got = decontam.contaminated(lspark.createDataFrame(docs, "doc_id long, text string"), benchmark).collect()
    assert plain_lcs(item, changed) / len(item) == 0.65
    assert [(r["doc_id"], r["answer"]) for r in got] == [(1, True)]


def test_every_probe_within_the_thresholds_is_found(lspark):
    """At the production values, against the longest common subsequence of every run of a document."""
    rnd = random.Random(4)
    vocabulary = [f"v{i}" for i in range(400)]
    some = lambda n: rnd.choices(vocabulary, k=n)
    items = [(i, some(rnd.randrange(8, 60))) for i in range(24)]
    docs = [(i, some(rnd.randrange(0, 80))) for i in range(60)]
    for rate in (0.0, 0.1, 0.2, 0.25, 0.35, 0.5):
        docs += [(1000 * round(100 * rate) + i, [*some(rnd.randrange(60)), *edited(rnd, w, rate), *some(rnd.randrange(60))]) for i, w in items]
    names = {x: k for k, x in enumerate(vocabulary)}
    want = {}
    for d, text in docs:
        for i, w in items:
            width = len(w) + 2 * max(8, len(w) // 4)
            if len(set(w) & set(text)) < 0.6 * len(set(w)):
                continue
            for s in range(max(1, len(text) - width + 1)):
                part = text[s : s + width]
                share = decontam._lcs(np.array([names[x] for x in w]), [names.get(x, -1) for x in part]) / len(w)
                answer = any(part[k : k + 5] == w[-5:] for k in range(len(part)))
                if share >= 0.75 or share >= 0.6 and answer:
                    want[d, i] = max(want.get((d, i), 0), share)
    as_rows = lambda rows: [(i, " ".join(w)) for i, w in rows]
    got = decontam.contaminated(lspark.createDataFrame(as_rows(docs), "doc_id long, text string"), lspark.createDataFrame(as_rows(items), "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]): r["lcs"] for r in got} == want and len(want) > 90


def test_short_items_and_scripts_without_spaces(lspark):
    rnd = random.Random(12)
    vocabulary = [f"v{i}" for i in range(300)]
    some = lambda n: " ".join(rnd.choices(vocabulary, k=n))
    items = [(n, some(n)) for n in range(3, 12)] + [(1, "onlyword"), (2, "two words")]
    items += [(20, "法国的首都是哪一座城市？"), (21, "日本で一番高い山は何ですか。"), (22, "ประเทศไทยมีเมืองหลวงชื่ออะไร"), (23, "水是什么")]
    docs = [(100 + i, f"{some(40)} {t}, {some(40)}") for i, t in items if i < 20]
    docs += [(100 + i, f"前面的一些文字在这里{t}後ろの文章もここにあります") for i, t in items if i >= 20]
    docs += [(200, "two other words"), (201, "前面的水，是一些什么文字"), *((i, some(60)) for i in range(30))]
    got = decontam.contaminated(lspark.createDataFrame(docs, "doc_id long, text string"), lspark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(100 + i, i) for i, _ in items}


def test_items_longer_than_the_overlap_across_a_boundary(lspark):
    rnd = random.Random(14)
    some = lambda n: [f"v{rnd.randrange(5000)}" for _ in range(n)]
    long = some(6 * decontam.OVERLAP)
    before = decontam.SECTION + decontam.OVERLAP // 2 - len(long) // 2
    docs = [(k, " ".join([*some(before), *edited(rnd, long[:-5], rate), *some(decontam.SECTION)])) for k, rate in enumerate((0.0, 0.1))]
    benchmark = lspark.createDataFrame([(1, " ".join(long))], "item_id long, text string")
    got = decontam.contaminated(lspark.createDataFrame(docs, "doc_id long, text string"), benchmark).collect()
    # The answer is cut off, so that the share alone decides.
    assert sorted((r["doc_id"], r["answer"]) for r in got) == [(0, False), (1, False)]
    assert all(r["lcs"] >= 0.85 for r in got)


def test_space_is_of_all_passages(lspark):
    """Each direction is scaled to unit variance over every passage of a corpus of more than 40,000."""
    rnd = random.Random(15)
    vocabulary = [f"v{i}" for i in range(300)]
    docs = [(i, " ".join(rnd.choices(vocabulary, k=4))) for i in range(50_000)]
    benchmark = docs[:3]
    space = decontam.fit(*(lspark.createDataFrame(x, "doc_id long, text string") for x in (docs, benchmark)))
    rows = np.concatenate([decontam._passages(h, cuts) for _, h, cuts in word_hashes([t.encode() for _, t in docs + benchmark])])
    assert len(rows) == 50_003
    weight = np.append(space.idf, 0)[rows]
    projection = np.vstack([space.projection[: decontam.TERMS], np.zeros((1, space.projection.shape[1]))])
    along = projection[rows].sum(axis=1) / np.linalg.norm(weight, axis=1, keepdims=True)
    assert np.allclose((along**2).sum(axis=0), 1, atol=1e-3)


def test_sums_by_term():
    rng = np.random.default_rng(3)
    words = np.minimum(rng.zipf(1.3, 32 * 700), 5000).astype(np.uint64) << np.uint64(50)
    rows = decontam._passages(words, np.array([0, len(words)]))
    values = np.vstack([rng.normal(size=(len(rows), 5)), np.zeros((1, 5))])
    want, got = np.zeros((decontam.TERMS + 1, 5)), np.zeros((decontam.TERMS, 5))
    np.add.at(want, rows, values[:-1, None])
    decontam._sums_by_term(rows, values, got)
    assert np.allclose(got, want[:-1])


def test_sums_of_groups_by_size():
    """Groups are summed up to the largest of their block, not up to FAN."""
    r = np.random.default_rng(6)
    sizes = np.sort(r.integers(1, decontam.FAN + 1, 700))[::-1].astype(np.int8)
    table = np.vstack([r.normal(size=(50, 3)), np.full((1, 3), np.nan)])
    rows = np.full((700, decontam.FAN), 50)
    for k, n in enumerate(sizes):
        rows[k, :n] = r.integers(0, 50, n)
        rows[k, n:] = 0
    block = 64
    for at in range(0, 700, block):  # behind the largest of a block stands what must not be read
        rows[at : at + block, sizes[at] :] = 50
    table[0] = 0
    found = decontam._row_sums(rows, table, sizes, block)
    assert np.allclose(found[:-1], [table[x[:n]].sum(axis=0) for x, n in zip(rows, sizes, strict=True)]) and not found[-1].any()


def test_words_are_hashed_in_blocks(monkeypatch):
    """A block of the working size or the whole piece: the same hashes, from arrays of the block's size."""
    r = random.Random(2)
    texts = ["", " ", "one", "x" * 300_000 + " y", *(" \t\n".join(["wort", "é", "a" * r.randrange(1, 90)] * r.randrange(2000)) for _ in range(30))]
    data = [t.encode() for t in texts]

    def hashes():
        return [(i, h.tolist(), cuts.tolist()) for i, h, cuts in word_hashes(data)]

    tracemalloc.start()
    found = hashes()
    whole = b" ".join([b"word"] * (common.PIECE_BYTES // 5))
    tracemalloc.reset_peak()
    before = tracemalloc.get_traced_memory()[0]
    common._hash_piece(whole)
    used = tracemalloc.get_traced_memory()[1] - before
    tracemalloc.stop()
    assert used < 12 * len(whole)
    for size in (64, 1 << 30):
        monkeypatch.setattr(common, "BLOCK_BYTES", size)
        assert hashes() == found


def test_an_answer_stands_as_a_whole():
    r = np.random.default_rng(8)
    for _ in range(500):
        text, part = r.integers(0, 3, r.integers(0, 12)).astype(np.uint64), r.integers(0, 3, r.integers(0, 5)).astype(np.uint64)
        want = len(part) > 0 and any((text[i : i + len(part)] == part).all() for i in range(len(text) - len(part) + 1))
        assert decontam._holds(text, part) == want
