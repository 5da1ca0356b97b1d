"""Toxicity: held-out quality, the machine's formula, and pairs that no additive score can tell."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from clicklens.llm import queries, toxicity

SF = "/root/testdata/sf0.1"


def terms_of(texts):
    found = [np.zeros(0, np.uint32)] * len(texts)
    for first, owner, terms in toxicity.term_rows(texts):
        for k in set(owner.tolist()):
            found[first + k] = terms[owner == k].astype(np.uint32)
    return found


def test_held_out_quality_of_the_query(lspark):
    got = queries.QUERIES["op12_toxicity"](lspark, SF).toPandas()
    docs = lspark.read.parquet(f"{SF}/documents.parquet")
    assert len(got) == docs.count() and got.score.between(0, 1).all()
    assert ((got.score >= 0.5).astype(int) == got.predicted).all()
    assert (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()
    both = got.merge(lspark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic").toPandas(), on="doc_id")
    both = both[both.held_out]
    assert both.predicted[both.toxic == 1].mean() > 0.9
    assert both.predicted[both.toxic == 0].mean() < 0.01


def test_labels_held_out_are_not_looked_at(lspark):
    small = "/root/testdata/sf0.01"
    docs, labels = (lspark.read.parquet(f"{small}/{n}.parquet") for n in ("documents", "labels"))
    other = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.fit(docs, x.filter(~toxicity.held_out(F.col("doc_id")))) for x in (labels, other))
    assert len(a.terms) and np.array_equal(a.terms, b.terms) and np.array_equal(a.weights, b.weights) and a.bias == b.bias


def paired(seed, count):
    """Toxic where an insult meets a group; insults alone and groups alone are not."""
    r = random.Random(seed)
    insults, groups, rest = ([f"{k}{i}" for i in range(n)] for k, n in (("insult", 3), ("group", 3), ("word", 200)))
    for _ in range(count):
        toxic, words = r.random() < 0.4, r.sample(rest, 20)
        if toxic:
            words += [r.choice(insults), r.choice(groups)]
        else:
            words += r.choice([r.sample(insults, 3), r.sample(groups, 3), r.sample(insults, 2), []])
        r.shuffle(words)
        yield " ".join(words), int(toxic)


def test_pairs_weigh_what_single_terms_cannot():
    texts, labels = zip(*paired(1, 2000), strict=True)
    model = toxicity.train(terms_of(texts), np.array(labels, float))
    texts, labels = zip(*paired(2, 500), strict=True)
    y = np.array(labels)
    assert ((toxicity.scores(list(texts), model) >= 0.5) == y).mean() > 0.97
    alone = toxicity.Model(model.terms, model.bias, model.weights, model.factors * 0)
    assert ((toxicity.scores(list(texts), alone) >= 0.5) == y).mean() < 0.9


def test_scores_are_the_formula():
    texts = ["A bb CCC", "", None, "bb bb ddd été", "x " * 400_000 + "bb"]
    known = np.unique(np.concatenate(terms_of(texts)))
    r = np.random.default_rng(3)
    model = toxicity.Model(known, -0.2, r.normal(size=len(known)).astype(np.float32), r.normal(size=(len(known), 3)).astype(np.float32))
    for t, got in zip(texts, toxicity.scores(texts, model), strict=True):
        i = np.searchsorted(known, terms_of([t])[0])
        z = model.bias + model.weights[i].sum()
        z += sum(float(model.factors[a] @ model.factors[b]) for k, a in enumerate(i) for b in i[k + 1 :])
        assert abs(got - 1 / (1 + np.exp(-z))) < 1e-4


def test_terms_are_words_and_beginnings_once():
    a, b, c, d = terms_of(["Stupid, stupid", "stupi d", "stupidly", "STUPID!"])
    assert np.array_equal(a, d) and len(a) == 2
    assert len(np.intersect1d(a, c)) == 1 and len(c) == 2 and len(b) == 4
    long_ = "lorem ipsum " * 200_000  # read in pieces
    assert np.array_equal(terms_of([long_])[0], terms_of(["lorem ipsum"])[0])


def test_odd_rows(lspark, odd_docs):
    labels = lspark.createDataFrame([(1, 1, 0), (1, 0, 1), (6, 1, 0), (7, 1, 0), (3, 0, 1), (None, 0, 1), (5, 0, None), (99, 0, 1)], "doc_id int, quality int, toxic int")
    model = toxicity.fit(odd_docs, labels)
    got = toxicity.score_texts(odd_docs, model)
    assert got.columns == [c for c in odd_docs.columns if c != "score"] + ["score", "predicted"]
    rows = got.collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    by_text = {}
    for r in rows:
        assert by_text.setdefault(r["text"], r["score"]) == r["score"]
    assert by_text[None] == by_text[""]
    share = toxicity.score_texts(odd_docs, toxicity.fit(odd_docs, labels.filter("toxic = 0")))
    assert all(r["score"] < 1e-9 and r["predicted"] == 0 for r in share.collect())


def test_the_higher_label_of_an_id_counts(lspark):
    docs = lspark.createDataFrame([(i, f"bad text{i}" if i % 2 else f"good text{i}") for i in range(80)], "doc_id long, text string")
    labels = lspark.createDataFrame([(i, k) for i in range(80) for k in ([0, 1] if i % 2 else [0, 0])], "doc_id long, toxic int")
    found = toxicity.score_texts(docs, toxicity.fit(docs, labels)).collect()
    assert all(r["predicted"] == r["doc_id"] % 2 for r in found)


def test_empty_tables(lspark, no_docs):
    none = lspark.createDataFrame([], "doc_id long, toxic int")
    docs = lspark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert toxicity.score_texts(no_docs, toxicity.fit(no_docs, none)).collect() == []
    assert [r["predicted"] for r in toxicity.score_texts(docs, toxicity.fit(docs, none)).collect()] == [0]
