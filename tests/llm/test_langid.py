"""Language identification: held-out accuracy, and the kernel against sets of n-grams."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from clicklens.llm import langid, queries

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_of_the_query(lspark):
    got = queries.QUERIES["op7_language"](lspark, SF).toPandas()
    want = lspark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").toPandas()
    both = got.merge(want, on="doc_id")
    assert len(both) == len(want)
    assert (both.held_out == both.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)).all()
    assert (both.lang == both.lang_pred)[both.held_out].mean() > 0.98
    assert both.score.between(0, 1).all()


def test_labels_held_out_are_not_looked_at(lspark):
    docs = lspark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    other = docs.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang")))
    a, b = (langid.fit(langid.training_rows(d)) for d in (docs, other))
    assert a.languages == b.languages and np.array_equal(a.coefficients, b.coefficients)


def test_presence_counts_distinct_ngrams():
    def grams(t):
        t = " ".join("".join(c if c.isalpha() else " " for c in t.lower()).split(" "))
        while "  " in t:
            t = t.replace("  ", " ")
        t = t.lstrip(" ")
        return {t[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}

    for text in ("Abc abc, abd!", "ñandú Ñandú", "x", "a  b\n\nc 12 d"):
        row = langid.presence([text])[0]
        assert abs(int(row.sum()) - len(grams(text))) <= 1  # hashed places may meet
    long_ = "abc def " * 300_000  # read in pieces
    assert np.array_equal(langid.presence([long_])[0], langid.presence(["abc def " * 10])[0])


def test_odd_rows(lspark, odd_docs):
    model = langid.fit(langid.training_rows(odd_docs))
    got = langid.predict(odd_docs, model)
    assert got.columns == [c for c in odd_docs.columns if c != "score"] + ["lang_pred", "score"]
    rows = got.collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert (r["lang_pred"] == "und") == (r["text"] is None or not any(c.isalpha() for c in r["text"]))
        assert 0 <= r["score"] <= 1 and (r["lang_pred"] != "und" or r["score"] == 0)
    model = langid.fit(odd_docs.filter("lang = 'none'"))
    assert {r["lang_pred"] for r in langid.predict(odd_docs, model).collect()} == {"und"}


def test_empty_table(lspark, no_docs):
    assert langid.predict(no_docs, langid.fit(langid.training_rows(no_docs))).collect() == []


def test_every_labelled_text_is_learned_from(lspark):
    """Against ridge regression over all rows at once, of more than 400 of a language."""
    rnd = random.Random(2)
    syllables = {"xa": ["ka", "lo", "mi", "nu"], "xb": ["ka", "lo", "tse", "ri"], "xc": ["mi", "ri", "tse", "gu"]}
    rows = [(i, " ".join("".join(rnd.choices(syllables[n], k=3)) for _ in range(4)), n) for i, n in enumerate(rnd.choices([*syllables], [6, 2, 1], k=1500))]
    model = langid.fit(lspark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3))
    assert model.languages == sorted(syllables)
    x = langid.presence([t for _, t, _ in rows]).astype(float)
    k = (x / np.sqrt(x.sum(axis=1, keepdims=True))) @ model.landmarks
    y = np.array([[n == m for m in model.languages] for _, _, n in rows], float)
    weight = (y / y.sum(axis=0)).sum(axis=1, keepdims=True)
    marks = model.landmarks.T.astype(float) @ model.landmarks
    left = k.T @ (k * weight) + langid.RIDGE * (marks + 1e-6 * np.eye(len(marks)))
    want = k @ np.linalg.solve(left, k.T @ (y * weight))
    assert np.abs(k @ model.coefficients - want).max() < 1e-3


def test_landmarks_are_first_by_the_hash_of_the_id(lspark):
    rows = [(i // 2, f"{'ab'[i % 2]} text {chr(97 + i % 26) * (1 + i % 5)}", ("en", "de")[i % 3 == 0]) for i in range(600)]
    docs = lspark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = docs.select("lang", "text", F.xxhash64(F.col("doc_id").cast("string")).alias("h"), F.xxhash64("text").alias("th")).collect()
    per = langid.LANDMARKS // 2
    first = [r["text"] for n in ("de", "en") for r in sorted((r for r in found if r["lang"] == n), key=lambda r: (r["h"], r["th"]))[:per]]
    x = langid.presence(first)
    assert np.allclose(langid.fit(docs).landmarks, (x / np.sqrt(x.sum(axis=1, keepdims=True))).T)
