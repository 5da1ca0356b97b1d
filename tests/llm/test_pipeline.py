"""The corpus pipeline, stage by stage, against plain versions of the decisions."""

import random
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from clicklens.llm import langid, mixing, queries
from clicklens.llm.common import stored

from .test_decontam import words_of
from .test_simhash import brute, plain_print
from .test_tokens import expected

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Each stage's input and result."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, f in pipeline.STAGES:
        after = stored(f(spark, docs, SF), name)
        out[name] = (docs, after)
        docs = after
    return out


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_columns(stages):
    for name, (before, after) in stages.items():
        assert name == "token_output" or after.columns == before.columns


def test_language(lspark, stages):
    before, after = stages["language_id"]
    found = langid.predict(before, langid.fit(langid.training_rows(before)))
    assert ids(after) == ids(found.filter((F.col("lang_pred") != "und") & (F.col("score") >= pipeline.LEAST_SCORE)))
    assert len(ids(after)) >= 0.99 * before.count()


def test_near_duplicates(stages):
    before, after = stages["simhash_near_dedup"]
    rows = before.orderBy("doc_id").collect()
    assert ids(after) == sorted({rows[c]["doc_id"] for c in brute([plain_print(r["text"]) for r in rows])})


def test_decontamination(lspark, stages):
    before, after = stages["decontamination"]
    items = [words_of(r["text"]) for r in lspark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    runs = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    bad = [r["doc_id"] for r in before.collect() if any(len(runs(w) & runs(words_of(r["text"]))) >= 0.6 * len(runs(w)) for w in items)]
    assert bad and ids(after) == sorted(set(ids(before)) - set(bad))


def test_mixing(stages):
    before, after = stages["mixing"]
    con = duckdb.connect()
    con.register("documents", before.toPandas())
    want = {r[0]: r[1] for r in con.execute(f"SELECT doc_id, taken // size FROM ({mixing.ORACLE_SQL}) WHERE taken > 0").fetchall()}
    assert Counter(ids(after)) == want


def test_token_output(lspark, stages):
    before, after = stages["token_output"]
    rows = [tuple(r) for r in before.select("doc_id", "text").orderBy("doc_id").collect()]
    want = expected(rows, queries.word_tokenizer())
    assert sorted(map(tuple, after.select("doc_id", "start", "n_tokens", "ids_crc32").collect())) == sorted(want)


def test_odd_rows(lspark, odd_docs):
    docs = odd_docs
    for name, f in pipeline.STAGES:
        after = stored(f(lspark, docs, SF), name)
        assert name == "token_output" or after.columns == odd_docs.columns
        docs = after
    assert docs.count() > 0


def test_empty_table(lspark, no_docs):
    docs = no_docs
    for name, f in pipeline.STAGES:
        docs = stored(f(lspark, docs, SF), name)
        assert docs.count() == 0


@pytest.mark.parametrize("languages", [1, 4, 30])
def test_clean_documents_stay_whatever_the_number_of_languages(lspark, languages):
    rng = random.Random(languages)
    rows = []
    for k in range(languages):
        letters = rng.sample("abcdefghijklmnopqrstuvwxyz", 14)
        words = ["".join(rng.choices(letters, k=rng.randint(2, 9))) for _ in range(300)]
        rows += [(len(rows) + i, " ".join(rng.choices(words, k=60)), f"l{k:02}", "s") for i in range(40)]
    docs = lspark.createDataFrame([*rows, (-1, "12 34 !", "l00", "s")], "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"] for r in pipeline.language_id(lspark, docs, SF).collect()}
    assert -1 not in kept and len(kept) >= 0.99 * len(rows)
