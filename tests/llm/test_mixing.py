"""Mixing: the SQL, the tree's sums and distribution, targets against plain resharing."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from clicklens.llm import mixing, queries

from .conftest import SF


def test_query_against_sql(lspark):
    got = sorted(map(tuple, queries.QUERIES["op3_mixing"](lspark, SF).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert got == sorted(con.execute(mixing.ORACLE_SQL).fetchall())


def reshared(sizes, weights, cap=3):
    """Targets by giving the excess back again and again."""
    total, open_, out = sum(sizes), set(range(len(sizes))), [0.0] * len(sizes)
    left = float(total)
    while open_:
        unit = left / sum(weights[i] for i in open_)
        above = {i for i in open_ if unit * weights[i] > cap * sizes[i]}
        for i in above or open_:
            out[i] = cap * sizes[i] if above else unit * weights[i]
        if not above:
            break
        left -= sum(out[i] for i in above)
        open_ -= above
    return out


@pytest.mark.parametrize("sizes", [[5, 1, 1, 900, 3], [0, 10, 0], [7], [100, 100, 100, 1], [0, 0]])
def test_targets(lspark, sizes):
    rows = [(f"s{i:02}", f"{i:02}", n) for i, n in enumerate(sizes)]
    got = mixing.source_targets(lspark.createDataFrame(rows, "key string, source string, size long")).orderBy("source").collect()
    want = reshared(sizes, [float(mixing.WEIGHTS[i % 3]) for i in range(len(sizes))])
    assert [r["target"] for r in got] == pytest.approx(want)


def docs_of(spark, n=3000):
    rnd = np.random.default_rng(5)
    rows = [(i, " ".join(["w"] * int(rnd.integers(0, 60))), "abcd"[min(3, int(rnd.integers(0, 9)))]) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_mix_meets_targets_whatever_the_blocks(lspark):
    docs = docs_of(lspark)
    fine, coarse = (mixing.allot(docs, block_words=b, shard_words=s).select("doc_id", "source", "size", "target", F.size("picks").alias("n"), "picks").toPandas() for b, s in ((150, 4000), (10**6, 10**9)))
    a, b = (x.sort_values("doc_id")[["doc_id", "n"]].to_numpy().tolist() for x in (fine, coarse))
    assert a == b  # blocks and shards deal documents out, they don't choose them
    fine["taken"] = fine["size"] * fine["n"]
    by = fine.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"), largest=("size", "max"))
    assert ((by.taken - by.target).abs() <= by.largest / 2 + 1).all() and (fine.n <= 3).all()
    shards = {p["shard"] for ps in fine.picks for p in ps}
    assert len(shards) > 10


def test_reruns_agree(lspark):
    one, two = (sorted(map(tuple, mixing.mix(docs_of(lspark, 500), block_words=100, shard_words=1000).select("doc_id", "pass", "shard").collect())) for _ in range(2))
    assert one == two and one


def test_tree_is_exact_and_hypergeometric(lspark):
    quotas = lspark.createDataFrame([(f"s{i}", 37 + 400 * i) for i in range(6)], "key string, quota long")
    for shards in (1, 2, 7, 16):
        got = mixing.split_quotas(quotas, shards).toPandas()
        assert got.groupby("key").n.sum().to_dict() == {f"s{i}": 37 + 400 * i for i in range(6)}
        total = got.groupby("shard").n.sum()
        assert len(total) == shards and total.max() - total.min() <= shards
    # One draw of 40 from 30 of 100, many times over: mean and variance are those of the distribution.
    nodes = lspark.range(4000).select(F.array(F.lit(30), F.lit(70)).cast("array<long>").alias("q"), F.col("id").cast("int").alias("lo"), F.lit(2).alias("width"), F.lit(100).cast("long").alias("total"), F.lit(40).cast("long").alias("wanted"))
    left = nodes.select(F.expr(mixing._LEFT).alias("x")).select("x").toPandas().x
    x = np.array([v[0] for v in left])
    assert all(sum(v) == 40 for v in left)
    assert abs(x.mean() - 12) < 0.15 and abs(x.var() - 40 * 0.3 * 0.7 * 60 / 99) < 0.5


def test_odd_rows(lspark, odd_docs):
    got = mixing.allot(odd_docs).select("doc_id", "source", "size", "source_size", "target", "picks").collect()
    assert len(got) == odd_docs.count()
    assert all(r["picks"] == [] for r in got if r["size"] == 0)
    assert {r["size"] for r in got if r["doc_id"] in (2, 3, 4)} == {0}
    mixed = mixing.mix(odd_docs)
    assert mixed.columns == [c for c in odd_docs.columns if c not in ("size", "shard")] + ["pass", "shard"]
    assert mixed.count() > 0


def test_empty_table(lspark, no_docs):
    assert mixing.allot(no_docs).collect() == [] and mixing.mix(no_docs).collect() == []


@pytest.mark.parametrize("text, n", [(None, 0), ("", 0), (" ", 0), ("a", 1), (" a\x0bb ", 2), ("a \x85", 2), (" ", 1), ("a\n", 1), ("a  ", 2)])
def test_word_count(lspark, text, n):
    assert lspark.createDataFrame([(text,)], "t string").select(mixing.word_count(F.col("t"))).first()[0] == n


def test_no_python_on_the_main_path(lspark):
    plan = queries.QUERIES["op3_mixing"](lspark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
