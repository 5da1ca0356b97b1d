"""Records with line breaks in fields, over many small splits, against the standard library."""

import csv
import io
import random

import pytest

from clicklens.sources import records as module
from clicklens.sources.records import records
from clicklens.sources.tsv import read_hits


@pytest.fixture()
def small_splits(spark):
    conf = {"spark.sql.files.maxPartitionBytes": "200", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k in conf:
        spark.conf.unset(k)


def put(path, text):
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return path


def as_the_library(text):
    return sorted(str(tuple(x or None for x in r[:3])) for r in csv.reader(io.StringIO(text, newline=""), delimiter="\t") if len(r) >= 3)


def read(spark, path):
    rows = read_hits(spark, path, multi_line=True, columns=["a", "b", "c"]).collect()
    return sorted(str(tuple(r)) for r in rows)


@pytest.mark.parametrize("seed", range(2))
def test_random_files_over_many_splits(small_splits, tmp, seed):
    r = random.Random(seed)
    parts = ["", "x", "word", '"q"', '"two\nlines"', '"\n"', '"a\t\n\tb"', '"d""\n""d"', '"""\n"""', '"cr\r\nlf"', 'mid"dle', '"shut"then', '"' + "long\n" * 30 + '"', "é", '"日\n本"']
    bodies = []
    for k in range(3):
        end = r.choice(["\n", "\r\n"])
        rows = ["\t".join(r.choice(parts) for _ in range(r.choice([3, 3, 3, 2, 4]))) for _ in range(100)]
        bodies.append(end.join(rows) + r.choice(["", end]))
        put(f"{tmp}/{k}.tab", f"a\tb\tc{end}" + bodies[-1])
    assert small_splits.read.text(f"{tmp}/0.tab").rdd.getNumPartitions() > 5
    assert read(small_splits, tmp) == sorted(x for b in bodies for x in as_the_library(b))


def test_one_field_through_many_splits_and_an_open_end(small_splits, tmp):
    body = '1\t"' + "inside\n" * 200 + '"\tz\n2\ty\tz\n3\ty\t"open\nto the end'
    put(f"{tmp}/a.tab", "a\tb\tc\n" + body)
    assert read(small_splits, tmp) == as_the_library(body)


def test_files_with_other_headers_and_none(small_splits, tmp):
    put(f"{tmp}/a.tab", 'a\tb\tc\n1\t"x\ny"\tz\n')
    put(f"{tmp}/b.tab", ' c \td\ta\n3\t"\n"\t1\n')
    put(f"{tmp}/c.tab", "")
    rows = read_hits(small_splits, tmp, multi_line=True, columns=["a", "b", "c"], with_input_file=True).collect()
    got = sorted((r["input_file"][-5:], r["a"], r["b"], r["c"]) for r in rows)
    assert got == [("a.tab", "1", "x\ny", "z"), ("b.tab", "1", None, "3")]


def test_a_record_without_an_end_fails_the_read(small_splits, tmp, monkeypatch):
    monkeypatch.setattr(module, "LONGEST", 500)
    put(f"{tmp}/a.tab", "a\tb\tc\n" + '1\t"open\tz\n' + "2\ty\tz\n" * 300)
    with pytest.raises(Exception, match="left open"):
        read(small_splits, tmp)


def test_lines_without_quotes_need_no_second_read(spark, tmp):
    put(f"{tmp}/a.tab", "a\tb\tc\n1\t2\t3\n")
    plan = records(spark, [f"{tmp}/a.tab"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1 and "Exchange" not in plan
