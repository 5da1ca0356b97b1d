"""The line reader against the standard library, its plan, and inputs of several runs and streams."""

import csv
import datetime as dt
import os
import random
import re

import pytest
from pyspark.errors import PySparkException

from clicklens.operators import keyword_report
from clicklens.plans import SearchKeywordJob
from clicklens.sinks import read_report_table
from clicklens.sources.tsv import hits_from_lines, lines_frame, read_hits
from clicklens.streaming import incremental, incremental_report, read_running_revenue, running_revenue

HEADER = "event_list\tproduct_list\treferrer"
DAY = dt.date(2024, 7, 1)


def purchase(keyword, price):
    return f"1\tE;X;1;{price};\thttp://www.google.com/search?q={keyword}"


def write(path, *lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write("\n".join([HEADER, *lines]) + "\n")


def test_fields_as_the_standard_library_reads_them(spark):
    r, texts = random.Random(1), ["", "a", '"b"', '"b\tc"', '"x""y"', '""', '"q"tail', '"q"ta"il', 'mid"dle', '"""t"', '" "', '"a""b\t""c"z', '"\t"']
    lines = ["\t".join(r.choice(texts) for _ in range(r.randint(1, 5))) for _ in range(2000)]
    want = [tuple(x or None for x in f[:3]) for f in csv.reader(lines, delimiter="\t") if len(f) >= 3]
    got = hits_from_lines(lines_frame(spark, lines), ["a", "b", "c"], columns=["a", "b", "c"]).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


@pytest.mark.parametrize("line", ['a\tb\t"open', '"open\tb\tc', 'a\t"x""\tc', 'a\tb\t"'])
def test_an_open_quote_fails_the_read(spark, line):
    with pytest.raises(PySparkException, match="multi_line"):
        hits_from_lines(lines_frame(spark, ["x\ty\tz", line]), ["a", "b", "c"], columns=["a"]).collect()


def test_long_quoted_fields_need_no_deep_stack(spark):
    inner = "ab\t" * 100_000 + '""' * 100_000
    row = hits_from_lines(lines_frame(spark, [f'1\t"{inner}"\t3']), ["a", "b", "c"], columns=["b", "c"]).first()
    assert row["b"] == inner.replace('""', '"') and row["c"] == "3"


def test_lines_are_cut_once(spark, tmp):
    write(f"{tmp}/in/a.tab", purchase("a", 1))
    plan = keyword_report(read_hits(spark, f"{tmp}/in"))._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"split\(value", plan)) == 1
    assert plan.count("regexp_extract_all(concat(value") == 1 and "from_csv" not in plan


def test_many_headers_one_scan(spark, tmp):
    names = ["referrer", "event_list", "product_list"]
    for k in range(40):
        order = random.Random(k).sample(names, 3)
        values = dict(zip(names, (f"http://www.bing.com/search?q=k{k}", "1", f"E;X;1;{k + 1};"), strict=True))
        header = "\t".join([*(f"extra{k}_{i}" for i in range(k % 5)), *(f" {n} " for n in order)])
        os.makedirs(f"{tmp}/in", exist_ok=True)
        with open(f"{tmp}/in/f {k}+%.tab", "w", encoding="utf-8") as f:
            f.write(f"{header}\n" + "\t".join([*["-"] * (k % 5), *(values[n] for n in order)]) + "\nshort\n")
    hits = read_hits(spark, f"{tmp}/in", with_input_file=True)
    assert hits._jdf.queryExecution().executedPlan().toString().count("FileScan text") == 1
    rows = hits.select("referrer", "event_list", "product_list", "user_agent", "input_file").collect()
    assert {(r[0], r[1], r[2], r[3]) for r in rows} == {(f"http://www.bing.com/search?q=k{k}", "1", f"E;X;1;{k + 1};", None) for k in range(40)}
    assert len({r["input_file"] for r in rows}) == len(rows) == 40


def test_a_run_by_input_leaves_the_other_inputs(spark, tmp):
    def run(name):
        job = SearchKeywordJob(f"{tmp}/{name}", f"{tmp}/o", DAY, table_path=f"{tmp}/t", by_input=True)
        job.run(spark)
        rows = read_report_table(spark, f"{tmp}/t", DAY, extra="input_file string").collect()
        return sorted((os.path.basename(r["input_file"]), r["revenue"]) for r in rows)

    write(f"{tmp}/a.tab", purchase("a", 1))
    write(f"{tmp}/b.tab", purchase("b", 2))
    assert run("a.tab") == [("a.tab", 1.0)]
    assert run("b.tab") == [("a.tab", 1.0), ("b.tab", 2.0)]
    write(f"{tmp}/a.tab", purchase("a", 7))
    assert run("a.tab") == [("a.tab", 7.0), ("b.tab", 2.0)]
    write(f"{tmp}/a.tab", "short")
    assert run("a.tab") == [("b.tab", 2.0)]


def test_a_passing_fault_loses_no_upload(spark, tmp, monkeypatch):
    write(f"{tmp}/in/a.tab", purchase("a", 1))
    real, left = incremental._Reports._write, [incremental.ATTEMPTS + 1]

    def fails(self, todo):
        if left[0]:
            left[0] -= 1
            raise PySparkException("executor lost")
        real(self, todo)

    monkeypatch.setattr(incremental._Reports, "_write", fails)
    run = lambda: incremental_report(spark, f"{tmp}/in", f"{tmp}/t", f"{tmp}/c", run_date=DAY).awaitTermination()
    with pytest.raises(PySparkException):
        run()
    run()
    assert [(r["path"].rpartition("/")[2], r["error"]) for r in incremental.read_ledger(spark, f"{tmp}/t").collect()] == [("a.tab", None)]
    assert read_report_table(spark, f"{tmp}/t", DAY).count() == 1


def test_a_broken_file_does_not_stop_the_totals(spark, tmp):
    write(f"{tmp}/in/a.tab", purchase("a", 1))
    write(f"{tmp}/in/b.tab", '1\t"open\tx')
    for _ in range(2):
        running_revenue(spark, f"{tmp}/in", f"{tmp}/t", f"{tmp}/c").awaitTermination()
        assert [r["revenue"] for r in read_running_revenue(spark, f"{tmp}/t").collect()] == [1.0]
    assert [r["path"].rpartition("/")[2] for r in incremental.read_set_aside(spark, f"{tmp}/t").collect()] == ["b.tab"]
