"""The log of uploads, files uploaded again, and totals that follow them."""

import datetime as dt
import os

import pytest

from clicklens.streaming import incremental, read_running_revenue, running_revenue, uploads

HEADER = "event_list\tproduct_list\treferrer"
T0 = 1_700_000_000


def put(path, at, *bought):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write("\n".join([HEADER, *(f"1\tE;X;1;{price};\thttp://www.google.com/search?q={word}" for word, price in bought)]) + "\n")
    os.utime(path, (at, at))


def run(spark, tmp, checkpoint="c"):
    running_revenue(spark, f"{tmp}/in", f"{tmp}/t", f"{tmp}/{checkpoint}").awaitTermination()
    return sorted((r["search_keyword"], r["revenue"]) for r in read_running_revenue(spark, f"{tmp}/t").collect())


@pytest.mark.parametrize("fold_every", [50, 1])
def test_a_file_uploaded_again_replaces_its_sums(spark, tmp, monkeypatch, fold_every):
    monkeypatch.setattr(uploads, "FOLD_EVERY", fold_every)
    put(f"{tmp}/in/a.tab", T0, ("x", 0.1), ("y", 2))
    put(f"{tmp}/in/b.tab", T0, ("x", 0.2), ("z", 3))
    assert run(spark, tmp) == [("x", 0.3), ("y", 2.0), ("z", 3.0)]
    # One pair corrected, one gone, one new; a price far from the others comes and goes.
    put(f"{tmp}/in/a.tab", T0 + 100, ("x", 0.7), ("w", 2e22))
    assert run(spark, tmp) == [("w", 2e22), ("x", 0.9), ("z", 3.0)]
    put(f"{tmp}/in/a.tab", T0 + 200)
    assert run(spark, tmp) == [("x", 0.2), ("z", 3.0)]
    put(f"{tmp}/in/a.tab", T0 + 300, ("x", 0.1), ("y", 2))
    assert run(spark, tmp) == [("x", 0.3), ("y", 2.0), ("z", 3.0)]
    # Nothing new; and another stream into the same table, from its own beginning.
    assert run(spark, tmp) == run(spark, tmp, "other") == [("x", 0.3), ("y", 2.0), ("z", 3.0)]


def test_a_broken_second_upload_keeps_what_the_file_held(spark, tmp):
    put(f"{tmp}/in/a.tab", T0, ("x", 1))
    run(spark, tmp)
    put(f"{tmp}/in/a.tab", T0 + 100, ("x", 5), ('y"', 5))
    with open(f"{tmp}/in/a.tab", "a", encoding="utf-8") as f:
        f.write('1\t"open\tx\n')
    os.utime(f"{tmp}/in/a.tab", (T0 + 100, T0 + 100))
    assert run(spark, tmp) == [("x", 1.0)]
    assert incremental.read_set_aside(spark, f"{tmp}/t").count() == 1
    put(f"{tmp}/in/a.tab", T0 + 200, ("x", 7))
    assert run(spark, tmp) == [("x", 7.0)]


def test_the_log_stays_small_and_finds_what_it_holds(spark, tmp, monkeypatch):
    monkeypatch.setattr(uploads, "FOLD_EVERY", 10)
    log = uploads.Log(spark, f"{tmp}/log", "path string, mtime timestamp")
    start, all_of_them = dt.datetime(2024, 1, 1), []
    for i in range(45):
        rows = [(f"f{i}", start + dt.timedelta(minutes=i)), ("same", start + dt.timedelta(minutes=i))]
        log.add(spark.createDataFrame(rows, log.schema).coalesce(1))
        all_of_them += rows
        if log.full():
            log.fold()
        assert len(log.steps()) < 10
    assert len(os.listdir(f"{tmp}/log")) <= 4 + 9
    assert sorted((r["path"], r["mtime"]) for r in log.rows().collect()) == sorted(all_of_them)
    late = ("f44", start + dt.timedelta(minutes=90))
    assert log.unknown([*all_of_them[:3], *all_of_them[-3:], late]) == [late]
    assert log.rows(after=39).count() == 10


def test_later_listings_look_at_late_files_only(spark, tmp):
    put(f"{tmp}/in/old.tab", T0)
    put(f"{tmp}/in/new.tab", T0 + 10 * 86_400)
    log = uploads.Log(spark, f"{tmp}/log", "path string, mtime timestamp")
    old = dt.datetime.fromtimestamp(T0 - 5)
    log.add(spark.createDataFrame([(f"file:{tmp}/in/{n}.tab", old) for n in ("old", "new")], log.schema))
    changes = uploads.Changes(log, f"{tmp}/in")
    assert changes.due() and sorted(p.rpartition("/")[2] for p, _ in changes.find()) == ["new.tab", "old.tab"]
    assert not changes.due() and [p.rpartition("/")[2] for p, _ in changes.find()] == ["new.tab"]
