"""Landing only what changed."""

from __future__ import annotations

import os
import time

import pytest

from dq_mart.session import local_fs_path, scratch_path
from dq_mart.sources import incremental as N


@pytest.fixture()
def lake(spark):
    root = scratch_path(spark, "tests", "incremental")
    folder = local_fs_path(f"{root}/csv")
    os.makedirs(folder)
    return root, folder


def put(folder, name, rows, header="k,v"):
    with open(f"{folder}/{name}", "w") as f:
        f.write("\n".join([header, *rows]) + "\n")


def land(spark, lake, **sources):
    root, folder = lake
    paths = {n: f"{folder}/{p}" for n, p in (sources or {"a": "a", "b": "b.csv"}).items()}
    got = N.land_changed(spark, paths, root).collect()
    return {(r.table_name, os.path.basename(r.path)): (r.status, r.rows) for r in got}


def rows(spark, lake, table):
    df = N.read_changed(spark, lake[0], table)
    return None if df is None else sorted((r.k, r.v) for r in df.collect())


def test_files_come_change_and_go(spark, lake):
    _, folder = lake
    os.makedirs(f"{folder}/a")
    put(folder, "a/1.csv", ["1,x", '2,"y, z"'])
    put(folder, "a/2.csv", ["3,w"])
    put(folder, "b.csv", ["9,q"])
    assert land(spark, lake) == {("a", "1.csv"): ("new", 2), ("a", "2.csv"): ("new", 1), ("b", "b.csv"): ("new", 1)}
    assert rows(spark, lake, "a") == [("1", "x"), ("2", "y, z"), ("3", "w")]
    before = N.read_manifest(spark, lake[0]).select("path", "folder").collect()
    assert set(land(spark, lake).values()) == {("unchanged", 2), ("unchanged", 1)}
    assert sorted(N.read_manifest(spark, lake[0]).select("path", "folder").collect()) == sorted(before)
    time.sleep(1.1)
    put(folder, "a/1.csv", ["1,x", "2,changed"])
    put(folder, "a/3.csv", [])                                   # a header alone
    os.remove(f"{folder}/a/2.csv")
    os.utime(f"{folder}/b.csv")                                  # the same text, another time
    assert land(spark, lake) == {("a", "1.csv"): ("changed", 2), ("a", "2.csv"): ("vanished", 1),
                                 ("a", "3.csv"): ("new", 0), ("b", "b.csv"): ("touched", 1)}
    assert rows(spark, lake, "a") == [("1", "x"), ("2", "changed")] and rows(spark, lake, "b") == [("9", "q")]
    assert land(spark, lake)["b", "b.csv"] == ("unchanged", 1)


def test_same_length_other_text(spark, lake):
    put(lake[1], "b.csv", ["1,x"])
    land(spark, lake)
    time.sleep(1.1)
    put(lake[1], "b.csv", ["1,y"])
    assert land(spark, lake) == {("b", "b.csv"): ("changed", 1)} and rows(spark, lake, "b") == [("1", "y")]


def test_nothing_there(spark, lake):
    assert land(spark, lake) == {} and rows(spark, lake, "a") is None
    put(lake[1], "b.csv", ["1,x"])
    land(spark, lake)
    os.remove(f"{lake[1]}/b.csv")
    assert land(spark, lake) == {("b", "b.csv"): ("vanished", 1)}
    assert rows(spark, lake, "b") is None and land(spark, lake) == {}


def test_a_run_that_fails_changes_nothing(spark, lake, monkeypatch):
    put(lake[1], "b.csv", ["1,x"])
    land(spark, lake)
    time.sleep(1.1)
    put(lake[1], "b.csv", ["1,x", "2,y"])

    def broken(*a, **k):
        raise RuntimeError("driver lost")
    monkeypatch.setattr(N, "write_table", broken)
    with pytest.raises(RuntimeError):
        land(spark, lake)
    assert rows(spark, lake, "b") == [("1", "x")]
    monkeypatch.undo()
    assert land(spark, lake) == {("b", "b.csv"): ("changed", 2)}


def test_unchanged_files_are_not_read(spark, lake, monkeypatch):
    put(lake[1], "b.csv", ["1,x"])
    land(spark, lake)

    def never(*a, **k):
        raise AssertionError("read")
    monkeypatch.setattr(N, "read_raw_csv", never)
    assert land(spark, lake) == {("b", "b.csv"): ("unchanged", 1)}
