"""Loads that open new and changed files only."""

import os

import pytest

from kerbline.sources import filelog
from kerbline.sources.feeds import FEEDS
from tests.test_drops import put, volumes

A, B, C = "msoa_daily_agg_a.csv", "msoa_daily_agg_b.csv", "lsoa_daily_agg_c.csv"


@pytest.fixture
def load(spark, tmp_path, monkeypatch):
    root, house = tmp_path / "in", str(tmp_path / "house")
    opened = []
    scan = filelog.scan_files

    def watched(spark, paths, feed):
        opened.extend(os.path.basename(p) for p in paths)
        return scan(spark, paths, feed)

    monkeypatch.setattr(filelog, "scan_files", watched)

    def run(mode="raise"):
        opened.clear()
        rows = filelog.load_new(spark, str(root), house, mode=mode).collect()
        return {(r["file_name"], str(r["file_date"])): r["action"] for r in rows}, sorted(opened)

    run.root, run.target = root, f"{house}/{FEEDS['msoa_daily'].table}"
    run.house = house
    return run


def test_second_load_opens_no_file(spark, load):
    put(load.root, "drop01_01_2022", A, 5)
    put(load.root, "drop01_01_2022", B, 3)
    put(load.root, "drop01_01_2022", "notes.csv", 3)
    day = "2022-01-01"
    done, opened = load()
    assert done == {(A, day): "append", (B, day): "append", ("notes.csv", day): "unroutable"} and opened == [A, B]
    first = volumes(spark, load.target)
    done, opened = load()
    assert done == {(A, day): "unchanged", (B, day): "unchanged", ("notes.csv", day): "unroutable"} and opened == []
    assert volumes(spark, load.target) == first


def test_changed_and_newer_files_are_opened_and_older_ones_not(spark, load):
    put(load.root, "drop01_01_2022", A, 5)
    put(load.root, "drop01_01_2022", B, 3)
    load()
    put(load.root, "drop01_01_2022", A, 7, volume=2.0)
    done, opened = load()
    assert opened == [A] and done[A, "2022-01-01"] == "replace"
    # the same name in a later folder, then in an earlier one
    put(load.root, "drop01_02_2022", A, 4, volume=3.0)
    done, opened = load()
    assert opened == [A] and done == {(A, "2022-01-01"): "older", (A, "2022-02-01"): "replace", (B, "2022-01-01"): "unchanged"}
    put(load.root, "drop01_12_2021", B, 9, volume=9.0)
    done, opened = load()
    assert opened == [] and done[B, "2021-12-01"] == "older"
    assert volumes(spark, load.target) == {A: (4, 3.0, "2022-02-01"), B: (3, 1.0, "2022-01-01")}


def test_load_that_died_before_its_log_entry(spark, load, monkeypatch):
    put(load.root, "drop01_01_2022", A, 5)
    with monkeypatch.context() as m:
        m.setattr(filelog, "log_path", lambda house: "/proc/nowhere/log")
        with pytest.raises(Exception):
            load()
    first = volumes(spark, load.target)
    assert first == {A: (5, 1.0, "2022-01-01")}
    done, opened = load()
    assert opened == [A] and done[A, "2022-01-01"] == "skip"
    assert load()[1] == [] and volumes(spark, load.target) == first


def test_lost_partition_and_empty_file(spark, load):
    from kerbline.sources.tables import remove_path

    put(load.root, "drop01_01_2022", A, 5)
    put(load.root, "drop01_01_2022", B, 0)
    done, opened = load()
    assert opened == [A, B]
    assert load()[1] == []
    remove_path(spark, load.target, "file_name", A)
    done, opened = load()
    assert opened == [A] and done[A, "2022-01-01"] == "append"
    assert volumes(spark, load.target) == {A: (5, 1.0, "2022-01-01")}


def test_dropped_rows_do_not_count(spark, load):
    put(load.root, "drop01_01_2022", A, 5, volume=-1.0)
    put(load.root, "drop01_01_2022", B, 2)
    done, _ = load(mode="drop")
    assert done[B, "2022-01-01"] == "append"
    assert load(mode="drop")[1] == []
    assert volumes(spark, load.target) == {B: (2, 1.0, "2022-01-01")}
