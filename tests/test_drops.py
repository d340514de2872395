import csv

import pytest
from pyspark.sql import functions as F

from kerbline.sources import drops, inputs, tables
from kerbline.sources.feeds import FEEDS
from kerbline.streaming.folder import run_folder

HEAD = [
    "msoa_id", "date", "time_indicator", "scaled_volume", "loyalty_percentage", "dwell_time",
    "worker_population_percentage", "resident_population_percentage",
]


def put(root, folder, name, n, volume=1.0, head=None):
    where = root / "received" / folder / "files"
    where.mkdir(parents=True, exist_ok=True)
    with open(where / name, "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(head or HEAD)
        for i in range(n):
            out.writerow([f"E{i}", "2022-01-05", "Night", volume, "IDE", 2, 3, 4])


def volumes(spark, path):
    rows = spark.read.parquet(path).groupBy("file_name").agg(
        F.count("*").alias("n"), F.max("scaled_volume").alias("v"), F.max("file_date").alias("d")
    )
    return {r["file_name"]: (r["n"], r["v"], str(r["d"])) for r in rows.collect()}


def test_load_is_idempotent_and_replaces_by_count(spark, tmp_path):
    root, house = tmp_path / "in", str(tmp_path / "house")
    put(root, "drop01_01_2022", "msoa_daily_agg_a.csv", 5)
    put(root, "drop01_01_2022", "msoa_daily_agg_b.csv", 3)
    put(root, "drop01_01_2022", "msoa_footfall_hist_x.csv", 3)
    target = f"{house}/{FEEDS['msoa_daily'].table}"

    found = {r["file_name"]: r["route"] for r in drops.discover(spark, str(root)).collect()}
    assert found["msoa_footfall_hist_x.csv"] is None and found["msoa_daily_agg_a.csv"] == "msoa_daily"

    def load():
        done = {r["file_name"]: r["action"] for r in drops.load_drops(spark, str(root), house).collect()}
        assert done.pop("msoa_footfall_hist_x.csv") == "unroutable"
        return done

    a, b = "msoa_daily_agg_a.csv", "msoa_daily_agg_b.csv"
    assert load() == {a: "append", b: "append"}
    first = volumes(spark, target)
    assert first == {a: (5, 1.0, "2022-01-01"), b: (3, 1.0, "2022-01-01")}
    assert load() == {a: "skip", b: "skip"}
    assert volumes(spark, target) == first
    # fewer rows in the table than in the file, then more
    put(root, "drop01_01_2022", a, 7, volume=2.0)
    assert load() == {a: "replace", b: "skip"}
    put(root, "drop01_01_2022", a, 2, volume=3.0)
    assert load() == {a: "replace", b: "skip"}
    assert volumes(spark, target) == {a: (2, 3.0, "2022-01-01"), b: (3, 1.0, "2022-01-01")}
    # the same name in a later folder wins
    put(root, "drop01_02_2022", a, 4, volume=4.0)
    assert load() == {a: "replace", b: "skip"}
    assert volumes(spark, target)[a] == (4, 4.0, "2022-02-01")


def test_a_bad_row_stops_the_load_and_leaves_the_table(spark, tmp_path):
    root, house = tmp_path / "in", str(tmp_path / "house")
    put(root, "drop01_01_2022", "msoa_daily_agg_a.csv", 2, volume=0)
    with pytest.raises(Exception, match="scaled_volume:positive"):
        drops.load_drops(spark, str(root), house)
    path = f"{house}/{FEEDS['msoa_daily'].table}"
    for _ in range(2):
        drops.load_drops(spark, str(root), house, mode="drop")
        assert drops.loaded_counts(spark, path).count() == 0


def test_each_file_is_read_by_its_own_header(spark, tmp_path):
    root, house = tmp_path / "in", str(tmp_path / "house")
    put(root, "drop01_01_2022", "msoa_daily_agg_a.csv", 2)
    where = root / "received" / "drop01_01_2022" / "files"
    (where / "msoa_daily_agg_b.csv").write_text(
        ",".join([*HEAD[::-1], "note"]) + "\n4,3,2,IDE,7,Night,2022-01-05,E9,x\n"
    )
    rows = drops.scan_feed(spark, str(root), FEEDS["msoa_daily"]).collect()
    got = {(r["msoa_id"], r["scaled_volume"], r["note"]) for r in rows}
    assert got == {("E0", "1.0", None), ("E1", "1.0", None), ("E9", "7", "x")}
    drops.load_drops(spark, str(root), house)
    target = f"{house}/{FEEDS['msoa_daily'].table}"
    assert volumes(spark, target)["msoa_daily_agg_b.csv"] == (1, 7.0, "2022-01-01")
    put(root, "drop01_01_2022", "msoa_daily_agg_c.csv", 0, head=HEAD[1:])
    with pytest.raises(ValueError, match="msoa_daily_agg_c.csv lacks msoa_id"):
        drops.scan_feed(spark, str(root), FEEDS["msoa_daily"])


def test_null_tokens_are_missing(spark, tmp_path):
    root, house = tmp_path / "in", str(tmp_path / "house")
    for i, token in enumerate(["", "NA", "N/A", "n/a", "NULL", "null", "NaN", "nan", "None"]):
        put(root, "drop01_01_2022", f"msoa_daily_agg_{i}.csv", 1, volume=token)
    drops.load_drops(spark, str(root), house)
    rows = spark.read.parquet(f"{house}/{FEEDS['msoa_daily'].table}")
    assert rows.count() == 9 and rows.where("scaled_volume IS NOT NULL").count() == 0


def test_drop_mode_settles_and_leaves_no_stale_rows(spark, tmp_path):
    root, house = tmp_path / "in", str(tmp_path / "house")
    a, b = "msoa_daily_agg_a b=1.csv", "msoa_daily_agg_b.csv"
    target = f"{house}/{FEEDS['msoa_daily'].table}"

    def load():
        done = drops.load_drops(spark, str(root), house, mode="drop")
        return {r["file_name"]: r["action"] for r in done.collect()}

    put(root, "drop01_01_2022", a, 3)
    put(root, "drop01_01_2022", b, 2)
    with open(root / "received" / "drop01_01_2022" / "files" / b, "a") as f:
        f.write("E7,2022-01-05,Night,0,IDE,2,3,4\n")
    assert load() == {a: "append", b: "append"}
    assert volumes(spark, target) == {a: (3, 1.0, "2022-01-01"), b: (2, 1.0, "2022-01-01")}
    assert load() == load() == {a: "skip", b: "skip"}
    # now no row of the file is good
    put(root, "drop01_01_2022", a, 4, volume=0)
    assert load() == {a: "replace", b: "skip"}
    assert set(volumes(spark, target)) == {b}
    assert load() == {a: "skip", b: "skip"}


def test_one_name_in_two_folders_loads_once(spark, tmp_path):
    root, house, log = tmp_path / "in", str(tmp_path / "house"), str(tmp_path / "log")
    a = "msoa_daily_agg_a.csv"
    target = f"{house}/{FEEDS['msoa_daily'].table}"
    put(root, "first01_01_2022", a, 2, volume=1.0)
    put(root, "second01_01_2022", a, 3, volume=2.0)
    for action in ("append", "skip"):
        done = drops.load_drops(spark, str(root), house).collect()
        assert [(r["action"], r["n_file"], r["n_older"]) for r in done] == [(action, 2, 1)]
    assert volumes(spark, target) == {a: (2, 1.0, "2022-01-01")}
    # a newer file replaces an equal number of rows, and an older one that comes later does not
    put(root, "third02_01_2022", a, 2, volume=3.0)
    run_folder(spark, str(root), house, "msoa_daily", log).awaitTermination()
    assert volumes(spark, target) == {a: (2, 3.0, "2022-01-02")}
    put(root, "fourth31_12_2021", a, 9, volume=4.0)
    run_folder(spark, str(root), house, "msoa_daily", log).awaitTermination()
    assert volumes(spark, target) == {a: (2, 3.0, "2022-01-02")}


def test_nothing_routes(spark, tmp_path):
    root = tmp_path / "in"
    put(root, "drop01_01_2022", "other.csv", 1)
    done = drops.load_drops(spark, str(root), str(tmp_path / "house")).collect()
    assert [(r["file_name"], r["action"], r["route"]) for r in done] == [("other.csv", "unroutable", None)]


def test_reconcile(spark):
    incoming = spark.createDataFrame([("a", 3), ("b", 3), ("c", 3), ("d", 3)], "file_name string, n_file long")
    loaded = spark.createDataFrame([("b", 3), ("c", 2), ("d", 9), ("e", 1)], "file_name string, n_table long")
    got = {r["file_name"]: r["action"] for r in drops.reconcile(incoming, loaded).collect()}
    assert got == {"a": "append", "b": "skip", "c": "replace", "d": "replace", "e": "keep"}


def test_stream_loads_new_files_once(spark, tmp_path):
    root, house, log = tmp_path / "in", str(tmp_path / "house"), str(tmp_path / "log")
    put(root, "drop01_01_2022", "msoa_daily_agg_a.csv", 5)
    target = f"{house}/{FEEDS['msoa_daily'].table}"
    run_folder(spark, str(root), house, "msoa_daily", log).awaitTermination()
    assert volumes(spark, target) == {"msoa_daily_agg_a.csv": (5, 1.0, "2022-01-01")}
    put(root, "drop 01_02_2022", "msoa_daily_agg_b.csv", 2)
    run_folder(spark, str(root), house, "msoa_daily", log).awaitTermination()
    # a fresh log replays every file; the table does not change
    run_folder(spark, str(root), house, "msoa_daily", log + "2").awaitTermination()
    assert volumes(spark, target) == {
        "msoa_daily_agg_a.csv": (5, 1.0, "2022-01-01"),
        "msoa_daily_agg_b.csv": (2, 1.0, "2022-02-01"),
    }


def test_tables_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([(1, float("nan")), (2, 1.5)], "a int, b double")
    for ending, write in (
        ("p.parquet", lambda p: rows.write.parquet(p)),
        ("o.orc", lambda p: rows.write.orc(p)),
    ):
        path = str(tmp_path / ending)
        write(path)
        got = sorted(tuple(r) for r in tables.read_table(spark, path).collect())
        assert got == [(1, None), (2, 1.5)]
    tables.write_csv(rows.where("a = 2"), str(tmp_path / "c.csv"))
    assert [tuple(r) for r in tables.read_table(spark, str(tmp_path / "c.csv"), schema="a int, b double").collect()] == [(2, 1.5)]


def test_declared_inputs_match_by_header(spark, tmp_path):
    where = tmp_path / "clusters.csv"
    where.write_text("cluster_size,extra,highest,cluster_hourly,cluster_daily\n3,x,7,1,2\n")
    got = inputs.read_input(spark, "clusters", str(where), renames={"highest": "area_id"})
    assert [tuple(r) for r in got.collect()] == [(7, 1, 2, 3)]
    with pytest.raises(ValueError, match="area_id"):
        inputs.read_input(spark, "clusters", str(where))
    spend = tmp_path / "weekly.csv"
    spend.write_text(
        "yr,wk,week_start,area_id,area_name,txn_amt_wd_retail\n2020,1,2020-01-06,1,a,1.5\n2020,2,,1,a,\n"
    )
    rows = inputs.read_input(spark, "weekly_spend", str(spend))
    assert [r["week_start"] is None for r in rows.collect()] == [False, True]
