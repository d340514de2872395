import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbline.operators import aggregates, blocks, evaluate
from kerbline.operators.blocks import nearest
from kerbline.operators.evaluate import confusion
from kerbline.operators.joins import index_encode, name_of


def points(spark, x, c):
    return spark.createDataFrame(
        [(i, [float(v) for v in row], int(k)) for i, (row, k) in enumerate(zip(x, c))],
        "id long, x array<double>, c int",
    )


def brute_silhouette(x, c):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    out = []
    for i in range(len(x)):
        same = c == c[i]
        if same.sum() == 1:
            out.append(0.0)
            continue
        a = d[i][same].sum() / (same.sum() - 1)
        b = min(d[i][c == k].mean() for k in set(c) if k != c[i])
        out.append((b - a) / max(a, b))
    return np.array(out)


@pytest.mark.parametrize("size", [7, 2048])
def test_silhouette_is_exact_in_any_block_size(spark, size):
    rng = np.random.default_rng(0)
    x, c = rng.normal(size=(40, 3)), np.r_[rng.integers(0, 3, 39), 9]
    got = evaluate.silhouettes(points(spark, x, c), key="id", vector="x", cluster="c", size=size)
    rows = {r["id"]: r["silhouette"] for r in got.collect()}
    want = brute_silhouette(x, c)
    assert [rows[i] for i in range(40)] == pytest.approx(list(want), abs=1e-12)
    placed = evaluate.ordered_silhouettes(got, key="id", cluster="c").orderBy("place").collect()
    assert [(r["c"], r["silhouette"]) for r in placed] == sorted((r["c"], r["silhouette"]) for r in placed)


@pytest.mark.parametrize("size", [6, 2048])
def test_nearest_matches_brute_force(spark, size):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 3, size=(30, 2)).astype(float)  # many equal distances
    c = rng.integers(0, 3, 30)
    rows = points(spark, x, c)
    got = blocks.nearest(rows, rows, 4, key="id", vector="x", label="c", size=size).collect()
    for i in range(30):
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        want = sorted(range(30), key=lambda j: (d[j], j))[:4]
        mine = sorted((r["place"], r["neighbour"]) for r in got if r["id"] == i)
        assert [j for _, j in mine] == want
    calls = blocks.knn_classify(rows, rows, 4, key="id", vector="x", label="c", size=size).collect()
    for r in calls:
        votes = [c[g["neighbour"]] for g in got if g["id"] == r["id"]]
        assert r["prediction"] == min(set(votes), key=lambda k: (-votes.count(k), k))


def test_adjusted_rand(spark):
    def score(a, b):
        rows = spark.createDataFrame(list(zip(a, b)), "a int, b int")
        return evaluate.adjusted_rand(rows, "a", "b").first()[0]

    assert score([0, 0, 1, 1], [5, 5, 3, 3]) == 1.0
    assert score([0, 0, 1, 1], [0, 0, 1, 2]) == pytest.approx(0.5714285714)
    assert score([0, 0, 0], [1, 1, 1]) == 1.0
    assert score([0, 0, 1, 1], [0, 1, 0, 1]) == pytest.approx(-0.5)


def test_scores_with_a_class_nobody_calls(spark):
    rows = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 1)], "label int, prediction int")
    table = evaluate.confusion(rows)
    assert table.count() == 9 and table.agg(F.sum("n")).first()[0] == 4
    per = {r["class"]: r for r in evaluate.class_scores(table).collect()}
    assert per[2]["precision"] == 0 and per[2]["recall"] == 0 and per[2]["f_score"] == 0
    assert per[1]["precision"] == pytest.approx(1 / 3) and per[1]["recall"] == 1
    assert (per[0]["tp"], per[0]["fp"], per[0]["fn"], per[0]["tn"]) == (1, 0, 1, 2)
    overall = evaluate.overall_scores(table).first()
    assert overall["accuracy"] == 0.5
    assert overall["weighted_f1"] == pytest.approx((2 * (2 / 3) + 0.5) / 4)


def test_regression_scores(spark):
    y, p = np.array([1.0, 2, 4, 8]), np.array([1.5, 2, 3, 9])
    rows = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, p double")
    got = evaluate.regression_scores(rows, actual="y", predicted="p").first()
    assert got["r2"] == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert got["mae"] == pytest.approx(np.abs(y - p).mean())
    assert got["rmse"] == pytest.approx(np.sqrt(((y - p) ** 2).mean()))


def test_correlations_use_complete_pairs(spark):
    rows = spark.createDataFrame([(1.0, 2.0), (2.0, None), (3.0, 1.0), (4.0, 5.0)], "a double, b double")
    got = {(r["a"], r["b"]): r["r"] for r in aggregates.correlations(rows, ["a", "b"]).collect()}
    assert got[("a", "b")] == pytest.approx(np.corrcoef([1, 3, 4], [2, 1, 5])[0, 1])


def test_histogram_matches_numpy(spark):
    x = np.random.default_rng(2).integers(0, 30, 200).astype(float)
    rows = spark.createDataFrame([(float(v), 4.0) for v in x], "x double, same double")
    out = aggregates.histograms(rows, ["x", "same"]).orderBy("feature", "bin").collect()
    assert [r["n"] for r in out if r["feature"] == "x"] == list(np.histogram(x)[0])
    assert [r["n"] for r in out if r["feature"] == "same"] == list(np.histogram(np.full(200, 4.0))[0])


def test_sums_and_shares_of_nulls(spark):
    rows = spark.createDataFrame(
        [(1, None, None), (2, 1.0, 3.0)], "id long, txn_amt_we_a double, txn_amt_wd_a double"
    )
    got = {
        r["id"]: r for r in aggregates.sector_shares(rows, key="id", sectors=["a"], prefix="txn_amt").collect()
    }
    assert got[1]["total"] == 0.0 and got[1]["percent_a"] is None
    assert got[2]["percent_we"] == 0.25 and got[2]["percent_a"] == 1.0


def test_labels_keep_their_type(spark):
    rows = spark.createDataFrame([(1, 1.7, 1.7), (2, 0.2, 1.7)], "id int, label double, prediction double")
    got = {(r["label"], r["prediction"]): r["n"] for r in confusion(rows).collect()}
    assert got == {(1.7, 1.7): 1, (0.2, 1.7): 1, (1.7, 0.2): 0, (0.2, 0.2): 0}


def test_neighbours_keep_the_label(spark):
    train = spark.createDataFrame([(i, [float(i)], i + 0.7) for i in range(40)], "id long, x array<double>, label double")
    got = nearest(train, train, 3, key="id", vector="x", label="label", size=8).where("id = 5").orderBy("place")
    assert [(r["place"], r["neighbour"], r["label"], r["distance"]) for r in got.collect()] == [
        (1, 5, 5.7, 0.0), (2, 4, 4.7, 1.0), (3, 6, 6.7, 1.0)
    ]


def test_names_and_codes(spark):
    names = spark.createDataFrame([(1, "b", "y"), (1, "a", "z"), (2, "c", None)], "id int, n string, m string")
    ids = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    got = {tuple(r) for r in name_of(ids, names, "id").collect()}
    assert got == {(1, "a", "z"), (2, "c", None), (3, None, None)}
    coded = {tuple(r) for r in index_encode(names.select("m", "n"), "m").select("n", "code").collect()}
    assert coded == {("b", 0), ("a", 1), ("c", None)}


def test_equal_vectors_are_measured_once(spark, monkeypatch):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(9, 3)) + 1e4
    base[1] = base[0] + 1e-7  # nearer than what a product of such lengths can tell
    x, c = base[np.r_[0:9, rng.integers(0, 9, 51)]], rng.integers(0, 3, 60)
    rows = points(spark, x, c)
    want = brute_silhouette(x, c)
    got = {r["id"]: r["silhouette"] for r in evaluate.silhouettes(rows, key="id", vector="x", cluster="c", size=4).collect()}
    assert [got[i] for i in range(60)] == pytest.approx(list(want), abs=1e-9)
    near = nearest(rows, rows, 4, key="id", vector="x", label="c", size=4).collect()
    for i in range(60):
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        assert [j for _, j in sorted((r["place"], r["neighbour"]) for r in near if r["id"] == i)] == sorted(
            range(60), key=lambda j: (d[j], j)
        )[:4]
    # sixty rows of nine vectors meet as nine
    met = []
    real = blocks._block
    monkeypatch.setattr(blocks, "_block", lambda n, size: met.append(n) or real(n, size))
    evaluate.silhouettes_of(rows.withColumn("d", F.col("c") % 2), key="id", vector="x", clusters=["c", "d"]).count()
    nearest(rows, rows, 2, key="id", vector="x", label="c").count()
    assert met[:2] == [9, 9] and met[2] <= 18
