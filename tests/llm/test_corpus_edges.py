"""Every corpus operator on awkward tables: nulls, empty and long texts, repeats, no rows."""

import os
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbline.llm import nearest
from kerbline.llm.common import scratch, staged
from kerbline.llm.exact_dedup import exact_dedup, later_half
from kerbline.llm.labelled import learning_sample
from kerbline.llm.licences import licence_paragraphs
from kerbline.llm.line_dedup import dedup_lines, line_decisions
from kerbline.llm.mixing import OP5_SQL, mix_sources
from kerbline.llm.nearest import nearest_neighbours
from kerbline.llm.packing import pack
from kerbline.llm.passages import repeated_passages
from kerbline.llm.quality import quality_scores
from kerbline.llm.simhash import simhash_groups
from kerbline.llm.toxicity import toxicity_scores

LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
# columns that operators use inside, to clash with
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, key string, size long, h string, "
    "fp long, sha string, row string, shard int, first string, id long, n int, root long, words int, label int, gone string"
)
ROWS = [
    (1, "alpha beta gamma delta", "en", "s1", 22),
    (1, "alpha beta gamma delta", "en", "s1", 22),
    (2, "alpha beta gamma delta", None, None, None),
    (3, None, None, "s1", None),
    (4, "", "en", "", 0),
    (5, " \t\n\x0b\f\r", "en", "s2", 6),
    (6, LONG, "en", "s2", len(LONG)),
    (7, LONG + " tail", "en", "s1", len(LONG) + 5),
    (None, "alpha  beta\ngamma delta", "en", "s2", 23),
    (None, None, None, None, None),
    (8, "All rights reserved.\né ü 漢字 🙂 all the rest", "de", "s3", 40),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(*r, "k", 9, "h", 7, "sha", "r", 1, "f", 5, 2, 3, 4, 1, "g") for r in ROWS]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (1, None, None), (3, 0, 1), (6, 1, 0), (None, 1, 1), (99, 0, 1), (7, 1, 1), (4, 0, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


OPERATORS = {
    "lines": lambda d, _: line_decisions(d),
    "line_texts": lambda d, _: dedup_lines(d),
    "simhash": lambda d, _: simhash_groups(d),
    "toxicity": toxicity_scores,
    "exact": lambda d, _: exact_dedup(d, later_half()),
    "mixing": lambda d, _: mix_sources(d),
    "licences": lambda d, _: licence_paragraphs(d),
    "passages": lambda d, _: repeated_passages(d),
    "packing": lambda d, _: pack(d),
    "quality": quality_scores,
}
A_ROW_EACH = {"line_texts", "simhash", "toxicity", "exact", "mixing", "quality"}


@pytest.mark.parametrize("name", OPERATORS)
def test_awkward_rows(docs, labels, name):
    got = OPERATORS[name](docs, labels).collect()
    if name in A_ROW_EACH:
        assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in ROWS)
    by_id = {r.doc_id: r for r in got}
    if name == "lines":
        kept = {(r.doc_id, r.line_no): r.kept for r in got}
        assert kept[1, 0] and not kept[2, 0] and kept[6, 0]
        # one word more at the end of a long line
        assert not kept[7, 0] and by_id[7].keep_doc_id == 6 and by_id[7].distance == 1
        assert kept[None, 0] and kept[None, 1] and 3 not in by_id and 5 not in by_id
    elif name == "line_texts":
        assert by_id[7].text == "" and by_id[3].text is None and by_id[5].text == ROWS[5][1]
        assert [r.text for r in got if r.doc_id == 1] == [ROWS[0][1]] * 2
    elif name == "simhash":
        assert by_id[3].fingerprint == by_id[4].fingerprint == "0" * 16
        assert by_id[2].component_id == 1 and by_id[7].component_id == 6 and by_id[5].component_id == 3
    elif name in ("toxicity", "quality"):
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
        assert by_id[3].score == by_id[4].score == by_id[5].score
        assert not by_id[None].held_out
    elif name == "exact":
        kept = sorted((r.doc_id for r in got if r.kept), key=str)
        # of each group one row: 23 code points beat 22, and 6 those of 0
        assert kept == sorted([None, 5, 6, 7, 8], key=str)
        assert by_id[3].keep_id == 5 and by_id[1].group_size == 4 and by_id[4].group_size == 4
    elif name == "mixing":
        assert all(0 <= r.taken <= 3 * r.size for r in got)
        assert by_id[3].size == 0 and by_id[6].size == 30_000
    elif name == "licences":
        assert [(r.doc_id, r.paragraph, r.family) for r in got] == [(8, 0, "proprietary")]
    elif name == "passages":
        assert {(r.doc_id, r.keep_id, r.edits) for r in got} == {(7, 6, 0)}
        # the long text repeats itself, and leads to its first occurrence there
        covered = {w for r in got for w in range(r.start_word, r.end_word)}
        assert covered == set(range(30_000))
    elif name == "packing":
        sizes = {}
        for r in got:
            sizes[r.bin] = sizes.get(r.bin, 0) + r.words
        assert max(sizes.values()) <= 2048 and sum(sizes.values()) == 4 * 4 + 30_000 + 30_001 + 10
        assert len([r for r in got if r.doc_id == 1]) == 2


@pytest.mark.parametrize("name", OPERATORS)
def test_no_rows(docs, labels, name):
    empty = docs.limit(0)
    assert OPERATORS[name](empty, labels).count() == 0
    assert OPERATORS[name](empty, labels.limit(0)).count() == 0


@pytest.mark.parametrize("operator", [toxicity_scores, quality_scores])
def test_no_labels(docs, labels, operator):
    assert {r.score for r in operator(docs, labels.limit(0)).collect()} == {0.5}


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], "x"), (0, [1.0, 0.0], "x"), (1, [1.0, 0.0], None), (2, [0.0, 1.0], "x"), (3, None, "x"),
        (4, [0.0, 0.0], "x"), (5, [nan, 1.0], "x"), (6, [inf, 1.0], "x"), (7, [None, 1.0], "x"),
        (8, [1.0, 0.0, 0.0], "x"), (None, [1.0, 0.0], "x"), (9, [], "x"), (100, [0.0, 1.0], "x"), (200, None, "x"),
        (300, [5e-324, 0.0], "x"),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, id string")
    got = nearest_neighbours(df, F.col("vec_id") % 100 == 0, k=3).collect()
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(found) == {0, 100, 300}
    assert [x[1] for x in sorted(found[0])] == [1, 300, 2]
    # a repeated candidate row counts twice
    assert [x[1] for x in sorted(found[100])] == [2, 300, 0]
    assert [x[1] for x in sorted(found[300])] == [0, 0, 1]
    assert nearest_neighbours(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_rows_of_one_id_lose_only_their_own_lines(spark):
    rows = [
        (1, "aa bb"), (None, "aa bb\nkeep one"), (None, "unique zero\nkeep two"), (None, None),
        (3, "aa bb\nkeep three"), (3, "other line\nkeep four"), (4, "x " * 12), (None, "y\n" + "x " * 11 + "z"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in dedup_lines(df).collect()), key=str)
    assert got == sorted(
        [
            (1, "aa bb"), (None, "keep one"), (None, "unique zero\nkeep two"), (None, None),
            (3, "keep three"), (3, "other line\nkeep four"), (4, "x " * 12), (None, "y"),
        ],
        key=str,
    )


def test_pipeline_rows_without_an_own_id(spark, tmp_path):
    import corpus_pipeline

    texts = [" ".join(f"{c}{i}" for i in range(40)) for c in "abcdef"]
    rows = [(None, texts[0], "s"), (None, texts[1], "s"), (None, texts[1], "s"), (7, texts[2], "s"), (7, texts[3], "t")]
    rows += [(8, texts[4], "s"), (9, texts[4], "t"), (9, texts[5], "t"), (None, texts[5], "u")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = corpus_pipeline.near_dedup(spark, df, "").collect()
    assert sorted(map(tuple, got), key=str) == sorted([rows[i] for i in (0, 1, 3, 4, 5, 7)], key=str)
    # no row is multiplied by another row of its doc_id
    mixed = corpus_pipeline.mix(spark, df, "")
    due = mix_sources(df).selectExpr("sum(whole + int(2 * part >= greatest(size, 1)))").first()[0]
    assert mixed.count() == due


def test_quality_stage_decides_by_row(spark, tmp_path, monkeypatch):
    import corpus_pipeline

    def scored(docs, labels, carry=()):
        return docs.select("doc_id", F.col("text").startswith("good").cast("int").alias("predicted"), *carry)

    monkeypatch.setattr(corpus_pipeline, "quality_scores", scored)
    spark.createDataFrame([(1, 1)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    rows = [(1, "good a"), (1, "bad b"), (None, "good c"), (None, "bad d"), (2, "bad e")]
    got = corpus_pipeline.quality(spark, spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path))
    assert sorted(map(tuple, got.collect()), key=str) == sorted([rows[0], rows[2]], key=str)


def test_orphan_labels_take_no_place(spark):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(60)] + [(3, "other")] * 2, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(5000)], "doc_id long, toxic int")
    ids = {i for i in range(60) if zlib.crc32(str(i).encode()) % 5}
    got = learning_sample(docs, labels, "toxic", 5, 0, 500).collect()
    assert sorted(r.doc_id for r in got) == sorted(ids) and all(r.label == r.doc_id % 2 for r in got)
    few = {r.doc_id for r in learning_sample(docs, labels, "toxic", 5, 0, 20).collect()}
    assert len(few) == 20 and few <= ids
    # of a repeated id the same row in any layout
    again = learning_sample(docs.repartition(7), labels, "toxic", 5, 0, 500).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_ids_may_be_text(spark):
    docs = spark.createDataFrame([("a", "one two"), ("b c", None), (None, "x")], "doc_id string, text string")
    labels = spark.createDataFrame([("a", 1, 1), ("b c", 0, 0)], "doc_id string, toxic int, quality int")
    for operator in (toxicity_scores, quality_scores):
        got = {r.doc_id: r for r in operator(docs, labels).collect()}
        assert set(got) == {"a", "b c", None} and all(0 <= r.score <= 1 for r in got.values())
        assert not got[None].held_out


def test_mix_of_rows_without_ids_as_sql(spark):
    docs = [(i if i % 3 else None, f"w{i % 50} " * (i % 7), None if i % 5 == 0 else f"s{i % 4}") for i in range(600)]
    docs += [(None, "same words here", "s1")] * 300 + [(77, "same words here", "s2")] * 40 + [(None, None, "")] * 5
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", docs)
    want = con.execute(OP5_SQL).fetchall()
    df = mix_sources(spark.createDataFrame(docs, "doc_id long, text string, source string"))
    got = df.select("doc_id", "size", "source_size", "target", "taken").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    # copies share no window row
    assert df.count() == len(docs)


@pytest.mark.parametrize("resident_bytes", [1 << 27, 1])
def test_groups_of_query_blocks_change_nothing(spark, monkeypatch, resident_bytes):
    monkeypatch.setattr(nearest, "_QUERY_ROWS", 16)
    monkeypatch.setattr(nearest, "_CANDIDATE_ROWS", 50)
    rng = np.random.default_rng(4)
    vectors = [(i, rng.integers(-3, 4, 2 + i % 2).astype(float).tolist()) for i in range(400)]
    df = spark.createDataFrame(vectors, "id long, embedding array<double>").withColumnRenamed("id", "vec_id")
    df = df.select("vec_id", "embedding", *(F.lit(0).alias(c) for c in ("dim", "block", "lane", "query", "groups", "first")))
    got = nearest.nearest_neighbours(df, F.col("vec_id") % 4 == 0, k=5, tasks=3, resident_bytes=resident_bytes)
    found = {}
    for r in got.collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.score, r.vec_id))
    usable = [(i, np.array(v)) for i, v in vectors if any(v)]
    for i, v in usable:
        if i % 4 == 0:
            near = sorted((float(np.sqrt(sum((v - w) ** 2))), j) for j, w in usable if j != i and len(w) == len(v))
            assert [(s, j) for _, s, j in sorted(found[i])] == near[:5]
    assert set(found) == {i for i, _ in usable if i % 4 == 0}


def test_scratch_keeps_what_outlives_it(spark):
    def files(df):
        return [os.path.exists(f.removeprefix("file:").replace("///", "/")) for f in before[df]]

    before = {}

    def table(name, **how):
        df = staged(spark.range(3), name, **how)
        before[df] = df.inputFiles()
        assert all(files(df))
        return df

    with scratch(spark):
        with scratch(spark):
            inner, passed = table("inner"), table("passed", outlives=True)
        assert not any(files(inner)) and passed.count() == 3
        last = table("last", outlives=True)
    assert not any(files(passed)) and last.count() == 3
    with pytest.raises(ZeroDivisionError), scratch(spark):
        lost = table("lost")
        1 / 0  # noqa: B018
    assert not any(files(lost))
