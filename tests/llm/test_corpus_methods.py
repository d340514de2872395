"""The corpus operators against brute force, exact round trips and held-out accuracy."""

import glob
import hashlib
import os
import random
import textwrap

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as contract
from kerbline.llm import licences
from kerbline.llm.common import components
from kerbline.llm.exact_dedup import build_filter, exact_dedup, passes
from kerbline.llm.licences import TEMPLATES, licence_paragraphs
from kerbline.llm.line_dedup import deletions, half_keys, line_decisions, near
from kerbline.llm.mixing import mix_sources, water_fill
from kerbline.llm.nearest import nearest_neighbours
from kerbline.llm.packing import best_fit, pack
from kerbline.llm.passages import align, chains, edits, repeated_passages, seeds
from kerbline.llm.quality import fit_additive
from kerbline.llm.simhash import fingerprint, near_links, trie_links
from kerbline.llm.toxicity import distances, train
from tools.check import keyed

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def word_edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(row[j] + 1, now[-1] + 1, row[j - 1] + (x != y)))
        row = now
    return row[-1]


# ---- SQL ---------------------------------------------------------------------------


@needs_tables
@pytest.mark.parametrize("name", ["op4_exact_dedup", "op5_mix_sources", "op8_block_nearest"])
def test_same_rows_as_sql(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    df = contract.queries()[name](spark, SF)
    cur = con.execute(contract.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert keyed([tuple(r) for r in df.collect()], df.columns) == keyed(cur.fetchall(), names)


# ---- line dedup ----------------------------------------------------------------------


def edited(rnd, words, vocabulary, times):
    words = list(words)
    for _ in range(times):
        at, kind = rnd.randint(0, max(0, len(words) - 1)), rnd.randint(0, 2)
        if kind == 0:
            words.insert(at, rnd.choice(vocabulary))
        elif words and kind == 1:
            words.pop(at)
        elif words:
            words[at] = rnd.choice(vocabulary)
    return words


def test_lines_as_brute_force(spark):
    rnd = random.Random(3)
    vocabulary = [f"w{i}" for i in range(5)]
    pool, rows = [[rnd.choice(vocabulary) for _ in range(n)] for n in (1, 4, 9, 10, 11, 12, 13, 25)], []
    for d in range(50):
        texts = [edited(rnd, rnd.choice(pool), vocabulary, rnd.choice([0, 0, 1, 1, 2])) for _ in range(4)]
        pool += texts[:1]
        rows.append((d, "\n".join(" ".join(t) for t in texts)))
    got = {(r.doc_id, r.line_no): r for r in line_decisions(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    every = [(d, i, line.split()) for d, t in rows for i, line in enumerate(t.split("\n")) if line.split()]
    assert set(got) == {x[:2] for x in every}
    found = 0
    for d, i, words in every:
        first = min(x[:2] for x in every if x[2] == words)
        before = [
            x[:2] for x in every
            if x[:2] < first and min(len(words), len(x[2])) >= 10 and word_edits(words, x[2]) == 1
        ]
        goal = min(before, default=first)
        r = got[d, i]
        assert (r.keep_doc_id, r.keep_line_no, r.distance) == (*goal, int(bool(before)))
        assert r.kept == (goal == (d, i))
        found += bool(before)
    assert found > 20


def test_near_lines_share_half_and_variant():
    rnd = random.Random(4)
    for _ in range(300):
        a = [b"%d" % rnd.randint(0, 3) for _ in range(rnd.randint(11, 14))]
        b = edited(rnd, a, [b"0", b"1", b"9"], 1)
        assert near(a, b) and (a == b or word_edits(a, b) == 1)
        if len(b) >= 10:
            assert set(half_keys(a)) & set(half_keys(b))
        (whole_a, less_a), (whole_b, less_b) = deletions(a), deletions(b)
        if len(a) == len(b):
            assert (less_a == less_b).any()
        else:
            assert whole_a in less_b or whole_b in less_a
        c = edited(rnd, b, [b"7", b"8"], 2)
        assert near(a, c) == (word_edits(a, c) <= 1)


# ---- SimHash ---------------------------------------------------------------------------


def test_fingerprint_by_definition():
    text = b"The Quick brown\tfox THE quick brown fox \xc3\x89t\xc3\xa9 the quick"
    words = [w.decode() for w in text.split()]
    words = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words]
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]), 42) for i in range(len(words) - 2)]
    want = sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))
    assert fingerprint(text) == want
    assert fingerprint(b"one Two") == xxhash.xxh64_intdigest("one two", 42)
    assert fingerprint(b" \n") == fingerprint(None) == 0


def planted_prints(n, seed):
    rnd = random.Random(seed)
    values = [rnd.getrandbits(64) for _ in range(n)]
    for _ in range(n):
        v = rnd.choice(values)
        for bit in rnd.sample(range(64), rnd.randint(1, 4)):
            v ^= 1 << bit
        values.append(v)
    return sorted(set(values) | {0, 1, 2**64 - 1})


def roots(values):
    x = np.array(values, np.uint64)
    low = {v: v for v in values}

    def find(v):
        while low[v] != v:
            v = low[v]
        return v

    for i, v in enumerate(values):
        for j in np.flatnonzero(np.bitwise_count(x[i + 1 :] ^ x[i]) <= 3) + i + 1:
            a, b = find(v), find(values[j])
            low[max(a, b)] = min(a, b)
    return {v: find(v) for v in values}


def test_trie_pairs_are_all_pairs():
    x = np.array([v >> 40 for v in planted_prints(400, 1)] + [v for v in planted_prints(400, 2)], np.uint64)
    x = np.unique(x)
    got = {(int(a), int(b)) for i, j in trie_links(x, None, 0, 3, 16) for a, b in zip(x[i], x[j], strict=True)}
    close = {
        (int(a), int(b)) for k, a in enumerate(x) for b in x[k + 1 :][np.bitwise_count(x[k + 1 :] ^ a) <= 3]
        if a >> np.uint64(48) == b >> np.uint64(48)
    }
    assert got == close and len(close) > 100


@pytest.mark.parametrize("per_task", [32_768, 8])
def test_links_connect_what_brute_force_connects(spark, per_task):
    # 8 a task takes crowded subtrees apart into pairs of subtrees
    values = planted_prints(300, 5)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    links = near_links(spark.createDataFrame(signed, "fp long"), per_task=per_task)
    found = {r.node % 2**64: r.root % 2**64 for r in components(links).collect()}
    want = roots(values)
    groups, expected = {}, {}
    for v in values:
        groups.setdefault(found.get(v, v), set()).add(v)
        expected.setdefault(want[v], set()).add(v)
    assert {frozenset(g) for g in groups.values()} == {frozenset(g) for g in expected.values()}


@needs_tables
def test_simhash_query_as_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    prints = {r.doc_id: fingerprint((r.text or "").encode()) for r in docs}
    root = roots(sorted(set(prints.values())))
    first = {}
    for d, p in sorted(prints.items()):
        first.setdefault(root[p], d)
    got = contract.queries()["op2_simhash_near_dedup"](spark, SF).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {
        (d, f"{p:016x}", first[root[p]]) for d, p in prints.items()
    }


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100, 102: 100}


# ---- exact dedup -----------------------------------------------------------------------


@pytest.mark.parametrize("n", [0, 1, 2, 3, 17, 1000, 60_000])
def test_filter_has_its_keys(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
    made = build_filter(keys)
    assert passes(keys, *made).all()
    other = rng.integers(0, 2**64, 20_000, dtype=np.uint64)
    assert passes(other, *made).mean() < 0.02
    if n > 10_000:
        assert len(made[3]) < 1.35 * n


def test_snapshot_and_batch_may_be_any_rows(spark):
    rows = [(1, "a b", 0), (2, "ab ", 1), (3, "a\nb\n", 1), (4, "c", 1), (5, "c ", 1), (6, "d", 0), (7, "d", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, batch int")
    for new in (F.col("batch") == 1, F.lit(False), F.lit(True), F.lit(None).cast("boolean")):
        got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup(df, new).collect()}
        assert got == {
            (1, 3, 3, False), (2, 3, 3, False), (3, 3, 3, True), (4, 5, 2, False), (5, 5, 2, True),
            (6, 6, 2, True), (7, 6, 2, False),
        }
    assert exact_dedup(df, F.lit(True)).where("doc_id = 6").first().text_sha256 == hashlib.sha256(b"d").hexdigest()


# ---- mixing ------------------------------------------------------------------------------


def test_water_fill(spark):
    sources = spark.createDataFrame([("a", 10, 1), ("b", 10, 2), ("c", 1000, 3)], "key string, size long, weight int")
    got = {r.key: r.target for r in water_fill(sources).collect()}
    assert got == {"a": 30.0, "b": 30.0, "c": 960.0}


def test_targets_are_met_and_reruns_agree(spark):
    rnd = random.Random(1)
    rows = [(i, " ".join("w" * rnd.randint(0, 60)), rnd.choice(["a", "b", "b", "b", "", None])) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    first, again = mix_sources(df).collect(), mix_sources(df.repartition(7)).collect()
    assert sorted(first, key=str) == sorted(again, key=str)
    taken, target = {}, {}
    for r in first:
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in target)
    assert abs(sum(target.values()) - sum(r.size for r in first)) < 1e-6


# ---- licences ------------------------------------------------------------------------------


def test_licences_and_prose(spark):
    rows = [
        (1, "Some prose.\n\nLicensed under the Apache License, Version 2.0.\nmore prose here"),
        (2, "This work is licensed under the GNU General Public License, version 3."),
        (3, "Licensed under CC BY-NC 4.0.\nLicensed under CC BY-SA 4.0."),
        (4, "She has a driving license and he reserved all the seats by right."),
        (5, "Released under the MIT License, see the file."),
        (6, "The general public wants a new version of the license office."),
    ]
    got = licence_paragraphs(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.paragraph, r.family) for r in got} == {
        (1, 2, "Apache-2.0"), (2, 0, "GPL"), (3, 0, "CC-BY-NC"), (3, 1, "CC-BY-SA"), (5, 0, "MIT")
    }


def test_wrapped_notices(spark):
    def wrapped(text, width, mark):
        return "\n".join(mark + line for line in textwrap.wrap(text, width))

    notices = {f: max(TEMPLATES[f], key=len) for f in ("MIT", "GPL", "BSD")}
    rows, want = [], set()
    for n, (family, notice) in enumerate(notices.items()):
        for mark, width in (("# ", 50), (" * ", 70), ("", 60)):
            body = wrapped(notice, width, mark)
            doc_id = len(rows)
            rows.append((doc_id, f"int a{n};\n\n{body}\n\nint main() {{}}"))
            want.add((doc_id, 2, 1 + len(body.split("\n")), family))
    rows.append((99, "the people of the city\nwent to the library and\nwere free to read there"))
    got = licence_paragraphs(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.family) for r in got} == {(d, f) for d, _, _, f in want}
    # whole notices, but for lines that add no pair
    assert all(r.likeness > 0.9 and r.last_line > r.paragraph for r in got)
    assert {(r.doc_id, r.paragraph) for r in got} == {w[:2] for w in want} and len(got) == len(want)


def test_licences_learn_from_every_paragraph(spark, monkeypatch):
    seen, trained = [], licences._trained

    def spy(rows, families, background):
        seen.append(background.count())
        return trained(rows, families, background)

    monkeypatch.setattr(licences, "_trained", spy)
    rows = [(i, f"Note {i} of the walk by the river and of its {i % 97} old bridges.") for i in range(6000)]
    rows += [(6000, TEMPLATES["BSD"][2]), (6001, TEMPLATES["MIT"][1])]
    got = licence_paragraphs(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    # the notice without a word of licences is no ordinary paragraph
    assert seen == [6000]
    assert {(r["doc_id"], r["family"]) for r in got} == {(6000, "BSD"), (6001, "MIT")}


def test_licence_classifier_keeps_its_rows_in_bounded_parts(spark, monkeypatch):
    rows = [(i, f"Note {i} of the walk by the river and of its {i % 97} old bridges.") for i in range(3000)]
    rows += [(6000, TEMPLATES["BSD"][2]), (6001, TEMPLATES["MIT"][1])]
    sizes, fit = [], licences.LogisticRegression.fit

    def spy(self, data):
        per = data.groupBy(F.spark_partition_id()).count().collect()
        sizes.append(([r["count"] for r in per], self.getMaxBlockSizeInMB()))
        return fit(self, data)

    monkeypatch.setattr(licences.LogisticRegression, "fit", spy)
    monkeypatch.setattr(licences, "_PART_ROWS", 50, raising=False)
    got = licence_paragraphs(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    [(parts, block)] = sizes
    # half of the paragraphs, and the variations of the templates
    assert max(parts) <= 100 and sum(parts) > 1400
    assert 0 < block < 0.5
    assert {(r["doc_id"], r["family"]) for r in got} == {(6000, "BSD"), (6001, "MIT")}


def test_licence_paragraphs_are_worked_out_once(spark, tmp_path):
    texts = [(1, "first line\nsecond line\n\nthird line\nfourth line")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    seen, written = [], licences.staged

    def spy(df, name, **kw):
        seen.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return written(df, name, **kw)

    licences.staged = spy
    try:
        licence_paragraphs(docs).collect()
    finally:
        licences.staged = written
    lines = seen[0][1]
    # pairs and vectors
    assert lines.count("UDF(") <= 2 and lines.count("[^a-z0-9]+") == 1
    # a block's row has its own lines only
    blocks = dict(seen)["licence-blocks"]
    listed = [r for r in blocks.splitlines() if "Generate explode" in r and "start" in r]
    assert listed and all("lines#" not in r.split("], false")[-2].split("[")[-1] for r in listed)


# ---- passages --------------------------------------------------------------------------------


def test_equal_runs_share_a_seed():
    rnd = random.Random(2)
    for _ in range(100):
        run = [b"%d" % rnd.randint(0, 99) for _ in range(21)]
        a = [b"a%d" % rnd.randint(0, 99) for _ in range(rnd.randint(0, 60))]
        b = [b"b%d" % rnd.randint(0, 99) for _ in range(rnd.randint(0, 60))]
        one, other = seeds(a + run + b)[1], seeds(b + run + a + b)[1]
        assert set(one.tolist()) & set(other.tolist())


def test_chain_is_the_best_collinear_one():
    rnd = random.Random(5)
    for _ in range(60):
        matches = sorted({(rnd.randint(0, 30), rnd.randint(0, 30)) for _ in range(10)})
        matches = [m for i, m in enumerate(matches) if i == 0 or m[0] > matches[i - 1][0]]
        best = 0.0
        score = []
        for i, (a, b) in enumerate(matches):
            before = [score[j] - 0.1 * (a - p + b - q) / 2 for j, (p, q) in enumerate(matches[:i]) if q < b]
            score.append(8 + max([0.0, *before]))
            best = max(best, score[-1])
        chain = chains(matches)[0]
        cost = sum((x[0] - w[0] + x[1] - w[1]) / 2 for w, x in zip(chain, chain[1:], strict=False))
        assert abs(8 * len(chain) - 0.1 * cost - best) < 1e-9
        assert sorted(m for c in chains(matches) for m in c) == matches


def test_alignment_counts_edits():
    a, b = [b"%d" % i for i in range(60)], [b"%d" % i for i in range(60)]
    b[30:31] = [b"x", b"y"]
    assert edits(a[20:40], b[20:41]) == 2 and edits([], [b"q"]) == 1
    assert align([b"l", *a, b"r"], [b"m", *b, b"s"], [(11, 11), (46, 47)]) == (1, 61, 1, 62, 2)


def test_planted_passages(spark):
    rnd = random.Random(9)

    def prose(n):
        return ["".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(n)]

    exact, fuzzy, short = prose(60), prose(120), prose(30)
    changed = list(fuzzy)
    for at in (30, 61, 95):
        changed[at] = "changed"
    del changed[75]
    texts = [prose(80) + exact + prose(40), prose(50) + fuzzy, prose(10) + exact, prose(200), changed + prose(90)]
    texts += [prose(20) + short, short + prose(90), prose(7) + exact + prose(5) + fuzzy[:70]]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.keep_id, r.start_word, r.end_word, r.keep_start, r.keep_end, r.edits) for r in got} == {
        (2, 0, 10, 70, 80, 140, 0), (4, 1, 0, 119, 50, 170, 4), (7, 0, 7, 67, 80, 140, 0), (7, 1, 72, 142, 50, 120, 0)
    }


def prose_of(rnd, n):
    return ["".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(n)]


@pytest.mark.parametrize("fragments", [1, 50])
def test_fragments_do_not_hide_the_whole_passage(spark, fragments):
    # the smallest doc_ids hold the first 45 words only, of them 50 more than a hot run has places
    rnd = random.Random(12)
    whole = prose_of(rnd, 60)
    texts = [prose_of(rnd, 20) + whole[:45] + prose_of(rnd, 20) for _ in range(fragments)]
    texts += [prose_of(rnd, 30) + whole + prose_of(rnd, 9), prose_of(rnd, 12) + whole + prose_of(rnd, 30)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.keep_id, r.start_word, r.end_word, r.edits) for r in got} == {
        (fragments + 1, fragments, 12, 72, 0)
    }


def test_near_passages_with_many_edits(spark):
    # of any passage that has one equal run of 8 words, however short its chain
    rnd = random.Random(13)
    rows, planted = [], {}
    for n in range(40):
        words = prose_of(rnd, 60)
        other = list(words)
        for at in range(rnd.randint(4, 7), 60, 12):
            other[at] = "changed"
        rows += [(2 * n, " ".join(prose_of(rnd, 20) + words)), (2 * n + 1, " ".join(other + prose_of(rnd, 30)))]
        planted[2 * n + 1] = 2 * n
    got = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.keep_id for r in got} == planted
    assert all(r.edits == 5 and r.end_word - r.start_word == 60 for r in got)


def test_bad_gap_does_not_drop_a_good_passage(spark):
    rnd = random.Random(14)
    good, line = prose_of(rnd, 60), prose_of(rnd, 9)
    texts = [good + prose_of(rnd, 40) + line, good + prose_of(rnd, 40) + line]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(r.doc_id, r.keep_id, r.start_word, r.end_word) for r in got] == [(1, 0, 0, 60)]


# ---- nearest ---------------------------------------------------------------------------------


def test_many_blocks_and_tasks_as_brute_force(spark, monkeypatch):
    from kerbline.llm import nearest

    monkeypatch.setattr(nearest, "_QUERY_ROWS", 5)
    monkeypatch.setattr(nearest, "_CANDIDATE_ROWS", 16)
    rng = np.random.default_rng(1)
    x = np.round(rng.normal(size=(300, 6)), 1)  # with ties
    x[50:90] = x[50]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = nearest_neighbours(df, F.col("vec_id") % 10 == 0, k=7).collect()
    want = set()
    for q in range(0, 300, 10):
        gap = x - x[q]
        d = np.zeros(300)
        for j in range(6):
            d += gap[:, j] * gap[:, j]
        order = sorted((float(s), i) for i, s in enumerate(np.sqrt(d)) if i != q)[:7]
        want |= {(q, n, i, s) for n, (s, i) in enumerate(order, 1)}
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in got} == want


# ---- packing -----------------------------------------------------------------------------------


def test_best_fit_as_brute_force():
    rnd = random.Random(8)
    for _ in range(40):
        pieces = sorted(((rnd.randint(0, 50), rnd.randint(0, 4), rnd.randint(0, 9)) for _ in range(60)), reverse=True)
        bins, want = [], []
        for size, source, cluster in pieces:
            fits = [
                (b["room"], n) for n, b in enumerate(bins)
                if b["room"] >= size and b["room"] > 0 and cluster not in b["clusters"]
                and (source == 0 or source not in b["sources"])
            ]
            at = min(fits)[1] if fits else len(bins)
            if not fits:
                bins.append({"room": 64, "sources": set(), "clusters": set()})
            bins[at]["room"] -= size
            bins[at]["sources"].add(source)
            bins[at]["clusters"].add(cluster)
            want.append(at)
        assert best_fit(pieces, 64) == want


@needs_tables
def test_packing_query(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    whole, bins = {}, {}
    for r in contract.queries()["op9_best_fit_packing"](spark, SF).collect():
        assert r.start_word == whole.get(r.doc_id, 0) or r.piece
        whole[r.doc_id] = whole.get(r.doc_id, 0) + r.words
        bins.setdefault(r.bin, []).append(r)
    assert whole == {d: len((r.text or "").encode().split()) for d, r in docs.items()}
    for rows in bins.values():
        assert sum(r.words for r in rows) <= 2048
        named = [docs[r.doc_id].source for r in rows if docs[r.doc_id].source is not None]
        assert len(named) == len(set(named))
        texts = ["".join((docs[r.doc_id].text or "").split()) for r in rows]
        assert len(texts) == len(set(texts))


def test_packing_does_not_depend_on_layout(spark):
    rows = [(i, "w " * (i * 37 % 900), f"s{i % 4}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    one = {tuple(r) for r in pack(df, shard_rows=64).collect()}
    assert one == {tuple(r) for r in pack(df.repartition(11), shard_rows=64).collect()}


# ---- classifiers -------------------------------------------------------------------------------


def test_additive_model_finds_a_pair():
    rng = np.random.default_rng(0)
    x = rng.uniform(-1, 1, (4000, 3))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    model = fit_additive(x[:3000], y[:3000])
    assert (model.pairs[0][0], model.pairs[0][1]) == (0, 1)
    assert ((model.probability(x[3000:]) > 0.5) == y[3000:]).mean() > 0.9


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="no test tables")
@pytest.mark.parametrize(("name", "label", "least"), [("op10_quality", "quality", 0.99), ("op3_toxicity", "toxic", 0.88)])
def test_held_out_ranking(spark, name, label, least):
    sf = "/root/testdata/sf0.1"
    scores = contract.queries()[name](spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = scores.where("held_out").join(labels, "doc_id").select("score", F.col(label).alias("y")).toPandas()
    ranks = rows.score.rank()
    ones, n = ranks[rows.y == 1], (rows.y == 1).sum()
    assert (ones.sum() - n * (n + 1) / 2) / (n * (len(rows) - n)) > least


# ---- the pipeline --------------------------------------------------------------------------------


def test_rare_toxic_words_are_learned():
    rng = random.Random(5)
    plain = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(300)]
    foul = ["".join(rng.choices("qrstuvwxyz", k=8)) for _ in range(100)]
    texts = [(" ".join(rng.choices(plain, k=40)).encode(), 0) for _ in range(2000)]
    for i in range(1000):
        # each word is in one toxic text of a hundred
        words = rng.choices(plain, k=40)
        words[rng.randrange(40)] = foul[i % 100]
        texts.append((" ".join(words).encode(), 1))
    learned = train(texts)
    assert all(w.encode() in learned.toxic for w in foul)
    # words of ordinary texts are not
    assert sum(f" {w} ".encode() in learned.toxic for w in plain) == 0


def test_distances_by_single_windows():
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(200)]
    texts = [(" ".join(rng.choices(words, k=60) + ["vileword"] * (i % 2)).encode(), i % 2) for i in range(200)]
    ordinary, toxic = train(texts).compressors()
    for n in (1, 9, 10, 11, 25, 41_000):
        text = " ".join(rng.choices([*words, "vileword"], k=n)).encode()
        parts = text.split()
        saved = []
        for i in range(0, n, 10):
            window = b" " + b" ".join(parts[i : i + 10]) + b" "
            saved.append(len(ordinary.compress(window)) - len(toxic.compress(window)))
        got = distances(text, ordinary, toxic)
        assert got[:3] == sorted([*saved, 0, 0, 0], reverse=True)[:3]
        assert got[3:7] == [sum(x >= k for x in saved) / (len(saved) + 4) for k in (2, 3, 4, 6)]
        assert got[7] == sum(max(x, 0) for x in saved) / (len(saved) + 4)


@needs_tables
def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, texts = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    after = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == columns
        after[name] = docs.collect()
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    kept = {r.doc_id for r in after["quality"]}
    assert len(good & kept) >= 0.98 * len(good) and len(kept) < len(texts)
    assert {r.doc_id for r in after["line-dedup"]} == kept
    lines = [line.lower().split() for r in after["line-dedup"] for line in r.text.split("\n") if line.split()]
    assert len(lines) == len({tuple(x) for x in lines})
    prints = {r.doc_id: fingerprint(r.text.encode()) for r in after["line-dedup"]}
    root = roots(sorted(set(prints.values())))
    first = {}
    for doc_id, p in sorted(prints.items()):
        first.setdefault(root[p], doc_id)
    assert sorted(r.doc_id for r in after["simhash"]) == sorted(first.values())
    assert {r.doc_id for r in after["mixing"]} <= {r.doc_id for r in after["simhash"]}
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "copy", "piece", "start_word", "words", "bin"]
