"""Embedding near-dedup, conversation repair and token alignment against brute force."""

import glob
import hashlib
import itertools
import os
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from kerbline.llm import repair as rp
from kerbline.llm.alignment import (
    alignment_report,
    alignments,
    byte_level,
    merge_ends,
    pieces,
    tokenizer_path,
)
from kerbline.llm.rotation import binary_codes, code_estimates, cosine_groups, near_cells, rotation, unit
from tools.check import keyed

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
needs_tokenizers = pytest.mark.skipif(
    not os.path.isdir("/opt/tokenizers"), reason="no tokenizer files"
)


@needs_tables
@pytest.mark.parametrize("name", ["op11_embedding_near_dedup", "op12_conversation_repair"])
def test_same_rows_as_sql(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    df = contract.queries()[name](spark, SF)
    cur = con.execute(contract.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert keyed([tuple(r) for r in df.collect()], df.columns) == keyed(cur.fetchall(), names)


# ---- embedding near-dedup ------------------------------------------------------------


def brute_groups(rows, cosine=0.98):
    """(n_links, component_id) per row of (id, vector, label)."""

    def fine(v):
        return v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v) and any(v)

    n = len(rows)
    links = [set() for _ in range(n)]
    for i, j in itertools.combinations(range(n), 2):
        (_, x, a), (_, y, b) = rows[i], rows[j]
        if a is None or a != b or not fine(x) or not fine(y) or len(x) != len(y):
            continue
        x, y = np.array(x) / np.abs(x).max(), np.array(y) / np.abs(y).max()
        if x @ y / np.sqrt((x @ x) * (y @ y)) >= cosine:
            links[i].add(j)
            links[j].add(i)
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((len(links[i]), min(ids, default=None)))
    return out


@pytest.mark.parametrize("tile_rows", [2048, 16])
def test_near_vectors_as_brute_force(spark, tile_rows):
    rng = np.random.default_rng(tile_rows)
    rows = []
    for label in (0, 1):
        centres = rng.standard_normal((12, 24))
        for c in range(12):
            # spreads around the bound, chains included
            for s in rng.uniform(0, 0.35, 14 if c else 60):
                rows.append((len(rows), (centres[c] + s * rng.standard_normal(24)).tolist(), label))
    rows += [(len(rows) + i, rows[5][1], 0) for i in range(4)]
    rows += [(500, (np.array(rows[5][1]) * 3e5).tolist(), 0), (501, rows[5][1], 1), (502, rows[5][1], None)]
    got = {
        r.vec_id: (r.n_links, r.component_id)
        for r in cosine_groups(
            spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), tile_rows=tile_rows
        ).collect()
    }
    assert got == {r[0]: want for r, want in zip(rows, brute_groups(rows), strict=True)}
    assert sum(n for n, _ in got.values()) > 500


def test_near_vectors_on_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, None, 0), (4, [], 0), (5, [0.0, -0.0], 0),
        (6, [nan, 1.0], 0), (7, [inf, 1.0], 0), (8, [None, 1.0], 0), (9, [1.0, 0.0], None), (10, [1.0, 0.0, 0.0], 0),
        (11, [1e-200, 0.0], 0), (12, [1e200, 1e199], 0), (None, [0.0, 5.0], 0), (13, [0.0, 1.0], 0), (None, [3.0, -9.0], 0),
        (14, [7.0], 0), (15, [2.0], 0), (16, [-2.0], 0),
    ]
    schema = "vec_id long, embedding array<double>, label int, key string, part int, h1 int, rep int, cell int"
    df = spark.createDataFrame([(*r, "k", 1, 2, 3, 4) for r in rows], schema)
    got = [(r.vec_id, r.n_links, r.component_id, r.kept) for r in cosine_groups(df).collect()]
    want = [(r[0], n, c, r[0] == c) for r, (n, c) in zip(rows, brute_groups(rows), strict=True)]
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(got, key=order) == sorted(want, key=order)
    none = cosine_groups(df.limit(0))
    assert none.columns == ["vec_id", "n_links", "component_id", "kept"] and none.count() == 0


def test_estimates_are_unbiased_and_bounds_hold():
    rng = np.random.default_rng(1)
    x, y = unit(rng.standard_normal((40, 64))), unit(rng.standard_normal((300, 64)))
    y[:40] = unit(x + 0.1 * y[:40])
    errors, over = [], 0
    for seed in range(30):
        turn = rotation(64, seed)
        assert np.allclose(turn @ turn.T, np.eye(64))
        estimate, width = code_estimates(*binary_codes(x @ turn.T), y @ turn.T, 3.0)
        errors.append(estimate - x @ y.T)
        over += (np.abs(errors[-1]) > width).sum()
    assert abs(np.mean(errors)) < 1e-3
    assert over / np.size(errors) < 0.004  # 0.27 % by the normal bound
    _, never = code_estimates(*binary_codes(x @ turn.T), y @ turn.T, 1e9)
    assert (np.abs(errors[-1]) <= never).all()


def test_cells_of_near_vectors_meet():
    rng = np.random.default_rng(2)
    x = unit(rng.standard_normal((400, 16)))
    y = unit(x + 0.045 * rng.standard_normal(x.shape))
    near = (x * y).sum(axis=1) >= 0.98
    assert near.sum() > 100
    both = np.concatenate([x, y])
    home, guest, cell = near_cells(both, 6, 2 - 2 * 0.98)
    to = set(zip(guest.tolist(), cell.tolist()))
    for i in np.flatnonzero(near).tolist():
        low, high = sorted((i, i + 400), key=lambda r: home[r])
        assert home[low] == home[high] or (low, home[high]) in to
    assert len(guest) < 20 * len(both)


# ---- conversation repair -------------------------------------------------------------


def repairs(turns):
    """All (cost, audit, roles and texts) of a conversation of (role, text, mark); small ones only."""
    best = None
    most = 2 * len(turns) + 3

    def go(i, cost, audit, put):
        nonlocal best
        if best is not None and cost > best[0] or len(put) > most:
            return
        word = "".join(r[:1] or "?" for r, _ in put)  # an empty role is none of the three
        if i == len(turns) and (word == "" or rp_legal(word)):
            best = min(best or (cost, audit, put), (cost, audit, put))
        for role in ("user", "assistant"):
            if audit.count("I") <= len(turns):
                go(i, cost + 3, audit + "I", [*put, (role, "")])
        if i < len(turns):
            role, text, mark = turns[i]
            go(i + 1, cost + 4, audit + "D", put)
            if mark != "d":
                extra = 3 * (mark == "t")
                go(i + 1, cost + extra, audit + "K", [*put, (role, text)])
                for other in ("user", "assistant"):
                    go(i + 1, cost + 3 + extra, audit + "R", [*put, (other, text)])

    go(0, 0, "", [])
    return best


def rp_legal(word):
    body = word[1:] if word[:1] == "s" else word
    return len(body) > 0 and body == "ua" * (len(body) // 2)


def faults(turns):
    """(marks, counts) of turns (turn, role, text) in order."""
    seen, marks, counts = set(), [], Counter()
    for _, role, text in turns:
        visible = text.strip(" \t\n\x0b\f\r")
        if not visible:
            marks.append("d")
            counts["blank"] += 1
        elif (role, text) in seen:
            marks.append("d")
            counts["duplicate"] += 1
        elif visible[-1] not in ".!?":
            marks.append("t")
            counts["truncated"] += 1
        else:
            marks.append("k")
        seen.add((role, text))
    for (_, a, _), (_, b, _) in itertools.pairwise(turns):
        counts["illegal"] += a[:1] + b[:1] not in ("su", "ua", "au")
    return marks, counts


def brute_report(turns):
    marks, counts = faults(turns)
    cost, audit, put = repairs([(r, t, m) for (_, r, t), m in zip(turns, marks, strict=True)])
    known = [t for t, _, _ in turns if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in put).encode()).hexdigest()
    return (gaps, counts["blank"], counts["duplicate"], counts["truncated"], counts["illegal"], cost, audit, sha), put


TURNS = "conv_id long, turn long, role string, text string"
COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def in_order(turns):
    key = lambda t: (t[0] is not None, t[0] or 0, t[1], hashlib.sha256(t[2].encode()).hexdigest())
    return sorted(turns, key=key)


def test_repairs_as_all_edits_tried(spark):
    rnd = random.Random(4)
    convs = {}
    for c in range(120):
        texts = ["Yes.", "No", " ", "Well?", "Éh!  \n", "漢."]
        roles = ["system", "user", "assistant", "user", "assistant", "tool", "", "u"]
        convs[c] = [
            (rnd.choice([None, 0, 1, 2, 3, 5, 8]), rnd.choice(roles), rnd.choice(texts)) for _ in range(rnd.randint(1, 5))
        ]
    rows = [(c, *t) for c, ts in convs.items() for t in ts]
    df = spark.createDataFrame(rows, TURNS)
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in rp.repair_report(df).collect()}
    made = {}
    for r in sorted(rp.repaired_turns(df).collect(), key=lambda r: (r.conv_id, r.place)):
        made.setdefault(r.conv_id, []).append((r.role, r.text))
    for c, turns in convs.items():
        want, put = brute_report(in_order(turns))
        assert got[c] == want, (c, turns)
        assert made.get(c, []) == put


def viterbi(marks):
    """Least (cost, audit) of a long conversation by states, from the left."""
    now = {q: rp.EMPTY[q] for q in range(4) if rp.EMPTY[q]}
    for m in marks:
        cell, to = rp.TURNS[m], {}
        for p, (cost, audit) in now.items():
            for q in range(4):
                if cell[4 * p + q]:
                    c, a = cell[4 * p + q]
                    to[q] = min(to.get(q, (10**9, "")), (cost + c, audit + a))
        now = to
    return min(now[q] for q in (0, 3) if q in now)


def test_spans_of_any_length_combine():
    rnd = random.Random(5)
    for n in (0, 1, 2, 7, 8, 9, 63, 64, 65, 600):
        marks = "".join(rnd.choice("uauaudUAoSs") for _ in range(n))
        spans = rp.Spans()
        at, known = 0, {}
        while at < n:
            step = rnd.randint(1, 8)
            spans.add(rp.marks_cell(marks[at : at + step], known))
            at += step
        assert rp.best(spans.whole()) == viterbi(marks)


def test_long_conversation_over_many_parts(spark):
    rnd = random.Random(6)
    rows = [(7, t, rnd.choice(["user", "assistant"]), f"{rnd.randint(0, 2000)}{rnd.choice('.?,')}") for t in range(3000)]
    rows += [(c, t, "user", "Hi.") for c in (6, 8) for t in range(2)]
    rows += [(9, None, "user", "same.")] * 40
    df = spark.createDataFrame(rows, TURNS).repartition(5)
    got = {r.conv_id: r for r in rp.repair_report(df).collect()}
    marks, counts = faults([r[1:] for r in rows if r[0] == 7])
    names = "".join("d" if m == "d" else (r[2][0].upper() if m == "t" else r[2][0]) for r, m in zip(rows, marks, strict=False))
    assert (got[7].cost, got[7].audit) == viterbi(names)
    assert (got[7].duplicate, got[7].truncated, got[7].gaps) == (counts["duplicate"], counts["truncated"], 0)
    lines = [f"{r.role}:{r.text}" for r in sorted(rp.repaired_turns(df.where("conv_id = 7")).collect(), key=lambda r: r.place)]
    assert got[7].repaired_sha256 == hashlib.sha256("\n".join(lines).encode()).hexdigest()
    assert got[9].duplicate == 39 and got[9].audit.count("D") == 39 and got[9].cost == 4 * 39 + 3


def test_repair_of_awkward_tables(spark):
    long = "word " * 300_000 + "end."
    rows = [
        (1, 0, None, "a."), (1, 1, "user", None), (None, None, None, None), (None, 3, "user", "x."), (2, None, "user", "q?"),
        (2, None, "assistant", "r."), (3, 0, "user", long), (3, 1, "assistant", long), (4, 0, "user", "gone."),
    ]
    df = spark.createDataFrame([(*r, "p", 1, "d") for r in rows], TURNS + ", present string, part int, digest string")
    there = F.coalesce(F.col("conv_id"), F.lit(0)) != 4
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in rp.repair_report(df, there).collect()}
    for conv in (1, 2, 3, None):
        turns = [(t, r or " ", " " if x is None else x) for c, t, r, x in rows if c == conv]
        assert got[conv] == brute_report(in_order(turns))[0]
    empty = hashlib.sha256(b"").hexdigest()
    assert got[4] == (0, 0, 0, 0, 0, 0, "", empty) and len(got) == 5
    assert rp.repair_report(df.limit(0)).count() == 0
    hurt = rp.damaged(df)
    assert hurt.columns == ["conv_id", "turn", "role", "text", "present"]


# ---- token alignment -----------------------------------------------------------------


def brute_alignment(text, a, b):
    """(a ids, b ids, links as positions, groups as text) of a text, or None."""
    ids_a, ids_b = a.encode(" " + text), b.encode(text)
    whole = (" " + text).encode()
    if b"".join(a.table[i] for i in ids_a) != whole or b"".join(b.table[i] for i in ids_b) != whole:
        return None

    def spans(ids, table):
        ends = list(itertools.accumulate(len(table[i]) for i in ids))
        return list(zip([0, *ends[:-1]], ends))

    sa, sb = spans(ids_a, a.table), spans(ids_b, b.table)
    links = [
        (i, j) for i, (lo, hi) in enumerate(sa) for j, (lo2, hi2) in enumerate(sb) if max(lo, lo2) < min(hi, hi2)
    ]
    groups, lo = [], 0
    for cut in sorted({e for _, e in sa} & {e for _, e in sb}):
        inside = [
            ",".join(str(ids[k]) for k, (s, e) in enumerate(sp) if s >= lo and e <= cut)
            for ids, sp in ((ids_a, sa), (ids_b, sb))
        ]
        groups.append("|".join(inside))
        lo = cut
    return ids_a, ids_b, links, ";".join(groups)


@needs_tokenizers
def test_byte_level_as_its_file_says():
    from tokenizers import Tokenizer

    path = tokenizer_path("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    ours = byte_level(path)
    rnd = random.Random(7)
    bits = [" ", "  ", "\n", "a", "Zed", "é", "漢", "🙂", "'ll", "'S", "12", " ", "_", "-", "\t", "ß", "́", "<|endoftext|>"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 14))) for _ in range(3000)]
    texts += ["\n" * 70_000 + "x", " " * 900_000]
    assert all(ours.encode(" " + t) == whole.encode(" " + t, add_special_tokens=False).ids for t in texts)


def test_ends_merge_in_any_lanes():
    rng = np.random.default_rng(8)
    for lane in (1, 3, 256):
        for _ in range(30):
            ends = np.arange(1, rng.integers(1, 60))
            a, b = (np.unique(np.append(rng.choice(ends, rng.integers(0, len(ends) + 1)), ends[-1:])) for _ in range(2))
            m = merge_ends(a, b, lane)
            low_a, low_b = np.concatenate([[0], a])[:-1], np.concatenate([[0], b])[:-1]
            want = [(i, j) for i in range(len(a)) for j in range(len(b)) if max(low_a[i], low_b[j]) < min(a[i], b[j])]
            assert list(zip(m.a.tolist(), m.b.tolist())) == want
            assert a[m.cut_a].tolist() == b[m.cut_b].tolist() == np.intersect1d(a, b).tolist()
    none = merge_ends(np.zeros(0, np.int64), np.zeros(0, np.int64))
    assert not len(none.a) and not len(none.cut_a)


@needs_tokenizers
@pytest.mark.parametrize("chunk_bytes", [1, 500, 1 << 21])
def test_alignment_as_brute_force(spark, chunk_bytes):
    rnd = random.Random(9)
    vocabulary = ["hello", "Wörld", "naïve", "123", "don't", "漢字", "🙂", "\n", "foo_bar", "▁", "<s>", "  ", "ing"]
    texts = [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(1, 30))) for _ in range(60)]
    texts += [None, "", " ", "\t", "ﬁ ligature", "a▁b", "x" * 3000, texts[0], "<|endoftext|>", "\x00\x01", texts[0]]
    rows = [(i if i % 9 else None, t, "n", 1, 2) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, chunk string, pairs int, total int").repartition(3)
    paths = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    a, b = byte_level(paths[0]), pieces(paths[1])
    found = [brute_alignment(t, a, b) if t else None for t in texts]
    count = Counter((f[0][i], f[1][j]) for f in found if f for i, j in f[2])
    top = {}
    for (_, y), n in count.items():
        top[y] = max(top.get(y, 0), n)
    want = []
    for row, f in zip(rows, found, strict=True):
        if f is None:
            want.append((row[0], 0, 0, 0, 0, 0, 0, ""))
            continue
        pairs = [(f[0][i], f[1][j]) for i, j in f[2]]
        best = sum(count[p] == top[p[1]] for p in pairs)
        sha = hashlib.sha256(f[3].encode()).hexdigest()
        want.append((row[0], len(f[0]), len(f[1]), f[3].count(";") + 1, len(pairs), best, sum(count[p] for p in pairs), sha))
    got = [tuple(r) for r in alignment_report(df, *paths, chunk_bytes=chunk_bytes).collect()]
    order = lambda r: (r[0] is None, r[0] or 0, r)
    assert sorted(got, key=order) == sorted(want, key=order)
    assert sum(w[1] == 0 for w in want) >= 3
    rows = {r.doc_id: r for r in alignments(df, *paths, chunk_bytes=chunk_bytes).collect() if r.doc_id is not None}
    for (doc_id, *_), f in zip(want, found, strict=True):
        if doc_id is None:
            continue
        r = rows[doc_id]
        ids_a, ids_b, links, groups = f or ([], [], [], "")
        assert (r.a_ids, r.b_ids) == (ids_a, ids_b)
        assert list(zip(r.a_links, r.b_links)) == links
        lo_a, lo_b, out = 0, 0, []
        for hi_a, hi_b in zip(r.a_ends, r.b_ends):
            out.append(",".join(map(str, ids_a[lo_a:hi_a])) + "|" + ",".join(map(str, ids_b[lo_b:hi_b])))
            lo_a, lo_b = hi_a, hi_b
        assert ";".join(out) == groups


@needs_tokenizers
def test_alignment_of_no_rows(spark):
    paths = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    none = spark.createDataFrame([], "doc_id long, text string")
    assert alignment_report(none, *paths).count() == alignments(none, *paths).count() == 0
    blank = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert [tuple(r) for r in alignment_report(blank, *paths).orderBy("doc_id").collect()] == [
        (1, 0, 0, 0, 0, 0, 0, ""),
        (2, 0, 0, 0, 0, 0, 0, ""),
    ]
