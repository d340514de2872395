"""SimHash near-dedup: fingerprints, and a binary trie joined with itself."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, forest, staged

_QUARTER = 16
_PER_TASK = 32_768  # fingerprints of one trie that one task should hold
_DEEPEST = 12  # further bits by which a crowded trie is taken apart


def fingerprint(text: bytes | None, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash over word shingles, repeats included; 0 without words."""
    words = (text or b"").lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n < shingle:
        hashes = np.array([xxhash.xxh64_intdigest(joined, seed)], np.uint64)
    else:
        lengths = np.fromiter(map(len, words), np.int64, n)
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths)[: n - shingle + 1].tolist()
        digest = xxhash.xxh64_intdigest
        spans = zip(starts, ends[shingle - 1 :].tolist(), strict=True)
        hashes = np.fromiter((digest(joined[a:b], seed) for a, b in spans), np.uint64, len(starts))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 32_768):
        part = hashes[at : at + 32_768].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, *carry, fp) of every row; fp is the fingerprint as a signed long."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            fps = np.array([fingerprint(t.as_py()) for t in texts], np.uint64).view(np.int64)
            own = [batch.column(c) for c in ("doc_id", *carry)]
            yield pa.RecordBatch.from_arrays([*own, pa.array(fps)], names=["doc_id", *carry, "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    further = "".join(f"{c} {docs.schema[c].dataType.simpleString()}, " for c in carry)
    source = docs.select("doc_id", *carry, F.col("text").cast("string"))
    return source.mapInArrow(compute, f"doc_id {kind}, {further}fp long")


# ---- the trie self-join --------------------------------------------------------------


def trie_links(
    a: np.ndarray, b: np.ndarray | None, diff: int, budget: int, depth: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of sorted uint64 ``a`` and ``b`` within ``budget`` differing bits.

    ``b`` None joins ``a`` with itself. Only pairs whose first 16 bits agree are asked
    for. A trie node is a range of the sorted array. The traversal starts at pairs of
    nodes with equal first 16 bits, that share or are known to differ in ``diff`` of the
    bits up to ``depth``, and descends both nodes together: the four pairs of children
    carry the bits that differ so far, and a pair over the budget is dropped with all
    below it. Node pairs with few leaves are compared leaf by leaf.
    """
    same_tree = b is None
    b = a if b is None else b
    if not len(a) or not len(b):
        return
    head_a, head_b = a >> np.uint64(64 - _QUARTER), b >> np.uint64(64 - _QUARTER)
    heads = np.intersect1d(head_a, head_b)
    nodes = np.stack(
        [
            np.searchsorted(head_a, heads, "left"),
            np.searchsorted(head_a, heads, "right"),
            np.searchsorted(head_b, heads, "left"),
            np.searchsorted(head_b, heads, "right"),
            np.full(len(heads), diff),
        ]
    ).astype(np.int64)
    ones: dict[tuple[bool, int], np.ndarray] = {}

    def ones_before(first: bool, level: int) -> np.ndarray:
        if (first or same_tree, level) not in ones:
            bits = ((a if first or same_tree else b) >> np.uint64(63 - level)) & np.uint64(1)
            ones[first or same_tree, level] = np.concatenate([[0], np.cumsum(bits, dtype=np.int64)])
        return ones[first or same_tree, level]

    stack = [(depth, nodes, np.full(nodes.shape[1], same_tree))]
    while stack:
        level, now, same = stack.pop()
        if now.shape[1] > 1 << 19:
            half = now.shape[1] // 2
            stack += [(level, now[:, :half], same[:half]), (level, now[:, half:], same[half:])]
            continue
        n1, n2 = now[1] - now[0], now[3] - now[2]
        few = (n1 * n2 <= 16) | (level == 64)
        if few.any():
            lo1, lo2, m1, m2 = now[0, few], now[2, few], n1[few], n2[few]
            count = m1 * m2
            k = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            wide = np.repeat(m2, count)
            i, j = np.repeat(lo1, count) + k // wide, np.repeat(lo2, count) + k % wide
            close = np.bitwise_count(a[i] ^ b[j]) <= budget
            close &= ~np.repeat(same[few], count) | (i < j)
            yield i[close], j[close]
            now, same = now[:, ~few], same[~few]
        if not now.shape[1]:
            continue
        before1, before2 = ones_before(True, level), ones_before(False, level)
        lo1, hi1, lo2, hi2, d = now
        mid1 = hi1 - (before1[hi1] - before1[lo1])
        mid2 = hi2 - (before2[hi2] - before2[lo2])
        below = np.concatenate(
            [
                np.stack([lo1, mid1, lo2, mid2, d]),
                np.stack([mid1, hi1, mid2, hi2, d]),
                np.stack([lo1, mid1, mid2, hi2, d + 1]),
                np.stack([mid1, hi1, lo2, mid2, d + 1])[:, ~same],
            ],
            axis=1,
        )
        twin = np.concatenate([same, same, np.zeros(below.shape[1] - 2 * len(same), bool)])
        keep = (below[1] > below[0]) & (below[3] > below[2]) & (below[4] <= budget)
        keep &= ~twin | (below[1] - below[0] > 1)
        stack.append((level + 1, below[:, keep], twin[keep]))


def _spanning(a: np.ndarray, b: np.ndarray | None, diff: int, budget: int, depth: int) -> np.ndarray:
    """The links found by :func:`trie_links` as a forest: rows (value, root value)."""
    values = a if b is None else np.concatenate([a, b])
    shift = 0 if b is None else len(a)
    root = np.arange(len(values))
    us, vs, held = [], [], 0
    for u, v in trie_links(a, b, diff, budget, depth):
        us.append(u)
        vs.append(v + shift)
        held += len(u)
        if held > 1 << 20:
            # what is linked so far shrinks to one edge a node
            low = forest(len(values), np.concatenate([*us, np.arange(len(values))]), np.concatenate([*vs, root]))
            root, us, vs, held = low, [], [], 0
    root = forest(len(values), np.concatenate([*us, np.arange(len(values))]), np.concatenate([*vs, root]))
    moved = root != np.arange(len(values))
    return np.stack([values[moved], values[root[moved]]], axis=1)


def near_links(fps: DataFrame, budget: int = 3, per_task: int = _PER_TASK) -> DataFrame:
    """Links (a, b) that connect all distinct ``fps`` (fp) within ``budget`` <= 3 bits.

    Two fingerprints within 3 bits agree in one of their four quarters. So there are four
    tries, each with another quarter in front, and a pair is found in the trie where that
    quarter leads: its traversal starts at equal 16-bit nodes. Top subtrees are dealt to
    tasks. A subtree that holds too many fingerprints is taken apart by its next bits
    into pairs of subtrees that differ in at most ``budget`` of them, each pair a task of
    its own. A task returns its links as a forest, which connects the same fingerprints
    with fewer rows than fingerprints.
    """
    if budget > 3:
        raise ValueError("four quarters find at most 3 differing bits")
    n = fps.count()
    top = min(_QUARTER, max(0, math.ceil(math.log2(max(1, n) / per_task))))
    turned = fps.select("fp", F.explode(F.array(*map(F.lit, range(4)))).alias("quarter")).withColumn(
        "key",
        F.expr("CASE WHEN quarter = 0 THEN fp ELSE shiftleft(fp, 16 * quarter) | "
               "shiftrightunsigned(fp, 64 - 16 * quarter) END"),
    )
    turned = turned.withColumn("subtree", F.shiftrightunsigned("key", 64 - top) if top else F.lit(0).cast("long"))
    # at most 4 * 2^16 rows
    crowd = turned.groupBy("quarter", "subtree").agg(F.count("*").alias("members"))
    crowd = crowd.withColumn(
        "bits",
        F.greatest(
            F.lit(0), F.least(F.lit(_DEEPEST), F.ceil(F.log2(F.col("members") / F.lit(4 * per_task))))
        ).cast("int"),
    ).drop("members")
    tasks = (
        turned.join(crowd, ["quarter", "subtree"])
        .withColumn("sub", F.expr(f"CASE WHEN bits = 0 THEN 0L ELSE "
                                  f"shiftrightunsigned(shiftleft(key, {_QUARTER}), 64 - bits) END"))
        .withColumn("mask", F.explode(F.expr(
            f"filter(sequence(0L, shiftleft(1L, bits) - 1), m -> bit_count(m) <= {budget})")))
        .withColumn("base", F.least("sub", F.expr("sub ^ mask")))
        .withColumn("right", F.col("sub") > F.col("base"))
    )

    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        keys, right = pdf["key"].to_numpy().view(np.uint64), pdf["right"].to_numpy()
        mask, bits, quarter = (int(pdf[c].iloc[0]) for c in ("mask", "bits", "quarter"))
        depth = _QUARTER + bits
        if mask:
            both = np.sort(keys[~right]), np.sort(keys[right])
        else:
            both = np.sort(keys), None
        found = _spanning(*both, mask.bit_count(), budget, depth)
        if quarter:
            by = np.uint64(16 * quarter)
            found = (found >> by) | (found << (np.uint64(64) - by))
        found = found.view(np.int64)
        return pd.DataFrame({"a": found[:, 0], "b": found[:, 1]})

    return (
        tasks.select("quarter", "subtree", "base", "mask", "bits", "key", "right")
        .groupBy("quarter", "subtree", "base", "mask")
        .applyInPandas(links, "a long, b long")
    )


def _components(docs: DataFrame, budget: int, carry: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp) of every row, and for each fp its component: (fp, root, component_id)."""
    prints = staged(fingerprints(docs, carry), "fingerprints")
    first = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    joined = components(near_links(first.select("fp"), budget))
    # one row per fingerprint that has a neighbour, the root included
    ends = joined.select(F.col("node").alias("fp"), "root").union(
        joined.select(F.col("root").alias("fp"), "root").distinct()
    )
    smallest = ends.join(first, "fp").groupBy("root").agg(F.min("first_id").alias("component_id"))
    linked = ends.join(smallest, "root").select("fp", "root", "component_id")
    component = first.join(linked, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), F.coalesce("component_id", "first_id").alias("component_id")
    )
    # a table of its own, so that the last join deals both sides anew and can split a hot fp
    component = staged(component, "fingerprint-components")
    return prints, component


def component_rows(docs: DataFrame, carry: tuple[str, ...], budget: int = 3) -> DataFrame:
    """(doc_id, *carry, root) of every row; root names the component, also without a doc_id."""
    prints, component = _components(docs, budget, carry)
    return prints.join(component.select("fp", "root"), "fp").select("doc_id", *carry, "root")


def simhash_groups(docs: DataFrame, budget: int = 3) -> DataFrame:
    """Near-duplicate groups: (doc_id, fp, fingerprint, component_id), one row per row.

    Words are runs of other characters than \\x20 and \\x09-\\x0D, A-Z lower-cased;
    3-word shingles, joined by a space, count with repeats. Fewer words make one shingle;
    null texts and texts without a word have fingerprint zero, which is linked like any
    other. ``component_id`` is the smallest doc_id among all rows reachable over links of
    at most ``budget`` differing bits (null only where all of these are null). Repeated
    rows share a fingerprint; an empty table gives an empty result; other columns are
    not read.

    Only distinct fingerprints are joined, so copies cost one aggregate.
    """
    prints, component = _components(docs, budget)
    return prints.join(component, "fp", "left").select(
        "doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
