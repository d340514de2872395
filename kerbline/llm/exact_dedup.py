"""Exact dedup: static binary-fuse filters per snapshot, exact buckets behind them."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import no_spaces, staged

_FILTER = "shard long, seed long, segment long, segments long, cells binary"
_KEYS_PER_FILTER = 250_000


# ---- the filter: 3-wise binary fuse, one byte per cell ------------------------------


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    x = keys + np.uint64((seed * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _cells(hashes: np.ndarray, segment: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Three cells, in consecutive segments, and the byte stored for each hash."""
    first = (hashes >> np.uint64(40)) % np.uint64(segments)
    at = [
        ((first + np.uint64(i)) * np.uint64(segment) + ((hashes >> np.uint64(13 * i)) & np.uint64(segment - 1)))
        for i in range(3)
    ]
    stored = ((hashes * np.uint64(0x2545F4914F6CDD1D)) >> np.uint64(56)).astype(np.uint8)
    return np.stack(at, axis=1).astype(np.int64), stored


def build_filter(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """A filter over distinct uint64 ``keys``: (seed, segment, segments, cells).

    Cells that only one remaining key uses are peeled off round by round; a seed under
    which some keys cannot be peeled is given up for the next one.
    """
    n = len(keys)
    segment = 1 << min(13, max(2, int(math.log(max(n, 2)) / math.log(3.33) + 2.25)))
    factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 2)))
    segments = max(1, math.ceil(n * factor / segment) - 2)
    size = (segments + 2) * segment
    for seed in range(1000):
        at, stored = _cells(_mixed(keys, seed), segment, segments)
        degree = np.bincount(at.ravel(), minlength=size)
        # the sum of the key numbers in a cell is the key itself once it is alone there
        numbers = np.repeat(np.arange(n), 3)
        total = np.bincount(at.ravel(), weights=numbers, minlength=size).astype(np.int64)
        order, front = [], np.flatnonzero(degree == 1)
        while len(front):
            alone, pick = np.unique(total[front], return_index=True)
            order.append((alone, front[pick]))
            gone = at[alone].ravel()
            np.subtract.at(degree, gone, 1)
            np.subtract.at(total, gone, np.repeat(alone, 3))
            front = np.unique(gone)
            front = front[degree[front] == 1]
        if sum(len(a) for a, _ in order) == n:
            cells = np.zeros(size, np.uint8)
            for alone, cell in reversed(order):
                three = cells[at[alone]]
                cells[cell] = stored[alone] ^ three[:, 0] ^ three[:, 1] ^ three[:, 2]
            return seed, segment, segments, cells.tobytes()
        # small sets can stay tangled in few cells
        if seed % 8 == 7:
            segments += max(1, segments // 8)
            size = (segments + 2) * segment
    raise RuntimeError("no seed peels these keys")


def passes(keys: np.ndarray, seed: int, segment: int, segments: int, cells: bytes) -> np.ndarray:
    """True for every key of the filter, and for one other key in 256."""
    at, stored = _cells(_mixed(keys, seed), segment, segments)
    three = np.frombuffer(cells, np.uint8)[at]
    return (three[:, 0] ^ three[:, 1] ^ three[:, 2]) == stored


# ---- the operator --------------------------------------------------------------------


def digest_of(text: Column | str) -> Column:
    return F.sha2(no_spaces(text), 256)


def _bucketed(digests: DataFrame, shards: int) -> DataFrame:
    """64 bits of each digest as filter key, and the shard they fall in."""
    key = F.conv(F.substring("sha", 1, 16), 16, -10).cast("long")
    return digests.withColumn("key", key).withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))


def snapshot_filters(digests: DataFrame, shards: int) -> DataFrame:
    """One filter for each shard of the distinct ``digests`` (sha) of a snapshot."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = np.unique(pdf["key"].to_numpy()).view(np.uint64)
        return pd.DataFrame([(int(pdf["shard"].iloc[0]), *build_filter(keys))], columns=names)

    names = ["shard", "seed", "segment", "segments", "cells"]
    return _bucketed(digests, shards).select("shard", "key").groupBy("shard").applyInPandas(build, _FILTER)


def screen(digests: DataFrame, filters: DataFrame, shards: int) -> DataFrame:
    """The incoming digests (sha) that their shard's filter does not rule out."""

    def check(_: tuple, pdf: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if not len(own) or not len(pdf):
            return pd.DataFrame({"sha": pd.Series([], dtype=object)})
        f = own.iloc[0]
        hit = passes(
            pdf["key"].to_numpy().view(np.uint64), int(f.seed), int(f.segment), int(f.segments), f.cells
        )
        return pdf.loc[hit, ["sha"]]

    incoming = _bucketed(digests, shards).select("shard", "key", "sha").groupBy("shard")
    return incoming.cogroup(filters.groupBy("shard")).applyInPandas(check, "sha string")


def exact_dedup(docs: DataFrame, incoming: Column) -> DataFrame:
    """Groups of equal texts over an immutable snapshot and a new batch.

    ``incoming`` is true for the rows of the new batch; the others are the snapshot.
    Texts are equal when identical without white space (null counts as empty). Copies
    inside the snapshot and inside the batch are grouped apart, by SHA-256. The batch's
    distinct digests are screened by the snapshot's filters, one filter for each
    ``shard`` of digests. Only the digests that pass are looked up in the snapshot's
    exact buckets, and there the two texts are compared byte by byte; texts that differ
    under one digest would stay two groups.

    The row with most code points in its original text stays, then the smallest doc_id
    (null last); of repeated rows one. Returns one row per row of ``docs``: doc_id,
    keep_id, group_size, kept, text_sha256. Other columns are not read. An empty table,
    batch or snapshot gives an empty or one-sided result.

    Groups are aggregated before their shuffle and joined back by digest, where the
    adaptive skew join splits a digest that many rows share.
    """
    rows = staged(
        docs.select(
            "doc_id",
            digest_of("text").alias("sha"),
            F.coalesce(F.length("text"), F.lit(0)).alias("points"),
            F.coalesce(incoming, F.lit(False)).alias("new"),
        )
        # repeated rows become one with a count, so that exactly one of them can stay
        .groupBy("doc_id", "sha", "points", "new")
        .agg(F.count("*").alias("copies")),
        "exact-rows",
    )
    best = F.min(F.struct((-F.col("points")).alias("short"), F.isnull("doc_id").alias("no_id"), "doc_id"))
    groups = staged(
        rows.groupBy("new", "sha").agg(F.sum("copies").alias("size"), best.alias("best")), "exact-groups"
    )
    old, new = groups.where("not new").drop("new"), groups.where("new").drop("new")
    shards = max(1, math.ceil(old.count() / _KEYS_PER_FILTER))
    filters = staged(snapshot_filters(old.select("sha"), shards), "exact-filters")
    seen = screen(new.select("sha"), filters, shards)
    bucket = old.select("sha", F.col("size").alias("old_size"), F.col("best").alias("old_best"))
    met = new.select("sha", F.col("size").alias("new_size"), F.col("best").alias("new_best"))
    met = staged(met.join(seen, "sha").join(bucket, "sha"), "exact-met")

    # byte check: the texts of the two rows that stand for their groups
    ends = met.select("sha", F.lit(True).alias("new"), F.col("new_best.doc_id").alias("doc_id")).union(
        met.select("sha", F.lit(False).alias("new"), F.col("old_best.doc_id").alias("doc_id"))
    )
    source = docs.select(
        F.col("doc_id").alias("id"), F.coalesce(incoming, F.lit(False)).alias("side"), "text"
    )
    # the merge join is dealt and split alike at every size
    texts = source.join(
        ends.hint("merge"), source.id.eqNullSafe(ends.doc_id) & (F.col("side") == F.col("new")), "inner"
    ).select("sha", "new", no_spaces("text").alias("body"))
    # a doc_id that several rows share brings their other texts along
    texts = texts.where(F.sha2("body", 256) == F.col("sha"))
    equal = texts.groupBy("sha").agg((F.min("body") == F.max("body")).alias("same"))
    same = met.join(equal.where("same").select("sha"), "sha", "left_semi")

    merged = same.select(
        "sha",
        (F.col("old_size") + F.col("new_size")).alias("size"),
        F.least("old_best", "new_best").alias("best"),
        (F.col("new_best") < F.col("old_best")).alias("holder"),
    )
    merged = staged(merged, "exact-merged")
    apart = groups.join(merged, "sha", "left_anti")
    both = merged.select(F.explode(F.array(F.lit(True), F.lit(False))).alias("new"), "sha", "size", "best", "holder")
    final = apart.select("new", "sha", "size", "best", F.col("new").alias("holder")).union(both)
    # a row repeated in the snapshot and in the batch stays in the snapshot
    stays = (
        (F.col("new") == F.col("holder"))
        & F.col("doc_id").eqNullSafe(F.col("best.doc_id"))
        & (F.col("points") == -F.col("best.short"))
    )
    one = (
        rows.join(final, ["new", "sha"])
        .withColumn("stays", stays)
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    )
    return one.select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("stays") & (F.col("copy") == 1)).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def later_half(doc_id: str = "doc_id") -> Column:
    """The query's new batch: rows whose doc_id hashes to an odd number."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), F.lit(2)) == 1


OP4_SQL = """
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[ \\x09-\\x0D]', '', 'g') AS body,
    length(coalesce(text, '')) AS points
  FROM documents),
r AS (
  SELECT *, row_number() OVER w AS place, first_value(doc_id) OVER w AS keep_id,
    count(*) OVER (PARTITION BY body) AS group_size
  FROM d WINDOW w AS (PARTITION BY body ORDER BY points DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, place = 1 AS kept,
  sha256(body) AS text_sha256
FROM r
"""
