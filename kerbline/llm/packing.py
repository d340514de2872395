"""Best-fit packing of documents into bins, no two conflicting ones together."""

from __future__ import annotations

import math
from bisect import bisect_left, insort

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import no_spaces, staged, word_count


def best_fit(pieces: list[tuple[int, int, int]], capacity: int) -> list[int]:
    """Bin numbers of ``pieces`` (size, source bit, cluster bit), given largest first.

    Open bins are ordered by residual, then by number. The search starts at the first
    bin whose residual holds the piece and goes on to the next larger residual until the
    bitmaps of the bin have neither the piece's source nor its cluster; without such a
    bin a new one is opened. Bit 0 stands for no source, which conflicts with nothing.
    """
    open_bins: list[tuple[int, int]] = []
    sources: list[int] = []
    clusters: list[int] = []
    chosen = []
    for size, source, cluster in pieces:
        source_bit, cluster_bit = (1 << source) & ~1, 1 << cluster
        at = bisect_left(open_bins, (size, -1))
        while at < len(open_bins):
            number = open_bins[at][1]
            if not sources[number] & source_bit and not clusters[number] & cluster_bit:
                residual = open_bins.pop(at)[0]
                break
            at += 1
        else:
            number, residual = len(sources), capacity
            sources.append(0)
            clusters.append(0)
        sources[number] |= source_bit
        clusters[number] |= cluster_bit
        if residual > size:
            insort(open_bins, (residual - size, number))
        chosen.append(number)
    return chosen


def pack(docs: DataFrame, *, capacity: int = 2048, shard_rows: int = 4096) -> DataFrame:
    """Bins of at most ``capacity`` words, the tightest compatible bin for each piece.

    Two documents conflict, and never share a bin, when they have one source or one
    text (equal without white space). A null source conflicts with no source. Documents
    longer than ``capacity`` are cut into pieces, all but the last of them full, so a
    bin holds at most one piece of a document. Empty and null texts are one piece of no
    words: they are packed too, under the same conflicts. Repeated rows are rows of one
    text, and so lie in different bins.

    Bins are filled in shards of about ``shard_rows`` pieces, dealt by a hash, so hot
    sources and large clusters spread over all shards and the result does not depend on
    the layout of the input. Largest pieces go first, ties by cluster, doc_id, copy.

    Returns doc_id, copy (1, 2, ... for repeated rows), piece (0, 1, ...), start_word,
    words, bin, one row per piece. An empty table gives an empty result; other columns
    are not read.
    """
    rows = (
        docs.select(
            "doc_id",
            F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")).alias("origin"),
            F.xxhash64(no_spaces("text")).alias("cluster"),
            word_count("text").alias("size"),
        )
        .groupBy("doc_id", "origin", "cluster", "size")
        .agg(F.count("*").alias("copies"))
    )
    pieces = staged(
        rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        .withColumn("last", F.greatest(F.lit(0).cast("long"), F.ceil(F.col("size") / capacity) - 1))
        .withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"))))
        .withColumn("start_word", F.col("piece") * capacity)
        .withColumn("words", F.least(F.lit(capacity), F.col("size") - F.col("start_word")).cast("long"))
        .select("doc_id", "origin", "cluster", "copy", "piece", "start_word", "words"),
        "pieces",
    )
    shards = max(1, math.ceil(pieces.count() / shard_rows))
    dealt = pieces.withColumn(
        "shard", F.pmod(F.xxhash64("doc_id", "cluster", "copy", "piece"), F.lit(shards).cast("long"))
    )
    kind = docs.schema["doc_id"].dataType.simpleString()

    def fill(own: pa.Table) -> pa.Table:
        keys = [("words", "descending"), *((k, "ascending") for k in ("cluster", "doc_id", "copy", "piece"))]
        own = own.take(pc.sort_indices(own, sort_keys=keys))
        # bits are given out within the shard; bit 0 is the missing source
        origins = own["origin"].combine_chunks().dictionary_encode()
        blank = origins.dictionary.index("").as_py()
        source = [0 if i == blank else i + 1 for i in origins.indices.to_pylist()]
        cluster = own["cluster"].combine_chunks().dictionary_encode().indices.to_pylist()
        local = best_fit(list(zip(own["words"].to_pylist(), source, cluster, strict=True)), capacity)
        first = own["shard"][0].as_py()
        bins = pa.array([first + shards * i for i in local], pa.int64())
        return own.select(["doc_id", "copy", "piece", "start_word", "words"]).append_column("bin", bins)

    return dealt.groupBy("shard").applyInArrow(
        fill, f"doc_id {kind}, copy long, piece long, start_word long, words long, bin long"
    )
