"""Nearest neighbours by a block matrix join of int8 tiles."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import staged

_BLOCK = "dim int, block long, ids array<long>, vectors binary, codes binary, scales binary, errors binary"
_PARTS = ["ids", "vectors", "codes", "scales", "errors"]
_QUERY_ROWS, _CANDIDATE_ROWS = 1024, 4096
_RESIDENT_BYTES = 128 << 20  # of query blocks that one task holds, on average


def usable(vector: Column | str) -> Column:
    """True for vectors that take part: not null, not empty or zero, all components finite."""
    v = F.col(vector) if isinstance(vector, str) else vector
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, a scale per row, and how far (Euclidean) each row is from its code."""
    scale = np.abs(x).max(axis=1) / 127
    scale[scale == 0] = 1  # of components too small to divide
    codes = np.clip(np.rint(x / scale[:, None]), -127, 127).astype(np.int8)
    return codes, scale, np.linalg.norm(x - codes * scale[:, None], axis=1)


def distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances of paired rows; squares are added component by component."""
    total = np.zeros(len(x))
    for j in range(x.shape[1]):
        gap = x[:, j] - y[:, j]
        total += gap * gap
    return np.sqrt(total)


def tile_survivors(q: dict, c: dict, limit: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query row, candidate row) of a tile that may belong to the k nearest.

    The int8 product gives the distance between codes; the true one is off by at most
    the two quantisation errors. A pair survives when its least possible distance is not
    above the query's ``limit`` nor the k-th smallest largest-possible one of the tile.
    """
    # sums of int8 products stay far below 2^53, so this product is exact
    dots = q["codes"].astype(np.float64) @ c["codes"].astype(np.float64).T
    square = q["norms"][:, None] + c["norms"] - 2 * q["scales"][:, None] * c["scales"] * dots
    near = np.sqrt(np.maximum(square, 0))
    # room for the rounding of the double arithmetic above, at its largest near zero
    slack = q["errors"][:, None] + c["errors"] + 1e-7 * np.sqrt(q["norms"][:, None] + c["norms"])
    own = q["ids"][:, None] == c["ids"]
    most = np.where(own, np.inf, near + slack)
    if most.shape[1] > k:
        limit = np.minimum(limit, np.partition(most, k - 1, axis=1)[:, k - 1])
    return np.nonzero((near - slack <= limit[:, None]) & ~own)


def _blocks(vectors: DataFrame, rows: int) -> DataFrame:
    """Rows of one dimension packed into blocks of at most ``rows`` vectors."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.array([len(v) for v in batch.column("vector")])
            ids = batch.column("id").to_numpy()
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                x = np.array(batch.column("vector").take(pa.array(at)).flatten(), np.float64).reshape(-1, dim)
                for lo in range(0, len(at), rows):
                    part, own = x[lo : lo + rows], ids[at[lo : lo + rows]]
                    codes, scales, errors = quantise(part)
                    yield pa.RecordBatch.from_pylist(
                        [
                            {
                                "dim": int(dim),
                                "block": int(own[0]),
                                "ids": own.tolist(),
                                "vectors": part.tobytes(),
                                "codes": codes.tobytes(),
                                "scales": scales.tobytes(),
                                "errors": errors.tobytes(),
                            }
                        ],
                        schema=schema,
                    )

    schema = pa.schema(
        [("dim", pa.int32()), ("block", pa.int64()), ("ids", pa.list_(pa.int64()))]
        + [(n, pa.binary()) for n in ("vectors", "codes", "scales", "errors")]
    )
    return vectors.mapInArrow(build, _BLOCK)


def _unpacked(row: dict) -> dict:
    out = {
        "ids": np.asarray(row["ids"], np.int64),
        "x": np.frombuffer(row["vectors"], np.float64).reshape(-1, row["dim"]),
        "codes": np.frombuffer(row["codes"], np.int8).reshape(-1, row["dim"]),
        "scales": np.frombuffer(row["scales"], np.float64),
        "errors": np.frombuffer(row["errors"], np.float64),
    }
    out["norms"] = out["scales"] ** 2 * (out["codes"].astype(np.float64) ** 2).sum(axis=1)
    return out


def nearest_neighbours(vectors: DataFrame, is_query: Column, *, k: int = 10, id_col: str = "vec_id",
                       vector_col: str = "embedding", tasks: int | None = None,
                       resident_bytes: int = _RESIDENT_BYTES) -> DataFrame:
    """The k nearest rows of each query row by Euclidean distance, exactly.

    Queries are the rows where ``is_query``; candidates are all rows but those with the
    query's id. Vectors that are null, empty, zero, or hold null or non-finite components
    take no part, and only vectors of one length are compared. Rows are packed into
    blocks; every query block meets every candidate block in one tile. A tile's int8
    product bounds each distance, and only pairs that can still be among the k nearest
    are measured on the original vectors in double precision. A task holds the query blocks
    of one group, about ``resident_bytes`` with a heap for each query, and runs through its
    candidate blocks once; so the candidates are shuffled once for each group. The tasks'
    heaps are merged by a ranked window.

    Returns query_id, rank (from 1), vec_id, score: nearest first, ties to the smaller id,
    fewer than k rows where there are fewer candidates. Rows with a null id take no part.
    Repeated candidate rows each count. A repeated query row gives one answer. An empty
    table gives an empty result; other columns are not read.
    """
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"),
        F.transform(vector_col, lambda x: x.cast("double")).alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).where(usable("vector") & F.col("id").isNotNull())
    rows = staged(rows, "vectors")
    n = rows.count()
    spread = rows.repartition(max(1, math.ceil(n / _CANDIDATE_ROWS)), "id")
    candidates = staged(_blocks(spread.select("id", "vector"), _CANDIDATE_ROWS), "candidate-blocks")
    asked = rows.where("asks").dropDuplicates(["id"])
    m = asked.count()
    queries = asked.repartition(max(1, math.ceil(m / _QUERY_ROWS)), "id")
    queries = staged(_blocks(queries.select("id", "vector"), _QUERY_ROWS), "query-blocks")

    # query blocks in groups that a task can hold, several only for very many queries
    held = F.col("blocks") * _QUERY_ROWS * F.col("dim") * 9 / resident_bytes
    sizes = queries.groupBy("dim").agg(F.count("*").alias("blocks"))
    # one row for each length of vectors that are asked for
    sizes = F.broadcast(staged(sizes.select("dim", F.ceil(held).cast("int").alias("groups")), "query-groups"))
    # candidate blocks are dealt to lanes, and each query block is sent to every lane
    lanes = tasks or max(1, min(64, math.ceil(n / _CANDIDATE_ROWS)))
    asking = (
        queries.join(sizes, "dim")
        .withColumn("query", F.pmod(F.xxhash64("block"), "groups").cast("int"))
        .withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    )
    answering = (
        candidates.join(sizes, "dim")
        .withColumn("lane", F.pmod(F.xxhash64("block"), F.lit(lanes)).cast("int"))
        .withColumn("query", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
    )

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Tiles in order of (dim, query, lane), the group's query blocks ahead of the candidates."""
        askers: list[tuple[dict, list[list], np.ndarray]] = []
        now = None

        def meet(c: dict) -> None:
            for asker, heaps, limit in askers:
                at, to = tile_survivors(asker, c, limit, k)
                scores = distance(asker["x"][at], c["x"][to])
                # a heap holds its worst pair on top
                pairs = zip((-scores).tolist(), (-c["ids"][to]).tolist(), strict=True)
                for i, pair in zip(at.tolist(), pairs, strict=True):
                    if len(heaps[i]) < k:
                        heapq.heappush(heaps[i], pair)
                    elif pair > heaps[i][0]:
                        heapq.heapreplace(heaps[i], pair)
                    if len(heaps[i]) == k:
                        limit[i] = -heaps[i][0][0]

        def found() -> Iterator[pa.RecordBatch]:
            for asker, heaps, _ in askers:
                rows = [(int(i), -b, -a) for i, h in zip(asker["ids"], heaps, strict=True) for a, b in h]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[c] for r in rows], kind) for c, kind in enumerate((pa.int64(), pa.int64(), pa.float64()))],
                    names=["query_id", "vec_id", "score"],
                )

        for batch in batches:
            for part in range(batch.num_rows):
                row = batch.slice(part, 1).to_pylist()[0]
                block, place = _unpacked(row), (row["dim"], row["query"], row["lane"])
                if place != now:
                    yield from found()
                    askers, now = [], place
                if row["first"] == 0:
                    size = len(block["ids"])
                    askers.append((block, [[] for _ in range(size)], np.full(size, np.inf)))
                else:
                    meet(block)
        yield from found()

    def side(df: DataFrame, first: int) -> DataFrame:
        return df.select("dim", "query", "lane", F.lit(first).alias("first"), *_PARTS)

    tiles = side(asking, 0).union(side(answering, 1))
    dealt = tiles.repartition("dim", "query", "lane").sortWithinPartitions("dim", "query", "lane", "first")
    tops = dealt.mapInArrow(answer, "query_id long, vec_id long, score double")
    order = W.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = tops.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


OP8_SQL = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    sqrt(list_reduce(list_transform(list_zip(q.v, c.v), lambda x: (x[1] - x[2]) * (x[1] - x[2])),
      lambda a, b: a + b)) AS score
  FROM e q JOIN e c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 100 = 0),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM p)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""
