"""Embedding near-dedup by binary codes of randomly rotated vectors."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, forest, staged

_TILE_ROWS = 2048  # vectors on each side of a tile
_MOST_BITS = 20
_DOUBT = 1e-9  # chance that a bound misses a given pair


def usable(vector: Column) -> Column:
    """True for vectors that can have an angle: not null or zero, all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


# ---- codes ---------------------------------------------------------------------------


def rotation(dim: int, seed: int = 0) -> np.ndarray:
    """A random rotation (or reflection) of ``dim`` dimensions, the same for the same seed."""
    q, r = np.linalg.qr(np.random.default_rng((seed, dim)).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; their largest component is taken out first, so no square overflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def binary_codes(turned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed signs of rotated unit vectors, and the correction factor of each.

    The code stands for the unit vector of the signs over sqrt(dim); the factor is its
    inner product with the vector itself.
    """
    return np.packbits(turned > 0, axis=1), np.abs(turned).sum(axis=1) / math.sqrt(turned.shape[1])


def code_estimates(codes: np.ndarray, factors: np.ndarray, others: np.ndarray, z: float) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products of coded vectors with whole ones, and their half-widths.

    A vector is f * code + sqrt(1 - f^2) * rest, the rest a direction at right angles to
    the code that the random rotation makes uniform. So <code, other> / f estimates the
    product without bias, and the error is sqrt(1 - f^2) / f times the part of the other
    vector along that direction: normal to ``z`` deviations, and never above its length.
    """
    dim = others.shape[1]
    signs = np.unpackbits(codes, axis=1, count=dim).astype(np.float32) * 2 - 1
    g = (signs @ others.T.astype(np.float32)) / np.float32(math.sqrt(dim))
    f = np.clip(factors, 1e-6, 1)[:, None].astype(np.float32)
    rest = np.sqrt(np.maximum(1 - g * g, 0)) * np.sqrt(np.maximum(1 - f * f, 0))
    spread = min(1.0, z / math.sqrt(dim - 1)) if dim > 1 else 1.0
    # room for the single precision of this product
    return g / f, rest * spread / f + np.float32(1e-4)


def exact_cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosines of paired rows of original vectors, in double precision."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    y = y / np.abs(y).max(axis=1, keepdims=True)
    return (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1)))


# ---- cells ---------------------------------------------------------------------------


def flip_room(bits: int, dim: int, cosine: float, doubt: float) -> float:
    """How much squared length two vectors above ``cosine`` can differ by in ``bits`` coordinates.

    Their distance is at most sqrt(2 - 2 cosine), and the random rotation spreads it evenly:
    the share that falls on ``bits`` of ``dim`` coordinates is below the normal bound of the
    chi-square quantile (Laurent-Massart) but for ``doubt``, and never above one.
    """
    whole = 2 - 2 * cosine
    if bits >= dim:
        return whole
    t = math.log(2 / doubt)
    most = bits + 2 * math.sqrt(bits * t) + 2 * t
    others = dim - bits
    least = max(0.0, others - 2 * math.sqrt(others * t))
    return whole * most / (most + least)


def near_cells(turned: np.ndarray, bits: int, room: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The cell of each vector by its first ``bits`` signs, and further cells (row, cell).

    A vector has partners in another cell only across the coordinates whose signs differ,
    and the squares of its own coordinates there add up to at most ``room``. A pair of
    cells is searched from the smaller one.
    """
    head = turned[:, :bits]
    home = (head > 0).astype(np.int64) @ (1 << np.arange(bits, dtype=np.int64)) if bits else np.zeros(len(turned), np.int64)
    rows, masks, used = np.arange(len(turned)), np.zeros(len(turned), np.int64), np.zeros(len(turned))
    for k in range(bits):
        more = used + head[rows, k] ** 2
        fits = more <= room
        rows = np.concatenate([rows, rows[fits]])
        masks = np.concatenate([masks, masks[fits] | 1 << k])
        used = np.concatenate([used, more[fits]])
    cell = home[rows] ^ masks
    up = cell > home[rows]
    return home, rows[up], cell[up]


# ---- the join ------------------------------------------------------------------------


@dataclass(frozen=True)
class Tile:
    """One side of a tile: keys, numbers of copies, original vectors."""

    key: np.ndarray
    copies: np.ndarray
    x: np.ndarray


def tile_links(a: Tile, b: Tile | None, turn: np.ndarray, cosine: float, z: float) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs (row of a, row of b) of a tile; ``b`` None joins ``a`` with itself.

    Pairs whose estimate stays below the bound by more than its half-width are done with;
    the others are measured on the original vectors.
    """
    codes, factors = binary_codes(unit(a.x) @ turn.T)
    other = a if b is None else b
    found_a, found_b = [], []
    turned = unit(other.x) @ turn.T
    step = max(1, (1 << 22) // max(1, len(other.x)))
    for lo in range(0, len(a.x), step):
        estimate, width = code_estimates(codes[lo : lo + step], factors[lo : lo + step], turned, z)
        i, j = np.nonzero(estimate + width >= cosine)
        i += lo
        if b is None:
            i, j = i[i < j], j[i < j]
        for at in range(0, len(i), 1 << 18):
            p, q = i[at : at + (1 << 18)], j[at : at + (1 << 18)]
            linked = exact_cosines(a.x[p], other.x[q]) >= cosine
            found_a.append(p[linked])
            found_b.append(q[linked])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *found_a]), np.concatenate([none, *found_b])


def cosine_groups(
    vectors: DataFrame, *, cosine: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding",
    label_col: str = "label", tile_rows: int = _TILE_ROWS, doubt: float = _DOUBT, seed: int = 0,
) -> DataFrame:
    """Links of equally labelled vectors with a cosine of at least ``cosine`` (above 0).

    Returns vec_id, n_links (other rows linked with it), component_id (smallest vec_id
    reachable by links, its own included) and kept (vec_id = component_id), one row per
    row. Vectors that are null, empty, zero or hold null or non-finite components, and rows
    with a null label, link with nothing; vectors of different length neither. Repeated
    rows are vectors of their own. Rows without an id are linked like others, their
    component has the smallest id there is; where there is none it is null, and they are
    kept. An empty table gives an empty result; other columns are not read.

    Equal vectors count as one with its number of copies. Vectors are rotated at random;
    their leading signs name a cell, as many signs as leave ``tile_rows`` vectors to a
    cell of the largest label, and a vector is also sent to the cells it can have partners
    in. In a cell, tiles of ``tile_rows`` vectors a side compare binary codes with rotated
    vectors: unbiased estimates with confidence bounds leave few pairs, which are measured
    on the original vectors. A link is never wrong; each of both bounds misses a given one
    with a chance of at most ``doubt``. A tile returns numbers of links and a forest of
    them, not the pairs.
    """
    z = NormalDist().inv_cdf(1 - doubt / 2)
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v"),
        F.monotonically_increasing_id().alias("key"),
    )
    takes_part = F.col("label").isNotNull() & usable(F.transform("v", lambda x: x.cast("double")))
    rows = rows.withColumn("part", F.coalesce(takes_part, F.lit(False)))
    for h, salt in (("h1", 1), ("h2", 2)):
        # together 128 bits, which stand for the vector
        rows = rows.withColumn(h, F.when(F.col("part"), F.xxhash64(F.lit(salt), "v", F.lit(salt))))
    rows = staged(rows, "vectors")
    same = ["label", "h1", "h2"]
    single = rows.where("part").groupBy(*same).agg(
        F.min("key").alias("rep"), F.count("*").alias("copies"), F.min("vec_id").alias("least")
    )
    single = staged(single, "distinct-vectors")
    most = single.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits = min(_MOST_BITS, max(0, math.ceil(math.log2(max(1, most) / tile_rows))))

    label_type = rows.schema["label"].dataType.simpleString()
    reps = rows.where("part").join(single.select(F.col("rep").alias("key"), "copies"), "key")
    reps = reps.select("label", "key", "copies", F.transform("v", lambda x: x.cast("double")).alias("v"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = np.array([len(v) for v in batch.column("v")], np.int64)
            for dim in np.unique(dims).tolist():
                own = batch.take(pa.array(np.flatnonzero(dims == dim)))
                x = own.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                if dim not in turns:
                    turns[dim] = rotation(dim, seed)
                few = min(bits, dim)
                home, guest, cell = near_cells(unit(x) @ turns[dim].T, few, flip_room(few, dim, cosine, doubt))
                at = np.concatenate([np.arange(len(x)), guest])
                out = own.take(pa.array(at))
                # rows come as bytes, so that a copy of them costs no list
                raw = pa.array([r.tobytes() for r in x], pa.binary()).take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [
                        out.column("label"), out.column("key"), out.column("copies"), raw,
                        pa.array(np.full(len(at), dim, np.int32)), pa.array(np.concatenate([home, cell])),
                        pa.array(np.arange(len(at)) >= len(x)),
                    ],
                    names=["label", "key", "copies", "x", "dim", "cell", "guest"],
                )

    placed = reps.mapInArrow(
        place, f"label {label_type}, key long, copies long, x binary, dim int, cell long, guest boolean"
    )
    placed = staged(placed, "vector-cells")
    cells = ["label", "dim", "cell"]
    # slices of each cell for those at home and for guests; cells without either need no guests
    size = placed.groupBy(*cells).agg(
        F.ceil(F.count_if(~F.col("guest")) / tile_rows).cast("int").alias("homes"),
        F.ceil(F.count_if("guest") / tile_rows).cast("int").alias("guests"),
    )
    sliced = placed.join(size, cells).withColumn(
        "s", F.pmod(F.xxhash64("key"), F.when(F.col("guest"), F.col("guests")).otherwise(F.col("homes"))).cast("int")
    )

    def to_tiles(count: str, guest: int, first: Column, second: Column, side: Column) -> Column:
        tile = lambda t: F.struct(F.lit(guest).alias("with_guests"), first(t).alias("i"), second(t).alias("j"), side(t).alias("side"))
        return F.transform(F.filter(F.sequence(F.lit(0), F.greatest(F.col(count) - 1, F.lit(0))), lambda t: t < F.col(count)), tile)

    s = F.col("s")
    at_home = F.concat(
        to_tiles("homes", 0, lambda t: F.least(t, s), lambda t: F.greatest(t, s), lambda t: (s > t).cast("int")),
        to_tiles("guests", 1, lambda t: t, lambda t: s, lambda t: F.lit(1)),
    )
    as_guest = to_tiles("homes", 1, lambda t: s, lambda t: t, lambda t: F.lit(0))
    tile_key = [*cells, "with_guests", "i", "j"]
    tiles = sliced.select(
        *cells, "key", "copies", "x", F.explode(F.when(F.col("guest"), as_guest).otherwise(at_home)).alias("t")
    ).select(*cells, "t.*", "key", "copies", "x")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        for run in _runs(batches, tile_key):
            dim = run.column("dim")[0].as_py()
            if dim not in turns:
                turns[dim] = rotation(dim, seed)
            side = run.column("side").to_numpy()
            key, copies = run.column("key").to_numpy(), run.column("copies").to_numpy()
            x = np.frombuffer(b"".join(run.column("x").to_pylist()), np.float64).reshape(-1, dim)
            a, b = (Tile(key[side == k], copies[side == k], x[side == k]) for k in (0, 1))
            alone = run.column("with_guests")[0].as_py() == 0 and run.column("i")[0].as_py() == run.column("j")[0].as_py()
            if not len(a.key) or not (alone or len(b.key)):
                continue
            p, q = tile_links(a, None if alone else b, turns[dim], cosine, z)
            b = a if alone else b
            keys = np.concatenate([a.key, b.key])
            more = np.concatenate([np.bincount(p, b.copies[q], len(a.key)), np.bincount(q, a.copies[p], len(b.key))])
            root = forest(len(keys), p, q + len(a.key)) if not alone else np.tile(forest(len(a.key), p, q), 2)
            moved = (more > 0) | (root != np.arange(len(keys)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[moved]), pa.array(more[moved].astype(np.int64)), pa.array(keys[root[moved]])],
                names=["key", "more", "to"],
            )

    dealt = tiles.repartition(*tile_key).sortWithinPartitions(*tile_key)
    found = staged(dealt.mapInArrow(compare, "key long, more long, to long"), "tile-links")
    linked = found.groupBy("key").agg(F.sum("more").alias("more"))
    joined = components(found.select(F.col("key").alias("a"), F.col("to").alias("b")))
    ends = joined.select(F.col("node").alias("key"), "root").union(
        joined.select(F.col("root").alias("key"), "root").distinct()
    )
    least = single.select(F.col("rep").alias("key"), "least")
    smallest = ends.join(least, "key").groupBy("root").agg(F.min("least").alias("low"))
    group = ends.join(smallest, "root").select("key", "low")
    known = (
        single.select(*same, F.col("rep").alias("key"), "copies", "least")
        .join(linked, "key", "left").join(group, "key", "left")
        .select(
            *same,
            (F.coalesce("more", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.when(F.col("low").isNull(), F.col("least")).otherwise(F.col("low")).alias("component_id"),
        )
    )
    # a table of its own, so that the last join can split a vector with very many copies
    known = staged(known, "vector-groups")
    in_groups = rows.where("part").join(known, same).select("vec_id", "n_links", "component_id")
    alone = rows.where("NOT part").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return in_groups.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _runs(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[pa.RecordBatch]:
    """Runs of rows with equal ``by`` from sorted batches, each as one batch."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None

    def whole() -> pa.RecordBatch:
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = list(zip(*(batch.column(c).to_pylist() for c in by), strict=True))
        lo = 0
        for r in range(1, len(keys) + 1):
            if r < len(keys) and keys[r] == keys[lo]:
                continue
            if held and keys[lo] != last:
                yield whole()
                held = []
            held.append(batch.slice(lo, r - lo))
            last, lo = keys[lo], r
    if held:
        yield whole()


OP11_SQL = """
WITH RECURSIVE
e AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id
    AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach(a, b) AS (
  SELECT a, b FROM links
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
low AS (SELECT a, min(b) AS low FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a),
out AS (
  SELECT vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(low.low, vec_id)) AS component_id
  FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN low ON low.a = vec_id)
SELECT *, vec_id = component_id AS kept FROM out
"""
