"""Trees on a binned feature table, many at a time, one aggregate a level.

Features are cut once into bins by their quantiles. A level of all trees is one pass over
the rows, which adds up a histogram for each open node, and one small group per node that
finds its best split. Trees of all folds, criteria and classes grow side by side, so a
cross-validation costs as many passes as a single fit.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, spread
from .passes import added_up

# ---- bins ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Bins:
    """Upper edges of the bins of each feature; the last bin is open."""

    edges: tuple[tuple[float, ...], ...]

    @property
    def most(self) -> int:
        return max((len(e) for e in self.edges), default=0) + 1

    def codes(self, x: np.ndarray) -> np.ndarray:
        """Bin numbers, one row per row of ``x``: how many edges a value exceeds."""
        out = np.empty(x.shape, np.uint16)
        for f, edges in enumerate(self.edges):
            out[:, f] = np.searchsorted(np.asarray(edges), x[:, f], "left")
        return out


def _edges(df: DataFrame, columns: Sequence, bins: int) -> list[tuple[float, ...]]:
    """Edges of at most ``bins`` bins of each column, below its largest value.

    A column of at most ``bins`` distinct values gets an edge at each of them, another one
    its distinct quantiles, from sketches merged in one aggregate.
    """
    ranks = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    row = df.agg(
        *[F.percentile_approx(c, ranks, F.lit(200 * bins)).alias(f"q{i}") for i, c in enumerate(columns)],
        *[F.max(c).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.approx_count_distinct(c, 0.02).alias(f"d{i}") for i, c in enumerate(columns)],
    ).first()
    found = [row[f"q{i}"] or [] for i in range(len(columns))]
    # the estimate bounds these sets
    few = [i for i in range(len(columns)) if row[f"d{i}"] <= 1.2 * bins]
    if few:
        values = df.agg(*[F.collect_set(columns[i]).alias(f"v{i}") for i in few]).first()
        for i in few:
            if len(values[f"v{i}"]) <= bins:
                found[i] = values[f"v{i}"]
    return [tuple(sorted({float(e) for e in q if e < row[f"m{i}"]})) for i, q in enumerate(found)]


def feature_bins(df: DataFrame, *, features: str = "features", bins: int = 64) -> Bins:
    """At most ``bins`` bins per entry of a feature vector, about equally full."""
    size = df.select(F.size(vector_to_array(features)).alias("n")).agg(F.max("n")).first()[0] or 0
    arrays = df.select(vector_to_array(features).alias("x"))
    return Bins(tuple(_edges(arrays, [F.col("x")[i] for i in range(size)], bins)) if size else ())


# ---- trees ---------------------------------------------------------------------------


@dataclass
class Tree:
    """Nodes by number; ``feature`` is -1 in a leaf. Rows with a bin up to ``upto`` go left.

    ``totals`` holds the sums of a node's rows, from which its value comes, also where the
    tree is cut off above its leaves.
    """

    feature: list[int] = field(default_factory=lambda: [-1])
    upto: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    depth: list[int] = field(default_factory=lambda: [0])
    gain: list[float] = field(default_factory=lambda: [0.0])
    totals: list[np.ndarray | None] = field(default_factory=lambda: [None])

    def split(self, node: int, feature: int, upto: int, gain: float, left: np.ndarray, right: np.ndarray) -> None:
        self.feature[node], self.upto[node], self.gain[node] = feature, upto, gain
        self.left[node] = len(self.feature)
        for totals in (left, right):
            self.feature.append(-1)
            self.upto.append(0)
            self.left.append(0)
            self.gain.append(0.0)
            self.depth.append(self.depth[node] + 1)
            self.totals.append(totals)

    def shape(self) -> Tree:
        """The nodes as arrays, without their sums: what a task needs to place rows."""
        return Tree(*(np.asarray(a, np.int32) for a in (self.feature, self.upto, self.left, self.depth)), [], [])

    def leaves(self, codes: np.ndarray, depth: int | None = None) -> np.ndarray:
        """The node where each row ends, at most ``depth`` levels down."""
        feature, upto, left, deep = map(np.asarray, (self.feature, self.upto, self.left, self.depth))
        at = np.zeros(len(codes), np.int64)
        moving = np.flatnonzero(feature[at] >= 0)
        while len(moving) and (depth is None or deep[at[moving[0]]] < depth):
            node = at[moving]
            at[moving] = left[node] + (codes[moving, feature[node]] > upto[node])
            moving = moving[feature[at[moving]] >= 0]
        return at


# ---- criteria ------------------------------------------------------------------------


@dataclass(frozen=True)
class Criterion:
    """What a histogram cell adds up, and what is lost in a node.

    A cell has ``slots`` of ``width`` sums each. ``impurity`` takes sums with the two last
    axes (slots, width) and gives the total loss; ``value`` gives a node's prediction. Both
    sides of a split need ``least`` of the sum ``weight``, and the split a gain above
    ``least_gain``, where that is given.
    """

    slots: int
    width: int
    impurity: Callable[[np.ndarray], np.ndarray]
    value: Callable[[np.ndarray], np.ndarray | float]
    weight: int = 0
    least: float = 1.0
    least_gain: float | None = None


def _square_loss(a: np.ndarray) -> np.ndarray:
    n = np.maximum(a[..., 0, 0], 1e-300)
    return np.maximum(a[..., 0, 2] - a[..., 0, 1] ** 2 / n, 0)


def _mean(a: np.ndarray) -> float:
    return float(a[0, 1] / a[0, 0]) if a[0, 0] else 0.0


def squared_error() -> Criterion:
    """Sums of 1, y, y^2; a leaf predicts the mean."""
    return Criterion(1, 3, _square_loss, _mean)


def _medians(a: np.ndarray) -> np.ndarray:
    """Median of cells with counts and sums by label bin: between its two middle bins."""
    count, total = a[..., 0], a[..., 1]
    through = np.cumsum(count, axis=-1)
    n = through[..., -1:]
    middle = total / np.where(count > 0, count, 1)
    low = np.argmax(2 * through >= n, axis=-1)[..., None]
    high = np.argmax(2 * through > n, axis=-1)[..., None]
    return (np.take_along_axis(middle, low, -1) + np.take_along_axis(middle, high, -1))[..., 0] / 2


def absolute_error(label_bins: int) -> Criterion:
    """Counts and sums by bin of the label; a leaf predicts the median.

    Exact where every bin holds one value; otherwise values inside the median's bin count
    as their mean.
    """

    def loss(a: np.ndarray) -> np.ndarray:
        return np.abs(a[..., 1] - a[..., 0] * _medians(a)[..., None]).sum(axis=-1)

    return Criterion(label_bins, 2, loss, lambda a: float(_medians(a)))


def _entropy(a: np.ndarray) -> np.ndarray:
    c = a[..., 0]
    n = np.maximum(c.sum(axis=-1, keepdims=True), 1e-300)
    return -(c * np.log2(np.where(c > 0, c / n, 1))).sum(axis=-1)


def _gini(a: np.ndarray) -> np.ndarray:
    c = a[..., 0]
    n = c.sum(axis=-1)
    return n - (c**2).sum(axis=-1) / np.maximum(n, 1e-300)


def _shares(a: np.ndarray) -> np.ndarray:
    return a[:, 0] / max(a[:, 0].sum(), 1e-300)


def class_counts(classes: int, kind: str) -> Criterion:
    """Counts by class, with ``gini`` or ``entropy`` loss; a leaf predicts the shares."""
    return Criterion(classes, 1, {"gini": _gini, "entropy": _entropy}[kind], _shares)


def softmax_gradients(l2: float, least: float) -> Criterion:
    """Sums of 1, g, h, the slopes and curvatures of the log loss.

    A node loses -G^2 / (H + l2) and steps by -G / (H + l2).
    """
    return Criterion(
        1, 3, lambda a: -(a[..., 0, 1] ** 2) / (a[..., 0, 2] + l2), lambda a: float(-a[0, 1] / (a[0, 2] + l2)),
        weight=2, least=least, least_gain=1e-6,
    )


def improvement(parts: np.ndarray) -> np.ndarray:
    """Score of splits by the difference of the two means: n_l n_r / n (m_l - m_r)^2.

    ``parts`` has the sums of both sides on its first axis. This is the loss of squared
    error that a split removes, worked out without the squares of the labels.
    """
    n, s = parts[..., 0, 0], parts[..., 0, 1]
    both = n[0] * n[1]
    gap = n[1] * s[0] - n[0] * s[1]
    return gap**2 / np.maximum(both * (n[0] + n[1]), 1e-300)


_SIDES = 1 << 14  # sums of features whose splits are tried together


def best_split(
    criterion: Criterion, hist: np.ndarray, allowed: Sequence[int], by_means: bool = False
) -> tuple[int, int, float, np.ndarray, np.ndarray] | None:
    """(feature, bin up to which rows go left, gain, sums left, sums right) of a node.

    ``hist`` is (feature, bin, slot, width). Gains count to nine digits of the best; of
    equal ones the first feature's first bin wins, so a sum in another order of the rows
    finds the same split.
    """
    # a feature that may not be split on may have no sums
    whole = hist[allowed[0]].sum(axis=0)
    lost = float(criterion.impurity(whole))
    rows = whole[:, 0].sum()
    spent = criterion.least_gain is None and lost <= 1e-12 * max(1.0, rows)
    if spent or hist.shape[1] < 2:
        return None

    def sides(some: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
        left = np.cumsum(hist[some], axis=1)[:, :-1]
        right = whole - left
        # what is left over of a sum that was taken away whole
        right[np.abs(right) < 1e-12 * np.abs(whole)] = 0
        return left, right

    # few features at a time: the sides of all of them may be many times the histogram
    gain = np.full((len(hist), hist.shape[1] - 1), -np.inf)
    together = max(1, _SIDES // hist[0].size)
    for lo in range(0, len(allowed), together):
        some = np.asarray(allowed[lo : lo + together])
        left, right = sides(some)
        ok = np.ones(left.shape[:2], bool)
        for side in (left, right):
            ok &= side[..., 0].sum(axis=-1) >= 1
            ok &= side[..., criterion.weight].sum(axis=-1) >= criterion.least
        if ok.any():
            l, r = left[ok], right[ok]
            found = np.full(ok.shape, -np.inf)
            found[ok] = improvement(np.stack([l, r])) if by_means else lost - criterion.impurity(l) - criterion.impurity(r)
            gain[some] = found
    if not np.isfinite(gain).any():
        return None
    if criterion.least_gain is not None and gain.max() <= criterion.least_gain:
        return None
    f, b = np.unravel_index(np.argmax(np.round(gain / max(gain.max(), 1e-9 * abs(lost)), 9)), gain.shape)
    left, right = sides([f])
    return int(f), int(b), float(gain[f, b]), left[0, b], right[0, b]


# ---- growing -------------------------------------------------------------------------


@dataclass(frozen=True)
class Plan:
    """One tree to grow: rows of ``fold`` are left out, ``target`` names a class or label."""

    fold: int = -1
    target: int = 0
    bootstrap: int | None = None


# (codes, label, further columns) of a batch -> slot and sums of each row for a plan
Sums = Callable[[Mapping[str, np.ndarray], Plan], tuple[np.ndarray | None, list[np.ndarray]]]


def mixed(h: np.ndarray, seed: int) -> np.ndarray:
    """Uniform numbers in [0, 1) from 64-bit keys and a seed (splitmix64)."""
    with np.errstate(over="ignore"):
        z = h.view(np.uint64) + np.uint64(0x9E3779B97F4A7C15) * np.uint64(seed + 1)
        for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            z = (z ^ (z >> np.uint64(shift))) * np.uint64(by)
        return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / 2.0**53


def draws(h: np.ndarray, seed: int) -> np.ndarray:
    """How often a bootstrap sample holds each row: Poisson numbers of mean one."""
    at_most = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])
    return np.searchsorted(at_most, mixed(h, seed), "right").astype(np.float64)


def binned(df: DataFrame, bins: Bins, *, key: str, label: str = "label", features: str = "features",
           carry: Sequence[str] = ()) -> DataFrame:
    """(h, y, fold, codes, *carry): the narrow table that trees grow on."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            codes = bins.codes(x)
            packed = pa.array([r.tobytes() for r in codes], pa.binary())
            names = [c for c in batch.schema.names if c != "x"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), packed], names=[*names, "codes"])

    fold = F.col("fold").cast("int") if "fold" in df.columns else F.lit(-1)
    rows = df.select(
        F.xxhash64(key).alias("h"), F.col(label).cast("double").alias("y"), fold.alias("fold"), *carry,
        vector_to_array(features).alias("x"),
    )
    further = "".join(f", {c} {rows.schema[c].dataType.simpleString()}" for c in carry)
    return rows.mapInArrow(code, f"h long, y double, fold int{further}, codes binary")


def _columns(batch: pa.RecordBatch, features: int) -> dict[str, np.ndarray]:
    out = {
        c: batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names if c not in ("codes", "margins")
    }
    out["codes"] = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint16).reshape(-1, features)
    if "margins" in batch.schema.names:
        out["margins"] = np.frombuffer(b"".join(batch.column("margins").to_pylist()), np.float64).reshape(batch.num_rows, -1)
    return out


_CELLS = 1 << 22  # sums that a task holds at a time
_ROWS = 1 << 18  # rows that a task holds for several blocks of nodes


def _allowed(seed: int, tree: int, node: int, features: int, few: int | None) -> np.ndarray:
    """Features that a node may split on, ``few`` drawn ones or all."""
    if not few:
        return np.arange(features)
    return np.random.default_rng((seed, tree, node)).permutation(features)[:few]


def _parts(batches: Iterator[pa.RecordBatch], features: int) -> Iterator[list[dict[str, np.ndarray]]]:
    """Batches in lists of about ``_ROWS`` rows."""
    held: list[dict[str, np.ndarray]] = []
    for batch in batches:
        held.append(_columns(batch, features))
        if sum(len(c["codes"]) for c in held) >= _ROWS:
            yield held
            held = []
    if held:
        yield held


def _at_once(table: DataFrame, filled_cells: Callable, best: Callable, per_node: int, width: int) -> list[dict]:
    """Splits of one block of nodes: a task hands on the sums of a node as one row, which meet once."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
        for block, filled, totals in filled_cells(batches):
            at, cell = np.divmod(filled, per_node)
            for i in np.unique(at):
                lo, hi = np.searchsorted(at, [i, i + 1])
                hist = np.zeros((per_node, width))
                for j in range(width):
                    hist[cell[lo:hi], j] = totals[j][lo:hi]
                yield {"{} {}".format(*block[i]): hist}

    def finish(name: str, hist: np.ndarray) -> np.ndarray:
        f, b, gain, left, right = best(*map(int, name.split()), hist)
        return np.concatenate([[f, b, gain, np.size(left)], np.ravel(left), np.ravel(right)])

    out = []
    for name, row in added_up(table, make, finish).items():
        t, node = map(int, name.split())
        left, right = np.split(row[4:], [int(row[3])])
        out.append({"tree": t, "node": node, "feature": int(row[0]), "upto": int(row[1]), "gain": float(row[2]),
                    "left": left, "right": right})
    return out


def _by_cells(table: DataFrame, filled_cells: Callable, best: Callable, per_node: int, width: int) -> list:
    """Splits of many blocks of nodes: cells are summed one by one, then meet by node."""
    names = [f"v{j}" for j in range(width)]

    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, filled, totals in filled_cells(batches):
            which = np.array(block, np.int64).reshape(-1, 2)
            for lo in range(0, len(filled), _CELLS // 16):
                some = filled[lo : lo + _CELLS // 16]
                at, cell = np.divmod(some, per_node)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(which[at, 0]), pa.array(which[at, 1]), pa.array(cell)]
                    + [pa.array(v[lo : lo + _CELLS // 16]) for v in totals],
                    names=["tree", "node", "cell", *names],
                )

    def split(pdf: pd.DataFrame) -> pd.DataFrame:
        hist = np.zeros((per_node, width))
        hist[pdf["cell"].to_numpy()] = pdf[names].to_numpy()
        t, node = int(pdf["tree"].iloc[0]), int(pdf["node"].iloc[0])
        f, b, gain, left, right = best(t, node, hist)
        row = (t, node, f, b, gain, np.ravel(left).tolist(), np.ravel(right).tolist())
        return pd.DataFrame([row], columns=["tree", "node", "feature", "upto", "gain", "left", "right"])

    kinds = ", ".join(f"{n} double" for n in names)
    cells = table.mapInArrow(histogram, f"tree long, node long, cell long, {kinds}")
    total = cells.groupBy("tree", "node", "cell").agg(*[F.sum(n).alias(n) for n in names])
    return total.groupBy("tree", "node").applyInPandas(
        split, "tree long, node long, feature int, upto int, gain double, left array<double>, right array<double>"
    ).collect()


def grow(
    table: DataFrame, bins: Bins, plans: Sequence[Plan], criterion: Criterion, sums: Sums, *,
    max_depth: int, features_per_split: int | None = None, by_means: bool = False, seed: int = 0,
) -> list[Tree]:
    """All trees of ``plans``, level by level.

    Each level reads ``table`` once. A task adds up the cells (tree, node, feature, bin,
    slot) of its rows, the cells of all tasks are summed, and each node's group of cells,
    whose size the bins bound, gives its best split. The driver sees one row a node.
    """
    n_features, n_bins = len(bins.edges), bins.most
    trees = [Tree() for _ in plans]
    slots, width = criterion.slots, criterion.width
    per_node = n_features * n_bins * slots
    open_ = [(t, 0) for t in range(len(plans))]
    level = 0
    # a tree without a split still needs the sums of its root
    while open_ and (level < max_depth or not level):
        # open nodes, in blocks whose cells are bounded whatever the depth
        many = max(1, _CELLS // (per_node * width))
        blocks = [open_[i : i + many] for i in range(0, len(open_), many)]
        tried = {x: _allowed(seed, *x, n_features, features_per_split) for x in open_} if features_per_split else {}

        shapes = {t: trees[t].shape() for t in {t for t, _ in open_}}

        def filled_cells(batches: Iterator[pa.RecordBatch], blocks=blocks, tried=tried, trees=shapes) -> Iterator[tuple]:
            """(block, cells with rows, their sums) of a task, block by block."""
            offsets = np.arange(n_features) * n_bins
            # one block reads batch by batch; several ones share parts of bounded size
            for kept in _parts(batches, n_features) if len(blocks) > 1 else [(_columns(b, n_features) for b in batches)]:
                dense = len(blocks) == 1 or sum(len(c["codes"]) for c in kept) * n_features > many * per_node
                placed: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
                for block in blocks:
                    place = {t: np.full(len(trees[t].feature), -1, np.int64) for t, _ in block}
                    for i, (t, node) in enumerate(block):
                        place[t][node] = i
                    split_on = np.array([tried.get(x, np.arange(n_features)) for x in block])
                    cells = np.zeros((width, len(block) * per_node)) if dense else []
                    for c, cols in enumerate(kept):
                        codes = cols["codes"]
                        for t in place:
                            if (c, t) not in placed:
                                w = np.where(cols["fold"] == plans[t].fold, 0.0, 1.0) if plans[t].fold >= 0 else np.ones(len(codes))
                                if plans[t].bootstrap is not None:
                                    w *= draws(cols["h"], plans[t].bootstrap)
                                drawn = np.flatnonzero(w > 0)
                                found = drawn, w[drawn], trees[t].leaves(codes[drawn])
                                if len(blocks) > 1 and block[-1][0] == t:
                                    # the tree may go on in the next block
                                    placed[c, t] = found
                            else:
                                found = placed[c, t]
                            drawn, w, leaf = found
                            at = place[t][leaf]
                            here = np.flatnonzero(at >= 0)
                            at, own = at[here], drawn[here]
                            slot, values = sums(cols, plans[t])
                            on = split_on[at]
                            cell = (at[:, None] * n_features * n_bins + offsets[on] + codes[own[:, None], on]) * slots
                            if slot is not None:
                                cell += slot[own, None]
                            flat = cell.ravel()
                            heavy = [np.repeat(w[here] * v[own], on.shape[1]) for v in values]
                            if not dense:
                                # fewer entries than cells
                                seen, inverse = np.unique(flat, return_inverse=True)
                                cells.append((seen, [np.bincount(inverse, h, len(seen)) for h in heavy]))
                                continue
                            for j, h in enumerate(heavy):
                                cells[j] += np.bincount(flat, h, cells.shape[1])
                    placed = {k: v for k, v in placed.items() if k[1] == block[-1][0]}
                    if dense:
                        filled = np.flatnonzero(cells[0])
                        totals = [cells[j, filled] for j in range(width)]
                    else:
                        filled = np.concatenate([np.zeros(0, np.int64), *(s for s, _ in cells)])
                        totals = [np.concatenate([np.zeros(0), *(v[j] for _, v in cells)]) for j in range(width)]
                    yield block, filled, totals

        def best(t: int, node: int, hist: np.ndarray) -> tuple:
            hist = hist.reshape(n_features, n_bins, slots, width)
            allowed = _allowed(seed, t, node, n_features, features_per_split)
            found = best_split(criterion, hist, allowed, by_means)
            return found or (-1, 0, 0.0, hist[allowed[0]].sum(axis=0), np.zeros(0))

        find = _at_once if len(blocks) == 1 else _by_cells
        found = find(table, filled_cells, best, per_node, width)
        open_ = []
        for r in sorted(found, key=lambda r: (r["tree"], r["node"])):
            tree = trees[r["tree"]]
            left = np.array(r["left"]).reshape(slots, width)
            if r["feature"] < 0:
                tree.totals[r["node"]] = left
                continue
            right = np.array(r["right"]).reshape(slots, width)
            tree.totals[r["node"]] = left + right
            if max_depth:
                tree.split(r["node"], r["feature"], r["upto"], r["gain"], left, right)
                open_ += [(r["tree"], tree.left[r["node"]]), (r["tree"], tree.left[r["node"]] + 1)]
        level += 1
    return trees


# ---- models --------------------------------------------------------------------------


def _scored(df: DataFrame, score: Callable[[np.ndarray], dict[str, np.ndarray]], kinds: Mapping[str, str],
            features: str = "features") -> DataFrame:
    """``df`` with the columns that ``score`` gives for its feature vectors."""
    @F.pandas_udf(", ".join(f"{n} {k}" for n, k in kinds.items()))
    def run(x: pd.Series) -> pd.DataFrame:
        found = score(np.stack(x.to_numpy()).astype(np.float64)) if len(x) else {n: [] for n in kinds}
        return pd.DataFrame({n: list(v) if np.ndim(v) > 1 else v for n, v in found.items()})

    whole = df.withColumn("_tree_score", run(vector_to_array(features)))
    return whole.select(*[F.col(f"`{c}`") for c in df.columns], *[F.col("_tree_score")[n].alias(n) for n in kinds])


@dataclass(frozen=True)
class TreeModel:
    """A regression tree; predictions may be cut off at a ``depth``."""

    bins: Bins
    tree: Tree
    criterion: Criterion
    shift: float = 0.0
    depth: int | None = None

    def _values(self) -> np.ndarray:
        return np.array([self.criterion.value(t) + self.shift for t in self.tree.totals])

    def transform(self, df: DataFrame) -> DataFrame:
        values = self._values()

        def score(x: np.ndarray) -> dict[str, np.ndarray]:
            at = self.tree.leaves(self.bins.codes(x), self.depth)
            return {"prediction": values[at], "leaf": at}

        return _scored(df, score, {"prediction": "double", "leaf": "long"})

    def nodes(self, spark) -> DataFrame:
        """(node, feature, edge, gain, rows, value), one row per node."""
        t, values = self.tree, self._values()
        edge = [self.bins.edges[f][b] if f >= 0 else None for f, b in zip(t.feature, t.upto, strict=True)]
        rows = [float(a[:, 0].sum()) for a in t.totals]
        data = zip(range(len(rows)), t.feature, edge, map(float, t.gain), rows, map(float, values), strict=True)
        return spark.createDataFrame(list(data), "node int, feature int, edge double, gain double, rows double, value double")


CRITERIA = ("squared_error", "friedman_mse", "absolute_error")


def _label_sums(criterion: str, label_edges: tuple[float, ...], shift: float) -> Sums:
    """The sums of a regression criterion; labels are moved by their mean against cancellation."""
    edges = np.asarray(label_edges)

    def sums(cols, plan):
        y = cols["y"] - shift
        if criterion == "absolute_error":
            return np.searchsorted(edges, cols["y"], "left"), [np.ones(len(y)), y]
        return None, [np.ones(len(y)), y, y * y]

    return sums


def _regression(criterion: str, df: DataFrame, label: str, bins: int) -> tuple[Criterion, Sums, float]:
    if criterion not in CRITERIA:
        raise ValueError(f"no criterion {criterion!r}; there are {', '.join(CRITERIA)}")
    shift = float(df.agg(F.avg(F.col(label).cast("double"))).first()[0] or 0.0)
    edges = _edges(df, [F.col(label).cast("double")], bins)[0] if criterion == "absolute_error" else ()
    made = absolute_error(len(edges) + 1) if criterion == "absolute_error" else squared_error()
    return made, _label_sums(criterion, edges, shift), shift


@dataclass(frozen=True)
class RegressionTree:
    """A tree for a number, by squared error, improvement score (``friedman_mse``) or absolute error.

    ``bins`` bounds the split places of a feature, ``label_bins`` the values that absolute
    error tells apart; on tables with no more distinct values the splits are exact.
    """

    key: str
    max_depth: int = 8
    criterion: str = "squared_error"
    bins: int = 64
    label_bins: int = 256

    def fit(self, df: DataFrame) -> TreeModel:
        family = tree_family(df, [self.max_depth], [self.criterion], key=self.key, bins=self.bins, label_bins=self.label_bins)
        return family[self.criterion][0]


def tree_family(
    df: DataFrame, depths: Sequence[int], criteria: Sequence[str], *, key: str, folds: int = 0, bins: int = 64,
    label_bins: int = 256,
) -> dict[str, list[TreeModel]]:
    """For each criterion the tree of all rows, and then those without each fold (column ``fold``).

    Trees are grown to the largest depth: the shallower ones are their upper parts. All
    folds grow in the same passes.
    """
    cuts = feature_bins(df, bins=bins)
    table = spread(binned(df, cuts, key=key))
    plans = [Plan(fold=f) for f in range(-1, folds)]
    out = {}
    for name in criteria:
        made, sums, shift = _regression(name, df, "label", label_bins)
        trees = grow(table, cuts, plans, made, sums, max_depth=max(depths), by_means=name == "friedman_mse")
        out[name] = [TreeModel(cuts, t, made, shift, max(depths)) for t in trees]
    return out


def tree_grid(
    df: DataFrame, depths: Sequence[int], criteria: Sequence[str] = CRITERIA, *, key: str, folds: int = 5,
    bins: int = 64, label_bins: int = 256,
) -> DataFrame:
    """R2 of every criterion and depth by fold: (criterion, max_depth, scores, mean_score, sd_score).

    ``df`` holds ``key``, ``features`` and ``label``. Folds are contiguous in key order; a
    criterion's trees of all folds and depths grow together, and one pass scores each fold
    with the trees that have not seen it.
    """
    from .learning import with_folds

    table = cut(with_folds(df.select(key, "features", "label"), folds, key=key))
    family = tree_family(table, depths, criteria, key=key, folds=folds, bins=bins, label_bins=label_bins)
    cuts = next(iter(family.values()))[0].bins
    options = [(c, d) for c in criteria for d in depths]
    values = {c: [m._values() for m in family[c]] for c in criteria}

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = _columns(batch, len(cuts.edges))
            out = np.zeros((len(options), batch.num_rows))
            for f in range(folds):
                own = np.flatnonzero(cols["fold"] == f)
                for o, (c, d) in enumerate(options):
                    out[o, own] = values[c][f + 1][family[c][f + 1].tree.leaves(cols["codes"][own], d)]
            for o in range(len(options)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(batch.num_rows, o, np.int32)), batch.column("fold"), batch.column("y"), pa.array(out[o])],
                    names=["option", "fold", "y", "prediction"],
                )

    scored = binned(table, cuts, key=key).mapInArrow(predict, "option int, fold int, y double, prediction double")
    err = F.col("y") - F.col("prediction")
    r2 = (1 - F.try_divide(F.avg(err * err), F.var_pop("y"))).alias("r2")
    found = {(r["option"], r["fold"]): r["r2"] for r in scored.groupBy("option", "fold").agg(r2).collect()}
    rows = []
    for o, (c, d) in enumerate(options):
        scores = [found.get((o, f)) for f in range(folds)]
        known = [s for s in scores if s is not None]
        mean = sum(known) / len(known) if known else None
        sd = math.sqrt(sum((s - mean) ** 2 for s in known) / len(known)) if known else None
        rows.append((c, d, scores, mean, sd))
    rows.sort(key=lambda r: (r[3] is None, -(r[3] or 0.0), r[0], r[1]))
    return df.sparkSession.createDataFrame(
        rows, "criterion string, max_depth int, scores array<double>, mean_score double, sd_score double"
    )


# ---- classes -------------------------------------------------------------------------


def _classes(df: DataFrame, label: str = "label") -> int:
    """Number of classes 0, 1, ..., whose largest label is read from the rows."""
    return int(df.agg(F.max(F.col(label))).first()[0] or 0) + 1


def _called(p: np.ndarray) -> dict[str, np.ndarray]:
    return {"prediction": p.argmax(axis=1).astype(np.float64), "probability": p}


@dataclass(frozen=True)
class ForestModel:
    """Class shares averaged over trees; a single tree is a forest of one."""

    bins: Bins
    trees: list[Tree]
    criterion: Criterion

    def transform(self, df: DataFrame) -> DataFrame:
        values = [np.array([_shares(t) for t in tree.totals]) for tree in self.trees]

        def score(x: np.ndarray) -> dict[str, np.ndarray]:
            codes = self.bins.codes(x)
            return _called(np.mean([v[t.leaves(codes)] for t, v in zip(self.trees, values, strict=True)], axis=0))

        return _scored(df, score, {"prediction": "double", "probability": "array<double>"})


@dataclass(frozen=True)
class ClassForest:
    """Trees for a class label by ``gini`` or ``entropy``.

    One tree sees all rows and features. More trees see a bootstrap sample each, drawn by
    the row's key, and the square root of the features at each split.
    """

    key: str
    criterion: str = "gini"
    trees: int = 1
    max_depth: int = 8
    bins: int = 64
    seed: int = 0

    def fit(self, df: DataFrame) -> ForestModel:
        cuts = feature_bins(df, bins=self.bins)
        table = spread(binned(df, cuts, key=self.key))
        made = class_counts(_classes(df), self.criterion)
        plans = [Plan(bootstrap=self.seed * 100_003 + t if self.trees > 1 else None) for t in range(self.trees)]
        few = max(1, int(math.sqrt(len(cuts.edges)))) if self.trees > 1 else None
        grown = grow(
            table, cuts, plans, made, lambda cols, plan: (cols["y"].astype(np.int64), [np.ones(len(cols["y"]))]),
            max_depth=self.max_depth, features_per_split=few, seed=self.seed,
        )
        return ForestModel(cuts, grown, made)


# ---- boosting ------------------------------------------------------------------------

_HELD = 256 << 20  # bytes of rows that one task may keep


@dataclass(frozen=True)
class Rows:
    """All rows of a table, held by one task."""

    codes: np.ndarray
    y: np.ndarray
    fold: np.ndarray

    @staticmethod
    def of(batches: Iterator[pa.RecordBatch], features: int) -> Rows:
        """The rows in the order of their keys' hashes, however they have come."""
        parts = [_columns(b, features) for b in batches]
        if not parts:
            return Rows(np.zeros((0, features), np.uint16), np.zeros(0), np.zeros(0, np.int32))
        h, codes, y, fold = (np.concatenate([p[c] for p in parts]) for c in ("h", "codes", "y", "fold"))
        order = np.lexsort((y, h))
        return Rows(codes[order], y[order], fold[order])

    @staticmethod
    def width(features: int, margins: int) -> int:
        """Bytes of a row: codes, hash, label, fold, and the margin, probability and place for each tree of a round,
        twice while they are put together or renewed."""
        return 2 * (2 * features + 20 + 20 * margins)


def _grown_here(
    rows: Rows, widths: Sequence[int], plans: Sequence[Plan], criterion: Criterion,
    slopes: Callable[[Plan, slice], tuple[np.ndarray, np.ndarray]], max_depth: int,
) -> tuple[list[Tree], list[np.ndarray]]:
    """What :func:`grow` gives, from rows that are held, and the leaf of each row in each tree."""
    n_features, most = len(widths), max(widths)
    starts = np.concatenate([[0], np.cumsum(widths)])
    trees = [Tree() for _ in plans]
    place = [np.zeros(len(rows.y), np.int32) for _ in plans]
    open_ = [(t, 0) for t in range(len(plans))]
    level = 0
    while open_ and (level < max_depth or not level):
        hist = np.zeros((len(open_), starts[-1], criterion.width))
        first = 0
        for t, plan in enumerate(plans):
            nodes = [node for u, node in open_[first:] if u == t]
            if not nodes:
                continue
            at_node = np.full(len(trees[t].feature), -1, np.int64)
            at_node[nodes] = np.arange(len(nodes))
            for lo in range(0, len(rows.y), _ROWS):
                part = slice(lo, lo + _ROWS)
                at = at_node[place[t][part]]
                if plan.fold >= 0:
                    at[rows.fold[part] == plan.fold] = -1
                here = np.flatnonzero(at >= 0)
                at = at[here]
                g, h = (v[here] for v in slopes(plan, part))
                for f, width in enumerate(widths):
                    cell = at * width + rows.codes[part, f][here]
                    own = hist[first : first + len(nodes), starts[f] : starts[f + 1]]
                    for j, v in enumerate((None, g, h)):
                        own[..., j] += np.bincount(cell, v, len(nodes) * width).reshape(len(nodes), width)
            first += len(nodes)
        following = []
        for i, (t, node) in enumerate(open_):
            full = np.zeros((n_features, most, 1, criterion.width))
            for f, width in enumerate(widths):
                full[f, :width, 0] = hist[i, starts[f] : starts[f + 1]]
            found = best_split(criterion, full, np.arange(n_features))
            if not found:
                trees[t].totals[node] = full[0].sum(axis=0)
                continue
            f, upto, gain, left, right = found
            trees[t].totals[node] = left + right
            if max_depth:
                trees[t].split(node, f, upto, gain, left, right)
                following += [(t, trees[t].left[node]), (t, trees[t].left[node] + 1)]
        for t in {t for t, _ in following}:
            feature, upto, left = (np.asarray(a, np.int32) for a in (trees[t].feature, trees[t].upto, trees[t].left))
            for lo in range(0, len(rows.y), _ROWS):
                at = place[t][lo : lo + _ROWS]
                moving = np.flatnonzero(feature[at] >= 0)
                node = at[moving]
                at[moving] = left[node] + (rows.codes[lo + moving, feature[node]] > upto[node])
        open_ = following
        level += 1
    return trees, place


def softmax(margins: np.ndarray) -> np.ndarray:
    e = np.exp(margins - margins.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass(frozen=True)
class BoostedModel:
    """Margins of all classes: their start and the steps of every round's trees."""

    bins: Bins
    start: np.ndarray
    rounds: list[list[tuple[Tree, np.ndarray]]]

    def margins(self, codes: np.ndarray) -> np.ndarray:
        out = np.tile(self.start, (len(codes), 1))
        for trees in self.rounds:
            for k, (tree, steps) in enumerate(trees):
                out[:, k] += steps[tree.leaves(codes)]
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        def score(x: np.ndarray) -> dict[str, np.ndarray]:
            return _called(softmax(self.margins(self.bins.codes(x))))

        return _scored(df, score, {"prediction": "double", "probability": "array<double>"})


@dataclass(frozen=True)
class SoftmaxBoosting:
    """Multi-class boosting with a softmax loss: each round one tree per class.

    A tree follows slopes g = p - (1 for the own class) and curvatures h = 2 p (1 - p): its
    splits gain by G^2 / (H + l2), its leaves step by -G / (H + l2), shrunk by ``rate``, and
    no side of a split has less than ``least_weight`` of curvature. All classes start even.
    The trees of a round, of all classes and folds, grow together. A level is a pass over
    the rows, whose margins are carried with them and renewed every ``carry`` rounds, between
    which the newest trees are applied on the fly. Rows of no more than ``_HELD`` bytes with
    their margins are held by one task for all rounds, which takes them less than the
    overhead of some hundred passes; the trees are the same.
    """

    key: str
    rounds: int = 100
    rate: float = 0.3
    max_depth: int = 6
    l2: float = 1.0
    least_weight: float = 1.0
    bins: int = 64
    carry: int = 10

    def fit(self, df: DataFrame) -> BoostedModel:
        return self.fit_folds(df, 0)[0]

    def fit_folds(self, df: DataFrame, folds: int) -> list[BoostedModel]:
        """The model of all rows, and those without each fold (column ``fold``)."""
        cuts = feature_bins(df, bins=self.bins)
        classes = _classes(df)
        models, n_features = folds + 1, len(cuts.edges)
        table = spread(binned(df, cuts, key=self.key))
        starts = np.zeros((models, classes))
        plans = [Plan(fold=m - 1, target=m * classes + k) for m in range(models) for k in range(classes)]
        made = softmax_gradients(self.l2, self.least_weight)
        rows = table.count()
        if rows and n_features and rows * Rows.width(n_features, len(plans)) <= _HELD:
            rounds = self._held(table, cuts, plans, made, starts)
            own = [[r[m * classes : (m + 1) * classes] for r in rounds] for m in range(models)]
            return [BoostedModel(cuts, starts[m], own[m]) for m in range(models)]
        done: list[list[list[tuple[Tree, np.ndarray]]]] = [[] for _ in range(models)]
        fresh: list[list[tuple[Tree, np.ndarray]]] = []

        def now(cols: Mapping[str, np.ndarray], fresh) -> np.ndarray:
            """Margins (row, model, class) with the rounds that the rows do not carry yet."""
            out = np.array(cols["margins"]).reshape(-1, models, classes)
            for trees in fresh:
                for plan, (tree, steps) in zip(plans, trees, strict=True):
                    out[:, plan.target // classes, plan.target % classes] += steps[tree.leaves(cols["codes"])]
            return out

        def renew(rows: DataFrame, fresh: list) -> DataFrame:
            first = "margins" not in rows.columns

            def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    if first:
                        raw = [starts.tobytes()] * batch.num_rows
                    else:
                        raw = [r.tobytes() for r in now(_columns(batch, n_features), fresh)]
                    own = [batch.column(c) for c in ("h", "y", "fold", "codes")]
                    yield pa.RecordBatch.from_arrays([*own, pa.array(raw, pa.binary())], names=["h", "y", "fold", "codes", "margins"])

            return cut(rows.mapInArrow(add, "h long, y double, fold int, codes binary, margins binary"))

        table = renew(table, fresh)
        for _ in range(self.rounds):
            current = list(fresh)

            def sums(cols, plan, current=current):
                if "p" not in cols:
                    cols["p"] = softmax(now(cols, current)).reshape(len(cols["y"]), -1)
                p = cols["p"][:, plan.target]
                return None, [np.ones(len(p)), p - (cols["y"] == plan.target % classes), np.maximum(2 * p * (1 - p), 1e-16)]

            trees = grow(table, cuts, plans, made, sums, max_depth=self.max_depth)
            steps = [(t, self.rate * np.array([made.value(a) for a in t.totals])) for t in trees]
            for m in range(models):
                done[m].append(steps[m * classes : (m + 1) * classes])
            # without the sums of nodes, which every pass would send along
            fresh.append([(tree.shape(), step) for tree, step in steps])
            if len(fresh) == self.carry:
                table = renew(table, fresh)
                fresh = []
        return [BoostedModel(cuts, starts[m], done[m]) for m in range(models)]

    def _held(
        self, table: DataFrame, cuts: Bins, plans: Sequence[Plan], made: Criterion, starts: np.ndarray
    ) -> list[list[tuple[Tree, np.ndarray]]]:
        """The trees of every round and their steps, from one task that holds the rows."""
        models, classes = starts.shape
        widths = [len(e) + 1 for e in cuts.edges]
        rounds, rate, max_depth = self.rounds, self.rate, self.max_depth

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = Rows.of(batches, len(widths))
            margins = np.tile(starts, (len(rows.y), 1, 1))
            p = np.empty((len(plans), len(rows.y)))

            def slopes(plan: Plan, part: slice) -> tuple[np.ndarray, np.ndarray]:
                own = p[plan.target, part]
                return own - (rows.y[part] == plan.target % classes), np.maximum(2 * own * (1 - own), 1e-16)

            for r in range(rounds):
                for lo in range(0, len(rows.y), _ROWS):
                    p[:, lo : lo + _ROWS] = softmax(margins[lo : lo + _ROWS]).reshape(-1, len(plans)).T
                trees, place = _grown_here(rows, widths, plans, made, slopes, max_depth)
                steps = [rate * np.array([made.value(a) for a in t.totals]) for t in trees]
                for plan, step, at in zip(plans, steps, place, strict=True):
                    margins[:, plan.target // classes, plan.target % classes] += step[at]
                # the class itself is not known to the driver by the worker's name
                plain = [([getattr(t, c) for c in columns], step) for t, step in zip(trees, steps, strict=True)]
                yield pa.RecordBatch.from_pylist([{"round": r, "trees": pickle.dumps(plain)}], schema)

        columns = ("feature", "upto", "left", "depth", "gain", "totals")
        schema = pa.schema([("round", pa.int32()), ("trees", pa.binary())])
        found = table.select("h", "y", "fold", "codes").repartition(1).mapInArrow(run, "round int, trees binary").collect()
        known = (pickle.loads(r["trees"]) for r in sorted(found, key=lambda r: r["round"]))
        return [[(Tree(*own), step) for own, step in trees] for trees in known]
