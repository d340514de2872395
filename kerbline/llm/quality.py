"""Quality classifier: a generalised additive model with pairwise interactions.

Each text becomes a few numbers; each number falls in a bin, and the score is the sum of
one table entry per feature and one per chosen pair of features. The tables are learned by
cyclic boosting of shallow trees, one feature or pair at a time.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged
from .labelled import held_out, learning_sample

FEATURES = [
    "log_words", "word_length", "length_spread", "upper", "digit", "non_ascii", "stops", "shouts",
    "bars", "marks", "brackets", "other_punctuation", "spaces", "lines_per_word", "distinct_words",
    "commonest_word", "echoes", "distinct_lines", "longest_line", "short_words", "long_words",
    "compression",
]
_LEARN_ROWS = 20_000
_STEP = 1 << 20  # bytes of a text handled at a time where arrays are made of them


def _of(characters: bytes) -> np.ndarray:
    return np.frombuffer(characters, np.uint8)


def features(text: bytes | None) -> list[float]:
    """The numbers of one text, all zero for an empty or null one."""
    data = text or b""
    words = data.split()
    n, size = len(words), len(data)
    if not n:
        return [0.0] * len(FEATURES)
    seen = np.zeros(256, np.int64)
    for at in range(0, size, _STEP):
        seen += np.bincount(_of(data[at : at + _STEP]), minlength=256)
    lengths = np.fromiter(map(len, words), np.int64, n)
    upper, lower = seen[65:91].sum(), seen[97:123].sum()
    counts = Counter(words)
    lines = [line for line in data.split(b"\n") if line.strip()]
    marks = seen[_of(b"#$%&*@^~+=_\\")].sum()
    punctuation = seen[33:48].sum() + seen[58:65].sum() + seen[91:97].sum() + seen[123:127].sum()
    stops, shouts, bars = seen[_of(b".,;:")].sum(), seen[_of(b"!?")].sum(), seen[124]
    brackets = seen[_of(b"<>()[]{}/\"'`")].sum()
    return [
        float(np.log1p(n)),
        float(lengths.mean()),
        float(lengths.std()),
        upper / max(1, upper + lower),
        seen[48:58].sum() / size,
        seen[128:].sum() / size,
        stops / n,
        shouts / n,
        bars / n,
        marks / n,
        brackets / n,
        (punctuation - stops - shouts - bars - marks - brackets) / n,
        seen[_of(b" \t\n\x0b\x0c\r")].sum() / size,
        len(lines) / n,
        len(counts) / n**0.8,
        max(counts.values()) / n,
        sum(map(bytes.__eq__, words, words[1:])) / n,
        len(set(lines)) / len(lines),
        max(map(len, lines)) / size,
        float((lengths <= 2).mean()),
        float((lengths >= 15).mean()),
        len(zstandard.ZstdCompressor(level=1).compress(data)) / (size + 20),
    ]


# ---- the model -----------------------------------------------------------------------


@dataclass
class AdditiveModel:
    """Bin edges and lookup tables; a score is a sum of table entries."""

    start: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        if not self.tables:
            return out
        for j, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            out += table[np.searchsorted(edges, x[:, j], "right")]
        wide = [np.searchsorted(self.coarse[j], x[:, j], "right") for j in range(x.shape[1])]
        for i, j, table in self.pairs:
            out += table[wide[i], wide[j]]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(x), -30, 30)))


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1], method="higher"))


def _leaf(g: np.ndarray, h: np.ndarray, l2: float) -> np.ndarray:
    return g / (h + l2)


def _best_cut(g: np.ndarray, h: np.ndarray, l2: float) -> tuple[float, int]:
    """Gain and position of the best cut of a run of bins; 0.0 where none gains."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl**2 / (hl + l2) + gr**2 / (hr + l2) - g.sum() ** 2 / (h.sum() + l2)
    at = int(np.argmax(gain))
    return float(gain[at]), at + 1


def _line_tree(g: np.ndarray, h: np.ndarray, l2: float) -> np.ndarray:
    """Leaf values per bin of a tree of depth two over one feature."""
    out = np.empty(len(g))
    _, cut = _best_cut(g, h, l2)
    for lo, hi in ((0, cut), (cut, len(g))):
        if lo == hi:
            continue
        _, inner = _best_cut(g[lo:hi], h[lo:hi], l2)
        for a, b in ((lo, lo + inner), (lo + inner, hi)):
            if a < b:
                out[a:b] = _leaf(g[a:b].sum(), h[a:b].sum(), l2)
    return out


def _square_tree(g: np.ndarray, h: np.ndarray, l2: float) -> tuple[np.ndarray, float]:
    """Leaf values of a depth-two tree over two features, and its gain."""
    best_gain, best = -1.0, np.zeros_like(g)
    for axis in (0, 1):
        a, b = (g, h) if axis == 0 else (g.T, h.T)
        gain, cut = _best_cut(a.sum(axis=1), b.sum(axis=1), l2)
        out = np.zeros_like(a)
        for part in (slice(0, cut), slice(cut, len(a))):
            ga, hb = a[part].sum(axis=0), b[part].sum(axis=0)
            more, inner = _best_cut(ga, hb, l2)
            gain += more
            for cols in (slice(0, inner), slice(inner, len(ga))):
                out[part, cols] = _leaf(ga[cols].sum(), hb[cols].sum(), l2)
        if gain > best_gain:
            best_gain, best = gain, out if axis == 0 else out.T
    return best, best_gain


def fit_additive(
    x: np.ndarray,
    y: np.ndarray,
    *,
    bins: int = 64,
    coarse_bins: int = 12,
    rounds: int = 60,
    pair_rounds: int = 30,
    most_pairs: int = 8,
    rate: float = 0.15,
    l2: float = 5.0,
) -> AdditiveModel:
    """Cyclic boosting on log loss: every round visits each feature, then each pair.

    Pairs are those that a tree on the gradients left by the single features gains most
    on. Without rows of both labels the model is the smoothed share of label 1.
    """
    share = (y.sum() + 0.5) / (len(y) + 1)
    model = AdditiveModel(float(np.log(share / (1 - share))))
    if len(np.unique(y)) < 2:
        return model
    d = x.shape[1]
    model.edges = [_edges(x[:, j], bins) for j in range(d)]
    model.coarse = [_edges(x[:, j], coarse_bins) for j in range(d)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    fine = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(model.edges)]
    wide = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(model.coarse)]
    score = np.full(len(y), model.start)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
        return y - p, np.maximum(p * (1 - p), 1e-6)

    for _ in range(rounds):
        for j in range(d):
            g, h = slopes()
            k = len(model.tables[j])
            step = rate * _line_tree(np.bincount(fine[j], g, k), np.bincount(fine[j], h, k), l2)
            model.tables[j] += step
            score += step[fine[j]]

    def grids(i: int, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        g, h = slopes()
        shape = len(model.coarse[i]) + 1, len(model.coarse[j]) + 1
        cell = wide[i] * shape[1] + wide[j]
        n = shape[0] * shape[1]
        return cell, np.bincount(cell, g, n).reshape(shape), np.bincount(cell, h, n).reshape(shape)

    gains = []
    for i in range(d):
        for j in range(i + 1, d):
            gains.append((_square_tree(*grids(i, j)[1:], l2)[1], i, j))
    chosen = sorted(gains, key=lambda x: (-x[0], x[1:]))[:most_pairs]
    model.pairs = [(i, j, np.zeros((len(model.coarse[i]) + 1, len(model.coarse[j]) + 1))) for _, i, j in chosen]
    for _ in range(pair_rounds):
        for i, j, table in model.pairs:
            cell, g, h = grids(i, j)
            step = rate * _square_tree(g, h, l2)[0]
            table += step
            score += step.ravel()[cell]
    return model


# ---- on Spark ------------------------------------------------------------------------


def text_features(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, x) with the numbers of every whole text, and the columns ``carry``."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t.as_py()) for t in batch.column("text").cast(pa.binary())]
            numbers = pa.array(x, pa.list_(pa.float64()))
            own = [batch.column(c) for c in ("doc_id", *carry)]
            yield pa.RecordBatch.from_arrays([*own, numbers], names=["doc_id", *carry, "x"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    further = "".join(f"{c} {docs.schema[c].dataType.simpleString()}, " for c in carry)
    source = docs.select("doc_id", *carry, F.col("text").cast("string"))
    return source.mapInArrow(compute, f"doc_id {kind}, {further}x array<double>")


def quality_scores(
    docs: DataFrame, labels: DataFrame, *, label: str = "quality", folds: int = 3, fold: int = 1,
    learn_rows: int = _LEARN_ROWS, carry: tuple[str, ...] = (),
) -> DataFrame:
    """Quality of every whole text: doc_id, held_out, score (0 to 1), predicted (0 or 1).

    The model is fitted on the driver on the numbers of at most ``learn_rows`` labelled
    documents outside the held-out fold (22 doubles each, about 4 MB in all); no other
    column than text and doc_id is read, and doc_id only picks the rows. Null and empty
    texts are scored like a text without words. Without usable labels every score is the
    smoothed share of label 1 (0.5 without any). One row per row of ``docs``, repeated
    rows and null doc_ids included, with the columns ``carry`` of it; an empty table gives
    an empty result.
    """
    numbers = staged(text_features(docs, carry), "quality-features")
    sample = learning_sample(numbers, labels, label, folds, fold, learn_rows)
    rows = sample.orderBy("doc_id").select("x", "label").collect()
    x = np.array([r.x for r in rows], np.float64).reshape(len(rows), len(FEATURES))
    model = fit_additive(x, np.array([r.label for r in rows], np.float64))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("x").flatten().to_numpy(zero_copy_only=False)
            p = model.probability(flat.reshape(batch.num_rows, len(FEATURES)))
            columns = [batch.column("doc_id"), batch.column("held_out"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))]
            columns += [batch.column(c) for c in carry]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "score", "predicted", *carry])

    kind = docs.schema["doc_id"].dataType.simpleString()
    further = "".join(f", {c} {docs.schema[c].dataType.simpleString()}" for c in carry)
    marked = numbers.withColumn("held_out", held_out(folds, fold))
    return marked.mapInArrow(score, f"doc_id {kind}, held_out boolean, score double, predicted int{further}")
