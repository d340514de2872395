"""Toxicity by compression distance: dictionaries of toxic and of ordinary text.

A text is cut into windows of ten words. Each window is compressed twice, once with a
zstandard dictionary trained on ordinary text and once with the same dictionary behind
one learned from toxic text. What the toxic dictionary saves is the window's distance. The
largest distances and the shares of windows above several distances make the score, with
thresholds that are calibrated on labelled documents the dictionaries have not seen.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged
from .labelled import held_out, learning_sample
from .quality import fit_additive

_WINDOW = 10
_ORDINARY_BYTES = 8192
_STEM = 7  # bytes of a word's start, the space before it included
_STEPS = (2, 3, 4, 6)
_DICTIONARY_ROWS, _DICTIONARY_CHARS, _CALIBRATION_ROWS = 4_000, 20_000, 20_000


def windows(words: list[bytes], size: int = _WINDOW) -> list[bytes]:
    return [b" " + b" ".join(words[i : i + size]) + b" " for i in range(0, len(words), size)]


# ---- the dictionaries ----------------------------------------------------------------


def toxic_spans(texts: list[tuple[bytes, int]]) -> list[bytes]:
    """What toxic texts say and ordinary ones do not, as text to train a dictionary on.

    Most words of a toxic text are ordinary. So words are grouped by how they start, and
    a group counts when it is met at least eight times as often in toxic texts, by
    different places (a place is the word and the one before it, so that copies of a text
    count once), and its log-likelihood ratio exceeds what the most uneven of as many
    groups would reach by chance. That is a matter of evidence, not of a share: with more
    labels rarer words are learned. A group stands for its longest start that most of
    its words share, and these starts are the toxic dictionary, commonest last.
    """
    places: tuple[dict[bytes, set[int]], dict[bytes, set[int]]] = (defaultdict(set), defaultdict(set))
    whole: dict[bytes, set[bytes]] = defaultdict(set)
    for text, label in texts:
        words = text.lower().split()
        for before, word in zip([b"", *words], words, strict=False):
            stem = (b" " + word)[:_STEM]
            places[label][stem].add(xxhash.xxh64_intdigest(before + b" " + word))
            if label:
                whole[stem].add(word)
    ordinary, toxic = ({k: len(v) for k, v in p.items()} for p in places)
    n_ordinary, n_toxic = sum(ordinary.values()), sum(toxic.values())
    if not n_ordinary or not n_toxic:
        return []
    share = n_toxic / (n_ordinary + n_toxic)
    # a ratio of 2 ln(n) is exceeded by about one in n of what differs by chance alone
    least = 2 * math.log(len(toxic) + 1)
    spans: list[bytes] = []
    for stem, n in sorted(toxic.items(), key=lambda x: (x[1], x[0])):
        m = ordinary.get(stem, 0)
        ratio = 2 * n * math.log(n / ((n + m) * share))
        ratio += 2 * m * math.log(m / ((n + m) * (1 - share))) if m else 0
        if n < 2 or ratio < least or n < 8 * (m + 1) * n_toxic / n_ordinary or len(stem) < 4:
            continue
        own = [b" " + word + b" " for word in whole[stem]]
        while True:
            longer = Counter(w[: len(stem) + 1] for w in own if w.startswith(stem) and len(w) > len(stem))
            if not longer:
                break
            best, k = min(longer.items(), key=lambda x: (-x[1], x[0]))
            if k < 0.6 * len(own):
                break
            stem = best
        spans.append(stem)
    return spans


def ordinary_content(samples: list[bytes], size: int) -> bytes:
    """What zstandard's trainer picks from ``samples``; too few samples are it themselves."""
    try:
        return zstandard.train_dictionary(size, samples, k=64, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[-size:]


@dataclass(frozen=True)
class Dictionaries:
    ordinary: bytes
    toxic: bytes

    def compressors(self) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
        """With ordinary text behind toxic text both find ordinary matches equally near."""
        size = len(self.ordinary) + len(self.toxic)
        rules = zstandard.ZstdCompressionParameters.from_level(
            6, source_size=128, dict_size=max(size, 8), min_match=4,
            format=zstandard.FORMAT_ZSTD1_MAGICLESS,
            write_checksum=0, write_content_size=0, write_dict_id=0,
        )
        made = []
        for content in (self.ordinary, self.toxic + self.ordinary):
            # a dictionary has 8 bytes at least
            kept = zstandard.ZstdCompressionDict(
                content.rjust(8), dict_type=zstandard.DICT_TYPE_RAWCONTENT
            )
            kept.precompute_compress(compression_params=rules)
            made.append(zstandard.ZstdCompressor(dict_data=kept, compression_params=rules))
        return made[0], made[1]


def train(texts: list[tuple[bytes, int]]) -> Dictionaries:
    ordinary = [w for text, label in texts if not label for w in windows(text.lower().split())]
    # as long as there is evidence for; the sample bounds it
    return Dictionaries(ordinary_content(ordinary, _ORDINARY_BYTES), b"".join(toxic_spans(texts)))


def _lengths(compressor: zstandard.ZstdCompressor, parts: list[bytes]) -> np.ndarray:
    packed = compressor.multi_compress_to_buffer(parts, threads=0)
    return np.fromiter((len(packed[i]) for i in range(len(packed))), np.int64, len(packed))


def distances(
    text: bytes | None, ordinary: zstandard.ZstdCompressor, toxic: zstandard.ZstdCompressor
) -> list[float]:
    """The numbers of one whole text that its score is made of."""
    cut = windows((text or b"").lower().split())
    if not cut:
        return [0.0] * (5 + len(_STEPS))
    saved = []
    for at in range(0, len(cut), 4096):
        part = cut[at : at + 4096]
        saved.append(_lengths(ordinary, part) - _lengths(toxic, part))
    saved = np.concatenate([*saved, [0, 0, 0]])
    top = np.sort(saved)[::-1][:3]
    n = len(cut) + 4
    shares = [float((saved >= k).sum()) / n for k in _STEPS]
    return [*map(float, top), *shares, float(np.maximum(saved, 0).sum()) / n, float(np.log1p(len(cut)))]


# ---- on Spark ------------------------------------------------------------------------


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, *, label: str = "toxic", folds: int = 5, fold: int = 0,
    dictionary_rows: int = _DICTIONARY_ROWS, calibration_rows: int = _CALIBRATION_ROWS,
) -> DataFrame:
    """Toxicity of every whole text: doc_id, held_out, score (0 to 1), predicted (0 or 1).

    Only labelled rows outside the held-out fold are learned from: about half of them, at
    most ``dictionary_rows``, train the dictionaries, each by its text or, of longer ones, by
    20,000 characters in a row from a place that its doc_id picks; of the others at most
    ``calibration_rows`` calibrate the thresholds (nine numbers each, of the whole text).
    Texts are lower-cased (A-Z). No other column than text and doc_id is read, and doc_id,
    of any type that has a text form, only picks the rows. Null and empty texts are scored as texts without a window. Without usable
    labels every score is the smoothed share of label 1. One row per row of ``docs``,
    repeated rows and null doc_ids included; an empty table gives an empty result.
    """
    name = F.col("doc_id").cast("string")
    odd = F.pmod(F.xxhash64(name, F.lit("half")), F.lit(2)) == 1
    texts = learning_sample(
        docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")),
        labels.where(odd), label, folds, fold, dictionary_rows,
    )
    # bounds what the driver takes in; all texts are scored, and calibrate, whole
    spare = F.greatest(F.length("text") - _DICTIONARY_CHARS, F.lit(0)) + 1
    start = (F.pmod(F.xxhash64(name, F.lit("start")), spare) + 1).cast("int")
    excerpt = F.substr("text", start, F.lit(_DICTIONARY_CHARS))
    rows = texts.select("doc_id", excerpt.alias("text"), "label").collect()
    rows.sort(key=lambda r: r.doc_id)
    learned = train([(r.text.encode(), r.label) for r in rows])
    del rows
    width = 5 + len(_STEPS)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = learned.compressors()
        for batch in batches:
            x = [distances(t.as_py(), *pair) for t in batch.column("text").cast(pa.binary())]
            numbers = pa.array(x, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), numbers], names=["doc_id", "x"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    source = docs.select("doc_id", F.col("text").cast("string"))
    measured = staged(source.mapInArrow(measure, f"doc_id {kind}, x array<double>"), "toxicity")

    sample = learning_sample(measured, labels.where(~odd), label, folds, fold, calibration_rows)
    known = sample.orderBy("doc_id").select("x", "label").collect()
    x = np.array([r.x for r in known], np.float64).reshape(len(known), width)
    y = np.array([r.label for r in known], np.float64)
    model = fit_additive(x, y, rounds=40, most_pairs=4, pair_rounds=10)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("x").flatten().to_numpy(zero_copy_only=False)
            p = model.probability(flat.reshape(batch.num_rows, width))
            columns = [batch.column("doc_id"), batch.column("held_out"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "score", "predicted"])

    marked = measured.withColumn("held_out", held_out(folds, fold))
    return marked.mapInArrow(score, f"doc_id {kind}, held_out boolean, score double, predicted int")
