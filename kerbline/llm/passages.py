"""Substring dedup: shared k-mer seeds, collinear chains, aligned fuzzy passages."""

from __future__ import annotations

import bisect
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch, staged

K = 8  # words of a seed
REACH = 14  # words between the matches that are kept of an equal run
GAP = 40  # words; matches further apart belong to different passages
HOT = 32  # places; a run that more have leads to the first of them, and is told apart by longer ones
_GAP_COST = 0.1  # of a match, for each word by which a chain moves on, both texts' mean
_TURN = np.uint64(0x9E3779B97F4A7C15)
_BUCKET_CHARS = 1 << 23  # of text, whose seeds meet in one bucket
_FLUSH = 1 << 20  # seeds that a task holds before it deals them to the buckets
_ASKED = 1024  # spans of one document that are cut in one visit of its text
Visit = Callable[[pa.RecordBatch, list[list[bytes]]], pa.RecordBatch]
_SEED_BYTES = 5  # of a hash that are kept; matches are compared word by word in the end


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def seeds(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of all k-mers."""
    n = len(words) - K + 1
    if n < 1:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    each = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    mers = np.zeros(n, np.uint64)
    for j in range(K):
        mers = mers * _TURN + each[j : j + n]
    return np.arange(n), _mixed(mers).view(np.int64)


def longer_seeds(words: list[bytes], spots: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of longer runs, and of two k-mers as far apart, that start at ``spots``."""
    mers = seeds(words)[1].view(np.uint64)
    places, hashes = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for length in sorted({x for x in (2 * K, 4 * K, min_words) if K < x <= max(2 * K, min_words)}):
        last = length - K
        at = spots[spots + last < len(mers)]
        for kind, steps in enumerate(([*range(0, last, K), last], [0, last])):
            x = np.full(len(at), 2 * length + kind, np.uint64)
            for step in steps:
                x = _mixed(x * _TURN + mers[at + step])
            places.append(at)
            hashes.append(x.view(np.int64))
    return np.concatenate(places), np.concatenate(hashes)


# ---- seeds in buckets ----------------------------------------------------------------


def _squeezed(x: np.ndarray) -> bytes:
    """An int32 array as compressed differences, byte by byte."""
    steps = np.diff(x, prepend=np.int32(0)).astype(np.int32)
    return pa.compress(steps.view(np.uint8).reshape(-1, 4).T.tobytes(), "zstd", asbytes=True)


def _stretched(data: bytes, n: int) -> np.ndarray:
    flat = pa.decompress(data, 4 * n, "zstd", asbytes=True)
    steps = np.frombuffer(flat, np.uint8).reshape(4, n).T.copy().view(np.int32).ravel()
    return np.cumsum(steps, dtype=np.int32)


def _dealt(ids: pa.Array, rows: np.ndarray, places: np.ndarray, mers: np.ndarray, buckets: int) -> pa.RecordBatch:
    """The seeds of some documents, one row a bucket."""
    mers = mers.view(np.uint64) >> np.uint64(64 - 8 * _SEED_BYTES)
    bucket = (mers % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    ends = np.flatnonzero(np.diff(bucket[order], append=-1)) + 1
    numbers, counts, hashes, owners, spots, own, sizes = [], [], [], [], [], [], [0]
    lo = 0
    for hi in ends.tolist():
        part = order[lo:hi]
        here, index = np.unique(rows[part], return_inverse=True)
        numbers.append(bucket[part[0]])
        counts.append(hi - lo)
        hashes.append(mers[part].view(np.uint8).reshape(-1, 8)[:, :_SEED_BYTES].T.tobytes())
        owners.append(_squeezed(index.astype(np.int32)))
        spots.append(_squeezed(places[part].astype(np.int32)))
        own.append(here)
        sizes.append(sizes[-1] + len(here))
        lo = hi
    used = ids.take(pa.array(np.concatenate([np.empty(0, np.int64), *own])))
    columns = [
        pa.array(numbers, pa.int32()), pa.array(counts, pa.int32()), pa.array(hashes, pa.binary()),
        pa.array(owners, pa.binary()), pa.array(spots, pa.binary()),
        pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), used),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["bucket", "n", "hashes", "owners", "places", "ids"])


def _in_buckets(docs: DataFrame, buckets: int, min_words: int) -> DataFrame:
    """All seeds of ``docs``, or the longer ones at ``spots`` where it has such a column."""
    longer = "spots" in docs.columns

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows, places, hashes, held, docs_held = [], [], [], [], 0, 0

        def flushed() -> pa.RecordBatch:
            every = pa.concat_arrays(ids)
            return _dealt(every, np.concatenate(rows), np.concatenate(places), np.concatenate(hashes), buckets)

        for batch in batches:
            for row, text in enumerate(batch.column("text").cast(pa.binary())):
                words = words_of(text.as_py())
                if longer:
                    spots = batch.column("spots")[row].values.to_numpy(zero_copy_only=False)
                    at, mers = longer_seeds(words, np.unique(spots).astype(np.int64), min_words)
                else:
                    at, mers = seeds(words)
                if not len(at):
                    continue
                ids.append(batch.column("doc_id").slice(row, 1))
                rows.append(np.full(len(at), docs_held))
                places.append(at)
                hashes.append(mers)
                held, docs_held = held + len(at), docs_held + 1
                if held >= _FLUSH:
                    yield flushed()
                    ids, rows, places, hashes, held, docs_held = [], [], [], [], 0, 0
        if held:
            yield flushed()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(
        compute, f"bucket int, n int, hashes binary, owners binary, places binary, ids array<{kind}>"
    )


def met(h: np.ndarray, code: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted seeds (code, pos), pairs of them (here, there), and those of hot hashes.

    Places of one hash are paired with all that earlier documents have of it, or, where
    more than HOT have it, with the first of them.
    """
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    order = order[np.append(same, False) | np.insert(same, 0, False)] if len(h) > 1 else order[:0]
    order = order[np.lexsort((pos[order], code[order], h[order]))]
    h, code, pos = h[order], code[order], pos[order]
    if len(h):
        # rows that repeat a doc_id
        new = np.insert((h[1:] != h[:-1]) | (code[1:] != code[:-1]) | (pos[1:] != pos[:-1]), 0, True)
        h, code, pos = h[new], code[new], pos[new]
    starts = np.flatnonzero(np.insert(h[1:] != h[:-1], 0, True)) if len(h) else np.empty(0, np.int64)
    size = np.diff(np.append(starts, len(h)))
    first, end = np.repeat(starts, size), np.repeat(starts + size, size)
    several = code[first] != code[end - 1]
    hot = several & (end - first > HOT)
    here, there = [np.flatnonzero(hot & (code > code[first]))], []
    there.append(first[here[0]])
    left = np.flatnonzero(several & ~hot)
    for k in range(1, HOT):
        left = left[left + k < end[left]]
        if not len(left):
            break
        apart = left[code[left + k] > code[left]]
        here.append(apart + k)
        there.append(apart)
    return code, pos, np.concatenate(here), np.concatenate(there), np.flatnonzero(hot)


def _matches(dealt: DataFrame, kind: str) -> DataFrame:
    """(doc_id, keep_id, pos, to) of the pairs, and (doc_id, null, pos, null) of hot seeds."""

    def compute(own: pa.Table) -> pa.Table:
        hashes, owners, places, ids, before = [], [], [], [], 0
        for n, h, o, p, names in zip(*(own.column(c) for c in ("n", "hashes", "owners", "places", "ids")), strict=True):
            n = n.as_py()
            whole = np.zeros((n, 8), np.uint8)
            whole[:, :_SEED_BYTES] = np.frombuffer(h.as_py(), np.uint8).reshape(_SEED_BYTES, n).T
            hashes.append(whole.view(np.uint64).ravel())
            owners.append(_stretched(o.as_py(), n).astype(np.int64) + before)
            places.append(_stretched(p.as_py(), n))
            ids.append(names.values)
            before += len(names.values)
        every = pa.concat_arrays(ids)
        distinct = every.unique()
        distinct = distinct.take(pc.sort_indices(distinct))
        code = pc.index_in(every, value_set=distinct).to_numpy(zero_copy_only=False)
        code, pos, here, there, hot = met(
            np.concatenate(hashes), code[np.concatenate(owners)], np.concatenate(places)
        )
        none = len(hot)
        columns = [
            distinct.take(pa.array(np.concatenate([code[here], code[hot]]))),
            pa.concat_arrays([distinct.take(pa.array(code[there])), pa.nulls(none, distinct.type)]),
            pa.array(np.concatenate([pos[here], pos[hot]]), pa.int32()),
            pa.concat_arrays([pa.array(pos[there], pa.int32()), pa.nulls(none, pa.int32())]),
        ]
        return pa.Table.from_arrays(columns, names=["doc_id", "keep_id", "pos", "to"])

    return dealt.groupBy("bucket").applyInArrow(compute, f"doc_id {kind}, keep_id {kind}, pos int, to int")


# ---- chains --------------------------------------------------------------------------


class _PrefixMax:
    """Fenwick tree: the best (value, index) among the first places."""

    def __init__(self, n: int):
        self.best: list[tuple[float, int]] = [(float("-inf"), -1)] * (n + 1)

    def put(self, place: int, entry: tuple[float, int]) -> None:
        place += 1
        while place < len(self.best):
            if entry > self.best[place]:
                self.best[place] = entry
            place += place & -place

    def before(self, place: int) -> tuple[float, int]:
        found = (float("-inf"), -1)
        while place > 0:
            found = max(found, self.best[place])
            place -= place & -place
        return found


def chains(matches: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """Collinear chains of ``matches`` (place here, place there), sorted, best first.

    A chain gains K a match and pays for every word it moves on in both texts. That cost
    is linear, so the best match to continue from is a prefix maximum over the places
    there. Chains are cut where a gap exceeds GAP words in either text.
    """
    there = sorted({b for _, b in matches})
    rank = {b: i for i, b in enumerate(there)}
    tree = _PrefixMax(len(there))
    score, back = [], []
    for number, (a, b) in enumerate(matches):
        value, best = tree.before(rank[b])
        paid = _GAP_COST * (a + b) / 2
        gain = value - paid
        score.append(K + max(0.0, gain))
        back.append(best if gain > 0 else -1)
        tree.put(rank[b], (score[-1] + paid, number))
    used = [False] * len(matches)
    out = []
    for end in sorted(range(len(matches)), key=lambda i: (-score[i], i)):
        links, at = [], end
        while at >= 0 and not used[at]:
            used[at] = True
            links.append(matches[at])
            at = back[at]
        links.reverse()
        start = 0
        for i in range(1, len(links) + 1):
            if i == len(links) or max(links[i][0] - links[i - 1][0], links[i][1] - links[i - 1][1]) > GAP + K:
                if i > start:
                    out.append(links[start:i])
                start = i
    return out


def edits(a: list[bytes], b: list[bytes]) -> int:
    """Word edit distance of two short lists."""
    while a and b and a[0] == b[0]:
        a, b = a[1:], b[1:]
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    if not a or not b:
        return len(a) + len(b)
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        corner, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            corner, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, corner + (x != y))
    return row[-1]


_OVER = ((1, 1), (1, 0), (0, 1))  # words here and there that an end passes over


def align(a: list[bytes], b: list[bytes], links: list[tuple[int, int]]) -> tuple[int, int, int, int, int]:
    """Ends of the passage in both lists (start, end, start, end) and its word edits.

    The chain's matches are fixed points; what lies between two of them is aligned, and
    both ends go on as long as words agree, over single replaced, inserted or deleted
    words that four equal ones follow.
    """
    (i, j), errors = links[0], 0
    start, to = i, j

    def goes_on(x: int, y: int, step: int, n: int) -> bool:
        for s in range(n):
            p, q = x + step * s, y + step * s
            if not (0 <= p < len(a) and 0 <= q < len(b) and a[p] == b[q]):
                return False
        return True

    while True:
        if goes_on(start - 1, to - 1, -1, 1):
            start, to = start - 1, to - 1
        else:
            over = next((x for x in _OVER if goes_on(start - 1 - x[0], to - 1 - x[1], -1, 4)), None)
            if over is None:
                break
            start, to, errors = start - over[0], to - over[1], errors + 1
    for p, q in links[1:]:
        errors += edits(a[i:p], b[j:q])
        i, j = p, q
    i, j = min(i + K, len(a)), min(j + K, len(b))
    while True:
        if goes_on(i, j, 1, 1):
            i, j = i + 1, j + 1
        else:
            over = next((x for x in _OVER if goes_on(i + x[0], j + x[1], 1, 4)), None)
            if over is None:
                break
            i, j, errors = i + over[0], j + over[1], errors + 1
    return start, i, to, j, errors


def alike(
    a: list[bytes], b: list[bytes], links: list[tuple[int, int]], min_words: int, min_identity: float
) -> list[tuple[int, int, int, int, int]]:
    """Alignments of a chain that are long and alike enough, the chain cut at its worst gaps."""
    found, rest = [], [links]
    while rest:
        links = rest.pop()
        i, j, p, q, errors = align(a, b, links)
        if j - i < min_words:
            continue
        if errors <= (1 - min_identity) * max(j - i, q - p) + 1e-9:
            found.append((i, j, p, q, errors))
        elif len(links) > 1:
            gaps = [edits(a[x[0] : y[0]], b[x[1] : y[1]]) for x, y in zip(links, links[1:], strict=False)]
            cut = gaps.index(max(gaps)) + 1
            rest += [links[cut:], links[:cut]]
    return found


# ---- on Spark ------------------------------------------------------------------------

# a match in one number, the place here above 32 bits and the place there below; an array
# of numbers takes a quarter of the bytes of an array of structs
_LINKS = "array<long>"
_LOW = (1 << 32) - 1


def thinned(rows: np.ndarray, pos: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Indices, by row and place, of the ends of equal runs and each REACH-th match between."""
    order = np.lexsort((pos, to - pos, rows))
    r, p, d = rows[order], pos[order], (to - pos)[order]
    if not len(r):
        return order
    new = np.insert((r[1:] != r[:-1]) | (d[1:] != d[:-1]) | (p[1:] > p[:-1] + 1), 0, True)
    again = np.insert((r[1:] == r[:-1]) & (d[1:] == d[:-1]) & (p[1:] == p[:-1]), 0, False)
    starts = np.flatnonzero(new)
    begin = np.repeat(p[starts], np.diff(np.append(starts, len(p))))
    keep = ((p - begin) % REACH == 0) | np.append(new[1:], True)
    order = order[keep & ~(again & ~np.append(new[1:], True))]
    return order[np.lexsort((to[order], pos[order], rows[order]))]


def _parts(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Short batches, since what Python makes of a row takes more memory than the row."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _chained(pairs: DataFrame) -> DataFrame:
    """Chains of each pair (doc_id, keep_id, matches)."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            rows, numbers, found = [], [], []
            matches = batch.column("matches")
            flat, counts = matches.flatten(), pc.list_value_length(matches).to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(batch.num_rows), counts)
            both = flat.to_numpy(zero_copy_only=False)
            pos, to = both >> 32, both & _LOW
            kept = thinned(owner, pos, to)
            ends = np.searchsorted(owner[kept], np.arange(batch.num_rows + 1))
            pos, to = pos[kept].tolist(), to[kept].tolist()
            for row in range(batch.num_rows):
                lo, hi = ends[row], ends[row + 1]
                mine = sorted(set(zip(pos[lo:hi], to[lo:hi], strict=True)))
                for number, links in enumerate(chains(mine)):
                    rows.append(row)
                    numbers.append(number)
                    found.append([p << 32 | q for p, q in links])
            at = pa.array(rows, pa.int64())
            columns = [batch.column("doc_id").take(at), batch.column("keep_id").take(at)]
            columns += [pa.array(numbers, pa.int32()), pa.array(found, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "keep_id", "chain", "links"])

    kind = pairs.schema["doc_id"].dataType.simpleString()
    return pairs.mapInArrow(compute, f"doc_id {kind}, keep_id {kind}, chain int, links {_LINKS}")


def _first_likes(found: DataFrame) -> DataFrame:
    """Of the passages of each document those with a word that none before has, by keep_id."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, covered = None, []
        for batch in batches:
            keep = []
            spans = (batch.column(c).to_pylist() for c in ("doc_id", "start_word", "end_word"))
            for doc_id, start, end in zip(*spans, strict=True):
                if doc_id != last:
                    last, covered = doc_id, []
                at = bisect.bisect_right(covered, (start, float("inf"))) - 1
                keep.append(at < 0 or covered[at][1] < end)
                if keep[-1]:
                    lo = at if at >= 0 and covered[at][1] >= start else at + 1
                    hi = bisect.bisect_right(covered, (end, float("inf")))
                    if hi > lo:
                        start, end = min(start, covered[lo][0]), max(end, covered[hi - 1][1])
                    covered[lo:hi] = [(start, end)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    ordered = found.repartition("doc_id").sortWithinPartitions(
        "doc_id", "keep_id", "start_word", F.desc("end_word"), "keep_start", "keep_end"
    )
    return ordered.mapInArrow(compute, found.schema)


def _asked(chained: DataFrame, name: str) -> DataFrame:
    """(id, slices): how often the text of each ``name`` has to travel, once for _ASKED chains."""
    counts = chained.groupBy(F.col(name).alias("id")).agg(F.ceil(F.count("*") / _ASKED).cast("int").alias("slices"))
    # a table of its own, so that the joins deal both sides anew and can split a hot id
    return staged(counts, "asked")


def _at_texts(texts: DataFrame, asked: DataFrame, requests: DataFrame, visit: Visit, fields: str) -> DataFrame:
    """What ``visit`` makes of batches of ``requests`` (id, slice, ...) and the words of their texts.

    A text travels once for every slice of its requests, ahead of them, and is split into
    words once; a document that very many ask for is so dealt to several tasks. Of rows that
    repeat an id the one with the smallest hash of its text is read.
    """
    own = [c for c in requests.columns if c not in ("id", "slice")]
    told = requests.select(
        "id", "slice", F.lit(1).alias("kind"), F.lit(0).cast("long").alias("order"),
        *own, F.lit(None).cast("string").alias("text"),
    )
    read = texts.join(asked, "id").select(
        "id", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), F.lit(0).alias("kind"),
        F.xxhash64("text").alias("order"),
        *[F.lit(None).cast(requests.schema[c].dataType).alias(c) for c in own], "text",
    )
    place = ["id", "slice", "kind", "order"]
    dealt = told.union(read).repartition("id", "slice").sortWithinPartitions(*place)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, words = None, []
        for whole in batches:
            for batch in _parts([whole]):
                met: list[list[bytes]] = []
                rows = []
                columns = (batch.column(c).to_pylist() for c in ("id", "slice", "kind"))
                for row, (name, slice_, kind) in enumerate(zip(*columns, strict=True)):
                    if kind:
                        rows.append(row)
                        met.append(words)
                    elif (name, slice_) != last:
                        last = name, slice_
                        words = words_of(batch.column("text")[row].cast(pa.binary()).as_py())
                yield visit(batch.take(pa.array(rows, pa.int64())), met)

    return dealt.select("id", "slice", "kind", *own, "text").mapInArrow(compute, fields)


def _span(links: list[int], shift: int, margin: int) -> tuple[int, int]:
    """The words of a text that a chain can reach: its own and ``margin`` on either side."""
    return max(0, (links[0] >> shift & _LOW) - margin), (links[-1] >> shift & _LOW) + K + margin


def repeated_passages(docs: DataFrame, *, min_words: int = 50, min_identity: float = 0.8) -> DataFrame:
    """Passages that an earlier document has too, equal or nearly so.

    Texts are compared by their words, A-Z lower-cased. Seeds are all 8-word runs, and lead
    to every place that an earlier document has them at. A run with more than HOT places
    leads to the first of them alone, but so do the runs of 16, 32 and ``min_words`` words
    that start with it, and the pairs of 8-word runs as far apart: of these too, each leads
    to all its places up to HOT. So an equal passage is always found, and a near one unless
    every such run it shares is in more places and the first of them is no part of its
    like. Matches of two documents are chained with gap costs, and chains of any span are
    aligned word by word, and cut at their worst gaps where they are not alike enough.
    Passages of at least ``min_words`` words remain whose alignment has at most
    ``1 - min_identity`` edits a word.

    Returns doc_id, start_word, end_word (exclusive), keep_id, keep_start, keep_end, edits,
    identity: one row per passage of doc_id with its like in keep_id < doc_id, where the
    smaller keep_id goes first and a passage inside those before gives no row. A passage
    without an earlier like, and repeats inside one document, give no row. Rows with a
    null doc_id take no part, rows that repeat a doc_id are taken for one document, null
    and empty texts have no passage, and an empty table gives an empty result. Other
    columns are not read.
    """
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).where("doc_id IS NOT NULL")
    kind = texts.schema["doc_id"].dataType.simpleString()
    # one row; buckets of about equal size at every size of the table
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = 1 + chars // _BUCKET_CHARS
    # the matches are many times the chains
    with scratch(texts.sparkSession):
        met_rows = staged(_matches(_in_buckets(texts.select("doc_id", "text"), buckets, min_words), kind), "matches")
        matches = met_rows.where("keep_id IS NOT NULL")
        hot = met_rows.where("keep_id IS NULL")
        if not hot.isEmpty():
            # no more than the words of one document
            spots = hot.groupBy(F.col("doc_id").alias("id")).agg(F.collect_set("pos").alias("spots"))
            again = texts.join(spots, F.col("doc_id") == F.col("id")).select("doc_id", "text", "spots")
            longer = _matches(_in_buckets(again, buckets, min_words), kind)
            matches = matches.union(longer.where("keep_id IS NOT NULL"))
        pairs = matches.groupBy("doc_id", "keep_id").agg(
            # no more than HOT for each seed of one document
            F.collect_list(F.shiftleft(F.col("pos").cast("long"), 32).bitwiseOR(F.col("to").cast("long"))).alias("matches")
        )
        chained = staged(_chained(pairs), "chains", outlives=True)
    here, there = _asked(chained, "doc_id"), _asked(chained, "keep_id")
    # both slices are known before any words travel, so these travel once, from here to there
    told = chained
    for asked, own, other in ((here, "doc_id", "keep_id"), (there, "keep_id", "doc_id")):
        told = told.join(asked.withColumnRenamed("id", own), own).withColumn(
            f"{own}_slice", F.pmod(F.xxhash64(other, "chain"), "slices").cast("int")
        ).drop("slices")
    margin = max(min_words, K + REACH)

    def cut(batch: pa.RecordBatch, texts: list[list[bytes]]) -> pa.RecordBatch:
        spans = [_span(links, 32, margin) for links in batch.column("links").to_pylist()]
        words = [b" ".join(text[lo:hi]) for text, (lo, hi) in zip(texts, spans, strict=True)]
        kept = ["keep_id", "keep_id_slice", "id", "links"]
        return pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in kept), pa.array([lo for lo, _ in spans], pa.int32()), pa.array(words, pa.binary())],
            names=["id", "slice", "doc_id", "links", "lo", "words"],
        )

    def aligned(batch: pa.RecordBatch, texts: list[list[bytes]]) -> pa.RecordBatch:
        rows, ends = [], []
        columns = (batch.column(c).to_pylist() for c in ("lo", "words", "links"))
        for row, (text, lo, words, links) in enumerate(zip(texts, *columns, strict=True)):
            keep_lo, keep_hi = _span(links, 0, margin)
            a, b = words.split(), text[keep_lo:keep_hi]
            links = [((m >> 32) - lo, (m & _LOW) - keep_lo) for m in links]
            # another row of a repeated doc_id, or another run of the same hash
            links = [(i, j) for i, j in links if a[i : i + K] == b[j : j + K] and i + K <= len(a)]
            if not links:
                continue
            for i, j, p, q, errors in alike(a, b, links, min_words, min_identity):
                rows.append(row)
                identity = 1 - errors / max(j - i, q - p)
                ends.append((i + lo, j + lo, p + keep_lo, q + keep_lo, errors, identity))
        at = pa.array(rows, pa.int64())
        ints = [pa.array([e[n] for e in ends], pa.int32()) for n in range(5)]
        columns = [batch.column("doc_id").take(at), ints[0], ints[1], batch.column("id").take(at)]
        columns += [*ints[2:], pa.array([e[5] for e in ends], pa.float64())]
        return pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", "start_word", "end_word", "keep_id", "keep_start", "keep_end", "edits", "identity"]
    texts = texts.withColumnRenamed("doc_id", "id")
    asking = told.select(
        F.col("doc_id").alias("id"), F.col("doc_id_slice").alias("slice"), "keep_id", "keep_id_slice", "links"
    )
    slices = _at_texts(
        texts, here, asking, cut, f"id {kind}, slice int, doc_id {kind}, links {_LINKS}, lo int, words binary"
    )
    found = _at_texts(
        texts, there, slices, aligned,
        f"doc_id {kind}, start_word int, end_word int, keep_id {kind}, keep_start int, keep_end int, "
        "edits int, identity double",
    )
    return _first_likes(found)
