"""Token alignment of two tokenizers by lockstep merging of their byte ends."""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import staged

# Fixed value: the split pattern of the byte-level tokenizer.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_BLANK_RUN = re.compile(r"\s{65536}")
_LANE = 256  # A tokens one slot of the state vector walks through
_CHUNK_BYTES = 1 << 21  # text that is aligned at once


# ---- the two tokenizers --------------------------------------------------------------


def _byte_of_char() -> dict[str, int]:
    """The byte that each printable stand-in of a byte-level vocabulary means.

    Printable bytes stand for themselves, the others in order for the code points from 256.
    """
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@dataclass(frozen=True)
class Tokens:
    """A text as ids, with the bytes of every id at hand."""

    encode: Callable[[str], list[int]]
    table: list[bytes]

    @property
    def lengths(self) -> np.ndarray:
        return np.fromiter(map(len, self.table), np.int64, len(self.table))


def byte_level(path: str) -> Tokens:
    """The byte-level vocabulary of a ``tokenizers`` file, special tokens left out."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"] for t in spec.get("added_tokens", ()) if t.get("special")}
    chars = _byte_of_char()
    vocab = {i: bytes(chars[c] for c in t) for t, i in spec["model"]["vocab"].items() if t not in special}
    table = [vocab.get(i, b"") for i in range(max(vocab) + 1)]
    fast = tiktoken.Encoding("byte-level", pat_str=PATTERN, special_tokens={},
                             mergeable_ranks={b: i for i, b in vocab.items()})

    slow: list = []

    def encode(text: str) -> list[int]:
        if not _BLANK_RUN.search(text):
            return fast.encode_ordinary(text)
        # the look-ahead of the pattern overflows a stack on such runs; the same
        # vocabulary behind another library does not
        if not slow:
            import tokenizers

            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            slow.append(tokenizers.Tokenizer.from_file(path))
            slow[0].encode_special_tokens = True
        return slow[0].encode(text, add_special_tokens=False).ids

    return Tokens(encode, table)


def pieces(path: str) -> Tokens:
    """A ``sentencepiece`` model; U+2581 means a space, ``<0xHH>`` a byte."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    table = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        table.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
    return Tokens(lambda text: model.encode(text, num_threads=1), table)


def tokenizer_path(name: str, folder: str | None = None) -> str:
    """Place of a public vocabulary file: in ``folder``, else where the installed package has it."""
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return str(public_tokenizers.path(name))


# ---- lockstep merging ----------------------------------------------------------------


@dataclass(frozen=True)
class Merged:
    """Token ends of a batch of documents merged: links (a, b) in order, and cuts.

    ``a`` and ``b`` are positions in the concatenated tokens of the batch; ``cut_a`` and
    ``cut_b`` mark the tokens after which both sides end.
    """

    a: np.ndarray
    b: np.ndarray
    cut_a: np.ndarray
    cut_b: np.ndarray


def merge_ends(end_a: np.ndarray, end_b: np.ndarray, lane: int = _LANE) -> Merged:
    """All overlapping token pairs of two tilings of the same bytes.

    Ends are counted through the whole batch, so they rise across documents too. Every
    ``lane`` tokens of A get a slot of the state vector, which holds an A and a B pointer;
    a slot starts at the B token over its first byte. In each step all slots emit their
    link, note a cut where both tokens end, and move the pointer (or both) that ends
    first. Slots that are through are taken out, so a step costs what is still open.
    """
    cut_a, cut_b = np.zeros(len(end_a), bool), np.zeros(len(end_b), bool)
    i = np.arange(0, len(end_a), lane)
    stop = np.minimum(i + lane, len(end_a))
    first_byte = np.concatenate([[0], end_a[i[1:] - 1]]) if len(i) else i
    j = np.searchsorted(end_b, first_byte, "right")
    links_a, links_b = [], []
    while len(i):
        links_a.append(i)
        links_b.append(j)
        at_a, at_b = end_a[i], end_b[j]
        both = at_a == at_b
        cut_a[i[both]] = True
        cut_b[j[both]] = True
        i = i + (at_a <= at_b)
        j = j + (at_b <= at_a)
        open_ = i < stop
        if not open_.all():
            i, j, stop = i[open_], j[open_], stop[open_]
    if not links_a:
        none = np.zeros(0, np.int64)
        return Merged(none, none, cut_a, cut_b)
    a, b = np.concatenate(links_a), np.concatenate(links_b)
    # both pointers only rise, so the sum of them orders the links of all slots
    order = np.argsort(a + b, kind="stable")
    return Merged(a[order], b[order], cut_a, cut_b)


@dataclass(frozen=True)
class Batch:
    """Some documents as concatenated tokens; ``starts_*`` has one entry more than documents."""

    ids_a: np.ndarray
    ids_b: np.ndarray
    starts_a: np.ndarray
    starts_b: np.ndarray
    merged: Merged

    def link_starts(self) -> np.ndarray:
        """Where the links of each document begin, by its A tokens."""
        return np.searchsorted(self.merged.a, self.starts_a)


def tokenized(texts: list[bytes | None], a: Tokens, b: Tokens) -> Batch:
    """Both token sequences of each text and their merge.

    A reads a space and the text; B adds that space itself. A text that is null, empty, not
    UTF-8, or not given back byte by byte by both sides has no tokens.
    """
    all_a: list[list[int]] = []
    all_b: list[list[int]] = []
    for raw in texts:
        ids_a: list[int] = []
        ids_b: list[int] = []
        if raw:
            try:
                text = raw.decode("utf-8")
            except UnicodeDecodeError:
                text = None
            if text is not None:
                ids_a, ids_b = a.encode(" " + text), b.encode(text)
                whole = b" " + raw
                if b"".join(map(a.table.__getitem__, ids_a)) != whole or (
                    b"".join(map(b.table.__getitem__, ids_b)) != whole
                ):
                    ids_a, ids_b = [], []
        all_a.append(ids_a)
        all_b.append(ids_b)

    def joined(parts: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        starts = np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)])
        flat = np.fromiter((t for p in parts for t in p), np.int64, int(starts[-1]))
        return flat, starts

    flat_a, starts_a = joined(all_a)
    flat_b, starts_b = joined(all_b)
    merged = merge_ends(np.cumsum(a.lengths[flat_a]), np.cumsum(b.lengths[flat_b]))
    return Batch(flat_a, flat_b, starts_a, starts_b, merged)


def group_texts(batch: Batch) -> tuple[bytes, np.ndarray]:
    """``a1,a2|b1;a3|b2;`` of all documents in one string, and where each document ends.

    The ids are laid out group by group, A before B, and their digits are written by column.
    """
    m = batch.merged
    na, nb = len(batch.ids_a), len(batch.ids_b)
    # tokens of B before the group of each A token, and of A up to the group of each B token
    ends_a, ends_b = np.flatnonzero(m.cut_a), np.flatnonzero(m.cut_b)
    group_a = np.cumsum(m.cut_a) - m.cut_a
    group_b = np.cumsum(m.cut_b) - m.cut_b
    b_before = np.concatenate([[0], ends_b + 1])[group_a] if na else group_a
    a_through = (ends_a + 1)[group_b] if nb else group_b
    ids = np.zeros(na + nb, np.int64)
    sep = np.zeros(na + nb, np.uint8)
    place_a, place_b = np.arange(na) + b_before, np.arange(nb) + a_through
    ids[place_a], ids[place_b] = batch.ids_a, batch.ids_b
    sep[place_a] = np.where(m.cut_a, ord("|"), ord(","))
    sep[place_b] = np.where(m.cut_b, ord(";"), ord(","))
    digits = np.ones(len(ids), np.int64)
    width = 1
    while width < 19 and (big := ids >= 10**width).any():
        digits += big
        width += 1
    ends = np.cumsum(digits + 1)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    out[ends - 1] = sep
    rest = ids
    for k in range(width):
        here = digits > k
        out[ends[here] - 2 - k] = ord("0") + rest[here] % 10
        rest = rest // 10
    through = np.concatenate([[0], ends])[batch.starts_a[1:] + batch.starts_b[1:]]
    return out.tobytes(), through


def _chunks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Rows in slices of about ``most`` bytes of text; a longer text is a slice of its own."""
    for batch in batches:
        texts = batch.column("text")
        through = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at, before = 0, 0
        while at < len(texts):
            taken = max(1, int(np.searchsorted(through, before + most, "right")) - at)
            before = int(through[at + taken - 1])
            yield batch.slice(at, taken), texts.slice(at, taken).to_pylist()
            at += taken


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))


# ---- results -------------------------------------------------------------------------


def alignments(docs: DataFrame, a_path: str, b_path: str, *, chunk_bytes: int = _CHUNK_BYTES) -> DataFrame:
    """One row per document: its tokens, the links between them, and the groups.

    Columns: doc_id; a_ids, b_ids; a_links, b_links (positions of the linked tokens, links
    in order); a_ends, b_ends (number of A and B tokens up to the end of each group).
    Documents whose text is null, empty or not reproduced byte by byte by both tokenizers
    have empty arrays. Repeated rows each count, other columns are not read, an empty table
    gives an empty result. Whole texts are read; a task holds ``chunk_bytes`` of text at a
    time, or one longer text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = byte_level(a_path), pieces(b_path)
        for rows, texts in _chunks(batches, chunk_bytes):
            got = tokenized(texts, a, b)
            m, at = got.merged, got.link_starts()

            def lists(flat: np.ndarray, starts: np.ndarray) -> pa.Array:
                return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(flat, pa.int32()))

            ends_a, ends_b = np.flatnonzero(m.cut_a) + 1, np.flatnonzero(m.cut_b) + 1
            groups = np.searchsorted(ends_a, got.starts_a, "right")
            n_links, n_groups = np.diff(at), np.diff(groups)
            own_a, own_b = got.starts_a[:-1], got.starts_b[:-1]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    lists(got.ids_a, got.starts_a),
                    lists(got.ids_b, got.starts_b),
                    lists(m.a - np.repeat(own_a, n_links), at),
                    lists(m.b - np.repeat(own_b, n_links), at),
                    lists(ends_a - np.repeat(own_a, n_groups), groups),
                    lists(ends_b - np.repeat(own_b, n_groups), groups),
                ],
                names=["doc_id", "a_ids", "b_ids", "a_links", "b_links", "a_ends", "b_ends"],
            )

    arrays = ", ".join(f"{c} array<int>" for c in ("a_ids", "b_ids", "a_links", "b_links", "a_ends", "b_ends"))
    return _texts(docs).mapInArrow(run, f"doc_id long, {arrays}")


_ALIGNED = (
    "chunk long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "links binary, pairs array<long>, times array<long>"
)


def alignment_report(docs: DataFrame, a_path: str, b_path: str, *, chunk_bytes: int = _CHUNK_BYTES) -> DataFrame:
    """One row per document with its alignment in figures, weighed by the whole corpus.

    Columns: doc_id; n_a, n_b, n_groups, n_links; n_best (links whose id pair is linked as
    often as any pair of its B id in the corpus); count_sum (how often the id pairs of the
    links are linked in the corpus, added over the links); groups_sha256. Rows, nulls and
    empty tables as in :func:`alignments`; documents without tokens have zeros and ''.

    A chunk of texts is aligned once. It leaves its distinct id pairs with their numbers,
    and per document which of them it holds; pairs of all chunks are added up, and each
    chunk gets the totals of its own pairs back. A frequent pair is one row per chunk, so
    no key grows with the texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = byte_level(a_path), pieces(b_path)
        pack = zstandard.ZstdCompressor(level=3)
        chunk = TaskContext.get().partitionId() << 32
        for rows, texts in _chunks(batches, chunk_bytes):
            got = tokenized(texts, a, b)
            m, at = got.merged, got.link_starts()
            n = len(texts)
            # ids of both fit an int64 by far
            code = got.ids_a[m.a] * len(b.table) + got.ids_b[m.b]
            pairs, which = np.unique(code, return_inverse=True)
            times = np.bincount(which, minlength=len(pairs))
            # (document, pair) once, with its number
            own = np.repeat(np.arange(n), np.diff(at))
            held, often = np.unique(own * max(1, len(pairs)) + which, return_counts=True)
            doc, pair = np.divmod(held, max(1, len(pairs)))
            cuts = np.searchsorted(doc, np.arange(n + 1))
            blobs = []
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                steps = np.diff(pair[lo:hi], prepend=0).astype(np.int32)
                both = np.concatenate([steps, often[lo:hi].astype(np.int32)])
                blobs.append(pack.compress(both.view(np.uint8).reshape(-1, 4).T.tobytes()))
            text, through = group_texts(got)
            shas, begin = [], 0
            for end in through.tolist():
                # the last separator is not part of the text
                shas.append(hashlib.sha256(text[begin : end - 1]).hexdigest() if end > begin else "")
                begin = end
            groups = np.searchsorted(np.flatnonzero(m.cut_a) + 1, got.starts_a, "right")
            none = pa.nulls(n, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, chunk)),
                    rows.column("doc_id"),
                    *(pa.array(np.diff(x).astype(np.int64)) for x in (got.starts_a, got.starts_b, groups, at)),
                    pa.array(shas, pa.string()),
                    pa.array(blobs, pa.binary()),
                    none,
                    none,
                ],
                schema=schema,
            )
            yield pa.RecordBatch.from_pylist(
                [{"chunk": chunk, "pairs": pairs.tolist(), "times": times.tolist()}], schema=schema
            )
            chunk += 1

    schema = pa.schema(
        [("chunk", pa.int64()), ("doc_id", pa.int64())]
        + [(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")]
        + [("groups_sha256", pa.string()), ("links", pa.binary())]
        + [(c, pa.list_(pa.int64())) for c in ("pairs", "times")]
    )
    pieces_b = len(pieces(b_path).table)
    aligned = staged(_texts(docs).mapInArrow(run, _ALIGNED), "aligned")
    heads = aligned.where("pairs IS NOT NULL")
    held = heads.select("chunk", F.posexplode(F.arrays_zip("pairs", "times")).alias("at", "p"))
    held = held.select("chunk", "at", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    totals = held.groupBy("pair").agg(F.sum("times").alias("total"))
    # at most as many rows in a window as A has ids
    of_b = W.partitionBy(F.col("pair") % pieces_b)
    totals = staged(
        totals.select("pair", "total", (F.col("total") == F.max("total").over(of_b)).alias("best")), "pair-totals"
    )
    known = held.join(totals, "pair").groupBy("chunk").agg(
        F.sort_array(F.collect_list(F.struct("at", "total", "best"))).alias("k")
    )
    figures = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"]
    first = known.select(
        "chunk", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("doc_id"),
        *[F.lit(None).cast(aligned.schema[c].dataType).alias(c) for c in figures],
        F.col("k.total").alias("total"), F.col("k.best").alias("best"),
    )
    rest = aligned.where("pairs IS NULL").select(
        "chunk", F.lit(1).alias("kind"), "doc_id", *figures,
        F.lit(None).cast("array<long>").alias("total"), F.lit(None).cast("array<boolean>").alias("best"),
    )
    dealt = first.unionByName(rest).repartition("chunk").sortWithinPartitions("chunk", "kind")

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        total = best = np.zeros(0, np.int64)
        for batch in batches:
            kinds = batch.column("kind").to_numpy()
            sums, bests = [], []
            for r, kind in enumerate(kinds):
                if kind == 0:
                    total = batch.column("total")[r].values.to_numpy()
                    best = batch.column("best")[r].values.to_numpy(zero_copy_only=False)
                    continue
                raw = np.frombuffer(unpack.decompress(batch.column("links")[r].as_py()), np.uint8)
                steps, often = np.ascontiguousarray(raw.reshape(4, -1).T).view(np.int32).reshape(2, -1).astype(np.int64)
                pair = np.cumsum(steps)
                sums.append(int((total[pair] * often).sum()))
                bests.append(int(often[best[pair]].sum()))
            docs_only = batch.filter(pa.array(kinds == 1))
            cols = [docs_only.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(bests, pa.int64()), pa.array(sums, pa.int64()), docs_only.column("groups_sha256")],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
            )

    return dealt.mapInArrow(
        weigh,
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string",
    )
