"""Line dedup by a deletion-neighbourhood join.

Lines are compared as words. Two lines are near when one word inserted, deleted or
replaced makes them equal. Every variant of a line with one word deleted is hashed
together with the place of the deletion; near lines meet in such a hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packed, staged

NEAR_WORDS = 10  # lines of fewer words are compared for equality only
_TURN = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2^64
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def lines_of(text: bytes | None) -> list[list[bytes]]:
    """Words of every line of a text, A-Z lower-cased; white space does not count."""
    return [line.split() for line in (text or b"").lower().split(b"\n")]


def _long(data: bytes, seed: int) -> int:
    return xxhash.xxh64_intdigest(data, seed) - (1 << 63)


def line_hash(words: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words))


def half_keys(words: list[bytes]) -> list[int | None]:
    """Four hashes of which two near lines share one.

    One edit leaves the first or the last half of the words alone, where halves are
    those of the shorter line. A line is the shorter or equal one, or the longer by one,
    so it has the halves for its own length and for one word less.
    """
    if len(words) < NEAR_WORDS:
        return [None] * 4
    keys: list[int | None] = []
    for n in (len(words), len(words) - 1):
        half = n // 2
        keys += [_long(b" ".join(words[:half]), 2 * n), _long(b" ".join(words[-half:]), 2 * n + 1)]
    return keys


def deletions(words: list[bytes]) -> tuple[int, np.ndarray]:
    """Hash of the whole line, and of each line that lacks one word, in order."""
    n = len(words)
    each = np.fromiter((xxhash.xxh64_intdigest(w, 7) for w in words), np.uint64, n)
    powers = np.cumprod(np.full(n, _TURN))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(each * powers)])
    without = sums[:-1] + (sums[-1] - sums[1:]) * _BACK

    def final(x: np.ndarray, length: int) -> np.ndarray:
        x = (x ^ (x >> np.uint64(29)) ^ np.uint64(length)) * np.uint64(0xBF58476D1CE4E5B9)
        return (x ^ (x >> np.uint64(32))).view(np.int64)

    return int(final(sums[-1:], n)[0]), final(without, n - 1)


def near(a: list[bytes], b: list[bytes]) -> bool:
    """True when at most one word is inserted, deleted or replaced between ``a`` and ``b``."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    same = 0
    while same < len(a) and a[same] == b[same]:
        same += 1
    return a[same + (len(a) == len(b)) :] == b[same + 1 :]


def _text_key() -> Column:
    """With doc_id it names a row; rows of one doc_id and text have the same lines."""
    return F.xxhash64(F.col("text").cast("string"))


def split_lines(docs: DataFrame) -> DataFrame:
    """Every line that has a word: doc_id, text_key, line_no, words, h, k0 to k3."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, numbers, words, hashes, keys = [], [], [], [], []
            for row, text in enumerate(batch.column("text").cast(pa.binary())):
                for number, line in enumerate(lines_of(text.as_py())):
                    if line:
                        at.append(row)
                        numbers.append(number)
                        words.append(len(line))
                        hashes.append(line_hash(line))
                        keys.append(half_keys(line))
            columns = [
                *(batch.column(c).take(pa.array(at, pa.int64())) for c in ("doc_id", "text_key")),
                pa.array(numbers, pa.int32()),
                pa.array(words, pa.int32()),
                pa.array(hashes, pa.binary()),
                *(pa.array([k[i] for k in keys], pa.int64()) for i in range(4)),
            ]
            yield pa.RecordBatch.from_arrays(
                columns, names=["doc_id", "text_key", "line_no", "words", "h", "k0", "k1", "k2", "k3"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    halves = ", ".join(f"k{i} long" for i in range(4))
    return docs.select("doc_id", _text_key().alias("text_key"), F.col("text").cast("string")).mapInArrow(
        compute, f"doc_id {kind}, text_key long, line_no int, words int, h binary, {halves}"
    )


def _place(doc_id: str = "doc_id", line_no: str = "line_no") -> Column:
    """Sorts by doc_id, null last, then by line."""
    return F.struct(F.isnull(doc_id).alias("no_id"), F.col(doc_id).alias("doc_id"), F.col(line_no).alias("line_no"))


def _variants(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Deletion variants of the ``wanted`` lines (h, first, text_key).

    Rows h, first, key, gap and, where gap is -1 and key stands for the whole line, its
    words in ``line``.
    """
    own = wanted.groupBy(F.col("first.doc_id").alias("id"), "text_key").agg(
        # no more than the lines of one text
        F.collect_list(F.struct(F.col("first.line_no").alias("line_no"), "h")).alias("lines")
    )
    # the merge join is dealt and split alike at every size
    rows = docs.select("doc_id", F.col("text").cast("string"), _text_key().alias("key")).join(
        own.hint("merge"), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("key") == F.col("text_key"))
    )

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in enumerate(batch.column("text").cast(pa.binary())):
                split = lines_of(text.as_py())
                numbers, hashes, keys, gaps, lines = [], [], [], [], []
                for line in batch.column("lines")[row].as_py():
                    number = line["line_no"]
                    # another text of this doc_id and key may have another line here
                    if number >= len(split) or line_hash(split[number]) != line["h"]:
                        continue
                    whole, less = deletions(split[number])
                    n = len(less)
                    keys += [whole, *less.tolist()]
                    gaps += range(-1, n)
                    numbers += [number] * (n + 1)
                    hashes += [line["h"]] * (n + 1)
                    lines += [b" ".join(split[number])] + [None] * n
                ids = batch.column("doc_id").take(pa.array([row] * len(keys), pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(hashes, pa.binary()),
                        ids,
                        pa.array(numbers, pa.int32()),
                        pa.array(keys, pa.int64()),
                        pa.array(gaps, pa.int32()),
                        pa.array(lines, pa.binary()),
                    ],
                    names=["h", "doc_id", "line_no", "key", "gap", "line"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    made = rows.select("doc_id", "text", "lines").mapInArrow(
        compute, f"h binary, doc_id {kind}, line_no int, key long, gap int, line binary"
    )
    return made.select("h", _place().alias("first"), "key", "gap", "line")


def _verified(pairs: DataFrame) -> DataFrame:
    """The pairs whose lines (a_line, b_line) are within one word of each other."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column("a_line").to_pylist(), batch.column("b_line").to_pylist(), strict=True)
            keep = pa.array([near(a.split(b" "), b.split(b" ")) for a, b in both], pa.bool_())
            yield batch.select(["h", "first"]).filter(keep)

    return pairs.select("h", "first", "a_line", "b_line").mapInArrow(
        compute, pairs.select("h", "first").schema
    )


def near_lines(docs: DataFrame, distinct: DataFrame) -> DataFrame:
    """For each distinct line (h, first, text_key) with an earlier near one: (h, near_first), the earliest.

    Lines that share no half with another line have no near line, and are not expanded.
    The others emit their deletion variants. Lines that lack a word at one place and agree
    otherwise are near, and it is enough to pair each with the earliest of them; a line
    that equals a variant is near to all lines the variant comes from. So no group is
    expanded into all its pairs. Every pair found by hash is compared word by word.
    """
    halves = distinct.select("h", F.explode(F.array("k0", "k1", "k2", "k3")).alias("key")).where("key IS NOT NULL")
    shared = halves.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    meets = halves.join(shared, "key", "left_semi").select("h").distinct()
    wanted = distinct.select("h", "first", "text_key").join(meets, "h", "left_semi")
    # a row that repeats a doc_id repeats its variants, which only finds the same pairs again
    variants = staged(_variants(docs, wanted), "line-variants")

    whole = variants.where("gap = -1").select("h", "first", "key", "line")
    less = variants.where("gap >= 0").select("h", "first", "key", "gap")
    groups = less.groupBy("key", "gap").agg(F.min(F.struct("first", "h")).alias("least"), F.count("*").alias("n"))
    replaced = (
        less.join(groups.where("n > 1"), ["key", "gap"])
        .where(F.col("h") != F.col("least.h"))
        .select("h", F.col("least.h").alias("a"))
    )
    met = less.select("h", "first", "key").join(
        whole.select(F.col("h").alias("a"), F.col("first").alias("a_first"), "key"), "key"
    )
    later = F.col("a_first") < F.col("first")
    inserted = met.where(F.col("h") != F.col("a")).select(
        F.when(later, F.col("h")).otherwise(F.col("a")).alias("h"),
        F.when(later, F.col("a")).otherwise(F.col("h")).alias("a"),
    )
    pairs = (
        replaced.union(inserted)
        .distinct()
        .join(whole.select(F.col("h").alias("a"), "first", F.col("line").alias("a_line")), "a")
        .join(whole.select("h", F.col("line").alias("b_line")), "h")
    )
    return _verified(pairs).groupBy("h").agg(F.min("first").alias("near_first"))


def _decisions(docs: DataFrame) -> DataFrame:
    """:func:`line_decisions` with the text_key and the h of each line."""
    lines = staged(split_lines(docs), "lines")
    keys = [F.min(f"k{i}").alias(f"k{i}") for i in range(4)]
    least = F.min(F.struct(_place().alias("first"), "text_key")).alias("least")
    distinct = lines.groupBy("h").agg(least, F.count("*").alias("n"), *keys)
    distinct = staged(distinct.select("h", "least.first", "least.text_key", "n", "k0", "k1", "k2", "k3"), "distinct-lines")
    close = near_lines(docs, distinct)
    fate = (
        distinct.select("h", "first", "n")
        .join(close, "h", "left")
        .where("n > 1 OR near_first IS NOT NULL")
        .select("h", "first", "near_first")
    )
    fate = staged(fate, "line-fates")
    place = _place()
    goal = F.coalesce("near_first", "first", place)
    return (
        lines.select("doc_id", "text_key", "line_no", "words", "h")
        .join(fate, "h", "left")
        .select(
            "doc_id",
            "text_key",
            "line_no",
            "words",
            "h",
            goal["doc_id"].alias("keep_doc_id"),
            goal["line_no"].alias("keep_line_no"),
            F.when(F.col("near_first").isNull(), 0).otherwise(1).alias("distance"),
            (goal == place).alias("kept"),
        )
    )


def line_decisions(docs: DataFrame) -> DataFrame:
    """What becomes of every line that has a word.

    A line stays if no earlier line, by doc_id (null last) and line number, is equal to
    it or, for lines of at least ten words, near to it: one word inserted, deleted or
    replaced, so nine tenths of the words at least agree. Lines are compared by their
    words with A-Z lower-cased. An earlier line counts whether or not it stays itself.

    Returns doc_id, line_no (from 0, lines end at \\n), words, keep_doc_id, keep_line_no
    (the earliest near line, else the earliest equal one), distance (0 or 1 words), kept.
    Lines without a word are no rows and always stay. Null and empty texts have none.
    Rows that repeat a doc_id are one document: their equal lines at one place stay or go
    together. An empty table gives an empty result; other columns are not read.
    """
    return _decisions(docs).drop("text_key", "h")


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` without the lines that :func:`line_decisions` lets go, all rows kept.

    The other lines stay as they are, in order; n_chars, where there is one, is that of
    the new text. A null text stays null. Rows that share a doc_id, or have none, lose
    their own lines only.
    """
    gone = (
        _decisions(docs)
        .where("NOT kept")
        .groupBy(F.col("doc_id").alias("gone_id"), "text_key")
        # no more than the lines of one text
        .agg(F.collect_set("line_no").alias("gone"))
    )
    same = F.col("row.doc_id").eqNullSafe(F.col("gone_id")) & (F.col("key") == F.col("text_key"))
    keyed = packed(docs).withColumn("key", F.xxhash64(F.col("row.text").cast("string")))
    joined = keyed.join(gone.hint("merge"), same, "left")
    stays = F.expr("filter(split(row.text, '\n', -1), (x, i) -> NOT array_contains(gone, i))")
    new = {"text": F.array_join(stays, "\n")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length(new["text"]).cast(docs.schema["n_chars"].dataType)
    untouched = F.col("gone").isNull()
    return joined.select(
        *(
            F.when(untouched, F.col("row")[c]).otherwise(new[c]).alias(c) if c in new else F.col("row")[c].alias(c)
            for c in docs.columns
        )
    )
