"""Repair of conversation structure by weighted interval parsing (CYK) over spans of turns."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEEP, REROLE, DELETE, INSERT, OPEN_END = 0, 3, 4, 3, 3  # costs of the edits, and of a truncated turn that stays
_SPACE = r"\x20\x09-\x0D"
_ITEMS = 8  # spans that one chart combines
_BLOCK_BYTES = 1 << 18
_RUN_BYTES = 1 << 22  # texts of one conversation that a task holds

# Roles that may follow in (s?(ua)+)?, as moves between four states: at the start, after
# the system turn, after a user turn, after an answer. It may end in the first or the last.
_MOVES = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_ENDS = (0, 3)
_NAMES = {"u": "user", "a": "assistant"}
_STATES = range(4)

# A cell of a span holds, for each nonterminal (state before, state after), the least
# (cost, audit) of all edits that lead from one to the other; None where nothing does.
Cell = list[tuple[int, str] | None]


# ---- the grammar ---------------------------------------------------------------------


def _least(cell: Cell, at: int, cost: int, audit: str) -> None:
    cell[at] = min(cell[at] or (cost, audit), (cost, audit))


def _insertions() -> Cell:
    """The cell of an empty span: turns that are inserted, closed under repetition."""
    cell: Cell = [None] * 16
    for p in _STATES:
        cell[5 * p] = (0, "")
    for _ in _STATES:
        for p in _STATES:
            for (r, role), q in _MOVES.items():
                if role in _NAMES and cell[4 * p + r] is not None:
                    cost, audit = cell[4 * p + r]
                    _least(cell, 4 * p + q, cost + INSERT, audit + "I")
    return cell


# places in a cell of all rules (p, q) -> (p, r) (r, q): whole, left and right
_FOLLOWS = {(p, q) for p in _STATES for q in _STATES if p == q or q > 1 or (p, q) == (0, 1)}
_RULES = [
    (4 * p + q, 4 * p + r, 4 * r + q)
    for p in _STATES for r in _STATES for q in _STATES
    if (p, r) in _FOLLOWS and (r, q) in _FOLLOWS
]


def joined(left: Cell, right: Cell, into: Cell) -> None:
    """All rules on two neighbouring spans; ``into`` keeps the least.

    Equally cheap audits of one span never begin with one another, since what follows
    could only be insertions, which cost; so least audits join to least audits.
    """
    for at, one, other in _RULES:
        head, tail = left[one], right[other]
        if head is not None and tail is not None:
            cost, old = head[0] + tail[0], into[at]
            if old is None or cost < old[0] or cost == old[0] and head[1] + tail[1] < old[1]:
                into[at] = (cost, head[1] + tail[1])


EMPTY = _insertions()


def _closed(cell: Cell) -> Cell:
    half: Cell = [None] * 16
    joined(EMPTY, cell, half)
    whole: Cell = [None] * 16
    joined(half, EMPTY, whole)
    return whole


def _turn_cell(mark: str) -> Cell:
    """Terminal rules of one turn: kept, given another role, or deleted, insertions around it.

    A mark is the role's initial (``o``: none of the three), upper case for a truncated
    turn; ``d`` is a turn that has to go.
    """
    cell: Cell = [None] * 16
    for p in _STATES:
        _least(cell, 5 * p, DELETE, "D")
        if mark == "d":
            continue
        extra = OPEN_END if mark.isupper() else 0
        for (r, role), q in _MOVES.items():
            if r == p and role == mark.lower():
                _least(cell, 4 * p + q, KEEP + extra, "K")
            if r == p and role in _NAMES:
                _least(cell, 4 * p + q, REROLE + extra, "R")
    return _closed(cell)


TURNS = {m: _turn_cell(m) for m in "suaoSUAOd"}


def chart(items: Sequence[Cell]) -> Cell:
    """The cell of all ``items`` together, bottom-up by span length over all splits."""
    n = len(items)
    if not n:
        return EMPTY
    spans = {(i, i + 1): cell for i, cell in enumerate(items)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            cell: Cell = [None] * 16
            for k in range(i + 1, i + length):
                joined(spans[i, k], spans[k, i + length], cell)
            spans[i, i + length] = cell
    return spans[0, n]


def marks_cell(marks: str, known: dict[str, Cell]) -> Cell:
    """:func:`chart` of turns; spans with the same marks share a cell."""
    n = len(marks)
    if n < 2:
        return TURNS[marks] if n else EMPTY
    if marks not in known:
        if len(known) > 20_000:
            known.clear()
        for length in range(2, n + 1):
            for i in range(n - length + 1):
                span = marks[i : i + length]
                if span in known:
                    continue
                cell: Cell = [None] * 16
                for k in range(1, length):
                    head, tail = span[:k], span[k:]
                    joined(TURNS.get(head) or known[head], TURNS.get(tail) or known[tail], cell)
                known[span] = cell
    return known[marks]


@dataclass
class Spans:
    """Neighbouring spans, added in order and combined ``_ITEMS`` at a time."""

    levels: list[list[Cell]] = field(default_factory=list)

    def add(self, cell: Cell) -> None:
        for level in self.levels:
            level.append(cell)
            if len(level) < _ITEMS:
                return
            cell = chart(level)
            level.clear()
        self.levels.append([cell])

    def whole(self) -> Cell:
        tail: list[Cell] = []
        for level in self.levels:
            # older spans are on higher levels
            tail = [chart([*level, *tail])] if level or tail else []
        return tail[0] if tail else EMPTY


def best(cell: Cell) -> tuple[int, str]:
    """Cheapest repair of a whole conversation; deleting all of it is always possible."""
    return min(cell[q] for q in _ENDS if cell[q] is not None)


# ---- turns to spans ------------------------------------------------------------------

_COUNTS = ["n", "blank", "duplicate", "truncated", "illegal", "turns"]
_SPAN = "lo long, hi long, first string, last string, " + ", ".join(f"{c} long" for c in _COUNTS)
_PIECE = (
    f"conv_id long, kind int, part int, seq int, {_SPAN}, costs array<long>, audits array<string>, "
    "roles array<string>, texts array<binary>, sha256 string"
)
_PIECE_SCHEMA = pa.schema(
    [("conv_id", pa.int64()), ("kind", pa.int32()), ("part", pa.int32()), ("seq", pa.int32())]
    + [("lo", pa.int64()), ("hi", pa.int64()), ("first", pa.string()), ("last", pa.string())]
    + [(c, pa.int64()) for c in _COUNTS]
    + [("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string()))]
    + [("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.binary())), ("sha256", pa.string())]
)


def illegal(before: str | None, after: str | None) -> bool:
    """Whether two role initials may not stand side by side; None is no turn."""
    return before is not None and after is not None and before + after not in ("su", "ua", "au")


@dataclass
class Facts:
    """What is counted over a run of turns; runs add up in order."""

    lo: int | None = None
    hi: int | None = None
    first: str | None = None
    last: str | None = None
    n: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    turns: int = 0

    def add(self, o: Facts) -> None:
        self.illegal += o.illegal + illegal(self.last, o.first)
        self.turns += o.turns - (o.lo is not None and o.lo == self.hi)
        self.first = o.first if self.first is None else self.first
        self.last = self.last if o.last is None else o.last
        self.lo = o.lo if self.lo is None else self.lo
        self.hi = self.hi if o.hi is None else o.hi
        self.n += o.n
        self.blank += o.blank
        self.duplicate += o.duplicate
        self.truncated += o.truncated

    def gaps(self) -> int:
        return 0 if self.lo is None else self.hi - self.lo + 1 - self.turns


def _spans_of(batches: Iterator[pa.RecordBatch], finish: bool) -> Iterator[dict]:
    """Sorted turns to blocks (kind 1, with their texts) and a span per conversation (kind 0).

    With ``finish`` a conversation that neither begins nor ends the part, and so lies in
    it whole, is repaired at once and leaves its result alone (kind 2).
    """
    part = TaskContext.get().partitionId()
    known: dict[str, Cell] = {}
    conv: tuple | None = None
    facts, spans = Facts(), Spans()
    block: list[tuple[str, bytes]] = []
    marks = ""
    blocks: list[dict] = []
    seq = block_bytes = run_bytes = 0
    may_finish = False  # the first run may have begun in the part before
    first_of: tuple | None = None

    def end_block() -> None:
        nonlocal seq, block_bytes, run_bytes, marks, block
        if block:
            spans.add(marks_cell(marks, known))
            roles, texts = zip(*block, strict=True)
            blocks.append({"conv_id": conv[0], "kind": 1, "part": part, "seq": seq, "roles": roles, "texts": texts})
            run_bytes += block_bytes
            seq, block_bytes, marks, block = seq + 1, 0, "", []

    def end_run(whole: bool) -> list[dict]:
        nonlocal facts, spans, seq, run_bytes, blocks
        end_block()
        cell = spans.whole()
        row = {"conv_id": conv[0], "part": part, "seq": 0, **vars(facts)}
        if whole:
            cost, audit = best(cell)
            put = Hashed(audit)
            for b in blocks:
                put.turns(b["roles"], b["texts"])
            out = [row | {"kind": 2, "costs": [cost], "audits": [audit], "sha256": put.end()}]
        else:
            costs, audits = [c and c[0] for c in cell], [c and c[1] for c in cell]
            out = [*blocks, row | {"kind": 0, "costs": costs, "audits": audits}]
        facts, spans, seq, run_bytes, blocks = Facts(), Spans(), 0, 0, []
        return out

    names = ["conv_id", "turn", "role", "text", "digest", "kind", "blank", "open", "copies"]
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in names]
        for conv_id, turn, role, text, digest, kind, blank, open_, copies in zip(*columns, strict=True):
            if conv != (conv_id,):
                if conv is not None:
                    yield from end_run(may_finish)
                    may_finish = finish
                conv = (conv_id,)
            if kind == 0:
                # the next row is the earliest of the conversation with its role and text
                first_of = (conv_id, turn, role, digest)
            elif kind == 1:
                again = first_of != (conv_id, turn, role, digest)
                initial = role[:1]
                for copy in range(copies):
                    one = Facts(lo=turn, hi=turn, first=initial, last=initial, n=1, turns=int(turn is not None))
                    mark = initial if initial in ("s", "u", "a") else "o"
                    if blank:
                        one.blank, mark = 1, "d"
                    elif again or copy:
                        one.duplicate, mark = 1, "d"
                    elif open_:
                        one.truncated, mark = 1, mark.upper()
                    facts.add(one)
                    marks += mark
                    # the text of a copy is not needed, it has to go
                    block.append((role, b"" if copy else text))
                    block_bytes += len(block[-1][1])
                    if len(marks) == _ITEMS or block_bytes > _BLOCK_BYTES:
                        end_block()
                    if run_bytes > _RUN_BYTES or len(blocks) > 4096:
                        yield from blocks
                        blocks, run_bytes, may_finish = [], 0, False
    if conv is not None:
        yield from end_run(False)


def _pieces(turns: DataFrame, present: Column | None, finish: bool) -> DataFrame:
    there = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        there.alias("there"),
    )
    rows = rows.withColumns({"digest": F.sha2("text", 256), "blank": ~F.col("text").rlike(f"[^{_SPACE}]")})
    # equal rows are counted before they are shuffled
    real = (
        rows.where("there").groupBy("conv_id", "turn", "role", "digest")
        .agg(F.count("*").alias("copies"), F.first("text").alias("text"))
        .select(
            "conv_id", "turn", "role", F.col("text").cast("binary").alias("text"), "digest", F.lit(1).alias("kind"),
            (~F.col("text").rlike(f"[^{_SPACE}]")).alias("blank"),
            (~F.col("text").rlike(rf"[.!?][{_SPACE}]*\z")).alias("open"), "copies",
        )
    )
    earliest = F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn"))
    first = (
        rows.where("there AND NOT blank").groupBy("conv_id", "role", "digest").agg(earliest.alias("at"))
        .select("conv_id", F.col("at.turn").alias("turn"), "role", "digest")
    )
    # a row for every conversation, also for those of which nothing is left
    named = rows.where("NOT there").select("conv_id").distinct()

    def marker(df: DataFrame, kind: int) -> DataFrame:
        further = {f.name: F.lit(None).cast(f.dataType) for f in real.schema if f.name not in df.columns}
        return df.withColumns(further | {"kind": F.lit(kind)}).select(real.columns)

    order = ["conv_id", "turn", "role", "digest"]
    laid = real.union(marker(first, 0)).union(marker(named, -1))
    laid = laid.repartitionByRange(*order).sortWithinPartitions(*order, "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(_spans_of(batches, finish), _PIECE_SCHEMA)

    return laid.mapInArrow(run, _PIECE)


# ---- spans to repairs ----------------------------------------------------------------

Emit = Callable[[int | None, str, str, bytes], None]


class Repair:
    """Walks an audit beside the turns it belongs to, and tells what the result is."""

    def __init__(self, audit: str, out: Callable[[str, str, bytes], None]):
        self.audit, self.at, self.state, self.out = audit, 0, 0, out

    def _put(self, edit: str, role: str, text: bytes) -> None:
        self.state = _MOVES[self.state, role[:1]]
        self.out(edit, role, text)

    def _next_role(self) -> str:
        return "assistant" if self.state == 2 else "user"

    def insertions(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            self._put("I", self._next_role(), b"")

    def turn(self, role: str, text: bytes) -> None:
        self.insertions()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            self._put(edit, role if edit == "K" else self._next_role(), text)


class Hashed(Repair):
    """The repaired ``role:text`` lines as one hash."""

    def __init__(self, audit: str):
        super().__init__(audit, self._line)
        self.sha, self.started = hashlib.sha256(), False

    def _line(self, edit: str, role: str, text: bytes) -> None:
        self.sha.update(b"\n" * self.started + role.encode() + b":" + text)
        self.started = True

    def turns(self, roles: Sequence[str], texts: Sequence[bytes]) -> None:
        for role, text in zip(roles, texts, strict=True):
            self.turn(role, text)

    def end(self) -> str:
        self.insertions()
        return self.sha.hexdigest()


def _walk(batches: Iterator[pa.RecordBatch], begin: Callable[[int | None, str], Repair]) -> Iterator[tuple]:
    """Runs of one conversation: results as they are, or its spans and then its blocks.

    ``begin(conv_id, audit)`` is called once the spans are combined and gives what walks
    the blocks. Yields (conv_id, walker or hash, facts, cost, audit, whether it was the
    last) after each block and at the end of a conversation.
    """
    conv: tuple | None = None
    facts, spans = Facts(), Spans()
    found: tuple | None = None

    def start() -> tuple:
        cost, audit = best(spans.whole())
        return conv[0], begin(conv[0], audit), facts, cost, audit

    names = ["lo", "hi", "first", "last", *_COUNTS]
    for batch in batches:
        for r, (conv_id, kind) in enumerate(zip(batch.column("conv_id").to_pylist(), batch.column("kind").to_pylist())):
            if conv is not None and conv != (conv_id,):
                yield *(found or start()), True
            if conv != (conv_id,):
                conv, facts, spans, found = (conv_id,), Facts(), Spans(), None
            if kind != 1:
                facts.add(Facts(**{c: batch.column(c)[r].as_py() for c in names}))
                costs, audits = batch.column("costs")[r].as_py(), batch.column("audits")[r].as_py()
            if kind == 2:
                found = conv_id, batch.column("sha256")[r].as_py(), facts, costs[0], audits[0]
            elif kind == 0:
                spans.add([None if c is None else (c, a) for c, a in zip(costs, audits, strict=True)])
            else:
                found = found or start()
                for role, text in zip(batch.column("roles")[r].as_py(), batch.column("texts")[r].as_py(), strict=True):
                    found[1].turn(role, text)
                yield *found, False
    if conv is not None:
        yield *(found or start()), True


def _batches(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    out: list[dict] = []
    size = 0
    for row in rows:
        out.append(row)
        size += len(row.get("text") or b"") + sum(map(len, row.get("texts") or ())) + len(row.get("audit") or "")
        if len(out) >= 4096 or size > 1 << 24:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
            out, size = [], 0
    yield pa.RecordBatch.from_pylist(out, schema=schema)


def _dealt(turns: DataFrame, present: Column | None, finish: bool) -> DataFrame:
    pieces = _pieces(turns, present, finish)
    return pieces.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "part", "seq")


def repair_report(turns: DataFrame, present: Column | None = None) -> DataFrame:
    """One row per conversation: its faults, its cheapest repair, and the repaired text's hash.

    ``turns`` has conv_id, turn, role, text. A conversation is its rows by turn, nulls
    first, ties by role and then by the SHA-256 of the text; a null role or text counts as
    one space, and rows with a null conv_id are one conversation. Rows for which
    ``present`` is not true only name their conversation. A turn is blank (no visible
    character), else a duplicate (role and text seen earlier), else truncated (the last
    visible character is none of ``.!?``). Allowed are turns whose role initials read
    ``(s?(ua)+)?``, so one whose role is empty can't be kept as it is. Edits: keep (0), give the role user or assistant (3), delete (4; a
    must for blank turns and duplicates), insert an empty user or assistant turn (3); a
    truncated turn that stays costs 3. Of equally cheap repairs the one whose initials
    sort first wins.

    Returns conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and
    repaired_sha256. A conversation without present turns has zeros, an empty audit and
    the hash of the empty text. An empty table gives an empty result; other columns are
    not read.

    The repair grammar in Chomsky normal form has a nonterminal for each pair of states
    before and after a span. Turns are range-partitioned in order, so a long conversation
    lies in many tasks: each parses blocks of 8 turns by a chart and combines their cells,
    8 at a time, to the cell of its part. A conversation that lies in one part is repaired
    there; the parts of the others, at most one per task, are combined where the repaired
    text is hashed, block by block (a hash reads its text in order, in one task).
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for conv_id, walker, facts, cost, audit, last in _walk(batches, lambda _, audit: Hashed(audit)):
            if last:
                sha = walker if isinstance(walker, str) else walker.end()
                counts = {c: getattr(facts, c) for c in ("blank", "duplicate", "truncated", "illegal")}
                yield {"conv_id": conv_id, "gaps": facts.gaps(), **counts, "cost": cost, "audit": audit, "repaired_sha256": sha}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(rows(batches), schema)

    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    schema = pa.schema(
        [("conv_id", pa.int64())] + [(c, pa.int64()) for c in numbers] + [("audit", pa.string()), ("repaired_sha256", pa.string())]
    )
    kinds = ", ".join(f"{c} long" for c in numbers)
    return _dealt(turns, present, True).mapInArrow(run, f"conv_id long, {kinds}, audit string, repaired_sha256 string")


def repaired_turns(turns: DataFrame, present: Column | None = None) -> DataFrame:
    """The repaired conversations of :func:`repair_report`: conv_id, place (from 0), edit, role, text.

    ``edit`` is K for kept, R for a changed role, I for an inserted turn; deleted turns
    have no row, and neither has a conversation of which nothing is left.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        made: list[dict] = []
        place = 0

        def begin(conv_id: int | None, audit: str) -> Repair:
            def out(edit: str, role: str, text: bytes) -> None:
                nonlocal place
                made.append({"conv_id": conv_id, "place": place, "edit": edit, "role": role, "text": text})
                place += 1

            return Repair(audit, out)

        for _, walker, _, _, _, last in _walk(batches, begin):
            if last:
                walker.insertions()
                place = 0
            yield from made
            made.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(rows(batches), schema)

    schema = pa.schema(
        [("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.binary())]
    )
    made = _dealt(turns, present, False).mapInArrow(run, "conv_id long, place long, edit string, role string, text binary")
    return made.withColumn("text", F.col("text").cast("string"))


# ---- the query -----------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """Turns with faults made by the CRC-32 of ``conv_id:turn`` modulo 20, and ``present``.

    0 drops a turn (it stays as a row that is not present), 1 empties its text, 2 removes
    its ``.!?``, 3 repeats it, 4 makes it a user's. A null counts as one space.
    """
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    role = F.coalesce(F.col("role").cast("string"), F.lit(" "))
    hurt = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"),
                                (F.crc32(key.cast("binary")) % 20).alias("fault"))
    return hurt.select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "")
        .when(F.col("fault") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        (F.col("fault") != 0).alias("present"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("fault") == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


OP12_SQL = r"""
WITH RECURSIVE
crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations),
hit AS (
  SELECT src.*, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(k) + 1),
      lambda i: CAST(ascii(k[i]) AS BIGINT))),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS f
  FROM src, crc),
turns AS (
  SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN f = 1 THEN '' WHEN f = 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM hit, range(CASE WHEN f = 3 THEN 2 ELSE 1 END) WHERE f <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i,
    left(role, 1) AS c, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS was,
    NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
    NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS cut
  FROM turns),
counted AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth,
    dense_rank() OVER (ORDER BY conv_id) AS g
  FROM placed),
flawed AS (SELECT *, blank OR nth > 1 AS bad, cut AND NOT blank AND nth = 1 AS part FROM counted),
facts AS (
  SELECT conv_id, g, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (blank) AS blank, count(*) FILTER (nth > 1 AND NOT blank) AS duplicate,
    count(*) FILTER (part) AS truncated,
    count(*) FILTER (was IS NOT NULL AND was || c NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM flawed GROUP BY conv_id, g),
moves AS (
  SELECT * FROM (VALUES (0, 's', 1, ''), (0, 'u', 2, 'user'), (1, 'u', 2, 'user'), (2, 'a', 3, 'assistant'),
    (3, 'u', 2, 'user')) AS m(p, r, q, name)),
adds AS (
  SELECT p, p AS q, 0 AS cost, '' AS audit, '' AS put FROM range(4) AS s(p)
  UNION ALL SELECT p, q, 3, 'I', chr(10) || name || ':' FROM moves WHERE r <> 's'
  UNION ALL SELECT a.p, b.q, 6, 'II', chr(10) || a.name || ':' || chr(10) || b.name || ':'
    FROM moves a JOIN moves b ON a.q = b.p WHERE a.r <> 's' AND b.r <> 's' AND a.p <> b.q),
dp(g, i, s, v) AS (
  SELECT g, CAST(0 AS BIGINT), q, {'cost': cost, 'audit': audit, 'put': put} FROM facts, adds WHERE p = 0
  UNION ALL
  SELECT o.g, o.i, adds.q, min({'cost': o.cost + adds.cost, 'audit': o.audit || adds.audit, 'put': o.put || adds.put})
  FROM (
    SELECT d.g, d.i + 1 AS i, d.s, d.v.cost + 4 AS cost, d.v.audit || 'D' AS audit, d.v.put AS put
    FROM dp d JOIN flawed f ON f.g = d.g AND f.i = d.i + 1
    UNION ALL
    SELECT d.g, d.i + 1, m.q, d.v.cost + 3 * CAST(f.part AS INTEGER), d.v.audit || 'K',
      d.v.put || chr(10) || f.role || ':' || f.text
    FROM dp d JOIN flawed f ON f.g = d.g AND f.i = d.i + 1 JOIN moves m ON m.p = d.s AND m.r = f.c WHERE NOT f.bad
    UNION ALL
    SELECT d.g, d.i + 1, m.q, d.v.cost + 3 + 3 * CAST(f.part AS INTEGER), d.v.audit || 'R',
      d.v.put || chr(10) || m.name || ':' || f.text
    FROM dp d JOIN flawed f ON f.g = d.g AND f.i = d.i + 1 JOIN moves m ON m.p = d.s AND m.r <> 's' WHERE NOT f.bad
  ) AS o JOIN adds ON adds.p = o.s
  GROUP BY o.g, o.i, adds.q),
won AS (
  SELECT f.*, min(d.v) AS v FROM facts f JOIN dp d ON d.g = f.g AND d.i = f.n AND d.s IN (0, 3) GROUP BY ALL),
every AS (SELECT DISTINCT conv_id FROM conversations)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(w.v.cost, 0) AS BIGINT) AS cost,
  coalesce(w.v.audit, '') AS audit, sha256(coalesce(substr(w.v.put, 2), '')) AS repaired_sha256
FROM every e LEFT JOIN won w ON e.conv_id IS NOT DISTINCT FROM w.conv_id
"""
