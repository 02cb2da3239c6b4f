"""Cheapest repair of conversations by Four-Russians block tables.

A conversation should read ``(s?(ua)+)?`` in the initials of its roles. Rows may be kept (0),
given role user or assistant (1), deleted (2; blank rows and repeats must be) and rows with
empty text may be inserted (5); a truncated row that stays costs 5 more. Of the cheapest edits
those whose initials D, I, K, R come first in ASCII order are taken.

The method. Let the vector of a place be the least cost of finishing from there in each of the
four states of the pattern. Less its minimum it takes few values, all found in advance, so a
step over one of the nine kinds of rows is a table of (vector, kind) to (vector, added cost),
and a step over a block of ``BLOCK`` rows is a table as well. A conversation is processed
from its end, block by block, one lookup each. For tracing, a block is expanded backward, row
by row, from the vector after it; then the edits are read forward, the least letter among the
optimal ones first, which is exact because suffixes are compared.

Spark's part. Equal rows are counted before any shuffle of texts (only a SHA-256 of the text
travels); repeats are found by a combining aggregation; kinds are cut into pieces where the
rows are range-partitioned, so a conversation that holds a third of all rows is spread; one
byte a row, less than the audit that is returned, meets per conversation. Only the repaired
texts of a conversation are streamed through one task in order, as its digest asks for, with
one batch of rows in memory.

Defined results: a null role or text counts as one space, and so do a null id or turn in the
hashed key of the damage. Rows without an id form one conversation. Rows of equal turn are
taken by role and then by the SHA-256 of the text (those of the damaged rows); equal rows
stand together. Rows of other roles are deleted or given a role. A conversation
whose rows were all dropped has zeros, an empty audit and the hash of nothing. Very long texts
are only hashed. An empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import arrow_schema, staged

BLOCK = 4  # rows of a block
KEEP_OR_TRUNCATED = 4  # kinds: s, u, a, other; the same truncated; to be deleted
DELETED = 8
KINDS = 9
START, SYSTEM, USER, ASSISTANT = range(4)  # states: what was read last
NEXT = {(START, 0): SYSTEM, (START, 1): USER, (SYSTEM, 1): USER, (USER, 2): ASSISTANT, (ASSISTANT, 1): USER}
ADDED = [USER, USER, ASSISTANT, USER]  # state after an inserted or reroled row
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
FAR = 1 << 40


def _with_inserts(costs: list[int]) -> list[int]:
    for _ in range(2):
        costs = [min(c, INSERT + costs[ADDED[q]]) for q, c in enumerate(costs)]
    return costs


END = tuple(_with_inserts([0, FAR, FAR, 0]))


def step(after: tuple, kind: int) -> list[int]:
    """Costs before a row of a kind, in each state, from those after it."""
    return _with_inserts([min(cost for _, cost, _ in _choices(after, kind, q)) for q in range(4)])


def _choices(after: tuple, kind: int, state: int) -> Iterator[tuple[str, int, int]]:
    """Letter, cost of finishing with it, and next state, of what may be done with a row."""
    yield "D", DELETE + after[state], state
    if kind != DELETED:
        kept = NEXT.get((state, kind % KEEP_OR_TRUNCATED))
        extra = TRUNCATED * (kind >= KEEP_OR_TRUNCATED)
        if kept is not None:
            yield "K", extra + after[kept], kept
        yield "R", REROLE + extra + after[ADDED[state]], ADDED[state]


class Tables:
    """All normalised vectors, and their transitions over rows and blocks."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        self.vectors = [END]  # END has minimum 0
        number = {END: 0}
        self.one: list[list[tuple[int, int]]] = []  # vector, kind -> vector, added cost
        for vector in self.vectors:  # grows while it is read
            row = []
            for kind in range(KINDS):
                costs = step(vector, kind)
                low = min(costs)
                costs = tuple(c - low for c in costs)
                if costs not in number:
                    number[costs] = len(self.vectors)
                    self.vectors.append(costs)
                row.append((number[costs], low))
            self.one.append(row)
        # the last kind of a block is met first; blocks are numbered with the first kind highest
        self.many = [[(v, 0)] for v in range(len(self.vectors))]
        for _ in range(block):
            self.many = [
                [(self.one[v][kind][0], cost + self.one[v][kind][1]) for kind in range(KINDS) for v, cost in row]
                for row in self.many
            ]
        self.trace = [
            [[self._letters(vector, kind, q) for q in range(4)] for kind in range(KINDS)] for vector in self.vectors
        ]

    def _letters(self, after: tuple, kind: int, state: int) -> tuple[str, int]:
        """The least letters up to and with those of a row, and the state then."""
        before, letters = step(after, kind), ""
        while True:
            options = [c for c in _choices(after, kind, state) if c[1] == before[state]]
            if before[state] == INSERT + before[ADDED[state]]:
                options.append(("I", 0, -1))
            letter, _, following = min(options)
            letters += letter
            if letter != "I":
                return letters, following
            state = ADDED[state]

    def solve(self, kinds: bytes) -> tuple[int, str]:
        """The least cost of a conversation, and its audit."""
        size, head = self.block, len(kinds) % self.block
        places = list(range(head, len(kinds), size))
        after, cost, vector = [], 0, 0  # vectors after each block, the last one first
        for at in reversed(places):
            after.append(vector)
            code = 0
            for kind in kinds[at : at + size]:
                code = code * KINDS + kind
            vector, added = self.many[vector][code]
            cost += added
        after.append(vector)
        for kind in reversed(kinds[:head]):
            vector, added = self.one[vector][kind]
            cost += added
        cost += self.vectors[vector][START]
        state, letters = START, []
        for at, stop in zip([0, *places], [head, *(p + size for p in places)]):
            vector, inside = after.pop(), []
            for kind in reversed(kinds[at:stop]):  # expand the block backward
                inside.append(vector)
                vector = self.one[vector][kind][0]
            for kind in kinds[at:stop]:
                found, state = self.trace[inside.pop()][kind][state]
                letters.append(found)
        while END[state]:
            letters.append("I")
            state = ADDED[state]
        return cost, "".join(letters)


@lru_cache(maxsize=1)
def tables() -> Tables:
    return Tables()


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text`` and ``times`` (0: dropped, 2: repeated), damaged
    by the hash of ``conv_id:turn``."""
    def of(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fate = F.crc32(F.concat(of("conv_id"), F.lit(":"), of("turn")).cast("binary")) % 20
    text = F.when(fate == 1, "").when(fate == 2, F.regexp_replace(of("text"), "[.!?]", "")).otherwise(of("text"))
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(fate == 4, "user").otherwise(of("role")).alias("role"), text.alias("text"),
        F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1).alias("times"),
    )


_PLACE = ["conv_id", "turn", "role", "sha"]
_PIECE = (
    "conv_id long, place int, kinds binary, blank long, duplicate long, truncated long, illegal long, "
    "first string, last string, low long, high long, turns long"
)
_REPAIR = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
)


def repairs(rows: DataFrame) -> DataFrame:
    """Faults and the cheapest audit of each conversation of ``damaged`` rows."""
    spaces = r"[\x20\x09-\x0D]"
    slim = rows.select(
        "conv_id", "turn", "role", F.sha2(F.col("text").cast("binary"), 256).alias("sha"), "times",
        (~F.col("text").rlike(rf"[^\x20\x09-\x0D]")).alias("blank"),
        (~F.col("text").rlike(rf"[.!?]{spaces}*\z")).alias("truncated"),
    )
    met = staged(slim.groupBy(*_PLACE, "blank", "truncated").agg(F.sum("times").alias("times")), "conversation-rows")
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    said = met.filter("times > 0 AND NOT blank")
    seen = said.groupBy(
        F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("sha").alias("s")
    ).agg(F.min(turn).alias("first"), F.count("*").alias("places")).filter("places > 1")
    again = (
        said.join(seen, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("sha") == F.col("s")))
        .filter(~turn.eqNullSafe(F.col("first")))
        .select(*_PLACE, F.lit(True).alias("again"))
    )
    marked = met.select("*", F.lit(False).alias("again")).unionByName(
        again.select(*_PLACE, F.lit(False).alias("blank"), F.lit(False).alias("truncated"), F.lit(0).cast("long").alias("times"), "again")
    )
    order = [F.asc_nulls_first(c) for c in _PLACE]
    pieces = (
        marked.repartitionByRange(*order)
        .sortWithinPartitions(*order, F.desc("again"))
        .mapInArrow(_pieces(), _PIECE)
    )
    return pieces.repartition("conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(_solved(), _REPAIR)


def _pieces():
    schema = arrow_schema(_PIECE)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        place, piece, again_at = TaskContext.get().partitionId(), None, None
        done: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in (*_PLACE, "blank", "truncated", "times", "again"))):
                if row[7]:  # stands before the row that it marks
                    again_at = row[:4]
                    continue
                if piece is None or piece.conv != row[0]:
                    if piece is not None:
                        done.append(piece.row(place))
                    piece = Piece(row[0])
                piece.add(row[1], row[2], row[4], row[5], row[6], again_at == row[:4])
            yield _record(done, schema)
            done = []
        if piece is not None:
            done.append(piece.row(place))
        yield _record(done, schema)

    return pieces


class Piece:
    """Consecutive rows of a conversation: a kind per row, and counts that join with those of
    the next piece."""

    def __init__(self, conv: int | None):
        self.conv, self.kinds = conv, bytearray()
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.low = self.high = None

    def add(self, turn: int | None, role: str, blank: bool, truncated: bool, times: int, again: bool) -> None:
        if not times:
            return
        initial = role[:1]
        if self.first is None:
            self.first = initial
        else:
            self.illegal += self.last + initial not in LEGAL
        self.illegal += times - 1  # equal initials side by side
        self.last = initial
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn
        if blank:
            self.blank += times
            self.kinds += bytes([DELETED]) * times
            return
        repeats = times if again else times - 1
        self.duplicate += repeats
        if not again:
            self.truncated += truncated
            self.kinds.append({"s": 0, "u": 1, "a": 2}.get(initial, 3) + KEEP_OR_TRUNCATED * truncated)
        self.kinds += bytes([DELETED]) * repeats

    def join(self, later: Piece) -> None:
        if later.first is not None:
            if self.first is None:
                self.first = later.first
            else:
                self.illegal += self.last + later.first not in LEGAL
            self.last = later.last
        if later.low is not None:
            self.turns += later.turns - (later.low == self.high)
            self.low = later.low if self.low is None else self.low
            self.high = later.high
        self.kinds += later.kinds
        for name in ("blank", "duplicate", "truncated", "illegal"):
            setattr(self, name, getattr(self, name) + getattr(later, name))

    def row(self, place: int) -> tuple:
        return (
            self.conv, place, bytes(self.kinds), self.blank, self.duplicate, self.truncated, self.illegal,
            self.first, self.last, self.low, self.high, self.turns,
        )

    @classmethod
    def read(cls, row: tuple) -> Piece:
        piece = cls(row[0])
        piece.kinds = bytearray(row[2])
        (piece.blank, piece.duplicate, piece.truncated, piece.illegal,
         piece.first, piece.last, piece.low, piece.high, piece.turns) = row[3:]
        return piece


LEGAL = {"su", "ua", "au"}


def _solved():
    schema = arrow_schema(_REPAIR)

    def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole: Piece | None = None
        done: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                piece = Piece.read(row)
                if whole is not None and whole.conv == piece.conv:
                    whole.join(piece)
                    continue
                if whole is not None:
                    done.append(_repair(whole))
                whole = piece
            yield _record(done, schema)
            done = []
        if whole is not None:
            done.append(_repair(whole))
        yield _record(done, schema)

    return solved


def _repair(piece: Piece) -> tuple:
    cost, audit = tables().solve(bytes(piece.kinds))
    gaps = piece.high - piece.low + 1 - piece.turns if piece.low is not None else 0
    return piece.conv, gaps, piece.blank, piece.duplicate, piece.truncated, piece.illegal, cost, audit


def _record(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def repaired(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """The repaired rows of each conversation: ``conv_id``, ``position``, ``role``, ``text``.
    Each conversation is streamed in order."""
    return _streamed(rows, audits).mapInArrow(_rows_out(), "conv_id long, position long, role string, text string")


def digests(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """``repaired_sha256`` of the repaired rows as ``role:text``, joined by newlines."""
    return _streamed(rows, audits).mapInArrow(_digests_out(), "conv_id long, repaired_sha256 string")


def _streamed(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """Each conversation's audit and then its rows in order, in one partition."""
    sha = F.sha2(F.col("text").cast("binary"), 256).alias("sha")
    both = audits.select(
        "conv_id", F.lit(0).alias("part"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
        F.lit("").alias("sha"), F.col("audit").alias("text"), F.lit(1).alias("times"),
    ).union(
        rows.filter("times > 0").select("conv_id", F.lit(1).alias("part"), "turn", "role", sha, "text", "times")
    )
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "part", "turn", "role", "sha")


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, None, None) where a conversation begins, then (conv_id, role, text) per row."""
    conv, audit, at, wanted, written = None, "", 0, 0, 0

    def role_here() -> str:
        return "user" if (written - wanted % 2) % 2 == 0 else "assistant"

    for batch in batches:
        columns = (batch[c].to_pylist() for c in ("conv_id", "part", "role", "text", "times"))
        for conv_id, part, role, text, times in zip(*columns):
            if part == 0:
                while at < len(audit):  # inserted after the last row of the conversation before
                    yield conv, role_here(), ""
                    at, written = at + 1, written + 1
                conv, audit, at, written = conv_id, text, 0, 0
                wanted = len(audit) - audit.count("D")
                yield conv, None, None
                continue
            for _ in range(times):
                while audit[at] == "I":
                    yield conv, role_here(), ""
                    at, written = at + 1, written + 1
                if audit[at] != "D":
                    yield conv, role if audit[at] == "K" else role_here(), text
                    written += 1
                at += 1
    while at < len(audit):
        yield conv, role_here(), ""
        at, written = at + 1, written + 1


def _rows_out():
    schema = arrow_schema("conv_id long, position long, role string, text string")

    def rows_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = position = 0
        for conv, role, text in _edited(batches):
            if role is None:
                position = 0
                continue
            held.append((conv, position, role, text))
            position, size = position + 1, size + len(text)
            if len(held) >= 1_000 or size >= 1 << 22:
                yield _record(held, schema)
                held, size = [], 0
        yield _record(held, schema)

    return rows_out


def _digests_out():
    schema = arrow_schema("conv_id long, repaired_sha256 string")

    def digests_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        digest, of, rows = None, None, 0
        for conv, role, text in _edited(batches):
            if role is None:
                if digest is not None:
                    held.append((of, digest.hexdigest()))
                if len(held) >= 5_000:
                    yield _record(held, schema)
                    held = []
                digest, of, rows = hashlib.sha256(), conv, 0
                continue
            digest.update(f"\n{role}:{text}"[rows == 0 :].encode("utf-8", "surrogatepass"))
            rows += 1
        if digest is not None:
            held.append((of, digest.hexdigest()))
        yield _record(held, schema)

    return digests_out


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``damaged`` rows: faults, cost, audit, digest."""
    found = staged(repairs(rows), "conversation-audits")
    return found.join(
        digests(rows, found).withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c"))
    ).drop("c")
