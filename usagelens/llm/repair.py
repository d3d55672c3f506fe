"""Conversation structure repair: the cheapest edits that make a conversation's roles alternate.

The roles' initials must read `(s?(ua)+)?`. The repair grammar is in Chomsky normal form: a nonterminal [p q] is
a span that leads the pattern from state p to state q; [p q] -> [p r][r q] for every state r, and [p q] -> row for
every edit of one row that does so. Inserted turns are empty productions, closed beforehand. A cell of the
chart holds, for each nonterminal, the least (cost, audit) of its span.

In this grammar some r stands at every cut of a span, so every cut gives the same cell and the chart needs one
cut a span: spans of 1, 2, 4, ... rows, joined bottom-up by length, n cells instead of n^2. It also lets a long
conversation be cut at ranges of turns, a task for each, and the ranges' cells be joined like any others.

Order of rows: conv_id, turn (null first), then role and the text's SHA-256. Rows equal in all four are taken
together with their number, so repeated rows and hot conversations spread over the ranges.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import pieces, stored, with_columns

# The edits' costs.
REROLE, DELETE, INSERT, UNFINISHED = 1, 2, 5, 5
SPACE = " \t\n\x0b\x0c\r"
#: What follows each state on an initial: 0 at the start, 1 after s, 2 after u, 3 after a. 0 and 3 may end.
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ROLE_OF = {2: "user", 3: "assistant"}
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
#: The nonterminals [p q] that derive anything, and for each the pairs of them it splits into.
PAIRS = [(0, 0), (0, 1), (0, 2), (0, 3), (1, 1), (1, 2), (1, 3), (2, 2), (2, 3), (3, 2), (3, 3)]
SPLITS = [[(PAIRS.index((p, r)), PAIRS.index((r, q))) for r in range(4) if (p, r) in PAIRS and (r, q) in PAIRS] for p, q in PAIRS]

Cell = tuple  # for each pair of PAIRS its (cost, audit), or None


def joined(left: Cell, right: Cell) -> Cell:
    """The cell of two spans side by side."""
    out = []
    for splits in SPLITS:
        cost, audit = None, ""
        for a, b in splits:
            x, y = left[a], right[b]
            if x is None or y is None:
                continue
            both = x[0] + y[0]
            if cost is None or both < cost:
                cost, audit = both, x[1] + y[1]
            elif both == cost and (other := x[1] + y[1]) < audit:
                audit = other
        out.append(None if cost is None else (cost, audit))
    return tuple(out)


@cache
def nothing() -> Cell:
    """The cell of no rows: the closure of insertions."""
    found = {(p, p): (0, "") for p in range(4)}
    for p in range(4):
        q, cost, audit = p, 0, ""
        while (q := NEXT[(q, "a" if q == 2 else "u")]) and (p, q) not in found:
            cost, audit = cost + INSERT, audit + "I"
            found[(p, q)] = (cost, audit)
    return tuple(found.get(pair) for pair in PAIRS)


def closed(edits: dict) -> Cell:
    return joined(joined(nothing(), tuple(edits.get(pair) for pair in PAIRS)), nothing())


@cache
def of_row(initial: str, is_cut: bool) -> Cell:
    """The cell of a row that may stay. A role with no initial of the pattern can't be kept."""
    more, edits = UNFINISHED if is_cut else 0, {}
    for p in range(4):
        edits[(p, p)] = (DELETE, "D")
    for (p, role), q in NEXT.items():
        options = [edits[(p, q)]] if (p, q) in edits else []
        if role != "s":
            options.append((REROLE + more, "R"))
        if role == initial:
            options.append((more, "K"))
        if options:
            edits[(p, q)] = min(options)
    return closed(edits)


def of_deleted(n: int) -> Cell:
    """The cell of n rows that all must go."""
    return closed({(p, p): (DELETE * n, "D" * n) for p in range(4)})


_one_deleted = cache(lambda: of_deleted(1))


class Span:
    """Rows side by side: their cell, and what is counted of them. Cells are joined by doubling lengths."""

    FIELDS = "n blank duplicate truncated illegal turns".split()

    def __init__(self):
        self.cells: list[tuple[int, Cell]] = []
        self.n = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = None  # initials
        self.least = self.most = None  # turns

    def push(self, length: int, cell: Cell) -> None:
        while self.cells and self.cells[-1][0] <= length:
            more, before = self.cells.pop()
            length, cell = length + more, joined(before, cell)
        self.cells.append((length, cell))

    def cell(self) -> Cell:
        out = None
        for _, cell in reversed(self.cells):
            out = cell if out is None else joined(cell, out)
        return out or nothing()

    def add(self, turn: int | None, role: str, n: int, is_first: bool, is_blank: bool, is_cut: bool) -> None:
        initial = role[:1]
        self.illegal += (n - 1) * ((initial, initial) not in LEGAL)
        if self.n:
            self.illegal += (self.last, initial) not in LEGAL
        else:
            self.first = initial
        self.last = initial
        self.n += n
        if turn is not None and turn != self.most:
            self.turns += 1
            self.most = turn
            self.least = turn if self.least is None else self.least
        if is_blank:
            self.blank += n
            gone = n
        else:
            gone = n - 1 if is_first else n
            self.duplicate += gone
            if is_first:
                self.truncated += is_cut
                self.push(1, of_row(initial, is_cut))
        if gone:
            self.push(gone, _one_deleted() if gone == 1 else of_deleted(gone))

    def follow(self, other: Span) -> None:
        """Add a span that stands right after this one."""
        if not other.n:
            return
        if self.n:
            self.illegal += (self.last, other.first) not in LEGAL
        else:
            self.first = other.first
        if other.least is not None:
            self.turns -= other.least == self.most
            self.least = other.least if self.least is None else self.least
            self.most = other.most
        self.last = other.last
        for name in self.FIELDS:
            setattr(self, name, getattr(self, name) + getattr(other, name))
        self.push(other.n, other.cell())

    def audit(self) -> tuple:
        """(gaps, blank, duplicate, truncated, illegal, cost, audit)"""
        cell = self.cell()
        cost, audit = min(cell[PAIRS.index((0, q))] for q in (0, 3) if cell[PAIRS.index((0, q))])
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit


def _turns(conversations: DataFrame) -> DataFrame:
    """The four columns without nulls in role and text, and the text's digest."""
    rows = with_columns(conversations, "conv_id", "turn", "role", "text")
    return rows.select(
        "conv_id",
        F.col("turn").try_cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    ).withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))


# Ascending, null first, as Spark sorts.
ORDER = ["conv_id", "turn", "role", "digest"]


def _end(text: Column) -> Column:
    """The last character that is no white space, or nothing."""
    return F.right(F.rtrim(text, F.lit(SPACE)), F.lit(1))


def faults(conversations: DataFrame) -> DataFrame:
    """Each distinct row with its number, whether its role and text come first here, and how its text ends.

    The texts themselves stay behind: only digests are shuffled. Both groupings combine before the shuffle.
    """
    rows = _turns(conversations)
    key = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    firsts = rows.groupBy("conv_id", "role", "digest").agg(F.min(key).alias("least"))
    marks = firsts.select(
        "conv_id", F.col("least.turn").alias("turn"), "role", "digest",
        F.lit(0).cast("long").alias("n"), F.lit(True).alias("is_first"), F.lit(False).alias("is_blank"), F.lit(False).alias("is_cut"),
    )
    counted = rows.withColumn("end", _end(F.col("text"))).select(
        "conv_id", "turn", "role", "digest", F.lit(1).cast("long").alias("n"), F.lit(False).alias("is_first"),
        (F.col("end") == "").alias("is_blank"), (~F.col("end").isin("", ".", "!", "?")).alias("is_cut"),
    )
    flags = [F.bool_or(c).alias(c) for c in ("is_first", "is_blank", "is_cut")]
    return counted.unionByName(marks).groupBy("conv_id", "turn", "role", "digest").agg(F.sum("n").alias("n"), *flags)


CELLS = ", ".join(f"cost_{p}{q} long, audit_{p}{q} string" for p, q in PAIRS)
COUNTS = "n long, blank long, duplicate long, truncated long, illegal long, turns long"
SPAN = f"turn long, role string, digest binary, {COUNTS}, first string, last string, least long, most long, {CELLS}"
AUDIT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _arrow(id_type: pa.DataType, ddl: str) -> pa.Schema:
    of = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([("conv_id", id_type), *((name, of[kind]) for name, kind in (x.split() for x in ddl.split(", ")))])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _emitted(rows: Iterator[tuple], ddl: str, id_type: pa.DataType, size: int) -> Iterator[pa.RecordBatch]:
    """Rows in batches; a row's text is its last value."""
    schema, held, chars = _arrow(id_type, ddl), [], 0
    for row in rows:
        held.append(row)
        chars += 100 + len(row[-1] or "")
        if chars > size:
            yield _batch(held, schema)
            held, chars = [], 0
    yield _batch(held, schema)


HELD = 4 << 20


def _spans(rows: Iterator[tuple]) -> Iterator[tuple]:
    """One row for each conversation of a range, from rows in order."""
    span = start = None
    for conv, turn, role, digest, n, is_first, is_blank, is_cut in rows:
        if start is None or conv != start[0]:
            if start:
                yield _span_row(start, span)
            span, start = Span(), (conv, turn, role, digest)
        span.add(turn, role, n, is_first, is_blank, is_cut)
    if start:
        yield _span_row(start, span)


def _span_row(start: tuple, span: Span) -> tuple:
    cells = [x for entry in span.cell() for x in (entry or (None, None))]
    return (*start, *(getattr(span, name) for name in Span.FIELDS), span.first, span.last, span.least, span.most, *cells)


def _span_of(values: tuple) -> Span:
    span, n = Span(), len(Span.FIELDS)
    for name, value in zip(Span.FIELDS, values):
        setattr(span, name, value)
    span.first, span.last, span.least, span.most = values[n : n + 4]
    cells = values[n + 4 :]
    span.cells = [(span.n, tuple(None if c is None else (c, a) for c, a in zip(cells[::2], cells[1::2])))]
    return span


def _audits(rows: Iterator[tuple]) -> Iterator[tuple]:
    """One row for each conversation, from the spans of its ranges in order."""
    whole, last = None, None
    for conv, _, _, _, *values in rows:
        span = _span_of(tuple(values))
        if whole is not None and conv == last:
            whole.follow(span)
            continue
        if whole is not None:
            yield (last, *whole.audit())
        whole, last = span, conv
    if whole is not None:
        yield (last, *whole.audit())


def audits(conversations: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) for each conversation that has rows.

    A null role or text counts as one space, a null conv_id as a conversation of its own; a turn that is no
    number counts as null. Extra columns are ignored. Rows are sorted in ranges of (conv_id, turn, ...): a hot
    conversation is parsed by many tasks, and only its ranges' cells meet in one.
    """
    rows = faults(conversations)
    id_type = rows.schema["conv_id"].dataType.simpleString()
    kind = pa.int64() if id_type == "bigint" else pa.int32() if id_type == "int" else pa.string()
    if kind == pa.string():
        rows, id_type = rows.withColumn("conv_id", F.col("conv_id").cast("string")), "string"
    columns = ["conv_id", "turn", "role", "digest", "n", "is_first", "is_blank", "is_cut"]
    ranged = rows.select(*columns).repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    spans = ranged.mapInArrow(
        lambda batches: _emitted(_spans(_rows(batches)), SPAN, kind, HELD), f"conv_id {id_type}, {SPAN}"
    )
    met = spans.repartition("conv_id").sortWithinPartitions(*ORDER)
    return met.mapInArrow(
        lambda batches: _emitted(_audits(_rows(batches)), AUDIT, kind, HELD), f"conv_id {id_type}, {AUDIT}"
    )


REPAIRED = "place long, role string, text string"


class _Walk:
    """Follows a conversation's audit along its rows."""

    def __init__(self, conv, audit: str):
        self.conv, self.audit, self.at, self.state, self.place = conv, audit, 0, 0, 0

    def _turn(self, role: str, text: str) -> tuple:
        self.place += 1
        return self.conv, self.place - 1, role, text

    def inserted(self) -> Iterator[tuple]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            self.state = NEXT[(self.state, "a" if self.state == 2 else "u")]
            yield self._turn(ROLE_OF[self.state], "")

    def row(self, role: str, text: str) -> Iterator[tuple]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = NEXT[(self.state, role[0])]
            yield self._turn(role, text)
        elif edit == "R":
            self.state = NEXT[(self.state, "a" if self.state == 2 else "u")]
            yield self._turn(ROLE_OF[self.state], text)


def _repaired(rows: Iterator[tuple]) -> Iterator[tuple]:
    walk = None
    for conv, kind, role, text in rows:
        if kind == 0:
            if walk:
                yield from walk.inserted()
            walk = _Walk(conv, text)
        else:
            yield from walk.row(role, text)
    if walk:
        yield from walk.inserted()


def repaired(conversations: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, place, role, text): the turns after the edits of `found`, the `audits` of the same rows.

    A conversation's audit comes before its rows in one sorted partition, so rows are edited as they stream by
    and nothing is held but the audit. Its rows stand together there, in order of place.
    """
    rows = _turns(conversations)
    id_type = found.schema["conv_id"].dataType
    kind = {"bigint": pa.int64(), "int": pa.int32()}.get(id_type.simpleString(), pa.string())
    turns = rows.select(F.col("conv_id").cast(id_type), F.lit(1).alias("kind"), "turn", "role", "digest", "text")
    heads = found.select(
        "conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
        F.lit(None).cast("binary").alias("digest"), F.col("audit").alias("text"),
    )
    placed = turns.unionByName(heads).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "digest")

    def run(batches):
        parts = (part for batch in batches for part in pieces(batch, "text"))
        yield from _emitted(_repaired(_rows(parts)), REPAIRED, kind, HELD)

    return placed.select("conv_id", "kind", "role", "text").mapInArrow(run, f"conv_id {id_type.simpleString()}, {REPAIRED}")


def _hashed(rows: Iterator[tuple]) -> Iterator[tuple]:
    digest, last = None, None
    for conv, place, role, text in rows:
        if place == 0:
            if digest:
                yield last, digest.hexdigest()
            digest, last = hashlib.sha256(), conv
        else:
            digest.update(b"\n")
        digest.update(f"{role}:{text}".encode())
    if digest:
        yield last, digest.hexdigest()


def digests(turns: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) over the `role:text` lines of each conversation, from `repaired`, as it orders them."""
    id_type = turns.schema["conv_id"].dataType.simpleString()
    kind = {"bigint": pa.int64(), "int": pa.int32()}.get(id_type, pa.string())

    def run(batches):
        parts = (part for batch in batches for part in pieces(batch, "text"))
        yield from _emitted(_hashed(_rows(parts)), "repaired_sha256 string", kind, HELD)

    return turns.mapInArrow(run, f"conv_id {id_type}, repaired_sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with faults put in by the remainder of crc32(conv_id:turn) by 20; a null is written as one space.

    0 drops the row, 1 empties its text, 2 takes `.`, `!` and `?` out of it, 3 repeats it, 4 makes it the user's.
    """
    rows = with_columns(conversations, "conv_id", "turn", "role", "text")
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    code, text = F.col("code"), F.coalesce("text", space)
    spoilt = rows.withColumn("code", F.crc32(key.cast("binary")) % 20).select(
        "conv_id",
        "turn",
        F.when(code == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(code == 1, "").when(code == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(code == 0, 0).when(code == 3, 2).otherwise(1).alias("times"),
    )
    return spoilt.select("conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(1), F.col("times").cast("int"))).alias("one")).drop("one")


def repair(conversations: DataFrame, conv_ids: DataFrame) -> DataFrame:
    """`audits` and the digest of the repaired turns for each row of `conv_ids` (distinct conv_id).

    Conversations without rows have zeros, an empty audit and the digest of empty text.
    """
    found = stored(audits(conversations), "audits")
    hashes = digests(repaired(conversations, found)).withColumnRenamed("conv_id", "_hashed")
    names = [x.split()[0] for x in AUDIT.split(", ")]
    ids = conv_ids.select(F.col("conv_id").cast(found.schema["conv_id"].dataType).alias("conv_id"))
    known = found.withColumnRenamed("conv_id", "_found")
    every = ids.join(known, F.col("conv_id").eqNullSafe(F.col("_found")), "left").join(
        hashes, F.col("conv_id").eqNullSafe(F.col("_hashed")), "left"
    )
    return every.select(
        "conv_id",
        *(F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in names[:-1]),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
