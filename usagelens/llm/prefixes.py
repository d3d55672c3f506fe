"""Prefix trie of conversations, with a count-min sketch in front of the exact grouping.

Every conversation is a path of turns from the root; conversations with the same first d turns (role and text)
share a node of depth d. A prefix is known by a 127-bit digest, a polynomial over its turns' digests, which can be
continued from one range of turns to the next: a conversation of any length is cut over many tasks.

The sketch counts all prefix digests in `SKETCH_ROWS` rows of counters, of which only "one" or "more" is kept, a bit
each. A prefix whose estimate is one belongs to one conversation: its node is emitted where it is. Only the other
prefixes are shuffled and grouped exactly. The sketch has 16 counters a prefix and at most `MAX_WIDTH` a row; a
larger corpus fills it and proves fewer singletons, which changes what is shuffled but not the result.

What a node needs of its subtree is a sum over its members, so nothing walks the tree. Let r(c) be the least depth
at which c is the smallest member of its node, and stays so below. A child is counted by its smallest member, a leaf
by the member that is smallest there, and (members - 1) times the length, summed over a subtree, is the sum over
members c of the lengths from the node down to depth r(c) - 1.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import stored, with_columns

PRIME = (1 << 127) - 1
BASE = int.from_bytes(hashlib.sha256(b"prefix").digest()[:15], "big")
SKETCH_ROWS = 2
CELLS_PER_PREFIX = 16
#: Counters of a sketch row at most, so that the bits of all rows take 32 MB where they are broadcast.
MAX_WIDTH = 1 << 27
MIN_WIDTH = 1 << 16
# Counters whose bits travel as one value.
BLOCK = 1 << 15
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def digested(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, key, n_chars): a digest of role and text, null as empty, and the text's code points.

    Rows without a numeric conv_id belong to no conversation and are left out; a turn that is no number counts as null.
    """
    rows = with_columns(conversations, "conv_id", "turn", "role", "text")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    narrow = rows.select(
        F.col("conv_id").try_cast("long").alias("conv_id"),
        F.col("turn").try_cast("long").alias("turn"),
        F.unhex(F.sha2(whole.cast("binary"), 256)).alias("key"),
        F.length(text).cast("long").alias("n_chars"),
    )
    return narrow.filter("conv_id is not null")


PLACED = pa.schema(
    [
        ("conv_id", pa.int64()), ("depth", pa.int64()), ("key", pa.binary()), ("n_chars", pa.int64()), ("chars", pa.int64()),
        ("hi", pa.int64()), ("lo", pa.int64()), ("parent_hi", pa.int64()), ("parent_lo", pa.int64()),
        ("piece", pa.int32()), ("is_last", pa.bool_()), ("is_first_here", pa.bool_()), ("is_last_here", pa.bool_()),
    ]
)
PLACED_DDL = (
    "conv_id long, depth long, key binary, n_chars long, chars long, hi long, lo long, parent_hi long, parent_lo long, "
    "piece int, is_last boolean, is_first_here boolean, is_last_here boolean"
)


def halves(digest: int) -> tuple[int, int]:
    """A digest as two signed 64-bit numbers."""
    return digest >> 64, (digest & (2**64 - 1)) - 2**63


def whole(hi: int, lo: int) -> int:
    return hi << 64 | (lo + 2**63)


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Depth, running digest and running length of each row, counted from the start of this range.

    `is_first_here` and `is_last_here` mark the rows of the range's first and last conversation.
    """
    piece = TaskContext.get().partitionId()
    conv, depth, chars, digest, first, held = None, 0, 0, 0, None, None
    for batch in batches:
        out = []
        for row_conv, key, n_chars in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "key", "n_chars"))):
            if held is not None:
                held[10] = row_conv != conv
                out.append(held)
            if row_conv != conv:
                first = row_conv if conv is None else first
                conv, depth, chars, digest = row_conv, 0, 0, 0
            before = halves(digest)
            depth, chars = depth + 1, chars + n_chars
            digest = (digest * BASE + int.from_bytes(key[:16], "big") + 1) % PRIME
            held = [conv, depth, key, n_chars, chars, *halves(digest), *before, piece, False, conv == first, False]
        yield _placed(out)
    if held is not None:
        # Whether the last row ends its conversation is seen when the ranges are joined.
        held[10] = held[12] = True
        yield _placed([held])


def _placed(rows: list) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(PLACED)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, PLACED)], schema=PLACED)


def _offsets(ends: list) -> tuple[dict, set]:
    """What the conversation that a range begins in had before it, by range; and the ranges that end within one.

    `ends` has, for each range, the last row of its first and of its last conversation.
    """
    offsets, open_ended = {}, set()
    conv, last_piece, depth, chars, digest = None, None, 0, 0, 0
    pieces: dict[int, list] = {}
    for row in ends:
        pieces.setdefault(row.piece, []).append(row)
    for piece in sorted(pieces):
        rows = sorted(pieces[piece], key=lambda r: r.is_last_here)
        first, last = rows[0], rows[-1]
        if first.conv_id == conv:
            offsets[piece] = (conv, depth, chars, digest)
            open_ended.add(last_piece)
        if last.conv_id != conv:
            depth = chars = digest = 0
        digest = (digest * pow(BASE, last.depth, PRIME) + whole(last.hi, last.lo)) % PRIME
        conv, last_piece, depth, chars = last.conv_id, piece, depth + last.depth, chars + last.chars
    return offsets, open_ended


def in_order(turns: DataFrame) -> DataFrame:
    """The turns with their depth from 1 and the digest and length of the prefix they end, stored.

    The order is by turn, null first, then by the turn's digest. Ranges of (conv_id, turn) are sorted by a task each;
    two rows of each range, at most, tell the driver how the conversations that cross ranges go on.
    """
    order = ["conv_id", "turn", "key"]  # ascending, null first
    ranged = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    local = stored(ranged.mapInArrow(_running, PLACED_DDL), "turns")
    ends = local.filter("is_last_here or (is_first_here and is_last)")
    offsets, open_ended = _offsets(ends.select("piece", "conv_id", "depth", "chars", "hi", "lo", "is_last_here").collect())
    if not offsets:
        return local

    def join(batches):
        for batch in batches:
            rows = [list(x) for x in zip(*(c.to_pylist() for c in batch.columns))]
            for row in rows:
                if row[9] in offsets and offsets[row[9]][0] == row[0]:
                    _, depth, chars, digest = offsets[row[9]]
                    own, before = whole(row[5], row[6]), whole(row[7], row[8])
                    row[5:7] = halves((digest * pow(BASE, row[1], PRIME) + own) % PRIME)
                    row[7:9] = halves((digest * pow(BASE, row[1] - 1, PRIME) + before) % PRIME)
                    row[1], row[4] = row[1] + depth, row[4] + chars
                if row[12] and row[9] in open_ended:
                    row[10] = False
            yield _placed(rows)

    return stored(local.mapInArrow(join, PLACED_DDL), "prefixes")


def _cells(width: int) -> list:
    return [F.col(c).bitwiseAND(F.lit(width - 1).cast("long")) for c in ("hi", "lo")]


def sketch(prefixes: DataFrame) -> tuple[int, list[bytes]]:
    """The width of a sketch row, and for each row the counters above one, a bit each."""
    width = MIN_WIDTH
    while width < min(MAX_WIDTH, CELLS_PER_PREFIX * prefixes.count()):
        width *= 2
    at = F.explode(F.array(*(F.struct(F.lit(i).alias("row"), c.alias("cell")) for i, c in enumerate(_cells(width)))))
    more = prefixes.select(at.alias("at")).groupBy("at.row", "at.cell").count().filter("count > 1")
    block, rest = F.expr(f"cell div {BLOCK}"), (F.col("cell") % BLOCK).cast("int")
    blocks = more.groupBy("row", block.alias("block")).agg(F.collect_list(rest).alias("cells"))  # BLOCK numbers at most

    def packed(batches):
        for batch in batches:
            out = []
            for cells in batch.column("cells").to_pylist():
                bits = np.zeros(BLOCK, dtype=bool)
                bits[cells] = True
                out.append(np.packbits(bits, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("block"), pa.array(out, pa.binary())], names=["row", "block", "bits"])

    rows = [bytearray(width // 8) for _ in range(SKETCH_ROWS)]
    # Bounded: the bits of all rows, 2 * MAX_WIDTH / 8 bytes.
    for found in blocks.mapInArrow(packed, "row int, block long, bits binary").collect():
        start = found.block * BLOCK // 8
        rows[found.row][start : start + BLOCK // 8] = found.bits
    return width, [bytes(r) for r in rows]


def screened(prefixes: DataFrame) -> DataFrame:
    """The prefixes with `maybe` (the estimate is above one) and `parent_maybe`, the same for the prefix before."""
    width, rows = sketch(prefixes)
    shared = prefixes.sparkSession.sparkContext.broadcast(rows)

    def run(batches):
        planes = [np.frombuffer(r, dtype=np.uint8) for r in shared.value]

        def above_one(*columns):
            out = True
            for plane, column in zip(planes, columns):
                cell = column.to_numpy() & (width - 1)
                out = out & ((plane[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1).astype(bool)
            return out

        for batch in batches:
            own = above_one(batch.column("hi"), batch.column("lo"))
            before = above_one(batch.column("parent_hi"), batch.column("parent_lo")) & (batch.column("depth").to_numpy() > 1)
            columns = [batch.column(c) for c in KEPT]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(own), pa.array(before)], names=[*KEPT, "maybe", "parent_maybe"])

    narrow = prefixes.select(*KEPT)
    return stored(narrow.mapInArrow(run, f"{KEPT_DDL}, maybe boolean, parent_maybe boolean"), "screened")


KEPT = "conv_id depth n_chars chars hi lo parent_hi parent_lo is_last".split()
KEPT_DDL = "conv_id long, depth long, n_chars long, chars long, hi long, lo long, parent_hi long, parent_lo long, is_last boolean"


def _end_digests(rows: DataFrame) -> DataFrame:
    """(hi, lo, ends_sha256) over each node's conv_ids, ascending, from (hi, lo, conv_id).

    Hashing a list goes from its first id to its last, so a node's ids stream through one task, never held together.
    """

    def run(batches):
        digest, last = None, None
        for batch in batches:
            out = []
            for hi, lo, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if (hi, lo) == last:
                    digest.update(b",%d" % conv)
                    continue
                if last is not None:
                    out.append((*last, digest.hexdigest()))
                digest, last = hashlib.sha256(b"%d" % conv), (hi, lo)
            yield _ends(out)
        yield _ends([] if last is None else [(*last, digest.hexdigest())])

    def _ends(out):
        columns = zip(*out) if out else [[]] * 3
        kinds = (pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["hi", "lo", "ends_sha256"])

    key = ["hi", "lo"]
    placed = rows.select(*key, "conv_id").repartition(*key).sortWithinPartitions(*key, "conv_id")
    return placed.mapInArrow(run, "hi long, lo long, ends_sha256 string")


def nodes(turns: DataFrame, conv_ids: DataFrame) -> DataFrame:
    """One row for each node of the trie of `turns` (conv_id, turn, key, n_chars), columns as in `COLUMNS`.

    `conv_ids` lists all members, distinct and not null, also those without turns. Turns of equal number stand in
    order of their digests. Without members there are no nodes, not even the root.
    """
    prefixes = screened(in_order(turns))
    maybe, parent_maybe = F.col("maybe"), F.col("parent_maybe")
    start = F.struct(F.col("depth"), (F.col("chars") - F.col("n_chars")).alias("chars"))  # of the node, and the text before it
    key = ["hi", "lo"]

    # The smallest member of each node that may be shared.
    least = prefixes.filter(maybe).groupBy(*key).agg(
        F.min("conv_id").alias("least"), F.min(start).alias("start"), F.bool_and("is_last").alias("is_leaf")
    )
    least = stored(least, "least")

    # For each conversation: where it becomes the smallest, whether it stands for a leaf, and its length.
    nothing = F.lit(None).cast("struct<depth: bigint, chars: bigint>")
    proven = prefixes.filter(~maybe & ~parent_maybe & (F.col("depth") == 1) | ~maybe & parent_maybe)
    facts = (
        least.select(F.col("least").alias("conv_id"), "start", "is_leaf", F.lit(None).cast("long").alias("total"))
        .unionByName(proven.select("conv_id", start.alias("start"), F.lit(False).alias("is_leaf"), F.lit(None).cast("long").alias("total")))
        .unionByName(
            prefixes.filter("is_last").select("conv_id", nothing.alias("start"), (~maybe).alias("is_leaf"), F.col("chars").alias("total"))
        )
    )
    per_conv = facts.groupBy("conv_id").agg(F.min("start").alias("first"), F.max("is_leaf").cast("long").alias("leaf"), F.max("total").alias("total"))
    per_conv = stored(per_conv, "conversations")
    reached = F.coalesce("first.chars", "total")  # the text before the depth at which it is the smallest

    # Sums over the members of a node.
    known = per_conv.withColumnRenamed("conv_id", "_conv")
    joined = prefixes.filter(maybe | parent_maybe).join(known, F.col("conv_id") == F.col("_conv"))
    first = F.col("first.depth")
    saved = F.when(first.isNull() | (F.col("depth") < first), reached - (F.col("chars") - F.col("n_chars"))).otherwise(0)
    has_own_child = (first == F.col("depth") + 1) | (first <= F.col("depth")) & ~F.col("is_last")
    grouped = (
        joined.filter(maybe)
        .groupBy(*key)
        .agg(
            F.min(F.struct("conv_id", first.alias("first"))).alias("top"),
            F.max("depth").alias("depth"),
            F.max("parent_hi").alias("parent_hi"),
            F.max("parent_lo").alias("parent_lo"),
            F.count(F.lit(1)).alias("n_convs"),
            F.sum(F.coalesce(has_own_child, F.lit(False)).cast("long")).alias("n_children"),
            F.sum("leaf").alias("n_leaves"),
            F.sum(saved).alias("saved_tokens"),
        )
        .withColumns({"conv_id": F.col("top.conv_id"), "is_entry": F.col("top.first") == F.col("depth")})
        .drop("top")
    )
    ended = prefixes.filter(maybe & F.col("is_last")).select(*key, "conv_id")
    turnless = conv_ids.join(known, F.col("conv_id") == F.col("_conv"), "left_anti")
    at_root = turnless.select(F.lit(0).cast("long").alias("hi"), F.lit(0).cast("long").alias("lo"), "conv_id")
    ends = stored(_end_digests(ended.unionByName(at_root)), "ends")

    one = F.lit(1).cast("long")
    own_end = F.when(F.col("is_last"), F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)).otherwise(EMPTY_SHA256)
    single = {
        "n_convs": one, "n_children": (~F.col("is_last")).cast("long"), "n_leaves": one,
        "saved_tokens": F.lit(0).cast("long"), "ends_sha256": own_end,
    }
    wide = ["conv_id", "depth", "parent_hi", "parent_lo", "is_entry", *COLUMNS[3:]]
    shared = grouped.join(ends, key, "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)))
    border = joined.filter(~maybe).withColumns({**single, "is_entry": first == F.col("depth")})
    rest = stored(shared.select(*wide).unionByName(border.select(*wide)), "nodes")

    members = conv_ids.agg(F.min("conv_id").alias("root"), F.count(F.lit(1)).alias("n"))
    sums = per_conv.agg(
        F.coalesce(F.sum((first == 1).cast("long")), F.lit(0)).alias("n_children"),
        F.coalesce(F.sum("leaf"), F.lit(0)).alias("n_leaves"),
        F.coalesce(F.sum(reached), F.lit(0)).alias("saved_tokens"),
    )
    root_ends = ends.filter("hi = 0 and lo = 0").agg(F.coalesce(F.max("ends_sha256"), F.lit(EMPTY_SHA256)).alias("ends_sha256"))
    root = (
        members.filter("n > 0").crossJoin(F.broadcast(sums)).crossJoin(F.broadcast(root_ends))  # one row each
        .select(
            F.col("root").alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"),
            F.col("n").alias("n_convs"), "n_children",
            F.when(F.col("n_children") == 0, one).otherwise(F.col("n_leaves")).alias("n_leaves"), "saved_tokens", "ends_sha256",
        )
    )
    smallest = F.broadcast(members.select(F.col("root").alias("parent_conv_id")))  # one row

    local = prefixes.filter(~maybe & ~parent_maybe).withColumns(single)
    deeper = local.filter("depth > 1").withColumn("parent_conv_id", F.col("conv_id"))
    tops = local.filter("depth = 1").crossJoin(smallest).unionByName(
        rest.filter("depth = 1").crossJoin(smallest), allowMissingColumns=True
    )
    stay = rest.filter("depth > 1 and not is_entry").withColumn("parent_conv_id", F.col("conv_id"))
    parents = least.select(F.col("hi").alias("parent_hi"), F.col("lo").alias("parent_lo"), F.col("least").alias("parent_conv_id"))
    enter = rest.filter("depth > 1 and is_entry").join(parents, ["parent_hi", "parent_lo"])
    out = root
    for part in (deeper, tops, stay, enter):
        out = out.unionByName(part.select(*COLUMNS))
    return out


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of whole conversations (conv_id, turn, role, text); null role or text is empty, extra columns are ignored."""
    turns = digested(conversations)
    return nodes(turns, turns.select("conv_id").distinct())


def rebuilt(conversations: DataFrame, every: int = 100, most: int = 5) -> tuple[DataFrame, DataFrame]:
    """(turns, conv_ids) where each conversation begins with turns of the first one of its hundred.

    Conversation c takes the first h = crc32(c) % 6 turns of c - c % 100 and then its own after its first h. A
    head has five turns at most and goes to the conversations of its hundred; the other turns stay where they are.
    """
    turns = digested(conversations)
    own = in_order(turns).select("conv_id", "depth", "key", "n_chars")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)
    head = F.sort_array(F.collect_list(F.struct("depth", "key", "n_chars"))).alias("head")
    heads = own.filter(F.col("depth") <= most).groupBy(F.col("conv_id").alias("base")).agg(head)
    conv_ids = stored(turns.select("conv_id").distinct(), "conv-ids")
    wanting = conv_ids.select("conv_id", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % every).alias("base"))
    taken = wanting.join(heads, "base").select("conv_id", F.explode(F.expr("slice(head, 1, cast(h as int))")).alias("x"))
    before = taken.select("conv_id", F.col("x.depth").alias("turn"), "x.key", "x.n_chars")
    after = own.filter(F.col("depth") > h).select("conv_id", (F.col("depth") + most).alias("turn"), "key", "n_chars")
    return before.unionByName(after), conv_ids
