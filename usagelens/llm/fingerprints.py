"""Document fingerprints by context-triggered piecewise hashing.

A hash rolls over seven bytes of the text; where it hits a value that depends on the block size, a chunk
ends. Boundaries depend on nearby bytes only, so an edit changes the chunks it touches and no others. The
fingerprint lists a symbol for each chunk, at the block size that fits the text's length and at twice
that. Two fingerprints are compared where their block sizes meet, by the edit distance (insertions and
deletions) of their chunk lists.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import mixed, pieces, with_columns

ROLL = 7
LEAST_BLOCK = 3
#: The block size is the least 3 * 2^k that cuts a text into so many chunks at most on average.
CHUNKS = 96
SYMBOL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
PAIRS = [a + b for a in SYMBOL for b in SYMBOL]
# Bytes that are hashed at a time.
SEGMENT = 1 << 20
#: Ranges of ids for each shuffle partition.
RANGES = 4
WEIGHTS = [np.uint64(x) for x in mixed(np.arange(ROLL, dtype=np.uint64)) | np.uint64(1)]


def block_size(n_bytes: int) -> int:
    size = LEAST_BLOCK
    while size * CHUNKS < n_bytes:
        size *= 2
    return size


def triggers(data: bytes, block: int) -> tuple[np.ndarray, np.ndarray, int]:
    """For the places that end a chunk: the rolling hash, and the sum of hashes up to there; and the whole sum."""
    values, sums, total = [], [], np.uint64(0)
    tail = np.zeros(ROLL - 1, dtype=np.uint8)
    with np.errstate(over="ignore"):
        for at in range(0, len(data), SEGMENT):
            raw = np.concatenate([tail, np.frombuffer(data, np.uint8, min(SEGMENT, len(data) - at), at)])
            tail = raw[-(ROLL - 1) :]
            wide = raw.astype(np.uint64) + np.uint64(1)
            n = len(raw) - ROLL + 1
            rolled = wide[:n] * WEIGHTS[0]
            for k in range(1, ROLL):
                rolled += wide[k : k + n] * WEIGHTS[k]
            rolled ^= rolled >> np.uint64(29)
            rolled *= np.uint64(0xBF58476D1CE4E5B9)
            rolled ^= rolled >> np.uint64(32)
            running = np.cumsum(rolled) + total
            total = running[-1]
            ends = np.flatnonzero(rolled % np.uint64(block) == np.uint64(block - 1))
            values.append(rolled[ends])
            sums.append(running[ends])
    if not values:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), 0
    return np.concatenate(values), np.concatenate(sums), total


def symbols(sums: np.ndarray, total) -> str:
    """Two characters a chunk; what follows the last boundary is a chunk too."""
    with np.errstate(over="ignore"):
        chunks = np.diff(np.concatenate([[np.uint64(0)], sums, [np.uint64(total)]]).astype(np.uint64))
    if len(chunks) and len(sums) and chunks[-1] == 0:
        chunks = chunks[:-1]
    return "".join([PAIRS[x] for x in (mixed(chunks) >> np.uint64(52)).tolist()])


def fingerprint(text: str | None) -> str:
    """`block:chunks:chunks at twice the block size`; nothing but the block size for an empty text."""
    data = (text or "").encode()
    block = block_size(len(data))
    if not data:
        return f"{block}::"
    values, sums, total = triggers(data, block)
    double = values % np.uint64(2 * block) == np.uint64(2 * block - 1)
    return f"{block}:{symbols(sums, total)}:{symbols(sums[double], total)}"


def in_common(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, bit by bit in parallel."""
    places: dict[str, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for x in b:
        match = places.get(x)
        if match is not None:
            both = row & match
            row = ((row + both) | (row - both)) & full
    return len(a) - row.bit_count()


def likeness_of(a: str, b: str) -> float:
    """1 - edit distance / length of both, over chunk lists."""
    if a == b:
        return 1.0
    x, y = ([s[i : i + 2] for i in range(0, len(s), 2)] for s in (a, b))
    return 2 * in_common(x, y) / (len(x) + len(y)) if x and y else 0.0


def likeness(a: str, b: str) -> float:
    """0 to 1: the best over the block sizes that both fingerprints have; 0 if there is none."""
    if a == b:
        return 1.0
    (na, a1, a2), (nb, b1, b2) = a.split(":"), b.split(":")
    na, nb = int(na), int(nb)
    if not (a1 and b1):
        return 0.0
    if na == nb:
        return max(likeness_of(a1, b1), likeness_of(a2, b2))
    if na == 2 * nb:
        return likeness_of(a1, b2)
    return likeness_of(a2, b1) if nb == 2 * na else 0.0


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint for each row of `docs`; a null text counts as empty."""
    rows = with_columns(docs, "doc_id", "text")
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in pieces(batch, "text"):
                found = [fingerprint(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found, pa.string())], names=["doc_id", "fingerprint"])

    return rows.mapInArrow(run, f"doc_id {id_type}, fingerprint string")


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def range_starts(ids: DataFrame, n_ranges: int) -> list[int]:
    """The least doc_id of each of about `n_ranges` ranges of equally many rows, ascending."""
    ranged = ids.filter("doc_id is not null").repartitionByRange(n_ranges, "doc_id")
    least = ranged.groupBy(F.spark_partition_id().alias("range")).agg(F.min("doc_id").alias("doc_id"))
    return sorted(row.doc_id for row in least.collect())  # one number a range


OUT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def compare_neighbours(docs: DataFrame) -> DataFrame:
    """Each document against its edited text and against the next document, one row for each row of `docs`.

    The order is by doc_id, null ids first, equal ids by text (null as empty); after the last comes the first.
    A single row is its own next. Texts travel once, to the range of ids they are in; the first row of each
    range also goes to the range before, whose last row needs it. Extra columns are ignored.
    """
    rows = with_columns(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    n_parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    starts = np.array(range_starts(rows.select("doc_id"), RANGES * n_parts), dtype=np.int64)
    last = max(0, len(starts) - 1)

    @F.arrow_udf("int")
    def range_of(ids: pa.Array) -> pa.Array:
        known = ids.fill_null(-(2**63)).to_numpy(zero_copy_only=False)
        return pa.array(np.maximum(0, np.searchsorted(starts, known, side="right") - 1), pa.int32())

    @F.arrow_udf("boolean")
    def is_start(ids: pa.Array) -> pa.Array:
        known = ids.fill_null(int(starts[0]) if len(starts) else 0).to_numpy(zero_copy_only=False)
        return pa.array(np.isin(known, starts) if len(starts) else np.ones(len(known), dtype=bool))

    here = F.struct(F.col("own").alias("range"), F.lit(0).alias("extra"))
    before = F.struct(F.when(F.col("own") > 0, F.col("own") - 1).otherwise(F.lit(last)).alias("range"), F.lit(1).alias("extra"))
    placed = (
        rows.withColumn("own", range_of("doc_id"))
        .withColumn("starts", is_start("doc_id"))
        .select("doc_id", "text", F.explode(F.when(F.col("starts"), F.array(here, before)).otherwise(F.array(here))).alias("at"))
        .select("at.range", "at.extra", "doc_id", "text")
    )
    ordered = placed.repartition(n_parts, "range").sortWithinPartitions("range", "extra", "doc_id", "text")
    return ordered.mapInArrow(compare_in_order, OUT)


def compare_in_order(batches):
    """Rows come sorted by range; within one, the extra rows come last and only serve as the next one."""
    held = None  # (range, extra, id, text, fingerprint) of the row before
    for batch in batches:
        for part in pieces(batch, "text"):
            out = []
            for place, extra, doc_id, text in zip(*(c.to_pylist() for c in part.columns)):
                if held and held[0] == place and held[1] and extra:
                    continue
                row = (place, extra, doc_id, text, fingerprint(text))
                if held and held[0] == place and not held[1]:
                    out.append(compared(held[2], held[3], held[4], text, row[4]))
                held = row
            columns = zip(*out) if out else [[]] * 7
            fields = pa.schema(
                [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                 ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
            )
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields)], schema=fields)


def compared(doc_id, text: str, own: str, following: str, next_fingerprint: str) -> tuple:
    changed = edited(text, following)
    other = fingerprint(changed)
    return (
        doc_id,
        len(text),
        hashlib.sha256(changed.encode()).hexdigest(),
        own,
        other,
        likeness(own, other),
        likeness(own, next_fingerprint),
    )
