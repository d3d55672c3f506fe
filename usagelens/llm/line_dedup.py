"""Line dedup with a sharded minimal perfect hash.

Hashes of the long lines are counted over all documents. The lines found in enough documents are cut into
shards, and a task for each shard builds a minimal perfect hash over its line hashes together with
arrays of fingerprints, document counts and largest ids, without the lines or their hashes. Documents
look their lines up in these arrays: one slot, one comparison of fingerprints, no join of lines.

The arrays go to the tasks as a broadcast of at most `MAX_INDEX_BYTES`; beyond it the shards are taken in
groups of that size, and the documents pass one group after another, written in between.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import grouped, mixed, numbers, pieces, stored, with_columns

MIN_CHARS = 40
MIN_DOCS = 5
SHARD_KEYS = 1 << 15
MAX_INDEX_BYTES = 64 << 20
STRIP = " \t\n\x0b\x0c\r"
# Bits a key in each level of the hash; more make lookups shorter and the index larger.
ROOM = 2.0
ONES = np.array([bin(b).count("1") for b in range(256)], dtype=np.uint8)
NO_ID = -(2**63)


def key_of(line: str) -> str:
    """The line as it is compared: white space stripped, A-Z in lower case."""
    line = line.strip(STRIP)
    return line.lower() if line.isascii() else line.encode().lower().decode()


def long_keys(lines: list[str], min_chars: int) -> list[tuple[int, str]]:
    """(line number, key) of the lines that are long enough to count."""
    keys = ((n, key_of(line)) for n, line in enumerate(lines) if len(line) >= min_chars)
    return [(n, key) for n, key in keys if len(key) >= min_chars]


def hashed(keys: list[str]) -> np.ndarray:
    """128 bits a key: two columns of unsigned numbers."""
    raw = b"".join(xxhash.xxh3_128_digest(k) for k in keys)
    return np.frombuffer(raw, dtype=">u8").astype(np.uint64).reshape(-1, 2)


class PerfectHash:
    """A minimal perfect hash: numbers distinct keys 0 to n - 1, in a few bits each.

    Each level is a bit array; keys that are alone at their place are numbered there, the others go on to
    the next level. Any other key gets some number or -1.
    """

    def __init__(self, keys: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        base = 0
        while len(keys):
            size = 64 * max(1, round(ROOM * len(keys) / 64))
            at = self.place(keys, len(self.levels), size)
            alone = np.bincount(at, minlength=size) == 1
            bits = np.packbits(alone, bitorder="little")
            ones = np.cumsum(ONES[bits], dtype=np.int64)
            before = np.concatenate([[0], ones[:-1]]) + base
            self.levels.append((bits, before.astype(np.int32)))
            base += int(ones[-1])
            keys = keys[~alone[at]]

    @staticmethod
    def place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mixed(keys[:, 0] ^ mixed(keys[:, 1], level), level) % np.uint64(size)).astype(np.int64)

    def number(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, dtype=np.int64)
        left = np.arange(len(keys))
        for level, (bits, before) in enumerate(self.levels):
            if not len(left):
                break
            at = self.place(keys[left], level, 8 * len(bits))
            byte, bit = at >> 3, (at & 7).astype(np.uint8)
            here = (bits[byte] >> bit) & 1 == 1
            below = ONES[bits[byte] & ((np.uint8(1) << bit) - np.uint8(1))]
            out[left[here]] = before[byte[here]] + below[here]
            left = left[~here]
        return out


class Shard:
    """The repeated lines of one shard: perfect hash, fingerprints, counts, largest ids."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, largest: np.ndarray):
        self.hash = PerfectHash(keys)
        slot = self.hash.number(keys)
        order = np.argsort(slot)
        self.fingerprints = keys[order, 1]
        self.counts = counts[order].astype(np.uint32)
        self.largest = largest[order]

    def look_up(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each key, the documents that hold it (0: not in the index) and the largest id."""
        slot = self.hash.number(keys)
        known = slot >= 0
        known[known] = self.fingerprints[slot[known]] == keys[known, 1]
        at = np.where(known, slot, 0)
        return np.where(known, self.counts[at], 0), self.largest[at]


def repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """high, low (the line's hash), n_docs, largest (id): lines in at least `min_docs` documents."""

    def lines(batches):
        for batch in batches:
            for part in pieces(batch, "text"):
                ids, found = [], []
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    keys = {k for _, k in long_keys((text or "").split("\n"), min_chars)}
                    found.extend(keys)
                    ids.extend([doc_id] * len(keys))
                both = hashed(found).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(ids, pa.int64())],
                    names=["high", "low", "doc_id"],
                )

    return (
        with_columns(docs, "doc_id", "text")
        .select(F.col("doc_id").cast("long"), "text")
        .mapInArrow(lines, "high long, low long, doc_id long")
        .groupBy("high", "low")
        .agg(F.count("*").alias("n_docs"), F.coalesce(F.max("doc_id"), F.lit(NO_ID)).alias("largest"))
        .filter(F.col("n_docs") >= min_docs)
    )


def build_index(lines: DataFrame, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """shard, n_shards, n_keys, data (pickled `Shard`): one row a shard, from `repeated_lines`."""
    lines = stored(lines, "lines")
    n_shards = max(1, -(-lines.count() // shard_keys))

    def build(batches):
        for group in grouped(batches, "shard"):
            keys = np.stack([numbers(group, c).view(np.uint64) for c in ("high", "low")], axis=1)
            shard = Shard(keys, numbers(group, "n_docs"), numbers(group, "largest"))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(numbers(group, "shard")[:1], pa.int64()),
                    pa.array([len(keys)], pa.int64()),
                    pa.array([pickle.dumps(shard)], pa.binary()),
                ],
                names=["shard", "n_keys", "data"],
            )

    # high as an unsigned number, modulo the number of shards
    wrapped = F.when(F.col("high") < 0, F.lit((1 << 64) % n_shards)).otherwise(F.lit(0))
    shard = F.pmod(F.pmod(F.col("high"), F.lit(n_shards)) + wrapped, F.lit(n_shards))
    keyed = lines.withColumn("shard", shard.cast("long"))
    placed = keyed.repartition("shard").sortWithinPartitions("shard", "high", "low")
    return placed.mapInArrow(build, "shard long, n_keys long, data binary").withColumn("n_shards", F.lit(n_shards))


def shard_groups(index: DataFrame, limit: int) -> Iterator[tuple[int, dict[int, Shard]]]:
    """The index in groups of shards that together hold at most `limit` bytes (or one shard)."""
    held: dict[int, Shard] = {}
    size, n_shards = 0, 1
    for row in stored(index, "line-index").toLocalIterator():
        if held and size + len(row.data) > limit:
            yield n_shards, held
            held, size = {}, 0
        held[row.shard] = pickle.loads(row.data)
        size, n_shards = size + len(row.data), row.n_shards
    if held:
        yield n_shards, held


ROW = "doc_id long, text string, n_lines long, n_dropped long"


def drop_repeated_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, limit: int = MAX_INDEX_BYTES
) -> DataFrame:
    """doc_id, text (what is kept), n_lines, n_dropped for each row of `docs`.

    Each row is a document, also where ids repeat; among rows that share the largest id, all keep their
    lines. A null id is below all others; if all holders of a line have none, all keep it. A null or
    empty text is one empty line. Extra columns are ignored.
    """
    index = build_index(repeated_lines(docs, min_chars, min_docs))
    rows = with_columns(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.lit(-1).cast("long").alias("n_lines"),
        F.lit(0).cast("long").alias("n_dropped"),
    )
    passes = 0
    for n_shards, shards in shard_groups(index, limit):
        rows = probed(stored(rows, "line-dedup") if passes else rows, n_shards, shards, min_chars)
        passes += 1
    return rows if passes else probed(rows, 1, {}, min_chars)


def probed(rows: DataFrame, n_shards: int, shards: dict[int, Shard], min_chars: int) -> DataFrame:
    """Look up every long line of every document in some shards and drop what is repeated."""
    tables = rows.sparkSession.sparkContext.broadcast(shards)

    def probe(batches):
        for batch in batches:
            for part in pieces(batch, "text"):
                ids = [NO_ID if x is None else x for x in part.column("doc_id").to_pylist()]
                texts = [t.split("\n") for t in part.column("text").to_pylist()]
                found = [(d, n, key) for d, lines in enumerate(texts) for n, key in long_keys(lines, min_chars)]
                dropped: list[set[int]] = [set() for _ in texts]
                if found:
                    keys = hashed([key for _, _, key in found])
                    shard = (keys[:, 0] % np.uint64(n_shards)).astype(np.int64)
                    for s in np.unique(shard).tolist():
                        if s in tables.value:
                            at = np.flatnonzero(shard == s)
                            counts, largest = tables.value[s].look_up(keys[at])
                            for i, top in zip(at[counts > 0].tolist(), largest[counts > 0].tolist()):
                                d, n, _ = found[i]
                                if ids[d] != top:
                                    dropped[d].add(n)
                kept = [
                    "\n".join([x for n, x in enumerate(lines) if n not in gone]) if gone else "\n".join(lines)
                    for lines, gone in zip(texts, dropped)
                ]
                total = [len(x) if n < 0 else n for x, n in zip(texts, part.column("n_lines").to_pylist())]
                gone = [len(x) + n for x, n in zip(dropped, part.column("n_dropped").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(kept), pa.array(total, pa.int64()), pa.array(gone, pa.int64())],
                    names=["doc_id", "text", "n_lines", "n_dropped"],
                )

    return rows.mapInArrow(probe, ROW)


def digests(kept: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256, from `drop_repeated_lines`."""
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
