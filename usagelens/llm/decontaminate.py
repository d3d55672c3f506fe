"""Benchmark decontamination by Wu-Manber search over words.

The windows of all benchmark items (10 words, or a whole shorter item) are the patterns. For patterns of
one length, a table over pairs of adjacent words says how far the search may jump after looking at the
pair that ends at the current place: a pair that no pattern holds lets it jump almost a whole pattern.
Where a pair ends a pattern, the patterns in its bucket are compared word by word. Patterns are grouped
by length, so that short items do not shorten the jumps of the long ones.

Patterns go to the tasks as a broadcast of at most `MAX_PATTERN_BYTES`; a larger benchmark is cut into
chunks of that size, and the documents are passed through one after another, written in between. An item
too large for a chunk is cut into pieces that share `window - 1` words, so no window is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens.llm.common import pieces, stored, with_columns

WINDOW = 10
MAX_PATTERN_BYTES = 64 << 20
# A word is a run of digits, letters and whatever is not ASCII; A-Z become a-z, all else a space.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(WORD_BYTES).split(b" ") if text else []


def split_words(text: str | None) -> list[bytes]:
    return [w for w in words_of(text) if w]


def windows_of(words: list[bytes], size: int = WINDOW) -> set[tuple[bytes, ...]]:
    if not words:
        return set()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


class WuManber:
    """Finds all occurrences of patterns of one length in a sequence of words."""

    def __init__(self, patterns: list[tuple[bytes, ...]]):
        self.length = len(patterns[0])
        self.block = min(2, self.length)
        self.jump = self.length - self.block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.bucket: dict[tuple[bytes, ...], set[tuple[bytes, ...]]] = {}
        for p in patterns:
            for end in range(self.block, self.length + 1):
                key = p[end - self.block : end]
                self.shift[key] = min(self.shift.get(key, self.jump), self.length - end)
            self.bucket.setdefault(p[-self.block :], set()).add(p)

    def find(self, words: list[bytes]) -> Iterator[tuple[int, tuple[bytes, ...]]]:
        """(start, pattern) of every occurrence, in order."""
        shift, jump, length, n = self.shift, self.jump, self.length, len(words)
        end = length
        if self.block == 1:
            for i, w in enumerate(words):
                if (w,) in self.shift:
                    yield i, (w,)
            return
        while end <= n:
            step = shift.get((words[end - 2], words[end - 1]), jump)
            if step:
                end += step
                continue
            found = tuple(words[end - length : end])
            if found in self.bucket[found[-2:]]:
                yield end - length, found
            end += 1


class Searcher:
    """All windows of some benchmark items, ready for search."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.owners: dict[tuple[bytes, ...], set[str]] = {}
        for item, words in items:
            for w in windows_of(words, window):
                self.owners.setdefault(w, set()).add(item)
        by_length: dict[int, list[tuple[bytes, ...]]] = {}
        for w in self.owners:
            by_length.setdefault(len(w), []).append(w)
        self.matchers = [WuManber(p) for _, p in sorted(by_length.items())]

    def search(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """The hit spans (start, end) and the items whose windows occur."""
        spans, items = [], set()
        for m in self.matchers:
            for start, pattern in m.find(words):
                spans.append((start, start + m.length))
                items |= self.owners[pattern]
        return joined(spans), items - {None}


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans without overlaps."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def parts_of(words: list[bytes], window: int, limit: int) -> Iterator[tuple[list[bytes], int]]:
    """An item's words with the bytes that their search tables need, cut where that is above `limit`.

    Pieces hold the same windows together as the whole item: each starts `window - 1` words before the end of
    the one before. A piece of a single window can be above the limit.
    """
    start = end = cost = 0
    # A piece's windows hold about `window` references to each of its words.
    cost_of = lambda w: len(w) + 100 + 8 * window
    while end < len(words):
        more = cost_of(words[end])
        if cost + more > limit and end - start >= window:
            yield words[start:end], cost
            start = end - window + 1
            cost = sum(map(cost_of, words[start:end]))
        cost += more
        end += 1
    yield words[start:end], cost


def searchers(benchmark: DataFrame, window: int, limit: int) -> Iterator[Searcher]:
    """The benchmark's items, read one after another, as search tables of bounded size."""
    held: list[tuple[str | None, list[bytes]]] = []
    size = 0
    items = with_columns(benchmark, "item_id", "text").filter("text is not null")
    for row in items.toLocalIterator():
        for words, cost in parts_of(split_words(row.text), window, limit):
            if held and size + cost > limit:
                yield Searcher(held, window)
                held, size = [], 0
            held.append((None if row.item_id is None else str(row.item_id), words))
            size += cost
    yield Searcher(held, window)


FOUND = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.LongType())),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


def find_spans(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, limit: int = MAX_PATTERN_BYTES
) -> DataFrame:
    """doc_id, text, n_words, spans (start and end words, flat), items (sorted) for each row of `docs`.

    A null or empty text has no words and no hits. An item without words has no windows, one without id has
    windows but is not named; equal items are each reported. Rows may repeat; extra columns are ignored; an empty benchmark hits nothing.
    """
    empty = F.array().cast("array<bigint>"), F.array().cast("array<string>")
    rows = with_columns(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long"), "text", F.lit(0).cast("long").alias("n_words"), empty[0].alias("spans"), empty[1].alias("items")
    )
    for n, searcher in enumerate(searchers(benchmark, window, limit)):
        rows = searched(stored(rows, "decontaminate") if n else rows, searcher)
    return rows


def searched(rows: DataFrame, searcher: Searcher) -> DataFrame:
    tables = rows.sparkSession.sparkContext.broadcast(searcher)

    def search(batches):
        for batch in batches:
            for part in pieces(batch, "text"):
                counts, spans, items = [], [], []
                old = part.column("spans").to_pylist(), part.column("items").to_pylist()
                for text, before, named in zip(part.column("text").to_pylist(), *old):
                    words = split_words(text)
                    new, found = tables.value.search(words)
                    new = joined([*new, *zip(before[::2], before[1::2])])
                    counts.append(len(words))
                    spans.append([x for pair in new for x in pair])
                    items.append(sorted(found.union(named)))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("text"),
                        pa.array(counts, pa.int64()),
                        pa.array(spans, pa.list_(pa.int64())),
                        pa.array(items, pa.list_(pa.string())),
                    ],
                    names=FOUND.fieldNames(),
                )

    return rows.mapInArrow(search, FOUND)


def hits(found: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, from `find_spans`."""
    n_hit = F.expr("aggregate(spans, 0L, (sum, x) -> x - sum)")  # -(start) + end - ..., over an even number
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def clean_only(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, limit: int = MAX_PATTERN_BYTES) -> DataFrame:
    """The rows of `docs`, all columns, whose text holds no window of the benchmark, items without id included.

    A null or empty text has no words and stays; an empty benchmark drops nothing.
    """
    for n, searcher in enumerate(searchers(benchmark, window, limit)):
        docs = stored(docs, "decontaminate") if n else docs  # one pass's tables in a job
        tables = docs.sparkSession.sparkContext.broadcast(searcher)

        def keep(batches, tables=tables):
            for batch in batches:
                for part in pieces(batch, "text"):
                    clean = [not tables.value.search(split_words(t))[0] for t in part.column("text").to_pylist()]
                    yield part.filter(pa.array(clean, pa.bool_()))

        with_columns(docs, "text")
        docs = docs.mapInArrow(keep, docs.schema)
    return docs


def digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
