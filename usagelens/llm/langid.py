"""Language identification with bit-sliced Bloom filters over character n-grams.

Training counts the trigrams of every language over all its documents. A language keeps its most frequent
trigrams, those left out that are far more common in another language: all of them up to a number that the size of
the filter sets, and as many of a language whose trigrams are all rare as of any other. All languages share one array
of slots: bit l of a slot belongs to language l. A lookup ANDs the slots of a trigram and so yields all languages
that hold it at once. A document's language is the one with the highest count of held trigrams, after the hits that
false positives explain have been taken off.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from usagelens.functions.joins import hint_if_small
from usagelens.llm.common import mixed, pieces, stored, with_columns

#: Slots of the whole filter, 8 bytes each, whatever the number of languages and trigrams. Every 64 languages take
#: one row of slots, and a language keeps a trigram for every SLOTS_PER_KEY of its row: 262,144 up to 64 languages.
MAX_SLOTS = 1 << 22
#: A trigram is left to the languages in which its share is at least this part of the highest one.
MIN_OF_BEST = 0.25
HASHES = 3
SLOTS_PER_KEY = 16
UNKNOWN = "und"
# Slots that travel as one value.
BLOCK = 1 << 15
# Trigrams that a task holds before it sums them up.
HELD = 4 << 20


@cache
def folding() -> np.ndarray:
    """For every code point its lower case, or 0 where it is no letter."""
    out = np.zeros(0x110000, dtype=np.uint32)
    for c in range(0x110000):
        x = chr(c)
        if x.isalpha():
            low = x.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Trigrams around every letter (0 stands for what is no letter), and each text's first one."""
    raw = "\0\0".join(["", *((t or "") for t in texts), ""]).encode("utf-32-le")
    folded = folding()[np.frombuffer(raw, dtype=np.uint32)].astype(np.uint64)
    middle = np.flatnonzero(folded[1:-1]) if len(folded) > 2 else np.zeros(0, dtype=np.int64)
    grams = (folded[middle] << np.uint64(42)) | (folded[middle + 1] << np.uint64(21)) | folded[middle + 2]
    begins = np.cumsum([2, *(len(t or "") + 2 for t in texts)])
    return grams, np.searchsorted(middle + 1, begins)


def summed(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(codes, return_inverse=True)
    return keys, np.bincount(at, weights=counts, minlength=len(keys)).astype(np.int64)


def trigram_counts(docs: DataFrame) -> DataFrame:
    """lang, gram, n over all rows of `docs` (lang, text) with a language."""

    def count(batches):
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        waiting = 0
        for batch in batches:
            for part in pieces(batch, "text"):
                langs = part.column("lang").to_pylist()
                texts = part.column("text").to_pylist()
                for lang in set(langs):
                    grams, _ = trigrams([t for t, x in zip(texts, langs) if x == lang])
                    keys, n = np.unique(grams, return_counts=True)
                    held.setdefault(lang, []).append((keys, n))
                    waiting += len(keys)
                if waiting > HELD:
                    yield from batches_of(held)
                    held, waiting = {}, 0
        yield from batches_of(held)

    def batches_of(held) -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            keys, n = summed(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(n)],
                names=["lang", "gram", "n"],
            )

    rows = with_columns(docs, "lang", "text").filter("lang is not null and text is not null")
    return rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def slots_of(grams: np.ndarray, mask: int) -> list[np.ndarray]:
    """The places of each trigram's bits in a row of `mask` + 1 slots."""
    first = mixed(grams)
    step = (first >> np.uint64(32)) | np.uint64(1)
    return [((first + np.uint64(k) * step) & np.uint64(mask)).astype(np.int64) for k in range(HASHES)]


def row_slots(most_grams: int, n_rows: int) -> int:
    """Slots of a row: SLOTS_PER_KEY for each trigram of the language with most, within MAX_SLOTS for all rows."""
    slots = 1 << 10
    while slots < most_grams * SLOTS_PER_KEY and 2 * slots * n_rows <= MAX_SLOTS:
        slots *= 2
    return slots


class Profiles:
    """One bit-sliced Bloom filter over the trigrams of all languages."""

    def __init__(self, grams: dict[str, np.ndarray], sizes: dict[str, int]):
        """A small filter at once; `learn` has tasks fill a large one."""
        # Equal counts go to the language with more training text.
        langs = sorted(grams, key=lambda x: (-sizes[x], x))
        n_rows = -(-max(1, len(langs)) // 64)
        words = np.zeros((n_rows, row_slots(max((len(g) for g in grams.values()), default=1), n_rows)), dtype=np.uint64)
        for i, lang in enumerate(langs):
            for at in slots_of(grams[lang], words.shape[1] - 1):
                words[i // 64, at] |= np.uint64(1 << (i % 64))
        self._set(langs, words)

    @classmethod
    def of_words(cls, langs: list[str], words: np.ndarray) -> Profiles:
        """`words[w, slot]` has a bit for each of the languages 64 w to 64 w + 63, which come in order of preference."""
        out = cls.__new__(cls)
        out._set(langs, words)
        return out

    def _set(self, langs: list[str], words: np.ndarray) -> None:
        self.langs, self.words, self.mask = langs, words, words.shape[1] - 1
        filled = [np.count_nonzero(words[i // 64] & np.uint64(1 << (i % 64))) / (self.mask + 1) for i in range(len(langs))]
        self.false_rate = np.minimum(np.array(filled) ** HASHES, 0.99)

    def hits(self, grams: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Corrected counts, one row a text, one column a language."""
        n = np.diff(begins)
        out = np.zeros((len(n), len(self.langs)))
        if not len(grams):
            return out
        slots = slots_of(grams, self.mask)
        for w, row in enumerate(self.words):
            held = row[slots[0]]
            for at in slots[1:]:
                held &= row[at]
            for i in range(64 * w, min(64 * w + 64, len(self.langs))):
                total = np.concatenate([[0], np.cumsum((held >> np.uint64(i % 64)) & np.uint64(1))])
                out[:, i] = total[begins[1:]] - total[begins[:-1]]
        return np.maximum(0, (out - n[:, None] * self.false_rate) / (1 - self.false_rate))

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score: the share of the text's trigrams that its language holds."""
        grams, begins = trigrams(texts)
        n = np.diff(begins)
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        hits = self.hits(grams, begins)
        best = hits.argmax(axis=1)
        score = np.clip(hits[np.arange(len(n)), best] / np.maximum(n, 1), 0, 1)
        return [self.langs[b] if k else UNKNOWN for b, k in zip(best, n)], score


def _level(n) -> Column:
    """A coarse size of a count: exact up to 8, then eight levels for each doubling."""
    return F.when(n <= 8, n).otherwise(F.floor(F.log2(n) * 8)).cast("int")


def chosen(kept: DataFrame, most: int) -> DataFrame:
    """The `most` most frequent trigrams of each language, about; a table of some 500 levels a language sets the cut.

    Within the level where the cut falls, the trigrams' hashes decide, so a language all of whose trigrams are equally
    rare keeps a random part of them.
    """
    sized = kept.withColumn("level", _level(F.col("n")))
    levels = sized.groupBy("lang", "level").agg(F.count(F.lit(1)).alias("in_level"))
    # one row for each level of a language
    above = F.coalesce(F.sum("in_level").over(Window.partitionBy("lang").orderBy(F.desc("level")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    part = levels.withColumn("part", F.greatest(F.lit(0.0), F.lit(most) - above) / F.col("in_level")).filter("part > 0")
    random = F.pmod(F.xxhash64("gram"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    return sized.join(part.select("lang", "level", "part"), ["lang", "level"]).filter(random < F.col("part")).select("lang", "gram")


def learn(docs: DataFrame) -> Profiles:
    """Profiles of all languages in `docs` (lang, text), counted over every row.

    Rows without text or language teach nothing. The driver sees the languages with their sizes, and the finished
    filter in pieces that tasks have made: 32 MB at most.
    """
    spark = docs.sparkSession
    counts = stored(trigram_counts(docs), "trigrams")
    sizes = stored(counts.groupBy("lang").agg(F.sum("n").alias("total")), "languages")
    # Equal counts go to the language with more training text.
    langs = [row.lang for row in sizes.orderBy(F.desc("total"), "lang").collect()]  # one row a language
    n_rows = max(1, -(-len(langs) // 64))
    share = counts.join(hint_if_small(sizes), "lang").withColumn("share", F.col("n") / F.col("total"))
    best = F.max("share").over(Window.partitionBy("gram"))  # a row for each language at most
    kept = share.withColumn("best", best).filter(F.col("share") >= MIN_OF_BEST * F.col("best"))
    kept = stored(kept.select("lang", "gram", "n"), "kept-trigrams")
    most = kept.groupBy("lang").count().agg(F.max("count")).first()[0] or 0
    slots = row_slots(most, n_rows)
    places = spark.sparkContext.broadcast({x: i for i, x in enumerate(langs)})

    def bits(batches):
        for batch in batches:
            place = np.array([places.value[x] for x in batch.column("lang").to_pylist()], dtype=np.int64)
            for at in slots_of(batch.column("gram").to_numpy().view(np.uint64), slots - 1):
                bit = np.uint64(1) << (place % 64).astype(np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(place // 64), pa.array(at), pa.array(bit.view(np.int64))], names=["word", "slot", "bit"]
                )

    set_bits = chosen(kept, slots // SLOTS_PER_KEY).mapInArrow(bits, "word long, slot long, bit long")
    filled = set_bits.groupBy("word", "slot").agg(F.bit_or("bit").alias("bits"))
    pair = F.struct((F.col("slot") % BLOCK).cast("int").alias("at"), "bits")
    blocks = filled.groupBy("word", F.expr(f"slot div {BLOCK}").alias("block")).agg(F.collect_list(pair).alias("pairs"))  # BLOCK at most

    def packed(batches):
        for batch in batches:
            out = []
            for pairs in batch.column("pairs"):
                found = np.zeros(min(BLOCK, slots), dtype=np.int64)
                values = pairs.values
                found[values.field("at").to_numpy()] = values.field("bits").to_numpy()
                out.append(found.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("block"), pa.array(out, pa.binary())], names=["word", "block", "bits"])

    words = np.zeros((n_rows, slots), dtype=np.uint64)
    for row in blocks.mapInArrow(packed, "word long, block long, bits binary").collect():
        start = row.block * BLOCK
        words[row.word, start : start + BLOCK] = np.frombuffer(row.bits, dtype=np.uint64)
    return Profiles.of_words(langs, words)


def identify(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """doc_id, lang_pred, score for each row of `docs` (doc_id, text).

    A null text or one without letters is `und` with score 0. Any text with a letter gets a learned
    language; where no language holds any of its trigrams or several hold as many, the one with more
    training text. Rows may repeat, ids may be null; extra columns are ignored.
    """
    rows = with_columns(docs, "doc_id", "text")
    tables = docs.sparkSession.sparkContext.broadcast(profiles)
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in pieces(batch, "text"):
                langs, score = tables.value.predict(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(langs, pa.string()), pa.array(score, pa.float64())],
                    names=["doc_id", "lang_pred", "score"],
                )

    return rows.mapInArrow(run, f"doc_id {id_type}, lang_pred string, score double")
