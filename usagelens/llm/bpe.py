"""Byte-level BPE: texts to token ids and back, with a vocabulary file of a public tokenizer.

A text is cut at the special tokens and then into words. A word starts as its bytes, a doubly linked list of
symbols. All neighbours that can merge wait in a priority queue by the rank of their merge, the leftmost
first; a merge relinks the list and queues the new neighbours. Entries whose symbols have changed since are
skipped when they come up. Decoding concatenates the vocabulary's strings.

The file's path is a parameter. It is read by the driver and its tables are broadcast; a file is refused above
`MAX_FILE_BYTES`, so their size has a bound that does not depend on the data. Tasks remember the ids of words
they met, `REMEMBERED` at most.
"""

from __future__ import annotations

import codecs
import json
import re
import struct
from array import array
from collections.abc import Iterator
from functools import cached_property
from heapq import heapify, heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from usagelens.llm.common import LlmError, pieces, with_columns

MAX_FILE_BYTES = 64 << 20
#: Words whose ids a task keeps, in two generations; longer words are not kept.
REMEMBERED = 1 << 18
REMEMBERED_CHARS = 64
# Words, or ids, that are handled as Python objects at a time.
HELD = 1 << 17

#: How byte-level vocabularies cut a text into words.
ENDINGS = "'(?:[stmd]|re|ve|ll)"
WORDS = ENDINGS + r"| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Letters and numbers of Unicode versions after 16, which are neither to the tokenizers.
LATER = (
    "՘֋-֌࢏౜೜₏₝-₟꟎-꟏꟒꟔꟝꟢꟱꭬-꭭"
    "\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a"
    "\U00011db0-\U00011ddb\U00011de0-\U00011de9\U00011df1\U0001246f\U00012475-\U0001247f\U00012550-\U00012686"
    "\U00016ea0-\U00016eb8\U00016ebb-\U00016ed3\U00016ff2-\U00016ff6\U000187f8-\U000187ff\U00018cd6-\U00018cda"
    "\U00018d09-\U00018d20\U00018d80-\U00018df2\U00018e00-\U00019191\U000191a0-\U000191d2\U0001b123-\U0001b128"
    "\U0001b168\U0001d6a6\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96\U0001dfcd-\U0001dfff"
    "\U0001e6c0-\U0001e6de\U0001e6e0-\U0001e6e2\U0001e6e4-\U0001e6e5\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4"
    "\U0001e6fe-\U0001e6ff\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead\U000323b0-\U00033479\U0003d000-\U0003fc3f"
)
WORDS_WITH_LATER = (
    f"(?V1){ENDINGS}"
    rf"| ?[\p{{L}}--[{LATER}]]+| ?[\p{{N}}--[{LATER}]]+| ?[[^\s\p{{L}}\p{{N}}]||[{LATER}]]+|\s+(?!\S)|\s+"
)


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself where it is printable, else the next one from 256 on."""
    printable = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    others = iter(range(256, 512))
    return [chr(b if b in printable else next(others)) for b in range(256)]


class Vocabulary:
    """The tables of a byte-level BPE file."""

    def __init__(self, spec: dict):
        model, cut = spec["model"], spec.get("pre_tokenizer") or {}
        plain = model.get("type") == "BPE" and cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space")
        if not plain or cut.get("use_regex") is False or spec.get("normalizer") or model.get("ignore_merges"):
            raise LlmError("not a plain byte-level BPE vocabulary")
        ids = model["vocab"]
        letters = byte_letters()
        self.of_byte = [ids[letter] for letter in letters]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        #: (left << 32 | right) to the rank of their merge, and the id that a merge makes
        self.ranks = {ids[a] << 32 | ids[b]: rank for rank, (a, b) in enumerate(pairs)}
        self.made = [ids[a + b] for a, b in pairs]
        self.special: dict[str, int] = {}
        for token in spec.get("added_tokens") or []:
            if token.get("lstrip") or token.get("rstrip") or token.get("single_word"):
                raise LlmError(f"special token with conditions: {token['content']!r}")
            self.special[token["content"]] = token["id"]
        byte_of = {letter: b for b, letter in enumerate(letters)}
        self.strings = [b""] * (1 + max([*ids.values(), *self.special.values()], default=0))
        for token, i in [*ids.items(), *self.special.items()]:
            known = all(c in byte_of for c in token)
            self.strings[i] = bytes(byte_of[c] for c in token) if known else token.encode()

    def merged(self, word: bytes) -> list[int]:
        """The ids of one word."""
        ids = [self.of_byte[b] for b in word]
        n, rank_of, made = len(ids), self.ranks.get, self.made
        if n < 2:
            return ids
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        # The rank at which each symbol merges with the next one now; an entry of another rank is stale.
        ranks = [rank_of(a << 32 | b) for a, b in zip(ids, ids[1:])]
        ranks.append(None)
        queue = [rank << 32 | i for i, rank in enumerate(ranks) if rank is not None]
        heapify(queue)
        while queue:
            entry = heappop(queue)
            rank, i = entry >> 32, entry & 0xFFFFFFFF
            if ranks[i] != rank:
                continue
            j = after[i]
            k = after[i] = after[j]
            ids[i] = symbol = made[rank]
            ids[j], ranks[i], ranks[j] = -1, None, None
            if k < n:
                before[k] = i
                ranks[i] = rank = rank_of(symbol << 32 | ids[k])
                if rank is not None:
                    heappush(queue, rank << 32 | i)
            h = before[i]
            if h >= 0:
                ranks[h] = rank = rank_of(ids[h] << 32 | symbol)
                if rank is not None:
                    heappush(queue, rank << 32 | h)
        return [x for x in ids if x >= 0]


class _Words(dict):
    """Ids of words as packed bytes; the words not met for a while are forgotten."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.older = vocabulary, {}

    def __missing__(self, word: str) -> bytes:
        packed = self.older.get(word)
        if packed is None:
            packed = pack(self.vocabulary.merged(word.encode()))
        if len(word) <= REMEMBERED_CHARS:
            if len(self) >= REMEMBERED // 2:
                self.older = dict(self)
                self.clear()
            self[word] = packed
        return packed


def pack(ids) -> bytes:
    """Ids as little-endian unsigned 32-bit numbers."""
    return struct.pack(f"<{len(ids)}I", *ids)


class Coder:
    """Encodes and decodes texts; what it remembers of words stays in the process."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary

    def __getstate__(self):
        return {"vocabulary": self.vocabulary}

    @cached_property
    def words(self) -> _Words:
        return _Words(self.vocabulary)

    @cached_property
    def patterns(self):
        special = "|".join(re.escape(x) for x in sorted(self.vocabulary.special, key=len, reverse=True))
        return regex.compile(WORDS), regex.compile(WORDS_WITH_LATER), re.compile(f"[{LATER}]"), re.compile(f"({special})") if special else None

    def _pieces(self, text: str) -> Iterator[bytes]:
        usual, careful, later, _ = self.patterns
        pattern = careful if not text.isascii() and later.search(text) else usual
        if len(text) <= HELD:
            yield from map(self.words.__getitem__, pattern.findall(text))
            return
        found = pattern.finditer(text)
        while some := [m.group() for m in islice(found, HELD)]:
            yield b"".join(map(self.words.__getitem__, some))

    def encode(self, text: str) -> bytes:
        """The text's ids, packed."""
        special = self.patterns[3]
        if special is None or not any(x in text for x in self.vocabulary.special):
            return b"".join(self._pieces(text))
        out = []
        for n, part in enumerate(special.split(text)):
            out.append(pack([self.vocabulary.special[part]]) if n % 2 else b"".join(self._pieces(part)))
        return b"".join(out)

    def decode(self, packed: bytes) -> str:
        """The strings of packed ids one after another; unknown ids are left out, broken UTF-8 is replaced."""
        strings = self.vocabulary.strings
        ids = np.frombuffer(packed, dtype="<u4")
        if len(ids) and ids.max() >= len(strings):
            ids = ids[ids < len(strings)]
        reader, out = codecs.getincrementaldecoder("utf-8")("replace"), []
        for a in range(0, len(ids), HELD):
            out.append(reader.decode(b"".join(map(strings.__getitem__, ids[a : a + HELD].tolist()))))
        return "".join(out) + reader.decode(b"", True)


def read_vocabulary(path: str) -> Vocabulary:
    """The vocabulary in a tokenizer file; a typed error if it is too large or of another kind."""
    with open(path, "rb") as file:
        raw = file.read(MAX_FILE_BYTES + 1)
    if len(raw) > MAX_FILE_BYTES:
        raise LlmError(f"vocabulary file above {MAX_FILE_BYTES} bytes: {path}")
    return Vocabulary(json.loads(raw))


def _coder(df: DataFrame, path: str):
    return df.sparkSession.sparkContext.broadcast(Coder(read_vocabulary(path)))


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) for each row of `docs`: the whole text's ids as little-endian unsigned 32-bit numbers.

    A null or empty text has no ids. Special tokens of the vocabulary are recognised in the text, none are
    added, nothing is cut off or padded. Equal texts get equal ids; rows may repeat, ids may be null. Extra
    columns are ignored. A run of letters without any break is held by its task as one list of bytes.
    """
    rows = with_columns(docs, "doc_id", "text")
    id_type = rows.schema["doc_id"].dataType.simpleString()
    coder = _coder(docs, path)

    def run(batches):
        for batch in batches:
            for part in pieces(batch, "text"):
                found = [coder.value.encode(t or "") for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found, pa.binary())], names=["doc_id", "ids"])

    return rows.mapInArrow(run, f"doc_id {id_type}, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, text) for each row of `encoded`; null ids give an empty text, extra columns are ignored."""
    rows = with_columns(encoded, "doc_id", "ids")
    id_type = rows.schema["doc_id"].dataType.simpleString()
    coder = _coder(encoded, path)

    def run(batches):
        for batch in batches:
            for part in pieces(batch, "ids"):
                found = [coder.value.decode(x or b"") for x in part.column("ids").to_pylist()]
                columns = [part.column("doc_id"), part.column("ids"), pa.array(found, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "text"])

    return rows.mapInArrow(run, f"doc_id {id_type}, ids binary, text string")


def unpacked(encoded: DataFrame) -> DataFrame:
    """(doc_id, ids) with the ids as an array of numbers; null stays null."""
    rows = with_columns(encoded, "doc_id", "ids")
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in pieces(batch, "ids"):
                found = [None if x is None else array("I", x) for x in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found, pa.list_(pa.int64()))], names=["doc_id", "ids"])

    return rows.mapInArrow(run, f"doc_id {id_type}, ids array<long>")
