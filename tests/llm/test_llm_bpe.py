"""Byte-level BPE against the tokenizers library."""

import hashlib
import json
import random
import struct
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from usagelens.llm import bpe
from usagelens.llm.common import LlmError
from usagelens.llm.queries import QUERIES

public_tokenizers = pytest.importorskip("public_tokenizers")
Tokenizer = pytest.importorskip("tokenizers").Tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")
MIDDLE = Path("/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(PATH)
    found.no_truncation()
    found.no_padding()
    return found


@pytest.fixture(scope="module")
def coder():
    return bpe.Coder(bpe.read_vocabulary(PATH))


def numbers(packed):
    return list(struct.unpack(f"<{len(packed) // 4}I", packed))


def same(coder, library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    assert numbers(coder.encode(text)) == ids
    assert coder.decode(bpe.pack(ids)) == library.decode(ids, skip_special_tokens=False)


PIECES = [*"abc12 \n\t!'.s", "<|endoftext|>", " the", "'ll", "é", "中", "՘", "\x1c", "\x85", "​", "　", "½", "\U0001f600", "<|endof", "̀", "\0"]


def test_random_texts(coder, library):
    rng = random.Random(1)
    for _ in range(3000):
        letters = [rng.choice(PIECES) if rng.random() < 0.9 else chr(rng.choice([rng.randrange(0xD800), rng.randrange(0xE000, 0x110000)])) for _ in range(rng.randrange(14))]
        same(coder, library, "".join(letters))


def test_every_code_point(coder, library):
    # Beyond these planes nothing is assigned.
    texts = [f"a{c}1{c} {c}{c}." for c in map(chr, [*range(0xD800), *range(0xE000, 0x20000), *range(0x2A000, 0x40000, 3), *range(0xE0000, 0xE0200)])]
    for a in range(0, len(texts), 1 << 16):
        part = texts[a : a + (1 << 16)]
        assert all(numbers(coder.encode(t)) == e.ids for t, e in zip(part, library.encode_batch(part, add_special_tokens=False)))


@pytest.mark.parametrize("text", ["a" * 60_000, "9" * 20_000, "ab " * 150_000 + "\n" * 90_000 + "x", "<|endoftext|>" * 3_000, " " * 5_000])
def test_long_texts(coder, library, text):
    same(coder, library, text)


def test_random_ids(coder, library):
    rng = random.Random(2)
    for _ in range(2000):
        ids = [rng.randrange(50_257) for _ in range(rng.randrange(9))]
        assert coder.decode(bpe.pack(ids)) == library.decode(ids, skip_special_tokens=False)


def test_forgotten_words_are_encoded_again(coder, library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 4)
    for text in ["one two three four five six seven", "six five four three two one", "one one two two"] * 2:
        same(coder, library, text)


def test_merges_go_by_rank_and_stale_ones_are_skipped():
    letters = bpe.byte_letters()
    vocab = {letter: i for i, letter in enumerate(letters)}
    merges = [["b", "c"], ["a", "b"], ["a", "bc"], ["c", "d"]]
    vocab |= {a + b: 256 + i for i, (a, b) in enumerate(merges)}
    spec = {"model": {"type": "BPE", "vocab": vocab, "merges": merges}, "pre_tokenizer": {"type": "ByteLevel"}}
    found = bpe.Vocabulary(spec)
    assert found.merged(b"abcd") == [vocab["abc"], vocab["d"]]
    assert found.merged(b"abab") == [vocab["ab"], vocab["ab"]]
    with pytest.raises(LlmError, match="special token with conditions"):
        bpe.Vocabulary({**spec, "added_tokens": [{"content": "x", "id": 1, "lstrip": True}]})


def test_other_vocabularies_are_refused(tmp_path):
    path = tmp_path / "other.json"
    path.write_text(json.dumps({"model": {"type": "WordPiece", "vocab": {}}}))
    with pytest.raises(LlmError, match="not a plain byte-level BPE"):
        bpe.read_vocabulary(str(path))


def test_odd_rows(spark, library):
    rows = [(1, None), (1, ""), (None, "no id"), (None, "no id"), (2, "<|endoftext|>tail "), (3, "É\U0001f600\0")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("x"))
    coded = bpe.encode(docs, PATH)
    expected = sorted(str((i, library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)
    assert sorted(str((r.doc_id, r.ids)) for r in bpe.unpacked(coded).collect()) == expected
    back = bpe.decode(coded.withColumn("text", F.lit(0)), PATH).collect()
    assert sorted(str((r.doc_id, r.text)) for r in back) == sorted(str((i, t or "")) for i, t in rows)
    assert [r.text for r in bpe.decode(spark.createDataFrame([(1, None)], "doc_id string, ids binary"), PATH).collect()] == [""]
    assert bpe.decode(bpe.encode(docs.limit(0), PATH), PATH).collect() == []
    with pytest.raises(LlmError, match="missing columns: text"):
        bpe.encode(docs.drop("text"), PATH)


def test_query(spark, library):
    found = QUERIES["op12_bpe"](spark, str(MIDDLE))
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{MIDDLE}/documents.parquet'").fetchall()
    expected = []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        raw = struct.pack(f"<{len(ids)}I", *ids)
        expected.append((doc_id, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted(map(tuple, found.collect())) == sorted(expected)
