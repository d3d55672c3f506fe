"""Operators against plain Python over the same rows."""

import collections
import hashlib
import itertools
import math
import re
import zlib
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from usagelens.llm import decontaminate, fingerprints, langid, line_dedup, mixing, ngram_join, pii, sharding, toxicity, url_filter
from usagelens.llm.common import buckets_for
from usagelens.llm.queries import ORACLES, QUERIES

SMALL, MIDDLE, LARGE = (Path("/root/testdata") / x for x in ("sf0.001", "sf0.01", "sf0.1"))
pytestmark = pytest.mark.skipif(not SMALL.exists(), reason="sample tables are not here")


def rows_of(name, folder=MIDDLE, columns="*"):
    return duckdb.sql(f"SELECT {columns} FROM '{folder}/{name}.parquet'").fetchall()


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_and_sql_agree(spark, name):
    con = duckdb.connect()
    for path in SMALL.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    found, expected = QUERIES[name](spark, str(SMALL)), con.execute(ORACLES[name])
    names = [d[0] for d in expected.description]
    order = sorted(names)
    assert sorted(found.columns) == order
    right = sorted(str([dict(zip(names, r))[c] for c in order]) for r in expected.fetchall())
    assert sorted(str([r[c] for c in order]) for r in found.collect()) == right


# Mixing


def shared(sizes, weights, most):
    """Targets by sharing again and again what capped sources leave."""
    total, capped = sum(sizes), set()
    while True:
        free = [i for i in range(len(sizes)) if i not in capped]
        left = total - sum(most * sizes[i] for i in capped)
        weight = sum(weights[i] for i in free)
        goal = {i: left * weights[i] / weight for i in free}
        above = {i for i in free if goal[i] > most * sizes[i] + 1e-9}
        if not above:
            return [most * sizes[i] if i in capped else goal[i] for i in range(len(sizes))]
        capped |= above


@pytest.mark.parametrize("sizes", [[10, 1, 50, 3, 3, 7], [1, 1000, 1000], [5], [1, 1, 1, 1, 1, 1, 900], [0, 4, 9]])
def test_targets(spark, sizes):
    rows = [(None if i == len(sizes) - 1 else f"s{i}", x) for i, x in enumerate(sizes)]
    found = mixing.targets(frame(spark, rows, "source string, source_size long")).collect()
    weights = [mixing.WEIGHTS[i % 3] for i in range(len(sizes))]
    got = [r.target for r in sorted(found, key=lambda r: (r.source is None, r.source))]
    assert got == pytest.approx(shared(sizes, weights, mixing.MOST_REPEATS))


def test_seats_go_by_highest_quotient(spark):
    goals = [("a", 60, 41.0, 0), ("b", 30, 50.0, 1), ("c", 10, 9.0, 2)]
    schema = "source string, source_size long, target double, rank long"
    found = collections.Counter((r.rank, r.shard) for r in mixing.seats(frame(spark, goals, schema), 20, 4).collect())
    quotients = sorted(((-t / (2 * i + 1), rank, i) for _, _, t, rank in goals for i in range(20)))
    expected = collections.Counter((rank, place // 5) for place, (_, rank, _) in enumerate(quotients[:20]))
    assert found == expected


def test_mix(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    found = mixing.mix(docs).collect()
    assert sorted(found) == sorted(mixing.mix(docs.repartition(5)).collect())
    texts = dict(rows_of("documents", columns="doc_id, text"))
    word = re.compile(mixing.WORD)
    assert all(r["size"] == len(word.findall(texts[r.doc_id] or "")) for r in found)
    assert all(0 <= r.taken <= 3 * r["size"] for r in found)
    by = collections.defaultdict(list)
    for r in found:
        by[r.source].append(r)
    for rows in by.values():
        assert sum(r["size"] for r in rows) == rows[0].source_size
        assert sum(r.taken for r in rows) == pytest.approx(rows[0].target, rel=0.01)


def test_mix_of_few_words_is_exact_to_a_word(spark):
    rows = [(1, "a b c", "x"), (2, "d", "x"), (3, "e f g h i j", "y"), (4, None, "y"), (5, "k", None)]
    found = mixing.mix(frame(spark, rows, "doc_id long, text string, source string")).collect()
    for source, target in (("x", 6.875), ("y", 2.75), (None, 1.375)):
        taken = [r for r in found if r.source == source]
        assert taken[0].target == pytest.approx(target)
        assert abs(sum(r.taken for r in taken) - target) <= 1


def whole_copies(rows, n_buckets):
    """Copies of each row of a mix: down the seeded order, those whose middle lies before the words still wanted."""
    blocks = mixing.BLOCKS
    total = sum(r["size"] for r in rows)
    block = max(1, -(-total // blocks))
    by, copies = collections.defaultdict(list), {}
    for r in rows:
        by[r.source].append(r)
    for own in by.values():
        line = sorted(own, key=lambda r: ((r.place >> 20) % n_buckets, r.place, r.doc_id))
        given = sum(r.taken for r in line)
        n_blocks = max(1, -(-line[0].source_size // block))
        # What all give alike, and what is taken from the first ones besides.
        times = min(r.taken // r["size"] for r in line if r["size"])
        more = given - times * line[0].source_size
        assert more <= n_blocks * block
        start = 0
        for r in line:
            copies[r.doc_id] = times + (start + r["size"] / 2 < more) if r["size"] else 0
            start += r["size"]
    return copies


def test_mixed_rows_follow_the_mix(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    found = mixing.mix(docs).collect()
    times = collections.Counter(r.doc_id for r in mixing.mixed_rows(docs).collect())
    assert times == {d: n for d, n in whole_copies(found, buckets_for(len(found))).items() if n}
    by = collections.defaultdict(list)
    for r in found:
        by[r.source].append(r)
    block = -(-sum(r["size"] for r in found) // mixing.BLOCKS)
    for rows in by.values():
        words = sum(times[r.doc_id] * r["size"] for r in rows)
        assert abs(words - rows[0].target) <= max(r["size"] for r in rows) / 2 + 2 * block
        assert max(times[r.doc_id] for r in rows) <= mixing.MOST_REPEATS


# Sharding


def test_interleave(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    found = sharding.interleave(docs).collect()
    rows = sharding.measured(docs).collect()
    n_buckets = buckets_for(len(rows))
    of_source = collections.defaultdict(list)
    for r in rows:
        of_source[r.key].append(((r.mixed >> 20) % n_buckets, r.mixed, r.doc_id, r["size"], r.text_crc32, r.key))
    line = []
    for group in of_source.values():
        for rank, r in enumerate(sorted(group)):
            line.append(((rank + 0.5) / len(group), r[5], *r[1:5]))
    expected = []
    for place, r in enumerate(sorted(line)):
        shard = place * 40 // len(line)
        expected.append((r[3], shard, place - -(-shard * len(line) // 40)))
    assert sorted((r.doc_id, r.shard, r.slot) for r in found) == sorted(expected)
    counts = collections.Counter(r.shard for r in found)
    assert len(counts) == 40 and max(counts.values()) - min(counts.values()) <= 1
    texts = dict(rows_of("documents", columns="doc_id, text"))
    assert all(r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in found)
    assert all(r["size"] == len(texts[r.doc_id].encode()) + 16 for r in found)


def test_shards_hold_the_mixture(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"),
        F.when(F.col("id") % 10 < 6, "big").when(F.col("id") % 10 < 9, "middle").otherwise(F.lit(None)).alias("source"),
    )
    found = collections.Counter((r.shard, r.source) for r in sharding.interleave(docs).collect())
    for source, share in (("big", 60), ("middle", 30), (None, 10)):
        assert all(abs(found[s, source] - share) <= 2 for s in range(40))


def test_write_shards(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    placed = sharding.interleave(docs)
    sharding.write_shards(docs, placed, str(tmp_path / "out"))
    back = {(r.doc_id, r.shard, r.slot) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert back == {(r.doc_id, r.shard, r.slot) for r in placed.collect()}


# Language


def test_language_of_held_out_documents(spark):
    langs = dict(rows_of("documents", columns="doc_id, lang"))
    held = [r for r in QUERIES["op2_language_id"](spark, str(MIDDLE)).collect() if r.held_out]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and 0 <= r.score <= 1 for r in held)
    assert np.mean([langs[r.doc_id] == r.lang_pred for r in held]) >= 0.97


def test_hits_are_corrected_counts():
    rng = np.random.default_rng(1)
    grams = {x: rng.integers(0, 2**62, 3000).astype(np.uint64) for x in ("aa", "bb", "cc")}
    profiles = langid.Profiles(grams, {"aa": 3, "bb": 2, "cc": 1})
    query = np.concatenate([grams["aa"][:500], grams["bb"][:100], rng.integers(0, 2**62, 5000).astype(np.uint64)])
    found = dict(zip(profiles.langs, profiles.hits(query, np.array([0, len(query)]))[0]))
    assert found["aa"] == pytest.approx(500, abs=40)
    assert found["bb"] == pytest.approx(100, abs=40)
    assert found["cc"] == pytest.approx(0, abs=40)


def test_many_languages_and_trigrams():
    profiles = langid.Profiles({f"l{i:03}": np.array([i], dtype=np.uint64) for i in range(130)}, {f"l{i:03}": 1 for i in range(130)})
    hits = profiles.hits(np.array([129, 64, 3], dtype=np.uint64), np.array([0, 1, 2, 3]))
    assert [profiles.langs[i] for i in hits.argmax(axis=1)] == ["l129", "l064", "l003"]
    grams, begins = langid.trigrams(["Ab", None, "", "x1y", "!"])
    a, b, x, y = map(ord, "abxy")
    assert grams.tolist() == [a << 21 | b, a << 42 | b << 21, x << 21, y << 21]
    assert begins.tolist() == [0, 2, 2, 2, 4, 4]


# Near copies


def shingles(text):
    words = [w for w in re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def linked_pairs(rows, threshold=0.8):
    sets = [shingles(t) for _, t in rows]
    holders = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    common = collections.Counter(p for h in holders.values() for p in itertools.combinations(h, 2))
    return {(i, j) for (i, j), n in common.items() if n / (len(sets[i]) + len(sets[j]) - n) >= threshold}


def classes(rows, pairs):
    least = list(range(len(rows)))

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for i, j in pairs:
        a, b = sorted((root(i), root(j)), key=lambda k: rows[k][0])
        least[b] = a
    return [rows[root(i)][0] for i in range(len(rows))]


@pytest.mark.parametrize("limits", [(1024, 1 << 19), (2, 300)])
def test_near_copies(spark, monkeypatch, limits):
    monkeypatch.setattr(ngram_join, "BUCKET_TEXTS", limits[0])
    monkeypatch.setattr(ngram_join, "CHUNK_SHINGLES", limits[1])
    rows = rows_of("documents", columns="doc_id, text")
    pairs = linked_pairs(rows)
    links = collections.Counter(itertools.chain.from_iterable(pairs))
    expected = sorted((r[0], c, links[i]) for i, (r, c) in enumerate(zip(rows, classes(rows, pairs))))
    found = ngram_join.near_copies(frame(spark, rows))
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in found.collect()) == expected


def test_posterior_bounds():
    least = ngram_join.least_matches(0.8, 1e-6)
    # The chance by numerical integration of the posterior density.
    s = np.linspace(0, 1, 200_001)
    for n in (16, 48, 96):
        for m, drops in ((least[n] - 1, True), (least[n], False)):
            log = m * np.log(np.maximum(s, 1e-300)) + (n - m) * np.log(np.maximum(1 - s, 1e-300))
            density = np.exp(log - log.max())
            assert (density[s >= 0.8].sum() / density.sum() < 1e-6) == drops


def test_components(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(1000 + i, 1001 + i) for i in range(60)]
    df = frame(spark, edges, "a long, b long")
    found = {r.node: r.root for r in ngram_join.components(df).collect()}
    least = {}
    graph = collections.defaultdict(set)
    for a, b in edges:
        if a != b:
            graph[a].add(b)
            graph[b].add(a)
    for start in sorted(graph):
        if start not in least:
            todo = [start]
            while todo:
                x = todo.pop()
                if x not in least:
                    least[x] = start
                    todo += graph[x]
    assert found == least


# Toxicity


def test_toxicity_of_held_out_documents(spark):
    toxic = dict(rows_of("labels", LARGE, "doc_id, toxic"))
    found = [r for r in QUERIES["op5_toxicity"](spark, str(LARGE)).collect() if r.held_out and r.doc_id in toxic]
    y = np.array([toxic[r.doc_id] for r in found])
    p = np.array([r.predicted for r in found])
    assert all(r.predicted == (r.score >= 0.3) for r in found)
    assert 2 * (p * y).sum() / (p.sum() + y.sum()) >= 0.9


def test_training_gradients():
    rng = np.random.default_rng(0)
    model = toxicity.fresh_model(rng)
    model.embedding *= 30
    rows = toxicity.rows_of(["bad", "good", "words", "elsewhere"], {})
    rows = np.concatenate([np.zeros((1, toxicity.N_ROWS), np.int32), rows])
    texts, y = [[1, 2, 3], [4], []], np.array([1, 0, 1], dtype=np.float32)

    def loss():
        text = toxicity.packed(texts)
        p = toxicity.sigmoid(model.logits(model.values(rows), text))
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    before = loss()
    adagrad = toxicity.Adagrad(0.01)
    for _ in range(30):
        toxicity.learn_batch(model, adagrad, rows, texts, y, np.ones(3))
    assert loss() < before


def test_scores_do_not_depend_on_batches():
    model = toxicity.fresh_model(np.random.default_rng(0))
    texts = [t for _, t in rows_of("documents", SMALL, "doc_id, text")] + [None, "", "one"]
    together = toxicity.Scorer(model).scores(texts)
    alone = [toxicity.Scorer(model).scores([t])[0] for t in texts]
    assert together == pytest.approx(alone, abs=1e-6)


def test_thresholds_by_language():
    model = toxicity.Model(None, {}, {}, None, 0.0)
    logits = np.concatenate([np.linspace(-5, -2, 50), np.linspace(1, 3, 50), np.linspace(-9, -6, 50), np.linspace(-5, -4, 50)])
    y = np.array([0] * 50 + [1] * 50 + [0] * 50 + [1] * 50, dtype=float)
    toxicity.calibrate(model, logits, y, ["a"] * 100 + ["b"] * 100, np.ones(200, dtype=bool))
    shifted = toxicity.sigmoid(logits + model.bias)
    for lang, part in (("a", slice(0, 100)), ("b", slice(100, 200))):
        assert ((shifted[part] >= model.thresholds[lang]) == (y[part] == 1)).all()


# Decontamination


@pytest.mark.parametrize("limit", [64 << 20, 3000])
def test_windows_of_all_lengths(spark, limit):
    rng = np.random.default_rng(5)
    words = list("abcdef")
    text = lambda n: " ".join(rng.choice(words, n))
    docs = [(i, text(int(rng.integers(0, 60)))) for i in range(300)]
    items = [(i, text(int(n))) for i, n in enumerate(rng.integers(0, 14, 40)) if n != 1]
    docs += [(300, "X. " + items[0][1].upper() + " y"), (301, None)]
    found = decontaminate.find_spans(frame(spark, docs), frame(spark, items, "item_id long, text string"), limit=limit)
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in decontaminate.hits(found).collect()}
    for doc_id, body in docs:
        w = re.findall("[a-z0-9]+", (body or "").lower())
        hit, named = set(), set()
        for item, t in items:
            x = t.split()
            n = min(10, len(x))
            for j in range(len(x) - n + 1) if x else ():
                for i in range(len(w) - n + 1):
                    if w[i : i + n] == x[j : j + n]:
                        hit |= set(range(i, i + n))
                        named.add(str(item))
        digest = hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
        assert got[doc_id] == (len(w), len(hit), len(named), digest)
    clean = {r.doc_id for r in decontaminate.clean_only(frame(spark, docs), frame(spark, items, "item_id long, text string")).collect()}
    assert clean == {d for d, r in got.items() if r[1] == 0}


# Lines


@pytest.mark.parametrize("limits", [(64 << 20, 1 << 15), (1, 3)])
def test_repeated_lines(spark, monkeypatch, limits):
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", limits[1])
    monkeypatch.setattr(line_dedup.build_index, "__defaults__", (limits[1],))
    rng = np.random.default_rng(6)
    pool = [f"line {i} " + "x" * int(rng.integers(25, 45)) for i in range(30)] + ["short", "", "É" * 40, "É" * 39]
    docs = [(int(i), "\n".join(f"{' ' * int(rng.integers(3))}{x.upper() if rng.random() < 0.3 else x}\t" for x in rng.choice(pool, 8))) for i in range(60)]
    docs += [(None, "\n".join(pool)), (59, docs[59][1]), (7, None)]
    found = line_dedup.drop_repeated_lines(frame(spark, docs), limit=limits[0])
    ascii_lower = lambda s: re.sub("[A-Z]", lambda m: m[0].lower(), s)
    key = lambda s: ascii_lower(s.strip(" \t\n\x0b\x0c\r"))
    holders = collections.defaultdict(list)
    for i, (_, text) in enumerate(docs):
        for k in {key(x) for x in (text or "").split("\n")}:
            holders[k].append(i)
    expected = []
    for i, (doc_id, text) in enumerate(docs):
        lines = (text or "").split("\n")
        gone = [
            len(k := key(x)) >= 40 and len(h := holders[k]) >= 5 and doc_id != max((docs[j][0] for j in h if docs[j][0] is not None), default=None)
            for x in lines
        ]
        kept = "\n".join(x for x, g in zip(lines, gone) if not g)
        expected.append((doc_id or -1, len(lines), sum(gone), kept))
    assert sorted((r.doc_id or -1, r.n_lines, r.n_dropped, r.text) for r in found.collect()) == sorted(expected)


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 40_000])
def test_perfect_hash(n):
    keys = np.random.default_rng(n).integers(0, 2**63, (n, 2)).astype(np.uint64)
    if n > 1:
        keys[1, 0] = keys[0, 0]
    numbers = line_dedup.PerfectHash(keys).number(keys)
    assert sorted(numbers.tolist()) == list(range(n))


# Personal data

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(sum(divmod(2 * int(x), 10)) if i % 2 else int(x) for i, x in enumerate(reversed(digits))) % 10 == 0


def plain_spans(text):
    out = []
    for place, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text, re.ASCII):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else None,
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append((m.start(), place, kind, m.end()))
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(out))


ODD = [
    "a@b.c_d@e.f x..y@z-1.org.. q@w e@r.t@y.u @a.b a@.b a@b..c",
    "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.255 1.2.3 999.1.2.3.4 1..2.3.4",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111  1111 4111111111111111-4 378282246310005 30569309025904",
    "+1 (555) 123-4567, +12 3 +1234567890123456 +1((((( +4 4 20.7946.0958 +1+15551234567",
    "\ue000a@b.co\ue000 \ue001 1.1.1.1\ue000 é😀 x@y.zz +15551234567",
    "".join(f"u{i}@h{i}.com" for i in range(30)),
]


def test_base_spans(spark):
    docs = [*rows_of("documents", columns="doc_id, text"), *((10_000 + i, t) for i, t in enumerate(ODD))]
    rng = np.random.default_rng(8)
    docs += [(20_000 + i, "".join(rng.choice(list("a1@.-+ ()5"), 60))) for i in range(1500)]
    found = {r.doc_id: r for r in pii.digests(pii.find(frame(spark, docs))).collect()}
    for doc_id, text in docs:
        expected = plain_spans(text)
        assert found[doc_id].base_sha256 == hashlib.sha256(expected.encode()).hexdigest(), (text[:200], expected, found[doc_id])
        assert [found[doc_id][f"n_{k}"] for k in PLAIN] == [sum(s.startswith(k) for s in expected.split(",")) for k in PLAIN]
        assert set(filter(None, expected.split(","))) <= set(found[doc_id].spans.split(","))


def test_revealing_terms(spark):
    docs = [(i, f"agent Zorblax{i % 2} wrote to spy{i % 2}@mail.org about the plans") for i in range(10)]
    docs += [(100 + i, f"the plans about nothing {i} wrote agent") for i in range(40)]
    spans = {r.doc_id: r.spans for r in pii.digests(pii.find(frame(spark, docs))).collect()}
    for i, text in docs[:10]:
        a = text.index("Zorblax")
        assert f"removed:{a}:{a + 8}" in spans[i].split(",")
        assert "plans" not in spans[i]
        assert len(spans[i].split(",")) == 2
    assert all(spans[i] == "" for i, _ in docs[10:])
    clean = {r.doc_id: r.text for r in pii.sanitise(frame(spark, docs)).collect()}
    assert clean[0] == "agent  wrote to [EMAIL] about the plans"
    assert clean[100] == docs[10][1]


def test_disclosure_ratio(spark):
    docs = [(i, "word codename near a@b.org here") for i in range(6)] + [(9, "codename alone"), (10, "x"), (11, "y")]
    rows = frame(spark, docs)
    base = pii.found_spans(rows)
    found = {r.term: r.ratio for r in pii.disclosing_terms(rows, base, 3).collect()}
    information = -math.log2(6 / 10)
    assert found["near"] == pytest.approx(1.0)
    ratio = 1 + math.log2(6 / 7) / information
    assert ("codename" in found) == (ratio >= pii.DISCLOSES)


# Fingerprints


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] if x == y else math.inf))
        row = new
    return row[-1]


def test_neighbours(spark):
    rows = rows_of("documents", SMALL, "doc_id, text")
    rows += [(5000, ""), (5001, None), (5002, "é" * 7), (5003, "😀a")]
    found = {r.doc_id: r for r in fingerprints.compare_neighbours(frame(spark, rows).repartition(7)).collect()}
    rows = [(d, t or "") for d, t in sorted(rows)]
    assert len(found) == len(rows)
    for i, (doc_id, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        r = found[doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        own, other = fingerprints.fingerprint(text), fingerprints.fingerprint(changed)
        assert (r.fingerprint, r.edited_fingerprint) == (own, other)
        assert r.near_edited == fingerprints.likeness(own, other)
        assert r.near_next == fingerprints.likeness(own, fingerprints.fingerprint(after))


def test_likeness_is_edit_distance():
    rng = np.random.default_rng(2)
    for _ in range(50):
        a, b = ("".join(rng.choice(fingerprints.PAIRS[:6], rng.integers(1, 90))) for _ in range(2))
        x, y = ([s[i : i + 2] for i in range(0, len(s), 2)] for s in (a, b))
        if a != b:
            assert fingerprints.likeness_of(a, b) == pytest.approx(1 - edit_distance(x, y) / (len(x) + len(y)))


def test_segments_do_not_show(monkeypatch):
    text = rows_of("documents", SMALL, "max_by(text, length(text))")[0][0]
    whole = fingerprints.fingerprint(text)
    monkeypatch.setattr(fingerprints, "SEGMENT", 100)
    assert fingerprints.fingerprint(text) == whole


def test_small_edits_stay_near():
    text = rows_of("documents", SMALL, "max_by(text, length(text))")[0][0]
    near = fingerprints.likeness(fingerprints.fingerprint(text), fingerprints.fingerprint("x" + text[:3000] + "inserted" + text[3000:]))
    assert near >= 0.9


# URLs


def test_only_fetched_rules_run():
    rules = [url_filter.token_rule("block", "spam"), url_filter.host_rule("allow", "org", "/"), url_filter.Rule("any", "block", "q=", (), 0)]
    index = url_filter.file_rules(rules, {"spam": 2, "org": 9})
    assert {k: len(v) for k, v in index.items()} == {"spam": 1, "org": 1, None: 1}
    rule = url_filter.host_rule("block", "example.org", "/en/1")
    assert rule.tokens == ("example", "org", "en")
    assert url_filter.file_rules([rule], {"example": 5, "org": 9, "en": 2}) == {"en": [rule]}


def test_odd_urls(spark):
    urls = [None, "", "no scheme", "://", "http://ORG/", "http://a.org", "http://a.org?x=/", "http://corg/x", "https://x.example.org/en/1#y",
            "https://example.org/en/2", "a://b://c.com/de/", "http://x.COM/de/é?q", "http://u@h.com:80/fr/", "http://spam.net/a", "http://my.com/fr/\n/x"]
    found = url_filter.judge(frame(spark, list(enumerate(urls)), "page_id long, url string")).collect()
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in found}
    assert [got[i] for i in range(len(urls))] == [
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("org", "/", "org/", "allow"),
        ("a.org", "", None, "allow"), ("a.org", "", None, "allow"), ("corg", "/x", None, "allow"),
        ("x.example.org", "/en/1", "example.org/en/1", "block"), ("example.org", "/en/2", "org/", "allow"), ("b:", "//c.com/de/", None, "allow"),
        ("x.com", "/de/é", "com/de/", "block"), ("u@h.com:80", "/fr/", None, "allow"), ("spam.net", "/a", None, "block"), ("my.com", "/fr/\n/x", "com/fr/", "allow"),
    ]


# Pipeline


def test_pipeline_stages(spark):
    sf, docs = str(MIDDLE), spark.read.parquet(f"{MIDDLE}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_copies", "decontamination", "mixing", "sharding"]
    kept = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        before = kept[list(kept)[-1]]
        kept[name] = corpus_pipeline.stored(stage(spark, before, sf), "test")
        if name != "sharding":
            assert kept[name].columns == docs.columns
    rows = {name: [(r.doc_id, r.text) for r in df.collect()] for name, df in kept.items() if name != "sharding"}
    model = corpus_pipeline.toxicity_model(docs, spark, sf)
    scores = toxicity.Scorer(model).scores([t for _, t in rows["documents"]])
    langs = dict(rows_of("documents", columns="doc_id, lang"))
    clean = [r for r, s in zip(rows["documents"], scores) if s < model.thresholds.get(langs[r[0]], 0.3)]
    assert sorted(rows["toxicity"]) == sorted(clean)
    one = [r for r, c in zip(clean, classes(clean, linked_pairs(clean))) if c == r[0]]
    assert sorted(rows["near_copies"]) == sorted(one)
    windows = {w for (t,) in rows_of("benchmark", columns="text") for w in decontaminate.windows_of(decontaminate.split_words(t))}
    dirty = lambda t: any(tuple(w[i : i + 10]) in windows for w in [decontaminate.split_words(t)] for i in range(len(w)))
    assert sorted(rows["decontamination"]) == sorted(r for r in one if not dirty(r[1]))
    taken = mixing.mix(kept["decontamination"]).collect()
    times = whole_copies(taken, buckets_for(len(taken)))
    assert collections.Counter(d for d, _ in rows["mixing"]) == collections.Counter({d: n for d, n in times.items() if n})
    shards = [r.shard for r in kept["sharding"].collect()]
    assert len(shards) == len(rows["mixing"])
    counts = collections.Counter(shards)
    assert max(counts.values()) - min(counts.values()) <= 1


def test_run(spark):
    assert corpus_pipeline.run(spark, str(SMALL)).count() > 0
