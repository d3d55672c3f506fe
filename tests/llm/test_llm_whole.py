"""Whole results where an operator used to stop at a window, a number of blocks, a sample or a table's size."""

import heapq

import numpy as np
import pytest

import corpus_pipeline
from usagelens.llm import decontaminate, mixing, pii, toxicity
from usagelens.llm.common import buckets_for, stored_paths


def spans_of(spark, docs):
    found = pii.find(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    return {r.doc_id: [(s.kind, docs_text[s.start : s.end]) for s in r.spans] for r in found for docs_text in [dict(docs)[r.doc_id]]}


def test_revealing_terms_are_marked_wherever_they_stand(spark):
    far = "one two three four five six seven eight nine ten " * 9
    docs = [(i, f"Zorblax a@b.org here {far} and zorblax again, not Zorblaxes") for i in range(60)]
    docs += [(100, f"only ZORBLAX {far}"), (101, "nothing of it"), *((200 + i, f"plain {far}") for i in range(100))]
    spans = spans_of(spark, docs)
    for i in range(60):
        assert [t.lower() for k, t in spans[i] if k in ("term", "removed")].count("zorblax") == 2
    assert [t for _, t in spans[100]] == ["ZORBLAX"]
    assert spans[101] == spans[200] == []
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    clean = {r.doc_id: r.text for r in pii.sanitise(rows).collect()}
    assert "zorblax" not in clean[100].lower() and "Zorblaxes" in clean[0]


def test_near_is_counted_in_words_not_characters(spark):
    gap = " . " * 100
    docs = [(i, f"Quuxford{gap}a@b.org{gap}Plughton") for i in range(5)] + [(10 + i, "none") for i in range(20)]
    spans = spans_of(spark, docs)
    assert all([t for _, t in spans[i]] == ["Quuxford", "a@b.org", "Plughton"] for i in range(5))


def test_five_words_each_side(spark):
    docs = [(i, "w11abc w22abc w33abc 7 w44 55 w55abc é w66abc, x@y.org; v1a v2a v3a v4a v5a v6a") for i in range(5)]
    docs += [(10 + i, "none") for i in range(20)]
    near = [t for _, t in spans_of(spark, docs)[0]]
    assert near == ["w22abc", "w33abc", "w44", "w55abc", "w66abc", "x@y.org", "v1a", "v2a", "v3a", "v4a", "v5a"]


@pytest.mark.parametrize(
    "goals",
    [
        [(60, 41.0), (30, 50.0), (10, 9.0)],
        [(4, 6.875), (6, 2.75), (1, 1.375)],
        [(1000, 1437.5), (1000, 500.5), (37, 111.0), (12, 0.0), (100, 100.0)],
        [(100, 2.5)] + [(1, 2.5)] * 39,
    ],
)
def test_word_quotas_are_seats_by_highest_quotient(spark, goals):
    rows = [(i, size, target) for i, (size, target) in enumerate(goals)]
    found = mixing.word_quotas(spark.createDataFrame(rows, "rank long, source_size long, target double")).collect()
    waiting = [(-t, i, 0) for i, _, t in rows if t]
    heapq.heapify(waiting)
    expected = dict.fromkeys((i for i, _, t in rows if t), 0)
    for _ in range(sum(size for size, _ in goals)):
        while True:
            _, i, seat = heapq.heappop(waiting)
            if seat < 3 * goals[i][0]:
                break
        expected[i] += 1
        heapq.heappush(waiting, (-goals[i][1] / (2 * seat + 3), i, seat + 1))
    assert {r.rank: r.quota for r in found} == expected


def test_small_sources_stay_in_a_large_mix(spark):
    # Of 5 billion words, a block in 65,536 has some 76,000: sources below that.
    sizes = [3_000_000_000, 2_000_000_000, 12_000, 20_000, 1]
    rows = [(f"s{i}", x) for i, x in enumerate(sizes)]
    goals = mixing.targets(spark.createDataFrame(rows, "source string, source_size long"))
    found = goals.join(mixing.word_quotas(goals), "rank").collect()
    assert len(found) == len(sizes)
    assert all(abs(r.quota - r.target) <= 2 for r in found)
    assert sum(r.quota for r in found) == sum(sizes)
    quota = {r.source: r.quota for r in found}
    assert (quota["s2"], quota["s3"], quota["s4"]) == (36_000, 60_000, 3)


def test_items_above_the_limit_are_searched_in_pieces(spark):
    words = [f"w{i}" for i in range(500)]
    items = spark.createDataFrame([(1, " ".join(words)), (2, "w7 w8")], "item_id long, text string")
    texts = [(i, "x " + " ".join(words[i : i + 10]) + " y") for i in range(491)]
    texts += [(1000, " ".join(words)), (1001, " ".join(words[3:7])), (1002, " ".join(words[20:29]))]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = {r.doc_id: r for r in decontaminate.find_spans(docs, items, limit=40_000).collect()}
    assert all(r.spans[0] == 1 and r.spans[1] == 11 and "1" in r["items"] for i, r in found.items() if i < 491)
    assert found[1000].spans == [0, 500] and found[1000]["items"] == ["1", "2"]
    assert found[1001].spans == found[1002].spans == []
    kept = decontaminate.clean_only(docs, items, limit=40_000).collect()
    assert sorted(r.doc_id for r in kept) == [1001, 1002]


@pytest.mark.parametrize("n", [0, 1, 9, 10, 11, 57])
@pytest.mark.parametrize("limit", [1, 2000, 4000, 10**6])
def test_pieces_hold_the_windows_of_the_whole(n, limit):
    words = [b"%d" % (i % 7) for i in range(n)]
    parts = [p for p, _ in decontaminate.parts_of(words, 10, limit)]
    assert set().union(*map(decontaminate.windows_of, parts)) == decontaminate.windows_of(words)


def test_thresholds_come_from_all_rows_left_out_of_training(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "cuts_from", lambda model, counts: seen.extend(counts))
    words = ["good day", "bad fool"]
    rows = [(i, f"{words[i % 10 == 0]} {i} plain text", "en" if i % 3 else "xx", int(i % 10 == 0)) for i in range(400)]
    rows += [(1, "a second text", "en", 0)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    toxicity.fit(docs.drop("toxic"), docs.select("doc_id", "toxic"), max_rows=20)
    # 40 of 400 are sampled, of which 32 train.
    assert sum(r[3] for r in seen) == 368
    assert sum(r[3] for r in seen if r[1]) in range(20, 29)
    assert {r[0] for r in seen} == {"en", "xx"}


def test_counted_cuts_are_those_of_single_rows():
    rng = np.random.default_rng(3)
    steps = np.concatenate([rng.integers(-300, 20, 900), rng.integers(-60, 300, 30)])
    y = np.array([0] * 900 + [1] * 30)
    values, at = np.unique(steps, return_inverse=True)
    counted = np.zeros((2, len(values)))
    np.add.at(counted, (y, at), 1)
    cut = toxicity.best_step(values, *counted)

    def f1(c):
        p = steps * toxicity.STEP >= c
        return 2 * (p & (y == 1)).sum() / (p.sum() + y.sum())

    assert f1(cut) == pytest.approx(max(f1((v - 0.5) * toxicity.STEP) for v in values))


def test_languages_get_cuts_of_their_own():
    model = toxicity.Model(None, {}, {}, None, 0.0)
    counts = [("a", 0, -400, 5000), ("a", 1, 100, 50), ("b", 0, -700, 900), ("b", 1, -500, 9), ("c", 1, 5, 3), (None, 0, -300, 1)]
    toxicity.cuts_from(model, counts)
    assert set(model.thresholds) == {"a", "b"}
    assert toxicity.sigmoid(np.array(-700 / 64 + model.bias)) < model.thresholds["b"] <= toxicity.sigmoid(np.array(-500 / 64 + model.bias))


def test_items_without_id_count_where_no_names_are_wanted(spark):
    items = spark.createDataFrame([(None, "secret passage"), (1, "other words")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a secret passage here"), (2, "other words"), (3, "clean")], "doc_id long, text string")
    assert [r.doc_id for r in decontaminate.clean_only(docs, items).collect()] == [3]


def test_items_without_id_have_windows_but_no_name(spark):
    items = spark.createDataFrame([(None, "secret passage"), (1, "other words"), (None, "Other words")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a secret passage here"), (2, "other words"), (3, "clean")], "doc_id long, text string")
    found = {r.doc_id: (r.n_hit, r.n_items, r.contaminated) for r in decontaminate.hits(decontaminate.find_spans(docs, items)).collect()}
    assert found == {1: (2, 0, True), 2: (2, 1, True), 3: (0, 0, False)}


def test_equal_rows_of_two_sources_keep_their_sources(spark):
    rows = [(1, "one two three four", s) for s in ("a", "b", None)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    copies = {}
    for r in mixing.mix(docs).collect():
        copies[r.source] = copies.get(r.source, 0) + r.copies
    found = [r.source for r in mixing.mixed_rows(docs).collect()]
    assert {s: found.count(s) for s in copies} == copies


def mixed_by_hand(rows, found, shards):
    """(taken, shards) of every document, from each block of the mix: one word, to the highest quotient."""
    goals = {}
    for r in found:
        goals[r.source] = (r.target, r.source_size)
    order = sorted(goals, key=lambda s: (s is None, s or ""))
    queue = [(-goals[s][0], rank, 0, s) for rank, s in enumerate(order) if goals[s][0] > 0]
    heapq.heapify(queue)
    total = sum(size for _, size in goals.values())
    lines = {s: [] for s in goals}
    for n, r in sorted(enumerate(found), key=lambda x: line_order(x[1], len(found))):
        lines[r.source] += [n] * r["size"]
    taken, where = [0] * len(found), [set() for _ in found]
    for place in range(total):
        _, rank, seat, s = heapq.heappop(queue)
        # shard k ends at total * (k + 1) // shards
        shard = next(k for k in range(place * shards // total, shards) if place < total * (k + 1) // shards)
        document = lines[s][seat % len(lines[s])]
        taken[document] += 1
        where[document].add(shard)
        if seat + 1 < mixing.MOST_REPEATS * goals[s][1]:
            heapq.heappush(queue, (-(goals[s][0] / (2 * seat + 3)), rank, seat + 1, s))
    return [(n, sorted(w)) for n, w in zip(taken, where)]


def line_order(r, n_rows):
    return (r.place >> 20) % buckets_for(n_rows), r.place, r.doc_id, r["size"]


@pytest.mark.parametrize("folder", ["sf0.001", None])
def test_every_block_goes_where_the_highest_quotient_says(spark, folder):
    if folder:
        docs = spark.read.parquet(f"/root/testdata/{folder}/documents.parquet")
    else:
        rng = np.random.default_rng(2)
        rows = [(i, "w " * int(rng.integers(0, 30)), [None, "a", "b", "b", "b", "c", "e"][int(rng.integers(0, 7))]) for i in range(300)]
        docs = spark.createDataFrame([*rows, (400, "x", "tiny"), (401, None, "none")], "doc_id long, text string, source string")
    found = mixing.mix(docs).collect()
    assert [(r.taken, sorted(r.shards)) for r in found] == mixed_by_hand(docs, found, mixing.SHARDS)


@pytest.mark.parametrize("n_clean", [100_000, 1_000_000])
def test_cuts_do_not_depend_on_how_many_rows_training_takes(n_clean):
    rng = np.random.default_rng(9)
    y = np.array([0] * n_clean + [1] * (n_clean // 25))
    steps = np.where(y == 1, rng.normal(80, 60, len(y)), rng.normal(-80, 60, len(y))).round().astype(int)
    trained = np.zeros(len(y), dtype=bool)
    for t in (0, 1):
        trained[rng.choice(np.flatnonzero(y == t), min(3200, int(0.8 * (y == t).sum())), replace=False)] = True

    def common(rows, weights):
        values, n = np.unique(np.stack([y[rows], steps[rows]]), axis=1, return_counts=True)
        model = toxicity.Model(None, {}, {}, None, 0.0, left_out=weights)
        toxicity.cuts_from(model, [(None, int(t), int(s), int(k)) for (t, s), k in zip(values.T, n)])
        return model.bias

    everything = common(np.ones(len(y), dtype=bool), (1.0, 1.0))
    left = ~trained
    weights = tuple((y == t).sum() / (left & (y == t)).sum() for t in (0, 1))
    assert common(left, weights) == pytest.approx(everything, abs=0.2)
    if n_clean == 100_000:  # 3,200 of 4,000 toxic rows are gone
        assert common(left, (1.0, 1.0)) < everything - 0.3


def test_the_pipeline_leaves_one_table(spark):
    before = set(stored_paths())
    docs = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert docs.count() > 0
    (left,) = set(stored_paths()) - before
    assert "stage-sharding" in left
