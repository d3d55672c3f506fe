"""Repair and prefix trie of conversations against plain Python and SQL."""

import collections
import hashlib
import heapq
import itertools
import random
import re
import zlib
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from usagelens.llm import prefixes, repair
from usagelens.llm.common import LlmError
from usagelens.llm.queries import ORACLES, QUERIES

SMALL, MIDDLE = (Path("/root/testdata") / x for x in ("sf0.001", "sf0.01"))
SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"

# Repair


def edges(state, row):
    """(cost, letter, next state, role) of each way to treat a row, by the rules as stated."""
    role, text, fault = row
    more = 5 if fault == "truncated" else 0
    yield 2, "D", state, None
    if fault in ("blank", "duplicate"):
        return
    for new, cost, letter in ((role, 0, "K"), ("user", 1, "R"), ("assistant", 1, "R")):
        grown = state + new[:1]
        if new and re.fullmatch("s?(ua)*u?", grown) and len(grown) > len(state):
            yield cost + more, letter, grown, (new, text)


def cheapest(rows):
    """(cost, audit, repaired) by a search over (rows done, initials so far), cheapest and ASCII-least first."""
    queue = [(0, "", 0, "", ())]
    done = set()
    while queue:
        cost, audit, at, state, out = heapq.heappop(queue)
        shape = (at, state[:1] == "s", len(state) and state[-1])
        if shape in done:
            continue
        done.add(shape)
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", state):
            return cost, audit, out
        for role in ("user", "assistant"):
            if re.fullmatch("s?(ua)*u?", state + role[0]):
                heapq.heappush(queue, (cost + 5, audit + "I", at, state + role[0], (*out, (role, ""))))
        if at < len(rows):
            for more, letter, grown, kept in edges(state, rows[at]):
                heapq.heappush(queue, (cost + more, audit + letter, at + 1, grown, (*out, kept) if kept else out))


def with_faults(turns):
    """(role, text, fault) in order; turns are (turn, role, text)."""
    order = sorted(turns, key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), hashlib.sha256(x[2].encode()).digest()))
    seen, out = set(), []
    for _, role, text in order:
        end = text.rstrip(SPACE)[-1:]
        fault = "blank" if not end else "duplicate" if (role, text) in seen else "" if end in ".!?" else "truncated"
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def expected_repair(conv_turns):
    rows = with_faults(conv_turns)
    cost, audit, out = cheapest(rows)
    known = [t for t, _, _ in conv_turns if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    initials = [role[:1] for role, _, _ in rows]
    illegal = sum(pair not in {("s", "u"), ("u", "a"), ("a", "u")} for pair in zip(initials, initials[1:]))
    faults = collections.Counter(f for _, _, f in rows)
    sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, sha


def damage(rows):
    out = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        out[conv]
        if code == 1:
            text = ""
        if code == 2:
            text = re.sub("[.!?]", "", text)
        if code == 4:
            role = "user"
        out[conv] += [(turn, role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    return out


def repaired_by_hand(rows):
    return {conv: expected_repair(turns) for conv, turns in damage(rows).items()}


def as_dict(df):
    columns = "gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
    rows = df.collect()
    found = {r.conv_id: tuple(r[c] for c in columns) for r in rows}
    assert len(found) == len(rows)
    return found


def random_conversations(seed, n, most=7):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "ugly"]
    texts = ["Yes.", "No!", "Why", "", " \t", None, "Hm? ", "open", "é中.", "Yes."]
    rows = []
    for conv in range(n):
        for turn in range(rng.randrange(most)):
            times = 2 if rng.random() < 0.1 else 1
            rows += [(conv, rng.choice([turn, turn, turn, turn + 3, None, 1]), rng.choice(roles[: 3 + seed % 2 * 6]), rng.choice(texts))] * times
    return rows


@pytest.fixture(scope="module")
def sample(spark):
    path = f"{MIDDLE}/conversations.parquet"
    return duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{path}'").fetchall(), spark.read.parquet(path)


def test_repair_of_the_sample(spark, sample):
    found = as_dict(QUERIES["op11_repair"](spark, str(MIDDLE)))
    assert found == repaired_by_hand(sample[0])


@pytest.mark.parametrize("seed", [0, 1])
def test_repair_of_random_conversations(spark, seed):
    rows = [*random_conversations(seed, 120), (None, None, None, None), (None, 2, "user", "Hi."), (-5, 9, "assistant", "Ok.")]
    turns = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("digest", "n", "kind", "cost", "place", "end")})
    found = as_dict(repair.repair(repair.damaged(turns), turns.select("conv_id").distinct()))
    assert found == repaired_by_hand(rows)


def test_a_long_conversation_over_many_ranges(spark):
    rng = random.Random(5)
    rows = [(7, t, rng.choice(["user", "assistant", "system"]), f"{rng.randrange(300)}{rng.choice(['.', ''])}") for t in range(1500)]
    rows += [(6, 0, "user", "a."), (8, 0, "assistant", "b.")] + [(9, 3, "user", "same.")] * 400
    turns = spark.createDataFrame(rows, SCHEMA)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = as_dict(repair.repair(repair.damaged(turns), turns.select("conv_id").distinct()))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert found == repaired_by_hand(rows)


def every_split(cells):
    """The whole chart: every span, from every cut of it."""
    chart = {(i, i + 1): cell for i, cell in enumerate(cells)}
    for length in range(2, len(cells) + 1):
        for i in range(len(cells) - length + 1):
            options = [repair.joined(chart[i, k], chart[k, i + length]) for k in range(i + 1, i + length)]
            chart[i, i + length] = tuple(min((o[n] for o in options if o[n]), default=None) for n in range(len(repair.PAIRS)))
    return chart[0, len(cells)]


def test_one_cut_of_a_span_gives_what_all_cuts_give():
    rng = random.Random(3)
    for _ in range(60):
        cells = [rng.choice([repair.of_row(rng.choice("suax"), rng.random() < 0.3), repair.of_deleted(1)]) for _ in range(rng.randrange(1, 11))]
        span = repair.Span()
        for cell in cells:
            span.push(1, cell)
        assert span.cell() == every_split(cells)


def test_repaired_turns_follow_the_pattern(spark, sample):
    rows = repair.damaged(sample[1])
    turns = repair.repaired(rows, repair.audits(rows)).collect()
    by = collections.defaultdict(list)
    for r in turns:
        by[r.conv_id].append((r.place, r.role[0]))
    for found in by.values():
        found.sort()
        assert [p for p, _ in found] == list(range(len(found)))
        assert re.fullmatch("s?(ua)+", "".join(x for _, x in found))


def test_no_conversations(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repair.repair(none, none.select("conv_id")).collect() == []
    assert prefixes.prefix_trie(none).collect() == []
    with pytest.raises(LlmError, match="missing columns: role"):
        repair.audits(none.drop("role"))


# Prefix trie


def trie_by_hand(paths):
    """Nodes of {conv_id: [(role, text), ...]}, by walking every path."""
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for conv, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(conv)
        ends[tuple(path)].append(conv)
    children = collections.defaultdict(set)
    for node in members:
        if node:
            children[node[:-1]].add(node)
    leaves, saved = collections.Counter(), collections.Counter()
    for node in members:
        own = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += own
            leaves[node[:d]] += not children[node]
    return sorted(
        (
            min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children[node]), leaves[node], saved[node],
            hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest(),
        )
        for node, m in members.items()
    )


def ordered(rows):
    out = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = role or "", text or ""
        key = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
        if conv is not None:
            out[conv].append((turn is not None, turn or 0, key, role, text))
    return {conv: [(r, t) for *_, r, t in sorted(turns)] for conv, turns in out.items()}


def rebuilt_by_hand(rows):
    own = ordered(rows)
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(c - 100 * int(c / 100))
        out[c] = own.get(base, [])[:h] + own[c][h:]
    return out


def found_nodes(df):
    assert df.columns == prefixes.COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=lambda x: (x[0], x[1]))


def test_trie_of_the_sample(spark, sample):
    found = found_nodes(QUERIES["op13_prefix_trie"](spark, str(MIDDLE)))
    assert found == trie_by_hand(rebuilt_by_hand(sample[0]))


def few_turns(seed, n):
    rng = random.Random(seed)
    rows = [(c, rng.choice([t, t, None, 2]), rng.choice(["user", "", None]), rng.choice(["a", "bb", "é中", None, ""])) for c in range(-150, n) for t in range(rng.randrange(6))]
    return rows + [(None, 1, "user", "nobody")]


@pytest.mark.parametrize("width", [None, 1 << 15])
def test_trie_of_random_conversations(spark, monkeypatch, width):
    if width:  # a sketch so full that nothing is proven
        monkeypatch.setattr(prefixes, "MIN_WIDTH", width)
        monkeypatch.setattr(prefixes, "MAX_WIDTH", width)
        monkeypatch.setattr(prefixes, "_cells", lambda width: [F.lit(0).cast("long")] * 2)
        full = lambda p: (width, [b"\xff" * (width // 8)] * 2)
        monkeypatch.setattr(prefixes, "sketch", full)
    rows = few_turns(1, 300)
    turns = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("key", "depth", "hi", "chars")})
    assert found_nodes(prefixes.prefix_trie(turns)) == trie_by_hand(ordered(rows))
    assert found_nodes(prefixes.nodes(*prefixes.rebuilt(turns))) == trie_by_hand(rebuilt_by_hand(rows))


def test_trie_of_long_and_hot_conversations(spark):
    long = [(c, t, "user", f"turn {t}") for c in (3, 40) for t in range(700)] + [(5, t, "user", f"turn {t}" + "x" * (t > 600)) for t in range(900)]
    hot = [(c, t, "user", ["hello", "again"][t]) for c in range(1000, 1900) for t in range(c % 3)]
    rows = [*long, *hot, *((c, 0, "user", "hello") for c in range(2000, 2300))]
    turns = spark.createDataFrame(rows, SCHEMA)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        members = spark.createDataFrame([(c,) for c in {r[0] for r in rows} | {1, 2}], "conv_id long")
        found = found_nodes(prefixes.nodes(prefixes.digested(turns), members))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert found == trie_by_hand({1: [], 2: [], **ordered(rows)})


def test_the_sketch_proves_most_singletons(spark, sample):
    rows = prefixes.screened(prefixes.in_order(prefixes.digested(sample[1]))).collect()
    count = collections.Counter((r.hi, r.lo) for r in rows)
    assert all(r.maybe for r in rows if count[r.hi, r.lo] > 1)
    assert sum(r.maybe for r in rows if count[r.hi, r.lo] == 1) <= 0.02 * len(rows)


@pytest.mark.parametrize("name", ["op11_repair", "op13_prefix_trie"])
@pytest.mark.parametrize("folder", [SMALL, MIDDLE])
def test_sql_agrees(spark, name, folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet'")
    expected = con.execute(ORACLES[name])
    names = sorted(d[0] for d in expected.description)
    places = [[d[0] for d in expected.description].index(n) for n in names]
    found = QUERIES[name](spark, str(folder))
    assert sorted(found.columns) == names
    assert sorted(str([r[n] for n in names]) for r in found.collect()) == sorted(str([r[p] for p in places]) for r in expected.fetchall())
