"""The operators of this package as queries over the sample tables, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.llm import (
    bpe,
    decontaminate,
    fingerprints,
    langid,
    line_dedup,
    mixing,
    ngram_join,
    pii,
    prefixes,
    repair,
    sharding,
    toxicity,
    url_filter,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(modulus: int):
    """The remainder that decides whether a document is held out; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % modulus


@query
def op1_mix_sources(spark, sf_dir):
    found = mixing.mix(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "source", "size", "source_size", "target", "taken", "shards")


@query
def op2_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    profiles = langid.learn(docs.filter(fold(5) != 0))
    return langid.identify(docs, profiles).select("doc_id", (fold(5) == 0).alias("held_out"), "lang_pred", "score")


@query
def op3_ngram_jaccard_join(spark, sf_dir):
    found = ngram_join.near_copies(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_links", "class_size")


@query
def op4_shards(spark, sf_dir):
    return sharding.interleave(table(spark, sf_dir, "documents"))


def toxicity_model(docs: DataFrame, spark: SparkSession, sf_dir: str) -> toxicity.Model:
    return toxicity.fit(docs.filter(fold(4) != 2), table(spark, sf_dir, "labels"))


@query
def op5_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = toxicity.score(docs, toxicity_model(docs, spark, sf_dir))
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted")
    return found.select("doc_id", (fold(4) == 2).alias("held_out"), "score", predicted)


@query
def op6_decontaminate(spark, sf_dir):
    found = decontaminate.find_spans(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.hits(found)


@query
def op7_line_dedup(spark, sf_dir):
    return line_dedup.digests(line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents")))


@query
def op8_pii(spark, sf_dir):
    return pii.digests(pii.find(table(spark, sf_dir, "documents")))


@query
def op9_fingerprints(spark, sf_dir):
    return fingerprints.compare_neighbours(table(spark, sf_dir, "documents"))


@query
def op10_url_filter(spark, sf_dir):
    return url_filter.judge(table(spark, sf_dir, "pages"))


@query
def op11_repair(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    return repair.repair(repair.damaged(turns), turns.select("conv_id").distinct())


@query
def op12_bpe(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.json")
    coded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path)
    return coded.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op13_prefix_trie(spark, sf_dir):
    return prefixes.nodes(*prefixes.rebuilt(table(spark, sf_dir, "conversations")))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLES["op6_decontaminate"] = rf"""
WITH words AS (
    SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents),
items AS (
    SELECT item_id,
        regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark WHERE text IS NOT NULL),
windows AS (
    SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, array_to_string(w[i : i + 9], ' ') AS pattern, least(10, len(w)) AS n
    FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 8))) AS i FROM items WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM windows),
places AS (
    SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words, lengths WHERE len(w) >= n),
hits AS (
    SELECT r, i, places.n AS n, item
    FROM (SELECT r, n, i, array_to_string(w[i : i + n - 1], ' ') AS pattern FROM places) AS places
    JOIN windows USING (pattern, n)),
hit_words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
hit_items AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT r, item FROM hits WHERE item IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)
"""

ORACLES["op7_line_dedup"] = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS n FROM docs),
keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key
    FROM lines),
repeated AS (
    SELECT key, max(doc_id) AS largest FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT r) >= 5),
marked AS (
    SELECT r, doc_id, n, line, coalesce(repeated.key IS NOT NULL AND doc_id IS DISTINCT FROM largest, false) AS gone
    FROM keyed LEFT JOIN repeated USING (key))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r
"""

ORACLES["op10_url_filter"] = f"""
WITH cut AS (
    SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM cut),
rules(h, p, verdict) AS (
    VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
        ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
best AS (
    SELECT page_id, host, path, max_by(h || p, length(h || p)) AS rule, max_by(verdict, length(h || p)) AS verdict
    FROM (SELECT row_number() OVER () AS r, * FROM parts)
    LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
    GROUP BY r, page_id, host, path)
SELECT page_id, host, path, rule,
    coalesce(verdict, CASE WHEN regexp_matches(host, '(^|[^a-z0-9])(adult|casino|porn|spam|warez|xxx)([^a-z0-9]|$)')
        THEN 'block' ELSE 'allow' END) AS verdict
FROM best
"""


def crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit."""
    shifted = "CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END"
    codes = f"list_transform(range(1, length({text}) + 1), lambda i: CAST(ascii(substr({text}, i, 1)) AS BIGINT))"
    each = f"lambda a, b: xor(a // 256, list_reduce(range(8), lambda c, i: {shifted}, xor(a, b) % 256))"
    return f"xor(list_reduce({codes}, {each}, 4294967295), 4294967295)"


SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def edit_sql(state: str, cost: str | int, letter: str, line: str) -> str:
    """A state {k: cost and audit, t: repaired lines} after one more edit; NULL stays NULL."""
    price = f"lpad(CAST(CAST(left({state}.k, 8) AS INT) + {cost} AS VARCHAR), 8, '0')"
    return (
        f"CASE WHEN {state} IS NOT NULL THEN {{'k': {price} || substr({state}.k, 9) || '{letter}', 't': {state}.t || {line}}} END"
    )


def row_sql(to: int, come_from: list[int], symbol: str) -> str:
    """The best way to stand in state `to` after a row: delete it there, or keep or rerole it from another state."""
    options = [edit_sql(f"c{to}", 2, "D", "''")]
    role = {"u": "user", "a": "assistant"}.get(symbol)
    for p in come_from:
        kept = edit_sql(f"c{p}", "more", "K", "role || ':' || text || chr(10)")
        options.append(f"CASE WHEN stays AND initial = '{symbol}' THEN {kept} END")
        if role:
            moved = edit_sql(f"c{p}", "1 + more", "R", f"'{role}:' || text || chr(10)")
            options.append(f"CASE WHEN stays THEN {moved} END")
    return f"least({', '.join(options)})" if len(options) > 1 else options[0]


USER_LINE, ASSISTANT_LINE = "'user:' || chr(10)", "'assistant:' || chr(10)"
NO_STATE = "CAST(NULL AS STRUCT(k VARCHAR, t VARCHAR))"

ORACLES["op11_repair"] = f"""
WITH RECURSIVE keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
    FROM conversations),
coded AS (SELECT *, {crc32_sql("k")} % 20 AS code FROM keyed),
damaged AS (
    SELECT conv_id, turn, CASE code WHEN 4 THEN 'user' ELSE role END AS role,
        CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(range(CASE code WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
    FROM coded),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth,
        left(role, 1) AS initial, right(rtrim(text, {SPACES}), 1) AS last
    FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM damaged)),
faulty AS (
    SELECT *, CASE WHEN last = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
        WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
        lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial NOT IN ('su', 'ua', 'au') AS illegal
    FROM placed),
counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal, max(i) AS n
    FROM faulty GROUP BY conv_id),
walk AS (
    SELECT conv_id, CAST(0 AS BIGINT) AS i, {{'k': '00000000', 't': ''}} AS c0, {NO_STATE} AS c1,
        {{'k': '00000005I', 't': {USER_LINE}}} AS c2, {{'k': '00000010II', 't': {USER_LINE} || {ASSISTANT_LINE}}} AS c3
    FROM counts
    UNION ALL
    SELECT conv_id, i, d0, d1, e2, least(d3, {edit_sql("e2", 5, "I", ASSISTANT_LINE)})
    FROM (
        SELECT *, least(d2, {", ".join(edit_sql(f"d{p}", 5, "I", USER_LINE) for p in (0, 1, 3))}) AS e2
        FROM (
            SELECT conv_id, i, {row_sql(0, [], "")} AS d0, {row_sql(1, [0], "s")} AS d1,
                {row_sql(2, [0, 1, 3], "u")} AS d2, {row_sql(3, [2], "a")} AS d3
            FROM (
                SELECT walk.conv_id, walk.i + 1 AS i, c0, c1, c2, c3, role, text, initial,
                    fault NOT IN ('blank', 'duplicate') AS stays, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END AS more
                FROM walk JOIN faulty ON walk.conv_id IS NOT DISTINCT FROM faulty.conv_id AND faulty.i = walk.i + 1)))),
best AS (
    SELECT counts.conv_id AS conv_id, least(c0, c3) AS x
    FROM walk JOIN counts ON walk.conv_id IS NOT DISTINCT FROM counts.conv_id AND walk.i = counts.n)
SELECT ids.conv_id AS conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
    coalesce(CAST(left(x.k, 8) AS BIGINT), 0) AS cost, coalesce(substr(x.k, 9), '') AS audit,
    sha256(coalesce(left(x.t, greatest(length(x.t) - 1, 0)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS ids
LEFT JOIN counts ON ids.conv_id IS NOT DISTINCT FROM counts.conv_id
LEFT JOIN best ON ids.conv_id IS NOT DISTINCT FROM best.conv_id
"""

ORACLES["op13_prefix_trie"] = f"""
WITH turns AS (
    SELECT conv_id, turn, text, sha256(length(role) || ':' || role || text) AS key
    FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, key) AS place FROM turns),
convs AS (
    SELECT conv_id, {crc32_sql("CAST(conv_id AS VARCHAR)")} % 6 AS h, conv_id - conv_id % 100 AS base
    FROM (SELECT DISTINCT conv_id FROM turns)),
rebuilt AS (
    SELECT convs.conv_id, place, key, text FROM convs JOIN placed ON placed.conv_id = base WHERE place <= h
    UNION ALL
    SELECT convs.conv_id, place + 5, key, text FROM convs JOIN placed ON placed.conv_id = convs.conv_id WHERE place > h),
deep AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY place) AS depth,
        string_agg(key, '') OVER (PARTITION BY conv_id ORDER BY place) AS prefix
    FROM rebuilt),
members AS (
    SELECT conv_id, 0 AS depth, '' AS prefix, NULL AS parent, 0 AS n_chars FROM convs
    UNION ALL
    SELECT conv_id, depth, prefix, left(prefix, 64 * (depth - 1)), length(text) FROM deep),
nodes AS (
    SELECT prefix, min(conv_id) AS conv_id, any_value(depth) AS depth, any_value(parent) AS parent, count(*) AS n_convs,
        (count(*) - 1) * any_value(n_chars) AS saved
    FROM members GROUP BY prefix),
children AS (SELECT parent AS prefix, count(*) AS n_children FROM nodes GROUP BY parent),
below AS (
    SELECT members.prefix AS prefix, sum(saved) AS saved_tokens, count(*) FILTER (n_children IS NULL) AS n_leaves
    FROM nodes LEFT JOIN children USING (prefix)
    JOIN members ON members.conv_id = nodes.conv_id AND members.depth <= nodes.depth
    GROUP BY members.prefix),
ends AS (
    SELECT prefix, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids
    FROM (SELECT conv_id, max_by(prefix, depth) AS prefix FROM members GROUP BY conv_id) GROUP BY prefix)
SELECT nodes.conv_id AS conv_id, CAST(nodes.depth AS BIGINT) AS depth, parents.conv_id AS parent_conv_id, nodes.n_convs AS n_convs,
    coalesce(n_children, 0) AS n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens,
    sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes JOIN below USING (prefix) LEFT JOIN children USING (prefix) LEFT JOIN ends USING (prefix)
LEFT JOIN nodes AS parents ON parents.prefix = nodes.parent
"""
