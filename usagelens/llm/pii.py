"""Personal data: patterns, and terms that give protected entities away.

Emails, IP addresses, card and phone numbers are found by patterns and checks. Each distinct one is a
protected entity. Words near an entity are counted together with it over the whole corpus; the share of a
word's documents in which it stands by the entity is how well the word predicts it. In terms of
information: PMI(entity; word) / IC(entity) = 1 + log2 p(entity | word) / -log2 p(entity). A word whose
ratio reaches `DISCLOSES` with any entity reveals it and is generalised, above `REMOVES` it is removed, wherever
it stands: beside the entity, elsewhere in the document, or in documents without the entity.

Everything is a DataFrame function. Matches are marked in the text with a character that no pattern knows,
and the marked text is cut there, so positions are sums of lengths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.functions.joins import hint_if_small
from usagelens.llm.common import id_text, stored, with_columns

KINDS = ("email", "ip", "card", "phone")
# Each starts where a run of its first characters starts, or where the match before ended, and possessive
# groups keep long runs linear; both find what the plain patterns find.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for its pattern to be tried.
NEEDS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){13}", "phone": r"\+[0-9]"}
MARK, INSTEAD = "\ue000", "\ue001"
#: Words before and after an entity that count as near it.
NEAR_WORDS = 5
#: Documents in which a word and an entity must stand together.
MIN_SUPPORT = 3
DISCLOSES = 0.95
REMOVES = 0.999
WORD = r"[\p{L}][\p{L}\p{N}]{2,}+"
#: The shortest beginning of a text that holds its first NEAR_WORDS words, and that of a reversed text.
FIRST_WORDS = rf"^(?s:.*?{WORD}){{0,{NEAR_WORDS}}}"
LAST_WORDS = rf"^(?s:.*?(?<![\p{{L}}\p{{N}}])[\p{{L}}\p{{N}}]{{2,}}\p{{L}}){{0,{NEAR_WORDS}}}"
LABELS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "term": "[TERM]", "removed": ""}
SPAN = "struct<kind:string,start:bigint,end:bigint,value:string>"


def passes(kind: str, value: Column) -> Column:
    """The check beyond the pattern."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    n = F.length(digits)
    if kind == "ip":
        short = lambda part: F.regexp_replace(part, "^0+", "")
        return F.forall(
            F.split(value, r"\."),
            lambda part: (F.length(short(part)) <= 3) & (F.coalesce(short(part).try_cast("int"), F.lit(0)) <= 255),
        )
    if kind == "card":
        doubled = lambda x: F.when(x > 4, 2 * x - 9).otherwise(2 * x)
        luhn = F.aggregate(
            F.sequence(F.lit(1), n),
            F.lit(0),
            lambda total, i: total
            + F.when((n - i) % 2 == 1, doubled(F.substring(digits, i, F.lit(1)).cast("int"))).otherwise(
                F.substring(digits, i, F.lit(1)).cast("int")
            ),
        )
        return F.when(n.between(14, 19), luhn % 10 == 0).otherwise(F.lit(False))
    if kind == "phone":
        return n.between(10, 15)
    return F.lit(True)


def located(text: Column, pattern: str, kind: str) -> Column:
    """Spans (kind, start, end, value) of the pattern's matches, by start; positions in code points."""
    parts = F.split(F.regexp_replace(text, pattern, f"{MARK}$0{MARK}"), MARK)
    # Parts lie outside and inside of matches in turn.
    none = F.array().cast(f"array<{SPAN}>")

    def add(state: Column, part: Column) -> Column:
        end = state["at"] + F.length(part)
        span = F.struct(F.lit(kind).alias("kind"), state["at"].alias("start"), end.alias("end"), part.alias("value"))
        spans = F.when(state["inside"], F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(end.alias("at"), (~state["inside"]).alias("inside"), spans.alias("spans"))

    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit(False).alias("inside"), none.alias("spans"))
    found = F.aggregate(parts, start, add)["spans"]
    return F.filter(found, lambda s: passes(kind, s["value"]))


def base_spans(clean: Column) -> Column:
    """All checked spans of a text without MARK, by start and then kind as listed."""
    none = F.array().cast(f"array<{SPAN}>")
    each = [F.when(clean.rlike(NEEDS[k]), located(clean, PATTERNS[k], k)).otherwise(none) for k in KINDS]
    return in_order(F.concat(*each), KINDS)


def in_order(spans: Column, kinds: tuple[str, ...]) -> Column:
    place = lambda s: F.array_position(F.array(*[F.lit(k) for k in kinds]), s["kind"])
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), place(s).alias("place"), s.alias("span")))
    return F.transform(F.array_sort(keyed), lambda x: x["span"])


def entity_of(span: Column) -> Column:
    """One name for all spellings of an entity."""
    plain = F.regexp_replace(span["value"], "[^0-9]", "")
    return F.concat(span["kind"], F.lit(":"), F.when(span["kind"].isin("email", "ip"), F.lower(span["value"])).otherwise(plain))


def near_terms(text: Column, spans: Column) -> Column:
    """(entity, term, start, end) of the words near each span, themselves in no span."""

    def around(span: Column) -> Column:
        back = F.regexp_extract(F.reverse(F.substring(text, F.lit(1), span["start"].cast("int"))), LAST_WORDS, 0)
        ahead = F.regexp_extract(F.substring(text, (span["end"] + 1).cast("int"), F.length(text)), FIRST_WORDS, 0)
        before = words_at(F.reverse(back), span["start"] - F.length(back))
        near = F.concat(before, words_at(ahead, span["end"]))
        free = F.filter(near, lambda w: ~F.exists(spans, lambda s: (w["start"] < s["end"]) & (s["start"] < w["end"])))
        entity = entity_of(span)
        return F.transform(free, lambda w: F.struct(entity.alias("entity"), F.lower(w["value"]).alias("term"), w["start"].alias("start"), w["end"].alias("end")))

    return F.array_distinct(F.flatten(F.transform(spans, around)))


def words_at(text: Column, offset: Column) -> Column:
    found = located(text, WORD, "term")
    return F.transform(found, lambda s: F.struct((s["start"] + offset).alias("start"), (s["end"] + offset).alias("end"), s["value"].alias("value")))


def found_spans(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, base, near: what each text holds, without the text."""
    clean = F.translate(F.coalesce("text", F.lit("")), MARK, INSTEAD)
    rows = with_columns(docs, "doc_id", "text").select("doc_id", F.xxhash64("text").alias("text_hash"), clean.alias("text"))
    rows = rows.withColumn("base", base_spans(F.col("text")))
    near = F.when(F.size("base") > 0, near_terms(F.col("text"), F.col("base")))
    return rows.select("doc_id", "text_hash", "base", near.alias("near"))


def document_counts(docs: DataFrame) -> DataFrame:
    """term, n_docs: in how many documents each word stands, over the whole corpus."""
    return docs.select(F.explode(distinct_words()).alias("term")).groupBy("term").agg(F.count("*").alias("n_docs"))


def distinct_words() -> Column:
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), 0)
    return F.array_distinct(F.transform(words, lambda w: F.lower(w)))


def disclosing_terms(docs: DataFrame, found: DataFrame, min_support: int = MIN_SUPPORT) -> DataFrame:
    """entity, term, ratio (PMI / IC) of the pairs whose ratio reaches DISCLOSES.

    A word and an entity count as together in a document where the word stands near the entity. Pairs in fewer
    than `min_support` documents say nothing about the word and are left out.
    """
    both = F.array_distinct(F.transform("near", lambda w: F.struct(w["entity"].alias("entity"), w["term"].alias("term"))))
    pairs = (
        found.filter(F.size("near") > 0)
        .select(F.explode(both).alias("pair"))
        .groupBy("pair.entity", "pair.term")
        .agg(F.count("*").alias("together"))
        .filter(F.col("together") >= min_support)
    )
    entities = (
        found.filter(F.size("base") > 0)
        .select(F.explode(F.array_distinct(F.transform("base", entity_of))).alias("entity"))
        .groupBy("entity")
        .agg(F.count("*").alias("n_entity"))
    )
    n_all = found.count()
    of_word = F.least(F.lit(1.0), F.col("together") / F.col("n_docs"))
    information = -F.log2(F.col("n_entity") / F.lit(n_all + 1.0))
    ratio = 1 + F.log2(of_word) / information
    return (
        pairs.join(entities, "entity")
        .join(document_counts(docs), "term")
        .select("entity", "term", ratio.alias("ratio"))
        .filter(F.col("ratio") >= DISCLOSES)
    )


def occurrences(text: Column, terms: Column) -> Column:
    """Spans of all words of a text without MARK that are keys of `terms` (term -> kind), by start."""
    none = F.array().cast(f"array<{SPAN}>")

    def add(state: Column, part: Column) -> Column:
        end = state["at"] + F.length(part)
        term = F.lower(part)
        span = F.struct(terms[term].alias("kind"), state["at"].alias("start"), end.alias("end"), term.alias("value"))
        wanted = state["inside"] & F.map_contains_key(terms, term)
        spans = F.when(wanted, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(end.alias("at"), (~state["inside"]).alias("inside"), spans.alias("spans"))

    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit(False).alias("inside"), none.alias("spans"))
    return F.aggregate(F.split(F.regexp_replace(text, WORD, f"{MARK}$0{MARK}"), MARK), start, add)["spans"]


def term_spans(docs: DataFrame, found: DataFrame, revealing: DataFrame) -> DataFrame:
    """id, text_hash, own (term -> kind), terms: where the revealing words of a document stand in it.

    Documents without such words are left out; those that agree in id and text are one.
    """
    kind = F.when(F.max("ratio") >= REMOVES, F.lit("removed")).otherwise(F.lit("term"))
    kinds = stored(revealing.groupBy("term").agg(kind.alias("kind")), "pii-terms")
    rows = with_columns(docs, "doc_id", "text").select(id_text().alias("id"), F.xxhash64("text").alias("text_hash"), "text")
    near = found.filter(F.size("near") > 0).select(id_text().alias("id"), "text_hash", F.explode("near.term").alias("term"))
    held = rows.select("id", "text_hash", F.explode(distinct_words()).alias("term")).unionByName(near)
    own = F.map_from_entries(F.collect_set(F.struct("term", "kind"))).alias("own")
    owners = stored(held.join(hint_if_small(kinds), "term").groupBy("id", "text_hash").agg(own), "pii-owners")
    clean = F.translate(F.coalesce("text", F.lit("")), MARK, INSTEAD)
    where = rows.join(hint_if_small(owners), ["id", "text_hash"]).withColumn("text", clean)
    return where.select("id", "text_hash", "own", occurrences(F.col("text"), F.col("own")).alias("terms")).dropDuplicates(["id", "text_hash"])


def find(docs: DataFrame, min_support: int = MIN_SUPPORT) -> DataFrame:
    """doc_id, text_hash, base, spans for each row of `docs`: checked spans, and those with revealing terms.

    A revealing term is marked wherever it stands outside of checked spans, in all documents. A null text counts as
    empty. Rows that agree in id and text get the same spans, each as a row of its own; null ids are allowed;
    extra columns are ignored. Spans carry kind, start, end, value.
    """
    found = stored(found_spans(docs), "pii")
    terms = term_spans(docs, found, disclosing_terms(docs, found, min_support))
    joined = found.withColumn("id", id_text()).join(terms, ["id", "text_hash"], "left")
    none = F.array().cast(f"array<{SPAN}>")
    free = F.filter("terms", lambda w: ~F.exists("base", lambda s: (w["start"] < s["end"]) & (s["start"] < w["end"])))
    # Of a word that runs into a checked span, the part outside stands in `near`.
    beside = F.transform(
        F.filter("near", lambda w: F.map_contains_key(F.col("own"), w["term"])),
        lambda w: F.struct(F.col("own")[w["term"]].alias("kind"), w["start"].alias("start"), w["end"].alias("end"), w["term"].alias("value")),
    )
    every = F.array_distinct(F.concat("base", F.coalesce(free, none), F.coalesce(beside, none)))
    spans = in_order(every, (*KINDS, "term", "removed"))
    return joined.select("doc_id", "text_hash", "base", spans.alias("spans"))


def sanitise(docs: DataFrame, min_support: int = MIN_SUPPORT) -> DataFrame:
    """doc_id, text for each row of `docs`, spans replaced by their label, removed terms by nothing.

    Of overlapping spans the first one counts. A null text stays null.
    """
    spans = find(docs, min_support).filter(F.size("spans") > 0).select(id_text().alias("id"), "text_hash", "spans")
    spans = spans.dropDuplicates(["id", "text_hash"])
    rows = with_columns(docs, "doc_id", "text").withColumns({"id": id_text(), "text_hash": F.xxhash64("text")})
    joined = rows.join(spans, ["id", "text_hash"], "left")
    label = F.create_map(*[F.lit(x) for pair in LABELS.items() for x in pair])

    def put(state: Column, span: Column) -> Column:
        between = F.substring(F.col("text"), (state["at"] + 1).cast("int"), (span["start"] - state["at"]).cast("int"))
        new = F.struct(span["end"].alias("at"), F.concat(state["out"], between, label[span["kind"]]).alias("out"))
        return F.when(span["start"] >= state["at"], new).otherwise(state)

    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))
    done = F.aggregate("spans", start, put)
    rest = F.substring(F.col("text"), (done["at"] + 1).cast("int"), F.length("text"))
    return joined.select("doc_id", F.when(F.size("spans") > 0, F.concat(done["out"], rest)).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, from `find`."""
    listed = lambda c: F.concat_ws(",", F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )
