"""Mixing sources to target weights.

The blocks of the mix, a word each, are handed to sources by highest quotient (Sainte-Laguë: target over odd
numbers), so a source's quota is its target to about a word at any size of the corpus. The sequence of blocks is cut
into shards of as many blocks; each shard's blocks of a source are its integer quota of that source. Every source's
documents are laid on a line of words in a seeded order, gone round as often as the quota asks, and the shards
select their quotas along it, one after another: `taken` is what all shards select of a document, `shards` which do.
Where whole documents are wanted, one goes where its middle lies, so a source is off its target by half a document
at most besides. `quotas` deals larger blocks.

Everything is a DataFrame function. The text is read once; all later steps work on one narrow row for
each document, one for each source, and few seats a source: most of a source's seats are counted, not listed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from usagelens.llm.common import buckets_for, id_text, running_total, stored, with_columns

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
#: A source gives each of its words so many times at most.
MOST_REPEATS = 3
#: Blocks in the whole mix where `quotas` deals them to shards, which bounds the seats listed.
BLOCKS = 1 << 16
SHARDS = 64
SEED = 7


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, source, size (words; null text: 0), and the seeded place in its source's order."""
    return with_columns(docs, "doc_id", "source", "text").select(
        "doc_id",
        "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        place().alias("place"),
    )


def place():
    return F.xxhash64(F.lit(SEED), "doc_id", "text")


def targets(sizes: DataFrame, weights=WEIGHTS, most_repeats: int = MOST_REPEATS) -> DataFrame:
    """source, source_size, target, from one row a source (source, source_size).

    Targets share the total by weight. Those above `most_repeats` times their source's size are set to
    that, and what they leave is shared again by weight, until none is above. In order of
    size / weight the capped sources come first, so running totals find them in one pass.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.withColumn("rank", F.row_number().over(by_name) - 1).select(
        "source",
        "source_size",
        (F.col("source_size") * most_repeats).cast("double").alias("cap"),
        F.get(cycle, (F.col("rank") % len(weights)).cast("int")).alias("weight"),
        F.col("rank"),
    )
    by_room = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    everything = Window.partitionBy()
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    still = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    # The words a unit of weight gets if all sources before this one are capped and it isn't.
    tried = ranked.withColumn("per_weight", left / still)
    free = F.col("per_weight") * F.col("weight") <= F.col("cap")
    room = (F.col("cap") / F.col("weight")).alias("room")
    first_free = F.min(F.when(free, F.struct(room, "rank", "per_weight"))).over(everything)
    return tried.withColumn("level", first_free["per_weight"]).select(
        "source",
        "source_size",
        F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))).alias("target"),
        "rank",
    )


def seats(goals: DataFrame, blocks: int = BLOCKS, shards: int = SHARDS) -> DataFrame:
    """Every block that the mix takes: source rank, block size, and the shard it goes to.

    The quotient of a source's i-th seat is target / (2i + 1); seats are taken in descending order of
    it until the mix has all its blocks, and that order is cut into shards of as many blocks. A source
    offers no more seats than its blocks `MOST_REPEATS` times.
    """
    total = Window.partitionBy()
    words = F.sum("source_size").over(total)
    block = F.greatest(F.lit(1), F.ceil(words / blocks)).cast("long")
    sized = goals.withColumn("block", block).withColumn("n_seats", F.ceil(words / F.col("block")))
    offered = F.least(
        MOST_REPEATS * F.ceil(F.col("source_size") / F.col("block")),
        F.ceil(F.col("target") / F.col("block")) + 1,
    )
    each = sized.filter("target > 0").select(
        "rank", "block", "target", "n_seats", F.explode(F.sequence(F.lit(0).cast("long"), offered - 1)).alias("seat")
    )
    order = Window.orderBy(F.desc(F.col("target") / (2 * F.col("seat") + 1)), "rank", "seat")
    per_shard = F.greatest(F.lit(1), F.ceil(F.col("n_seats") / shards))
    return (
        each.withColumn("place", F.row_number().over(order) - 1)
        .filter("place < n_seats")
        .select("rank", "block", "seat", F.floor(F.col("place") / per_shard).alias("shard"))
    )


def _filled(goals: DataFrame, most_repeats: int) -> DataFrame:
    """rank, house, quota: how many of the first `words` blocks of the mix are each source's, for every house.

    `goals` has a row for each house (a number of blocks, `words`) and source, with the source's `target` for the whole
    mix and `share`, the part of it that falls to so many blocks. A source has round(share / d) seats for a common d
    near 1. Bounds of d, from roundings of half a word a source, say which seats are surely in and which surely out;
    only those between are listed and ranked. No source has more than its words `most_repeats` times.
    """
    everything = Window.partitionBy("house")
    cap = F.col("source_size") * most_repeats
    # With these, d down to 2/3 hands out more words without reaching a cap.
    roomy = F.sum(F.when(F.col("share") * 3 <= cap * 2, F.col("share"))).over(everything)
    slack = F.count("*").over(everything) + 1
    rounded = lambda x: F.floor(x + 0.5)
    bounds = goals.withColumns({"sum_roomy": roomy, "slack": slack}).filter("share > 0").withColumns({
        "sure": F.least(cap, rounded(F.col("share") * F.greatest(F.lit(0.0), 1 - F.col("slack") / (2 * F.col("words"))))),
        "most": F.least(cap, F.coalesce(rounded(F.col("share") * (1 + F.col("slack") / F.col("sum_roomy"))), cap)),
    })
    left = bounds.withColumn("left", F.col("words") - F.sum("sure").over(everything))
    seat = F.explode(F.sequence("sure", F.col("most") - 1)).alias("seat")
    order = Window.partitionBy("house").orderBy(F.desc(F.col("target") / (2 * F.col("seat") + 1)), "rank", "seat")
    between = left.filter("most > sure").select("rank", "house", "target", "left", seat).withColumn("place", F.row_number().over(order))
    more = between.filter("place <= left").groupBy("rank", "house").agg(F.count("*").alias("more"))
    return left.join(more, ["rank", "house"], "left").select("rank", "house", (F.col("sure") + F.coalesce("more", F.lit(0))).alias("quota"))


def word_quotas(goals: DataFrame, most_repeats: int = MOST_REPEATS) -> DataFrame:
    """rank, quota: how many words the mix takes of each source with a target above 0, of as many as there are."""
    words = F.sum("source_size").over(Window.partitionBy())
    whole = goals.withColumns({"words": words, "share": F.col("target"), "house": F.lit(0)})
    return _filled(whole, most_repeats).select("rank", "quota")


def shard_quotas(goals: DataFrame, shards: int = SHARDS, most_repeats: int = MOST_REPEATS) -> DataFrame:
    """rank, quota, ends: for each source the words it gives, and how many of them the shards up to each one take."""
    total = F.sum("source_size").over(Window.partitionBy())
    cut = goals.withColumn("total", total).withColumn("house", F.explode(F.sequence(F.lit(1), F.lit(shards))))
    cut = cut.withColumn("words", F.expr("total * house div " + str(shards))).filter("words > 0")
    houses = cut.withColumn("share", F.col("target") * F.col("words") / F.col("total"))
    held = _filled(houses, most_repeats).groupBy("rank").agg(F.sort_array(F.collect_list(F.struct("house", "quota"))).alias("held"))
    # Houses that were too small to give this source a seat, or empty, end at 0.
    ends = F.transform(
        F.sequence(F.lit(1), F.lit(shards)),
        lambda k: F.coalesce(F.get(F.filter("held", lambda x: x["house"] == k), F.lit(0))["quota"], F.lit(0)),
    )
    return held.select("rank", F.element_at("held", -1)["quota"].alias("quota"), ends.alias("ends"))


def quotas(docs: DataFrame, blocks: int = BLOCKS, shards: int = SHARDS) -> DataFrame:
    """source, shard, blocks: how many blocks each shard takes of each source."""
    goals = targets(source_sizes(measured(docs)))
    taken = seats(goals, blocks, shards).groupBy("rank", "shard").agg(F.count("*").alias("blocks"))
    return taken.join(goals.select("rank", "source"), "rank").select("source", "shard", "blocks")


def source_sizes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("source").agg(F.sum("size").alias("source_size"))


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, place, source, size, source_size, target, taken, shards, copies for each row of `docs`.

    `taken` is in words, `shards` lists the shards that take any of them, `copies` is in whole documents.

    A null text has no words, a null source is a source (last in order), rows may repeat and ids may be
    null or tied: each row is a document of its own. Documents without words are taken 0 times. An empty
    table gives an empty result. Columns other than doc_id, source and text are ignored.
    """
    rows = stored(measured(docs), "mixing")
    n_buckets = buckets_for(rows.count())
    goals = targets(source_sizes(rows))
    plan = goals.join(shard_quotas(goals), "rank", "left").select(
        F.struct(F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("name")).alias("key"),
        "source_size",
        "target",
        F.coalesce("quota", F.lit(0)).alias("quota"),
        "ends",
    )
    keyed = rows.withColumn(
        "key", F.struct(F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("name"))
    )
    bucket = F.pmod(F.shiftright("place", 20), F.lit(n_buckets))
    laid = running_total(keyed, ["key"], bucket, ["place", "doc_id", "size"], F.col("size"), "start")
    n_words = F.greatest(F.col("source_size"), F.lit(1))
    # So many of the first words are taken once more than the others.
    joined = laid.join(plan, "key").select(
        "*", F.floor(F.col("quota") / n_words).alias("times"), (F.col("quota") % n_words).alias("more")
    )
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("more") - F.col("start")))
    middle_in = F.col("start") + F.col("size") / 2 < F.col("more")
    copies = F.col("times") + middle_in.cast("int")
    shard_of = lambda word: F.size(F.filter("ends", lambda end: end <= word))

    def in_round(r):
        first = r * F.col("source_size") + F.col("start")
        last = first + F.when(r < F.col("times"), F.col("size")).otherwise(part) - 1
        return F.when(last >= first, F.sequence(shard_of(first), shard_of(last))).otherwise(F.array().cast("array<int>"))

    shards = F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(0).cast("long"), F.col("times")), in_round)))
    return joined.select(
        "doc_id",
        "place",
        "source",
        "size",
        F.col("source_size").cast("long").alias("source_size"),
        F.col("target").cast("double").alias("target"),
        (F.col("size") * F.col("times") + part).cast("long").alias("taken"),
        F.when((F.col("size") > 0) & F.col("ends").isNotNull(), shards).otherwise(F.array().cast("array<int>")).alias("shards"),
        F.when(F.col("size") > 0, copies).otherwise(F.lit(0)).cast("int").alias("copies"),
    )


def mixed_rows(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, each as often as the mix takes it as a whole.

    Documents without words are not in a mix of words. Rows that agree in id, text and source are one here, repeated
    as often as they are together.
    """
    times = F.sum("copies").cast("int")
    key = [id_text().alias("id"), F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("name")]
    names = ["id", "none", "name", "place"]
    taken = mix(docs).groupBy(*key, "place").agg(times.alias("times"))
    rows = docs.select(*key, place().alias("place"), F.struct("*").alias("row"))
    once = rows.dropDuplicates(names).join(taken.filter("times > 0"), names)
    return once.select("row", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")
