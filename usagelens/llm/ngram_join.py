"""N-gram Jaccard join with Bayesian pruning of candidates.

Texts are sets of shingles of five words. Equal sets are joined first and go on as one text. MinHash values,
four to a band, put texts that may be alike into buckets. Within a bucket pairs are compared a few values at
a time; a pair is dropped once the posterior probability that its similarity reaches the threshold falls
below a tolerance. What survives ties texts into components, and within a component all pairs are compared
the same way and then verified exactly on their shingle sets.

No pairs leave a task: a bucket yields a forest of its surviving pairs, and a component, cut into tiles of
bounded size, yields each text's number of links and a forest of the verified ones. Classes are the
components of these.
"""

from __future__ import annotations

from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import grouped, id_text, lists, mixed, numbers, pieces, stored, with_columns
from usagelens.llm.decontaminate import split_words

WORDS = 5
THRESHOLD = 0.8
#: A pair is dropped when its chance of reaching the threshold is lower.
TOLERANCE = 1e-6
BANDS, BAND_VALUES = 24, 4
VALUES = BANDS * BAND_VALUES
#: Values compared before the posterior is looked at again.
STEP = 16
#: Larger buckets are not compared but tied together as they are; their component is compared in tiles.
BUCKET_TEXTS = 1024
#: Shingles of one chunk of a component; a tile holds two chunks.
CHUNK_SHINGLES = 1 << 19
KNOWN_WORDS = 1 << 17
# Ties that a task contracts at a time.
CONTRACT_TIES = 1 << 18
PLACES = mixed(np.arange(WORDS, dtype=np.uint64), 1) | np.uint64(1)
FACTORS = mixed(np.arange(VALUES, dtype=np.uint64), 2) | np.uint64(1)
OFFSETS = mixed(np.arange(VALUES, dtype=np.uint64), 3)


class Shingler:
    """Shingle sets as sorted 64-bit hashes; remembers the hashes of words."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def words(self, text: str | None) -> np.ndarray:
        known, out = self.known, []
        if len(known) > KNOWN_WORDS:
            known.clear()
        for w in split_words(text):
            h = known.get(w)
            if h is None:
                h = known[w] = xxhash.xxh3_64_intdigest(w)
            out.append(h)
        return np.array(out, dtype=np.uint64)

    @staticmethod
    def shingles(words: np.ndarray) -> np.ndarray:
        """A text of fewer words is one shingle, without words it has none."""
        n = len(words)
        if not n:
            return words
        width = min(WORDS, n)
        with np.errstate(over="ignore"):
            total = words[: n - width + 1] * PLACES[0]
            for k in range(1, width):
                total += words[k : n - width + 1 + k] * PLACES[k]
        return np.unique(mixed(total, width))


def sketch(shingles: np.ndarray) -> np.ndarray:
    """The low 16 bits of every MinHash value, four in a number."""
    low = np.full(VALUES, np.iinfo(np.uint64).max, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(shingles), 2048):
            part = shingles[None, at : at + 2048] * FACTORS[:, None]
            part += OFFSETS[:, None]
            np.minimum(low, part.min(axis=1), out=low)
    return mixed(low).astype(np.uint16).view(np.int64)


@cache
def least_matches(threshold: float, tolerance: float) -> tuple[int, ...]:
    """After n values, the matches below which a pair is dropped (n = 0 to VALUES).

    With a uniform prior the similarity is Beta(m + 1, n - m + 1) distributed after m matches, and the chance
    that it reaches t is that of at most m successes in n + 1 trials of probability t.
    """
    out = []
    for n in range(VALUES + 1):
        m, chance = -1, 0.0
        while chance < tolerance:
            m += 1
            chance += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return tuple(out)


def surviving(values: np.ndarray, x: int, others: np.ndarray, least: tuple[int, ...]) -> np.ndarray:
    """Of `others`, the rows that may still reach the threshold with row x, comparing STEP values at a time."""
    matches = np.zeros(len(others), dtype=np.int32)
    for at in range(0, VALUES, STEP):
        matches += (values[others, at : at + STEP] == values[x, at : at + STEP]).sum(axis=1, dtype=np.int32)
        alive = matches >= least[at + STEP]
        if not alive.all():
            others, matches = others[alive], matches[alive]
        if not len(others):
            break
    return others


SKETCHED = "doc_id long, text_hash long, ha long, hb long, n_shingles long, sketch array<long>"


def sketched(docs: DataFrame) -> DataFrame:
    """One row for each row of `docs`: its key, the hash of its shingle set, and its MinHash values."""

    def run(batches):
        shingler = Shingler()
        for batch in batches:
            for part in pieces(batch, "text"):
                high, low, counts, sketches = [], [], [], []
                for text in part.column("text").to_pylist():
                    shingles = shingler.shingles(shingler.words(text))
                    digest = xxhash.xxh3_128_digest(shingles.tobytes())
                    high.append(int.from_bytes(digest[:8], signed=True))
                    low.append(int.from_bytes(digest[8:], signed=True))
                    counts.append(len(shingles))
                    sketches.append(sketch(shingles) if len(shingles) else np.zeros(BANDS, dtype=np.int64))
                offsets = np.arange(0, (len(counts) + 1) * BANDS, BANDS, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("text_hash"),
                        pa.array(high, pa.int64()),
                        pa.array(low, pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sketches))),
                    ],
                    names=["doc_id", "text_hash", "ha", "hb", "n_shingles", "sketch"],
                )

    return keyed(docs).mapInArrow(run, SKETCHED)


def keyed(docs: DataFrame) -> DataFrame:
    rows = with_columns(docs, "doc_id", "text")
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")


def values_of(group: list[pa.RecordBatch]) -> np.ndarray:
    return np.stack(lists(group, "sketch")).view(np.uint16)


class Forest:
    """Which rows are tied, and the ties that were needed for it."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.edges: list[tuple[int, int]] = []

    def tie(self, x: int, others: np.ndarray) -> None:
        new, first = np.unique(self.label[others], return_index=True)
        use = new != self.label[x]
        if use.any():
            self.edges += [(x, int(y)) for y in others[first[use]]]
            self.label[np.isin(self.label, new[use])] = self.label[x]


def edge_batch(edges: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    columns = np.array(edges, dtype=np.int64).reshape(-1, 4).T
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["ha", "hb", "ga", "gb"])


def compare_buckets(batches, least: tuple[int, ...]):
    edges: list[tuple[int, int, int, int]] = []
    for group in grouped(batches, "bucket"):
        ha, hb, values = numbers(group, "ha"), numbers(group, "hb"), values_of(group)
        forest = Forest(len(ha))
        for x in range(len(ha) - 1):
            others = x + 1 + np.flatnonzero(forest.label[x + 1 :] != forest.label[x])
            if len(others) and len(found := surviving(values, x, others, least)):
                forest.tie(x, found)
        edges += [(ha[x], hb[x], ha[y], hb[y]) for x, y in forest.edges]
        if len(edges) > 10_000:
            yield edge_batch(edges)
            edges = []
    yield edge_batch(edges)


def candidate_edges(texts: DataFrame, least: tuple[int, ...]) -> DataFrame:
    """ha, hb, ga, gb: ties that hold all surviving pairs together, from one row a text (ha, hb, sketch)."""
    rows = texts.select("ha", "hb", F.posexplode("sketch").alias("band", "value")).select(
        "ha", "hb", F.xxhash64("band", "value").alias("bucket")
    )
    text = F.struct("ha", "hb")
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("n"), F.min(text).alias("low"), F.max(text).alias("high")).filter("n > 1")
    sizes = stored(sizes, "buckets")
    # Most buckets hold two texts, often the same two in many bands.
    two = sizes.filter("n = 2").select("low", "high").distinct()
    two = two.withColumn("bucket", F.xxhash64("low.ha", "low.hb", "high.ha", "high.hb"))
    two = two.select("bucket", F.explode(F.array("low", "high")).alias("text")).select("bucket", "text.ha", "text.hb")
    more = rows.join(sizes.filter("n > 2"), "bucket")
    some = more.filter(F.col("n") <= BUCKET_TEXTS).select("bucket", "ha", "hb")
    compared = (
        two.unionByName(some)
        .join(texts.select("ha", "hb", "sketch"), ["ha", "hb"])
        .repartition("bucket")
        # The forest of a bucket depends on its order; a task that runs again must give the same.
        .sortWithinPartitions("bucket", "ha", "hb")
        .mapInArrow(lambda b: compare_buckets(b, least), "ha long, hb long, ga long, gb long")
    )
    tied = more.filter((F.col("n") > BUCKET_TEXTS) & (text != F.col("low"))).select(
        "ha", "hb", F.col("low.ha").alias("ga"), F.col("low.hb").alias("gb")
    )
    return compared.unionByName(tied)


def least_reachable(x: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
    """For each of n numbered nodes the least one that the ties x - y connect it to."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def node_array(columns: list[pa.Array]) -> np.ndarray:
    """Nodes, integers or structs of integers, as an array that sorts as they do."""
    kind = columns[0].type
    if not pa.types.is_struct(kind):
        return np.concatenate([c.to_numpy() for c in columns])
    out = np.empty(sum(map(len, columns)), dtype=[(f.name, f.type.to_pandas_dtype()) for f in kind])
    for f in kind:
        out[f.name] = np.concatenate([c.field(f.name).to_numpy() for c in columns])
    return out


def node_column(nodes: np.ndarray) -> pa.Array:
    names = nodes.dtype.names
    return pa.StructArray.from_arrays([pa.array(nodes[x]) for x in names], names) if names else pa.array(nodes)


def contract(batches):
    """Ties (u, v) of one task, a block at a time, as ties to the least node of each of the block's components."""

    def stars(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        u, v = (node_array([b.column(side) for b in rows]) for side in ("u", "v"))
        # Sorted, so the least number is the least node.
        known, at = np.unique(np.concatenate([u, v]), return_inverse=True)
        root = least_reachable(at[: len(u)], at[len(u) :], len(known))
        tied = np.flatnonzero(root != np.arange(len(known)))
        return pa.RecordBatch.from_arrays([node_column(known[tied]), node_column(known[root[tied]])], names=["u", "v"])

    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= CONTRACT_TIES:
            yield stars(held)
            held, n = [], 0
    if n:
        yield stars(held)


def components(edges: DataFrame) -> DataFrame:
    """node, root for all nodes of `edges` (a, b), by alternating large and small stars.

    Every round ties each node's larger neighbours, then its smaller ones, to the least node it sees. Before
    each, a task contracts the ties it reads, which needs no shuffle and shortens paths; it reads them from a
    written table, so a task that runs again gives the same ties. It ends when each node has one tie to a
    smaller node, or only ties to larger ones. Each round is written to the shared folder.
    """
    links = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct()
    links = stored(links, "links")
    while True:
        links = stored(links.mapInArrow(contract, links.schema), "links")
        ends = links.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
            links.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
        )
        ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if ends.filter("up > 1 or up = 1 and down = 1").isEmpty():
            break
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = stored(small.unionByName(least.withColumnRenamed("m", "v")).distinct(), "links")
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def nodes(edges: DataFrame) -> DataFrame:
    return edges.select(F.struct("ha", "hb").alias("a"), F.struct(F.col("ga").alias("ha"), F.col("gb").alias("hb")).alias("b"))


VERIFIED = "ha long, hb long, ga long, gb long, links long"


def verify_tiles(batches, least: tuple[int, ...], threshold: float):
    """For each tile, every text's links (ga, gb null) and the ties of its forest (links null)."""
    for group in grouped(batches, "tile"):
        ha, hb = numbers(group, "ha"), numbers(group, "hb")
        # Rows that repeat in the documents bring the same text again.
        _, at = np.unique(np.stack([ha, hb]), axis=1, return_index=True)
        ha, hb, side = ha[at], hb[at], numbers(group, "side")[at]
        copies, values = numbers(group, "copies")[at], values_of(group)[at]
        every = lists(group, "shingles")
        sets = [every[i] for i in at]
        links, forest = linked(values, sets, side, copies, least, threshold)
        mine = np.flatnonzero(links)
        yield pa.RecordBatch.from_pydict(
            {
                "ha": np.concatenate([ha[mine], [ha[x] for x, _ in forest.edges]]).astype(np.int64),
                "hb": np.concatenate([hb[mine], [hb[x] for x, _ in forest.edges]]).astype(np.int64),
                "ga": pa.array([None] * len(mine) + [int(ha[y]) for _, y in forest.edges], pa.int64()),
                "gb": pa.array([None] * len(mine) + [int(hb[y]) for _, y in forest.edges], pa.int64()),
                "links": pa.array(links[mine].tolist() + [None] * len(forest.edges), pa.int64()),
            }
        )


def linked(values, sets, side, copies, least, threshold: float) -> tuple[np.ndarray, Forest]:
    """Links of each row, counted in documents: side 0 meets itself, side -1 meets side 1."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    cuts = np.concatenate([[0], np.cumsum(sizes)])
    vocabulary, flat = np.unique(np.concatenate(sets), return_inverse=True)
    held = np.zeros(len(vocabulary), dtype=bool)
    links, forest = np.zeros(n, dtype=np.int64), Forest(n)
    right = np.flatnonzero(side == 1)
    for x in np.flatnonzero(side <= 0):
        others = right if side[x] else np.arange(x + 1, n)
        if not len(others):
            continue
        others = surviving(values, x, others, least)
        if not len(others):
            continue
        held[flat[cuts[x] : cuts[x + 1]]] = True
        theirs = np.concatenate([flat[cuts[y] : cuts[y + 1]] for y in others])
        starts = np.concatenate([[0], np.cumsum(sizes[others])[:-1]])
        common = np.add.reduceat(held[theirs], starts, dtype=np.int64)
        held[flat[cuts[x] : cuts[x + 1]]] = False
        near = others[common >= threshold * (sizes[x] + sizes[others] - common) - 1e-9]
        if len(near):
            links[x] += copies[near].sum()
            links[near] += copies[x]
            forest.tie(int(x), near)
    return links, forest


def verified(docs: DataFrame, texts: DataFrame, tied: DataFrame, least: tuple[int, ...], threshold: float) -> DataFrame:
    """Links and ties of all texts in a component (node, root), verified on their shingles."""
    node = F.struct("ha", "hb")
    placed = texts.withColumn("node", node).join(tied, "node")
    sizes = placed.groupBy("root").agg(F.ceil(F.sum("n_shingles") / CHUNK_SHINGLES).alias("n_chunks"))
    wanted = placed.join(sizes, "root").select(
        id_text("key.doc_id").alias("id"),
        F.col("key.text_hash").alias("text_hash"),
        "ha",
        "hb",
        "root",
        "copies",
        "n_chunks",
        F.pmod(F.xxhash64("ha", "hb"), F.col("n_chunks")).alias("chunk"),
    )
    rows = keyed(docs).withColumn("id", id_text()).join(wanted, ["id", "text_hash"]).select("ha", "hb", "copies", "root", "n_chunks", "chunk", "text")
    schema = "ha long, hb long, copies long, root struct<ha:long,hb:long>, n_chunks long, chunk long, sketch array<long>, shingles array<long>"

    def shingled(batches):
        shingler = Shingler()
        for batch in batches:
            for part in pieces(batch, "text"):
                sets = [shingler.shingles(shingler.words(t)) for t in part.column("text").to_pylist()]
                ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                offsets = np.arange(0, (len(sets) + 1) * BANDS, BANDS, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns[:-1],
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([sketch(s) for s in sets]))),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets).view(np.int64))),
                    ],
                    names=[*batch.schema.names[:-1], "sketch", "shingles"],
                )

    # Each chunk meets itself and every other one.
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_chunks") - 1)).alias("other")
    low, high = F.least("chunk", "other"), F.greatest("chunk", "other")
    tiles = (
        rows.mapInArrow(shingled, schema)
        .select("*", other)
        .select(
            F.xxhash64("root.ha", "root.hb", low, high).alias("tile"),
            F.signum(F.col("chunk") - F.col("other")).cast("long").alias("side"),
            "ha",
            "hb",
            "copies",
            "sketch",
            "shingles",
        )
    )
    ordered = tiles.repartition("tile").sortWithinPartitions("tile")
    return ordered.mapInArrow(lambda b: verify_tiles(b, least, threshold), VERIFIED)


def near_copies(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """doc_id, text_hash, class_id, n_links, class_size, kept for each row of `docs`.

    n_links counts the other rows whose shingle sets have a Jaccard similarity of `threshold` or more; classes
    are the components of these links, named by their least doc_id. `kept` holds for the least (doc_id,
    text_hash) of a class, and so for several rows only where rows repeat. Texts without words have no
    shingles: each is a class of its own, without links. Extra columns are ignored.
    """
    least = least_matches(threshold, tolerance)
    rows = stored(sketched(docs), "sketches")
    key = F.struct("doc_id", "text_hash")
    texts = rows.filter("n_shingles > 0").groupBy("ha", "hb").agg(
        F.count("*").alias("copies"),
        F.min(key).alias("key"),
        F.min("doc_id").alias("doc_id"),
        F.max("n_shingles").alias("n_shingles"),
        F.first("sketch").alias("sketch"),
    )
    texts = stored(texts, "texts")
    tied = stored(components(nodes(candidate_edges(texts, least))), "tied")
    found = stored(verified(docs, texts, tied, least, threshold), "verified")
    links = found.filter("links is not null").groupBy("ha", "hb").agg(F.sum("links").alias("links"))
    roots = components(nodes(found.filter("links is null"))).select("node.ha", "node.hb", "root")
    named = texts.drop("sketch").join(roots, ["ha", "hb"], "left").join(links, ["ha", "hb"], "left")
    named = named.withColumn("root", F.coalesce("root", F.struct("ha", "hb")))
    classes = named.groupBy("root").agg(
        F.min("doc_id").alias("class_id"), F.min("key").alias("first"), F.sum("copies").alias("class_size")
    )
    of_text = named.join(classes, "root").select("ha", "hb", "copies", "links", "class_id", "first", "class_size")
    some = rows.filter("n_shingles > 0").select("doc_id", "text_hash", "ha", "hb").join(of_text, ["ha", "hb"])
    some = some.select(
        "doc_id",
        "text_hash",
        "class_id",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        "class_size",
        key.eqNullSafe(F.col("first")).alias("kept"),
    )
    none = rows.filter("n_shingles = 0").select(
        "doc_id",
        "text_hash",
        F.col("doc_id").alias("class_id"),
        F.lit(0).cast("long").alias("n_links"),
        F.lit(1).cast("long").alias("class_size"),
        F.lit(True).alias("kept"),
    )
    return some.unionByName(none)


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs`, all columns, that stay when one document of each class stays.

    Of rows that agree in doc_id and text one stays, except that texts without words all stay.
    """
    kept = near_copies(docs, threshold).filter("kept").groupBy(id_text().alias("id"), "text_hash")
    kept = kept.agg(F.max(F.col("n_links") + F.col("class_size") == 1).alias("alone"))
    rows = docs.select(id_text().alias("id"), F.xxhash64("text").alias("text_hash"), F.struct("*").alias("row"))
    joined = rows.join(kept, ["id", "text_hash"])
    # A class of one row has nothing to lose, however often its key occurs.
    salt = F.when(F.col("alone"), F.monotonically_increasing_id())
    return joined.withColumn("salt", salt).dropDuplicates(["id", "text_hash", "salt"]).select("row.*")
