"""Tables kept beside the events of a star, part by part, so that old parts need not be read again.

A side table holds, for each part, what one question needs of that part's events. Its rows add up over parts; rows
with negative counts take away what an upsert replaced. Streams and upserts write the side rows of a part together
with it, in one commit; `brought_up` makes them for the parts that have none, such as those of a plain load.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens.functions.casts import TwoLevelTotal
from usagelens.functions.joins import hint_if_small
from usagelens.functions.moments import MOMENTS, moments
from usagelens.schemas import TYPED_EVENT, struct
from usagelens.sources.commits import Entry, Log, commit, read_log

#: Good events of an id that a later part replaces, by the part they are in.
REMOVED = struct(event_id="string", old_part="string")
#: `build(events, sign)`: the rows for some events, to be added (1) or taken away (-1).
Build = Callable[[DataFrame, int], DataFrame]


@dataclass(frozen=True)
class SideTable:
    name: str
    schema: T.StructType
    build: Build


def _cost_moments(events: DataFrame, sign: int) -> DataFrame:
    return moments(events.filter("table = 'fact_api_requests'"), F.col("cost_usd"), sign)


COST_MOMENTS = SideTable("cost_moments", MOMENTS, _cost_moments)

_COST = TwoLevelTotal("cost_usd")
_WHOLE = T.DecimalType(38, 0)


def _rolled_up(table: str, keys: list[str], sums: dict[str, Column]) -> Build:
    """Rows of one fact by `keys` and day, with their number and some sums. Combines before the shuffle."""

    def build(events: DataFrame, sign: int) -> DataFrame:
        rows = events.filter(F.col("table") == table)
        aggregates = {"n": F.count(F.lit(1)), **sums}
        return rows.groupBy("event_date", *keys).agg(*[(c if sign > 0 else -c).alias(name) for name, c in aggregates.items()])

    return build


def request_sums() -> dict[str, Column]:
    """What request reports add up; a sum over no value is NULL, so each has its number of values beside it."""
    tokens = F.col("input_tokens") + F.col("output_tokens")
    side = F.col("input_tokens") + F.col("cache_read_tokens") + F.col("cache_creation_tokens")
    counted = {"tokens": tokens, "cache_read": F.col("cache_read_tokens"), "prompt_side": side, "ms": F.col("duration_ms")}
    out = dict(zip(_COST.names(), _COST.parts())) | {"cost_n": F.count("cost_usd")}
    for name, value in counted.items():
        out |= {name: F.sum(value.cast(_WHOLE)).cast(_WHOLE), f"{name}_n": F.count(value)}
    return out


_SUMS = {"tokens": _WHOLE, "cache_read": _WHOLE, "prompt_side": _WHOLE, "ms": _WHOLE}
REQUEST_ROLLUP = SideTable(
    "request_rollup",
    struct(
        event_date="date",
        user_email="string",
        model="string",
        n="bigint",
        **dict(zip(_COST.names(), [T.DecimalType(38, 12), T.DoubleType()])),
        cost_n="bigint",
        **{k: v for name, kind in _SUMS.items() for k, v in ((name, kind), (f"{name}_n", "bigint"))},
    ),
    lambda events, sign: _rolled_up("fact_api_requests", ["user_email", "model"], request_sums())(events, sign),
)
TOOL_ROLLUP = SideTable(
    "tool_rollup",
    struct(event_date="date", user_email="string", tool_name="string", decision="string", event_kind="string", n="bigint"),
    _rolled_up("fact_tool_usage", ["user_email", "tool_name", "decision", "event_kind"], {}),
)
ERROR_ROLLUP = SideTable(
    "error_rollup",
    struct(event_date="date", user_email="string", model="string", status_code="int", error_message="string", n="bigint"),
    _rolled_up("fact_api_errors", ["user_email", "model", "status_code", "error_message"], {}),
)
ROLLUPS = (REQUEST_ROLLUP, TOOL_ROLLUP, ERROR_ROLLUP)


def events_folder(part: str) -> str:
    return f"events/part={part}"


def _with_part(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("part", T.StringType())])


def read_folders(spark: SparkSession, root: str, entries: list[Entry], schema: T.StructType) -> DataFrame:
    """The rows of the folders of some entries, with the part they belong to."""
    full = _with_part(schema)
    if not entries:
        return spark.createDataFrame([], full)
    out = None
    by_base: dict[str, dict[str, None]] = {}
    for e in entries:
        base, _, leaf = e.folder.rpartition("/")
        by_base.setdefault(f"{root}/versions/{e.version}/{base}", {})[leaf] = None
    for base, leaves in by_base.items():
        rows = spark.read.schema(full).option("basePath", base).parquet(*(f"{base}/{leaf}" for leaf in leaves))
        out = rows if out is None else out.unionByName(rows)
    return out


def replaced_events(spark: SparkSession, root: str, log: Log, version: str, removals: list[Entry]) -> DataFrame | None:
    """The good events that some `removed` folders name, from the parts they are in; None if there are none."""
    if not removals:
        return None
    gone = read_folders(spark, root, removals, REMOVED).select(F.col("event_id").alias("__id"), F.col("old_part").alias("__part"))
    parts = {r[0] for r in gone.select("__part").distinct().collect()}  # names of parts
    old = read_folders(spark, root, [e for e in log.of(version, "events") if e.part in parts], TYPED_EVENT)
    same = (F.col("event_id") == F.col("__id")) & (F.col("part") == F.col("__part"))
    return old.filter("stage IS NULL").join(hint_if_small(gone), same, "left_semi").drop("part")


def side_rows(spark: SparkSession, root: str, log: Log, side: SideTable, events: Entry, removals: list[Entry]) -> DataFrame:
    """The side rows of one part: of its events, less those of the events in other parts that it replaces."""
    rows = side.build(read_folders(spark, root, [events], TYPED_EVENT), 1)
    replaced = replaced_events(spark, root, log, events.version, removals)
    return rows if replaced is None else rows.unionByName(side.build(replaced, -1))


#: Folder of the side rows that are written together with their part.
WITH_PART = "parts"


def write_side(rows: DataFrame, side: SideTable, root: str, version: str, part: str, within: str = WITH_PART) -> Entry:
    """Write the side rows of one part; they count once the returned entry is committed.

    The folders of many parts lie in one, so that they are read as one table. What a writer that failed left under
    the name of this part is overwritten.
    """
    folder = f"{side.name}/{within}/part={part}"
    typed = rows.select(*[F.col(f.name).cast(f.dataType) for f in side.schema.fields])
    typed.write.mode("overwrite").parquet(f"{root}/versions/{version}/{folder}")
    return Entry(version, side.name, part, folder)


def read_side(spark: SparkSession, root: str, log: Log, side: SideTable, version: str | None = None) -> DataFrame:
    """All side rows that count in `log`."""
    return read_folders(spark, root, log.of(version or log.version, side.name), side.schema)


def brought_up(spark: SparkSession, root: str, *sides: SideTable, log: Log | None = None) -> Log:
    """Make the side rows of all parts that lack them; returns the log that has them.

    Each part's events are read once for each table, in one job over the columns it needs.
    """
    log = log or read_log(spark, root)
    version, within = log.version, uuid.uuid4().hex  # two that do this at once do not write into each other's
    made = []
    for side in sides:
        have = set(log.parts(version, side.name))
        for entry in log.of(version, "events"):
            if entry.part not in have:
                removals = [e for e in log.of(version, "removed") if e.part == entry.part]
                rows = side_rows(spark, root, log, side, entry, removals)
                made.append(write_side(rows, side, root, version, entry.part, within))
    return commit(spark, root, log, made) if made else log
