"""Streaming form of the load, through the same parsing functions."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from usagelens.functions.casts import to_instant
from usagelens.operators import facts, parse
from usagelens.sources.logs import with_origin
from usagelens.sources.sidetables import SideTable
from usagelens.sources.star import DAILY, append_part


def stream_lines(
    spark: SparkSession, path: str, files_per_trigger: int | None = None, origin: bool = False
) -> DataFrame:
    """Log batch lines from files arriving in a folder; any source with a `value` column will do.

    With `origin` rejected rows keep the file they came from.
    """
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return with_origin(reader.load(path)) if origin else reader.load(path)


def stream_events(lines: DataFrame) -> DataFrame:
    return facts.typed_events(parse.parse_lines(lines))


def part_name(checkpoint: str, batch_id: int) -> str:
    """One name for a micro-batch, also when it is retried after a failure."""
    return f"{hashlib.sha256(checkpoint.encode()).hexdigest()[:16]}-{batch_id:010d}"


def stream_ingest(
    lines: DataFrame,
    root: str,
    checkpoint: str,
    partition_by: tuple[str, ...] = DAILY,
    sides: tuple[SideTable, ...] = (),
    lateness: str | None = None,
    **trigger,
) -> StreamingQuery:
    """Append typed events to the star at `root`, exactly once, a part for each micro-batch.

    With `lateness`, an event whose id came within that time before is left out (`without_repeats`), across
    micro-batches and restarts, with the ids of that time as state; without it none is. No event is dropped for
    being late. Each batch is balanced into files of a sensible size; many small batches are joined by
    `star.compact`. The rows of `sides` are kept up with every batch.
    """
    # Where repeats are dropped the events are parsed in the stream, before its state; the sink is the same.
    rows = lines if lateness is None else without_repeats(stream_events(lines), lateness)

    def apply(batch: DataFrame, batch_id: int) -> None:
        events = facts.typed_events(parse.parse_lines(batch)) if lateness is None else batch
        append_part(events, root, part_name(checkpoint, batch_id), partition_by, sides)

    return (
        rows.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def without_repeats(events: DataFrame, lateness: str) -> DataFrame:
    """A stream of typed events without those whose id came within `lateness` before, in bounded state.

    Events without an id or a time can't be told apart or bounded; they all pass. Good and rejected rows are
    told apart, so a rejected event does not keep its repaired form out.
    """
    timed = F.col("event_id").isNotNull() & to_instant(F.col("epoch_ms")).isNotNull()
    rest = events.filter(~timed)
    known = events.filter(timed).withColumns(
        {"event_ts": to_instant(F.col("epoch_ms")), "is_good": F.col("stage").isNull()}
    )
    once = known.withWatermark("event_ts", lateness).dropDuplicatesWithinWatermark(["event_id", "is_good"])
    return once.drop("event_ts", "is_good").unionByName(rest)
