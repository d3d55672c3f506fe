"""Adding a delta to the star without loading any event twice."""

from __future__ import annotations

import json
import uuid
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from usagelens.functions.joins import BROADCAST_ROWS, hint_if_small
from usagelens.operators import facts, parse
from usagelens.schemas import TYPED_EVENT
from usagelens.session import scratch_path
from usagelens.sources import idindex
from usagelens.sources.commits import Entry, Log, commit, remove_path
from usagelens.sources.idindex import is_bad
from usagelens.sources.sidetables import REMOVED, SideTable, brought_up, read_folders, replaced_events, side_rows, write_side
from usagelens.sources.star import DAILY, counters, is_known, started, write_part
from usagelens.streaming.ingest import part_name


def one_per_id(events: DataFrame) -> DataFrame:
    """One row for each event id, a good one before a rejected one; events without an id are all kept.

    Which of several good rows stays depends on their values only. The least row is found by an aggregate
    that combines before the shuffle, so an id that repeats a million times is one row a task.
    """
    columns = TYPED_EVENT.fieldNames()
    row = F.struct(is_bad().alias("bad"), F.col("epoch_ms").alias("ms"), F.struct(*columns).alias("row"))
    with_id = events.filter("event_id IS NOT NULL").groupBy("event_id").agg(F.min(row).alias("least"))
    once = with_id.select("least.row.*")
    return once.unionByName(events.filter("event_id IS NULL").select(*columns))


def staged_once(delta: DataFrame, staged: str) -> tuple[DataFrame, DataFrame]:
    """`one_per_id` of `delta` and its ids (event_id, n), from tables below `staged`; `delta` is computed once.

    Ids are counted apart from their rows, so that the rows of ids that come once, most of them as a rule, are
    neither sorted nor shuffled.
    """
    spark = delta.sparkSession
    delta.select(*TYPED_EVENT.fieldNames()).write.parquet(f"{staged}/rows")
    rows = spark.read.schema(TYPED_EVENT).parquet(f"{staged}/rows")
    counted = rows.filter("event_id IS NOT NULL").groupBy("event_id").agg(F.count(F.lit(1)).alias("n"))
    counted.write.parquet(f"{staged}/ids")
    ids = spark.read.parquet(f"{staged}/ids")
    repeated = ids.filter("n > 1").select(F.col("event_id").alias("__id"))
    found = repeated.limit(BROADCAST_ROWS + 1).count()
    if not found:
        return rows, ids
    if found <= BROADCAST_ROWS:
        same, repeated = F.col("event_id") == F.col("__id"), F.broadcast(repeated)
        many = one_per_id(rows.join(repeated, same, "left_semi"))
        once = rows.join(repeated, same, "left_anti").unionByName(many)
    else:
        once = one_per_id(rows)
    once.write.parquet(f"{staged}/once")
    return spark.read.schema(TYPED_EVENT).parquet(f"{staged}/once"), ids


def loaded_before(delta: DataFrame, root: str, log: Log, ids: DataFrame) -> DataFrame:
    """(event_id, any_good, same_time, good_parts) for the ids of `delta` that are loaded; replaced events do not count."""
    spark = delta.sparkSession
    found = idindex.looked_up(spark, root, log, ids)
    if removals := log.of(log.version, "removed"):
        gone = read_folders(spark, root, removals, REMOVED).select("event_id", F.col("old_part").alias("part"), F.lit(True).alias("is_good"))
        found = found.join(hint_if_small(gone), ["event_id", "part", "is_good"], "left_anti")
    times = delta.select(F.col("event_id").alias("__id"), F.col("epoch_ms").alias("__ms"))
    same = F.col("is_good") & F.col("epoch_ms").eqNullSafe(F.col("__ms"))
    return (
        found.join(times, F.col("event_id") == F.col("__id"))
        .groupBy("event_id")
        .agg(
            F.bool_or("is_good").alias("any_good"),
            F.bool_or(same).alias("same_time"),
            F.collect_set(F.when(F.col("is_good"), F.col("part"))).alias("good_parts"),
        )
    )


def incremental_upsert(
    delta: DataFrame,
    root: str,
    partition_by: tuple[str, ...] = DAILY,
    part: str | None = None,
    sides: tuple[SideTable, ...] = (),
) -> None:
    """Add the unseen events of `delta` (typed events) to the star at `root`, all of them or none.

    An id is looked up in the id index, whatever its day. A good event of a loaded id and time is a repeat and is
    left out; with another time it replaces the loaded one: the delivery that comes last counts. A rejected row
    keeps out its repetition, not its repair. Running this again with the same delta adds nothing but rejected
    events that carry no id. `sides` get the rows of what is added, less those of what is replaced.
    """
    spark = delta.sparkSession
    log = started(spark, root, partition_by)
    part = part or uuid.uuid4().hex
    if is_known(log, part):
        return
    log = idindex.brought_up(spark, root, log)
    log = brought_up(spark, root, *sides, log=log)
    staged, version = scratch_path(spark, "delta"), log.version
    try:
        once, ids = staged_once(delta, staged)
        loaded_before(once, root, log, ids).write.parquet(f"{staged}/known")
        known = spark.read.parquet(f"{staged}/known").withColumnRenamed("event_id", "__id")
        judged = once.join(known, F.col("event_id") == F.col("__id"), "left")
        is_new = F.col("__id").isNull() | ~is_bad() & ~F.col("same_time")
        fresh = judged.filter(is_new).select(*TYPED_EVENT.fieldNames())
        made = [write_part(fresh, root, version, part, partition_by)]
        written = read_folders(spark, root, made, TYPED_EVENT)
        made.append(idindex.write_ids(written, root, version, part))

        # One row for each replaced event.
        replaced = judged.filter(~is_bad() & F.col("any_good") & ~F.col("same_time"))
        removed = replaced.select("event_id", F.explode("good_parts").alias("old_part"))
        removal = Entry(version, "removed", part, f"removed/part={part}")
        removed.write.mode("overwrite").parquet(f"{root}/versions/{version}/{removal.folder}")
        removals = [] if read_folders(spark, root, [removal], REMOVED).isEmpty() else [removal]
        if (old := replaced_events(spark, root, log, version, removals)) is not None:
            counted = old.agg(*counters()).first().asDict()
            removals = [replace(removal, counts=json.dumps({name: -n for name, n in counted.items()}))]
        for side in sides:
            made.append(write_side(side_rows(spark, root, log, side, made[0], removals), side, root, version, part))
        commit(spark, root, log, [*made, *removals])
    finally:
        remove_path(spark, staged)


def stream_upsert(
    lines: DataFrame,
    root: str,
    checkpoint: str,
    partition_by: tuple[str, ...] = DAILY,
    sides: tuple[SideTable, ...] = (),
    **trigger,
) -> StreamingQuery:
    """Micro-batch upsert, exact however late a repeat arrives; a batch retried after a failure counts once."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        events = facts.typed_events(parse.parse_lines(batch))
        incremental_upsert(events, root, partition_by, part_name(checkpoint, batch_id), sides)

    return (
        lines.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
