"""The star schema on disk.

    <root>/commits/                          which folders count (commits.py)
    <root>/versions/<v>/dim_employees/
    <root>/versions/<v>/events/part=<p>/table=<t>/event_date=<d>/    (or without the day level)
    <root>/versions/<v>/removed/part=<p>/    events of other parts that part p replaces
    <root>/versions/<v>/<side table>/<folder>/part=<p>/    what is kept of each part (sidetables.py)

Loads, streams and upserts all write parts: a part is one directory tree with all event tables, written by
one job. It becomes visible with its commit, written last, so readers never see half of one. A load starts a
new version; a stream or upsert adds a part to the newest. Of two writers at once one gets an error.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from usagelens.functions.joins import hint_if_small
from usagelens.schemas import (
    CONTRACT,
    FACT_TABLES,
    ORIGIN,
    QUARANTINE_TABLE,
    TYPED_EVENT,
    UNKNOWN_TABLE,
    MissingSourceError,
    Star,
)
from usagelens.sources.commits import Entry, Log, commit, read_log, remove_path
from usagelens.sources.sidetables import REMOVED, SideTable, events_folder, read_folders, side_rows, write_side

DAILY = ("table", "event_date")
# for volumes where a day would make a tiny file
BY_TABLE = ("table",)


_REJECTED = "cost_usd IS NULL OR duration_ms IS NULL OR input_tokens IS NULL OR output_tokens IS NULL"
#: What is counted of events while they are written, as `<table>.<detail>`: the checks of a load. Stages are fixed.
COUNTS = {
    **{f"{t}.total_rows": f"table = '{t}'" for t in (*FACT_TABLES, UNKNOWN_TABLE)},
    "fact_api_requests.rejected_rows": f"table = 'fact_api_requests' AND ({_REJECTED})",
    "fact_tool_usage.decision_rows": "table = 'fact_tool_usage' AND decision <> ''",
    "fact_tool_usage.result_rows": "table = 'fact_tool_usage' AND is_success IS NOT NULL",
    "fact_api_errors.null_status_rows": "table = 'fact_api_errors' AND status_code IS NULL",
    "fact_user_prompts.null_length_rows": "table = 'fact_user_prompts' AND prompt_length IS NULL",
    **{f"{QUARANTINE_TABLE}.{s}": f"table = '{QUARANTINE_TABLE}' AND stage = '{s}'" for s in ("batch", "message", "timestamp", "employee")},
}


def counters() -> list[Column]:
    return [F.count_if(F.expr(condition)).alias(name) for name, condition in COUNTS.items()]


def events_path(root: str, version: str) -> str:
    return f"{root}/versions/{version}/events"


def write_events(
    events: DataFrame, path: str, mode: str, partition_by: tuple[str, ...] = DAILY
) -> dict[str, int]:
    """Write typed events into one directory per table (and day); returns the COUNTS of them.

    The rebalance hint lets adaptive execution cut large partitions and join small ones, so a hot
    day or table is spread over tasks and files come out at a sensible size. The counts are observed in the tasks
    that write, after that shuffle: of a task that runs again only the run that finishes counts.

    Spark turns adaptive execution off in the session of a stream with state, where the hint would do nothing and
    each task would write a file into every directory; it is on for this write.
    """
    seen, conf, adaptive = Observation(), events.sparkSession.conf, "spark.sql.adaptive.enabled"
    before = conf.get(adaptive)
    conf.set(adaptive, "true")  # before the hint, which is dropped at once where it can do nothing
    try:
        balanced = events.hint("rebalance", *partition_by).observe(seen, *counters())
        balanced.write.mode(mode).partitionBy(*partition_by).parquet(path)
    finally:
        conf.set(adaptive, before)
    return {name: int(n or 0) for name, n in seen.get.items()}


def _part_path(root: str, version: str, part: str) -> str:
    return f"{root}/versions/{version}/{events_folder(part)}"


def _new_version(log: Log) -> str:
    """Writes are numbered, so a clock that runs behind can't hide one."""
    return f"{log.seq + 1:012d}-{uuid.uuid4().hex[:8]}"


def write_star(
    dim: DataFrame, events: DataFrame, root: str, partition_by: tuple[str, ...] = DAILY
) -> str:
    """Full rebuild from typed events; returns the new version."""
    spark = dim.sparkSession
    log = read_log(spark, root)
    version = _new_version(log)
    dim.write.mode("overwrite").parquet(f"{root}/versions/{version}/dim_employees")
    commit(spark, root, log, [write_part(events, root, version, "load", partition_by)])
    return version


def started(spark: SparkSession, root: str, partition_by: tuple[str, ...] = DAILY) -> Log:
    """The log of the star at `root`; a new one has a version without employees and events."""
    log = read_log(spark, root)
    if log.version is None:
        nobody = spark.createDataFrame([], CONTRACT["dim_employees"])
        write_star(nobody, spark.createDataFrame([], TYPED_EVENT), root, partition_by)
        log = read_log(spark, root)
    return log


def is_known(log: Log, part: str) -> bool:
    """Whether a part of that name was ever added, also if it was joined with others since."""
    return any(e.part == part for e in log.entries if e.table in ("events", "joined"))


def append_part(
    events: DataFrame,
    root: str,
    part: str | None = None,
    partition_by: tuple[str, ...] = DAILY,
    sides: tuple[SideTable, ...] = (),
) -> Log:
    """Add typed events to the newest version, or to a new one without employees; returns the log then.

    A part that is committed already is left as it is, so a batch retried under its name counts once. The
    rows of `sides` are made from what was written and count with the same commit.
    """
    spark = events.sparkSession
    log = started(spark, root, partition_by)
    part = part or uuid.uuid4().hex
    if is_known(log, part):
        return log
    made = [write_part(events, root, log.version, part, partition_by)]
    for side in sides:
        made.append(write_side(side_rows(spark, root, log, side, made[0], []), side, root, log.version, part))
    return commit(spark, root, log, made)


def write_part(
    events: DataFrame, root: str, version: str, part: str, partition_by: tuple[str, ...] = DAILY
) -> Entry:
    """Write a part's events; they count once the returned entry is committed."""
    counts = write_events(events, _part_path(root, version, part), "overwrite", partition_by)
    return Entry(version, "events", part, events_folder(part), json.dumps(counts))


def load_counts(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    """(table_name, detail, row_count) as counted while the parts were written; no event is read.

    What upserts replaced is taken off. Zero rows are listed.
    """
    log = read_log(spark, root)
    version = version or current_version(spark, root, log)
    total = dict.fromkeys(COUNTS, 0)
    for entry in (*log.of(version, "events"), *log.of(version, "removed")):
        for name, n in json.loads(entry.counts or "{}").items():
            total[name] += n
    rows = [(*name.split("."), n) for name, n in total.items()]
    return spark.createDataFrame(rows, "table_name string, detail string, row_count long")


def compact(spark: SparkSession, root: str, partition_by: tuple[str, ...] = DAILY) -> str:
    """Write the newest version's parts as one, without what was replaced, as a new version.

    A stream that commits meanwhile makes this fail with a `CommitConflictError`; nothing is lost then.
    """
    log = read_log(spark, root)
    version, old = _new_version(log), current_version(spark, root, log)
    dim = read_dim(spark, root, old)
    dim.write.mode("overwrite").parquet(f"{root}/versions/{version}/dim_employees")
    made = write_part(read_events(spark, root, old, log), root, version, "load", partition_by)
    # The names of the parts joined here stay known, so that none of them is written again.
    names = [Entry(version, "joined", p, "") for p in [*log.parts(old), *log.parts(old, "joined")]]
    commit(spark, root, log, [made, *names])
    return version


def remove_versions(spark: SparkSession, root: str, keep: int = 1) -> list[str]:
    """Drop all but the newest `keep` versions, folders included; returns the dropped ones."""
    log = read_log(spark, root)
    known = list(dict.fromkeys(e.version for e in log.entries if e.table == "events"))
    dropped = known[: max(0, len(known) - max(1, keep))]
    if dropped:
        commit(spark, root, log, [], tuple(dropped))
        for version in dropped:
            remove_path(spark, f"{root}/versions/{version}")
    return dropped


def current_version(spark: SparkSession, root: str, log: Log | None = None) -> str:
    newest = (log or read_log(spark, root)).version
    if newest is None:
        raise MissingSourceError(f"no finished load at {root}: run the load first")
    return newest


def read_events(
    spark: SparkSession, root: str, version: str | None = None, log: Log | None = None
) -> DataFrame:
    """All typed events; a filter on `table` or `event_date` reads only those directories.

    Only committed parts are read, by their paths. Their names pass through the driver, one for each write since
    the last load. Where upserts replaced events, these are left out.
    """
    log = log or read_log(spark, root)
    version = version or current_version(spark, root, log)
    events = read_folders(spark, root, log.of(version, "events"), TYPED_EVENT)
    if removals := log.of(version, "removed"):
        gone = hint_if_small(read_folders(spark, root, removals, REMOVED).select(
            F.col("event_id").alias("__id"), F.col("old_part").alias("__part")
        ))
        replaced = (F.col("event_id") == F.col("__id")) & (F.col("part") == F.col("__part")) & F.col("stage").isNull()
        events = events.join(gone, replaced, "left_anti")
    return events.drop("part")


def _of_table(events: DataFrame, name: str) -> DataFrame:
    columns = CONTRACT[name].fieldNames()
    extra = ["event_kind"] if name == "fact_tool_usage" else []
    return events.filter(F.col("table") == name).select(*columns, *extra)


def star_from_events(dim: DataFrame, events: DataFrame) -> Star:
    return Star(dim_employees=dim, **{name: _of_table(events, name) for name in FACT_TABLES})


def read_dim(spark: SparkSession, root: str, version: str) -> DataFrame:
    path = f"{root}/versions/{version}/dim_employees"
    return spark.read.schema(CONTRACT["dim_employees"]).parquet(path)


def read_star(spark: SparkSession, root: str, version: str | None = None) -> Star:
    log = read_log(spark, root)
    version = version or current_version(spark, root, log)
    return star_from_events(read_dim(spark, root, version), read_events(spark, root, version, log))


def read_quarantine(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    rejected = read_events(spark, root, version).filter(
        F.col("table") == QUARANTINE_TABLE
    )
    return rejected.select("stage", "reason", "raw", "event_id")


def read_rejected(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    """The quarantine with where each row came from: file, offset of the piece of it that was read, log stream."""
    rejected = read_events(spark, root, version).filter(F.col("table") == QUARANTINE_TABLE)
    return rejected.select("stage", "reason", "raw", "event_id", *ORIGIN, "log_stream")


def read_unknown(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    events = read_events(spark, root, version)
    return events.filter(F.col("table") == UNKNOWN_TABLE).select("body", "event_id", "epoch_ms")
