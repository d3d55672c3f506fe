"""Log batches as JSON lines: one object per line, each wrapping a few events."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.functions.casts import to_timestamp
from usagelens.schemas import ORIGIN, MissingSourceError

ENVELOPE = {
    "messageType": "DATA_MESSAGE",
    "owner": "000000000000",
    "logGroup": "/telemetry",
    "logStream": "collector",
}
SUBSCRIPTION_FILTERS = ["all-events"]

MAX_BATCH = 10


def clean_lines(lines: DataFrame) -> DataFrame:
    """Leave out blank lines; works on batch and streaming input.

    The full test only runs on lines that start with white space. Surrounding white space needs no
    stripping: it means nothing in JSON.
    """
    blank = r"value = '' OR (left(value, 1) RLIKE '\\s' AND value RLIKE '^\\s*$')"
    return lines.select("value", *[c for c in ORIGIN if c in lines.columns]).filter(f"NOT ({blank})")


def with_origin(lines: DataFrame) -> DataFrame:
    """Lines of a file source with where each was read; rejected rows keep it."""
    file, offset = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    return lines.select("value", file.alias(ORIGIN[0]), offset.alias(ORIGIN[1]))


def read_log_batches(spark: SparkSession, path: str) -> DataFrame:
    try:
        return clean_lines(with_origin(spark.read.text(path)))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise MissingSourceError(f"log batches not found: {path}") from e
        raise


def to_log_batches(events: DataFrame) -> DataFrame:
    """(id, timestamp, message) rows as JSON batch lines, neighbours together, without a shuffle.

    Built-in grouping would have to move every message to form groups of ten; cutting each Arrow
    batch where it lies does not. The envelope's date is that of the first event.
    """

    # defined here so that it travels to the executors by value, without this package
    def cut(record_batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in record_batches:
            if rb.num_rows:
                rows = pa.StructArray.from_arrays(rb.columns, names=rb.schema.names)
                offsets = pa.array([*range(0, rb.num_rows, MAX_BATCH), rb.num_rows], pa.int32())
                lists = pa.ListArray.from_arrays(offsets, rows)
                yield pa.RecordBatch.from_arrays([lists], names=["logEvents"])

    batches = events.select("id", "timestamp", "message").mapInArrow(
        cut, "logEvents ARRAY<STRUCT<id: STRING, timestamp: BIGINT, message: STRING>>"
    )
    first = to_timestamp(F.col("logEvents")[0]["timestamp"])
    envelope = [F.lit(v).alias(k) for k, v in ENVELOPE.items()]
    filters = F.array(*[F.lit(f) for f in SUBSCRIPTION_FILTERS]).alias("subscriptionFilters")
    day = [F.year(first).alias("year"), F.month(first).alias("month"), F.day(first).alias("day")]
    line = F.struct(*envelope, filters, F.col("logEvents"), *day)
    return batches.select(F.to_json(line).alias("value"))


def write_log_batches(events: DataFrame, path: str) -> None:
    to_log_batches(events).write.mode("overwrite").text(path)
