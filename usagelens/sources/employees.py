"""The employee dimension as CSV.

A record is read by the strict rules: fields separated by commas, a field with commas, quotes or line breaks in
quotes, quotes in it doubled. Where a record does not follow them from its first line on, that line alone is set
aside, and reading goes on at the next one: an unclosed quote costs its line and not the rest of the file.
A file is read by one task, as its lines can't be told apart from line breaks in fields anywhere else.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.schemas import CONTRACT, MissingColumnsError, MissingSourceError

COLUMNS = CONTRACT["dim_employees"].fieldNames()
CSV = {"header": True, "escape": '"'}

STAGE = "employee"
QUOTES, TOO_FEW, TOO_MANY, NO_COLUMN = "broken quotes", "too few fields", "too many fields", "file lacks columns"

_END = r"\r\n|\r|\n|\z"
# Possessive throughout: the matcher walks along a field of any length without recursion.
_FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+"|[^",\r\n]*+)'
_RECORD = f"{_FIELD}(?:,{_FIELD})*+"
_RECORD_OR_LINE = rf"({_RECORD}(?={_END})|[^\r\n]*+)(?:{_END})"


def check_columns(df: DataFrame) -> DataFrame:
    missing = set(COLUMNS) - set(df.columns)
    if missing:
        raise MissingColumnsError(f"employee file lacks columns: {sorted(missing)}")
    return df


def _fields(record: Column) -> Column:
    """The values of a record; an unquoted empty field is NULL, a quoted one empty text."""
    raw = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(f",({_FIELD})"), F.lit(1))

    def value(x: Column) -> Column:
        inner = F.replace(F.substring(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))
        return F.when(x.startswith('"'), inner).when(x != "", x)

    return F.transform(raw, value)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the files: the employee columns, and file, record number, raw text and reason if it is bad.

    Each file's own header says where its columns are: their order does not matter and extras are ignored.
    """
    try:
        check_columns(spark.read.options(**CSV).csv(path))  # the first file's header
        files = spark.read.text(path, wholetext=True)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise MissingSourceError(f"employee file not found: {path}") from e
        raise
    text = F.regexp_replace("value", "^\ufeff", "")
    records = F.filter(F.regexp_extract_all(text, F.lit(_RECORD_OR_LINE), F.lit(1)), lambda x: x != "")
    split = files.select(F.col("_metadata.file_path").alias("file"), records.alias("records"))
    # The header is taken before the explode: after it, every record would carry all records of its file.
    headed = split.withColumn("header", _fields(F.get("records", F.lit(0))))
    headed = headed.select("file", "header", F.posexplode("records").alias("record", "raw"))
    rows = headed.filter("record > 0").withColumn("fields", _fields(F.col("raw")))
    n, wanted = F.size("fields"), F.size("header")
    lacking = ~F.forall(F.array(*map(F.lit, COLUMNS)), lambda c: F.array_contains("header", c))
    reason = (
        F.when(lacking, NO_COLUMN)
        .when(~F.col("raw").rlike(rf"\A(?:{_RECORD})\z"), QUOTES)
        .when(n < wanted, TOO_FEW)
        .when(n > wanted, TOO_MANY)
    )
    values = [F.get("fields", F.array_position("header", F.lit(c)).cast("int") - 1).alias(c) for c in COLUMNS]
    return rows.select(*values, "file", "record", "raw", reason.alias("reason"))


def read_employees(spark: SparkSession, path: str) -> DataFrame:
    """The good records, all columns as text."""
    return good(read_records(spark, path))


def good(records: DataFrame) -> DataFrame:
    return records.filter("reason IS NULL").select(*COLUMNS)


def rejected_employees(spark: SparkSession, path: str) -> DataFrame:
    """The bad records as the quarantine has them, with their file and their number in it (`source_offset`)."""
    return rejected(read_records(spark, path))


def rejected(records: DataFrame) -> DataFrame:
    bad = records.filter("reason IS NOT NULL")
    where = F.col("file").alias("source_file"), F.col("record").cast("long").alias("source_offset")
    return bad.select(F.lit(STAGE).alias("stage"), "reason", "raw", *where)


def with_header(lines: DataFrame, header: str) -> DataFrame:
    """Lines (`value`) as files with a header: it comes first in every partition, also in empty ones."""

    def run(batches):
        yield pa.RecordBatch.from_arrays([pa.array([header], pa.string())], names=["value"])
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string())], names=["value"])

    return lines.mapInArrow(run, "value string")


def to_csv_lines(rows: DataFrame, *columns: str) -> DataFrame:
    """Rows as records under a header: text is quoted, NULL is an empty field."""
    quoted = [
        F.coalesce(F.concat(F.lit('"'), F.replace(F.col(c).cast("string"), F.lit('"'), F.lit('""')), F.lit('"')), F.lit(""))
        for c in columns
    ]
    return with_header(rows.select(F.concat_ws(",", *quoted).alias("value")), ",".join(columns))


def write_employees(dim: DataFrame, path: str) -> None:
    """CSV files that `read_employees` reads back as they were, whatever the texts hold."""
    to_csv_lines(dim, *COLUMNS).write.mode("overwrite").text(path)
