"""CSV landing files."""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions import c, not_null
from ..workspace import Workspace
from .csv_records import csv_records

# Timestamps keep their microseconds, instants also their offset.
INSTANT_PATTERN = "yyyy-MM-dd HH:mm:ss.SSSSSSXXX"
ZONELESS_PATTERN = "yyyy-MM-dd HH:mm:ss.SSSSSS"

# Stands for an unquoted empty field inside the reader, which else cannot tell it from "".
_NULL = "\x01"


def load_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    required: tuple[str, ...] = ("time_stamp",),
    zone: str | None = None,
    multi_line: bool = False,
    workspace: Workspace | None = None,
) -> DataFrame:
    """Read comma-separated files with one header line; the columns bind by position.

    A malformed field, a short row, a number too large for its type or a null in
    a required column fails the job, whichever columns it reads. Timestamps without
    an offset are read in ``zone``, by default the session zone. Quotes inside a
    quoted field are doubled; an unquoted empty field is null, a quoted one an empty
    text. ``multi_line`` allows line breaks in quoted fields: the lines are stored first, and records
    put together from what each task reads, so a large file is still read by many tasks.
    """
    options = {"mode": "FAILFAST", "escape": '"', "nullValue": _NULL}
    if zone:
        options["timeZone"] = zone
    if multi_line:
        fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)
        records = csv_records(spark, path, workspace or Workspace(spark))
        parsed = F.from_csv("record", fields, options | {"multiLine": "true"}).alias("row")
        df = records.select(parsed).select("row.*")
    else:
        df = spark.read.schema(schema).options(header=True, **options).csv(path)
    checked = [not_null(n) if n in required else c(n) for n in df.columns]
    # Always true, but of all columns: a projection would else skip the checks of the rest.
    whole = F.hash(*checked) >= F.lit(-(2**31))
    return df.filter(whole).select(*checked)


def export_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write comma-separated files with a header line and no index column.

    Blanks at the ends of a text and of a label stay, quotes are doubled, an empty text is
    quoted and a null is not, as ``load_csv`` and other readers expect.
    """
    (
        df.write.mode(mode)
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("escape", '"')
        .option("timestampFormat", INSTANT_PATTERN)
        .option("timestampNTZFormat", ZONELESS_PATTERN)
        .csv(path)
    )
