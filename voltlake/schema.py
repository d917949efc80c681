"""Column names and types of the readings table, its exports and the run log."""

from pyspark.sql import types as T

# Measures per battery in table order, and the number of batteries.
MEASURES = ("temp", "charge", "voltage")
N_BATTERIES = 6

# The declared types of the readings table and of the narrow export.
TABLE_NUMBER = T.DecimalType(6, 3)
NARROW_NUMBER = T.DecimalType(5, 3)
NARROW_CHARGE = T.LongType()


def table_columns(n_batteries: int = N_BATTERIES) -> list[str]:
    return ["time_stamp"] + [
        f"bat{b}_{m}" for b in range(1, n_batteries + 1) for m in MEASURES
    ]


def readings_schema(n_batteries: int = N_BATTERIES) -> T.StructType:
    time, *numbers = table_columns(n_batteries)
    fields = [T.StructField(time, T.TimestampType(), False)]
    return T.StructType(fields + [T.StructField(c, TABLE_NUMBER) for c in numbers])


def file_labels(layout: str, n_batteries: int = N_BATTERIES) -> list[str]:
    """Column labels of the exported files.

    ``bucket`` exports start with the bucket and keep ``time_stamp``; ``count``
    exports start with ``timestamp``; the ``sheet`` layout is the count layout
    with a leading space on each voltage label.
    """
    heads = {"bucket": ["bucket", "time_stamp"], "count": ["timestamp"], "sheet": ["timestamp"]}
    if layout not in heads:
        raise ValueError(f"unknown layout {layout!r}, expected one of {sorted(heads)}")
    space = {"voltage": " "} if layout == "sheet" else {}
    return heads[layout] + [
        f"{space.get(m, '')}bat {b} {m}" for b in range(1, n_batteries + 1) for m in MEASURES
    ]


def file_schema(
    layout: str, n_batteries: int = N_BATTERIES, narrow: bool = False
) -> T.StructType:
    """Types of the exported files.

    The default keeps the table's ``decimal(6,3)``. ``narrow=True`` asks for the
    tighter ``decimal(5,3)`` with whole-number charge. The ``sheet`` layout has
    floating-point temperature and voltage and whole-number charge.
    """

    def type_of(label: str) -> T.DataType:
        if not label.strip().startswith("bat "):
            return T.TimestampType()
        if layout == "sheet":
            return T.LongType() if label.endswith("charge") else T.DoubleType()
        if not narrow:
            return TABLE_NUMBER
        return NARROW_CHARGE if label.endswith("charge") else NARROW_NUMBER

    return T.StructType([T.StructField(c, type_of(c)) for c in file_labels(layout, n_batteries)])


RUN_TYPE_LENGTH = 8

RUN_LOG_SCHEMA = T.StructType(
    [
        T.StructField("last_runtime_stamp", T.TimestampType(), False),
        T.StructField("data_start_timestamp", T.TimestampType(), False),
        T.StructField("run_type", T.StringType(), False),
        T.StructField("n_rows", T.LongType()),
        T.StructField("n_files", T.LongType()),
        T.StructField("elapsed_ms", T.LongType()),
    ]
)
