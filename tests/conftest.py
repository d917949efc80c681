import os
import sys
from datetime import datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from voltlake.schema import readings_schema  # noqa: E402

os.environ["TZ"] = "UTC"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def chicago(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Chicago")
    yield spark
    spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.fixture
def folder(tmp_path):
    return lambda name: str(tmp_path / name)


def utc(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def reading(at: datetime, temp="20.000", charge="50.000", voltage="12.100"):
    numbers = [None if v is None else Decimal(v) for v in (temp, charge, voltage)]
    return (at, *numbers * 6)


def sensor_rows() -> list[tuple]:
    """Wide readings with ties, copies, nulls, large values and instants around clock changes."""
    start = utc("2023-04-26 21:43:34")
    rows = [
        reading(start + timedelta(seconds=3 * i), temp=f"{20 + (i * 7) % 11}.500")
        for i in range(40)
    ]
    rows += [rows[5]] * 3
    rows += [reading(rows[9][0], temp=f"{i}.250") for i in range(6)]
    rows += [reading(start, temp=None), reading(start, temp="999.999", charge="98.800")]
    rows += [reading(start, temp="99.999"), reading(start, temp="100.000")]
    rows += [reading(utc("1999-12-31 23:59:59.500000")), reading(utc("1969-12-31 23:59:58"))]
    rows += [reading(utc("2023-11-05 06:30:00")), reading(utc("2023-11-05 07:30:00"))]
    return rows


@pytest.fixture(scope="session")
def sensor_table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sensor") / "readings")
    frame = spark.createDataFrame(sensor_rows(), readings_schema())
    frame.repartition(3).write.parquet(path)
    return path
