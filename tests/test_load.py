import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F, types as T

from conftest import sensor_rows
from voltlake import (
    append_readings,
    as_of,
    export_csv,
    load_csv,
    load_job,
    order_readings,
    readings,
    row_count,
)
from voltlake.schema import readings_schema

SCHEMA = readings_schema(1)
HEADER = "time_stamp,bat1_temp,bat1_charge,bat1_voltage"
GOOD = "2023-04-26 21:43:34-05:00,98.800,50.000,12.100"


@pytest.fixture
def landing(folder):
    def write(*lines, header=HEADER):
        os.makedirs(folder("csv"), exist_ok=True)
        with open(os.path.join(folder("csv"), "part.csv"), "w") as file:
            file.write("\n".join([header, *lines]) + "\n")
        return folder("csv")

    return write


def rows_of(spark, path, **options):
    return load_csv(spark, path, SCHEMA, **options).select(
        F.unix_micros("time_stamp").alias("us"), *[F.col(c).cast("string") for c in SCHEMA.names[1:]]
    ).collect()


def test_values_and_instants(spark, landing):
    path = landing(GOOD, "2023-04-26 21:43:34.123456-05,,1.2345,")
    first, second = rows_of(spark, path)
    assert tuple(first) == (1682563414_000000, "98.800", "50.000", "12.100")
    # Empty fields are null; surplus decimals are rounded half up.
    assert tuple(second) == (1682563414_123456, None, "1.235", None)


def test_columns_bind_by_position(spark, landing):
    path = landing(GOOD, header="a,b,c,d")
    assert rows_of(spark, path)[0].bat1_temp == "98.800"


def test_zone_of_times_without_offset(spark, landing):
    path = landing("2023-04-26 21:43:34,1,2,3")
    assert rows_of(spark, path)[0].us == 1682545414_000000
    assert rows_of(spark, path, zone="America/Chicago")[0].us == 1682563414_000000


@pytest.mark.parametrize(
    "line",
    [
        "2023-04-26 21:43:34-05:00,warm,50.000,12.100",
        "2023-04-26 21:43:34-05:00,98.800,50.000",
        "2023-04-26 21:43:34-05:00,1000.000,50.000,12.100",
        "yesterday,98.800,50.000,12.100",
        ",98.800,50.000,12.100",
    ],
    ids=["bad number", "short row", "overflow", "bad time", "null time"],
)
def test_a_bad_row_stops_the_load_and_leaves_the_table(spark, landing, folder, line):
    table = folder("table")
    append_readings(load_csv(spark, landing(GOOD), SCHEMA), table)
    with pytest.raises(Exception):
        append_readings(load_csv(spark, landing(GOOD, line), SCHEMA), table)
    assert row_count(readings(spark, table)).first().n_rows == 1


def test_loading_twice_adds_twice(spark, landing, folder):
    path = landing(GOOD, GOOD)
    assert load_job(spark, path, folder("table"), n_batteries=1) == 2
    assert load_job(spark, path, folder("table"), n_batteries=1) == 4


def test_csv_round_trip_keeps_microseconds(spark, sensor_table, folder):
    table = readings(spark, sensor_table)
    export_csv(table, folder("csv"))
    back = load_csv(spark, folder("csv"), readings_schema())
    assert back.count() == table.count() == len(sensor_rows())
    assert back.exceptAll(table).count() == 0 and table.exceptAll(back).count() == 0


def test_csv_round_trip_of_zoneless_times(chicago, folder):
    frame = chicago.sql("select timestamp_ntz'2024-03-10 02:30:07.000001' as time_stamp")
    export_csv(frame, folder("csv"))
    schema = T.StructType([T.StructField("time_stamp", T.TimestampNTZType())])
    back = load_csv(chicago, folder("csv"), schema)
    assert back.select(F.col("time_stamp").cast("string")).first()[0] == "2024-03-10 02:30:07.000001"


def test_ordered_scan_returns_every_row_in_time_order(spark, sensor_table):
    table = readings(spark, sensor_table)
    rows = order_readings(table).collect()
    assert order_readings(table).columns == table.columns
    times = [r.time_stamp for r in rows]
    assert times == sorted(times) and len(times) == len(sensor_rows())
    assert order_readings(table.unionAll(table)).count() == 2 * len(times)


def test_stored_instants_have_statistics(spark, sensor_table, folder):
    append_readings(readings(spark, sensor_table).coalesce(1), folder("table"))
    file = next(f for f in os.listdir(folder("table")) if f.endswith(".parquet"))
    group = pq.ParquetFile(os.path.join(folder("table"), file)).metadata.row_group(0)
    assert group.column(0).physical_type == "INT64"
    assert group.column(0).statistics.has_min_max
    assert spark.conf.get("spark.sql.parquet.outputTimestampType") == "INT96"
    rows = as_of(readings(spark, folder("table")), "time_stamp", "2000-01-01")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert rows.count() == 2 and "PushedFilters: [IsNotNull(time_stamp), LessThan(time_stamp" in plan


def test_row_count_reads_no_column(spark, sensor_table):
    counted = row_count(readings(spark, sensor_table))
    assert counted.first().n_rows == len(sensor_rows())
    assert "ReadSchema: struct<>" in counted._jdf.queryExecution().executedPlan().toString()
