from .csv import export_csv, load_csv
from .parquet import check_codec, refuse_own_input, write_parquet
from .readings import append_readings, order_readings, readings, row_count

__all__ = [
    "append_readings",
    "check_codec",
    "export_csv",
    "load_csv",
    "order_readings",
    "readings",
    "refuse_own_input",
    "row_count",
    "write_parquet",
]
