"""Intermediate tables in the folder all executors share."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from .storage import remove_folder, write_table

_LOCAL_FALLBACK: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    A local session without the setting gets a temporary folder. A cluster
    session without it is refused: a machine-local folder would not be seen by
    the other executors.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    key = context.applicationId
    if key not in _LOCAL_FALLBACK:
        _LOCAL_FALLBACK[key] = tempfile.mkdtemp(prefix="voltlake-")
    return _LOCAL_FALLBACK[key]


class Workspace:
    """A fresh subfolder for the tables of one run.

    Tables written here cut the lineage: a lost executor costs a re-read of the
    table, never a second evaluation that could order rows differently. As a
    context manager the folder is removed at the end, so use it that way only
    where no lazily evaluated result outlives the block.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/voltlake-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"

    def save(self, df: DataFrame, name: str = "table") -> DataFrame:
        """Write ``df`` and return a DataFrame that reads the written table."""
        path = self.path(name)
        write_table(df, path)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        remove_folder(self.spark, self.root)

    def __enter__(self) -> "Workspace":
        return self

    def __exit__(self, *exc) -> None:
        self.close()
