"""Small column helpers."""

from pyspark.sql import Column, DataFrame, functions as F


def c(name: str) -> Column:
    """A column by its exact name, whatever characters the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def not_null(name: str) -> Column:
    """The column, failing the job on the first null (file tables do not enforce NOT NULL)."""
    message = F.lit(f"null in required column {name}")
    return F.when(c(name).isNull(), F.raise_error(message)).otherwise(c(name)).alias(name)


def refuse_names(df: DataFrame, *names: str) -> None:
    """Names that an operator adds must be free; Spark would fail later and less clearly."""
    taken = {n.lower() for n in df.columns} & {n.lower() for n in names}
    if taken:
        raise ValueError(f"columns with a reserved name: {sorted(taken)}")
