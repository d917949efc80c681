"""File labels and the type contract of an export."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .. import schema as tables
from ..functions import c


def export_names(
    df: DataFrame, layout: str = "count", n_batteries: int = tables.N_BATTERIES
) -> DataFrame:
    """Rename the columns, by position, to the labels used in the exported files."""
    labels = tables.file_labels(layout, n_batteries)
    if len(labels) != len(df.columns):
        raise ValueError(f"{layout} layout has {len(labels)} columns, got {len(df.columns)}")
    return df.toDF(*labels)


# Columns of rows that were judged by a contract.
FITS = "_vl_fits"
REJECTED = "rejected_columns"


def _typed(name: str, target: T.DataType) -> Column:
    return c(name).try_cast(target)


def _rejected(name: str, target: T.DataType) -> Column:
    return c(name).isNotNull() & _typed(name, target).isNull()


def _lossy(df: DataFrame, name: str, target: T.DataType) -> Column:
    """The value fits the target but does not come back unchanged."""
    back = _typed(name, target).try_cast(df.schema[name].dataType)
    return F.coalesce(back != c(name), F.lit(False))


def _retyped(df: DataFrame, contract: T.StructType) -> list[str]:
    absent = [f.name for f in contract if f.name not in df.columns]
    if absent:
        raise ValueError(f"columns missing for the contract: {absent}")
    return [f.name for f in contract if f.dataType != df.schema[f.name].dataType]


def _names_where(df: DataFrame, contract: T.StructType, test) -> Column:
    """The names of the contract columns whose value meets ``test``, as an array."""
    changed = _retyped(df, contract)
    if not changed:
        return F.array().cast("array<string>")
    hits = F.array(*[F.when(test(n, contract[n].dataType), F.lit(n)) for n in changed])
    return F.array_except(hits, F.array(F.lit(None).cast("string")))


def check_contract(df: DataFrame, contract: T.StructType) -> DataFrame:
    """The contract columns in their types, plus what did not fit.

    A value outside its type becomes null and its column is named in
    ``rejected_columns``; a value that fits only after losing digits is named in
    ``lossy_columns``. Other columns pass through.
    """
    types = {f.name: f.dataType for f in contract}
    rejected = _names_where(df, contract, _rejected)
    lossy = _names_where(df, contract, lambda n, t: _lossy(df, n, t))
    # The guard keeps this expression apart from the one in the tests. Where a filter
    # and a projection share one, the optimizer derives 2^columns constraints.
    typed = {n: F.when(c(n).isNotNull(), _typed(n, t)).alias(n) for n, t in types.items()}
    return df.select(
        *[typed[n] if n in types else c(n) for n in df.columns],
        rejected.alias("rejected_columns"),
        lossy.alias("lossy_columns"),
    )


def enforce(
    df: DataFrame,
    contract: T.StructType,
    policy: str = "fail",
    allow_lossy: bool = True,
) -> tuple[DataFrame, DataFrame | None]:
    """Apply the contract and return (good rows, bad rows).

    ``fail`` stops the job on the first value that does not fit, and has no bad
    rows. ``quarantine`` keeps whole rows apart: good rows carry the contract's
    types, bad rows their original values and ``rejected_columns``. With
    ``allow_lossy=False`` a value that would lose digits does not fit either.
    """

    def bad(name: str, target: T.DataType) -> Column:
        test = _rejected(name, target)
        return test if allow_lossy else test | _lossy(df, name, target)

    changed = set(_retyped(df, contract))
    types = {f.name: f.dataType for f in contract}
    if policy == "fail":

        def checked(name: str) -> Column:
            value = c(name).cast("string")
            message = F.concat(
                F.lit(f"column {name} does not fit {types[name].simpleString()}: "), value
            )
            failed = F.when(bad(name, types[name]), F.raise_error(message))
            return failed.otherwise(_typed(name, types[name])).alias(name)

        return df.select(*[checked(n) if n in changed else c(n) for n in df.columns]), None
    if policy != "quarantine":
        raise ValueError(f"unknown policy {policy!r}, expected 'fail' or 'quarantine'")

    unfit = reduce(Column.__or__, [bad(n, types[n]) for n in sorted(changed)], F.lit(False))
    rejected = _names_where(df, contract, bad).alias(REJECTED)
    return typed(df.filter(~unfit), contract), df.filter(unfit).select("*", rejected)


def with_verdict(df: DataFrame, contract: T.StructType, name: str) -> DataFrame:
    """``df`` plus ``rejected_columns`` and ``name``: whether all values fit the contract's types."""
    types = {f.name: f.dataType for f in contract}
    unfit = [_rejected(n, types[n]) for n in sorted(_retyped(df, contract))]
    rejected = _names_where(df, contract, _rejected).alias(REJECTED)
    return df.select("*", rejected, (~reduce(Column.__or__, unfit, F.lit(False))).alias(name))


def typed(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Rows that fit, in the contract's types: by a plain cast, which no longer can fail."""
    changed, types = set(_retyped(df, contract)), {f.name: f.dataType for f in contract}
    return df.select(*[c(n).cast(types[n]).alias(n) if n in changed else c(n) for n in df.columns])
