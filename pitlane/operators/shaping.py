"""Column and row selection, reshaping, lookups by name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitlane.constants import DRIVER_VIEW_COLUMNS


def cast_columns(df: DataFrame, types: dict[str, str], strict: bool = False) -> DataFrame:
    """Cast the listed columns; values that do not fit become NULL unless `strict`."""
    return df.withColumns(
        {
            name: F.col(name).cast(kind) if strict else F.col(name).try_cast(kind)
            for name, kind in types.items()
        }
    )


def drop_columns(df: DataFrame, names: list[str], missing_ok: bool = False) -> DataFrame:
    """Drop columns; an unknown name is an error unless `missing_ok`."""
    unknown = [n for n in names if n not in df.columns]
    if unknown and not missing_ok:
        raise KeyError(f"no such columns: {unknown}")
    return df.drop(*names)


def positional_columns(df: DataFrame, start: int | None, stop: int | None) -> DataFrame:
    """Columns by position, with slice rules."""
    return df.select(*df.columns[start:stop])


def tag(df: DataFrame, **constants: object) -> DataFrame:
    """Add constant columns."""
    return df.withColumns({name: F.lit(value) for name, value in constants.items()})


def serving_columns(df: DataFrame) -> DataFrame:
    """Columns sorted by their original name, then lower-cased."""
    return df.select(*[F.col(c).alias(c.lower()) for c in sorted(df.columns)])


def drop_missing(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows without NULL or NaN in the columns (default: in any column)."""
    return df.dropna(how="any", subset=columns)


def of_drivers(df: DataFrame, drivers: list[str]) -> DataFrame:
    return df.where(F.col("Driver").isin(drivers))


def driver_view(processed: DataFrame, driver: str) -> DataFrame:
    """One driver's laps with the columns of the driver page."""
    return processed.where(F.col("Driver") == driver).select(*DRIVER_VIEW_COLUMNS)


def melt(
    df: DataFrame, ids: list[str], values: list[str], variable: str, value: str
) -> DataFrame:
    """Wide to long: one row per id row and value column."""
    return df.select(*ids, *values).unpivot(ids, values, variable, value)


def union_by_name(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of all frames; a column one of them lacks is NULL there."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def join_blocks(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Put two feature blocks side by side on their natural key."""
    return left.join(right, keys)


def grand_prix_events(schedule: DataFrame, column: str, pattern: str = "Grand Prix") -> DataFrame:
    return schedule.where(F.col(column).contains(pattern))


def first_rows(df: DataFrame, order: list[str], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def parse_records(
    df: DataFrame, column: str, schema: str | T.StructType, keep: list[str]
) -> DataFrame:
    """JSON text to typed columns next to the kept ones; malformed text gives NULLs."""
    return df.select(*keep, F.from_json(column, schema).alias("_r")).select(*keep, "_r.*")


def ordered_null_last(df: DataFrame, column: str, *ties: str, ascending: bool = True) -> DataFrame:
    """Sort by one column with missing values at the end in both directions."""
    key: Column = F.col(column)
    by = key.asc_nulls_last() if ascending else key.desc_nulls_last()
    return df.orderBy(by, *ties)
