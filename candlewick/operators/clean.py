"""Column names, types and keys of bar tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.functions.scalars import to_number, to_time
from candlewick.schemas import BAR_SCHEMA, VALUE_COLUMNS

KEY = ["symbol", "datetime"]


def normalize_columns(df: DataFrame) -> DataFrame:
    """Trim blanks around column names."""
    return df.toDF(*[name.strip() for name in df.columns])


def require_columns(df: DataFrame, names: Sequence[str] = tuple(BAR_SCHEMA.names)) -> DataFrame:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def _coerced(field: T.StructField, found: T.DataType) -> Column:
    """The column in the wanted type; NaN becomes null also where the type fits."""
    if field.dataType == found and not isinstance(found, T.DoubleType):
        return F.col(field.name)
    if isinstance(field.dataType, T.DoubleType):
        return to_number(F.col(field.name))
    if isinstance(field.dataType, T.TimestampType):
        return to_time(F.col(field.name))
    return F.col(field.name).try_cast(field.dataType)


def enforce_schema(df: DataFrame, schema: T.StructType = BAR_SCHEMA) -> DataFrame:
    """Cast the schema's columns in place; bad values become null, other columns stay."""
    wanted = {field.name: field for field in schema.fields}
    return df.select(
        *[
            _coerced(wanted[found.name], found.dataType).alias(found.name)
            if found.name in wanted
            else F.col(f"`{found.name}`")
            for found in df.schema.fields
        ]
    )


def normalize_bars(df: DataFrame) -> DataFrame:
    """Trimmed names, all bar columns present, typed values."""
    return enforce_schema(require_columns(normalize_columns(df)))


def drop_incomplete(df: DataFrame, names: Sequence[str] = ("datetime", "symbol", "close")) -> DataFrame:
    """Keep rows in which all named columns have a value.

    Plain null tests, unlike ``dropna``, reach the Parquet scan and tell the
    optimizer that the columns are complete from here on.
    """
    return df.filter(" AND ".join(f"`{name}` IS NOT NULL" for name in names))


def add_layer_columns(df: DataFrame, crypto: str | None = None) -> DataFrame:
    """Add ``year`` and ``month``; set ``crypto`` when given, else keep the one there is."""
    columns = {"year": F.year("datetime"), "month": F.month("datetime")}
    if crypto is not None:
        columns["crypto"] = F.lit(crypto)
    return df.withColumns(columns)


def dedup_bars(df: DataFrame, key: Sequence[str] = tuple(KEY)) -> DataFrame:
    """One row per key: of several, the greatest one, comparing close, volume, then the other columns.

    The choice does not depend on row order. Copies are merged before the
    shuffle, so a key with very many copies stays cheap.
    """
    rest = [name for name in df.columns if name not in key]
    lead = [name for name in ("close", "volume") if name in rest]
    ranked = lead + [name for name in rest if name not in lead]
    best = df.groupBy(*key).agg(F.max(F.struct(*ranked)).alias("_best"))
    return best.select(*[F.col(name) if name in key else F.col(f"_best.`{name}`") for name in df.columns])


def sort_bars(df: DataFrame) -> DataFrame:
    return df.orderBy(*KEY)


def value_columns(df: DataFrame) -> list[str]:
    return [name for name in VALUE_COLUMNS if name in df.columns]
