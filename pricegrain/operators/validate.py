"""Schema, null and key checks; casts and rounding that writers apply."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.scalars import round_price, significant
from ..schemas import Table


class SchemaError(ValueError):
    """A table that doesn't meet its contract."""


def cast_to(df: DataFrame, schema: StructType, strict: bool = False) -> DataFrame:
    """The schema's columns in its order; values that don't cast become null, or raise if ``strict``."""
    to = lambda f: F.col(f.name).cast(f.dataType) if strict else F.col(f.name).try_cast(f.dataType)
    return df.select([to(f).alias(f.name) for f in schema])


def check_columns(df: DataFrame, schema: StructType) -> None:
    """Missing, unexpected and wrongly typed columns; needs no pass over the rows."""
    have, want = {f.name: f.dataType for f in df.schema}, {f.name: f.dataType for f in schema}
    if missing := [c for c in want if c not in have]:
        raise SchemaError(f"missing columns: {missing}")
    if extra := [c for c in have if c not in want]:
        raise SchemaError(f"unexpected columns: {extra}")
    if wrong := [f"{c}: {have[c].simpleString()} instead of {want[c].simpleString()}" for c in want if have[c] != want[c]]:
        raise SchemaError(f"wrong types: {wrong}")


def null_probe(df: DataFrame, columns) -> DataFrame:
    """One row with the number of nulls in each column, in one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def duplicate_probe(df: DataFrame, key) -> DataFrame:
    """Keys that occur more than once, null parts included, with their count ``n``."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def validate(df: DataFrame, table: Table) -> DataFrame:
    """``df`` itself if it meets the table's contract; raises SchemaError otherwise."""
    check_columns(df, table.schema)
    if table.required:
        nulls = null_probe(df, table.required).first().asDict()
        if found := {c: n for c, n in nulls.items() if n}:
            raise SchemaError(f"nulls in required columns: {found}")
    if found := duplicate_probe(df, table.key).limit(5).collect():
        raise SchemaError(f"duplicate keys: {[tuple(r)[:-1] for r in found]}")
    return df


def rounded(df: DataFrame, table: Table) -> DataFrame:
    """Prices to four decimals and rates to ten significant digits; done once, by writers."""
    change: dict[str, Column] = {c: round_price(c) for c in table.rounded if c in df.columns}
    change |= {c: significant(c) for c in table.significant if c in df.columns}
    return df.withColumns(change) if change else df


def prepared(df: DataFrame, table: Table, check: bool = True) -> DataFrame:
    """What a writer stores: cast, validated, rounded, in the table's order."""
    out = cast_to(df, table.schema)
    return rounded(validate(out, table) if check else out, table).orderBy(*table.order)


def same_schema(a: StructType, b: StructType) -> tuple[set[str], set[str]]:
    """Columns that only a has, and only b."""
    return {*a.names} - {*b.names}, {*b.names} - {*a.names}
