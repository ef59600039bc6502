"""Column presence, aliases, order and nesting, decided while the plan is built."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def resolve_column(df: DataFrame, aliases: Sequence[str]) -> str | None:
    """Name of the first column called like one of the aliases, ignoring case and outer blanks."""
    wanted = {a.strip().lower() for a in aliases}
    return next((c for c in df.columns if c.strip().lower() in wanted), None)


def column_or(df: DataFrame, aliases: Sequence[str], otherwise: Column) -> Column:
    name = resolve_column(df, aliases)
    return otherwise if name is None else quoted(name)


def first_present(df: DataFrame, names: Sequence[str], dtype: str = "string") -> Column:
    """The first of the named columns that exists, else a typed null."""
    for name in names:
        if name in df.columns:
            return quoted(name)
    return F.lit(None).cast(dtype)


def first_known_of(df: DataFrame, names: Sequence[str]) -> Column:
    """Per row the first value among the named columns that exist."""
    present = [quoted(n) for n in names if n in df.columns]
    return F.coalesce(*present) if present else F.lit(None).cast("string")


def ensure_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Add the missing ones of the columns as typed nulls."""
    missing = {c: F.lit(None).cast(t) for c, t in types.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def order_columns(df: DataFrame, front: Sequence[str]) -> DataFrame:
    """Known columns first, in the given order, then the others as they come."""
    known = [c for c in front if c in df.columns]
    return df.select(*[quoted(c) for c in known + [c for c in df.columns if c not in front]])


def upper_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def suffix_collisions(df: DataFrame, other: DataFrame, keys: Sequence[str], suffix: str) -> DataFrame:
    """Rename the columns of ``other`` that ``df`` has too, but for the join keys."""
    clash = [c for c in other.columns if c in df.columns and c not in keys]
    return other.withColumnsRenamed({c: c + suffix for c in clash})


def flatten_struct(df: DataFrame, max_level: int = 2) -> DataFrame:
    """Nested records as columns with dotted names, down to ``max_level`` levels; arrays stay."""

    def leaves(fields, column_of, prefix, level):
        for field in fields:
            name = f"{prefix}{field.name}"
            column = column_of(field.name)
            if isinstance(field.dataType, T.StructType) and level < max_level:
                yield from leaves(
                    field.dataType.fields, column.getField, f"{name}.", level + 1
                )
            else:
                yield column.alias(name)

    return df.select(*leaves(df.schema.fields, quoted, "", 0))


def tag(df: DataFrame, **constants) -> DataFrame:
    """Provenance columns with constant values."""
    return df.withColumns({name: F.lit(value) for name, value in constants.items()})
