"""Projections and per-column rewrites. Each is one ``select``, never a loop of them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepflow.operators.joins import lookup_join


def project(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns)


def project_with_key(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """The chosen columns, with the key in front even when it was not asked for."""
    return df.select(key, *[c for c in columns if c != key])


def project_tuples(df: DataFrame, columns: list[str], name: str = "row") -> DataFrame:
    return df.select(F.struct(*columns).alias(name))


def drop_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.drop(*columns)


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def rename_by_position(df: DataFrame) -> DataFrame:
    return df.toDF(*[str(i) for i in range(len(df.columns))])


@dataclass(frozen=True)
class TypeSplit:
    categorical: list[str]
    continuous: list[str]
    other: list[str]


def split_by_type(df: DataFrame, leave_out: tuple[str, ...] = ()) -> TypeSplit:
    """Column names by kind: text, numbers, and the rest (dates, booleans, vectors)."""
    groups = TypeSplit([], [], [])
    for field in df.schema.fields:
        if field.name in leave_out:
            continue
        if isinstance(field.dataType, T.StringType):
            groups.categorical.append(field.name)
        elif isinstance(field.dataType, T.NumericType):
            groups.continuous.append(field.name)
        else:
            groups.other.append(field.name)
    return groups


def rewrite(df: DataFrame, changes: dict[str, Column]) -> DataFrame:
    """Replace or add several columns at once, keeping the order of the others."""
    return df.withColumns(changes) if changes else df


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast columns; text that does not hold such a value becomes null."""
    return rewrite(df, {c: F.col(c).try_cast(t) for c, t in types.items()})


def cast_prefix(df: DataFrame, prefix: str, dtype: str = "int") -> DataFrame:
    return cast_columns(df, {c: dtype for c in df.columns if c.startswith(prefix)})


def map_values(df: DataFrame, column: str, mapping: DataFrame) -> DataFrame:
    """Replace values through a two-column (old, new) frame; unmapped values stay."""
    old, new = mapping.columns
    keyed = mapping.select(F.col(old).alias(column), F.col(new).alias("_mapped"))
    out = lookup_join(df, keyed, column)
    return out.withColumn(column, F.coalesce("_mapped", column)).select(*df.columns)


def fill_constant(df: DataFrame, values: dict[str, object]) -> DataFrame:
    return df.na.fill(values)


def fill_where(df: DataFrame, column: str, condition: Column, value: Column) -> DataFrame:
    return df.withColumn(column, F.when(condition, value).otherwise(F.col(column)))


def pad_columns(df: DataFrame, names: list[str], value: object = 0) -> DataFrame:
    """Add those of ``names`` that are missing, holding a constant."""
    return rewrite(df, {n: F.lit(value) for n in names if n not in df.columns})


def drop_null_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.na.drop("any", subset=columns)


def keep_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull())


def keep_outside(df: DataFrame, column: str, low, high) -> DataFrame:
    return df.where(~F.col(column).between(low, high))


def exclude_values(df: DataFrame, column: str, values: list | DataFrame) -> DataFrame:
    """Rows whose value is none of ``values``; null rows go too, as with ``!=``.

    A list becomes one predicate; a one-column frame of any size an anti join.
    """
    if isinstance(values, DataFrame):
        unwanted = values.toDF(column).distinct()
        return keep_not_null(df, column).join(unwanted, column, "left_anti")
    return df.where(~F.col(column).isin(list(values)))


# Smallest signed type first, with the range it holds.
_INTEGER_TYPES = [
    ("tinyint", -(2**7), 2**7 - 1),
    ("smallint", -(2**15), 2**15 - 1),
    ("int", -(2**31), 2**31 - 1),
    ("bigint", -(2**63), 2**63 - 1),
]


def narrowest_integer(low: int | None, high: int | None) -> str:
    if low is None:
        return "tinyint"
    return next(name for name, lo, hi in _INTEGER_TYPES if lo <= low and high <= hi)


def narrow_types(df: DataFrame, columns: list[str] | None = None, lossy_floats: bool = False) -> DataFrame:
    """Cast numbers to the smallest type that holds every value, found in one scan.

    A double becomes a float only if no value changes, or on request. Text is
    left alone: Parquet already stores repeated text as a dictionary.
    """
    kinds = dict(df.dtypes)
    chosen = columns if columns is not None else df.columns
    integers = [c for c in chosen if kinds[c] in ("tinyint", "smallint", "int", "bigint")]
    doubles = [c for c in chosen if kinds[c] == "double"]
    if not integers and not doubles:
        return df
    facts = [f(F.col(c)).alias(f"{n}{i}") for i, c in enumerate(integers) for n, f in (("lo", F.min), ("hi", F.max))]
    facts += [
        F.coalesce(F.bool_and(F.col(c).cast("float").cast("double").eqNullSafe(F.col(c))), F.lit(True)).alias(f"same{i}")
        for i, c in enumerate(doubles)
    ]
    seen = df.agg(*facts).first()
    types = {c: narrowest_integer(seen[f"lo{i}"], seen[f"hi{i}"]) for i, c in enumerate(integers)}
    types |= {c: "float" for i, c in enumerate(doubles) if lossy_floats or seen[f"same{i}"]}
    return df.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])
