"""Scalar expressions used across the operators."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F


def first_digits(col: Column) -> Column:
    """First run of digits in a text, null when there is none."""
    return F.nullif(F.regexp_extract(col.cast("string"), "([0-9]+)", 1), F.lit(""))


def period_label(rank: Column, prefix: str = "M") -> Column:
    return F.concat(F.lit(prefix), rank.cast("string"))


def joined_label(*parts: Column, sep: str = "-") -> Column:
    return F.concat_ws(sep, *[p.cast("string") for p in parts])


def replace_texts(col: Column, pairs: dict[str, str]) -> Column:
    """Literal (not pattern) replacements, applied in the given order."""
    for old, new in pairs.items():
        col = F.replace(col, F.lit(old), F.lit(new))
    return col


def max_abs_percent(vector: Column) -> Column:
    """Largest absolute entry of a vector column, times 100, as float."""
    return array_max_abs_percent(vector_to_array(vector))


def array_max_abs_percent(values: Column) -> Column:
    return (F.array_max(F.transform(values, F.abs)) * 100).cast("float")


def named(name: str) -> Column:
    """The column of exactly this name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def missing_as_null(name: str, dtype: str) -> Column:
    """NaN counts as missing for floating columns; other types pass through."""
    col = named(name)
    return F.when(~F.isnan(col), col) if dtype in ("double", "float") else col


def stable_hash(*parts: Column) -> Column:
    """Non-negative 32-bit integer that depends on the text of the parts only.

    The first eight hex digits of an MD5, so other engines can compute it too
    and a row gets the same value however the data is partitioned.
    """
    return F.conv(F.substring(stable_digest(*parts), 1, 8), 16, 10).cast("bigint")


def wide_hash(*parts: Column) -> Column:
    """Like ``stable_hash`` with 60 bits, for use where 2^32 values are too few."""
    return F.conv(F.substring(stable_digest(*parts), 1, 15), 16, 10).cast("bigint")


def stable_digest(*parts: Column) -> Column:
    return F.md5(F.concat_ws("-", *[p.cast("string") for p in parts]).cast("binary"))
