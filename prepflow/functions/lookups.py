"""Keyword lookups (``price__gte=10``) turned into column predicates.

The part before the double underscore is the column, the part after it the
comparison; without one the comparison is ``exact``. Case-sensitive text
lookups and comparisons on the column's own type reach the Parquet scan as
pushed filters.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _text(col: Column) -> Column:
    return col.cast("string")


def _folded(col: Column) -> Column:
    return F.lower(_text(col))


def _exact(col: Column, value) -> Column:
    return col.isNull() if value is None else col == F.lit(value)


def _iexact(col: Column, value) -> Column:
    return col.isNull() if value is None else _folded(col) == str(value).lower()


LOOKUPS = {
    "exact": _exact,
    "iexact": _iexact,
    "contains": lambda c, v: _text(c).contains(str(v)),
    "icontains": lambda c, v: _folded(c).contains(str(v).lower()),
    "in": lambda c, v: c.isin(list(v)),
    "gt": lambda c, v: c > F.lit(v),
    "gte": lambda c, v: c >= F.lit(v),
    "lt": lambda c, v: c < F.lit(v),
    "lte": lambda c, v: c <= F.lit(v),
    "startswith": lambda c, v: _text(c).startswith(str(v)),
    "istartswith": lambda c, v: _folded(c).startswith(str(v).lower()),
    "endswith": lambda c, v: _text(c).endswith(str(v)),
    "iendswith": lambda c, v: _folded(c).endswith(str(v).lower()),
}


def _parse(lookup: str) -> tuple[str, str]:
    name, mark, comparison = lookup.rpartition("__")
    if mark and comparison in LOOKUPS:
        return name, comparison
    return lookup, "exact"


def predicate(lookup: str, value) -> Column:
    """One lookup as a boolean column; null where the tested column is null."""
    name, comparison = _parse(lookup)
    return LOOKUPS[comparison](F.col(name), value)


def all_of(**lookups) -> Column:
    """Every lookup holds."""
    return reduce(lambda a, b: a & b, (predicate(k, v) for k, v in lookups.items()))


def none_of(**lookups) -> Column:
    """Negation of ``all_of`` that is true, not null, where a tested column is null."""
    sides = []
    for lookup, value in lookups.items():
        name, _ = _parse(lookup)
        test = predicate(lookup, value)
        sides.append(~test if value is None else ~test | F.col(name).isNull())
    return reduce(lambda a, b: a | b, sides)


def filter_rows(df: DataFrame, **lookups) -> DataFrame:
    return df.where(all_of(**lookups))


def exclude_rows(df: DataFrame, **lookups) -> DataFrame:
    return df.where(none_of(**lookups))


def get_one(df: DataFrame, **lookups) -> DataFrame:
    """The single row that matches; ``LookupError`` when none or several do.

    Only the first two matches are looked at, so at most two rows leave the cluster.
    """
    found = filter_rows(df, **lookups).take(2)
    if len(found) != 1:
        raise LookupError(f"{lookups}: {'no row' if not found else 'more than one row'} matches")
    return df.sparkSession.createDataFrame(found, df.schema)
