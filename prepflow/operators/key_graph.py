"""Deletes that follow the foreign keys between tables.

Tables and links form a graph. A deleted row takes the rows that point to it along, and by
links that stand for inheritance also the row it extends. Each round semi-joins only the rows
deleted in the round before, so a table is read once for each level above it; cycles and tables that
point to themselves end when a round finds no further row.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prepflow.functions.scalars import named
from prepflow.sources.scratch import settle


@dataclass(frozen=True)
class Link:
    """``child.column`` points to ``parent.parent_column``. ``extends``: the child's row is a part of the parent's, so both go together."""

    child: str
    column: str
    parent: str
    parent_column: str
    extends: bool = False


def cascade(
    tables: Mapping[str, DataFrame], keys: Mapping[str, list[str]], links: list[Link], start: str, condition: Column
) -> dict[str, DataFrame]:
    """The rows that are left of every table once the rows of ``start`` that meet ``condition`` are deleted.

    ``keys`` names the columns that identify a row of each table; rows that share a key go
    together, and a null is a key of its own. A table that is not ``start`` may name its links' columns, which decide its rows. A null foreign key points to nothing. A condition that is null
    deletes nothing. Columns the graph doesn't use are never moved.
    """
    ends = [(x.parent, x.parent_column, x.child, x.column) for x in links]
    ends += [(x.child, x.column, x.parent, x.parent_column) for x in links if x.extends]
    used = {t: list(dict.fromkeys([*keys[t], *[column for table, column, _, _ in ends if table == t]])) for t in tables}
    gone: dict[str, list[DataFrame]] = {t: [] for t in tables}
    fresh = {start: _fresh(tables[start].where(condition), used[start], keys[start], [], start)}
    while fresh := {t: f for t, f in fresh.items() if not f.isEmpty()}:
        for t, f in fresh.items():
            gone[t].append(f)
        reached: dict[str, list[DataFrame]] = {}
        for source, from_column, target, to_column in ends:
            if source in fresh:
                hit = fresh[source].select(named(from_column).alias("k0")).distinct().alias("hit")
                rows = tables[target].alias("rows").join(hit, _of("rows", to_column) == F.col("hit.k0"), "left_semi")
                reached.setdefault(target, []).append(rows.select(*_columns(used[target])))
        fresh = {t: _fresh(reduce(DataFrame.unionByName, parts), used[t], keys[t], gone[t], t) for t, parts in reached.items()}
    return {t: _without(df, gone[t], keys[t]) for t, df in tables.items()}


def _fresh(rows: DataFrame, used: list[str], key: list[str], before: list[DataFrame], label: str) -> DataFrame:
    """Those of the rows that no earlier round has deleted, once each."""
    return settle(_without(rows.select(*_columns(used)).distinct(), before, key), f"gone-{label}")


def _without(rows: DataFrame, gone: list[DataFrame], key: list[str]) -> DataFrame:
    if not gone:
        return rows
    deleted = reduce(DataFrame.unionByName, [g.select(*[named(c).alias(f"k{i}") for i, c in enumerate(key)]) for g in gone]).alias("gone")
    same = reduce(Column.__and__, [_of("rows", c).eqNullSafe(F.col(f"gone.k{i}")) for i, c in enumerate(key)])
    return rows.alias("rows").join(deleted, same, "left_anti")


def _of(side: str, column: str) -> Column:
    """A column of one side of a join, which no column of the other can clash with."""
    return F.col(f"{side}.`" + column.replace("`", "``") + "`")


def _columns(names: list[str]) -> list[Column]:
    return [named(c) for c in names]

