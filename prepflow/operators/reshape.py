"""Long transaction histories turned into one wide row per entity."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prepflow.functions.scalars import period_label

MAX_COLUMNS = 10_000


def latest_periods(df: DataFrame, period: str, n: int) -> list:
    """The ``n`` most recent period values, newest first. They become column names."""
    rows = _latest(df, period, n).collect()
    return [r[0] for r in rows]


def _latest(df: DataFrame, period: str, n: int) -> DataFrame:
    return df.where(F.col(period).isNotNull()).select(period).distinct().orderBy(F.col(period).desc()).limit(n)


def latest_period_labels(df: DataFrame, period: str, n: int, prefix: str = "M") -> DataFrame:
    """The ``n`` most recent periods with their labels ``M1`` (newest) to ``Mn``."""
    rank = F.row_number().over(Window.orderBy(F.col(period).desc()))
    return _latest(df, period, n).select(period, period_label(rank, prefix).alias("label"))


def all_values(df: DataFrame, *columns: str, limit: int = MAX_COLUMNS) -> list[tuple]:
    """Distinct non-null value tuples in order, to be used as column names."""
    rows = df.select(*columns).na.drop().distinct().orderBy(*columns).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{columns} would give more than {limit} columns")
    return [tuple(r) for r in rows]


def keep_recent(df: DataFrame, period: str, n: int, prefix: str = "M") -> DataFrame:
    """Rows of the ``n`` most recent periods, the period replaced by its label."""
    periods = latest_periods(df, period, n)
    if not periods:
        return df.where(F.lit(False)).withColumn(period, F.lit(None).cast("string"))
    labels = F.create_map(*[F.lit(x) for i, p in enumerate(periods) for x in (p, f"{prefix}{i + 1}")])
    return df.where(F.col(period).isin(periods)).withColumn(period, labels[F.col(period)])


def pivot_mean(
    df: DataFrame,
    index: list[str],
    column: str,
    values: list,
    measures: list[str],
    name,
    fill: float | None = 0.0,
    gaps_of_absent: bool = False,
) -> DataFrame:
    """Mean of each measure per index row and pivot value.

    ``name(value, measure)`` names the cells. Empty cells become ``fill``. With
    ``gaps_of_absent`` a measure that an index row never has stays null, as when
    each measure is pivoted alone and the results are merged by an outer join.
    """
    means = [F.avg(m).alias(m) for m in measures]
    wide = df.where(F.col(column).isin(values)).groupBy(*index).pivot(column, values).agg(*means)
    cells = [(v, m) for v in values for m in measures]
    wide = wide.toDF(*index, *[f"_c{i}" for i in range(len(cells))])
    out = []
    for i, (value, measure) in enumerate(cells):
        cell = F.col(f"_c{i}")
        if fill is not None:
            filled = F.coalesce(cell, F.lit(fill))
            if gaps_of_absent:
                own = [F.col(f"_c{j}") for j, (_, m) in enumerate(cells) if m == measure]
                filled = F.when(F.coalesce(*own).isNotNull(), filled)
            cell = filled
        out.append(cell.alias(name(value, measure)))
    return wide.select(*index, *out)


def pivot_two_keys(
    df: DataFrame, index: list[str], first: str, second: str, measures: list[str], fill: float | None = 0.0, firsts: list | None = None
) -> DataFrame:
    """Pivot over the pairs of two columns of any type; cells are named ``first-second-measure``.

    Only pairs that occur get columns, or, with ``firsts``, each of these values beside
    each value of ``second``, so that the columns don't depend on gaps in the data. Rows
    with a null in either column are left out. Where two pairs would have one name, texts
    are written in quotes. There are at most ``MAX_COLUMNS`` pairs, so they are broadcast.
    """
    pairs = all_values(df, first, second) if firsts is None else [(a, b) for a in firsts for (b,) in all_values(df, second)]
    plain = ["-".join(str(v).lower() if isinstance(v, bool) else str(v) for v in p) for p in pairs]
    times = Counter(plain)
    names = [n if times[n] == 1 else "-".join(map(repr, p)) for n, p in zip(plain, pairs, strict=True)]
    kinds = df.select(first, second).schema.add("_pair", "integer")
    coded = df.sparkSession.createDataFrame([(*p, i) for i, p in enumerate(pairs)], kinds)
    joined = df.join(F.broadcast(coded), [first, second])
    return pivot_mean(joined, index, "_pair", list(range(len(pairs))), measures, lambda i, m: f"{names[i]}-{m}", fill)


def pivot_periods(
    df: DataFrame,
    key: str,
    period: str,
    measures: list[str],
    n: int,
    fill: float | None = 0.0,
    name: str = "{period}-{measure}",
    prefix: str = "M",
) -> DataFrame:
    """One row per key with the mean of each measure in each of the ``n`` latest periods.

    Always ``n`` columns per measure: periods the data does not have are constant.
    """
    periods = latest_periods(df, period, n)
    labels = {p: f"{prefix}{i + 1}" for i, p in enumerate(periods)}

    def cell(value, measure):
        return name.format(period=labels[value], measure=measure)

    wide = pivot_mean(df, [key], period, periods, measures, cell, fill)
    missing = [
        name.format(period=f"{prefix}{i + 1}", measure=m) for i in range(len(periods), n) for m in measures
    ]
    pad = F.lit(fill).cast("double")
    return wide.select("*", *[pad.alias(c) for c in missing]) if missing else wide
