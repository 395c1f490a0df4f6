"""Transaction histories to modelling tables."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepflow.operators.aggregate import first_per_key
from prepflow.operators.columns import cast_columns, fill_constant
from prepflow.operators.encode import apply_codes, fit_labels
from prepflow.operators.joins import join_inner, join_keep_larger
from prepflow.operators.reshape import (
    all_values,
    keep_recent,
    latest_period_labels,
    pivot_mean,
    pivot_periods,
    pivot_two_keys,
)
from prepflow.sources.scratch import settle


@dataclass(frozen=True)
class MonthlyTables:
    merged: DataFrame
    running: DataFrame
    month_labels: DataFrame


def monthly_transpose(
    running: DataFrame,
    loans: DataFrame,
    key: str,
    period: str,
    running_measure: str,
    loan_measures: list[str],
    running_months: int,
    loan_months: int,
    second_key: str | None = None,
    running_second_key: str | None = None,
) -> MonthlyTables:
    """Running-account means per month beside loan means per month and measure.

    ``M1`` is each table's own latest month. With ``second_key`` the loans, and with
    ``running_second_key`` the running accounts, are spread over month and that column
    together (``M1-<value>-<measure>``). All months asked for have columns, also where
    the data has none. The merged table keeps every key of
    whichever table has more keys; the other one's columns are null where it has
    no such key. Both wide tables are written out before they are counted and
    joined, so each history is pivoted once.
    """

    def spread(df, measures, n, second, name):
        if second is None:
            return pivot_periods(df, key, period, measures, n, name=name)
        months = [f"M{i + 1}" for i in range(n)]
        return pivot_two_keys(keep_recent(df, period, n), [key], period, second, measures, firsts=months)

    running_wide = settle(spread(running, [running_measure], running_months, running_second_key, "{period}"), "running")
    loan_wide = spread(loans, loan_measures, loan_months, second_key, "{period}-{measure}")
    loan_wide = settle(cast_columns(loan_wide, {key: "bigint"}), "loans")
    labels = latest_period_labels(running, period, running_months).select(F.col("label").alias("Month_label"))
    return MonthlyTables(join_keep_larger(running_wide, loan_wide, key), running_wide, labels)


@dataclass(frozen=True)
class PeriodTables:
    merged: DataFrame
    features: DataFrame
    labels: DataFrame
    codes: dict[str, DataFrame]
    outputs: dict[str, object]  # the period of each OFN column; None where the data has too few


def by_number(period) -> list:
    """A sort key for periods that takes the numbers in a text as numbers: B2 before B10."""
    if not isinstance(period, str):
        return [period]
    return [int(x) if i % 2 else x for i, x in enumerate(re.split(r"((?<![0-9])-?[0-9]+)", period))]


def multi_output_transpose(
    inputs: DataFrame,
    outputs: DataFrame,
    key: str,
    order: list[str],
    static: list[str],
    period: str,
    measures: list[str],
    text_labels: list[str],
    missing_text: str,
    output_period: str,
    output_value: str,
    n_outputs: int = 6,
    known: tuple = (),
) -> PeriodTables:
    """One row per key: static attributes, mean of each measure per period, and the
    label of each output period as ``OFN1``, ``OFN2``, …

    Periods are ordered by the numbers in them. Those in ``known`` come first and have
    columns also where the data has none. All periods of the data have columns; with
    fewer than ``n_outputs`` the remaining ``OFN`` columns are 0, as for absent cells.

    ``text_labels`` are filled and turned into codes, so they can be measures.
    The static attributes are those of the key's first row in ``order``.
    """
    filled = fill_constant(inputs, dict.fromkeys(text_labels, missing_text))
    attributes = first_per_key(filled.select(key, *[c for c in order if c != key], *static), key, order).select(key, *static)
    coded, codes = filled, {}
    for c in text_labels:
        codes[c] = fit_labels(filled, c)
        coded = apply_codes(coded, codes[c], c, f"_{c}_code").drop(c).withColumnRenamed(f"_{c}_code", c)
    def periods_of(df, column):
        return [*known, *sorted((p for (p,) in all_values(df, column) if p not in known), key=by_number)]

    periods = periods_of(filled, period)
    wide = pivot_mean(coded, [key], period, periods, measures, lambda p, m: f"{p}_{m}", 0.0, gaps_of_absent=True)

    out_periods = periods_of(outputs, output_period)
    names = {p: f"OFN{i + 1}" for i, p in enumerate(out_periods)}
    labels = pivot_mean(outputs, [key], output_period, out_periods, [output_value], lambda p, m: names[p], 0.0)
    spare = [f"OFN{i + 1}" for i in range(len(out_periods), n_outputs)]
    labels = labels.select(
        key, *[F.col(n).cast("int").try_cast("tinyint").alias(n) for n in names.values()], *[F.lit(0).cast("tinyint").alias(n) for n in spare]
    )

    merged = join_inner([attributes, wide, labels], key)
    ofn = [*names.values(), *spare]
    shown = {n: p for p, n in names.items()} | dict.fromkeys(spare)
    return PeriodTables(merged, merged.drop(*ofn), merged.select(key, *ofn), codes, shown)
