"""Exact quantiles by radix selection.

Spark's exact functions keep every distinct value in one buffer. Here each value
becomes one or more order-preserving 64-bit words, and a scan counts rows per digit
of up to 16 bits: the digit that holds the wanted rank is the only one searched
further. The counts are combined before the shuffle and each round fixes 16 more bits,
so a word takes at most four scans whatever the values or their ties.
"""

from __future__ import annotations

import math
import struct
from dataclasses import dataclass, field
from decimal import Context, Decimal
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prepflow.functions.scalars import missing_as_null

ACCURACY = 10_000
DIGIT_BITS = 16
WORD_BITS = 64
WHOLE = ("tinyint", "smallint", "int", "bigint")
#: Fixed values of IEEE 754 doubles: smallest normal number, bits of the fraction, bias of the exponent.
SMALLEST_NORMAL, FRACTION_BITS, BIAS = 2.2250738585072014e-308, 52, 1023
#: A word of a decimal holds this many digits.
WORD_DIGITS = 18
WIDE = Context(prec=80)


@dataclass
class _Search:
    """One wanted rank: the words found so far, and what is known of the next one."""

    column: int
    share: float
    rank: int  # among the rows in question
    words: list[int] = field(default_factory=list)
    low: int | None = None
    high: int | None = None
    shift: int = WORD_BITS - DIGIT_BITS

    def narrow(self, low: int, high: int, digit_bits: int) -> None:
        """The next word lies in this range; its digit is the first bits in which the ends differ."""
        differ = low ^ high
        self.low, self.high = low, high
        self.shift = max((WORD_BITS if differ < 0 else differ.bit_length()) - digit_bits, 0)

    @property
    def target(self) -> tuple:
        """Searches with equal targets share one histogram."""
        return self.column, tuple(self.words), self.low, self.high, self.shift


def exact_quantiles(df: DataFrame, columns: list[str], points: list[float], digit_bits: int = DIGIT_BITS) -> dict[str, list]:
    """For each column the smallest value whose rank reaches ``ceil(point * n)``.

    Nulls and NaN are ignored; a column without values gives ``None``. Integers come back as
    integers, decimals as decimals, floats as floats. All columns and points share each
    scan; a task holds at most 2 ** ``digit_bits`` counts for each of them. There are at most
    64 / ``digit_bits`` scans a word after one for counts and ends: numbers have one word, decimals of more than 18 digits up to six.
    """
    if not 1 <= digit_bits <= 16:
        raise ValueError("digit_bits must be from 1 to 16")
    kinds = dict(df.dtypes)
    n_words = [word_count(kinds[c]) for c in columns]
    facts = [f(missing_as_null(c, kinds[c])).alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("n", F.count), ("low", F.min), ("high", F.max))]
    first = df.agg(*facts).first()
    searches: list[_Search] = []
    found: dict[tuple[int, float], object] = {}
    for i, c in enumerate(columns):
        for p in points if first[f"n{i}"] else []:
            s = _Search(i, p, max(math.ceil(p * first[f"n{i}"]), 1), shift=WORD_BITS - digit_bits)
            if n_words[i] == 1:
                s.narrow(*[word_of(first[f"{x}{i}"], kinds[c]) for x in ("low", "high")], digit_bits)
            searches.append(s)
    pending = searches
    while pending:  # later scans read only the ranges still in question
        ranges: dict[int, list] = {}
        for s in pending:
            one = n_words[s.column] == 1 and s.low is not None
            ends = [value_of([w], kinds[columns[s.column]]) for w in (s.low, s.high)] if one else None
            ranges.setdefault(s.column, []).append(ends)
        rows = _count_digits(words_of_values(df, columns, ranges), pending)
        unsettled = []
        for i, s in enumerate(pending):
            low, high, s.rank = rows[i]
            if low == high:
                s.words.append(low)
                s.low, s.high, s.shift = None, None, WORD_BITS - digit_bits
            else:
                s.narrow(low, high, digit_bits)
            if len(s.words) < n_words[s.column]:
                unsettled.append(s)
            else:
                found[s.column, s.share] = value_of(s.words, kinds[columns[s.column]])
        pending = unsettled
    return {c: [found.get((i, p)) for p in points] for i, c in enumerate(columns)}


def _count_digits(data: DataFrame, searches: list[_Search]) -> dict[int, tuple[int, int, int]]:
    """By search, smallest and largest word in the digit that holds its rank, and its rank within that digit.

    One scan for all. The running counts go over at most 2 ** 16 digits of a target.
    """
    targets = list(dict.fromkeys(s.target for s in searches))
    target = digit = word = None
    for t, (column, words, low, high, shift) in enumerate(targets):  # they don't overlap
        own = F.col("words")[len(words)]
        inside = F.col("column") == column
        for i, w in enumerate(words):
            inside &= F.col("words")[i] == F.lit(w)
        if low is not None:
            inside &= own.between(F.lit(low), F.lit(high))
        target = (F if target is None else target).when(inside, F.lit(t))
        digit = (F if digit is None else digit).when(F.col("t") == t, F.shiftright(own, shift))
        word = (F if word is None else word).when(F.col("t") == t, own)
    counts = (
        data.withColumn("t", target)
        .where(F.col("t").isNotNull())
        .select("t", digit.alias("digit"), word.alias("word"))
        .groupBy("t", "digit")
        .agg(F.count(F.lit(1)).alias("n"), F.min("word").alias("low"), F.max("word").alias("high"))
    )
    wanted: dict[int, list] = {t: [] for t in range(len(targets))}
    for i, s in enumerate(searches):
        wanted[targets.index(s.target)].append(F.struct(F.lit(i).alias("search"), F.lit(s.rank).cast("long").alias("rank")))
    ranks = F.create_map(*[x for t, w in wanted.items() for x in (F.lit(t), F.array(*w))])
    ranked = counts.select("*", F.sum("n").over(Window.partitionBy("t").orderBy("digit")).alias("upto"))
    ranked = ranked.select("*", F.inline(ranks[F.col("t")]))
    rest = (F.col("rank") - F.col("upto") + F.col("n")).alias("rest")
    holds = ranked.select("search", "low", "high", "n", rest).where((F.col("rest") >= 1) & (F.col("rest") <= F.col("n")))
    return {r.search: (r.low, r.high, r.rest) for r in holds.collect()}


def word_count(kind: str) -> int:
    if not kind.startswith("decimal"):
        return 1
    precision, scale = _decimal(kind)
    return 1 if precision <= WORD_DIGITS else 3 + math.ceil(scale / WORD_DIGITS)


def words_of_values(df: DataFrame, columns: list[str], ranges: dict[int, list] | None = None) -> DataFrame:
    """A row (column, words) for each value: the place in ``columns`` and bigints that order as its values do, first word first.

    ``ranges`` leaves only the columns named by their places, and of these the values between any of the ends given (None: all).
    The exponent of a double is found in steps of their own, as its parts are used many times.
    """
    kinds = dict(df.dtypes)
    ranges = ranges if ranges is not None else {i: [None] for i in range(len(columns))}
    kept = {}
    for i, ends in ranges.items():
        value = missing_as_null(columns[i], kinds[columns[i]])
        inside = value.isNotNull() if None in ends else reduce(or_, [value.between(*[F.lit(e) for e in x]) for x in ends])
        kept[i] = F.when(inside, value).alias(f"v{i}")
    values = df.select(*kept.values())
    doubles = [i for i in kept if kinds[columns[i]] in ("float", "double")]
    values = values.withColumns({f"v{i}": F.col(f"v{i}").cast("double") for i in doubles} | {f"a{i}": F.abs(F.col(f"v{i}").cast("double")) for i in doubles})
    values = values.withColumns({f"g{i}": _guessed_exponent(F.col(f"a{i}")) for i in doubles})
    values = values.withColumns({f"e{i}": _exponent(F.col(f"a{i}"), F.col(f"g{i}")) for i in doubles})
    values = values.withColumns({f"u{i}": _power(F.col(f"e{i}")) for i in doubles})
    cells = []
    for i in kept:
        c, value = columns[i], F.col(f"v{i}")
        if i in doubles:
            words = [_double_word(value, *[F.col(f"{x}{i}") for x in "aeu"])]
        elif kinds[c] in WHOLE:
            words = [value.cast("bigint")]
        elif kinds[c].startswith("decimal"):
            words = _decimal_words(value, *_decimal(kinds[c]))
        else:
            raise ValueError(f"no quantiles of {kinds[c]} in {c!r}")
        cells.append(F.struct(F.lit(i).alias("column"), F.array(*words).alias("words")))
    return values.select(F.inline(F.array(*cells))).where(F.col("words")[0].isNotNull())


def _decimal_words(value: Column, precision: int, scale: int) -> list[Column]:
    """The unscaled number where it fits a word. Else the whole part in three words of 18 digits
    and the digits after the point in further ones, all with the value's sign.
    """
    if precision <= WORD_DIGITS:
        return [(value * F.lit(Decimal(10) ** scale).cast(f"decimal({scale + 1},0)")).cast("bigint")]
    base = F.lit(Decimal(10) ** WORD_DIGITS).cast("decimal(19,0)")
    sign = F.when(value < 0, -1).otherwise(1).cast("bigint")
    whole = F.when(value < 0, F.ceil(value)).otherwise(F.floor(value)).cast("decimal(38,0)")
    words, rest = [], whole if precision > scale else F.when(value.isNotNull(), F.lit(0)).cast("decimal(38,0)")
    for _ in range(2):
        last = rest % base
        words.append(last.cast("bigint"))
        rest = ((rest - last) / base).cast("decimal(38,0)")
    words = [rest.cast("bigint"), *reversed(words)]
    one = F.lit(Decimal(1)).cast("decimal(1,0)")
    after = F.format_number(value % one if precision > scale else value, scale)
    after = F.translate(after, "-", "")  # "0." and the digits after the point; abs would round to 34 digits
    for taken in range(0, scale, WORD_DIGITS):
        words.append(F.substring(after, 3 + taken, min(WORD_DIGITS, scale - taken)).cast("bigint") * sign)
    return words


def _guessed_exponent(a: Column) -> Column:
    return F.least(F.greatest(F.floor(F.log2(a)), F.lit(1 - BIAS)), F.lit(BIAS)).cast("int")


def _exponent(a: Column, guess: Column) -> Column:
    """The guess, which a logarithm may miss by one next to powers of two, put right by comparisons."""
    return guess + F.when(a >= _power(guess + 1), 1).when(a < _power(guess), -1).otherwise(0)


def _power(e: Column) -> Column:
    """2 ** e, by shifts where they reach."""
    shifted = lambda by: F.call_function("shiftleft", F.lit(1).cast("bigint"), by).cast("double")
    up, down = shifted(e), F.lit(1.0) / shifted(-e)
    return F.when(e.between(0, 62), up).when(e.between(-62, -1), down).otherwise(F.pow(F.lit(2.0), e))


def _double_word(x: Column, a: Column, e: Column, power: Column) -> Column:
    """Exponent and fraction of the absolute value ``a`` as one integer, negated for negative ``x``.

    Every step is exact, as ``power`` is 2 ** ``e``. Both zeros give 0, infinities the outermost words.
    """
    normal = F.shiftleft((e + BIAS).cast("bigint"), FRACTION_BITS) + ((a / power - 1) * float(2**FRACTION_BITS)).cast("bigint")
    half = F.lit(2.0**537)  # two steps, as 2 ** 1074 is no double
    word = (
        F.when(a == F.lit(math.inf), F.lit((2 * BIAS + 1) << FRACTION_BITS))
        .when(a < SMALLEST_NORMAL, (a * half * half).cast("bigint"))
        .otherwise(normal)
    )
    return F.when(x < 0, -word).otherwise(word)


def word_of(value, kind: str) -> int:
    """The word of a value that has just one."""
    if kind in WHOLE:
        return value
    if kind in ("float", "double"):
        size = struct.unpack("<Q", struct.pack("<d", abs(value)))[0]
        return -size if value < 0 else size
    return int(value.scaleb(_decimal(kind)[1], WIDE))


def value_of(words: list[int], kind: str) -> object:
    """The value that ``words_of_values`` turned into these words."""
    if kind in WHOLE:
        return words[0]
    if kind in ("float", "double"):
        size = struct.unpack("<d", struct.pack("<Q", abs(words[0])))[0]
        return -size if words[0] < 0 else size
    precision, scale = _decimal(kind)
    if precision <= WORD_DIGITS:
        return Decimal(words[0]).scaleb(-scale, WIDE)
    unscaled = (words[0] * 10**WORD_DIGITS + words[1]) * 10**WORD_DIGITS + words[2]
    left = scale
    for w in words[3:]:
        digits = min(WORD_DIGITS, left)
        unscaled, left = unscaled * 10**digits + w, left - digits
    return Decimal(unscaled).scaleb(-scale, WIDE)


def _decimal(kind: str) -> tuple[int, int]:
    precision, scale = kind[len("decimal(") : -1].split(",")
    return int(precision), int(scale)


def approx_quantiles(df: DataFrame, columns: list[str], points: list[float], accuracy: int = ACCURACY) -> dict[str, list]:
    """One scan with a bounded sketch; ranks are off by at most n / accuracy."""
    kinds = dict(df.dtypes)
    found = [F.percentile_approx(missing_as_null(c, kinds[c]), points, accuracy).alias(f"q{i}") for i, c in enumerate(columns)]
    return dict(zip(columns, df.agg(*found).first(), strict=True))
