"""Column expressions: flags, bins, calendar parts, rounding, percentages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from tallyhouse.labels import MISSING_TOKENS


def cents(amount: Column) -> Column:
    """Two-decimal money as whole cents: sums are exact and stay in generated code."""
    return F.rint(amount * 100).cast("long")


def from_cents(total: Column) -> Column:
    return total.cast("double") / F.lit(100.0)


def flag_from_text(text: Column, yes: str = "Yes") -> Column:
    """1 for exactly ``yes``; anything else, null included, is 0."""
    return text.eqNullSafe(F.lit(yes)).cast("int")


def flag_label(flag: Column, yes: str = "Yes", no: str = "No") -> Column:
    return F.when(flag == 1, F.lit(yes)).otherwise(F.lit(no))


def blank_missing(text: Column, tokens: Sequence[str] = tuple(MISSING_TOKENS)) -> Column:
    return F.when(~text.isin(list(tokens)), text)


def bin_index(value: Column, edges: Sequence[float]) -> Column:
    """Ordinal of the right-closed bin ``(edges[i], edges[i+1]]``; null outside the edges."""
    chain = F.when(value <= F.lit(edges[0]), F.lit(None).cast("int"))
    for position, upper in enumerate(edges[1:]):
        chain = chain.when(value <= F.lit(upper), F.lit(position))
    return chain


def bin_right_closed(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    chain = F.when(value <= F.lit(edges[0]), F.lit(None).cast("string"))
    for upper, label in zip(edges[1:], labels, strict=True):
        chain = chain.when(value <= F.lit(upper), F.lit(label))
    return chain


def ordinal(value: Column, order: Sequence[str]) -> Column:
    """Position of a category in a fixed order; null when it is not listed."""
    chain = F.when(value == F.lit(order[0]), F.lit(0))
    for position, name in enumerate(order[1:], start=1):
        chain = chain.when(value == F.lit(name), F.lit(position))
    return chain


def rename_values(value: Column, names: dict[str, str]) -> Column:
    pairs = list(names.items())
    chain = F.when(value == F.lit(pairs[0][0]), F.lit(pairs[0][1]))
    for code, name in pairs[1:]:
        chain = chain.when(value == F.lit(code), F.lit(name))
    return chain


def text_or(value: Column, missing: str = "nan") -> Column:
    return F.coalesce(value.cast("string"), F.lit(missing))


def date_key(day: Column) -> Column:
    """yyyymmdd as an integer."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def weekday_from_monday(day: Column) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return F.weekday(day) + 1


def monday_week(day: Column) -> Column:
    """Week of the year counted from the first Monday; earlier days are week 0."""
    return F.floor((F.dayofyear(day) + 6 - F.weekday(day)) / 7).cast("int")


def is_weekend(day: Column) -> Column:
    return (F.weekday(day) >= 5).cast("int")


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double")) * 100


def percent_change(base: Column, other: Column) -> Column:
    return F.try_divide(other - base, base) * 100


def rate(condition: Column) -> Column:
    """Share of rows of the group that meet the condition, 0..1; null counts as not met."""
    return F.avg(F.coalesce(condition, F.lit(False)).cast("int"))


def hash_key(identity: Column, seed: int) -> Column:
    """52-bit hash of an id and a seed: exact as a double, the same in any layout."""
    digest = F.md5(F.concat_ws(":", identity.cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")


def hash_unit(identity: Column, seed: int) -> Column:
    """Uniform number in [0, 1) drawn from the hash of an id."""
    return hash_key(identity, seed) / F.lit(float(2**52))
