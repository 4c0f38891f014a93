"""Odds arithmetic as columns."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_american_odds(c: Column) -> Column:
    """Displayed odds text to a signed integer: unicode dashes, ``EVEN``; zero and junk give NULL."""
    text = F.upper(F.trim(F.translate(c.cast("string"), "−–", "--")))
    number = F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("int"))
    return F.when(text.isin("EVEN", "EVENS"), F.lit(100)).otherwise(F.when(number != 0, number))


def format_american(odds: Column) -> Column:
    return F.when(odds > 0, F.concat(F.lit("+"), odds.cast("string"))).otherwise(odds.cast("string"))


def fractional_text(numerator: Column, denominator: Column) -> Column:
    shown = F.concat(numerator.cast("string"), F.lit("/"), denominator.cast("string"))
    return F.when(numerator.isNotNull() & (denominator != 0), shown)


def display_percent(c: Column) -> Column:
    return F.regexp_replace(F.trim(c.cast("string")), r"%+$", "").try_cast("double")


def american_to_decimal(odds: Column) -> Column:
    """Signed odds, or the text ``EVEN``, to decimal odds; zero gives NULL."""
    even = F.upper(F.trim(odds.cast("string"))) == "EVEN"
    value = odds.try_cast("double")
    return (F.when(even, F.lit(2.0))
            .when(value > 0, 1.0 + value / 100.0)
            .when(value < 0, 1.0 + 100.0 / F.abs(value)))


def decimal_to_american(decimal: Column) -> Column:
    return (F.when(decimal >= 2.0, 100.0 * (decimal - 1.0))
            .when(decimal > 1.0, -100.0 / (decimal - 1.0)))


def implied_probability(decimal: Column) -> Column:
    return F.when(decimal > 1.0, 1.0 / decimal)


def american_implied_probability(odds: Column) -> Column:
    return implied_probability(american_to_decimal(odds))


def devig(probability: Column, *others: Column) -> Column:
    """Proportional margin removal: this side's share of the quoted total."""
    return probability / overround(probability, *others)


def overround(*probabilities: Column) -> Column:
    return reduce(add, probabilities)


def canonical_threshold(line: Column, reject_integer_lines: bool = True) -> Column:
    """An Over ``L`` line as the smallest integer ``k`` with ``X >= k``; NULL if not priceable."""
    usable = line.isNotNull() & ~F.isnan(line) & (line >= 0) & (F.abs(line) < F.lit(float("inf")))
    if reject_integer_lines:
        usable = usable & (line != F.floor(line))
    return F.when(usable, (F.floor(line) + 1).cast("int"))
