"""Columns that turn landed text into typed values."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Amounts keep four decimals until the one rounding that follows conversion.
AMOUNT = "decimal(18,4)"
RATE = "decimal(9,4)"
MONEY = "decimal(18,2)"


def code(column: str) -> Column:
    """An identifier or code: no outer spaces, upper case."""
    return F.upper(F.trim(column))


def label(column: str) -> Column:
    """A category written in lower case."""
    return F.lower(F.trim(column))


def person_name(column: str) -> Column:
    return F.initcap(F.trim(column))


def instant(column: str) -> Column:
    """A time, or NULL where the text is none (ANSI casts would end the job instead)."""
    return F.try_to_timestamp(F.col(column))


def amount(column: str) -> Column:
    return F.col(column).try_cast(AMOUNT)


def prefixed_id(column: str, prefix: str, width: int) -> Column:
    """``prefix`` and the trimmed text, zero-filled to ``width``.

    ``lpad`` cuts longer text, which would give another row's id, so such text gives NULL.
    """
    digits = F.trim(column)
    return F.when(F.length(digits) <= width, F.concat(F.lit(prefix), F.lpad(digits, width, "0")))


def in_base_currency(amount_: Column, rate: Column) -> Column:
    """One half-up rounding, after the conversion."""
    return F.round(amount_ * rate, 2).cast(MONEY)


def rate_of(currency: Column, rates: Mapping[str, str]) -> Column:
    """The rate of a currency from a literal map; NULL for a code the map does not hold."""
    pairs = [F.lit(x) if i % 2 == 0 else F.lit(x).cast(RATE) for kv in rates.items() for i, x in enumerate(kv)]
    return F.try_element_at(F.create_map(*pairs), currency)
