"""Named data-quality rules.

A rule set is an ordered mapping of rule name to SQL predicate. A predicate that is NULL counts as broken.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROKEN = "_broken"
FAILED_RULES = "_failed_rules"


def _holds(predicate: str) -> str:
    return f"coalesce({predicate}, false)"


def all_hold(rules: Mapping[str, str]) -> Column:
    """The conjunction of a rule set: true or false for every row, never NULL."""
    return F.expr(" and ".join(_holds(p) for p in rules.values()) or "true")


def broken(rules: Mapping[str, str]) -> Column:
    """The names of the rules a row breaks, in rule order, as an array."""
    names = ", ".join(f"case when not {_holds(p)} then '{name}' end" for name, p in rules.items())
    return F.expr(f"array_compact(array({names}))")


def tag(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Every row with the array of rules it breaks (empty for a valid row)."""
    return df.withColumn(BROKEN, broken(rules))


def keep_valid(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Only the rows that break no rule; the others are dropped.

    A filter drops NULL by itself, so the bare predicates are used: those on plain columns then reach the file scan.
    """
    return df.where(" and ".join(f"({p})" for p in rules.values()) or "true")


def rejects(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Only the rows that break a rule, with the comma-joined names in ``_failed_rules``."""
    return df.where(~all_hold(rules)).withColumn(FAILED_RULES, F.array_join(broken(rules), ","))


def split(df: DataFrame, rules: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    return keep_valid(df, rules), rejects(df, rules)
