"""From landed text to typed, deduplicated, reference-checked rows, with every reject explained."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions import cleaning
from strata.operators import rules as dq
from strata.session import fits_broadcast
from strata.sources.land import CORRUPT, LINEAGE

RAW = "_raw"
OUTCOME = "_outcome"
COPIES = "_copies"
KNOWN = "_known"

VALID, RULE_FAILED, ORPHAN = "valid", "rule_failed", "orphan"
#: The rule name an orphan carries.
CUSTOMER_EXISTS = "customer_exists"


@dataclass(frozen=True)
class Entity:
    """What one kind of record looks like.

    ``typed`` gives each published column as an expression over the landed strings; ``version`` is the typed column
    whose greatest value marks the latest revision of ``key``; ``reference`` is the typed column that must be found
    in the parent table.
    """

    name: str
    source_columns: tuple[str, ...]
    typed: Mapping[str, Column]
    key: str
    version: str
    rules: Mapping[str, str]
    reference: str | None = None
    derived: Mapping[str, Column] = field(default_factory=dict)

    @property
    def silver_columns(self) -> list[str]:
        return [*self.typed, *LINEAGE, *self.derived]


def standardize(landed: DataFrame, entity: Entity, carry: Sequence[str] = ()) -> DataFrame:
    """Typed columns, lineage, the landed strings as the struct ``_raw``, and the ``carry`` columns as they are."""
    landed_text = [c for c in (*entity.source_columns, CORRUPT) if c in landed.columns]
    typed = [expression.alias(name) for name, expression in entity.typed.items()]
    return landed.select(*typed, *LINEAGE, F.struct(*landed_text).alias(RAW), *carry)


def convert_currency(
    df: DataFrame,
    rates: Mapping[str, str] | DataFrame,
    amount: str = "amount",
    currency: str = "currency",
    out: str = "amount_usd",
) -> DataFrame:
    """Add ``out``: the amount in the base currency, NULL for a currency without a rate.

    ``rates`` is a constant mapping, or a table (currency, rate) with one row per currency. A table within the
    broadcast bound is broadcast; any other is joined as Spark sees fit.
    """
    if isinstance(rates, DataFrame):
        table = rates.select(F.col("currency").alias("_code"), F.col("rate").cast(cleaning.RATE).alias("_rate"))
        if fits_broadcast(table):
            table = F.broadcast(table)
        joined = df.join(table, F.col(currency) == F.col("_code"), "left")
        value = cleaning.in_base_currency(F.col(amount).cast(cleaning.AMOUNT), F.col("_rate"))
        return joined.withColumn(out, value).drop("_code", "_rate")
    rate = cleaning.rate_of(F.col(currency), rates)
    return df.withColumn(out, cleaning.in_base_currency(F.col(amount).cast(cleaning.AMOUNT), rate))


def keep_latest(
    df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column], tie_break: Sequence[str] | None = None
) -> DataFrame:
    """One row per key: the first by ``newest_first``, ties by ``tie_break`` (default: every other column).

    The rank filter becomes a group limit that each map task applies before the shuffle, so a hot key sends one row
    per task, however many revisions it has.
    """
    rest = tie_break if tie_break is not None else [c for c in df.columns if c not in keys]
    window = Window.partitionBy(*keys).orderBy(*newest_first, *(F.col(c).desc() for c in rest))
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def latest_with_copies(df: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """Like ``keep_latest``, as an aggregate that also counts each key's rows in ``_copies``.

    The row is the greatest struct of (newest columns, all other columns). That is a total order, so the result does
    not depend on how the rows are spread; partial aggregation leaves one row per key and map task.
    """
    rest = [c for c in df.columns if c not in (*keys, *newest)]
    best = df.groupBy(*keys).agg(F.max(F.struct(*newest, *rest)).alias("_best"), F.count(F.lit(1)).alias(COPIES))
    return best.select(*(F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns), COPIES)


def known(df: DataFrame, parents: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` occurs in ``parents``."""
    return df.join(parents.select(column), column, "left_semi")


def orphans(df: DataFrame, parents: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is NULL or does not occur in ``parents``."""
    return df.join(parents.select(column), column, "left_anti")


def check_reference(df: DataFrame, parents: DataFrame, column: str) -> DataFrame:
    """Every row with ``_known``, in one join instead of a semi and an anti join.

    ``parents`` must be unique on ``column`` (a silver table is). Both sides reach the join straight from their
    shuffle, which is what lets adaptive execution split a hot reference over several tasks.
    """
    keys = parents.select(F.col(column).alias("_parent"))
    joined = df.join(keys, F.col(column) == F.col("_parent"), "left")
    return joined.withColumn(KNOWN, F.col("_parent").isNotNull()).drop("_parent")


def latest_valid(landed: DataFrame, entity: Entity) -> DataFrame:
    """The latest row per key among those that break no rule, typed, with ``_raw`` and ``_copies``.

    Only the landed strings travel through the shuffle; they are typed again after it, which costs less than
    shuffling both forms.
    """
    passed = dq.keep_valid(standardize(landed, entity), entity.rules)
    candidates = passed.select(
        F.col(entity.key).alias("_key"), F.col(entity.version).alias("_version"), "_ingested_at", f"{RAW}.*",
        *(c for c in LINEAGE if c != "_ingested_at"),
    )
    latest = latest_with_copies(candidates, ["_key"], ["_version", "_ingested_at"])
    return standardize(latest, entity, carry=[COPIES])


def accepted(landed: DataFrame, entity: Entity, parents: DataFrame | None = None) -> DataFrame:
    """The latest valid row per key with its ``_outcome``: ``valid``, or ``orphan`` where its reference is unknown."""
    latest = latest_valid(landed, entity)
    if entity.reference is None:
        judged = latest.withColumn(OUTCOME, F.lit(VALID))
    else:
        judged = check_reference(latest, parents, entity.reference)
        judged = judged.withColumn(OUTCOME, F.when(F.col(KNOWN), VALID).otherwise(ORPHAN)).drop(KNOWN)
    failed_rules = F.when(F.col(OUTCOME) == ORPHAN, CUSTOMER_EXISTS)
    return judged.withColumns({dq.FAILED_RULES: failed_rules, **entity.derived})


def clean(landed: DataFrame, entity: Entity, parents: DataFrame | None = None) -> DataFrame:
    """The verdict on a landed table: one row per rule reject and one per key of the rest.

    ``_outcome`` is ``valid``, ``rule_failed`` or ``orphan``; ``_failed_rules`` names the broken rules; ``_copies``
    says how many landed rows the row stands for, so the copies of all rows add up to the landed rows.

    Rows are tagged once, in one scan. Rejects go through the deduplication with a key of their own each, by task and
    row, so they stay single rows and spread evenly; the landed strings alone are shuffled.
    """
    tagged = standardize(landed, entity).withColumn(dq.FAILED_RULES, F.array_join(dq.broken(entity.rules), ","))
    passed = F.col(dq.FAILED_RULES) == ""
    candidates = tagged.select(
        F.when(passed, F.col(entity.key)).alias("_key"), F.when(~passed, F.monotonically_increasing_id()).alias("_reject"),
        F.col(entity.version).alias("_version"), "_ingested_at", f"{RAW}.*", *(c for c in LINEAGE if c != "_ingested_at"), dq.FAILED_RULES,
    )
    latest = latest_with_copies(candidates, ["_key", "_reject"], ["_version", "_ingested_at"])
    typed = standardize(latest, entity, carry=[dq.FAILED_RULES, COPIES])
    failed = F.col(dq.FAILED_RULES) != ""
    if entity.reference is None:
        judged = typed.withColumn(OUTCOME, F.when(failed, RULE_FAILED).otherwise(VALID))
    else:
        judged = check_reference(typed, parents, entity.reference)
        judged = judged.withColumn(OUTCOME, F.when(failed, RULE_FAILED).when(F.col(KNOWN), VALID).otherwise(ORPHAN)).drop(KNOWN)
    names = F.when(F.col(OUTCOME) == ORPHAN, CUSTOMER_EXISTS).when(failed, F.col(dq.FAILED_RULES))
    return judged.withColumns({dq.FAILED_RULES: names, **entity.derived})


def silver(judged: DataFrame, entity: Entity) -> DataFrame:
    return judged.where(F.col(OUTCOME) == VALID).select(*entity.silver_columns)


def quarantine(judged: DataFrame, entity: Entity) -> DataFrame:
    """Rejects: the typed row, the names of the broken rules, and the text as it was landed."""
    return judged.where(F.col(OUTCOME) != VALID).select(*entity.typed, *LINEAGE, dq.FAILED_RULES, RAW)
