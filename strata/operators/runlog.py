"""Row counts of a run, taken while the rows are written, and their reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from strata.operators.refine import COPIES, ORPHAN, OUTCOME, RULE_FAILED, VALID
from strata.sources.tables import Store

LOG_SCHEMA = (
    "batch_id string, stage string, table string, rows_in bigint, rows_out bigint, rows_quarantined bigint, "
    "ts timestamp"
)


def observed_write(
    store: Store,
    df: DataFrame,
    layer: str,
    name: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    metrics: Mapping[str, Column] | None = None,
) -> dict[str, int]:
    """Write a table and return metrics of what was written, in one pass.

    The metrics sit in the write's last stage, where Spark counts each finished task once, also when executors are
    lost and tasks run again.
    """
    metrics = metrics or {"rows": F.count(F.lit(1))}
    seen = Observation()
    store.write(df.observe(seen, *(m.alias(k) for k, m in metrics.items())), layer, name, mode, partition_by)
    # A plan the optimizer proves empty observes nothing.
    found = seen.get
    return {k: found.get(k) or 0 for k in metrics}


def outcome_metrics() -> dict[str, Column]:
    """How many landed rows ended in which outcome, over the verdicts of ``refine.clean``."""
    outcome = F.col(OUTCOME)
    return {
        "rows_out": F.count_if(outcome == VALID),
        "rule_failed": F.count_if(outcome == RULE_FAILED),
        "orphans": F.count_if(outcome == ORPHAN),
        "superseded": F.sum(F.col(COPIES) - 1),
    }


def reconcile(judged: DataFrame, key: str) -> DataFrame:
    """One row: landed = out + quarantined + superseded, and as many distinct keys as rows out."""
    totals = judged.agg(
        F.sum(COPIES).alias("rows_in"),
        *(m.alias(k) for k, m in outcome_metrics().items()),
        F.count_distinct(F.when(F.col(OUTCOME) == VALID, F.col(key))).alias("distinct_keys"),
    )
    quarantined = F.col("rule_failed") + F.col("orphans")
    adds_up = F.col("rows_in") == F.col("rows_out") + quarantined + F.col("superseded")
    return totals.select(
        "rows_in",
        "rows_out",
        quarantined.alias("rows_quarantined"),
        "superseded",
        "distinct_keys",
        (adds_up & (F.col("distinct_keys") == F.col("rows_out"))).alias("balanced"),
    )


def entry(batch_id: str, stage: str, table: str, rows_in: int, rows_out: int, quarantined: int = 0) -> dict:
    return {
        "batch_id": batch_id,
        "stage": stage,
        "table": table,
        "rows_in": rows_in,
        "rows_out": rows_out,
        "rows_quarantined": quarantined,
        "ts": datetime.now(timezone.utc),
    }


def append(store: Store, entries: Sequence[dict]) -> None:
    store.write(store.spark.createDataFrame(list(entries), LOG_SCHEMA), "ops", "pipeline_run_log", mode="append")
