"""A whole run: land the extracts, refine them, build the marts, log the row counts."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import functions as F

from strata.operators import marts, refine, runlog
from strata.operators.refine import Entity
from strata.plans import entities
from strata.session import overriding, require_utc, warn_without_skew_handling
from strata.sources import land
from strata.sources.tables import Store

#: Extract name, file format and entity of each source.
SOURCES = {"crm": ("csv", "customers"), "billing": ("json", "invoices"), "support": ("json", "tickets")}


class Unbalanced(RuntimeError):
    """Landed rows and outcome rows do not add up."""


def default_entities() -> dict[str, Entity]:
    return {e.name: e for e in (entities.customers(), entities.invoices(), entities.tickets())}


def refine_entity(store: Store, entity: Entity, batch_id: str, rows_in: int) -> dict:
    """Bronze to silver and quarantine.

    The verdicts are written once, split by outcome, and both tables are copied from their own partition: the
    deduplication and the reference check run a single time, and losing executors afterwards repeats a copy only.
    """
    landed = store.read("bronze", entity.name)
    parents = store.read("silver", "customers") if entity.reference else None
    judged = refine.clean(landed, entity, parents)
    # With a file open per outcome the writer needs no sort by outcome.
    with overriding(store.spark, "spark.sql.maxConcurrentOutputFileWriters", "4"):
        seen = runlog.observed_write(
            store, judged, "stage", entity.name, partition_by=[refine.OUTCOME], metrics=runlog.outcome_metrics()
        )
    quarantined = seen["rule_failed"] + seen["orphans"]
    if rows_in != seen["rows_out"] + quarantined + seen["superseded"]:
        raise Unbalanced(f"{entity.name}: {rows_in} landed rows, outcomes {seen}")
    staged = store.read("stage", entity.name, judged.schema)
    store.write(refine.silver(staged, entity), "silver", entity.name)
    store.write(refine.quarantine(staged, entity), "quarantine", entity.name)
    return runlog.entry(batch_id, "silver", entity.name, rows_in, seen["rows_out"], quarantined)


def refine_and_model(
    store: Store, declared: Mapping[str, Entity], batch_id: str, rows_in: Mapping[str, int]
) -> list[dict]:
    """Silver, quarantine and gold from the landed tables; customers first, as the others refer to them."""
    log = [refine_entity(store, declared[n], batch_id, rows_in[n]) for n in ("customers", "invoices", "tickets")]
    make = {"customer_360": marts.customer_360, "monthly_revenue": marts.monthly_revenue, "ticket_summary": marts.ticket_summary}
    for name, inputs in marts.INPUTS.items():
        rows = runlog.observed_write(store, make[name](*(store.read("silver", n) for n in inputs)), "gold", name)["rows"]
        log.append(runlog.entry(batch_id, "gold", name, rows, rows))
    return log


def run_batch(
    store: Store,
    extracts: Mapping[str, str],
    batch_id: str | None = None,
    declared: Mapping[str, Entity] | None = None,
    keep_history: bool = False,
) -> list[dict]:
    """Run everything from the extract paths ``crm``, ``billing`` and ``support``; returns the log entries.

    Bronze holds this batch only, or every batch so far with ``keep_history``. Silver and gold are rebuilt from
    bronze and overwritten, so running again does not repeat rows.
    """
    require_utc(store.spark)
    warn_without_skew_handling(store.spark)
    batch_id = batch_id or uuid.uuid4().hex
    declared = declared or default_entities()
    log, rows_in = [], {}
    for source, (fmt, name) in SOURCES.items():
        rows = land.read_strings(store.spark, extracts[source], declared[name].source_columns, fmt, batch_id)
        landed = runlog.observed_write(store, rows, "bronze", name, mode="append" if keep_history else "overwrite")
        log.append(runlog.entry(batch_id, "bronze", name, landed["rows"], landed["rows"]))
        rows_in[name] = landed["rows"] if not keep_history else count_landed(store, name)
    log += refine_and_model(store, declared, batch_id, rows_in)
    runlog.append(store, log)
    return log


def count_landed(store: Store, name: str) -> int:
    return store.read("bronze", name).agg(F.count(F.lit(1))).first()[0]
