"""The same run over growing folders: only files not seen before are landed, and only what they touch is refined."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import functions as F

from strata.operators import runlog
from strata.operators.refine import Entity
from strata.plans.batch import SOURCES, default_entities
from strata.session import require_utc, warn_without_skew_handling
from strata.sources import land
from strata.sources.tables import Store
from strata.streaming import state as st


def land_new_files(
    store: Store, folder: str, entity: Entity, fmt: str, batch_id: str, checkpoints: str
) -> int:
    """Append the rows of new files to bronze; returns how many there were.

    They are counted in bronze by their batch id, whatever number of micro-batches brought them.
    """
    rows = land.stream_strings(store.spark, folder, entity.source_columns, fmt, batch_id)
    store.append_stream(rows, "bronze", entity.name, f"{checkpoints.rstrip('/')}/{entity.name}")
    return store.read("bronze", entity.name, rows.schema).where(F.col("_batch_id") == batch_id).agg(F.count(F.lit(1))).first()[0]


def run_incremental(
    store: Store,
    folders: Mapping[str, str],
    checkpoints: str,
    batch_id: str | None = None,
    declared: Mapping[str, Entity] | None = None,
    buckets: int = st.BUCKETS,
) -> list[dict]:
    """Land what is new in the three folders and bring silver, quarantine and gold up to date.

    New rows are merged into the buckets of their keys, rows that wait for a customer are re-admitted when that customer
    arrives, and the marts' sums are changed by the difference; see ``state``. Nothing else of silver or quarantine is
    read or written. A run that finds nothing writes its log only.

    ``checkpoints`` must be a durable shared folder. A store is fed either by this function, always with the same
    ``buckets``, or by ``run_batch``: a batch overwrite of bronze would contradict what the checkpoints remember.
    """
    require_utc(store.spark)
    warn_without_skew_handling(store.spark)
    batch_id = batch_id or uuid.uuid4().hex
    declared = declared or default_entities()
    log, new = [], {}
    for source, (fmt, name) in SOURCES.items():
        new[name] = land_new_files(store, folders[source], declared[name], fmt, batch_id, checkpoints)
        log.append(runlog.entry(batch_id, "bronze", name, new[name], new[name]))
    state, arrived, touched = st.BucketedState(store, batch_id, buckets), None, []
    for name in ("customers", "invoices", "tickets"):
        waiting = arrived is not None and declared[name].reference is not None
        change = state.refine(declared[name], arrived) if new[name] or waiting else None
        if change is None:
            continue
        touched.append(name)
        log.append(runlog.entry(batch_id, "silver", name, change.rows_in, change.rows_out, change.quarantined))
        if name == "customers":
            arrived = state.arrived(change)
        else:
            state.add_up(name, change)
        change.commit()
    log += st.run_marts(state, touched)
    runlog.append(store, log)
    return log
