"""What an incremental run remembers, in buckets of keys, so that it reads and rewrites only what its new rows touch.

* ``state/<entity>``: the latest valid row of each key as landed, its outcome and how many landed rows it stands for,
  partitioned by ``_bucket``, a hash of the key. Silver and the orphans in quarantine lie in the same buckets; rule
  rejects never change and are appended to the bucket ``REJECTS`` of quarantine.
* ``parked/<entity>``: the orphans by a hash of the reference they miss. When customers arrive, their parked rows are
  looked up there and judged again; no other row of the entity is read for it. Customers never leave silver, so a row
  that was found valid needs no second look until it is replaced.
* ``sums/...``: the marts' sums by customer and group, partitioned by a hash of the customer. A run adds the difference
  between what the touched buckets hold now and what they held before, so replaced and re-admitted rows take their
  earlier share back. Latest dates cannot be subtracted; they are kept for each customer and bucket of keys, and those
  that changed are replaced.
* ``ops/state_counts``: row counts of each bucket, so that the log's totals need no scan.

Every step is written to the stage layer before a partition is replaced, and partitions are replaced as a whole when
the write commits. The number of buckets is fixed by the first run of a store.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import marts, refine, runlog
from strata.operators import rules as dq
from strata.operators.refine import COPIES, ORPHAN, OUTCOME, RAW, VALID, Entity
from strata.plans.batch import Unbalanced
from strata.sources.land import CORRUPT, LINEAGE
from strata.sources.tables import Store

BUCKETS = 64
BUCKET = "_bucket"
#: The bucket of quarantine that holds rule rejects.
REJECTS = -1
_NEW = "_new"


def bucket_of(key: Column | str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _listed(df: DataFrame, column: str = BUCKET) -> list[int]:
    """The distinct buckets of a table: one number for each bucket at most."""
    return sorted(r[0] for r in df.select(column).distinct().collect())


@dataclass
class Change:
    """What a run did to one entity: its valid rows in the touched buckets before and after, and its log counts.

    ``before`` reads the state as it was, which ``commit`` replaces.
    """

    before: DataFrame
    after: DataFrame
    commit: Callable[[], None]
    rows_in: int
    rows_out: int
    quarantined: int


class BucketedState:
    def __init__(self, store: Store, batch_id: str, buckets: int = BUCKETS):
        self.store, self.batch_id, self.buckets = store, batch_id, buckets

    # -- tables ------------------------------------------------------------------------------------------------------

    def _kept(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` as a table of the stage layer."""
        self.store.write(df, "stage", name)
        return self.store.read("stage", name, df.schema)

    def _read(self, layer: str, name: str, schema: T.StructType, buckets: Sequence[int], column: str = BUCKET) -> DataFrame:
        """The rows in some buckets; none if the table does not exist yet."""
        try:
            found = self.store.read(layer, name, schema)
        except AnalysisException as missing:
            if missing.getCondition() not in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"):
                raise
            found = self.store.spark.createDataFrame([], schema)
        return found.select(*schema.names).where(F.col(column).isin(list(buckets)))

    def _replace(self, df: DataFrame, layer: str, name: str, emptied: Sequence[int] = (), column: str = BUCKET) -> None:
        """``df`` becomes the whole content of its buckets; those in ``emptied`` get no rows and are removed."""
        self.store.replace_partitions(df, layer, name, column)
        self.store.drop_partitions(layer, name, column, emptied)

    # -- entities ----------------------------------------------------------------------------------------------------

    def refine(self, entity: Entity, arrived: DataFrame | None = None) -> Change | None:
        """Judge the landed rows of this batch, and parked rows whose customer is in ``arrived`` (customer_id)."""
        store, name, n = self.store, entity.name, self.buckets
        kinds = ", ".join(f"`{c}` string" for c in (*entity.source_columns, CORRUPT, "_source_file", "_batch_id"))
        landed = store.read("bronze", name, T._parse_datatype_string(f"{kinds}, _ingested_at timestamp"))
        landed = landed.where(F.col("_batch_id") == self.batch_id)
        tagged = refine.standardize(landed, entity).withColumn(dq.FAILED_RULES, F.array_join(dq.broken(entity.rules), ","))
        passed = F.col(dq.FAILED_RULES) == ""
        text = [c for c in (*entity.source_columns, CORRUPT) if c in landed.columns]
        rest = [*text, *(c for c in LINEAGE if c != "_ingested_at")]
        reference = F.when(passed, bucket_of(entity.reference, n)) if entity.reference else F.lit(None).cast("int")
        tagged = self._kept(tagged.select(
            F.when(passed, bucket_of(entity.key, n)).alias(BUCKET), reference.alias("_ref_bucket"), F.col(entity.key).alias("_key"),
            F.col(entity.version).alias("_version"), "_ingested_at", f"{RAW}.*", *(c for c in LINEAGE if c != "_ingested_at"), dq.FAILED_RULES,
        ), f"{name}_tagged")
        fresh = tagged.where(passed).select(
            BUCKET, "_key", "_version", "_ingested_at", *rest, F.lit(1).cast("long").alias(COPIES), F.lit(ORPHAN).alias(OUTCOME),
        )
        rejects = refine.standardize(tagged.where(~passed), entity, carry=[dq.FAILED_RULES]).select(*entity.typed, *LINEAGE, dq.FAILED_RULES, RAW)
        readmitted = self._readmitted(entity, arrived)
        # Rows for each pair of buckets at most; the bucket of rejects is NULL.
        found = tagged.groupBy(BUCKET, "_ref_bucket").agg(F.count(F.lit(1)).alias("rows")).collect()
        counts = Row(passed=sum(r.rows for r in found if r[BUCKET] is not None), rejected=sum(r.rows for r in found if r[BUCKET] is None))
        touched = sorted({*(r[BUCKET] for r in found if r[BUCKET] is not None), *(_listed(readmitted) if readmitted is not None else ())})
        if not touched and not counts.rejected:
            return None

        state_schema = fresh.schema
        old = self._read("state", name, state_schema, touched)
        both = old.withColumn(_NEW, F.lit(False)).unionByName(fresh.withColumn(_NEW, F.lit(True)))
        best = F.max(F.struct("_version", "_ingested_at", *rest, OUTCOME, _NEW)).alias("best")
        merged = both.groupBy(BUCKET, "_key").agg(best, F.sum(COPIES).alias(COPIES)).select(BUCKET, "_key", "best.*", COPIES)
        referred = {r["_ref_bucket"] for r in found if r[BUCKET] is not None}
        judged = self._kept(self._judged(entity, merged, old, referred), f"{name}_judged")
        now, held = self._counts(entity, judged, touched, counts)

        self._replace(self._valid(entity, judged), "silver", name, [b for b in touched if not now[b].valid])
        if entity.reference:
            typed = refine.standardize(judged.where(F.col(OUTCOME) == ORPHAN), entity, carry=[BUCKET]).withColumns(dict(entity.derived))
            orphans = typed.select(*entity.typed, *LINEAGE, F.lit(refine.CUSTOMER_EXISTS).alias(dq.FAILED_RULES), RAW, BUCKET)
            self._replace(orphans, "quarantine", name, [b for b in touched if not now[b].orphans])
            self._park(entity, judged, arrived)
        rejects = rejects.withColumn(BUCKET, F.lit(REJECTS))
        store.with_a_file(rejects, "quarantine", name, BUCKET)
        store.write(rejects, "quarantine", name, mode="append", partition_by=[BUCKET])
        before = self._valid(entity, old)
        after = self._read("silver", name, before.schema, touched)
        return Change(before, after, lambda: self._replace(judged.drop(_NEW), "state", name), *held)

    def _valid(self, entity: Entity, judged: DataFrame) -> DataFrame:
        typed = refine.standardize(judged.where(F.col(OUTCOME) == VALID), entity, carry=[BUCKET]).withColumns(dict(entity.derived))
        return typed.select(*entity.silver_columns, BUCKET)

    def _judged(self, entity: Entity, merged: DataFrame, old: DataFrame, referred: set[int]) -> DataFrame:
        """``merged`` with its outcomes; only new rows and orphans are looked up, in the buckets of their references:
        ``referred`` are those of the new rows, and the orphans among ``old`` add theirs."""
        if entity.reference is None:
            return merged.withColumn(OUTCOME, F.lit(VALID))
        waiting = refine.standardize(old.where(F.col(OUTCOME) != VALID), entity)
        buckets = referred | set(_listed(waiting.select(bucket_of(entity.reference, self.buckets).alias(BUCKET))))
        keys = T.StructType([T.StructField("customer_id", T.StringType()), T.StructField(BUCKET, T.IntegerType())])
        parents = self._read("silver", "customers", keys, sorted(buckets)).select(F.col("customer_id").alias("_reference"))
        asks = (F.col(OUTCOME) != VALID) | F.col(_NEW)
        # All other rows go through the same join, each with a key of its own, which spreads them.
        reference = F.when(asks, F.col(entity.reference)).otherwise(F.concat(F.lit("\0"), "_key")).alias("_reference")
        typed = refine.standardize(merged, entity, carry=["_key", "_version", BUCKET, OUTCOME, COPIES, _NEW])
        rows = typed.select(BUCKET, "_key", "_version", "_ingested_at", f"{RAW}.*", *(c for c in LINEAGE if c != "_ingested_at"), OUTCOME, COPIES, _NEW, reference)
        known = refine.check_reference(rows, parents, "_reference")
        outcome = F.when(~asks, F.col(OUTCOME)).when(F.col(refine.KNOWN), VALID).otherwise(ORPHAN)
        return known.withColumn(OUTCOME, outcome).select(*merged.columns)

    # -- parked orphans ----------------------------------------------------------------------------------------------

    _PARKED = T.StructType([T.StructField("_reference", T.StringType()), T.StructField("_key", T.StringType()), T.StructField(BUCKET, T.IntegerType()), T.StructField("_ref_bucket", T.IntegerType())])

    def _parked(self, entity: Entity, arrived: DataFrame) -> tuple[DataFrame, list[int]]:
        buckets = _listed(arrived.select(bucket_of("customer_id", self.buckets).alias("_ref_bucket")), "_ref_bucket")
        return self._read("parked", entity.name, self._PARKED, buckets, "_ref_bucket"), buckets

    def _readmitted(self, entity: Entity, arrived: DataFrame | None) -> DataFrame | None:
        if entity.reference is None or arrived is None:
            return None
        parked, _ = self._parked(entity, arrived)
        return parked.join(arrived.select(F.col("customer_id").alias("_reference")), "_reference", "left_semi")

    def _park(self, entity: Entity, judged: DataFrame, arrived: DataFrame | None) -> None:
        """Take out what was re-admitted, put in what is new; an entry whose row was replaced since is harmless."""
        if arrived is not None:
            parked, buckets = self._parked(entity, arrived)
            if buckets:
                left = parked.join(arrived.select(F.col("customer_id").alias("_reference")), "_reference", "left_anti")
                left = self._kept(left, f"{entity.name}_parked")
                self._replace(left, "parked", entity.name, sorted(set(buckets) - set(_listed(left, "_ref_bucket"))), "_ref_bucket")
        new = refine.standardize(judged.where((F.col(OUTCOME) == ORPHAN) & F.col(_NEW)), entity, carry=["_key", BUCKET])
        rows = new.select(F.col(entity.reference).alias("_reference"), "_key", BUCKET, bucket_of(entity.reference, self.buckets).alias("_ref_bucket"))
        self.store.write(rows.where("_reference is not null"), "parked", entity.name, mode="append", partition_by=["_ref_bucket"])

    # -- counts ------------------------------------------------------------------------------------------------------

    _COUNTS = "entity string, bucket int, copies bigint, valid bigint, orphans bigint"

    def _counts(self, entity: Entity, judged: DataFrame, touched: Sequence[int], counts) -> tuple[dict, tuple[int, int, int]]:
        """Check that nothing was lost, and bring the totals up to date: the touched buckets' counts, and the landed, valid
        and quarantined rows so far."""
        schema = T._parse_datatype_string(self._COUNTS)
        try:
            known = {(r.entity, r.bucket): r for r in self.store.read("ops", "state_counts").collect()}  # entities x buckets rows
        except AnalysisException:
            known = {}
        tally = [F.sum(COPIES).alias("copies"), F.count_if(F.col(OUTCOME) == VALID).alias("valid"), F.count_if(F.col(OUTCOME) == ORPHAN).alias("orphans")]
        now = {r[BUCKET]: r for r in judged.groupBy(BUCKET).agg(*tally).collect()}
        copies_before = sum(known[entity.name, b].copies for b in touched if (entity.name, b) in known)
        if sum(r.copies for r in now.values()) - copies_before != counts.passed:
            raise Unbalanced(f"{entity.name}: {counts.passed} rows passed, the state grew by another number")
        rows = {key: tuple(row) for key, row in known.items()}
        for b, r in now.items():
            rows[entity.name, b] = (entity.name, b, r.copies, r.valid, r.orphans)
        rejected = rows.get((entity.name, REJECTS), (None, None, 0, 0, 0))[2] + counts.rejected
        rows[entity.name, REJECTS] = (entity.name, REJECTS, rejected, 0, 0)
        own = [r for (e, b), r in rows.items() if e == entity.name]
        self.store.write(self.store.spark.createDataFrame(list(rows.values()), schema).coalesce(1), "ops", "state_counts")
        return now, (sum(r[2] for r in own), sum(r[3] for r in own), rejected + sum(r[4] for r in own))

    # -- marts -------------------------------------------------------------------------------------------------------

    def arrived(self, customers: Change) -> DataFrame:
        """Ids of customers that silver did not hold before."""
        new = customers.after.select("customer_id").join(customers.before.select("customer_id"), "customer_id", "left_anti")
        return self._kept(new, "arrived")

    def add_up(self, name: str, change: Change) -> None:
        """Bring the sums of an entity up to date with a change of its silver rows."""
        groups, sums = marts.sums(name)
        parts = [sign.select(*[c.alias(k) for k, c in groups.items()], *[(F.lit(factor) * c).alias(k) for k, c in sums.items()])
                 for sign, factor in ((change.after, 1), (change.before, -1))]
        delta = parts[0].unionByName(parts[1]).groupBy(*groups).agg(*[F.sum(k).alias(k) for k in sums])
        changed = " or ".join(f"{k} != 0" for k in sums)
        delta = self._kept(delta.where(changed).withColumn(BUCKET, bucket_of("customer_id", self.buckets)), f"{name}_delta")
        touched = _listed(delta)
        if touched:
            held = self._read("sums", name, delta.schema, touched)
            total = held.unionByName(delta).groupBy(*groups, BUCKET).agg(*[F.sum(k).cast(delta.schema[k].dataType).alias(k) for k in sums])
            self._replace(self._kept(total.select(*delta.columns), f"{name}_sums"), "sums", name)
        if name == "invoices":
            self._latest(change)

    def _latest(self, change: Change) -> None:
        by = lambda df, out: df.groupBy("customer_id", F.col(BUCKET).alias("of_bucket")).agg(F.max("issued_at").alias(out))
        pairs = by(change.after, "last").join(by(change.before, "earlier"), ["customer_id", "of_bucket"], "full")
        moved = pairs.where(~F.col("last").eqNullSafe(F.col("earlier"))).select("customer_id", "of_bucket", "last", bucket_of("customer_id", self.buckets).alias(BUCKET))
        moved = self._kept(moved, "latest_delta")
        touched = _listed(moved)
        if touched:
            held = self._read("sums", "latest_invoice", moved.schema, touched).join(moved, ["customer_id", "of_bucket"], "left_anti")
            self._replace(self._kept(held.unionByName(moved), "latest"), "sums", "latest_invoice")

    def table(self, name: str, schema: str) -> DataFrame:
        """All sums of a kind; none if there are none yet."""
        return self._read("sums", name, T._parse_datatype_string(f"{schema}, {BUCKET} int"), range(self.buckets))


def run_marts(state: BucketedState, touched: Sequence[str]) -> list[dict]:
    """Write the marts made of touched entities, from sums and silver customers."""
    store, log = state.store, []
    invoices = state.table("invoices", "customer_id string, month string, status string, total decimal(38,2), n bigint")
    latest = state.table("latest_invoice", "customer_id string, of_bucket int, last timestamp")
    tickets = state.table("tickets", "customer_id string, priority string, status string, n bigint")
    profile = T._parse_datatype_string(f"customer_id string, full_name string, email string, region string, segment string, {BUCKET} int")
    customers = state._read("silver", "customers", profile, range(state.buckets)).drop(BUCKET)
    made = {
        "customer_360": lambda: marts.customer_360_of_sums(customers, invoices, latest, tickets),
        "monthly_revenue": lambda: marts.monthly_revenue_of_sums(customers, invoices),
        "ticket_summary": lambda: marts.ticket_summary_of_sums(customers, tickets),
    }
    for name, inputs in marts.INPUTS.items():
        if not set(touched).isdisjoint(inputs):
            rows = runlog.observed_write(store, made[name](), "gold", name)["rows"]
            log.append(runlog.entry(state.batch_id, "gold", name, rows, rows))
    return log
