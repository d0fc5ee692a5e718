"""Queries over the warehouse tables: landing, rules, refinement, marts, reports; each with its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import marts, refine, rules, runlog
from strata.plans import batch, extracts, published
from strata.plans.extracts import Warehouse, table
from strata.session import scratch_dir
from strata.settings import Settings
from strata.sources import land
from strata.sources.tables import Store
from strata.streaming import incremental

ORDER_RULES = {
    "order_present": "o_orderkey is not null",
    "amount_not_null": "o_totalprice is not null",
    "amount_positive": "o_totalprice > 100000",
    "priority_valid": "o_orderpriority in ('1-URGENT', '2-HIGH', '3-MEDIUM')",
    "status_valid": "o_orderstatus in ('F', 'O')",
    "date_valid": "o_orderdate >= timestamp '1996-01-01 00:00:00'",
}


def _wall_clock(df: DataFrame) -> DataFrame:
    """Times without a zone, as the warehouse tables have them, and money as doubles."""
    casts = {"timestamp": "timestamp_ntz"}
    return df.select(*(
        F.col(n).cast(casts[t]).alias(n) if t in casts else F.col(n).cast("double").alias(n) if t.startswith("decimal")
        else F.col(n) for n, t in df.dtypes
    ))


def _without_lineage(df: DataFrame) -> DataFrame:
    return _wall_clock(df.drop(*land.LINEAGE, refine.RAW))


# -- landing ---------------------------------------------------------------------------------------------------------


def land_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = land.with_lineage(table(spark, sf_dir, "customer"), "b1")
    return rows.select(
        *(F.col(c).cast("string").alias(c) for c in ("c_custkey", "c_name", "c_mktsegment")),
        F.regexp_extract("_source_file", r"([^/]+)$", 1).alias("file_name"),
        F.col("_ingested_at").isNotNull().alias("has_time"),
        F.col("_batch_id").alias("batch_id"),
    )


MAKERS = {"crm": extracts.customer_extract, "billing": extracts.invoice_extract, "support": extracts.ticket_extract}


def _write_extracts(
    spark: SparkSession, sf_dir: str, folder: str, sources: Iterable[str] = tuple(MAKERS), portion: Column | None = None
) -> dict[str, str]:
    """The extracts as files, CSV for the CRM, JSON lines for billing and support; with ``portion`` the rows for which
    it holds, added to files that are there."""
    paths = {}
    for source in sources:
        make = MAKERS[source]
        fmt, _ = batch.SOURCES[source]
        paths[source] = f"{folder}/raw/{source}"
        # White space is part of what landing must keep.
        kept = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
        rows = make(spark, sf_dir).drop(*land.LINEAGE)
        rows = rows if portion is None else rows.where(portion)
        rows.write.format(fmt).mode("append").options(header="true", **kept).save(paths[source])
    return paths


def land_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _write_extracts(spark, sf_dir, scratch_dir(spark, "csv"), ["crm"])["crm"]
    landed = land.read_strings(spark, folder, extracts.customers().source_columns, "csv", "b1")
    return landed.select(*extracts.customers().source_columns, F.col("_batch_id").alias("batch_id"))


def land_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _write_extracts(spark, sf_dir, scratch_dir(spark, "json"), ["billing"])["billing"]
    landed = land.read_strings(spark, folder, extracts.invoices().source_columns, "json", "b1")
    return landed.select(*extracts.invoices().source_columns, F.col("_batch_id").alias("batch_id"))


def stream_land_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = Store(spark, Settings(root=scratch_dir(spark, "stream")))
    schema = table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    for _ in range(2):  # the second run finds nothing new
        store.append_stream(land.with_lineage(stream, "b1"), "bronze", "events", f"{store.settings.root}/checkpoint")
    return store.read("bronze", "events").select(*schema.names, F.col("_batch_id").alias("batch_id"))


# -- rules, deduplication, references --------------------------------------------------------------------------------


def rules_valid_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.keep_valid(table(spark, sf_dir, "orders"), ORDER_RULES).select("o_orderkey", "o_totalprice")


def rules_quarantine_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = rules.rejects(table(spark, sf_dir, "orders"), ORDER_RULES)
    return bad.select("o_orderkey", F.col(rules.FAILED_RULES).alias("failed_rules"))


def dedup_latest_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refine.keep_latest(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], [F.col("l_shipdate").desc_nulls_last()],
        tie_break=["l_partkey", "l_suppkey"],
    )


def dedup_latest_max_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = refine.latest_with_copies(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"]
    )
    return latest.withColumnRenamed(refine.COPIES, "copies")


def _orders_and_customers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return orders, table(spark, sf_dir, "customer").where("c_acctbal > 0")


def integrity_known_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refine.known(*_orders_and_customers(spark, sf_dir), "c_custkey").select("o_orderkey", "c_custkey")


def integrity_orphan_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = refine.orphans(*_orders_and_customers(spark, sf_dir), "c_custkey")
    return bad.select("o_orderkey", "c_custkey", F.lit(refine.CUSTOMER_EXISTS).alias("failed_rules"))


def refine_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _without_lineage(Warehouse(spark, sf_dir).customers)


def refine_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _without_lineage(Warehouse(spark, sf_dir).invoices)


def refine_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _without_lineage(Warehouse(spark, sf_dir).tickets)


def convert_by_rates_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order prices in the currency of the customer's nation, with one derived rate per nation."""
    rates = table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("currency"), ((F.col("n_nationkey") % 7 + 1) * F.lit(0.25)).alias("rate")
    )
    people = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation").where("n_nationkey % 5 != 0"), F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    priced = people.select("c_custkey", F.col("c_acctbal").alias("amount"), F.col("n_name").alias("currency"))
    return _wall_clock(refine.convert_currency(priced, rates))


def quarantine_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rejects of all three record kinds by name with their landed text, columns a kind lacks as NULL."""
    parts = [
        refine.quarantine(judged, entity).select(
            *dict.fromkeys(["customer_id", entity.key]), F.col(rules.FAILED_RULES).alias("failed_rules"),
            F.concat_ws("|", *[F.col(refine.RAW)[name] for name in entity.source_columns]).alias("raw"),
        )
        for entity, judged in Warehouse(spark, sf_dir).judged()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def reconcile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        runlog.reconcile(judged, entity.key).select(F.lit(entity.name).alias("entity"), "*")
        for entity, judged in Warehouse(spark, sf_dir).judged()
    ]
    return reduce(DataFrame.unionByName, parts)


# -- marts and reports -----------------------------------------------------------------------------------------------


def gold(warehouse: Warehouse) -> dict[str, Callable[[], DataFrame]]:
    """The marts by name, each planned only when it is asked for."""
    return {
        "customer_360": lambda: marts.customer_360(warehouse.customers, warehouse.invoices, warehouse.tickets),
        "monthly_revenue": lambda: marts.monthly_revenue(warehouse.customers, warehouse.invoices),
        "ticket_summary": lambda: marts.ticket_summary(warehouse.customers, warehouse.tickets),
    }


def _mart(name: str):
    return lambda spark, sf_dir: _wall_clock(gold(Warehouse(spark, sf_dir))[name]())


def publish_marts(spark: SparkSession, sf_dir: str) -> published.PublishedTables:
    return published.PublishedTables(spark, gold(Warehouse(spark, sf_dir)))


def _report(name: str, **args: object):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return published.report(publish_marts(spark, sf_dir), name, **args)

    return run


TOP_CUSTOMERS = """
    select customer_id, full_name, region, total_billed_usd, invoice_count
    from customer_360 order by total_billed_usd desc, customer_id limit 200"""
REGION_JOIN = """
    with sums as (
      select region, round(sum(revenue_usd), 2) as revenue_usd, count(distinct month) as months
      from monthly_revenue group by region)
    select c.region, c.segment, count(*) as customers, max(s.revenue_usd) as revenue_usd, max(s.months) as months
    from customer_360 c join sums s on c.region = s.region
    group by c.region, c.segment"""


def published_top_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish_marts(spark, sf_dir).query(TOP_CUSTOMERS)


def published_region_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish_marts(spark, sf_dir).query(REGION_JOIN)


# -- whole runs ------------------------------------------------------------------------------------------------------


def _declared() -> dict:
    return {e.name: e for e in (extracts.customers(), extracts.invoices(), extracts.tickets())}


def batch_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of a batch run over the extract files, run twice: the second run repeats no rows."""
    folder = scratch_dir(spark, "batch")
    store = Store(spark, Settings(root=f"{folder}/lake"))
    paths = _write_extracts(spark, sf_dir, folder)
    for batch_id in ("first", "second"):
        batch.run_batch(store, paths, batch_id, _declared())
    return store.read("ops", "pipeline_run_log").select(
        "batch_id", "stage", "table", "rows_in", "rows_out", "rows_quarantined"
    )


def incremental_monthly_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly revenue after streaming the extract files in: in two portions, and a run that finds nothing new."""
    folder = scratch_dir(spark, "incremental")
    store = Store(spark, Settings(root=f"{folder}/lake"))
    first = {"crm": F.crc32("customer_id") % 2 == 0, "billing": F.crc32("invoice_id") % 2 == 0, "support": F.crc32("ticket_id") % 2 == 0}
    for portion in (0, 1, None):
        for source, even in first.items() if portion is not None else ():
            _write_extracts(spark, sf_dir, folder, [source], even if portion == 0 else ~even)
        incremental.run_incremental(store, {s: f"{folder}/raw/{s}" for s in MAKERS}, f"{folder}/checkpoints", f"run{portion}", _declared(), buckets=16)
    return store.read("gold", "monthly_revenue")


# -- SQL counterparts ------------------------------------------------------------------------------------------------

_NOT = extracts.BROKEN


def _names(rules: dict[str, str]) -> str:
    """SQL for the names of the rules whose predicate does not hold, joined by commas."""
    cases = ", ".join(f"case when not coalesce({holds}, false) then '{name}' end" for name, holds in rules.items())
    return f"array_to_string(list_filter([{cases}], lambda x: x is not null), ',')"


# The extracts as landed (dc, di, dt), typed with the rules each row breaks (tc, ti, tt), and what remains (c, i, t).
_RAW = f"""
    dc as (
      select c_custkey, d, case when c_custkey % {_NOT["customer_id_format"]} = 0 then ' x' else ' c' end || lpad(c_custkey::varchar, 9, '0') as customer_id,
             upper(c_name) || '  ' as full_name,
             ' ' || replace(upper(c_name), '#', '.') || case when c_acctbal > 0 then '@EXAMPLE.COM ' else '' end as email,
             case when c_custkey % {_NOT["region_valid"]} = 0 then 'mars' when d = 1 then lower(r_name) else 'africa' end as region,
             case when c_custkey % {_NOT["segment_valid"]} = 0 then 'none' else c_mktsegment end || ' ' as segment,
             case when c_custkey % {_NOT["updated_at_valid"]} = 0 then 'yesterday' when d = 1 then '2024-02-01 00:00:00'
                  else '2024-01-01 00:00:00' end as updated_at
      from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey,
           (values (0), (1)) v(d)),
    di as (
      select o_orderkey, d, case when o_orderkey % {_NOT["invoice_id_present"]} = 0 then '  ' else ' INV-' || o_orderkey end as invoice_id,
             o_custkey::varchar as customer_ref,
             case when o_orderkey % {_NOT["amount_not_null"]} = 0 then 'n/a'
                  else case when o_orderkey % {_NOT["amount_positive"]} = 0 then '-' else '' end || o_totalprice end as amount,
             case o_orderkey % 4 when 0 then 'usd' when 1 then 'eur' when 2 then 'gbp' else 'xxx' end as currency,
             case when o_orderkey % {_NOT["status_valid"]} = 0 then 'lost' when d = 0 then 'OPEN' when o_orderstatus = 'F' then 'PAID'
                  when o_orderstatus = 'O' then 'Open' else 'VOID' end as status,
             case when o_orderkey % {_NOT["issued_at_valid"]} = 0 then 'soon'
                  else strftime(o_orderdate - case d when 0 then interval 1 day else interval 0 day end, '%Y-%m-%d %H:%M:%S.%f') end as issued_at
      from orders, (values (0), (1)) v(d) where d = 1 or o_orderstatus = 'P'),
    dt as (
      select event_id, d, case when event_id % {_NOT["ticket_id_present"]} = 0 then ' ' else 'T-' || event_id || ' ' end as ticket_id,
             'c' || lpad(user_id::varchar, 9, '0') as customer_id, ' ' || event_type as subject,
             case when event_id % {_NOT["priority_valid"]} = 0 then 'p9' when value > 200 then 'p1' when value > 50 then 'p2' else 'p3' end as priority,
             case when d = 0 or event_type = 'error' then 'OPEN' when event_type = 'view' then 'Pending' when event_type = 'click' then 'closed'
                  else event_type end as status,
             case when event_id % {_NOT["opened_at_valid"]} = 0 then 'later'
                  else strftime(ts - case d when 0 then interval 1 day else interval 0 day end, '%Y-%m-%d %H:%M:%S.%f') end as opened_at
      from events, (values (0), (1)) v(d) where d = 1 or event_type = 'click')"""

_LAYERS = f"""{_RAW},
    tc as (
      select *, {_names({
          "customer_id_format": "regexp_full_match(customer_id, 'C[0-9]{9}')", "region_valid": f"region in {extracts.REGIONS}",
          "segment_valid": f"segment in {extracts.SEGMENTS}", "updated_at_valid": "updated_at is not null",
          "email_has_at": "contains(email, '@')"})} as failed
      from (select d, upper(trim(customer_id)) as customer_id,
                   upper(left(trim(full_name), 1)) || lower(substr(trim(full_name), 2)) as full_name, lower(trim(email)) as email,
                   upper(trim(region)) as region, lower(trim(segment)) as segment, try_cast(updated_at as timestamp) as updated_at,
                   concat_ws('|', customer_id, full_name, email, region, segment, updated_at) as raw from dc)),
    ti as (
      select *, {_names({
          "invoice_id_present": "invoice_id != ''", "amount_not_null": "amount is not null", "amount_positive": "amount > 0",
          "currency_valid": "currency in ('USD', 'EUR', 'GBP')", "status_valid": "status in ('paid', 'open', 'void')",
          "issued_at_valid": "issued_at is not null"})} as failed
      from (select d, trim(invoice_id) as invoice_id, 'C' || lpad(trim(customer_ref), 9, '0') as customer_id,
                   try_cast(amount as decimal(18,4)) as amount, upper(currency) as currency, lower(status) as status,
                   try_cast(issued_at as timestamp) as issued_at,
                   concat_ws('|', invoice_id, customer_ref, amount, currency, status, issued_at) as raw from di)),
    tt as (
      select *, {_names({
          "ticket_id_present": "ticket_id != ''", "priority_valid": "priority in ('P1', 'P2', 'P3')",
          "status_valid": "status in ('open', 'closed', 'pending')", "opened_at_valid": "opened_at is not null"})} as failed
      from (select d, trim(ticket_id) as ticket_id, upper(customer_id) as customer_id, trim(subject) as subject,
                   upper(priority) as priority, lower(status) as status, try_cast(opened_at as timestamp) as opened_at,
                   concat_ws('|', ticket_id, customer_id, subject, priority, status, opened_at) as raw from dt)),
    c as (select * exclude (d, failed, raw) from tc where d = 1 and failed = ''),
    i as (
      select * exclude (d, failed, raw),
             round(amount * case currency when 'USD' then 1.00 when 'EUR' then 1.08 else 1.27 end::decimal(9,4), 2)::decimal(18,2) as amount_usd
      from ti where d = 1 and failed = '' and customer_id in (select customer_id from c)),
    t as (
      select * exclude (d, failed, raw) from tt where d = 1 and failed = '' and customer_id in (select customer_id from c)),
    by_i as (
      select customer_id, sum(case when status != 'void' then amount_usd else 0 end)::double as total_billed_usd,
             sum(case when status = 'paid' then amount_usd else 0 end)::double as total_paid_usd,
             count(*) as invoice_count, max(issued_at) as last_invoice_at
      from i group by customer_id),
    by_t as (
      select customer_id, count(*) filter (status = 'open') as open_ticket_count,
             count(*) filter (status = 'open' and priority = 'P1') as open_p1_count
      from t group by customer_id),
    customer_360 as (
      select customer_id, full_name, email, region, segment, coalesce(total_billed_usd, 0) as total_billed_usd,
             coalesce(total_paid_usd, 0) as total_paid_usd, coalesce(invoice_count, 0) as invoice_count,
             last_invoice_at, coalesce(open_ticket_count, 0) as open_ticket_count,
             coalesce(open_p1_count, 0) as open_p1_count
      from c left join by_i using (customer_id) left join by_t using (customer_id)),
    monthly_revenue as (
      select strftime(issued_at, '%Y-%m') as month, region, sum(amount_usd)::double as revenue_usd,
             count(*) as paid_invoice_count
      from i join c using (customer_id) where status = 'paid' group by 1, 2),
    ticket_summary as (
      select priority, status, segment, count(*) as ticket_count
      from t join c using (customer_id) group by 1, 2, 3)"""

def _count_of(entity: str, typed: str, kept: str, orphans: str) -> str:
    return f"""
      select '{entity}' as entity, count(*) as rows_in, (select count(*) from {kept}) as rows_out,
             count(*) filter (failed != '') + count(*) filter ({orphans}) as rows_quarantined,
             count(*) filter (failed = '' and d = 0) as superseded
      from {typed}"""


_ORPHAN = "d = 1 and failed = '' and customer_id not in (select customer_id from c)"
_COUNTS = f"""
    with {_LAYERS},
    counts as ({_count_of("customers", "tc", "c", "false")} union all {_count_of("invoices", "ti", "i", _ORPHAN)}
      union all {_count_of("tickets", "tt", "t", _ORPHAN)})"""

_RULE_CASES = """list_filter([
    case when not coalesce(o_orderkey is not null, false) then 'order_present' end,
    case when not coalesce(o_totalprice is not null, false) then 'amount_not_null' end,
    case when not coalesce(o_totalprice > 100000, false) then 'amount_positive' end,
    case when not coalesce(o_orderpriority in ('1-URGENT', '2-HIGH', '3-MEDIUM'), false) then 'priority_valid' end,
    case when not coalesce(o_orderstatus in ('F', 'O'), false) then 'status_valid' end,
    case when not coalesce(o_orderdate >= timestamp '1996-01-01', false) then 'date_valid' end], lambda x: x is not null)"""

_LATEST_LINES = """
    select * exclude (n) from (
      select *, row_number() over (partition by l_orderkey, l_linenumber
                                   order by l_shipdate desc nulls last, l_partkey desc, l_suppkey desc) as n
      from lineitem) where n = 1"""


def over_layers(select: str, more: str = "") -> str:
    """A query over the refined tables and marts as CTEs, with ``more`` CTEs after them."""
    return f"with {_LAYERS}{', ' if more else ''}{more} {select}"


QUERIES = {
    "land_lineage": land_lineage,
    "land_csv": land_csv,
    "land_json": land_json,
    "stream_land_events": stream_land_events,
    "rules_valid_orders": rules_valid_orders,
    "rules_quarantine_orders": rules_quarantine_orders,
    "dedup_latest_lineitem": dedup_latest_lineitem,
    "dedup_latest_max_by": dedup_latest_max_by,
    "integrity_known_orders": integrity_known_orders,
    "integrity_orphan_orders": integrity_orphan_orders,
    "refine_customers": refine_customers,
    "refine_invoices": refine_invoices,
    "refine_tickets": refine_tickets,
    "convert_by_rates_table": convert_by_rates_table,
    "quarantine_all": quarantine_all,
    "reconcile_counts": reconcile_counts,
    "mart_customer_360": _mart("customer_360"),
    "mart_monthly_revenue": _mart("monthly_revenue"),
    "mart_ticket_summary": _mart("ticket_summary"),
    "report_top_region": _report("top_region"),
    "report_total_revenue": _report("total_revenue"),
    "report_open_by_priority": _report("open_by_priority", priority="P1"),
    "report_open_total": _report("open_total"),
    "report_customers_in_segment": _report("customers_in_segment", segment="machinery"),
    "report_customers": _report("customers"),
    "report_top_billed_customer": _report("top_billed_customer"),
    "published_top_customers": published_top_customers,
    "published_region_join": published_region_join,
    "batch_run_log": batch_run_log,
    "incremental_monthly_revenue": incremental_monthly_revenue,
}

ORACLE = {
    "land_lineage": """
        select c_custkey::varchar as c_custkey, c_name, c_mktsegment, 'customer.parquet' as file_name,
               true as has_time, 'b1' as batch_id from customer""",
    "land_csv": f"with {_RAW} select * exclude (c_custkey, d), 'b1' as batch_id from dc",
    "land_json": f"with {_RAW} select * exclude (o_orderkey, d), 'b1' as batch_id from di",
    "stream_land_events": "select *, 'b1' as batch_id from events",
    "rules_valid_orders": f"select o_orderkey, o_totalprice from orders where len({_RULE_CASES}) = 0",
    "rules_quarantine_orders": f"""
        select o_orderkey, array_to_string({_RULE_CASES}, ',') as failed_rules from orders where len({_RULE_CASES}) > 0""",
    "dedup_latest_lineitem": _LATEST_LINES,
    "dedup_latest_max_by": f"""
        select l.*, copies from ({_LATEST_LINES}) l join (
          select l_orderkey, l_linenumber, count(*) as copies from lineitem group by 1, 2) n
        using (l_orderkey, l_linenumber)""",
    "integrity_known_orders": """
        select o_orderkey, o_custkey as c_custkey from orders
        where o_custkey in (select c_custkey from customer where c_acctbal > 0)""",
    "integrity_orphan_orders": """
        select o_orderkey, o_custkey as c_custkey, 'customer_exists' as failed_rules from orders
        where o_custkey not in (select c_custkey from customer where c_acctbal > 0)""",
    "refine_customers": over_layers("select * from c"),
    "refine_invoices": over_layers("""
        select invoice_id, customer_id, amount::double as amount, currency, status, issued_at,
               amount_usd::double as amount_usd from i"""),
    "refine_tickets": over_layers("select * from t"),
    "convert_by_rates_table": """
        select c_custkey, c_acctbal as amount, n_name as currency,
               round(c_acctbal::decimal(18,4) * ((n_nationkey % 7 + 1) * 0.25)::decimal(9,4), 2)::double as amount_usd
        from customer left join (select * from nation where n_nationkey % 5 != 0) on c_nationkey = n_nationkey""",
    "quarantine_all": over_layers(f"""
        select customer_id, null::varchar as invoice_id, null::varchar as ticket_id, failed as failed_rules, raw from tc where failed != ''
        union all
        select customer_id, invoice_id, null, case when failed = '' then 'customer_exists' else failed end, raw
        from ti where failed != '' or {_ORPHAN}
        union all
        select customer_id, null, ticket_id, case when failed = '' then 'customer_exists' else failed end, raw
        from tt where failed != '' or {_ORPHAN}"""),
    "reconcile_counts": f"{_COUNTS} select *, rows_out as distinct_keys, true as balanced from counts",
    "mart_customer_360": over_layers("select * from customer_360"),
    "mart_monthly_revenue": over_layers("select * from monthly_revenue"),
    "mart_ticket_summary": over_layers("select * from ticket_summary"),
    "report_top_region": over_layers("""
        select region, round(sum(revenue_usd), 2) as revenue_usd
        from monthly_revenue group by region order by revenue_usd desc, region limit 1"""),
    "report_total_revenue": over_layers("select round(sum(revenue_usd), 2) as total_revenue_usd from monthly_revenue"),
    "report_open_by_priority": over_layers("""
        select sum(ticket_count)::bigint as open_tickets from ticket_summary where status = 'open' and priority = 'P1'"""),
    "report_open_total": over_layers(
        "select sum(ticket_count)::bigint as open_tickets from ticket_summary where status = 'open'"),
    "report_customers_in_segment": over_layers(
        "select count(*) as customers from customer_360 where segment = 'machinery'"),
    "report_customers": over_layers("select count(*) as customers from customer_360"),
    "report_top_billed_customer": over_layers("""
        select customer_id, total_billed_usd from customer_360 order by total_billed_usd desc, customer_id limit 1"""),
    "published_top_customers": over_layers(TOP_CUSTOMERS),
    "published_region_join": over_layers(f"select * from ({REGION_JOIN})"),
    "batch_run_log": f"""{_COUNTS},
        gold as (
          select 'customer_360' as name, count(*) as n from customer_360
          union all select 'monthly_revenue', count(*) from monthly_revenue
          union all select 'ticket_summary', count(*) from ticket_summary),
        log as (
          select 'bronze' as stage, entity as "table", rows_in, rows_in as rows_out, 0 as rows_quarantined from counts
          union all select 'silver', entity, rows_in, rows_out, rows_quarantined from counts
          union all select 'gold', name, n, n, 0 from gold)
        select batch_id, log.* from log, (values ('first'), ('second')) v(batch_id)""",
    "incremental_monthly_revenue": over_layers("select * from monthly_revenue"),
}
