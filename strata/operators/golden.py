"""Expected values of the golden questions, worked out from the landed text by a second road.

Nothing here uses the typing, rule, deduplication or mart code of the refinement: where the two disagree, an
evaluation fails. Revisions with the same time are put in a total order, the same as the refinement's: by landing time
and then by the landed text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The question each fact answers.
QUESTIONS = {
    "top_region": "Which region has the highest revenue?",
    "total_revenue": "What is the total revenue?",
    "open_p1": "How many open P1 tickets are there?",
    "open_total": "How many open tickets are there in total?",
    "customers_in_segment": "How many customers are in the enterprise segment?",
    "customers": "How many customers do we have?",
    "top_billed_customer": "Which customer has been billed the most?",
}

_FACTS = """
with c as (
  select id, latest.region, latest.segment
  from (select id, max(struct(updated, landed, customer_id, full_name, email, raw_region, raw_segment, updated_at, region, segment)) as latest
        from (select upper(trim(customer_id)) as id, upper(trim(region)) as region, lower(trim(segment)) as segment,
                     try_cast(updated_at as timestamp) as updated, _ingested_at as landed, customer_id, full_name, email,
                     region as raw_region, segment as raw_segment, updated_at
              from {customers})
        where id rlike :id_format and array_contains(:regions, region) and array_contains(:segments, segment)
          and updated is not null and contains(email, '@')
        group by id)),
latest_invoice as (
  select trim(invoice_id) as invoice,
         max_by(struct(*), struct(try_cast(issued_at as timestamp), _ingested_at, invoice_id, customer_ref, amount, currency, status, issued_at)) as row
  from {invoices}
  where trim(invoice_id) != '' and try_cast(amount as decimal(18,4)) > 0
    and upper(trim(currency)) in ('USD', 'EUR', 'GBP') and lower(trim(status)) in ('paid', 'open', 'void')
    and try_cast(issued_at as timestamp) is not null
  group by trim(invoice_id)),
priced as (
  select 'C' || repeat('0', :digits - length(trim(row.customer_ref))) || trim(row.customer_ref) as id,
         lower(trim(row.status)) as status,
         round(cast(row.amount as decimal(18,4))
               * case upper(trim(row.currency)) when 'EUR' then 1.08 when 'GBP' then 1.27 else 1.00 end, 2) as usd
  from latest_invoice),
by_reference as (
  select id, sum(case when status = 'paid' then usd else 0 end) as paid,
         sum(case when status != 'void' then usd else 0 end) as billed
  from priced group by id),
per_customer as (select id, region, paid, billed from by_reference join c using (id)),
latest_ticket as (
  select trim(ticket_id) as ticket,
         max_by(struct(*), struct(try_cast(opened_at as timestamp), _ingested_at, ticket_id, customer_id, subject, priority, status, opened_at)) as row
  from {tickets}
  where trim(ticket_id) != '' and upper(trim(priority)) in ('P1', 'P2', 'P3')
    and lower(trim(status)) in ('open', 'closed', 'pending') and try_cast(opened_at as timestamp) is not null
  group by trim(ticket_id)),
open_by_customer as (
  select upper(trim(row.customer_id)) as id, count(*) as n, count_if(upper(trim(row.priority)) = 'P1') as p1
  from latest_ticket where lower(trim(row.status)) = 'open' group by 1),
t as (select coalesce(sum(n), 0) as n, coalesce(sum(p1), 0) as p1 from open_by_customer left semi join c using (id)),
region_sums as (select region, sum(paid) as paid from per_customer group by region)
select 'top_region' as fact, array(min_by(region, struct(-paid, region)), cast(cast(max(paid) as decimal(38,2)) as string)) as expected
from region_sums
union all select 'total_revenue', array(cast(cast(sum(paid) as decimal(38,2)) as string)) from region_sums
union all select 'open_p1', array(cast(p1 as string)) from t
union all select 'open_total', array(cast(n as string)) from t
union all select 'customers_in_segment', array(cast(count_if(segment = :segment) as string)) from c
union all select 'customers', array(cast(count(*) as string)) from c
union all
select 'top_billed_customer', array(min_by(id, struct(-billed, id)), cast(cast(max(billed) as decimal(38,2)) as string))
from per_customer
"""


def expected_facts(
    customers: DataFrame,
    invoices: DataFrame,
    tickets: DataFrame,
    digits: int,
    regions: Sequence[str],
    segments: Sequence[str],
    segment: str = "enterprise",
) -> DataFrame:
    """(fact, expected): the seven facts as arrays of strings, amounts with two decimals, from landed extracts."""
    parameters = {
        "id_format": f"^C[0-9]{{{digits}}}$",
        "digits": digits,
        "regions": F.array(*map(F.lit, regions)),
        "segments": F.array(*map(F.lit, segments)),
        "segment": segment,
    }
    spark = customers.sparkSession
    return spark.sql(_FACTS, args=parameters, customers=customers, invoices=invoices, tickets=tickets)


def documented_items(items: DataFrame, facts: DataFrame) -> DataFrame:
    """Golden rows of the other types from a table (id, type, question, documented, facts, expected_doc).

    ``documented`` are the values a document states, ``facts`` the names of computed facts whose values an answer must
    hold as well (``hybrid`` items); either may be NULL. Values keep their order, documented ones first. A fact that
    was not computed is an error.
    """
    asked = items.select("id", F.posexplode(F.coalesce("facts", F.array().cast("array<string>"))).alias("at", "fact"))
    found = asked.join(facts, "fact", "left").select(
        "id", "at", F.when(F.col("expected").isNull(), F.raise_error(F.concat(F.lit("no fact "), F.col("fact")))).otherwise(F.col("expected")).alias("expected")
    )
    own = found.groupBy("id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("at", "expected"))), lambda f: f.expected)).alias("computed"))
    none = F.array().cast("array<string>")
    return items.join(own, "id", "left").select(
        "id", "type", "question", F.concat(F.coalesce("documented", none), F.coalesce("computed", none)).alias("expected_values"), "expected_doc"
    )


def sql_questions(facts: DataFrame) -> DataFrame:
    """The facts as golden rows of type ``sql``."""
    text = F.create_map(*(F.lit(x) for pair in QUESTIONS.items() for x in pair))
    return facts.select(
        F.col("fact").alias("id"),
        F.lit("sql").alias("type"),
        F.element_at(text, F.col("fact")).alias("question"),
        F.col("expected").alias("expected_values"),
        F.lit(None).cast("string").alias("expected_doc"),
    )
