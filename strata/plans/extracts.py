"""The warehouse tables in the shape of the three source extracts.

Customers, orders and events are rewritten as untidy text: padded, wrongly cased, delivered more than once, some
pointing to customers that are themselves rejected. Every rule is broken by the rows whose key is a multiple of the
rule's number in ``BROKEN``, so that some rows break several. Every row of a table is used.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import refine
from strata.operators.refine import Entity
from strata.plans import entities
from strata.sources.land import with_lineage

ID_DIGITS = 9
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
SEGMENTS = ("automobile", "building", "furniture", "household", "machinery")
BATCH = "warehouse"
#: Rows whose key is divisible by the number break the rule.
BROKEN = {
    "customer_id_format": 29, "region_valid": 23, "segment_valid": 19, "updated_at_valid": 17,
    "invoice_id_present": 31, "amount_not_null": 29, "amount_positive": 23, "status_valid": 19, "issued_at_valid": 17,
    "ticket_id_present": 31, "priority_valid": 23, "opened_at_valid": 17,
}
TEXT_TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text_id(key: str) -> Column:
    return F.lpad(F.col(key).cast("string"), ID_DIGITS, "0")


def _broken(key: str, rule: str, instead: str, otherwise: Column) -> Column:
    return F.when(F.col(key) % BROKEN[rule] == 0, instead).otherwise(otherwise)


def _deliveries(again: Column) -> Column:
    """Delivery numbers of a row: 0 is the older one, sent only where ``again`` holds, 1 the current one."""
    return F.explode(F.when(again, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1)))).alias("delivery")


def customer_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer twice, the older revision with another region; no ``@`` where the balance is not positive."""
    places = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    rows = with_lineage(table(spark, sf_dir, "customer"), BATCH)
    rows = rows.join(places.select("n_nationkey", "r_name"), F.col("c_nationkey") == F.col("n_nationkey"))
    current = F.col("delivery") == 1
    host = F.when(F.col("c_acctbal") > 0, "@EXAMPLE.COM ").otherwise("")
    return rows.select("*", _deliveries(F.lit(True))).select(
        F.concat(_broken("c_custkey", "customer_id_format", " x", F.lit(" c")), _text_id("c_custkey")).alias("customer_id"),
        F.concat(F.upper("c_name"), F.lit("  ")).alias("full_name"),
        F.concat(F.lit(" "), F.translate(F.upper("c_name"), "#", "."), host).alias("email"),
        _broken("c_custkey", "region_valid", "mars", F.when(current, F.lower("r_name")).otherwise("africa")).alias("region"),
        _broken("c_custkey", "segment_valid", "none ", F.concat(F.col("c_mktsegment"), F.lit(" "))).alias("segment"),
        _broken("c_custkey", "updated_at_valid", "yesterday",
                F.when(current, "2024-02-01 00:00:00").otherwise("2024-01-01 00:00:00")).alias("updated_at"),
        "_source_file", "_ingested_at", "_batch_id",
    )


def invoice_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as invoices; pending ones were delivered a day earlier as open. A quarter has an unknown currency."""
    rows = with_lineage(table(spark, sf_dir, "orders"), BATCH)
    status = F.col("o_orderstatus")
    older = F.col("delivery") == 0
    issued = F.when(older, F.col("o_orderdate") - F.expr("interval 1 day")).otherwise(F.col("o_orderdate"))
    codes = F.array(*(F.lit(c) for c in ("usd", "eur", "gbp", "xxx")))
    return rows.select("*", _deliveries(status == "P")).select(
        _broken("o_orderkey", "invoice_id_present", "  ",
                F.concat(F.lit(" INV-"), F.col("o_orderkey").cast("string"))).alias("invoice_id"),
        F.col("o_custkey").cast("string").alias("customer_ref"),
        F.when(F.col("o_orderkey") % BROKEN["amount_not_null"] == 0, "n/a").otherwise(F.concat(
            _broken("o_orderkey", "amount_positive", "-", F.lit("")), F.col("o_totalprice").cast("string"))).alias("amount"),
        F.get(codes, F.pmod(F.col("o_orderkey"), F.lit(4)).cast("int")).alias("currency"),
        _broken("o_orderkey", "status_valid", "lost", F.when(older, "OPEN").when(status == "F", "PAID").when(status == "O", "Open")
                .when(status == "P", "VOID").otherwise(status)).alias("status"),
        _broken("o_orderkey", "issued_at_valid", "soon", F.date_format(issued, TEXT_TIME)).alias("issued_at"),
        "_source_file", "_ingested_at", "_batch_id",
    )


def ticket_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as tickets; a closed ticket was delivered a day earlier as open. Sign-ups and purchases are no tickets
    and break the status rule."""
    rows = with_lineage(table(spark, sf_dir, "events"), BATCH)
    kind, value = F.col("event_type"), F.col("value")
    older = F.col("delivery") == 0
    opened = F.when(older, F.col("ts") - F.expr("interval 1 day")).otherwise(F.col("ts"))
    return rows.select("*", _deliveries(kind == "click")).select(
        _broken("event_id", "ticket_id_present", " ", F.concat(F.lit("T-"), F.col("event_id").cast("string"), F.lit(" "))).alias("ticket_id"),
        F.concat(F.lit("c"), _text_id("user_id")).alias("customer_id"),
        F.concat(F.lit(" "), kind).alias("subject"),
        _broken("event_id", "priority_valid", "p9", F.when(value > 200, "p1").when(value > 50, "p2").otherwise("p3")).alias("priority"),
        F.when(older | (kind == "error"), "OPEN").when(kind == "view", "Pending").when(kind == "click", "closed")
        .otherwise(kind).alias("status"),
        _broken("event_id", "opened_at_valid", "later", F.date_format(opened, TEXT_TIME)).alias("opened_at"),
        "_source_file", "_ingested_at", "_batch_id",
    )


def customers() -> Entity:
    return entities.customers(ID_DIGITS, REGIONS, SEGMENTS)


def invoices() -> Entity:
    return entities.invoices(ID_DIGITS)


def tickets() -> Entity:
    return entities.tickets()


class Warehouse:
    """The refined tables of one folder, each planned once however many queries use it."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    @cached_property
    def customer_extract(self) -> DataFrame:
        return customer_extract(self.spark, self.sf_dir)

    @cached_property
    def invoice_extract(self) -> DataFrame:
        return invoice_extract(self.spark, self.sf_dir)

    @cached_property
    def ticket_extract(self) -> DataFrame:
        return ticket_extract(self.spark, self.sf_dir)

    @cached_property
    def customers(self) -> DataFrame:
        entity = customers()
        return refine.silver(refine.accepted(self.customer_extract, entity), entity)

    @cached_property
    def invoices(self) -> DataFrame:
        entity = invoices()
        return refine.silver(refine.accepted(self.invoice_extract, entity, self.customers), entity)

    @cached_property
    def tickets(self) -> DataFrame:
        entity = tickets()
        return refine.silver(refine.accepted(self.ticket_extract, entity, self.customers), entity)

    def judged(self) -> list[tuple[Entity, DataFrame]]:
        """Every record kind with the verdicts on all its rows."""
        return [
            (customers(), refine.clean(self.customer_extract, customers())),
            (invoices(), refine.clean(self.invoice_extract, invoices(), self.customers)),
            (tickets(), refine.clean(self.ticket_extract, tickets(), self.customers)),
        ]
