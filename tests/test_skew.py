"""Plans that must hold when one key has a large share of all rows."""

from __future__ import annotations

from contextlib import ExitStack

import pytest
from pyspark.sql import functions as F

from strata.operators import marts, refine
from strata.session import fits_broadcast, overriding


@pytest.fixture()
def small_partitions(spark):
    """Settings under which a few hundred kilobytes count as skewed, and nothing is broadcast."""
    settings = {
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    }
    with ExitStack() as stack:
        for name, value in settings.items():
            stack.enter_context(overriding(spark, name, value))
        yield


@pytest.fixture(scope="module")
def facts(spark, tmp_path_factory):
    """Every second invoice and ticket belongs to customer 1."""
    folder = str(tmp_path_factory.mktemp("skew"))
    customer = F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id") % 400).cast("string").alias("customer_id")
    spark.range(20000).repartition(8).select(
        F.col("id").cast("string").alias("invoice_id"), customer, F.sha2(F.col("id").cast("string"), 256).alias("pad"),
        F.lit("paid").alias("status"), F.lit(1).cast("decimal(18,2)").alias("amount_usd"),
        F.to_timestamp(F.lit("2024-01-01")).alias("issued_at"), F.lit("P1").alias("priority"),
    ).write.parquet(f"{folder}/invoices")
    spark.range(300).select(F.col("id").cast("string").alias("customer_id"), F.lit("NA").alias("region"),
                            F.lit("smb").alias("segment")).write.parquet(f"{folder}/customers")
    return spark.read.parquet(f"{folder}/invoices"), spark.read.parquet(f"{folder}/customers")


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    rows = df.collect()
    return df._jdf.queryExecution().executedPlan().toString(), rows


def test_a_hot_reference_is_split(facts, small_partitions):
    invoices, customers = facts
    latest = refine.latest_with_copies(invoices, ["invoice_id"], ["issued_at"])
    plan, rows = final_plan(refine.check_reference(latest, customers, "customer_id"))
    assert "skew=true" in plan
    assert len(rows) == 20000
    assert sum(r._known for r in rows) == sum(int(r.customer_id) < 300 for r in rows)


def test_a_hot_key_is_reduced_before_the_shuffle(facts):
    invoices, _ = facts
    ranked, _ = final_plan(refine.keep_latest(invoices, ["customer_id"], [F.col("invoice_id").desc()]))
    assert ranked.index("Final") < ranked.index("Exchange") < ranked.index("Partial")
    counted, rows = final_plan(refine.latest_with_copies(invoices, ["customer_id"], ["invoice_id"]))
    assert counted.index("Exchange") < counted.index("partial_max")
    assert sum(r._copies for r in rows) == 20000


def test_marts_aggregate_before_they_join(facts, small_partitions):
    invoices, customers = facts
    plan, rows = final_plan(marts.monthly_revenue(customers, invoices))
    # Below the join each side's shuffle takes partial sums or customers, never single invoices.
    assert plan.count("partial_sum") >= 2
    assert plan.index("SortMergeJoin") < plan.rindex("partial_sum")
    assert [(r.revenue_usd, r.paid_invoice_count) for r in rows] == [
        (float(c), c) for c in [invoices.where("cast(customer_id as int) < 300").count()]]
    plan, rows = final_plan(marts.ticket_summary(customers, invoices.withColumn("status", F.lit("open"))))
    assert plan.index("SortMergeJoin") < plan.rindex("partial_count")
    assert rows[0].ticket_count == invoices.where("cast(customer_id as int) < 300").count()


def test_broadcast_is_refused_for_many_rows_in_few_bytes(spark, tmp_path):
    spark.range(200_000).select(F.lit("same").alias("text")).coalesce(1).write.parquet(f"{tmp_path}/t")
    table = spark.read.parquet(f"{tmp_path}/t")
    assert fits_broadcast(table, 64 * 1024 * 1024)
    assert not fits_broadcast(table, 64 * 1024 * 1024, rows=1000)
    assert not fits_broadcast(table, 1024 * 1024)
