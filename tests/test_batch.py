from __future__ import annotations

import glob
import json
import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

import dirty
from strata.operators import refine, rules
from strata.plans import batch, entities
from strata.session import SessionNotFit, require_utc, scratch_dir
from strata.settings import Settings
from strata.sources import land
from strata.sources.tables import Store
from strata.streaming.incremental import run_incremental


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("lake"))
    paths = dirty.write_extracts(f"{folder}/raw")
    store = Store(spark, Settings(root=f"{folder}/lake"))
    log = batch.run_batch(store, paths, "first")
    return store, paths, {(e["stage"], e["table"]): e for e in log}


def values(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_every_row_is_accounted_for(lake):
    _, _, log = lake
    counts = {t: tuple(log["silver", t][c] for c in ("rows_in", "rows_out", "rows_quarantined"))
              for t in ("customers", "invoices", "tickets")}
    assert counts == {"customers": (10, 4, 4), "invoices": (13, 5, 7), "tickets": (7, 4, 2)}


def test_quarantine_names_broken_rules_and_keeps_the_text(lake):
    store, _, _ = lake
    rejects = store.read("quarantine", "invoices")
    assert {r.invoice_id: r._failed_rules for r in rejects.collect()} == dirty.INVOICE_REJECTS
    assert rejects.where("invoice_id = 'B-TEXT'").first()._raw.amount == "many"
    assert rejects.where("invoice_id = 'B-LONG-REF'").first()._raw.customer_ref == "00410"
    assert rejects.where("invoice_id is null").first()._raw._corrupt_record == "not json"
    assert {r._failed_rules for r in store.read("quarantine", "customers").collect()} == {
        "customer_id_format", "region_valid", "updated_at_valid", "email_has_at"}
    assert values(store.read("quarantine", "tickets"), "ticket_id", "_failed_rules") == [
        ("Q-PRIORITY", "priority_valid"), ("Q-STRANGER", "customer_exists")]


def test_latest_revision_is_kept_clean(lake):
    store, _, _ = lake
    customers = store.read("silver", "customers")
    assert values(customers.where("customer_id = 'C0412'"), "full_name", "email", "region") == [
        ("New Row", "new@post.test", "APAC")]
    assert customers.count() == customers.select("customer_id").distinct().count() == 4
    assert values(store.read("silver", "tickets"), "ticket_id", "status") == [
        ("Q-1", "open"), ("Q-2", "open"), ("Q-3", "closed"), ("Q-4", "closed")]


def test_bronze_keeps_everything_with_lineage(lake):
    store, _, _ = lake
    bronze = store.read("bronze", "invoices")
    assert bronze.count() == 13
    assert bronze.where("_batch_id = 'first' and _source_file like '%invoices.jsonl' and _ingested_at is not null").count() == 13


def test_gold(lake):
    store, _, _ = lake
    assert values(store.read("gold", "monthly_revenue"), "month", "region", "revenue_usd", "paid_invoice_count") == [
        ("2025-06", "EMEA", 322.21, 2), ("2025-06", "NA", 0.48, 1)]
    rows = values(store.read("gold", "customer_360"), "customer_id", "total_billed_usd", "total_paid_usd",
                  "invoice_count", F.date_format("last_invoice_at", "yyyy-MM-dd"), "open_ticket_count", "open_p1_count")
    assert rows == [
        ("C0410", 322.21, 322.21, 2, "2025-06-10", 1, 1),
        ("C0411", 0.48, 0.48, 1, "2025-06-10", 1, 0),
        ("C0412", 64.0, 0.0, 2, "2025-08-01", 0, 0),
        ("C0417", 0.0, 0.0, 0, None, 0, 0),
    ]
    assert values(store.read("gold", "ticket_summary"), "priority", "status", "segment", "ticket_count") == [
        ("P1", "closed", "midmarket", 1), ("P1", "open", "enterprise", 1), ("P2", "closed", "smb", 1),
        ("P3", "open", "smb", 1)]


def test_running_again_repeats_nothing_and_appends_to_the_log(lake):
    store, paths, _ = lake
    before = {n: values(store.read("gold", n), "*") for n in ("customer_360", "monthly_revenue", "ticket_summary")}
    tie = values(store.read("silver", "customers").where("customer_id = 'C0417'"), "full_name")
    batch.run_batch(store, paths, "second")
    assert before == {n: values(store.read("gold", n), "*") for n in before}
    assert tie == values(store.read("silver", "customers").where("customer_id = 'C0417'"), "full_name")
    assert values(store.read("ops", "pipeline_run_log").groupBy("batch_id").count(), "*") == [("first", 9), ("second", 9)]


def test_history_is_kept_when_asked_for(spark, tmp_path):
    paths = dirty.write_extracts(f"{tmp_path}/raw")
    store = Store(spark, Settings(root=f"{tmp_path}/lake"))
    for batch_id in ("one", "two"):
        batch.run_batch(store, paths, batch_id, keep_history=True)
    assert store.read("bronze", "invoices").count() == 26
    assert store.read("silver", "invoices").count() == 5
    assert store.read("silver", "invoices").where("_batch_id = 'two'").count() == 5


def test_incremental_lands_each_file_once(spark, tmp_path):
    paths = dirty.write_extracts(f"{tmp_path}/raw")
    store = Store(spark, Settings(root=f"{tmp_path}/lake"))
    run = lambda name: {(e["stage"], e["table"]): e for e in run_incremental(store, paths, f"{tmp_path}/seen", name)}
    assert run("one")["bronze", "invoices"]["rows_in"] == 13
    written = lambda: {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{tmp_path}/lake/[sgq]*/**", recursive=True)}
    before, again = written(), run("two")
    assert again["bronze", "invoices"]["rows_in"] == 0
    assert {stage for stage, _ in again} == {"bronze"} and written() == before  # silver, stage, gold, quarantine
    newer = {**dirty.INVOICES[0], "invoice_id": "B-NEW", "amount": "5.00"}
    with open(f"{paths['billing']}/more.jsonl", "w") as out:
        out.write(json.dumps(newer) + "\n")
    log = run("three")
    assert ("silver", "tickets") not in log and ("gold", "ticket_summary") not in log and ("gold", "customer_360") in log
    assert log["bronze", "invoices"]["rows_in"] == 1
    assert log["silver", "invoices"]["rows_out"] == 6
    assert store.read("bronze", "invoices").count() == 14
    assert values(store.read("quarantine", "tickets"), "ticket_id") == [("Q-PRIORITY",), ("Q-STRANGER",)]
    assert store.read("gold", "monthly_revenue").where("region = 'EMEA'").first().revenue_usd == 327.61


def test_catalog_mode(spark, tmp_path):
    spark.sql("create database if not exists strata_test")
    store = Store(spark, Settings(mode="catalog", schema="strata_test"))
    try:
        store.write(spark.range(3), "gold", "numbers")
        store.write(spark.range(2), "gold", "numbers", mode="append")
        assert store.read("gold", "numbers").count() == 5
        assert spark.table("strata_test.gold_numbers").count() == 5
    finally:
        spark.sql("drop database strata_test cascade")


def test_reordered_header_is_an_error(spark, tmp_path):
    with open(f"{tmp_path}/swapped.csv", "w") as out:
        out.write("full_name,customer_id,email,region,segment,updated_at\nAda,C0001,a@x,NA,smb,2026-01-01\n")
    with pytest.raises(Exception, match="(?i)header"):
        land.read_strings(spark, str(tmp_path), entities.CUSTOMER_COLUMNS, "csv", "b").collect()


def test_empty_extract(spark, tmp_path):
    paths = dirty.write_extracts(f"{tmp_path}/raw")
    for file in glob.glob(f"{paths['support']}/*"):
        open(file, "w").close()
    store = Store(spark, Settings(root=f"{tmp_path}/lake"))
    log = {(e["stage"], e["table"]): e for e in batch.run_batch(store, paths, "b")}
    assert log["silver", "tickets"]["rows_in"] == 0
    assert store.read("gold", "customer_360").count() == 4


def test_other_zone_is_refused(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(SessionNotFit):
            require_utc(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_scratch_folder_is_below_the_shared_one():
    def session(master, **conf):
        return SimpleNamespace(sparkContext=SimpleNamespace(master=master),
                               conf=SimpleNamespace(get=lambda key, default: conf.get("shared", default)))

    assert scratch_dir(session("yarn", shared="hdfs://x/y/"), "test").startswith("hdfs://x/y/strata-test-")
    assert "strata-test-" in scratch_dir(session("local[2]"), "test")
    with pytest.raises(SessionNotFit):
        scratch_dir(session("spark://host:7077"), "test")


def test_both_deduplications_agree_with_brute_force(spark):
    rows = [(i % 7, (i * 37) % 5 or None, i % 3, f"v{i % 11}") for i in range(300)]
    df = spark.createDataFrame(rows, "k int, at int, second int, v string").repartition(5)
    wanted = {}
    for k, *rest in rows:
        order = tuple((x is not None, x) for x in rest)
        if k not in wanted or order > wanted[k][0]:
            wanted[k] = (order, (k, *rest))
    expected = sorted(w[1] for w in wanted.values())
    ranked = refine.keep_latest(df, ["k"], [F.col("at").desc_nulls_last(), F.col("second").desc()])
    counted = refine.latest_with_copies(df, ["k"], ["at", "second"])
    assert sorted(map(tuple, ranked.collect())) == expected
    assert sorted(tuple(r)[:4] for r in counted.collect()) == expected
    assert counted.agg(F.sum("_copies")).first()[0] == 300


def test_a_null_predicate_is_a_broken_rule(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, -1), (None, 7)], "id int, n int")
    checks = {"id_known": "id is not null", "positive": "n > 0 or n > 5", "small": "n < 7"}
    good, bad = rules.split(df, checks)
    assert values(good, "id") == [(1,)]
    assert {r.id: r._failed_rules for r in bad.collect()} == {2: "positive,small", 3: "positive", None: "id_known,small"}
    assert {r.id: r._broken for r in rules.tag(df, checks).collect()} == {
        1: [], 2: ["positive", "small"], 3: ["positive"], None: ["id_known", "small"]}
    assert rules.keep_valid(df, {}).count() == 4


def test_rules_on_plain_columns_reach_the_scan(spark, tmp_path):
    spark.range(10).write.parquet(f"{tmp_path}/t")
    kept = rules.keep_valid(spark.read.parquet(f"{tmp_path}/t"), {"big": "id > 5", "even": "id % 2 = 0"})
    assert "GreaterThan(id,5)" in kept._jdf.queryExecution().executedPlan().toString()
    assert values(kept, "id") == [(6,), (8,)]


def test_one_scan_judges_rejects_and_the_rest(spark, tmp_path):
    paths = dirty.write_extracts(f"{tmp_path}/raw")
    landed = land.read_strings(spark, paths["crm"], entities.CUSTOMER_COLUMNS, "csv", "b")
    landed.unionByName(landed).write.parquet(f"{tmp_path}/bronze")
    judged = refine.clean(spark.read.parquet(f"{tmp_path}/bronze"), entities.customers())
    assert judged._jdf.queryExecution().executedPlan().toString().count("Scan parquet") == 1
    # A reject that is delivered twice is two rejects; a valid row is kept once.
    assert values(judged.groupBy("_outcome").agg(F.count("*").alias("n"), F.sum("_copies").alias("copies")), "_outcome", "n", "copies") == [
        ("rule_failed", 8, 8), ("valid", 4, 12)]
