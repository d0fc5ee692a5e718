from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

import dirty
from strata.operators import golden, questions, refine, retrieval, scoring
from strata.plans import batch, entities
from strata.plans.published import PublishedTables, report_results
from strata.settings import Settings
from strata.sources import documents, land
from strata.sources.tables import Store

GOLDEN = "id string, type string, question string, expected_values array<string>, expected_doc string"
ITEMS = "id string, type string, question string, documented array<string>, facts array<string>, expected_doc string"
ANSWERS = "id string, question string, answer string, hit_step_limit boolean"
STEPS = "id string, step_no int, tool string, result_json string"


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    """A whole run over the small extracts and policies: golden questions routed and answered."""
    folder = str(tmp_path_factory.mktemp("eval"))
    store = Store(spark, Settings(root=f"{folder}/lake"))
    paths = dirty.write_extracts(f"{folder}/raw")
    batch.run_batch(store, paths, "b")
    raw = {n: land.read_strings(spark, paths[s], c, f, "b") for n, s, c, f in (
        ("customers", "crm", entities.CUSTOMER_COLUMNS, "csv"), ("invoices", "billing", entities.INVOICE_COLUMNS, "json"),
        ("tickets", "support", entities.TICKET_COLUMNS, "json"))}
    facts = golden.expected_facts(**raw, digits=4, regions=entities.REGIONS, segments=entities.SEGMENTS)
    hybrid = spark.createDataFrame([dirty.HYBRID_QUESTION], ITEMS)
    asked = golden.sql_questions(facts).unionByName(spark.createDataFrame(dirty.DOC_QUESTIONS, GOLDEN)).unionByName(golden.documented_items(hybrid, facts))
    documents.write_golden(asked, f"{folder}/golden")
    asked = documents.read_golden(spark, f"{folder}/golden").cache()
    texts = documents.read_documents(spark, dirty.write_policies(f"{folder}/docs"))
    index = retrieval.tfidf_index(retrieval.chunk(texts), store=store, name="policies")
    routed = questions.route(asked.select("id", "question")).cache()
    wanted = routed.where("wants_documents").select(F.col("id").alias("query_id"), F.col("question").alias("text"))
    results = report_results(PublishedTables.of_store(store))
    steps = questions.steps(routed, results, retrieval.search(index, wanted)).cache()
    return store, asked, questions.compose(routed, steps).cache(), steps


def test_expected_facts(run):
    _, asked, _, _ = run
    facts = {r.id: r.expected_values for r in asked.where("type = 'sql'").collect()}
    assert facts == {
        "top_region": ["EMEA", "322.21"], "total_revenue": ["322.69"], "open_p1": ["1"], "open_total": ["2"],
        "customers_in_segment": ["1"], "customers": ["4"], "top_billed_customer": ["C0410", "322.21"]}
    assert {r.type for r in asked.collect()} == {"sql", "doc", "hybrid", "abstain"}
    assert asked.where("id = 'h1'").first().expected_values == ["2 hours", "1"]


def test_rule_routed_answers_score_perfectly(run):
    store, asked, answers, steps = run
    items = {r.id: r for r in scoring.score_items(asked, answers, steps).collect()}
    assert len(items) == 14
    assert [i for i, r in items.items() if not r.correct] == [], items
    assert items["h1"].steps == 2
    summary = scoring.evaluate(store, asked, answers, steps, "router", {"k": 3}).first()
    assert (summary.n_questions, summary.answer_accuracy, summary.abstain_accuracy) == (14, 1.0, 1.0)
    assert (summary.hallucination_rate, summary.retrieval_hit_rate, summary.tool_error_rate) == (0.0, 1.0, 0.0)
    assert summary.run_name == "router" and summary.params == {"k": "3"}
    assert store.read("ops", "eval_rows").where(F.col("run_id") == summary.run_id).count() == 14
    scoring.evaluate(store, asked, answers, steps, "again")
    assert store.read("ops", "eval_runs").count() == 2


def test_fabricated_numbers_and_citations_are_found(run):
    _, asked, answers, steps = run
    # Answers with a number in them get a wrong one and a citation of nothing.
    wrong = F.concat(F.regexp_replace("answer", r"\d+(\.\d+)?", "8888.31"), F.lit(" [source: made_up_policy]"))
    with_steps = steps.select("id").distinct().withColumn("has", F.lit(True))
    bad = answers.join(with_steps, "id", "left").withColumn("answer", F.when(F.col("has"), wrong).otherwise(F.col("answer")))
    items = scoring.score_items(asked, bad.drop("has"), steps)
    summary = scoring.summarize(items).first()
    assert summary.hallucination_rate >= 0.8 and summary.answer_accuracy_sql < 0.2
    assert summary.abstain_accuracy == 1.0
    assert items.where(F.array_contains("ungrounded_citations", "made_up_policy")).count() == 12


def test_overconfident_answers_are_found(run):
    _, asked, answers, steps = run
    bold = answers.join(steps.select("id").distinct(), "id", "left_anti").withColumn("answer", F.lit("The answer is 42."))
    bad = answers.join(steps.select("id").distinct(), "id", "left_semi").unionByName(bold)
    summary = scoring.summarize(scoring.score_items(asked, bad, steps)).first()
    assert summary.abstain_accuracy == 0.0 and summary.hallucination_rate > 0


def test_grounding_finds_what_was_made_up(spark):
    """Answers are put together from known evidence and known inventions."""
    rng = random.Random(8)
    answers, steps, wanted = [], [], {}
    for i in range(250):
        held, docs = [], []
        for no in range(rng.randrange(4)):
            kind, number = rng.randrange(3), round(rng.random() * 500, 2)
            if kind == 0:  # a failed step is no evidence
                result = {"error": f"code {number}", "results": [{"doc_id": "lost"}]}
            elif kind == 1:
                result = {"rows": [{"v": -number if no else number, "b": True}]}
                held += [] if no else [number]
            else:
                result = {"results": [{"doc_id": f"d{no}", "text": f"says {number}\n-{number + 1000}"}]}
                held += [number, number + 1000]
                docs.append(f"d{no}")
            steps.append((str(i), no, "search_documents" if kind == 2 else "run_sql", json.dumps(result)))
        asked = round(5000 + rng.random(), 2)
        held.append(asked)
        said, numbers, cited = [], [], []
        for _ in range(rng.randrange(6)):
            pick = rng.randrange(4)
            if pick == 0:
                said.append(f"{rng.choice(held) + rng.choice([0, 0.01]):,.2f}")  # within the tolerance
            elif pick == 1:
                made_up = 900_000 + rng.randrange(9000) / 10
                said.append(f"{made_up:,.1f}")
                numbers.append(made_up)
            elif pick == 2 and docs:
                said.append(f"[source: {rng.choice(docs)}]")
            else:
                said.append("[source:7-lost]")
                cited.append("7-lost")
        answers.append((str(i), f"about {asked}?", " and ".join(said), False))
        wanted[str(i)] = (numbers, cited)
    found = scoring.grounding(spark.createDataFrame(answers, ANSWERS), spark.createDataFrame(steps, STEPS)).collect()
    assert {r.id: (r.ungrounded_numbers, r.ungrounded_citations) for r in found} == wanted
    assert all(r.hallucinated == bool(r.ungrounded_numbers or r.ungrounded_citations) for r in found)


def test_unanswered_and_null_items_are_not_correct(spark):
    asked = spark.createDataFrame([("a", "sql", "N 1?", ["1"], None), ("b", "sql", "N 2?", ["2"], "d"), ("c", "abstain", "?", [], None),
                                   ("d", "doc", "?", None, None), ("e", "abstain", "?", [], None)], GOLDEN)
    answers = spark.createDataFrame([("a", "", "It is 1", None), ("d", "", "text", False), ("e", "", None, None)], ANSWERS)
    rows = {r.id: r for r in scoring.score_items(asked, answers, spark.createDataFrame([], STEPS)).collect()}
    assert {i: r.correct for i, r in rows.items()} == {"a": True, "b": False, "c": False, "d": False, "e": False}
    assert rows["b"].answer is None and rows["b"].retrieval_hit is False and rows["b"].hallucinated is False
    assert all(r.hit_step_limit is False and r.steps == 0 and r.ungrounded_numbers == [] for r in rows.values())
    summary = scoring.summarize(scoring.score_items(asked, answers, spark.createDataFrame([], STEPS))).first()
    assert (summary.n_questions, summary.answer_accuracy, summary.abstain_accuracy) == (5, 0.2, 0.0)


@pytest.mark.parametrize("result, numbers", [
    ('{"rows":[{"n":4,"t":"fine 7"}]}', [4.0, 7.0]),
    ('{"rows":[{"n":4,"t":"bad \\q 7"}]}', None),
    ('{"rows":[{"n":4,"t":"raw\ttab 7"}]}', None),
    ('{"rows":[{"n":4', None), ("[4]", None), ("4", None), ("", None), (None, None), ('{"error":"x 4"}', None),
])
def test_unreadable_results_are_failed_steps(spark, result, numbers):
    steps = spark.createDataFrame([("a", 1, "run_sql", result)], STEPS)
    row = scoring.parse_steps(steps).first()
    assert (row.failed, row.numbers) == (numbers is None, numbers)
    items = scoring.score_items(spark.createDataFrame([("a", "sql", "?", ["4"], None)], GOLDEN),
                                spark.createDataFrame([("a", "", "It is 4", False)], ANSWERS), steps).first()
    assert (items.tool_errors, items.hallucinated) == ((1, True) if numbers is None else (0, False))


def test_narrowed_evidence(spark):
    steps = spark.createDataFrame([("1", 1, "run_sql", json.dumps(
        {"rows": [{"n": -5}], "row_count": 1, "sql": "select 9 limit 3", "results": [{"text": "in 7 days", "score": 0.5}]}))],
        STEPS)
    every = {r.number for r in scoring.evidence_numbers(steps).collect()}
    narrow = {r.number for r in scoring.evidence_numbers(steps, ["$.rows", "$.results[*].text"]).collect()}
    assert every == {-5.0, 1.0, 9.0, 3.0, 7.0, 0.5} and narrow == {-5.0, 7.0}


@pytest.mark.parametrize("answer, expected, present", [
    ("It is 1,250.00 in all", "1250", True),
    ("It is 1250.5", "1250", False),
    ("Within  45\nDays.", "45 days", True),
    ("Within 30 days", "45 days", False),
    ("C0410 leads", "c0410", True),
    ("in 21 hours", "1 hour", True),
])
def test_value_present(spark, answer, expected, present):
    df = spark.createDataFrame([(answer, expected)], "a string, e string")
    of = scoring.parsed_answer(F.lit(""), F.col("a"))
    assert df.select(scoring.value_present(of["said"], of["plain"], F.col("e"))).first()[0] is present


def test_items_without_steps_and_with_failed_steps(spark):
    asked = spark.createDataFrame([("x", "abstain", "Do 3?", [], None), ("y", "doc", "Why?", ["so"], "d1"),
                                   ("z", "sql", "N?", ["4"], None)], GOLDEN)
    answers = spark.createDataFrame([("x", "", "I cannot do 3.", False), ("y", "", "Not so.", True), ("z", "", "4", False)],
                                    ANSWERS)
    steps = spark.createDataFrame([("y", 1, "search_documents", '{"error": null}'),
                                   ("y", 2, "search_documents", '{"results": [{"doc_id": "d2"}, {"doc_id": "d1"}]}'),
                                   ("z", 1, "run_sql", '{"error": "4 went wrong"}')], STEPS)
    rows = {r.id: r for r in scoring.score_items(asked, answers, steps).collect()}
    assert (rows["x"].correct, rows["x"].steps, rows["x"].hallucinated, rows["x"].retrieval_hit) == (True, 0, False, None)
    assert (rows["y"].correct, rows["y"].tool_errors, rows["y"].hit_step_limit) == (True, 1, True)
    assert (rows["y"].retrieval_hit, rows["y"].retrieval_top1) == (True, False)
    assert (rows["z"].correct, rows["z"].hallucinated, rows["z"].tool_errors) == (True, True, 1)


def test_composed_texts(spark):
    asked = spark.createDataFrame([(i, i) for i in "abcdef"], "id string, question string")
    steps = spark.createDataFrame([
        ("a", 1, "run_sql", '{"rows": [{"region": "NA", "usd": 123456789.1234567, "n": null}], "row_count": 1}'),
        ("a", 2, "search_documents", '{"results": [{"doc_id": "d", "text": "T\\n\\nbody\\n\\nmore"}]}'),
        ("b", 1, "search_documents", '{"results": []}'),
        ("c", 1, "run_sql", '{"error": "Boom: 1"}'),
        ("d", 1, "run_sql", '{"rows": []}'),
        ("e", 1, "search_documents", '{"results": [{"doc_id": "d", "text": "no title"}]}'),
    ], STEPS)
    assert {r.id: r.answer for r in questions.compose(asked, steps).collect()} == {
        "a": "region = NA; usd = 123456789.1234567; n = None body\n\nmore [source: d]",
        "b": "No matching documents were found.",
        "c": "I could not complete a step: Boom: 1",
        "d": "I do not have enough information to answer.",
        "e": "no title [source: d]",
        "f": "I do not have enough information to answer.",
    }


def test_golden_files_may_hold_blank_lines(spark, tmp_path):
    with open(f"{tmp_path}/golden.jsonl", "w") as out:
        out.write('{"id": "a", "type": "sql", "question": "Q?", "expected_values": ["1"]}\n\n  \n')
        out.write('{"id": "b", "type": "abstain", "question": "R?", "expected_values": []}\n')
    rows = {r.id: r for r in documents.read_golden(spark, f"{tmp_path}/golden.jsonl").collect()}
    assert set(rows) == {"a", "b"} and rows["a"].expected_doc is None and rows["b"].expected_values == []


def test_documented_items_name_facts_in_order(spark):
    facts = spark.createDataFrame([("one", ["1", "a"]), ("two", ["2"])], "fact string, expected array<string>")
    items = spark.createDataFrame([("x", "hybrid", "?", ["d"], ["two", "one"], "doc"), ("y", "abstain", "?", None, None, None)], ITEMS)
    rows = {r.id: r.expected_values for r in golden.documented_items(items, facts).collect()}
    assert rows == {"x": ["d", "2", "1", "a"], "y": []}
    with pytest.raises(Exception, match="no fact three"):
        golden.documented_items(spark.createDataFrame([("x", "hybrid", "?", [], ["three"], None)], ITEMS), facts).collect()


def test_golden_ties_follow_the_refinement(spark, tmp_path):
    """Revisions of the same time with different contents: the facts agree with the marts, whichever way rows are dealt."""
    rows = [(f"C000{i % 4}", f"N{i}", f"n{i}@x", ("NA", "EMEA", "APAC")[i % 3], ("smb", "enterprise")[i % 2], "2025-01-01 00:00:00") for i in range(40)]
    bills = [(f"B{i % 9}", str(i % 4), f"{10 + i * 7 % 13}.00", ("USD", "EUR")[i % 2], ("paid", "open")[i % 3 == 0], "2025-01-02 00:00:00") for i in range(60)]
    calls = [(f"Q{i % 9}", f"C000{i % 4}", "s", f"P{1 + i % 3}", ("open", "closed")[i % 2], "2025-01-02 00:00:00") for i in range(60)]
    names = (("customers", rows, entities.CUSTOMER_COLUMNS), ("invoices", bills, entities.INVOICE_COLUMNS), ("tickets", calls, entities.TICKET_COLUMNS))
    stamped = {}
    for name, data, columns in names:
        frame = spark.createDataFrame(data, land.string_schema(columns)).repartition(5)
        stamped[name] = frame.select("*", F.lit("f").alias("_source_file"), F.timestamp_seconds(F.lit(0)).alias("_ingested_at"), F.lit("b").alias("_batch_id"))
    facts = {r.fact: r.expected for r in golden.expected_facts(**stamped, digits=4, regions=entities.REGIONS, segments=entities.SEGMENTS).collect()}
    people = refine.silver(refine.accepted(stamped["customers"], entities.customers()), entities.customers())
    of = {n: refine.silver(refine.accepted(stamped[n], e, people), e) for n, e in (("invoices", entities.invoices()), ("tickets", entities.tickets()))}
    paid = of["invoices"].where("status = 'paid'").agg(F.sum("amount_usd")).first()[0]
    assert facts["total_revenue"] == [str(paid)]
    assert facts["open_total"] == [str(of["tickets"].where("status = 'open'").count())]
    assert facts["customers_in_segment"] == [str(people.where("segment = 'enterprise'").count())]


def test_parsed_answers_are_not_read_again(spark):
    golden = spark.createDataFrame([("a", "doc", "Is 5 right?", ["7"], None), ("b", "doc", "And 6?", None, None)],
                                   "id string, type string, question string, expected_values array<string>, expected_doc string")
    answers = spark.createDataFrame([("a", "other 9?", "It is 7 [source: d1]. x3 4,000.5", False)], "id string, question string, answer string, hit_step_limit boolean")
    parsed = scoring.parse_answers(answers)
    posed = scoring.pose(golden, parsed)
    plain = scoring.pose(golden, answers)
    assert posed.columns == plain.columns and sorted(map(str, posed.collect())) == sorted(map(str, plain.collect()))
    marked = scoring.pose(golden, parsed.withColumn("stated", F.array(F.lit(42.0))))
    assert {r.id: (r.asked, r.said, r.stated) for r in marked.collect()} == {"a": ([5.0], [7.0, 4000.5], [42.0]), "b": ([6.0], [], [])}
