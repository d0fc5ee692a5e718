"""Scoring whole tables of answers: correctness, groundedness, abstention and retrieval.

Inputs are ``golden`` (id, type, question, expected_values, expected_doc), ``answers`` (id, question, answer,
hit_step_limit) and ``steps`` (id, step_no, tool, result_json). Golden and answers hold one row per id. Evidence is
reduced per id and value before it is joined, so an id with a large share of all steps is not gathered in one place.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions import text as tx
from strata.operators.questions import RESULT_SCHEMA, SEARCH_DOCUMENTS, has_error
from strata.sources.tables import Store

# Fixed values of the scoring rules.
TOLERANCE = 0.011
ABSTAIN_MARKERS = (
    "do not have", "don't have", "cannot", "can't", "could not", "not able", "no matching", "not allowed",
    "no information", "unable",
)
RATE_DECIMALS = 4
STEP_DECIMALS = 3


def is_abstention(answer: Column) -> Column:
    lowered = F.lower(answer)
    found = F.lit(False)
    for marker in ABSTAIN_MARKERS:
        found = found | lowered.contains(marker)
    return found


def value_present(numbers: Column, plain: Column, expected: Column) -> Column:
    """Whether an answer, given as its numbers and its collapsed text, holds an expected value: a plain number within
    the tolerance of any number in the answer, anything else as text, ignoring case and the amount of space."""
    wanted = F.get(tx.numbers(expected), F.lit(0))
    plain_number = wanted.isNotNull() & F.translate(expected, ",.", "").rlike("^[0-9]+$")
    near = F.exists(numbers, lambda n: F.abs(n - wanted) < TOLERANCE)
    return F.when(plain_number, near).otherwise(plain.contains(tx.collapse(expected)))


def parsed_answer(question: Column, answer: Column) -> dict[str, Column]:
    """What scoring needs of one answer: the numbers of its question (``asked``), its own numbers (``said``) and those
    outside citations (``stated``), its citations (``cited``) and its collapsed text (``plain``). Of NULL, nothing."""
    none = F.array().cast("array<double>")
    return {
        "asked": F.coalesce(tx.numbers(question), none),
        "said": F.coalesce(tx.numbers(answer), none),
        "stated": F.coalesce(tx.numbers(tx.without_citations(answer)), none),
        "cited": F.coalesce(tx.citations(answer), F.array().cast("array<string>")),
        "plain": tx.collapse(answer),
    }


def parse_answers(answers: DataFrame) -> DataFrame:
    """``answers`` with the columns of ``parsed_answer``; answers that are parsed already are returned as they are."""
    if "stated" in answers.columns:
        return answers
    return answers.select("*", *[c.alias(n) for n, c in parsed_answer(F.col("question"), F.col("answer")).items()])


def parsed_step(result: Column, fields: Sequence[str] | None = None) -> Column:
    """struct<failed, numbers, documents> of one step's result.

    A step failed if its result has an ``error`` or is no readable JSON object; then it holds no numbers. By default
    every leaf counts, also the echoed statement, the row count and the scores; ``fields`` narrows it to JSON paths
    such as ``$.rows`` and ``$.results[*].text``. ``documents`` are the ids of the search results in order.
    """
    every = tx.json_numbers(result)
    found = every if fields is None else F.flatten(F.array(*(
        F.coalesce(tx.json_numbers(F.concat(F.lit("["), F.get_json_object(result, f), F.lit("]"))),
                   F.array().cast("array<double>")) for f in fields)))
    failed = has_error(result) | F.json_object_keys(result).isNull() | every.isNull()
    return F.struct(
        failed.alias("failed"), F.when(~failed, found).alias("numbers"),
        F.from_json(result, RESULT_SCHEMA).results.doc_id.alias("documents"),
    )


def parse_steps(steps: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """(id, step_no, tool, failed, numbers, documents). Steps that are parsed already are returned as they are, so a
    parsed table can be stored and scored from."""
    if "failed" in steps.columns:
        return steps
    parsed = steps.select("id", "step_no", "tool", parsed_step(F.col("result_json"), fields).alias("parsed"))
    return parsed.select("id", "step_no", "tool", "parsed.*")


def evidence_numbers(steps: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """(id, number) of every number in the results of steps without error."""
    return parse_steps(steps, fields).where("not failed").select("id", F.explode("numbers").alias("number"))


def _bucket(number: Column) -> Column:
    # A double, as numbers can exceed every integer type. Two numbers within the tolerance are at most one bucket apart.
    return F.rint(number / F.lit(TOLERANCE))


def _claim(number: Column | None = None, doc_id: Column | None = None) -> Column:
    """A number or a document as one kind of row: its bucket and the number, or its id."""
    none, nowhere = F.lit(None).cast("double"), F.lit("")
    if doc_id is not None:
        return F.struct(F.lit(0.0).alias("bucket"), doc_id.alias("doc_id"), none.alias("number"))
    return F.struct(_bucket(number).alias("bucket"), nowhere.alias("doc_id"), number.alias("number"))


def grounding(answers: DataFrame, steps: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """(id, ungrounded_numbers, ungrounded_citations, hallucinated) for every answer: the numbers it states, outside
    citations, that neither its steps nor its question hold within the tolerance, and the documents it cites that no
    step returned; both in order and with repeats.

    Numbers and documents go through one join. Of all evidence in one bucket only the least and the greatest number
    matter: within a bucket both are near enough, and from a neighbouring bucket the nearer end decides. So an id with
    a large share of all steps is reduced before it is joined.
    """
    answers, steps = parse_answers(answers), parse_steps(steps, fields)
    held = F.concat(
        F.transform(F.coalesce("numbers", F.array().cast("array<double>")), lambda n: _claim(n)),
        F.transform(F.filter(F.coalesce("documents", F.array().cast("array<string>")), lambda d: d.isNotNull()), lambda d: _claim(doc_id=d)),
    )
    evidence = (
        steps.where("not failed").select("id", F.inline(held))
        .unionByName(answers.select("id", F.inline(F.transform("asked", lambda n: _claim(n)))))
        .groupBy("id", "bucket", "doc_id").agg(F.min("number").alias("least"), F.max("number").alias("greatest"))
    )

    def probe(claim: Column, at: Column, shift: int = 0) -> Column:
        return F.struct((claim.bucket + shift).alias("bucket"), claim.doc_id.alias("doc_id"), claim.number.alias("number"), at.alias("at"))

    numbers = F.flatten(F.transform("stated", lambda n, i: F.array(*(probe(_claim(n), i, shift) for shift in (-1, 0, 1)))))
    citations = F.transform("cited", lambda d, i: probe(_claim(doc_id=d), i))
    near = (F.abs(F.col("number") - F.col("least")) < TOLERANCE) | (F.abs(F.col("number") - F.col("greatest")) < TOLERANCE)
    found = F.when(F.col("number").isNull(), F.col("e.id").isNotNull()).otherwise(F.coalesce(near, F.lit(False)))
    claims = answers.select("id", F.inline(F.concat(numbers, citations)))
    judged = (
        claims.join(evidence.alias("e"), ["id", "bucket", "doc_id"], "left")
        .groupBy("id", "number", "doc_id", "at").agg(F.max(found).alias("grounded"))
    )
    claim = F.when(~F.col("grounded"), F.struct("at", "number", "doc_id"))
    bad = judged.groupBy("id").agg(F.array_sort(F.collect_list(claim)).alias("bad"))
    every = answers.select("id").join(bad, "id", "left").withColumn("bad", F.coalesce("bad", F.array().cast("array<struct<at:int,number:double,doc_id:string>>")))
    return every.select(
        "id",
        F.transform(F.filter("bad", lambda c: c.number.isNotNull()), lambda c: c.number).alias("ungrounded_numbers"),
        F.transform(F.filter("bad", lambda c: c.number.isNull()), lambda c: c.doc_id).alias("ungrounded_citations"),
        (F.size("bad") > 0).alias("hallucinated"),
    )


def retrieved(steps: DataFrame) -> DataFrame:
    """(id, step_no, rank, doc_id) of every document the search steps returned, in the order they came."""
    searches = parse_steps(steps).where(F.col("tool") == SEARCH_DOCUMENTS)
    return searches.select("id", "step_no", F.posexplode("documents").alias("rank", "doc_id"))


def retrieval(golden: DataFrame, steps: DataFrame) -> DataFrame:
    """(id, retrieval_hit, retrieval_top1) for the golden items with an expected document."""
    found = retrieved(steps)
    first = found.groupBy("id").agg(F.min(F.struct("step_no", "rank", "doc_id")).alias("first"))
    distinct = found.select("id", F.col("doc_id").alias("expected_doc")).distinct().withColumn("hit", F.lit(True))
    wanted = golden.where("expected_doc is not null and expected_doc != ''").select("id", "expected_doc")
    return wanted.join(distinct, ["id", "expected_doc"], "left").join(first, "id", "left").select(
        "id",
        F.coalesce("hit", F.lit(False)).alias("retrieval_hit"),
        F.coalesce(F.col("first.doc_id") == F.col("expected_doc"), F.lit(False)).alias("retrieval_top1"),
    )


def pose(golden: DataFrame, answers: DataFrame) -> DataFrame:
    """Every golden item with its answer, parsed; an unanswered item has a NULL answer.

    Of answers that are parsed already, what was read in the answer is taken over; the question is the golden item's.
    """
    if "stated" not in answers.columns:
        return parse_answers(golden.join(answers.select("id", "answer", "hit_step_limit"), "id", "left"))
    read = {n: c for n, c in parsed_answer(F.col("question"), F.lit(None).cast("string")).items() if n != "asked"}
    posed = golden.join(answers.select("id", "answer", "hit_step_limit", *read), "id", "left")
    asked = parsed_answer(F.col("question"), F.col("answer"))["asked"].alias("asked")
    return posed.select(*golden.columns, "answer", "hit_step_limit", asked, *[F.coalesce(n, c).alias(n) for n, c in read.items()])


def score_posed(posed: DataFrame, steps: DataFrame) -> DataFrame:
    """One scored row per posed item, from parsed answers and steps. An unanswered item is not correct, and no flag
    but those of retrieval, which only items with an expected document have, is NULL."""
    counts = steps.groupBy("id").agg(F.count(F.lit(1)).alias("steps"), F.count_if("failed").alias("tool_errors"))
    joined = (
        posed.join(counts, "id", "left")
        .join(grounding(posed, steps), "id")
        .join(retrieval(posed, steps), "id", "left")
    )
    abstained = is_abstention(F.col("answer")) & (F.size("ungrounded_numbers") == 0)
    all_present = F.forall("expected_values", lambda v: value_present(F.col("said"), F.col("plain"), v))
    correct = F.when(F.col("type") == "abstain", abstained).otherwise(all_present)
    return joined.select(
        "id",
        "type",
        "question",
        "answer",
        F.coalesce("steps", F.lit(0)).alias("steps"),
        F.coalesce("tool_errors", F.lit(0)).alias("tool_errors"),
        "ungrounded_numbers",
        "ungrounded_citations",
        "hallucinated",
        F.coalesce("hit_step_limit", F.lit(False)).alias("hit_step_limit"),
        F.coalesce(correct & F.col("answer").isNotNull(), F.lit(False)).alias("correct"),
        "retrieval_hit",
        "retrieval_top1",
    )


def score_items(
    golden: DataFrame, answers: DataFrame, steps: DataFrame, fields: Sequence[str] | None = None
) -> DataFrame:
    """One scored row per golden item, answered or not.

    Answers and steps are used several times; where they come from costly plans, ``evaluate`` stores them parsed.
    """
    return score_posed(pose(golden, answers), parse_steps(steps, fields))


def _rate(holds: Column, subset: Column | None = None) -> Column:
    """The share of a subset's rows for which ``holds``; NULL where the subset is empty."""
    flag = holds.cast("int")
    return F.round(F.avg(flag if subset is None else F.when(subset, flag)), RATE_DECIMALS)


def summarize(items: DataFrame) -> DataFrame:
    """One row of rates over all scored items."""
    correct, kind = F.col("correct"), F.col("type")
    has_document = F.col("retrieval_hit").isNotNull()
    return items.agg(
        F.count(F.lit(1)).alias("n_questions"),
        _rate(correct).alias("answer_accuracy"),
        _rate(correct, kind == "sql").alias("answer_accuracy_sql"),
        _rate(correct, kind == "doc").alias("answer_accuracy_doc"),
        _rate(correct, kind == "hybrid").alias("answer_accuracy_hybrid"),
        _rate(correct, kind == "abstain").alias("abstain_accuracy"),
        _rate(F.col("retrieval_hit"), has_document).alias("retrieval_hit_rate"),
        _rate(F.col("retrieval_top1"), has_document).alias("retrieval_top1_rate"),
        _rate(F.col("hallucinated")).alias("hallucination_rate"),
        _rate(F.col("tool_errors") > 0).alias("tool_error_rate"),
        F.round(F.avg("steps"), STEP_DECIMALS).alias("avg_steps"),
    )


def evaluate(
    store: Store,
    golden: DataFrame,
    answers: DataFrame,
    steps: DataFrame,
    run_name: str,
    params: Mapping[str, str] | None = None,
) -> DataFrame:
    """Score a run, append the scored rows to ``ops.eval_rows`` and the summary, with the run's name and parameters,
    to ``ops.eval_runs``; returns the summary row.

    Steps and posed answers are parsed once, into stage tables, and scored from there.
    """
    run_id = uuid.uuid4().hex

    def kept(df: DataFrame, layer: str, name: str) -> DataFrame:
        mine = df.withColumn("run_id", F.lit(run_id))
        store.write(mine, layer, name, "append", partition_by=["run_id"])
        return store.read(layer, name, mine.schema).where(F.col("run_id") == run_id)

    parsed = kept(parse_steps(steps), "stage", "eval_steps").drop("run_id")
    posed = kept(pose(golden, answers), "stage", "eval_answers").drop("run_id")
    items = kept(score_posed(posed, parsed), "ops", "eval_rows")
    named = [x for k, v in (params or {}).items() for x in (F.lit(k), F.lit(str(v)))]
    summary = summarize(items).select(
        F.lit(run_id).alias("run_id"),
        F.lit(run_name).alias("run_name"),
        F.lit(datetime.now(timezone.utc)).alias("ts"),
        (F.create_map(*named) if named else F.create_map()).cast("map<string,string>").alias("params"),
        "*",
    )
    store.write(summary, "ops", "eval_runs", "append")
    return store.read("ops", "eval_runs").where(F.col("run_id") == run_id)
