"""Quality rules whose cutoffs are chosen under control of their false rejections, in native expressions.

**Measures.** Words are what lies between ASCII white space. Per text: words, code points in words, signs of ``SIGNS``,
lines with a word that equal an earlier line, words inside windows of ``WINDOW`` words that occur twice or more in the
text (the first time included). The base rule fails texts of fewer than ``LEAST_WORDS`` words or with more than
``MOST_REPEATED`` per cent of repeated words.

**Rules.** Each rule looks at one rate, in thousandths rounded down: signs, repeated words and echoes (words equal to the
word before) per word, repeated lines per line with a word, capital letters per code point in words. It rejects what is
above its cutoff, one of ``CUTOFFS``.

**Risk control.** A stratum is a language. Its holdout are the documents labelled good that pass the base rule (ids whose
checksum reserves them for evaluation are left out). For each stratum, rule and cutoff the hypothesis "more than ``ALPHA`` /
rules of the good documents are rejected" is tested by the exact binomial tail of the rejected ones. Along the cutoffs of
a rule, from the most lenient on, testing stops at the first hypothesis that stands (fixed sequence, which needs no
further correction); over rules and strata the level ``DELTA`` is divided (Bonferroni). So with probability 1 - ``DELTA``
all rejected hypotheses are false at once, and whichever of their cutoffs are used, no stratum loses more than ``ALPHA``
of its good documents to the rules. Of a rule's certified cutoffs the one with the greatest difference between the bad
and the good share that it rejects is used, the most lenient of equals. A stratum whose holdout is too small to certify
anything has no cutoffs there, and only the base rule counts.

Counts cover all labelled documents. Defined results: a null text has no words; a null language is a stratum of its own;
repeated rows of an id are one labelled document (the least by its measures), repeated label rows count once with the
largest label; null labels and ids teach nothing; without labels only the base rule counts; an empty table gives an
empty table. Other columns are not looked at, whatever their names. Texts are read whole, in one pass. Windows are
compared by 64-bit hashes.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm import sql_parts
from strata.llm.common import held_out, spread_join, written
from strata.session import fits_broadcast

SPACES = " \t\n\x0b\x0c\r"
SIGNS = "#*$%&|<>"
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30
#: The share of good documents that the rules of a stratum may reject, and the chance that the choice breaks that bound.
ALPHA = 0.05
DELTA = 0.1
RULES = ("signs", "lines", "repeats", "echoes", "capitals")
#: Thousandths, from the most lenient on.
CUTOFFS = (4000, 3000, 2000, 1500, 1200, 1000, 900, 800, 700, 600, 500, 400, 300, 250, 200, 150, 120, 100, 80, 60, 50, 40, 30, 20, 10, 5, 0)
#: Terms of the binomial tail that are added one by one; what lies beyond is bounded by a geometric series.
TERMS = 2000
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _per_mille(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.floor(part * 1000 / whole)).otherwise(0).cast("long")


def _covered(keys: Column) -> Column:
    """Words inside windows whose key occurs twice or more; ``keys`` are the windows' keys by place."""
    placed = F.array_sort(F.transform(keys, lambda key, at: F.struct(key.alias("key"), at.alias("at"))))

    def repeated(found: Column) -> Column:
        beside = lambda s, at: F.coalesce(F.get(found, at)["key"] == s["key"], F.lit(False))
        twice = F.filter(found, lambda s, at: ((at > 0) & beside(s, at - 1)) | beside(s, at + 1))
        places = F.array_sort(F.transform(twice, lambda s: s["at"]))
        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        step = lambda acc, at: F.struct((acc["n"] + at + WINDOW - F.greatest(acc["end"], at)).alias("n"), (at + WINDOW).alias("end"))
        return F.aggregate(places, start, step, lambda acc: acc["n"])

    # Bound by a lambda, the sorted array is made once and not for each of its elements.
    folded = F.transform(F.array(placed), repeated)[0]
    return F.when(F.size(F.array_distinct(keys)) == F.size(keys), 0).otherwise(folded)


def measures(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id", "lang")) -> DataFrame:
    """The ``keep`` columns with the five counts of ``BASE``, base_failed and a rate in thousandths for each rule."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    trimmed = F.btrim(whole, F.lit(SPACES))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"[{SPACES}]+"))
    lines = F.filter(F.split(whole, "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    without = lambda chars: F.length(F.translate(whole, chars, ""))

    def of_words(w: Column) -> Column:
        n = F.size(w)
        starts = F.when(n >= WINDOW, F.sequence(F.lit(1), n - WINDOW + 1)).otherwise(F.array().cast("array<int>"))
        keys = F.transform(starts, lambda at: F.xxhash64(F.slice(w, at, WINDOW)))
        covered = F.transform(F.array(keys), _covered)[0]
        echoes = F.size(F.filter(w, lambda word, at: (at > 0) & (word == F.get(w, at - 1))))
        return F.struct(n.cast("long").alias("n_words"), covered.cast("long").alias("n_repeat_words"), echoes.cast("long").alias("echoes"))

    of_lines = lambda some: F.struct(F.size(some).cast("long").alias("lines"), (F.size(some) - F.size(F.array_distinct(some))).cast("long").alias("n_dup_lines"))
    found = docs.select(
        *[F.col(f"`{c}`").alias(c) for c in keep],
        F.transform(F.array(words), of_words)[0].alias("w"), F.transform(F.array(lines), of_lines)[0].alias("l"),
        without(SPACES).cast("long").alias("word_chars"), (F.length(whole) - without(SIGNS)).cast("long").alias("n_symbols"),
        (F.length(whole) - F.length(F.regexp_replace(whole, r"\p{Lu}+", ""))).cast("long").alias("capitals"),
    )
    n = F.col("w.n_words")
    return found.select(
        *keep, n, "word_chars", "n_symbols", "l.n_dup_lines", "w.n_repeat_words",
        ((n < LEAST_WORDS) | (100 * F.col("w.n_repeat_words") > MOST_REPEATED * n)).alias("base_failed"),
        *[_per_mille(part, of).alias(f"rate_{rule}") for rule, part, of in (
            ("signs", F.col("n_symbols"), n), ("lines", F.col("l.n_dup_lines"), F.col("l.lines")), ("repeats", F.col("w.n_repeat_words"), n),
            ("echoes", F.col("w.echoes"), n), ("capitals", F.col("capitals"), F.col("word_chars")))],
    )


def _log_factorial(n: Column) -> Column:
    """ln n! to about 1e-12, by Stirling's series at n + 9 and the product that leads there."""
    z = n + 9.0
    series = (z - 0.5) * F.ln(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * F.pow(z, F.lit(5)))
    return series - reduce(lambda a, b: a + b, [F.ln(n + float(i)) for i in range(1, 9)])


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X of n trials with chance ``p``, for k below n * p; 1 from there on.

    The terms fall from k downwards. All are added if there are at most ``TERMS``; else those beyond are replaced by the
    geometric series that bounds them, so the result is never too small.
    """
    k, n = k.cast("double"), n.cast("double")
    top = F.exp(_log_factorial(n) - _log_factorial(k) - _log_factorial(n - k) + k * math.log(p) + (n - k) * math.log1p(-p))
    odds = (1 - p) / p
    falls = lambda i: i / (n - i + 1) * odds
    least = F.greatest(k - (TERMS - 1), F.lit(1.0))
    steps = F.when(k >= 1, F.sequence(k.cast("long"), least.cast("long"), F.lit(-1).cast("long"))).otherwise(F.array().cast("array<bigint>"))
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def add(acc: Column, i: Column) -> Column:
        term = acc["term"] * falls(i.cast("double"))
        return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"))

    rest = falls(least - 1)  # zero where every term was added
    total = F.aggregate(steps, start, add, lambda acc: acc["sum"] + acc["term"] * rest / (1 - rest))
    return F.when(k < n * p, F.least(top * total, F.lit(1.0))).otherwise(1.0)


def certified(measured: DataFrame, labels: DataFrame, label: str = "quality", stratum: str = "lang", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(stratum, rule, cutoff, n, rejected, p, chosen): every tested hypothesis that was rejected, one chosen by rule."""
    marks = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max(label).alias("good"))
    rates = [f"rate_{rule}" for rule in RULES]
    passed = measured.where("not base_failed").select("doc_id", F.coalesce(F.col(stratum), F.lit("")).alias("stratum"), *rates)
    known = passed.join(marks, "doc_id").groupBy("doc_id").agg(F.min(F.struct("good", "stratum", *rates)).alias("row")).select("row.*")
    # A rate's level is the number of cutoffs that it is above: it is rejected by the last ``level`` cutoffs.
    edges = F.array(*map(F.lit, CUTOFFS))
    level = lambda rate: F.size(F.filter(edges, lambda edge: edge < F.col(rate)))
    levels = F.array(*[F.struct(F.lit(rule).alias("rule"), level(f"rate_{rule}").alias("level")) for rule in RULES])
    counted = known.select("stratum", (F.col("good") > 0).alias("good"), F.explode(levels).alias("l")).groupBy("stratum", "l.rule", "l.level").agg(
        F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
    counted = written(counted, "levels")  # strata x rules x levels rows at most
    strata = counted.where("good > 0").agg(F.count_distinct("stratum")).first()[0]
    if not strata:
        return counted.select("stratum", "rule", F.lit(0).alias("cutoff"), *[F.lit(0).cast("long").alias(c) for c in ("n", "rejected")], F.lit(0.0).alias("p"), F.lit(True).alias("chosen")).limit(0)
    steps = F.explode(F.array(*[F.struct(F.lit(i).alias("step"), F.lit(c).alias("cutoff")) for i, c in enumerate(CUTOFFS)])).alias("s")
    # At step i (cutoff number i) the rows of level len(CUTOFFS) - i and above are rejected.
    over = F.col("level") >= len(CUTOFFS) - F.col("s.step")
    tested = counted.select("*", steps).groupBy("stratum", "rule", "s.step", "s.cutoff").agg(
        F.sum("good").alias("n"), F.sum(F.when(over, F.col("good")).otherwise(0)).alias("rejected"),
        F.sum("bad").alias("n_bad"), F.sum(F.when(over, F.col("bad")).otherwise(0)).alias("caught"))
    tested = tested.withColumn("p", binomial_tail(F.col("rejected"), F.col("n"), alpha / len(RULES)))
    along = Window.partitionBy("stratum", "rule").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    proved = tested.where("n > 0").withColumn("worst", F.max("p").over(along)).where(F.col("worst") <= delta / (len(RULES) * strata))
    gain = F.coalesce(F.try_divide("caught", "n_bad"), F.lit(0.0)) - F.col("rejected") / F.col("n")
    best = F.row_number().over(Window.partitionBy("stratum", "rule").orderBy(F.round(gain, 9).desc(), "step")) == 1
    return proved.select("stratum", "rule", "cutoff", "n", "rejected", "p", best.alias("chosen"))


def verdicts(measured: DataFrame, tests: DataFrame, stratum: str = "lang") -> DataFrame:
    """``measured`` with ``kept``: false if the base failed or a rate is above the chosen cutoff of its stratum."""
    most = written(tests.where("chosen").groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == rule, F.col("cutoff"))).alias(f"cut_{rule}") for rule in RULES]), "cutoffs")
    rows = measured.withColumn("stratum", F.coalesce(F.col(stratum), F.lit("")))
    if fits_broadcast(most):
        judged = rows.join(F.broadcast(most), "stratum", "left")
    else:
        judged = spread_join(rows, most, ["stratum"], ["doc_id"], "left")
    within = [F.coalesce(F.col(f"rate_{rule}") <= F.col(f"cut_{rule}"), F.lit(True)) for rule in RULES]
    return judged.withColumn("kept", reduce(lambda a, b: a & b, within, ~F.col("base_failed"))).drop("stratum", *[f"cut_{rule}" for rule in RULES])


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the five counts, base_failed and kept for every document."""
    measured = written(measures(docs.select("doc_id", "lang", "text")), "measures")
    return verdicts(measured, certified(measured, labels)).select("doc_id", *BASE, "base_failed", "kept")


_RATES = (("signs", "n_symbols", "n_words"), ("lines", "n_dup_lines", "lines"), ("repeats", "n_repeat_words", "n_words"), ("echoes", "echoes", "n_words"), ("capitals", "capitals", "word_chars"))
ORACLE = rf"""
with {sql_parts.CRC_TABLE},
texts as (select row_number() over () as k, doc_id, coalesce(lang, '') as stratum, coalesce(text, '') as text from documents),
split as (select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as ws,
                 list_filter(string_split(text, chr(10)), lambda s: regexp_matches(s, '[^\x20\x09-\x0D]')) as ls from texts),
windows as (select k, i, list_slice(ws, i, i + {WINDOW - 1}) as w from (select k, ws, unnest(range(1, len(ws) - {WINDOW - 2})) as i from split)),
repeated as (select k, i from windows join (select k, w from windows group by 1, 2 having count(*) > 1) using (k, w)),
covered as (select k, count(distinct i + o) as n from repeated, range(0, {WINDOW}) offsets(o) group by k),
counts as (
  select s.k, doc_id, stratum, cast(len(ws) as bigint) as n_words, cast(length(array_to_string(ws, '')) as bigint) as word_chars,
         cast(length(text) - length(regexp_replace(text, '[{SIGNS}]', '', 'g')) as bigint) as n_symbols,
         cast(len(ls) - len(list_distinct(ls)) as bigint) as n_dup_lines, coalesce(c.n, 0) as n_repeat_words,
         len(ls) as lines, length(text) - length(regexp_replace(text, '\p{{Lu}}', '', 'g')) as capitals,
         len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) as echoes
  from split s left join covered c using (k)),
base as (select *, n_words < {LEAST_WORDS} or 100 * n_repeat_words > {MOST_REPEATED} * n_words as base_failed from counts),
rates as (
  {" union all ".join(f"select k, doc_id, stratum, base_failed, '{rule}' as rule, case when {whole} > 0 then (1000 * {part}) // {whole} else 0 end as rate from base" for rule, part, whole in _RATES)}),
marks as (select doc_id, max(quality) > 0 as good from labels, crc_table
          where quality is not null and {sql_parts.crc32("cast(doc_id as varchar)")} % 4 <> 2 group by doc_id),
tested as (
  select stratum, rule, cutoff, count(*) filter (good) as n, count(*) filter (good and rate > cutoff) as k, count(*) filter (not good) as n_bad,
         count(*) filter (not good and rate > cutoff) as caught
  from rates join marks using (doc_id), (select unnest({list(CUTOFFS)}) as cutoff) where not base_failed group by all having count(*) filter (good) > 0),
p_values as (
  select *, case when k >= n * {ALPHA / len(RULES)!r} then 1.0 else list_sum(list_transform(range(0, k + 1), lambda i:
              exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({ALPHA / len(RULES)!r}) + (n - i) * ln(1 - {ALPHA / len(RULES)!r})))) end as p from tested),
proved as (
  select * from (select *, max(p) over (partition by stratum, rule order by cutoff desc) as worst from p_values)
  where worst <= {DELTA / len(RULES)!r} / (select count(distinct stratum) from tested)),
chosen as (
  select stratum, rule, cutoff from proved
  qualify row_number() over (partition by stratum, rule order by round(case when n_bad > 0 then caught / n_bad else 0 end - k / n, 9) desc, cutoff desc) = 1),
rejected as (select distinct r.k from rates r join chosen c on c.stratum = r.stratum and c.rule = r.rule and r.rate > c.cutoff)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and k not in (select k from rejected) as kept
from base
"""
