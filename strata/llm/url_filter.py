"""URL filters: rules on hosts and paths, then a weighted vocabulary counted by one Aho-Corasick automaton.

The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased; the path what
follows up to ``?``, ``#`` or the end. A rule fits its host and all subdomains if the path starts with the rule's path;
the longest rule decides (a block before an allow of the same text).

Where no rule fits, the terms in what follows ``://`` (in the whole url if there is none) are counted, with A-Z
lower-cased and percent-escapes of ASCII letters and digits read; a term counts between characters other than a-z and
0-9. One strict term blocks, or distinct soft terms whose weights add up to ``LIMIT``. A term that occurs again does not
count again.

A url without ``://`` has an empty host and path and fits no rule, so its terms decide; a null url is allowed. Rows are
judged one by one, so repeated rows and ids give repeated results; an empty table gives an empty table. Rules and the
vocabulary are parameters that do not grow with the pages; the automaton takes any number of terms.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import per_text, with_fields

STRICT = ("casino", "escort", "hentai", "jackpot", "porn", "viagra", "xxx")
#: Soft terms by weight. No soft term reaches the limit alone.
SOFT_TERMS = {
    **dict.fromkeys(("adult", "bet", "bets", "dating", "gratis", "loan", "pharmacy", "pills", "poker", "sex", "slots", "winner"), 2),
    **dict.fromkeys(("bonus", "cheap", "deal", "free", "prize", "win"), 1),
}
LIMIT = 3
FIELDS = ["host", "path", "rule", "verdict", "strict_hits", "soft_hits"]
_WORD = set("abcdefghijklmnopqrstuvwxyz0123456789")
_LOWER = {c: c + 32 for c in range(65, 91)}
#: Escapes of 0-9, A-O, P-Z, a-o and p-z.
ESCAPE = "%(3[0-9]|[46][1-9A-Fa-f]|[57][0-9Aa])"
_ESCAPE = re.compile(ESCAPE)


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))


def parts(url: str) -> tuple[str, str, str]:
    """Host, path and all that follows ``://``; without it no host and path, and the whole url."""
    _, found, rest = url.partition("://")
    if not found:
        return "", "", url
    before = min((at for at in map(rest.find, "?#") if at >= 0), default=len(rest))
    slash = rest.find("/", 0, before)
    end = before if slash < 0 else slash
    return rest[:end].translate(_LOWER), rest[end:before], rest


class Judge:
    def __init__(self, rules: Iterable[Rule], strict: Iterable[str], soft: Mapping[str, int], limit: int):
        self.by_host: dict[str, list[Rule]] = {}
        for rule in sorted(rules, key=lambda r: (-len(r.name), r.verdict == "allow")):
            self.by_host.setdefault(rule.host, []).append(rule)
        self.soft, self.limit = dict(soft), limit
        self.terms = ahocorasick.Automaton()
        for is_strict, terms in ((False, soft), (True, strict)):
            for term in terms:
                self.terms.add_word(term, (term, is_strict))
        if len(self.terms):
            self.terms.make_automaton()

    def rule(self, host: str, path: str) -> Rule | None:
        labels, best = host.split("."), None
        for at in range(len(labels)):
            fits = (r for r in self.by_host.get(".".join(labels[at:]), ()) if path.startswith(r.path))
            found = next(fits, None)
            if found and (best is None or (-len(found.name), found.verdict == "allow") < (-len(best.name), best.verdict == "allow")):
                best = found
        return best

    def hits(self, rest: str) -> tuple[set[str], set[str]]:
        text, strict, soft = _ESCAPE.sub(lambda m: chr(int(m[1], 16)), rest).translate(_LOWER), set(), set()
        if len(self.terms):
            for end, (term, is_strict) in self.terms.iter(text):
                start = end + 1 - len(term)
                if (start == 0 or text[start - 1] not in _WORD) and (end + 1 == len(text) or text[end + 1] not in _WORD):
                    (strict if is_strict else soft).add(term)
        return strict, soft

    def __call__(self, url: str) -> tuple:
        host, path, rest = parts(url)
        strict, soft = self.hits(rest)
        rule = self.rule(host, path) if host else None
        verdict = rule.verdict if rule else "block" if strict or sum(map(self.soft.__getitem__, soft)) >= self.limit else "allow"
        return host, path, rule and rule.name, verdict, len(strict), len(soft)


def judge(pages: DataFrame, rules: Iterable[Rule] = RULES, strict: Iterable[str] = STRICT, soft: Mapping[str, int] = SOFT_TERMS, limit: int = LIMIT,
          url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule, verdict and the numbers of distinct strict and soft terms."""
    rules, strict, soft = tuple(rules), tuple(strict), dict(soft)

    def make():
        one = Judge(rules, strict, soft, limit)

        def work(urls):
            columns = list(zip(*map(one, urls)))
            return [pa.array(c, t) for c, t in zip(columns, [pa.string()] * 4 + [pa.int64()] * 2)]

        return work

    found = per_text("host string, path string, rule string, verdict string, strict_hits long, soft_hits long", make)(F.col(url))
    return with_fields(pages, found, FIELDS)


def judged(pages: DataFrame) -> DataFrame:
    return judge(pages.select("page_id", "url")).select("page_id", *FIELDS)


def oracle() -> str:
    """The same verdicts in SQL."""
    def count(terms, weight=lambda term: 1):
        return " + ".join(f"{weight(term)} * cast(regexp_matches(t, '(^|[^a-z0-9]){term}([^a-z0-9]|$)') as bigint)" for term in terms)

    cases = sorted(RULES, key=lambda r: -len(r.name))
    fits = {r: f"(host = '{r.host}' or ends_with(host, '.{r.host}')) and starts_with(path, '{r.path}')" for r in cases}
    rule = "case " + " ".join(f"when {fits[r]} then '{r.name}'" for r in cases) + " end"
    verdict = "case " + " ".join(f"when {fits[r]} then '{r.verdict}'" for r in cases)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
with u as (select page_id, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest,
             case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else coalesce(url, '') end as whole from pages),
d as (select page_id, rest, array_to_string(list_transform(regexp_extract_all(whole, '{ESCAPE}|[^%]+|%'),
             lambda x: case when regexp_full_match(x, '{ESCAPE}') then chr(cast('0x' || substr(x, 2, 2) as int)) else x end), '') as plain from u),
p as (select page_id, translate(plain, '{upper}', '{lower}') as t,
             translate(regexp_extract(rest, '^[^/?#]*'), '{upper}', '{lower}') as host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from d),
n as (select *, {count(STRICT)} as strict_hits, {count(SOFT_TERMS)} as soft_hits, {count(SOFT_TERMS, SOFT_TERMS.get)} as weight from p)
select page_id, host, path, {rule} as rule, {verdict} when strict_hits > 0 or weight >= {LIMIT} then 'block' else 'allow' end as verdict,
       strict_hits, soft_hits
from n
"""
