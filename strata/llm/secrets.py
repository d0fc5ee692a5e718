"""Secret scans in native expressions: fixed patterns, and random-looking strings found by a test battery.

**Base kinds.** ``assign`` (a keyword, a sign and a value), ``access`` (access key ids) and ``hex`` (long runs of hex
digits). Matches are leftmost and do not overlap within a kind; a match that is too short is dropped after it has used
up its text. Offsets are code points: the lengths of what lies between the matches and of the matches, added up.

**Random strings.** Unbroken strings of ``MIN_LENGTH`` and more base64 characters that hold a letter and a digit, or
letters of both cases, are tested. Their characters say which encoding they can be (hex, upper-case hex, base32, letters,
else base64). Three statistics
are compared with what a string drawn at random from that alphabet gives: chi-squared uniformity of the characters, the
number of runs above and below the middle of the alphabet, and serial correlation. Fisher's method combines the three
p-values. For a random string the result is uniform; for words, names and paths it is close to zero.

**False discoveries.** Over all strings of the corpus, by encoding and length band: the p-values of random strings are
spread evenly, those of ordinary ones thin out towards one. The density of random strings is read off beyond the first of
the points ``FLAT`` from which on the p-values pass a chi-squared test of evenness. The cut is the smallest p from which on
at most ``FDR`` of the strings are in excess of that density, so bands in which short ordinary strings look random get a
stricter cut, and a band whose p-values are even nowhere, or whose even part is empty, accepts nothing. Counts are kept
in a fixed number of bins. What overlaps a base span is not added.

Null and empty texts have no spans. Rows are scanned one by one, so repeated rows and ids give repeated results. Very
long texts with very many matches are handled whole. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import free_names

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # as runs are greedy, the long ones among all runs
KINDS = ("assign", "access", "hex", "random")
MIN_LENGTH = 20
STRING = r"[A-Za-z0-9+/_-]{20,}={0,2}"
FDR = 0.05
BINS = 200
#: Points beyond which p-values may be even, and the 0.999 quantile of chi-squared for the tenths from there to one.
FLAT = ((0.2, 24.32), (0.4, 20.52), (0.6, 16.27))
BANDS = (24, 32, 48, 64, 128)
_ALPHABETS = {
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "letters": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
_BLOCK = 256
_HIT = "struct<start:int,stop:int,hit:string>"


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """array<struct<start, stop, hit>> of all matches; ``hit`` is the text of ``group``."""
    gaps = F.split(text, pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    rows = F.zip_with(F.slice(gaps, 1, F.size(whole)), F.arrays_zip(whole.alias("all"), value.alias("hit")),
                      lambda gap, m: F.struct(F.length(gap).alias("gap"), F.length(m["all"]).alias("size"), m["hit"].alias("hit")))
    # Results are gathered in blocks, as appending to one long array would copy it each time.
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{_HIT}>>").alias("full"), F.array().cast(f"array<{_HIT}>").alias("last"))

    def add(acc, row):
        begin = acc["at"] + row["gap"]
        end = begin + row["size"]
        last = F.concat(acc["last"], F.array(F.struct(begin.alias("start"), end.alias("stop"), row["hit"].alias("hit"))))
        full = F.size(acc["last"]) >= _BLOCK - 1
        return F.struct(end.alias("at"), F.when(full, F.concat(acc["full"], F.array(last))).otherwise(acc["full"]).alias("full"),
                        F.when(full, F.array().cast(f"array<{_HIT}>")).otherwise(last).alias("last"))

    return F.aggregate(rows, start, add, lambda acc: F.flatten(F.concat(acc["full"], F.array(acc["last"]))))


def _none() -> Column:
    return F.array().cast(f"array<{_HIT}>")


def _upper_tail(z: Column) -> Column:
    """P(Z > z) for a standard normal Z, by the polynomial 26.2.17 of Abramowitz and Stegun."""
    a = F.abs(z)
    t = 1 / (1 + 0.2316419 * a)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-a * a / 2) * 0.3989422804014327 * poly
    return F.when(z >= 0, tail).otherwise(1 - tail)


def _strings(text: Column) -> Column:
    """Strings that hold a letter and a digit or letters of both cases, with encoding and length: array of structs."""
    mixed = lambda s: (s.rlike("[0-9]") & s.rlike("[A-Za-z]")) | (s.rlike("[a-z]") & s.rlike("[A-Z]"))
    found = F.filter(matches(text, STRING), lambda m: mixed(m["hit"]))

    def described(m):
        body = F.translate(F.rtrim(m["hit"], F.lit("=")), "-_", "+/")
        code = F.when(body.rlike("^[0-9a-f]+$"), "hex").when(body.rlike("^[0-9A-F]+$"), "HEX").when(body.rlike("^[A-Z2-7]+$"), "base32").when(body.rlike("^[A-Za-z]+$"), "letters").otherwise("base64")
        return F.struct(m["start"].alias("start"), m["stop"].alias("stop"), body.alias("body"), code.alias("code"), F.length(body).alias("n"))

    return F.transform(found, described)


def _tested(strings: Column) -> Column:
    """The strings with their combined p-value. Each step is a lambda of its own, so nothing is computed twice."""
    alphabets = F.create_map(*[F.lit(x) for pair in _ALPHABETS.items() for x in pair])

    def values(s):
        alphabet = alphabets[s["code"]]
        chars = F.split(s["body"], "")
        return F.struct(
            s["start"].alias("start"), s["stop"].alias("stop"), s["code"].alias("code"), s["n"].cast("double").alias("n"),
            F.length(alphabet).cast("double").alias("k"),
            F.transform(chars, lambda c: F.instr(alphabet, c) - 1.0).alias("v"),
            F.aggregate(F.transform(F.array_distinct(chars), lambda c: (s["n"] - F.length(F.replace(s["body"], c, F.lit("")))).cast("double")),
                        F.lit(0.0), lambda a, c: a + c * c).alias("squares"),
        )

    def moments(s):
        size = s["n"].cast("int")
        high = F.transform(s["v"], lambda v: F.when(v >= s["k"] / 2, 1.0).otherwise(0.0))
        return F.struct(
            *[s[c].alias(c) for c in ("start", "stop", "code", "n", "k", "v", "squares")],
            (F.aggregate(s["v"], F.lit(0.0), lambda a, v: a + v) / s["n"]).alias("mean"),
            F.aggregate(high, F.lit(0.0), lambda a, v: a + v).alias("above"),
            (1 + F.aggregate(F.zip_with(F.slice(high, 1, size - 1), F.slice(high, 2, size - 1), lambda a, b: F.abs(a - b)), F.lit(0.0), lambda a, v: a + v)).alias("runs"),
        )

    def scores(s):
        size = s["n"].cast("int")
        spread = F.aggregate(s["v"], F.lit(0.0), lambda a, v: a + (v - s["mean"]) * (v - s["mean"]))
        beside = F.aggregate(F.zip_with(F.slice(s["v"], 1, size - 1), F.slice(s["v"], 2, size - 1), lambda a, b: (a - s["mean"]) * (b - s["mean"])), F.lit(0.0), lambda a, v: a + v)
        df, n = s["k"] - 1, s["n"]
        chi = s["k"] / n * s["squares"] - n
        # Wilson and Hilferty: the cube root of chi-squared over its degrees is nearly normal.
        z_chi = (F.pow(F.greatest(chi, F.lit(0.0)) / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
        pairs = 2 * s["above"] * (n - s["above"])
        z_runs = F.when(pairs > 0, (s["runs"] - 1 - pairs / n) / F.sqrt(F.greatest(pairs * (pairs - n) / (n * n * (n - 1)), F.lit(1e-9)))).otherwise(F.lit(12.0))
        z_serial = F.when(spread > 0, (beside / spread + 1 / n) * F.sqrt(n)).otherwise(F.lit(12.0))
        return F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["code"].alias("code"), n.alias("n"),
                        z_chi.alias("c"), z_runs.alias("r"), z_serial.alias("s"))

    def combined(s):
        least = F.lit(1e-15)
        logs = -(F.log(F.greatest(_upper_tail(s["c"]), least)) + F.log(F.greatest(2 * _upper_tail(F.abs(s["r"])), least)) + F.log(F.greatest(2 * _upper_tail(F.abs(s["s"])), least)))
        return F.struct(*[s[c].alias(c) for c in ("start", "stop", "code", "n")], logs.alias("logs"))

    def result(s):
        p = F.exp(-s["logs"]) * (1 + s["logs"] + s["logs"] * s["logs"] / 2)
        band = F.lit(0)
        for edge in BANDS:
            band = band + (s["n"] >= edge).cast("int")
        return F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["code"].alias("code"), band.alias("band"),
                        F.least(F.floor(p * BINS).cast("int"), F.lit(BINS - 1)).alias("bin"))

    for step in (values, moments, scores, combined, result):
        strings = F.transform(strings, step)
    return strings


def _candidates(text: Column) -> Column:
    return F.when(text.rlike(STRING), _tested(_strings(text))).otherwise(F.array().cast("array<struct<start:int,stop:int,code:string,band:int,bin:int>>"))


def cuts(docs: DataFrame, text: str = "text", rate: float = FDR) -> dict[tuple[str, int], int]:
    """First accepted bin by (encoding, length band), from the strings of all documents.

    At most encodings x bands x bins counts leave the tasks, whatever the input.
    """
    strings = docs.select(F.explode(_candidates(F.coalesce(F.col(text), F.lit("")))).alias("s"))
    counted = strings.groupBy("s.code", "s.band", "s.bin").agg(F.count(F.lit(1)).alias("n")).collect()
    by: dict[tuple[str, int], list[int]] = {}
    for row in counted:
        by.setdefault((row.code, row.band), [0] * BINS)[row.bin] = row.n
    return {key: cut for key, bins in by.items() if (cut := _cut(bins, rate)) is not None}


def _density(bins: list[int]) -> float | None:
    """Random strings in a bin: the mean beyond the first point from which on the bins are even; None if there is none."""
    tenth = BINS // 10
    for point, most in FLAT:
        cells = [sum(bins[at:at + tenth]) for at in range(round(point * BINS), BINS, tenth)]
        mean = sum(cells) / len(cells)
        if not mean or sum((n - mean) ** 2 for n in cells) / mean <= most:
            return mean / tenth
    return None


def _cut(bins: list[int], rate: float) -> int | None:
    """The smallest bin (never the first) from which on at most ``rate`` of the strings exceed the random ones."""
    density = _density(bins)
    if not density:
        return None
    best, total = None, 0
    for at in range(BINS - 1, 0, -1):
        total += bins[at]
        if total and 1 - density * (BINS - at) / total <= rate:
            best = at
    return best


def scan(docs: DataFrame, accepted: dict[tuple[str, int], int], text: str = "text") -> DataFrame:
    """``docs`` with n_assign, n_access, n_hex, base_sha256, spans and found.

    ``found`` are all spans as array<struct<start, kind, stop>> in order; kind is an index of ``KINDS``.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    some = whole.rlike(STRING)
    assign = F.when(whole.rlike(ASSIGN), F.filter(matches(whole, ASSIGN, 2), lambda m: F.length(m["hit"]) >= 6)).otherwise(_none())
    access = F.when(some, F.filter(matches(whole, ACCESS), lambda m: m["stop"] - m["start"] >= 20)).otherwise(_none())
    hexes = F.when(some, matches(whole, HEX)).otherwise(_none())

    def of(kind):
        return lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["stop"].alias("stop"))

    allowed = F.create_map(*[x for (code, band), cut in accepted.items() for x in (F.lit(f"{code}{band}"), F.lit(cut))]) if accepted else F.create_map().cast("map<string,int>")
    kept = [c for c in docs.columns if c.lower() not in FIELDS]
    hits, base, every = free_names(docs.columns, "hits", "base", "all")
    out = docs.select(*[F.col(f"`{c}`") for c in kept], F.struct(assign.alias("a"), access.alias("k"), hexes.alias("h"), _candidates(whole).alias("c")).alias(hits))
    out = out.withColumn(base, F.array_sort(F.concat(F.transform(f"{hits}.a", of(0)), F.transform(f"{hits}.k", of(1)), F.transform(f"{hits}.h", of(2)))))
    random = F.filter(f"{hits}.c", lambda s: (s["bin"] >= F.coalesce(F.try_element_at(allowed, F.concat(s["code"], s["band"].cast("string"))), F.lit(BINS)))
                      & ~F.exists(base, lambda b: (b["start"] < s["stop"]) & (b["stop"] > s["start"])))
    out = out.withColumn(every, F.array_sort(F.concat(base, F.transform(random, of(3)))))
    names = F.array(*map(F.lit, KINDS))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["stop"])), ",")

    return out.select(
        *[F.col(f"`{c}`") for c in kept],
        *[F.size(f"{hits}.{c}").cast("long").alias(name) for c, name in zip("akh", FIELDS)],
        F.sha2(joined(base), 256).alias("base_sha256"), joined(every).alias("spans"), F.col(every).alias("found"),
    )


FIELDS = ("n_assign", "n_access", "n_hex", "base_sha256", "spans", "found")


def redacted(scanned: DataFrame, text: str = "text", mask: str = "[SECRET]", found: str = "found") -> DataFrame:
    """``scanned`` with every found span of the text replaced by ``mask``; overlapping spans become one."""
    body, empty = F.col(text), F.array().cast("array<string>")
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<array<string>>").alias("full"), empty.alias("last"))

    def add(acc, s):
        fresh = s["start"] >= acc["at"]
        piece = F.when(fresh, F.concat(F.substring(body, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mask))).otherwise(F.lit(""))
        last = F.concat(acc["last"], F.array(piece))
        full = F.size(acc["last"]) >= _BLOCK - 1
        return F.struct(F.greatest(acc["at"], s["stop"]).alias("at"), F.when(full, F.concat(acc["full"], F.array(last))).otherwise(acc["full"]).alias("full"),
                        F.when(full, empty).otherwise(last).alias("last"))

    def end(acc):
        return F.concat(F.array_join(F.flatten(F.concat(acc["full"], F.array(acc["last"]))), ""), F.substring(body, acc["at"] + 1, F.length(body)))

    return scanned.withColumn(text, F.when(F.size(found) > 0, F.aggregate(found, start, add, end)).otherwise(body))


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts and digest, and all spans for every document."""
    narrow = docs.select("doc_id", "text")
    return scan(narrow, cuts(narrow)).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")
