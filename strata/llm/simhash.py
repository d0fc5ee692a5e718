"""SimHash near-dedup: fingerprints linked by generalised pigeonhole partitions.

**Fingerprints.** Lower-cased (A-Z) words between white space (ASCII), three-word shingles with repeats, XXH64 with seed
42; a bit is set if it is set in over half of the hashes. A text of one or two words is one shingle; a text without
words has fingerprint zero and is linked like any other. Null is an empty text.

**Links.** Only distinct fingerprints are compared. The 64 bits are dealt to partitions so that correlated bits lie
together. A partition has a threshold: if the thresholds add up to (distance - partitions + 1), two fingerprints within
the distance agree up to its threshold in one partition at least. Thresholds may differ, and -1 leaves a partition out.
How often two fingerprints agree in a partition is estimated from the joint counts of all pairs of bits over all
fingerprints; a dynamic program picks the thresholds with the fewest expected candidates and probes, for each number of
partitions, and the cheapest number wins. Threshold r is probed by keys that leave out r of the partition's bits.

**Verification.** Fingerprints under one key are a bucket. Buckets of up to ``BUCKET`` are compared pair by pair. In a
larger one (many near copies) the pairs are not listed: each fingerprint is linked to the values one bit away from it,
which two fingerprints share exactly if they differ in two bits at most; such values are nodes of the graph alone. So
no link is lost, and a bucket of n fingerprints makes at most 65 n rows.

**Components.** ``components`` over the links; a component's id is its smallest doc_id.

Rows with a null doc_id get a fingerprint and the component of their text (null if it has no other doc_id). Repeated
rows are linked like copies. An empty table gives an empty table. Extra columns are not looked at.
"""

from __future__ import annotations

import itertools
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import free_names, ordered, per_text, written
from strata.llm.components import components

SEED = 42
SHINGLE = 3
DISTANCE = 2
BITS = 64
BUCKET = 64
MAX_PARTS = 6
_BIT_WEIGHTS = np.uint64(1) << np.arange(BITS, dtype=np.uint64)


def fingerprint(text: str, size: int = SHINGLE) -> int:
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    n = max(len(words) - size + 1, 1)
    starts = [0, *ends[:n - 1]]
    digest = xxhash.xxh64_intdigest
    stops = ends[min(size, len(words)) - 1:]
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 14):
        part = range(at, min(at + (1 << 14), n))
        hashes = np.array([digest(joined[starts[i]:stops[i] - 1], SEED) for i in part], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(_BIT_WEIGHTS[2 * ones > n].sum())


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_hash, fp): fp as the signed 64-bit form of the fingerprint; the hash tells rows of an id apart."""
    def make():
        return lambda texts: [pa.array(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64))]

    return docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"), per_text("fp long", make)(F.col(text))["fp"].alias("fp"))


@dataclass(frozen=True)
class Plan:
    """Bit masks to keep for the probes, by partition; ``cost`` in candidates and probes."""

    parts: tuple[tuple[int, ...], ...]
    thresholds: tuple[int, ...]
    cost: float

    def masks(self) -> list[int]:
        """One mask per probe key: the partition's bits without r of them."""
        out = []
        for bits, r in zip(self.parts, self.thresholds):
            for gone in itertools.combinations(bits, r) if r >= 0 else ():
                out.append(sum(1 << b for b in bits if b not in gone))
        return out


def joint_counts(distinct: DataFrame, fp: str = "fp") -> tuple[int, np.ndarray]:
    """Number of fingerprints and, for each pair of bits, how many have both set: 64 x 64, whatever the input."""
    def count(batches):
        total, n = np.zeros((BITS, BITS), np.int64), 0
        for batch in batches:
            values = batch.column(0).to_numpy()
            for at in range(0, len(values), 1 << 15):
                bits = np.unpackbits(values[at:at + (1 << 15)].astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
                total += np.rint(bits.T @ bits).astype(np.int64)
                n += len(bits)
        yield pa.RecordBatch.from_arrays([pa.array(range(BITS * BITS + 1), pa.int32()), pa.array([*total.ravel().tolist(), n], pa.int64())], names=["cell", "n"])

    found = distinct.select(fp).mapInArrow(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    flat = np.zeros(BITS * BITS + 1, np.int64)
    for row in found:
        flat[row.cell] = row.n
    return int(flat[-1]), flat[:-1].reshape(BITS, BITS)


def plan(n: int, both: np.ndarray, distance: int = DISTANCE) -> Plan:
    """The cheapest partitions and thresholds for ``n`` fingerprints with these joint counts."""
    share = both / max(n, 1)
    one = np.diag(share)
    deviation = np.sqrt(np.maximum(one * (1 - one), 1e-12))
    correlation = np.abs(share - np.outer(one, one)) / np.outer(deviation, deviation)
    np.fill_diagonal(correlation, -1)
    best = None
    for m in range(1, MAX_PARTS + 1):
        parts = _grouped(correlation, m)
        # Chance that two fingerprints differ in exactly r bits of a partition.
        chances = [_differ(bits, share, distance) for bits in parts]
        # State: sum of thresholds so far -> (cost, thresholds).
        states = {0: (0.0, ())}
        for bits, chance in zip(parts, chances):
            after: dict[int, tuple[float, tuple[int, ...]]] = {}
            for total, (cost, chosen) in states.items():
                for r in range(-1, distance + 1):
                    more = 0.0 if r < 0 else n * (n - 1) / 2 * sum(chance[:r + 1]) + n * math.comb(len(bits), r)
                    if total + r not in after or cost + more < after[total + r][0]:
                        after[total + r] = (cost + more, (*chosen, r))
            states = after
        if (goal := distance - m + 1) in states and (best is None or states[goal][0] < best.cost):
            best = Plan(tuple(parts), states[goal][1], states[goal][0])
    return best


def _grouped(correlation: np.ndarray, m: int) -> list[tuple[int, ...]]:
    """``m`` groups of nearly equal size; each grows by the free bit most correlated with the group."""
    free, groups = set(range(BITS)), []
    for g in range(m):
        size = (BITS - sum(map(len, groups))) // (m - g)
        left = sorted(free)
        start = max(left, key=lambda b: (correlation[b, left].max(), -b))
        group = [start]
        free.discard(start)
        while len(group) < size:
            nearest = max(sorted(free), key=lambda b: (correlation[b, group].mean(), -b))
            group.append(nearest)
            free.discard(nearest)
        groups.append(tuple(sorted(group)))
    return groups


def _differ(bits: tuple[int, ...], share: np.ndarray, most: int) -> list[float]:
    """Chance of 0..most differing bits between two fingerprints, with the bits as a chain of neighbours in strength."""
    def cells(a, b):
        t = share[a, b]
        return np.array([[1 - share[a, a] - share[b, b] + t, share[b, b] - t], [share[a, a] - t, t]]).clip(0)

    order, rest = [bits[0]], list(bits[1:])
    while rest:
        last = order[-1]
        order.append(rest.pop(int(np.argmax([abs(share[last, b] - share[last, last] * share[b, b]) for b in rest]))))
    p = share[bits[0], bits[0]]
    # ways[d][state]: d differing bits so far; state 1 if the last bit differs.
    ways = np.zeros((most + 1, 2))
    ways[0, 0] = p * p + (1 - p) * (1 - p)
    if most:
        ways[1, 1] = 2 * p * (1 - p)
    for a, b in zip(order, order[1:]):
        c = cells(a, b)
        agree_a = share[a, a] ** 2 + (1 - share[a, a]) ** 2
        agree_both = float((c ** 2).sum())
        agree_b = share[b, b] ** 2 + (1 - share[b, b]) ** 2
        stay = agree_both / agree_a if agree_a > 0 else 0.0
        back = (agree_b - agree_both) / (1 - agree_a) if agree_a < 1 else 0.0
        stay, back = min(max(stay, 0.0), 1.0), min(max(back, 0.0), 1.0)
        after = np.zeros_like(ways)
        after[:, 0] = ways[:, 0] * stay + ways[:, 1] * back
        after[1:, 1] = ways[:-1, 0] * (1 - stay) + ways[:-1, 1] * (1 - back)
        ways = after
    return [float(w) for w in ways.sum(1)]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >= 1 << (BITS - 1) else value


def links(distinct: DataFrame, masks: list[int], bucket: int = BUCKET) -> DataFrame:
    """(a, b): links between fingerprints, and between those and single-bit neighbours in large buckets.

    Nodes are (value, real) packed as struct<v long, r int>: r is 0 for a fingerprint, 1 for a neighbour value. The
    neighbour values stand for a distance of two alone, so the distance is no parameter here.
    """
    keyed = F.explode(F.array(*[F.struct(F.lit(i).alias("probe"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for i, m in enumerate(masks)]))
    keys = distinct.select("fp", keyed.alias("k")).select("fp", "k.probe", "k.key")
    several = keys.groupBy("probe", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # A large bucket may take any share of the rows; this join is left free for adaptive execution to split it.
    members = written(keys.join(several, ["probe", "key"]), "buckets")
    node = lambda value, real: F.struct(F.col(value).alias("v"), F.lit(real).alias("r"))
    small = (
        members.where(F.col("n") <= bucket).groupBy("probe", "key").agg(F.collect_list("fp").alias("fps"))
        .select(F.explode("fps").alias("a"), "fps").select("a", F.explode("fps").alias("b"))
        .where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE))
        .select(node("a", 0).alias("a"), node("b", 0).alias("b")).distinct()
    )
    # All members of a bucket agree outside the bits that the probe leaves out or does not cover, but a flip anywhere
    # else can meet no other member: flip what the key does not hold, and the fingerprint itself.
    flips = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(_signed(1 << b))) for b in range(BITS)])
    spread = members.where(F.col("n") > bucket).select("fp").distinct().select("fp", F.explode(flips).alias("near"))
    shared = spread.groupBy("near").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("near")
    # A neighbour value that is a fingerprint itself counts as that fingerprint: the distance is one at most.
    large = spread.join(shared, "near").select(node("fp", 0).alias("a"), node("near", 1).alias("b"))
    return small.unionByName(large)


def grouped(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text_hash, fp, component_id and root (a value shared by the rows of a group alone) for every row."""
    prints = written(fingerprints(docs, doc_id, text), "prints")
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    n, both = joint_counts(distinct)
    roots = components(links(distinct, plan(n, both).masks()))
    own = F.struct(F.col("fp").alias("v"), F.lit(0).alias("r"))
    nodes = roots.where("node.r = 0").select(F.col("node.v").alias("fp"), "root")
    known = distinct.join(nodes, "fp", "left")
    ids = known.where("root is not null").groupBy("root").agg(F.min("least").alias("smallest"))
    component = F.coalesce("smallest", "least").alias("component_id")
    labels = written(known.join(ids, "root", "left").select("fp", F.coalesce("root", own).alias("root"), component), "labels")
    # Copies may take any share of the rows: both sides come straight from their shuffles, so the join can be split.
    return prints.join(labels, "fp")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id for every row."""
    found = grouped(docs, doc_id, text)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group: that with the smallest doc_id (a null id is the largest), then text hash.

    Of rows that agree in both, the first by all columns stays.
    """
    return keep_first(docs, grouped(docs, doc_id, text), doc_id, text)


def keep_first(docs: DataFrame, groups: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``docs`` with the first row of each group; ``groups`` has doc_id, text_hash and root for every row.

    Columns of ``docs`` may have any name and type; those without an order (maps) are compared by their JSON form.
    """
    rows = groups.groupBy("root", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "n"))
    own_id, own_hash, own_n, own_row = free_names(docs.columns, "id", "hash", "n", "row")
    leaders = written(rows.groupBy("root").agg(first.alias("l")).select(F.col("l.doc_id").alias(own_id), F.col("l.text_hash").alias(own_hash), F.col("l.n").alias(own_n)), "leaders")
    same = F.col(f"`{doc_id}`").eqNullSafe(F.col(own_id)) & (F.xxhash64(f"`{text}`") == F.col(own_hash))
    once = docs.join(leaders.where(F.col(own_n) == 1), same, "left_semi")
    repeated = docs.join(leaders.where(F.col(own_n) > 1), same, "left_semi")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    order = F.struct(*[F.col(f"`{f.name}`") if ordered(f.dataType) else F.to_json(F.struct(f"`{f.name}`")) for f in docs.schema.fields])
    least = repeated.groupBy(F.col(f"`{doc_id}`").alias(own_id), F.xxhash64(f"`{text}`").alias(own_hash)).agg(F.min_by(whole, order).alias(own_row))
    return once.unionByName(least.select(f"{own_row}.*"))
