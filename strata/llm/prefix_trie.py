"""Conversation prefix trie, with subtree totals by parallel tree contraction.

**Conversations.** A conversation's turns are ordered by turn (null first), then role and text, null role or text being
empty. Its rebuilt form is the first h original turns of the conversation that opens its hundred (``conv_id`` less its
remainder by 100; all if it has fewer, none if it is absent), then its own turns after its first h; h is the unsigned
crc32 of the decimal conv_id, modulo 6.

**Nodes.** Each distinct sequence of first d rebuilt turns is a node of depth d, the root having none. A turn at its depth
is two 64-bit hashes, a sequence the exclusive or of its turns' hashes, so prefixes come from running aggregates;
sequences are told apart by depth and 128 bits. A node is named by its smallest member and its depth. A conversation of
any length is ranked by a range sort and summed block by block, so none is gathered in one task.

**Contraction.** Rounds of two steps until no node is left. *Compress*: pointer doubling by self joins contracts every
chain of nodes with one child left, each with the sum from itself down to the chain's end, to which the chain's place in
the tree passes. *Rake*: leaves have their totals and give them to their parents. After a compress all inner nodes have
two children or more, so a round at least halves the tree. *Expansion* goes back through the rounds: a contracted node's
total is its sum and the total of its chain's end. Every state is written to the shared scratch folder.

Defined results: rows with a null conv_id belong to no conversation; repeated rows are turns of their own; a
conversation that loses all turns is a member of the root alone; an empty table has no nodes. Other columns, whatever
their names, are not looked at. Texts are hashed whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm import sql_parts
from strata.llm.common import spread_join, written

#: Rows of (conv_id, turns) of which a conversation is rebuilt: the opening one, and the most turns taken from it.
HUNDRED = 100
MOST_SHARED = 5
#: Member ids that are joined to one string.
ID_BLOCK = 8192
_SUMS = ("leaves", "saved")


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, block, pos, t1, t2, chars): turns numbered from 1 by order, with two hashes of role and text.

    Rows are sorted by ranges of the whole order; ``block`` is the range, so a long conversation has several.
    """
    empty = F.lit("")
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
        F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"),
    ).where("conv_id is not null")
    # The bounds of the ranges are sampled to the driver, so they hold the beginnings of texts only; within a range texts
    # are compared whole. Rows that agree in all of that share a range, whose sort may spill.
    ranged = rows.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 64)).sortWithinPartitions("conv_id", "turn", "role", "text")
    hashes = [F.xxhash64(F.lit(i), "role", "text").alias(f"t{i}") for i in (1, 2)]
    # The number holds the range in its high bits and counts the range's rows in order in its low ones.
    placed = ranged.select("conv_id", F.monotonically_increasing_id().alias("place"), *hashes, F.length("text").cast("long").alias("chars"))
    placed = written(placed.withColumn("block", F.shiftright("place", 33)), "turns")
    blocks = placed.groupBy("conv_id", "block").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = blocks.select("conv_id", "block", (before - F.col("first") + 1).alias("shift"))
    return placed.join(starts, ["conv_id", "block"]).select("conv_id", "block", (F.col("place") + F.col("shift")).alias("pos"), "t1", "t2", "chars")


def _turn_hash(depth: Column, i: int, t: str) -> Column:
    return F.xxhash64(F.lit(i), depth, F.col(t))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, a, b, own_a, own_b, chars, ends): one row per conversation and prefix, the empty one included.

    ``a`` and ``b`` are the prefix's hashes, ``own_a`` and ``own_b`` those of its last turn.
    """
    turns = written(ordered_turns(conversations), "ordered")
    shared = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(6))
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("size")).withColumn("h", shared)
    sizes = sizes.withColumn("base", F.col("conv_id") - F.col("conv_id") % HUNDRED)
    opening = turns.where((F.col("conv_id") % HUNDRED == 0) & (F.col("pos") <= MOST_SHARED)).groupBy(F.col("conv_id").alias("base")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "t1", "t2", "chars"))).alias("opening"))  # five turns at most
    plan = sizes.join(opening, "base", "left").withColumn("opening", F.slice(F.coalesce("opening", F.array().cast("array<struct<pos:bigint,t1:bigint,t2:bigint,chars:bigint>>")), F.lit(1), F.col("h")))
    plan = written(plan.select("conv_id", "size", "h", "opening", (F.size("opening") + F.greatest(F.col("size") - F.col("h"), F.lit(0))).alias("turns")), "plan")
    taken = plan.select("conv_id", "turns", F.explode("opening").alias("o")).select("conv_id", F.lit(-1).cast("long").alias("block"), F.col("o.pos").alias("depth"), "o.t1", "o.t2", "o.chars", "turns")
    kept = spread_join(turns, plan.select("conv_id", "h", F.size("opening").alias("taken"), "turns"), ["conv_id"], ["block"]).where("pos > h")
    kept = kept.select("conv_id", "block", (F.col("pos") - F.col("h") + F.col("taken")).alias("depth"), "t1", "t2", "chars", "turns")
    own = [_turn_hash(F.col("depth"), i, f"t{i}").alias(f"own_{x}") for i, x in ((1, "a"), (2, "b"))]
    rows = written(taken.unionByName(kept).select("conv_id", "block", "depth", *own, "chars", (F.col("depth") == F.col("turns")).alias("ends")), "rebuilt")
    blocks = rows.groupBy("conv_id", "block").agg(F.bit_xor("own_a").alias("a"), F.bit_xor("own_b").alias("b"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = blocks.select("conv_id", "block", *[F.coalesce(F.bit_xor(x).over(earlier), F.lit(0)).alias(f"before_{x}") for x in "ab"])
    within = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    running = rows.join(before, ["conv_id", "block"]).select(
        "conv_id", "depth", *[F.bit_xor(f"own_{x}").over(within).bitwiseXOR(F.col(f"before_{x}")).alias(x) for x in "ab"], "own_a", "own_b", "chars", "ends")
    zero = F.lit(0).cast("long")
    roots = plan.select("conv_id", zero.alias("depth"), *[zero.alias(c) for c in ("a", "b", "own_a", "own_b", "chars")], (F.col("turns") == 0).alias("ends"))
    return running.unionByName(roots)


def _digests(ends: DataFrame) -> DataFrame:
    """(depth, a, b, ends_sha256) of (depth, a, b, conv_id): the hash of each node's ids, ascending and comma-joined.

    Ids are sorted by ranges and joined to strings of a bounded number of ids there; then a task hashes the strings of a
    node one after the other and holds no more than a batch of them.
    """
    key = ["depth", "a", "b"]
    names = [*key, "first", "ids"]
    kind = "depth long, a long, b long, first long, ids string"

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids, out = None, [], []

        def close():
            if ids:
                out.append((*node, ids[0], ",".join(map(str, ids))))

        for batch in batches:
            for *at, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if at != node or len(ids) == ID_BLOCK:
                    close()
                    node, ids = at, []
                ids.append(conv)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if n == "ids" else pa.int64()) for n, c in zip(names, zip(*out))], names=names)
                out.clear()
        close()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if n == "ids" else pa.int64()) for n, c in zip(names, zip(*out))], names=names)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state, out = None, None, []
        fields = [*key, "ends_sha256"]

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if n == "ends_sha256" else pa.int64()) for n, c in zip(fields, zip(*out))], names=fields)

        for batch in batches:
            for *at, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if at == node:
                    state.update(b",")
                else:
                    if node is not None:
                        out.append((*node, state.hexdigest()))
                    node, state = at, hashlib.sha256()
                state.update(ids.encode())
            if out:
                yield flush()
                out.clear()
        if node is not None:
            out.append((*node, state.hexdigest()))
            yield flush()

    ranged = ends.select(*key, "conv_id").repartitionByRange(*key, "conv_id").sortWithinPartitions(*key, "conv_id")
    strings = ranged.mapInArrow(joined, kind)
    return strings.repartition(*key).sortWithinPartitions(*key, "first").mapInArrow(hashed, "depth long, a long, b long, ends_sha256 string")


def subtree_totals(nodes: DataFrame, sums: tuple[str, ...] = _SUMS) -> DataFrame:
    """(id, sums...) over each node's subtree, from ``nodes`` (id, parent, sums...); a root's parent is null.

    Ids may be of any type with equality. See the module's text for the method.
    """
    add = [F.sum(s).alias(f"more_{s}") for s in sums]

    def with_more(df: DataFrame, more: DataFrame) -> DataFrame:
        plus = [(F.col(s) + F.coalesce(F.col(f"more_{s}"), F.lit(0))).alias(s) for s in sums]
        return df.join(more, "id", "left").select(*[c for c in df.columns if c not in sums], *plus)

    live, raked, chains = written(nodes.select("id", "parent", *sums), "live"), [], []
    while not live.isEmpty():
        children = live.where("parent is not null").groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("only"))
        counted = written(live.join(children, "id", "left").select("id", "parent", *sums, F.coalesce("n", F.lit(0)).alias("n"), "only"), "counted")
        unary = counted.where("n = 1")
        # A chain's nodes point to their only child; ``more`` says that it is in the chain as well.
        inner = unary.select(F.col("id").alias("next"), F.lit(True).alias("more"))
        chain = written(unary.select("id", F.col("only").alias("next"), *sums).join(inner, "next", "left").select("id", "next", *sums, F.coalesce("more", F.lit(False)).alias("more")), "chain")
        if not chain.isEmpty():
            inside = chain.where("more").select(F.col("next").alias("id"))
            heads = unary.select("id", "parent").join(inside, "id", "left_anti")
            heads = written(heads, "heads")
            while not chain.where("more").isEmpty():
                ahead = chain.select(F.col("id").alias("next"), F.col("next").alias("then"), F.col("more").alias("again"), *[F.col(s).alias(f"more_{s}") for s in sums])
                jumped = chain.where("more").join(ahead, "next").select("id", F.col("then").alias("next"), *[(F.col(s) + F.col(f"more_{s}")).alias(s) for s in sums], F.col("again").alias("more"))
                chain = written(chain.where("not more").unionByName(jumped), "chain")
            moved = written(heads.join(chain, "id").select("parent", "next", *sums), "moved")
            places = moved.select(F.col("next").alias("id"), F.col("parent").alias("above"), F.lit(True).alias("at_end"))
            above = moved.where("parent is not null").groupBy(F.col("parent").alias("id")).agg(*add)
            rest = counted.where("n != 1").join(places, "id", "left")
            rest = rest.select("id", F.when(F.col("at_end"), F.col("above")).otherwise(F.col("parent")).alias("parent"), *sums, "n")
            counted = written(with_more(rest, above), "compressed")
        chains.append(chain)
        leaves = counted.where("n = 0")
        raked.append(leaves.select("id", *sums))
        given = leaves.where("parent is not null").groupBy(F.col("parent").alias("id")).agg(*add)
        live = written(with_more(counted.where("n > 0").select("id", "parent", *sums), given), "live")
    if not raked:
        return nodes.select("id", *sums)
    known = []
    for leaves, chain in zip(reversed(raked), reversed(chains)):
        known.append(leaves)
        if not chain.isEmpty():
            total = known[0]
            for more in known[1:]:
                total = total.unionByName(more)
            ends = total.select(F.col("id").alias("next"), *[F.col(s).alias(f"more_{s}") for s in sums])
            grown = spread_join(chain.drop("more"), ends, ["next"], ["id"]).select("id", *[(F.col(s) + F.col(f"more_{s}")).alias(s) for s in sums])
            known.append(written(grown, "expanded"))
    total = known[0]
    for more in known[1:]:
        total = total.unionByName(more)
    return total


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    rows = written(rebuilt(conversations), "prefixes")
    key = ["depth", "a", "b"]
    nodes = rows.groupBy(*key).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("own_a").alias("own_a"), F.min("own_b").alias("own_b"), F.min("chars").alias("chars"))
    nodes = written(nodes.select("*", (F.col("depth") - 1).alias("up"), F.col("a").bitwiseXOR(F.col("own_a")).alias("up_a"), F.col("b").bitwiseXOR(F.col("own_b")).alias("up_b")), "nodes")
    children = nodes.where("depth > 0").groupBy(F.col("up").alias("depth"), F.col("up_a").alias("a"), F.col("up_b").alias("b")).agg(F.count(F.lit(1)).alias("n_children"))
    # A node may have any share of all nodes as children.
    parents = nodes.select(F.col("depth").alias("up"), F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("conv_id").alias("parent_conv_id"))
    placed = spread_join(nodes.where("depth > 0"), parents, ["up", "up_a", "up_b"], ["conv_id"]).select(*key, "conv_id", "n_convs", "chars", "parent_conv_id")
    top = nodes.where("depth = 0").select(*key, "conv_id", "n_convs", "chars", F.lit(None).cast("long").alias("parent_conv_id"))
    known = placed.unionByName(top).join(children, key, "left").join(_digests(rows.where("ends")), key, "left")
    known = written(known.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "chars",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")), "known")
    own = known.select(
        F.struct("conv_id", "depth").alias("id"),
        F.when(F.col("depth") > 0, F.struct(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"))).alias("parent"),
        (F.col("n_children") == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    totals = subtree_totals(own).select("id.conv_id", "id.depth", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    return known.join(totals, ["conv_id", "depth"]).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


ORACLE = f"""
with {sql_parts.CRC_TABLE},
t as (select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
             row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as pos
      from conversations where conv_id is not null),
sizes as (select conv_id, conv_id - conv_id % {HUNDRED} as base, {sql_parts.crc32("cast(conv_id as varchar)")} % 6 as h
          from (select distinct conv_id from t), crc_table),
taken as (select s.conv_id, t.pos as depth, t.role, t.text from sizes s join t on t.conv_id = s.base and t.pos <= s.h),
n_taken as (select conv_id, count(*) as n from taken group by conv_id),
turns as (select * from taken union all
          select s.conv_id, t.pos - s.h + coalesce(n.n, 0), t.role, t.text
          from sizes s join t using (conv_id) left join n_taken n using (conv_id) where t.pos > s.h),
prefixes as (
  select conv_id, depth, length(text) as chars,
         string_agg(length(role) || ':' || role || length(text) || ':' || text, '') over (partition by conv_id order by depth) as p
  from turns union all select conv_id, 0, 0, '' from sizes),
nodes as (select depth, p, min(conv_id) as conv_id, count(*) as n_convs, any_value(chars) as chars from prefixes group by depth, p),
rows as (select r.conv_id as member, r.depth, n.conv_id, n.n_convs, n.chars from prefixes r join nodes n using (depth, p)),
own as (select n.conv_id, n.depth, n.n_convs, n.chars, up.conv_id as parent_conv_id
        from nodes n left join rows up on up.member = n.conv_id and up.depth = n.depth - 1),
children as (select parent_conv_id as conv_id, depth - 1 as depth, count(*) as n_children from own where depth > 0 group by 1, 2),
weighed as (select o.*, coalesce(c.n_children, 0) as n_children from own o left join children c using (conv_id, depth)),
totals as (
  select r.conv_id, r.depth, sum(case when x.n_children = 0 then 1 else 0 end) as n_leaves, sum((x.n_convs - 1) * x.chars) as saved_tokens
  from weighed x join rows r on r.member = x.conv_id and r.depth <= x.depth group by 1, 2),
ends as (
  select r.conv_id, r.depth, sha256(string_agg(cast(r.member as varchar), ',' order by r.member)) as ends_sha256
  from rows r join (select conv_id as member, max(depth) as depth from prefixes group by 1) last using (member, depth) group by 1, 2)
select w.conv_id, w.depth, w.parent_conv_id, w.n_convs, w.n_children, cast(t.n_leaves as bigint) as n_leaves,
       cast(t.saved_tokens as bigint) as saved_tokens, coalesce(e.ends_sha256, sha256('')) as ends_sha256
from weighed w join totals t using (conv_id, depth) left join ends e using (conv_id, depth)
"""
