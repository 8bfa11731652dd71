"""Prefix trie of conversations, built by the recursion of van Emde Boas layouts.

A problem is (root, sequences): the part of the trie below one node down to a height that is a power of two. It is cut
at half its height. What a sequence has above the cut is its cut prefix and gets a name, the 128-bit hash of the root's
name and of the prefix's turns; the distinct cut prefixes are the sequences of the upper trie, and the rests, each under
the name of its prefix, are the lower forests. All problems of one height are rows of one table, so a round (one per
power of two up to the longest conversation) handles them all at once. At height 1 a sequence is one turn: the row is a
node. Equal sequences become one weighted row before the first cut, and equal prefixes at each cut, so a first turn
that a third of all conversations share is one row from its cut on.

Totals go upward the same way. From height 1 to the whole, a block's total is that of its upper trie plus those of the
lower forests at its cut (``forest totals``). Then, from the whole down, every forest's total is grafted to the leaf of
the upper trie where it hangs, and what a leaf holds is passed to the cut above it, until each node has the total of all
that hangs below it. A node's subtree is thus summed with joins on names and grouped sums alone.

The digest of the conversations that end at a node reads their numbers in order. They are sorted over all tasks by
(node, number); a task digests the nodes that begin and end in its range and writes the others as blocks of up to
BLOCK bytes, which are put together in order. So of a node where a third of all conversations end, one task reads only
few blocks.

Intermediate tables go to the shared folder. One task holds the turn ids of one conversation (24 bytes a turn), never
its texts.

Defined results: rows with a null conv_id belong to no conversation and take no part; turns are ordered by turn (null
first), ties by role and then text in code-point order, and repeated rows are turns of their own; null role or text is
empty; a conversation without turns after the rebuilding is a member of the root only; extra columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from . import common

SHARED = 100  # conversation c takes its first turns from c - c % SHARED ...
HEADS = 6  # ... fewer than this
BLOCK = 1 << 16
EMPTY = hashlib.sha256(b"").hexdigest()
NAME = ("a", "b")


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)


# --- sequences -------------------------------------------------------------------------------------------------------

def sequences(conversations: DataFrame) -> DataFrame:
    """conv_id, turns: per conversation its turns in order, each as a 128-bit id (a, b) and its text's code points n."""
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text"))
    # texts are sorted (and spilled) with their rows; the list of a conversation holds ids only
    numbered = turns.withColumn("place", place).select("conv_id", F.struct(
        "place", F.xxhash64(F.lit(1), "role", "text").alias("a"), F.xxhash64(F.lit(2), "text", "role").alias("b"),
        F.length("text").cast("long").alias("n")).alias("turn"))
    return numbered.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns")).select(
        "conv_id", F.transform("turns", lambda t: F.struct(t["a"], t["b"], t["n"])).alias("turns"))


def rebuilt(own: DataFrame) -> DataFrame:
    """The first h turns of conversation c - c % SHARED, then c's own turns after its first h; h = crc32(c) % HEADS."""
    bases = own.where(F.col("conv_id") % SHARED == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, HEADS - 1).alias("heads"))
    head = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    joined = (own.withColumn("base", F.col("conv_id") - F.col("conv_id") % SHARED).withColumn("h", head)
              .join(bases, "base", "left"))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    heads = F.when(F.col("heads").isNotNull(), F.slice("heads", F.lit(1), F.col("h")))
    return joined.select("conv_id", F.when(heads.isNull(), rest).otherwise(F.concat(heads, rest)).alias("turns"))


# --- upper tries and lower forests -----------------------------------------------------------------------------------

def _name(a: Column, b: Column, turns: Column) -> tuple[Column, Column]:
    return F.xxhash64(F.lit(1), a, b, turns), F.xxhash64(F.lit(2), b, a, turns)


def end_name(turns: Column, height: int) -> Column:
    """Name (a, b) of the node of a whole sequence shorter than ``height``, found by the same cuts as in the recursion."""
    cuts = []
    while height > 1:
        height //= 2
        cuts.append(height)
    zero = F.lit(0).cast("long")

    def cut(at: Column, c: Column) -> Column:
        a, b = _name(at["a"], at["b"], F.slice(turns, at["at"] + 1, c))
        return F.when(F.size(turns) - at["at"] >= c, F.struct(a.alias("a"), b.alias("b"), (at["at"] + c).alias("at"))).otherwise(at)

    found = F.aggregate(F.array(*map(F.lit, cuts)), F.struct(zero.alias("a"), zero.alias("b"), F.lit(0).alias("at")), cut)
    return F.struct(found["a"].alias("a"), found["b"].alias("b"))


def halved(problems: DataFrame, height: int) -> DataFrame:
    """The problems of half the height: upper tries (distinct cut prefixes) and lower forests.

    Columns: lo (depth of the root), ra and rb (its name), turns, la and lb (name of the node at the full height, null
    where the sequence ends above it), n (members) and conv (the smallest).
    """
    c = height // 2
    length = F.size("turns")
    prefix = F.slice("turns", 1, c)
    a, b = _name(F.col("ra"), F.col("rb"), prefix)
    keys = ["lo", "ra", "rb", "turns", "la", "lb"]
    upper = (problems.where(length >= c).select("lo", "ra", "rb", prefix.alias("turns"), a.alias("la"), b.alias("lb"), "n", "conv")
             .groupBy(*keys).agg(F.sum("n").alias("n"), F.min("conv").alias("conv")))
    below = length > c
    # distinct as they are: two equal rests under one prefix would be two equal sequences
    rest = problems.where(length != c).select(
        F.when(below, F.col("lo") + c).otherwise(F.col("lo")).alias("lo"),
        F.when(below, a).otherwise(F.col("ra")).alias("ra"), F.when(below, b).otherwise(F.col("rb")).alias("rb"),
        F.when(below, F.slice("turns", c + 1, c)).otherwise(F.col("turns")).alias("turns"), "la", "lb", "n", "conv")
    return upper.unionByName(rest)


def trie(whole: DataFrame, path: str, height: int) -> dict[int, DataFrame]:
    """The tables of problems by height, height // 2 down to 1."""
    zero = F.lit(0).cast("long")
    none = F.lit(None).cast("long")
    at = (whole.where(F.size("turns") > 0).groupBy("turns").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv"))
          .select(F.lit(0).alias("lo"), zero.alias("ra"), zero.alias("rb"), "turns", none.alias("la"), none.alias("lb"), "n", "conv"))
    tables = {}
    at = _stored(at, f"{path}/problems-{height}")
    while height > 1:
        at = _stored(halved(at, height), f"{path}/problems-{height // 2}")
        height //= 2
        tables[height] = at
    return tables


def nodes_of(whole: DataFrame, single: DataFrame) -> DataFrame:
    """a, b (name), pa, pb (parent's), depth, conv_id, n_convs, own (saved by the node itself), n_children."""
    zero = F.lit(0).cast("long")
    none = F.lit(None).cast("long")
    edges = single.select(F.col("la").alias("a"), F.col("lb").alias("b"), F.col("ra").alias("pa"), F.col("rb").alias("pb"),
                          (F.col("lo") + 1).alias("depth"), F.col("conv").alias("conv_id"), F.col("n").alias("n_convs"),
                          ((F.col("n") - 1) * F.col("turns")[0]["n"]).alias("own"))
    root = (whole.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where(F.col("n_convs") > 0)
            .select(zero.alias("a"), zero.alias("b"), none.alias("pa"), none.alias("pb"), F.lit(0).alias("depth"), "conv_id", "n_convs", zero.alias("own")))
    children = edges.groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.count(F.lit(1)).alias("n_children"))
    return edges.unionByName(root).join(children, [*NAME], "left").withColumn("n_children", F.coalesce("n_children", zero))


# --- totals ----------------------------------------------------------------------------------------------------------

def grafted(nodes: DataFrame, tables: dict[int, DataFrame], path: str) -> DataFrame:
    """a, b, saved, leaves: what hangs below each node that has children."""
    heights = sorted(tables)
    sums = [F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves")]

    def links(c: int, lower: bool) -> DataFrame:  # from the full-height leaves of upper tries, or lower forests, to their roots
        side = F.col("lo") % (2 * c) == (c if lower else 0)
        return tables[c].where(F.col("la").isNotNull() & side).select(F.col("la").alias("a"), F.col("lb").alias("b"), "ra", "rb")

    # a forest's total, by its root: nodes of one level, then blocks of 2, 4, ... levels
    total = {1: _stored(nodes.where(F.col("depth") > 0).select(
        F.col("pa").alias("a"), F.col("pb").alias("b"), (F.col("depth") - 1).alias("depth"), F.col("own").alias("saved"),
        (F.col("n_children") == 0).cast("long").alias("leaves")).groupBy(*NAME, "depth").agg(*sums), f"{path}/forests-1")}
    for c in heights:
        at_cut = F.col("depth") % (2 * c) == c
        moved = (total[c].where(at_cut).join(links(c, False), [*NAME])
                 .select(F.col("ra").alias("a"), F.col("rb").alias("b"), (F.col("depth") - c).alias("depth"), "saved", "leaves"))
        total[2 * c] = _stored(total[c].where(~at_cut).unionByName(moved).groupBy(*NAME, "depth").agg(*sums), f"{path}/forests-{2 * c}")
    top = max(total)
    held = None
    for c in reversed(heights):
        grafts = total[c].where(F.col("depth") % (2 * c) == c).select(*NAME, "saved", "leaves")
        if held is not None:  # a leaf of a lower forest keeps what it holds and passes it to the cut above
            both = F.array(F.struct("a", "b"), F.struct(F.col("ra").alias("a"), F.col("rb").alias("b")))
            passed = held.join(links(c, True), [*NAME]).select(F.inline(both), "saved", "leaves")
            grafts = grafts.unionByName(passed)
        held = grafts.groupBy(*NAME).agg(*sums)
    return held.unionByName(total[top].select(*NAME, "saved", "leaves"))


# --- digests of the conversations that end at a node -----------------------------------------------------------------

def _blocks(batches):
    """Sorted rows (a, b, conv_id) of one task -> per node its digest, or its numbers in blocks where it touches an end of the task's range."""
    node, first, held, size, at, whole = None, None, [], 0, None, False
    out: list[tuple] = []

    def block():
        nonlocal held, size, at
        out.append((*node, at, ",".join(held).encode(), None))
        held, size, at = [], 0, None

    for pdf in batches:
        for a, b, conv in zip(pdf["a"].tolist(), pdf["b"].tolist(), pdf["conv_id"].tolist(), strict=True):
            if node != (a, b):
                if node is not None:
                    if whole:
                        out.append((*node, at, None, hashlib.sha256(",".join(held).encode()).hexdigest()))
                        held, size, at = [], 0, None
                    elif held:
                        block()
                whole = node is not None  # the task's first node may have begun before
                node = (a, b)
            if at is None:
                at = conv
            held.append(str(conv))
            size += len(held[-1]) + 1
            if size >= BLOCK:
                block()
                whole = False
        yield pd.DataFrame(out, columns=["a", "b", "at", "block", "sha"])
        out = []
    if node is not None:
        if held:
            block()
        yield pd.DataFrame(out, columns=["a", "b", "at", "block", "sha"])


def _digested(batches):
    """Sorted blocks -> one digest per node."""
    node, digest = None, None
    for pdf in batches:
        out = []
        for a, b, block in zip(pdf["a"].tolist(), pdf["b"].tolist(), pdf["block"], strict=True):
            if node != (a, b):
                if node is not None:
                    out.append((*node, digest.hexdigest()))
                node, digest = (a, b), hashlib.sha256()
            elif len(block):
                digest.update(b",")
            digest.update(block)
        yield pd.DataFrame(out, columns=["a", "b", "sha"])
    if node is not None:
        yield pd.DataFrame([(*node, digest.hexdigest())], columns=["a", "b", "sha"])


def end_digests(ends: DataFrame, path: str) -> DataFrame:
    """a, b, sha from a, b, conv_id: SHA-256 of each node's numbers in ascending order, joined by commas."""
    run = _stored(ends.repartitionByRange("a", "b", "conv_id").sortWithinPartitions("a", "b", "conv_id")
                  .mapInPandas(_blocks, "a long, b long, at long, block binary, sha string"), f"{path}/ends")
    parts = (run.where(F.col("sha").isNull()).select("a", "b", "at", "block").repartition("a", "b").sortWithinPartitions("a", "b", "at")
             .mapInPandas(_digested, "a long, b long, sha string"))
    return run.where(F.col("sha").isNotNull()).select("a", "b", "sha").unionByName(parts)


# --- the whole -------------------------------------------------------------------------------------------------------

def prefix_trie(whole: DataFrame, path: str | None = None) -> DataFrame:
    """One row per node of the trie of ``whole`` (conv_id, turns: array of (a, b, n)); see the module's text."""
    spark = whole.sparkSession
    path = path or scratch_path(spark, "conversation-trie")
    longest = whole.agg(F.max(F.size("turns"))).first()[0] or 0
    height = 2
    while height <= longest:
        height *= 2
    tables = trie(whole, path, height)
    nodes = _stored(nodes_of(whole, tables[1].where(F.size("turns") > 0)), f"{path}/nodes")
    below = grafted(nodes, tables, path)
    digests = end_digests(whole.select(end_name(F.col("turns"), height).alias("name"), "conv_id").select("name.a", "name.b", "conv_id"), path)
    parents = nodes.where(F.col("n_children") > 0).select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    zero = F.lit(0).cast("long")
    return (nodes.join(below, [*NAME], "left").join(digests, [*NAME], "left").join(parents, ["pa", "pb"], "left").select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children",
        F.when(F.col("n_children") == 0, F.lit(1)).otherwise(F.coalesce("leaves", zero)).cast("long").alias("n_leaves"),
        (F.col("own") + F.coalesce("saved", zero)).alias("saved_tokens"), F.coalesce("sha", F.lit(EMPTY)).alias("ends_sha256")))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "conversation-trie")
    own = _stored(sequences(common.table(spark, sf_dir, "conversations")), f"{path}/own")
    return prefix_trie(_stored(rebuilt(own), f"{path}/rebuilt"), path)


#: DuckDB SQL of the same rows: a node is the list of its first turns.
ORACLE = """
with bits as (select list_reduce([k] || range(8), lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) v, k
              from range(256) t(k)),
crc as (select list(v order by k) tbl from bits),
turns as (select conv_id, turn, coalesce(role, '') role, coalesce(text, '') text from conversations where conv_id is not null),
own as (select conv_id, list({'r': role, 't': text} order by turn nulls first, role, text) turns,
               list_transform(string_split(conv_id::varchar, ''), lambda ch: ascii(ch)::bigint) bytes from turns group by conv_id),
headed as (select conv_id, turns, xor(list_reduce([4294967295] || bytes, lambda c, b: xor(c >> 8, tbl[(xor(c, b) & 255) + 1])), 4294967295) % 6 h
           from own, crc),
seqs as (select x.conv_id, coalesce(b.turns[1:x.h], []) || x.turns[x.h + 1:] s from headed x left join own b on b.conv_id = x.conv_id - x.conv_id % 100),
members as (select conv_id, d, s[1:d] p, len(s) = d ends from (select conv_id, s, unnest(range(len(s) + 1)) d from seqs)),
nodes as (select d, p, min(conv_id) conv_id, count(*) n_convs,
                 sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where ends), '')) ends_sha256,
                 case when d = 0 then 0 else (count(*) - 1) * length(p[d].t) end own
          from members group by d, p),
children as (select d - 1 d, p[1:d - 1] p, count(*) n_children from nodes where d > 0 group by 1, 2),
full_nodes as (select n.*, coalesce(c.n_children, 0) n_children from nodes n left join children c on c.d = n.d and c.p = n.p),
below as (select j d, p[1:j] p, sum(own) saved_tokens, sum((n_children = 0)::int) n_leaves
          from (select *, unnest(range(d + 1)) j from full_nodes) group by 1, 2)
select n.conv_id::bigint conv_id, n.d::bigint depth, q.conv_id::bigint parent_conv_id, n.n_convs::bigint n_convs,
       n.n_children::bigint n_children, b.n_leaves::bigint n_leaves, b.saved_tokens::bigint saved_tokens, n.ends_sha256
from full_nodes n join below b on b.d = n.d and b.p = n.p left join full_nodes q on q.d = n.d - 1 and q.p = n.p[1:n.d - 1]
"""
