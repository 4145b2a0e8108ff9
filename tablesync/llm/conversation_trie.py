"""Conversation prefix trie by whole-sequence collapse.

A node of the trie is a distinct prefix of a conversation's turns.  No prefix text is
ever built: every turn becomes two 56-bit numbers drawn from the SHA-256 of its depth,
role and text, and a prefix is known by its depth and the exact sums of its turns'
numbers, so prefixes come from running sums.

1. Conversations with the same sums are one *weighted sequence*; the ids that end there
   are kept beside it as a list, cut into blocks of ``1 << ID_BITS`` ids.
2. Only one conversation of each sequence is expanded to its prefixes.  Sequences that
   are a proper prefix of another one fall out by an anti-join; the rest are the leaves.
3. The weighted prefixes are aggregated per node.  What a node's subtree holds follows
   from its own sequences and needs no pairs of ancestors: all characters from the node
   down are weighted suffix lengths; the characters of the *distinct* nodes there are
   suffix lengths of leaf sequences, each node counted on the smallest leaf through it
   (the nodes of one leaf then form one stretch that reaches its end, so one number a
   leaf tells where it begins).

Work and shuffles grow with the turns, whatever the depth.  Positions and running sums
are taken in blocks of a conversation, so a very long one is no single window; a
sequence or first turn that a third of all conversations share is one row after a
partial aggregate.  A node's list of ids goes through one SHA-256, which is serial by
definition: it is streamed, never held, and arrives as blocks of up to 4,096 ids.

Defined results: rows of a null ``conv_id`` belong to no conversation and are left out;
null turns come first, equal turns are ordered by role and text; repeated rows are turns
of their own; an empty table gives no node, not even a root; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablesync.llm.common import stored, table

TURN_BITS = 8  # turns whose numbers agree above these bits are numbered in one window
DEPTH_BITS = 10  # depths that are summed in one window
ID_BITS = 12  # ids of one block of an end list
ROOT = "0:0:0"
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def numbered(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, text) -> conv, pos (from 1), digest, chars: the turns in order."""
    block = F.coalesce(F.shiftright("turn", TURN_BITS), F.lit(-(1 << 62)))  # nulls first
    rows = rows.withColumn("block", block)
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy("conv", "block")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("conv", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    )
    inside = Window.partitionBy("conv", "block").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return (
        rows.withColumn("place", F.row_number().over(inside))
        .join(starts, ["conv", "block"])
        .select(
            "conv",
            (F.col("start") + F.col("place")).alias("pos"),
            F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("digest"),
            F.length("text").cast("long").alias("chars"),
        )
    )


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The contract's conversations: (conv) of each, and (conv, d, digest, chars) of their turns.

    Conversation c takes the first h turns of conversation c - c % 100, then its own
    turns after its first h; h is the CRC-32 of its decimal id modulo 6.
    """
    turns = stored(
        numbered(
            conversations.filter("conv_id IS NOT NULL").select(
                F.col("conv_id").cast("long").alias("conv"),
                F.col("turn").cast("long").alias("turn"),
                F.coalesce("role", F.lit("")).alias("role"),
                F.coalesce("text", F.lit("")).alias("text"),
            )
        ),
        "trie-turns",
    )
    taken = F.pmod(F.crc32(F.col("conv").cast("string")), F.lit(6))
    sizes = turns.groupBy("conv").agg(F.max("pos").alias("n"))
    bases = sizes.filter("conv % 100 = 0").select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    convs = (
        sizes.select("conv", (F.col("conv") - F.col("conv") % 100).alias("base"), taken.alias("h"))
        .join(bases, "base", "left")
        .select("conv", "base", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("head"))
    )
    openings = turns.filter("conv % 100 = 0 AND pos <= 5").withColumnRenamed("conv", "base")  # at most five a base
    heads = convs.join(openings, "base").filter("pos <= head").select("conv", F.col("pos").alias("d"), "digest", "chars")
    tails = (
        turns.filter(F.col("pos") > taken)
        .join(convs.select("conv", "h", "head"), "conv")
        .select("conv", (F.col("pos") - F.col("h") + F.col("head")).alias("d"), "digest", "chars")
    )
    return sizes.select("conv"), heads.union(tails)


def running(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Adds ``<column>_to``: each column's sum over the conversation's depths up to the row's."""
    rows = rows.withColumn("block", F.shiftright("d", DEPTH_BITS))
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("conv", "block").agg(*(F.sum(c).alias(c) for c in columns))
    starts = sums.select(
        "conv", "block", *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_start") for c in columns)
    )
    inside = Window.partitionBy("conv", "block").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.select("*", *(F.sum(c).over(inside).alias(f"{c}_in") for c in columns)).join(starts, ["conv", "block"])
    to = lambda c: (F.col(f"{c}_start") + F.col(f"{c}_in")).alias(f"{c}_to")
    return summed.select(*(c for c in rows.columns if c != "block"), *map(to, columns))


def node_key(depth: Column, first: Column, second: Column) -> Column:
    text = lambda c: c.cast("decimal(38,0)").cast("string")
    return F.concat_ws(":", depth.cast("string"), text(first), text(second))


def end_hashes(totals: DataFrame) -> DataFrame:
    """(conv, key) -> key, ends_sha256 of the conversations that end at the node."""
    blocks = totals.groupBy("key", F.shiftright("conv", ID_BITS).alias("block")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids")
    )

    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            done = []
            for k, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if k != key:
                    if digest is not None:
                        done.append((key, digest.hexdigest()))
                    key, digest = k, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in done], pa.string()) for i in (0, 1)], ["key", "ends_sha256"])
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([digest.hexdigest()])], ["key", "ends_sha256"])

    ordered = blocks.repartition("key").sortWithinPartitions("key", "block").select("key", "ids")
    return ordered.mapInArrow(streamed, "key string, ends_sha256 string")


def prefix_trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """The nodes over conversations (conv) and their turns (conv, d from 1, digest, chars).

    key, parent_key, depth, conv_id (smallest member), parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.
    """
    drawn = F.sha2(F.concat(F.col("d").cast("string"), F.lit(":"), "digest"), 256)
    lane = lambda at: F.conv(F.substring(drawn, at, 14), 16, 10).cast("decimal(17,0)")
    turns = stored(turns.select("conv", "d", lane(1).alias("a"), lane(15).alias("b"), "chars"), "trie-rebuilt")

    # 1. weighted sequences
    sums = turns.groupBy("conv").agg(
        F.count(F.lit(1)).alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("chars").alias("total")
    )
    zero = lambda c: F.coalesce(c, F.lit(0))
    totals = stored(
        convs.join(sums, "conv", "left").select(
            "conv", node_key(zero("n"), zero("a"), zero("b")).alias("key"), zero("n").alias("n"), zero("total").alias("total")
        ),
        "trie-totals",
    )
    sequences = stored(
        totals.groupBy("key").agg(
            F.min("conv").alias("conv"), F.count(F.lit(1)).alias("weight"), F.max("n").alias("n"), F.max("total").alias("total")
        ),
        "trie-sequences",
    )

    # 2. the prefixes of one conversation of each, and the leaves
    one = sequences.select("conv", "weight", "n", "total")
    longer = running(turns.join(one, "conv"), ["a", "b", "chars"]).select(
        node_key(F.col("d"), F.col("a_to"), F.col("b_to")).alias("key"),
        node_key(F.col("d") - 1, F.col("a_to") - F.col("a"), F.col("b_to") - F.col("b")).alias("parent_key"),
        "conv", "weight", "n", "total", "d", (F.col("chars_to") - F.col("chars")).alias("before"),
    )
    roots = one.select(
        F.lit(ROOT).alias("key"), F.lit(None).cast("string").alias("parent_key"), "conv", "weight", "n", "total",
        F.lit(0).cast("long").alias("d"), F.lit(0).cast("long").alias("before"),
    )
    prefixes = stored(longer.union(roots), "trie-prefixes")
    proper = prefixes.filter("d < n").select("key").distinct()
    leaves = stored(sequences.join(proper, "key", "left_anti").select("conv"), "trie-leaves")

    # 3. weighted prefixes by node
    flagged = prefixes.join(leaves.withColumn("leaf", F.lit(1)), "conv", "left")
    nodes = stored(
        flagged.groupBy("key").agg(
            F.min("parent_key").alias("parent_key"),
            F.min("d").alias("depth"),
            F.min("conv").alias("conv_id"),
            F.sum("weight").alias("n_convs"),
            F.sum(F.col("weight") * (F.col("total") - F.col("before"))).alias("spent"),
            F.count("leaf").alias("n_leaves"),
            F.min(F.when(F.col("leaf") == 1, F.col("conv"))).alias("owner"),
            F.min("before").alias("before"),
        ),
        "trie-nodes",
    )
    stretch = nodes.groupBy(F.col("owner").alias("conv")).agg(F.min("before").alias("begins"))
    distinct = (
        prefixes.join(leaves, "conv")
        .join(stretch, "conv")
        .groupBy("key")
        .agg(F.sum(F.col("total") - F.greatest("before", "begins")).alias("distinct"))
    )
    children = nodes.filter("parent_key IS NOT NULL").groupBy(F.col("parent_key").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    return (
        nodes.join(distinct, "key")
        .join(children, "key", "left")
        .join(end_hashes(totals.select("conv", "key")), "key", "left")
        .join(parents, "parent_key", "left")
        .select(
            "key", "parent_key", "conv_id", "depth", "parent_conv_id", "n_convs",
            F.coalesce("n_children", F.lit(0)).alias("n_children"),
            "n_leaves",
            (F.col("spent") - F.col("distinct")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
        )
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(*rebuilt(table(spark, sf_dir, "conversations"))).drop("key", "parent_key")


ORACLE = """
WITH turns AS (
  SELECT conv_id AS c, list({'r': coalesce(role, ''), 't': coalesce(text, '')}
         ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS l
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
hashed AS (
  SELECT c, l, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda z: ascii(z)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                             lambda x, y: xor(x >> 1, 3988292384 * (x & 1))))) % 6 AS h
  FROM turns),
built AS (
  SELECT o.c, list_concat(CASE WHEN b.l IS NULL THEN [] ELSE b.l[1:o.h] END, o.l[o.h + 1:]) AS l
  FROM hashed o LEFT JOIN turns b ON b.c = o.c - o.c % 100),
prefixes AS (
  SELECT c, len(l) AS n, unnest(range(0, len(l) + 1)) AS d, l[1:d] AS k FROM built),
nodes AS (
  SELECT k, d, min(c) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE n = d), '')) AS ends_sha256
  FROM prefixes GROUP BY k, d),
children AS (SELECT k[1:d - 1] AS k, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
below AS (
  SELECT u.k[1:i] AS k, sum((u.n_convs - 1) * CASE WHEN u.d = 0 THEN 0 ELSE length(u.k[u.d].t) END) AS saved,
         count(*) FILTER (WHERE x.n_children IS NULL) AS n_leaves
  FROM (SELECT *, unnest(range(0, d + 1)) AS i FROM nodes) u LEFT JOIN children x ON x.k = u.k
  GROUP BY 1)
SELECT v.conv_id, v.d AS depth, p.conv_id AS parent_conv_id, v.n_convs,
       coalesce(x.n_children, 0)::BIGINT AS n_children, b.n_leaves, b.saved::BIGINT AS saved_tokens, v.ends_sha256
FROM nodes v JOIN below b ON b.k = v.k
LEFT JOIN children x ON x.k = v.k
LEFT JOIN nodes p ON v.d > 0 AND p.d = v.d - 1 AND p.k = v.k[1:v.d - 1]
"""
