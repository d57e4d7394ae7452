"""Conversation prefix trie by fixed-length block hashing.

A node of depth d is a distinct sequence of the first d turns (role, text) of conversations, its
*members*; the root is the empty sequence.

*Digests.*  A turn is hashed once (SHA-256 of role and text); texts travel no further.  The digest
of the first p turns is 128 bits, made of four running sums of 32-bit hashes of (turn hash, place):
such sums can be taken over parts of a conversation at once, so a conversation of any length is cut
into segments of ``SEGMENT`` turns and no task holds more than one of them.

*Blocks first.*  Every ``BLOCK`` turns the running digest is a block digest; conversations are
grouped by their successive block digests with one map-side combined count per (block, digest).
Where all members of a block's group also share the next block (or a group has one member), the
turns in between are a chain that every member walks: its nodes are read off the group's smallest
conversation, without comparing turns.  Only where siblings diverge inside a block (members with
other turns, or that end in it) its turn boundaries are refined: those turns alone are grouped by
their turn digests.

*Subtrees without walking them.*  A member of a node owns it when it is the smallest; who owns a node
owns all nodes below it on its path.  So a sum over the subtree is a sum over members: a childless
node is counted at its owner, and the (n_convs - 1) * code points of every node below depth d are,
member by member, the code points from depth d to just above the first node that the member
owns.  Both are one number per conversation, added up by the same two groupings.

*Ends.*  The ids of the conversations that end in a node are sorted by range, joined to texts of
bounded size in many tasks, and those are streamed in order through one SHA-256.

Defined results: conversations are ordered by turn, NULL first, equal turns by the hash of role and
text; repeated rows are turns of their own.  NULL role or text is empty.  Rows without conv_id are
left out.  Turnless (rebuilt) conversations are members of the root only.  Without conversations
there is no node, not even the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from issuelens.llm.text import hot_split, in_arrow, read_table, schema_of, sql_crc32, written
from issuelens.operators.sequence import row_number_in_order

BLOCK = 4                      # turns of a block
SEGMENT = 1024                 # turns of a conversation that one task sums up
MOST_HEAD = 5                  # turns a rebuilt conversation may take from another
GROUP = 100
IDS = 2000                     # conversation ids joined to one text
LANES = ["l0", "l1", "l2", "l3"]
KEY = ["depth", "p1", "p2"]


def said(role: Column, text: Column) -> Column:
    """SHA-256 (binary) of a turn; NULL is empty."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))


def ordered(conversations: DataFrame) -> DataFrame:
    """(conv_id, rn, n_own, said, chars): every turn hashed and numbered from 1."""
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").isNotNull().alias("has_turn"), F.coalesce("turn", F.lit(0)).alias("turn"),
        said(F.col("role"), F.col("text")).alias("said"), F.length(F.coalesce("text", F.lit(""))).cast("long").alias("chars"))
    turns = written(turns, "turns")
    return row_number_in_order(turns, ["conv_id"], ["has_turn", "turn", "said"], "rn", "n_own") \
        .select("conv_id", F.col("rn").cast("long").alias("rn"), F.col("n_own").cast("long").alias("n_own"), "said", "chars")


def whole(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns as they are: (conv_id, segment, pos, said, chars) and (conv_id, n)."""
    placed = turns.select("conv_id", F.floor((F.col("rn") - 1) / SEGMENT).alias("segment"), F.col("rn").alias("pos"), "said", "chars")
    return placed, turns.groupBy("conv_id").agg(F.max("n_own").alias("n"))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with the first h turns of their group's first one, h = crc32(conv_id) % 6.

    Own turns meet their conversation's numbers by (conv_id, segment), so a conversation that holds
    a large part of all turns is no hot key.
    """
    own = turns.groupBy("conv_id").agg(F.max("n_own").alias("n_own")) \
        .withColumn("base", F.col("conv_id") - F.col("conv_id") % GROUP).withColumn("h", F.crc32(F.col("conv_id").cast("string")) % (MOST_HEAD + 1))
    heads = turns.filter((F.col("conv_id") % GROUP == 0) & (F.col("rn") <= MOST_HEAD)).groupBy(F.col("conv_id").alias("base")) \
        .agg(F.array_sort(F.collect_list(F.struct("rn", "said", "chars"))).alias("head"))
    convs = own.join(heads, "base", "left").withColumn("head", F.slice(F.coalesce("head", F.array().cast(heads.schema["head"].dataType)), 1, F.col("h").cast("int"))) \
        .withColumn("n_head", F.size("head").cast("long")).withColumn("n", F.col("n_head") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0)))
    convs = written(convs.select("conv_id", "n_own", "n", "h", "n_head", "head"), "convs")
    taken = convs.select("conv_id", F.explode("head").alias("t")) \
        .select("conv_id", F.lit(-1).cast("long").alias("segment"), F.col("t.rn").alias("pos"), "t.said", "t.chars")
    numbers = convs.select("conv_id", "h", "n_head", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_own") - 1) / SEGMENT))).alias("segment"))
    kept = turns.withColumn("segment", F.floor((F.col("rn") - 1) / SEGMENT)).join(numbers, ["conv_id", "segment"]).filter(F.col("rn") > F.col("h")) \
        .select("conv_id", "segment", (F.col("rn") - F.col("h") + F.col("n_head")).alias("pos"), "said", "chars")
    return taken.unionByName(kept), convs.select("conv_id", "n")


def digest(lanes: list[Column]) -> list[Column]:
    return [F.xxhash64(*lanes), F.xxhash64(F.lit(1), *reversed(lanes))]


def digested(placed: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv_id, pos, block, p1, p2, q1, q2, chars, cum): the digests of the first pos turns, and of one less."""
    wide = placed.select("*", *[F.pmod(F.xxhash64("said", "pos", F.lit(i)), F.lit(1 << 32)).alias(c) for i, c in enumerate(LANES)])
    sums = wide.groupBy("conv_id", "segment").agg(*[F.sum(c).alias(c) for c in [*LANES, "chars"]])
    earlier = Window.partitionBy("conv_id").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select("conv_id", "segment", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"before_{c}") for c in [*LANES, "chars"]])
    so_far = Window.partitionBy("conv_id", "segment").orderBy("pos")
    summed = wide.select("conv_id", "segment", "pos", "chars", *LANES, *[F.sum(c).over(so_far).alias(f"sum_{c}") for c in [*LANES, "chars"]]) \
        .join(carried, ["conv_id", "segment"])
    now = [F.col(f"sum_{c}") + F.col(f"before_{c}") for c in LANES]
    (p1, p2), (q1, q2) = digest(now), digest([x - F.col(c) for x, c in zip(now, LANES)])
    return summed.select("conv_id", "pos", F.ceil(F.col("pos") / BLOCK).alias("block"), p1.alias("p1"), p2.alias("p2"), q1.alias("q1"), q2.alias("q2"),
                         "chars", (F.col("sum_chars") + F.col("before_chars")).alias("cum"))


def ends_digests(ends: DataFrame) -> DataFrame:
    """(depth, p1, p2, ends_sha256) of rows (depth, p1, p2, conv_id): the ids, ascending, joined by commas.

    A node's ids are sorted and joined in as many tasks as they fill; one task reads the joined texts in
    order, a batch at a time.
    """
    ddl = "depth long, p1 long, p2 long, first long, ids string"
    joined_schema, out_ddl = schema_of(ddl), "depth long, p1 long, p2 long, ends_sha256 string"
    out_schema = schema_of(out_ddl)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids = None, []
        made: list[tuple] = []

        def close() -> None:
            if ids:
                made.append((*key, ids[0], ",".join(map(str, ids))))

        for b in batches:
            for *k, i in zip(*(c.to_pylist() for c in b.columns)):
                if k != key or len(ids) >= IDS:
                    close()
                    key, ids = k, []
                ids.append(i)
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made), joined_schema)], schema=joined_schema)
                made.clear()
        close()
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made), joined_schema)], schema=joined_schema)

    def digest_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha, done = None, None, []

        def batch() -> pa.RecordBatch:
            got = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), out_schema)], schema=out_schema)
            done.clear()
            return got

        for b in batches:
            for *k, _, ids in zip(*(c.to_pylist() for c in b.columns)):
                if k != key:
                    if key is not None:
                        done.append((*key, sha.hexdigest()))
                    key, sha = k, hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            if done:
                yield batch()
        if key is not None:
            done.append((*key, sha.hexdigest()))
            yield batch()

    dealt = ends.select(*KEY, "conv_id").repartitionByRange(*KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id")
    joined = in_arrow(dealt, join, ddl)
    return in_arrow(joined.repartition(*KEY).sortWithinPartitions(*KEY, "first"), digest_ids, out_ddl)


def trie(placed: DataFrame, convs: DataFrame) -> DataFrame:
    """The nodes of conversations given as placed turns and (conv_id, n)."""
    convs = written(convs, "lengths")
    digests = written(digested(placed, convs), "digests")
    total = convs.agg(F.count("*").alias("n"), F.min("conv_id").alias("first")).first()
    root = digest([F.lit(0).cast("long")] * 4)
    # Conversations by successive block digests.
    blocks = digests.filter(F.col("pos") % BLOCK == 0).select("conv_id", "block", "p1", "p2")
    groups = written(blocks.groupBy("block", "p1", "p2").agg(F.count("*").alias("n_left"), F.min("conv_id").alias("first"))
                     .withColumn("members", F.col("n_left")), "groups")
    grouped = written(hot_split(blocks, ["block", "p1", "p2"], groups), "grouped")
    above = grouped.select("conv_id", (F.col("block") + 1).alias("block"), F.col("members").alias("above"), F.col("first").alias("above_first"))
    walked = convs.filter("n > 0").select("conv_id", F.explode(F.sequence(F.lit(1).cast("long"), F.ceil(F.col("n") / BLOCK))).alias("block")) \
        .join(above, ["conv_id", "block"], "left").join(grouped.select("conv_id", "block", "members"), ["conv_id", "block"], "left") \
        .withColumn("above", F.coalesce("above", F.lit(total["n"]))).withColumn("above_first", F.coalesce("above_first", F.lit(total["first"])))
    shared = F.coalesce(F.col("members") == F.col("above"), F.lit(False))
    # "lone" and "chain" blocks have the same members at every turn; in the others siblings diverge.
    walked = walked.withColumn("kind", F.when(F.col("above") == 1, "lone").when(shared, "chain").otherwise("split"))
    turns = written(digests.join(walked.filter((F.col("kind") == "split") | (F.col("conv_id") == F.col("above_first")))
                               .select("conv_id", "block", "kind", "above"), ["conv_id", "block"]), "walked")
    columns = ["depth", "p1", "p2", "q1", "q2", "conv_id", "n_convs", "chars", "cum", "kind", "block"]
    straight = turns.filter("kind <> 'split'").withColumnRenamed("pos", "depth").withColumnRenamed("above", "n_convs").select(*columns)
    refined = turns.filter("kind = 'split'").groupBy(F.col("pos").alias("depth"), "p1", "p2").agg(
        *[F.max(c).alias(c) for c in ("q1", "q2", "chars", "cum", "kind", "block")], F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
    nodes = straight.unionByName(refined.select(*columns))
    children = nodes.groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(F.count("*").alias("n_children"))
    if total["n"]:
        zero = F.lit(0).cast("long")
        top = placed.sparkSession.range(1).select(
            zero.alias("depth"), root[0].alias("p1"), root[1].alias("p2"), zero.alias("q1"), zero.alias("q2"), F.lit(total["first"]).alias("conv_id"),
            F.lit(total["n"]).alias("n_convs"), zero.alias("chars"), zero.alias("cum"), F.lit("root").alias("kind"), zero.alias("block"))
        nodes = nodes.unionByName(top)
    nodes = written(nodes.join(children, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "nodes")
    # One number per conversation: code points above the first node it owns, and whether it owns a childless node.
    owned = nodes.groupBy("conv_id").agg(F.min_by(F.col("cum") - F.col("chars"), "depth").alias("owned_from"),
                                         F.max((F.col("n_children") == 0).cast("long")).alias("leaf"))
    last = digests.groupBy("conv_id").agg(F.max_by(F.struct("p1", "p2", "cum"), "pos").alias("last"))
    finals = written(convs.join(last, "conv_id", "left").join(owned, "conv_id", "left").select(
        "conv_id", F.col("n").alias("depth"), F.coalesce("last.p1", root[0]).alias("p1"), F.coalesce("last.p2", root[1]).alias("p2"),
        F.coalesce("owned_from", "last.cum", F.lit(0).cast("long")).alias("owned_from"), F.coalesce("leaf", F.lit(0).cast("long")).alias("leaf")), "finals")
    numbers = finals.select("conv_id", "owned_from", "leaf")
    added = [F.sum("leaf").alias("n_leaves"), (F.sum("owned_from") - F.min_by("owned_from", "conv_id")).alias("not_owned")]
    every = numbers.agg(*added).first()
    at_turns = turns.filter("kind = 'split'").join(numbers, "conv_id").groupBy(F.col("pos").alias("depth"), "p1", "p2").agg(*added)
    at_blocks = grouped.filter("members > 1").join(numbers, "conv_id").groupBy("block", F.col("first").alias("conv_id"), "p1", "p2").agg(*added).drop("p1", "p2")
    lone = nodes.filter("kind = 'lone'").select("*", F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("not_owned"))
    summed = lone.unionByName(nodes.filter("kind = 'split'").join(at_turns, KEY)) \
        .unionByName(nodes.filter("kind = 'chain'").join(at_blocks, ["block", "conv_id"])) \
        .unionByName(nodes.filter("kind = 'root'").select("*", *[F.lit(every[c]).cast("long").alias(c) for c in ("n_leaves", "not_owned")]))
    saved = F.col("not_owned") - (F.col("n_convs") - 1) * (F.col("cum") - F.col("chars"))
    ends = ends_digests(finals)
    parents = nodes.filter("n_children > 0").select(
        (F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent_conv_id"),
        F.col("n_children").alias("n_left"))
    joined = written(summed.withColumn("saved_tokens", saved).join(ends, KEY, "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest()))), "summed")
    below = hot_split(joined.filter("depth > 0"), ["depth", "q1", "q2"], parents)
    found = below.unionByName(joined.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long")).select(below.columns))
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def op13(conversations: DataFrame) -> DataFrame:
    """The prefix trie of a table of turns, its conversations rebuilt."""
    return trie(*rebuilt(ordered(conversations)))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all rebuilt conversations."""
    return op13(read_table(spark, sf_dir, "conversations"))


# Every prefix is compared as a whole, and every subtree walked.
OP13_SQL = f"""
WITH hashed AS (
  SELECT conv_id, turn, coalesce(text, '') AS text,
         sha256(CAST(strlen(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '')) AS said
  FROM conversations WHERE conv_id IS NOT NULL),
turns AS (
  SELECT conv_id, said, length(text) AS chars, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, said) AS rn FROM hashed),
sizes AS (SELECT conv_id, max(rn) AS n_own FROM turns GROUP BY 1),
convs AS (
  SELECT c.conv_id, c.n_own, c.h, c.base, least(c.h, coalesce(b.n_own, 0)) AS n_head
  FROM (SELECT *, conv_id - conv_id % {GROUP} AS base, {sql_crc32("conv_id")} % {MOST_HEAD + 1} AS h FROM sizes) c
  LEFT JOIN sizes b ON b.conv_id = c.base),
rebuilt AS (
  SELECT c.conv_id, t.rn AS pos, t.said, t.chars FROM convs c JOIN turns t ON t.conv_id = c.base AND t.rn <= c.h
  UNION ALL
  SELECT c.conv_id, t.rn - c.h + c.n_head, t.said, t.chars FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.rn > c.h),
prefixes AS (
  SELECT conv_id, pos, chars, sha256(string_agg(said, '') OVER (PARTITION BY conv_id ORDER BY pos)) AS p FROM rebuilt
  UNION ALL
  SELECT conv_id, 0, 0, '' FROM convs),
paths AS (SELECT *, lag(p) OVER (PARTITION BY conv_id ORDER BY pos) AS up, max(pos) OVER (PARTITION BY conv_id) AS len FROM prefixes),
nodes AS (
  SELECT pos AS depth, p, min(conv_id) AS conv_id, count(*) AS n, max(chars) AS chars, max(up) AS up,
         coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (pos = len), '') AS ends
  FROM paths GROUP BY 1, 2),
children AS (SELECT depth - 1 AS depth, up AS p, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1, 2),
full_nodes AS (SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN children c ON c.depth = n.depth AND c.p = n.p),
sums AS (
  SELECT a.pos AS depth, a.p, sum((u.n - 1) * u.chars) AS saved, count(*) FILTER (u.n_children = 0) AS leaves
  FROM full_nodes u JOIN paths a ON a.conv_id = u.conv_id AND a.pos <= u.depth GROUP BY 1, 2)
SELECT v.conv_id, CAST(v.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, CAST(v.n AS BIGINT) AS n_convs, CAST(v.n_children AS BIGINT) AS n_children,
       CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(v.ends) AS ends_sha256
FROM full_nodes v JOIN sums s ON s.depth = v.depth AND s.p = v.p LEFT JOIN nodes up ON up.depth = v.depth - 1 AND up.p = v.up
"""
