"""N-gram Jaccard join by a token-group matrix: which documents are linked, and their components.

A document's set holds its distinct ``gram``-word shingles (A-Z lower-cased; the whole sequence as
one when it is shorter).  Two documents link when 100 * |intersection| >= ``percent`` * |union|.
The query takes four words and 85, the pipeline stage five words and 80.

1. *Equal sets* become one node (an aggregate combined before the shuffle), so copies are never
   paired; from here on only nodes with different sets are compared.
2. *Index.*  Tokens have one global order: first those that are not frequent in a bounded sample
   of documents, by hash, then the frequent ones.  Linked sets share one of their first
   n - ceil(percent n / 100) + 1 tokens in any such order, so only these are indexed, in lists by token
   and size class; the sample decides how short the lists are, never what is found.
3. *Groups.*  In every list all nodes meet one leader, first the one with the least tokens of its own; each node is compared with the leader it
   shares most lists with, and links merge nodes into groups of similar documents.  A few rounds
   with other leaders merge what the first missed.  This costs one comparison per node and
   round, never a pair of all members.
4. *Token-group matrix.*  The index tokens of each group are united.  What a node shares with the
   union, and the sizes in the group, bound its overlap with every member; only groups where
   the bound allows a link are opened, and the node is compared with those members.  Every pair
   in different groups that can link is compared here, so no link is lost.

A comparison first looks at the two index prefixes alone: tokens of one that are not in the
other, up to the smaller of their last tokens, cannot be in the other at all, which bounds the
intersection.  Only pairs that pass get their whole sets, read again from the texts, and the
exact count decides.

Nothing is capped.  Components are found by alternating large and small stars on edges in
tables; hot keys are split by the adaptive skew join and by ``hot_split``.

Defined results: rows with equal sets form one component; empty or NULL text has an empty set
(n_shingles 0), is linked with nothing and is its own component.  Rows without a doc_id are
compared with nothing and have no component.  Different texts under one doc_id are compared
as different documents, each with its own row.  Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from issuelens.llm.text import WordHash, count_floor, gram_hashes, hash_words, hot_split, in_arrow, mix, read_table, schema_of, steps_of, with_id, written

GRAM = 4
PERCENT = 85
# of the pipeline stage
STAGE_GRAM = 5
STAGE_PERCENT = 80
SAMPLE_SHARE = 1 / 8
SAMPLE_DOCS = 8192             # at least
SAMPLE_OFTEN = 3
MAX_FREQUENT = 2_000_000       # frequent tokens that every task gets: 16 MB
LEADER_ROUNDS = 2
# Ids up to this many are broadcast to pick rows out of a large table; more are joined by shuffle.
MAX_BROADCAST_IDS = 500_000
FREQUENT_BIT = 1 << 63


def token_set(text: bytes | None, memory: WordHash, gram: int = GRAM) -> np.ndarray:
    """The distinct shingle hashes of a text, ascending."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = hash_words(words, memory)
    if len(words) < gram:
        return gram_hashes(h, len(words)) ^ np.uint64(len(words))
    return np.unique(gram_hashes(h, gram))


def needed(n: Column | np.ndarray | int, percent: int = PERCENT):
    """Common tokens that a set of n needs at least with any set it links to."""
    return (percent * n + 99) // 100


def frequent_tokens(docs: DataFrame, text: str, key: Column, share: float = SAMPLE_SHARE, sample_docs: int = SAMPLE_DOCS,
                    often: int = SAMPLE_OFTEN, most: int = MAX_FREQUENT, gram: int = GRAM) -> np.ndarray:
    """Tokens that stand in ``often`` or more documents of a hashed sample: a share of all, ``sample_docs`` at least.

    With a share, "frequent" means some ``often / share`` documents however large the corpus
    is, so index lists stay that short.  At most ``most`` tokens, the most frequent ones.
    """
    total = docs.count()
    if not total:
        return np.zeros(0, np.uint64)
    part = min(1.0, max(share, sample_docs / total))
    drawn = docs.filter(F.pmod(F.xxhash64(key.cast("string"), F.lit("sample")), F.lit(1_000_000)) < 1e6 * part)
    schema = schema_of("token long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = WordHash()
        for b in batches:
            for t in b.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(token_set(t.as_py(), memory, gram).view(np.int64))], schema=schema)

    counts = written(in_arrow(drawn.select(F.col(text).cast("binary").alias("text")), run, "token long")
                     .groupBy("token").agg(F.count("*").alias("n")).filter(F.col("n") >= often), "frequent")
    floor = count_floor(counts, "n", most)
    if floor is None:
        return np.zeros(0, np.uint64)
    found = counts.filter(steps_of("n") >= floor).select("token").toArrow().column(0)
    return np.sort(found.to_numpy().view(np.uint64))


def is_in(tokens: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(tokens), bool)
    at = np.minimum(np.searchsorted(ordered, tokens), len(ordered) - 1)
    return ordered[at] == tokens


def set_table(docs: DataFrame, doc_id: str, text: str, frequent: np.ndarray, gram: int = GRAM, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n, k1, k2, index): size, 128-bit identity and index tokens of every row's set."""
    held = docs.sparkSession.sparkContext.broadcast(frequent)
    out = with_id(docs, doc_id, "n long, k1 long, k2 long, index array<long>")
    schema = schema_of(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory, often = WordHash(), held.value
        for b in batches:
            made = []
            for t in b.column(1):
                s = token_set(t.as_py(), memory, gram)
                keys = [mix(s + np.uint64(c)).sum(dtype=np.uint64).view(np.int64) for c in (0, 1)]
                prefix = len(s) - needed(len(s), percent) + 1 if len(s) else 0
                # 63 bits of the hash below a bit for frequent tokens, shifted to sort as signed numbers
                ranked = (s >> np.uint64(1)) | (is_in(s, often).astype(np.uint64) << np.uint64(63))
                ranked = np.sort(ranked)[:prefix] if len(often) else ranked[:prefix]
                made.append((len(s), int(keys[0]), int(keys[1]), (ranked ^ np.uint64(FREQUENT_BIT)).view(np.int64)))
            cols = list(zip(*made)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, f.type) for c, f in zip(cols, list(schema)[1:])]], schema=schema)

    return in_arrow(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text")), run, out)


def sets_of(docs: DataFrame, doc_id: str, text: str, nodes: DataFrame, gram: int = GRAM) -> DataFrame:
    """(node, n, tokens) of ``nodes`` (node, n, rep, k1, k2), read again from their first documents' texts."""
    out = with_id(docs, doc_id, "k1 long, k2 long, tokens array<long>")
    schema = schema_of(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = WordHash()
        for b in batches:
            sets = [token_set(t.as_py(), memory, gram) for t in b.column(1)]
            keys = [[int(mix(s + np.uint64(c)).sum(dtype=np.uint64).view(np.int64)) for s in sets] for c in (0, 1)]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(k, pa.int64()) for k in keys],
                                              pa.array([s.view(np.int64) for s in sets], schema.field(3).type)], schema=schema)

    wanted = few(written(nodes.select(F.col("rep").alias("doc_id")).distinct(), "wanted"))
    first = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text")).join(wanted, "doc_id", "left_semi")
    return in_arrow(first, run, out).distinct().join(nodes.withColumnRenamed("rep", "doc_id"), ["doc_id", "k1", "k2"]) \
        .select("node", "n", "tokens")


def possible(pairs: DataFrame, prefixes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) that sizes and index prefixes allow to link; ``prefixes`` is (node, n, index)."""
    pairs = written(pairs, "pairs")            # read three times below
    some = picked(prefixes, pairs)
    side = lambda x: some.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("index").alias(f"i{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b") \
        .filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")) \
        .withColumn("last", F.least(F.element_at("ia", -1), F.element_at("ib", -1)))
    upto = lambda x: F.size(F.filter(f"i{x}", lambda t: t <= F.col("last")))
    rest = F.least(F.col("na") - upto("a"), F.col("nb") - upto("b"))
    most = F.size(F.array_intersect("ia", "ib")) + rest
    return both.filter((100 + percent) * most >= percent * (F.col("na") + F.col("nb"))).select("a", "b").distinct()


def few(ids: DataFrame) -> DataFrame:
    """``ids``, to be broadcast when they are at most ``MAX_BROADCAST_IDS``; more are left to a shuffled join."""
    return F.broadcast(ids) if ids.limit(MAX_BROADCAST_IDS + 1).count() <= MAX_BROADCAST_IDS else ids


def picked(table: DataFrame, pairs: DataFrame) -> DataFrame:
    """The rows of ``table`` (node, ...) whose node is in one of the pairs."""
    nodes = written(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "picked")
    return table.join(few(nodes), "node", "left_semi")


def linked(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) of nodes whose sets link, by the exact size of the intersection."""
    some = picked(sets, pairs)
    a = some.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    b = some.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    both = F.size(F.array_intersect("ta", "tb"))
    return pairs.join(a, "a").join(b, "b").filter(100 * both >= percent * (F.col("na") + F.col("nb") - both)).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for all nodes of ``edges`` (a, b): the smallest node that is reachable.

    Alternating large and small stars until every node points at one end that points nowhere;
    each round is a table.
    """
    def stars(e: DataFrame) -> bool:
        rows, nodes = e.agg(F.count("*"), F.countDistinct("u")).first()
        return rows == nodes and e.join(e.select(F.col("v").alias("u")), "u", "left_semi").isEmpty()

    e = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while not stars(e):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(lowest, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        pointed = large.join(lowest, "u")
        e = written(pointed.select("u", F.col("m").alias("v")).unionByName(
            pointed.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct(), "edges")
    found = e.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return found.unionByName(found.select(F.col("label").alias("node"), "label").distinct())


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after joining the groups of linked nodes."""
    of = lambda name: labels.select(F.col("node").alias(name), F.col("label").alias(f"l{name}"))
    between = links.join(of("a"), "a").join(of("b"), "b").select(F.col("la").alias("a"), F.col("lb").alias("b")).distinct()
    found = components(between).select(F.col("node").alias("label"), F.col("label").alias("new"))
    return written(labels.join(found, "label", "left").select("node", F.coalesce("new", "label").alias("label")), "labels")


def listed_entries(entries: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(key, token, node, n, most, own, early, home): the lists by token and size class, those with two nodes or more.

    ``entries`` has the index tokens (token, node, n, place, early) that two nodes or more have.  A node's
    other index tokens may lie in another set behind its index.  But a node that holds ``token`` in its
    index has there all its tokens before it, so of those that only one index holds none is common:
    ``most`` = n less the node's own ones before ``token`` bounds every intersection of the token's nodes.
    ``own`` is the share of its set that its whole index holds alone.
    Sizes of linked sets differ by less than one class, so a node stands in its own class (home)
    and, as a guest, in the next; two nodes meet once, unless both are guests.
    """
    shared_before = F.dense_rank().over(Window.partitionBy("node").orderBy("place")) - 1
    own = (F.col("n") - F.ceil(F.col("n") * percent / 100) + 1 - F.count("*").over(Window.partitionBy("node"))) / F.col("n")
    level = F.floor(F.log("n") / F.log(F.lit(100 / percent))).cast("int")
    places = F.array(F.struct(level.alias("level"), F.lit(True).alias("home")), F.struct((level + 1).alias("level"), F.lit(False).alias("home")))
    each = entries.withColumn("most", F.col("n") - (F.col("place") - shared_before)).withColumn("own", own) \
        .select("token", "node", "n", "most", "own", "early", F.explode(places).alias("p")) \
        .select(F.xxhash64("token", "p.level").alias("key"), "token", "node", "n", "most", "own", "early", "p.home")
    several = each.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.max("home").alias("homes")) \
        .filter("low < high and homes").select("key")
    return each.join(several, "key")


def within(most: Column, n: Column, other: Column, percent: int) -> Column:
    """Whether an intersection of ``most`` is enough for sets of n and ``other`` to link."""
    return (100 + percent) * most >= percent * (n + other)


def least_common(n: Column, other: Column, percent: int) -> Column:
    """Index tokens a set of n shares at least with a linked set of size ``other``."""
    rest = lambda x: F.ceil(x * percent / 100) - 1
    return F.ceil((n + other) * percent / (100 + percent)) - F.greatest(rest(n), rest(other))


def group_pairs(lists: DataFrame, labels: DataFrame, sizes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs (a, b) of nodes of different groups that the token-group matrix lets through.

    ``lists`` has (key, token, node, n, most, home), ``labels`` the group of each node, ``sizes``
    (node, n).  ``most`` holds for the token's list, and so does ``o_top``, the group's highest there:
    a pair that can link passes in each of its common lists.  Of two groups the nodes of the
    smaller one are held against the larger one's union.
    A group of one node is its own union: two such nodes make a pair where an early token of the
    smaller set is in the other's index, and ``possible`` counts what they share.
    """
    listed = lists.join(labels, "node")
    several = listed.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("key")
    groups = sizes.join(labels, "node").groupBy("label").agg(
        F.count("*").alias("members"), F.min("n").alias("smallest"), F.max("n").alias("largest"))
    listed = written(listed.join(several, "key").join(groups, "label"), "listed")
    matrix = listed.groupBy("key", "label").agg(F.max("home").alias("homes"), F.max("early").alias("o_early"), F.max("most").alias("o_top"),
                                                *[F.first(c).alias(f"o_{c}") for c in ("members", "smallest", "largest")])
    low = F.greatest("o_smallest", F.ceil(F.col("n") * percent / 100))
    high = F.least("o_largest", F.floor(F.col("n") * 100 / percent))
    meets = ((F.struct("members", "label") < F.struct(F.col("o_members"), F.col("other"))) & (F.col("home") | F.col("homes"))
             & (low <= high) & within(F.least("most", "o_top"), F.col("n"), low, percent)
             & ((F.col("o_members") > 1) | F.when(F.col("n") <= F.col("o_smallest"), F.col("early")).otherwise(F.col("o_early"))))
    asked = listed.join(matrix.withColumnRenamed("label", "other"), "key").filter(meets)
    shared = asked.select("node", "n", "other", "o_members", "token", low.alias("low"), high.alias("high")).distinct() \
        .groupBy("node", "n", "other", "o_members", "low", "high").agg(F.count("*").alias("common"))
    # the bound is lowest at one end of the sizes that can link
    enough = F.col("common") >= F.least(least_common(F.col("n"), F.col("low"), percent), least_common(F.col("n"), F.col("high"), percent)) - 1
    found = written(shared.filter((F.col("o_members") == 1) | enough).select("node", "other", "o_members"), "open")
    # the label of a group of one is its node
    single = found.filter("o_members = 1").select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))
    open_ = found.filter("o_members > 1").drop("o_members")
    # as for two single nodes, the smaller set's early tokens are enough to meet at
    inside = listed.select("key", F.col("node").alias("member"), F.col("label").alias("other"), F.col("home").alias("m_home"),
                           F.col("n").alias("m_n"), F.col("most").alias("m_most"), F.col("early").alias("m_early"))
    fits = ((F.col("home") | F.col("m_home")) & F.when(F.col("n") <= F.col("m_n"), F.col("early")).otherwise(F.col("m_early"))
            & within(F.least("most", "m_most"), F.col("n"), F.col("m_n"), percent))
    return listed.select("key", "node", "n", "most", "early", "home").join(open_, "node").join(inside, ["key", "other"]).filter(fits) \
        .select(F.least("node", "member").alias("a"), F.greatest("node", "member").alias("b")).unionByName(single).distinct()


def leader_pairs(lists: DataFrame, labels: DataFrame, turn: int, percent: int = PERCENT) -> DataFrame:
    """For each node the leader of another group that it shares most lists with, as pairs (a, b).

    A list's leader is first the node with the least own tokens: what others were copied from shares all it
    has with them, while a copy's changes are its own, so copies that link only to it meet it and not
    each other.  Later turns take others.
    Nodes that meet it in less than a tenth of their index are left to the token-group matrix.
    """
    rank = F.struct(F.lit(0.0) if turn else F.col("own"), F.xxhash64("node", F.lit(turn)), "node")
    listed = lists.join(labels, "node")
    leaders = listed.groupBy("key").agg(F.min(rank)["node"].alias("leader"), F.min_by("label", rank).alias("leader_label"),
                                        F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high")
    met = listed.join(leaders, "key").filter(F.col("label") != F.col("leader_label")).groupBy("node", "n", "leader").agg(F.count("*").alias("met"))
    best = met.filter(1000 * F.col("met") >= (100 - percent) * F.col("n")).groupBy("node").agg(F.max(F.struct("met", F.col("leader"))).alias("best"))
    return best.select(F.least("node", "best.leader").alias("a"), F.greatest("node", "best.leader").alias("b")).distinct()


def joined(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", gram: int = GRAM, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``."""
    frequent = frequent_tokens(docs, text, F.col(doc_id), gram=gram)
    table = written(set_table(docs, doc_id, text, frequent, gram, percent), "sets")
    named = table.filter("doc_id is not null and n > 0")
    nodes = written(named.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.count("*").alias("n_left"))
                    .withColumn("node", F.monotonically_increasing_id()), "nodes")
    firsts = named.select("k1", "k2", F.col("doc_id").alias("rep"), "index").join(nodes.drop("n_left"), ["k1", "k2", "rep"])
    # one exchange by token counts its nodes and passes on the rows; a token stands once in a
    # node's prefix, so even a token of every node is but one in the prefix length of all rows
    by_token = Window.partitionBy("token")
    # early: among the first tokens that two linked sets share one of where this is the smaller set
    early = F.col("place") < F.col("n") - F.ceil(F.col("n") * (2 * percent) / (100 + percent)) + 1
    entries = firsts.select("node", "n", F.posexplode("index").alias("place", "token")).select("node", "n", "token", "place", early.alias("early")) \
        .withColumn("several", F.count("*").over(by_token) > 1).filter("several").drop("several")
    lists = written(listed_entries(written(entries, "entries"), percent), "lists")
    sizes = written(lists.select("node", "n").distinct(), "sizes")
    prefixes = written(firsts.select("node", "n", "index").join(few(sizes.select("node")), "node", "left_semi"), "prefixes")
    labels = written(sizes.select("node", F.col("node").alias("label")), "labels")

    def sets_for(pairs: DataFrame) -> DataFrame:
        return written(sets_of(docs, doc_id, text, picked(nodes.select("node", "n", "rep", "k1", "k2"), pairs), gram), "tokens")

    sets = None
    for turn in range(LEADER_ROUNDS):
        pairs = written(possible(leader_pairs(lists, labels, turn, percent), prefixes, percent), "pairs")
        if pairs.isEmpty():
            break
        more = pairs if sets is None else missing(pairs, sets)
        sets = sets_for(pairs) if sets is None else (sets if more.isEmpty() else sets.unionByName(sets_for(more)))
        links = written(linked(pairs, sets, percent), "links")
        if links.isEmpty():
            break
        labels = merged(labels, links)
    pairs = written(possible(group_pairs(lists, labels, sizes, percent), prefixes, percent), "pairs")
    if not pairs.isEmpty():
        more = pairs if sets is None else missing(pairs, sets)
        sets = sets_for(pairs) if sets is None else (sets if more.isEmpty() else sets.unionByName(sets_for(more)))
        labels = merged(labels, written(linked(pairs, sets, percent), "links"))
    lowest = labels.join(nodes.select("node", "rep"), "node").groupBy("label").agg(F.min("rep").alias("component_id"))
    of_set = nodes.join(labels.join(lowest, "label").select("node", "component_id"), "node", "left") \
        .select("k1", "k2", F.coalesce("component_id", "rep").alias("component_id"), "n_left")
    rows = table.select("doc_id", F.col("n").alias("n_shingles"), "k1", "k2")
    alone = rows.filter("doc_id is null or n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return hot_split(rows.filter("doc_id is not null and n_shingles > 0"), ["k1", "k2"], written(of_set, "members")) \
        .select("doc_id", "n_shingles", "component_id").unionByName(alone)


def missing(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Nodes of the pairs that have no set yet, as pairs with themselves."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    return written(nodes.join(sets.select("node"), "node", "left_anti").select(F.col("node").alias("a"), F.col("node").alias("b")), "missing")


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document."""
    return joined(read_table(spark, sf_dir, "documents"))


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each group of linked documents the one with the smallest doc_id stays.

    Rows with equal doc_id and text leave one row; rows without a doc_id all stay.
    """
    away = joined(docs, gram=STAGE_GRAM, percent=STAGE_PERCENT).filter("component_id <> doc_id").select("doc_id").distinct()
    stay = docs.join(away, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
    return stay.filter("doc_id is not null").dropDuplicates(["doc_id", "text"]).unionByName(stay.filter("doc_id is null"))
