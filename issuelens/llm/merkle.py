"""Merkle manifest of a dataset as a tree of SHA-256 midstates.

A *leaf* is the digest of a row's fields; a *parent* the digest of its children's digests (hex
text, concatenated), ``fanout`` consecutive ones at a time, the last run of a level shorter, even
one child.  A child's hex text is exactly one 64-byte block of SHA-256, so the state of a
parent's hash before each of its child slots is eight 32-bit words: parents *retain* a copy of
it per slot, as part of the written manifest.  *Folding* a replaced leaf resumes, level by level,
the retained state of its slot, and takes in the replacement and the siblings to its right only;
nothing to its left is read again.

Every group of rows (``lang``) is a tree of its own with a *subroot*; the subroots, in the order
of their groups, are the leaves of the tree above, which ends in the *root*.

*Scale.*  Rows are numbered by one range sort (a hot group is cut like any other range; a tiny
table of counts per range carries the numbers on).  ``span`` consecutive leaves (a power of the
fan-out) are one *chunk*: one task group of bounded size builds all levels of the chunk and
writes one row with its digests and states.  The chunks' tops are the leaves of the next round,
so the tree takes log(rows) / log(span) rounds.  Folding goes down the same rounds: each chunk
gets the steps above it from the chunk that holds its top, and then serves all leaves in it.

Defined results: fields that are NULL count as such (``-``), empty texts as ``0:``.  A NULL group
is a group and comes first; then groups by their UTF-8 bytes.  A NULL order column comes first;
rows with equal order columns are ordered by their leaf, so repeated rows have one order and
stay rows of their own.  A group of one row has its leaf as subroot, and a table of one group
that subroot as root.  An empty table has no rows and no root (None).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from issuelens.llm.text import in_arrow, read_table, schema_of, sql_crc32, written

FANOUT = 2
SPAN = 4096                    # leaves of a chunk at most
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_MODULUS = 7
ALL_ROWS = ""                  # the only group of the tree above the groups


# --- SHA-256 on many messages at once, with states that can be kept -----------------------------

def primes(n: int) -> list[int]:
    found: list[int] = []
    p = 2
    while len(found) < n:
        if all(p % q for q in found):
            found.append(p)
        p += 1
    return found


def cube_root(x: int) -> int:
    """The whole part of a cube root."""
    r = 1 << -(-x.bit_length() // 3)
    while r ** 3 > x:
        r = (2 * r + x // r ** 2) // 3
    return r


# The standard's constants: fractions of the square and cube roots of the first primes.
START = np.array([isqrt(p << 64) & 0xFFFFFFFF for p in primes(8)], np.uint32)
ROUND = np.array([cube_root(p << 96) & 0xFFFFFFFF for p in primes(64)], np.uint32)
HEX = np.frombuffer(b"0123456789abcdef", np.uint8)


def turned(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> np.uint32(n)) | (x << np.uint32(32 - n))


def absorbed(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """SHA-256 states (n, 8) after one more block (n, 16 words) each."""
    w = [np.ascontiguousarray(blocks[:, i]) for i in range(16)]
    for i in range(16, 64):
        a, b = w[i - 15], w[i - 2]
        w.append(w[i - 16] + (turned(a, 7) ^ turned(a, 18) ^ (a >> np.uint32(3))) + w[i - 7]
                 + (turned(b, 17) ^ turned(b, 19) ^ (b >> np.uint32(10))))
    a, b, c, d, e, f, g, h = (np.ascontiguousarray(states[:, i]) for i in range(8))
    for i in range(64):
        t = h + (turned(e, 6) ^ turned(e, 11) ^ turned(e, 25)) + ((e & f) ^ (~e & g)) + ROUND[i] + w[i]
        u = (turned(a, 2) ^ turned(a, 13) ^ turned(a, 22)) + ((a & b) ^ (a & c) ^ (b & c))
        a, b, c, d, e, f, g, h = t + u, a, b, c, d + t, e, f, g
    return states + np.stack([a, b, c, d, e, f, g, h], axis=1)


def hex_blocks(digests: np.ndarray) -> np.ndarray:
    """Digests (n, 32 bytes) as the block their hex text makes (n, 16 words)."""
    text = np.empty((len(digests), 64), np.uint8)
    text[:, 0::2], text[:, 1::2] = HEX[digests >> 4], HEX[digests & 15]
    return text.view(">u4").astype(np.uint32)


def finished(states: np.ndarray, n_blocks: np.ndarray) -> np.ndarray:
    """Digests (n, 32 bytes) of messages of whole blocks, from their states and numbers of blocks."""
    last = np.zeros((len(states), 16), np.uint32)
    bits = n_blocks.astype(np.uint64) * np.uint64(512)
    last[:, 0], last[:, 14], last[:, 15] = 0x80000000, bits >> np.uint64(32), bits & np.uint64(0xFFFFFFFF)
    return absorbed(states, last).astype(">u4").view(np.uint8).reshape(-1, 32)


def begun(n: int) -> np.ndarray:
    return np.repeat(START[None, :], n, axis=0)


def absorbed_where(states: np.ndarray, wanted: np.ndarray, digests: np.ndarray) -> np.ndarray:
    """States after the block of ``digests`` (one per wanted row) where ``wanted``, unchanged elsewhere."""
    rows = np.flatnonzero(wanted)
    if len(rows):
        states = states.copy()
        states[rows] = absorbed(states[rows], hex_blocks(digests))
    return states


# --- chunks ------------------------------------------------------------------------------------------

def level_sizes(n: int, fanout: int, n_levels: int) -> list[int]:
    """Nodes per level of a chunk of ``n`` leaves, the leaves first, after ``n_levels`` reductions."""
    out = [n]
    for _ in range(n_levels):
        out.append(-(-out[-1] // fanout))
    return out


def levels_needed(n: int, fanout: int) -> int:
    k = 0
    while n > 1:
        n, k = -(-n // fanout), k + 1
    return k


@dataclass
class Chunk:
    """All levels of a chunk: per level its digests (n, 32), per reduction the states before each child slot (n, 8)."""

    fanout: int
    levels: list[np.ndarray]
    states: list[np.ndarray]

    @classmethod
    def build(cls, leaves: np.ndarray, fanout: int, n_levels: int) -> Chunk:
        levels, kept = [leaves], []
        for _ in range(n_levels):
            below = levels[-1]
            n = -(-len(below) // fanout)
            states, before = begun(n), np.empty((len(below), 8), np.uint32)
            counts = np.minimum(fanout, len(below) - np.arange(n) * fanout)
            for slot in range(min(fanout, len(below))):
                has = counts > slot
                child = np.flatnonzero(has) * fanout + slot
                before[child] = states[has]
                states = absorbed_where(states, has, below[child])
            kept.append(before)
            levels.append(finished(states, counts))
        return cls(fanout, levels, kept)

    def packed(self) -> tuple[bytes, bytes]:
        return b"".join(x.tobytes() for x in self.levels), b"".join(x.astype("<u4").tobytes() for x in self.states)

    @classmethod
    def unpacked(cls, n: int, n_levels: int, fanout: int, digests: bytes, states: bytes) -> Chunk:
        sizes = level_sizes(n, fanout, n_levels)
        edges = np.cumsum([0, *sizes])
        all_digests = np.frombuffer(digests, np.uint8).reshape(-1, 32)
        all_states = np.frombuffer(states, "<u4").astype(np.uint32).reshape(-1, 8)
        return cls(fanout, [all_digests[a:b] for a, b in zip(edges, edges[1:])],
                   [all_states[a:b] for a, b in zip(edges[:-2], edges[1:-1])])

    def folded(self, place: np.ndarray, digests: np.ndarray, proof: np.ndarray, n_proof: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The chunk's top with the leaves at ``place`` replaced, one at a time, by ``digests``; and the states and
        numbers of blocks of the proofs (hashes over all siblings) carried on."""
        for below, before in zip(self.levels, self.states):
            slot, first = place % self.fanout, place - place % self.fanout
            count = np.minimum(self.fanout, len(below) - first)
            states = absorbed(before[place], hex_blocks(digests))              # resumed at the leaf's own slot
            for j in range(min(self.fanout, len(below))):
                has = j < count
                right, sibling = has & (j > slot), has & (j != slot)
                states = absorbed_where(states, right, below[first[right] + j])
                proof = absorbed_where(proof, sibling, below[first[sibling] + j])
                n_proof = n_proof + sibling
            digests = finished(states, count)
            place = place // self.fanout
        return digests, proof, n_proof

    def step(self, place: int, level: int) -> bytes:
        """What folding needs of one level: slot, siblings to the left and right, the state before the slot."""
        below, at = self.levels[level], place // self.fanout ** level
        first = at - at % self.fanout
        run = below[first : first + self.fanout]
        head = np.array([at - first, len(run)], "<u4").tobytes()
        return head + self.states[level][at].astype("<u4").tobytes() + np.delete(run, at - first, axis=0).tobytes()

    def steps(self, place: int) -> bytes:
        return b"".join(self.step(place, level) for level in range(len(self.states)))


def folded_above(path: bytes, digests: np.ndarray, proof: np.ndarray, n_proof: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Carry folding on through the steps above a chunk (the same for all of its leaves)."""
    at, n = 0, len(digests)
    while at < len(path):
        slot, count = np.frombuffer(path, "<u4", 2, at)
        before = np.frombuffer(path, "<u4", 8, at + 8).astype(np.uint32)
        siblings = np.frombuffer(path, np.uint8, 32 * (int(count) - 1), at + 40).reshape(-1, 32)
        at += 40 + 32 * len(siblings)
        states = absorbed(np.repeat(before[None, :], n, axis=0), hex_blocks(digests))
        for j, s in enumerate(siblings):
            block = np.repeat(hex_blocks(s[None, :]), n, axis=0)
            proof = absorbed(proof, block)
            if j >= slot:
                states = absorbed(states, block)
        n_proof = n_proof + len(siblings)
        digests = finished(states, np.full(n, count))
    return digests, proof, n_proof


def stacked(digests: Sequence[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 32)


# --- trees in Spark ----------------------------------------------------------------------------------

def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``pos`` (from 0, by ``order``, NULLs first, within the group ``grp``) and ``n``, the group's rows."""
    by = ["grp", *order, F.monotonically_increasing_id()]      # the last one deals equal rows to several ranges
    dealt = rows.repartitionByRange(*by).sortWithinPartitions("grp", *order) \
        .select("*", F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().alias("_at"))
    dealt = written(dealt, "ranges")
    counts = dealt.groupBy("grp", "_range").agg(F.count("*").alias("_rows"), F.min("_at").alias("_begin"))
    along = Window.partitionBy("grp").orderBy("_range")
    offsets = counts.select("grp", "_range", "_begin", F.sum("_rows").over(Window.partitionBy("grp")).alias("n"),
                            (F.sum("_rows").over(along) - F.col("_rows")).alias("_before"))
    return dealt.join(offsets, ["grp", "_range"]).withColumn("pos", F.col("_before") + F.col("_at") - F.col("_begin")) \
        .drop("_range", "_at", "_begin", "_before")


def span_of(fanout: int, most: int = SPAN) -> tuple[int, int]:
    """Levels and leaves of a chunk."""
    k = 1
    while fanout ** (k + 1) <= most:
        k += 1
    return k, fanout ** k


CHUNK = "grp string, chunk long, n long, n_leaves int, n_levels int, top binary, digests binary, states binary"


@dataclass
class Tree:
    """Written rounds of chunks, and the top (grp, top) of every group."""

    fanout: int
    span: int
    rounds: list[DataFrame]
    tops: DataFrame


def build(leaves: DataFrame, fanout: int = FANOUT, most: int = SPAN) -> Tree:
    """The trees over ``leaves`` (grp, pos, n, digest), one per group."""
    if fanout < 2:
        raise ValueError("a parent takes two children or more")
    n_levels, span = span_of(fanout, most)

    def reduce(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("pos")
        n = int(group["n"].iloc[0])
        levels = levels_needed(n, fanout) if n <= span else n_levels
        chunk = Chunk.build(stacked(group["digest"]), fanout, levels)
        return pd.DataFrame([(group["grp"].iloc[0], group["chunk"].iloc[0], n, len(group), levels, chunk.levels[-1].tobytes(), *chunk.packed())],
                            columns=["grp", "chunk", "n", "n_leaves", "n_levels", "top", "digests", "states"])

    rounds, nodes, tops = [], leaves.select("grp", "pos", "n", "digest"), None
    while True:
        chunks = written(nodes.withColumn("chunk", F.floor(F.col("pos") / span)).groupBy("grp", "chunk").applyInPandas(reduce, CHUNK), "chunks")
        rounds.append(chunks)
        done = chunks.filter(F.col("n") <= span).select("grp", "top")
        tops = done if tops is None else tops.unionByName(done)
        nodes = chunks.filter(F.col("n") > span).select("grp", F.col("chunk").alias("pos"), F.ceil(F.col("n") / span).alias("n"),
                                                        F.col("top").alias("digest"))
        if nodes.isEmpty():
            return Tree(fanout, span, rounds, tops)


def with_paths(tree: Tree, above: DataFrame) -> DataFrame:
    """The chunks over the leaves with ``path`` (the steps above each) and the columns of ``above`` (grp, path, ...)."""
    extra = [c for c in above.columns if c not in ("grp", "path")]
    held, nodes = None, None
    for r in range(len(tree.rounds) - 1, -1, -1):
        chunks = tree.rounds[r]
        held = chunks.filter(F.col("n") <= tree.span).join(above, "grp")
        if nodes is not None:
            held = held.unionByName(chunks.filter(F.col("n") > tree.span).join(nodes, ["grp", "chunk"]))
        held = written(held, "paths")
        if r > 0:
            nodes = child_paths(tree, held, extra).withColumnRenamed("pos", "chunk")
    return held


def child_paths(tree: Tree, chunks: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """(grp, pos, path, extra) of the leaves of chunks that have their own paths."""
    fanout = tree.fanout
    out = T.StructType([*T.StructType.fromDDL("grp string, pos long, path binary").fields, *[chunks.schema[c] for c in extra]])
    schema = schema_of(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                chunk = Chunk.unpacked(row["n_leaves"], row["n_levels"], fanout, row["digests"], row["states"])
                paths = [chunk.steps(i) + row["path"] for i in range(row["n_leaves"])]
                size = len(paths)
                places = [row["first"] + i for i in range(size)]
                yield pa.RecordBatch.from_arrays([pa.array([row["grp"]] * size, pa.string()), pa.array(places, pa.int64()), pa.array(paths, pa.binary()),
                                                  *[pa.array([row[c]] * size, schema.field(c).type) for c in extra]], schema=schema)

    return in_arrow(chunks.withColumn("first", F.col("chunk") * tree.span), run, out)


def fold(tree: Tree, above: DataFrame, replaced: DataFrame) -> DataFrame:
    """Fold rows (grp, pos, digest, ...) into the tree and the steps ``above`` its groups (grp, path, ...).

    One row per row of ``replaced``, whose other columns are kept: ``folded`` (what the top becomes
    when this leaf alone is replaced), ``proof_sha256`` (over all siblings, level by level, left to
    right) and the columns of ``above``.
    """
    fanout, span = tree.fanout, tree.span
    chunks = with_paths(tree, above)
    extra = [c for c in above.columns if c not in ("grp", "path")]
    kept = [c for c in replaced.columns if c not in ("grp", "pos", "digest")]
    out = T.StructType([*[replaced.schema[c] for c in kept], *[above.schema[c] for c in extra],
                        *T.StructType.fromDDL("folded binary, proof_sha256 binary").fields])

    def run(rows: pd.DataFrame, chunk: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame(columns=out.names)
        c = chunk.iloc[0]
        held = Chunk.unpacked(int(c["n_leaves"]), int(c["n_levels"]), fanout, c["digests"], c["states"])
        place = rows["pos"].to_numpy(np.int64) - int(c["chunk"]) * span
        folded, proof, n = held.folded(place, stacked(rows["digest"]), begun(len(rows)), np.zeros(len(rows), np.int64))
        folded, proof, n = folded_above(c["path"], folded, proof, n)
        done = rows[kept].copy()
        for name in extra:
            done[name] = [c[name]] * len(rows)
        done["folded"] = [x.tobytes() for x in folded]
        done["proof_sha256"] = [x.tobytes() for x in finished(proof, n)]
        return done

    dealt = replaced.withColumn("chunk", F.floor(F.col("pos") / span))
    return dealt.groupBy("grp", "chunk").cogroup(chunks.groupBy("grp", "chunk")).applyInPandas(run, out)


# --- manifest of a table -------------------------------------------------------------------------------

def field_text(value: Column) -> Column:
    """``-`` for NULL, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: Sequence[Column]) -> Column:
    """The leaf digest (binary) of a row's fields."""
    return F.unhex(F.sha2(F.concat(*map(field_text, fields)), 256))


@dataclass
class Manifest:
    leaves: DataFrame          # grp, pos, n, digest and the columns kept of the rows
    groups: DataFrame          # grp, path (the steps above the group's top), subroot
    tree: Tree
    root: bytes | None


def manifest(rows: DataFrame, order: Sequence[str], fanout: int = FANOUT, most: int = SPAN) -> Manifest:
    """The manifest of rows (grp, digest, ...): numbered leaves, a tree per group, the tree over the groups.

    A NULL group comes first.
    """
    keyed = rows.withColumn("grp", F.coalesce(F.concat(F.lit("="), "grp"), F.lit("")))
    leaves = written(numbered(keyed, [*order, "digest"]), "leaves")
    tree = build(leaves, fanout, most)
    subroots = numbered(tree.tops.select(F.lit(ALL_ROWS).alias("grp"), F.col("grp").alias("name"), F.col("top").alias("digest")), ["name"])
    subroots = written(subroots, "subroots")
    upper = build(subroots, fanout, most)
    root = upper.tops.first()
    start = rows.sparkSession.createDataFrame([(ALL_ROWS, b"")], "grp string, path binary")
    paths = child_paths(upper, with_paths(upper, start))
    groups = subroots.join(paths, ["grp", "pos"]).select(F.col("name").alias("grp"), "path", F.col("digest").alias("subroot"))
    return Manifest(leaves, written(groups, "groups"), tree, bytes(root["top"]) if root else None)


def verified(found: Manifest, replacement: str) -> DataFrame:
    """Every leaf folded with the digest in column ``replacement`` in its place: the leaf's other columns, ``leaf``,
    ``subroot``, ``root``, ``proof_sha256``, ``folded_root`` (hex) and ``verified``."""
    rows = found.leaves.withColumn("leaf", F.col("digest")).withColumn("digest", F.col(replacement)).drop(replacement, "n")
    text = lambda c: F.lower(F.hex(c))
    folded = fold(found.tree, found.groups, rows)
    root = F.lit(found.root.hex() if found.root else None).cast("string")
    kept = [c for c in folded.columns if c not in ("leaf", "subroot", "folded", "proof_sha256")]
    return folded.select(*kept, text("leaf").alias("leaf"), text("subroot").alias("subroot"), root.alias("root"),
                         text("proof_sha256").alias("proof_sha256"), text("folded").alias("folded_root")) \
        .withColumn("verified", F.col("folded_root") == F.col("root"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of ``documents``, every leaf proved; a seventh of the rows is tampered with."""
    docs = read_table(spark, sf_dir, "documents")
    changed = F.col("n_chars").cast("decimal(20,0)") + 1
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % TAMPER_MODULUS == 0, F.lit(False))
    rows = docs.select("doc_id", F.col("lang").alias("grp"), leaf([F.col(c) for c in FIELDS]).alias("digest"),
                       F.when(tampered, leaf([changed if c == "n_chars" else F.col(c) for c in FIELDS])).alias("other")) \
        .withColumn("offered", F.coalesce("other", "digest")).drop("other")
    return verified(manifest(rows, ["doc_id"]), "offered") \
        .select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def _sql_field(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN '-' ELSE CAST(strlen(CAST({x} AS VARCHAR)) AS VARCHAR) || ':' || CAST({x} AS VARCHAR) END"


def _sql_leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_sql_field(n_chars if f == "n_chars" else f) for f in FIELDS) + ")"


# Every level of every tree is written out; nothing is resumed.
OP11_SQL = f"""
WITH RECURSIVE
docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce('=' || lang, '') AS grp, {_sql_leaf("n_chars")} AS leaf, {_sql_leaf("n_chars + 1")} AS other,
         coalesce({sql_crc32("doc_id")} % {TAMPER_MODULUS} = 0, false) AS tampered
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY grp) AS n FROM docs),
nodes AS (
  SELECT grp, 0 AS lvl, pos, n, leaf AS h FROM leaves
  UNION ALL
  SELECT grp, lvl + 1, pos // 2, (max(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM nodes WHERE n > 1 GROUP BY grp, lvl, pos // 2),
subroots AS (
  SELECT grp, lvl AS height, h, row_number() OVER (ORDER BY grp) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS lvl, pos, n, h FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 2, (max(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM tops WHERE n > 1 GROUP BY lvl, pos // 2),
root AS (SELECT lvl AS height, h FROM tops WHERE n = 1),
siblings AS (
  SELECT l.rid, 0 AS tree, s.lvl, s.h FROM leaves l JOIN nodes s ON s.grp = l.grp AND s.pos = xor(l.pos >> s.lvl, 1)
  UNION ALL
  SELECT l.rid, 1, s.lvl, s.h FROM leaves l JOIN subroots g ON g.grp = l.grp JOIN tops s ON s.pos = xor(g.pos >> s.lvl, 1)),
proofs AS (SELECT rid, sha256(string_agg(h, '' ORDER BY tree, lvl)) AS proof FROM siblings GROUP BY rid),
low AS (
  SELECT rid, grp, 0 AS lvl, pos, other AS h FROM leaves WHERE tampered AND other IS NOT NULL
  UNION ALL
  SELECT f.rid, f.grp, f.lvl + 1, f.pos // 2, sha256(CASE WHEN f.pos % 2 = 0 THEN f.h || coalesce(s.h, '') ELSE s.h || f.h END)
  FROM low f JOIN subroots g ON g.grp = f.grp AND f.lvl < g.height LEFT JOIN nodes s ON s.grp = f.grp AND s.lvl = f.lvl AND s.pos = xor(f.pos, 1)),
high AS (
  SELECT f.rid, 0 AS lvl, g.pos, f.h FROM low f JOIN subroots g ON g.grp = f.grp AND f.lvl = g.height
  UNION ALL
  SELECT f.rid, f.lvl + 1, f.pos // 2, sha256(CASE WHEN f.pos % 2 = 0 THEN f.h || coalesce(s.h, '') ELSE s.h || f.h END)
  FROM high f JOIN root r ON f.lvl < r.height LEFT JOIN tops s ON s.lvl = f.lvl AND s.pos = xor(f.pos, 1)),
folded AS (SELECT f.rid, f.h FROM high f JOIN root r ON f.lvl = r.height)
SELECT l.doc_id, l.leaf, g.h AS subroot, (SELECT h FROM root) AS root, coalesce(p.proof, sha256('')) AS proof_sha256,
       coalesce(f.h, (SELECT h FROM root)) AS folded_root, coalesce(f.h, (SELECT h FROM root)) = (SELECT h FROM root) AS verified
FROM leaves l JOIN subroots g ON g.grp = l.grp LEFT JOIN proofs p ON p.rid = l.rid LEFT JOIN folded f ON f.rid = l.rid
"""
