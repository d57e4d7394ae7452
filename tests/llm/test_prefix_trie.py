"""Prefix trie against a brute-force form, over plain and rebuilt conversations, and the defined results."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from conftest import SF_SMALL
from issuelens.llm import prefix_trie

DDL = "conv_id long, turn long, role string, text string, segment string, n long"


def turn_order(r):
    role, text = r[2] or "", r[3] or ""
    return (r[1] is not None, r[1] or 0, hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest())


def conversations(rows):
    out = defaultdict(list)
    for r in sorted((r for r in rows if r[0] is not None), key=turn_order):
        out[r[0]].append((r[2] or "", r[3] or ""))
    return out


def rebuild(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = convs.get(c - c % 100, [])[:h] + turns[h:]
    return out


def brute(convs):
    members = defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
    children = defaultdict(set)
    for node in members:
        if node:
            children[node[:-1]].add(node)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        own = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += own
            leaves[node[:d]] += not children[node]
    rows = []
    for node, ids in members.items():
        ends = ",".join(str(c) for c in ids if len(convs[c]) == len(node))
        rows.append((ids[0], len(node), members[node[:-1]][0] if node else None, len(ids), len(children[node]), leaves[node], saved[node],
                     hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def made(seed, n, longest):
    rng = random.Random(seed)
    stem = [("user", "x" * i) for i in range(longest)]
    rows = []
    for c in range(n):
        keep = rng.randrange(longest)
        turns = stem[:keep] + [(rng.choice(["user", "assistant", None]), rng.choice(["a", "bb", "ß", None])) for _ in range(rng.randrange(4))]
        rows += [(c * 7 if c % 5 else c, i, *t, "clash", 1) for i, t in enumerate(turns)]
    return list({(r[0], r[1]): r for r in rows}.values())


@pytest.mark.parametrize("block,segment,ids", [(4, 1024, 2000), (1, 3, 1), (3, 2, 2)])
def test_plain_conversations(spark, monkeypatch, block, segment, ids):
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    monkeypatch.setattr(prefix_trie, "SEGMENT", segment)
    monkeypatch.setattr(prefix_trie, "IDS", ids)
    rows = made(block, 60, 14)
    turns = prefix_trie.ordered(spark.createDataFrame(rows, DDL))
    assert got(prefix_trie.trie(*prefix_trie.whole(turns))) == brute(conversations(rows))


def test_rebuilt_conversations_of_several_groups(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SEGMENT", 3)
    rng = random.Random(5)
    rows = [(c, t, "user", rng.choice(["p", "q"]) * (t + 1), "", 0) for c in [*range(0, 40), *range(100, 130), *range(201, 215)] for t in range(rng.randrange(1, 9))]
    turns = prefix_trie.ordered(spark.createDataFrame(rows, DDL))
    assert got(prefix_trie.trie(*prefix_trie.rebuilt(turns))) == brute(rebuild(conversations(rows)))


def test_defined_results(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SEGMENT", 8)
    rows = [(None, 0, "user", "x", "", 0), (1, None, "user", "first", "", 0), (1, 0, None, None, "", 0), (1, 0, "", "", "", 0),
            (2, 3, "user", "first", "", 0), (2, 3, "user", "first", "", 0), (300, 0, "user", "only", "", 0), (-7, 0, "user", "y" * 100_000, "", 0)]
    rows += [(9, i, "user", "same", "", 0) for i in range(40)] + [(8, i, "user", "same", "", 0) for i in range(40)]
    df = spark.createDataFrame(rows, DDL)
    assert got(prefix_trie.op13(df)) == brute(rebuild(conversations(rows)))
    assert prefix_trie.op13(spark.createDataFrame([], DDL)).count() == 0
    assert prefix_trie.op13(spark.createDataFrame(rows[:1], DDL)).count() == 0


def test_turnless_conversations_are_members_of_the_root(spark):
    c = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 == 5)
    rows = [(c, 0, "user", "gone", "", 0), (c + 1 if zlib.crc32(str(c + 1).encode()) % 6 else c + 2, 0, "user", "z", "", 0)]
    found = got(prefix_trie.op13(spark.createDataFrame(rows, DDL)))
    assert found == brute(rebuild(conversations(rows))) and found[0][1] == 0


def test_query_matches_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    df = prefix_trie.op13_prefix_trie(spark, SF_SMALL)
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert got(df) == brute(rebuild(conversations(rows)))
