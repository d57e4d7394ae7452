"""Merkle manifest: SHA-256 states, trees and folds against a brute-force form, and the defined results."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from issuelens.llm import merkle

DDL = "doc_id long, source string, lang string, n_chars int, text string, pos string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def brute_tree(digests, fanout):
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + fanout])) for i in range(0, len(levels[-1]), fanout)])
    return levels


def siblings(levels, i, fanout):
    out = []
    for level in levels[:-1]:
        first = i - i % fanout
        out.append([x for j, x in enumerate(level[first : first + fanout], first) if j != i])
        i //= fanout
    return out


def brute(rows, fanout=2):
    """(doc_id, leaf, subroot, root, proof, folded_root, verified) as the contract says, without any state kept."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, sha("".join(map(field, r[:5]))), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [brute_tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])], fanout) for g in names]
    top = brute_tree([t[-1][0] for t in trees], fanout)
    out = []
    for k, g in enumerate(names):
        for i, (_, _, leaf, r) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            tampered = list(r[:5])
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None:
                tampered[3] += 1
            h = sha("".join(map(field, tampered)))
            proof = ""
            for levels, at in ((trees[k], i), (top, k)):
                for level in levels[:-1]:
                    first = at - at % fanout
                    run = level[first : first + fanout]
                    proof += "".join(x for j, x in enumerate(run) if j != at - first)
                    run[at - first] = h
                    h, at = sha("".join(run)), at // fanout
            out.append((r[0], leaf, trees[k][-1][0], top[-1][0], sha(proof), h, h == top[-1][0]))
    return sorted(out, key=str)


def found(spark, rows, fanout=2, most=merkle.SPAN):
    docs = spark.createDataFrame(rows, DDL)
    changed = F.col("n_chars") + 1
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False))
    digests = docs.select("doc_id", F.col("lang").alias("grp"), merkle.leaf([F.col(c) for c in merkle.FIELDS]).alias("digest"),
                          merkle.leaf([F.when(tampered, changed).otherwise(F.col(c)) if c == "n_chars" else F.col(c)
                                       for c in merkle.FIELDS]).alias("offered"))
    got = merkle.verified(merkle.manifest(digests, ["doc_id"], fanout, most), "offered")
    return sorted((tuple(r) for r in got.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


def documents(n, langs=("en",), start=0):
    return [(i, f"s{i % 3}", langs[i % len(langs)], i * 3, f"text {i} ä", "clash") for i in range(start, start + n)]


def test_states_absorb_and_finish_as_hashlib():
    rng = np.random.default_rng(0)
    digests = rng.integers(0, 256, (5, 3, 32), dtype=np.uint8)
    states = merkle.begun(5)
    for k in range(3):
        states = merkle.absorbed(states, merkle.hex_blocks(digests[:, k]))
    got = [x.tobytes().hex() for x in merkle.finished(states, np.full(5, 3))]
    assert got == [sha("".join(x.tobytes().hex() for x in row)) for row in digests]
    assert merkle.finished(merkle.begun(1), np.zeros(1, int))[0].tobytes().hex() == sha("")


@pytest.mark.parametrize("n", [1, 2, 3, 7, 8, 9, 33])
@pytest.mark.parametrize("fanout", [2, 3, 5])
def test_chunk_and_fold_match_brute_force_and_resume_retained_states(n, fanout):
    leaves = [sha(str(i)) for i in range(n)]
    want = brute_tree(leaves, fanout)
    chunk = merkle.Chunk.build(merkle.stacked(map(bytes.fromhex, leaves)), fanout, merkle.levels_needed(n, fanout))
    assert [[x.tobytes().hex() for x in level] for level in chunk.levels] == want
    again = merkle.Chunk.unpacked(n, len(chunk.states), fanout, *chunk.packed())
    place = np.arange(n)
    for held in (chunk, again):
        same, proof, blocks = held.folded(place, held.levels[0], merkle.begun(n), np.zeros(n, int))
        assert {x.tobytes().hex() for x in same} == {want[-1][0]}
        assert [x.tobytes().hex() for x in merkle.finished(proof, blocks)] == [sha("".join("".join(s) for s in siblings(want, i, fanout))) for i in range(n)]
    # what lies left of a slot is not read again: with those digests spoilt the fold is the same
    spoilt = [x.copy() for x in again.levels]
    last, at = n - 1, n - 1
    for level in spoilt[:-1]:
        level[at - at % fanout : at] = 0
        at //= fanout
    other = merkle.Chunk(fanout, spoilt, again.states)
    top, _, _ = other.folded(np.array([last]), again.levels[0][[last]], merkle.begun(1), np.zeros(1, int))
    assert top[0].tobytes().hex() == want[-1][0]


@pytest.mark.parametrize("fanout,most", [(2, 4096), (2, 4), (3, 9)])
def test_manifest_matches_brute_force_over_several_rounds(spark, fanout, most):
    rows = documents(70, ("en", "de", "en", "en", None, "")) + documents(1, ("xx",), 500)
    got = found(spark, rows, fanout, most)
    assert got == brute(rows, fanout)
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)


def test_defined_results(spark):
    rows = [(None, None, None, None, None, ""), (3, "s", "en", None, "", ""), (3, "s", "en", None, "", ""), (3, "t", "en", 1, "x" * 200_000, ""),
            (-5, "s", "é", 0, "ß", ""), (None, "s", "en", 2, "a", ""), (12, "s", "ab", 2, "a", "")]
    assert found(spark, rows) == brute(rows)
    assert found(spark, rows[:1]) == brute(rows[:1])
    assert found(spark, documents(2)) == brute(documents(2))
    assert found(spark, []) == []


def test_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(*merkle.FIELDS).collect()
    got = merkle.op11_merkle_manifest(spark, SF_SMALL)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute([tuple(r) for r in docs])
