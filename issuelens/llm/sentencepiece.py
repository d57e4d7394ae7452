"""SentencePiece unigram encoding and decoding, with a max-plus scan for giant documents.

The encoding of a text is its segmentation into pieces with the largest sum of piece scores
(ties: the longer last piece, from the right, as the library's own Viterbi has it).  Scores are
held as whole numbers (score x 1024, rounded), so sums are exact in any order.

* *Forced cuts.*  No piece of the model has a space mark after another character, so the lattice
  falls apart before every word; each task solves a distinct word once and remembers it.  (The
  rule is derived from the model's pieces; a model without it is solved text by text.)
* *Giant documents* (more than ``chunk`` characters) are split into chunks, rows of their own
  that spread over the cluster.  The state at a chunk boundary is the number of characters by
  which the last piece reaches over it (fewer than K, the longest piece).  A chunk yields the
  K x K max-plus transfer matrix "entry state -> exit state", with the order of preference of
  entry states for each exit, so that ties are decided as in one pass.  Matrices are combined
  associatively, ``FAN`` at a time and level by level, up to one per document; then, level by
  level down, each block gets its entry and exit state, and finally every chunk is backtraced
  alone.  What lies between a chunk's first and last forced cut has the same pieces whatever the
  states: its ids are kept beside the matrix, and only the two ends are traced.  No task ever holds
  more than ``FAN`` matrices or one chunk of a giant document.

Models with normalisation tables are refused.  The public SentencePiece model at hand is of the
BPE type; its pieces and scores serve as a unigram model here (see the README).  Characters
without a piece score 10 below the lowest score and become byte pieces, or ``<unk>``.

Defined results: NULL text has NULL ids, empty text no ids.  Repeated rows each get their own
row.  Input columns stay, but for the text (replaced by ``token_ids``) and columns named
``token_ids``, ``n_tokens`` or ``n_chunks``, which are replaced.  Decoding gives the text back,
with U+2581, the space mark, read as a space.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from issuelens.llm.lattice import Trie
from issuelens.llm.text import in_arrow, read_table, schema_of, written

PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
CHUNK = 16_384
FAN = 64
SCALE = 1024
WORDS_KEPT = 200_000
LONG_WORD = 64
NONE = -(1 << 62)          # "no path": far below any sum of scores


def load_model(path: str) -> dict:
    """Pieces, scores and settings of a model file (read on the driver)."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    spec = model.normalizer_spec
    if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
        raise ValueError("only models with identity normalisation are supported")
    return {"pieces": [(p.piece, p.score, p.type) for p in model.pieces], "prefix": spec.add_dummy_prefix}


class Solved(dict):
    """Ids of the stretches between forced cuts, remembered (long ones and an overflow are not)."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces

    def __missing__(self, word: str) -> bytes:
        ids = self.pieces.solve(word)
        if len(word) <= LONG_WORD and len(self) < 2 * WORDS_KEPT:
            self[word] = ids
        return ids


class Pieces:
    """The lattice of a model: which pieces start at a character, and what they score."""

    def __init__(self, model: dict):
        self.text = [p for p, _, _ in model["pieces"]]
        self.prefix = MARK if model["prefix"] else ""
        normal = {p: (i, s) for i, (p, s, kind) in enumerate(model["pieces"]) if kind in (1, 4)}
        lowest = min((s for _, s in normal.values()), default=0.0)
        self.ids = {p: (i, round(s * SCALE)) for p, (i, s) in normal.items()}
        self.unknown_score = round((lowest - 10) * SCALE)
        self.bytes = {int(p[1:-1], 16): i for i, (p, _, kind) in enumerate(model["pieces"]) if kind == 6}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.unknown_id = next((i for i, (_, _, kind) in enumerate(model["pieces"]) if kind == 2), 0)
        self.longest = max(map(len, self.ids), default=1)
        inside = {c for p in self.ids if len(p) > 1 for c in p}
        alone = "".join(re.escape(c) for c in "\t\n\r" if c not in inside)
        words_split = all(MARK not in p.lstrip(MARK) for p in self.ids)
        if not words_split:
            self.split = re.compile(f"[{alone}]|[^{alone}]+" if alone else "(?s:.+)")
        else:
            self.split = re.compile(f"{f'[{alone}]|' if alone else ''}{MARK}+[^{MARK}{alone}]*|[^{MARK}{alone}]+")
        self.solved: dict[str, bytes] = Solved(self)
        # what each id adds to a path's score: an unknown character counts with its first byte
        self.id_scores = np.array([round(s * SCALE) if kind in (1, 4) else 0 for _, s, kind in model["pieces"]], np.int64)
        for b, i in self.bytes.items():
            self.id_scores[i] = 0 if b & 0xC0 == 0x80 else self.unknown_score
        if not self.bytes:
            self.id_scores[self.unknown_id] = self.unknown_score
        self.trie: Trie | None = None

    def normal(self, text: str) -> str:
        return self.prefix + text.replace(" ", MARK) if text else ""

    def arcs(self, text: str, start: int, stop: int) -> list[tuple[int, int]]:
        """(end, score) of the pieces from ``start`` that end at ``stop`` or before."""
        get, found = self.ids.get, []
        for end in range(start + 1, min(stop, start + self.longest) + 1):
            piece = get(text[start:end])
            if piece is not None:
                found.append((end, piece[1]))
        if not found or found[0][0] > start + 1:
            found.insert(0, (start + 1, self.unknown_score))
        return found

    def paths(self, text: str, start: int, last_start: int, stop: int) -> tuple[list[int], list[int]]:
        """Best scores and last-piece starts from ``start``; pieces start before ``last_start``."""
        score, back = [NONE] * (stop + 1), [-1] * (stop + 1)
        score[start] = 0
        for i in range(start, min(last_start, stop)):
            here = score[i]
            if here > NONE:
                for end, s in self.arcs(text, i, stop):
                    if here + s > score[end]:            # a tie keeps the earlier start
                        score[end], back[end] = here + s, i
        return score, back

    @staticmethod
    def starts(back: list[int], end: int, start: int) -> list[int]:
        """Piece starts of the best path, from the right."""
        out = []
        while end > start:
            end = back[end]
            out.append(end)
        return out

    def emit(self, text: str, starts: list[int], end: int) -> bytes:
        """Ids (32-bit) of the pieces that begin at ``starts`` (from the right)."""
        ids: list[int] = []
        borders = [*reversed(starts), end]
        for start, stop in zip(borders, borders[1:]):
            piece = text[start:stop]
            known = self.ids.get(piece)
            if known is not None:
                ids.append(known[0])
            elif self.bytes:
                ids += [self.bytes[b] for b in piece.encode()]
            else:
                ids.append(self.unknown_id)
        return np.array(ids, np.int32).tobytes()

    def solve(self, word: str) -> bytes:
        """Ids of a stretch between forced cuts."""
        n = len(word)
        _, back = self.paths(word, 0, n, n)
        return self.emit(word, self.starts(back, n, 0), n)

    def score(self, ids: bytes) -> int:
        return int(self.id_scores[np.frombuffer(ids, np.int32)].sum())

    def prepare(self, words: set[str]) -> None:
        """Solve many new words at once: the same Viterbi, all words position by position."""
        if len(self.solved) + len(words) > WORDS_KEPT:
            # the words met first are mostly the frequent ones: they stay
            kept = dict(islice(self.solved.items(), max(0, WORDS_KEPT // 2 - len(words) // 2)))
            self.solved.clear()
            self.solved.update(kept)
        new = [w for w in words.difference(self.solved) if len(w) <= LONG_WORD]
        if len(new) < 64:                          # not worth the arrays
            return
        if self.trie is None:
            self.trie = Trie(list(self.ids))
            self.piece_ids = np.array([i for i, _ in self.ids.values()], np.int32)
            self.piece_scores = np.array([*[s for _, s in self.ids.values()], self.unknown_score], np.int64)
        _, lots = self.trie.grids(new)
        for places, grid, sizes in lots:
            n, width = len(places), grid.shape[1]
            score = np.full((width, n), NONE, np.int64)
            back, via = np.zeros((width, n), np.int32), np.full((width, n), -1, np.int32)
            score[0] = 0
            for start, end, rows, piece in self.trie.steps(grid, sizes):
                sums = score[start, rows] + self.piece_scores[piece]
                better = sums > score[end, rows]                       # a tie keeps the earlier start
                rows, piece, sums = rows[better], piece[better], sums[better]
                score[end, rows], back[end, rows], via[end, rows] = sums, start, piece
            # pieces from the right, a column per step; then each word's row is its ids, reversed
            at, row, taken = sizes.copy(), np.arange(n), np.full((width, n), -1, np.int32)
            length, unknown = np.zeros(n, np.int64), np.zeros(n, bool)
            while len(row):
                piece = via[at, row]
                unknown[row] |= piece < 0
                taken[length[row], row] = piece
                length[row] += 1
                at = back[at, row]
                row, at = row[at > 0], at[at > 0]
            column = np.repeat(np.arange(n), length)
            step = np.arange(len(column)) - np.repeat(np.cumsum(length) - length, length)
            ids = self.piece_ids[taken[length[column] - 1 - step, column]].tobytes()
            ends = 4 * np.cumsum(length)
            ok = np.flatnonzero(~unknown).tolist()                     # unknown characters need bytes: left to ``solve``
            stops, starts = ends.tolist(), (ends - 4 * length).tolist()
            at = places.tolist()
            self.solved.update((new[at[k]], ids[starts[k] : stops[k]]) for k in ok)

    def parts(self, texts: list[str | None]) -> Iterator[tuple[int, list[list[str]]]]:
        """Texts as their words, in parts of about ``WORDS_KEPT`` / 4 distinct words that are solved together.

        Yields the place of a part's first text and the words of its texts.
        """
        at, found, words = 0, [], set()
        for k, text in enumerate(texts):
            found.append(self.split.findall(text or ""))
            words.update(found[-1])
            if len(words) >= WORDS_KEPT // 4 or k + 1 == len(texts):
                self.prepare(words)
                yield at, found
                at, found, words = k + 1, [], set()

    def ids_of(self, words: list[str]) -> bytes:
        return b"".join(map(self.solved.__getitem__, words))

    def encode(self, normal: str) -> bytes:
        return self.ids_of(self.split.findall(normal))

    def encode_all(self, normals: list[str | None]) -> list[bytes | None]:
        return [None if normals[at + k] is None else self.ids_of(words)
                for at, found in self.parts(normals) for k, words in enumerate(found)]

    def decode(self, ids: list[int]) -> str:
        text, byte_of = self.text, self.byte_of
        if any(map(byte_of.__contains__, set(ids))):
            raw = b"".join(bytes([byte_of[i]]) if i in byte_of else text[i].encode() for i in ids)
            out = raw.decode(errors="replace")
        else:
            out = "".join(map(text.__getitem__, ids))
        return out.replace(MARK, " ")[len(self.prefix):]

    # -- chunks of giant documents: ``text`` is the chunk, ``over`` characters of what follows
    #    it, and ``before``, the character before it; ``size`` is the length of the chunk proper.

    def cuts(self, before: str, text: str, size: int, ends: bool) -> tuple[int, int] | None:
        """First and last forced cut within the chunk, its borders included."""
        marks = [m.start() for m in self.split.finditer(before + text)]
        # a match that starts at 0 begins with the character before the chunk and cuts nothing here
        places = [m - len(before) for m in marks if m >= len(before) and m - len(before) <= size]
        if before == "" and (not places or places[0] != 0):
            places.insert(0, 0)
        if ends:
            places.append(size)
        return (places[0], places[-1]) if places else None

    def transfer(self, before: str, text: str, size: int, ends: bool) -> tuple[np.ndarray, np.ndarray]:
        """Transfer matrix of a chunk, and for each exit the rank of every entry (0: preferred)."""
        between = self.cuts(before, text, size, ends)
        return self.matrix(text, size, between, self.encode(text[between[0] : between[1]]) if between else b"")

    def matrix(self, text: str, size: int, between: tuple[int, int] | None, middle_ids: bytes) -> tuple[np.ndarray, np.ndarray]:
        """``transfer``, given the forced cuts and the ids between them."""
        k = self.longest
        value, rank = np.full((k, k), NONE, np.int64), np.zeros((k, k), np.int16)
        stop = min(len(text), size + k - 1)
        if between is not None:
            first, last = between
            middle = self.score(middle_ids)
            exits, _ = self.paths(text, last, size, stop)
            order = []
            for s in range(min(k, first + 1)):
                score, back = self.paths(text, s, first, first)
                order.append((self.starts(back, first, s), s))
                for e in range(min(k, stop - size + 1)):
                    if exits[size + e] > NONE:
                        value[s, e] = score[first] + middle + exits[size + e]
            for r, (_, s) in enumerate(sorted(order)):
                rank[s, :] = r
            return value, rank
        paths = {s: self.paths(text, s, size, stop) for s in range(min(k, size))}
        for e in range(min(k, stop - size + 1)):
            order = []
            for s, (score, back) in paths.items():
                if score[size + e] > NONE:
                    value[s, e] = score[size + e]
                    order.append((self.starts(back, size + e, s), s))
            for r, (_, s) in enumerate(sorted(order)):
                rank[s, e] = r
        return value, rank

    def backtrace(self, before: str, text: str, size: int, ends: bool, entry: int, exit_: int) -> bytes:
        """Ids of the pieces that start in this chunk, given its states at both borders."""
        between = self.cuts(before, text, size, ends)
        if between is None:
            return self.trace(text, size, entry, exit_)
        first, last = between
        return self.trace(text[:first], first, entry, 0) + self.encode(text[first:last]) + self.trace(text[last:], size - last, 0, exit_)

    def trace(self, text: str, size: int, entry: int, exit_: int) -> bytes:
        """Ids of the best path from ``entry`` to ``exit_`` characters after ``size``, of pieces that start before ``size``."""
        _, back = self.paths(text, entry, size, size + exit_)
        return self.emit(text, self.starts(back, size + exit_, entry), size + exit_)


Matrix = tuple[np.ndarray, np.ndarray]


def combine(a: Matrix, b: Matrix) -> Matrix:
    """The max-plus product of two neighbouring transfer matrices, ranks included (associative)."""
    (av, ar), (bv, br) = a, b
    k = len(av)
    sums = av[:, :, None] + bv[None, :, :]
    sums[(av[:, :, None] == NONE) | np.broadcast_to(bv[None, :, :] == NONE, sums.shape)] = NONE
    value = sums.max(axis=1)
    # among the best middle states of (s, e) the one that b prefers for e
    tied = np.where(sums == value[:, None, :], br[None, :, :].astype(np.int64), np.iinfo(np.int64).max)
    middle = tied.argmin(axis=1)
    key = br[middle, np.arange(k)[None, :]].astype(np.int64) * (k + 1) + ar[np.arange(k)[:, None], middle]
    return value, key.argsort(axis=0, kind="stable").argsort(axis=0).astype(np.int16)


def resolve(matrices: list[Matrix], entry: int, exit_: int) -> list[int]:
    """Boundary states along a row of chunks, from the state before the first to the one after the last."""
    vectors = [np.full(len(matrices[0][0]), NONE, np.int64)]
    vectors[0][entry] = 0
    for value, _ in matrices[:-1]:
        v = vectors[-1]
        sums = np.where((v[:, None] == NONE) | (value == NONE), NONE, v[:, None] + value)
        vectors.append(sums.max(axis=0))
    states = [exit_]
    for v, (value, rank) in zip(reversed(vectors), reversed(matrices)):
        column = value[:, states[-1]]
        sums = np.where((v == NONE) | (column == NONE), NONE, v + column)
        best = np.flatnonzero(sums == sums.max())
        states.append(int(best[rank[best, states[-1]].argmin()]))
    return states[::-1]


def pack(m: Matrix) -> bytes:
    return m[0].tobytes() + m[1].tobytes()


def unpack(b: bytes, k: int) -> Matrix:
    return (np.frombuffer(b, np.int64, k * k).reshape(k, k), np.frombuffer(b, np.int16, k * k, k * k * 8).reshape(k, k))


def split_documents(docs: DataFrame, held, text: str, chunk: int) -> DataFrame:
    """Chunks of giant documents: (row_no, chunk, n_chunks, rest, before, body, size).

    ``rest``, the other columns, goes with the first chunk.  ``body`` is the chunk and the
    following characters a piece can reach, ``before`` the character in front of it.
    """
    others = [c for c in docs.columns if c != text]
    rest = T.StructType([T.StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(others)])
    out = T.StructType([T.StructField("row_no", T.LongType()), T.StructField("rest", rest),
                        *T.StructType.fromDDL("chunk long, n_chunks long, before string, body string, size int").fields])
    schema = schema_of(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(held.value)
        over = pieces.longest - 1
        for b in batches:
            for i in range(b.num_rows):
                normal = pieces.normal(b.column(2)[i].as_py())
                n = max(1, len(normal) // chunk)              # the last chunk takes what is left over
                for first in range(0, n, FAN):
                    some = range(first, min(first + FAN, n))
                    ends = [len(normal) if c == n - 1 else (c + 1) * chunk for c in some]
                    head = [i if c == 0 else None for c in some]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([b.column(0)[i].as_py()] * len(some), pa.int64()),
                        b.column(1).take(pa.array(head, pa.int64())).cast(schema.field("rest").type),
                        pa.array(list(some), pa.int64()), pa.array([n] * len(some), pa.int64()),
                        pa.array([normal[c * chunk - 1 : c * chunk] if c else "" for c in some], pa.string()),
                        pa.array([normal[c * chunk : e + over] for c, e in zip(some, ends)], pa.string()),
                        pa.array([e - c * chunk for c, e in zip(some, ends)], pa.int32())], schema=schema)

    numbered = docs.select(F.monotonically_increasing_id().alias("row_no"),
                           F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)] or [F.lit(None).alias("none")]).alias("rest"),
                           F.col(text).alias("body"))
    return in_arrow(numbered, run, out).repartition("row_no", "chunk")


MATRIX = "row_no long, at long, matrix binary"


def boundary_states(chunks: DataFrame, held, k: int) -> tuple[DataFrame, DataFrame]:
    """(row_no, chunk, entry, exit) by the scan: matrices up a tree of fan ``FAN``, states down it; and the table of
    the chunks' matrices with what backtracing needs: the text up to the first cut and from the last one
    (``left``, ``right``; without cuts all is ``left``), the size of each, and the ids in between; and ``rest``.
    """
    ends = T.StructType.fromDDL("left string, left_size int, middle binary, right string, right_size int")
    out = T.StructType([*T.StructType.fromDDL(MATRIX).fields, *ends.fields, chunks.schema["rest"]])
    matrix_schema = schema_of(out)

    def solved(pieces: Pieces, before: str, text: str, size: int, ends: bool) -> tuple:
        between = pieces.cuts(before, text, size, ends)
        if between is None:
            return pack(pieces.matrix(text, size, None, b"")), text, size, b"", "", 0
        first, last = between
        ids = pieces.encode(text[first:last])
        return pack(pieces.matrix(text, size, between, ids)), text[:first], first, ids, text[last:], size - last

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(held.value)
        for b in batches:
            rows = list(zip(*[b.column(i).to_pylist() for i in (2, 3, 4, 1, 5)]))
            for at, part in pieces.parts([r[1] for r in rows]):
                size_of_part = len(part)
                some = rows[at : at + size_of_part]
                cols = zip(*[solved(pieces, before, body, size, c + 1 == n) for before, body, size, c, n in some])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, size_of_part), b.column(1).slice(at, size_of_part),
                                                  *[pa.array(c, f.type) for c, f in zip(cols, list(matrix_schema)[2:])],
                                                  b.column(6).slice(at, size_of_part).cast(matrix_schema.field("rest").type)], schema=matrix_schema)

    def up(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("at")
        total = None
        for m in group["matrix"]:
            total = unpack(m, k) if total is None else combine(total, unpack(m, k))
        return pd.DataFrame({"row_no": group["row_no"].iloc[:1], "at": group["at"].iloc[:1] // FAN, "matrix": [pack(total)]})

    def down(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("at")
        states = resolve([unpack(m, k) for m in group["matrix"]], int(group["entry"].iloc[0]), int(group["exit"].iloc[0]))
        return pd.DataFrame({"row_no": group["row_no"], "at": group["at"], "entry": states[:-1], "exit": states[1:]})

    base = written(in_arrow(chunks.select("row_no", "chunk", "before", "body", "size", "n_chunks", "rest"), matrices, out), "matrices")
    levels = [base.select("row_no", "at", "matrix")]
    most = chunks.agg(F.max("n_chunks")).first()[0] or 1
    while most > 1:
        parents = levels[-1].groupBy("row_no", F.floor(F.col("at") / FAN).alias("block")).applyInPandas(
            lambda g: up(g), MATRIX)
        levels.append(written(parents, "matrices"))
        most = -(-most // FAN)
    # a document starts and ends on a piece boundary: state 0 on both sides
    states = levels[-1].select("row_no", "at", F.lit(0).alias("entry"), F.lit(0).alias("exit"))
    for level in reversed(levels[:-1]):
        of_block = states.select("row_no", F.col("at").alias("block"), "entry", "exit")
        states = level.withColumn("block", F.floor(F.col("at") / FAN)).join(of_block, ["row_no", "block"]) \
            .groupBy("row_no", "block").applyInPandas(lambda g: down(g), "row_no long, at long, entry int, exit int")
        if level is not levels[0]:
            states = written(states, "states")
    return states.withColumnRenamed("at", "chunk"), base.drop("matrix").withColumnRenamed("at", "chunk")


def ids_array(found: list[bytes | None]) -> pa.Array:
    """Packed ids as an Arrow list column."""
    lengths = [0 if x is None else len(x) // 4 for x in found]
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    flat = np.frombuffer(b"".join(x for x in found if x is not None), np.int32)
    mask = pa.array([x is None for x in found], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat), mask=mask)


def encode(docs: DataFrame, model_path: str = PIECE_MODEL, text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """``docs`` with ``text`` replaced by token_ids (array<int>), n_tokens and n_chunks (long)."""
    model = load_model(model_path)
    k = max(len(p) for p, _, _ in model["pieces"])
    if chunk <= k:
        raise ValueError("a chunk must be longer than the longest piece")
    held = docs.sparkSession.sparkContext.broadcast(model)
    others = [c for c in docs.columns if c not in (text, "token_ids", "n_tokens", "n_chunks")]
    docs = docs.select(*[F.col(f"`{c}`") for c in others], F.col(f"`{text}`"))
    giant = F.length(F.col(f"`{text}`")) > chunk
    kinds = [T.StructField(c, docs.schema[c].dataType) for c in others]
    # Small documents go straight through one task each.
    rest = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(kinds)] or [T.StructField("none", T.StringType())])
    out = T.StructType([T.StructField("rest", rest), T.StructField("token_ids", T.ArrayType(T.IntegerType()))])
    schema = schema_of(out)

    # a chunk's ids: up to its first cut (part 0, all of them without cuts), between its cuts (1), from the last one (2)
    chunked = T.StructType([T.StructField("row_no", T.LongType()), T.StructField("rest", rest), T.StructField("chunk", T.LongType()),
                            T.StructField("part", T.IntegerType()), T.StructField("token_ids", T.ArrayType(T.IntegerType()))])
    chunked_schema = schema_of(chunked)

    def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(held.value)
        for b in batches:
            found = pieces.encode_all([None if t is None else pieces.normal(t) for t in b.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column(0).cast(schema.field(0).type), ids_array(found).cast(schema.field(1).type)], schema=schema)

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(held.value)
        for whole_batch in batches:
            for at in range(0, whole_batch.num_rows, FAN):           # few chunks at a time, to hold little
                b = whole_batch.slice(at, FAN)
                row, part, found = [], [], []
                for i, (left, left_size, right, right_size, cut, entry, exit_) in enumerate(zip(*[b.column(i).to_pylist() for i in range(3, 10)])):
                    row.append(i)
                    part.append(0)
                    found.append(pieces.trace(left, left_size, entry, 0 if cut else exit_))
                    if cut:                                # the path passes it
                        row.append(i)
                        part.append(2)
                        found.append(pieces.trace(right, right_size, 0, exit_))
                head = pa.array([i if p == 0 else None for i, p in zip(row, part)], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(row, pa.int64())), b.column(1).take(head).cast(chunked_schema.field(1).type),
                     b.column(2).take(pa.array(row, pa.int64())), pa.array(part, pa.int32()),
                     ids_array(found).cast(chunked_schema.field(4).type)], schema=chunked_schema)

    def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for at in range(0, whole_batch.num_rows, FAN):
                b = whole_batch.slice(at, FAN)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.nulls(b.num_rows, chunked_schema.field(1).type), b.column(1), pa.array([1] * b.num_rows, pa.int32()),
                     ids_array(b.column(2).to_pylist()).cast(chunked_schema.field(4).type)], schema=chunked_schema)

    struct = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)] or [F.lit(None).cast("string").alias("none")])
    short = in_arrow(docs.filter(~F.coalesce(giant, F.lit(False))).select(struct.alias("rest"), F.col(f"`{text}`").alias("t")), small, out) \
        .withColumn("n_chunks", F.lit(1).cast("long"))
    chunks = written(split_documents(docs.filter(giant), held, text, chunk), "chunks")
    states, ends = boundary_states(chunks, held, k)
    cut = (F.length("middle") > 0) | (F.length("right") > 0) | (F.col("right_size") > 0)
    traced = in_arrow(ends.withColumn("cut", cut).drop("middle").join(states, ["row_no", "chunk"]).select(
        "row_no", "rest", "chunk", "left", "left_size", "right", "right_size", "cut", "entry", "exit"), back, chunked)
    # ids between cuts need no state: they are not joined, only brought together
    middles = in_arrow(ends.filter(F.length("middle") > 0).select("row_no", "chunk", "middle"), between, chunked)
    # One row is one document: only here do its ids come together.
    whole = traced.unionByName(middles).groupBy("row_no").agg(
        F.max_by("rest", -(3 * F.col("chunk") + F.col("part"))).alias("rest"),
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "part", "token_ids"))), lambda x: x["token_ids"])).alias("token_ids"),
        F.count_if(F.col("part") == 0).alias("n_chunks")).drop("row_no")
    return short.unionByName(whole).select(
        *[F.col(f"rest.c{i}").alias(c) for i, c in enumerate(others)], "token_ids",
        F.when(F.col("token_ids").isNotNull(), F.size("token_ids")).cast("long").alias("n_tokens"), "n_chunks")


def decode(encoded: DataFrame, model_path: str = PIECE_MODEL, text: str = "text") -> DataFrame:
    """``encoded`` with ``token_ids`` replaced by the text they stand for."""
    held = encoded.sparkSession.sparkContext.broadcast(load_model(model_path))
    others = [c for c in encoded.columns if c not in (text, "token_ids")]
    rest = T.StructType([T.StructField(f"c{i}", encoded.schema[c].dataType) for i, c in enumerate(others)] or [T.StructField("none", T.StringType())])
    out = T.StructType([T.StructField("rest", rest), T.StructField("text", T.StringType())])
    schema = schema_of(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(held.value)
        for b in batches:
            ids = b.column(1)
            flat, ends = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
            found = [pieces.decode(flat[ends[i] : ends[i + 1]].tolist()) if ids[i].is_valid else None for i in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(schema.field(0).type), pa.array(found, pa.string())], schema=schema)

    struct = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)] or [F.lit(None).cast("string").alias("none")])
    found = in_arrow(encoded.select(struct.alias("rest"), "token_ids"), run, out)
    return found.select(*[F.col(f"rest.c{i}").alias(c) for i, c in enumerate(others)], F.col("text").alias(text))


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every document: token count, digest of the ids, and whether the text came back."""
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.xxhash64(F.replace(F.col("text"), F.lit(MARK), F.lit(" "))).alias("sent"), F.length("text").cast("long").alias("n_chars"))
    found = encode(docs).withColumn("ids_digest", F.xxhash64("token_ids"))
    return decode(found).select("doc_id", "n_chars", "n_tokens", "n_chunks", "ids_digest",
                                (F.xxhash64("text") == F.col("sent")).alias("round_trip"))


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage, the last: documents as token ids, with the decoded text beside them."""
    return encode(docs.withColumn("doc_text", F.col("text"))).withColumnRenamed("doc_text", "text")
