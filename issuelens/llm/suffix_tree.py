"""Language-model scores by a probabilistic suffix tree over words.

*Tokens* are the words of a text (A-Z lower-cased), then one end.  Every training word is a symbol of
the tree; a word that training did not show is the one unknown word.

*Contexts* are the strings of up to ``DEPTH`` preceding words within the document.  Every string that
training shows at least ``LEAST`` times is a candidate (one occurrence has no distribution to test); it is
retained when its next-symbol distribution diverges from that of its longest retained suffix: n * KL
must exceed half log n for each next symbol seen.  Next-symbol counts are smoothed by Witten-Bell
interpolation with the longest retained suffix, down to the root, where a word has its discounted
relative frequency and the unknown word the discounted mass; a token is scored in the state of the
longest retained suffix of what precedes it.

*The tree is grown where its tokens are scored.*  Every token goes, with the words before it, to the part of the
corpus that its last word is dealt to, so a part holds whole branches: all counts, tests and
probabilities of contexts that end in its words are worked out there, and a document's
sums come back.  Tasks send tokens as packed columns (``packed``), a part has about ``PART_BYTES`` of text.
A context that more than ``HOT_CONTEXT`` training tokens follow is not dealt to one part but by the next
word back; its own next-symbol counts are made by a map-side combined aggregate beforehand.

*Counts.*  All training words are counted in Spark (tasks send partial counts).  The at most ``HOT_WORDS``
most frequent ones (and next symbols of hot contexts) go to every task as a table of fixed size; the other
counts, each of which is rarer than 1 in HOT_WORDS, are joined by shuffle, once for every part that asks
for them.  Words and contexts are told apart by 64-bit hashes.

``fit`` with ``symbols`` learns the small tree of a *bounded alphabet* instead: the most frequent words, the end,
and one symbol for all other words, which are told apart below it by discounted relative frequency; its
contexts need an empirical probability of ``P_MIN``, and it is held in memory.

Defined results: NULL text is an empty text, whose only token is the end.  Every row is scored
on its own (rows are told apart by a row number), repeated rows and NULL doc_id included; a row
with NULL doc_id is training data.  Without training data every token has base probability 1 over 1.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from issuelens.llm.text import ODD, count_floor, held_out, in_arrow, mix, read_table, schema_of, steps_of, with_id, written

DEPTH = 3
LEAST = 2                      # occurrences of a candidate context
PART_BYTES = 8 << 20           # text whose tokens one part has
HOT_CONTEXT = 1_000_000        # tokens after a context, above which the next word back tells its part
FLUSHED = 600_000              # tokens a task lays out before it sends them on
ADDED = 1_000_000              # sums that a task adds up before it sends them on
TWIGS = 8                      # pieces of a part, whose branches are grown one after the other
BOUNDED_DEPTH = 2              # of the tree with a bounded alphabet
P_MIN = 5e-5
HOT_WORDS = 240_000
COUNTS_KEPT = 400_000          # words a task counts before it sends them on
MOST_DISCOUNT = 0.95
TOGETHER = 300_000             # tokens worked on at once


def tokens(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, c): how often each word stands in ``docs``."""
    schema = schema_of("word binary, c long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def send():
            got = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], schema=schema)
            seen.clear()
            return got

        for b in batches:
            for t in b.column(0):
                words = tokens(t.as_py())
                for at in range(0, len(words), COUNTS_KEPT):
                    seen.update(words[at : at + COUNTS_KEPT])
                    if len(seen) > COUNTS_KEPT:
                        yield send()
        yield send()

    return in_arrow(docs.select(F.col(text).cast("binary").alias("text")), run, "word binary, c long") \
        .groupBy("word").agg(F.sum("c").alias("c"))


def most_frequent(words: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """The words of the highest counts, at most ``most`` (whole steps of a logarithmic scale of counts)."""
    floor = count_floor(words, "c", most)
    if floor is None:
        return []
    found = words.filter(steps_of("c") >= floor).select("word", "c").toArrow()
    return sorted(zip(found.column(0).to_pylist(), found.column(1).to_pylist()), key=lambda x: (-x[1], x[0]))


class Tree:
    """Retained contexts and their smoothed next-symbol log10 probabilities.

    A context of length d is the number that its symbols, oldest first, make in base ``size``.
    """

    def __init__(self, root: np.ndarray):
        total = root.sum()
        self.size = len(root)
        self.root = np.log10((root + 1 / self.size) / (total + 1))
        self.levels: list[tuple] = []

    def parts(self) -> tuple:
        """The tree as plain arrays, which tasks can read without this module."""
        return self.root, self.levels

    @classmethod
    def of(cls, parts: tuple) -> "Tree":
        tree = cls.__new__(cls)
        tree.root, tree.levels = parts
        tree.size = len(tree.root)
        return tree

    def log_probs(self, codes: list[np.ndarray], symbols: np.ndarray, depth: int) -> np.ndarray:
        """log10 P(symbol | longest retained suffix of at most ``depth`` symbols); codes[d] is -1 where there is none."""
        out = self.root[symbols]
        for d, (contexts, keys, values, back_off) in enumerate(self.levels[:depth], 1):
            if not len(contexts):
                continue
            at = np.minimum(np.searchsorted(contexts, codes[d]), len(contexts) - 1)
            rows = np.flatnonzero(contexts[at] == codes[d])
            at, wanted = at[rows], at[rows] * self.size + symbols[rows]
            place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            out[rows] = np.where(keys[place] == wanted, values[place], back_off[at] + out[rows])
        return out

    def lower(self, contexts: np.ndarray, depth: int) -> list[np.ndarray]:
        """The suffixes of contexts of length ``depth``, by length."""
        return [contexts % self.size ** d for d in range(depth)]

    def add_level(self, contexts: np.ndarray, symbols: np.ndarray, n: np.ndarray) -> None:
        """The next longer contexts: parallel arrays of (context, next symbol, count)."""
        depth = len(self.levels) + 1
        order = np.lexsort((symbols, contexts))
        contexts, symbols, n = contexts[order], symbols[order], n[order]
        names, at = np.unique(contexts, return_inverse=True)
        total, kinds = np.bincount(at, n, len(names)), np.bincount(at, minlength=len(names))
        below = 10 ** self.log_probs(self.lower(contexts, depth), symbols, depth - 1)
        values = np.log10((n + kinds[at] * below) / (total + kinds)[at])
        self.levels.append((names, at * self.size + symbols, values, np.log10(kinds / (total + kinds))))

    def diverges(self, contexts: np.ndarray, symbols: np.ndarray, n: np.ndarray, depth: int) -> bool:
        """The test of one context, from its next symbols and their counts."""
        total = n.sum()
        below = self.log_probs(self.lower(contexts, depth), symbols, depth - 1) * np.log(10)
        return float((n * (np.log(n / total) - below)).sum()) > 0.5 * np.log(total) * len(n)


def context_codes(symbols: np.ndarray, place: np.ndarray, size: int, depth: int) -> list[np.ndarray]:
    """For d = 0..depth the context of length d before each token, -1 where the document is younger."""
    out = [np.zeros(len(symbols), np.int64)]
    for d in range(1, depth + 1):
        code = np.full(len(symbols), -1, np.int64)
        rows = np.flatnonzero(place >= d)
        code[rows] = 0
        for back in range(d, 0, -1):
            code[rows] = code[rows] * size + symbols[rows - back]
        out.append(code)
    return out


def parts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[np.ndarray, list[list[bytes]]]]:
    """Rows of a batch with their tokens, about ``TOGETHER`` tokens at a time."""
    rows, found, n = [], [], 0
    for i, t in enumerate(batch.column(column)):
        words = tokens(t.as_py())
        rows.append(i)
        found.append(words)
        n += len(words) + 1
        if n > TOGETHER:
            yield np.array(rows), found
            rows, found, n = [], [], 0
    if rows:
        yield np.array(rows), found


def laid_out(found: list[list[bytes]], index: dict[bytes, int], end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token numbers of several documents in a row (-1: not in the index), places in the document, and begins."""
    sizes = np.array([len(w) + 1 for w in found])
    begins = np.cumsum(sizes) - sizes
    get = index.get
    ids = np.fromiter((x for words in found for x in (*[get(w, -1) for w in words], end)), np.int64, int(sizes.sum()))
    return ids, np.arange(len(ids)) - np.repeat(begins, sizes), begins


def counts_of(train: DataFrame, text: str, hot_words: int) -> dict:
    """Words and their counts (a written table), the most frequent of them, and the figures that every score needs."""
    words = written(word_counts(train, text), "words")
    in_words, known, once, twice = words.agg(F.sum("c"), F.count("*"), F.count(F.when(F.col("c") == 1, 1)),
                                             F.count(F.when(F.col("c") == 2, 1))).first()
    ends, in_words = train.count(), in_words or 0
    # Below 1, so that a word seen once keeps some probability where no word was seen twice.
    discount = min(once / (once + 2 * twice), MOST_DISCOUNT) if once else 0.5
    return {"words": words, "tokens": in_words + ends, "known": known + (ends > 0), "ends": ends, "hot": most_frequent(words, hot_words),
            "in_words": in_words, "words_known": known, "discount": discount}


def fit_bounded(train: DataFrame, symbols: int, text: str = "text", depth: int = BOUNDED_DEPTH, p_min: float = P_MIN,
                hot_words: int = HOT_WORDS) -> dict:
    """Learn word counts (a written table) and the tree of a bounded alphabet."""
    spark = train.sparkSession
    figures = counts_of(train, text, hot_words)
    hot, in_words, ends, known = (figures[k] for k in ("hot", "in_words", "ends", "words_known"))
    alphabet = hot[: min(symbols, len(hot))]
    rare, end, size = len(alphabet), len(alphabet) + 1, len(alphabet) + 2
    n_rare = in_words - sum(c for _, c in alphabet)
    root = np.array([*[c for _, c in alphabet], n_rare, ends], float)
    index = {w: i for i, (w, _) in enumerate(alphabet)}
    tree = Tree(root)
    total = root.sum()
    candidates = np.flatnonzero(root >= max(1, p_min * total))
    for d in range(1, depth + 1):
        held = spark.sparkContext.broadcast((index, candidates))
        schema = schema_of("context long, symbol long, n long")

        def count(batches: Iterator[pa.RecordBatch], d=d) -> Iterator[pa.RecordBatch]:
            index, wanted = held.value
            kept_keys, kept_n = np.zeros(0, np.int64), np.zeros(0, np.int64)
            for b in batches:
                for _, found in parts(b, 0):
                    ids, place, _ = laid_out(found, index, end)
                    ids[ids < 0] = rare
                    code = context_codes(ids, place, size, d)[d]
                    at = np.minimum(np.searchsorted(wanted, code), len(wanted) - 1)
                    ok = wanted[at] == code
                    keys, n = np.unique(np.concatenate([kept_keys, at[ok] * size + ids[ok]]), return_inverse=True)
                    kept_n = np.bincount(n, np.concatenate([kept_n, np.ones(int(ok.sum()))]), len(keys)).astype(np.int64)
                    kept_keys = keys
            yield pa.RecordBatch.from_arrays([pa.array(wanted[kept_keys // size] if len(kept_keys) else kept_keys), pa.array(kept_keys % size),
                                              pa.array(kept_n)], schema=schema)

        if not len(candidates):
            break
        counted = in_arrow(train.select(F.col(text).cast("binary").alias("text")), count, "context long, symbol long, n long") \
            .groupBy("context", "symbol").agg(F.sum("n").alias("n"))
        counted = written(counted, "contexts")
        shared = spark.sparkContext.broadcast(tree.parts())

        def test(group: pd.DataFrame, d=d) -> pd.DataFrame:      # at most one row per symbol
            ok = Tree.of(shared.value).diverges(group["context"].to_numpy(), group["symbol"].to_numpy(), group["n"].to_numpy(float), d)
            return group if ok else group.iloc[:0]

        kept = counted.groupBy("context").applyInPandas(lambda g: test(g), "context long, symbol long, n long").toPandas()
        tree.add_level(kept["context"].to_numpy(np.int64), kept["symbol"].to_numpy(np.int64), kept["n"].to_numpy(float))
        # longer candidates: frequent strings of d + 1 symbols that do not go over an end
        longer = counted.filter((F.col("n") >= max(1, p_min * total)) & (F.col("symbol") != end)) \
            .select((F.col("context") * size + F.col("symbol")).alias("code")).collect()
        candidates = np.sort(np.array([r.code for r in longer], np.int64))
    return {**figures, "symbols": len(alphabet), "n_rare": n_rare, "rare_words": known - len(alphabet), "tree": tree}


def rare_log(c, n_rare: int, rare_words: int, discount: float):
    """log10 probability of a word with count ``c`` among the rare ones; c = 0 is the unknown word."""
    if n_rare == 0:
        return np.zeros(len(c))
    return np.log10(np.where(c > 0, (c - discount), discount * max(rare_words, 1)) / n_rare)


def score_bounded(docs: DataFrame, model: dict, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``score`` by the tree of a bounded alphabet."""
    spark = docs.sparkSession
    light = {**{k: v for k, v in model.items() if k != "words"}, "tree": model["tree"].parts()}
    held = spark.sparkContext.broadcast(light)
    out = with_id(docs, doc_id, "n_tokens long, n_known long, base_score double, score double, tail array<binary>")
    schema = schema_of(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        index = {w: i for i, (w, _) in enumerate(m["hot"])}
        c = np.array([*[n for _, n in m["hot"]], m["ends"]], float)
        end, n_symbols = len(m["hot"]), m["symbols"]
        rare, size = n_symbols, n_symbols + 2
        symbol = np.concatenate([np.minimum(np.arange(end), rare), [rare + 1, rare]])       # the last: words not in the index
        base = np.concatenate([np.log10((c + 1) / (m["tokens"] + m["known"] + 1)), [0.0]])
        below = np.zeros(end + 2)
        below[n_symbols:end] = rare_log(c[n_symbols:end], m["n_rare"], m["rare_words"], m["discount"])
        known = np.concatenate([c > 0, [False]])
        tree = Tree.of(m["tree"])
        for b in batches:
            made = []
            for rows, found in parts(b, 1):
                ids, place, begins = laid_out(found, index, end)
                symbols = symbol[ids]
                logs = tree.log_probs(context_codes(symbols, place, size, len(tree.levels)), symbols, len(tree.levels)) + below[ids]
                sums = [np.add.reduceat(x, begins) for x in (known[ids].astype(np.int64), base[ids], logs)]
                made += list(zip([len(w) + 1 for w in found], *[x.tolist() for x in sums], [[w for w in words if w not in index] for words in found]))
            cols = list(zip(*made)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(x, f.type) for x, f in zip(cols, list(schema)[1:])]], schema=schema)

    rows = in_arrow(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text")), run, out) \
        .withColumn("row_no", F.monotonically_increasing_id())
    rows = written(rows, "scores")
    tail = rows.select("row_no", F.explode("tail").alias("word")).join(model["words"], "word", "left")
    count = F.coalesce("c", F.lit(0))
    rest = max(model["n_rare"], 1)
    mass = model["discount"] * max(model["rare_words"], 1) / rest if model["n_rare"] else 1.0
    of_rare = F.log10(F.when(count > 0, (count - model["discount"]) / rest).otherwise(F.lit(mass)))
    sums = tail.groupBy("row_no").agg(
        F.count(F.when(count > 0, 1)).alias("t_known"), F.sum(F.log10((count + 1) / (model["tokens"] + model["known"] + 1))).alias("t_base"),
        F.sum(of_rare).alias("t_score"))
    zero = F.lit(0)
    return rows.drop("tail").join(sums, "row_no", "left").select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("t_known", zero)).alias("n_known"),
        (F.col("base_score") + F.coalesce("t_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("t_score", F.lit(0.0))).alias("score"))


# --------------------------------------------------------------------------------------
# The whole tree: every word is a symbol
# --------------------------------------------------------------------------------------
def word_hash(word: bytes) -> int:
    """What Spark's ``xxhash64`` makes of the word, as an unsigned number."""
    return xxhash.xxh64_intdigest(word, 42)


END_HASH = word_hash(b" ")     # no word holds a space
NO_HASHES = np.zeros(0, np.uint64)


class Codes(dict):
    """Code 0 is no word, 1 ... k are the given words, k + 1 is the end; the other words follow, as they come."""

    def __init__(self, words: list[bytes]):
        super().__init__(zip(words, range(1, len(words) + 1)))
        self.end, self.others = len(words) + 1, []

    def __missing__(self, word: bytes) -> int:
        self.others.append(word)
        code = self[word] = self.end + len(self.others)
        return code

    def of(self, words: list[bytes]) -> np.ndarray:
        """The codes of a document's tokens."""
        out = np.empty(len(words) + 1, np.int32)
        out[:-1] = np.fromiter(map(self.__getitem__, words), np.int32, len(words))
        out[-1] = self.end
        return out

    def forget(self) -> np.ndarray:
        """Forgets the other words, and returns their hashes."""
        hashes = np.fromiter(map(word_hash, self.others), np.uint64, len(self.others))
        for word in self.others:
            del self[word]
        self.others = []
        return hashes


def words_before(ids: np.ndarray, place: np.ndarray, depth: int) -> list[np.ndarray]:
    """For d = 1..depth the code of the d-th word before each token, 0 where the document is younger."""
    out = []
    for d in range(1, depth + 1):
        w = np.zeros(len(ids), np.int32)
        w[d:] = ids[:-d]
        w[place < d] = 0
        out.append(w)
    return out


def context_hash(shorter: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a context that is one word longer (to the left); the empty context has 0."""
    return mix(shorter * np.uint64(ODD) + word)


def pair_hash(context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    return mix(mix(context) + symbol)


def found_in(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the ascending ``keys``, and whether they are the wanted ones."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def hot_chain(before: list[np.ndarray], hashes: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple]]:
    """The shortest context of each token that is not hot, whether there is one, and the hot ones below it: (rows, context) by length."""
    n = len(before[0]) if before else 0
    context, cold, levels = np.zeros(n, np.uint64), np.zeros(n, bool), []
    rows = np.arange(n)
    for codes in before:
        rows = rows[codes[rows] > 0]
        context[rows] = context_hash(context[rows], hashes[codes[rows]])
        is_hot = found_in(hot, context[rows])[1]
        cold[rows[~is_hot]] = True
        rows = rows[is_hot]
        if not len(rows):
            break
        levels.append((rows, context[rows]))
    return context, cold, levels


def places(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... in each of several documents in a row."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def laid(batches: Iterator[pa.RecordBatch], m: dict, depth: int) -> Iterator[tuple]:
    """Documents of (row_no, text, trained, scored) as (row, row numbers, flags, codes, words before, hash of every code), about ``FLUSHED``
    tokens at a time."""
    codes = Codes(m["hot"])
    numbers, marks, found, n = [], [], [], 0

    def flush() -> tuple:
        sizes = np.array([len(x) for x in found])
        ids = np.concatenate(found)
        return (np.repeat(np.arange(len(found), dtype=np.int32), sizes), np.array(numbers, np.int64), np.array(marks, np.uint8), ids,
                words_before(ids, places(sizes), depth), np.concatenate([m["hashes"], codes.forget()]))

    for b in batches:
        at = {k: b.schema.get_field_index(k) for k in ("row_no", "text", "trained", "scored")}
        mark = b.column(at["trained"]).to_numpy(zero_copy_only=False) + 2 * b.column(at["scored"]).to_numpy(zero_copy_only=False).astype(np.uint8)
        for number, t, k in zip(b.column(at["row_no"]).to_pylist(), b.column(at["text"]), mark.tolist()):
            numbers.append(number)
            marks.append(k)
            found.append(codes.of(tokens(t.as_py())))
            n += len(found[-1])
            if n > FLUSHED:
                made = flush()
                numbers, marks, found, n = [], [], [], 0
                yield made
    if found:
        yield flush()


def asked(ids: np.ndarray, before: list[np.ndarray], hashes: np.ndarray, m: dict) -> tuple[np.ndarray, list[tuple]]:
    """The piece (``TWIGS`` of them make a part) of every token, and the counts to look up for it: (rows, keys)."""
    symbol, n_hot = hashes[ids], len(m["hashes"]) - 1
    context, cold, levels = hot_chain(before, hashes, m["hot_contexts"])
    rare = np.flatnonzero(ids > n_hot)
    wanted = [(rare, symbol[rare])]
    for rows, c in levels:
        keys = pair_hash(c, symbol[rows])
        rows, keys = (x[~found_in(m["pair_keys"], keys)[1]] for x in (rows, keys))
        wanted.append((rows, keys))
    # A token without a longer context is dealt by the counts it asks for; when it asks for none, anywhere.
    last = np.flatnonzero(~cold)
    free = np.ones(len(ids), bool)
    for rows, _ in wanted:
        free[rows] = False
    route = context.copy()
    route[last] = np.where(free[last], last.astype(np.uint64), pair_hash(context[last], symbol[last]))
    return (mix(route) % np.uint64(m["parts"] * TWIGS)).astype(np.int64), wanted


def width_of(most: int) -> int:
    return max(1, (int(most).bit_length() + 7) // 8)


def in_planes(x: np.ndarray, most: int) -> bytes:
    """Whole numbers up to ``most`` (others modulo 256 ** width): how many bytes each has, then all lowest bytes, the next ones, ..."""
    width = width_of(most)
    rows = np.ascontiguousarray(x.astype(np.uint32)).view(np.uint8).reshape(-1, 4)
    return bytes([width]) + rows[:, :width].T.tobytes()


def steps(x: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Differences, but for where a piece begins."""
    out = np.diff(x, prepend=x.dtype.type(0))
    out[begins] = x[begins]
    return out


def packed(row: np.ndarray, numbers: np.ndarray, marks: np.ndarray, codes: list[np.ndarray], hashes: np.ndarray, n_hot: int, new: np.ndarray,
           ends: np.ndarray) -> bytes:
    """Some tokens, by piece (each up to its place in ``ends``) and rising last word, with the rows and rare words that they need.

    ``codes``: of the words before and of the tokens; ``new``: scratch space, as long as ``hashes``, that tells 0 ... ``n_hot`` apart.
    """
    used = np.zeros(len(numbers), bool)
    used[row] = True
    row, begins = (np.cumsum(used) - 1)[row], np.concatenate([[0], ends[:-1]])
    begins = begins[begins < len(row)]
    rare = np.unique(np.concatenate([c[c > n_hot] for c in codes]))
    new[rare] = np.arange(n_hot + 1, n_hot + 1 + len(rare), dtype=np.int32)
    codes, most, n_rows = [new[c] for c in codes], n_hot + len(rare), int(row.max()) + 1
    raw = b"".join([np.array([len(row), n_rows, len(rare), most, *ends], np.int64).tobytes(), np.diff(numbers[used], prepend=0).tobytes(), marks[used].tobytes(),
                    hashes[rare].tobytes(), in_planes(steps(row, begins), n_rows), in_planes(steps(codes[0], begins), most),
                    *[in_planes(c, most) for c in codes[1:]]])
    return np.int64(len(raw)).tobytes() + pa.Codec("zstd", 3).compress(raw, asbytes=True)


def opened(blob: bytes, columns: int) -> dict:
    """What ``packed`` made, with the places of its columns in ``raw``."""
    raw = pa.decompress(blob[8:], decompressed_size=int(np.frombuffer(blob[:8], np.int64)[0]), codec="zstd", asbytes=True)
    n, n_rows, n_rare, most, *ends = np.frombuffer(raw, np.int64, 4 + TWIGS).tolist()
    at = 8 * (4 + TWIGS)
    out = {"raw": raw, "n": n, "ends": [0, *ends], "numbers": np.cumsum(np.frombuffer(raw, np.int64, n_rows, at)),
           "marks": np.frombuffer(raw, np.uint8, n_rows, at + 8 * n_rows), "rare": np.frombuffer(raw, np.uint64, n_rare, at + 9 * n_rows),
           "most": [n_rows, *[most] * (columns - 1)], "columns": []}
    at += 9 * n_rows + 8 * n_rare
    for _ in range(columns):
        out["columns"].append(at)
        at += 1 + raw[at] * n
    return out


def column(x: dict, i: int, piece: int) -> np.ndarray:
    """Column ``i`` (0: the row, then the words before and the token) of a piece."""
    begin, end = x["ends"][piece : piece + 2]
    at, n = x["columns"][i], x["n"]
    width = x["raw"][at]
    out = np.zeros((end - begin, 4), np.uint8)
    for k in range(width):
        out[:, k] = np.frombuffer(x["raw"], np.uint8, end - begin, at + 1 + k * n + begin)
    out = out.view(np.uint32).reshape(-1)
    if i < 2:       # kept as differences, modulo 256 ** width
        out = np.cumsum(out, dtype=np.uint32)
        out = out if width > 3 else out % np.uint32(256 ** width)
    return out.view(np.int32)


def alike(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys, a row of each, and every row's number among them."""
    order = np.argsort(keys)
    keys = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    number = np.empty(len(keys), np.int32)
    number[order] = np.cumsum(new, dtype=np.int32) - np.int32(1)
    return keys[new], order[new], number


def word_probability(c: np.ndarray, m: dict) -> np.ndarray:
    """The root's probability of a word with count ``c``; c = 0 is the unknown word."""
    share = (m["in_words"] + 0.5) / (m["tokens"] + 1)
    return share * 10 ** rare_log(c, m["in_words"], m["words_known"], m["discount"])


def grown(symbols: np.ndarray, before: list[np.ndarray], trained: np.ndarray, p: np.ndarray, below: np.ndarray, boundary: np.ndarray,
          least: int) -> np.ndarray:
    """The tokens' probabilities in the tree of one part.

    ``below`` is the length of the hot context that a token's probability ``p`` is already that of, ``boundary`` a number of that context.
    """
    size = int(max(symbols.max(initial=0), *[w.max(initial=0) for w in before])) + 1
    p, context, live = p.copy(), -1 - boundary.astype(np.int64), np.zeros(len(p), bool)
    for d, w in enumerate(before, 1):
        rows = np.flatnonzero((w > 0) & (live | (below == d - 1)))
        live[:] = False
        if not len(rows):
            continue
        _, _, of = alike(context[rows] * size + w[rows])
        total = np.bincount(of, trained[rows])
        keep = total[of] >= least
        rows, of = rows[keep], of[keep]
        live[rows], context[rows] = True, of
        if not len(rows):
            continue
        pairs, one, pair = alike(of * np.int64(size) + symbols[rows])
        n = np.bincount(pair, trained[rows])
        seen = n > 0
        at = (pairs // size)[seen]
        kinds = np.bincount(at, minlength=len(total))
        gain = np.bincount(at, n[seen] * (np.log(n[seen]) - np.log(p[rows[one]][seen])), len(total))
        log_total = np.log(np.maximum(total, 1))
        retained = gain - total * log_total > 0.5 * log_total * kinds
        mixed = (n[pair] + kinds[of] * p[rows]) / (total + kinds)[of]
        p[rows] = np.where(retained[of], mixed, p[rows])
    return p


def part_scores(blobs: list[bytes], keys: np.ndarray, counts: np.ndarray, m: dict) -> list[np.ndarray]:
    """(row_no, n_tokens, n_known, base_score, score) of the scored rows' tokens in a part; a count that is not in ``keys`` is 1.

    A row may be there several times: Spark adds up."""
    n_hot, read = len(m["hashes"]) - 1, [opened(x, m["depth"] + 2) for x in blobs]
    rare = np.unique(np.concatenate([x["rare"] for x in read]))
    hashes = np.concatenate([m["hashes"], rare])
    first_row = np.cumsum([0] + [len(x["numbers"]) for x in read])
    numbers, marks = (np.concatenate([x[k] for x in read]) for k in ("numbers", "marks"))
    new_code = [np.searchsorted(rare, x["rare"]).astype(np.int32) + np.int32(n_hot + 1) for x in read]
    at, there = found_in(keys, rare)
    c = np.concatenate([[0], m["counts"], [m["ends"]], np.where(there, counts[at] if len(counts) else 0, 1)])
    root = word_probability(c, m)
    root[n_hot] = (m["ends"] + 0.5) / (m["tokens"] + 1)
    base, known = np.log10((c + 1) / (m["tokens"] + m["known"] + 1)), c > 0
    sums = np.zeros((4, len(numbers)))

    def whole(i: int, piece: int) -> np.ndarray:
        out = []
        for x, new in zip(read, new_code):
            codes = column(x, i, piece)
            is_rare = codes > n_hot
            codes[is_rare] = new[codes[is_rare] - (n_hot + 1)]
            out.append(codes)
        return np.concatenate(out)

    for piece in range(TWIGS):
        row = np.concatenate([column(x, 0, piece) + np.int32(first) for x, first in zip(read, first_row)])
        if not len(row):
            continue
        *before, symbols = [whole(i, piece) for i in range(1, m["depth"] + 2)]
        p = root[symbols]
        below, boundary = np.zeros(len(p), np.int8), np.zeros(len(p), np.int32)
        for d, (rows, contexts) in enumerate(hot_chain(before, hashes, m["hot_contexts"])[2], 1):
            hot = found_in(m["hot_contexts"], contexts)[0]
            below[rows], boundary[rows] = d, hot + 1
            pair = pair_hash(contexts, hashes[symbols[rows]])
            at, there = found_in(keys, pair)
            n = np.where(there, counts[at] if len(counts) else 0, 1)
            at, there = found_in(m["pair_keys"], pair)
            n = np.where(there, m["pair_counts"][at] if len(m["pair_counts"]) else 0, n)
            total, kinds, retained = (x[hot] for x in m["hot_figures"])
            p[rows] = np.where(retained, (n + kinds * p[rows]) / (total + kinds), p[rows])
        p = grown(symbols, before, (marks & 1)[row], p, below, boundary, m["least"])
        for x, weights in zip(sums, (None, known[symbols], base[symbols], np.log10(p))):
            x += np.bincount(row, weights, len(numbers))
    scored = (marks & 2) > 0
    return [numbers[scored], *[x[scored].astype(np.int64) for x in sums[:2]], *[x[scored] for x in sums[2:]]]


def hot_counts(train: DataFrame, m: dict, text: str, contexts: dict[int, tuple]) -> DataFrame:
    """(context, low, symbol, key, n): what follows the given hot contexts (hash -> words, last first); ``low`` is the context less its first word."""
    spark, ddl = train.sparkSession, "context long, low long, symbol long, key long, n long"
    length, words = len(next(iter(contexts.values()))), {h for c in contexts.values() for h in c}
    names = [w for w in m["hot"] if word_hash(w) in words]
    held = spark.sparkContext.broadcast((names, np.array([0, *map(word_hash, names)], np.uint64), np.sort(np.array(list(contexts), np.uint64))))
    schema = schema_of(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, hashes, wanted = held.value
        get = {w: i for i, w in enumerate(names, 1)}.get
        for b in batches:
            for _, found in parts(b, 0):
                flat = []
                for words in found:
                    flat += words
                    flat.append(b" ")
                ids = np.fromiter(map(get, flat, repeat(0)), np.int32, len(flat))
                before = words_before(ids, places(np.array([len(w) + 1 for w in found])), length)
                rows = np.flatnonzero(np.logical_and.reduce([w > 0 for w in before]))
                low = context = np.zeros(len(rows), np.uint64)
                for w in before:
                    low, context = context, context_hash(context, hashes[w[rows]])
                ok = np.flatnonzero(found_in(wanted, context)[1])
                symbol = np.fromiter((word_hash(flat[i]) for i in rows[ok].tolist()), np.uint64, len(ok))
                columns = [context[ok], low[ok], symbol]
                keys, one, n = np.unique(pair_hash(columns[0], symbol), return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (*[x[one] for x in columns], keys, n)], schema=schema)

    rows = train.select(F.col(text).cast("binary").alias("text"))
    return written(in_arrow(rows, run, ddl).groupBy("context", "low", "symbol", "key").agg(F.sum("n").alias("n")), "hot-contexts")


def fit_hot(train: DataFrame, model: dict, text: str, hot_context: int, hot_words: int) -> None:
    """The hot contexts of every length, from the root up: their counts (written tables), sizes and tests."""
    spark, m = train.sparkSession, model["held"]
    level = hashed_contexts([(word_hash(w),) for w, c in model["hot"] if c > hot_context])
    share = (m["in_words"] + 0.5) / (m["tokens"] + 1)
    p = (F.col("c") - m["discount"]) / max(m["in_words"], 1) * share
    low = model["words"].select(F.lit(0).cast("long").alias("low"), F.xxhash64("word").alias("symbol"), p.alias("p")).unionByName(
        spark.createDataFrame([(0, np.uint64(END_HASH).view(np.int64).item(), (m["ends"] + 0.5) / (m["tokens"] + 1))], "low long, symbol long, p double"))
    found, tables = [], []
    while level:
        counts = hot_counts(train, m, text, level)
        tables.append(counts)
        both = counts.join(low, ["low", "symbol"])
        figures = both.groupBy("context").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"), F.sum(F.col("n") * (F.log("n") - F.log("p"))).alias("gain"))
        log_total = F.log(F.col("total"))
        figures = written(figures.withColumn("retained", F.col("gain") - F.col("total") * log_total > 0.5 * log_total * F.col("kinds")).drop("gain"), "hot-figures")
        found += figures.collect()          # at most tokens / hot_context of each length
        mixed = F.when(F.col("retained"), (F.col("n") + F.col("kinds") * F.col("p")) / (F.col("total") + F.col("kinds"))).otherwise(F.col("p"))
        low = both.join(F.broadcast(figures), "context").select(F.col("context").alias("low"), "symbol", mixed.alias("p"))
        if len(next(iter(level.values()))) == m["depth"]:
            break
        longer = counts.filter((F.col("n") > hot_context) & (F.col("symbol") != F.lit(np.uint64(END_HASH).view(np.int64).item()))).select("context", "symbol").collect()
        level = hashed_contexts([(r.symbol % 2**64, *level[r.context % 2**64]) for r in longer])
        low = written(low, "hot-probabilities") if level else low
    if not tables:
        return
    m["hot_depth"] = len(tables)
    found.sort(key=lambda r: r.context % 2**64)
    m["hot_contexts"] = np.array([r.context % 2**64 for r in found], np.uint64)
    m["hot_figures"] = tuple(np.array([r[k] for r in found]) for k in ("total", "kinds", "retained"))
    pairs = tables[0]
    for t in tables[1:]:
        pairs = pairs.unionByName(t)
    model["pairs"] = pairs.select("key", "n")
    floor = count_floor(model["pairs"], "n", hot_words)
    if floor is not None:
        often = model["pairs"].filter(steps_of("n") >= floor).toArrow()
        keys, n = (often.column(i).to_numpy() for i in (0, 1))
        order = np.argsort(keys.view(np.uint64))
        m["pair_keys"], m["pair_counts"] = keys.view(np.uint64)[order], n[order]


def hashed_contexts(contexts: list[tuple]) -> dict[int, tuple]:
    """Contexts (hashes of their words, last first) by their hash."""
    out = {}
    for words in contexts:
        c = np.zeros(1, np.uint64)
        for w in words:
            c = context_hash(c, np.array([w], np.uint64))
        out[int(c[0])] = words
    return out


def even_labels(spark: SparkSession, n: int, tasks: int) -> np.ndarray:
    """``n`` numbers of which Spark's partitioning by hash deals about as many to each of ``tasks`` tasks."""
    ids = spark.range(40 * n + 1000).select(F.col("id").cast("int").alias("id"))
    order = F.row_number().over(Window.partitionBy("task").orderBy("id"))
    dealt = ids.select("id", F.pmod(F.hash("id"), F.lit(tasks)).alias("task")).withColumn("turn", order)
    return dealt.orderBy("turn", "task").limit(n).select("id").toArrow().column(0).to_numpy().astype(np.int32)


def fit(train: DataFrame, text: str = "text", symbols: int | None = None, depth: int | None = None, p_min: float = P_MIN,
        hot_words: int = HOT_WORDS, least: int = LEAST, hot_context: int = HOT_CONTEXT) -> dict:
    """Learn word counts (a written table) and hot contexts of the whole tree, whose other branches ``score`` grows; with
    ``symbols`` the tree of a bounded alphabet, to which ``p_min`` applies and ``least`` and ``hot_context`` do not."""
    if symbols is not None:
        return fit_bounded(train, symbols, text, depth or BOUNDED_DEPTH, p_min, hot_words)
    model = {**counts_of(train, text, hot_words), "train": train.select(F.col(text).alias("text"))}
    hot = model["hot"]
    model["held"] = {
        **{k: model[k] for k in ("tokens", "known", "ends", "in_words", "words_known", "discount")}, "depth": depth or DEPTH, "least": least,
        "hot": [w for w, _ in hot], "hashes": np.array([0, *[word_hash(w) for w, _ in hot], END_HASH], np.uint64), "counts": np.array([c for _, c in hot], np.int64),
        "hot_contexts": NO_HASHES, "hot_depth": 0, "hot_figures": (), "pair_keys": NO_HASHES, "pair_counts": np.zeros(0, np.int64)}
    fit_hot(train, model, text, hot_context, hot_words)
    return model


def score(docs: DataFrame, model: dict, text: str = "text", doc_id: str = "doc_id", trained: Column | None = None,
          part_bytes: int = PART_BYTES) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) of every row of ``docs``.

    ``trained`` tells which rows of ``docs`` are those that the model was fitted on; without it the training rows
    are read beside them.
    """
    if "tree" in model:
        return score_bounded(docs, model, text, doc_id)
    spark = docs.sparkSession
    out = with_id(docs, doc_id, "row_no long, n_tokens long, n_known long, base_score double, score double")
    sent = with_id(docs, doc_id, "part int, blob binary, row_no long")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text"),
                       (F.lit(False) if trained is None else F.coalesce(trained, F.lit(False))).alias("trained"), F.lit(True).alias("scored"))
    if trained is None:
        rows = rows.unionByName(model["train"].select(F.lit(None).cast(out["doc_id"].dataType).alias("doc_id"), F.col("text").cast("binary").alias("text"),
                                                      F.lit(True).alias("trained"), F.lit(False).alias("scored")))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rows = rows.withColumn("row_no", F.monotonically_increasing_id())
    n_parts = max(1, -(-size // part_bytes))
    # Tasks with several parts each add up what these have of a document; the parts' labels are dealt evenly to them.
    tasks = min(n_parts, max(4 * spark.sparkContext.defaultParallelism, -(-n_parts // 8)))
    held = spark.sparkContext.broadcast({**model["held"], "parts": n_parts, "labels": even_labels(spark, n_parts, tasks)})
    sent_schema, out_schema, asked_schema = schema_of(sent), schema_of(out), schema_of("part int, key long")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        hot_words = found_in(m["hot_contexts"], context_hash(np.uint64(0), m["hashes"]))[1]
        for _, _, _, ids, before, hashes in laid(batches, m, min(m["depth"], m["hot_depth"] + 1)):
            some = ids >= len(m["hashes"])
            if m["hot_depth"]:
                some |= np.concatenate([hot_words, np.zeros(len(hashes) - len(hot_words), bool)])[before[0]]
            part, wanted = asked(ids[some], [w[some] for w in before], hashes, m)
            part = m["labels"][part // TWIGS]
            part, key = (np.concatenate(x) for x in zip(*[(part[r], k) for r, k in wanted]))
            order = np.lexsort((key, part))
            part, key = part[order], key[order]
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (part[1:] != part[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(part[new]), pa.array(key[new].view(np.int64))], schema=asked_schema)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        n_hot, told = len(m["hashes"]) - 1, []

        def heard(batches):
            for b in batches:
                scored = b.filter(b.column(b.schema.get_field_index("scored")))
                told.append((scored.column(scored.schema.get_field_index("doc_id")), scored.column(scored.schema.get_field_index("row_no"))))
                yield b

        def tell():
            while told:
                ids, numbers = told.pop()
                part = pa.array(m["labels"][numbers.to_numpy() % m["parts"]])
                yield pa.RecordBatch.from_arrays([ids, part, pa.nulls(len(ids), pa.binary()), numbers], schema=sent_schema)

        for row, numbers, marks, ids, before, hashes in laid(heard(batches), m, m["depth"]):
            piece = asked(ids, before, hashes, m)[0]
            codes, new = [*before, ids], np.arange(len(hashes), dtype=np.int32)
            # numbers of two bytes are sorted without comparisons
            order = np.lexsort([(x >> k).astype(np.uint16) for x, k in ((codes[0], 0), (codes[0], 16), (piece, 0), (piece, 16))][: 3 + (m["parts"] * TWIGS >= 1 << 16)])
            ends = np.searchsorted(piece[order], np.arange(m["parts"] * TWIGS + 1))
            for k in np.flatnonzero(np.diff(ends[::TWIGS])).tolist():
                at = ends[k * TWIGS : (k + 1) * TWIGS + 1]
                some = order[at[0] : at[-1]]
                blob = packed(row[some], numbers, marks, [c[some] for c in codes], hashes, n_hot, new, at[1:] - at[0])
                yield pa.RecordBatch.from_arrays([pa.nulls(1, sent_schema.field(0).type), pa.array(m["labels"][k : k + 1]), pa.array([blob], pa.binary()),
                                                  pa.nulls(1, pa.int64())], schema=sent_schema)
            yield from tell()
        yield from tell()

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, added, label, blobs, keys, counts = held.value, [], None, [], [], []

        def made(ids: pa.Array | None, *columns: np.ndarray) -> pa.RecordBatch:
            ids = pa.nulls(len(columns[0]), out_schema.field(0).type) if ids is None else ids
            return pa.RecordBatch.from_arrays([ids, *[pa.array(x) for x in columns]], schema=out_schema)

        def add_up() -> None:       # what several parts have of a document
            nonlocal added
            rows, _, at = alike(np.concatenate([x[0] for x in added]))
            sums = [np.bincount(at, np.concatenate([x[i] for x in added]), len(rows)) for i in range(1, 5)]
            added = [[rows, *[x.astype(np.int64) for x in sums[:2]], *sums[2:]]]

        def grown_part() -> Iterator[pa.RecordBatch]:
            if blobs:
                key, n = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (keys, counts))
                key = key.view(np.uint64)
                order = np.argsort(key)
                added.append(part_scores(blobs, key[order], n[order], m))
            for x in (blobs, keys, counts):
                x.clear()
            if sum(len(x[0]) for x in added) > ADDED:
                add_up()
                if 2 * len(added[0][0]) > ADDED:
                    yield made(None, *added.pop())

        for b in batches:
            part, blob, key, n = (b.column(b.schema.get_field_index(k)) for k in ("part", "blob", "key", "n"))
            told = b.filter(b.column(b.schema.get_field_index("row_no")).is_valid())
            if len(told):
                zero = np.zeros(len(told))
                ids, numbers = (told.column(told.schema.get_field_index(k)) for k in ("doc_id", "row_no"))
                yield made(ids, numbers.to_numpy(), *[zero.astype(np.int64)] * 2, zero, zero)
            labels = part.to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(labels)) + 1).tolist(), len(labels)]
            for begin, end in zip(cuts, cuts[1:]):
                if begin == end:
                    continue
                if labels[begin] != label:
                    yield from grown_part()
                    label = labels[begin]
                blobs += blob.slice(begin, end - begin).drop_null().to_pylist()
                keys.append(key.slice(begin, end - begin).drop_null().to_numpy())
                counts.append(n.slice(begin, end - begin).drop_null().to_numpy())
        yield from grown_part()
        if added:
            add_up()
            yield made(None, *added[0])

    counts = model["words"].select(F.xxhash64("word").alias("key"), F.col("c").alias("n"))
    if "pairs" in model:
        counts = counts.unionByName(model["pairs"])
    # a count of 1 is not sent: most of the counts asked for are
    told = in_arrow(rows.select("row_no", "text", "trained", "scored"), ask, "part int, key long").join(counts, "key", "left") \
        .select("part", "key", F.coalesce("n", F.lit(0)).alias("n")).where("n != 1")
    both = in_arrow(rows, send, sent).unionByName(told, allowMissingColumns=True).repartition(tasks, "part").sortWithinPartitions("part")
    found = in_arrow(both, grow, out)
    return found.groupBy("row_no").agg(F.first("doc_id", ignorenulls=True).alias("doc_id"), F.sum("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"),
                                       F.sum("base_score").alias("base_score"), F.sum("score").alias("score")).drop("row_no")


def is_training(doc_id: Column) -> Column:
    return ~F.coalesce(held_out(doc_id, 7), F.lit(False))


def op4_suffix_tree_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a tree learned from those that are not held out."""
    docs = read_table(spark, sf_dir, "documents")
    model = fit(docs.filter(is_training(F.col("doc_id"))))
    return score(docs, model, trained=is_training(F.col("doc_id"))).select("doc_id", (~is_training(F.col("doc_id"))).alias("held_out"), "n_tokens", "n_known",
                                     F.lit(model["tokens"]).cast("long").alias("train_tokens"), "base_score", "score")
