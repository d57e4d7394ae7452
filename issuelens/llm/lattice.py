"""Walking the piece lattices of many words at once."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np


class Trie:
    """A trie of pieces over ASCII and the most used other characters of the vocabulary, as arrays.

    Words are laid out as a grid of character codes, the longest first; ``steps`` then walks all
    their lattices together, start by start.  Words with a character outside the trie's
    alphabet, or longer than ``LONGEST``, are ``odd``: their lattice is walked singly elsewhere.
    """

    LETTERS, LONGEST, TOGETHER = 256, 40, 8192

    def __init__(self, pieces: list[str]):
        self.longest = max(map(len, pieces), default=1)
        counts = sorted(Counter("".join(pieces)).items(), key=lambda x: (not x[0].isascii(), -x[1], x[0]))
        used = [c for c, _ in counts[: self.LETTERS - 1] if ord(c) < 65_536]
        self.code = np.zeros(65_536, np.uint8)
        self.code[[ord(c) for c in used]] = np.arange(1, len(used) + 1)
        known, edges, piece_of = set(used), {}, {}
        for i, p in enumerate(pieces):
            if known.issuperset(p):
                node = 0
                for c in p:
                    node = edges.setdefault((node, self.code[ord(c)]), len(edges) + 1)
                piece_of[node] = i
        self.child = np.zeros((len(edges) + 1, self.LETTERS), np.uint16 if len(edges) < 65_535 else np.int32)
        if edges:
            at = np.array(list(edges), np.int64)
            self.child[at[:, 0], at[:, 1]] = list(edges.values())
        self.piece = np.full(len(edges) + 1, -1, np.int32)
        self.piece[list(piece_of)] = list(piece_of.values())

    def grids(self, words: list[str]) -> tuple[np.ndarray, Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
        """The odd words' places, and the others as (places, grid, sizes) in lots of ``TOGETHER``."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.where(points < 65_536, self.code[np.minimum(points, 65_535)], 0)
        begins = np.concatenate([[0], np.cumsum(sizes)])
        strange = np.concatenate([[0], np.cumsum(codes == 0)])
        odd = (strange[begins[1:]] > strange[begins[:-1]]) | (sizes > self.LONGEST) | (sizes == 0)
        plain = np.flatnonzero(~odd)
        plain = plain[np.argsort(-sizes[plain], kind="stable")]

        def lots():
            for at in range(0, len(plain), self.TOGETHER):
                some = plain[at : at + self.TOGETHER]
                size = sizes[some]
                grid = np.zeros((len(some), int(size[0]) + 1), np.uint8)
                rows = np.repeat(np.arange(len(some)), size)
                cols = np.arange(len(rows)) - np.repeat(np.cumsum(size) - size, size)
                grid[rows, cols] = codes[begins[some][rows] + cols]
                yield some, grid, size

        return np.flatnonzero(odd), lots()

    def steps(self, grid: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(start, end, rows, pieces) of all arcs, by start, then end; piece -1 is an unknown character."""
        width = int(sizes[0])
        for start in range(width):
            rows = np.arange(int(np.searchsorted(-sizes, -start, side="left")))       # words longer than start
            node = self.child[0, grid[rows, start]]
            yield start, start + 1, rows, self.piece[node]
            for end in range(start + 2, min(width, start + self.longest) + 1):
                alive = node > 0
                rows, node = rows[alive], node[alive]
                if not len(rows):
                    break
                node = self.child[node, grid[rows, end - 1]]
                piece = self.piece[node]
                hit = piece >= 0
                yield start, end, rows[hit], piece[hit]
