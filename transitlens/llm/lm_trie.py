"""A compact n-gram trie: Elias-Fano levels with quantised probabilities.

Level 0 numbers the words, level 1 has the contexts, level 2 the successors of
each. A level is a monotone sequence: words and contexts by their hashes,
successors by their number within the context they follow (rank of the context,
then number of the word). Pointers from contexts to their successors are
monotone as well. All are Elias-Fano coded: the low bits of
each value packed, the high bits in unary, with a directory for every chunk of
values. Probabilities and back-off weights are 16-bit codes of their logarithm.

A trie is one block of bytes that is mapped into memory; a search decodes the
chunks that its sorted queries fall into.
"""

from __future__ import annotations

import mmap
import tempfile

import numpy as np

CHUNK = 1 << 16
#: Codes per unit of log10: a code of 65,535 is 10 ** -32.
STEPS = 2000


def code(log10: np.ndarray) -> np.ndarray:
    """16-bit codes of logarithms that are 0 or less."""
    return np.clip(np.rint(-log10 * STEPS), 0, 65535).astype(np.uint16)


class EliasFano:
    """A monotone sequence of whole numbers below 2 ** 63."""

    FIELDS = ("head", "firsts", "low_at", "high_at", "low", "high")

    def __init__(self, parts: dict[str, np.ndarray]):
        self.n, self.bits = map(int, parts["head"])
        self.firsts, self.low_at, self.high_at = parts["firsts"], parts["low_at"], parts["high_at"]
        self.low, self.high = parts["low"], parts["high"]

    @staticmethod
    def build(values: np.ndarray) -> dict[str, np.ndarray]:
        values = values.astype(np.int64)
        n = len(values)
        top = int(values[-1]) + 1 if n else 1
        bits = max(0, (top // max(1, n)).bit_length() - 1)
        firsts, low_at, high_at, low, high = [], [0], [0], [], []
        for a in range(0, n, CHUNK):
            v = values[a:a + CHUNK]
            firsts.append(v[0])
            if bits:
                low.append(np.packbits((v[:, None] >> np.arange(bits)) & 1))
                low_at.append(low_at[-1] + len(low[-1]))
            else:
                low_at.append(low_at[-1])
            ups = (v >> bits) - (v[0] >> bits)
            unary = np.zeros(int(ups[-1]) + len(v), np.uint8)
            unary[ups + np.arange(len(v))] = 1
            high.append(np.packbits(unary))
            high_at.append(high_at[-1] + len(high[-1]))
        join = lambda x: np.concatenate(x) if x else np.zeros(0, np.uint8)
        return {"head": np.array([n, bits], np.int64), "firsts": np.array(firsts, np.int64),
                "low_at": np.array(low_at, np.int64), "high_at": np.array(high_at, np.int64),
                "low": join(low), "high": join(high)}

    def chunk(self, k: int) -> np.ndarray:
        count = min(CHUNK, self.n - k * CHUNK)
        ones = np.flatnonzero(np.unpackbits(self.high[self.high_at[k]:self.high_at[k + 1]]))[:count]
        out = (ones - np.arange(count) + (self.firsts[k] >> self.bits)) << self.bits
        if self.bits:
            low = np.unpackbits(self.low[self.low_at[k]:self.low_at[k + 1]], count=count * self.bits)
            out += low.reshape(count, self.bits) @ (1 << np.arange(self.bits, dtype=np.int64))
        return out

    def get(self, places: np.ndarray) -> np.ndarray:
        """Values at sorted places."""
        out = np.empty(len(places), np.int64)
        for k, a, b in _runs(places // CHUNK):
            out[a:b] = self.chunk(k)[places[a:b] - k * CHUNK]
        return out

    def find(self, queries: np.ndarray) -> np.ndarray:
        """Places of sorted queries; -1 for those that aren't there."""
        out = np.full(len(queries), -1, np.int64)
        for k, a, b in _runs(np.searchsorted(self.firsts, queries, side="right") - 1):
            if k < 0:
                continue
            values = self.chunk(k)
            at = np.minimum(np.searchsorted(values, queries[a:b]), len(values) - 1)
            hit = values[at] == queries[a:b]
            out[a:b][hit] = at[hit] + k * CHUNK
        return out


def _runs(x: np.ndarray) -> list[tuple[int, int, int]]:
    """(value, begin, end) of each run of equal values."""
    starts = np.flatnonzero(np.diff(x, prepend=x[0] - 1 if len(x) else 0)) if len(x) else np.zeros(0, int)
    return [(int(x[a]), int(a), int(b)) for a, b in zip(starts, [*starts[1:], len(x)], strict=True)]


class Trie:
    """Levels of words, contexts and successors."""

    def __init__(self, block: memoryview | bytes):
        """Map the levels of a block that ``build`` made."""
        head = np.frombuffer(block, np.int64, 1)[0]
        sizes = np.frombuffer(block, np.int64, int(head) * 2, 8).reshape(-1, 2)
        at, arrays = 8 + 16 * int(head), []
        for n, kind in sizes:
            kind = np.dtype((np.uint8, np.uint16, np.int64)[kind])
            arrays.append(np.frombuffer(block, kind, int(n), at))
            at += -(-int(n) * kind.itemsize // 8) * 8
        step = len(EliasFano.FIELDS)
        self.words, self.contexts, self.pointers, self.successors = (
            EliasFano(dict(zip(EliasFano.FIELDS, arrays[k * step:(k + 1) * step], strict=True))) for k in range(4))
        self.backoffs, self.codes = arrays[4 * step:]

    @staticmethod
    def build(words: np.ndarray, contexts: np.ndarray, pointers: np.ndarray, successors: np.ndarray,
              codes: np.ndarray, backoffs: np.ndarray) -> bytes:
        """From sorted words and contexts (numbers below 2 ** 63), the place of each context's first
        successor (and the end), and the successors as places in ``words``, in order within a context."""
        rank = np.repeat(np.arange(len(contexts), dtype=np.int64), np.diff(pointers))
        levels = (words, contexts, pointers, rank << 32 | successors.astype(np.int64))
        arrays = [EliasFano.build(x)[f] for x in levels for f in EliasFano.FIELDS] + [backoffs.astype(np.uint16), codes.astype(np.uint16)]
        kinds = {1: 0, 2: 1, 8: 2}
        sizes = np.array([[len(a), kinds[a.itemsize]] for a in arrays], np.int64)
        out = [np.array([len(arrays)], np.int64).tobytes(), sizes.tobytes()]
        for a in arrays:
            raw = a.tobytes()
            out.append(raw + b"\0" * (-len(raw) % 8))
        return b"".join(out)

    def search(self, words: np.ndarray, contexts: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For sorted pairs (place in sorted ``contexts`` << 32 | place in sorted ``words``):
        the place of the successor (-1: unseen) and of the context (-1: unseen)."""
        number, rank = self.words.find(words), self.contexts.find(contexts)
        rank, number = rank[pairs >> 32], number[pairs & 0xFFFFFFFF]
        place = np.full(len(pairs), -1, np.int64)
        known = np.flatnonzero((rank >= 0) & (number >= 0))
        if len(known):
            found = self.successors.find(rank[known] << 32 | number[known])
            first, end = self.pointers.get(rank[known]), self.pointers.get(rank[known] + 1)
            place[known] = np.where((found >= first) & (found < end), found, -1)
        return place, rank


def mapped(block: bytes) -> memoryview:
    """A block in a memory-mapped file that is gone with its last use."""
    with tempfile.TemporaryFile() as f:  # it has no name: nothing is left behind
        f.write(block)
        f.flush()
        return memoryview(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))
