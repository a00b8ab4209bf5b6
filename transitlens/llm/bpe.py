"""Byte-pair merges compiled into a deterministic automaton.

The automaton reads tokens. Every token leads to one state, and a state says
which tokens may come next. It starts with one state in which every symbol
loops; merges are then applied in order of priority, one gadget each. The
gadget of merge (u, v) -> w, with p the state that u leads to:

* a copy of p without the arc v becomes the state that u leads to, since u
  followed by v would have been merged;
* every state with an arc u gains an arc w to the state that v led to.

The sequences that the finished automaton accepts are the tokenisations that
the merges produce, exactly one for each string of symbols. States are kept as
what was cut from them and when: the state of a token t is a row of cuts of its
own, on top of the row its right part had when t was made. An arc t exists in a
state if neither t nor one of the left parts it grew from was cut before the
next part was made.

Encoding follows the one accepted path that spells a word: arcs are looked up
by the symbols ahead, and a table of transitions says which of them the current
state has.
"""

from __future__ import annotations

import json
import unicodedata
from functools import cache

from tokenizers import Tokenizer

INFINITE = 1 << 60
#: Lengths of the prefixes that are remembered, and how many of them.
STEMS, STEMS_KEPT = (9, 6), 150_000


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies.

    Printable Latin-1 characters stand for themselves; the other bytes take
    the code points from 256 on, in order.
    """
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters, free = [""] * 256, 256
    for b in own:
        letters[b] = chr(b)
    for b in range(256):
        if not letters[b]:
            letters[b], free = chr(free), free + 1
    return letters


class MergeAutomaton:
    """The automaton of one vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model.get("end_of_word_suffix") or ""
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
        self.labels = {i: s for s, i in [*self.ids.items(), *self.special.items()]}
        self.letters = byte_letters()
        self.to_letters = {b: s for b, s in enumerate(self.letters)}
        size = max(self.labels) + 1
        self.left, self.born = [-1] * size, [-1] * size
        self.cuts: list[dict[int, tuple[int, int]]] = [{} for _ in range(size)]
        self.base: list[tuple[int, int] | None] = [None] * size
        made = set()
        for time, merge in enumerate(model["merges"]):
            u, v = (self.ids[x] for x in (merge if isinstance(merge, list) else merge.split(" ")))
            made.add(self._gadget(u, v, self.ids["".join(merge if isinstance(merge, list) else merge.split(" "))], time))
        # Words of the vocabulary that no merge makes and that aren't symbols are never produced.
        self.text = {i: s.removesuffix(self.end) if self.end else s for s, i in self.ids.items()}
        self.trie: dict = {}
        for s, i in self.ids.items():
            if i in made or len(self.text[i]) == 1:
                node = self.trie
                for x in self.symbols(self.text[i]) if s != self.text[i] else s:
                    node = node.setdefault(x, {})
                node[0] = i
        self.tokens = {s: i for s, i in self.ids.items() if s == self.text[i] and (i in made or len(s) == 1)}
        self.known: dict[int, bool] = {}
        self.stems: dict[str, tuple[list[int], list[int]]] = {}

    def _gadget(self, u: int, v: int, w: int, time: int) -> int:
        if not self._arc(u, v):  # u's state has no arc v: the merge can't occur
            return -1
        self.left[w], self.born[w] = u, time
        self.base[w] = (v, len(self.cuts[v]))
        self.cuts[u][v] = (len(self.cuts[u]), time)
        return w

    def _arc(self, t: int, after: int) -> bool:
        """Whether the state that ``t`` leads to has the arc ``after``."""
        owner, rows = t, len(self.cuts[t])
        while True:
            cut = self.cuts[owner]
            if cut:
                x, until = after, INFINITE
                while x >= 0:
                    hit = cut.get(x)
                    if hit is not None and hit[0] < rows and hit[1] <= until:
                        return False
                    until, x = self.born[x], self.left[x]
            below = self.base[owner]
            if below is None:
                return True
            owner, rows = below

    def arc(self, t: int, after: int) -> bool:
        key = t << 20 | after
        got = self.known.get(key)
        if got is None:
            if len(self.known) > 500_000:
                self.known.clear()
            got = self.known[key] = self._arc(t, after)
        return got

    def symbols(self, word: str) -> list[str]:
        """A word in byte letters as the automaton's symbols; the last one has the end mark."""
        out = list(word)
        if out and self.end:
            out[-1] += self.end
        return out

    def encode_word(self, word: str) -> list[int]:
        """The tokens of a word, by transitions from the first state, longest arcs first.

        The accepted path is unique, so a position that once led nowhere never
        has to be reached again.
        """
        symbols = self.symbols(word)
        n, trie, known, dead = len(symbols), self.trie, self.known, set()
        out: list[int] = []
        open_arcs: list[list[tuple[int, int]]] = []
        i, before = 0, -1
        while i < n:
            if len(open_arcs) == len(out):  # a new position: what can be read from here
                found, node = [], trie
                for k in range(i, n):
                    node = node.get(symbols[k])
                    if node is None:
                        break
                    token = node.get(0)
                    if token is not None:
                        found.append((token, k + 1))
                open_arcs.append(found)
            found = open_arcs[-1]
            while found:
                token, end = found.pop()
                if end in dead:
                    continue
                if before >= 0:
                    good = known.get(before << 20 | token)
                    if not (self.arc(before, token) if good is None else good):
                        continue
                out.append(token)
                i, before = end, token
                break
            else:  # nowhere to go: back to the position before
                dead.add(i)
                open_arcs.pop()
                i -= len(self.text[out.pop()])
                before = out[-1] if out else -1
        return out

    def prefix_counts(self, word: str) -> list[int]:
        """Exact token counts of all prefixes of a word, by dynamic programming.

        For each position the one token that ends the accepted path to it is
        found by an arc from an earlier position; the count is that
        position's count and one more. Entry i is for i letters. What is known
        of a prefix holds in every word that begins with it, so words with a
        common stem go on from there.
        """
        n, known, tokens, stems = len(word), self.known, self.tokens, self.stems
        last, counts = [-1], [0]
        for stem in STEMS:
            if n > stem and (have := stems.get(word[:stem])):
                last, counts = have[0][:], have[1][:]
                break
        for end in range(len(last), n + 1):
            for start in range(end - 1, -1, -1):
                token = tokens.get(word[start:end])
                if token is None:
                    continue
                before = last[start]
                if before >= 0:
                    good = known.get(before << 20 | token)
                    if not (self.arc(before, token) if good is None else good):
                        continue
                last.append(token)
                counts.append(counts[start] + 1)
                break
            else:  # not a letter of the vocabulary
                last.append(-1)
                counts.append(0)
            if end in STEMS and n > end:
                if len(stems) >= STEMS_KEPT:
                    stems.clear()
                stems[word[:end]] = last[:], counts[:]
        return counts

    def spell(self, piece: str) -> str:
        """A piece of text in byte letters."""
        if piece.isascii() and piece.isprintable() and " " not in piece:
            return piece
        letters = self.letters
        return "".join([letters[b] for b in piece.encode("utf-8", "surrogatepass")])


_LOADED: dict[str, MergeAutomaton] = {}


def automaton(path: str) -> MergeAutomaton:
    """The automaton of a file, compiled once in each Python worker."""
    if path not in _LOADED:
        _LOADED[path] = MergeAutomaton(path)
    return _LOADED[path]


_ASSIGNED: set[str] = set()


def unassigned(text: str) -> bool:
    """Whether a text has a code point that this Python's Unicode tables don't know.

    Libraries differ on these, so that such texts are split by the tokenizers
    library itself.
    """
    new = set(text) - _ASSIGNED
    if new:
        good = {c for c in new if unicodedata.category(c) != "Cn"}
        _ASSIGNED.update(good)
        return len(good) < len(new)
    return False


@cache
def library(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


def library_split(path: str, text: str) -> tuple[str, list[tuple[int, int]]]:
    """The normalised text and the places of its pieces, by the tokenizers library."""
    tool = library(path)
    if tool.normalizer is not None:
        text = tool.normalizer.normalize_str(text)
    return text, [place for _, place in tool.pre_tokenizer.pre_tokenize_str(text)]
