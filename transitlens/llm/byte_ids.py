"""Token ids of whole batches of texts for byte-level vocabularies.

Texts of a batch are split together: every code point has a class, and the
pieces of the pre-tokeniser begin where classes change, but for three rules (a
blank belongs to what follows it, a longer white space keeps its last character
apart, a contraction takes its letters). Different pieces are encoded once by
the tokenizers library and kept; a batch's ids are gathered from them. Texts
that hold a special token, or a code point that this Python doesn't know, are
encoded by the library as they are.
"""

from __future__ import annotations

import unicodedata
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from tokenizers import Tokenizer

from transitlens.llm.bpe import byte_letters

OTHER, LETTER, NUMBER, SPACE, UNKNOWN = range(5)
#: Pieces that are kept before they are given up, and the longest such piece.
KEPT, LONGEST_KEPT = 400_000, 64


def _classes() -> np.ndarray:
    out = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))
        if kind[0] in "LN":
            out[c] = LETTER if kind[0] == "L" else NUMBER
        elif kind == "Cn":
            out[c] = UNKNOWN
    blanks = regex.findall(r"\p{White_Space}", "".join(map(chr, range(0xD800))))
    out[[ord(c) for c in blanks]] = SPACE
    return out


class ByteIds:
    """Ids of texts by one vocabulary file; made once in a worker, its kept pieces are those of a task."""

    loaded: dict[str, tuple[Tokenizer, np.ndarray, list[str]]] = {}
    letters = dict(enumerate(byte_letters()))

    def __init__(self, path: str):
        if path not in self.loaded:
            tool = Tokenizer.from_file(path)
            tool.no_truncation()
            tool.no_padding()
            special = [t.content for t in tool.get_added_tokens_decoder().values()]
            self.loaded[path] = tool, _classes(), special
        self.tool, self.classes, self.special = self.loaded[path]
        self.known: dict[bytes, bytes] = {}

    def _piece_starts(self, points: np.ndarray, kinds: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Where pieces begin in the code points of several texts, which end at ``ends``."""
        n = len(points)
        text_start = np.zeros(n + 4, bool)
        text_start[0] = True
        text_start[ends] = True  # also behind the last one
        kinds = np.append(kinds, np.full(4, UNKNOWN, np.uint8))
        points = np.append(points, np.zeros(4, np.uint32))
        start = text_start.copy()
        start[1:] |= kinds[1:] != kinds[:-1]
        # White space before something else: its last character is apart, a blank goes with what follows.
        last = np.flatnonzero((kinds[:n] == SPACE) & start[1:n + 1] & ~text_start[1:n + 1])
        start[last] = True
        start[last[points[last] == 0x20] + 1] = False
        # Contractions: a piece that is one quote before letters.
        quote = np.flatnonzero((points[:n] == 0x27) & start[:n])
        quote = quote[start[quote + 1] & (kinds[quote + 1] == LETTER) & ~text_start[quote + 1]]
        first, second = points[quote + 1], np.where(text_start[quote + 2], 0, points[quote + 2])
        one = np.isin(first, [ord(c) for c in "stmd"])
        two = ((second == ord("e")) & np.isin(first, [ord("r"), ord("v")])) | ((first == ord("l")) & (second == ord("l")))
        for which, length in ((one, 2), (two, 3)):
            at = quote[which]
            start[at + 1] = False
            start[at[kinds[at + length] == LETTER] + length] = True
        return np.flatnonzero(start[:n])

    def _encoded(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of pieces as little-endian bytes."""
        known, tokenize, letters = self.known, self.tool.model.tokenize, self.letters
        if len(known) > KEPT:
            known.clear()
        out = list(map(known.get, pieces))
        for i, got in enumerate(out):
            if got is None:
                tokens = tokenize(pieces[i].decode("latin-1").translate(letters))
                got = out[i] = pack(f"<{len(tokens)}I", *[t.id for t in tokens])
                if len(pieces[i]) <= LONGEST_KEPT:
                    known[pieces[i]] = got
        return out

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text as unsigned 32-bit numbers."""
        texts = [t or "" for t in texts]
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
        plain = [i for i, t in enumerate(texts) if t and not any(s in t for s in self.special)]
        points = np.frombuffer("".join([texts[i] for i in plain]).encode("utf-32-le"), np.uint32)
        ends = np.cumsum([len(texts[i]) for i in plain])
        kinds = self.classes[points]
        odd = {plain[i] for i in np.searchsorted(ends, np.flatnonzero(kinds == UNKNOWN), "right")}
        for i, t in enumerate(texts):
            if i in odd or any(s in t for s in self.special):
                out[i] = np.array(self.tool.encode(t, add_special_tokens=False).ids, np.uint32)
        if odd:
            good = [t if i not in odd and not any(s in t for s in self.special) else None for i, t in enumerate(texts)]
            return [mine if good[i] is None else got for i, (mine, got) in enumerate(zip(out, self.encode(good), strict=True))]
        if not plain:
            return out
        starts = self._piece_starts(points, kinds, ends)
        data = "".join([texts[i] for i in plain]).encode()
        width = 1 + (points >= 0x80).astype(np.int32) + (points >= 0x800) + (points >= 0x10000)
        at = np.append(0, np.cumsum(width, dtype=np.int64))
        offsets = np.append(at[starts], len(data))
        pieces = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        each = self._encoded(pieces.dictionary.to_pylist())
        pool = np.frombuffer(b"".join(each), "<u4")
        lengths = np.fromiter(map(len, each), np.int64, len(each)) // 4
        begins = np.cumsum(lengths) - lengths
        which = pieces.indices.to_numpy()
        counts = lengths[which]
        before = np.append(0, np.cumsum(counts))
        ids = pool[np.arange(before[-1]) + np.repeat(begins[which] - before[:-1], counts)]
        cuts = before[np.searchsorted(starts, np.append(0, ends))]
        for n, i in enumerate(plain):
            out[i] = ids[cuts[n]:cuts[n + 1]]
        return out
