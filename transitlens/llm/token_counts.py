"""Token counts of every prefix, by dynamic programming.

For each text a table holds the exact number of tokens of every prefix, one
entry per character. Budget questions (how many tokens, does it fit, where to
cut) are answered from the table without encoding again.

Inside a piece of the pre-tokeniser the counts come from
``MergeAutomaton.prefix_counts``. Across pieces the counts add up, but for
prefixes whose own split differs from that of the whole text; these get their
own counts:

* a prefix that ends in white space has its whole last run as one piece;
* a prefix that ends inside a contraction such as 're has its quote and its
  letter apart;
* a prefix that ends inside the string of a special token is plain text there.

Defined cases: a null or empty text has the single entry 0; null and repeated
ids are kept, one row each; an empty table gives an empty result. Texts are
read whole. Other columns are ignored.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitlens.llm.bpe import MergeAutomaton, automaton, library_split, unassigned
from transitlens.llm.common import ready

#: Fixed value: how byte_bpe_50k.json splits text.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
                       r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
SPACE_RUNS = regex.compile(r"\p{White_Space}{2,}")
LONG_CONTRACTIONS = {"'re", "'ve", "'ll"}

#: Pieces that a Python worker keeps the counts of, and the longest such piece.
PIECES_KEPT, LONGEST_KEPT = 600_000, 64


class PieceCounts(dict):
    """Piece -> the bytes of int32 counts of its prefixes of 1, 2, ... characters, and the last of these.

    When half of ``PIECES_KEPT`` are there, they become ``older``, and those
    that were older go; a piece that is used again comes back from there.
    """

    def __init__(self, table: MergeAutomaton):
        super().__init__()
        self.older: dict[str, tuple[bytes, int]] = {}
        self.table = table
        self.specials = sorted(table.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")") if self.specials else None

    def __missing__(self, piece: str) -> tuple[bytes, int]:
        got = self.older.get(piece)
        if got is None:
            counts = self.table.prefix_counts(self.table.spell(piece))
            if piece.isascii():
                del counts[0]
            else:
                ends = accumulate([len(c.encode("utf-8", "surrogatepass")) for c in piece])
                counts = [counts[e] for e in ends]
            if piece in LONG_CONTRACTIONS:
                counts[1] = 2
            got = array("i", counts).tobytes(), counts[-1]
        if len(piece) <= LONGEST_KEPT:
            if len(self) >= PIECES_KEPT // 2:
                self.older = dict(self)
                self.clear()
            self[piece] = got
        return got

    def segment(self, text: str) -> np.ndarray:
        """Counts of the prefixes of 1, 2, ... characters of a text without special tokens."""
        if not text:
            return np.zeros(0, np.int32)
        if not text.isascii() and unassigned(text):
            pieces = [text[a:b] for a, b in library_split(self.table.path, text)[1]]
        else:
            pieces = PIECES.findall(text)
        each, last = zip(*map(self.__getitem__, pieces), strict=True)
        totals = np.fromiter(accumulate(last, initial=0), np.int32, len(last) + 1)
        counts = np.frombuffer(b"".join(each), np.int32) + np.repeat(totals[:-1], list(map(len, pieces)))
        for run in SPACE_RUNS.finditer(text):
            if run.end() < len(text):  # at the end the run is one piece already
                before = counts[run.start() - 1] if run.start() else 0
                # The last blank of a run may belong to the word after it.
                counts[run.start():run.end()] = before + np.frombuffer(self[run.group()][0], np.int32)
        return counts

    def prefixes(self, text: str | None) -> np.ndarray:
        """Entry i: exact number of tokens of the first i characters."""
        text = text or ""
        if self.cut is None or not any(s in text for s in self.specials):
            return np.concatenate([np.zeros(1, np.int32), self.segment(text)])
        out, base = [np.zeros(1, np.int32)], 0
        parts = self.cut.split(text)
        for k in range(0, len(parts), 2):
            counts = self.segment(parts[k])
            out.append(base + counts)
            if k + 1 < len(parts):
                special = parts[k + 1]
                inside = [self.segment(parts[k] + special[:n])[-1] for n in range(1, len(special))]
                base += int(counts[-1]) + 1 if len(counts) else 1
                start = base - 1 - (int(counts[-1]) if len(counts) else 0)
                out.append(np.array([start + x for x in inside] + [base], np.int32))
        return np.concatenate(out).astype(np.int32)


_COUNTS: dict[str, PieceCounts] = {}


def piece_counts(path: str) -> PieceCounts:
    if path not in _COUNTS:
        _COUNTS[path] = PieceCounts(automaton(path))
    return _COUNTS[path]


def prefix_table(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and ``prefix_tokens`` array<int>: entry i is for the first i characters."""
    ready(docs.sparkSession)
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType),
                           T.StructField("prefix_tokens", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = piece_counts(path)
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                counts = [table.prefixes(t) for t in part.column(1).to_pylist()]
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, counts)]), pa.int32()),
                                                 pa.array(np.concatenate(counts)))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], schema.names)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def budget_answers(docs: DataFrame, path: str, limit: int, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """What the prefix tables say of a budget of ``limit`` tokens, one row per row of ``docs``:

    n_bytes (UTF-8), n_tokens, over_limit, and ``fits``: the length in
    characters of the longest prefix with no more than ``limit`` tokens. The
    tables are made and read in the same task and not kept.
    """
    ready(docs.sparkSession)
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType()),
                           T.StructField("fits", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = piece_counts(path)
        for batch in batches:
            n_bytes, n_tokens, fits = [], [], []
            for text in batch.column(1).to_pylist():
                counts = table.prefixes(text)
                n_bytes.append(len((text or "").encode()))
                n_tokens.append(int(counts[-1]))
                fits.append(len(counts) - 1 if counts[-1] <= limit else int(np.flatnonzero(counts <= limit)[-1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()),
                 pa.array([n > limit for n in n_tokens], pa.bool_()), pa.array(fits, pa.int64())], schema.names)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)
