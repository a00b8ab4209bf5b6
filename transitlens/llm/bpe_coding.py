"""BPE encoding and decoding with the merge automaton.

A text is cut at special tokens, normalised and split into words as the
vocabulary file says (NFC, lower case, letters / single digits / other signs);
each word runs through the automaton of ``bpe.MergeAutomaton``. Decoding emits
the label of each arc, separated by blanks, as the file names no decoder.

Defined cases: a null text is the empty text and has no tokens; repeated rows
and ids give one row each; null ids are kept; an empty table gives an empty
result. Texts are read whole. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitlens.llm.bpe import _LOADED, MergeAutomaton, automaton, library_split, unassigned
from transitlens.llm.common import keep_only, kept_by, ready, sliced

#: Fixed value: how word_bpe_49k.json splits normalised text.
WORD_SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+")

#: Words that a Python worker keeps the tokens of. A full table is emptied.
WORDS_KEPT = 200_000


class WordCodes(dict):
    """Word -> (ids as little-endian 32-bit bytes, labels joined by blanks)."""

    def __init__(self, table: MergeAutomaton):
        super().__init__()
        self.table = table
        self.specials = sorted(table.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")") if self.specials else None

    def _coded(self, ids: list[int]) -> tuple[bytes, str]:
        return np.array(ids, "<u4").tobytes(), " ".join([self.table.labels[i] for i in ids])

    def __missing__(self, word: str) -> tuple[bytes, str]:
        if len(self) >= WORDS_KEPT:
            self.clear()
        got = self[word] = self._coded(self.table.encode_word(self.table.spell(word)))
        return got

    def words(self, text: str) -> list[str]:
        if not text.isascii():
            if unassigned(text):
                text, places = library_split(self.table.path, text)
                return [text[a:b] for a, b in places]
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # no final-sigma rule
        return WORD_SPLIT.findall(text.lower())

    def parts(self, text: str) -> list[tuple[bytes, str]]:
        if self.cut is None or not any(s in text for s in self.specials):
            return [self[w] for w in self.words(text)]
        out = []
        for k, segment in enumerate(self.cut.split(text)):
            out += [self._coded([self.table.special[segment]])] if k % 2 else [self[w] for w in self.words(segment)]
        return out

    def encode(self, text: str | None) -> tuple[bytes, str]:
        """(ids as bytes, decoded text)."""
        parts = self.parts(text or "")
        return b"".join([p[0] for p in parts]), " ".join([p[1] for p in parts])


_CODES: dict[str, WordCodes] = {}
kept_by("bpe_coding", lambda: (_CODES.clear(), _LOADED.clear()))


def codes(path: str) -> WordCodes:
    if path not in _CODES:
        _CODES[path] = WordCodes(automaton(path))
    return _CODES[path]


def _ids_array(coded: list[bytes]) -> pa.Array:
    """A list column of ids; built from one buffer."""
    ends = np.cumsum([0, *(len(x) // 4 for x in coded)])
    values = np.frombuffer(b"".join(coded), "<u4").astype(np.int32)
    return pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(values)).cast(pa.list_(pa.int32()))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
           with_ids: bool = True, with_digests: bool = True, with_decoded: bool = False) -> DataFrame:
    """One row per row of ``docs``: the id, n_tokens and, as asked for,

    * ``ids`` array<int> and ``decoded`` string, the real outputs;
    * ``ids_sha256`` of the ids as little-endian unsigned 32-bit integers and
      ``decoded_sha256`` of the decoded text in UTF-8.
    """
    ready(docs.sparkSession)
    fields = [T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_tokens", T.LongType())]
    if with_digests:
        fields += [T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    if with_decoded:
        fields.append(T.StructField("decoded", T.StringType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only("bpe_coding")
        table = codes(path)
        for batch in sliced(batches):
            both = [table.encode(t) for t in batch.column(1).to_pylist()]
            out = [batch.column(0), pa.array([len(b) // 4 for b, _ in both], pa.int64())]
            if with_digests:
                out += [pa.array([hashlib.sha256(b).hexdigest() for b, _ in both], pa.string()),
                        pa.array([hashlib.sha256(s.encode()).hexdigest() for _, s in both], pa.string())]
            if with_ids:
                out.append(_ids_array([b for b, _ in both]))
            if with_decoded:
                out.append(pa.array([s for _, s in both], pa.string()))
            yield pa.RecordBatch.from_arrays(out, [f.name for f in fields])

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, T.StructType(fields))


def decode(coded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """The id and ``decoded``: the arc labels of an id array, separated by blanks.

    Ids without a label are left out; a null array decodes to the empty text.
    """
    ready(coded.sparkSession)
    schema = T.StructType([T.StructField(id_col, coded.schema[id_col].dataType), T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels = automaton(path).labels
        for batch in sliced(batches):
            texts = [" ".join([labels[i] for i in ids or [] if i in labels]) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], schema.names)

    return coded.select(F.col(id_col), F.col(ids_col)).mapInArrow(run, schema)
