"""Encoding of a corpus with a public byte-level BPE vocabulary.

Pre-tokenisation is vectorised over whole batches: code points become classes, and most token starts follow from transitions between
neighbouring classes. Apostrophe forms need a small automaton: each code point is a function from state to state, and an associative
scan composes them by doubling; any MEMORY functions in a row are a constant, so the scan ends there. No regular expression is run.
The byte slices then go through a cache in front of the pair merging; slice offsets can be kept, so that parts of a text can be
decoded alone.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

DEFAULT_VOCABULARY = os.environ.get("GRITMILL_VOCABULARY", "/opt/tokenizers/byte_bpe_50k.tiktoken")
#: Entries of the cache of merged slices before it starts anew, and the longest slice it takes.
CACHE_ENTRIES, CACHED_BYTES = 1 << 18, 64

OTHER, LETTER, NUMBER, BLANK, END = range(5)
_APOSTROPHE, _SPACE = 0x27, 0x20
#: States after a code point: nothing of interest, an apostrophe that starts a token, one with r, v or l after it, a whole form.
_NONE, _OPEN, _R, _V, _L, _FORM = range(6)
#: Next state by state, per kind of code point; all others lead to _NONE.
_STEPS = np.zeros((7, 6), np.uint8)
_STEPS[1] = _OPEN
_STEPS[2, _OPEN] = _STEPS[5, _L] = _STEPS[6, _R] = _STEPS[6, _V] = _FORM
_STEPS[3, _OPEN], _STEPS[4, _OPEN], _STEPS[5, _OPEN] = _R, _V, _L
_KINDS = {"s": 2, "t": 2, "m": 2, "d": 2, "r": 3, "v": 4, "l": 5, "e": 6}
#: Code points that a state can depend on.
MEMORY = 4


def scan_states(kinds: np.ndarray) -> np.ndarray:
    """State after each code point: the composition of all transition functions up to it, from _NONE."""
    functions, reach = _STEPS[kinds], 1
    while reach < MEMORY:
        composed = functions.copy()
        composed[reach:] = np.take_along_axis(functions[reach:], functions[:-reach], 1)
        functions, reach = composed, 2 * reach
    return functions[:, _NONE]


@lru_cache(1)
def class_table() -> np.ndarray:
    """Class of every code point: letters L*, numbers N*, blanks (White_Space), all else."""
    import unicodedata

    table = np.zeros(0x110000, np.uint8)
    by_category = {"L": LETTER, "N": NUMBER}
    table[:] = [by_category.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)]
    for first, last in ((9, 13), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)):
        table[first : last + 1] = BLANK
    return table


@lru_cache(1)
def _letter_kinds() -> np.ndarray:
    table = np.zeros(0x80, np.uint8)
    for letter, kind in _KINDS.items():
        table[ord(letter)] = kind
    return table


def token_starts(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sorted starts of all tokens in ``points``, whose texts are closed by one position each in ``ends`` (positions of their own)."""
    n = len(points)
    cls = class_table()[points]
    cls[ends] = END
    before = np.empty(n, np.uint8)
    before[0], before[1:] = END, cls[:-1]
    after = np.empty(n, np.uint8)
    after[-1], after[:-1] = END, cls[1:]
    space = (points == _SPACE) & (cls == BLANK)
    after_space = np.zeros(n, bool)
    after_space[1:] = space[:-1]
    blank = cls == BLANK
    start = ~blank & (cls != before) & ~after_space
    # blanks: a run starts a token; so does its last blank where something else than the text's end follows
    start |= blank & (before != BLANK)
    start |= blank & (after != BLANK) & (after != END)
    start[ends] = True
    kinds = _letter_kinds()[np.minimum(points, 0x7F)]
    kinds[(points == _APOSTROPHE) & (cls == OTHER) & start & (after == LETTER)] = 1
    # states only leave _NONE within MEMORY of such an apostrophe, whose function is a constant: the stretches are scanned together
    opened = np.flatnonzero(kinds == 1)
    if len(opened):
        near = (opened[:, None] + np.arange(MEMORY)[None, :]).ravel()
        near = near[near < n]
        done = np.unique(near[scan_states(kinds[near]) == _FORM])
        # the form's letters are no start, what follows is one
        start[np.where(kinds[done] == 2, done, done - 1)] = False
        nxt = done + 1
        start[nxt[cls[nxt] == LETTER]] = True
    return np.flatnonzero(start)


class BytePairEncoder:
    """Pair merging by the ranks of a vocabulary file, behind a cache."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}
        # only the merging of a given slice is used; boundaries are found above
        self._merge = tiktoken.Encoding("gritmill", pat_str=r"[\s\S]", mergeable_ranks=self.ranks, special_tokens={})._core_bpe.encode_single_piece
        self._pieces = {v: k for k, v in self.ranks.items()}
        self._cache: dict[bytes, list[int]] = {}

    def merge(self, piece: bytes) -> list[int]:
        ids = self._cache.get(piece)
        if ids is None:
            own = self.ranks.get(piece)
            ids = [own] if own is not None else self._merge(piece)
            if len(piece) <= CACHED_BYTES:
                if len(self._cache) >= CACHE_ENTRIES:
                    self._cache.clear()
                self._cache[piece] = ids
        return ids

    def decode(self, ids) -> str:
        return b"".join(self._pieces[i] for i in ids).decode("utf-8")

    def encode_batch(self, texts: list[str | None]) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All ids; per text the end among the ids; all slices' first characters, their numbers of ids, and per text the end among them."""
        joined = "\0".join([t or "" for t in texts] + [""])
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        if not len(points):
            empty = np.zeros(0, np.int64)
            return [], empty, empty, empty, empty
        lengths = np.array([len(t) if t else 0 for t in texts], np.int64)
        ends = np.cumsum(lengths + 1) - 1
        starts = token_starts(points, ends)
        width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        place = np.concatenate([[0], np.cumsum(width)])
        data = joined.encode("utf-8")
        cuts = place[np.append(starts, len(points))].tolist()
        is_end = np.isin(starts, ends)
        ids: list[int] = []
        sizes = np.zeros(len(starts), np.int64)
        merge, extend = self.merge, ids.extend
        for i in np.flatnonzero(~is_end).tolist():
            got = merge(data[cuts[i] : cuts[i + 1]])
            extend(got)
            sizes[i] = len(got)
        done = np.cumsum(sizes)
        closing = np.flatnonzero(is_end)
        text_of = np.cumsum(is_end) - is_end
        offsets = np.concatenate([[0], ends[:-1] + 1])
        inner = ~is_end
        return ids, done[closing], (starts - offsets[text_of])[inner], sizes[inner], np.cumsum(inner)[closing]


@lru_cache(4)
def encoder(path: str) -> BytePairEncoder:
    return BytePairEncoder(path)


def _lists(ends: np.ndarray, values, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(values, kind))


def encode_corpus(df: DataFrame, identifier: str, text: str, vocabulary: str = DEFAULT_VOCABULARY, offsets: bool = False) -> DataFrame:
    """(identifier, ids) of every row, without special tokens; null and empty texts give an empty list.

    With ``offsets`` also ``slice_starts`` (first code point of each pre-token) and ``slice_sizes`` (its number of ids). Strings of
    special tokens in a text are ordinary text. Rows are neither merged nor dropped, so repeated rows and null identifiers stay; no
    shuffle. The vocabulary file must be at the same path on every executor.
    """
    fields = [df.schema[identifier], T.StructField("ids", T.ArrayType(T.IntegerType(), False))]
    if offsets:
        fields += [T.StructField("slice_starts", T.ArrayType(T.IntegerType(), False)), T.StructField("slice_sizes", T.ArrayType(T.IntegerType(), False))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary)
        for batch in batches:
            # a few hundred texts at a time bound the arrays of code points
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                ids, ends, starts, sizes, slice_ends = coder.encode_batch(part.column(1).to_pylist())
                columns = [part.column(0), _lists(ends, np.array(ids, np.int32), pa.int32())]
                if offsets:
                    columns += [_lists(slice_ends, starts.astype(np.int32), pa.int32()), _lists(slice_ends, sizes.astype(np.int32), pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    return df.select(identifier, text).mapInArrow(run, T.StructType(fields))
