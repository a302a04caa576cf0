"""Evaluation texts leaking into training text.

Windows of the items and of the documents are embedded by the CGK random walk: a reader stands on a unit, copies it to the output and
moves on or stays by a random bit of that unit and step. Edit distance becomes Hamming distance, since two readers meet again after
an edit. Tables of sampled output positions then find windows that agree; every hit is verified by an exact alignment of the item
with the document around it.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gritmill.llm.words import WordHashes, words

#: One changed unit in so many, and the least share of an item.
PER_CHANGE, LEAST_SHARE = 10, 2
#: Units of a window, shorter ones for shorter items, and the step at which documents are read; items are read at every unit. A window
#: has at most half the units of the least stretch, so every stretch has more windows than a step.
WINDOWS = {16: 4, 8: 2, 4: 1, 2: 1, 1: 1}
#: Random walks, tables per walk, and output positions per table.
WALKS, TABLES, POSITIONS = 3, 4, 10
#: Items of one pass over the documents; larger sets are taken in blocks.
ITEMS_AT_ONCE = 5_000
UNITS_AT_ONCE = 200_000
_U = np.uint64
_BLOCK_TAG = re.compile(r"</?(?:br|p|div|li|ul|ol|td|tr|th|table|h[1-6]|blockquote|pre)\b[^<>]*>", re.IGNORECASE)
_TAG = re.compile(r"</?[A-Za-z][^<>]*>")
_LINE_HYPHEN = re.compile(r"(?<=[^\W\d_])[-‐­][ \t]*\r?\n[ \t>]*(?=[^\W\d_])")
_CJK = re.compile("[㐀-䶿一-鿿]")


def plain(text: str | None) -> str:
    """Without markup and hyphens at line ends."""
    if not text:
        return ""
    if "<" in text:
        text = _TAG.sub("", _BLOCK_TAG.sub(" ", text))
    if "&" in text:
        text = html.unescape(text)
    return _LINE_HYPHEN.sub("", text)


def units(text: str | None, by_character: bool) -> list[str]:
    found = words(plain(text))
    return list("".join(found)) if by_character else found


def is_by_character(text: str | None) -> bool:
    """Whether a text counts by characters: most of its letters are Han."""
    letters = sum(c.isalpha() for c in text or "")
    return letters > 0 and 2 * len(_CJK.findall(text)) > letters


def cgk_tables(h: np.ndarray, starts: np.ndarray, window: int, seed: int) -> list[np.ndarray]:
    """For each table the hashes of the sampled positions of the windows' embeddings."""
    rng = np.random.default_rng(1000 * window + seed)
    steps = 3 * window
    odd = rng.integers(1, 2**63, steps, dtype=np.uint64) | _U(1)
    # the walk needs about two steps per unit; later positions are padding
    sampled = [set(rng.choice(2 * window, min(POSITIONS, 2 * window), replace=False).tolist()) for _ in range(TABLES)]
    last = max(max(s) for s in sampled)
    at, out = np.zeros(len(starts), np.int64), [np.full(len(starts), t + 1, np.uint64) for t in range(TABLES)]
    for j in range(last + 1):
        inside = at < window
        current = np.where(inside, h[starts + np.minimum(at, window - 1)], _U(0))
        for t, own in enumerate(sampled):
            if j in own:
                out[t] = (out[t] ^ current) * _U(0x9E3779B97F4A7C15)
                out[t] ^= out[t] >> _U(31)
        at += inside & ((current * odd[j]) >> _U(63) == 1)
    return out


@dataclass
class Index:
    """Window tables of a block of items that count alike (by word or by character) and have one window size."""

    window: int
    by_character: bool
    items: list[tuple[int, np.ndarray]] = field(default_factory=list)
    tables: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def build(self) -> None:
        h = np.concatenate([x for _, x in self.items] + [np.zeros(self.window, np.uint64)])
        sizes = np.array([len(x) for _, x in self.items])
        item = np.repeat(np.arange(len(sizes)), sizes)
        offset = np.arange(len(item)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        inside = offset + self.window <= sizes[item]
        item, offset = item[inside], offset[inside]
        starts = np.flatnonzero(inside)
        for walk in range(WALKS):
            for keys in cgk_tables(h, starts, self.window, walk):
                order = np.argsort(keys, kind="stable")
                seen = np.zeros(1 << 20, bool)
                seen[(keys & _U((1 << 20) - 1)).astype(np.int64)] = True
                self.tables.append((keys[order], item[order], offset[order], seen))

    def hits(self, h: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window number, item number, offset in the item) of all agreeing windows."""
        found = []
        for walk in range(WALKS):
            for keys, (known, item, offset, seen) in zip(cgk_tables(h, starts, self.window, walk), self.tables[walk * TABLES :]):
                at = np.flatnonzero(seen[(keys & _U((1 << 20) - 1)).astype(np.int64)])
                low, high = np.searchsorted(known, keys[at], "left"), np.searchsorted(known, keys[at], "right")
                n = high - low
                if n.sum():
                    place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
                    found.append((np.repeat(at, n), item[place], offset[place]))
        if not found:
            empty = np.zeros(0, np.int64)
            return empty, empty, empty
        return tuple(np.concatenate(x) for x in zip(*found))


def contains_stretch(item: np.ndarray, region: np.ndarray, base: int, slack: int) -> bool:
    """Whether the region contains at least half of the item in one stretch with at most one changed unit in ten.

    Item unit i lies at ``region[base + i]``, give or take ``slack``. longest[i, d]: item units of the longest alignment with e edits
    that ends before item unit i and region unit i + d. Along a diagonal it grows by equal units from the best entry, which is a
    running maximum within runs of equal units, so each number of edits takes a few array operations; most leaks need few.
    """
    n = len(item)
    least, most = -(-n // LEAST_SHARE), n // PER_CHANGE
    diagonals = base + np.arange(-slack, slack + 1)
    at = np.arange(n)[:, None] + diagonals[None, :]
    inside = (at >= 0) & (at < len(region))
    equal = np.zeros((n + 1, len(diagonals)), bool)
    equal[1:] = inside & (region[np.clip(at, 0, max(0, len(region) - 1))] == item[:, None]) if len(region) else False
    run = np.cumsum(~equal, axis=0, dtype=np.int64) * (4 * n + 4)
    i = np.arange(n + 1, dtype=np.int64)[:, None]
    shift = run - i
    enter = np.zeros((n + 1, len(diagonals)), np.int64)
    for e in range(most + 1):
        longest = np.maximum.accumulate(enter + shift, axis=0) - shift
        if longest.max() >= max(least, PER_CHANGE * e):
            return True
        if e < most:
            enter = np.zeros_like(longest)
            enter[1:] = longest[:-1] + 1
            np.maximum(enter[1:, :-1], longest[:-1, 1:] + 1, out=enter[1:, :-1])
            np.maximum(enter[:, 1:], longest[:, :-1], out=enter[:, 1:])
    return False


def may_contain(item: np.ndarray, h: np.ndarray, first: np.ndarray, low: np.ndarray, high: np.ndarray, slack: int) -> np.ndarray:
    """Cheap necessary condition for many places at once: enough item units occur near their place.

    The item's first unit should be at ``h[first]`` of a document that fills ``h[low:high]``.
    """
    n = len(item)
    least = -(-n // LEAST_SHARE)
    out = np.zeros(len(first), bool)
    step = max(1, 2_000_000 // (n + 2 * slack))
    for k in range(0, len(first), step):
        part = slice(k, k + step)
        at = first[part, None] + np.arange(-slack, n + slack)[None, :]
        values = np.where((at >= low[part, None]) & (at < high[part, None]), h[np.clip(at, 0, len(h) - 1)], _U(0))
        near = np.zeros((len(at), n), bool)
        for d in range(2 * slack + 1):
            near |= values[:, d : d + n] == item
        out[part] = near.sum(axis=1) >= least - least // PER_CHANGE
    return out


def scan(index: Index, documents: list[np.ndarray]) -> list[tuple[int, int]]:
    """(document number, item number) of the verified leaks."""
    sizes = np.array([len(d) for d in documents])
    if not len(sizes) or not sizes.sum():
        return []
    h = np.concatenate([*documents, np.zeros(index.window, np.uint64)])
    firsts = np.cumsum(sizes) - sizes
    document = np.repeat(np.arange(len(sizes)), sizes)
    position = np.arange(len(document)) - np.repeat(firsts, sizes)
    starts = np.flatnonzero((position % WINDOWS[index.window] == 0) & (position + index.window <= sizes[document]))
    window, item, offset = index.hits(h, starts)
    if not len(window):
        return []
    where = starts[window]
    lengths = np.array([len(x) for _, x in index.items])
    slack = lengths // PER_CHANGE + 2
    # neighbouring diagonals of a document and an item are verified together
    width = slack[item] // 2 + 1
    band = (position[where] - offset) // width
    low, span = band.min(), int(np.ptp(band)) + 1
    # one number per item, document and band: below 2**63, as items, documents and units of a batch are bounded
    keys = np.unique((item * len(sizes) + document[where]) * span + (band - low))
    rest, band = np.divmod(keys, span)
    hits = np.stack([*np.divmod(rest, len(sizes)), band + low], axis=1)
    out = []
    for i, group in zip(hits[np.flatnonzero(np.diff(hits[:, 0], prepend=-1)), 0].tolist(), np.split(hits, np.flatnonzero(np.diff(hits[:, 0])) + 1)):
        units_, room = index.items[i][1], int(slack[i])
        d, base = group[:, 1], group[:, 2] * (room // 2 + 1) + (room // 2 + 1) // 2
        fits = may_contain(units_, h, firsts[d] + base, firsts[d], firsts[d] + sizes[d], room + room // 2)
        done = -1
        for k, b in zip(d[fits].tolist(), base[fits].tolist()):
            if k != done and contains_stretch(units_, documents[k], b, 2 * room):
                out.append((k, i))
                done = k
    return out


def _index(items: list[tuple[int, str]]) -> list[Index]:
    hashes, made = WordHashes(), {}
    for key, text in items:
        by_character = is_by_character(text)
        h = hashes(units(text, by_character))
        half = -(-len(h) // LEAST_SHARE)
        window = next((w for w in WINDOWS if 2 * w <= half + 1), 1)
        if len(h):
            made.setdefault((window, by_character), Index(window, by_character)).items.append((key, h))
    for index in made.values():
        index.build()
    return list(made.values())


def _blocks(items: DataFrame) -> Iterator[list[tuple[object, str]]]:
    """The items in blocks of ITEMS_AT_ONCE, one block at a time on the driver."""
    block: list[tuple[object, str]] = []
    for r in items.toLocalIterator():
        block.append((r.i, r.t))
        if len(block) == ITEMS_AT_ONCE:
            yield block
            block = []
    yield block


def find_leaks(documents: DataFrame, document_id: str, text: str, items: DataFrame, item_id: str, item_text: str) -> DataFrame:
    """(document_id, item_id) of every document that contains an item: at least half of it in one stretch but for one unit in ten.

    Units are words, or characters for items in Han script. Case, punctuation, blanks, line breaks, hyphens at line ends, markup and
    character forms don't matter. Null and empty texts and items contain nothing; repeated documents are found each; a null id is kept.
    The items are a stated query set, taken in blocks of ITEMS_AT_ONCE (each about 20 kB of tables), each of which reads the documents
    once; no shuffle of documents.
    """
    found = None
    rows = items.select(F.col(item_id).alias("i"), F.col(item_text).alias("t")).where("t is not null").distinct()
    kinds = dict(documents.dtypes)[document_id], dict(items.dtypes)[item_id]
    schema = f"d {kinds[0]}, i {kinds[1]}"
    for block in _blocks(rows):
        if not block and found is not None:
            break
        indexes = _index(block)
        shared = documents.sparkSession.sparkContext.broadcast(indexes)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            hashes = WordHashes()
            for batch in batches:
                texts = batch.column(1).to_pylist()
                sizes = np.cumsum([len(t) if t else 0 for t in texts])
                low = 0
                while low < len(texts):
                    high = max(low + 1, int(np.searchsorted(sizes, (sizes[low - 1] if low else 0) + 6 * UNITS_AT_ONCE, "right")))
                    part = [plain(t) for t in texts[low:high]]
                    by_words = [words(t) for t in part]
                    pairs: list[tuple[int, object]] = []
                    for by_character in (False, True):
                        own = [x for x in shared.value if x.by_character == by_character]
                        if own:
                            chosen = [k for k, t in enumerate(part) if not by_character or _CJK.search(t)]
                            h = [hashes(list("".join(by_words[k])) if by_character else by_words[k]) for k in chosen]
                            for x in own:
                                pairs += [(low + chosen[d], x.items[i][0]) for d, i in scan(x, h)]
                    if pairs:
                        at = pa.array([p for p, _ in pairs])
                        yield pa.RecordBatch.from_arrays([batch.column(0).take(at), pa.array([i for _, i in pairs], batch_type)], ["d", "i"])
                    low = high

        batch_type = pa.int64() if kinds[1] in ("bigint", "long") else pa.int32() if kinds[1] == "int" else pa.string()
        part = documents.select(F.col(document_id).alias("d"), F.col(text).alias("t")).where("t is not null").mapInArrow(run, schema)
        found = part if found is None else found.unionByName(part)
    return found.withColumnsRenamed({"d": document_id, "i": item_id}).distinct()
