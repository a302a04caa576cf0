"""Same or near-same records across splits.

Texts that are equal as word sequences form one class. Near-same means at most one word in eight changed. The evaluation passages are
sharded by hash; an Aho-Corasick automaton over the runs of a shard's passages scans training texts, and the matched intervals are
merged into coverage per passage. A passage of n words is cut into n // 7 + 1 runs and k changes break at most k of them, so a near-same
text keeps the others: that many intact runs, the lengths and an exact word edit distance decide.

Scanning every training text with every shard would cost shards times corpus. So texts are routed: of k + 1 disjoint runs of a passage
(four words, chosen where the training words are rarest) one is intact, every position of every training text is probed against them,
and a hit must lie within k words of its place, the lengths within k, and the word signatures within 2k bits. All of it follows from k
changes, so routing loses no pair; the automaton of a shard then sees the texts that some passage of the shard may match.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gritmill.llm.store import saved
from gritmill.llm.words import WordHashes, edits_within, gram_hashes, words

#: One changed word in so many.
PER_CHANGE = 8
#: Words of a run, and buckets of the counts that tell rare runs from frequent ones.
RUN, COUNT_BUCKETS = 4, 1 << 19
#: Words of a block in which runs are chosen together.
BLOCK = 448
#: Bits of the filter over the runs: 12 per run, within these.
FILTER_BITS = (1 << 20, 1 << 27)
TEXTS_AT_ONCE = 1024
#: Passages of a shard, so that its automaton has a bounded size, and training texts of one salt of it.
SHARD_PASSAGES, SALT_TEXTS = 4096, 100_000
_U = np.uint64


def most_changes(n: int, m: int) -> int:
    return max(n, m) // PER_CHANGE


def run_length(n: int) -> int:
    """Words of each run of an evaluation text of n words: n // 7 bounds its changes, as a partner has at most 8n/7 words."""
    count = n // (PER_CHANGE - 1) + 1
    return min(RUN, max(1, n // count))


def choose_runs(cost: np.ndarray, n: int, length: int) -> list[int]:
    """First words of n // 7 + 1 disjoint runs of least total cost; long texts block by block."""
    if n > BLOCK:
        out = []
        for first in range(0, n, BLOCK):
            size = min(BLOCK, n - first)
            # a short rest keeps fewer runs than words allow
            if size >= length * (size // (PER_CHANGE - 1) + 1):
                out += [first + p for p in choose_runs(cost[first : first + size - length + 1], size, length)]
            elif size >= length:
                out.append(first)
        return out if len(out) >= n // (PER_CHANGE - 1) + 1 else list(range(0, n - length + 1, length))
    count, m = n // (PER_CHANGE - 1) + 1, n - length + 1
    rows, best = [], None
    for j in range(count):
        if j:
            shifted = np.full(m, np.inf)
            if m > length:
                shifted[length:] = best[: m - length]
            total = cost + shifted
        else:
            total = cost.astype(np.float64)
        rows.append(total)
        best = np.minimum.accumulate(total)
    out, last = [], m - 1
    for total in reversed(rows):
        p = int(np.argmin(total[: last + 1]))
        out.append(p)
        last = p - length
    return out[::-1]


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(_U).view(np.int64)


def _record_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[list[str]]]]:
    for batch in batches:
        for first in range(0, batch.num_rows, TEXTS_AT_ONCE):
            part = batch.slice(first, TEXTS_AT_ONCE)
            yield part, [t.split(" ") for t in part.column("tokens").to_pylist()]


def _flat(texts: list[list[str]], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words, words per text, and the first of each text."""
    sizes = np.array([len(t) for t in texts], np.int64)
    return hashes([w for t in texts for w in t]), sizes, np.concatenate([[0], np.cumsum(sizes)[:-1]])


def _signatures(h: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits per text of which every word sets one."""
    bit, high = _U(1) << ((h >> _U(8)) & _U(63)), ((h >> _U(20)) & _U(1)).astype(bool)
    low_bits, high_bits = np.where(high, _U(0), bit), np.where(high, bit, _U(0))
    return np.bitwise_or.reduceat(low_bits, firsts), np.bitwise_or.reduceat(high_bits, firsts)


def _all_runs(h: np.ndarray, sizes: np.ndarray, length: int, most: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text and position of all runs of one length; ``most`` restricts to texts of at most so many words."""
    g = gram_hashes(h, length)
    text = np.repeat(np.arange(len(sizes)), sizes)[: len(g)]
    position = (np.arange(len(h)) - np.repeat(np.cumsum(sizes) - sizes, sizes))[: len(g)]
    keep = position + length <= sizes[text]
    if most is not None:
        keep &= sizes[text] <= most
    return g[keep], text[keep], position[keep]


def normalise(df: DataFrame, identifier: str, text: str, side: Column, extra: str) -> DataFrame:
    """(record, side, extra, tokens, n, cid, cid2) of each row with an identifier, a side and at least one word; no shuffle."""
    narrow = df.select(F.col(identifier).alias("record"), side.alias("side"), F.col(extra).cast("string").alias("extra"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = [" ".join(words(t)) for t in batch.column("text").to_pylist()]
            digests = [xxhash.xxh3_128_digest(t.encode()) for t in tokens]
            ids = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2) if digests else np.zeros((0, 2), np.int64)
            columns = [*batch.columns[:3], pa.array(tokens, pa.string()), pa.array([t.count(" ") + 1 if t else 0 for t in tokens], pa.int32())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(ids[:, 0]), pa.array(ids[:, 1])], ["record", "side", "extra", "tokens", "n", "cid", "cid2"])

    kind = dict(narrow.dtypes)["record"]
    done = narrow.where("record is not null and side is not null and text is not null").mapInArrow(run, f"record {kind}, side string, extra string, tokens string, n int, cid long, cid2 long")
    return done.where("n > 0")


def run_counts(train: DataFrame) -> np.ndarray:
    """How often training runs fall into each of COUNT_BUCKETS buckets: of fixed size, whatever the data. Only steers the choice of runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts = WordHashes(), np.zeros(COUNT_BUCKETS, np.int64)
        for _, texts in _record_batches(batches):
            h, sizes, _ = _flat(texts, hashes)
            g, _, _ = _all_runs(h, sizes, RUN)
            counts += np.bincount((g & _U(COUNT_BUCKETS - 1)).astype(np.int64), minlength=COUNT_BUCKETS)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(counts[at])], ["bucket", "n"])

    rows = train.select("tokens").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(COUNT_BUCKETS, np.float32)
    counts[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return counts


_RUN_SCHEMA = "g long, cid long, pos int, n int, s1 long, s2 long"


def _emit(g, text, position, part, sizes, s1, s2) -> pa.RecordBatch:
    cid = part.column("cid").to_numpy()
    arrays = [_signed(g), cid[text], position.astype(np.int32), sizes[text].astype(np.int32), _signed(s1[text]), _signed(s2[text])]
    return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["g", "cid", "pos", "n", "s1", "s2"])


def evaluation_runs(evaluation: DataFrame, counts: np.ndarray) -> DataFrame:
    shared = evaluation.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = WordHashes(), shared.value
        for part, texts in _record_batches(batches):
            h, sizes, firsts = _flat(texts, hashes)
            s1, s2 = _signatures(h, firsts)
            g_all = {length: gram_hashes(h, length) for length in range(1, RUN + 1)}
            g, text, position = [], [], []
            for i, (n, first) in enumerate(zip(sizes.tolist(), firsts.tolist())):
                length = run_length(n)
                own = g_all[length][first : first + n - length + 1]
                at = choose_runs(1.0 + seen[(own & _U(COUNT_BUCKETS - 1)).astype(np.int64)], n, length)
                g.append(own[at])
                text += [i] * len(at)
                position += at
            yield _emit(np.concatenate(g), np.array(text), np.array(position), part, sizes, s1, s2)

    return evaluation.select("cid", "tokens").mapInArrow(run, _RUN_SCHEMA)


def _places(g: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    return g & _U(bits - 1), (g >> _U(32)) & _U(bits - 1)


def run_filter(runs: DataFrame) -> np.ndarray:
    """Bits of a two-hash Bloom filter over the runs, at most 16 MB: an or of words per executor, then of the partial results."""
    bits = FILTER_BITS[0]
    wanted = 12 * runs.count()
    while bits < wanted and bits < FILTER_BITS[1]:
        bits *= 2
    place = F.explode(F.array(F.col("g").bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned("g", 32).bitwiseAND(F.lit(bits - 1)))).alias("p")
    words_ = runs.select(place).select(F.shiftright("p", 6).cast("int").alias("w"), F.expr("shiftleft(1L, cast(p & 63 as int))").alias("b"))
    rows = words_.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[rows.column("w").to_numpy()] = rows.column("b").to_numpy()
    return out.view(np.uint64)


def training_runs(train: DataFrame, bits: np.ndarray) -> DataFrame:
    """All runs of all training classes that the filter lets through."""
    shared = train.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, table = WordHashes(), shared.value
        is_set = lambda at: (table[(at >> _U(6)).astype(np.int64)] >> (at & _U(63))) & _U(1) != 0
        for part, texts in _record_batches(batches):
            h, sizes, firsts = _flat(texts, hashes)
            s1, s2 = _signatures(h, firsts)
            for length in range(1, RUN + 1):
                # shorter runs belong to evaluation texts of less than eight words, whose partners have at most nine
                g, text, position = _all_runs(h, sizes, length, None if length == RUN else PER_CHANGE + 1)
                low, high = _places(g, len(table) * 64)
                hit = np.flatnonzero(is_set(low))
                hit = hit[is_set(high[hit])]
                yield _emit(g[hit], text[hit], position[hit], part, sizes, s1, s2)

    return train.select("cid", "tokens").mapInArrow(run, _RUN_SCHEMA)


def candidates(evaluation_: DataFrame, training: DataFrame) -> DataFrame:
    """Distinct (e_cid, t_cid) whose hit, lengths and signatures allow a near-same pair."""
    e = evaluation_.select("g", *[F.col(c).alias(f"e_{c}") for c in ("cid", "pos", "n", "s1", "s2")])
    t = training.select("g", *[F.col(c).alias(f"t_{c}") for c in ("cid", "pos", "n", "s1", "s2")])
    k = F.floor(F.greatest("e_n", "t_n") / PER_CHANGE)
    apart = F.bit_count(F.col("e_s1").bitwiseXOR(F.col("t_s1"))) + F.bit_count(F.col("e_s2").bitwiseXOR(F.col("t_s2")))
    near = (F.abs(F.col("e_pos") - F.col("t_pos")) <= k) & (F.abs(F.col("e_n") - F.col("t_n")) <= k) & (apart <= 2 * k)
    return e.join(t, "g").where(near).select("e_cid", "t_cid").distinct()


def merge(intervals: list[tuple[int, int]]) -> int:
    """Length of the union of intervals [from, to)."""
    total, end = 0, -1
    for a, b in sorted(intervals):
        total += max(0, b - max(a, end))
        end = max(end, b)
    return total


class Shard:
    """The automaton over the runs of evaluation passages; finds the passages that a training text is near to."""

    def __init__(self) -> None:
        self.passages: list[tuple[tuple[int, int], list[str], list[int]]] = []
        self._automaton: ahocorasick.Automaton | None = None

    def add(self, key: tuple[int, int], text: str) -> None:
        tokens = text.split(" ")
        count = len(tokens) // (PER_CHANGE - 1) + 1
        self.passages.append((key, tokens, [j * len(tokens) // count for j in range(count + 1)]))
        self._automaton = None

    def _build(self) -> ahocorasick.Automaton:
        runs: dict[str, list[tuple[int, int]]] = {}
        for e, (_, tokens, cuts) in enumerate(self.passages):
            for j, (a, b) in enumerate(zip(cuts, cuts[1:])):
                if a < b:
                    runs.setdefault(f" {' '.join(tokens[a:b])} ", []).append((e, j))
        automaton = ahocorasick.Automaton()
        for run, places in runs.items():
            automaton.add_word(run, places)
        automaton.make_automaton()
        self._automaton = automaton
        return automaton

    def find(self, text: str) -> list[tuple[tuple[int, int], float]]:
        """(key, covered share) of each near-same passage."""
        if not self.passages:
            return []
        intact: dict[int, int] = {}
        for _, places in (self._automaton or self._build()).iter(f" {text} "):
            for e, j in places:
                intact[e] = intact.get(e, 0) | (1 << j)
        out, tokens, m = [], None, text.count(" ") + 1
        for e, runs in intact.items():
            key, passage, cuts = self.passages[e]
            n, k = len(passage), most_changes(len(passage), m)
            if abs(n - m) <= k and runs.bit_count() >= len(cuts) - 1 - k:
                tokens = text.split(" ") if tokens is None else tokens
                if edits_within(passage, tokens, k):
                    out.append((key, merge([(a, b) for j, (a, b) in enumerate(zip(cuts, cuts[1:])) if runs >> j & 1]) / n))
        return out


def scanned(routes: DataFrame, evaluation: DataFrame, train: DataFrame, shards: int, salts: int = 1) -> DataFrame:
    """(e_cid, e_cid2, t_cid, t_cid2, coverage) of near-same classes: the automata of all shards over the texts routed to them.

    ``routes`` has (shard, t_cid). Training texts of a shard are spread over ``salts`` tasks, each with an automaton of its own, and
    stream through it; passages come first in their task.
    """
    columns = ["shard", "salt", "side", "cid", "cid2", "tokens"]
    passages = evaluation.select(F.pmod("cid", F.lit(shards)).cast("int").alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.lit(0).alias("side"), "cid", "cid2", "tokens")
    texts = routes.join(train.select(F.col("cid").alias("t_cid"), "cid", "cid2", "tokens"), "t_cid").select("shard", F.pmod(F.xxhash64("cid", "cid2"), F.lit(salts)).cast("int").alias("salt"), F.lit(1).alias("side"), "cid", "cid2", "tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, own = None, Shard()
        for batch in batches:
            found: list[tuple[int, int, int, int, float]] = []
            for shard, salt, side, cid, cid2, tokens in zip(*(batch.column(c).to_pylist() for c in columns)):
                if (shard, salt) != place:
                    place, own = (shard, salt), Shard()
                if side == 0:
                    own.add((cid, cid2), tokens)
                else:
                    found += [(*key, cid, cid2, share) for key, share in own.find(tokens)]
            kinds = [pa.int64()] * 4 + [pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], kind) for i, kind in enumerate(kinds)], ["e_cid", "e_cid2", "t_cid", "t_cid2", "coverage"])

    rows = passages.unionByName(texts).repartition("shard", "salt").sortWithinPartitions("shard", "salt", "side")
    return rows.select(*columns).mapInArrow(run, "e_cid long, e_cid2 long, t_cid long, t_cid2 long, coverage double")


def overlaps(df: DataFrame, identifier: str, text: str, split: Column, extra: str) -> tuple[DataFrame, DataFrame]:
    """Near-same classes across splits, and the members (record, side, extra, cid, cid2).

    ``split`` gives ``train`` or another name for evaluation; null is left out, as are null texts and texts without words. Equal
    repetitions of a record count once; one that is delivered with several texts is a member of each of their classes. Copies of a
    text are one class, so their pairs are not compared one by one.
    """
    rows = saved(normalise(df, identifier, text, split, extra))
    is_train = F.col("side") == "train"
    classes = saved(rows.groupBy("cid", "cid2").agg(F.min("tokens").alias("tokens"), F.bool_or(is_train).alias("t"), F.bool_or(~is_train).alias("e")))
    train, evaluation = classes.where("t"), classes.where("e")
    runs = saved(evaluation_runs(evaluation, run_counts(train)))
    pairs = candidates(runs, training_runs(train, run_filter(runs)))
    shards = max(1, -(-evaluation.count() // SHARD_PASSAGES))
    routes = saved(pairs.select(F.pmod("e_cid", F.lit(shards)).cast("int").alias("shard"), "t_cid").distinct())
    salts = max(1, -(-routes.count() // (shards * SALT_TEXTS)))
    members = rows.groupBy("record", "side", "cid", "cid2").agg(F.min("extra").alias("extra"))
    return saved(scanned(routes, evaluation, train, shards, salts)), members


def evaluation_counts(found: DataFrame, members: DataFrame) -> DataFrame:
    """(record, side, extra, pairs, coverage) of each evaluation record with a near-same training record, from the classes alone."""
    copies = members.where("side = 'train'").groupBy(F.col("cid").alias("t_cid"), F.col("cid2").alias("t_cid2")).agg(F.count("*").alias("n"))
    per_class = found.join(copies, ["t_cid", "t_cid2"]).groupBy(F.col("e_cid").alias("cid"), F.col("e_cid2").alias("cid2")).agg(F.sum("n").alias("pairs"), F.max("coverage").alias("coverage"))
    own = members.where("side <> 'train'").join(per_class, ["cid", "cid2"])
    return own.groupBy("record", "side").agg(F.min("extra").alias("extra"), F.sum("pairs").alias("pairs"), F.max("coverage").alias("coverage"))


def class_members(found: DataFrame, members: DataFrame) -> DataFrame:
    """(record, side, class_id, links): every record with the class of its text and the number of near-same classes across splits."""
    links = found.select(F.explode(F.array(F.struct(F.col("e_cid").alias("cid"), F.col("e_cid2").alias("cid2"), F.lit("e").alias("k")), F.struct(F.col("t_cid").alias("cid"), F.col("t_cid2").alias("cid2"), F.lit("t").alias("k")))).alias("x"))
    links = links.groupBy("x.cid", "x.cid2", F.when(F.col("x.k") == "t", "train").alias("own")).agg(F.count("*").alias("links"))
    rows = members.withColumn("own", F.when(F.col("side") == "train", "train")).alias("m")
    joined = rows.join(links.alias("l"), F.col("m.cid").eqNullSafe(F.col("l.cid")) & (F.col("m.cid2") == F.col("l.cid2")) & F.col("m.own").eqNullSafe(F.col("l.own")), "left")
    return joined.select("record", "side", F.concat_ws(":", F.hex("m.cid"), F.hex("m.cid2")).alias("class_id"), F.coalesce("links", F.lit(0)).alias("links"))


def record_pairs(found: DataFrame, members: DataFrame) -> DataFrame:
    """(e_record, e_side, e_extra, t_record, coverage): the pairs of records, copies among them."""
    e = members.where("side <> 'train'").select(F.col("cid").alias("e_cid"), F.col("cid2").alias("e_cid2"), F.col("record").alias("e_record"), F.col("side").alias("e_side"), F.col("extra").alias("e_extra"))
    t = members.where("side = 'train'").select(F.col("cid").alias("t_cid"), F.col("cid2").alias("t_cid2"), F.col("record").alias("t_record"))
    return found.join(e, ["e_cid", "e_cid2"]).join(t, ["t_cid", "t_cid2"]).select("e_record", "e_side", "e_extra", "t_record", "coverage")
