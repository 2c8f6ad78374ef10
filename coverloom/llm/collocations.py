"""Phrase collocation mining: frequent phrases of each group, scored by their weakest cut.

Words are counted where the texts are read and summed; the frequent ones get ids, the texts become arrays of ids, in which
infrequent words and ends of pieces are breaks. Lengths follow one another. A phrase of k words can only be frequent if the
phrases of its first and of its last k - 1 words are, so places where both are give its key: the first one's slot and the last
word's id, in one 64-bit number. Keys that are met often enough in all tasks together are the candidates. A minimal perfect hash
over them, with the keys stored by slot so that others are told apart, turns places into slots: tasks count these with bincount,
the arrays are summed as a tree, block by block, and the texts' arrays of slots are written for the next length.

A cut of a phrase is read by slot: a candidate knows the counts of all its beginnings through the slot of its first k - 1 words
and those of all its ends through the slot of its last k - 1. A longer phrase that has a shorter one in it and is as frequent
exists only if one with a single word more does, so these two slots also tell which phrases are to be dropped.

Tables of words and keys that tasks hold are sent in slices of fixed size, one pass for each, so memory doesn't depend on how
many there are: a word that a slice doesn't have waits for the next one.

Defined cases: null texts are empty; a null group is `und`, as is a group of this name; a piece or text without words has no
phrase; equal scores and counts are ordered by the phrase; repeated rows and ids count each time, the id isn't read; extra
columns are dropped; an empty table gives no row. Scores are exact as long as 1000 times a count and n have at most 18 digits.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, StructField, StructType

from coverloom.functions.index import numbered
from coverloom.llm.kernels import U, column, mix, tidy, weights
from coverloom.llm.util import arrow_batches, bounded, discard, free_shuffles, materialize, ship

#: Bytes of text that are split at once, words that a task counts, and keys that it gathers before it gives them out.
STEP, FLUSH_WORDS, FLUSH_KEYS = 1 << 20, 300_000, 1 << 21
#: Words and keys of a slice, which tasks hold whole.
WORDS_SLICE, KEYS_SLICE = 500_000, 4_000_000
#: Slots of a block of counts, and arrays that one step of the tree sums.
BLOCK, ARITY = 1 << 16, 16
#: Bits of a level of the perfect hash for each key that it is offered.
GAMMA = 2
#: Rows of a table of candidates that may be broadcast.
BROADCAST_ROWS = 200_000
_MARK, _ENDS = b"\xff", b".,;:!?\n\x0b\x0c\r"


def _table() -> bytes:
    """A-Z lower-cased, tabs to spaces, ends of pieces to a byte that no text has."""
    out = bytearray(range(256))
    for c in range(65, 91):
        out[c] += 32
    out[9] = 32
    for c in _ENDS:
        out[c] = 255
    return bytes(out)


_FLAT, _GAP = _table(), re.compile(rb"[ \xff]")


def _words(text: bytes):
    """Lists of words of a text, some bytes at a time, with _MARK between pieces."""
    flat, at = text.translate(_FLAT), 0
    while at < len(flat):
        gap = _GAP.search(flat, at + STEP)
        end = gap.start() if gap else len(flat)
        yield flat[at:end].replace(_MARK, b" \xff ").split()
        at = end


def _texts(batch):
    data, starts, ends, _ = column(batch, "text")
    for group, s, e in zip(batch.column("grp").to_pylist(), starts.tolist(), ends.tolist()):
        yield group, data[s:e].tobytes()


def _count_words(batches):
    """(grp, word, n): partial counts, and of all words of a group with a null word."""

    def out():
        rows = [(g, w, n) for g, c in counts.items() for w, n in c.items() if w != _MARK]
        rows += [(g, None, sum(c.values()) - c[_MARK]) for g, c in counts.items()]
        counts.clear()
        for i in range(0, len(rows), 50_000):
            g, w, n = zip(*rows[i : i + 50_000])
            yield pa.RecordBatch.from_arrays([pa.array(g, pa.string()), pa.array(w, pa.binary()), pa.array(n, pa.int64())], ["grp", "word", "n"])

    counts: dict[str, Counter] = {}
    for batch in batches:
        for group, text in _texts(batch):
            for words in _words(text):
                own = counts.setdefault(group, Counter())
                own.update(words)
                if len(own) > FLUSH_WORDS:
                    yield from out()
        if sum(map(len, counts.values())) > FLUSH_WORDS:
            yield from out()
    yield from out()


class _Ids(dict):
    """Ids of a slice's words; 0 for the mark, -1 for others."""

    def __missing__(self, word):
        return -1


def _beside(marked: np.ndarray) -> np.ndarray:
    """The marked places that have a marked neighbour."""
    near = np.zeros(len(marked), bool)
    near[1:] = marked[:-1]
    near[:-1] |= marked[1:]
    return marked & near


def _behind(marked: np.ndarray, n: int) -> np.ndarray:
    """The marked places and the n behind each."""
    out = marked.copy()
    for i in range(1, n + 1):
        out[i:] |= marked[:-i]
    return out


def _runs(ids: np.ndarray) -> bytes:
    """Only runs of two ids and more, with one break behind each."""
    own = _beside(ids > 0)
    return np.where(own, ids, 0)[_behind(own, 1)].tobytes()


def _encode(words: dict[str, list], first: bool, last: bool):
    """(ids, left, grp): ids of words, 0 at breaks; words that no slice has had yet are -1, and listed in left. The first slice reads texts, the last one makes breaks of what is still unknown."""

    def run(batches):
        ids = {g: _Ids(zip(*own)) for g, own in words.items()}
        for own in ids.values():
            own[_MARK] = 0
        none = _Ids({_MARK: 0})

        def packed(parts, left, groups):
            return pa.RecordBatch.from_arrays([pa.array(parts, pa.binary()), pa.array(left, pa.binary()), pa.array(groups, pa.string())], ["ids", "left", "grp"])

        for batch in batches:
            if first:
                parts, left, size = [], [], 0
                for i, (group, text) in enumerate(_texts(batch)):
                    own = ids.get(group, none)
                    for found in _words(text):
                        at = np.fromiter(map(own.__getitem__, found), np.int32, len(found))
                        if last:
                            np.maximum(at, 0, out=at)
                        else:
                            left.extend(w for w, x in zip(found, at.tolist()) if x < 0)
                        parts.append(at)
                        size += len(at)
                    parts.append(np.zeros(1, np.int32))
                    if size > STEP or not last:
                        whole = np.concatenate(parts)
                        yield packed([_runs(whole) if last else whole.tobytes()], [b" ".join(left)], [group])
                        parts, left, size = [], [], 0
                if parts:
                    yield packed([_runs(np.concatenate(parts))], [b""], [None])
                continue
            for group, blob, text in zip(*(batch.column(c).to_pylist() for c in ("grp", "ids", "left"))):
                own, found = ids.get(group, none), text.split()
                at = np.frombuffer(blob, np.int32).copy()
                got = np.fromiter(map(own.__getitem__, found), np.int32, len(found))
                at[at < 0] = got
                if last:
                    np.maximum(at, 0, out=at)
                yield packed([_runs(at) if last else at.tobytes()], [b"" if last else b" ".join(w for w, x in zip(found, got.tolist()) if x < 0)], [group])

    return tidy(run)


class PerfectHash:
    """A minimal perfect hash over distinct keys: slots from 0, in the order of the levels' bits; the key of each slot is stored. Each level is a bit array that holds the keys that no other key of the level meets; the others go on to the next one."""

    def __init__(self, keys: np.ndarray):
        self.bits, self.base, total, rest = [], [], 0, keys.view(np.uint64)
        slots = []
        while len(rest):
            size = GAMMA * len(rest) + 64
            at = self._at(rest, len(self.bits), size)
            alone = np.bincount(at, minlength=size) == 1
            fits = alone[at]
            slots.append(rest[fits][np.argsort(at[fits])])
            self.bits.append(alone)
            self.base.append(total)
            total += int(fits.sum())
            rest = rest[~fits]
        self.keys = np.concatenate(slots).view(np.int64) if slots else np.zeros(0, np.int64)
        self.sizes = [len(b) for b in self.bits]
        self.bits = [np.packbits(np.pad(b, (0, -len(b) % 64)), bitorder="little").view(np.uint64) for b in self.bits]
        #: Slots before each 64 bits of a level.
        self.ranks = [first + np.concatenate(([0], np.cumsum(np.bitwise_count(b), dtype=np.int64)))[:-1] for first, b in zip(self.base, self.bits)]

    @staticmethod
    def _at(keys, level: int, size: int):
        return (mix(keys * weights(1, level + 11)[0] + U(level)) % U(size)).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 if it isn't among those that the hash was made of."""
        out = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        for level, (bits, ranks, size) in enumerate(zip(self.bits, self.ranks, self.sizes)):
            at = self._at(keys[todo].view(np.uint64), level, size)
            word, bit = bits[at >> 6], (at & 63).astype(np.uint64)
            there = (word >> bit) & U(1) == 1
            slot = ranks[at[there] >> 6] + np.bitwise_count(word[there] & ((U(1) << bit[there]) - U(1)))
            same = self.keys[slot] == keys[todo[there]]
            out[todo[there][same]] = slot[same]
            todo = todo[~there]
        return out


def _places(ids: np.ndarray, slots: np.ndarray, k: int):
    """Places where a phrase of k words may be frequent, and their keys. slots: those of the phrases of k - 1 words, from 1; 0 for none."""
    both = np.flatnonzero((slots[:-1] > 0) & (slots[1:] > 0))
    return both, (slots[both].astype(np.int64) << 32) | ids[both + k - 1].astype(np.int64)


def _corpus(batch):
    for ids, slots in zip(batch.column("ids").to_pylist(), batch.column("slots").to_pylist()):
        ids = np.frombuffer(ids, np.int32)
        yield ids, ids if slots is None else np.frombuffer(slots, np.uint32)


def _meet(k: int):
    """(key, n): partial counts of the keys of possible phrases."""

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for ids, slots in _corpus(batch):
                for i in range(0, len(ids), FLUSH_KEYS):
                    _, found = _places(ids[i : i + FLUSH_KEYS + k], slots[i : i + FLUSH_KEYS + 1], k)
                    held.append(found)
                    size += len(found)
                    if size >= FLUSH_KEYS:
                        yield from _grouped(held)
                        held, size = [], 0
        yield from _grouped(held)

    return tidy(run)


def _grouped(held):
    keys, n = np.unique(np.concatenate(held) if held else np.zeros(0, np.int64), return_counts=True)
    for i in range(0, len(keys), 1 << 18):
        yield pa.RecordBatch.from_arrays([pa.array(keys[i : i + (1 << 18)]), pa.array(n[i : i + (1 << 18)].astype(np.int64))], ["key", "n"])


_FOUND = StructType([StructField("ids", BinaryType()), StructField("slots", BinaryType()), StructField("now", BinaryType()), StructField("block", IntegerType()), StructField("task", IntegerType()), StructField("counts", BinaryType()), StructField("ends", BinaryType())])


def _resolve(k: int, table: PerfectHash, base: int, last: bool, keep: bool):
    """The corpus with the slots (from base + 1) of this slice's phrases of k words in `now`, and behind it the blocks of this task's counts: how often each slot occurs, and the slot of its last k - 1 words. After the last slice `now` becomes `slots`. keep: whether the corpus is asked for."""

    def run(batches):
        task = TaskContext.get().partitionId()
        counts, ends = np.zeros(len(table.keys), np.int64), np.zeros(len(table.keys), np.uint32)
        for batch in batches:
            ids_out, slots_out, now_out = [], [], []
            for (ids, slots), now in zip(_corpus(batch), batch.column("now").to_pylist()):
                now = np.zeros(len(ids), np.uint32) if now is None else np.frombuffer(now, np.uint32).copy()
                for i in range(0, len(ids), STEP):
                    at, keys = _places(ids[i : i + STEP + k], slots[i : i + STEP + 1], k)
                    slot = table.slots(keys)
                    at, slot = at[slot >= 0], slot[slot >= 0]
                    counts += np.bincount(slot, minlength=len(counts))
                    ends[slot] = slots[i + at + 1]
                    now[i + at] = slot + base + 1
                if last:  # only runs can hold longer phrases; with each, the words behind that belong to its last one
                    own = _beside(now > 0)
                    part = _behind(own, k - 1)
                    ids, now = ids[part], np.where(own, now, 0).astype(np.uint32)[part]
                if keep and len(ids):
                    ids_out.append(ids.tobytes())
                    slots_out.append(None if last or k == 2 else slots.tobytes())
                    now_out.append(now.tobytes())
            n = len(ids_out)
            if last:
                slots_out, now_out = now_out, [None] * n
            yield _rows(n, ids=ids_out, slots=slots_out, now=now_out)
        for b in range(0, len(counts), BLOCK):
            own = counts[b : b + BLOCK]
            if own.any():
                yield _rows(1, block=[b // BLOCK], task=[task], counts=[own.tobytes()], ends=[ends[b : b + BLOCK].tobytes()])

    return tidy(run)


def _rows(n: int, **have):
    kinds = {"block": pa.int32(), "task": pa.int32()}
    return pa.RecordBatch.from_arrays([pa.array(have.get(f.name, [None] * n), kinds.get(f.name, pa.binary())) for f in _FOUND], _FOUND.names)


def _sum(table: pa.Table) -> pa.Table:
    """One row of all arrays of a group of a block's rows."""
    counts = sum((np.frombuffer(x, np.int64) for x in table.column("counts").to_pylist()), 0)
    ends = np.maximum.reduce([np.frombuffer(x, np.uint32) for x in table.column("ends").to_pylist()])
    one = lambda name: pa.array(table.column(name).to_pylist()[:1], pa.int32())
    return pa.table({"block": one("block"), "task": one("lot"), "counts": pa.array([counts.tobytes()], pa.binary()), "ends": pa.array([ends.tobytes()], pa.binary())})


def _tree_sum(parts: DataFrame) -> DataFrame:
    """(block, counts, ends): the sums of all tasks' arrays (block, task, counts, ends). A group of a step has one block of ARITY tasks at most, so steps grow with the logarithm of the tasks."""
    tasks = (parts.agg(F.max("task")).first()[0] or 0) + 1
    parts = parts.select("block", "task", "counts", "ends")
    while tasks > 0:
        lots = parts.withColumn("lot", F.floor(F.col("task") / F.lit(ARITY)).cast("int"))
        parts = materialize(lots.groupBy("block", "lot").applyInArrow(_sum, "block int, task int, counts binary, ends binary"), "sums")
        tasks = -(-tasks // ARITY) if tasks > ARITY else 0
    return parts.drop("task")


def _unpacked(base: int, table: PerfectHash):
    """(slot, key, a, q) of each slot of the blocks' counts: q is the slot of the last k - 1 words."""

    def run(batches):
        for batch in batches:
            for b, counts, ends in zip(*(batch.column(c).to_pylist() for c in ("block", "counts", "ends"))):
                counts, ends = np.frombuffer(counts, np.int64), np.frombuffer(ends, np.uint32).astype(np.int64)
                at = b * BLOCK + np.arange(len(counts))
                yield pa.RecordBatch.from_arrays([pa.array(at + base + 1), pa.array(table.keys[at]), pa.array(counts), pa.array(ends)], ["slot", "key", "a", "q"])

    return tidy(run)


def _corpus_of(rows: DataFrame, words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The table that is written, and (ids, slots, now) of texts in it: the slots of single words are their ids."""
    n = words.count()
    slices, out = max(1, -(-n // WORDS_SLICE)), rows
    for i in range(slices):
        held: dict[str, list] = {}
        for r in words.where(F.col("id").between(i * WORDS_SLICE + 1, (i + 1) * WORDS_SLICE)).toLocalIterator():  # a slice: of bounded size
            own = held.setdefault(r["grp"], [[], []])
            own[0].append(bytes(r["word"]))
            own[1].append(r["id"])
        before, out = out, materialize(out.mapInArrow(_encode(held, i == 0, i == slices - 1), "ids binary, left binary, grp string"), "ids", "zstd")
        if i:
            discard(before)
    return out, out.select("ids", F.lit(None).cast("binary").alias("slots"), F.lit(None).cast("binary").alias("now"))


def _level(written: DataFrame, corpus: DataFrame, k: int, min_count: int, keep: bool) -> tuple[DataFrame, DataFrame, DataFrame] | None:
    """(slot, key, a, q) of the frequent phrases of k words, and the corpus with their slots (as written, and its columns), which takes the place of the one given; None if there is none."""
    met = corpus.mapInArrow(_meet(k), "key long, n long")
    keys = materialize(met.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count).select("key"), "keys")
    n = keys.count()
    if not n:
        discard(written, keys)
        return None
    if n >= 1 << 32:
        raise ValueError(f"{n} phrases of {k} words are more than slots of 32 bits can tell apart: raise min_count")
    slices, base, parts = -(-n // KEYS_SLICE), 0, []
    for i in range(slices):
        own = keys.where(F.pmod(F.xxhash64("key"), F.lit(slices)) == i).toArrow()  # a slice: of bounded size
        table = PerfectHash(own.column("key").to_numpy())
        found = materialize(corpus.mapInArrow(_resolve(k, table, base, i == slices - 1, keep), _FOUND), "found", "zstd")
        discard(written)
        written, corpus = found, found.where("block is null").select("ids", "slots", "now")
        sums = _tree_sum(found.where("block is not null"))
        parts.append(materialize(sums.mapInArrow(_unpacked(base, table), "slot long, key long, a long, q long"), "counted"))
        base += len(table.keys)
    discard(keys)
    for p in parts[1:]:
        parts[0] = parts[0].unionByName(p)
    return parts[0], written, corpus


def phrases(docs: DataFrame, group: str = "lang", text: str = "text", min_count: int = 100, longest: int = 5) -> tuple[list[DataFrame], DataFrame]:
    """For each length from 1 on (slot, grp, phrase, a, starts, ends, p, q), starts and ends being the counts of the first and of the last 1, 2, ... words, p and q the slots of the first and last k - 1 words; and (grp, n), all words of a group."""
    spark = docs.sparkSession
    arrow_batches(spark)
    rows = docs.select(F.coalesce(F.col(group).cast("string"), F.lit("und")).alias("grp"), F.col(text).cast("string").alias("text"))
    counted = rows.mapInArrow(tidy(_count_words), "grp string, word binary, n long").groupBy("grp", "word").agg(F.sum("n").alias("n"))
    counted = materialize(counted.where((F.col("n") >= min_count) | F.col("word").isNull()), "words")
    totals = counted.where("word is null").select("grp", "n")
    words = materialize(numbered(counted.where("word is not null"), "at", "grp", "word").withColumn("id", F.col("at") + 1), "ids")
    one = F.array("n")
    none = F.lit(None).cast("long")
    levels = [words.select(F.col("id").alias("slot"), "grp", F.col("word").cast("string").alias("phrase"), F.col("n").alias("a"), one.alias("starts"), one.alias("ends"), none.alias("p"), none.alias("q"))]
    written, corpus = _corpus_of(rows, words)
    for k in range(2, longest + 1):
        got = _level(written, corpus, k, min_count, k < longest)
        if got is None:
            break
        found, written, corpus = got
        found = found.withColumn("p", F.shiftrightunsigned("key", 32))
        first = levels[-1].select(F.col("slot").alias("p"), "grp", F.col("phrase").alias("_first"), F.col("starts").alias("_starts"))
        rest = levels[-1].select(F.col("slot").alias("q"), F.col("phrase").alias("_rest"), F.col("ends").alias("_ends"))
        both = found.join(bounded(first, BROADCAST_ROWS), "p").join(bounded(rest, BROADCAST_ROWS), "q")
        phrase = F.concat("_first", F.lit(" "), F.substring_index("_rest", " ", -1))
        both = both.select("slot", "grp", phrase.alias("phrase"), "a", F.concat("_starts", F.array("a")).alias("starts"), F.concat("_ends", F.array("a")).alias("ends"), "p", "q")
        levels.append(materialize(both, "phrases"))
        free_shuffles(spark)
    return levels, totals


def mine(docs: DataFrame, group: str = "lang", text: str = "text", min_count: int = 100, longest: int = 5, top: int = 2000) -> DataFrame:
    """The `top` phrases of each group: grp, rank, phrase, a, l, r, n, score, n_words. Left out are those in a longer one that is as frequent."""
    levels, totals = phrases(docs, group, text, min_count, longest)
    totals = bounded(totals, BROADCAST_ROWS)
    parts = []
    for k in range(2, len(levels) + 1):
        own = levels[k - 1].withColumn("n_words", F.lit(k).cast("long"))
        if k < len(levels):
            longer = levels[k]
            most = longer.select(F.explode(F.array("p", "q")).alias("slot"), "a").groupBy("slot").agg(F.max("a").alias("_most"))
            own = own.join(bounded(most, BROADCAST_ROWS), "slot", "left").where("_most is null or _most < a").drop("_most")
        parts.append(own)
    if not parts:
        parts = [levels[0].where(F.lit(False)).withColumn("n_words", F.lit(1).cast("long"))]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    exact = "cast(1000 * a as decimal(19, 0)) * cast(n as decimal(18, 0)) div (cast(starts[j - 1] as decimal(19, 0)) * cast(ends[n_words - j - 1] as decimal(18, 0)))"
    cuts = F.expr(f"array_min(transform(sequence(1, cast(n_words as int) - 1), j -> struct({exact} as score, j, starts[j - 1] as l, ends[n_words - j - 1] as r)))")
    rows = rows.join(totals, "grp").withColumn("_cut", cuts).select("grp", "phrase", "a", "_cut.l", "_cut.r", "n", "_cut.score", "n_words")
    order = W.partitionBy("grp").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return rows.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)


ship(__name__)
