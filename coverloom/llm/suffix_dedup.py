"""Suffix-array dedup by bucket-pointer refinement: bytes covered by a long string that starts earlier somewhere are removed.

A suffix that starts with a repeated string of `length` bytes is found by its bucket: all suffixes are put into buckets by
their first q-gram, and a bucket is refined by sorting its suffixes on the bucket identifiers of the suffixes at later
offsets. The new identifiers are written back and the next refinement reads them, so that the prefix that a bucket's
suffixes share doubles, up to `length` bytes; a suffix alone in its bucket is finished and leaves.

Suffixes are kept together by anchors: of each window of `length` bytes the place of its least q-gram. Equal windows choose
alike, so suffixes that share `length` bytes see the same anchor from the same distance, and all suffixes of an anchor's
bucket can be refined in one task. The steps are

1. buckets of anchors by q-gram are counted over all texts; q-grams that occur once are finished;
2. the anchors left bring the bytes of their windows to their bucket, which one task has together with others; of anchors
   with the same bytes the first one stays, as all windows of the others are covered;
3. an anchor's windows are cut into NODES ranges of distances. A bucket is refined by the identifiers (q-grams) of the
   suffixes at the later and earlier offsets that all windows of a range cover; ranges that are alone are finished;
4. the suffixes that start the windows left, and those that lie where a window's last half starts, are refined by the
   bucket identifiers at offset + q; then the former by these new identifiers at length - 2 q, which makes `length` bytes.
   Of each bucket all but the first suffix are covered.

Buckets of more than HOT anchors are never brought to one task: steps 2 and 4 run for them as aggregations over 128-bit
identifiers with a partial step before each shuffle. No step pairs the members of a bucket.

Defined cases: a null or empty text has no bytes and nothing is removed; texts under `length` bytes can't match; of equal
texts the one with the least doc id stays whole and the others lose all; rows with a null doc id come before all ids; rows
that share a doc id count as one document: equal strings at equal places of them don't remove each other, and what goes from
one goes from all; extra columns are dropped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coverloom.llm import bloom
from coverloom.llm.kernels import U, column, maybe_in, mix, tidy, weights
from coverloom.llm.util import arrow_batches, materialize, ship

QGRAM, LENGTH = 32, 100
#: Members of a bucket that one task refines; larger buckets are refined by aggregations.
HOT = 20_000
#: Ranges of an anchor's windows, by the anchor's distance from the window's start, as parts of the largest distance.
NODES = 4
#: Rows that the refinement holds at once, beyond the last bucket of them.
BLOCK = 8_000
#: Bytes that one step of the kernel works on.
SEGMENT = 1 << 18
_ODD = 0x9E3779B97F4A7C15


def _slide(x, n: int, f):
    """f over each run of n values: out[i] = f(x[i], ..., x[i + n - 1])."""
    done, out = 1, x
    while 2 * done <= n:
        out = f(out[: len(out) - done], out[done:])
        done *= 2
    rest = n - done
    return f(out[: len(out) - rest], out[rest:]) if rest else out


def powers(n: int, base: int):
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Hasher:
    """Polynomial hashes of all substrings of a segment, from prefix sums; the bytes go through a table of random values."""

    def __init__(self, size: int, seed: int):
        base = int(weights(seed + 1, 5)[seed])
        self.up, self.down = powers(size + 1, base), powers(size + 1, pow(base, -1, 1 << 64))
        self.table = weights(256, 17 + seed)

    def load(self, d):
        self.sums = np.zeros(len(d) + 1, np.uint64)
        np.cumsum(self.table[d] * self.up[: len(d)], out=self.sums[1:])

    def all(self, n: int):
        """Of every run of n bytes."""
        k = len(self.sums) - n
        return (self.sums[n:] - self.sums[:k]) * self.down[:k]

    def of(self, a, b):
        """Of the runs [a, b)."""
        return mix((self.sums[b] - self.sums[a]) * self.down[a] + (b - a).astype(np.uint64) * U(_ODD))


def anchors(batch, q: int, length: int):
    """For each segment: (row, place in the row, q-gram, low, high, place in data) of its anchors. The anchor stands low to high bytes behind the start of the windows that chose it."""
    data, starts, ends, _ = column(batch, "text")
    if not len(starts) or ends[-1] == starts[0]:
        return
    lo, hi, margin, w = int(starts[0]), int(ends[-1]), 2 * length, length - q + 1
    full = np.flatnonzero(ends - starts >= length)
    if not len(full):
        return
    hasher = Hasher(min(SEGMENT, hi - lo) + 2 * margin, 0)
    for a in range(lo, hi, SEGMENT):
        z = min(a + SEGMENT, hi)
        p, r = max(lo, a - margin), min(hi, z + margin)
        d = data[p:r]
        if len(d) < length:
            continue
        hasher.load(d)
        gram = mix(hasher.all(q))
        chosen = (gram & U(0xFFFFFFFF00000000)) | np.arange(len(gram), dtype=np.uint64)
        chosen = (_slide(chosen, w, np.minimum) & U(0xFFFFFFFF)).astype(np.int64)  # for each start of a window
        inside = np.zeros(len(chosen) + 1, np.int32)  # windows that cross rows don't count
        rows = full[(ends[full] > p) & (starts[full] < r)]
        s, e = np.clip(starts[rows] - p, 0, len(chosen)), np.clip(ends[rows] - length + 1 - p, 0, len(chosen))
        keep = e > s
        np.add.at(inside, s[keep], 1)
        np.add.at(inside, e[keep], -1)
        start = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
        if not len(start):
            continue
        at = chosen[start]
        new = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        first, last = start[new], start[np.append(new[1:], len(start)) - 1]
        at = at[new]
        own = (at >= a - p) & (at < z - p)
        at, first, last = at[own], first[own], last[own]
        row = full[np.searchsorted(starts[full], at + p, "right") - 1]
        yield row, at + p - starts[row], gram[at], at - last, at - first, at + p


def _grams(q: int, length: int):
    """(k, n): q-grams of anchors and how often this batch has them."""

    def run(batches):
        for b in batches:
            found = [x[2] for x in anchors(b, q, length)]
            if found:
                k, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(n.astype(np.int64))], ["k", "n"])

    return tidy(run)


NAMES = ["doc", "pos", "k", "low", "high", "bytes"]


def _strings(q: int, length: int, wanted, hot, of_hot: bool):
    """Anchors whose q-gram is wanted, and hot or not, with the bytes of their windows. For hot ones these are filled up on either side to those of all windows with the q-gram, by 0xFF, which no text has."""

    def run(batches):
        for b in batches:
            data, _, _, _ = column(b, "text")
            for row, place, gram, low, high, at in anchors(b, q, length):
                m = maybe_in(wanted.value, gram) & (maybe_in(hot.value, gram) == of_hot)
                if not m.any():
                    continue
                row, place, gram, low, high, at = (x[m] for x in (row, place, gram, low, high, at))
                if of_hot:
                    strings = pa.array([b"\xff" * (length - q - h) + data[i - h : i - l + length].tobytes() + b"\xff" * l for i, h, l in zip(at, high, low)], pa.binary())
                else:
                    n = high - low + length
                    ends = np.cumsum(n)
                    flat = data[np.arange(int(ends[-1])) + np.repeat(at - high - (ends - n), n)]
                    strings = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(np.concatenate(([0], ends)).astype(np.int32)), pa.py_buffer(flat)])
                yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(row)), pa.array(place), pa.array(gram.view(np.int64)), pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32)), strings], NAMES)

    return tidy(run)


def _ranks(*parts):
    """A number for each row, alike for rows with the same parts; sorting makes it."""
    h = mix(np.asarray(parts[0]).astype(np.uint64))
    for x in parts[1:]:
        h = mix(h * U(_ODD) + np.asarray(x).astype(np.uint64))
    return np.unique(h, return_inverse=True, return_counts=True)[1:]


def refine(k, doc, pos, low, high, flat, ends, q: int, length: int):
    """(row, s, e) of the covered ranges of whole buckets. Rows are sorted by k, doc and pos; flat and ends: the bytes of their windows."""
    side, n = length - q, len(k)
    width = side + length
    size = high - low + length
    m = np.full((n, width), 255, np.uint8)
    to = np.repeat(np.arange(n) * width + side - high - (ends - size), size) + np.arange(len(flat))
    m.reshape(-1)[to] = flat
    base = int(weights(3, 5)[2])
    up, down = powers(width + 1, base), powers(width + 1, pow(base, -1, 1 << 64))
    sums = np.zeros((n, width + 1), np.uint64)
    np.cumsum(weights(256, 29)[m] * up[:width], axis=1, out=sums[:, 1:])
    gram = lambda r, j: mix((sums[r, j + q] - sums[r, j]) * down[j])  # noqa: E731  the q-gram bucket of the suffix at j
    place = np.cumsum(np.concatenate(([0], ((doc[1:] != doc[:-1]) | (pos[1:] != pos[:-1]) | (k[1:] != k[:-1])).astype(np.int64))))
    out = []

    # anchors with the same bytes as an earlier one
    bucket = _ranks(k.view(np.uint64))[0]
    _, first, same = np.unique(mix(sums[:, width] ^ mix(bucket.astype(np.uint64) + U(77))), return_index=True, return_inverse=True)
    gone = place[first[same]] != place
    out.append((np.flatnonzero(gone), (pos - high)[gone], (pos - low + length)[gone]))
    row = np.flatnonzero(~gone)

    # ranges of windows: refined by what all their windows cover
    rows, ranges = [], []
    for i in range(NODES):
        lo, hi = side * i // NODES + (i > 0), side * (i + 1) // NODES
        r = row[(low[row] <= hi) & (lo <= high[row])]
        b, left, right = bucket[r], side - lo, side - hi + length - q
        later = [min(side + q * x, right) for x in range(1, 1 + -(-(right - side) // q))]
        earlier = [max(side - q * x, left) for x in range(1, 1 + -(-lo // q))]
        for j in [*later, *earlier]:
            b, times = _ranks(b, gram(r, j))
            keep = times[b] > 1
            r, b = r[keep], b[keep]
        if not (later or earlier):
            b, times = _ranks(b)
            r = r[times[b] > 1]
        rows.append(r)
        ranges.append(np.stack((np.maximum(low[r], lo), np.minimum(high[r], hi))))
    row, (near, far) = np.concatenate(rows), np.concatenate(ranges, axis=1)
    if not len(row):
        return tuple(np.concatenate(x) for x in zip(*out))

    # suffixes of the windows left, by row and place
    starts = np.zeros((n, side + 2), np.int8)
    np.add.at(starts, (row, side - far), 1)
    np.add.at(starts, (row, side - near + 1), -1)
    starts = np.cumsum(starts, axis=1, dtype=np.int8)[:, :-1] > 0
    step = length - 2 * q
    asked = np.zeros((n, side + 1 + step), bool)
    asked[:, : side + 1] = starts
    asked[:, step:] |= starts
    number = np.zeros(asked.shape, np.int64)
    r, j = np.nonzero(asked)
    number[r, j] = _ranks(gram(r, j), gram(r, j + q))[0]  # 2 q bytes
    r, j = np.nonzero(starts)
    h = mix(mix(number[r, j].astype(np.uint64) + U(_ODD)) * U(_ODD) + number[r, j + step].astype(np.uint64))  # length bytes
    _, first, same = np.unique(mix(h ^ mix(bucket[r].astype(np.uint64) + U(77))), return_index=True, return_inverse=True)
    covered = place[r[first[same]]] != place[r]
    r, j = r[covered], j[covered]
    if len(r):
        new = np.concatenate(([True], (r[1:] != r[:-1]) | (j[1:] != j[:-1] + 1)))
        last = np.append(np.flatnonzero(new)[1:], len(r)) - 1
        out.append((r[new], pos[r[new]] + j[new] - side, pos[r[new]] + j[last] - side + length))
    return tuple(np.concatenate(x) for x in zip(*out))


def _refine_buckets(q: int, length: int):
    """(doc, s, e) from rows sorted by k, doc and pos, a block of whole buckets at a time."""

    def solve(batch):
        col = lambda c: batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
        data, starts, ends, _ = column(batch, "bytes")
        docs = batch.column("doc")
        known = docs.fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)
        flat = data[starts[0] : ends[-1]]
        row, s, e = refine(col("k"), known, col("pos"), col("low"), col("high"), flat, ends - starts[0], q, length)
        return pa.RecordBatch.from_arrays([docs.take(pa.array(row)), pa.array(s), pa.array(e)], ["doc", "s", "e"])

    def run(batches):
        held = []
        for b in batches:
            held.append(b)
            if sum(x.num_rows for x in held) < BLOCK:
                continue
            t = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            k = t.column("k").to_numpy(zero_copy_only=False)
            last = int(np.searchsorted(k, k[-1]))  # the last bucket may go on in the next batch
            if last:
                yield solve(t.slice(0, last))
            held = [t.slice(last)]
        if held and sum(x.num_rows for x in held):
            yield solve(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    return tidy(run)


def _cut(whole: bool):
    """(doc_id, n_bytes, n_removed, n_spans, kept) from text and spans; spans are (start, end) in any order. whole: of a character that is covered in part, no byte goes."""

    def run(batches):
        for b in batches:
            data, starts, ends, _ = column(b, "text")
            spans = b.column("spans")
            at = np.asarray(spans.offsets) if len(spans) else np.zeros(1, np.int64)
            flat = spans.values
            s, e = np.asarray(flat.field("s")).astype(np.int64), np.asarray(flat.field("e")).astype(np.int64)
            none = np.asarray(spans.is_null())
            out, kept = np.zeros((b.num_rows, 3), np.int64), []
            for i in range(b.num_rows):
                text = data[starts[i] : ends[i]]
                out[i, 0] = len(text)
                if none[i] or at[i] == at[i + 1]:
                    kept.append(text.tobytes())
                    continue
                x, y = s[at[i] : at[i + 1]], e[at[i] : at[i + 1]]
                order = np.argsort(x, kind="stable")
                x, y = x[order], np.maximum.accumulate(y[order])
                new = np.concatenate(([True], x[1:] > y[:-1]))  # spans that touch are one run
                x, y = x[new], y[np.concatenate((np.flatnonzero(new)[1:] - 1, [len(y) - 1]))]
                gone = np.zeros(len(text) + 1, np.int8)
                gone[np.minimum(x, len(text))] += 1
                gone[np.minimum(y, len(text))] -= 1
                stay = np.cumsum(gone[:-1]) == 0
                if whole:
                    head = (text & 0xC0) != 0x80
                    stay = np.logical_or.reduceat(stay, np.flatnonzero(head))[np.cumsum(head) - 1]
                edge = np.diff(np.concatenate(([0], (~stay).view(np.int8), [0])))
                out[i, 1:] = len(text) - int(stay.sum()), int((edge == 1).sum())
                kept.append(text[stay].tobytes())
            rest = [c for c in b.schema.names if c not in ("doc_id", "text", "spans")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *map(pa.array, out.T.copy()), pa.array(kept, pa.binary()), *map(b.column, rest)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", *rest])

    return tidy(run)


def _refined(strings: DataFrame, q: int, length: int) -> DataFrame:
    """Steps 2 and 4 by aggregations. strings: (doc, pos, k, low, high, bytes), bytes filled up. Returns spans (doc, s, e)."""
    place, side, step = F.struct("doc", "pos"), length - q, length - 2 * q
    ids = lambda *cols: F.struct(*[F.xxhash64(F.lit(i), *cols).alias(n) for i, n in ((1, "a"), (2, "b"))])
    strings = strings.withColumn("whole", ids("k", "bytes"))
    firsts = strings.groupBy("whole").agg(F.min(F.struct("doc", "pos", "k", "low", "high", "bytes")).alias("x"))
    firsts = materialize(firsts.select("whole", "x.*", F.struct("x.doc", "x.pos").alias("least")), "firsts")
    met = strings.select("doc", "pos", "low", "high", "whole").join(firsts.select("whole", "least"), "whole").where(place != F.col("least"))
    whole = met.select("doc", (F.col("pos") - F.col("high")).alias("s"), (F.col("pos") - F.col("low") + length).alias("e"))
    gram = lambda j: F.xxhash64(F.lit(3), F.substring("bytes", j + 1, q))  # noqa: E731  the q-gram bucket of the suffix at j
    pair = lambda j: ids("k", gram(j), gram(j + q))
    j = F.col("j")
    windows = firsts.select("doc", "pos", "k", "bytes", F.explode(F.sequence(side - F.col("high"), side - F.col("low"))).alias("j"))
    windows = windows.select("doc", "pos", "j", pair(j).alias("one"), pair(j + step).alias("two")).select("doc", "pos", "j", ids("one", "two", "j").alias("id"))
    least = windows.groupBy("id").agg(F.min(place).alias("least"), F.max(place).alias("most")).where("least <> most").select("id", "least")
    covered = windows.join(least, "id").where(place != F.col("least"))
    start = F.col("pos") + j - side
    return whole.unionByName(covered.select("doc", start.alias("s"), (start + length).alias("e")))


def spans(own: DataFrame, q: int = QGRAM, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """Covered byte ranges (doc, s, e), which may overlap; own: doc_id and text. length: 2 q to 4 q, which two refinements of a q-gram reach."""
    if not 2 * q <= length <= 4 * q:
        raise ValueError("length must be 2 q to 4 q")
    spark = own.sparkSession
    counted = own.select("text").mapInArrow(_grams(q, length), "k long, n long")
    repeated = materialize(counted.groupBy("k").agg(F.sum("n").alias("n")).where("n > 1"), "qgrams")
    large = repeated.where(F.col("n") > hot)
    n_large = large.count()
    wanted = spark.sparkContext.broadcast(bloom.build(repeated, "k", repeated.count()))
    hots = spark.sparkContext.broadcast(bloom.build(large, "k", n_large))
    schema = "doc long, pos long, k long, low int, high int, bytes binary"
    anchored = own.mapInArrow(_strings(q, length, wanted, hots, False), schema)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    together = anchored.repartition(parts, "k").sortWithinPartitions("k", "doc", "pos")
    out = materialize(together.mapInArrow(_refine_buckets(q, length), "doc long, s long, e long"), "spans")
    if n_large:
        strings = materialize(own.mapInArrow(_strings(q, length, wanted, hots, True), schema), "strings")
        out = out.unionByName(materialize(_refined(strings, q, length), "spans"))
    return out


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", q: int = QGRAM, length: int = LENGTH, whole_characters: bool = False, keep: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (binary, the remaining bytes) and the columns to keep for every row of docs."""
    arrow_batches(docs.sparkSession)
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), *keep)
    by_doc = spans(own.select("doc_id", "text"), q, length).groupBy(F.col("doc").alias("_doc")).agg(F.collect_list(F.struct(F.col("s").cast("int").alias("s"), F.col("e").cast("int").alias("e"))).alias("spans"))
    joined = own.join(by_doc, F.col("doc_id").eqNullSafe(F.col("_doc")), "left").drop("_doc")
    schema = T.StructType.fromDDL("doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
    return joined.mapInArrow(_cut(whole_characters), T.StructType([*schema, *own.select(*keep).schema]))


ship(__name__)
