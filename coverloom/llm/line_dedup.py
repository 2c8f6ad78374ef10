"""Line dedup that can take documents back: sharded cuckoo filters over exact reference counts.

A line's key is the line without white space at its ends, A-Z lower-cased; short keys don't count. The state holds, as written
tables, who has a key (one row for each text and distinct key of it), the exact count of texts and the largest document id of
each key, and a cuckoo filter of each shard of the keys' hashes with the keys that `min_docs` texts or more have: the common
ones. Inserting documents adds their counts, deleting them takes exactly these away again and looks up who is the largest left;
only keys that become common, or cease to be, are inserted into or deleted from their shard's filter.

To dedup texts, their lines are probed against the filters where the texts are read. What may be common meets the exact counts:
those of keys so common that no more than HOT_KEYS of them can exist by a broadcast join, the others by a shuffled one in which
no key has more than a HOT_KEYS-th of all rows. Lines that are dropped go to their documents; only texts that may have one are
shuffled.

Sizes: filters of FILTER_BYTES together are sent to all tasks; the lines of further shards all go to the exact join. A key that
finds no room in its filter is stashed beside it as it is. When the shards fill up, the filters are made anew from the counts, in
more shards. Keys are told apart by 128 bits of hash.

Defined cases: a null or empty text is one empty line; rows count as texts of their own, also rows that share a document id,
which hold a key together when it is the largest; a null id is smaller than all others, and rows of it are deleted by a null;
a document all of whose lines go leaves an empty text; extra columns are dropped unless they are kept; an empty table gives an
empty state.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from coverloom.llm.kernels import U, column, mix, tidy
from coverloom.llm.url_filter import maybe_in
from coverloom.llm.util import arrow_batches, materialize, ship

WHITE = b" \t\n\x0b\x0c\r"
#: Buckets of a shard's filter (of four fingerprints of 16 bits), and keys for which a shard is planned and at which there are too many.
BUCKETS, PLANNED, FULL = 1 << 13, 1 << 14, 24_000
#: Moves before a key is stashed.
KICKS = 200
#: Bytes of filters that are sent to all tasks.
FILTER_BYTES = 32 << 20
#: So many keys at most can each have over a HOT_KEYS-th of all rows.
HOT_KEYS = 50_000
#: Bytes of the widest code point.
WIDEST = 4


def keys(text: bytes, min_chars: int) -> list[bytes | None]:
    """The 128-bit key of each line; None for a key of under min_chars code points."""
    out: list[bytes | None] = []
    for line in text.split(b"\n"):
        line = line.strip(WHITE)
        n = len(line)
        if n < min_chars or n < WIDEST * min_chars and sum((c & 0xC0) != 0x80 for c in line) < min_chars:
            out.append(None)
        else:
            out.append(xxhash.xxh3_128_digest(line.lower()))
    return out


def _words(packed: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(packed), "<i8").reshape(-1, 2)


def _texts(batch):
    data, starts, ends, _ = column(batch, "text")
    for s, e in zip(starts.tolist(), ends.tolist()):
        yield data[s:e].tobytes()


def _places(k1: np.ndarray, k2: np.ndarray):
    """Fingerprint and both buckets of keys. The shard is taken from the low bits of k1, the bucket from its high ones."""
    fp = np.maximum((k2.view(np.uint64) & U(0xFFFF)), U(1))
    a = mix(k1.view(np.uint64)) & U(BUCKETS - 1)
    return fp.astype(np.int64), a.astype(np.int64), (a ^ (mix(fp) & U(BUCKETS - 1))).astype(np.int64)


class Cuckoo:
    """A filter of one shard: slots (BUCKETS, 4) of fingerprints, 0 if free, and stashed keys (n, 2)."""

    def __init__(self, slots: bytes | None = None, stash: bytes | None = None):
        self.slots = np.frombuffer(slots, np.uint16).reshape(BUCKETS, 4).copy() if slots else np.zeros((BUCKETS, 4), np.uint16)
        self.stash = {tuple(x) for x in np.frombuffer(stash or b"", np.int64).reshape(-1, 2).tolist()}

    def insert(self, k1: np.ndarray, k2: np.ndarray) -> None:
        table = self.slots.tolist()
        fp, a, b = (x.tolist() for x in _places(k1, k2))
        step = (mix(np.arange(1 << 16, dtype=np.uint64)) & U(BUCKETS - 1)).tolist()
        for i, (f, x, y) in enumerate(zip(fp, a, b)):
            moved = []  # (bucket, slot, what was there), to be undone if there is no room
            for kick in range(KICKS):
                at = next((z for z in (x, y) if 0 in table[z]), None)
                if at is not None:
                    table[at][table[at].index(0)] = f
                    break
                slot = kick % 4
                moved.append((y, slot, table[y][slot]))
                f, table[y][slot] = table[y][slot], f
                x, y = y, y ^ step[f]
            else:
                for z, slot, was in reversed(moved):
                    table[z][slot] = was
                self.stash.add((int(k1[i]), int(k2[i])))
        self.slots = np.array(table, np.uint16)

    def delete(self, k1: np.ndarray, k2: np.ndarray) -> None:
        for one, two, f, x, y in zip(k1.tolist(), k2.tolist(), *(v.tolist() for v in _places(k1, k2))):
            if (one, two) in self.stash:
                self.stash.remove((one, two))
                continue
            for z in (x, y):
                found = np.flatnonzero(self.slots[z] == f)
                if len(found):
                    self.slots[z, found[0]] = 0
                    break

    def blobs(self) -> tuple[bytes, bytes]:
        return self.slots.tobytes(), np.array(sorted(self.stash), np.int64).reshape(-1, 2).tobytes()


class Filters:
    """The filters of the shards that are sent to tasks; keys of other shards may be common."""

    def __init__(self, shards: int, rows: list):
        self.shards = shards
        self.slots = np.zeros((len(rows) or 1, BUCKETS, 4), np.uint16)
        self.at = np.full(shards, -1, np.int64)
        stash = [np.zeros((0, 2), np.int64)]
        for i, r in enumerate(rows):
            self.at[r["shard"]] = i
            self.slots[i] = np.frombuffer(r["slots"], np.uint16).reshape(BUCKETS, 4)
            stash.append(np.frombuffer(r["stash"], np.int64).reshape(-1, 2))
        self.stash = np.unique(np.concatenate(stash)[:, 0])

    def may_hold(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        at = self.at[(k1.view(np.uint64) & U(self.shards - 1)).astype(np.int64)]
        fp, a, b = _places(k1, k2)
        fp = fp.astype(np.uint16)[:, None]
        held = (self.slots[at, a] == fp).any(1) | (self.slots[at, b] == fp).any(1)
        return held | (at < 0) | np.isin(k1, self.stash)


def _holders(min_chars: int, filters: Filters | None = None):
    """(k1, k2, doc_id): one row for each text and distinct key of it that the filters, if given, let through."""

    def run(batches):
        for batch in batches:
            rows, found = [], []
            for i, text in enumerate(_texts(batch)):
                own = {k for k in keys(text, min_chars) if k}
                rows.append(np.full(len(own), i, np.int64))
                found.extend(own)
            if found:
                both, at = _words(found), np.concatenate(rows)
                k1, k2 = both[:, 0].copy(), both[:, 1].copy()
                if filters is not None:
                    may = filters.may_hold(k1, k2)
                    k1, k2, at = k1[may], k2[may], at[may]
                yield pa.RecordBatch.from_arrays([pa.array(k1), pa.array(k2), batch.column("doc_id").take(pa.array(at))], ["k1", "k2", "doc_id"])

    return tidy(run)


def _without(min_chars: int, names: list[str]):
    """The columns `names` of rows with n_lines, n_dropped and kept: the text without the lines whose keys are among the row's `gone`."""

    def run(batches):
        for batch in batches:
            lists, out, before, dropped = batch.column("gone"), [], [], []
            at, flat = np.asarray(lists.offsets).tolist(), lists.values
            packed = np.stack([np.asarray(flat.field(i)) for i in (0, 1)], 1).astype("<i8").tobytes()
            for i, text in enumerate(_texts(batch)):
                gone = {packed[16 * j : 16 * j + 16] for j in range(at[i], at[i + 1])}
                lines = text.split(b"\n")
                kept = [line for line, k in zip(lines, keys(text, min_chars)) if k not in gone] if gone else lines
                out.append(b"\n".join(kept))
                before.append(len(lines))
                dropped.append(len(lines) - len(kept))
            own = [batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays([*own, pa.array(before, pa.int64()), pa.array(dropped, pa.int64()), pa.array(out, pa.binary())], [*names, "n_lines", "n_dropped", "kept"])

    return tidy(run)


@dataclass
class State:
    """holders: (k1, k2, doc_id); counts: (k1, k2, n, last); filters: (shard, slots, stash); common: how many keys have min_docs texts."""

    holders: DataFrame
    counts: DataFrame
    filters: DataFrame
    shards: int
    common: int
    min_chars: int
    min_docs: int


def _read(docs: DataFrame, doc_id: str, text: str, min_chars: int, filters: Filters | None = None) -> DataFrame:
    arrow_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = StructType([StructField("k1", LongType()), StructField("k2", LongType()), StructField("doc_id", rows.schema["doc_id"].dataType)])
    return rows.mapInArrow(_holders(min_chars, filters), kind)


def _counted(*parts: DataFrame) -> DataFrame:
    """Counts of partial ones (k1, k2, n, last, old); old: the count before."""
    all_of = parts[0]
    for p in parts[1:]:
        all_of = all_of.unionByName(p)
    return materialize(all_of.groupBy("k1", "k2").agg(F.sum("n").alias("n"), F.max("last").alias("last"), F.sum("old").alias("old")), "counts")


def _of(holders: DataFrame) -> DataFrame:
    return holders.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("last")).withColumn("old", F.lit(0).cast("long"))


def _changed(a, b):
    """A shard's filter after the keys that became common (up) or ceased to be."""
    import pandas as pd

    one = Cuckoo(*(b[["slots", "stash"]].iloc[0] if len(b) else ()))
    for up, keys_of in a.groupby("up"):
        (one.insert if up else one.delete)(keys_of["k1"].to_numpy(np.int64), keys_of["k2"].to_numpy(np.int64))
    shard = (a if len(a) else b)["shard"].iloc[0]
    slots, stash = one.blobs()
    return pd.DataFrame({"shard": [shard], "slots": [slots], "stash": [stash]})


_FILTER = "shard long, slots binary, stash binary"


def _filtered(counts: DataFrame, before: State | None, min_docs: int) -> tuple[DataFrame, int, int]:
    """Filters, number of shards, and of common keys, after the change from old to n in counts."""
    spark = counts.sparkSession
    is_now, was = F.col("n") >= min_docs, F.col("old") >= min_docs
    changed = counts.where(is_now != was)
    up, down = changed.agg(F.count_if(is_now), F.count_if(was)).first()
    common = (before.common if before else 0) + up - down
    shards = before.shards if before else 1
    empty = spark.createDataFrame([], _FILTER)
    old = before.filters if before else empty
    if before is None or common > shards * FULL:
        while common > shards * PLANNED:
            shards *= 2
        changed, old = counts.where(is_now), empty
    changed = changed.select(F.col("k1").bitwiseAND(F.lit(shards - 1).cast("long")).alias("shard"), "k1", "k2", is_now.alias("up"))
    made = changed.groupBy("shard").cogroup(old.groupBy("shard")).applyInPandas(_changed, _FILTER)
    return materialize(made, "filters"), shards, common


def insert(state: State | None, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = 20, min_docs: int = 3) -> State:
    """The state with the documents. Without a state, a first one; otherwise its own limits hold."""
    if state:
        min_chars, min_docs = state.min_chars, state.min_docs
    new = materialize(_read(docs, doc_id, text, min_chars), "holders")
    counts = _counted(*([state.counts.withColumn("old", F.col("n"))] if state else []), _of(new))
    filters, shards, common = _filtered(counts, state, min_docs)
    holders = state.holders.unionByName(new) if state else new
    return State(holders, counts.drop("old"), filters, shards, common, min_chars, min_docs)


def delete(state: State, ids: DataFrame, doc_id: str = "doc_id") -> State:
    """The state without these documents, as if they had never been inserted. Only the keys that they hold are counted anew."""
    ids = ids.select(F.col(doc_id).alias("_id")).distinct()
    gone = F.col("doc_id").eqNullSafe(F.col("_id"))
    touched = materialize(state.holders.join(ids, gone, "left_semi").select("k1", "k2").distinct(), "touched")
    rest = materialize(state.holders.join(ids, gone, "left_anti"), "holders")
    before = state.counts.join(touched, ["k1", "k2"], "left_semi")
    before = before.select("k1", "k2", F.lit(0).cast("long").alias("n"), F.lit(None).cast(state.counts.schema["last"].dataType).alias("last"), F.col("n").alias("old"))
    anew = _counted(_of(rest.join(touched, ["k1", "k2"], "left_semi")), before)
    filters, shards, common = _filtered(anew, state, state.min_docs)
    counts = state.counts.join(touched, ["k1", "k2"], "left_anti").unionByName(anew.where("n > 0").drop("old"))
    return replace(state, holders=rest, counts=materialize(counts, "counts"), filters=filters, shards=shards, common=common)


def drops(state: State, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, k1, k2): the common keys of the documents, which another document keeps."""
    room = FILTER_BYTES // (BUCKETS * 8)
    sent = state.filters.where(F.col("shard") < room).collect()  # of fixed size: FILTER_BYTES at most
    may = materialize(_read(docs, doc_id, text, state.min_chars, Filters(state.shards, sent)), "possible")
    common = state.counts.where(F.col("n") >= state.min_docs)
    rows = state.counts.agg(F.sum("n")).first()[0] or 0
    hot = F.col("n") > rows / HOT_KEYS
    found = may.join(F.broadcast(common.where(hot)), ["k1", "k2"])  # fewer than HOT_KEYS keys can have so many of all rows
    cold = common.where(~hot).drop("n")
    found = found.drop("n").unionByName(may.join(cold, ["k1", "k2"]))
    return found.where(~F.col("doc_id").eqNullSafe(F.col("last"))).select("doc_id", "k1", "k2")


def dedup(state: State, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """For every row of docs, which the state has: doc_id, the kept columns, n_lines (before), n_dropped, kept (bytes of the text that is left)."""
    gone = drops(state, docs, doc_id, text).groupBy(F.col("doc_id").alias("_doc")).agg(F.collect_set(F.struct("k1", "k2")).alias("_keys"))
    gone = materialize(gone, "gone")
    own = docs.select(F.col(doc_id).alias("doc_id"), *keep, F.col(text).cast("string").alias("text"))
    probed = maybe_in(own, gone, "doc_id", "_doc", "_maybe").withColumn("_maybe", F.col("_maybe") | F.col("doc_id").isNull())
    met = probed.where("_maybe").join(gone, F.col("doc_id").eqNullSafe(F.col("_doc")), "left")
    none = F.array().cast(gone.schema["_keys"].dataType)
    met = met.select("doc_id", *keep, "text", F.coalesce("_keys", none).alias("gone"))
    rows = met.unionByName(probed.where("not _maybe").select("doc_id", *keep, "text", none.alias("gone")))
    names = [n for n in rows.columns if n not in ("text", "gone")]
    added = [StructField("n_lines", LongType()), StructField("n_dropped", LongType()), StructField("kept", BinaryType())]
    return rows.mapInArrow(_without(state.min_chars, names), StructType([*[rows.schema[n] for n in names], *added]))


ship(__name__)
