"""N-gram Jaccard join: a size-aware heavy-light join of the documents' shingle sets.

Equal sets are one class. Light sets (few shingles) enumerate, for each size that a partner may have, all their subsets of
the overlap that such a pair needs: two light sets are similar exactly if they share such a subset, so no comparison is
needed. Heavy sets scan inverted lists: each set is listed under its rarest shingles, as many as a similar set can't all
miss. The boundary between the two is the size with the least estimated work over the corpus's size histogram.

Shingles are ordered by the exact number of classes that have them. The counts are made by hash range: tasks pack the hashes
of their heavy sets with the classes that have them into sorted blobs, one for each range, and a range's task gives back what
two classes or more share. A class of which less than the threshold is shared has no partner and is done. The others keep
their shared shingles in order, which is all that lists and comparisons need.

Lists are not paired out. A list leaves out members that are too far down their own order to reach the threshold with it as
their first common shingle; the others are first compared with the list's pivot, the member nearest to the top of its own
order, and components of these links are formed. Only pairs of a list that still lie in different components are compared,
after the same bounds. Each comparison is of whole sets, so links are exact and none is lost: pairs that are never compared
are in one component already, or can't reach the threshold.

A shingle that a very large share of the corpus has would make its range large. Counters of fixed size find the cells of such
shingles; the shingles of these cells aren't counted but taken as shared and last in the order, and are spread over the
ranges by class. Any order gives the same result, a good one keeps lists short.

Defined cases: null, empty or wordless texts have an empty set, link with nothing and are their own component; texts of
fewer than k words have one shingle, the whole sequence; rows that share a doc id are compared each by its own text; a row
with a null id takes part and its component is the least id that it reaches, or null; extra columns are dropped.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverloom.llm.components import components
from coverloom.llm.kernels import U, mix, shingle_sets, tidy
from coverloom.llm.util import arrow_batches, discard, let, materialize, ship

#: Cells of the counters that find hot shingles, and how far above the median a cell counts as hot.
COUNTERS, HOT = 1 << 16, 1 << 18
#: Sizes beyond which no boundary is looked for; the subsets of far smaller sets outnumber their lists.
LARGEST_LIGHT = 64
#: Hash entries that a task packs at once, and about how many a range has.
FLUSH, RANGE = 1 << 19, 1 << 20
#: Bits of a shingle's hash that tell shingles apart.
BITS = 48
#: Classes that a task remembers, to pack a class that it meets again once.
SEEN = 200_000


def need(s: int, m: int, percent: int) -> int:
    """Least overlap of similar sets of sizes s and m."""
    return -(-percent * (s + m) // (100 + percent))


def partners(s: int, percent: int) -> range:
    """Sizes that a set similar to one of size s can have."""
    return range(-(-percent * s // 100), 100 * s // percent + 1)


def prefix(s: int, percent: int) -> int:
    return s - (-(-percent * s // 100)) + 1


def boundary(sizes: dict[int, int], percent: int, compare: float = 0.3) -> int:
    """The largest light size with the least work: subsets enumerated, against list entries and comparisons of a share of the sets. sizes: how many sets of each size up to LARGEST_LIGHT; larger ones are heavy."""

    def work(x: int) -> float:
        total = 0.0
        for s, n in sizes.items():
            if s <= x:
                total += n * sum(comb(s, need(s, m, percent)) for m in partners(s, percent) if m <= x and need(s, m, percent) <= s)
            if s > x or 100 * s // percent > x:
                total += n * (prefix(s, percent) + compare * s)
        return total

    return min(range(LARGEST_LIGHT + 1), key=lambda x: (work(x), x))


def _signature(s):
    return mix(s ^ U(0x1234567)).sum(dtype=np.uint64), mix(s + U(0x7654321)).sum(dtype=np.uint64)


SIG = ["s1", "s2", "size"]


def _classes(k: int):
    """Rows of kind 0: (doc_id, size, s1, s2, set) of a text, the set only of a possibly light one; of kind 1: a counter (s1) and what this task has counted (s2)."""
    names = ["kind", "doc_id", "size", "s1", "s2", "set"]

    def run(batches):
        counts = np.zeros(COUNTERS, np.int64)
        for b in batches:
            out, sets, seen = np.zeros((b.num_rows, 3), np.int64), [], []
            for i, s in shingle_sets(b, "text", k):
                a, z = _signature(s)
                out[i] = len(s), a.astype(np.int64), z.astype(np.int64)
                sets.append(s if len(s) <= LARGEST_LIGHT else s[:0])
                seen.append((s & U(COUNTERS - 1)).astype(np.int32))
            if seen:
                counts += np.bincount(np.concatenate(seen), minlength=COUNTERS)
            offsets = np.concatenate(([0], np.cumsum([len(x) for x in sets]))).astype(np.int32)
            flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            small = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))
            size, s1, s2 = out.T.copy()
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(b.num_rows, np.int32)), b.column("doc_id"), pa.array(size.astype(np.int32)), pa.array(s1), pa.array(s2), small], names)
        at = np.flatnonzero(counts)
        n = len(at)
        yield pa.RecordBatch.from_arrays([pa.array(np.ones(n, np.int32)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.array(at), pa.array(counts[at]), pa.nulls(n, pa.list_(pa.int64()))], names)

    return tidy(run)


def _subsets(percent: int, light: int):
    """(k1, k2, lo, hi, size, id) of the subsets of light sets, from (id, set)."""
    names = ["k1", "k2", "lo", "hi", "size", "id"]

    def run(batches):
        for b in batches:
            ids, lists, parts = b.column("id").to_pylist(), b.column("set"), []
            at, flat = np.asarray(lists.offsets), np.asarray(lists.values).view(np.uint64)
            for i, own in enumerate(ids):
                s = flat[at[i] : at[i + 1]]
                one, two, n = mix(s ^ U(0xA5A5)), mix(s + U(0x5A5A)), len(s)
                sum1, sum2 = one.sum(dtype=np.uint64), two.sum(dtype=np.uint64)
                for m in partners(n, percent):
                    c = need(n, m, percent)
                    if m > light or m < 1 or c > n:
                        continue
                    gone = np.array(list(combinations(range(n), n - c)), np.int64)
                    k1, k2 = sum1 - one[gone].sum(1, dtype=np.uint64), sum2 - two[gone].sum(1, dtype=np.uint64)
                    full = lambda v, kind: np.full(len(k1), v, kind)  # noqa: B023, E731
                    parts.append((k1.view(np.int64), k2.view(np.int64), full(min(n, m), np.int32), full(max(n, m), np.int32), full(n, np.int32), full(own, np.int64)))
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts)], names)

    return tidy(run)


def _packed(k: int, percent: int, light: int, ranges: int, hot):
    """(part, n, hashes, members, classes): the heavy sets' hashes of a range, sorted, as byte planes of their differences; for each the place of its class in `classes`. Parts from `ranges` on hold hashes of hot cells, spread by class."""
    names = ["part", "n", "hashes", "members", "classes"]

    def pack(sets, sigs):
        sizes = [len(x) for x in sets]
        full, member = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
        sig = np.array(sigs, np.uint64)
        h = full >> U(64 - BITS)
        part = (h >> U(BITS - 32)) * U(ranges) >> U(32)
        warm = hot.value[(full & U(COUNTERS - 1)).astype(np.int64)]
        part[warm] = U(ranges) + sig[member[warm]] % U(ranges)
        order = np.lexsort((h, part)) if warm.any() else np.argsort(h)
        h, member, part = h[order], member[order], part[order].astype(np.int64)
        at = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        rows = []
        for a, z in zip(at, np.append(at[1:], len(h))):
            own, local = np.unique(member[a:z], return_inverse=True)
            step = np.diff(h[a:z], prepend=U(0)).view(np.uint8).reshape(-1, 8)[:, : BITS // 8]
            rows.append((int(part[a]), int(z - a), step.T.tobytes(), local.astype(np.uint16 if len(own) <= 1 << 16 else np.uint32).tobytes(), sig[own].tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()))], names)

    def run(batches):
        seen: set[tuple[int, int]] = set()
        sets, sigs, held = [], [], 0
        for b in batches:
            for _, s in shingle_sets(b, "text", k):
                n = len(s)
                if not n or (n <= light and 100 * n // percent <= light):
                    continue
                a, z = _signature(s)
                if (key := (int(a), int(z))) in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(key)
                sets.append(s)
                sigs.append(a)
                held += n
                if held >= FLUSH:
                    yield pack(sets, sigs)
                    sets, sigs, held = [], [], 0
        if sets:
            yield pack(sets, sigs)

    return tidy(run)


def _shared(ranges: int):
    """(s1, k, c): what two classes or more have, with their number; from the blobs of _packed, sorted by part."""

    def unpack(row):
        n = row["n"]
        step = np.zeros((n, 8), np.uint8)
        step[:, : BITS // 8] = np.frombuffer(row["hashes"], np.uint8).reshape(BITS // 8, n).T
        kind = np.uint16 if len(row["members"]) == 2 * n else np.uint32
        return np.cumsum(step.reshape(-1).view(np.uint64), dtype=np.uint64), np.frombuffer(row["classes"], np.uint64)[np.frombuffer(row["members"], kind)]

    def solve(part, blobs):
        h, c = (np.concatenate(x) for x in zip(*blobs))
        order = np.lexsort((c, h))
        h, c = h[order], c[order]
        new = np.concatenate(([True], (h[1:] != h[:-1]) | (c[1:] != c[:-1])))  # a class that several tasks have packed counts once
        h, c = h[new], c[new]
        first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
        n = np.diff(np.append(first, len(h)))
        count = np.repeat(n if part < ranges else np.full(len(n), np.iinfo(np.int32).max), n)
        keep = count > 1
        return pa.RecordBatch.from_arrays([pa.array(c[keep].view(np.int64)), pa.array(h[keep].view(np.int64)), pa.array(count[keep].astype(np.int32))], ["s1", "k", "c"])

    def run(batches):
        now, blobs = None, []
        for b in batches:
            for row in b.to_pylist():
                if row["part"] != now and blobs:
                    yield solve(now, blobs)
                    blobs = []
                now = row["part"]
                blobs.append(unpack(row))
        if blobs:
            yield solve(now, blobs)

    return tidy(run)


def _fits(percent: int, n, place, m):
    """Whether a set of size n whose first common shingle with one of size m is at this place can be similar to it."""
    return (100 + percent) * (n - place + 1) >= percent * (n + m)


def _verified(cands: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of class ids that are similar. What only one class has can't be common, so the shared shingles of both give the overlap."""
    of = lambda side, name: cands.select(F.col("id").alias(side), F.col("n").alias(f"{side}n"), F.transform("e", lambda x: x.getField("k")).alias(name))
    both = pairs.join(of("a", "x"), "a").join(of("b", "y"), "b").where(100 * F.least("an", "bn") >= percent * F.greatest("an", "bn"))
    similar = let(F.size(F.array_intersect("x", "y")).cast("long"), lambda i: 100 * i >= percent * (F.col("an") + F.col("bn") - i))
    return both.where(similar).select("a", "b")


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80, hot: int = HOT) -> DataFrame:
    """doc_id, n_shingles and component_id for every row of docs."""
    spark = docs.sparkSession
    arrow_batches(spark)
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    first = materialize(own.mapInArrow(_classes(k), "kind int, doc_id long, size int, s1 long, s2 long, set array<long>"), "texts")
    rows = first.where("kind = 0").select("doc_id", *SIG)
    # ids are fixed by writing them
    reps = first.where("kind = 0 and size > 0").groupBy(*SIG).agg(F.min("doc_id").alias("rep"), F.first("set").alias("set"))
    reps = materialize(reps.withColumn("id", F.monotonically_increasing_id()), "reps")

    counts = first.where("kind = 1").groupBy("s1").agg(F.sum("s2").alias("n")).toArrow()  # COUNTERS rows at most
    cells = np.zeros(COUNTERS, np.int64)
    cells[counts.column("s1").to_numpy()] = counts.column("n").to_numpy()
    warm = spark.sparkContext.broadcast(cells >= 1.25 * np.median(cells) + hot)
    sizes = {r["size"]: r["n"] for r in reps.where(F.col("size") <= LARGEST_LIGHT).groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}  # LARGEST_LIGHT rows at most
    light = boundary(sizes, percent)

    # light: whoever shares a subset of the needed size is linked, through the least class on either side
    small = reps.where(F.col("size") <= light).select("id", "set").mapInArrow(_subsets(percent, light), "k1 long, k2 long, lo int, hi int, size int, id long").withColumnRenamed("id", "a")
    side = lambda col: F.min(F.when(F.col("size") == F.col(col), F.col("a")))
    ends = small.groupBy("k1", "k2", "lo", "hi").agg(side("lo").alias("p"), side("hi").alias("q"), F.min("a").alias("low"), F.max("a").alias("high"))
    ends = ends.where("p is not null and q is not null and low <> high").select("k1", "k2", "lo", "hi", F.explode(F.array_distinct(F.array("p", "q"))).alias("b"))
    links = small.join(ends, ["k1", "k2", "lo", "hi"]).where("a <> b").select("a", "b").distinct()

    # heavy: the classes of which enough is shared, with their shared shingles from the rarest on
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(cells.sum()) // RANGE)
    packed = own.select("text").mapInArrow(_packed(k, percent, light, ranges, warm), "part int, n int, hashes binary, members binary, classes binary")
    shared = packed.repartitionById(ranges, "part").sortWithinPartitions("part").mapInArrow(_shared(ranges), "s1 long, k long, c int")
    by_class = shared.groupBy("s1").agg(F.collect_list(F.struct("c", "k")).alias("e")).where(F.size("e") > 0)
    cands = reps.select("id", "s1", F.col("size").cast("long").alias("n")).join(by_class, "s1").where(100 * F.size("e") >= percent * F.col("n"))
    cands = materialize(cands.select("id", "n", F.array_sort("e").alias("e")), "shared")

    # unshared shingles are the rarest; of the places that a similar set can't all miss, they take the first ones
    n, need_n = F.col("n"), F.ceil(percent * F.col("n") / 100)
    listed = (n - need_n + 1 - (n - F.size("e"))).cast("int")
    lists = cands.select("id", "n", F.posexplode(F.slice("e", F.lit(1), F.greatest(listed, F.lit(0)))).alias("p", "x"), F.size("e").alias("r"))
    lists = materialize(lists.select(F.col("x.k").alias("k"), F.col("id").alias("a"), "n", (n - F.col("r") + F.col("p") + 1).alias("place")), "lists")
    pivot = lists.groupBy("k").agg(F.min_by("a", F.struct(F.col("place") / n, "a")).alias("b"), F.min("n").alias("least"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
    fits = _fits(percent, n, F.col("place"), F.greatest("least", need_n)) | (F.col("a") == F.col("b"))
    lists = materialize(lists.join(pivot, "k").where(fits).drop("least"), "fitting")
    tried = materialize(lists.where("a <> b").select("a", "b").distinct(), "tried")
    links = materialize(links.unionByName(_verified(cands, tried, percent)), "links")
    roots = components(links)

    # pairs of a list in different components
    placed = lists.drop("b").join(roots, F.col("a") == F.col("node"), "left").select("k", "a", "n", "place", F.coalesce("root", "a").alias("root"))
    several = placed.groupBy("k").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("k")
    apart = materialize(placed.join(several, "k", "left_semi"), "apart")
    met = apart.alias("l").join(apart.alias("r"), "k").where("l.a < r.a and l.root <> r.root")
    for x, y in (("l", "r"), ("r", "l")):
        met = met.where(_fits(percent, F.col(f"{x}.n"), F.col(f"{x}.place"), F.col(f"{y}.n")))
    pairs = met.select(F.col("l.a").alias("a"), F.col("r.a").alias("b")).distinct()
    pairs = pairs.join(tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti")
    more = materialize(_verified(cands, pairs, percent), "more")
    if not more.isEmpty():
        roots = components(links.unionByName(more))
    discard(lists, cands, apart, tried)

    named = materialize(reps.join(roots, F.col("id") == F.col("node"), "left").select(*SIG, "rep", F.coalesce("root", "id").alias("root")), "named")
    least = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = named.join(least, "root").select(*SIG, "component_id")
    out = rows.where("size > 0").join(named, SIG, "left").select("doc_id", F.col("size").cast("long").alias("n_shingles"), "component_id")
    empty = rows.where("size = 0").select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return out.unionByName(empty)


ship(__name__)
