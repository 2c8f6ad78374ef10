"""K-mer sketches, their Jaccard similarity, and sample sets built from nearest neighbours."""

from __future__ import annotations

from itertools import combinations, islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from coverloom.functions.index import numbered
from coverloom.functions.text import clean_sequence, reverse_complement
from coverloom.scratch import cut, small


def sketch(otu: DataFrame, k: int = 60, taxa: str | None = None) -> DataFrame:
    """Distinct (sample, kmer): canonical k-mers of the sequences, gaps and unknown bases as A."""
    rows = otu.where(F.col("taxonomy").rlike(taxa)) if taxa else otu
    seq = rows.select("sample", clean_sequence(F.col("sequence")).alias("s")).where(F.length("s") >= k)
    each = seq.select("sample", F.explode(F.transform(F.sequence(F.lit(1), F.length("s") - (k - 1)), lambda i: F.substring("s", i, F.lit(k)))).alias("kmer"))
    return each.select("sample", F.least("kmer", reverse_complement(F.col("kmer"))).alias("kmer")).distinct()


#: Samples that share a k-mer from which on it is compared by blocks of samples, and samples of a block.
HOT, BLOCK = 5_000, 512


def _by_blocks(hot: DataFrame, sizes: DataFrame, threshold: float, block: int) -> DataFrame:
    """(s, t, h): pairs of samples, s < t, with the number h of hot k-mers that they share, for all pairs that can reach the threshold if they also share all their other k-mers.

    hot: (kmer, sample); sizes: (sample, n, h: its hot k-mers). A task has two blocks of samples and multiplies their bit matrices, so that a k-mer that all samples have makes no row for each pair.
    """
    blocks = max(1, -(-sizes.count() // block))
    of = F.pmod(F.xxhash64("sample"), F.lit(blocks)).cast("int")
    lists = hot.groupBy("sample").agg(F.collect_list(F.xxhash64("kmer")).alias("k"))
    rows = sizes.join(lists, "sample", "left").withColumn("b", of)
    rows = rows.select("sample", "n", "h", "k", "b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("o"))
    rows = rows.select("sample", "n", "h", "k", "b", F.least("b", "o").alias("x"), F.greatest("b", "o").alias("y"))

    def multiply(key, rows):
        x, y = key
        rows = rows.sort_values("sample").reset_index(drop=True)
        ids = [np.asarray(k if k is not None else [], np.int64) for k in rows["k"]]
        words, at = np.unique(np.concatenate(ids), return_inverse=True)
        owner = np.repeat(np.arange(len(ids)), [len(k) for k in ids])
        name, n, cold = rows["sample"].to_numpy(), rows["n"].to_numpy(), (rows["n"] - rows["h"]).to_numpy()
        left, right = np.flatnonzero(rows["b"] == x), np.flatnonzero(rows["b"] == y)
        both = np.zeros((len(left), len(right)), np.float32)
        for a in range(0, len(words), 4096):
            m = np.zeros((len(ids), min(4096, len(words) - a)), np.float32)
            own = (at >= a) & (at < a + 4096)
            m[owner[own], at[own] - a] = 1
            both += m[left] @ m[right].T
        most = both + np.minimum(cold[left][:, None], cold[right][None])
        # a little slack covers rounding, the exact test comes last
        i, j = np.nonzero(most * (1 + threshold) >= threshold * (n[left][:, None] + n[right][None]) - 1e-6)
        i, j, h = left[i], right[j], both[i, j]
        keep = name[i] < name[j] if x == y else np.ones(len(i), bool)
        i, j, h = i[keep], j[keep], h[keep]
        turn = name[i] > name[j]
        return pd.DataFrame({"s": np.where(turn, name[j], name[i]), "t": np.where(turn, name[i], name[j]), "h": h.astype(np.int64)})

    return rows.groupBy("x", "y").applyInPandas(multiply, "s string, t string, h long")


def jaccard(sketches: DataFrame, threshold: float = 0.1, hot: int = HOT, block: int = BLOCK) -> DataFrame:
    """(query_name, match_name, jaccard) of sample pairs that share k-mers, at or over the threshold; samples without a common k-mer never meet. Each k-mer has the list of its samples' numbers, and a sample gets what stands behind it in its lists and counts it: one shuffled row for each sample of a k-mer, none for each pair. K-mers of over `hot` samples are compared by blocks of samples instead."""
    sketches = cut(sketches, "sketches")  # read again and again
    n = sketches.groupBy("sample").agg(F.count(F.lit(1)).alias("n"))
    common = cut(sketches.groupBy("kmer").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > hot).select("kmer"), "common")
    many = not common.isEmpty()
    rest = sketches.join(small(common), "kmer", "left_anti") if many else sketches
    # by rising size: what comes behind a sample is at least as large
    ids = cut(numbered(n, "id", "n", "sample").withColumn("id", F.col("id").cast("int")), "ids")
    lists = rest.where("kmer is not null").join(small(ids.select("sample", "id")), "sample").groupBy("kmer").agg(F.array_sort(F.collect_list("id")).alias("l")).where(F.size("l") > 1)
    met = lists.select("l", F.posexplode("l").alias("p", "x")).select("x", F.slice("l", F.col("p") + 2, F.size("l")).alias("rest")).where(F.size("rest") > 0)
    met = met.repartition("x").select("x", F.explode("rest").alias("y")).where("x < y").groupBy("x", "y").agg(F.count(F.lit(1)).alias("i"))
    of = lambda c: small(ids.select(F.col("id").alias(c), F.col("sample").alias(f"s{c}"), F.col("n").alias(f"n{c}")))
    met = met.join(of("x"), "x")
    if not many:  # a value of the threshold takes as many common k-mers
        met = met.where(F.col("i") >= threshold * F.col("nx") - 1e-6)
    met = met.join(of("y"), "y").where(F.col("nx") >= threshold * F.col("ny") - 1e-6)
    turn = F.col("sx") > F.col("sy")
    by = lambda a, b: F.when(turn, F.col(a)).otherwise(F.col(b))
    both = met.select(by("sy", "sx").alias("query_name"), by("sx", "sy").alias("match_name"), by("ny", "nx").alias("n1"), by("nx", "ny").alias("n2"), "i")
    if many:
        own = sketches.join(small(common), "kmer", "left_semi")
        h = own.groupBy("sample").agg(F.count(F.lit(1)).alias("h"))
        sizes = cut(n.join(h, "sample", "left").fillna(0, ["h"]), "sizes")
        pairs = _by_blocks(own, sizes, threshold, block)
        of = lambda s, c: sizes.select(F.col("sample").alias(s), F.col("n").alias(c))
        pairs = pairs.join(of("s", "n1"), "s").join(of("t", "n2"), "t").select(F.col("s").alias("query_name"), F.col("t").alias("match_name"), "n1", "n2", "h")
        both = pairs.join(both.drop("n1", "n2"), ["query_name", "match_name"], "left").withColumn("i", F.col("h") + F.coalesce("i", F.lit(0))).where("i > 0")
    value = F.col("i") / (F.col("n1") + F.col("n2") - F.col("i"))
    return filtered(both.select("query_name", "match_name", value.alias("jaccard")), threshold)


def filtered(distances: DataFrame, threshold: float = 0.1) -> DataFrame:
    return distances.where(F.col("jaccard") >= threshold)


def neighbours(distances: DataFrame, size: int, lower: bool = True) -> tuple[DataFrame, int]:
    """(sample, nearest): for each sample its size - 1 most similar ones, least similar first, and the size. Samples without enough similar ones are filled up with dissimilar ones, last names first; ties go to the later name. No distances give no sample.

    lower: of fewer samples than `size`, each has one less than all others are (and the size falls with it); else all others.
    Only the last `size` names can fill up, so each sample gets this one short list and is not joined with all samples.
    """
    distances = cut(distances, "distances")  # read again and again
    d = distances.select(F.col("query_name").alias("a"), F.col("match_name").alias("b"), "jaccard")
    names = d.select(F.explode(F.array("a", "b")).alias("sample")).distinct()
    n = names.count()
    if n < size and lower:
        size = max(n - 1, 0)
    both = d.unionByName(d.select(F.col("b").alias("a"), F.col("a").alias("b"), "jaccard")).where("a <> b").groupBy("a", "b").agg(F.sum("jaccard").alias("jaccard"))
    last = names.orderBy(F.desc("sample")).limit(size)
    fill = names.select(F.col("sample").alias("a")).crossJoin(F.broadcast(last.agg(F.collect_list("sample").alias("f")))).select("a", F.explode("f").alias("b")).where("a <> b")
    fill = fill.join(both.select("a", "b"), ["a", "b"], "left_anti").withColumn("jaccard", F.lit(0.0))
    w = W.partitionBy("a").orderBy(F.desc("jaccard"), F.desc("b"))
    top = both.unionByName(fill).withColumn("k", F.row_number().over(w)).where(F.col("k") <= max(size - 1, 0))
    lists = top.groupBy("a").agg(F.array_sort(F.collect_list(F.struct((-F.col("k")).alias("o"), F.col("b").alias("b")))).alias("x"))
    return names.join(lists, F.col("sample") == F.col("a"), "left").select("sample", F.coalesce(F.transform("x", lambda v: v.getField("b")), F.array().cast("array<string>")).alias("nearest")), size


def preclusters(distances: DataFrame, size: int = 2, largest: int = 2, anchors: list[str] | None = None, most_similar_first: bool = False) -> DataFrame:
    """Distinct sample sets (samples, sorted): for every sample and set size, the sample with the first `size` combinations of its neighbours."""
    if distances.isEmpty():
        return distances.select(F.array("query_name").alias("samples")).where(F.lit(False))
    near, size = neighbours(distances, size)
    if anchors:
        near = near.where(F.col("sample").isin(*anchors))
    if most_similar_first:
        near = near.withColumn("nearest", F.reverse("nearest"))
    rows = [(list(c),) for x in range(1, max(largest, 2)) for c in islice(combinations(range(size - 1), x), size)]
    if not rows:
        return near.select(F.array("sample").alias("samples")).where(F.lit(False))
    combos = F.array(*[F.array(*[F.lit(i) for i in c]) for (c,) in rows])
    each = near.select("sample", "nearest", F.explode(combos).alias("c"))
    chosen = F.transform("c", lambda i: F.get("nearest", i))
    return each.select(F.array_sort(F.concat(F.array("sample"), chosen)).alias("samples")).distinct()


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()
