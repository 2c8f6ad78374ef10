"""Candidate sample sets, their size and score, the greedy choice, extra targets and recovery samples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from coverloom.functions.index import numbered
from coverloom.functions.text import sample_key
from coverloom.scratch import cut, small

#: Candidates of one length that one task may choose among (about 330 bytes each there); more are chosen in distributed rounds.
ONE_TASK = 600_000
#: Samples beyond which the lists of a target's samples can be so long that recovery reads them by bounds.
LONG_LISTS = 5_000
#: Samples of a pool up to which it is listed under all their pairs (2,016 at most) when chosen sets look for it.
PAIRED = 64


def restrict(edges: DataFrame, samples: list[str]) -> DataFrame:
    """Edges without samples that may not be assembled, as far as they still have their size."""
    if not samples:
        return edges
    kept = edges.withColumn("samples", F.filter("samples", lambda s: s.isin(*samples)))
    return kept.where(F.size("samples") >= F.col("cluster_size"))


def matched(edges: DataFrame, min_samples: int = 2, min_targets: int = 1) -> DataFrame:
    """Candidates (key, samples, target_ids) from match edges."""
    own = edges.where((F.col("style") == "match") & (F.col("cluster_size") >= min_samples) & (F.size("target_ids") >= min_targets))
    return own.select(sample_key(F.col("samples")).alias("key"), F.array_sort("samples").alias("samples"), "target_ids")


def _supported(rows: DataFrame, on: str, least: int) -> DataFrame:
    """rows whose value of `on` has `least` targets over all of them; column n is a row's own number of targets."""
    enough = rows.groupBy(on).agg(F.sum("n").alias("_all")).where(F.col("_all") >= least).select(on)
    return rows.join(enough, on, "left_semi")


def _combinations(pools: DataFrame, n: int, least: int = 1) -> DataFrame:
    """(key, target_ids) of all n-combinations of sorted sample arrays that have `least` targets over all pools.

    A tree of prefixes: each step takes one sample and goes on with those behind it. A set is in no pool that its prefix isn't in, so
    it has at most its prefix's targets: samples and prefixes with too few are given up before they are spelled out. Rows of the
    tree carry the number of their pool, and meet the pool's targets at the end.
    """
    if least <= 1:  # every prefix has a target
        out = pools.select("target_ids", F.lit("").alias("key"), F.col("samples").alias("rest"))
        keep = ["target_ids"]
    else:
        pools = cut(pools.withColumn("pool", F.monotonically_increasing_id()), "pools")
        each = _supported(pools.select("pool", F.size("target_ids").alias("n"), F.explode("samples").alias("sample")), "sample", least)
        out = each.groupBy("pool", "n").agg(F.array_sort(F.collect_list("sample")).alias("rest")).where(F.size("rest") >= n).withColumn("key", F.lit(""))
        keep = ["pool", "n"]
    for left in range(n - 1, -1, -1):
        out = out.select(*keep, "key", "rest", F.posexplode("rest").alias("p", "s"))
        key = F.when(F.col("key") == "", F.col("s")).otherwise(F.concat_ws(",", "key", "s"))
        rest = F.slice("rest", F.col("p") + 2, F.size("rest"))
        out = out.select(*keep, key.alias("key"), rest.alias("rest")).where(F.size("rest") >= left) if left else out.select(*keep, key.alias("key"))
        if least > 1 and left < n - 1:
            out = _supported(cut(out, "prefixes"), "key", least)
    return out if least <= 1 else out.join(pools.select("pool", "target_ids"), "pool").select("target_ids", "key")


def pooled(edges: DataFrame, min_samples: int = 2, min_targets: int = 1, max_combined: int = 100) -> DataFrame:
    """Candidates from pools of at most max_combined samples: all their combinations of the pool's size, equal sets taken together with all their targets."""
    pools = edges.where((F.col("style") == "pool") & (F.col("cluster_size") >= min_samples) & (F.size("samples") <= max_combined))
    pools = pools.select("cluster_size", F.array_sort("samples").alias("samples"), "target_ids")
    sizes = [r[0] for r in pools.select("cluster_size").distinct().orderBy("cluster_size").collect()]  # the few set sizes
    parts = [_combinations(pools.where((F.col("cluster_size") == n) & (F.size("samples") >= n)), n, min_targets) for n in sizes]
    if not parts:
        return pools.select(sample_key(F.col("samples")).alias("key"), "samples", "target_ids").where(F.lit(False))
    got = reduce(DataFrame.unionByName, parts).groupBy("key").agg(F.flatten(F.collect_list("target_ids")).alias("target_ids"))
    return got.where(F.size("target_ids") >= min_targets).select("key", F.split("key", ",").alias("samples"), "target_ids")


def of_sources(edges: DataFrame, samples: list[str] | None = None) -> DataFrame:
    """One-sample candidates: all distinct targets of the edges that start from a sample."""
    source = edges.withColumn("source", F.get("samples", F.lit(0)))
    if samples:
        source = source.where(F.col("source").isin(*samples))
    got = source.groupBy("source").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("target_ids")))).alias("target_ids"))
    return got.select(F.col("source").alias("key"), F.array("source").alias("samples"), "target_ids")


def exclude(candidates: DataFrame, sets: list[str]) -> DataFrame:
    """Without sample sets (comma lists in any order) that were run already."""
    if not sets:
        return candidates
    keys = candidates.sparkSession.createDataFrame([(",".join(sorted(s.split(","))),) for s in sets], "key string")
    return candidates.join(small(keys), "key", "left_anti")


def anchored(candidates: DataFrame, anchors: list[str]) -> DataFrame:
    """Candidates with an anchor sample among theirs."""
    return candidates.where(F.arrays_overlap("samples", F.array(*[F.lit(a) for a in anchors]))) if anchors else candidates


def sized(candidates: DataFrame, read_size: DataFrame, max_size: float | None = None) -> DataFrame:
    """With length and total_size (samples without a size count 0), not over max_size."""
    candidates = cut(candidates, "candidates")  # read twice
    each = candidates.select("key", F.explode("samples").alias("sample"))
    size = each.join(small(cut(read_size.select("sample", "read_size"), "sizes")), "sample", "left").groupBy("key").agg(F.coalesce(F.sum("read_size"), F.lit(0)).cast("bigint").alias("total_size"))
    out = candidates.withColumn("length", F.size("samples")).join(size, "key")
    return out if max_size is None else out.where(F.col("total_size") <= max_size)


def scored(candidates: DataFrame, weights: DataFrame | None = None) -> DataFrame:
    """With total_targets: the number of targets, repeated ones counted each time, or the sum of their weights (0 for targets without one)."""
    if weights is None:
        return candidates.withColumn("total_targets", F.size("target_ids").cast("double"))
    each = candidates.select("key", F.explode("target_ids").alias("target")).join(weights, "target", "left")
    total = each.groupBy("key").agg(F.coalesce(F.sum("weight"), F.lit(0.0)).alias("total_targets"))
    return candidates.join(total, "key", "left").fillna(0.0, ["total_targets"])


def _in_turn(order: list[str], rising: list[bool]):
    """A function of the rows of one length: the keys that are taken when the rows are gone through in this order."""

    def choose(rows):
        used: set[str] = set()
        keys = []
        for key, samples in zip(*(rows.sort_values(order, ascending=rising)[c] for c in ("key", "samples"))):
            if used.isdisjoint(samples):
                used.update(samples)
                keys.append(key)
        return rows[rows["key"].isin(keys)][["key"]]

    return choose


def _prefix(alive: DataFrame, most: int) -> DataFrame:
    """Of each length the first rows by `at`, at most `most`: as many stretches of the numbers as hold no more than that. The prefix spans more of the order as rows between fall away."""
    width = max(most // 8, 1)
    part = F.expr(f"at div {width}")
    held = alive.groupBy("length", part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    upto = held.withColumn("sum", F.sum("n").over(W.partitionBy("length").orderBy("part"))).where(F.col("sum") <= most)
    upto = upto.groupBy("length").agg(F.max("part").alias("upto"))  # a row for each length
    return alive.join(F.broadcast(upto), "length").where(part <= F.col("upto")).drop("upto")


def greedy(candidates: DataFrame, one_task: int = ONE_TASK) -> DataFrame:
    """Candidates taken in order of score (falling), size and key, each if none of its samples is in one taken before it with as many samples.

    Few candidates are gone through in one task for each length. Otherwise each round takes every candidate that comes first for
    all its samples and, so that long chains of conflicts end soon, all that are taken among the first one_task of each
    length that are left (none if one_task is 0); both are of the same choice. Then candidates that share a sample with a taken one
    are dropped, until none is left. Rounds carry numbers of candidates and samples alone: a task makes one row for each
    of its samples, and what is used is looked up in place. The candidates are read more than once and should be a written table.
    """
    thin = candidates.select("key", "length", "samples", "total_targets", "total_size")
    most = thin.groupBy("length").count().agg(F.max("count")).first()[0] or 0
    if most <= one_task:
        choose = _in_turn(["total_targets", "total_size", "key"], [False, True, True])
        return candidates.join(thin.groupBy("length").applyInPandas(choose, "key string"), "key", "left_semi")
    order, alive, widest = _numbered_sets(thin)
    taken = []
    while not alive.isEmpty():
        first = alive.select("at", F.size("ids").alias("n"), F.explode("ids").alias("id")).groupBy("id").agg(F.min("at").alias("at"), F.min_by("n", "at").alias("n"))
        first = cut(first, "first")
        won = first.join(small(first.groupBy("at", "n").count().where("count = n").select("at")), "at", "left_semi").select("at", "id")
        if one_task:
            rows = _prefix(alive, one_task).select(F.col("at").alias("key"), "length", F.col("ids").alias("samples"), "at")
            turn = cut(rows.groupBy("length").applyInPandas(_in_turn(["at"], [True]), "key long").withColumnRenamed("key", "at"), "turn")
            won = won.unionByName(alive.join(small(turn), "at", "left_semi").select("at", F.explode("ids").alias("id"))).distinct()
        won = cut(won, "wins")
        taken.append(won.select("at").distinct())
        used = small(won.select("id").distinct())
        for i in range(widest):  # a place that a set doesn't have is null, and meets nothing
            alive = alive.join(used.withColumnRenamed("id", "_id"), F.get("ids", F.lit(i)) == F.col("_id"), "left_anti")
        alive = cut(alive, "alive")
    if not taken:
        return candidates.where(F.lit(False))
    keys = order.join(small(cut(reduce(DataFrame.unionByName, taken), "taken")), "at", "left_semi").select("key")
    return candidates.join(small(cut(keys, "keys")), "key", "left_semi")


def _numbered_sets(thin: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """(at, key): the candidates in their order; (at, length, ids): those with samples, these as numbers that differ between lengths; and the most samples of a set."""
    order = numbered(thin.select("key", "length", F.array_compact(F.array_distinct("samples")).alias("samples"), (-F.col("total_targets")).alias("a"), F.col("total_size").alias("b")), "at", "length", "a", "b", "key")
    order = cut(order.select("at", "key", "length", "samples"), "order")
    names = numbered(order.select("length", F.explode("samples").alias("sample")).distinct(), "id", "length", "sample")
    names = small(cut(names.select(F.col("length").alias("_length"), "sample", F.col("id").cast("int").alias("_id")), "names"))
    widest = order.agg(F.max(F.size("samples"))).first()[0] or 0
    sets = order.select("at", "length", "samples", F.array().cast("array<int>").alias("ids")).where(F.size("samples") > 0)
    for i in range(widest):
        sets = sets.join(names, (F.col("length") == F.col("_length")) & (F.get("samples", F.lit(i)) == F.col("sample")), "left")
        sets = sets.select("at", "length", "samples", F.array_append("ids", F.col("_id")).alias("ids"))
    return order.select("at", "key"), cut(sets.select("at", "length", F.array_compact("ids").alias("ids")), "alive"), widest


def _by_rarity(rows: DataFrame, on: str, ids: DataFrame) -> DataFrame:
    """(on, ids): the numbers of the samples of each row (on, length, samples), the rarest first. Samples without a number are left out."""
    each = rows.select(on, "length", F.explode(F.array_distinct("samples")).alias("sample")).join(ids, ["length", "sample"])
    return each.groupBy(on).agg(F.array_sort(F.collect_list("id")).alias("ids"))


def extra_targets(chosen: DataFrame, edges: DataFrame, max_combined: int = 100, paired: int = PAIRED) -> DataFrame:
    """target_ids made distinct, with those of pools of over max_combined samples that hold all samples of the chosen set and have its size.

    Samples are numbered by the pools that have them, the rarest first. A set meets only the pools that have its two rarest samples:
    pools of at most `paired` samples are listed under all pairs, which are few. Larger pools are listed under their samples, and
    met by a set's rarest one. The other samples are looked up in what is met, so a sample that all pools have makes no hot key.
    """
    pools = edges.where((F.col("style") == "pool") & (F.size("samples") > max_combined)).select(F.col("cluster_size").alias("length"), "samples", "target_ids")
    pools = cut(pools.withColumn("pool", F.monotonically_increasing_id()), "pools")
    if pools.isEmpty():
        return chosen.withColumn("target_ids", F.array_distinct("target_ids"))
    chosen = cut(chosen.withColumn("_row", F.monotonically_increasing_id()), "chosen")
    held = pools.select("length", F.explode(F.array_distinct("samples")).alias("sample")).groupBy("length", "sample").agg(F.count(F.lit(1)).alias("n"))
    ids = small(cut(numbered(held, "id", "n", "length", "sample").select("length", "sample", F.col("id").cast("int").alias("id")), "ids"))
    lists = cut(_by_rarity(pools, "pool", ids).join(pools.select("pool", "length", "target_ids"), "pool"), "lists")
    # a set of a sample without a number, or with one twice, is in no pool
    sets = _by_rarity(chosen, "_row", ids).join(chosen.select("_row", "length"), "_row").where(F.size("ids") == F.col("length")).drop("length")
    first, both = F.get("ids", F.lit(0)), F.shiftleft(F.get("ids", F.lit(0)).cast("bigint"), 32) + F.get("ids", F.lit(1))
    pairs = (F.size("ids") <= paired) & (F.col("length") > 1)
    few = lists.where(pairs).select("pool", F.posexplode("ids").alias("p", "x"), "ids")
    few = few.select("pool", "x", F.explode(F.slice("ids", F.col("p") + 2, F.size("ids"))).alias("y")).select("pool", (F.shiftleft(F.col("x").cast("bigint"), 32) + F.col("y")).alias("at"))
    met = sets.where(F.size("ids") > 1).select("_row", both.alias("at"), F.slice("ids", 3, F.size("ids")).alias("rest")).join(few, "at").drop("at")
    many = lists.where(~pairs).select("pool", F.explode("ids").alias("at"))
    if not many.isEmpty():
        met = met.unionByName(sets.select("_row", first.alias("at"), F.slice("ids", 2, F.size("ids")).alias("rest")).join(many, "at").drop("at"))
    extra = met.join(lists.drop("length"), "pool").where(F.size(F.array_except("rest", "ids")) == 0).groupBy("_row").agg(F.flatten(F.collect_list("target_ids")).alias("extra"))
    extra = small(cut(extra, "extra"), 300_000)
    out = F.array_distinct(F.concat("target_ids", F.coalesce("extra", F.array().cast("array<bigint>"))))
    return chosen.join(extra, "_row", "left").withColumn("target_ids", out).drop("extra", "_row")


def sample_targets(edges: DataFrame, single: bool = False) -> DataFrame:
    """Distinct (candidate, target): every sample of an edge, or in one-sample mode its destination, with the edge's targets."""
    who = F.array(F.get("samples", F.lit(1))) if single else F.col("samples")
    each = edges.select("target_ids", F.explode(who).alias("candidate")).where("candidate is not null")
    return each.select("candidate", F.explode("target_ids").alias("target")).distinct()


def _by_frequency(each: DataFrame, candidates: DataFrame, rare: float) -> DataFrame:
    """(key, target, w, rare): how often a set has a target, and whether the target is of the share `rare` of the set's targets that the fewest samples have."""
    held = candidates.groupBy("target").agg(F.count("candidate").alias("f"))
    own = cut(each.groupBy("key", "target").agg(F.count(F.lit(1)).alias("w")).join(held, "target", "left").select("key", "target", "w", F.coalesce("f", F.lit(0)).alias("f")), "lists")
    return own.join(own.groupBy("key").agg(F.percentile_approx("f", rare).alias("most")), "key").select("key", "target", "w", (F.col("f") <= F.col("most")).alias("rare"))


def _bounded_counts(each: DataFrame, candidates: DataFrame, most: int, rare: float = 0.75) -> DataFrame:
    """(key, candidate, n) for at least the first `most` candidates of each set, those of equal count included.

    The short lists, of the targets that few samples have, are counted first. The count of the candidate in the last place is then one
    that a candidate must reach, and the long lists can add no more than their number to a count: who can't reach it any more is
    given up, and the long lists are only looked up for the others. A set for which a sample that no short list has could still
    get a place is counted in full.
    """
    lists = cut(_by_frequency(each, candidates, rare), "lists")
    short = cut(lists.where("rare").join(candidates, "target", "left").groupBy("key", "candidate").agg(F.sum("w").alias("n")), "short")
    rest = lists.groupBy("key").agg(F.sum(F.when(F.col("rare"), 0).otherwise(F.col("w"))).alias("rest"))
    last = short.withColumn("k", F.row_number().over(W.partitionBy("key").orderBy(F.desc("n")))).where(F.col("k") <= most)
    last = last.where(F.col("k") == most).select("key", F.col("n").alias("least"))
    sure = small(cut(rest.join(last, "key").where(F.col("least") > F.col("rest")), "sure"))
    alive = short.join(sure, "key").where(F.col("n") + F.col("rest") >= F.col("least")).select("key", "candidate", "n")
    asked = alive.where("candidate is not null").select("key", "candidate").join(lists.where("not rare").select("key", "target", "w"), "key")
    more = asked.join(candidates, ["target", "candidate"], "left_semi").select("key", "candidate", F.col("w").alias("n"))
    full = lists.join(sure, "key", "left_anti").join(candidates, "target", "left").select("key", "candidate", F.col("w").alias("n"))
    return alive.unionByName(more).unionByName(full).groupBy("key", "candidate").agg(F.sum("n").alias("n"))


def recovery(chosen: DataFrame, candidates: DataFrame, most: int = 20, bounded: bool = False) -> DataFrame:
    """With recover_candidates: up to `most` samples by the number of shared targets, then by name. Targets that no sample has count as one nameless candidate, which takes a place and is left out of the list. bounded: long lists of samples are only read for candidates that can still get a place, which pays where some targets are in very many samples; the result is the same."""
    each = chosen.select("key", F.explode("target_ids").alias("target"))
    if bounded:
        n = _bounded_counts(each, cut(candidates, "candidates"), most)
    else:
        n = each.join(candidates, "target", "left").groupBy("key", "candidate").agg(F.count(F.lit(1)).alias("n"))
    w = W.partitionBy("key").orderBy(F.desc("n"), F.asc_nulls_last("candidate"))
    top = n.withColumn("k", F.row_number().over(w)).where(F.col("k") <= most)
    lists = top.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("k", "candidate"))).alias("x"))
    out = chosen.join(lists, "key", "left").withColumn("recover_candidates", F.coalesce(F.transform("x", lambda v: v.getField("candidate")), F.array().cast("array<string>")))
    return out.drop("x")


def finished(chosen: DataFrame, most: int = 20, weighted: bool = False, single: bool = False) -> DataFrame:
    """The final table: ranked by score, size and samples (falling), named, with comma lists."""
    recover = F.slice(F.array_distinct(F.concat("samples", "recover_candidates")), 1, most)
    total = F.col("total_targets") if weighted else F.size("target_ids").cast("double")
    rows = chosen.select(F.col("key").alias("samples"), F.col("length").cast("int").alias("length"), total.alias("total_targets"), "total_size", F.array_join(F.array_sort(recover), ",").alias("recover_samples"))
    ranked = numbered(rows, "i", F.desc("total_targets"), F.asc("total_size"), F.desc("samples"))
    name = F.col("samples") if single else F.concat(F.lit("coassembly_"), F.col("i").cast("string"))
    return ranked.withColumn("coassembly", name).drop("i")


def min_targets(edges: DataFrame, few: int = 10_000) -> int:
    """10 for more than `few` edges, else 1."""
    return 10 if edges.limit(few + 1).count() > few else 1
